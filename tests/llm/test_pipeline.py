"""The pipeline's stages, one after the other."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import simhash, toxicity
from tessera.llm.common import read_table, ship, stored
from tests.conftest import SF_MID
from tests.llm.common import DOCS, EDGE_ROWS, docs_frame


@pytest.fixture(scope="module")
def stages(spark):
    out = [read_table(spark, SF_MID, "documents")]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], SF_MID)))
    return out


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_columns_and_decisions(spark, stages):
    docs = stages[0]
    assert all(s.columns == docs.columns for s in stages[1:5])
    sizes = [s.count() for s in stages]
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] and sizes[5] == sizes[4] >= sizes[3]
    assert ids(stages[3]) == ids(stages[4]) == ids(stages[5])  # mixing leaves no document out


def test_each_stage_is_its_operator(spark, stages):
    scores = toxicity.score(stages[0], toxicity.learn(stages[0], read_table(spark, SF_MID, "labels"), label_weights=True))
    assert ids(stages[1]) == ids(scores.where(F.col("toxicity.score") < 0.3))
    components = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(stages[2]).collect()}
    assert ids(stages[3]) == set(components.values())


def test_run_equals_the_stages(spark, stages):
    key = lambda df: sorted((r["doc_id"], tuple(r["piece_ids"])) for r in df.collect())
    assert key(corpus_pipeline.run(spark, SF_MID)) == key(stages[5])
    # Ids decode to the text they were made of.
    assert stages[5].where("round_trip").count() == stages[5].count()


def test_edge_documents(spark):
    for rows in (EDGE_ROWS, []):
        docs = docs_frame(spark, rows) if rows else spark.createDataFrame([], DOCS)
        for name, stage in corpus_pipeline.STAGES:
            alone = stage(spark, docs, SF_MID)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert alone.columns == docs.columns
            assert alone.count() <= 2 * len(rows)
