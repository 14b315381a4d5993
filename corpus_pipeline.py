"""A corpus pipeline over ``documents``: five stages, each one operator of ``tessera.llm``.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns what the next stage gets as ``docs``. All but the last return the
columns they were given. ``run`` writes every stage's rows to the folder that
``spark.checkpoint.dir`` names and reads them back, so a lost executor costs the
stage it was in at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import mixing, quality_rules, sentence_pieces, simhash, toxicity
from tessera.llm.common import read_table, ship, stored, temp_column


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under 0.3, learned from the labelled ones."""
    ship(spark)
    index = toxicity.learn(docs, read_table(spark, sf_dir, "labels"), label_weights=True)
    scored = toxicity.score(docs, index, out := temp_column("toxicity"), evidence=0)
    return scored.where(F.col(f"{out}.score") < toxicity.THRESHOLD).drop(out)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose host's shrunk failure rate is at most one half."""
    return quality_rules.judge(docs, out := temp_column("quality")).where(F.col(f"{out}.kept")).drop(out)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component (4-word shingles, 4 bits)."""
    ship(spark)
    return simhash.deduplicate(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, those of small sources up to twice, by flattened source weights."""
    return mixing.mixed_documents(docs, target_entropy=None, max_repeats=2.0)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' piece ids, and whether they decode to the text."""
    ship(spark)
    path = public_tokenizers.path("piece_bpe_32k.model")
    encoded = sentence_pieces.encode(docs.select("doc_id", "lang", "source", "text"), "text", "piece_ids", path, round_trip="round_trip")
    return encoded.select("doc_id", "lang", "source", F.size("piece_ids").cast("long").alias("n_pieces"), "piece_ids", "round_trip")


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_low_quality),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing sources", mix),
    ("SentencePiece encoding", to_pieces),
]

# SQL cannot express the scores, fingerprints and pieces.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
