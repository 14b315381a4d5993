"""Links and components equal brute force; edge vectors."""

import numpy as np
import pytest

from tessera.llm import vector_dedup
from tessera.llm.common import read_table, ship
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<float>, label int, id string, rep string, `a.b` string"


def brute(rows, threshold=0.93):
    """rows: (id, vector, label) -> {id: (links, component)}"""
    def good(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)

    ok = [(i, np.asarray(v, dtype=np.float32).astype(float), l) for i, v, l in rows if i is not None and l is not None and good(v)]
    links, root = {i: 0 for i, _, _ in rows}, {i: i for i, _, _ in rows}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for x in range(len(ok)):
        for y in range(x + 1, len(ok)):
            (i, v, a), (j, w, b) = ok[x], ok[y]
            if a == b and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= threshold:
                links[i] += 1
                links[j] += 1
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    return {i: (links[i], find(i)) for i in links}


def frame(spark, rows):
    return spark.createDataFrame([(i, v, l, "x", "x", "x") for i, v, l in rows], SCHEMA)


def test_query_equals_brute_force(spark):
    ship(spark)
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in read_table(spark, SF_SMALL, "embeddings").collect()]
    got = vector_dedup.op10_embedding_near_dedup(spark, SF_SMALL).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == brute(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


@pytest.mark.parametrize("shard_rows", [64, 16])
def test_dense_groups_over_several_pieces(spark, shard_rows):
    ship(spark)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(3, 16))
    rows = [(i, (centres[i % 3] + rng.normal(size=16) * 0.15).tolist(), 0) for i in range(180)]
    rows += [(200 + i, rng.normal(size=16).tolist(), i % 2) for i in range(120)]
    rows += [(400 + i, rows[0][1], 0) for i in range(30)]  # copies
    got = vector_dedup.near_duplicates(frame(spark, rows), shard_rows=shard_rows, degree=16, candidates=24).collect()
    want = brute(rows)
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got}
    assert sum(n for n, _ in found.values()) >= 0.97 * sum(n for n, _ in want.values())
    assert all(found[i][0] <= want[i][0] for i in want)  # none below the threshold
    assert {i: c for i, (_, c) in found.items()} == {i: c for i, (_, c) in want.items()}


def test_edge_vectors(spark):
    ship(spark)
    rows = [
        (1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, [1.0, 0.0], 1), (4, [1.0, 0.0], None), (5, None, 0), (6, [0.0, 0.0], 0),
        (7, [1.0, None], 0), (8, [float("nan"), 1.0], 0), (9, [float("inf"), 1.0], 0), (10, [1.0, 0.0, 0.0], 0), (11, [], 0),
        (12, [1.0, 0.0], 0), (13, [1e-30, 0.0], 0), (14, [-1.0, 0.0], 0),
    ]
    got = vector_dedup.near_duplicates(frame(spark, [*rows, (None, [1.0, 0.0], 0), (14, [-1.0, 0.0], 0)])).collect()
    of = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got}
    assert len(got) == 16
    assert of[1] == (3, 1, True) and of[2] == (3, 1, False) and of[12][:2] == (3, 1) and of[13][:2] == (3, 1)
    assert of[14] == (1, 14, True)  # two rows of one id link with each other
    assert of[None] == (0, None, False)
    assert all(of[i] == (0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 11))
    assert vector_dedup.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_low_recall_is_an_error(spark):
    ship(spark)
    rng = np.random.default_rng(2)
    base = rng.normal(size=8)
    rows = [(i, (base + rng.normal(size=8) * 0.05).tolist(), 0) for i in range(200)]
    with pytest.raises(RuntimeError, match="recall"):
        vector_dedup.near_duplicates(frame(spark, rows), min_recall=1.01)
