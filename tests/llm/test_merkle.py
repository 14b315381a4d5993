"""The manifest equals one built row by row; proofs verify, and only unchanged rows do."""

import hashlib
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from tessera.llm import merkle
from tests.llm.common import DOCS, EDGE_ROWS, docs_frame

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[f] for f in FIELDS)])


def grow(level, arity):
    """Levels from the leaves up to the one node that remains."""
    levels = [level]
    while len(level) > 1:
        level = [h(*level[i : i + arity]) for i in range(0, len(level), arity)]
        levels.append(level)
    return levels


def siblings(levels, i, arity):
    out = []
    for level in levels[:-1]:
        run = level[i // arity * arity : i // arity * arity + arity]
        out += run[: i % arity] + run[i % arity + 1 :]
        i //= arity
    return out


def brute(rows, arity):
    rows = sorted(rows, key=lambda r: ((r["source"] is not None, (r["source"] or "").encode()), (r["doc_id"] is not None, r["doc_id"] or 0), leaf_of(r)))
    groups = [list(g) for _, g in groupby(rows, key=lambda r: r["source"])]
    trees = [grow([leaf_of(r) for r in g], arity) for g in groups]
    outer = grow([t[-1][0] for t in trees], arity)
    out = []
    for k, (g, t) in enumerate(zip(groups, trees)):
        for i, r in enumerate(g):
            proof = siblings(t, i, arity) + siblings(outer, k, arity)
            out.append((r["doc_id"], t[0][i], t[-1][0], outer[-1][0], h(*proof)))
    return sorted(out, key=str)


def answers(df, arity):
    got = merkle.manifest(df, FIELDS, "source", "doc_id", ["doc_id"], arity=arity).collect()
    assert all(r["verified"] and r["folded_root"] == r["root"] for r in got)
    return sorted([tuple(r)[:5] for r in got], key=str)


@pytest.mark.parametrize("arity", [2, 3, 16])
def test_equals_row_by_row(spark, arity):
    rows = EDGE_ROWS + [(100 + i, f"text {i}", f"s{i % 5}") for i in range(70)] + [(300, "alone", "\u00e9"), (301, "x", "z" * 40)]
    df = docs_frame(spark, rows).repartition(5)
    assert answers(df, arity) == brute(df.collect(), arity)


def test_one_group_over_many_partitions_and_repeated_rows(spark):
    rows = [(i // 3, f"t{i // 3}", "hot") for i in range(900)] + [(None, "same", "hot")] * 200
    df = docs_frame(spark, rows, clash=False).repartition(7)
    assert answers(df, 16) == brute(df.collect(), 16)


@pytest.mark.parametrize("rows", [[(1, "only", "a")], [(1, "a", "a"), (2, "b", "b")], [(i, "x", "a") for i in range(17)]])
def test_lone_nodes(spark, rows):
    df = docs_frame(spark, rows)
    assert answers(df, 16) == brute(df.collect(), 16)


def test_empty_table(spark):
    assert merkle.manifest(spark.createDataFrame([], DOCS), FIELDS, "source", "doc_id", ["doc_id"]).count() == 0


def test_a_changed_row_does_not_verify(spark):
    df = docs_frame(spark, [(i, f"Text {i}", f"s{i % 3}") for i in range(60)])
    changed = F.when(F.col("doc_id") % 7 == 0, F.lower("text")).otherwise(F.col("text"))
    got = merkle.manifest(df, FIELDS, "source", "doc_id", ["doc_id"], {"text": changed}).collect()
    assert {r["doc_id"] for r in got if not r["verified"]} == {i for i in range(60) if i % 7 == 0}
    want = {t[0]: t[1:] for t in brute(df.collect(), 16)}
    assert all((r["leaf"], r["subroot"], r["root"], r["proof_sha256"]) == want[r["doc_id"]] for r in got)


def test_names_of_the_result_are_refused(spark):
    df = docs_frame(spark, [(1, "a", "a")]).withColumn("root", F.lit(1))
    with pytest.raises(ValueError, match="root"):
        merkle.manifest(df, FIELDS, "source", "doc_id", ["root"])
