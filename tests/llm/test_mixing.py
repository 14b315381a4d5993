"""The exponent, the budgets and the stream."""

import math
from collections import Counter, defaultdict

import pytest

from tessera.llm import mixing
from tests.llm.common import DOCS, EDGE_ROWS, docs_frame

SOURCES = {"big": 300, "mid": 60, "small": 12, None: 30}


def corpus(spark):
    rows = [(k, "w " * (1 + k % 9), s) for k, s in enumerate(s for s, n in SOURCES.items() for _ in range(n))]
    return docs_frame(spark, rows), rows


def tokens_of(rows):
    out = Counter()
    for _, t, s in rows:
        out[s] += max(1, len((t or "").split()))
    return out


def weights(tokens, a):
    z = sum(t**a for t in tokens.values())
    return {s: t**a / z for s, t in tokens.items()}


def entropy(w):
    return -sum(x * math.log(x) for x in w.values())


def stream(df):
    return [r.asDict() for r in df.collect()]


@pytest.mark.parametrize("share", [0.8, 0.95, 0.999])
def test_entropy_target(spark, share):
    docs, rows = corpus(spark)
    tokens = tokens_of(rows)
    table = spark.createDataFrame([(s, 1, t) for s, t in tokens.items()], "source string, rows long, tokens long")
    a = mixing.fit_exponent(table, share, None, None)
    assert entropy(weights(tokens, a)) == pytest.approx(share * math.log(4), abs=1e-5)
    assert entropy(weights(tokens, a - 2e-6)) > share * math.log(4)


def test_repetition_limit(spark):
    docs, rows = corpus(spark)
    tokens = tokens_of(rows)
    got = stream(mixing.mix_sources(docs, target_entropy=None, max_repeats=3.0, block_tokens=100))
    copies = Counter(r["doc_id"] for r in got)
    assert set(copies) == {k for k, _, _ in rows}  # the covering budget leaves nobody out
    repeats = {s: sum(r["n_tokens"] for r in got if r["source"] == s) / t for s, t in tokens.items()}
    assert max(repeats.values()) == pytest.approx(3, rel=0.1) and min(repeats.values()) == pytest.approx(1, rel=0.02)


def test_stream_meets_budgets_in_every_block(spark):
    docs, rows = corpus(spark)
    total = 3000
    got = stream(mixing.mix_sources(docs, target_entropy=0.9, max_repeats=None, total=total, block_tokens=500, seed=7))
    tokens = tokens_of(rows)
    table = spark.createDataFrame([(s, 1, t) for s, t in tokens.items()], "source string, rows long, tokens long")
    w = weights(tokens, mixing.fit_exponent(table, 0.9, None, total))
    blocks = defaultdict(Counter)
    for r in got:
        blocks[r["block"]][r["source"]] += r["n_tokens"]
    assert set(blocks) == set(range(6))
    for b in blocks.values():
        for s in tokens:
            assert abs(b[s] - w[s] * total / 6) <= 2 * 9  # a document may straddle either end
    for block in blocks:
        places = sorted(r["position"] for r in got if r["block"] == block)
        assert places == list(range(len(places)))
    # Every epoch but a source's last is a whole permutation of its documents.
    for s in tokens:
        epochs = defaultdict(list)
        for r in got:
            if r["source"] == s:
                epochs[r["epoch"]].append(r["doc_id"])
        mine = sorted(k for k, _, x in rows if x == s)
        for e in sorted(epochs)[:-1]:
            assert sorted(epochs[e]) == mine
        assert len(set(epochs[max(epochs)])) == len(epochs[max(epochs)])


def test_seed_and_partitions(spark):
    docs, _ = corpus(spark)
    key = lambda rows: sorted((r["block"], r["position"], r["doc_id"], r["epoch"]) for r in rows)
    a = key(stream(mixing.mix_sources(docs, block_tokens=200)))
    assert a == key(stream(mixing.mix_sources(docs.repartition(7), block_tokens=200)))
    assert a != key(stream(mixing.mix_sources(docs, block_tokens=200, seed=2)))


def test_impossible_budget(spark):
    docs, _ = corpus(spark)
    with pytest.raises(ValueError, match="repetition"):
        mixing.mix_sources(docs, max_repeats=2.0, total=10**6)


def test_a_budget_too_small_for_some_sources(spark):
    docs, rows = corpus(spark)
    got = stream(mixing.mix_sources(docs, target_entropy=None, max_repeats=None, total=5))
    assert 0 < len(got) <= 5 and all(r["epoch"] == 0 for r in got)
    assert "small" not in {r["source"] for r in got}


def test_edge_rows(spark):
    docs = docs_frame(spark, EDGE_ROWS)
    got = stream(mixing.mix_sources(docs, target_entropy=None, max_repeats=None))
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _, _ in EDGE_ROWS)
    mixed = mixing.mixed_documents(docs, target_entropy=None, max_repeats=2.0)
    assert mixed.columns == docs.columns
    assert {r["doc_id"] for r in mixed.collect()} == {i for i, _, _ in EDGE_ROWS}
    assert mixing.mix_sources(spark.createDataFrame([], DOCS)).count() == 0
    assert mixing.mixed_documents(spark.createDataFrame([], DOCS)).count() == 0
