"""Counts equal a plain Python version; host verdicts."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.llm import quality_rules
from tests.llm.common import DOCS, EDGE_ROWS, docs_frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    w = WORD.findall(text)
    windows = list(zip(w, w[1:], w[2:]))
    seen = Counter(windows)
    repeated = {j for i, t in enumerate(windows) if seen[t] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(repeated),
        len(w) < 50 or 100 * len(repeated) > 50 * len(w),
    )


TEXTS = [
    "a b c a b c", "a a a a a", "a b c d a b c d a b c", "x y\nx y\n\n \nx y", "# * $ % & | < > #x", "one\x0btwo\x0cthree\rfour",
    " lead and trail ", "a b nbsp is no gap", "p q r p q s p q r", "k " * 120 + "z", "the end " * 30 + " ".join(map(str, range(100))),
]


@pytest.mark.parametrize("rows", [EDGE_ROWS, [(i, t, "s") for i, t in enumerate(TEXTS)]], ids=["edge", "texts"])
def test_counts(spark, rows):
    got = quality_rules.judge(docs_frame(spark, rows)).collect()
    assert len(got) == len(rows)
    names = [*quality_rules.COUNTS, "base_failed"]
    have = Counter((r["doc_id"], *(r["quality"][n] for n in names)) for r in got)
    assert have == Counter((i, *plain(t)) for i, t, _ in rows)
    assert all(r["a.b"] == "x" and r["kept"] == "x" for r in got)  # other columns pass through


def host_frame(spark, hosts):
    """hosts: (name, documents, failures)"""
    good = " ".join(f"word{i}" for i in range(80))
    rows = [(h, i, "short" if i < f else f"{h} {i} {good}") for h, n, f in hosts for i in range(n)]
    return docs_frame(spark, [(k, t, h) for k, (h, i, t) in enumerate(rows)])


def test_bad_hosts_lose_all_documents(spark):
    docs = host_frame(spark, [("bad", 200, 170), (None, 100, 90), *((f"h{i}", 60, 3 + i % 4) for i in range(12)), ("tiny", 1, 1)])
    got = quality_rules.judge(docs).groupBy("source").agg(
        F.sum(F.col("quality.kept").cast("int")).alias("kept"), F.first("quality.host_rate").alias("rate")
    ).collect()
    kept, rate = {r["source"]: r["kept"] for r in got}, {r["source"]: r["rate"] for r in got}
    assert kept["bad"] == 0 and kept[None] == 0
    assert all(kept[f"h{i}"] == 60 - (3 + i % 4) for i in range(12))
    # One failure of one document shrinks towards the mean; many hardly do.
    assert 0.2 < rate["tiny"] < 0.9 and abs(rate["bad"] - 0.85) < 0.02


def test_rates_are_the_moment_estimate(spark):
    hosts = [("a", 50, 10), ("b", 30, 20), ("c", 20, 1), ("d", 10, 9)]
    docs = host_frame(spark, hosts).withColumn("failed", F.length("text") == 5)
    got = {r["host"]: r["rate"] for r in quality_rules.host_rates(docs, "source", "failed").collect()}
    n, f, k = sum(h[1] for h in hosts), sum(h[2] for h in hosts), len(hosts)
    p = f / n
    spread = sum(m * (x / m - p) ** 2 for _, m, x in hosts)
    phi = (spread - (k - 1) * p * (1 - p)) / (p * (1 - p) * (n - sum(m * m for _, m, _ in hosts) / n - (k - 1)))
    s = 1 / phi - 1
    for h, m, x in hosts:
        assert got[h] == pytest.approx((x + p * s) / (m + s))


def test_alike_hosts_share_one_rate(spark):
    docs = host_frame(spark, [(h, 40, 4) for h in "abcd"]).withColumn("failed", F.length("text") == 5)
    rates = {r["rate"] for r in quality_rules.host_rates(docs, "source", "failed").collect()}
    assert rates == {0.1}


def test_empty(spark):
    assert quality_rules.judge(spark.createDataFrame([], DOCS)).count() == 0
