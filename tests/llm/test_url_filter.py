"""Rules against plain Python; the classifier by held-out accuracy and by its features."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from tessera.llm import url_filter
from tessera.llm.common import read_table
from tests.conftest import SF_SMALL
from tests.llm.common import CLASHING

URLS = [
    "http://a.org", "http://a.org/", "https://org/x", "http://borg/x", "http://EXAMPLE.org/es/1", "https://www.example.org/es/",
    "http://example.org/es", "http://example.org/en/1", "http://example.org/en/10?x#y", "http://notexample.org/es/", "http://x.com/fr/",
    "http://x.com/de/9", "http://x.com?q=/fr/", "http://x.com#/fr/", "http://x.com/FR/", "https://a.net/p?u=http://b.org/x", "no-scheme.org/x",
    "", None, "://", "://org/", "x://É.com/fr/ü", "http://x.com/fr/" + "a/" * 20_000, "http://x.com/a\n/b", "http://.org/", "http://a..org//", "http://user@x.org:80/p",
]


def plain(url):
    """(host, path, rule, verdict of the rule)."""
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([i for i, c in enumerate(rest) if c in "/?#"] or [len(rest)])
    host = re.sub("[A-Z]", lambda m: m[0].lower(), rest[:cut])
    path = re.split("[?#]", rest[cut:], maxsplit=1)[0]
    best = None
    for verdict, text in url_filter.RULES:
        name, below = text.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + below) and (best is None or len(text) > len(best[0])):
            best = (text, verdict)
    return host, path, *(best or (None, None))


@pytest.fixture(scope="module")
def learned(spark):
    return url_filter.learn(url_filter.labelled_urls(spark))


def test_rules_equal_plain_python(spark, learned):
    df = spark.createDataFrame([(i, u) for i, u in enumerate([*URLS, *URLS])], "page_id long, url string").repartition(3)
    for c in CLASHING:
        df = df.withColumn(c, F.lit("x")) if c != "score" else df
    got = {r["page_id"]: r for r in url_filter.judge(df, "url", url_filter.RULES, learned).collect()}
    assert len(got) == 2 * len(URLS)
    for i, u in enumerate([*URLS, *URLS]):
        host, path, rule, verdict = plain(u)
        r = got[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule), u
        assert r["verdict"] == (verdict or ("block" if r["score"] >= 0.5 else "allow"))
        assert r["a.b"] == "x" and 0 <= r["score"] <= 1
    assert url_filter.judge(df.limit(0), "url", url_filter.RULES, learned).count() == 0


def test_longest_rule_then_blocking_one(spark):
    rules = [("allow", "a.com/x"), ("block", "com/xx/"), ("block", "a.com/x"), ("allow", "com/")]
    df = spark.createDataFrame([("a.com", "/xx/1"), ("b.com", "/xx/1"), ("b.com", "/")], "host string, path string")
    got = df.select("host", "path", url_filter.matching_rule(F.col("host"), F.col("path"), rules).alias("r")).collect()
    assert [(r["r"]["verdict"], r["r"]["text"]) for r in got] == [("block", "a.com/x"), ("block", "com/xx/"), ("allow", "com/")]


def test_lexical_features(spark):
    url = "https://www.ab-1.example.com/en/12-x?p=1&q=22#f"
    df = spark.createDataFrame([(url,)], "url string").withColumns(
        dict(zip(["host", "path"], url_filter.host_and_path(F.col("url"))))
    )
    got = df.select(*[c.alias(n) for n, c in url_filter.lexical(F.col("url"), F.col("host"), F.col("path")).items()]).first()
    host = "www.ab-1.example.com"
    entropy = -sum(host.count(c) / len(host) * math.log2(host.count(c) / len(host)) for c in set(host))
    assert got["host_entropy"] == pytest.approx(entropy)
    assert (got["host_length"], got["path_length"], got["query_length"], got["host_depth"], got["path_depth"]) == (20, 8, 8, 4, 2)
    assert (got["host_hyphens"], got["path_hyphens"], got["parameters"], got["longest_label"]) == (1, 1, 2, 7)
    assert (got["host_digits"], got["path_digits"]) == (1 / 20, 2 / 8)


def test_own_label_is_left_out_of_suffix_shares(spark):
    rows = spark.createDataFrame([("http://one.aa/", 1.0), ("http://two.bb/", 0.0), ("http://x.bb/", 0.0)], "url string, label double")
    known = spark.createDataFrame([(1, "aa", 1.0, 1.0), (1, "bb", 2.0, 0.0)], "labels int, suffix string, seen double, bad double")
    df, names = url_filter._described(rows, F.col("url"), known, 0.5, F.col("label"))
    shares = {r["url"]: r[names[-3]] for r in df.collect()}
    assert shares["http://one.aa/"] == pytest.approx(0.5)  # nothing but its own label is known of aa
    assert shares["http://two.bb/"] == pytest.approx((0 + 4 * 0.5) / (1 + 4))


def test_held_out_accuracy(spark):
    rows = [tuple(line.split(" ", 1)) for line in url_filter.LABELLED.strip().splitlines()]
    random.Random(3).shuffle(rows)
    hits = []
    for fold in range(3):
        frame = lambda part: spark.createDataFrame([(u, int(y)) for y, u in part], "url string, label int")
        learned = url_filter.learn(frame([r for i, r in enumerate(rows) if i % 3 != fold]))
        told = url_filter.scored(frame([r for i, r in enumerate(rows) if i % 3 == fold]), "url", learned, "s").collect()
        hits += [(r["s"] >= 0.5) == bool(r["label"]) for r in told]
    assert sum(hits) / len(hits) >= 0.85


def test_query(spark):
    got = {r["page_id"]: r for r in url_filter.op13_url_filter(spark, SF_SMALL).collect()}
    rows = read_table(spark, SF_SMALL, "pages").select("page_id", "url").collect()
    assert len(got) == len(rows)
    for page_id, url in rows:
        host, path, rule, verdict = plain(url)
        assert (got[page_id]["host"], got[page_id]["path"], got[page_id]["rule"]) == (host, path, rule)
        assert verdict in (None, got[page_id]["verdict"])
    assert {r["verdict"] for r in got.values()} == {"allow", "block"}


def test_no_python_in_the_plan(spark, learned):
    df = url_filter.judge(read_table(spark, SF_SMALL, "pages").select("page_id", "url"), "url", url_filter.RULES, learned)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|SortMergeJoin", plan)


def test_one_label_is_refused(spark):
    with pytest.raises(ValueError, match="both labels"):
        url_filter.learn(spark.createDataFrame([("http://a.b/", 1)], "url string, label int"))
