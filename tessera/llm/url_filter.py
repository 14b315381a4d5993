"""URL filter: listed rules first, a gradient-boosted classifier for all others.

A rule allows or blocks a host with its subdomains below a path; of the rules that
fit a URL the longest decides. URLs without a rule are scored by gradient-boosted
trees over lexical features (lengths, depths, digit ratios, entropy, parameter
counts, hyphens) and statistics of the host's suffixes: the share of blocked URLs among
the labelled ones under the last one, two and three labels, shrunk towards the
overall share. For the labelled URLs themselves these shares leave their own label
out, so the trees cannot read it off.

Everything is column expressions, joins and ``pyspark.ml``: no Python runs on the
executors. Rules become one CASE expression (they are a parameter; some hundreds at
most); suffix statistics have at most three rows for each labelled URL, and at most
``MAX_LABELLED`` URLs are learned from (those of the smallest hash, so the choice is the
same at any size), hence they may be broadcast. Scoring a URL is a map, without a
shuffle.

Defined results. A NULL URL, or one without ``://``, has the empty host and path: no
rule can fit, and it is scored like any other URL with all features zero. Empty paths
fit no rule, since each rule's path begins with a slash. Of fitting rules of equal
length a blocking one wins, then the alphabetically first. URLs of any length are
read whole. Repeated URLs get the same verdict each; an empty table gives no rows; a
labelled table without both labels is an error. All columns of the input pass
through; if one has a name of the result, that is an error.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import quoted, read_table, temp_column
from tessera.llm.url_labels import LABELLED

# The rules that the registered query applies.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))

MAX_LABELLED = 50_000
SHRINK = 4.0  # weight of the overall share against the URLs under a suffix
SUFFIXES = (1, 2, 3)
THRESHOLD = 0.5
TREES, DEPTH, STEP, SEED = 30, 3, 0.2, 7
OUTPUT = ("host", "path", "rule", "verdict", "score")
ALLOW, BLOCK = "allow", "block"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host (A-Z lower-cased) and path of a URL; empty for one without ``://``."""
    rest = _rest(url)
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    """What follows the first ``://``."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule (verdict, text) that fits, as a struct, or NULL."""
    out = F.lit(None).cast("struct<verdict: string, text: string>")
    # The last one written is the first one asked.
    for verdict, text in sorted(rules, key=lambda r: (-len(r[1]), r[0] != BLOCK, r[1]), reverse=True):
        if verdict not in (ALLOW, BLOCK) or "/" not in text:
            raise ValueError(f"not a rule: {verdict} {text}")
        name, _, below = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + below)
        out = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(text).alias("text"))).otherwise(out)
    return out


def _share(text: Column, pattern: str) -> Column:
    """Share of the characters that match."""
    return F.coalesce(F.try_divide(F.regexp_count(text, F.lit(pattern)).cast("double"), F.length(text)), F.lit(0.0))


def _entropy(text: Column) -> Column:
    """Bits a character of the text's own distribution of characters."""
    n = F.length(text).cast("double")
    each = F.array_distinct(F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)))
    # Sum of c log c over the characters' counts c.
    inner = F.aggregate(each, F.lit(0.0), lambda acc, c: acc + _xlogx(n - F.length(F.replace(text, c, F.lit("")))))
    return F.when(n > 0, F.log2(n) - inner / n).otherwise(0.0)


def _xlogx(c: Column) -> Column:
    return c * F.log2(c)


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """Features of the address alone, by name."""
    query = F.regexp_extract(_rest(url), r"\?([^#]*)", 1)
    labels = F.split(host, r"\.")
    return {
        "host_length": F.length(host), "path_length": F.length(path), "query_length": F.length(query),
        "host_depth": F.regexp_count(host, F.lit(r"[^.]+")), "path_depth": F.regexp_count(path, F.lit("[^/]+")),
        "host_digits": _share(host, "[0-9]"), "path_digits": _share(path, "[0-9]"),
        "host_hyphens": F.regexp_count(host, F.lit("-")), "path_hyphens": F.regexp_count(path, F.lit("-")),
        "longest_label": F.array_max(F.transform(labels, F.length)),
        "host_entropy": _entropy(host), "query_entropy": _entropy(query),
        "parameters": F.regexp_count(query, F.lit("[^&]+")),
    }


def _suffix(host: Column, n: int) -> Column:
    """The last ``n`` labels of a host that has them, else NULL."""
    return F.when(F.size(F.split(host, r"\.")) >= n, F.substring_index(host, ".", -n))


@dataclass(frozen=True)
class Filter:
    """What was learned: the trees, the suffixes' counts and the overall share of blocked URLs."""

    model: GBTClassificationModel
    suffixes: DataFrame
    prior: float


def _described(df: DataFrame, url: Column, known: DataFrame, prior: float, label: Column | None) -> tuple[DataFrame, list[str]]:
    """``df`` with feature columns; ``label`` (of labelled rows) is left out of its own suffix shares."""
    host, path = host_and_path(url)
    base = df.withColumns({(h := temp_column("host")): host, (p := temp_column("path")): path})
    named = {temp_column(n): c.cast("double") for n, c in lexical(F.coalesce(url, F.lit("")), F.col(h), F.col(p)).items()}
    base, names = base.withColumns(named), list(named)
    for n in SUFFIXES:
        key, seen, bad = temp_column("suffix"), temp_column("seen"), temp_column("bad")
        stats = known.where(F.col("labels") == n).select(F.col("suffix").alias(key), F.col("seen").alias(seen), F.col("bad").alias(bad))
        base = base.withColumn(f"{key}_own", _suffix(F.col(h), n)).join(
            F.broadcast(stats), F.col(f"{key}_own") == F.col(key), "left"
        )
        own, one = (label.cast("double"), 1.0) if label is not None else (F.lit(0.0), 0.0)
        there = F.col(key).isNotNull()
        share = (F.col(bad) - own + SHRINK * prior) / (F.col(seen) - one + SHRINK)
        base = base.withColumn(name := temp_column(f"share_{n}"), F.when(there, share).otherwise(prior))
        names.append(name)
    return base, names


def learn(labelled: DataFrame, url: str = "url", label: str = "label", max_labelled: int = MAX_LABELLED) -> Filter:
    """Train on labelled URLs (label 1: block, 0: allow; rows with a NULL in either are no examples),
    at most ``max_labelled`` of them."""
    (u, y) = quoted([url, label])
    rows = labelled.where(u.isNotNull() & y.isNotNull()).select(u.alias("url"), y.cast("double").alias("label"))
    rows = rows.orderBy(F.xxhash64("url"), "url", "label").limit(max_labelled)
    total = rows.agg(F.avg("label").alias("prior"), F.count_distinct("label").alias("kinds")).first()
    if total["kinds"] != 2:
        raise ValueError("the labelled URLs need both labels")
    host, _ = host_and_path(F.col("url"))
    ends = F.array(*[F.struct(F.lit(n).alias("labels"), _suffix(host, n).alias("suffix")) for n in SUFFIXES])
    known = rows.select("label", F.inline(ends)).where("suffix IS NOT NULL").groupBy("labels", "suffix").agg(
        F.count(F.lit(1)).cast("double").alias("seen"), F.sum("label").alias("bad")
    )
    described, names = _described(rows, F.col("url"), known, total["prior"], F.col("label"))
    vectors = VectorAssembler(inputCols=names, outputCol="v").transform(described).select("v", "label", "url")
    trees = GBTClassifier(
        featuresCol="v", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=SEED, minInstancesPerNode=2
    )
    # A bounded table, in one order: the trees don't depend on partitioning.
    return Filter(trees.fit(vectors.coalesce(1).sortWithinPartitions("url", "label").select("v", "label")), known, total["prior"])


def scored(df: DataFrame, url: str, learned: Filter, out: str) -> DataFrame:
    """``df`` with the probability ``out`` that a URL should be blocked."""
    (u,) = quoted([url])
    described, names = _described(df, u, learned.suffixes, learned.prior, None)
    vector, probability = temp_column("v"), temp_column("p")
    model = learned.model.copy()
    model.setFeaturesCol(vector).setProbabilityCol(probability).setRawPredictionCol("").setPredictionCol("")
    result = model.transform(VectorAssembler(inputCols=names, outputCol=vector).transform(described))
    return result.select(*quoted(df.columns), vector_to_array(F.col(probability))[1].alias(out))


def judge(df: DataFrame, url: str, rules: Sequence[tuple[str, str]], learned: Filter, threshold: float = THRESHOLD) -> DataFrame:
    """``df`` with host, path, the fitting ``rule`` (NULL if none), ``verdict`` and ``score``."""
    clash = {c.lower() for c in df.columns} & set(OUTPUT)
    if clash:
        raise ValueError(f"columns named like the result's: {sorted(clash)}")
    (u,) = quoted([url])
    host, path = host_and_path(u)
    out = scored(df, url, learned, "score").withColumns({"host": host, "path": path})
    fit = temp_column("rule")
    out = out.withColumn(fit, matching_rule(F.col("host"), F.col("path"), rules))
    by_score = F.when(F.col("score") >= threshold, F.lit(BLOCK)).otherwise(ALLOW)
    verdict = F.coalesce(F.col(f"{fit}.verdict"), by_score)
    return out.select(*quoted(df.columns), "host", "path", F.col(f"{fit}.text").alias("rule"), verdict.alias("verdict"), "score")


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The labelled URLs of ``url_labels`` (url, label)."""
    rows = [line.split(" ", 1) for line in LABELLED.strip().splitlines()]
    values = ", ".join(f"('{url}', {label})" for label, url in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(url, label)")


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's URL."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    judged = judge(pages, "url", RULES, learn(labelled_urls(spark)))
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")
