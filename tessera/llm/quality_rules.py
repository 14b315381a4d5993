"""Quality rules of documents and of their hosts, in DataFrame functions only.

Documents: counts of words, symbols, repeated lines and repeated three-word
windows, and the base rules on them. Hosts: the share of a host's documents that
fail the base rules, shrunk towards the mean of all hosts by a beta prior whose
strength is estimated from how far hosts differ (method of moments for
beta-binomial counts); a host whose shrunk rate exceeds ``max_host_rate`` loses
all its documents.

Everything about one text stays in its row (array functions, O(n log n) in its
words), hosts are counted with partial sums, and the verdicts join back from a
checkpointed table so that a hot host's documents can be split.

Defined results: NULL text counts as empty (0 words, fails); a NULL host is a
host of its own; NULL or repeated ids are rows like any other; an empty table
gives an empty result; only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import quoted, read_table, settle, stored, temp_column, words

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_HOST_RATE = 0.5
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def with_counts(docs: DataFrame, out: str, text_col: str = "text") -> DataFrame:
    """``docs`` plus the struct ``out`` of the five counts (BIGINT) of the whole text."""
    text, w, tri, order, at = (temp_column(c) for c in ("text", "words", "tri", "order", "at"))
    result = docs.withColumn(text, F.coalesce(F.col(text_col), F.lit("")))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    result = result.withColumn(w, words(F.col(text)))
    n = F.size(w)
    pairs = F.zip_with(F.col(w), F.slice(w, 2, n), lambda a, b: F.concat(a, F.lit(" "), b))
    windows = F.zip_with(pairs, F.slice(w, 3, n), lambda ab, c: F.concat(ab, F.lit(" "), c))
    result = result.withColumn(tri, F.when(n >= 3, F.slice(windows, 1, n - 2)))
    # Only texts that repeat a window sort their windows to find where.
    repeats = F.size(F.array_distinct(tri)) < F.size(tri)
    result = result.withColumn(
        order, F.when(repeats, F.array_sort(F.transform(tri, lambda t, i: F.struct(t.alias("t"), i.alias("i")))))
    )
    nothing = F.lit(None).cast("struct<t:string,i:int>")
    size = F.size(order)
    before = F.concat(F.array(nothing), F.slice(order, 1, size - 1))
    after = F.concat(F.slice(order, 2, size), F.array(nothing))
    same = F.zip_with(
        F.zip_with(F.col(order), before, lambda x, y: F.struct(x["i"].alias("i"), x["t"].alias("t"), F.coalesce(x["t"] == y["t"], F.lit(False)).alias("hit"))),
        after,
        lambda x, y: F.when(x["hit"] | F.coalesce(x["t"] == y["t"], F.lit(False)), x["i"]),
    )
    result = result.withColumn(at, F.sort_array(F.filter(same, lambda i: i.isNotNull())))
    # A window covers three words, fewer if the next repeated window starts among them.
    cover = F.zip_with(F.col(at), F.slice(at, 2, F.size(at)), lambda i, j: F.coalesce(F.least(j - i, F.lit(3)), F.lit(3)))
    counts = [
        n, F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")),
        F.length(text) - F.length(F.translate(text, SYMBOLS, "")),
        F.size(lines) - F.size(F.array_distinct(lines)),
        F.coalesce(F.aggregate(cover, F.lit(0).cast("long"), lambda s, x: s + x), F.lit(0)),
    ]
    fields = [c.cast("long").alias(name) for name, c in zip(COUNTS, counts)]
    return result.withColumn(out, F.struct(*fields)).drop(text, w, tri, order, at)


def base_failed(counts: str) -> F.Column:
    n, repeated = F.col(f"{counts}.n_words"), F.col(f"{counts}.n_repeat_words")
    return (n < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * n)


def host_rates(counted: DataFrame, host_col: str, failed_col: str) -> DataFrame:
    """(host, n, failed, rate): the failure rate of every host, shrunk by the
    beta prior of all hosts. One aggregate row goes through the driver."""
    hosts = settle(counted.groupBy(F.col(host_col).alias("host")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(failed_col).cast("long")).alias("failed")
    ))
    s = hosts.agg(
        F.sum("n").alias("n"), F.sum("failed").alias("f"), F.count(F.lit(1)).alias("k"),
        F.sum(F.col("failed") * F.col("failed") / F.col("n")).alias("ff"), F.sum((F.col("n") * F.col("n")).cast("double")).alias("nn"),
    ).first()
    mean, strength = 0.0, None
    if s["n"]:
        mean = s["f"] / s["n"]
        spread = s["ff"] - mean * s["f"]
        within = mean * (1 - mean)
        room = within * (s["n"] - s["nn"] / s["n"] - (s["k"] - 1))
        between = (spread - (s["k"] - 1) * within) / room if room > 0 else 0.0
        if between > 0:
            strength = max(0.0, 1 / between - 1)
    rate = F.lit(mean) if strength is None else (F.col("failed") + mean * strength) / (F.col("n") + strength)
    return hosts.withColumn("rate", rate)


def judge(
    docs: DataFrame, out: str = "quality", text_col: str = "text", host_col: str = "source",
    max_host_rate: float = MAX_HOST_RATE, columns: list[str] | None = None,
) -> DataFrame:
    """``columns`` of ``docs`` (all if None) plus the struct ``out``: the counts,
    ``base_failed``, ``host_rate`` and ``kept``."""
    columns = docs.columns if columns is None else columns
    if out in columns:
        raise ValueError(f"column {out!r} is there already")
    host, text, counts, failed, rated, rate = (temp_column(c) for c in ("host", "text", "counts", "failed", "rated", "rate"))
    counted = with_counts(docs.select(*quoted(columns), F.col(host_col).alias(host), F.col(text_col).alias(text)), counts, text)
    counted = stored(counted.drop(text).withColumn(failed, base_failed(counts)))
    rates = stored(host_rates(counted, host, failed).select(F.col("host").alias(rated), F.col("rate").alias(rate)))
    kept = ~F.col(failed) & (F.col(rate) <= max_host_rate)
    verdict = F.struct(f"{counts}.*", F.col(failed).alias("base_failed"), F.col(rate).alias("host_rate"), kept.alias("kept"))
    return (
        counted.join(rates, F.col(host).eqNullSafe(F.col(rated)), "left")
        .withColumn(out, verdict).drop(host, rated, counts, failed, rate)
    )


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    judged = judge(read_table(spark, sf_dir, "documents"), columns=["doc_id"])
    return judged.select("doc_id", *[f"quality.{c}" for c in [*COUNTS, "base_failed", "kept"]])


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d
), t AS (
  SELECT r, i, concat_ws(' ', w[i], w[i + 1], w[i + 2]) AS t
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3)
), p AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, t) AS c FROM t) WHERE c > 1
), v AS (
  SELECT r, sum(least(3, coalesce(j - i, 3))) AS n
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS j FROM p) GROUP BY r
), m AS (
  SELECT w.doc_id, w.source, len(w)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(v.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN v USING (r)
), b AS (
  SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM m
), h AS (
  SELECT source, count(*)::DOUBLE AS n, count(*) FILTER (WHERE base_failed)::DOUBLE AS f FROM b GROUP BY source
), s AS (
  SELECT sum(n) AS n, sum(f) AS f, count(*) AS k, sum(f * f / n) AS ff, sum(n * n) AS nn, sum(f) / sum(n) AS p FROM h
), e AS (
  SELECT p, CASE WHEN p * (1 - p) * (n - nn / n - (k - 1)) > 0
            THEN (ff - p * f - (k - 1) * p * (1 - p)) / (p * (1 - p) * (n - nn / n - (k - 1))) ELSE 0 END AS phi FROM s
), g AS (
  SELECT source, CASE WHEN phi > 0 THEN (f + p * greatest(0, 1 / phi - 1)) / (n + greatest(0, 1 / phi - 1)) ELSE p END AS rate
  FROM h, e
)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND g.rate <= 0.5) AS kept
FROM b JOIN g ON b.source IS NOT DISTINCT FROM g.source
"""
