"""Mixing sources to target weights, in DataFrame functions only.

Weights are the sources' token shares raised to an exponent between 0 (uniform)
and 1 (as found), normalised. The exponent is the smallest one whose weights
neither exceed the target entropy nor make any source repeat more often than
allowed; it is bisected, six halvings to a job (one aggregate over the source
table, a row per midpoint), and rounded up to six decimals.

The weights are realised as a stream of documents: a source's budget is its
weight times the total, filled with permutations of its documents (epoch after
epoch, each ordered by a hash of seed, epoch and id) until the budget is met. The
stream is cut into blocks; each block takes the same part of every source's
budget and is itself permuted. Without a given total the smallest one is taken
at which every document appears at least once.

Running token sums of a source need no task that holds the source: a
permutation is cut into about sqrt(n) hash ranges, whose sums are accumulated
first. Per-source rows are joined from a checkpoint, so a hot source can be split.

Defined results: NULL or empty texts weigh one token; a NULL source is a source
of its own; repeated ids are copies of their own (NULL ids share a place in the
order); an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tessera.llm.common import read_table, settle, temp_column, words

HALVINGS = 6
ROUNDS = 5


def source_tokens(docs: DataFrame) -> DataFrame:
    """(source, rows, tokens) of rows (id, source, tokens)."""
    return docs.groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.sum("tokens").alias("tokens"))


def fit_exponent(
    sources: DataFrame, target_entropy: float | None, max_repeats: float | None, total: int | None
) -> float:
    """The smallest exponent that meets both limits. ``target_entropy`` is a share
    of the largest possible one; ``total``: the token budget (None: cover)."""
    whole = sources.agg(F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("k")).first()
    if not whole["k"] or (target_entropy is None and max_repeats is None):
        return 1.0
    tokens, highest = whole["t"], math.log(whole["k"])
    if total is not None and max_repeats is not None and total > max_repeats * tokens:
        raise ValueError("the budget needs more repetition than allowed")
    p = F.col("tokens") / F.lit(float(tokens))

    def too_flat(exponents: list[float]) -> dict[float, bool]:
        at = sources.select(p.alias("p"), F.explode(F.array(*map(F.lit, exponents))).alias("a"))
        raised = F.pow("p", "a")
        sums = at.groupBy("a").agg(
            F.sum(raised).alias("z"), F.sum(raised * F.log("p")).alias("zl"),
            F.max(F.pow("p", F.col("a") - 1)).alias("most"), F.max(F.pow("p", 1 - F.col("a"))).alias("cover"),
        )
        entropy = F.log("z") - F.col("a") * F.col("zl") / F.col("z")
        repeats = F.col("most") * (F.col("cover") if total is None else F.lit(float(total) / tokens) / F.col("z"))
        wrong = F.lit(False)
        if target_entropy is not None:
            wrong = wrong | (entropy > F.lit(target_entropy * highest))
        if max_repeats is not None:
            wrong = wrong | (repeats > F.lit(float(max_repeats)))
        return {r["a"]: r["wrong"] for r in sums.select("a", wrong.alias("wrong")).collect()}

    low, high = 0.0, 1.0
    if not too_flat([low])[low]:
        return low
    steps = 1 << HALVINGS
    for _ in range(ROUNDS):
        grid = [low + (high - low) * i / steps for i in range(1, steps)]
        flat = too_flat(grid)
        # Monotone, so six halvings end between the last midpoint that is too flat and the next.
        i = sum(flat[a] for a in grid)
        marks = [low, *grid, high]
        low, high = marks[i], marks[i + 1]
    return math.ceil(high * 1e6) / 1e6


def mixture(
    sources: DataFrame, target_entropy: float | None = None, max_repeats: float | None = None, total: int | None = None
) -> tuple[DataFrame, int]:
    """(source, rows, tokens, weight, budget) and the total budget in tokens."""
    exponent = fit_exponent(sources, target_entropy, max_repeats, total)
    raised = F.pow(F.col("tokens").cast("double"), F.lit(exponent))
    z = sources.agg(F.sum(raised).alias("z")).first()["z"] or 1.0
    weighted = sources.withColumn("weight", raised / F.lit(z))
    if total is None:
        total = math.floor((weighted.agg(F.max(F.col("tokens") / F.col("weight")).alias("b")).first()["b"] or 0.0) + 0.5)
    return weighted.withColumn("budget", F.floor(F.col("weight") * F.lit(float(total)) + 0.5).cast("long")), total


def realise(docs: DataFrame, mix: DataFrame, total: int, block_tokens: int, seed: int) -> DataFrame:
    """The stream: rows (id, source, tokens, epoch, block, position)."""
    blocks = max(1, math.floor(total / block_tokens + 0.5))
    per = settle(mix.where("budget > 0").select(
        F.col("source").alias("s"), F.col("tokens").alias("all"), "budget",
        F.ceil(F.sqrt(F.col("rows").cast("double"))).alias("ranges"),
    ))
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), "epoch", "id"))
    copies = (
        docs.join(per, docs["source"].eqNullSafe(per["s"])).drop("s")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.ceil(F.col("budget") / F.col("all")).cast("int") - 1)))
        .withColumn("key", key)
        .withColumn("range", F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / 4294967296.0 * F.col("ranges")))
    )
    lane = ["source", "epoch"]
    before = (
        copies.groupBy(*lane, "range").agg(F.sum("tokens").alias("sum"))
        .withColumn("before", F.sum("sum").over(W.partitionBy(*lane).orderBy("range")) - F.col("sum"))
        .select(F.col("source").alias("s"), F.col("epoch").alias("e"), F.col("range").alias("r"), "before")
    )
    inside = W.partitionBy(*lane, "range").orderBy("key", "tokens").rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = copies.withColumn("upto", F.sum("tokens").over(inside) - F.col("tokens"))
    start = F.col("epoch") * F.col("all") + F.col("before") + F.col("upto")
    stream = (
        placed.join(before, placed["source"].eqNullSafe(F.col("s")) & (placed["epoch"] == F.col("e")) & (placed["range"] == F.col("r")))
        .withColumn("start", start).where("start < budget")
        .withColumn("block", F.floor(F.col("start").cast("double") / F.col("budget") * F.lit(float(blocks))))
    )
    within = W.partitionBy("block").orderBy(F.md5(F.concat(F.lit("b"), "key")), "start", "tokens")
    return stream.select(
        "id", "source", "tokens", "epoch", "block", (F.row_number().over(within) - 1).alias("position")
    )


def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
    target_entropy: float | None = 0.99, max_repeats: float | None = 4.0, total: int | None = None,
    block_tokens: int = 1 << 18, seed: int = 1,
) -> DataFrame:
    """The mixed stream of ``docs``: rows (id, source, n_tokens, epoch, block,
    position); sorting by block and position gives the training order."""
    counted = settle(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"),
        F.greatest(F.size(words(F.col(text_col))), F.lit(1)).cast("long").alias("tokens"),
    ))
    mix, total = mixture(settle(source_tokens(counted)), target_entropy, max_repeats, total)
    return realise(counted, mix, total, block_tokens, seed).select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), F.col("tokens").alias("n_tokens"),
        "epoch", F.col("block").cast("long"), F.col("position").cast("long"),
    )


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", **options) -> DataFrame:
    """``docs`` as the mixed stream repeats or leaves them (all columns; a row for
    each epoch that has its id and source)."""
    i, s = temp_column("id"), temp_column("source")
    stream = mix_sources(docs, id_col, source_col, **options).select(
        F.col(id_col).alias(i), F.col(source_col).alias(s), "epoch"
    ).distinct().drop("epoch")
    return docs.join(stream, F.col(id_col).eqNullSafe(F.col(i)) & F.col(source_col).eqNullSafe(F.col(s))).drop(i, s)


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixed stream of all documents: entropy 0.99 of the largest, 4 repetitions."""
    return mix_sources(read_table(spark, sf_dir, "documents"))


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source,
         greatest(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')), 1)::BIGINT AS n_tokens FROM documents
), s AS (
  SELECT source, count(*) AS n, sum(n_tokens)::DOUBLE AS t FROM d GROUP BY source
), p AS (
  SELECT t / (SELECT sum(t) FROM s) AS p, (SELECT ln(count(*)) FROM s) AS h FROM s
), b AS (
  SELECT 0 AS i, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi
  UNION ALL
  SELECT i + 1, CASE WHEN flat THEN (lo + hi) / 2 ELSE lo END, CASE WHEN flat THEN hi ELSE (lo + hi) / 2 END
  FROM (
    SELECT i, lo, hi,
           ln(z) - a * zl / z > 0.99 * h OR most * cover > 4 AS flat
    FROM (
      SELECT i, lo, hi, (lo + hi) / 2 AS a, sum(pow(p, (lo + hi) / 2)) AS z, sum(pow(p, (lo + hi) / 2) * ln(p)) AS zl,
             max(pow(p, (lo + hi) / 2 - 1)) AS most, max(pow(p, 1 - (lo + hi) / 2)) AS cover, max(h) AS h
      FROM b, p WHERE i < 30 GROUP BY i, lo, hi
    )
  )
), zero AS (
  SELECT max(h) > 0 OR max(1 / p) * max(p) > 4 AS flat FROM p
), a AS (
  SELECT CASE WHEN (SELECT flat FROM zero) THEN ceil(max(hi) FILTER (WHERE i = 30) * 1e6) / 1e6 ELSE 0 END AS a FROM b
), w AS (
  SELECT source, n, t, pow(t, (SELECT a FROM a)) / (SELECT sum(pow(t, (SELECT a FROM a))) FROM s) AS w FROM s
), total AS (
  SELECT floor(max(t / w) + 0.5) AS b FROM w
), m AS (
  SELECT source, n, t::BIGINT AS t, floor(w * (SELECT b FROM total) + 0.5)::BIGINT AS budget FROM w
), c AS (
  SELECT d.*, m.t, m.budget, unnest(range(0, ceil(m.budget / m.t)::BIGINT)) AS epoch
  FROM d JOIN m ON d.source IS NOT DISTINCT FROM m.source
), k AS (
  SELECT *, md5('1|' || epoch || '|' || doc_id) AS key FROM c
), x AS (
  SELECT *, epoch * t + sum(n_tokens) OVER (
    PARTITION BY source, epoch ORDER BY key, n_tokens ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW
  ) - n_tokens AS start FROM k
), y AS (
  SELECT *, floor(start::DOUBLE / budget * greatest(1, floor((SELECT b FROM total) / 262144 + 0.5)))::BIGINT AS block
  FROM x WHERE start < budget
)
SELECT doc_id, source, n_tokens, epoch::INTEGER AS epoch, block,
       (row_number() OVER (PARTITION BY block ORDER BY md5('b' || key), start, n_tokens) - 1)::BIGINT AS position
FROM y
"""
