"""Merkle dataset manifest: a hash tree over the rows of a table, with proofs.

Every row is a leaf: H (lower-case hex SHA-256; digests enter further hashes as hex
text) of its fields one after the other, each ``-`` if NULL, else the UTF-8 byte
count, ``:`` and the value. The leaves of a group ascend by the row id. While a
level holds more than one node, ``ARITY`` consecutive nodes (the last run may be
shorter, down to one) become the H of their digests. What remains is the group's
subroot; the subroots, ordered by group, are the leaves of a tree built likewise,
which ends in the root.

In Spark terms:

* Positions come without a window over a group, whatever share of the rows it
  holds: the leaves are range-partitioned and sorted by (group, id, digest) and
  frozen by a checkpoint together with their place in the partition; what is
  added up over partitions is one count per (group, partition).
* Each level is a self-join by sibling shift: a node asks for the slots
  ``(slot + k) mod ARITY`` of its run, as far as the level reaches; requests meet
  the nodes in an equijoin on (group, run, slot), and the answers, at most
  ``ARITY - 1`` a node, are put in order. Rows in slot zero then emit the parents.
  A join key has at most ``ARITY`` requests, so nothing is skewed.
* Proofs go down again: a node's path is its own siblings before its parent's path,
  which is joined from the level above on (group, run).

The number of levels is the logarithm of the row count; levels are checkpointed, so
a lost executor costs its own level at most. The driver sees counts only.

Defined results. NULL ids come first, NULL groups are a group of their own, first of
all; a NULL field is ``-``, which no value can be. Ties and repeated rows: rows of
one group and id are ordered by their leaf, so which of two equal rows is which
cannot matter. An empty text is ``0:``; texts of any length are hashed whole. An
empty table has no rows and no root. The result's columns are the operator's own
plus those asked for by ``keep``; a name in both is an error, other columns of the
input (whatever their names) are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import quoted, read_table, settle, stored

ARITY = 16
OUTPUT = ("leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_STEP = "struct<before: string, after: string>"


def leaf_digest(fields: Sequence[Column]) -> Column:
    """H of the fields, each ``-`` if NULL, else ``bytes:value``."""
    parts = []
    for c in fields:
        text = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _placed(leaves: DataFrame) -> DataFrame:
    """``leaves`` (g, id, leaf, ...) with ``idx``, the place in its group by (id, leaf)."""
    tie = "tie"  # spreads rows that are equal in everything over partitions
    there = settle(
        leaves.withColumn(tie, F.monotonically_increasing_id())
        .repartitionByRange("g", "id", "leaf", tie).sortWithinPartitions("g", "id", "leaf", tie)
        .withColumns({"part": F.spark_partition_id(), "pos": F.monotonically_increasing_id()}).drop(tie)
    )
    counts = there.groupBy("g", "part").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("start"))
    # One row per group and partition it lies in: as many as groups and partitions
    # together, and for a window over one group at most as many as partitions.
    earlier = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.sum("n").over(earlier)
    counts = counts.select(
        F.col("g").alias("g2"), F.col("part").alias("part2"), "start", F.coalesce(before, F.lit(0)).alias("skip")
    )
    placed = there.join(counts, F.col("g").eqNullSafe(F.col("g2")) & (F.col("part") == F.col("part2")))
    return placed.select(
        *[c for c in there.columns if c not in ("part", "pos")], (F.col("pos") - F.col("start") + F.col("skip")).alias("idx")
    )


def _siblings(nodes: DataFrame, payload: Sequence[str], arity: int) -> DataFrame:
    """One level: nodes (g, idx, n, digest, payload) with the digests of their run
    before and after them, joined by sibling shift."""
    run, slot = F.floor(F.col("idx") / arity).cast("long"), (F.col("idx") % arity).cast("int")
    nodes = nodes.withColumns({"run": run, "slot": slot})
    # Offset 0 asks for the node's own digest and carries what the row holds.
    size = F.least(F.lit(arity).cast("long"), F.col("n") - F.col("run") * arity).cast("int")
    shift = F.transform(
        F.sequence(F.lit(0), size - 1),
        lambda k: F.struct(
            ((F.col("slot") + k) % size).alias("want"),
            F.when(k == 0, F.struct("n", *payload)).alias("own"),
        ),
    )
    asks = nodes.select("g", "run", "slot", F.inline(shift))
    have = nodes.select(F.col("g").alias("g2"), F.col("run").alias("run2"), F.col("slot").alias("want2"), "digest")
    met = asks.join(
        have, F.col("g").eqNullSafe(F.col("g2")) & (F.col("run") == F.col("run2")) & (F.col("want") == F.col("want2"))
    ).select("g", "run", "slot", "want", "own", "digest")
    # Partitioned by run, so that the way down finds its nodes in place.
    met = met.repartition("g", "run").groupBy("g", "run", "slot").agg(
        F.sort_array(F.collect_list(F.struct("want", "digest"))).alias("all"),
        F.max("own").alias("own"),  # the one that is not NULL
    )
    side = lambda keep: F.array_join(F.transform(F.filter("all", keep), lambda x: x["digest"]), "")
    return met.select(
        "g", "run", "slot", "own.n", *[F.col(f"own.{c}") for c in payload],
        F.filter("all", lambda x: x["want"] == F.col("slot"))[0]["digest"].alias("digest"),
        side(lambda x: x["want"] < F.col("slot")).alias("before"),
        side(lambda x: x["want"] > F.col("slot")).alias("after"),
    )


def _parents(level: DataFrame, arity: int) -> DataFrame:
    """Rows in slot zero emit their run's parent."""
    return level.where("slot = 0").select(
        "g", F.col("run").alias("idx"), F.ceil(F.col("n") / arity).cast("long").alias("n"),
        F.sha2(F.concat("digest", "after"), 256).alias("digest"),
    )


def tree(leaves: DataFrame, payload: Sequence[str], arity: int = ARITY) -> tuple[DataFrame, DataFrame]:
    """Trees over ``leaves`` (g, idx, digest, payload): the leaves with ``path``, an array of
    (before, after) from their own run upwards, and ``top``, the digest that remains;
    and the groups (g, top) alone, without the way down."""
    counts = leaves.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    nodes = leaves.join(counts.withColumnRenamed("g", "g2"), F.col("g").eqNullSafe(F.col("g2"))).drop("g2")
    most = counts.agg(F.max("n")).first()[0] or 0
    levels, tops, carried = [], [], list(payload)
    while True:
        # A group whose level holds one node has its top.
        tops.append((nodes.where("n = 1").select("g", "digest", *carried), carried))
        if most <= 1:
            break
        level = settle(_siblings(nodes.where("n > 1"), carried, arity))
        levels.append((level, carried))
        nodes, most, carried = settle(_parents(level, arity)), -(-most // arity), []
    # The way down: paths of one level are those of its parents behind its own step.
    none = F.array().cast(f"array<{_STEP}>")
    paths = tops[-1][0].select("g", F.lit(0).cast("long").alias("idx"), *tops[-1][1], none.alias("path"), F.col("digest").alias("top"), "digest")
    for (level, own), (top, top_own) in zip(reversed(levels), reversed(tops[:-1])):
        above = paths.select(F.col("g").alias("g2"), F.col("idx").alias("run2"), F.col("path").alias("up"), "top")
        step = F.array(F.struct("before", "after"))
        down = level.join(above, F.col("g").eqNullSafe(F.col("g2")) & (F.col("run") == F.col("run2"))).select(
            "g", (F.col("run") * arity + F.col("slot")).alias("idx"), *own,
            F.concat(step, "up").alias("path"), "top", "digest",
        )
        alone = top.select("g", F.lit(0).cast("long").alias("idx"), *top_own, none.alias("path"), F.col("digest").alias("top"), "digest")
        paths = down.unionByName(alone)
    ends = reduce(DataFrame.unionByName, [t.select("g", F.col("digest").alias("top")) for t, _ in tops])
    return paths, ends


def fold(digest: Column, path: Column) -> Column:
    """The top that a digest and its path of siblings give."""
    return F.aggregate(path, digest, lambda acc, s: F.sha2(F.concat(s["before"], acc, s["after"]), 256))


def manifest(
    df: DataFrame, fields: Sequence[str], group: str, row_id: str, keep: Sequence[str] = (), tampered: dict | None = None,
    arity: int = ARITY,
) -> DataFrame:
    """Leaf, subroot, root and proof of every row of ``df``.

    ``fields``: the columns of a leaf, in order. ``tampered``: {column: expression} of a
    second version of the rows, whose leaves are folded along the original siblings
    into ``folded_root``; ``verified`` says whether that is the root. Without it the
    original leaves are folded. ``keep``: columns to pass through.
    """
    clash = {c.lower() for c in keep} & {c.lower() for c in OUTPUT}
    if clash:
        raise ValueError(f"columns named like the result's: {sorted(clash)}")
    own = dict(zip(fields, quoted(list(fields))))
    (g,), (i,) = quoted([group]), quoted([row_id])
    kept = [f"keep_{n}" for n in range(len(keep))]
    leaf = leaf_digest(list(own.values()))
    other = leaf_digest([tampered.get(f, c) for f, c in own.items()]) if tampered else F.lit(None).cast("string")
    leaves = df.select(
        g.alias("g"), i.alias("id"), leaf.alias("leaf"), other.alias("other"), *[c.alias(k) for c, k in zip(quoted(list(keep)), kept)]
    ).withColumn("other", F.when(F.col("other") != F.col("leaf"), F.col("other")))
    # Stored first: the range partitioning samples its input, and texts are hashed once.
    placed = settle(_placed(stored(leaves)).withColumnRenamed("leaf", "digest").drop("id"))
    inner, subroots = tree(placed, ["other", *kept], arity)
    groups = settle(subroots.select(F.lit(True).alias("g"), F.col("g").alias("id"), F.col("top").alias("leaf")))
    ranked = settle(_placed(groups).withColumnRenamed("leaf", "digest").withColumnRenamed("id", "name"))
    outer, _ = tree(ranked, ["name"], arity)
    outer = settle(outer.select("name", F.col("path").alias("outer_path"), F.col("top").alias("root")))
    both = inner.join(outer, F.col("g").eqNullSafe(F.col("name")))
    full = F.concat("path", "outer_path")
    step_text = F.transform(full, lambda s: F.concat(s["before"], s["after"]))
    folded = fold(F.coalesce("other", "digest"), full)
    return both.select(
        *[F.col(k).alias(c) for c, k in zip(keep, kept)],
        F.col("digest").alias("leaf"), F.col("top").alias("subroot"), "root",
        F.sha2(F.array_join(step_text, ""), 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document, by source; where 5 divides the
    CRC-32 of the decimal doc_id, the text is tampered with by lower-casing A-Z."""
    docs = read_table(spark, sf_dir, "documents")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return manifest(
        docs, ["doc_id", "source", "lang", "n_chars", "text"], group="source", row_id="doc_id", keep=["doc_id"],
        tampered={"text": F.when(hit, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))},
    )


def _field(c: str) -> str:
    return f"coalesce(CAST(octet_length(encode(CAST({c} AS VARCHAR))) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


# CRC-32 bit by bit over the bytes of the decimal id.
_CRC = (
    "xor(list_reduce(flatten(list_transform(range(strlen(CAST(doc_id AS VARCHAR))), lambda i: "
    "list_concat([CAST(ascii(substr(CAST(doc_id AS VARCHAR), i + 1, 1)) AS BIGINT)], [-1, -1, -1, -1, -1, -1, -1, -1]))), "
    "lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, 4294967295), 4294967295)"
)

SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, {_leaf('text')} AS leaf,
         CASE WHEN {_CRC} % 5 = 0 THEN {_leaf(f"translate(text, '{UPPER}', '{LOWER}')")} END AS tampered
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
         count(*) OVER (PARTITION BY source) AS n FROM d),
nodes AS (
  SELECT source, 0 AS lvl, idx, n, leaf AS digest FROM leaves
  UNION ALL
  SELECT source, lvl + 1, idx // {ARITY}, (n + {ARITY - 1}) // {ARITY}, sha256(string_agg(digest, '' ORDER BY idx))
  FROM nodes WHERE n > 1 GROUP BY source, lvl, idx // {ARITY}, n),
runs AS (SELECT source, lvl, idx // {ARITY} AS run, list(digest ORDER BY idx) AS ds FROM nodes WHERE n > 1 GROUP BY ALL),
subroots AS (SELECT source, digest AS subroot FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS lvl, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx, count(*) OVER () AS n, subroot AS digest FROM subroots
  UNION ALL
  SELECT lvl + 1, idx // {ARITY}, (n + {ARITY - 1}) // {ARITY}, sha256(string_agg(digest, '' ORDER BY idx))
  FROM tops WHERE n > 1 GROUP BY lvl, idx // {ARITY}, n),
top_runs AS (SELECT lvl, idx // {ARITY} AS run, list(digest ORDER BY idx) AS ds FROM tops WHERE n > 1 GROUP BY ALL),
walk AS (
  SELECT doc_id, source, leaf, tampered, idx AS leaf_idx, 0 AS lvl, idx, n, coalesce(tampered, leaf) AS cur, '' AS proof FROM leaves
  UNION ALL
  SELECT w.doc_id, w.source, w.leaf, w.tampered, w.leaf_idx, w.lvl + 1, w.idx // {ARITY}, (w.n + {ARITY - 1}) // {ARITY},
         sha256(array_to_string(list_concat(r.ds[1:w.idx % {ARITY}], [w.cur], r.ds[w.idx % {ARITY} + 2:]), '')),
         w.proof || array_to_string(list_concat(r.ds[1:w.idx % {ARITY}], r.ds[w.idx % {ARITY} + 2:]), '')
  FROM walk w JOIN runs r ON r.source IS NOT DISTINCT FROM w.source AND r.lvl = w.lvl AND r.run = w.idx // {ARITY}
  WHERE w.n > 1),
inner_done AS (SELECT w.*, s.subroot FROM walk w JOIN subroots s ON s.source IS NOT DISTINCT FROM w.source WHERE w.n = 1),
ranked AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM subroots),
climb AS (
  SELECT i.doc_id, i.leaf, i.subroot, 0 AS lvl, k.pos AS idx, k.n AS n, i.cur, i.proof
  FROM inner_done i JOIN ranked k ON k.source IS NOT DISTINCT FROM i.source
  UNION ALL
  SELECT c.doc_id, c.leaf, c.subroot, c.lvl + 1, c.idx // {ARITY}, (c.n + {ARITY - 1}) // {ARITY},
         sha256(array_to_string(list_concat(r.ds[1:c.idx % {ARITY}], [c.cur], r.ds[c.idx % {ARITY} + 2:]), '')),
         c.proof || array_to_string(list_concat(r.ds[1:c.idx % {ARITY}], r.ds[c.idx % {ARITY} + 2:]), '')
  FROM climb c JOIN top_runs r ON r.lvl = c.lvl AND r.run = c.idx // {ARITY} WHERE c.n > 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = root AS verified
FROM (SELECT *, (SELECT digest FROM tops WHERE n = 1) AS root FROM climb WHERE n = 1)
"""
