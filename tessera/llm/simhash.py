"""SimHash near-duplicates by multi-index hashing.

A fingerprint has 64 bits; bit ``i`` is 1 if it is set in over half the XXH64
values (UTF-8, seed 42) of the text's word shingles, repeats included. Texts of
fewer words than a shingle have one shingle, the whole sequence; texts without
words have fingerprint zero.

Fingerprints link at ``max_bits`` or fewer differing bits. Equal ones are
grouped first, so a group of copies of any size costs one fingerprint. The 64
bits are cut into ``s`` segments; two linked fingerprints differ by at most
``max_bits // s`` bits in at least one of them. So each fingerprint is stored
under its value in every segment, and the small Hamming ball around each value
is enumerated as probes. Of a pair that differs in a mask, only the side whose
lowest differing bit is 0 probes, so a pair meets once in a segment. Rows of
equal (segment, value) meet in one sorted run where the complete distance is
verified; what leaves the task is a spanning forest of the links found there,
never the pairs. The runs that a value held by more than ``run_rows`` fingerprints
causes are cut into tiles that together still compare all of them.

Defined results: NULL text counts as empty; a NULL id joins its fingerprint's
group (component NULL if the group has no id); rows with equal ids are one
node; an empty table gives an empty result; other columns pass through, and
none of them is ever read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tessera.llm.common import components, read_table, settle, temp_column

SEED = 42
BITS = 64
# Candidate pairs compared at once in a task (bounds its memory).
PAIRS_AT_ONCE = 1 << 20


def fingerprint(text: bytes, shingle: int) -> int:
    """The 64-bit fingerprint of one text (ASCII letters are lower-cased)."""
    words = text.lower().split()  # on bytes: A-Z only, and the six ASCII white-space bytes
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        starts = [0, *accumulate(len(w) + 1 for w in words)]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a : b - 1], SEED) for a, b in zip(starts, starts[shingle:])]
    counts = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 15):
        block = np.array(hashes[i : i + (1 << 15)], dtype=">u8")
        counts += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes)).view(">u8")[0])


def with_fingerprint(docs: DataFrame, text_col: str, out: str, shingle: int = 4) -> DataFrame:
    """``docs`` plus the signed 64-bit fingerprint of ``text_col``."""

    @pandas_udf("long")
    def simhash(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            prints = [fingerprint(bytes(t), shingle) if t is not None else 0 for t in batch]
            yield pd.Series(np.array(prints, dtype=np.uint64).view(np.int64))

    return docs.withColumn(out, simhash(F.col(text_col).cast("binary")))


def segment_count(n: int, max_bits: int) -> int:
    """Segments about as wide as log2 of the number of fingerprints, so that a
    value holds about one of them; any choice gives the same links."""
    return max(2, min(max_bits + 1, BITS // max(1, n.bit_length())))


def _balls(segments: int, max_bits: int) -> F.Column:
    """The masks of all segments' Hamming balls: an array of (seg, lo, width, mask, low)."""
    radius = max_bits // segments
    cuts = [round(i * BITS / segments) for i in range(segments + 1)]
    masks = [
        (s, lo, (1 << (hi - lo)) - 1, sum(1 << b for b in flips), 1 << min(flips) if flips else 0)
        for s, (lo, hi) in enumerate(zip(cuts, cuts[1:]))
        for r in range(radius + 1)
        for flips in combinations(range(hi - lo), r)
    ]
    names, types = ("seg", "lo", "width", "mask", "low"), ("int", "int", "long", "long", "long")
    return F.array(*[F.struct(*[F.lit(v).cast(t).alias(k) for k, v, t in zip(names, m, types)]) for m in masks])


def _probes(prints: DataFrame, balls: F.Column) -> DataFrame:
    """(seg, value, probe, fp, rep): the stored rows (probe = false) and the
    enumerated Hamming balls (probe = true)."""
    return (
        prints.select("fp", "rep", F.explode(balls).alias("m"))
        .select("fp", "rep", "m.*", F.expr("shiftrightunsigned(fp, m.lo) & m.width").alias("own"))
        .where("own & low = 0")
        .select("seg", F.expr("own ^ mask").alias("value"), (F.col("mask") != 0).alias("probe"), "fp", "rep")
    )


def _tiles(rows: DataFrame, balls: F.Column, run_rows: int) -> DataFrame:
    """Cut the runs that hot values cause into tiles. A value that many fingerprints
    hold has ``ks`` chunks of stored rows; it and every value in its ball, which
    all of them probe, has ``kp`` chunks of rows that ask. Chunk i of the
    one meets chunk j of the other in tile (i, j), so all pairs still meet."""
    hot = settle(
        rows.where(~F.col("probe")).groupBy("seg", "value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > run_rows)
    )
    if hot.isEmpty():
        return rows.withColumn("tile", F.lit(0).cast("long"))
    asked = hot.withColumn("m", F.explode(balls)).where("m.seg = seg").groupBy("seg", F.expr("value ^ m.mask").alias("value"))
    sizes = settle(
        asked.agg(F.sum("n").alias("load")).join(hot, ["seg", "value"], "left").select(
            "seg", "value", F.ceil(F.coalesce("n", F.lit(1)) / run_rows).alias("ks"), F.ceil(F.col("load") / (8 * run_rows)).alias("kp")
        )
    )
    ks, kp = F.coalesce("ks", F.lit(1)), F.coalesce("kp", F.lit(1))
    i, j = F.pmod(F.xxhash64("fp", F.lit(1)), ks), F.pmod(F.xxhash64("fp", F.lit(2)), kp)
    upto = lambda k: F.sequence(F.lit(0).cast("long"), k - 1)
    cell = lambda tile, asks: F.struct(tile.alias("tile"), F.lit(asks).alias("asks"))
    kind = "array<struct<tile:bigint,asks:boolean>>"
    cells = F.when(
        (ks == 1) & (kp == 1), F.array(F.struct(F.lit(0).cast("long").alias("tile"), F.col("probe").alias("asks"))).cast(kind)
    ).otherwise(F.concat(
        F.when(F.col("probe"), F.array().cast(kind)).otherwise(F.transform(upto(kp), lambda c: cell(i * kp + c, False)).cast(kind)),
        F.transform(upto(ks), lambda c: cell(c * kp + j, True)).cast(kind),
    ))
    return (
        rows.join(sizes, ["seg", "value"], "left").withColumn("cell", F.explode(cells))
        .select("seg", "value", F.col("cell.asks").alias("probe"), "fp", "rep", F.col("cell.tile").alias("tile"))
    )


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest node reachable over the links (a, b), for each node but the smallest."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = root.copy()
        least = np.minimum(root[x], root[y])
        np.minimum.at(low, x, least)
        np.minimum.at(low, y, least)
        np.minimum.at(low, root[x], least)
        np.minimum.at(low, root[y], least)
        while (low[low] != low).any():
            low = low[low]
        if (low == root).all():
            break
        root = low
    other = root != np.arange(len(nodes))
    return nodes[other], nodes[root[other]]


def _verify(frame: pd.DataFrame, max_bits: int) -> pd.DataFrame:
    """Links among whole runs of sorted rows, as a spanning forest."""
    key = frame[["seg", "value", "tile"]].to_numpy()
    new = np.r_[True, (key[1:] != key[:-1]).any(axis=1)]
    run = np.cumsum(new) - 1
    start = np.flatnonzero(new)[run]
    stored = ~frame["probe"].to_numpy()
    n_stored = np.bincount(run, weights=stored).astype(np.int64)[run]
    # A stored row meets the stored rows before it, a probe all stored rows of its run.
    meets = np.where(stored, np.arange(len(frame)) - start, n_stored)
    fp, rep = frame["fp"].to_numpy().view(np.uint64), frame["rep"].to_numpy()
    ask = np.flatnonzero(meets)
    upto = np.cumsum(meets[ask])
    found_a, found_b = [], []
    first = 0
    while first < len(ask):
        done = upto[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(upto, done + PAIRS_AT_ONCE, side="right")))
        rows = ask[first:last]
        n = meets[rows]
        left = np.repeat(rows, n)
        right = np.repeat(start[rows], n) + np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n)
        near = np.bitwise_count(fp[left] ^ fp[right]) <= max_bits
        found_a.append(rep[left[near]])
        found_b.append(rep[right[near]])
        first = last
    if not found_a:
        return pd.DataFrame({"a": np.array([], np.int64), "b": np.array([], np.int64)})
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    other = a != b
    a, b = _forest(a[other], b[other])
    return pd.DataFrame({"a": a, "b": b})


def hamming_links(prints: DataFrame, max_bits: int = 4, segments: int | None = None, run_rows: int = 2048) -> DataFrame:
    """Links (a, b) between ``rep`` values that connect exactly what the links at
    ``max_bits`` or fewer bits connect. ``prints``: distinct ``fp`` and its ``rep``."""
    balls = _balls(segments or segment_count(prints.count(), max_bits), max_bits)
    rows = _tiles(_probes(prints, balls), balls, run_rows)

    def verify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0
        for frame in frames:
            held.append(frame)
            size += len(frame)
            if size < 200_000:
                continue
            block = pd.concat(held, ignore_index=True)
            last = block.iloc[-1][["seg", "value", "tile"]]
            same = ((block["seg"] == last["seg"]) & (block["value"] == last["value"]) & (block["tile"] == last["tile"])).to_numpy()
            cut = len(block) - int(same.sum())
            if cut:
                yield _verify(block.iloc[:cut].reset_index(drop=True), max_bits)
            held = [block.iloc[cut:].reset_index(drop=True)]
            size = len(held[0])
        if size:
            yield _verify(pd.concat(held, ignore_index=True), max_bits)

    return (
        rows.repartition("seg", "value", "tile")
        .sortWithinPartitions("seg", "value", "tile", "probe")
        .mapInPandas(verify, "a long, b long")
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4,
    segments: int | None = None, run_rows: int = 2048,
) -> DataFrame:
    """(id, fingerprint BIGINT, component_id BIGINT) for every row of ``docs``;
    ``component_id`` is the smallest id reachable over links, its own included."""
    fp = temp_column("fp")
    marked = settle(
        with_fingerprint(docs.select(id_col, text_col), text_col, fp, shingle)
        .select(F.col(id_col).cast("long").alias("id"), F.col(fp).alias("fp"))
    )
    prints = settle(marked.groupBy("fp").agg(F.min("id").alias("rep")))
    links = hamming_links(prints.where("rep is not null"), max_bits, segments, run_rows)
    joined = components(links, "a", "b").withColumnRenamed("node", "rep")
    group = settle(
        prints.join(joined, "rep", "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    )
    return marked.join(group, "fp").select(
        F.col("id").alias(id_col), F.col("fp").alias("fingerprint"), "component_id"
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` with one row of each component: the row whose id is its component
    id (of rows repeating that id, the one whose text has the smallest hash). Rows
    without an id are compared by equal fingerprints only: one stays of those whose
    fingerprint no row with an id has."""
    ids = near_duplicates(docs, id_col, text_col, shingle, max_bits)
    keep, rank, fp = temp_column("keep"), temp_column("rank"), temp_column("fp")
    kept = ids.where(F.col(id_col) == F.col("component_id")).select(F.col(id_col).alias(keep)).distinct()
    first = W.partitionBy(id_col).orderBy(F.xxhash64(text_col))
    named = (
        docs.join(kept, F.col(id_col) == F.col(keep), "left_semi")
        .withColumn(rank, F.row_number().over(first)).where(F.col(rank) == 1).drop(rank)
    )
    nameless = with_fingerprint(docs.where(F.col(id_col).isNull()), text_col, fp, shingle)
    taken = ids.where(F.col(id_col).isNotNull()).select(F.col("fingerprint").alias(keep)).distinct()
    first = W.partitionBy(fp).orderBy(F.xxhash64(text_col))
    nameless = (
        nameless.join(taken, F.col(fp) == F.col(keep), "left_anti")
        .withColumn(rank, F.row_number().over(first)).where(F.col(rank) == 1).drop(rank, fp)
    )
    return named.unionByName(nameless)


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document: 4-word shingles, 4 bits."""
    found = near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )
