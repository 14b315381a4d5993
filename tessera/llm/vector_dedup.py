"""Embedding near-duplicates over a robust-pruned flat graph.

1. Vectors that can be compared (label not null; vector not null or zero, without
   null or non-finite components) are grouped by equality first: copies cost one
   vector, whatever their number.
2. Centres fitted on a bounded sample deal every distinct vector to its nearest
   ``overlap`` cluster shards of its label. A shard above ``shard_rows`` is
   split again with new centres; what stays large (near copies lie together) is
   cut into pieces.
3. Every piece builds a flat graph: nearest candidates, robust-pruned with slack
   ``alpha``. The adjacency lists of a vector in its several shards are united.
4. Greedy search from a few medoids finds the region of each vector, then expands
   through every node in range. Pieces and query blocks of a cut shard meet in
   tiles, so no task holds a shard. Each link found is verified by its complete
   cosine in double precision and counted in one of the shards its ends share;
   only counts and a spanning forest leave the task, never the pairs.
5. Components of the forest are joined back; links are found with recall, which
   ``audit`` measures against brute force for a bounded sample of queries.

Defined results: a vector that cannot be compared has 0 links and itself as
component; a NULL id likewise has 0 links and a NULL component (kept = false);
rows with equal ids are one node; vectors of different lengths never link;
empty tables give empty results; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tessera.llm.common import components, read_table, settle

# Centres are fitted on at most so many vectors, and there are at most so many of
# them at a level (so broadcasts stay small); three levels of splitting at most.
SAMPLE_ROWS = 8192
MAX_CENTRES = 256
LEVELS = 3
# Entry points of a search.
MEDOIDS = 8
# Size of the shared tile arrays: pairs checked at once.
PAIRS_AT_ONCE = 1 << 20


def unit(vectors) -> np.ndarray:
    """Rows scaled to length one, in double precision."""
    x = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def comparable(df: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """Rows (id, label, vec, dim) whose vectors can be compared."""
    v = F.col(vec_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (
        df.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & v.isNotNull())
        .where(~bad & F.exists(v, lambda x: x != 0))
        .select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), v.alias("vec"), F.size(v).alias("dim"))
    )


def fit_centres(sample: np.ndarray, k: int, rounds: int = 6, apart: float = 0.8) -> np.ndarray:
    """Spherical k-means on a sample of unit vectors. Of centres closer than the
    cosine ``apart`` one stays, so that no group of near copies is torn apart:
    it lies in one shard, however large, and is cut into pieces there."""
    k = min(k, len(sample))
    centres = sample[np.linspace(0, len(sample) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        nearest = np.argmax(sample @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norm > 0, sums / np.where(norm > 0, norm, 1), centres)
    near = np.triu(centres @ centres.T >= apart, 1)
    return centres[~near.any(axis=0)]


def _deal(rows: DataFrame, overlap: int, shard_rows: int) -> DataFrame:
    """``rows`` (rep, mult, label, dim, vec, shard) with the one shard of each row
    replaced by its nearest shards below it: one row for each."""
    sizes = rows.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).agg(
        F.max("n").alias("largest"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("shards")
    ).first()
    if not sizes["n"]:
        return rows
    k = int(min(MAX_CENTRES, max(1, -(-overlap * sizes["largest"] // shard_rows))))
    if k == 1:
        return rows
    # The sample: the smallest hashes, whatever the order of rows.
    picked = rows.orderBy(F.xxhash64("rep", "shard"), "rep").limit(min(SAMPLE_ROWS, 32 * k)).select("dim", "vec").collect()
    by_dim: dict[int, list] = {}
    for r in picked:
        by_dim.setdefault(r["dim"], []).append(r["vec"])
    centres = {d: fit_centres(unit(v), k) for d, v in by_dim.items()}
    context = rows.sparkSession.sparkContext.broadcast(centres)

    @pandas_udf("array<int>")
    def nearest(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for vecs in batches:
            out = [[0]] * len(vecs)
            dims = np.array([len(v) for v in vecs])
            for d in np.unique(dims):
                mine = np.flatnonzero(dims == d)
                c = context.value.get(int(d))
                if c is None or len(c) <= overlap:
                    continue
                sims = unit(vecs.iloc[mine]) @ c.T
                top = np.argpartition(-sims, overlap - 1, axis=1)[:, :overlap]
                for i, t in zip(mine, np.sort(top, axis=1)):
                    out[i] = t.tolist()
            yield pd.Series(out)

    return rows.withColumn("c", F.explode(nearest("vec"))).withColumn(
        "shard", F.xxhash64("shard", "c")
    ).drop("c")


def shards(vectors: DataFrame, overlap: int, shard_rows: int) -> DataFrame:
    """Rows (rep, mult, label, dim, vec, shard), ``overlap`` or more for a vector."""
    rows = vectors.withColumn("shard", F.xxhash64("label", "dim"))
    done: DataFrame | None = None
    for level in range(LEVELS):
        rows = settle(_deal(rows, overlap, shard_rows).distinct() if level else _deal(rows, overlap, shard_rows))
        n = rows.groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
        large = settle(n.where(F.col("n") > shard_rows).select("shard"))
        if level == LEVELS - 1 or large.isEmpty():
            break
        fine = rows.join(large, "shard", "left_anti")
        done = fine if done is None else done.unionByName(fine)
        rows = rows.join(large, "shard", "left_semi")
    return rows if done is None else done.unionByName(rows)


def pieces(rows: DataFrame, shard_rows: int) -> DataFrame:
    """Number the pieces of every shard: columns ``k`` and ``piece`` < k."""
    n = settle(
        rows.groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
        .select("shard", F.ceil(F.col("n") / shard_rows).cast("int").alias("k"))
    )
    return rows.join(n, "shard").withColumn("piece", F.pmod(F.xxhash64("rep", F.lit(7)), F.col("k")).cast("int"))


def robust_prune(x: np.ndarray, degree: int, alpha: float, candidates: int) -> list[np.ndarray]:
    """Adjacency of a flat graph over unit vectors: of a node's candidates keep the
    nearest, drop those that are ``alpha`` times nearer to it than to the node, and
    so on. Two thirds of the ``degree`` go to the nearest candidates, the rest to
    random ones, whose long edges lead out of groups of near copies."""
    n = len(x)
    if n == 1:
        return [np.array([], dtype=np.int64)]
    sims = x @ x.T
    np.fill_diagonal(sims, -np.inf)
    m = min(candidates, n - 1)
    near = np.argpartition(-sims, m - 1, axis=1)[:, :m]
    near = np.take_along_axis(near, np.argsort(-np.take_along_axis(sims, near, axis=1), axis=1, kind="stable"), axis=1)
    wide = (np.arange(n)[:, None] + np.random.default_rng(n).integers(1, n, (n, degree))) % n
    rows = np.arange(n)
    picked = []
    for cand, room in ((near, degree - degree // 3), (wide, degree // 3)):
        far = 2 - 2 * np.take_along_axis(sims, cand, axis=1)
        alive = np.ones_like(cand, dtype=bool)
        kept = np.zeros_like(alive)
        for _ in range(min(room, cand.shape[1])):
            first = np.argmax(alive, axis=1)
            some = alive[rows, first]
            if not some.any():
                break
            kept[rows[some], first[some]] = True
            star = cand[rows, first]
            alive &= ~((alpha * (2 - 2 * sims[star[:, None], cand]) <= far) & some[:, None])
            alive[rows[some], first[some]] = False
        picked.append([c[k] for c, k in zip(cand, kept)])
    return [np.unique(np.r_[a, b]) for a, b in zip(*picked)]


def medoids(x: np.ndarray, n: int) -> list[int]:
    """The node nearest the mean, then those farthest from the ones before."""
    chosen = [int(np.argmax(x @ x.mean(axis=0)))]
    nearest = x @ x[chosen[0]]
    while len(chosen) < min(n, len(x)):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, x @ x[chosen[-1]])
    return chosen


def range_search(
    x: np.ndarray, neighbours: np.ndarray, queries: np.ndarray, start: list[int], beam: int, floor: float
) -> np.ndarray:
    """(query, node) pairs of cosine ``floor`` or more that the search meets. Greedy
    phase: ``beam`` times, each query's best unexpanded node is expanded. Range
    phase: every node in range is, round by round, until none is left.
    ``neighbours``: padded with -1."""
    n, q = len(x), len(queries)
    score = np.full((q, n), -np.inf)
    opened = np.zeros((q, n), dtype=bool)
    score[:, start] = queries @ x[start].T

    def visit(who: np.ndarray, node: np.ndarray) -> None:
        for i in range(0, len(who), PAIRS_AT_ONCE // 8):
            a, b = who[i : i + PAIRS_AT_ONCE // 8], node[i : i + PAIRS_AT_ONCE // 8]
            score[a, b] = np.einsum("ij,ij->i", queries[a], x[b])

    every = np.arange(q)
    for _ in range(min(beam, n)):
        open_score = np.where(opened, -np.inf, score)
        best = np.argmax(open_score, axis=1)
        active = every[open_score[every, best] > -np.inf]
        if not len(active):
            break
        best = best[active]
        opened[active, best] = True
        adjacent = neighbours[best]
        who, node = np.repeat(active, adjacent.shape[1]), adjacent.ravel()
        fresh = node >= 0
        who, node = who[fresh], node[fresh]
        fresh = score[who, node] == -np.inf
        visit(who[fresh], node[fresh])
    edges = np.zeros((n, n), dtype=np.float32)
    at, column = np.nonzero(neighbours >= 0)
    edges[at, neighbours[at, column]] = 1
    while True:
        found = (score >= floor) & ~opened
        asking = np.flatnonzero(found.any(axis=1))
        if not len(asking):
            break
        opened |= found
        reached = (found[asking].astype(np.float32) @ edges > 0) & (score[asking] == -np.inf)
        who, node = np.nonzero(reached)
        visit(asking[who], node)
    return np.argwhere(score >= floor)


_LINKS = "rep long, links long, low long"


def _build(frame: pd.DataFrame, degree: int, alpha: float, candidates: int) -> pd.DataFrame:
    reps = frame["rep"].to_numpy()
    adjacency = robust_prune(unit(frame["vec"]), degree, alpha, candidates)
    return pd.DataFrame({"rep": reps, "neighbours": [reps[a] for a in adjacency]})


def _local_low(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node reachable over the links (a, b) among 0..n-1."""
    low = np.arange(n)
    while len(a):
        least = np.minimum(low[a], low[b])
        new = low.copy()
        for at in (a, b, low[a], low[b]):
            np.minimum.at(new, at, least)
        new = new[new]
        if (new == low).all():
            break
        low = new
    return low


def _search(frame: pd.DataFrame, threshold: float, beam: int) -> pd.DataFrame:
    """One tile: range search of its queries over the graph of its nodes."""
    frame = frame.sort_values("rep", ignore_index=True)
    node, ask = frame["node"].to_numpy(), frame["ask"].to_numpy()
    nodes, asks = np.flatnonzero(node), np.flatnonzero(ask)
    empty = pd.DataFrame({"rep": [], "links": [], "low": []}).astype("int64")
    if not len(nodes) or not len(asks):
        return empty
    reps = frame["rep"].to_numpy()
    x = unit(frame["vec"])
    # The graph: the united adjacency lists, as far as they lie in this tile, both ways.
    source = np.repeat(np.arange(len(nodes)), [len(a) for a in frame["neighbours"].iloc[nodes]])
    target = np.concatenate([np.asarray(a, dtype=np.int64) for a in frame["neighbours"].iloc[nodes]])
    place = np.searchsorted(reps[nodes], target)
    inside = (place < len(nodes)) & (reps[nodes][np.minimum(place, len(nodes) - 1)] == target)
    edges = np.unique(np.r_[np.c_[source[inside], place[inside]], np.c_[place[inside], source[inside]]], axis=0)
    degree = np.bincount(edges[:, 0], minlength=len(nodes)) if len(edges) else np.zeros(len(nodes), dtype=int)
    neighbours = np.full((len(nodes), max(1, int(degree.max()))), -1, dtype=np.int64)
    if len(edges):
        neighbours[edges[:, 0], np.arange(len(edges)) - np.repeat(np.cumsum(degree) - degree, degree)] = edges[:, 1]
    graph = x[nodes]
    found = range_search(graph, neighbours, x[asks], medoids(graph, MEDOIDS), beam, threshold)
    a, b = asks[found[:, 0]], nodes[found[:, 1]]
    other = reps[a] != reps[b]
    a, b = a[other], b[other]
    # A pair counts in the smallest shard that both ends are in.
    mine = frame["shard"].to_numpy()[0]
    mult = frame["mult"].to_numpy()
    links = np.zeros(len(frame), dtype=np.int64)
    width = max(len(s) for s in frame["shards"])
    table = np.zeros((len(frame), width), dtype=np.int64)
    for i, s in enumerate(frame["shards"]):
        table[i, : len(s)] = s
        table[i, len(s) :] = s[0]
    for i in range(0, len(a), PAIRS_AT_ONCE // 8):
        p, r = a[i : i + PAIRS_AT_ONCE // 8], b[i : i + PAIRS_AT_ONCE // 8]
        common = (table[p][:, :, None] == table[r][:, None, :]).any(axis=2)
        owner = np.where(common, table[p], np.iinfo(np.int64).max).min(axis=1) == mine
        np.add.at(links, p[owner], mult[r[owner]])
    low = _local_low(len(frame), a, b)
    out = pd.DataFrame({"rep": reps, "links": links, "low": reps[low]})
    return out[(out["links"] > 0) | (out["low"] != out["rep"])]


def _tile_rows(rows: DataFrame) -> DataFrame:
    """One row for each tile a vector takes part in, as a node, as a query or both."""
    k, piece = F.col("k"), F.col("piece")
    every = F.sequence(F.lit(0), k - 1)
    kind = "array<struct<tile:int,node:boolean,ask:boolean>>"
    cells = F.when(
        k == 1, F.array(F.struct(F.lit(0).alias("tile"), F.lit(True).alias("node"), F.lit(True).alias("ask"))).cast(kind)
    ).otherwise(F.transform(every, lambda j: F.struct(
        (piece + j * k).cast("int").alias("tile"), F.lit(True).alias("node"), (j == piece).alias("ask")
    )).cast(kind))
    asks = F.when(k == 1, F.array().cast(kind)).otherwise(F.transform(
        F.filter(every, lambda i: i != piece),
        lambda i: F.struct((i + piece * k).cast("int").alias("tile"), F.lit(False).alias("node"), F.lit(True).alias("ask")),
    ).cast(kind))
    return rows.withColumn("cell", F.explode(F.concat(cells, asks))).select(
        "shard", "shards", "rep", "mult", "vec", "neighbours", "cell.*"
    )


def links(
    vectors: DataFrame, threshold: float = 0.93, overlap: int = 2, shard_rows: int = 768,
    degree: int = 24, alpha: float = 1.2, candidates: int = 48, beam: int = 32,
) -> DataFrame:
    """Rows (rep, links, low) for the distinct ``vectors`` (rep, mult, label, dim,
    vec) that link: partial link counts and the links' spanning forest."""
    rows = settle(pieces(shards(vectors, overlap, shard_rows), shard_rows))

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        return _build(frame, degree, alpha, candidates)

    adjacency = rows.select("shard", "piece", "rep", "vec").groupBy("shard", "piece").applyInPandas(
        build, "rep long, neighbours array<long>"
    )
    united = adjacency.groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("neighbours"))).alias("neighbours"))
    lists = settle(rows.groupBy("rep").agg(F.sort_array(F.collect_set("shard")).alias("shards")).join(united, "rep"))

    def search(frame: pd.DataFrame) -> pd.DataFrame:
        return _search(frame, threshold, beam)

    return _tile_rows(rows.join(lists, "rep")).groupBy("shard", "tile").applyInPandas(search, _LINKS)


def audit(vectors: DataFrame, counted: DataFrame, threshold: float, queries: int = 256) -> tuple[int, int]:
    """(links found, links there) of up to ``queries`` distinct vectors, by brute
    force over all of them."""
    asked = vectors.orderBy(F.xxhash64("rep", F.lit(3)), "rep").limit(queries).select("rep", "label", "dim", "vec").collect()
    if not asked:
        return 0, 0
    shared = vectors.sparkSession.sparkContext.broadcast(asked)

    def there(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        groups: dict = {}
        for r in shared.value:
            groups.setdefault((r["label"], r["dim"]), []).append(r)
        groups = {g: (np.array([r["rep"] for r in rs]), unit([r["vec"] for r in rs])) for g, rs in groups.items()}
        for frame in frames:
            for key, part in frame.groupby(["label", "dim"]):
                if key not in groups:
                    continue
                reps, q = groups[key]
                near = (unit(part["vec"]) @ q.T >= threshold) & (part["rep"].to_numpy()[:, None] != reps[None, :])
                n = (near * part["mult"].to_numpy()[:, None]).sum(axis=0)
                yield pd.DataFrame({"rep": reps[n > 0], "there": n[n > 0]})

    exact = vectors.mapInPandas(there, "rep long, there long").groupBy("rep").agg(F.sum("there").alias("there"))
    both = exact.join(counted.select("rep", "links"), "rep", "left").agg(
        F.sum(F.least("there", F.coalesce("links", F.lit(0)))).alias("found"), F.sum("there").alias("there")
    ).first()
    return int(both["found"] or 0), int(both["there"] or 0)


def near_duplicates(
    df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
    threshold: float = 0.93, min_recall: float = 0.9, **graph,
) -> DataFrame:
    """(id, n_links, component_id, kept) of every row. Raises if the audit finds
    less than ``min_recall`` of the links."""
    good = settle(comparable(df, id_col, vec_col, label_col))
    vectors = settle(good.groupBy("label", "dim", "vec").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("mult")))
    parts = settle(links(vectors, threshold, **graph))
    counted = settle(parts.groupBy("rep").agg(F.sum("links").alias("links")))
    found, there = audit(vectors, counted, threshold)
    if found < min_recall * there:
        raise RuntimeError(f"recall {found}/{there} is below {min_recall}: raise overlap, degree or beam")
    # Copies are one node each: of a vector, and of an id that several vectors carry.
    copies = good.join(vectors.where("mult > 1"), ["label", "dim", "vec"]).select(F.col("id").alias("rep"), F.col("rep").alias("low"))
    joined = components(parts.select("rep", "low").unionByName(copies), "rep", "low")
    direct = good.join(vectors, ["label", "dim", "vec"]).join(counted, "rep", "left").select(
        "id", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n")
    )
    per_id = direct.groupBy("id").agg(F.max("n").alias("n_links"))
    ids = df.select(F.col(id_col).cast("long").alias("id"))
    return (
        ids.join(per_id, "id", "left").join(joined.withColumnRenamed("node", "id"), "id", "left")
        .select(
            F.col("id").alias(id_col),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
            F.coalesce(F.col("id") == F.coalesce("component", "id"), F.lit(False)).alias("kept"),
        )
    )


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and verdict of every vector at cosine 0.93."""
    return near_duplicates(read_table(spark, sf_dir, "embeddings"))
