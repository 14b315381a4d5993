"""Means and centred cross products of many columns: one pass, merged pairwise.

A task folds its Arrow batches into the counts, means and centred (cross) products of
its rows, two such summaries at a time: each is centred on its own means, and the
difference of the means enters once when two are merged. No sum of raw products is
ever formed, so epoch-like columns do not cancel, and a column of one value has
exactly zero variance. Summaries of tasks are merged in two levels on the executors.

A summary is cut into tiles of rows of the matrix, each against the columns from its
own first one on. What a task holds at once is bounded by ``MAX_CELLS``: wider
matrices take one scan for each band of tiles instead of more memory.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import ship

# Cells (8 bytes each) of the matrix that one task holds, and of one tile.
MAX_CELLS = 1 << 22
TILE_CELLS = 1 << 18
# First-level merges that the tasks' summaries are spread over.
SPREAD = 32
# Deviation, as a share of a column's largest value, up to which it is taken for rounding.
ROUNDING = 64 * np.finfo(float).eps
_PARTS = ("n", "mx", "my", "xy", "xx", "yy", "ax", "ay")
SCHEMA = "g int, lo int, hi int, start int, salt int, " + ", ".join(f"{p} array<double>" for p in _PARTS)


@dataclass
class Moments:
    """Of t columns x against c columns y: counts ``n``, means ``mx`` and ``my``, centred
    products ``xy``, ``xx`` and ``yy``. With NULLs each is t x c and holds the rows in
    which both columns have a value; without, ``n`` is 1 x 1, ``mx`` and ``xx`` t x 1, ``my``
    and ``yy`` 1 x c, and they broadcast. ``ax`` (t x 1) and ``ay`` (1 x c) are the largest sizes of
    the columns' values."""

    n: np.ndarray
    mx: np.ndarray
    my: np.ndarray
    xy: np.ndarray
    xx: np.ndarray
    yy: np.ndarray
    ax: np.ndarray
    ay: np.ndarray

    @classmethod
    def of(cls, x: np.ndarray, missing: np.ndarray | None, lo: int, hi: int, start: int) -> Moments:
        """Of the rows ``x`` (r x k, 0 where missing): columns ``lo:hi`` against those from ``start`` on."""
        peak = np.abs(x).max(axis=0)
        if missing is None:
            shift = x[0]
            c = x - shift  # exactly 0 in a column of one value
            mean = c.mean(axis=0)
            c -= mean
            square = np.einsum("ij,ij->j", c, c)
            mean = shift + mean
            return cls(
                np.array([[float(len(x))]]), mean[lo:hi, None], mean[None, start:], c[:, lo:hi].T @ c[:, start:],
                square[lo:hi, None], square[None, start:], peak[lo:hi, None], peak[None, start:],
            )
        there = ~missing
        shift = x[there.argmax(axis=0), np.arange(x.shape[1])]  # each column's first value
        shift = np.where(there.any(axis=0), shift, 0.0)
        c, m = np.where(there, x - shift, 0.0), there.astype(float)
        mean = c.sum(axis=0) / np.maximum(m.sum(axis=0), 1.0)
        c, shift = np.where(there, c - mean, 0.0), shift + mean
        a, ma, b, mb = c[:, lo:hi], m[:, lo:hi], c[:, start:], m[:, start:]
        n, sx, sy = ma.T @ mb, a.T @ mb, ma.T @ b
        some = np.maximum(n, 1.0)
        return cls(
            n, sx / some + shift[lo:hi, None], sy / some + shift[None, start:], a.T @ b - sx * sy / some,
            _less((a * a).T @ mb, sx * sx / some), _less(ma.T @ (b * b), sy * sy / some),
            peak[lo:hi, None], peak[None, start:],
        )

    def merged(self, other: Moments) -> Moments:
        n = self.n + other.n
        share = other.n / np.maximum(n, 1.0)
        weight = self.n * share
        dx, dy = other.mx - self.mx, other.my - self.my
        return Moments(
            n, self.mx + dx * share, self.my + dy * share, self.xy + other.xy + weight * dx * dy,
            self.xx + other.xx + weight * dx * dx, self.yy + other.yy + weight * dy * dy,
            np.maximum(self.ax, other.ax), np.maximum(self.ay, other.ay),
        )

    def correlations(self) -> np.ndarray:
        """r of every pair; NaN where a column has no variance beyond the rounding of its values."""
        with np.errstate(invalid="ignore", divide="ignore"):
            some = np.maximum(self.n, 1.0)
            x, y = np.sqrt(self.xx / some), np.sqrt(self.yy / some)
            r = np.where((x > ROUNDING * self.ax) & (y > ROUNDING * self.ay), self.xy / some / (x * y), np.nan)
        return np.clip(r, -1.0, 1.0)


def _less(square: np.ndarray, mean_part: np.ndarray) -> np.ndarray:
    """What is left of a sum of squares without its mean's part; nothing if that is but rounding."""
    left = square - mean_part
    return np.where(left > 1e-13 * square, left, 0.0)


def tiles(k: int) -> list[tuple[int, int, int]]:
    """(lo, hi, start): rows of the upper triangle in tiles of bounded size."""
    step = max(1, TILE_CELLS // max(k, 1))
    return [(lo, min(lo + step, k), lo) for lo in range(0, k, step)]


def _bands(parts: Sequence[tuple[int, int, int]], k: int, groups: int) -> Iterator[list[tuple[int, int, int]]]:
    """Tiles that one task may hold together for all groups."""
    band, held = [], 0
    for lo, hi, start in parts:
        cells = (hi - lo) * (k - start) * groups
        if band and held + cells > MAX_CELLS:
            yield band
            band, held = [], 0
        band.append((lo, hi, start))
        held += cells
    if band:
        yield band


def _emit(state: dict, salt: int):
    import pyarrow as pa

    for (g, lo, hi, start), m in state.items():
        row = {"g": g, "lo": lo, "hi": hi, "start": start, "salt": salt}
        columns = [pa.array([v], pa.int32()) for v in row.values()]
        for p in _PARTS:
            flat = getattr(m, p).ravel()
            columns.append(pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), pa.array(flat, pa.float64())))
        yield pa.RecordBatch.from_arrays(columns, names=[*row, *_PARTS])


def unpacked(batch, i: int, k: int) -> tuple[tuple[int, int, int, int], Moments]:
    """Row ``i`` of a batch (or table) of summaries."""
    g, lo, hi, start = (batch[c][i].as_py() for c in ("g", "lo", "hi", "start"))
    t, c = hi - lo, k - start
    flat = [np.asarray(batch[p][i].values, dtype=float) for p in _PARTS]
    pairwise = len(flat[0]) > 1 or (t, c) == (1, 1)
    shapes = [(t, c)] * 6 if pairwise else [(1, 1), (t, 1), (1, c), (t, c), (t, 1), (1, c)]
    shapes += [(t, 1), (1, c)]
    return (g, lo, hi, start), Moments(*[f.reshape(s) for f, s in zip(flat, shapes)])


def _fold(k: int, band: Sequence[tuple[int, int, int]], pairwise: bool) -> Callable:
    """Arrow batches (g, x) -> one summary for each group and tile."""

    def run(batches):
        from pyspark import TaskContext

        state: dict = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            g = np.asarray(batch["g"])
            flat = batch["x"].flatten()
            missing = None
            if flat.null_count:
                if not pairwise:
                    raise ValueError("NULL among the values of a row")
                missing = np.asarray(flat.is_null()).reshape(-1, k)
                flat = flat.fill_null(0.0)
            elif pairwise:
                missing = np.zeros((batch.num_rows, k), dtype=bool)
            if len(flat) != k * batch.num_rows:
                raise ValueError(f"rows of other than {k} values")
            x = np.asarray(flat, dtype=float).reshape(-1, k)
            for group in np.unique(g):
                mine = g == group
                part, gone = x[mine], None if missing is None else missing[mine]
                for lo, hi, start in band:
                    key, m = (int(group), lo, hi, start), Moments.of(part, gone, lo, hi, start)
                    state[key] = state[key].merged(m) if key in state else m
        yield from _emit(state, TaskContext.get().partitionId() % SPREAD)

    return run


def _merge(k: int) -> Callable:
    def run(batches):
        state: dict = {}
        salt = 0
        for batch in batches:
            for i in range(batch.num_rows):
                salt = batch["salt"][i].as_py()
                key, m = unpacked(batch, i, k)
                state[key] = state[key].merged(m) if key in state else m
        yield from _emit(state, salt)

    return run


def comoments(
    df: DataFrame, x: Column, k: int, by: Column | None = None, groups: int = 1, parts: Sequence[tuple[int, int, int]] | None = None,
    pairwise: bool = False,
) -> DataFrame:
    """Summaries (``SCHEMA``) of the ``k`` values in the array column ``x``: a row for each group
    and tile, one scan as long as all tiles of all ``groups`` fit a task. ``by``: an int
    expression, the group. ``pairwise``: NULL values are left out of their pairs;
    otherwise a NULL is an error. A frame without rows gives none."""
    ship(df.sparkSession)
    source = df.select((F.lit(0) if by is None else by).cast("int").alias("g"), x.cast("array<double>").alias("x"))
    out = None
    for band in _bands(tiles(k) if parts is None else parts, k, groups):
        part = source.mapInArrow(_fold(k, band, pairwise), SCHEMA)
        part = part.repartition("g", "lo", "salt").mapInArrow(_merge(k), SCHEMA)
        part = part.repartition("g", "lo").mapInArrow(_merge(k), SCHEMA)
        out = part if out is None else out.unionByName(part)
    return out


def correlation_rows(summaries: DataFrame, k: int) -> DataFrame:
    """(i, j, r) of the pairs i < j in the tiles of one group; NULL without variance."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(batch.num_rows):
                (_, lo, hi, start), m = unpacked(batch, at, k)
                i, j = np.mgrid[lo:hi, start:k]
                keep = i < j
                r = m.correlations()[keep]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(i[keep], pa.int32()), pa.array(j[keep], pa.int32()), pa.array(r, mask=np.isnan(r))], names=["i", "j", "r"]
                )

    return summaries.mapInArrow(run, "i int, j int, r double")


def collected(summaries: DataFrame, k: int) -> dict[int, Moments]:
    """Each group's summary on the driver: for matrices of bounded width."""
    table = summaries.toArrow().combine_chunks()
    found: dict[int, list] = {}
    for i in range(table.num_rows):
        (g, lo, *_), m = unpacked(table, i, k)
        found.setdefault(g, []).append((lo, m))
    out = {}
    for g, members in found.items():
        members.sort(key=lambda e: e[0])
        if len(members) == 1:
            out[g] = members[0][1]
            continue
        # Tiles of the upper triangle -> the full matrix.
        xy = np.zeros((k, k))
        for lo, m in members:
            xy[lo : lo + m.xy.shape[0], lo:] = m.xy
        xy = np.triu(xy) + np.triu(xy, 1).T
        first = members[0][1]
        out[g] = Moments(first.n, first.my.T, first.my, xy, first.yy.T, first.yy, first.ay.T, first.ay)
    return out
