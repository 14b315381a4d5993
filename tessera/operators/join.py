"""Fact ⋈ dimension: a size-checked broadcast, else a shuffle join whose hot keys are
joined apart.

Semantics are those of an inner equi-join with USING: one key column, taken
from the fact side and put first; NULL keys never match; fact rows without a
dimension row are lost.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import entity_age as _entity_age
from tessera.operators.clean import drop_columns, present
from tessera.operators.profile import informative_expr
from tessera.session import bounded_size, ensure_parallelism, quoted

# Default size bound under which a dimension is broadcast (checked, not assumed).
BROADCAST_MAX_ROWS = 5_000_000
BROADCAST_MAX_BYTES = 256 * 1024 * 1024
# Buckets of hashed keys whose rows are counted to find hot keys.
HASH_BUCKETS = 1 << 16


def _key(df: DataFrame, on: str, side: str) -> str:
    hit = present(df, [on])
    if not hit:
        raise ValueError(f"join key {on!r} not in the {side} table")
    return hit[0]


def dim_join(
    fact: DataFrame,
    dim: DataFrame,
    on: str,
    broadcast: bool | str = "auto",
    broadcast_max_rows: int = BROADCAST_MAX_ROWS,
    broadcast_max_bytes: int = BROADCAST_MAX_BYTES,
    hot_share: float | None = None,
    spread: bool = False,
) -> DataFrame:
    """Inner USING join of a fact table with a dimension table on ``on``.

    ``broadcast="auto"``: the dimension is broadcast only if its planned size
    and then a count prove it small; otherwise a shuffle join runs. There, a key
    is hot if it holds ``hot_share`` or more of the fact rows (default: one
    shuffle partition's fair share), so there are at most ``1 / hot_share`` of
    them. The fact rows of hot keys stay where they are and meet a broadcast of
    just those keys' dimension rows (size-checked as well); all others go
    through a sort-merge join. ``True`` forces the broadcast, ``False`` the
    shuffle path. ``spread``: a fact that scans in few tasks is spread over more if the
    dimension is broadcast (a shuffle join deals the rows out anyway).
    """
    fkey = _key(fact, on, "fact")
    dkey = _key(dim, on, "dimension")
    dup = {c.lower() for c in fact.columns} & {c.lower() for c in dim.columns} - {fkey.lower()}
    if dup:
        raise ValueError(f"columns in both tables besides the key: {sorted(dup)}; drop them first")
    if dkey != fkey:
        dim = dim.withColumnRenamed(dkey, fkey)

    use_broadcast = broadcast is True or (
        broadcast == "auto" and bounded_size(dim, broadcast_max_rows, broadcast_max_bytes) is not None
    )
    if use_broadcast:
        if spread:
            fact = ensure_parallelism(fact)
        return fact.join(F.broadcast(dim), on=fkey, how="inner")
    return _shuffle_join(fact, dim, fkey, hot_share, broadcast_max_rows, broadcast_max_bytes)


def hot_keys(fact: DataFrame, key: str, share: float) -> list:
    """Keys holding ``share`` or more of the rows: at most ``1 / share`` of them, by
    arithmetic, so the list is bounded.

    Rows are first counted by ``HASH_BUCKETS`` buckets of hashed keys: a hot key's bucket
    holds that share too. Keys are counted only within such buckets, so that
    no column of many keys is shuffled; without one, one scan is enough."""
    k = quoted(key)
    rows = fact.where(k.isNotNull()).select(k.alias("k"), F.pmod(F.xxhash64(k), F.lit(HASH_BUCKETS)).alias("bucket"))
    buckets = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()
    least = share * sum(r["n"] for r in buckets)
    full = [r["bucket"] for r in buckets if r["n"] >= least]
    if not full:
        return []
    counts = rows.where(F.col("bucket").isin(full)).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    return [r["k"] for r in counts.where(F.col("n") >= F.lit(least)).select("k").collect()]


def _shuffle_join(
    fact: DataFrame, dim: DataFrame, key: str, share: float | None, max_rows: int, max_bytes: int
) -> DataFrame:
    # This path runs when the dimension is not provably small, so the join must
    # not fall back to a broadcast chosen from size estimates: force a
    # sort-merge join (AQE may still split a skewed partition further).
    share = share or 1 / int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(fact, key, share)
    if hot:
        is_hot = quoted(key).isin(hot)
        hot_dim = dim.where(is_hot)
        if bounded_size(hot_dim, max_rows, max_bytes) is not None:
            apart = fact.where(is_hot).join(F.broadcast(hot_dim), on=key, how="inner")
            rest = fact.where(~is_hot).join(dim.where(~is_hot).hint("merge"), on=key, how="inner")
            return apart.unionByName(rest)
    return fact.join(dim.hint("merge"), on=key, how="inner")


def gated_join(
    fact: DataFrame,
    dim: DataFrame,
    on: str,
    dim_drop: Iterable[str] = (),
    **join_options,
) -> tuple[DataFrame, bool]:
    """Join only if the fact key has more than one group (NULL and each text,
    ``NA`` included, count as groups). Returns ``(frame, included)``.

    The gate is one global aggregate over the key column (min, max, counts), not
    a distinct count, so it never shuffles by key value.
    """
    hit = present(fact, [on])
    if not hit:
        return fact, False
    if not fact.agg(informative_expr(hit[0])).first()[0]:
        return fact, False
    return dim_join(fact, drop_columns(dim, dim_drop), on, **join_options), True


def entity_age(
    df: DataFrame,
    year_col: str,
    date_col: str,
    out: str = "EntityAge",
    fmt: str = "M/d/y",
    age_null: str = "drop",
) -> DataFrame:
    """Replace a date-text column by an age in years: ``year - year(date)``,
    negative -> 0. Rows whose date does not parse give NULL: ``age_null="drop"``
    removes them, ``"keep"`` leaves NULL (for an imputer to fill)."""
    (y,) = present(df, [year_col]) or [None]
    (d,) = present(df, [date_col]) or [None]
    if y is None or d is None:
        return df
    df = df.withColumnRenamed(d, out).withColumn(out, _entity_age(y, out, fmt))
    if age_null == "drop":
        df = df.filter(quoted(out).isNotNull())
    return df
