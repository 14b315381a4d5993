"""Tables bucketed by a join key: shuffled once when written, never again when joined.

``write_bucketed`` stores a frame in a fixed number of buckets of its key, sorted within
each. Joins of two such tables with equal bucket counts, and group-bys on the key, then
read both sides in place without an exchange. Rows of hot keys would make one huge
bucket; they are stored apart, spread evenly, and meet a broadcast of just their keys'
rows of the other side (size-checked; bucket pruning reads only their buckets).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.clean import present
from tessera.operators.join import BROADCAST_MAX_BYTES, BROADCAST_MAX_ROWS, hot_keys
from tessera.session import Scratch, bounded_size, checkpoint_dir, quoted


@dataclass
class BucketedTable:
    """The stored rows: ``rest`` in buckets of ``key``, those of the ``hot`` keys apart."""

    key: str
    buckets: int
    rest: DataFrame
    hot: list = field(default_factory=list)
    apart: DataFrame | None = None
    names: list[str] = field(default_factory=list)

    def frame(self) -> DataFrame:
        """All rows."""
        return self.rest if self.apart is None else self.rest.unionByName(self.apart)

    def forget(self) -> None:
        """Take the tables out of the session's catalog (their files belong to the scratch)."""
        for name in self.names:
            self.rest.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")


def _folder(spark: SparkSession, folder: str | None) -> str:
    folder = folder or checkpoint_dir(spark)
    if folder is None:
        raise ValueError("bucketed tables need a shared folder: set spark.checkpoint.dir or name one")
    return folder.rstrip("/")


def write_bucketed(
    df: DataFrame, key: str, buckets: int, folder: str | None = None, hot_share: float | None = None, scratch: Scratch | None = None
) -> BucketedTable:
    """Store ``df`` bucketed and sorted by ``key``, as files under ``folder`` (default: the shared one).

    A key that holds ``hot_share`` of the rows or more (default: one bucket's fair share,
    so there are at most ``buckets`` such keys) is stored apart; ``hot_share=1.0`` or above finds
    none and saves the count. NULL keys are in the buckets like any other value, but
    spread if they are hot.
    """
    hit = present(df, [key])
    if not hit:
        raise ValueError(f"bucket key {key!r} not in the table")
    if buckets < 1:
        raise ValueError("buckets must be at least 1")
    spark, name = df.sparkSession, hit[0]
    root = f"{_folder(spark, folder)}/tessera_tables"
    share = 1 / buckets if hot_share is None else hot_share
    hot = hot_keys(df, name, share) if share < 1 else []
    is_hot = quoted(name).isin(hot) | quoted(name).isNull() if hot else F.lit(False)
    table = f"tessera_bucketed_{uuid.uuid4().hex}"
    path = f"{root}/{table}"
    rest = df.where(~is_hot) if hot else df
    # One task per bucket: each bucket is one sorted file.
    rest.repartition(buckets, quoted(name)).write.format("parquet").bucketBy(buckets, name).sortBy(name).option("path", path).saveAsTable(table)
    if scratch is not None:
        scratch.path(spark, path)
    apart = None
    if hot:
        df.where(is_hot).write.parquet(f"{path}_hot")
        apart = spark.read.parquet(f"{path}_hot")
        if scratch is not None:
            scratch.path(spark, f"{path}_hot")
    return BucketedTable(name, buckets, spark.table(table), hot, apart, [table])


def bucketed_join(
    fact: BucketedTable, dim: BucketedTable, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES
) -> DataFrame:
    """Inner USING join on the tables' key, which the fact's spelling names and comes first.

    The bucketed rows meet in place. The dimension is written without keys apart (one
    row per key or few), with the fact's number of buckets.
    """
    if fact.buckets != dim.buckets:
        raise ValueError(f"bucket counts differ: {fact.buckets} and {dim.buckets}")
    if dim.apart is not None:
        raise ValueError("write the dimension with hot_share=1.0: its hot keys cannot be met in place")
    if fact.key.lower() != dim.key.lower():
        raise ValueError(f"the tables are bucketed by {fact.key!r} and {dim.key!r}")
    right = dim.rest.withColumnRenamed(dim.key, fact.key)
    dup = {c.lower() for c in fact.rest.columns} & {c.lower() for c in right.columns} - {fact.key.lower()}
    if dup:
        raise ValueError(f"columns in both tables besides the key: {sorted(dup)}; drop them first")
    joined = fact.rest.join(right.hint("merge"), on=fact.key, how="inner")
    if fact.apart is None:
        return joined
    few = right.where(quoted(fact.key).isin(fact.hot))
    small = bounded_size(few, max_rows, max_bytes) is not None
    return joined.unionByName(fact.apart.join(F.broadcast(few) if small else few.hint("merge"), on=fact.key, how="inner"))
