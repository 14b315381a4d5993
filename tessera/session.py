"""Helpers that read (never set) the caller's session: lineage cuts, parallelism, size bounds."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> F.Column:
    """The column of exactly this name (dots and other characters are no syntax)."""
    return F.col("`" + name.replace("`", "``") + "`")


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        return None


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers of the session (once each), so
    that they find it wherever the driver was started."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="tessera-ship-")), "tessera_package.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, file.relative_to(root.parent))
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)


class Scratch:
    """What a run materialises on its way: ``close()`` unpersists the frames and
    deletes the tables and checkpoints, after which frames built on them no longer work."""

    def __init__(self) -> None:
        self._frames: list[DataFrame] = []
        self._paths: list[tuple[SparkSession, str]] = []

    def hold(self, df: DataFrame) -> None:
        self._frames.append(df)

    def path(self, spark: SparkSession, path: str) -> None:
        self._paths.append((spark, path))

    def close(self) -> None:
        while self._frames:
            self._frames.pop().unpersist()
        while self._paths:
            spark, path = self._paths.pop()
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.close()


def _checkpoint(df: DataFrame, folder: str, scratch: Scratch | None) -> DataFrame:
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    out = df.checkpoint(eager=True)
    if scratch is not None:
        file = out._jdf.queryExecution().logical().rdd().getCheckpointFile()
        if file.isDefined():
            scratch.path(spark, file.get())
    return out


def materialize(
    df: DataFrame, how: str = "auto", eager: bool = False, scratch: Scratch | None = None, path: str | None = None
) -> DataFrame:
    """Cut (or pin) the lineage of a frame that several later jobs read.

    ``table``: write the frame as Parquet under the cluster's shared checkpoint
    folder and read it back. The lineage is cut (a lost executor costs a
    re-read, not a re-run of the joins and casts before it), and every later
    job reads only the columns it needs, compressed and columnar.
    ``checkpoint``: Spark's reliable ``checkpoint()`` into the same folder
    (row-serialised; used when a column name cannot be stored in Parquet).
    ``persist``: ``MEMORY_AND_DISK``; lost blocks are recomputed from a
    deterministic lineage. ``auto`` = ``table`` when the session names a
    checkpoint folder (``checkpoint`` if the frame holds ML vectors, which
    decode faster from rows than from Parquet structs), else ``persist``
    (lazy unless ``eager``; the other modes always run at once). ``localCheckpoint`` is never used:
    its blocks die with the executor. The folder is the one the cluster names:
    that all executors share it cannot be told from its name and is trusted.
    ``scratch`` takes note of what was made, to be released by its ``close()``. A
    ``path`` asks for a table there, which the caller owns.
    """
    spark = df.sparkSession
    if path is not None:
        df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)
    if how == "none":
        return df
    folder = checkpoint_dir(spark)
    if how == "auto" and folder and _has_udt(df):
        how = "checkpoint"  # vectors: opaque blobs, nothing to prune, cheaper to read as rows
    if how in ("auto", "table", "checkpoint") and folder:
        if how != "checkpoint":
            path = f"{folder.rstrip('/')}/tessera_tables/{uuid.uuid4().hex}"
            try:
                df.write.mode("error").parquet(path)
            except Exception as e:  # noqa: BLE001 - e.g. a name Parquet cannot store
                if "INVALID_COLUMN_NAME" not in str(e) and "invalid character" not in str(e).lower():
                    raise
            else:
                if scratch is not None:
                    scratch.path(spark, path)
                return spark.read.parquet(path)
        return _checkpoint(df, folder, scratch)
    if how in ("table", "checkpoint"):
        raise ValueError(f"{how} requested but spark.checkpoint.dir is not set")
    out = df.persist(StorageLevel.MEMORY_AND_DISK)
    if scratch is not None:
        scratch.hold(out)
    if eager:
        # Fill the cache now, before concurrent readers race to compute it.
        out.count()
    return out


def _has_udt(df: DataFrame) -> bool:
    return any(isinstance(f.dataType, T.UserDefinedType) for f in df.schema.fields)


def materialize_observed(
    df: DataFrame, metrics: dict, how: str = "auto", scratch: Scratch | None = None, path: str | None = None
) -> tuple[DataFrame, dict]:
    """``materialize`` plus aggregate ``metrics`` (name -> aggregate Column)
    computed over the same rows.

    They are one aggregate over the materialised copy. An ``Observation`` would save
    that scan, but its aggregates run uncompiled, row by row: for some dozens of them it
    costs several times the scan of a stored table.
    """
    out = materialize(df, how, scratch=scratch, path=path)
    if not metrics:
        return out, {}
    return out, out.agg(*[c.alias(n) for n, c in metrics.items()]).first().asDict()


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread a scan-like frame over at least ``min_partitions`` tasks.

    A small single-row-group file scans as one partition, which makes every
    later pass single-threaded; only then is a round-robin repartition added. A
    large scan already has enough splits and is left alone (no extra shuffle
    at scale). Call it on a file scan, a checkpoint or a cached frame: reading
    the partition count of a plan that still contains a shuffle would run that
    shuffle once just to count (under AQE), so such frames are left to AQE.
    """
    spark = df.sparkSession
    target = min_partitions or spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df


_FIXED_WIDTH = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4, T.DateType: 4, T.DecimalType: 16}


def _holds_udt(t: T.DataType) -> bool:
    if isinstance(t, T.UserDefinedType):
        return True
    if isinstance(t, T.ArrayType):
        return _holds_udt(t.elementType)
    if isinstance(t, T.MapType):
        return _holds_udt(t.keyType) or _holds_udt(t.valueType)
    return isinstance(t, T.StructType) and any(_holds_udt(f.dataType) for f in t.fields)


def _row_bytes(schema: T.StructType) -> F.Column | None:
    """Size of one row in bytes: strings by octet length, fixed-width types by
    width, vectors by their dense length, anything nested by the length of its
    JSON text. None if a column has a type whose size cannot be told."""
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.linalg import VectorUDT

    total = F.lit(0).cast("bigint")
    for f in schema.fields:
        c = quoted(f.name)
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            part = F.coalesce(F.octet_length(c), F.lit(0)) + F.lit(8)
        elif isinstance(f.dataType, VectorUDT):
            part = F.coalesce(F.size(vector_to_array(c)) * F.lit(8), F.lit(0)) + F.lit(16)
        elif _holds_udt(f.dataType):
            return None
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            part = F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)) + F.lit(16)
        else:
            part = F.lit(_FIXED_WIDTH.get(type(f.dataType), 8))
        total = total + part.cast("bigint")
    return total


def planned_bytes(df: DataFrame) -> int:
    """The optimiser's estimate of the frame's size (no job)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def bounded_size(df: DataFrame, max_rows: int, max_bytes: int) -> tuple[int, int] | None:
    """(rows, bytes) of ``df`` if it provably holds at most ``max_rows`` rows and
    ``max_bytes`` bytes, else ``None``.

    A frame whose planned size is far over the bound (the plan knows file sizes,
    compressed) is turned down without a job. Otherwise one aggregate counts
    rows and bytes: partial sums in every task and one small row from each, so
    no rows move whatever the frame's size.
    """
    row_bytes = _row_bytes(df.schema)
    if max_rows <= 0 or max_bytes <= 0 or row_bytes is None:
        return None
    if planned_bytes(df) > 4 * max_bytes:
        return None
    probe = df.agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes).alias("b")).first()
    n, b = int(probe["n"]), int(probe["b"] or 0)
    if n > max_rows or b > max_bytes:
        return None
    return n, b
