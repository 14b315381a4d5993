"""Table sources: CSV / Parquet by name under a root, one or many at once."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import quoted


def string_schema(columns: Sequence[str]) -> T.StructType:
    """All-string schema (what a header CSV read without inference yields)."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


HEADER_THREADS = 32
CORRUPT, FILE = "_corrupt_record", "__file_of_record"


def _first_line(spark: SparkSession, path: str) -> str | None:
    """The first line with content of the file (or of the first file in the folder), or None."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(conf)
    if not fs.exists(at):
        return None
    while fs.getFileStatus(at).isDirectory():
        # As Spark lists: by name, without hidden entries.
        inside = sorted((f.getPath() for f in fs.listStatus(at)), key=lambda f: f.getName())
        inside = [f for f in inside if not f.getName().startswith(("_", ".")) and (fs.getFileStatus(f).isDirectory() or fs.getFileStatus(f).getLen())]
        if not inside:
            return None
        at = inside[0]
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(at)
    stream = fs.open(at)
    try:
        source = codec.createInputStream(stream) if codec is not None else stream
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(source, "UTF-8"))
        line = reader.readLine()
        while line is not None and not line.strip():
            line = reader.readLine()
        return line
    finally:
        stream.close()


def header_groups(spark: SparkSession, paths: Sequence[str]) -> list[tuple[list[str], list[str]]]:
    """(columns, paths) of CSV files with equal headers, in order of appearance.

    Only first lines are read, by ``HEADER_THREADS`` threads and without a Spark job; one
    read by Spark for each different header tells its columns. A path that is neither a
    file nor a folder (a pattern) is read by Spark on its own.
    """
    with ThreadPool(max(1, min(HEADER_THREADS, len(paths)))) as pool:
        lines = pool.map(lambda p: _first_line(spark, p), paths)
    by_line: dict[str, list[str]] = {}
    for p, line in zip(paths, lines):
        by_line.setdefault(line if line is not None else f"\0{p}", []).append(p)
    return [(spark.read.option("header", True).option("inferSchema", False).csv(ps[0]).columns, ps) for ps in by_line.values()]


def _select(df: DataFrame, columns: Sequence[str] | None, there: set[str], where: str) -> DataFrame:
    """``columns`` by name; names that some file has but this one lacks are NULL."""
    if columns is None:
        return df
    own = {c.lower(): c for c in df.columns}
    unknown = [c for c in columns if c.lower() not in there]
    if unknown:
        raise ValueError(f"no column {unknown} in {where}")
    return df.select(*[
        quoted(own[c.lower()]).alias(c) if c.lower() in own else F.lit(None).cast("string").alias(c) for c in columns
    ])


def read_table(
    spark: SparkSession,
    path: str | Sequence[str],
    fmt: str = "csv",
    columns: Sequence[str] | None = None,
    header: bool = True,
) -> DataFrame:
    """Read one table, or several files united by column name.

    CSV: header row on, every column string, permissive mode (a short row is
    padded with NULL, an empty field is NULL). Names come from each file's own
    header (a read of its first line); files with equal headers are one scan.
    ``columns`` selects by name: a name no file has is an error, one that only
    some files have is NULL in the others. Without a header, ``columns`` names
    the columns by position. Parquet: files with equal schemas are one scan,
    columns are united by name likewise.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"unsupported format {fmt!r} (csv or parquet)")
    if fmt == "csv" and not header:
        reader = spark.read.option("mode", "PERMISSIVE")
        return (reader.schema(string_schema(columns)) if columns is not None else reader).csv(paths)
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    if fmt == "csv":
        found = [(string_schema(names), ps) for names, ps in header_groups(spark, paths)]
    else:
        found = _parquet_groups(spark, paths)
    for schema, ps in found:
        groups.setdefault(schema.json(), (schema, []))[1].extend(ps)
    there = {c.lower() for schema, _ in groups.values() for c in schema.names}
    frames = []
    for schema, members in groups.values():
        reader = spark.read.schema(schema)
        if fmt == "csv":
            df = reader.option("header", True).option("mode", "PERMISSIVE").csv(members)
        else:
            df = reader.parquet(*members)
        frames.append(_select(df, columns, there, ", ".join(paths)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _parquet_groups(spark: SparkSession, paths: Sequence[str]) -> list[tuple[T.StructType, list[str]]]:
    """(schema, paths): all files under their merged schema, whose footers one job reads. Files whose
    types cannot be merged are told apart one by one."""
    if len(paths) > 1:
        try:
            return [(spark.read.option("mergeSchema", True).parquet(*paths).schema, list(paths))]
        except Exception as e:  # noqa: BLE001 - py4j wraps the JVM error
            if "MERGE" not in str(e).upper():
                raise
    return [(spark.read.parquet(p).schema, [p]) for p in paths]


@dataclass(frozen=True)
class Quarantine:
    """A permissive CSV read, taken apart: ``good`` rows, ``bad`` records (file, record) as they stand
    in the files, and ``counts`` (file, n_good, n_bad)."""

    good: DataFrame
    bad: DataFrame
    counts: DataFrame


def read_quarantined(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None) -> Quarantine:
    """Read CSV files with a header, united by name as ``read_table`` does, setting malformed records apart.

    A record is malformed if it has fewer or more fields than its file's header, or a quote
    that is never closed. ``read_table`` pads or cuts such records, as the original
    read did. Nothing runs here but the headers' reads; each of the three frames is one scan.
    """
    paths = [path] if isinstance(path, str) else list(path)
    groups = header_groups(spark, paths)
    there = {c.lower() for names, _ in groups for c in names}
    good, bad, flags = [], [], []
    for names, members in groups:
        mark = CORRUPT
        while mark.lower() in {n.lower() for n in names}:
            mark += "_"
        schema = string_schema([*names, mark])
        reader = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
        # All fields are parsed whatever a query selects: records are told by their number of fields.
        reader = reader.option("columnNameOfCorruptRecord", mark).option("columnPruning", False)
        df = reader.csv(members).select("*", F.col("_metadata.file_path").alias(FILE))
        # NULL unless the record is malformed; a query on the mark alone is refused by the reader.
        broken = F.concat(quoted(mark), F.coalesce(quoted(names[0]), F.lit(""))).isNotNull()
        good.append(_select(df.where(~broken).select(*[quoted(n) for n in names]), columns, there, ", ".join(paths)))
        bad.append(df.where(broken).select(F.col(FILE).alias("file"), quoted(mark).alias("record")))
        flags.append(df.select(F.col(FILE).alias("file"), broken.alias("bad")))
    unite = lambda frames: reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    counts = unite(flags).groupBy("file").agg(
        F.count(F.when(~F.col("bad"), 1)).alias("n_good"), F.count(F.when(F.col("bad"), 1)).alias("n_bad")
    )
    return Quarantine(unite(good), unite(bad), counts)


def load_tables(
    spark: SparkSession,
    root: str,
    names: Sequence[str],
    fmt: str = "csv",
    combine: str = "union",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Load the tables ``<root>/<name>.<fmt>`` and combine them.

    ``combine="union"``: every source contributes its rows, united by name with
    missing columns as NULL (see ``read_table``).
    ``combine="last"``: only the last name is read (each earlier read is
    overwritten by the next one in the original program).
    """
    names = list(names)
    if not names:
        raise ValueError("load_tables needs at least one table name")
    paths = [f"{root.rstrip('/')}/{n}.{fmt}" for n in names]
    if combine == "last":
        return read_table(spark, paths[-1], fmt, columns)
    if combine != "union":
        raise ValueError(f"combine must be 'union' or 'last', not {combine!r}")
    return read_table(spark, paths, fmt, columns)
