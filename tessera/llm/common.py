"""What several operators share: table access, lineage cuts, connected components."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import checkpoint_dir

# A word, wherever an operator speaks of words: a run of characters other than
# the six ASCII white-space characters.
WORD_GAP = r"[\x20\x09-\x0D]+"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers of the session (once each), so
    that they find it wherever the driver was started."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="tessera-ship-")), "tessera_package.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, file.relative_to(root.parent))
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as ``spark.checkpoint.dir`` names
    it. Only a local master without that setting (tests) gets one of its own;
    elsewhere its absence is an error."""
    sc = spark.sparkContext
    folder = checkpoint_dir(spark)
    if folder is None:
        if not sc.master.startswith(("local[", "local")) or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="tessera-llm-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def settle(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable ``checkpoint()`` in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Cut lineage by writing ``df`` as a table in the shared folder: columnar, and
    its size is known to the planner. For what carries texts, or is joined."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/tessera_llm/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def temp_column(name: str) -> str:
    """A column name that cannot clash with those of the caller's frame."""
    return f"__{name}_{uuid.uuid4().hex[:12]}"


def quoted(names: list[str]) -> list[F.Column]:
    """Columns by their exact names, dots and all."""
    return [F.col("`" + n.replace("`", "``") + "`") for n in names]


def words(text: F.Column) -> F.Column:
    """The words of a text as an array (NULL or blank text: empty array)."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_GAP, -1))


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components of the undirected graph with edges (``a``, ``b``),
    both BIGINT: rows (node, component) for every node with an edge to another
    node, ``component`` being the smallest node reachable.

    Alternating large-star and small-star rounds (O(log n) of them); every
    intermediate result is checkpointed, so an executor lost in round k costs
    no earlier round, and the minima that hub nodes are joined with are read
    from a checkpoint so that AQE may split a hub's rows. NULL ends are ignored.
    """
    pairs = settle(edges.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(
        F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")
    ).where("u <> v").distinct())

    def state(df: DataFrame) -> tuple:
        r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
        return r["n"], r["h"]

    before = state(pairs)
    while before[0]:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = settle(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = settle(
            both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct()
        )
        low = settle(large.groupBy("u").agg(F.min("v").alias("m")))
        pairs = settle(
            large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        )
        after = state(pairs)
        if after == before:
            break
        before = after
    stars = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
