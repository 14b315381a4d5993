"""Sinks and report frames: previews, schema, prediction samples, parquet output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def preview(df: DataFrame, n: int = 20, order_by: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows as a frame (not printed). Give ``order_by`` for a stable pick:
    Spark then plans a top-k (TakeOrderedAndProject), not a full sort."""
    if order_by:
        df = df.orderBy(*order_by)
    return df.limit(n)


def predictions_sample(
    pred: DataFrame, target: str, pred_col: str, n: int = 10, order_by: Sequence[str] | None = None
) -> DataFrame:
    """Actual vs predicted, ``n`` rows."""
    return preview(pred.select(target, pred_col), n, order_by)


def schema_report(df: DataFrame) -> DataFrame:
    """The schema as rows (position, name, type, nullable); planning only, no job."""
    rows = [
        (i, f.name, f.dataType.simpleString(), bool(f.nullable))
        for i, f in enumerate(df.schema.fields)
    ]
    schema = T.StructType(
        [
            T.StructField("position", T.IntegerType(), False),
            T.StructField("name", T.StringType(), False),
            T.StructField("type", T.StringType(), False),
            T.StructField("nullable", T.BooleanType(), False),
        ]
    )
    return df.sparkSession.createDataFrame(rows, schema)


def write_report(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a report frame as parquet (the batch sink; console output is not used)."""
    df.write.mode(mode).parquet(path)


def write_run_report(report, root: str, mode: str = "overwrite") -> list[str]:
    """Persist what an end-to-end run prints in the original program, as Parquet
    tables under ``root``: ``summary`` (model, selection, rmse, r2, n),
    ``best_params`` (model, selection, param, value), ``correlations`` (a, b, r)
    and ``selected`` (selection, slot). Returns the written paths."""
    from functools import reduce

    from pyspark.sql import functions as F

    spark = report.summary.sparkSession
    root = root.rstrip("/")
    written = []

    def put(name, df):
        path = f"{root}/{name}"
        write_report(df, path, mode)
        written.append(path)

    put("summary", report.summary)
    params = [
        df.select(F.lit(name.split("_")[0]).alias("model"), F.lit(name.split("_")[1]).alias("selection"), "param", "value")
        for name, df in report.best_params.items()
    ]
    if params:
        put("best_params", reduce(lambda a, b: a.unionByName(b), params))
    correlations = report.prep.correlations
    if correlations is not None:
        put("correlations", correlations)
    rows = [(sel, int(i)) for sel, idx in report.selected.items() for i in idx]
    put("selected", spark.createDataFrame(rows, "selection string, slot int"))
    return written
