"""Layers 3 and 4: the end-to-end run, parity with the original's behaviour, invariants."""

import pytest
from pyspark.sql import functions as F

from tessera.plans.fixtures import RAW_DIM, RAW_FACT
from tessera.plans.flagship import FLAGSHIP_SPEC, flagship
from tessera.plans.run import prepare
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def prep(spark):
    return prepare(RAW_FACT.frame(spark, SF_SMALL), RAW_DIM.frame(spark, SF_SMALL), FLAGSHIP_SPEC)


def test_prepare_decisions(prep):
    assert prep.included
    assert "carrier" in prep.constant_dropped  # single-valued text column
    assert "ship_year" not in prep.constant_dropped  # exempt
    assert prep.collinear_dropped == ["qty_dozen"]
    assert "part_age" in prep.spec.numeric_mean
    assert set(prep.spec.hhmm_cols) == set()  # became categorical day parts


def test_prepared_frame_invariants(prep):
    df = prep.df
    assert "cancelled" not in df.columns and "o_totalprice" not in df.columns and "l_partkey" not in df.columns
    imputed = list(prep.spec.numeric_mean) + list(prep.spec.numeric_mode)
    nulls = df.agg(*[F.sum(F.col(c).isNull().cast("int")).alias(c) for c in imputed]).first()
    assert all(v == 0 for v in nulls)
    parts = {r[0] for r in df.select("dep_hhmm").distinct().collect()}
    assert parts <= {"lateNight", "earlyMorning", "lateMorning", "earlyAfternoon", "lateAfternoon", "earlyEvening", "lateEvening", "earlyNight"}
    assert dict(df.dtypes)["y"] == "int"
    assert df.filter(F.col("part_age") < 0).count() == 0


def test_correlation_profile_is_one_frame(prep):
    rows = prep.correlations.collect()
    k = 11  # numeric columns at profiling time (before the collinear drop)
    assert len(rows) == k + k * (k - 1) // 2


def test_flagship_parity_mode_fdr_equals_fwe(spark):
    rep = flagship(spark, SF_SMALL, features="normFeatures", kinds=("linear",), folds=3)
    rows = {(r.model, r.selection): (r.rmse, r.r2) for r in rep.summary.collect()}
    assert rows[("linear", "fdr")] == rows[("linear", "fwe")]
    assert rows[("linear", "fdr")][0] >= 0
    assert rep.n_features > 0 and set(rep.selected["fwe"]) <= set(rep.selected["fdr"])


def test_flagship_full(spark):
    rep = flagship(spark, SF_SMALL, folds=3)
    rows = rep.summary.collect()
    assert {(r.model, r.selection) for r in rows} == {(m, s) for m in ("linear", "tree", "forest") for s in ("fdr", "fwe")}
    assert all(r.rmse >= 0 and r.n > 0 for r in rows)
    assert max(r.r2 for r in rows) > 0.5  # the target has signal
    params = {r.param for r in rep.best_params["linear_fdr"].collect()}
    assert {"regParam", "elasticNetParam", "maxIter"} <= params


def test_fit_on_train_keeps_test_rows_out_of_fitting(spark):
    from tessera.functions import hash_bucket
    from tessera.operators.impute import impute

    df = spark.range(2000).select(F.col("id").alias("k"), F.when(F.col("id") % 4 == 0, None).otherwise(F.col("id")).cast("int").alias("x"))
    train_rows = hash_bucket(["k"], 10) < 700
    _, model_all = impute(df, ["x"], "mean")
    _, model_train = impute(df, ["x"], "mean", fit_filter=train_rows)
    expect = df.filter(train_rows & F.col("x").isNotNull()).agg(F.avg("x")).first()[0]
    assert model_train.surrogateDF.first()["x"] == pytest.approx(expect)
    assert model_all.surrogateDF.first()["x"] != model_train.surrogateDF.first()["x"]

    rep = flagship(spark, SF_SMALL, kinds=("linear",), folds=3, fit_on="train")
    rows = rep.summary.collect()
    assert len(rows) == 2 and all(r.n > 0 and r.rmse >= 0 for r in rows)


def test_age_null_impute_keeps_rows(spark):
    fact, dim = RAW_FACT.frame(spark, SF_SMALL), RAW_DIM.frame(spark, SF_SMALL)
    dropped = prepare(fact, dim, FLAGSHIP_SPEC, materialize_how="none").df
    imputed = prepare(fact, dim, FLAGSHIP_SPEC, materialize_how="none", age_null="impute").df
    assert imputed.count() > dropped.count()
    assert imputed.filter(F.col("part_age").isNull()).count() == 0


def test_write_run_report(spark):
    import os
    import tempfile

    from tessera.sources import write_run_report

    rep = flagship(spark, SF_SMALL, kinds=("linear",), folds=2)
    root = os.path.join(tempfile.mkdtemp(prefix="tessera-run-"), "report")
    paths = write_run_report(rep, root)
    assert [p.rsplit("/", 1)[-1] for p in paths] == ["summary", "best_params", "correlations", "selected"]
    assert spark.read.parquet(paths[0]).count() == 2
    params = spark.read.parquet(paths[1])
    assert {r.model for r in params.select("model").distinct().collect()} == {"linear"}
    assert spark.read.parquet(paths[3]).count() == len(rep.selected["fdr"]) + len(rep.selected["fwe"])


def test_observed_mean_surrogates_equal_imputer(spark, monkeypatch):
    import sys

    from tessera.operators.impute import impute

    run_mod = sys.modules["tessera.plans.run"]  # the package exports a function of the same name

    fact, dim = RAW_FACT.frame(spark, SF_SMALL), RAW_DIM.frame(spark, SF_SMALL)
    ours = prepare(fact, dim, FLAGSHIP_SPEC).df  # checkpoint folder set: surrogates observed on the write
    monkeypatch.setattr(run_mod, "_fill_means", lambda df, cols, means, keep_double: impute(df, cols, "mean", keep_double)[0])
    spark_imputer = prepare(fact, dim, FLAGSHIP_SPEC).df
    assert ours.columns == spark_imputer.columns
    assert ours.exceptAll(spark_imputer).count() == 0 and spark_imputer.exceptAll(ours).count() == 0


def test_close_releases_everything(spark):
    import os

    def tables():
        root = spark.sparkContext.getCheckpointDir().removeprefix("file:")
        return {os.path.join(d, f) for d, _, files in os.walk(root) for f in files}

    jsc = spark.sparkContext._jsc
    spark.catalog.clearCache()
    before, held = tables(), set(jsc.getPersistentRDDs().keySet())
    with flagship(spark, SF_SMALL, folds=2) as rep:
        assert rep.summary.count() == 6
        assert tables() - before
    assert not tables() - before
    assert not set(jsc.getPersistentRDDs().keySet()) - held


def test_few_copies_at_a_time(spark):
    import threading
    import time

    jsc, seen, done = spark.sparkContext._jsc, [0], threading.Event()
    spark.catalog.clearCache()
    held = len(jsc.getPersistentRDDs())

    def watch():
        while not done.is_set():
            seen.append(len(jsc.getPersistentRDDs()) - held)
            time.sleep(0.05)

    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        flagship(spark, SF_SMALL, kinds=("tree", "forest"), folds=2, parallelism=2).close()
    finally:
        done.set()
        watcher.join()
    assert max(seen) <= 3  # the shared table and one bagged copy for each of two fits


def test_fits_at_a_time_follow_the_free_memory(spark, monkeypatch):
    import tessera.operators.models as models

    df = spark.range(1000)
    assert models.fits_at_a_time(df, 6) == 6  # a small table: all at once
    monkeypatch.setattr(models, "planned_bytes", lambda _: 10**18)
    assert models.fits_at_a_time(df, 6) == 1
    free = [int(v._2()) for v in _values(spark.sparkContext._jsc.sc().getExecutorMemoryStatus())]
    monkeypatch.setattr(models, "planned_bytes", lambda _: sum(free) // 6)
    assert models.fits_at_a_time(df, 6) in (2, 3)


def _values(scala_map):
    at = scala_map.values().iterator()
    while at.hasNext():
        yield at.next()


def test_failed_run_releases_what_it_made(spark):
    held = set(spark.sparkContext._jsc.getPersistentRDDs().keySet())
    with pytest.raises(KeyError):
        flagship(spark, SF_SMALL, kinds=("no such kind",))
    assert not set(spark.sparkContext._jsc.getPersistentRDDs().keySet()) - held
