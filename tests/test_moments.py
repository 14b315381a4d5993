"""One-pass co-moments: against numpy, whatever the merging; linear cross-validation and
selections built on them against Spark's own estimators."""

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import UnivariateFeatureSelector
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from tessera.operators import moments
from tessera.operators.features import assemble, f_scores, select_features, selection_report
from tessera.operators.models import equivalent_rows, fit_cv
from tessera.operators.profile import corr_matrix


def sample(n=400, k=5, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, k)) * 10.0 ** rng.integers(-3, 4, k) + rng.normal(size=k) * 50
    x[:, 0] = 1.7e9 + rng.normal(size=n) * 50
    return x


def direct(x, missing, lo, hi, start):
    """n, means and centred products of every pair, in exact order."""
    k = x.shape[1]
    out = {p: np.zeros((hi - lo, k - start)) for p in ("n", "mx", "my", "xy", "xx", "yy")}
    for i in range(lo, hi):
        for j in range(start, k):
            both = ~missing[:, i] & ~missing[:, j]
            a, b = x[both, i].astype(np.longdouble), x[both, j].astype(np.longdouble)
            at = (i - lo, j - start)
            out["n"][at] = both.sum()
            if both.any():
                out["mx"][at], out["my"][at] = a.mean(), b.mean()
                a, b = a - a.mean(), b - b.mean()
                out["xy"][at], out["xx"][at], out["yy"][at] = (a * b).sum(), (a * a).sum(), (b * b).sum()
    return out


@pytest.mark.parametrize("pairwise", [False, True])
@pytest.mark.parametrize("tile", [(0, 5, 0), (2, 4, 2), (4, 5, 0)])
def test_merging_equals_direct_computation(pairwise, tile):
    x = sample()
    missing = np.random.default_rng(1).random(x.shape) < (0.3 if pairwise else 0)
    missing[:, 3] |= pairwise  # a column without any value
    parts = [moments.Moments.of(np.where(missing, 0, x)[s], missing[s] if pairwise else None, *tile) for s in (slice(0, 7), slice(7, 8), slice(8, 250), slice(250, 400))]
    left = parts[0].merged(parts[1]).merged(parts[2].merged(parts[3]))
    right = parts[3].merged(parts[0].merged(parts[2])).merged(parts[1])
    want = direct(x, missing, *tile)
    scale = np.sqrt(np.maximum(want["xx"] * want["yy"], 1e-300))
    for m in (left, right):
        got = {p: np.broadcast_to(getattr(m, p), want["n"].shape) for p in want}
        assert np.array_equal(got["n"], want["n"])
        there = want["n"] > 0
        for p in ("mx", "my", "xx", "yy"):
            np.testing.assert_allclose(got[p][there], want[p][there], rtol=1e-7)
        np.testing.assert_allclose((got["xy"] / scale)[there], (want["xy"] / scale)[there], atol=1e-7)


def test_constant_columns_have_exactly_no_variance():
    x = np.full((1000, 2), 0.1)
    x[:, 1] = 1.7e9 + 0.3
    m = moments.Moments.of(x[:333], None, 0, 2, 0).merged(moments.Moments.of(x[333:], None, 0, 2, 0))
    assert (m.xx == 0).all() and np.isnan(m.correlations()).all()


def test_bands_and_tiles_do_not_matter(spark, monkeypatch):
    x = sample(300, 16)
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], [f"c{i}" for i in range(16)]).repartition(5)
    want = {(r.a, r.b): r.r for r in corr_matrix(df, df.columns).collect()}
    monkeypatch.setattr(moments, "TILE_CELLS", 40)
    monkeypatch.setattr(moments, "MAX_CELLS", 100)
    got = {(r.a, r.b): r.r for r in corr_matrix(df, df.columns).collect()}
    assert got.keys() == want.keys() and len(got) == 120
    assert all(abs(got[p] - want[p]) < 1e-12 for p in got)
    exact = np.corrcoef(x.T)
    assert all(abs(v - exact[int(a[1:]), int(b[1:])]) < 1e-7 for (a, b), v in got.items())


def test_wide_and_narrow_agree_on_nulls_nan_and_constants(spark, monkeypatch):
    df = spark.range(500).select(
        F.when(F.col("id") % 3 != 0, F.col("id")).cast("double").alias("a"), ((F.col("id") * 7) % 31).cast("double").alias("b"),
        F.lit(4.0).alias("k"), F.lit(None).cast("double").alias("none"), F.when(F.col("id") == 9, float("nan")).otherwise(F.col("id")).alias("nan"),
    )
    for policy in ("zero", "pairwise"):
        narrow = {(r.a, r.b): r.r for r in corr_matrix(df, df.columns, policy).collect()}
        monkeypatch.setattr("tessera.operators.profile.NARROW_PAIRS", 0)
        wide = {(r.a, r.b): r.r for r in corr_matrix(df, df.columns, policy).collect()}
        monkeypatch.undo()
        assert narrow.keys() == wide.keys()
        for p, v in narrow.items():
            assert (v is None) == (wide[p] is None) and (v is None or abs(v - wide[p]) < 1e-12), (policy, p)
            assert v is None or not {"k", "none", "nan"} & set(p)
    assert corr_matrix(df.limit(0), [*df.columns, *[f"a{i}" for i in range(9)]]).count() >= 0


def test_equivalent_rows_have_the_same_moments():
    x = sample(200, 6)
    x[:, 2] = 3.0
    rows = equivalent_rows(moments.Moments.of(x, None, 0, 6, 0))
    assert rows.shape == (7, 6)
    np.testing.assert_allclose(rows.mean(axis=0), x.mean(axis=0), rtol=1e-12)
    scale = np.where(x.std(axis=0) > 0, x.std(axis=0), 1)
    np.testing.assert_allclose(np.cov((rows / scale).T, bias=True), np.cov((x / scale).T, bias=True), atol=1e-6)
    assert (rows[:, 2] == 3.0).all()


@pytest.fixture(scope="module")
def regression(spark):
    """Correlated columns of different scale, a sparse one, a constant; folds of different size."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(900, 6)) * [1, 10, 0.1, 1, 5, 0]
    x[:, 3] = rng.random(900) < 0.05
    x[:, 4] += x[:, 1]
    y = 3 * x[:, 0] - 0.4 * x[:, 1] + 8 * x[:, 3] + rng.normal(size=900) * 2 + 40
    rows = [(i, Vectors.sparse(6, {j: float(v) for j, v in enumerate(r) if v}) if i % 2 else Vectors.dense(r), float(t), int(min(i % 7, 3))) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, ["id", "v", "y", "fold"]).withColumn(
        "fold", F.col("fold").cast("int")
    ).repartition(4).persist()


GRID = {"regParam": [0.0, 0.01, 0.5], "elasticNetParam": [0.0, 0.25, 1.0]}


@pytest.mark.parametrize("options", [{"maxIter": 10}, {"maxIter": 200, "tol": 1e-10}, {"standardization": False}, {"fitIntercept": False}])
def test_linear_cv_from_moments_equals_crossvalidator(spark, regression, options):
    got = fit_cv(regression, "linear", "v", "y", grid=GRID, folds=4, fold_col="fold", **options)
    est = LinearRegression(featuresCol="v", labelCol="y", predictionCol="predictionLR", **options)
    grid = ParamGridBuilder()
    for name, values in GRID.items():
        grid = grid.addGrid(est.getParam(name), values)
    want = CrossValidator(
        estimator=est, estimatorParamMaps=grid.build(), evaluator=RegressionEvaluator(labelCol="y", predictionCol="predictionLR"),
        numFolds=4, foldCol="fold", parallelism=4,
    ).fit(regression)
    np.testing.assert_allclose(got.avgMetrics, want.avgMetrics, rtol=1e-7)
    np.testing.assert_allclose(got.stdMetrics, want.stdMetrics, rtol=1e-5, atol=1e-9)
    np.testing.assert_allclose(got.bestModel.coefficients.toArray(), want.bestModel.coefficients.toArray(), rtol=1e-6, atol=1e-9)
    assert got.bestModel.intercept == pytest.approx(want.bestModel.intercept, rel=1e-6)
    assert not got.bestModel.hasSummary
    names = {p.name: v for p, v in got.bestModel.extractParamMap().items()}
    assert names["regParam"] == want.bestModel.getRegParam() and names["predictionCol"] == "predictionLR"
    a, b = (m.transform(regression).select("id", "predictionLR").orderBy("id").toPandas() for m in (got, want))
    np.testing.assert_allclose(a.predictionLR, b.predictionLR, rtol=1e-6)


def test_every_fold_and_grid_point_equals_its_own_fit(regression):
    from tessera.operators.models import estimator, param_grid

    for alpha in (0.0, 0.25):
        for reg in (0.01, 0.5):
            for fold in range(4):
                grid = {"regParam": [reg], "elasticNetParam": [alpha], "maxIter": [10]}
                kept = regression.where(F.col("fold") != fold)
                est = estimator("linear", "v", "y")
                want = est.fit(kept, param_grid(est, "linear", grid)[0])
                refit = fit_cv(kept.withColumn("half", (F.col("id") % 2).cast("int")), "linear", "v", "y", grid=grid, folds=2, fold_col="half")
                np.testing.assert_allclose(refit.bestModel.coefficients.toArray(), want.coefficients.toArray(), rtol=1e-6, atol=1e-9)


def test_linear_cv_is_one_scan(spark, regression):
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    df = regression.select("id", "y", "fold").mapInArrow(seen, "id long, y double, fold int")
    df = assemble(df.withColumn("a", F.col("id").cast("double")), ["a"], "v")
    fit_cv(df, "linear", "v", "y", grid=GRID, folds=4, fold_col="fold")
    assert reads.value == 900


def test_wide_or_iterative_linear_models_are_fitted_on_the_rows(regression):
    by_rows = fit_cv(regression, "linear", "v", "y", folds=4, fold_col="fold", max_moment_features=3)
    by_moments = fit_cv(regression, "linear", "v", "y", folds=4, fold_col="fold")
    assert by_rows.bestModel.hasSummary and not by_moments.bestModel.hasSummary
    np.testing.assert_allclose(by_rows.avgMetrics, by_moments.avgMetrics, rtol=1e-9)
    assert fit_cv(regression, "linear", "v", "y", folds=4, fold_col="fold", solver="l-bfgs").bestModel.hasSummary


def test_missing_fold_and_null_label(spark, regression):
    with pytest.raises(ValueError, match="fold 4"):
        fit_cv(regression, "linear", "v", "y", folds=5, fold_col="fold")
    with pytest.raises(Exception, match="NULL among the values"):
        fit_cv(regression.withColumn("y", F.when(F.col("id") != 5, F.col("y"))), "linear", "v", "y", folds=4, fold_col="fold")


@pytest.mark.parametrize("mode", ["fdr", "fwe"])
@pytest.mark.parametrize("threshold", [0.5, 0.05, 1e-4, 1e-12])
def test_selection_equals_the_selector(spark, regression, mode, threshold):
    sel = UnivariateFeatureSelector(featuresCol="v", labelCol="y", outputCol="s", selectionMode=mode)
    sel.setFeatureType("continuous").setLabelType("continuous").setSelectionThreshold(threshold)
    want = sel.fit(regression)
    df, picked, model = select_features(regression, "v", "y", mode, threshold, out="s")
    assert picked == sorted(want.selectedFeatures) == sorted(model.selectedFeatures)
    key = lambda d: [r["s"].toArray().tolist() for r in d.orderBy("id").collect()]
    assert key(df) == key(want.transform(regression))


def test_both_selections_from_one_pass(spark, regression):
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    df = regression.select("id", "y").mapInArrow(seen, "id long, y double")
    df = assemble(df.withColumn("a", F.col("id").cast("double")).withColumn("b", -F.col("y")), ["a", "b"], "v")
    scores = f_scores(df, "v", "y")
    for mode in ("fdr", "fwe"):
        assert 1 in select_features(df, "v", "y", mode, scores=scores, on_empty="all")[1]
    assert reads.value == 900


def test_report_of_thousands_of_slots(spark):
    k = 3000
    rows = [(i, Vectors.sparse(k, {i % k: 1.0, (i * 7) % k: 2.0}), float(i % 50)) for i in range(200)]
    df = spark.createDataFrame(rows, ["id", "v", "y"])
    report = selection_report(df, "v", "y", "fdr")
    assert report.count() == k
    assert report.where("f IS NULL AND NOT selected").count() > 0  # slots without variance
