"""What the queries over large tables must not do twice, or shuffle at all."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import join
from tessera.operators.join import dim_join, hot_keys
from tessera.operators.surrogates import modes
from tessera.plans import catalog
from tessera.session import materialize_observed


@pytest.fixture
def facts(spark, monkeypatch):
    """A small fact in place of the joined tables; the list grows with each time it is built."""
    built = []

    def fact(spark, _sf):
        built.append(1)
        return spark.range(400).selectExpr(
            "id AS l_orderkey", "cast(id % 3 AS int) AS l_linenumber", "cast(id % 20 * 7 + id % 3 AS double) AS y",
            "cast(id % 20 AS double) AS quantity", "concat('p', id % 4) AS o_orderpriority", "concat('r', id % 2) AS l_returnflag",
        ).repartition(3)

    monkeypatch.setattr(catalog, "_fact", fact)
    return built


def test_hot_keys_shuffle_no_column_of_many_keys(spark, monkeypatch):
    grouped = []
    plain = type(spark.range(1)).groupBy
    monkeypatch.setattr(type(spark.range(1)), "groupBy", lambda self, *c: grouped.append(str(c[0])) or plain(self, *c))
    many = spark.range(20000).select(F.col("id").alias("k"))
    assert hot_keys(many, "k", 0.01) == [] and grouped == ["bucket"]


def test_hot_keys_share_buckets(spark, monkeypatch):
    fact = spark.range(1200).select(F.expr("CASE WHEN id % 4 = 0 THEN 'hot' WHEN id % 4 = 1 THEN NULL ELSE cast(id AS string) END").alias("k"))
    monkeypatch.setattr(join, "HASH_BUCKETS", 2)
    assert hot_keys(fact, "k", 1 / 3) == ["hot"] and hot_keys(fact, "k", 0.34) == []
    assert hot_keys(fact.where("k IS NULL"), "k", 0.1) == []


def test_a_fact_is_spread_for_a_broadcast_only(spark):
    fact = spark.range(0, 50, 1, 1).select(F.col("id").alias("k"))
    dim = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    plan = lambda how: dim_join(fact, dim, "k", broadcast=how, spread=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition" in plan(True) and "Repartition" not in plan(False)


def test_least_squares_reads_stored_rows(spark, facts, monkeypatch):
    stored = []
    monkeypatch.setattr(catalog, "materialize", lambda df, *a, **o: stored.append(df.columns) or df)
    row = catalog.q_linreg_ols(spark, "").first()
    assert stored == [["y", "quantity"]] and abs(row["slope"] - 7) < 0.1


def test_model_summary_joins_once(spark, facts):
    rows = {r["model"]: r for r in catalog.q_model_summary(spark, "").collect()}
    assert len(facts) == 1 and set(rows) == {"linear", "tree", "forest"}
    assert len({r["n"] for r in rows.values()}) == 1 and rows["linear"]["r2"] > 0.99


def test_model_summary_compares_whole_models(spark, facts, monkeypatch):
    models, tested = {}, []
    plain = catalog.fit_cv

    def fit_cv(train, kind, *a, **o):
        models[kind] = plain(train, kind, *a, **o)
        return models[kind]

    split = catalog.hash_split
    monkeypatch.setattr(catalog, "fit_cv", fit_cv)
    monkeypatch.setattr(catalog, "hash_split", lambda df, *a: tested.append(split(df, *a)[1].collect()) or split(df, *a))
    report = {r["model"]: r for r in catalog.q_model_summary(spark, "").collect()}
    best = {kind: m.bestModel for kind, m in models.items()}
    assert {k: len(m.foldMetrics) for k, m in models.items()} == {"linear": 5, "tree": 5, "forest": 5}
    assert all(m.numFeatures == 5 for m in best.values())  # the quantity, four priorities and two flags less one each
    assert (best["linear"].getRegParam(), best["linear"].getElasticNetParam(), best["linear"].getMaxIter()) == (0.01, 0.25, 10)
    assert best["tree"].depth == 5 and best["tree"].getMaxBins() == 32
    forest = best["forest"]
    assert forest.getNumTrees == 20 and max(t.depth for t in forest.trees) == 5
    assert forest.getBootstrap() and forest.getFeatureSubsetStrategy() == "auto"
    # The report's figures, from the models' predictions row by row.
    y = np.array([r["y"] for r in tested[0]])
    for kind, model in best.items():
        error = y - np.array([model.predict(r["features"]) for r in tested[0]])
        row = report[kind]
        assert row["selection"] == "features" and row["n"] == len(y)
        assert row["rmse"] == pytest.approx(np.sqrt((error**2).mean()), abs=1e-4)
        assert row["r2"] == pytest.approx(1 - (error**2).mean() / y.var(), abs=1e-6)


def test_one_hot_reads_its_rows_once(spark, facts):
    df = catalog.q_one_hot(spark, "")
    assert "Union" not in df._jdf.queryExecution().optimizedPlan().toString()
    counts = {(r["col_name"], r["slot"]): r["count"] for r in df.groupBy("col_name", "slot").count().collect()}
    assert counts == {("o_orderpriority", 0): 100, ("o_orderpriority", 1): 100, ("o_orderpriority", 2): 100, ("l_returnflag", 0): 200}
    assert df.schema.simpleString() == "struct<l_orderkey:bigint,l_linenumber:int,col_name:string,slot:int,value:double>"


def test_metrics_come_from_the_stored_table(spark, monkeypatch):
    def uncompiled(*_):
        raise AssertionError("observed metrics run row by row")

    monkeypatch.setattr("pyspark.sql.Observation", uncompiled)
    df = spark.range(10).select("id", F.expr("CASE WHEN id > 3 THEN 'a' END").alias("c"))
    out, values = materialize_observed(df, {"n": F.count("c"), "top": F.max("id"), "none": F.max(F.expr("CASE WHEN id > 99 THEN 1 END"))})
    assert values == {"n": 6, "top": 9, "none": None} and out.count() == 10
    assert materialize_observed(df, {}, "none")[1] == {}


def test_candidates_are_counted_without_a_lambda(spark, monkeypatch):
    monkeypatch.setattr(F, "array_compact", None)
    df = spark.range(300).select(F.expr("CASE WHEN id % 5 < 2 THEN 7 WHEN id % 5 < 4 THEN 3 END").alias("a"), F.expr("cast(NULL AS int)").alias("b"), (F.col("id") % 2).alias("c"))
    assert modes(df, ["a", "b", "c"]) == {"a": 3, "b": None, "c": 0}
