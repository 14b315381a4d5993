"""Physical-plan properties: pushdown through the cleaning expressions, column
pruning, no Python evaluation, one-pass profiles, checked broadcasts."""

import re

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tessera.operators import clean, profile
from tessera.operators.join import dim_join, hot_keys
from tessera.plans.fixtures import DIM, FACT, RAW_DIM, RAW_FACT, table
from tessera.plans.flagship import FLAGSHIP_SPEC
from tessera.plans.run import prepare
from tessera.session import bounded_size
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_after_cleaning_reaches_the_scan(spark):
    li = table(spark, SF_SMALL, "lineitem")
    df = clean.sentinel_to_null(li, ["l_returnflag", "l_linestatus"])
    df = clean.null_to_unknown(df, ["l_returnflag"])
    df = clean.filter_upper(df, {"l_quantity": 10})
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(l_quantity), LessThanOrEqual(l_quantity,10.0)]" in plan


def test_projection_prunes_the_scan(spark):
    li = table(spark, SF_SMALL, "lineitem")
    plan = _plan(clean.drop_columns(li, ["l_shipdate"]).select("l_orderkey", "l_tax"))
    assert "ReadSchema: struct<l_orderkey:bigint,l_tax:double>" in plan


def test_prepared_plan_has_no_python_evaluation(spark):
    prep = prepare(RAW_FACT.frame(spark, SF_SMALL), RAW_DIM.frame(spark, SF_SMALL), FLAGSHIP_SPEC, materialize_how="none")
    plan = prep.df._jdf.queryExecution().optimizedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan and "PythonUDF" not in plan


def test_profile_is_one_aggregate_without_value_shuffle(spark):
    df = table(spark, SF_SMALL, "lineitem")
    plan = _plan(profile.informative_columns(df, ["l_returnflag", "l_linestatus", "l_partkey"]))
    assert "hashpartitioning" not in plan  # only the SinglePartition exchange of partial rows
    plan = _plan(profile.corr_target(df, "l_tax", ["l_quantity", "l_discount"]))
    assert "hashpartitioning" not in plan


def test_dimension_broadcast_only_when_proven_small(spark):
    li = table(spark, SF_SMALL, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    part = table(spark, SF_SMALL, "part").withColumnRenamed("p_partkey", "l_partkey")
    small = _plan(dim_join(li, part, "l_partkey"))
    assert "BroadcastHashJoin" in small
    capped = _plan(dim_join(li, part, "l_partkey", broadcast_max_rows=10))
    # no key is hot here: a plain sort-merge join, no broadcast of anything
    assert "SortMergeJoin [l_partkey" in capped and "BroadcastHashJoin" not in capped
    apart = _plan(dim_join(li, part, "l_partkey", broadcast=False, hot_share=0.005))
    # hot keys meet their own dimension rows, the others are merged
    assert "SortMergeJoin [l_partkey" in apart and "BroadcastHashJoin [l_partkey" in apart and "Union" in apart


def test_size_check_moves_no_rows(spark):
    from tessera.session import _row_bytes

    probe = table(spark, SF_SMALL, "part")
    plan = _plan(probe.agg(F.count(F.lit(1)), F.sum(_row_bytes(probe.schema))))
    assert "Limit" not in plan and "partial_count" in plan
    assert bounded_size(spark.range(10**12), 5_000_000, 1 << 28) is None  # by its planned size: no job


def test_hot_path_reads_the_columns_of_the_plain_join(spark):
    fact, dim = FACT.frame(spark, SF_SMALL), DIM.frame(spark, SF_SMALL)
    want = ["l_partkey", "y", "p_brand"]
    schemas = [
        set(re.findall(r"ReadSchema: (\S+)", _plan(dim_join(fact, dim, "l_partkey", broadcast=b, hot_share=0.01).select(*want))))
        for b in (True, False)
    ]
    assert schemas[0] == schemas[1]


def test_vector_dimension_over_the_bound_is_not_broadcast(spark):
    vectors = spark.range(100).select(F.col("id").alias("k"), array_to_vector(F.array_repeat(F.lit(1.5), 1000)).alias("v"))
    assert bounded_size(vectors, 1000, 10**6)[1] > 800_000
    assert bounded_size(vectors, 1000, 100_000) is None
    fact = spark.range(1000).select((F.col("id") % 100).alias("k"), "id")
    plan = _plan(dim_join(fact, vectors, "k", broadcast_max_bytes=100_000, hot_share=0.5))
    assert "BroadcastHashJoin" not in plan


def test_a_hot_key_of_equal_rows_is_spread(spark):
    """A third of a key-only fact on one key: its rows stay where they are."""
    fact = spark.range(0, 30000, 1, 8).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500).alias("k"))
    dim = spark.range(0, 500).select(F.col("id").alias("k"), F.create_map(F.lit("a"), F.col("id")).alias("attr"))

    def largest_share(df):
        counts = [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
        return max(counts) / sum(counts)

    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # measure our own split, not AQE's
    try:
        plain = dim_join(fact, dim, "k", broadcast=False, hot_share=1.0)
        apart = dim_join(fact, dim, "k", broadcast=False)
        assert plain.count() == apart.count() == 30000
        assert largest_share(plain) > 0.33  # the hot key lands on one reducer
        assert largest_share(apart) < 0.2
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def test_many_keys_above_no_share(spark):
    fact = spark.range(1000).select((F.col("id") % 10).alias("k"))
    assert len(hot_keys(fact, "k", 0.1)) == 10 and hot_keys(fact, "k", 0.11) == []
