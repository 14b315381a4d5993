"""Bucketed tables: the rows of a plain join, without an exchange."""

import pytest
from pyspark.sql import functions as F

from tessera.operators.bucketed import bucketed_join, write_bucketed
from tessera.operators.join import dim_join
from tessera.session import Scratch, checkpoint_dir


@pytest.fixture(scope="module")
def tables(spark):
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 211)
    fact = spark.range(6000).select(key.alias("Key"), "id").repartition(4)
    dim = spark.range(0, 200).select(F.col("id").alias("key"), (F.col("id") * 2).alias("twice")).union(spark.range(7, 8).selectExpr("id", "id * 3"))
    return fact, dim


def rows(df):
    return sorted(map(tuple, df.collect()))


def exchanges(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


@pytest.mark.parametrize("hot_share", [None, 1.0])
def test_join_without_exchange(spark, tables, hot_share):
    fact, dim = tables
    with Scratch() as scratch:
        left = write_bucketed(fact, "key", 8, hot_share=hot_share, scratch=scratch)
        right = write_bucketed(dim, "KEY", 8, hot_share=1.0, scratch=scratch)
        assert (left.hot == [7]) == (hot_share is None)
        assert left.frame().exceptAll(fact).count() == 0 and left.frame().count() == fact.count()
        joined = bucketed_join(left, right)
        assert joined.columns == ["Key", "id", "twice"]
        assert rows(joined) == rows(dim_join(fact, dim, "Key"))
        assert exchanges(left.rest.join(right.rest.withColumnRenamed("key", "Key").hint("merge"), "Key")) == 0
        # Hot rows meet a broadcast; nothing else is exchanged.
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan
        for again in range(2):  # later joins and group-bys read in place as well
            assert exchanges(left.rest.groupBy("Key").agg(F.count("*"))) == 0
        left.forget(), right.forget()


def test_hot_keys_that_cannot_be_broadcast(spark, tables):
    fact, dim = tables
    left, right = write_bucketed(fact, "Key", 4), write_bucketed(dim, "key", 4, hot_share=1.0)
    assert rows(bucketed_join(left, right, max_rows=0)) == rows(dim_join(fact, dim, "Key"))


def test_refusals(spark, tables):
    fact, dim = tables
    left = write_bucketed(fact, "Key", 4, hot_share=1.0)
    with pytest.raises(ValueError, match="bucket counts"):
        bucketed_join(left, write_bucketed(dim, "key", 8, hot_share=1.0))
    with pytest.raises(ValueError, match="bucketed by"):
        bucketed_join(left, write_bucketed(dim, "twice", 4, hot_share=1.0))
    with pytest.raises(ValueError, match="besides the key"):
        bucketed_join(left, write_bucketed(dim.withColumn("id", F.lit(1)), "key", 4, hot_share=1.0))
    with pytest.raises(ValueError, match="not in the table"):
        write_bucketed(dim, "nothing", 4)
    with pytest.raises(ValueError, match="at least 1"):
        write_bucketed(dim, "key", 0)


def test_empty_tables(spark, tables):
    fact, dim = tables
    joined = bucketed_join(write_bucketed(fact.limit(0), "Key", 4), write_bucketed(dim, "key", 4, hot_share=1.0))
    assert joined.count() == 0 and checkpoint_dir(spark)
