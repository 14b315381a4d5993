"""Derived test tables, each a list of (name, SQL expression) over the driver tables.

The same expression text is run by Spark (``selectExpr``) and, in the oracle
SQL, by DuckDB, so both engines see byte-identical inputs. Only functions that
behave the same in both are used: integer ``%``, ``CASE``, ``floor``/``round``
followed by a cast to BIGINT (never a double printed as text), ``||``,
``year``/``month``/``dayofmonth``/``hour``/``minute``.
Dirt (``NA``, NULL, placeholders, bad numbers, out-of-range clocks) is placed
by key arithmetic, so it scales with the tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tessera.session import ensure_parallelism

_INT_VALUE = "CAST(CAST(floor(value) AS BIGINT) AS STRING)"
_CLOCK = "hour(ts) * 100 + minute(ts)"


@dataclass(frozen=True)
class Fixture:
    name: str
    base: str  # driver table, or "lineitem_orders" for lineitem ⋈ orders
    columns: tuple[tuple[str, str], ...]

    def select_sql(self) -> str:
        cols = ",\n  ".join(f"{expr} AS {name}" for name, expr in self.columns)
        return f"SELECT\n  {cols}\nFROM {_FROM_SQL[self.base]}"

    def cte(self) -> str:
        return f"{self.name} AS (\n{self.select_sql()}\n)"

    def frame(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return _base_frame(spark, sf_dir, self.base).selectExpr(
            *[f"{expr} AS {name}" for name, expr in self.columns]
        )


_FROM_SQL = {
    "events": "events",
    "part": "part",
    "lineitem": "lineitem",
    "orders": "orders",
    "nation": "nation",
    "lineitem_orders": "lineitem JOIN orders ON l_orderkey = o_orderkey",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _spread(df: DataFrame) -> DataFrame:
    """The driver's files hold one row group each, so a scan is one or a few
    tasks; spread the scan before the derived columns are computed (a no-op
    for a real table with many splits)."""
    return ensure_parallelism(df)


def _base_frame(spark: SparkSession, sf_dir: str, base: str) -> DataFrame:
    if base == "lineitem_orders":
        from tessera.operators.join import dim_join

        # The library's size-checked join: orders is broadcast only when a
        # bounded probe proves it small, else a (salted) sort-merge join runs, which
        # deals the rows out itself: only for a broadcast the scan is spread.
        li = table(spark, sf_dir, "lineitem")
        o = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
        return dim_join(li, o, "l_orderkey", spread=True)
    return _spread(table(spark, sf_dir, base))


DIRTY_EVENTS = Fixture(
    "dirty_events",
    "events",
    (
        ("event_id", "event_id"),
        ("user_id", "user_id"),
        ("value", "value"),
        (
            "value_txt",
            "CASE WHEN event_id % 7 = 0 THEN 'NA' WHEN event_id % 11 = 0 THEN NULL "
            f"WHEN event_id % 13 = 0 THEN {_INT_VALUE} || '.75' "
            f"WHEN event_id % 17 = 0 THEN '-' || {_INT_VALUE} || '.7' "
            "WHEN event_id % 19 = 0 THEN ' ' || CAST(user_id AS STRING) || ' ' "
            "WHEN event_id % 23 = 0 THEN '1e3' WHEN event_id % 29 = 0 THEN 'abc' "
            "WHEN event_id % 31 = 0 THEN '+' || CAST(user_id AS STRING) "
            "WHEN event_id % 37 = 0 THEN '.5' "
            f"ELSE {_INT_VALUE} END",
        ),
        (
            "cancelled",
            "CASE WHEN event_id % 10 = 0 THEN '1' WHEN event_id % 41 = 0 THEN '0.00' "
            "WHEN event_id % 43 = 0 THEN NULL WHEN event_id % 47 = 0 THEN 'x' "
            "WHEN event_id % 53 = 0 THEN '0.4' ELSE '0' END",
        ),
        (
            "hhmm",
            "CASE WHEN event_id % 59 = 0 THEN 2500 WHEN event_id % 61 = 0 THEN -5 "
            "WHEN event_id % 67 = 0 THEN NULL WHEN event_id % 71 = 0 THEN 2400 "
            f"ELSE CAST({_CLOCK} AS INT) END",
        ),
        ("hhmm2", f"CAST((({_CLOCK}) + 700) % 2400 AS INT)"),
        (
            "cat",
            "CASE event_id % 9 WHEN 0 THEN NULL WHEN 1 THEN 'None' WHEN 2 THEN 'Unknow' "
            "WHEN 3 THEN '' WHEN 4 THEN ' ' WHEN 5 THEN 'Unknown' ELSE event_type END",
        ),
        ("event_type", "event_type"),
        ("const", "'k'"),
        ("const_null", "CASE WHEN event_id % 2 = 0 THEN 'k' ELSE NULL END"),
        ("all_null", "CAST(NULL AS STRING)"),
        ("user_na", "CASE WHEN event_id % 5 = 0 THEN 'NA' ELSE CAST(user_id AS STRING) END"),
        ("mo", "CASE WHEN event_id % 6 = 0 THEN NULL ELSE CAST(user_id % 12 + 1 AS INT) END"),
        ("amount", "CASE WHEN event_id % 8 = 0 THEN NULL ELSE CAST(floor(value) AS INT) END"),
        ("amount2", "CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(floor(value / 3) AS INT) + CAST(user_id % 5 AS INT) END"),
    ),
)

# Fact with a learnable target: y = price*(1-discount) + 500*quantity.
FACT = Fixture(
    "fact",
    "lineitem_orders",
    (
        ("l_orderkey", "l_orderkey"),
        ("l_linenumber", "l_linenumber"),
        ("y", "l_extendedprice * (1 - l_discount) + 500 * l_quantity"),
        ("price", "l_extendedprice"),
        ("quantity", "l_quantity"),
        ("discount", "l_discount"),
        ("tax", "l_tax"),
        ("o_orderpriority", "o_orderpriority"),
        ("l_returnflag", "l_returnflag"),
        ("l_partkey", "l_partkey"),
        ("ship_year", "CAST(year(l_shipdate) AS INT)"),
    ),
)

# Same fact, key all 'NA': the join gate must skip it.
FACT_NO_KEY = Fixture(
    "fact_no_key",
    "lineitem_orders",
    tuple((n, e) for n, e in FACT.columns if n != "l_partkey") + (("l_partkey", "'NA'"),),
)

_ISSUE_DATE = (
    "CASE WHEN p_partkey % 50 = 0 THEN 'None' WHEN p_partkey % 53 = 0 THEN 'NA' "
    "WHEN p_partkey % 59 = 0 THEN '13/45/2001' WHEN p_partkey % 61 = 0 THEN NULL "
    "ELSE CAST(p_partkey % 12 + 1 AS STRING) || '/' || CAST(p_partkey % 28 + 1 AS STRING) "
    "|| '/' || CAST(1990 + p_partkey % 15 AS STRING) END"
)

DIM = Fixture(
    "dim",
    "part",
    (
        ("l_partkey", "p_partkey"),
        ("p_brand", "p_brand"),
        ("p_type", "p_type"),
        ("p_size", "p_size"),
        ("issue_date", _ISSUE_DATE),
    ),
)

# Flagship input, all text (as a header CSV reads), dirt placed by key arithmetic.
RAW_FACT = Fixture(
    "raw_fact",
    "lineitem_orders",
    (
        ("l_orderkey", "l_orderkey"),
        ("l_linenumber", "l_linenumber"),
        (
            "y",
            "CASE WHEN l_orderkey % 97 = 0 THEN 'NA' WHEN (l_orderkey + l_linenumber) % 89 = 0 THEN NULL "
            "ELSE CAST(CAST(floor(l_extendedprice * (1 - l_discount) + 500 * l_quantity) AS BIGINT) AS STRING) END",
        ),
        ("cancelled", "CASE WHEN (l_orderkey + l_linenumber) % 41 = 0 THEN '1' ELSE '0' END"),
        ("cancel_code", "CASE WHEN (l_orderkey + l_linenumber) % 41 = 0 THEN 'B' ELSE NULL END"),
        ("o_totalprice", "CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING)"),
        ("o_orderstatus", "o_orderstatus"),
        ("l_partkey", "CASE WHEN l_orderkey % 83 = 0 THEN 'NA' ELSE CAST(l_partkey AS STRING) END"),
        ("o_custkey", "CAST(o_custkey AS STRING)"),
        ("quantity", "CASE WHEN l_orderkey % 79 = 0 THEN 'NA' ELSE CAST(CAST(l_quantity AS BIGINT) AS STRING) END"),
        ("qty_dozen", "CAST(CAST(l_quantity * 12 AS BIGINT) AS STRING)"),
        ("price", "CASE WHEN l_orderkey % 73 = 0 THEN NULL ELSE CAST(CAST(floor(l_extendedprice) AS BIGINT) AS STRING) END"),
        ("discount_pct", "CAST(CAST(round(l_discount * 100) AS BIGINT) AS STRING)"),
        ("tax_pct", "CAST(CAST(round(l_tax * 100) AS BIGINT) AS STRING)"),
        (
            "dep_hhmm",
            "CASE WHEN l_orderkey % 101 = 0 THEN '2500' WHEN l_orderkey % 103 = 0 THEN 'NA' "
            "ELSE CAST(((l_orderkey * 7 + l_linenumber * 3) % 24) * 100 + (l_orderkey * 11 + l_linenumber) % 60 AS STRING) END",
        ),
        (
            "arr_hhmm",
            "CAST(((l_orderkey * 7 + l_linenumber * 3 + 2 + l_orderkey % 3) % 24) * 100 "
            "+ (l_orderkey * 13 + l_linenumber) % 60 AS STRING)",
        ),
        ("ship_year", "CAST(year(l_shipdate) AS STRING)"),
        ("ship_month", "CASE WHEN l_orderkey % 71 = 0 THEN 'NA' ELSE CAST(month(l_shipdate) AS STRING) END"),
        ("ship_day", "CAST(dayofmonth(l_shipdate) AS STRING)"),
        ("ship_dow", "CAST(l_orderkey % 7 + 1 AS STRING)"),
        ("o_orderpriority", "CASE WHEN l_orderkey % 67 = 0 THEN 'NA' ELSE o_orderpriority END"),
        ("l_returnflag", "CASE WHEN l_orderkey % 61 = 0 THEN 'None' WHEN l_orderkey % 59 = 0 THEN NULL ELSE l_returnflag END"),
        ("l_linestatus", "l_linestatus"),
        ("carrier", "'TX'"),
    ),
)

RAW_DIM = Fixture(
    "raw_dim",
    "part",
    (
        ("l_partkey", "CAST(p_partkey AS STRING)"),
        ("p_brand", "CASE WHEN p_partkey % 67 = 0 THEN NULL ELSE p_brand END"),
        ("p_type", "p_type"),
        ("p_size", "CAST(p_size AS STRING)"),
        ("issue_date", _ISSUE_DATE),
        ("p_name", "p_name"),
        ("p_retailprice", "CAST(CAST(floor(p_retailprice) AS BIGINT) AS STRING)"),
    ),
)

FIXTURES = {f.name: f for f in (DIRTY_EVENTS, FACT, FACT_NO_KEY, DIM, RAW_FACT, RAW_DIM)}


def with_ctes(sql: str, *fixtures: Fixture) -> str:
    """Prefix a query with the fixtures it reads as CTEs (for the DuckDB oracle)."""
    if not fixtures:
        return sql
    return "WITH " + ",\n".join(f.cte() for f in fixtures) + "\n" + sql
