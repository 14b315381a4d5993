"""Query catalog: one Spark query per operator and, where SQL can say it, the
equivalent DuckDB SQL over the same driver tables.

Every query reads whole driver tables (or fixtures Spark derives from them by
key arithmetic, see ``fixtures``). Output columns carry the same names and
types on both sides; doubles are rounded the same way on both sides.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable
from statistics import NormalDist

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.columns import DAY_PARTS, day_part, parse_date
from tessera.operators import clean, profile
from tessera.operators.bucketed import bucketed_join, write_bucketed
from tessera.operators.dictionary import string_index_distributed
from tessera.operators.evaluate import evaluate, evaluate_many
from tessera.operators.features import (
    FEATURES_COL,
    assemble,
    build_features,
    feature_count,
    l1_normalize,
    one_hot,
    select_features,
    selection_report,
    string_index,
)
from tessera.operators.impute import impute
from tessera.operators.join import dim_join, entity_age, gated_join
from tessera.operators.models import (
    LINEAR_GRID,
    MODEL_KINDS,
    PREDICTION_COLS,
    add_fold_column,
    best_params,
    cv_table,
    estimator,
    fit_cv,
    hash_split,
    random_split,
)
from tessera.plans.fixtures import DIM, DIRTY_EVENTS, FACT, FACT_NO_KEY, RAW_DIM, RAW_FACT, table, with_ctes
from tessera.session import Scratch, checkpoint_dir, ensure_parallelism, materialize
from tessera.sources.sinks import predictions_sample, preview, schema_report
from tessera.sources.tables import load_tables, read_quarantined
from tessera.spec import derive_roles

Query = Callable[[SparkSession, str], DataFrame]
KEYS = ["l_orderkey", "l_linenumber"]
FACT_NUMERIC = ["price", "quantity", "discount", "tax"]
FACT_CATEGORICAL = ["o_orderpriority", "l_returnflag"]
PROFILE_COLS = ["cat", "const", "const_null", "all_null", "user_na", "mo", "hhmm"]
CORR_COLS = ["mo", "amount2", "hhmm", "value"]


def _round(c: str, d: int = 6) -> F.Column:
    return F.round(F.col(c), d).alias(c)


def _staging(spark: SparkSession, name: str) -> str:
    """A fresh folder for a query that writes and re-reads files: under the
    cluster's shared checkpoint folder when set, else a local temp folder (tests)."""
    base = checkpoint_dir(spark)
    if base:
        return f"{base.rstrip('/')}/tessera_staging/{name}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a shared folder: executors cannot read a driver-local folder")
    return os.path.join(tempfile.mkdtemp(prefix="tessera-"), name)


def _events(spark, sf):
    return DIRTY_EVENTS.frame(spark, sf)


def _fact(spark, sf):
    return FACT.frame(spark, sf)


def _dim(spark, sf):
    return DIM.frame(spark, sf)


def _fact_features(spark, sf, normalize="l1"):
    feats, _, _ = build_features(
        _fact(spark, sf), FACT_NUMERIC, FACT_CATEGORICAL, "y", normalize=normalize, keep=KEYS
    )
    return materialize(feats)


def _explode_vec(df: DataFrame, vec: str, keep: list[str], nonzero: bool = False, digits: int = 6) -> DataFrame:
    out = df.select(*keep, F.posexplode(vector_to_array(F.col(vec))).alias("slot", "value"))
    if nonzero:
        out = out.filter(F.col("value") != 0)
    return out.select(*keep, F.col("slot").cast("int").alias("slot"), F.round("value", digits).alias("value"))


QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


# ---------------------------------------------------------------- sources ---
_ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def _write_orders_csv(spark, sf, root, name, where=None):
    o = table(spark, sf, "orders").select(*_ORDERS_COLS)
    if where is not None:
        o = o.filter(where)
    o.write.mode("overwrite").option("header", True).csv(f"{root}/{name}.csv")


@query(
    "scan_csv",
    """SELECT o_orderpriority, CAST(count(*) AS BIGINT) AS n,
       CAST(sum(o_custkey) AS BIGINT) AS cust_sum,
       CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
FROM orders GROUP BY o_orderpriority""",
)
def q_scan_csv(spark, sf):
    root = _staging(spark, "scan_csv")
    _write_orders_csv(spark, sf, root, "orders")
    df = load_tables(spark, root, ["orders"], fmt="csv", columns=_ORDERS_COLS)
    return df.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.sum(F.col("o_custkey").cast("bigint")).cast("bigint").alias("cust_sum"),
        F.sum(F.round(F.col("o_totalprice").cast("double") * 100).cast("bigint")).cast("bigint").alias("cents"),
    )


def _two_sources(spark, sf, fmt="csv"):
    """Two files of one table whose columns differ in order, one lacking a column."""
    root = _staging(spark, "multi")
    o = table(spark, sf, "orders").select(*_ORDERS_COLS)
    even = o.filter("o_orderkey % 2 = 0")
    odd = o.filter("o_orderkey % 2 = 1").select(*reversed(_ORDERS_COLS)).drop("o_orderstatus")
    for name, df in (("even", even), ("odd", odd)):
        df.write.mode("overwrite").option("header", True).format(fmt).save(f"{root}/{name}.{fmt}")
    return root


def _key_stats(df):
    return df.agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.sum(F.col("o_orderkey").cast("bigint")).cast("bigint").alias("key_sum"),
        F.sum(F.col("o_custkey").cast("bigint")).cast("bigint").alias("cust_sum"),
        F.count("o_orderstatus").cast("bigint").alias("n_status"),
        F.count_distinct("o_orderpriority").cast("bigint").alias("n_priority"),
    )


def _key_stats_sql(where: str = "true") -> str:
    return f"""SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(o_orderkey) AS BIGINT) AS key_sum,
       CAST(sum(o_custkey) AS BIGINT) AS cust_sum,
       CAST(count(CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END) AS BIGINT) AS n_status,
       CAST(count(DISTINCT o_orderpriority) AS BIGINT) AS n_priority FROM orders WHERE {where}"""


@query("multi_source_union", _key_stats_sql())
def q_multi_union(spark, sf):
    root = _two_sources(spark, sf)
    return _key_stats(load_tables(spark, root, ["even", "odd"], combine="union", columns=_ORDERS_COLS))


@query("multi_source_parquet", _key_stats_sql())
def q_multi_parquet(spark, sf):
    root = _two_sources(spark, sf, "parquet")
    return _key_stats(load_tables(spark, root, ["even", "odd"], fmt="parquet", combine="union"))


@query("multi_source_last", _key_stats_sql("o_orderkey % 2 = 1"))
def q_multi_last(spark, sf):
    root = _two_sources(spark, sf)
    df = load_tables(spark, root, ["even", "odd"], combine="last")
    return _key_stats(df.withColumn("o_orderstatus", F.lit(None).cast("string")))


# Lines of a staged file that are short, long or broken, by key arithmetic.
_BROKEN_LINE = [
    ("o_orderkey % 7 = 1", "concat_ws(',', o_orderkey, o_custkey)"),
    ("o_orderkey % 11 = 2", "concat_ws(',', o_orderkey, o_custkey, o_orderstatus, 'more')"),
    ("o_orderkey % 13 = 3", "concat_ws(',', o_orderkey, concat('\"', o_custkey), o_orderstatus)"),
]
_IS_BROKEN = "(" + " OR ".join(w for w, _ in _BROKEN_LINE) + ")"


@query(
    "csv_quarantine",
    f"""SELECT CAST(o_orderkey % 4 AS INTEGER) AS part, CAST(count(*) FILTER (NOT {_IS_BROKEN}) AS BIGINT) AS n_good,
       CAST(count(*) FILTER ({_IS_BROKEN}) AS BIGINT) AS n_bad,
       CAST(sum(CASE WHEN NOT {_IS_BROKEN} THEN o_custkey ELSE 0 END) AS BIGINT) AS cust_sum,
       CAST(sum(CASE WHEN {_IS_BROKEN} THEN o_orderkey ELSE 0 END) AS BIGINT) AS bad_keys
FROM orders GROUP BY o_orderkey % 4""",
)
def q_csv_quarantine(spark, sf):
    """Four files with malformed lines: counts per file, the good rows' sums and the bad records'."""
    root = _staging(spark, "quarantine")
    line = "CASE " + " ".join(f"WHEN {w} THEN {e}" for w, e in _BROKEN_LINE) + " ELSE concat_ws(',', o_orderkey, o_custkey, o_orderstatus) END"
    lines = table(spark, sf, "orders").selectExpr("cast(o_orderkey % 4 AS int) AS part", "o_orderkey AS ord", f"{line} AS value")
    heads = spark.range(4).selectExpr("cast(id AS int) AS part", "cast(-1 AS bigint) AS ord", "'o_orderkey,o_custkey,o_orderstatus' AS value")
    staged = lines.unionByName(heads).repartition("part").sortWithinPartitions("part", "ord")
    staged.select("part", "value").write.partitionBy("part").text(root)
    got = read_quarantined(spark, [f"{root}/part={i}" for i in range(4)])
    part = F.regexp_extract("file", "part=([0-9]+)", 1).cast("int").alias("part")
    good = got.good.select((F.col("o_orderkey").cast("bigint") % 4).cast("int").alias("part"), F.col("o_custkey").cast("bigint").alias("cust"))
    bad = got.bad.select(part, F.substring_index("record", ",", 1).cast("bigint").alias("key"))
    sums = good.groupBy("part").agg(F.sum("cust").alias("cust_sum")).join(bad.groupBy("part").agg(F.sum("key").alias("bad_keys")), "part", "full")
    return got.counts.select(part, "n_good", "n_bad").join(sums, "part", "left").select(
        "part", "n_good", "n_bad", F.coalesce("cust_sum", F.lit(0)).cast("bigint").alias("cust_sum"),
        F.coalesce("bad_keys", F.lit(0)).cast("bigint").alias("bad_keys"),
    )


@query(
    "preview_limit",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
ORDER BY l_orderkey, l_linenumber LIMIT 20""",
)
def q_preview(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return preview(li, 20, order_by=["l_orderkey", "l_linenumber"])


_DUCK_TYPES = (
    "CASE WHEN column_type = 'BIGINT' THEN 'bigint' WHEN column_type = 'INTEGER' THEN 'int' "
    "WHEN column_type = 'DOUBLE' THEN 'double' WHEN column_type = 'VARCHAR' THEN 'string' "
    "WHEN column_type LIKE 'TIMESTAMP WITH TIME ZONE%' THEN 'timestamp' "
    "WHEN column_type LIKE 'TIMESTAMP%' THEN 'timestamp_ntz' ELSE lower(column_type) END"
)


@query(
    "schema_report",
    f"""SELECT CAST(row_number() OVER () - 1 AS INTEGER) AS position, column_name AS name,
       {_DUCK_TYPES} AS type, true AS nullable FROM (DESCRIBE lineitem)""",
)
def q_schema_report(spark, sf):
    return schema_report(table(spark, sf, "lineitem"))


# ------------------------------------------------------------ projections ---
@query(
    "drop_columns",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
       l_discount, l_returnflag, l_linestatus FROM lineitem""",
)
def q_drop_columns(spark, sf):
    return clean.drop_columns(table(spark, sf, "lineitem"), ["L_SHIPDATE", "l_tax", "no_such_column"])


# ---------------------------------------------------------------- filters ---
_E = DIRTY_EVENTS


@query(
    "require_columns",
    with_ctes(
        """SELECT event_id, value_txt, cat FROM dirty_events
WHERE value_txt IS NOT NULL AND value_txt NOT IN ('NA', 'None')
  AND cat IS NOT NULL AND cat NOT IN ('NA', 'None')""",
        _E,
    ),
)
def q_require(spark, sf):
    return clean.require_columns(_events(spark, sf), ["value_txt", "cat"], ("NA", "None")).select(
        "event_id", "value_txt", "cat"
    )


@query(
    "drop_missing_target",
    with_ctes("SELECT event_id, value_txt FROM dirty_events WHERE value_txt IS NOT NULL AND value_txt <> 'NA'", _E),
)
def q_drop_missing_target(spark, sf):
    return clean.drop_missing_target(_events(spark, sf), "value_txt").select("event_id", "value_txt")


def _duck_to_int(x: str) -> str:
    return (
        f"CASE WHEN regexp_full_match(trim({x}), '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)') "
        f"THEN CAST(trunc(TRY_CAST(trim({x}) AS DOUBLE)) AS INTEGER) END"
    )


@query(
    "filter_flag_zero",
    with_ctes(f"SELECT event_id, cancelled FROM dirty_events WHERE {_duck_to_int('cancelled')} = 0", _E),
)
def q_filter_flag(spark, sf):
    return clean.filter_flag(_events(spark, sf), "cancelled", 0).select("event_id", "cancelled")


@query(
    "filter_hhmm_range",
    with_ctes("SELECT event_id, hhmm, hhmm2 FROM dirty_events WHERE hhmm <= 2400 AND hhmm2 <= 2400", _E),
)
def q_filter_hhmm(spark, sf):
    return clean.filter_upper(_events(spark, sf), {"hhmm": 2400, "hhmm2": 2400}).select("event_id", "hhmm", "hhmm2")


# ------------------------------------------------------------------ joins ---
_JOIN_COLS = ["l_partkey", "l_orderkey", "l_linenumber", "y", "p_brand", "p_type", "p_size", "issue_date"]
_JOIN_SQL = (
    "SELECT l_partkey, l_orderkey, l_linenumber, round(y, 6) AS y, p_brand, p_type, p_size, issue_date "
    "FROM fact JOIN dim USING (l_partkey)"
)


def _join_out(df):
    return df.select(*[_round(c) if c == "y" else F.col(c) for c in _JOIN_COLS])


@query("dim_join", with_ctes(_JOIN_SQL, FACT, DIM))
def q_dim_join(spark, sf):
    return _join_out(dim_join(_fact(spark, sf), _dim(spark, sf), "l_partkey"))


@query("dim_join_salted", with_ctes(_JOIN_SQL, FACT, DIM))
def q_dim_join_salted(spark, sf):
    # The shuffle path, with a share low enough that the busiest part keys count
    # as hot and are joined apart from the others.
    return _join_out(dim_join(_fact(spark, sf), _dim(spark, sf), "L_PARTKEY", broadcast=False, hot_share=0.0006))


@query("dim_join_bucketed", with_ctes(_JOIN_SQL, FACT, DIM))
def q_dim_join_bucketed(spark, sf):
    """Both tables stored in buckets of the key first; the busiest part keys count as hot."""
    fact = write_bucketed(_fact(spark, sf), "l_partkey", 8, _staging(spark, "fact"), hot_share=0.0006)
    dim = write_bucketed(_dim(spark, sf), "l_partkey", 8, _staging(spark, "dim"), hot_share=1.0)
    return _join_out(bucketed_join(fact, dim))


@query(
    "gated_join",
    with_ctes(
        "SELECT l_partkey, l_orderkey, l_linenumber, round(y, 6) AS y, p_brand, p_type, p_size, issue_date, "
        "true AS included FROM fact JOIN dim USING (l_partkey)",
        FACT,
        DIM,
    ),
)
def q_gated_join(spark, sf):
    df, inc = gated_join(_fact(spark, sf), _dim(spark, sf), "l_partkey")
    return _join_out(df).withColumn("included", F.lit(inc))


@query(
    "gated_join_skip",
    with_ctes(
        "SELECT l_orderkey, l_linenumber, round(y, 6) AS y, l_partkey, false AS included FROM fact_no_key",
        FACT_NO_KEY,
    ),
)
def q_gated_join_skip(spark, sf):
    df, inc = gated_join(FACT_NO_KEY.frame(spark, sf), _dim(spark, sf).withColumn("l_partkey", F.col("l_partkey").cast("string")), "l_partkey")
    return df.select("l_orderkey", "l_linenumber", _round("y"), "l_partkey").withColumn("included", F.lit(inc))


# ------------------------------------------------------------ aggregation ---
@query("group_count", with_ctes("SELECT cat, CAST(count(*) AS BIGINT) AS count FROM dirty_events GROUP BY cat", _E))
def q_group_count(spark, sf):
    return profile.group_count(_events(spark, sf), "cat").withColumn("count", F.col("count").cast("bigint"))


def _per_column_sql(cols, expr) -> str:
    return "\nUNION ALL\n".join(f"SELECT '{c}' AS col_name, {expr.format(c=c)} FROM dirty_events" for c in cols)


_GROUPS = "count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)"


@query("distinct_groups", with_ctes(_per_column_sql(PROFILE_COLS, f"CAST({_GROUPS} AS BIGINT) AS groups"), _E))
def q_distinct_groups(spark, sf):
    return profile.distinct_groups(_events(spark, sf), PROFILE_COLS).withColumnRenamed("column", "col_name")


@query("informative_columns", with_ctes(_per_column_sql(PROFILE_COLS, f"({_GROUPS}) > 1 AS informative"), _E))
def q_informative(spark, sf):
    return profile.informative_columns(_events(spark, sf), PROFILE_COLS).withColumnRenamed("column", "col_name")


@query(
    "drop_constant_columns",
    with_ctes("SELECT event_id, cat, const, const_null, mo FROM dirty_events", _E),
)
def q_drop_constant(spark, sf):
    df = _events(spark, sf).select("event_id", "cat", "const", "const_null", "all_null", "mo")
    out, _, _ = profile.drop_constant_columns(df, exempt=("const",))
    return out


def _duck_corr(a: str, b: str, policy: str) -> str:
    if policy == "zero":
        x, y = f"coalesce(CAST({a} AS DOUBLE), 0.0)", f"coalesce(CAST({b} AS DOUBLE), 0.0)"
    else:
        x, y = f"CAST({a} AS DOUBLE)", f"CAST({b} AS DOUBLE)"
    c = f"corr({y}, {x})"
    return f"SELECT '{a}' AS a, '{b}' AS b, round(CASE WHEN isnan({c}) THEN NULL ELSE {c} END, 6) AS r FROM dirty_events"


def _corr_sql(pairs, policy):
    return with_ctes("\nUNION ALL\n".join(_duck_corr(a, b, policy) for a, b in pairs), _E)


def _corr_out(df):
    return df.select("a", "b", _round("r"))


@query("corr_target", _corr_sql([("amount", c) for c in CORR_COLS], "zero"))
def q_corr_target(spark, sf):
    return _corr_out(profile.corr_target(_events(spark, sf), "amount", CORR_COLS, "zero"))


@query("corr_target_pairwise", _corr_sql([("amount", c) for c in CORR_COLS], "pairwise"))
def q_corr_target_pairwise(spark, sf):
    return _corr_out(profile.corr_target(_events(spark, sf), "amount", CORR_COLS, "pairwise"))


_MATRIX_COLS = ["amount"] + CORR_COLS + ["const_num"]


@query(
    "corr_matrix",
    with_ctes(
        "\nUNION ALL\n".join(
            _duck_corr(a, b, "zero").replace("FROM dirty_events", "FROM (SELECT *, 7 AS const_num FROM dirty_events)")
            for i, a in enumerate(_MATRIX_COLS)
            for b in _MATRIX_COLS[i + 1 :]
        ),
        _E,
    ),
)
def q_corr_matrix(spark, sf):
    df = _events(spark, sf).withColumn("const_num", F.lit(7))
    return _corr_out(profile.corr_matrix(df, _MATRIX_COLS, "zero"))


@query(
    "corr_matrix_pairwise",
    _corr_sql([(a, b) for i, a in enumerate(_MATRIX_COLS[:-1]) for b in _MATRIX_COLS[i + 1 : -1]], "pairwise"),
)
def q_corr_matrix_pairwise(spark, sf):
    return _corr_out(profile.corr_matrix(_events(spark, sf), _MATRIX_COLS[:-1], "pairwise"))


def _wide_columns() -> list[tuple[str, str]]:
    """64 columns: epoch-like ones, sparse flags, ones with NULLs and plain ones."""
    out = []
    for i in range(64):
        if i % 8 == 0:
            e = f"1700000000 + (event_id * {i + 3}) % 1009 + user_id % 50"
        elif i % 4 == 1:
            e = f"CASE WHEN event_id % {i + 11} = 0 THEN 1 ELSE 0 END"
        elif i % 4 == 2:
            e = f"CASE WHEN event_id % {i + 2} = 0 THEN NULL ELSE (event_id * {2 * i + 1}) % 97 END"
        else:
            e = f"(event_id * {i + 7}) % 211 + user_id % {i + 2}"
        out.append((f"c{i}", f"CAST({e} AS BIGINT)"))
    return out


def _wide_sql() -> str:
    names = [c for c, _ in _wide_columns()]
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    cols = ", ".join(f"coalesce(CAST({e} AS DOUBLE), 0.0) AS {c}" for c, e in _wide_columns())
    listed = lambda items: "[" + ", ".join(items) + "]"
    return f"""SELECT unnest({listed([f"'{a}'" for a, _ in pairs])}) AS a, unnest({listed([f"'{b}'" for _, b in pairs])}) AS b,
       unnest({listed([f"round(corr({b}, {a}), 6)" for a, b in pairs])}) AS r FROM (SELECT {cols} FROM events)"""


@query("corr_matrix_wide", _wide_sql())
def q_corr_matrix_wide(spark, sf):
    df = ensure_parallelism(table(spark, sf, "events")).selectExpr(*[f"{e} AS {c}" for c, e in _wide_columns()])
    return _corr_out(profile.corr_matrix(df, [c for c, _ in _wide_columns()], "zero"))


@query("drop_collinear", with_ctes("SELECT l_orderkey, l_linenumber, y, quantity, discount, tax FROM fact", FACT))
def q_drop_collinear(spark, sf):
    # y = price*(1-discount) + 500*quantity: |r(y, price)| is far above 0.9,
    # every other pair is near 0, so the later column of that pair goes.
    df = _fact(spark, sf).select("l_orderkey", "l_linenumber", "y", "price", "quantity", "discount", "tax")
    out, _, _ = profile.drop_collinear(df, threshold=0.9, cols=["y", "price", "quantity", "discount", "tax"])
    return out


@query(
    "impute_mode",
    with_ctes(
        """SELECT event_id,
  coalesce(mo, (SELECT mo FROM dirty_events WHERE mo IS NOT NULL GROUP BY mo ORDER BY count(*) DESC, mo LIMIT 1)) AS mo,
  coalesce(amount, (SELECT amount FROM dirty_events WHERE amount IS NOT NULL GROUP BY amount ORDER BY count(*) DESC, amount LIMIT 1)) AS amount
FROM dirty_events""",
        _E,
    ),
)
def q_impute_mode(spark, sf):
    df, _ = impute(_events(spark, sf).select("event_id", "mo", "amount"), ["mo", "amount"], "mode")
    return df


def _median_sql(c: str) -> str:
    return (
        f"coalesce({c}, (SELECT {c} FROM (SELECT {c}, row_number() OVER (ORDER BY {c}) AS k, count(*) OVER () AS n "
        f"FROM dirty_events WHERE {c} IS NOT NULL) WHERE k = (n + 1) // 2)) AS {c}"
    )


@query(
    "impute_median",
    with_ctes(f"SELECT event_id, {_median_sql('mo')}, {_median_sql('amount')}, {_median_sql('amount2')} FROM dirty_events", _E),
)
def q_impute_median(spark, sf):
    cols = ["mo", "amount", "amount2"]
    return impute(_events(spark, sf).select("event_id", *cols), cols, "median")[0]


@query(
    "impute_mean",
    with_ctes(
        """SELECT event_id,
  coalesce(amount, CAST(trunc((SELECT avg(amount) FROM dirty_events)) AS INTEGER)) AS amount,
  coalesce(amount2, CAST(trunc((SELECT avg(amount2) FROM dirty_events)) AS INTEGER)) AS amount2
FROM dirty_events""",
        _E,
    ),
)
def q_impute_mean(spark, sf):
    df, _ = impute(_events(spark, sf).select("event_id", "amount", "amount2"), ["amount", "amount2"], "mean")
    return df


@query(
    "impute_mean_double",
    with_ctes(
        """SELECT event_id,
  round(coalesce(CAST(amount AS DOUBLE), (SELECT avg(amount) FROM dirty_events)), 6) AS amount
FROM dirty_events""",
        _E,
    ),
)
def q_impute_mean_double(spark, sf):
    df, _ = impute(_events(spark, sf).select("event_id", "amount"), ["amount"], "mean", keep_double=True)
    return df.select("event_id", _round("amount"))


@query(
    "f_regression",
    with_ctes(
        "\nUNION ALL\n".join(
            f"SELECT '{c}' AS feature, round(corr(y, {c}), 6) AS r, "
            f"round(corr(y, {c}) * corr(y, {c}) / (1 - corr(y, {c}) * corr(y, {c})) * (count(*) - 2), 4) AS f, "
            f"CAST(count(*) AS BIGINT) AS n FROM fact"
            for c in FACT_NUMERIC
        ),
        FACT,
    ),
)
def q_f_regression(spark, sf):
    out = profile.f_regression(_fact(spark, sf), "y", FACT_NUMERIC)
    return out.select("feature", _round("r"), F.round("f", 4).alias("f"), "n")


# ------------------------------------------------------- scalar functions ---
@query(
    "cast_numeric",
    with_ctes(
        f"SELECT event_id, {_duck_to_int('value_txt')} AS value_txt, {_duck_to_int('cancelled')} AS cancelled FROM dirty_events",
        _E,
    ),
)
def q_cast_numeric(spark, sf):
    return clean.cast_numeric(_events(spark, sf), ["value_txt", "cancelled"]).select("event_id", "value_txt", "cancelled")


@query(
    "sentinel_to_null",
    with_ctes(
        "SELECT event_id, "
        + ", ".join(f"CASE WHEN {c} = 'NA' THEN NULL ELSE {c} END AS {c}" for c in ("value_txt", "user_na", "cat"))
        + " FROM dirty_events",
        _E,
    ),
)
def q_sentinel(spark, sf):
    return clean.sentinel_to_null(_events(spark, sf), ["value_txt", "user_na", "cat"]).select(
        "event_id", "value_txt", "user_na", "cat"
    )


@query(
    "null_to_unknown",
    with_ctes(
        "SELECT event_id, "
        + ", ".join(
            f"CASE WHEN {c} IS NULL OR {c} IN ('Unknow', 'None', '', ' ') THEN 'unknown' ELSE {c} END AS {c}"
            for c in ("cat", "const_null")
        )
        + " FROM dirty_events",
        _E,
    ),
)
def q_null_to_unknown(spark, sf):
    return clean.null_to_unknown(_events(spark, sf), ["cat", "const_null"]).select("event_id", "cat", "const_null")


def _duck_day_part(x: str) -> str:
    whens = []
    for i, (label, lo, hi) in enumerate(DAY_PARTS):
        op = "<=" if i == len(DAY_PARTS) - 1 else "<"
        whens.append(f"WHEN {x} >= {lo} AND {x} {op} {hi} THEN '{label}'")
    return f"CASE WHEN {x} IS NULL THEN NULL {' '.join(whens)} ELSE '' END"


@query(
    "day_part",
    with_ctes(f"SELECT event_id, hhmm, {_duck_day_part('hhmm')} AS part FROM dirty_events", _E),
)
def q_day_part(spark, sf):
    return _events(spark, sf).select("event_id", "hhmm", day_part("hhmm").alias("part"))


@query(
    "parse_date",
    with_ctes(
        "SELECT l_partkey, issue_date, CAST(CAST(try_strptime(issue_date, '%m/%d/%Y') AS DATE) AS VARCHAR) AS parsed "
        "FROM dim",
        DIM,
    ),
)
def q_parse_date(spark, sf):
    return _dim(spark, sf).select("l_partkey", "issue_date", parse_date("issue_date").cast("string").alias("parsed"))


@query(
    "entity_age",
    with_ctes(
        """SELECT l_orderkey, l_linenumber,
  CAST(CASE WHEN ship_year - year(try_strptime(issue_date, '%m/%d/%Y')) < 0 THEN 0
       ELSE ship_year - year(try_strptime(issue_date, '%m/%d/%Y')) END AS INTEGER) AS part_age
FROM fact JOIN dim USING (l_partkey)""",
        FACT,
        DIM,
    ),
)
def q_entity_age(spark, sf):
    df = dim_join(_fact(spark, sf), _dim(spark, sf), "l_partkey")
    return entity_age(df, "ship_year", "issue_date", "part_age", age_null="keep").select(
        "l_orderkey", "l_linenumber", "part_age"
    )


# --------------------------------------------------------------- features ---
def _duck_rank(c: str) -> str:
    return (
        f"{c}_idx AS (SELECT {c} AS v, row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS i, "
        f"count(*) OVER () AS k FROM fact GROUP BY {c})"
    )


def _rank_ctes() -> str:
    return ",\n".join(_duck_rank(c) for c in FACT_CATEGORICAL)


@query(
    "string_index",
    with_ctes(
        f""", {_rank_ctes()}
SELECT l_orderkey, l_linenumber, CAST(a.i AS DOUBLE) AS o_orderpriorityIndexed, CAST(b.i AS DOUBLE) AS l_returnflagIndexed
FROM fact JOIN o_orderpriority_idx a ON fact.o_orderpriority = a.v JOIN l_returnflag_idx b ON fact.l_returnflag = b.v""",
        FACT,
    ).replace("\n, ", ",\n", 1),
)
def q_string_index(spark, sf):
    df, _ = string_index(_fact(spark, sf), FACT_CATEGORICAL)
    return df.select(*KEYS, "o_orderpriorityIndexed", "l_returnflagIndexed")


@query(
    "string_index_wide",
    """WITH idx AS (SELECT o_custkey, row_number() OVER (ORDER BY count(*) DESC, CAST(o_custkey AS VARCHAR)) - 1 AS i
             FROM orders GROUP BY o_custkey)
SELECT o_orderkey, CAST(i AS DOUBLE) AS customerIndexed FROM orders JOIN idx USING (o_custkey)""",
)
def q_string_index_wide(spark, sf):
    """A column of very many labels, whose dictionary is merged, not broadcast."""
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("customer"))
    return string_index_distributed(orders, ["customer"], broadcast_max_rows=0)[0].drop("customer")


@query(
    "one_hot",
    with_ctes(
        f""", {_rank_ctes()}
SELECT l_orderkey, l_linenumber, 'o_orderpriority' AS col_name, CAST(a.i AS INTEGER) AS slot, CAST(1.0 AS DOUBLE) AS value
FROM fact JOIN o_orderpriority_idx a ON fact.o_orderpriority = a.v WHERE a.i < a.k - 1
UNION ALL
SELECT l_orderkey, l_linenumber, 'l_returnflag' AS col_name, CAST(b.i AS INTEGER) AS slot, CAST(1.0 AS DOUBLE) AS value
FROM fact JOIN l_returnflag_idx b ON fact.l_returnflag = b.v WHERE b.i < b.k - 1""",
        FACT,
    ).replace("\n, ", ",\n", 1),
)
def q_one_hot(spark, sf):
    df, _ = one_hot(_fact(spark, sf), FACT_CATEGORICAL)
    # One pass for all columns: a union of them would join the rows once for each.
    encoded = [F.struct(F.lit(c).alias("col_name"), vector_to_array(F.col(f"{c}Cat")).alias("slots")) for c in FACT_CATEGORICAL]
    rows = df.select(*KEYS, F.inline(F.array(*encoded))).select(*KEYS, "col_name", F.posexplode("slots").alias("slot", "value"))
    rows = rows.filter(F.col("value") != 0)
    return rows.select(*KEYS, "col_name", F.col("slot").cast("int").alias("slot"), F.round("value", 6).alias("value"))


def _slots_sql(value_expr: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT l_orderkey, l_linenumber, {i} AS slot, round({value_expr.format(c=c)}, 6) AS value FROM fact"
        for i, c in enumerate(FACT_NUMERIC)
    )


@query("assemble", with_ctes(_slots_sql("{c}"), FACT))
def q_assemble(spark, sf):
    return _explode_vec(assemble(_fact(spark, sf), FACT_NUMERIC), "features", KEYS)


_L1 = " + ".join(f"abs({c})" for c in FACT_NUMERIC)


@query("l1_normalize", with_ctes(_slots_sql(f"CASE WHEN ({_L1}) = 0 THEN 0.0 ELSE {{c}} / ({_L1}) END"), FACT))
def q_l1_normalize(spark, sf):
    df = l1_normalize(assemble(_fact(spark, sf), FACT_NUMERIC), "features", "normFeatures")
    return _explode_vec(df, "normFeatures", KEYS)


def _pipeline_sql() -> str:
    """Oracle of the whole pipeline: numeric slots then one-hot slots, each
    divided by the row's L1 norm; only non-zero slots are listed."""
    n = len(FACT_NUMERIC)
    num = " + ".join(f"abs({c})" for c in FACT_NUMERIC)
    norm = f"({num} + CASE WHEN a.i < a.k - 1 THEN 1 ELSE 0 END + CASE WHEN b.i < b.k - 1 THEN 1 ELSE 0 END)"
    base = (
        "FROM fact JOIN o_orderpriority_idx a ON fact.o_orderpriority = a.v "
        "JOIN l_returnflag_idx b ON fact.l_returnflag = b.v"
    )
    parts = [
        f"SELECT l_orderkey, l_linenumber, {i} AS slot, round({c} / {norm}, 6) AS value {base} WHERE {c} <> 0"
        for i, c in enumerate(FACT_NUMERIC)
    ]
    parts.append(
        f"SELECT l_orderkey, l_linenumber, CAST({n} + a.i AS INTEGER) AS slot, round(1.0 / {norm}, 6) AS value {base} WHERE a.i < a.k - 1"
    )
    parts.append(
        f"SELECT l_orderkey, l_linenumber, CAST({n} + a.k - 1 + b.i AS INTEGER) AS slot, round(1.0 / {norm}, 6) AS value "
        f"{base} WHERE b.i < b.k - 1"
    )
    return with_ctes(f", {_rank_ctes()}\n" + "\nUNION ALL\n".join(parts), FACT).replace("\n, ", ",\n", 1)


@query("feature_pipeline", _pipeline_sql())
def q_feature_pipeline(spark, sf):
    return _explode_vec(_fact_features(spark, sf), "normFeatures", KEYS, nonzero=True)


@query(
    "feature_count",
    with_ctes(
        f"SELECT CAST({len(FACT_NUMERIC)} + (SELECT count(DISTINCT o_orderpriority) FROM fact) - 1 "
        "+ (SELECT count(DISTINCT l_returnflag) FROM fact) - 1 AS BIGINT) AS n_features",
        FACT,
    ),
)
def q_feature_count(spark, sf):
    feats = _fact_features(spark, sf)
    n = feature_count(feats, "normFeatures")
    # The metadata's number, held against the vectors of all rows.
    size = F.size(vector_to_array(F.col("normFeatures")))
    return feats.agg(F.max(F.when(size == n, F.lit(n))).cast("bigint").alias("n_features"))


# Slots of the selection report: four real columns and noise, the first of which passes
# the false-discovery limit at sf0.01 but not the family-wise one.
_NOISE = [
    (f"noise{i}", f"(l_orderkey * {m} + l_linenumber * {k}) % {p}")
    for i, (m, k, p) in enumerate(((13, 5, 957), (31, 17, 503), (101, 7, 997), (13, 29, 241), (71, 3, 89), (19, 5, 61)))
]
_SLOTS = FACT_NUMERIC + [n for n, _ in _NOISE]
SELECTION_ALPHA = 0.05
# Categories of the two encoded columns, as the driver's tables have them.
_N_PRIORITIES, _N_FLAGS = 5, 3


def _chosen_ctes(mode: str, source: str, slots: list[str]) -> str:
    """CTEs that end in ``ranked`` (slot, f, rank, ok) and the predicate of a chosen slot: F of every
    slot from its correlation; the p-value limits alpha * j / k as limits of F (Student's t
    quantiles from normal ones, expanded in 1/n)."""
    k = len(slots)
    z = [NormalDist().inv_cdf(1 - SELECTION_ALPHA * j / k / 2) for j in range(1, k + 1)]
    limits = ", ".join(f"({j}, {v!r}::DOUBLE)" for j, v in enumerate(z, 1))
    scores = "\nUNION ALL\n".join(f"SELECT {i} AS slot, corr(y, {c}) AS r, count(*) - 2 AS df FROM {source}" for i, c in enumerate(slots))
    chosen = "rank <= coalesce((SELECT max(rank) FROM ranked WHERE ok), 0)" if mode == "fdr" else "f > (SELECT lim FROM lims WHERE j = 1)"
    return f"""slots AS ({scores}),
scored AS (SELECT slot, r * r / (1 - r * r) * df AS f, df FROM slots),
lims AS (SELECT j, pow(z + (pow(z, 3) + z) / (4 * df) + (5 * pow(z, 5) + 16 * pow(z, 3) + 3 * z) / (96 * df * df), 2) AS lim
         FROM (VALUES {limits}) v(j, z), (SELECT DISTINCT df FROM scored)),
ranked AS (SELECT slot, f, rank, f >= lim AS ok
           FROM (SELECT *, row_number() OVER (ORDER BY f DESC) AS rank FROM scored) JOIN lims ON rank = j),
chosen AS (SELECT slot, f, {chosen} AS selected FROM ranked)"""


def _selection_sql(mode: str) -> str:
    noise = ", ".join(f"CAST({e} AS DOUBLE) AS {n}" for n, e in _NOISE)
    return with_ctes(
        f""", fact_noise AS (SELECT *, {noise} FROM fact),
{_chosen_ctes(mode, "fact_noise", _SLOTS)}
SELECT CAST(slot AS INTEGER) AS slot, round(f, 3) AS f, selected FROM chosen""",
        FACT,
    ).replace("\n, ", ",\n", 1)


def _selected_vectors_sql(mode: str) -> str:
    """The pipeline's slots (four numeric ones, then the one-hot ones but each column's last),
    and of them the chosen ones, numbered anew."""
    norm = " + ".join(f"abs({c})" for c in FACT_NUMERIC)
    hot = [("a", i) for i in range(_N_PRIORITIES - 1)] + [("b", i) for i in range(_N_FLAGS - 1)]
    norm += f" + CASE WHEN a.i < {_N_PRIORITIES - 1} THEN 1 ELSE 0 END + CASE WHEN b.i < {_N_FLAGS - 1} THEN 1 ELSE 0 END"
    values = [f"CAST({c} AS DOUBLE) / ({norm})" for c in FACT_NUMERIC] + [f"CASE WHEN {t}.i = {i} THEN 1.0 / ({norm}) ELSE 0.0 END" for t, i in hot]
    names = [f"s{i}" for i in range(len(values))]
    long = "\nUNION ALL\n".join(f"SELECT l_orderkey, l_linenumber, {i} AS slot, {c} AS value FROM vecs WHERE {c} <> 0" for i, c in enumerate(names))
    return with_ctes(
        f""", {_rank_ctes()},
vecs AS (SELECT l_orderkey, l_linenumber, y, {", ".join(f"{v} AS {n}" for v, n in zip(values, names))}
         FROM fact JOIN o_orderpriority_idx a ON fact.o_orderpriority = a.v JOIN l_returnflag_idx b ON fact.l_returnflag = b.v),
{_chosen_ctes(mode, "vecs", names)},
numbered AS (SELECT slot, row_number() OVER (ORDER BY slot) - 1 AS place FROM chosen WHERE selected),
long AS ({long})
SELECT l_orderkey, l_linenumber, CAST(place AS INTEGER) AS slot, round(value, 6) AS value FROM long JOIN numbered USING (slot)""",
        FACT,
    ).replace("\n, ", ",\n", 1)


def _selection_report(spark, sf, mode):
    noisy = _fact(spark, sf).selectExpr("*", *[f"CAST({e} AS DOUBLE) AS {n}" for n, e in _NOISE])
    feats, _, _ = build_features(noisy, _SLOTS, [], "y", normalize=None, features_col="features")
    report = selection_report(materialize(feats), "features", "y", mode, SELECTION_ALPHA)
    return report.select("slot", F.round("f", 3).alias("f"), "selected")


@query("select_fdr", _selection_sql("fdr"))
def q_select_fdr(spark, sf):
    return _selection_report(spark, sf, "fdr")


@query("select_fwe", _selection_sql("fwe"))
def q_select_fwe(spark, sf):
    return _selection_report(spark, sf, "fwe")


def _selected(spark, sf, mode):
    feats = _fact_features(spark, sf)
    df, picked, _ = select_features(feats, "normFeatures", "y", mode)
    return _explode_vec(df, "selectedFeatures", KEYS, nonzero=True)


@query("select_fdr_vectors", _selected_vectors_sql("fdr"))
def q_select_fdr_vectors(spark, sf):
    return _selected(spark, sf, "fdr")


@query("select_fwe_vectors", _selected_vectors_sql("fwe"))
def q_select_fwe_vectors(spark, sf):
    return _selected(spark, sf, "fwe")


# ----------------------------------------------------------------- models ---
_SPLIT_BUCKET = "(('0x' || substr(md5(concat_ws('#', CAST(o_orderkey AS VARCHAR), '10')), 1, 8))::BIGINT % 1000)"


@query("hash_split", f"SELECT o_orderkey, {_SPLIT_BUCKET} < 700 AS is_train FROM orders")
def q_hash_split(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey")
    train, test = hash_split(o, ["o_orderkey"], 0.7, 10)
    return train.withColumn("is_train", F.lit(True)).unionByName(test.withColumn("is_train", F.lit(False)))


@query(
    "random_split",
    "SELECT CAST(count(*) AS BIGINT) AS n, true AS both_sides, CAST(count(*) AS BIGINT) AS n_keys FROM orders",
)
def q_random_split(spark, sf):
    o = materialize(table(spark, sf, "orders").select("o_orderkey"))
    train, test = random_split(o)
    sides = train.withColumn("side", F.lit(1)).unionByName(test.withColumn("side", F.lit(2)))
    return sides.agg(
        F.count(F.lit(1)).alias("n"), (F.count_distinct("side") == 2).alias("both_sides"),
        F.count_distinct("o_orderkey").alias("n_keys"),
    )


@query(
    "linreg_ols",
    with_ctes(
        "SELECT round(regr_slope(y, quantity), 4) AS slope, round(regr_intercept(y, quantity), 4) AS intercept FROM fact",
        FACT,
    ),
)
def q_linreg_ols(spark, sf):
    with Scratch() as scratch:
        # The fit asks for the rows' partitions before it reads them, which runs a join twice.
        rows = materialize(_fact(spark, sf).select("y", "quantity"), scratch=scratch)
        m = estimator("linear", "x", "y", solver="normal", regParam=0.0).fit(assemble(rows, ["quantity"], "x"))
    # The model's own predictions at two points give its line.
    line = m.transform(assemble(spark.createDataFrame([(0.0,), (1.0,)], "quantity double"), ["quantity"], "x"))
    p = F.col("predictionLR")
    return line.agg(
        F.round(F.max(F.when(F.col("quantity") == 1, p)) - F.max(F.when(F.col("quantity") == 0, p)), 4).alias("slope"),
        F.round(F.max(F.when(F.col("quantity") == 0, p)), 4).alias("intercept"),
    )


@query(
    "eval_rmse",
    with_ctes("SELECT round(sqrt(avg((y - 1000 * quantity) * (y - 1000 * quantity))), 4) AS rmse FROM fact", FACT),
)
def q_eval_rmse(spark, sf):
    df = _fact(spark, sf).withColumn("pred", F.col("quantity") * 1000)
    return evaluate(df, "y", "pred").select(F.round("rmse", 4).alias("rmse"))


@query(
    "eval_r2",
    with_ctes(
        "SELECT round(1 - sum((y - 1000 * quantity) * (y - 1000 * quantity)) / (count(*) * var_pop(y)), 6) AS r2 FROM fact",
        FACT,
    ),
)
def q_eval_r2(spark, sf):
    df = _fact(spark, sf).withColumn("pred", F.col("quantity") * 1000)
    return evaluate(df, "y", "pred").select(F.round("r2", 6).alias("r2"))


def _cv_predictions(spark, sf, kind):
    feats = _fact_features(spark, sf)
    train, test = hash_split(feats, KEYS, 0.7, 10)
    train = add_fold_column(train, KEYS, 5, 10)
    pred_col = PREDICTION_COLS[kind]
    model = fit_cv(train, kind, "normFeatures", "y", folds=5, seed=10, fold_col="fold")
    return model, model.transform(test).select(*KEYS, "y", F.col(pred_col).alias("prediction"))


@query("linreg_cv")
def q_linreg_cv(spark, sf):
    return _cv_predictions(spark, sf, "linear")[1]


@query("dtree_cv")
def q_dtree_cv(spark, sf):
    return _cv_predictions(spark, sf, "tree")[1]


@query("rforest_cv")
def q_rforest_cv(spark, sf):
    return _cv_predictions(spark, sf, "forest")[1]


# One feature, whose models have a closed form: least squares, and the tree of one cut
# (of one tree without resampling, the forest is that tree).
_SIMPLE = {
    "linear": {"grid": {"regParam": [0.0]}, "solver": "normal"},
    "tree": {"maxDepth": 1, "maxBins": 64},
    "forest": {"maxDepth": 1, "maxBins": 64, "numTrees": 1, "bootstrap": False, "featureSubsetStrategy": "all"},
}
_FOLD = "(('0x' || substr(md5(concat_ws('#', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), 'fold10')), 1, 8))::BIGINT % 5)"
_SIDE = "(('0x' || substr(md5(concat_ws('#', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), '10')), 1, 8))::BIGINT % 1000)"
# The rows with their fold; ``hold`` 0..4 leaves that fold out, 5 leaves the test side out.
_SIDES_CTE = f"""sides AS (SELECT l_orderkey, l_linenumber, y, quantity, CASE WHEN {_SIDE} < 700 THEN CAST({_FOLD} AS INTEGER) ELSE 5 END AS fold FROM fact),
holds AS (SELECT h AS hold, y, quantity FROM sides, (SELECT unnest(range(6)) AS h) WHERE fold < 5 AND fold <> h),
line AS (SELECT hold, regr_slope(y, quantity) AS a, regr_intercept(y, quantity) AS b FROM holds GROUP BY hold),
vals AS (SELECT hold, quantity, count(*) AS n, sum(y) AS s FROM holds GROUP BY hold, quantity),
cuts AS (SELECT hold, quantity, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(n) OVER (PARTITION BY hold) AS nt,
                sum(s) OVER (PARTITION BY hold) AS st FROM vals WINDOW w AS (PARTITION BY hold ORDER BY quantity)),
best AS (SELECT hold, arg_max(quantity, g) AS cut, arg_max(sl / nl, g) AS low, arg_max((st - sl) / (nt - nl), g) AS high
         FROM (SELECT *, sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) AS g FROM cuts WHERE nl < nt) GROUP BY hold)"""
_LINE = "a * quantity + b"
_STUMP = "CASE WHEN quantity <= cut THEN low ELSE high END"


def _simple_sql(select: str) -> str:
    return with_ctes(f", {_SIDES_CTE}\n{select}", FACT).replace("\n, ", ",\n", 1)


def _folds_sql(model: str, predicted: str) -> str:
    return _simple_sql(
        f"SELECT fold, round(sqrt(avg(pow(y - ({predicted}), 2))), 4) AS rmse FROM sides JOIN {model} ON fold = hold "
        "WHERE fold < 5 GROUP BY fold"
    )


def _simple_cv(spark, sf, kind, **options):
    df = assemble(_fact(spark, sf).select(*KEYS, "y", "quantity"), ["quantity"], "x")
    train, test = hash_split(df, KEYS, 0.7, 10)
    train = add_fold_column(train, KEYS, 5, 10)
    return fit_cv(train, kind, "x", "y", folds=5, seed=10, fold_col="fold", **(_SIMPLE[kind] | options)), test


def _fold_rows(spark, sf, kind):
    model, _ = _simple_cv(spark, sf, kind)
    rows = [(i, v) for i, v in enumerate(model.foldMetrics)]
    return spark.createDataFrame(rows, "fold int, rmse double").select("fold", _round("rmse", 4))


@query("linreg_cv_folds", _folds_sql("line", _LINE))
def q_linreg_cv_folds(spark, sf):
    return _fold_rows(spark, sf, "linear")


@query("dtree_cv_folds", _folds_sql("best", _STUMP))
def q_dtree_cv_folds(spark, sf):
    return _fold_rows(spark, sf, "tree")


@query("rforest_cv_folds", _folds_sql("best", _STUMP))
def q_rforest_cv_folds(spark, sf):
    return _fold_rows(spark, sf, "forest")


@query(
    "best_params",
    "SELECT * FROM (VALUES ('elasticNetParam', '0.25'), ('maxIter', '10'), ('regParam', '0.01')) t(param, value)",
)
def q_best_params(spark, sf):
    """Of a strong and the original penalty the original wins."""
    grid = LINEAR_GRID | {"regParam": [1e6, *LINEAR_GRID["regParam"]]}
    model, _ = _simple_cv(spark, sf, "linear", grid=grid, solver="auto")
    return best_params(model, spark).where(F.col("param").isin(*LINEAR_GRID))


@query(
    "predictions_sample",
    _simple_sql(
        f"SELECT round(y, 4) AS y, round({_LINE}, 4) AS prediction FROM sides JOIN line ON hold = 5 WHERE fold = 5 "
        "ORDER BY l_orderkey, l_linenumber LIMIT 10"
    ),
)
def q_predictions_sample(spark, sf):
    model, test = _simple_cv(spark, sf, "linear")
    sample = predictions_sample(model.transform(test), "y", "predictionLR", 10, order_by=KEYS)
    return sample.select(_round("y", 4), F.round("predictionLR", 4).alias("prediction"))


@query("model_summary")
def q_model_summary(spark, sf):
    """The comparison report of the three cross-validated models, each on all features and with the
    original parameters, one aggregate over one test frame."""
    fact = _fact(spark, sf)
    with Scratch() as scratch:
        # Joined once: the features of both sides are narrow steps over the stored rows.
        rows = materialize(fact.select(*clean.present(fact, [*KEYS, "y", *FACT_NUMERIC, *FACT_CATEGORICAL])), scratch=scratch)
        feats, _, _ = build_features(
            ensure_parallelism(rows), FACT_NUMERIC, FACT_CATEGORICAL, "y", normalize=None, features_col=FEATURES_COL, keep=KEYS
        )
        train, scored = hash_split(feats, KEYS, 0.7, 10)
        train = cv_table(add_fold_column(train, KEYS, 5, 10), [FEATURES_COL], "y", "fold", scratch=scratch)
        columns = []
        for kind in MODEL_KINDS:
            model = fit_cv(train, kind, FEATURES_COL, "y", folds=5, seed=10, fold_col="fold", materialize_how="none")
            scored = model.transform(scored)
            columns.append((kind, FEATURES_COL, PREDICTION_COLS[kind]))
        report = evaluate_many(scored, "y", columns).select("model", "selection", _round("rmse", 4), _round("r2"), "n")
        return spark.createDataFrame(report.collect(), report.schema)


# ------------------------------------------------------------- end to end ---
def _prepared_sql() -> str:
    """The prepared flagship table in SQL, step by step."""
    ints = ["dep_hhmm", "arr_hhmm", "quantity", "price", "discount_pct", "tax_pct", "ship_year", "ship_month", "ship_day", "ship_dow"]
    cats = ["o_orderpriority", "l_returnflag", "l_linestatus", "p_brand", "p_type", "p_size"]
    fill = lambda c: f"CASE WHEN {c} IS NULL OR {c} IN ('Unknow', 'None', '', ' ') THEN 'unknown' ELSE {c} END"
    mean = lambda c: f"coalesce({c}, CAST(trunc((SELECT avg({c}) FROM j)) AS INTEGER)) AS {c}"
    mode = lambda c: (
        f"coalesce({c}, (SELECT {c} FROM j WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)) AS {c}"
    )
    issued = "year(try_strptime(issue_date, '%m/%d/%Y'))"
    return with_ctes(
        f""", j AS (
  SELECT l_orderkey, l_linenumber, {_duck_to_int("y")} AS y, {", ".join(f"{_duck_to_int(c)} AS {c}" for c in ints)},
         {", ".join(f"CASE WHEN {c} = 'NA' THEN NULL ELSE {c} END AS {c}" for c in cats)}, issue_date
  FROM raw_fact JOIN raw_dim USING (l_partkey)
  WHERE y IS NOT NULL AND y <> 'NA' AND {_duck_to_int("y")} IS NOT NULL AND {_duck_to_int("cancelled")} = 0
    AND issue_date IS NOT NULL AND issue_date NOT IN ('None', 'NA') AND p_brand IS NOT NULL AND p_type IS NOT NULL AND p_size IS NOT NULL
), filled AS (
  SELECT l_orderkey, l_linenumber, y, {", ".join(mean(c) for c in ints[:6])}, {", ".join(mode(c) for c in ints[6:])},
         {", ".join(f"{fill(c)} AS {c}" for c in cats)}, issue_date FROM j
)
SELECT l_orderkey, l_linenumber, y, {", ".join(ints[2:])}, {", ".join(cats)},
       CAST(greatest(ship_year - {issued}, 0) AS INTEGER) AS part_age,
       {", ".join(f"{_duck_day_part(c)} AS {c}" for c in ints[:2])}
FROM filled WHERE {issued} IS NOT NULL AND dep_hhmm <= 2400 AND arr_hhmm <= 2400""",
        RAW_FACT,
        RAW_DIM,
    ).replace("\n, ", ",\n", 1)


def _prepared(spark, sf):
    from tessera.plans.flagship import FLAGSHIP_SPEC
    from tessera.plans.run import prepare

    return prepare(RAW_FACT.frame(spark, sf), RAW_DIM.frame(spark, sf), FLAGSHIP_SPEC)


@query("prepare", _prepared_sql())
def q_prepare(spark, sf):
    return _prepared(spark, sf).df


_ROLES = [("numeric", c) for c in ("quantity", "price", "discount_pct", "tax_pct", "part_age", "ship_year", "ship_month", "ship_day", "ship_dow")]
_ROLES += [("categorical", c) for c in ("dep_hhmm", "arr_hhmm", "o_orderpriority", "l_returnflag", "l_linestatus", "p_brand", "p_type", "p_size")]


@query("derive_roles", "SELECT * FROM (VALUES " + ", ".join(f"('{r}', '{c}')" for r, c in _ROLES) + ") t(role, col_name)")
def q_derive_roles(spark, sf):
    prep = _prepared(spark, sf)
    numeric, categorical = derive_roles(prep.df.columns, prep.spec)
    return spark.createDataFrame(
        [("numeric", c) for c in numeric] + [("categorical", c) for c in categorical], "role string, col_name string"
    )


@query("flagship")
def q_flagship(spark, sf):
    from tessera.plans.flagship import flagship_summary

    return flagship_summary(spark, sf)


@query("flagship_parity")
def q_flagship_parity(spark, sf):
    """The original experiment: every model on all normalised features, so that the
    rows of the two selections are equal."""
    from tessera.plans.flagship import flagship_summary

    return flagship_summary(spark, sf, features="normFeatures")


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
