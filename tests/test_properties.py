"""Property tests on random frames (hypothesis): one-pass profiles equal their
definitions, casts equal a model of the legacy cast, results do not depend on
partitioning."""

import math
import re

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import day_part, to_int
from tessera.operators import profile
from tessera.operators.models import hash_split

SETTINGS = settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
small_text = st.one_of(st.none(), st.sampled_from(["a", "b", "NA", "", " ", "None"]))


@SETTINGS
@given(st.lists(st.tuples(small_text, st.one_of(st.none(), st.integers(-3, 3))), max_size=12))
def test_informative_equals_more_than_one_group(spark, rows):
    df = spark.createDataFrame(rows, "s string, i int")
    inf = {r["column"]: r["informative"] for r in profile.informative_columns(df).collect()}
    for c, idx in (("s", 0), ("i", 1)):
        groups = len({r[idx] for r in rows})  # NULL is a group
        assert inf[c] == (groups > 1)


_LEGACY = re.compile(r"^[+-]?(\d+\.?\d*|\.\d+)$")


def _legacy_int(s):
    if s is None or not _LEGACY.match(s.strip()):
        return None
    v = math.trunc(float(s.strip()))
    return v if -(2**31) <= v < 2**31 else None


numeric_text = st.one_of(
    st.none(),
    st.from_regex(r"\A[ ]?[+-]?[0-9]{0,6}(\.[0-9]{0,3})?[ ]?\Z", fullmatch=True),
    st.sampled_from(["NA", "1e3", "abc", "NaN", "Infinity", "--1", "1.2.3", "99999999999"]),
)


@SETTINGS
@given(st.lists(numeric_text, min_size=1, max_size=15))
def test_to_int_matches_legacy_cast_model(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = [r[0] for r in df.select(to_int("x")).collect()]
    assert got == [_legacy_int(v) for v in values]


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(-100, 2600)), min_size=1, max_size=20))
def test_day_part_total_function(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x int")
    got = [r[0] for r in df.select(day_part("x")).collect()]
    for v, g in zip(values, got):
        if v is None:
            assert g is None
        elif v < 0 or v > 2400:
            assert g == ""
        else:
            assert g != ""


@SETTINGS
@given(
    st.lists(
        st.tuples(st.one_of(st.none(), st.integers(-50, 50)), st.one_of(st.none(), st.integers(-50, 50))),
        min_size=3,
        max_size=25,
    )
)
def test_corr_zero_policy_matches_numpy(spark, rows):
    df = spark.createDataFrame(rows, "a int, b int")
    r = profile.corr_matrix(df, ["a", "b"], "zero").first()["r"]
    x = np.array([0.0 if a is None else a for a, _ in rows])
    y = np.array([0.0 if b is None else b for _, b in rows])
    if x.std() == 0 or y.std() == 0:
        assert r is None
    else:
        assert math.isclose(r, float(np.corrcoef(x, y)[0, 1]), rel_tol=1e-9, abs_tol=1e-12)


def test_profiles_and_split_do_not_depend_on_partitioning(spark):
    df = spark.range(3000).select(
        F.col("id").alias("k"),
        F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 13).alias("a"),
        ((F.col("id") * 31) % 17).alias("b"),
    )
    for other in (df.repartition(5), df.coalesce(1), df.repartition(11, "b")):
        r1 = profile.corr_matrix(df, ["a", "b"]).first()["r"]
        r2 = profile.corr_matrix(other, ["a", "b"]).first()["r"]
        assert math.isclose(r1, r2, rel_tol=1e-9)  # equal up to the order of floating-point merges
        assert sorted(profile.informative_columns(df).collect()) == sorted(profile.informative_columns(other).collect())
        assert {r.k for r in hash_split(df, ["k"])[0].collect()} == {r.k for r in hash_split(other, ["k"])[0].collect()}
