"""README's example on tables of the original's shape: 29 flight columns and the plane
columns, all text as a header CSV reads them."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tessera.plans.run import prepare, run
from tessera.spec import TableSpec, derive_roles

FLIGHTS = (
    "Year Month DayofMonth DayOfWeek DepTime CRSDepTime ArrTime CRSArrTime UniqueCarrier FlightNum TailNum ActualElapsedTime"
    " CRSElapsedTime AirTime ArrDelay DepDelay Origin Dest Distance TaxiIn TaxiOut Cancelled CancellationCode Diverted"
    " CarrierDelay WeatherDelay NASDelay SecurityDelay LateAircraftDelay"
).split()

SPEC = TableSpec(
    target="ArrDelay",
    numeric_mean=("DepTime", "CRSDepTime", "CRSArrTime", "CRSElapsedTime", "DepDelay", "Distance", "TaxiOut"),
    numeric_mode=("Year", "Month", "DayofMonth", "DayOfWeek"),
    categorical=("Origin", "Dest"),
    leak=("ArrTime", "ActualElapsedTime", "AirTime", "TaxiIn", "Diverted", "CarrierDelay", "WeatherDelay", "NASDelay",
          "SecurityDelay", "LateAircraftDelay"),
    ids=("UniqueCarrier", "FlightNum"),
    flag="Cancelled",
    flag_drop=("CancellationCode",),
    join_key="TailNum",
    dim_drop=("year", "status"),
    dim_required=("type", "manufacturer", "model", "aircraft_type", "engine_type"),
    dim_categorical=("type", "manufacturer", "model", "aircraft_type", "engine_type"),
    date_col="issue_date",
    age_year_col="Year",
    age_col="PlaneAge",
    hhmm_cols=("DepTime", "CRSArrTime"),
    exempt_constant=("Year",),
    collinear=("CRSDepTime", "CRSElapsedTime"),
    key_cols=("Year", "Month", "DayofMonth", "UniqueCarrier", "FlightNum", "Origin"),
)


def clock(n):
    return str(n // 60 % 24 * 100 + n % 60)


@pytest.fixture(scope="module")
def tables(spark):
    rows = []
    for i in range(1500):
        dep, delay, dist = i * 37 % 1440, i * 7 % 50 - 10, 100 + i * 13 % 2000
        r = dict.fromkeys(FLIGHTS, "0")
        r |= {
            "Year": "2007", "Month": str(1 + i % 12), "DayofMonth": str(1 + i % 28), "DayOfWeek": str(1 + i % 7),
            "DepTime": "NA" if i % 50 == 0 else clock(dep + delay), "CRSDepTime": clock(dep), "CRSArrTime": clock(dep + dist // 8),
            "UniqueCarrier": ["WN", "AA", "XE"][i % 3], "FlightNum": str(i), "TailNum": f"N{i % 40}" if i % 33 else "NA",
            "CRSElapsedTime": str(dist // 8), "ArrDelay": "NA" if i % 91 == 0 else str(2 * delay + i % 5), "DepDelay": str(delay),
            "Origin": ["SFO", "JFK", "ORD", "LAX"][i % 4], "Dest": ["BOS", "SEA", "DEN"][i * 7 % 3], "Distance": str(dist),
            "TaxiOut": str(5 + i % 20), "Cancelled": "1" if i % 77 == 0 else "0",
        }
        rows.append(tuple(r[c] for c in FLIGHTS))
    planes = [
        (f"N{i}", "Corporation", ["BOEING", "AIRBUS"][i % 2], f"M{i % 5}", "None" if i % 19 == 0 else f"{1 + i % 12}/{1 + i % 28}/{1990 + i % 15}",
         "Valid", "Fixed", ["Jet", "Prop"][i % 2], str(1990 + i % 15))
        for i in range(40)
    ]
    return (
        spark.createDataFrame(rows, ", ".join(f"{c} string" for c in FLIGHTS)),
        spark.createDataFrame(planes, "tailnum string, type string, manufacturer string, model string, issue_date string,"
                                      " status string, aircraft_type string, engine_type string, year string"),
    )


@pytest.mark.parametrize("features", ["selected", "normFeatures"])
def test_example_of_the_readme(spark, tables, features):
    with run(*tables, SPEC, features=features, folds=2, on_empty="all") as report:
        rows = {(r.model, r.selection): r for r in report.summary.collect()}
        assert len(rows) == 6 and all(r.n > 100 and r.rmse >= 0 for r in rows.values())
        assert rows["linear", "fdr"].r2 > 0.5 or features == "normFeatures"
        sample = report.predictions["linear_fdr"]
        assert sample.columns == [*SPEC.key_cols, "ArrDelay", "predictionLR"]  # ids too
        if features == "normFeatures":
            assert all(rows[m, "fdr"].rmse == rows[m, "fwe"].rmse for m in ("linear", "tree", "forest"))


def roles(tables, spec):
    prep = prepare(*tables, spec)
    return prep, derive_roles(prep.df.columns, prep.spec)


def test_roles_are_the_original_ones(spark, tables):
    prep, (numeric, categorical) = roles(tables, SPEC)
    assert prep.included and prep.collinear_dropped == ["CRSDepTime", "CRSElapsedTime"]
    assert numeric == ["DepDelay", "Distance", "TaxiOut", "PlaneAge", "Year", "Month", "DayofMonth", "DayOfWeek"]
    # Origin is a key and a feature; single-valued plane columns are gone.
    assert sorted(categorical) == sorted(["DepTime", "CRSArrTime", "Origin", "Dest", "manufacturer", "model", "engine_type"])


def test_misspelt_case_changes_nothing(spark, tables):
    odd = replace(
        SPEC, target="arrdelay", numeric_mean=tuple(c.upper() for c in SPEC.numeric_mean), hhmm_cols=("deptime", "crsarrtime"),
        collinear=("crsdeptime", "CRSELAPSEDTIME"), join_key="tailnum", key_cols=tuple(c.lower() for c in SPEC.key_cols),
        categorical=("ORIGIN", "dest"), date_col="ISSUE_DATE", age_year_col="year",
    )
    (a, roles_a), (b, roles_b) = roles(tables, SPEC), roles(tables, odd)
    assert roles_a == roles_b and "ArrDelay" not in roles_b[0] + roles_b[1]
    assert a.df.columns == b.df.columns and a.df.exceptAll(b.df).count() == 0


def test_without_a_key_the_split_is_random(spark, tables):
    with run(*tables, replace(SPEC, key_cols=()), kinds=("linear",), folds=2, on_empty="all") as report:
        n = report.summary.first()["n"]
        assert 0.2 < n / report.prep.df.count() < 0.4


def test_train_rows_are_the_same_at_every_stage(spark, tables):
    """Keys are hashed as they come, though later steps cast and impute them."""
    fact, dim = tables
    odd = fact.withColumn("Month", F.when(F.col("FlightNum") % 3 == 0, F.concat(F.lit("0"), "Month")).otherwise(F.col("Month")))
    with run(odd, dim, SPEC, kinds=("linear",), folds=2, fit_on="train", on_empty="all") as report:
        carried = report.prep.df
        from tessera.functions import hash_bucket
        from tessera.spec import CARRIED

        keys = [F.col(f"{CARRIED}key_{i}") for i in range(len(SPEC.key_cols))]
        assert carried.where(F.col(f"{CARRIED}split") != hash_bucket(keys, 10)).count() == 0


def test_missing_names(spark, tables):
    for bad in (replace(SPEC, target="nope"), replace(SPEC, key_cols=("nope",))):
        with pytest.raises(ValueError, match="nope"):
            run(*tables, bad)
