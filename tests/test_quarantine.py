"""Malformed CSV records are set apart with their files; good rows are those of a permissive read."""

import pytest

from tessera.sources import read_quarantined, read_table


@pytest.fixture()
def folder(tmp_path):
    files = {
        "a.csv": 'k,v,w\n1,x,y\n2,x\n3,x,y,z\n4,"x,y\n\n5,"q,r",t\n6,,\n',
        "b.csv": "v,k,_corrupt_record\nx,7,m\nx\n",
        "c.csv": "k,v,w\n8,a,b\n",
        "empty.csv": "k,v,w\n",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    return tmp_path


def test_good_bad_and_counts(spark, folder):
    got = read_quarantined(spark, [f"{folder}/{n}" for n in ("a.csv", "b.csv", "c.csv", "empty.csv")])
    name = lambda p: p.rsplit("/", 1)[-1]
    assert sorted((name(r["file"]), r["record"]) for r in got.bad.collect()) == [
        ("a.csv", "2,x"), ("a.csv", "3,x,y,z"), ("a.csv", '4,"x,y'), ("b.csv", "x"),
    ]
    assert {name(r["file"]): (r["n_good"], r["n_bad"]) for r in got.counts.collect()} == {"a.csv": (3, 3), "b.csv": (1, 1), "c.csv": (1, 0)}
    good = sorted((r["k"], r["v"], r["w"], r["_corrupt_record"]) for r in got.good.collect())
    assert [g[0] for g in good] == ["1", "5", "6", "7", "8"] and good[1] == ("5", "q,r", "t", None) and good[3] == ("7", "x", None, "m")
    # Columns by name, as in read_table; counting uses no other column.
    assert sorted(r["k"] for r in read_quarantined(spark, f"{folder}/a.csv", columns=["K"]).good.withColumnRenamed("K", "k").collect()) == ["1", "5", "6"]
    assert got.good.count() == 5 and got.bad.count() == 4
    with pytest.raises(ValueError, match="no column"):
        read_quarantined(spark, f"{folder}/a.csv", columns=["nothing"])


def test_a_thousand_files_start_no_job_each(spark, tmp_path):
    for i in range(1000):
        (tmp_path / f"f{i:04}.csv").write_text(f"k,v\n{i},x\n" if i % 3 else f"v,k\nx,{i}\n")
    paths = [f"{tmp_path}/f{i:04}.csv" for i in range(1000)]
    spark.sparkContext.setJobGroup("headers", "headers")
    try:
        df = read_table(spark, paths)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("headers")) <= 4  # a header and a listing for each of two headers
    finally:
        spark.sparkContext.setJobGroup("", "")
    assert df.selectExpr("sum(k) AS s", "count(*) AS n").first()[:] == (499500.0, 1000)


def test_folders_and_compressed_files(spark, folder):
    import gzip

    df = spark.read.option("header", True).csv(f"{folder}/c.csv")
    df.write.option("header", True).option("compression", "gzip").csv(f"{folder}/zipped.csv")
    with gzip.open(folder / "one.csv.gz", "wt") as f:
        f.write("k,v,w\n9,a,b\n")
    paths = [f"{folder}/zipped.csv", f"{folder}/one.csv.gz", f"{folder}/c.csv"]
    assert sorted(r["k"] for r in read_table(spark, paths).collect()) == ["8", "8", "9"]
    assert read_quarantined(spark, paths).bad.count() == 0


def test_parquet_footers_in_one_job(spark, folder):
    for i in range(12):
        spark.range(1).selectExpr(f"{i} AS k", *(["'x' AS extra"] if i % 2 else [])).write.parquet(f"{folder}/p{i}.parquet")
    spark.sparkContext.setJobGroup("footers", "footers")
    try:
        df = read_table(spark, [f"{folder}/p{i}.parquet" for i in range(12)], fmt="parquet")
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("footers")) <= 1
    finally:
        spark.sparkContext.setJobGroup("", "")
    assert df.selectExpr("count(extra)", "sum(k)").first()[:] == (6, 66)
    # Types that cannot be merged are widened by the union.
    spark.range(1).selectExpr("cast(2.5 AS double) AS k").write.parquet(f"{folder}/double.parquet")
    mixed = read_table(spark, [f"{folder}/p0.parquet", f"{folder}/double.parquet"], fmt="parquet")
    assert sorted(r["k"] for r in mixed.collect()) == [0.0, 2.5]
