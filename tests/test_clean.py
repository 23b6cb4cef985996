import datetime as dt

import pytest
from pyspark.sql import functions as F

from payscope.columns import RAW
from payscope.operators import clean as C
from payscope.operators import filters as FL
from payscope.plans import jobs

COLS = ["Job ID", "Agency", "Salary Range From", "Salary Range To", "Salary Frequency",
        "Job Category", "Minimum Qual Requirements"]
OWN_ROWS = [("p-7", "Parks", "41200", "58800", "Annual", "Field Work", "Diploma"),
            ("p-8", "Water", "90500", "91500", "Annual", "Field Work/Labs", "Masters"),
            ("p-9", "Parks", "30000", "31001", "Annual", "Legal & Policy", "Diploma")]


def test_midpoint_and_category_of_plain_rows(spark):
    df = spark.createDataFrame(OWN_ROWS, COLS)
    out = C.primary_category(C.salary_to_numeric(df, RAW.salary_from, RAW.salary_to), RAW.job_category)
    rows = {r["Job ID"]: r for r in out.collect()}
    assert [rows[k]["Annual_Salary_Mid"] for k in ("p-7", "p-8", "p-9")] == [50000.0, 91000.0, 30500.5]
    assert [rows[k]["Primary_Job_Category"] for k in ("p-7", "p-8", "p-9")] == ["Field Work", "Field Work", "Legal "]
    assert out.columns == [*COLS, "Annual_Salary_Mid", "Primary_Job_Category"]


def test_valid_date_beats_unusable_text(spark):
    rows = [("J1", "unknown", "a"), ("J1", "2020-01-01T00:00:00.000", "b"), ("J1", None, "c"),
            ("J2", "zzz", "a"), ("J2", None, "b"), ("J3", "2020-01-01T05:00:00.000", "a"), ("J3", "2020-01-01T04:00:00.000", "z")]
    df = spark.createDataFrame(rows, "k string, d string, t string")
    assert {r.k: r.t for r in C.dedup_keep_latest(df, "k", "d", ["t"]).collect()} == {"J1": "b", "J2": "b", "J3": "a"}


@pytest.mark.parametrize("text,expected", [
    ("N/A", None), ("", None), ("1.2.3", None), ("$1,234.50", 1234.5), ("-5", 5.0), (None, None),
    ("85000", 85000.0)])
def test_salary_strip(spark, text, expected):
    df = spark.createDataFrame([(text, "100")], "a string, b string")
    got = C.salary_to_numeric(df, "a", "b", out="mid", keep_bounds=True).collect()[0]
    assert got["Salary_From_Value"] == expected
    assert got["mid"] == (None if expected is None else (expected + 100) / 2)


def test_coerce_numeric_is_strict(spark):
    df = spark.createDataFrame([("$100", "7", "x")], "a string, b string, c string")
    r = C.coerce_numeric(df, ["a", "b", "c"]).collect()[0]
    assert (r.a, r.b, r.c) == (None, 7.0, None)


def test_posting_date_parse_and_drop(spark):
    df = spark.createDataFrame([("2020-02-29T00:00:00.000",), ("bad",), (None,), ("2020-02-29",)],
                               "posting_date string")
    out = C.posting_date_to_date(df, "posting_date")
    assert out.columns == ["Posting_Date"]
    assert [r[0] for r in out.collect()] == [dt.date(2020, 2, 29), None, None, None]


def test_timestamps(spark):
    df = spark.createDataFrame([("2020-01-02T03:04:05.678", "nope")], "a string, b string")
    r = C.coerce_timestamps(df, ["a", "b"]).collect()[0]
    assert r.a == dt.datetime(2020, 1, 2, 3, 4, 5, 678000) and r.b is None


def test_annualize_keep_and_null(spark):
    df = spark.createDataFrame([("Hourly", 10.0), ("Daily", 10.0), ("Annual", 10.0), ("Weekly", 10.0),
                                (None, 10.0)], "f string, v double")
    keep = [r.v for r in C.normalize_to_annual(df, "f", "v").collect()]
    assert keep == [20800.0, 2600.0, 10.0, 10.0, 10.0]
    null = [r.o for r in C.annualize_columns(df, "f", {"v": "o"}).collect()]
    assert null == [20800.0, 2600.0, 10.0, None, None]


def test_primary_category_variants(spark):
    data = [("Admin & Ops",), (",Lead",), (None,), ("Admin ",), ('"Health, Policy"',), ("  it/data",),
            ("ENGINEERING",), ("",)]
    df = spark.createDataFrame(data, "c string")
    first = [r.p for r in C.primary_category(df, "c", "p").collect()]
    assert first == ["Admin ", "", None, "Admin ", '"Health', "  it", "ENGINEERING", ""]
    clean = [r.p for r in C.primary_category_clean(df, "c", "p").collect()]
    assert clean == ["Admin", ",lead", "Unknown", "Admin", "Health", "It", "Engineering", ""]


def test_dedup_latest_with_tiebreak_and_nulls(spark):
    rows = [("A", "2020-01-01", 1), ("A", "2021-01-01", 1), ("A", None, 9),
            ("B", None, 1), ("B", None, 2), ("C", "2020-05-05", 1), ("C", "2020-05-05", 3)]
    df = spark.createDataFrame(rows, "k string, d string, t int")
    out = {r.k: (r.d, r.t) for r in C.dedup_keep_latest(df, "k", "d", ["t"], "yyyy-MM-dd").collect()}
    assert out == {"A": ("2021-01-01", 1), "B": (None, 2), "C": ("2020-05-05", 3)}


def test_dedup_checks_the_date_argument(spark):
    df = spark.createDataFrame([("A", "x")], "k string, when string")
    with pytest.raises(ValueError):
        C.dedup_keep_latest(df, "k", "Posting Date", [])
    assert C.dedup_keep_latest(df, "k", "when", []).count() == 1


def test_dedup_plan_limits_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("d"))
    plan = C.dedup_keep_latest(df, "k", "d", [])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_scalars_and_stamps(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "v double")
    out = C.attach_scalars(C.stamp_constants(df, {"basis": "Annual"}), df.agg(F.avg("v").alias("g")))
    assert sorted((r.v, r.basis, r.g) for r in out.collect()) == [(1.0, "Annual", 2.0), (3.0, "Annual", 2.0)]


def test_project_and_drop(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert C.project(df, {"a": "A x", "c": "C"}).columns == ["A x", "C"]
    assert C.drop_columns(df, ["b", "missing"]).columns == ["a", "c"]


def test_recent_windows(spark):
    d = dt.date
    rows = [(d(2020, 2, 29),), (d(2018, 3, 1),), (d(2018, 2, 28),), (d(2018, 2, 27),), (None,)]
    df = spark.createDataFrame(rows, "x date")
    days = sorted(r.x for r in FL.recent_days(df, "x", 730).collect())
    assert days == [d(2018, 3, 1), d(2020, 2, 29)]  # 730 days before 2020-02-29 is 2018-03-01
    years = sorted(r.x for r in FL.recent_years(df, "x", 2).collect())
    assert years == [d(2018, 2, 28), d(2018, 3, 1), d(2020, 2, 29)]
    all_null = spark.createDataFrame([(None,), (None,)], "x date")
    assert FL.recent_days(all_null, "x").count() == 2   # no valid date: keep all
    assert FL.recent_years(all_null, "x").count() == 0


def test_having_and_presence(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3)], "k string, n int")
    assert [r.k for r in FL.having_min_count(df, "n", 3).collect()] == ["b"]
    assert [r.k for r in FL.having_min_count(df, "n", 3, strict=True).collect()] == []
    t = spark.createDataFrame([("", 1.0), (None, 2.0), ("x", None), ("y", 3.0)], "c string, v double")
    assert [r.c for r in FL.require_present(t, ["v"], ["c"]).collect()] == ["y"]


def test_clean_job_order(spark):
    rows = [("J1", "DOH", "$10", "$20", "Hourly", "IT & Ops", "x", "2020-01-01T00:00:00.000"),
            ("J1", "DOH", "$99", "$99", "Annual", "HR", "x", "2019-01-01T00:00:00.000")]
    cols = ["Job ID", "Agency", "Salary Range From", "Salary Range To", "Salary Frequency",
            "Job Category", "Minimum Qual Requirements", "Posting Date"]
    out = jobs.clean(spark.createDataFrame(rows, cols), RAW, ()).collect()
    assert len(out) == 1 and out[0]["Annual_Salary_Mid"] == 15 * 2080
    assert out[0]["Primary_Job_Category"] == "IT " and out[0]["Posting_Date"] == dt.date(2020, 1, 1)


def test_recent_windows_with_year_partitions(spark, tmp_out):
    import os
    d = dt.date
    rows = [(d(2020, 2, 29), 1), (d(2018, 3, 1), 2), (d(2018, 2, 28), 3), (d(2016, 1, 1), 4), (None, 5)]
    path = os.path.join(tmp_out, "by_year")
    (spark.createDataFrame(rows, "x date, v int").withColumn("y", F.year("x"))
          .write.partitionBy("y").parquet(path))
    t = spark.read.parquet(path)
    got = sorted(r.v for r in FL.recent_days(t, "x", 730, partition_year="y").collect())
    assert got == sorted(r.v for r in FL.recent_days(t, "x", 730).collect()) == [1, 2]
    got = sorted(r.v for r in FL.recent_years(t, "x", 2, partition_year="y").collect())
    assert got == [1, 2, 3]
    plan = FL.recent_days(t, "x", 730, partition_year="y")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "year(date_sub(" in plan
