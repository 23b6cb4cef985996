import csv
import glob
import json
import os
import re

import pytest

from payscope.columns import RAW
from payscope.plans import catalog as c
from payscope.plans import jobs
from payscope.session import checkpoint_dir
from payscope.sources.csv import read_postings_csv
from payscope.sources.sink import write_kpi_csv
from payscope.sources.taxonomy import TAXONOMY, read_taxonomy_json, taxonomy_df

from .conftest import SF001


def _write_csv(path, rows):
    with open(path, "w", newline="", encoding="utf-8") as fh:
        w = csv.writer(fh, quoting=csv.QUOTE_MINIMAL)
        w.writerow(RAW.names())
        w.writerows(rows)


def _row(job_id, **kw):
    base = dict.fromkeys(RAW.names(), "")
    base.update({"Job ID": job_id, "Agency": "DOH", "Salary Range From": "50000",
                 "Salary Range To": "70000", "Salary Frequency": "Annual", "Job Category": "IT",
                 "Posting Date": "2020-01-01T00:00:00.000"})
    base.update(kw)
    return [base[n] for n in RAW.names()]


def test_csv_roundtrip_quotes_and_newlines(spark, tmp_out):
    path = os.path.join(tmp_out, "postings.csv")
    desc = 'Line one, with comma\nline two with "quotes"'
    _write_csv(path, [_row("1", **{"Job Description": desc}), _row("2", **{"Preferred Skills": '""'})])
    df = read_postings_csv(spark, path)
    rows = {r["Job ID"]: r for r in df.collect()}
    assert len(rows) == 2 and rows["1"]["Job Description"] == desc
    assert rows["2"]["Preferred Skills"] == '""'
    assert all(f.dataType.simpleString() == "string" for f in df.schema.fields)


def _write_table(path, header, rows):
    with open(path, "w", newline="", encoding="utf-8") as fh:
        w = csv.writer(fh)
        w.writerow(header)
        w.writerows(rows)


@pytest.mark.parametrize("multi_line", [True, False])
def test_csv_is_read_by_name(spark, tmp_out, multi_line):
    path = os.path.join(tmp_out, "other.csv")
    header = ["Extra", *reversed(RAW.names())]
    _write_table(path, header, [["x", *reversed(_row("7", **{"Job Category": "IT, Data"}))], ["y", *reversed(_row("8"))]])
    df = read_postings_csv(spark, path, multi_line=multi_line)
    rows = {r["Job ID"]: r for r in df.collect()}
    assert df.columns == RAW.names() and set(rows) == {"7", "8"}
    assert (rows["7"]["Job Category"], rows["7"]["Salary Range From"], rows["7"]["Salary Frequency"]) == ("IT, Data", "50000", "Annual")
    assert "Extra" in read_postings_csv(spark, path, extra=("Extra",)).columns


def test_csv_with_a_missing_column_raises(spark, tmp_out):
    path = os.path.join(tmp_out, "short.csv")
    _write_table(path, RAW.names()[:-1], [_row("1")[:-1]])
    with pytest.raises(ValueError, match="Process Date"):
        read_postings_csv(spark, path)


def test_csv_files_of_other_headers_fail(spark, tmp_out):
    folder = os.path.join(tmp_out, "mixed")
    os.makedirs(folder)
    _write_table(os.path.join(folder, "a.csv"), RAW.names(), [_row("1")])
    _write_table(os.path.join(folder, "b.csv"), list(reversed(RAW.names())), [list(reversed(_row("2")))])
    with pytest.raises(Exception, match="(?i)header"):
        read_postings_csv(spark, folder).collect()


def test_stream_reads_by_name(spark, tmp_out):
    from payscope.streaming import ingest, read_ingested
    src, out = os.path.join(tmp_out, "in"), os.path.join(tmp_out, "table")
    os.makedirs(src)
    _write_table(os.path.join(src, "a.csv"), ["Extra", *reversed(RAW.names())], [["x", *reversed(_row("7"))]])
    ingest(spark, src, out, checkpoint=os.path.join(tmp_out, "ckpt")).awaitTermination(120)
    row = read_ingested(spark, out).collect()[0]
    assert (row["Job ID"], row["Agency"], row["Annual_Salary_Mid"]) == ("7", "DOH", 60000.0)


def test_kpi_sink_keeps_order(spark, tmp_out):
    df = spark.range(50).selectExpr("id AS n", "id % 7 AS g").repartition(5)
    path = write_kpi_csv(df, "Ordered", tmp_out, "20260101", ["g", "n"])
    rows = [(int(r.g), int(r.n)) for r in spark.read.option("header", True).csv(path).collect()]
    assert rows == sorted(rows) and len(rows) == 50


def test_kpi_sink_single_file(spark, tmp_out):
    df = spark.createDataFrame([("a,b", 1), ('q"x', 2)], "k string, n int").repartition(3)
    path = write_kpi_csv(df, "Demo", tmp_out, run_date="20260101")
    assert path == os.path.join(tmp_out, "20260101", "Demo.csv") and os.path.isfile(path)
    assert [f for f in os.listdir(os.path.dirname(path)) if not f.startswith(".")] == ["Demo.csv"]
    back = spark.read.option("header", True).option("escape", '"').csv(path)
    assert sorted(tuple(r) for r in back.collect()) == [("a,b", "1"), ('q"x', "2")]


def test_kpi_sink_overwrites_and_keeps_the_old_file_on_failure(spark, tmp_out):
    from pyspark.sql import functions as F
    from payscope.sources.sink import commit_part
    path = write_kpi_csv(spark.range(5), "Again", tmp_out, "20260101")
    assert write_kpi_csv(spark.range(3), "Again", tmp_out, "20260101") == path
    assert open(path).read().split() == ["id", "0", "1", "2"]
    with pytest.raises(Exception, match="broken"):
        write_kpi_csv(spark.range(3).select(F.raise_error(F.lit("broken")).alias("id")), "Again", tmp_out, "20260101")
    assert open(path).read().split() == ["id", "0", "1", "2"]
    empty = write_kpi_csv(spark.range(0), "Empty", tmp_out, "20260101")
    assert open(empty).read().split() in (["id"], [])
    os.makedirs(os.path.join(tmp_out, "nothing"))
    with pytest.raises(FileNotFoundError, match="0 part files"):
        commit_part(spark, os.path.join(tmp_out, "nothing"), os.path.join(tmp_out, "x.csv"))
    for k in range(2):
        open(os.path.join(tmp_out, "nothing", f"part-{k}.csv"), "w").close()
    with pytest.raises(FileNotFoundError, match="2 part files"):
        commit_part(spark, os.path.join(tmp_out, "nothing"), os.path.join(tmp_out, "x.csv"))
    assert sorted(f for f in os.listdir(os.path.join(tmp_out, "20260101")) if not f.startswith(".")) == ["Again.csv", "Empty.csv"]


def test_taxonomy_json_source(spark, tmp_out):
    path = os.path.join(tmp_out, "skills.json")
    with open(path, "w") as fh:
        json.dump(TAXONOMY, fh, indent=2)
    from_json = sorted(tuple(r) for r in read_taxonomy_json(spark, path).collect())
    from_const = sorted(tuple(r) for r in taxonomy_df(spark).collect())
    assert len(from_const) == 77 and from_json == from_const


def test_report_job_end_to_end(spark, tmp_out):
    from payscope.columns import SNAKE
    enriched = jobs.enrich(jobs.clean(c.raw(spark, SF001), SNAKE, c.TIEBREAK), SNAKE)
    out = jobs.report(enriched, tmp_out, SNAKE, keywords=c.PART_WORDS, run_date="20260101")
    assert set(out) == {"Highest_Paid_Skills", "Skill_Salary_Distribution", "Degree_Salary_Correlation",
                        "Agency_insights"}
    k4 = spark.read.option("header", True).csv(out["Degree_Salary_Correlation"])
    # invariant: K4 counts add up to the postings left after dedup
    assert sum(int(r.job_count) for r in k4.collect()) == c.dedup(spark, SF001).count()
    # nothing stored is left behind
    assert not glob.glob(os.path.join(checkpoint_dir(spark).removeprefix("file:"), "enriched-*"))
    # K7 on the year-partitioned table equals K7 on the enriched plan itself
    from payscope.columns import POSTING_DATE
    from payscope.operators import kpis as K
    k7_file = {r.agency: float(r.avg_salary_2yr) for r in
               spark.read.option("header", True).csv(out["Agency_insights"]).collect()}
    k7_direct = {r.agency: r.avg_salary_2yr for r in K.agency_insights(enriched, SNAKE.agency, POSTING_DATE).collect()}
    assert k7_file.keys() == k7_direct.keys() and len(k7_file) > 0
    assert all(abs(k7_file[a] - k7_direct[a]) < 1e-6 * abs(k7_direct[a]) for a in k7_file)
    k10 = spark.read.option("header", True).csv(out["Highest_Paid_Skills"]).collect()
    means = {round(float(r.avg_salary) - float(r.salary_premium), 6) for r in k10}
    assert len(k10) > 0 and len(means) == 1      # one global mean behind every premium


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_in_hot_paths(spark):
    for name in ("M2", "K1", "K4", "K7", "K10_parts", "K11_docs", "T10_docs", "T11_docs"):
        p = _plan(c.QUERIES[name](spark, SF001))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_scan_prunes_columns(spark):
    p = _plan(c.QUERIES["K12"](spark, SF001))
    assert "p_name" not in p and "o_orderdate" not in p and "l_tax" not in p


def test_k7_is_one_aggregate_without_self_join(spark):
    p = _plan(c.QUERIES["K7"](spark, SF001))
    assert "SortMergeJoin" not in p


def test_invariants_on_test_tables(spark):
    k1 = c.QUERIES["K1"](spark, SF001).collect()
    assert all(r.job_count > 1 and r.min_salary <= r.median_salary <= r.max_salary for r in k1)
    k7 = c.QUERIES["K7"](spark, SF001).collect()
    assert all(abs(r.High_salary_per_agency - r.avg_salary_2yr - r.salary_premium) < 0.011 for r in k7)


def test_exact_median_splits_hot_groups_by_bucket(spark):
    from payscope.operators.aggregates import exact_median
    df = spark.createDataFrame([("hot", i * 0.37) for i in range(5000)] + [("cold", 1.0)], "k string, v double")
    p = _plan(exact_median(df, ["k"], "v"))
    # running sums: a group's octaves, an octave's buckets, a bucket's values;
    # buckets and values are never in a window of the group alone
    keys = re.findall(r"Window \[.*?\], \[([^\]]*)\], \[([^\]]*)\]", p)
    names = {(re.sub(r"#\d+L?", "", a), re.sub(r"#\d+L?| ASC.*", "", b)) for a, b in keys}
    assert names == {("_k", "_o"), ("_k, _o", "_b"), ("_k, _b", "v")}
    assert "SinglePartition" not in p


def test_scalar_attach_is_a_subquery_not_a_join(spark):
    from pyspark.sql import functions as F
    from payscope.operators.clean import attach_scalars
    df = spark.range(100)
    p = _plan(attach_scalars(df, df.agg(F.max("id").alias("m"))))
    assert "Subquery" in p and "Join" not in p and "CartesianProduct" not in p


def test_skill_kpis_have_no_expand(spark):
    for name in ("K10_parts", "K10_docs", "K11_docs"):
        assert "Expand" not in _plan(c.QUERIES[name](spark, SF001)), name


def _planned(spark, name):
    """Static plan without AQE and broadcast joins."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return _plan(c.QUERIES[name](spark, SF001))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_latest_date_needs_no_dedup(spark):
    for name in ("K7", "K9", "F3", "F4"):
        assert _planned(spark, name).count("Window [row_number(") == 1, name


def test_text_is_expanded_once(spark):
    df = c.QUERIES["K11_docs"](spark, SF001)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    # stages that ran carry a codegen number; the others of the same text are reused exchanges
    assert len(re.findall(r"\*\(\d+\) Generate explode", plan)) == 1


def test_medians_are_exact(spark):
    for name in ("K1", "T2", "J1", "K4", "M2"):
        assert "percentile" not in _plan(c.QUERIES[name](spark, SF001)), name


def test_stored_kpi_table_has_no_text(spark):
    from payscope.columns import SNAKE
    base = jobs.kpi_base(c.m2(spark, SF001), SNAKE)
    assert "combined_text" not in base.columns and SNAKE.job_description not in base.columns


def test_queries_without_bands_dedup_once(spark):
    for name in ("K6", "K5_test", "K10_parts", "K10", "K11", "T4", "T10", "T11", "K4"):
        assert _planned(spark, name).count("Window [row_number(") == 1, name


def test_bands_from_the_histogram_join_no_rows(spark):
    """K4: one scan of the facts; what is joined after the first aggregate are pairs."""
    plan = _planned(spark, "K4")
    assert plan.count("Window [row_number(") == 1
    above = plan[:plan.index("Window [row_number(")]
    rows = [line for line in above.splitlines() if "Join" in line]
    assert all("job_id" not in line for line in rows)
    # below the dedup window stand the adapter's own joins alone
    assert plan.count("SortMergeJoin [l_partkey") == 1 and plan.count("SortMergeJoin [l_suppkey") == 1


def test_bands_reach_rows_without_a_join(spark):
    plan = _planned(spark, "T2")
    main = [line for line in plan.splitlines() if not line.startswith("   :")]
    assert any("element_at(Subquery" in line for line in main)
    assert sum("SortMergeJoin" in line for line in main) == 2  # part and supplier, of the adapter
    # the medians read the rows once
    assert plan.count("Window [row_number(") == 2


def test_skills_are_not_gathered_in_one_task(spark):
    for name in ("K10_docs", "K11_docs", "K10", "K11"):
        df = c.QUERIES[name](spark, SF001)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "Window [max(" not in plan, name
    assert "Window [" not in _plan(c.QUERIES["K10_docs"](spark, SF001))


def test_large_year_is_split_by_its_size(spark, tmp_out):
    from pyspark.sql import functions as F
    from payscope.columns import COMBINED_TEXT, PRIMARY_CATEGORY, QUALIFICATION, SALARY_FLAG, SALARY_MID, POSTING_DATE, SNAKE
    keys = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor")
    rows = spark.range(200_000).select(
        F.col("id").cast("string").alias(SNAKE.job_id), F.sha2(F.col("id").cast("string"), 256).alias(SNAKE.agency),
        F.lit("2020-05-01").cast("date").alias(POSTING_DATE), F.col("id").cast("double").alias(SALARY_MID), F.lit("IT").alias(PRIMARY_CATEGORY),
        F.lit("x").alias(QUALIFICATION), F.lit("y").alias(SALARY_FLAG), F.lit("python").alias(COMBINED_TEXT))
    spark.conf.set(keys[0], "256k")
    try:
        base = jobs.kpi_base(rows.repartition(16), SNAKE)
        assert base.select(F.input_file_name()).distinct().count() > 8
        spark.conf.set(keys[0], "512m")
        base = jobs.kpi_base(rows.repartition(16), SNAKE)
        assert base.select(F.input_file_name()).distinct().count() == 1
    finally:
        spark.conf.unset(keys[0])


def test_profile_moves_digests(spark):
    from pyspark.sql import functions as F
    from payscope.operators.profile import profile
    df = spark.range(3000).select((F.col("id") % 700).alias("n"), F.repeat(F.col("id").cast("string"), 50).alias("long text"),
                                  F.when(F.col("id") % 2 == 0, F.lit("")).alias("half"), F.lit(None).cast("string").alias("none"))
    exact = {x.column: (x.rows, x.non_null, x.distinct) for x in profile(df).collect()}
    assert exact == {"n": (3000, 3000, 700), "long text": (3000, 3000, 3000), "half": (3000, 1500, 1), "none": (3000, 0, 0)}
    plan = _plan(profile(df))
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert "md5" in plan and moved and all("long text" not in line for line in moved)
    rough = {x.column: x.distinct for x in profile(df, sketch=True).collect()}
    assert all(abs(rough[k] - v[2]) <= 0.1 * v[2] for k, v in exact.items())
    assert profile(df, sketch=True).columns == profile(df).columns
