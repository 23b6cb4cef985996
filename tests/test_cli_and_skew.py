import os

from pyspark.sql import functions as F

from payscope.columns import RAW, SNAKE
from payscope.operators import clean as C
from payscope.operators import kpis as K
from payscope.plans import catalog as c
from payscope.plans.run import main

from .conftest import SF001


def test_cli_end_to_end_on_csv(spark, tmp_out):
    # the sf0.001 postings written as the original CSV layout (header with spaces)
    raw = c.raw(spark, SF001)
    as_csv = raw.select(*[F.col(getattr(SNAKE, f)).cast("string").alias(getattr(RAW, f))
                          for f in RAW.__dataclass_fields__])
    src = os.path.join(tmp_out, "in")
    as_csv.write.option("header", True).option("escape", '"').csv(src)
    out = main(["--input", src, "--output", os.path.join(tmp_out, "out"), "--tiebreak", "Salary Range To",
                "--keywords", *c.PART_WORDS, "--run-date", "20260102"], spark=spark)
    assert len(out) == 4
    k4 = spark.read.option("header", True).csv(out["Degree_Salary_Correlation"])
    assert sum(int(r.job_count) for r in k4.collect()) == raw.select(SNAKE.job_id).distinct().count()
    k10 = spark.read.option("header", True).csv(out["Highest_Paid_Skills"]).collect()
    assert 0 < len(k10) <= 20


def test_hot_key_dedup_and_aggregates(spark):
    # one key / one agency holds a third of all rows
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit("BIG")).otherwise(F.concat(F.lit("A"), (F.col("id") % 50).cast("string")))
         .alias("agency"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 700).cast("int")).alias("d"),
        (F.col("id") % 1000).cast("double").alias("s"))
    latest = C.dedup_keep_latest(df, "k", "d", ["s"]).where("k = 'hot'").collect()
    assert len(latest) == 1 and latest[0].d.isoformat() == "2021-11-30" and latest[0].s == 999.0
    ag = {r.agency: r for r in K.agency_insights(df, "agency", "d", "s").collect()}
    assert ag["BIG"].job_count_2yr == n // 3
    med = {r.agency: r.median_salary for r in K.median_by_group(df, ["agency"], "s").collect()}
    big = sorted(float(i % 1000) for i in range(0, n, 3))
    assert med["BIG"] == (big[len(big) // 2 - 1] + big[len(big) // 2]) / 2


def test_enrich_from_checkpointed_input_matches_lazy(spark):
    from payscope.plans import jobs
    cleaned = jobs.clean(c.raw(spark, SF001), SNAKE, c.TIEBREAK)
    cols = [SNAKE.job_id, "Qualification_Category", "Salary_Qual_Flag", "combined_text"]
    lazy = sorted(tuple(r) for r in jobs.enrich(cleaned, SNAKE).select(*cols).collect())
    ckpt = jobs.enrich(cleaned, SNAKE, checkpoint_input=True)
    plan = ckpt._jdf.queryExecution().executedPlan().toString()
    assert "lineitem.parquet" not in plan and "cleaned-" in plan
    assert sorted(tuple(r) for r in ckpt.select(*cols).collect()) == lazy
