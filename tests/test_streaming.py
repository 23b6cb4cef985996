import os
import tempfile

from payscope.columns import RAW
from payscope.operators import clean as C
from payscope.operators import features as T
from payscope.operators import kpis as K
from payscope.streaming import ingest, read_ingested

from .test_io_and_plans import _row, _write_csv


def test_incremental_ingest_then_batch_kpis(spark):
    src = tempfile.mkdtemp(prefix="payscope-src-")
    out = os.path.join(tempfile.mkdtemp(prefix="payscope-tbl-"), "postings")
    _write_csv(os.path.join(src, "a.csv"), [
        _row("1", **{"Salary Range From": "10", "Salary Range To": "20", "Salary Frequency": "Hourly"}),
        _row("2", **{"Minimum Qual Requirements": "Masters degree"})])
    q = ingest(spark, src, out)
    q.awaitTermination(120)
    assert read_ingested(spark, out).count() == 2

    # a later drop: only the new file is read, and an update of posting 1 arrives
    _write_csv(os.path.join(src, "b.csv"), [
        _row("1", **{"Posting Date": "2021-06-01T00:00:00.000", "Salary Range From": "30000",
                     "Salary Range To": "50000"}),
        _row("3", **{"Job Category": "HR/Admin"})])
    ingest(spark, src, out).awaitTermination(120)
    table = read_ingested(spark, out)
    assert table.count() == 4
    assert sorted(r.posting_year for r in table.select("posting_year").distinct().collect()) == [2020, 2021]

    # batch part: dedup on the whole table, then bands and a KPI
    latest = C.dedup_keep_latest(table, RAW.job_id, RAW.posting_date, [])
    rows = {r["Job ID"]: r for r in latest.collect()}
    assert rows["1"]["Annual_Salary_Mid"] == 40000.0 and rows["2"]["Qualification_Category"] == "Masters Degree"
    assert rows["3"]["Primary_Job_Category"] == "HR"
    k4 = K.degree_salary_correlation(T.flag_salary_vs_qualification(latest)).collect()
    assert sum(r.job_count for r in k4) == 3
