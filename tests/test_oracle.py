"""The correctness gate: each registered query against its DuckDB SQL at sf0.01."""

import pytest

import __spark_entry__ as E
from payscope.plans.catalog import QUERIES as CATALOG

from .conftest import SF001, SF01
from .oracle_check import compare, duck

# the queries of the reference's operators; the others have tests of their own
QUERIES = {k: E.queries()[k] for k in CATALOG}
SQLS = {k: E.oracle_sql()[k] for k in CATALOG}

# Queries with a text result that is empty for most rows, and which column.
LISTS = {"T4": "skills", "T5": "labels", "T6": "labels", "T7": "skills", "T8": "skills", "T9": "skills", "T10": "skills",
         "T11": "skills", "T4_docs": "skills", "T5_docs": "labels", "T7_docs": "skills", "T8_docs": "skills", "T11_docs": "skills"}


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", sorted(SQLS))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, SF01, QUERIES, SQLS)
    assert r["status"] == "ok", r


@pytest.mark.parametrize("name", sorted(LISTS))
def test_text_queries_have_content(spark, name):
    full = QUERIES[name](spark, SF01).where(f"{LISTS[name]} != ''")
    assert full.count() >= 100 and full.select(LISTS[name]).distinct().count() >= 3


def test_skill_kpis_have_rows(spark):
    for name in ("K10", "K11", "M3_skills"):
        assert QUERIES[name](spark, SF001).count() >= 5, name


# Fixed order of the result rows: column, whether it falls.
ORDERS = {"O1": [("Annual_Salary_Mid", True), ("job_id", False)], "O2": [("agency", False), ("Annual_Salary_Mid", True), ("job_id", False)],
          "K3": [("job_postings", True), ("Primary_Job_Category", False)], "K8": [("Annual_Salary_Mid", True)],
          "K4": [("Qualification_Category", False), ("job_count", True), ("Salary_Qual_Flag", False)], "K9": [("avg_salary", True)]}


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_rows_come_in_order(spark, name):
    rows = QUERIES[name](spark, SF001).collect()
    order = ORDERS[name]
    if name == "O2":  # nulls stand where Spark puts them in a falling order: last
        rows = [r for r in rows if r.Annual_Salary_Mid is not None]
    if name == "O1":
        nulls = [r.Annual_Salary_Mid is None for r in rows]
        assert nulls == sorted(nulls)
        rows = [r for r in rows if r.Annual_Salary_Mid is not None]
    want = rows
    for column, falls in reversed(order):
        want = sorted(want, key=lambda r: r[column], reverse=falls)
    assert [tuple(r[c] for c, _ in order) for r in rows] == [tuple(r[c] for c, _ in order) for r in want]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["skill", "job_count", "avg_salary", "unique_jobs", "salary_premium", "premium_pct"]
