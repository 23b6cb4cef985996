"""What keeps the structured queries small on large tables: plans and stored files."""

import os
import time
from urllib.parse import urlparse

from pyspark.sql import functions as F

from payscope import session
from payscope.columns import SNAKE as S
from payscope.operators import clean as C
from payscope.operators import profile as P
from payscope.operators import skills as SK
from payscope.operators.profile import _key, profile
from payscope.plans import catalog as c
from payscope.plans import jobs
from payscope.sources.adapters import TIEBREAK, postings_in_steps

from .conftest import SF001
from .test_io_and_plans import _plan, _planned


def test_global_mean_needs_no_second_pass(spark):
    for name in ("K10", "K10_parts", "K11"):
        plan = _planned(spark, name)
        assert "Subquery" not in plan, name
        assert plan.count("Window [row_number(") == 1, name


def test_texts_are_written_after_dedup(spark):
    for name in ("C10", "K10", "K11", "T5_table", "M1"):
        plan = _planned(spark, name)
        below = plan[plan.index("Window [row_number("):]
        assert "element_at" not in below, name


def test_late_texts_give_the_rows_of_dedup_on_texts(spark):
    early = C.dedup_keep_latest(c.raw(spark, SF001), S.job_id, S.posting_date, TIEBREAK)
    late = c.dedup(spark, SF001)
    assert early.columns == late.columns and early.schema == late.schema
    assert early.exceptAll(late).isEmpty() and late.exceptAll(early).isEmpty() and late.count() > 0


def test_vocabulary_filter_is_not_run_on_phrases(spark):
    plan = _plan(c.QUERIES["T5_table"](spark, SF001))
    assert "trim(_phrase" not in plan
    df = spark.createDataFrame([(1, "sql and c++ for 𝐀."), (2, None), (3, "  ")], "k int, t string")
    known = spark.createDataFrame([("sql", "a"), ("c++", "b"), (" ", "blank"), (None, "null"), (".", "dot")], "keyword string, label string")
    assert [tuple(r) for r in SK.vocabulary_presence(df, "k", "t", known).collect()] == [(1, ["a", "b"])]


def test_labels_keep_the_order_of_entries(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("sql c++ java",)], "t string")
    got = df.select(SK.keyword_presence(F.col("t"), [("x", "c++"), ("y", "java"), ("z", "sql"), ("w", "java")])).first()[0]
    assert got == ["x", "y", "z", "w"]


def test_posting_csv_is_stored_compressed(spark):
    files = c.QUERIES["S1"](spark, SF001).inputFiles()
    assert files and all(f.endswith(".csv.gz") for f in files)


def test_report_queries_clean_once(spark, monkeypatch):
    stored = {}
    real = jobs.materialize

    def materialize(df, name, *args, **kw):
        stored[name] = df._jdf.queryExecution().executedPlan().toString()
        return real(df, name, *args, **kw)

    monkeypatch.setattr(jobs, "materialize", materialize)
    c.QUERIES["M3_agencies"](spark, SF001).collect()
    assert set(stored) == {"cleaned", "enriched"}
    assert "lineitem.parquet" in stored["cleaned"] and "lineitem.parquet" not in stored["enriched"]


def test_profile_reads_its_rows_once(spark):
    df = spark.range(3000).selectExpr("id - 1500 as n", "id % 7 as m")
    assert _plan(profile(df)).count("Range (0, 3000") == 1
    for at_once in (None, 1):
        none = profile(df.where("n is null"), at_once=at_once).orderBy("position")
        assert [tuple(r) for r in none.collect()] == [(0, "n", "bigint", 0, 0, 0), (1, "m", "bigint", 0, 0, 0)]


def test_profile_keeps_unlike_values_apart(spark):
    long = "x" * 15
    texts = ["", "\0", " ", "a", "A", "é", long, long + "x", long + "y", long + "x", None, "a"]
    rows = [(t, i % 5 - 2, (-1) ** i * 2 ** 62, i % 3 == 0, i / 4 if i % 2 else None) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "t string, i int, l bigint, b boolean, d double")
    want = {c: (len(rows), sum(v is not None for v in vs), len({v for v in vs if v is not None})) for c, vs in zip(df.columns, zip(*rows))}
    for at_once in (None, 1, 2, 5, 9):
        got = profile(df, at_once=at_once)
        assert {r.column: (r.rows, r.non_null, r.distinct) for r in got.collect()} == want
        assert got.schema == profile(df).schema and got.columns == profile(df, sketch=True).columns


def test_short_values_move_as_they_are(spark):
    # a key of a whole number or of a short text is no longer than itself
    df = spark.createDataFrame([(7, "seven"), (-1, "y" * 40)], "n bigint, t string")
    keys = df.select(F.length(_key(df.schema["n"])).alias("n"), F.length(_key(df.schema["t"])).alias("t")).collect()
    assert [tuple(k) for k in keys] == [(1, 5), (8, 16)]


def _shuffle_files(spark):
    blocks = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllBlocks()
    return {blocks.apply(i).name() for i in range(blocks.size()) if blocks.apply(i).isShuffle()}


def test_profile_holds_one_shuffle_of_lines(spark, monkeypatch):
    stored, left, found = [], [], _shuffle_files(spark)
    real = session.materialize

    def materialize(df, name, *args, **kw):
        stored.append((name, df._jdf.queryExecution().executedPlan().toString()))
        out = real(df, name, *args, **kw)
        for _ in range(50):  # files go in the background
            if not _shuffle_files(spark) - found:
                break
            time.sleep(0.1)
        left.append(_shuffle_files(spark) - found)
        return out

    monkeypatch.setattr(session, "materialize", materialize)
    folder = urlparse(session.checkpoint_dir(spark)).path
    before = set(os.listdir(folder))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "false"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        got = c.QUERIES["P1"](spark, SF001)
        assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    finally:
        for k in conf:
            spark.conf.unset(k)
    assert [name for name, _ in stored] == ["lines-dated", "lines-supplied", "lines-named"]
    assert all(p.count("SortMergeJoin") == 1 for _, p in stored)
    assert left == [set()] * 3
    assert set(os.listdir(folder)) == before  # nor a table
    assert "parquet" not in _plan(got) and got.count() == 17


def test_profile_holds_the_cells_of_a_few_columns(spark, monkeypatch):
    found, seen = _shuffle_files(spark), []
    real = P._counts

    def counts(df, fields):
        for _ in range(50):  # files go in the background
            if not _shuffle_files(spark) - found:
                break
            time.sleep(0.1)
        seen.append((len(fields), _shuffle_files(spark) - found))
        return real(df, fields)

    monkeypatch.setattr(P, "_counts", counts)
    c.QUERIES["P1"](spark, SF001)
    assert seen == [(6, set()), (6, set()), (5, set())]


def test_postings_in_steps_are_the_postings(spark, tmp_out):
    import datetime as dt
    # lines without a part, a supplier, an order or a key; keys met twice; a nation that is not there
    day = dt.datetime(1996, 2, 29, 10, 30)
    tables = {
        "lineitem": ([(1, 1, 1, 1, 13.0, 100.5, "A", day), (1, 2, 1, 2, 7.0, 9.99, "N", day), (2, 1, 2, 1, 25.0, 0.0, "R", None), (3, 9, 1, 1, 1.0, 1.0, "A", day),
                      (3, 1, 9, 1, 1.0, 1.0, "A", day), (4, 1, 3, 1, 1.0, 1.0, "A", day), (None, 1, 1, 1, 1.0, None, None, day), (9, None, 1, 1, 1.0, 1.0, "A", day),
                      (5, 1, 1, 1, None, 5.0, "A", day), (5, 1, 1, 1, None, 5.0, "A", day)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_shipdate timestamp_ntz"),
        "orders": ([(1, day), (1, dt.datetime(1999, 1, 1)), (2, None), (7, day)], "o_orderkey long, o_orderdate timestamp_ntz"),
        "part": ([(1, "red rod", "B1", "SMALL", 3), (2, None, "B2", "LARGE", 4), (2, "hot bolt", "B2", None, 5)],
                 "p_partkey long, p_name string, p_brand string, p_type string, p_size int"),
        "supplier": ([(1, 1), (2, 1), (2, 2), (3, 7)], "s_suppkey long, s_nationkey int"),
        "nation": ([(1, "X"), (2, "Y")], "n_nationkey int, n_name string")}
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_out}/{name}.parquet")
    for d, n in ((tmp_out, 8), (SF001, 6000)):
        with session.stored_in_turn(spark) as store:
            whole, steps = c.raw(spark, d), postings_in_steps(spark, d, store)
            assert whole.dtypes == steps.dtypes
            assert whole.exceptAll(steps).isEmpty() and steps.exceptAll(whole).isEmpty() and whole.count() == n
