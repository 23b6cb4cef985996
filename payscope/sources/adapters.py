"""Adapters that present the driver's parquet tables as postings.

Adapter A turns ``lineitem`` (joined to part, supplier, nation, orders) into
a raw postings table with the same string columns as the postings CSV, so
that every structured operator runs over the whole ``lineitem`` table.
Adapter B presents ``documents`` as postings with long free text for the
keyword operators.

Join strategy: ``nation`` has a fixed 25 rows (TPC-H constant) and is
broadcast explicitly.  ``part``, ``supplier`` and ``orders`` grow with the
scale factor, so no hint is given: the planner broadcasts them only while
their estimated size is under ``spark.sql.autoBroadcastJoinThreshold`` and
falls back to sort-merge joins beyond it.  ``orders`` is joined last on the
order key, which is also the posting key, so after the dedup window it
reuses that hash partitioning instead of shuffling the rows again; plans that do
not read the order date do not join it at all.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payscope.columns import COMBINED_TEXT, SALARY_MID, SNAKE
from payscope.functions.dates import ISO_FORMAT, parse_timestamp

# Fixed values of adapter A (see FIXTURES.md section 5); each list is indexed
# by a key of the row modulo its length.
QUAL_TEXTS = [
    "A Masters degree",
    "A baccalaureate degree",
    "High school diploma",
    "Matriculation",
    "Five years of experience",
    None,
    "A Masters degree in engineering; knowledge in data analysis.",
    "A baccalaureate degree and legal experience in contract review.",
    "Diploma in public health, must have team lead skills.",
    "Experience in accounting and finance; skilled in financial modeling.",
]
PREFERRED_TEXTS = [
    "{name}",
    "Python; SQL, Java",
    "AutoCAD|Revit | CAD ",
    "https://skills.example/list, Excel; r",
    None,
    "Vendor Management; Six Sigma, MS Project",
    " C++ , C#;Java/Scala",
    "",
    "sql server|MySQL;Oracle",
]
DESCRIPTION_TEXTS = [
    "",
    ". Requires data analysis, and experience in project planning; must have python skills.",
    ". Proficienc in sap and oracle, knowledge: in aws; stakeholder management expertise",
    ". The unit needs sql programming, web development; r & d analysis and strong writing skills",
    ". Need first aid, cpr. Supervisory experience, excel proficienc wanted.",
]
CATEGORY_SEPARATORS = [" & ", ", ", "/"]
FREQUENCY_BY_FLAG = {"A": "Annual", "N": "Daily"}  # anything else: Hourly
NA_QUANTITY = 13
WEEKLY_QUANTITY = 7  # a frequency without a factor
PLAIN_FROM_QUANTITY = 20  # salary bounds without the currency sign from here on

# Columns that break ties between lines of one order (the key/line pair is
# not unique in the generated tables).
TIEBREAK = ("line_number", "part_key", "supp_key", SNAKE.salary_to, SNAKE.salary_frequency)
POSTED = "posted"  # the posting date of a line, by which the latest is kept


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def fact_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str]) -> DataFrame:
    """Scan only ``columns`` of a fact table (the first is its key).

    A table kept as one small file is one split.  A caller that wants such a
    scan spread (tests, the bench) says so in ``payscope.scan.partitions``;
    unset, as on a cluster, nothing is added to the scan.
    """
    df = table(spark, sf_dir, name).select(*columns)
    parts = spark.conf.get("payscope.scan.partitions", None)
    return df.repartition(int(parts), columns[0]) if parts else df


def _pick(texts: list[str | None], key: Column) -> Column:
    """The text at ``key`` modulo the list's length."""
    return F.element_at(F.array(*[F.lit(t).cast("string") for t in texts]), (key % len(texts) + 1).cast("int"))


def _money_text(x: Column) -> Column:
    sign = F.when(F.col("l_quantity") >= PLAIN_FROM_QUANTITY, F.lit("")).otherwise(F.lit("$"))
    return F.concat(sign, x.cast("decimal(12,2)").cast("string"))


def lines_from_tpch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``postings_from_tpch`` before its texts are written: posting key,
    posting day (``POSTED``), tie-breaks, and the columns that the texts come from.

    A text follows from its row alone, so a dedup sorts and shuffles these narrow
    rows and ``postings_from_lines`` writes the texts of the rows that it kept.
    """
    # nation last: a join's size is not known when it is planned, and supplier joined
    # with nation first would never count as small
    j = _with_supplier(_with_part(_lineitem(spark, sf_dir), spark, sf_dir), spark, sf_dir)
    return _with_nation(j, spark, sf_dir).select(*_line_columns())


def _lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_table(spark, sf_dir, "lineitem", [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_returnflag", "l_shipdate"])


def _with_part(j: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    return j.join(part, j.l_partkey == part.p_partkey).drop("p_partkey")


def _with_supplier(j: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return j.join(supp, j.l_suppkey == supp.s_suppkey).drop("s_suppkey")


def _with_nation(j: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return j.join(F.broadcast(nation), j.s_nationkey == nation.n_nationkey).drop("s_nationkey", "n_nationkey")


def _with_order_date(j: DataFrame, key: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    # One date per order key.  Declaring the key unique this way lets the
    # optimizer drop the left join altogether in plans that never read the
    # order date (most KPIs), so ``orders`` is not even scanned for them.
    orders = (fact_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate"])
              .groupBy("o_orderkey").agg(F.max("o_orderdate").alias("o_orderdate")))
    return j.join(orders, j[key] == orders.o_orderkey, "left").drop("o_orderkey")


def _line_columns() -> list[Column | str]:
    freq = F.coalesce(
        F.when(F.col("l_quantity") == WEEKLY_QUANTITY, F.lit("Weekly")),
        *[F.when(F.col("l_returnflag") == k, F.lit(v)) for k, v in FREQUENCY_BY_FLAG.items()],
        F.lit("Hourly"))
    # the day that the posting date's text reads as; a year that ISO_FORMAT does not
    # read back as written goes through the text
    day = (F.when(F.year("l_shipdate").between(1, 9999), F.to_date("l_shipdate").cast("timestamp_ntz"))
           .otherwise(parse_timestamp(_day_text())))
    return [
        F.col("l_orderkey").alias(SNAKE.job_id),
        day.alias(POSTED),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("part_key"),
        F.col("l_suppkey").alias("supp_key"),
        _money_text(F.col("l_extendedprice") + F.lit(100) * F.col("l_quantity")).alias(SNAKE.salary_to),
        freq.alias(SNAKE.salary_frequency),
        "l_quantity", "l_extendedprice", "l_shipdate", "n_name", "p_name", "p_brand", "p_type", "p_size"]


def _day_text() -> Column:
    return F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit("T00:00:00.000"))


def postings_from_lines(lines: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw postings (snake_case names, all text like the CSV) from the lines."""
    return _with_order_date(lines, SNAKE.job_id, spark, sf_dir).select(*_posting_columns())


def _posting_columns() -> list[Column | str]:
    pk = F.col("part_key")
    sep = _pick(CATEGORY_SEPARATORS, pk)
    category = F.when(pk % 17 == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.col("p_type"), sep, F.col("p_brand")))
    preferred = F.replace(_pick(PREFERRED_TEXTS, pk), F.lit("{name}"), F.col("p_name"))
    order_ts = F.date_format("o_orderdate", ISO_FORMAT)

    return [
        SNAKE.job_id,
        F.col("n_name").alias(SNAKE.agency),
        F.col("p_name").alias(SNAKE.business_title),
        F.col("line_number").cast("string").alias(SNAKE.positions),
        category.alias(SNAKE.job_category),
        F.when(F.col("l_quantity") == NA_QUANTITY, F.lit("N/A"))
         .otherwise(_money_text(F.col("l_extendedprice"))).alias(SNAKE.salary_from),
        SNAKE.salary_to,
        SNAKE.salary_frequency,
        _pick(QUAL_TEXTS, F.col("p_size")).alias(SNAKE.min_qual),
        F.concat(F.col("p_type"), F.lit(" "), F.col("p_brand"), _pick(DESCRIPTION_TEXTS, pk)).alias(SNAKE.job_description),
        preferred.alias(SNAKE.preferred_skills),
        _day_text().alias(SNAKE.posting_date),
        order_ts.alias(SNAKE.posting_updated),
        order_ts.alias(SNAKE.process_date),
        "line_number", "part_key", "supp_key",
    ]


def postings_from_tpch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw postings (snake_case names, all text like the CSV) from lineitem."""
    return postings_from_lines(lines_from_tpch(spark, sf_dir), spark, sf_dir)


def postings_in_steps(spark: SparkSession, sf_dir: str, store: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """The rows of ``postings_from_tpch`` for a plan that reads every column of every
    line: ``store`` (rows and a name -> the same rows, stored) after each join.

    A line is then dealt out by one key at a time, so the disk holds one shuffle
    beside the table before it, not all of them.  Names come last, and the texts of
    a posting are written as the stored rows are read: no shuffle of lines moves one,
    and the columns of a part are stored in the order of its key.
    """
    j = _lineitem(spark, sf_dir)
    j = store(_with_order_date(j, "l_orderkey", spark, sf_dir), "lines-dated")
    j = store(_with_supplier(j, spark, sf_dir), "lines-supplied")
    j = store(_with_nation(_with_part(j, spark, sf_dir), spark, sf_dir), "lines-named")
    return j.select(*_line_columns(), "o_orderdate").select(*_posting_columns())


def postings_from_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as postings: long free text, source as agency, size as pay.

    ``combined_text`` is the lower-cased full text (never a prefix) and
    ``Annual_Salary_Mid`` is ``n_chars`` as a double.  The text also serves
    as qualification text for the contextual-skill rules.
    """
    d = fact_table(spark, sf_dir, "documents", ["doc_id", "source", "lang", "text", "n_chars"])
    return d.select(
        F.col("doc_id").alias(SNAKE.job_id),
        F.col("source").alias(SNAKE.agency),
        F.col("lang"),
        F.lower(F.col("text")).alias(COMBINED_TEXT),
        F.col("text").alias(SNAKE.min_qual),
        F.col("n_chars").cast("double").alias(SALARY_MID),
    )
