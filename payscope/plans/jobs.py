"""Composite jobs M1-M3.

Order matters: dedup first, so medians and means see one row per posting;
the salary midpoint precedes the yearly scaling, which precedes the pay
bands.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payscope.columns import (COMBINED_TEXT, EXTRACTED_SKILLS, POSTING_DATE, PRIMARY_CATEGORY, QUALIFICATION,
                              RAW, SALARY_FLAG, SALARY_MID, SKILL, PostingColumns)
from payscope.operators import clean as C
from payscope.operators import features as T
from payscope.operators import kpis as K
from payscope.operators.skills import extract_mentions
from payscope.session import delete_folder, materialize
from payscope.sources.sink import write_kpi_csv


def clean(df: DataFrame, cols: PostingColumns = RAW, tiebreak: Sequence[str] = (),
          category_rule: str = "first", keep_bounds: bool = False, date: str | None = None,
          write_out: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """M1: dedup -> salary midpoint -> posting date -> yearly pay -> primary category.

    ``category_rule='first'`` is the untrimmed head (C8); ``'clean'`` the
    trimmed, capitalised variant with 'Unknown' for null (C9).

    ``df`` may hold rows whose texts are not written yet: the key, a ``date`` column,
    the tie-breaks and what ``write_out`` makes the columns of ``cols`` from, row by
    row.  It is then applied to the kept rows only, and the dedup moves narrow rows.
    """
    df = C.dedup_keep_latest(df, cols.job_id, date or cols.posting_date, tiebreak)
    df = write_out(df) if write_out else df
    df = C.salary_to_numeric(df, cols.salary_from, cols.salary_to, keep_bounds=keep_bounds)
    df = C.posting_date_to_date(df, cols.posting_date)
    df = C.normalize_to_annual(df, cols.salary_frequency)
    if category_rule == "first":
        return C.primary_category(df, cols.job_category)
    if category_rule == "clean":
        return C.primary_category_clean(df, cols.job_category)
    raise ValueError("category_rule must be 'first' or 'clean'")


def enrich(df: DataFrame, cols: PostingColumns = RAW, checkpoint_input: bool = False,
           made: list[str] | None = None) -> DataFrame:
    """M2: qualification class -> pay band against its median -> combined text.

    The pay bands need two passes over the input: the medians, then every row
    against them, which come to the rows as a map of T1's five labels.  With ``checkpoint_input`` the cleaned input is
    first written under the shared checkpoint folder, so both passes read
    those files instead of each re-running the upstream scan, joins and
    dedup sort; use it for large runs (it needs ``spark.checkpoint.dir``).
    ``made`` collects the folder, for deletion after the run.
    """
    if checkpoint_input:
        df = materialize(df, "cleaned", made=made)
    df = T.categorize_qualification(df, cols.min_qual)
    df = T.flag_salary_vs_qualification(df, labels=T.QUALIFICATIONS)
    return T.combined_text(df, [cols.preferred_skills, cols.job_description, cols.min_qual])


POSTING_YEAR = "posting_year"


def kpi_base(enriched: DataFrame, cols: PostingColumns = RAW, keywords: Sequence[str] | None = None,
             made: list[str] | None = None) -> DataFrame:
    """The one narrow table that the four KPIs read, stored by posting year.

    Skill mentions are found before writing, so no free text is stored.  Rows
    are rebalanced by year: adaptive execution splits a large year, and joins
    small ones in a task, by the bytes that the shuffle measured, so tasks and files
    have about ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` at any size.
    """
    narrow = extract_mentions(enriched, COMBINED_TEXT, keywords, EXTRACTED_SKILLS).select(
        cols.job_id, cols.agency, POSTING_DATE, SALARY_MID, PRIMARY_CATEGORY, QUALIFICATION, SALARY_FLAG,
        EXTRACTED_SKILLS, F.year(POSTING_DATE).alias(POSTING_YEAR))
    return materialize(narrow.hint("rebalance", POSTING_YEAR), "enriched", [POSTING_YEAR], made)


def kpi_tables(base: DataFrame, cols: PostingColumns = RAW) -> dict[str, tuple[DataFrame, list]]:
    """M3: KPI name -> (rows, order) over ``kpi_base``.  The two-year agency
    window skips older year folders."""
    return {
        "Highest_Paid_Skills": (K.highest_paid_mentions(base, EXTRACTED_SKILLS, cols.job_id),
                                [F.col("avg_salary").desc(), F.col(SKILL)]),
        "Skill_Salary_Distribution": (K.salary_distribution(base, PRIMARY_CATEGORY), [F.col(PRIMARY_CATEGORY)]),
        "Degree_Salary_Correlation": (K.degree_salary_correlation(base),
                                      [F.col(QUALIFICATION), F.col("job_count").desc(), F.col(SALARY_FLAG)]),
        "Agency_insights": (K.agency_insights(base, cols.agency, POSTING_DATE, partition_year=POSTING_YEAR),
                            [F.col("avg_salary_2yr").desc(), F.col(cols.agency)]),
    }


def report(enriched: DataFrame, output_dir: str, cols: PostingColumns = RAW,
           keywords: Sequence[str] | None = None, run_date: str | None = None,
           made: list[str] | None = None) -> dict[str, str]:
    """M3: the four KPI files.  Stored tables, those of ``made`` included, are
    deleted at the end."""
    made = [] if made is None else made
    spark = enriched.sparkSession
    try:
        tables = kpi_tables(kpi_base(enriched, cols, keywords, made), cols)
        return {name: write_kpi_csv(df, name, output_dir, run_date, order) for name, (df, order) in tables.items()}
    finally:
        for path in made:
            delete_folder(spark, path)
