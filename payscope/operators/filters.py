"""Filters and predicates."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payscope.operators.clean import attach_scalars


def having_min_count(df: DataFrame, count_col: str, threshold: int, strict: bool = False) -> DataFrame:
    """keep groups whose count is >= threshold (> with ``strict``)."""
    c = F.col(count_col)
    return df.where(c > threshold if strict else c >= threshold)


def require_present(df: DataFrame, not_null: Iterable[str] = (), non_empty: Iterable[str] = ()) -> DataFrame:
    """drop rows with a null in ``not_null`` or an empty/null text in ``non_empty``."""
    cond = F.lit(True)
    for c in not_null:
        cond = cond & F.col(c).isNotNull()
    for c in non_empty:
        cond = cond & F.col(c).isNotNull() & (F.length(F.col(c)) > 0)
    return df.where(cond)


def _with_max(df: DataFrame, date_col: str, name: str, dates: DataFrame | None) -> DataFrame:
    return attach_scalars(df, (df if dates is None else dates).agg(F.max(date_col).alias(name)))


def recent_days(df: DataFrame, date_col: str, days: int = 730,
                bounds: tuple[str, str] | None = None, partition_year: str | None = None,
                dates: DataFrame | None = None) -> DataFrame:
    """rows on or after (latest date in the data - ``days``).

    Null dates fall out; if no date is valid at all, every row is kept.
    The latest date is a one-row aggregate used as a scalar subquery: no driver
    round trip.  ``bounds`` names columns to keep the window (from, to).
    ``partition_year`` names a partition column holding the year of
    ``date_col``: an implied condition on it alone lets the scan skip whole
    year partitions once the subquery has run.  ``dates`` is a cheaper table
    with the same latest ``date_col``, such as the postings before C1: a
    latest posting is never dropped there, so the subquery needs no dedup.
    """
    j = _with_max(df, date_col, "_max_date", dates)
    cut = F.date_sub(F.col("_max_date"), days)
    no_max = F.col("_max_date").isNull()
    cond = no_max | (F.col(date_col) >= cut)
    if partition_year:
        cond = (no_max | (F.col(partition_year) >= F.year(cut))) & cond
    out = j.where(cond)
    if bounds:
        out = out.withColumns({bounds[0]: cut, bounds[1]: F.col("_max_date")})
    return out.drop("_max_date")


def recent_years(df: DataFrame, date_col: str, years: int = 2,
                 bounds: tuple[str, str] | None = None, partition_year: str | None = None,
                 dates: DataFrame | None = None) -> DataFrame:
    """rows on or after (latest date - ``years`` calendar years).

    Month arithmetic clamps Feb 29 to Feb 28, so this differs from F3 across
    leap days.  Null dates fall out; with no valid date no row passes.
    ``partition_year`` and ``dates`` as in F3.
    """
    j = _with_max(df, date_col, "_max_date", dates)
    cut = F.add_months(F.col("_max_date"), -12 * years)
    cond = F.col(date_col) >= cut
    if partition_year:
        cond = (F.col(partition_year) >= F.year(cut)) & cond
    out = j.where(cond)
    if bounds:
        out = out.withColumns({bounds[0]: cut, bounds[1]: F.col("_max_date")})
    return out.drop("_max_date")
