"""Cleaning, projections and casts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from payscope.columns import (POSTING_DATE, PRIMARY_CATEGORY, RANGE_MID, SALARY_FROM_NUM,
                              SALARY_MID, SALARY_TO_NUM)
from payscope.functions.dates import ISO_FORMAT, parse_date, parse_timestamp
from payscope.functions.salary import annualize, coerce_double, strip_to_double
from payscope.functions.text import capitalize_first, strip_ws

# Fixed value: the delimiters that separate categories in one cell.
CATEGORY_HEAD = r"^[^,&/]+"


def _require(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")


def dedup_keep_latest(df: DataFrame, key: str, date: str, tiebreak: Sequence[str],
                      fmt: str = ISO_FORMAT) -> DataFrame:
    """One row per ``key``, the one with the latest ``date``.

    Text dates are compared as parsed with ``fmt``; unusable and null dates
    come last, so any valid date beats them.

    ``tiebreak`` columns (descending) make the choice deterministic when one
    key has several rows with the same date; pass ``()`` to accept an
    arbitrary winner.  Plan: ``row_number() == 1`` lets Spark insert a
    WindowGroupLimit before the shuffle, so every map task forwards at most
    one row per key -- a key holding a third of the table costs no more
    shuffle than any other.
    """
    _require(df, key, date, *tiebreak)
    when = parse_timestamp(date, fmt) if df.schema[date].dataType.simpleString() == "string" else F.col(date)
    order = [when.desc_nulls_last()] + [F.col(c).desc_nulls_last() for c in tiebreak]
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def salary_to_numeric(df: DataFrame, salary_from: str, salary_to: str, out: str = SALARY_MID,
                      keep_bounds: bool = False) -> DataFrame:
    """Midpoint of the two salary bounds after stripping non-numeric text.

    Null when either bound is unusable.  With ``keep_bounds`` the parsed
    bounds stay as ``Salary_From_Value`` / ``Salary_To_Value``.
    """
    lo, hi = strip_to_double(salary_from), strip_to_double(salary_to)
    if keep_bounds:
        df = df.withColumns({SALARY_FROM_NUM: lo, SALARY_TO_NUM: hi})
        return df.withColumn(out, (F.col(SALARY_FROM_NUM) + F.col(SALARY_TO_NUM)) / 2.0)
    return df.withColumn(out, (lo + hi) / 2.0)


def coerce_numeric(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Strict number parse in place; bad text becomes null."""
    return df.withColumns({c: coerce_double(c) for c in columns})


def range_midpoint(df: DataFrame, lo: str, hi: str, out: str = RANGE_MID) -> DataFrame:
    """(lo + hi) / 2 on already numeric bounds (no yearly scaling)."""
    return df.withColumn(out, (F.col(lo) + F.col(hi)) / 2.0)


def posting_date_to_date(df: DataFrame, date_col: str, out: str = POSTING_DATE,
                         fmt: str = ISO_FORMAT, drop_source: bool = True) -> DataFrame:
    """C4: ISO text to a date column; bad text becomes null."""
    _require(df, date_col)
    # Built under a temporary name: with case-insensitive resolution
    # ``posting_date`` and ``Posting_Date`` are the same column.
    df = df.withColumn("_parsed_date", parse_date(date_col, fmt))
    if drop_source:
        df = df.drop(date_col)
    return df.withColumnRenamed("_parsed_date", out)


def coerce_timestamps(df: DataFrame, columns: Iterable[str], fmt: str = ISO_FORMAT) -> DataFrame:
    """Several text columns to timestamps in place; bad text becomes null."""
    return df.withColumns({c: parse_timestamp(c, fmt) for c in columns})


def normalize_to_annual(df: DataFrame, frequency: str, value: str = SALARY_MID,
                        unknown: str = "keep") -> DataFrame:
    """Hourly x2080, Daily x260, Annual x1; other frequencies kept (or null)."""
    return df.withColumn(value, annualize(F.col(value), F.col(frequency), unknown))


def annualize_columns(df: DataFrame, frequency: str, columns: Mapping[str, str],
                      unknown: str = "null") -> DataFrame:
    """As C6 on several columns ``{source: output}``; unknown frequency -> null."""
    return df.withColumns(
        {out: annualize(F.col(src), F.col(frequency), unknown) for src, out in columns.items()})


def primary_category(df: DataFrame, category: str, out: str = PRIMARY_CATEGORY) -> DataFrame:
    """Text before the first ``,`` ``&`` ``/``; untrimmed; leading delimiter -> ''."""
    return df.withColumn(out, F.regexp_extract(F.col(category), CATEGORY_HEAD, 0))


def primary_category_clean(df: DataFrame, category: str, out: str = PRIMARY_CATEGORY,
                           unknown: str = "Unknown") -> DataFrame:
    """Null -> 'Unknown'; quotes/blanks stripped; head trimmed; capitalised."""
    c = F.col(category)
    df = df.withColumn("_clean", F.btrim(c, F.lit("\"' \t\n")))
    df = df.withColumn("_head", F.regexp_extract(F.col("_clean"), CATEGORY_HEAD, 0))
    picked = strip_ws(F.when(F.col("_head") != "", F.col("_head")).otherwise(F.col("_clean")))
    df = df.withColumn("_picked", picked)
    return (df.withColumn(out, F.when(c.isNull(), F.lit(unknown))
                                .otherwise(capitalize_first(F.col("_picked"))))
              .drop("_clean", "_head", "_picked"))


def drop_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Remove helper or raw columns (missing names are ignored)."""
    return df.drop(*columns)


def project(df: DataFrame, columns: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """C11: choose, order and name output columns (``{source: output}``)."""
    if isinstance(columns, Mapping):
        return df.select(*[F.col(s).alias(o) for s, o in columns.items()])
    return df.select(*columns)


def stamp_constants(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    """The same known value on every row."""
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def attach_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Put the columns of a one-row result on every row.

    The one-row result (a global aggregate) becomes a scalar subquery: Spark
    runs it once and inlines its value into the outer plan, so nothing is
    joined, nothing goes through the driver, and its size never depends on
    the input.
    """
    packed = one_row.select(F.struct(*[F.col(f"`{c}`") for c in one_row.columns]).alias("_s")).scalar()
    return df.withColumns({c: packed[c] for c in one_row.columns})
