"""Feature engineering: qualification, pay band, combined text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payscope.columns import COMBINED_TEXT, QUAL_MEDIAN, QUALIFICATION, SALARY_FLAG, SALARY_MID
from payscope.functions.text import lower_concat
from payscope.operators.aggregates import exact_median

# ---------------------------------------------------------------------------
# Qualification rules, first hit wins on the lower-cased text.
# ---------------------------------------------------------------------------
QUALIFICATION_RULES = [
    ("master", "Masters Degree"),
    ("baccalaureate", "Bachelors Degree"),
    ("diploma", "Diploma"),
    ("matriculat", "Matriculation"),
]
QUALIFICATION_DEFAULT = "Experienced"
# every value of T1's result
QUALIFICATIONS = (*[label for _, label in QUALIFICATION_RULES], QUALIFICATION_DEFAULT)

# ---------------------------------------------------------------------------
# Pay bands relative to the qualification median,
# (factor, comparison, label), checked in order; otherwise "highly paid".
# ---------------------------------------------------------------------------
PAY_BANDS = [
    (0.85, "<", "underpaid"),
    (0.95, "<", "below standard"),
    (1.105, "<=", "industry standard"),
    (1.115, "<=", "above standard"),
]
PAY_BAND_DEFAULT = "highly paid"


def categorize_qualification(df: DataFrame, req_col: str, out: str = QUALIFICATION) -> DataFrame:
    """Qualification class from the requirements text (null -> Experienced)."""
    text = F.lower(F.col(req_col))
    expr = None
    for needle, label in QUALIFICATION_RULES:
        cond = text.contains(needle)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return df.withColumn(out, expr.otherwise(QUALIFICATION_DEFAULT))


def qualification_medians(df: DataFrame, qual_col: str = QUALIFICATION, salary: str = SALARY_MID) -> DataFrame:
    """Median pay per qualification: a value of the group, the lower middle one
    for even counts, exact at any size."""
    return exact_median(df, [qual_col], salary, QUAL_MEDIAN, lower=True)


def attach_qualification_median(df: DataFrame, qual_col: str = QUALIFICATION, salary: str = SALARY_MID,
                                labels: Sequence[str] | None = None) -> DataFrame:
    """Rows with their qualification median.

    ``labels`` names every value that ``qual_col`` can have (T1 has five): the
    medians are then one small map, which a scalar subquery hands to the rows, so
    the rows are not joined or shuffled again.  Without it the column may have
    any number of groups, and the rows are left-joined; the planner
    broadcasts the medians only while they are small.  A null or unlisted
    value has no median in the map; a null one has none in the join either.
    """
    medians = qualification_medians(df, qual_col, salary)
    if labels is None:
        return df.join(medians, qual_col, "left")
    # not a filter: pushed below the medians, it would make their plan's branches differ
    listed = F.when(F.col(qual_col).isin(*labels), F.struct(qual_col, QUAL_MEDIAN))
    known = medians.agg(F.map_from_entries(F.collect_list(listed)).alias("_medians")).scalar()
    return df.withColumn(QUAL_MEDIAN, F.when(F.col(qual_col).isNotNull(), F.try_element_at(known, F.col(qual_col))))


def pay_band(salary: Column, median: Column, null_label: str | None = None) -> Column:
    """Band of a pay against a median: the first that holds, else the highest.

    As in the original rules a null salary falls through every comparison
    and ends in "highly paid"; pass ``null_label`` to label it otherwise.
    """
    expr = None if null_label is None else F.when(salary.isNull(), null_label)
    for factor, op, label in PAY_BANDS:
        cond = salary < median * factor if op == "<" else salary <= median * factor
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(PAY_BAND_DEFAULT)


def flag_salary_vs_qualification(df: DataFrame, qual_col: str = QUALIFICATION,
                                 salary: str = SALARY_MID, out: str = SALARY_FLAG,
                                 null_label: str | None = None,
                                 keep_median: bool = False, labels: Sequence[str] | None = None) -> DataFrame:
    """Pay band of each posting against its qualification median (see J1
    for ``labels``)."""
    j = attach_qualification_median(df, qual_col, salary, labels)
    j = j.withColumn(out, pay_band(F.col(salary), F.col(QUAL_MEDIAN), null_label))
    return j if keep_median else j.drop(QUAL_MEDIAN)


def combined_text(df: DataFrame, text_cols: list[str], out: str = COMBINED_TEXT) -> DataFrame:
    """lower(concat_ws(' ', ...)) of the text columns, nulls as ''."""
    return df.withColumn(out, lower_concat(text_cols))
