"""One-way analysis of variance of pay across groups (K5)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from payscope.functions.fdist import f_survival
from payscope.operators.aggregates import median_from_pairs, reproducible_mean, reproducible_sum
from payscope.operators.clean import attach_scalars

ALPHA = 0.05
# Texts of the result.
METHOD = "ANOVA F-statistic"
INSUFFICIENT = "Insufficient qualification groups for analysis"


def _f_pvalue(f: Column, df1: Column, df2: Column) -> Column:
    """P(F > f), on the one row of the result."""

    @F.pandas_udf(DoubleType())
    def tail(f: pd.Series, df1: pd.Series, df2: pd.Series) -> pd.Series:
        return pd.Series([f_survival(a, b, c) for a, b, c in zip(f, df1, df2, strict=True)], dtype="float64")

    return tail(*[c.cast("double") for c in (f, df1, df2)])


def _pairs(df: DataFrame, group_col: str, value_col: str) -> DataFrame:
    """Distinct (group, value) pairs of known values with their number, ``_c``.
    Everything below follows from them, so the rows are read and collapsed once."""
    data = df.where(F.col(group_col).isNotNull() & F.col(value_col).isNotNull())
    return data.groupBy(group_col, value_col).agg(F.count(F.lit(1)).alias("_c"))


def salary_stats(df: DataFrame, group_col: str, value_col: str) -> DataFrame:
    """K5: count, mean and exact median of each group's known values."""
    pairs = _pairs(df, group_col, value_col)
    base = pairs.groupBy(group_col).agg(F.sum("_c").alias("n"), reproducible_mean(F.col(value_col), F.col("_c")).alias("mean"))
    # NaN covers no rank
    weighted = pairs.withColumn("_kc", F.when(F.isnan(value_col), F.lit(0).cast("long")).otherwise(F.col("_c")))
    med = median_from_pairs(weighted, [group_col], value_col, "_kc").withColumnRenamed(group_col, "_mk")
    return base.join(med, base[group_col].eqNullSafe(med["_mk"]), "left").drop("_mk")


def anova_stats(df: DataFrame, group_col: str, value_col: str) -> DataFrame:
    """Sums of squares, F and eta squared in one row.

    Groups' counts and means come from the pairs; the grand mean is a one-row
    aggregate of the groups, and the sum of squares within groups one of the
    pairs' deviations from their group's mean.  Sums are exact (see
    ``reproducible_sum``), so the same rows give the same bits however they are
    partitioned.
    """
    pairs = _pairs(df, group_col, value_col)
    groups = pairs.groupBy(group_col).agg(
        F.sum("_c").alias("n"), reproducible_sum(F.col(value_col) * F.col("_c")).alias("total"))
    groups = groups.withColumn("mean", F.col("total") / F.col("n"))
    grand = groups.agg((reproducible_sum(F.col("total")) / F.sum("n")).alias("grand_mean"))
    means = groups.select(F.col(group_col).alias("_group"), "mean")
    off = pairs.join(means, F.col(group_col) == F.col("_group")).select(
        (F.col("_c") * (F.col(value_col) - F.col("mean")) ** 2).alias("_square"))
    s = attach_scalars(groups, grand).agg(
        F.count(F.lit(1)).alias("groups"),
        F.sum("n").alias("n_obs"),
        reproducible_sum(F.col("n") * (F.col("mean") - F.col("grand_mean")) ** 2).alias("ss_between"))
    s = attach_scalars(s, off.agg(reproducible_sum(F.col("_square")).alias("ss_within")))
    k, n = F.col("groups"), F.col("n_obs")
    f_stat = (F.col("ss_between") / (k - 1)) / (F.col("ss_within") / (n - k))
    return s.select(
        "groups", "n_obs", (k - 1).alias("df_between"), (n - k).alias("df_within"),
        "ss_between", "ss_within",
        F.when(k > 1, f_stat).alias("F_statistic"),
        F.when(k > 1, F.col("ss_between") / (F.col("ss_between") + F.col("ss_within")))
         .alias("eta_squared"))


def anova_oneway(df: DataFrame, group_col: str, value_col: str, alpha: float = ALPHA) -> DataFrame:
    """K5: one-row ANOVA result: F, p, eta squared, verdict, group count.

    With fewer than two groups the statistics are null and ``error`` says why.
    """
    st = anova_stats(df, group_col, value_col)
    p = _f_pvalue(F.col("F_statistic"), F.col("df_between"), F.col("df_within"))
    ok = F.col("groups") > 1
    out = st.withColumn("p_value", F.when(ok, p))
    return out.select(
        F.lit(METHOD).alias("method"),
        "F_statistic", "p_value", "eta_squared",
        F.when(ok, F.when(F.col("p_value") < alpha, "significant").otherwise("not significant"))
         .alias("interpretation"),
        F.col("groups").alias("qual_groups"), "df_between", "df_within",
        F.when(~ok, F.lit(INSUFFICIENT)).alias("error"))
