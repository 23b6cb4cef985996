"""Profiling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StructField

from payscope.operators.clean import attach_scalars
from payscope.session import shuffles_dropped


# Relative standard deviation of the sketch.
SKETCH_RSD = 0.02
DIGEST_BYTES = 16


def profile(df: DataFrame, sketch: bool = False, at_once: int | None = None) -> DataFrame:
    """One row per column: (column, data_type, rows, non_null, distinct).

    One pass over ``df``: every row goes long as cells (column number, key of the
    value, see ``_key``), null ones too, which are counted per column and key, partly
    in each task already.  Totals, non-null and distinct counts of a column follow
    from these groups, so no column's values meet in one task, ``df`` is not built a
    second time for its totals, and a cell moves as 16 bytes at most however long its
    text is.

    With ``at_once``, for a stored ``df``, the counts are taken at once, by so many
    columns a pass, and a pass's shuffle is dropped before the next: the disk holds
    the cells of these columns only, and the result reads ``df`` no more.

    With ``sketch`` the distinct counts are HyperLogLog++ estimates (standard
    deviation 2 %) from one aggregate whose one-row result is turned long with
    ``inline``, and no cell moves at all.
    """
    if sketch:
        aggs = [F.count(F.lit(1)).alias("_rows")]
        aggs += [F.count(F.col(f"`{c}`")).alias(f"_nn{i}") for i, c in enumerate(df.columns)]
        aggs += [F.approx_count_distinct(F.col(f"`{c}`").cast("string"), SKETCH_RSD).alias(f"_d{i}") for i, c in enumerate(df.columns)]
        rows = [F.struct(*_labels(i, f), F.col("_rows").alias("rows"), F.col(f"_nn{i}").alias("non_null"), F.col(f"_d{i}").alias("distinct"))
                for i, f in enumerate(df.schema.fields)]
        return df.agg(*aggs).select(F.inline(F.array(*rows)))
    fields = list(enumerate(df.schema.fields))
    if at_once:
        spark, rows = df.sparkSession, []
        with shuffles_dropped(spark):
            for k in range(0, len(fields), at_once):
                rows += _counts(df, fields[k:k + at_once]).collect()  # a row for each column
        counts = spark.createDataFrame(rows, "_at int, _rows bigint, _nn bigint, _d bigint")
    else:
        counts = _counts(df, fields)
    # the columns stand for themselves, so a table without rows has its lines too
    columns = df.sparkSession.range(1).select(F.inline(F.array(*[F.struct(*_labels(i, f)) for i, f in fields])))
    return (columns.join(counts, columns["position"] == counts["_at"], "left")
                   .select(*columns.columns, *[F.coalesce(c, F.lit(0)).alias(name)
                                               for c, name in (("_rows", "rows"), ("_nn", "non_null"), ("_d", "distinct"))]))


def _counts(df: DataFrame, fields: Sequence[tuple[int, StructField]]) -> DataFrame:
    """Per column number: rows, non-null rows, distinct values (_at, _rows, _nn, _d)."""
    cells = F.array(*[F.struct(F.lit(i).alias("_at"), _key(f).alias("_v")) for i, f in fields])
    return (df.select(F.inline(cells)).groupBy("_at", "_v").agg(F.count(F.lit(1)).alias("_n"))
              .groupBy("_at").agg(F.sum("_n").alias("_rows"),
                                  F.sum(F.when(F.col("_v").isNotNull(), F.col("_n"))).alias("_nn"),
                                  F.count("_v").alias("_d")))


def _labels(i: int, field: StructField) -> list[Column]:
    return [F.lit(i).alias("position"), F.lit(field.name).alias("column"), F.lit(field.dataType.simpleString()).alias("data_type")]


def _key(field: StructField) -> Column:
    """The value of a column in at most 16 bytes: a whole number by its own bytes, a
    text (of any other value) of under 16 bytes as it is, a longer one by its
    128-bit digest.  Only two long texts of one digest would count as one; at 10^15
    distinct values the chance is below 10^-8.
    """
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, IntegralType):
        return F.unhex(F.hex(c.cast("bigint")))
    text = c.cast("string").cast("binary")
    return F.when(F.length(text) >= DIGEST_BYTES, F.unhex(F.md5(text))).otherwise(text)


def preview(df: DataFrame, n: int = 5, order_by: Sequence[str] = ()) -> DataFrame:
    """First ``n`` rows, by ``order_by`` if given (a top-n, no full sort)."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def value_counts(df: DataFrame, column: str, count_name: str = "count") -> DataFrame:
    """Count per non-null value with its share of all non-null rows.

    ``share_pct`` is the share x100 rounded half-even to one decimal and
    ``percentage`` the same as text with ``%``.  The total is a one-row
    aggregate over the per-value counts, attached as a scalar subquery.
    """
    counts = (df.where(F.col(column).isNotNull())
                .groupBy(column).agg(F.count(F.lit(1)).alias(count_name)))
    total = counts.agg(F.sum(count_name).alias("_total"))
    share = F.bround(F.col(count_name) / F.col("_total") * 100.0, 1)
    return (attach_scalars(counts, total)
            .select(column, count_name, share.alias("share_pct"),
                    F.concat(share.cast("string"), F.lit("%")).alias("percentage")))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of a column, as a DataFrame."""
    return df.select(column).distinct()
