"""Aggregation building blocks shared by the KPIs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_MANT_BITS = 16
_E_OFFSET = 2048          # exponents of finite doubles lie in [-1074, 1023]


def with_value_bucket(df: DataFrame, value: str, out: str) -> DataFrame:
    """Add an order-preserving bucket of a double column: sign, binary
    exponent and the top 16 mantissa bits packed in one long (``a <= b``
    implies ``bucket(a) <= bucket(b)``).

    Pure arithmetic: scaling by a power of two is exact, and the exponent
    from ``log2`` is corrected by one step either way, so no value lands in
    a wrong bucket; the infinities have the outermost buckets.  Built in small steps (one column each) so that every
    expression is evaluated once and stays inside generated code.
    """
    v = F.col(value)
    infinite = F.lit(float("inf"))
    a = F.when(F.abs(v) < infinite, F.abs(v))  # no exponent for an infinity
    df = df.withColumn("_e0", F.floor(F.log2(a)))
    df = df.withColumn("_p0", F.pow(F.lit(2.0), F.col("_e0")))
    df = df.withColumn("_e", F.when(F.col("_p0") > a, F.col("_e0") - 1)
                             .when(F.col("_p0") * 2 <= a, F.col("_e0") + 1)
                             .otherwise(F.col("_e0")))
    df = df.withColumn("_d", F.floor((a / F.pow(F.lit(2.0), F.col("_e")) - 1.0) * (1 << _MANT_BITS)))
    top = F.lit(1 << 40)
    e, d = F.col("_e"), F.col("_d")
    pos = top * 3 + (e + _E_OFFSET) * (1 << _MANT_BITS) + d
    neg = top * 1 + (F.lit(_E_OFFSET) - e) * (1 << _MANT_BITS) + ((1 << _MANT_BITS) - 1 - d)
    # coalesce: the bucket is declared non-null, so a join on it infers no
    # ``isnotnull(bucket)`` filter (which would be pushed, with the whole
    # expression inlined, below the aggregation onto every input row)
    bucket = (F.when(v == infinite, top * 4).when(v == -infinite, F.lit(0))
              .when(v > 0, pos).when(v < 0, neg).otherwise(top * 2).cast("long"))
    df = df.withColumn(out, F.coalesce(bucket, F.lit(0).cast("long")))
    return df.drop("_e0", "_p0", "_e", "_d")


# Sums are exact at this scale: pay has at most a few decimals.
EXACT_SUM = "decimal(38,12)"


def reproducible_sum(value: Column) -> Column:
    """Sum of doubles whose bits do not depend on how rows are partitioned: each is
    taken to twelve decimals and added exactly.  If one is too large for that (10^26
    or more, infinite) or NaN, the sum is that of doubles."""
    value = value.cast("double")
    fixed = value.try_cast(EXACT_SUM)
    misfits = F.count(F.when(value.isNotNull() & fixed.isNull(), True))
    return F.coalesce(F.when(misfits == 0, F.try_sum(fixed).cast("double")), F.sum(value))


def reproducible_mean(value: Column, weight: Column | None = None) -> Column:
    """Mean of the known values, each with an optional multiplicity."""
    if weight is None:
        return reproducible_sum(value) / F.count(value)
    return reproducible_sum(value * weight) / F.sum(F.when(value.isNotNull(), weight))


def exact_median(df: DataFrame, keys: Sequence[str], value: str, out: str = "median",
                 lower: bool = False) -> DataFrame:
    """Exact median per group (mean of the two middle values for even n;
    with ``lower`` the lower one of them).

    Distributed selection on three levels, with no group gathered in one task:

    1. rows collapse to distinct ``(keys, value)`` pairs with their
       multiplicity (map-side partial aggregation), and each pair gets an
       order-preserving value bucket (sign, exponent, top 16 mantissa bits);
    2. totals per ``(keys, octave)`` (sign and exponent, at most some 4,200 a
       group whatever the data) and a running sum locate the octaves of the middle
       ranks;
    3. inside those octaves alone, totals per bucket (at most 65,536 an
       octave) and a running sum by ``(keys, octave)`` locate the buckets;
    4. only pairs in those buckets are ranked exactly, partitioned by
       ``(keys, bucket)``, so a hot group is spread over its buckets and a
       task sees one bucket (a 1/65536 slice of a binary order of
       magnitude) of one group.

    Nulls and NaN are ignored; groups without values produce no row.
    """
    v = F.col(value)
    pairs = df.where(v.isNotNull() & ~F.isnan(v)).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"))
    return median_from_pairs(pairs, keys, value, "_c", out, lower)


def _covers(lo: Column, hi: Column) -> Column:
    """Whether the ranks from ``lo`` to ``hi`` hold a middle one."""
    r1, r2 = F.col("_r1"), F.col("_r2")
    return ((lo <= r1) & (hi >= r1)) | ((lo <= r2) & (hi >= r2))


def median_from_pairs(pairs: DataFrame, keys: Sequence[str], value: str, count: str,
                      out: str = "median", lower: bool = False) -> DataFrame:
    """Steps 2-4 of :func:`exact_median` on already collapsed
    ``(keys, value, count)`` rows, so a caller that needs other statistics
    from the same pairs shares one aggregation.  Values to ignore (null,
    NaN) must carry count 0: they then cover no rank.

    The group travels as one struct column: struct equality treats null
    fields as equal, so a null group is matched by a plain equi-join, and
    the join and the ranking window share one partitioning.
    """
    keys = list(keys)
    pairs = with_value_bucket(
        pairs.select(F.struct(*[F.col(k) for k in keys]).alias("_k"), value, F.col(count).alias("_c")),
        value, "_b")
    pairs = pairs.withColumn("_o", F.shiftright("_b", _MANT_BITS))
    upto = (Window.unboundedPreceding, Window.currentRow)
    octaves = pairs.groupBy("_k", "_o").agg(F.sum("_c").alias("_oc"))
    group = Window.partitionBy("_k")
    octaves = octaves.select("_k", "_o", "_oc", F.sum("_oc").over(group.orderBy("_o").rowsBetween(*upto)).alias("_cum"),
                             F.sum("_oc").over(group).alias("_n"))
    r1 = F.floor((F.col("_n") + 1) / 2)
    ranks = octaves.withColumns({"_r1": r1, "_r2": r1 if lower else F.floor(F.col("_n") / 2) + 1,
                                 "_before": F.col("_cum") - F.col("_oc")})
    in_octave = ranks.where(_covers(F.col("_before") + 1, F.col("_cum"))).select("_k", "_o", "_before", "_r1", "_r2")

    buckets = pairs.join(in_octave, ["_k", "_o"]).groupBy("_k", "_o", "_b").agg(
        F.sum("_c").alias("_bc"), *[F.max(c).alias(c) for c in ("_before", "_r1", "_r2")])
    within = Window.partitionBy("_k", "_o").orderBy("_b").rowsBetween(*upto)
    buckets = buckets.withColumn("_cum", F.col("_before") + F.sum("_bc").over(within))
    in_bucket = buckets.where(_covers(F.col("_cum") - F.col("_bc") + 1, F.col("_cum"))).select(
        "_k", "_b", (F.col("_cum") - F.col("_bc")).alias("_base"), "_r1", "_r2")

    cand = pairs.join(in_bucket, ["_k", "_b"])
    ranked = cand.withColumn("_hi", F.col("_base") + F.sum("_c").over(Window.partitionBy("_k", "_b").orderBy(value).rowsBetween(*upto)))
    picked = ranked.where(_covers(F.col("_hi") - F.col("_c") + 1, F.col("_hi")))
    med = picked.groupBy("_k").agg(F.avg(value).alias(out))
    return med.select(*[F.col("_k")[k].alias(k) for k in keys], out)
