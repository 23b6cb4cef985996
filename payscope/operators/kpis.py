"""KPI aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payscope.columns import EXTRACTED_SKILLS, QUALIFICATION, SALARY_FLAG, SALARY_MID, SKILL, SKILLS_LIST
from payscope.operators.aggregates import exact_median, median_from_pairs, reproducible_mean, reproducible_sum
from payscope.operators.features import pay_band
from payscope.operators.filters import recent_days, recent_years
from payscope.operators.profile import value_counts
from payscope.operators.skills import extract_mentions, generalized_skills
from payscope.sources.taxonomy import TAXONOMY

# Exact pay type: four decimals hold every half-cent amount exactly.
EXACT_PAY = "decimal(30,4)"


def salary_distribution(df: DataFrame, category: str, salary: str = SALARY_MID,
                        min_count: int = 1) -> DataFrame:
    """K1: per category count, rounded mean, median, min, max.

    HAVING count > ``min_count``.  The median is a value of the group, the
    lower middle one for even counts, exact at any size.  As in K2 every
    statistic comes from one collapse to distinct ``(category, salary)``.
    """
    base, med = _from_pairs(df, category, salary, lower=True)
    out = base.join(med, base[category].eqNullSafe(med["_mk"]), "left")
    return (out.select(category, F.col("rows").alias("job_count"), F.round("mean", 0).alias("avg_salary"),
                       F.col("median").alias("median_salary"), F.col("min").alias("min_salary"),
                       F.col("max").alias("max_salary"))
               .where(F.col("job_count") > min_count))


def _from_pairs(df: DataFrame, category: str, salary: str, lower: bool) -> tuple[DataFrame, DataFrame]:
    """Statistics and median per category, from distinct (category, salary) pairs.

    Unknown salaries get multiplicity 0 instead of a filter: a filter on
    the grouping column would be pushed below the shared aggregation and
    turn it into a second one that recomputes everything upstream.
    """
    s = F.col(salary)
    known = s.isNotNull() & ~F.isnan(s)
    pairs = df.groupBy(category, salary).agg(F.count(F.lit(1)).alias("_c"))
    c = F.when(known, F.col("_c"))
    base = pairs.groupBy(category).agg(
        F.sum("_c").alias("rows"),
        F.coalesce(F.sum(c), F.lit(0)).alias("count"),
        F.min(F.when(known, s)).alias("min"),
        F.max(F.when(known, s)).alias("max"),
        reproducible_mean(F.when(known, s), F.col("_c")).alias("mean"))
    weighted = pairs.withColumn("_kc", F.when(known, F.col("_c")).otherwise(F.lit(0).cast("long")))
    med = (median_from_pairs(weighted, [category], salary, "_kc", "median", lower)
           .withColumnRenamed(category, "_mk"))
    return base, med


def salary_distribution_exact(df: DataFrame, category: str, salary: str = SALARY_MID) -> DataFrame:
    """K2: per category count of known salaries, min, max, exact median, mean.

    All values rounded half-even to whole units.  Every statistic comes from
    one collapse of the rows to distinct ``(category, salary)`` pairs with
    their multiplicity, so the input is read and aggregated once (a second
    aggregation branch would recompute everything upstream of it).
    Categories whose salaries are all unknown keep a row with count 0.
    """
    base, med = _from_pairs(df, category, salary, lower=False)
    j = base.join(med, base[category].eqNullSafe(med["_mk"]), "left").drop("_mk")
    return j.select(category, "count",
                    *[F.bround(col, 0).alias(col) for col in ("min", "max", "median", "mean")])


def top_categories(df: DataFrame, category: str, k: int = 10) -> DataFrame:
    """K3: the ``k`` most frequent categories with their share (count desc, name)."""
    vc = value_counts(df, category, "job_postings")
    return vc.orderBy(F.col("job_postings").desc(), F.col(category).asc()).limit(k)


def degree_salary_correlation(df: DataFrame, qual_col: str = QUALIFICATION,
                              flag_col: str = SALARY_FLAG, salary: str = SALARY_MID) -> DataFrame:
    """K4: count and rounded mean pay per (qualification, pay band).

    Ordered by qualification, then count descending (band as last key).
    """
    return (df.groupBy(qual_col, flag_col).agg(
                F.count(F.lit(1)).alias("job_count"),
                F.round(reproducible_mean(F.col(salary)), 0).alias("avg_salary"))
              .orderBy(F.col(qual_col).asc(), F.col("job_count").desc(), F.col(flag_col).asc()))


def degree_salary_from_pay(df: DataFrame, qual_col: str = QUALIFICATION, salary: str = SALARY_MID,
                           out: str = SALARY_FLAG) -> DataFrame:
    """K4 for postings without a band column.

    A band depends on qualification and pay alone, so postings collapse to
    distinct (qualification, pay) pairs with their number, once; medians, bands,
    counts and means all follow from the pairs.  No posting is joined.  An unknown
    pay covers no rank and is, as in T2, "highly paid".
    """
    s = F.col(salary)
    known = s.isNotNull() & ~F.isnan(s)
    pairs = df.groupBy(qual_col, salary).agg(F.count(F.lit(1)).alias("_c"))
    weighted = pairs.withColumn("_kc", F.when(known, F.col("_c")).otherwise(F.lit(0).cast("long")))
    med = median_from_pairs(weighted, [qual_col], salary, "_kc", "_median", lower=True).withColumnRenamed(qual_col, "_mk")
    banded = pairs.join(med, pairs[qual_col].eqNullSafe(med["_mk"]), "left").select(
        qual_col, pay_band(s, F.col("_median")).alias(out), s.alias("_s"), "_c")
    return (banded.groupBy(qual_col, out).agg(
                F.sum("_c").alias("job_count"), F.round(reproducible_mean(F.col("_s"), F.col("_c")), 0).alias("avg_salary"))
              .orderBy(F.col(qual_col).asc(), F.col("job_count").desc(), F.col(out).asc()))


def median_by_group(df: DataFrame, keys: Sequence[str], salary: str = SALARY_MID,
                    out: str = "median_salary") -> DataFrame:
    """K6: exact median per group."""
    return exact_median(df, keys, salary, out)


def agency_insights(df: DataFrame, agency: str, date_col: str, salary: str = SALARY_MID,
                    days: int = 730, min_jobs: int = 3, partition_year: str | None = None,
                    dates: DataFrame | None = None) -> DataFrame:
    """K7: per agency over the last ``days`` days of data.

    One aggregate gives count, mean, max and min; the premium of the best
    paid posting over the mean follows from max - mean.  Agencies with fewer
    than ``min_jobs`` postings are dropped, as is a null agency.  Ordered by
    mean pay descending.

    Pay is summed as ``decimal(30,4)`` (four decimals hold every half-cent
    amount), and mean, premium and percentage follow in decimal arithmetic:
    the result does not depend on the order in which partitions are added.
    ``partition_year`` lets a year-partitioned input skip old partitions, and
    ``dates`` names a cheaper table for the latest date (see F3).
    """
    recent = recent_days(df, date_col, days, partition_year=partition_year, dates=dates)
    pay = F.col(salary).cast(EXACT_PAY)
    stats = (recent.where(F.col(agency).isNotNull()).groupBy(agency).agg(
                F.count(F.lit(1)).alias("job_count_2yr"),
                F.avg(pay).alias("avg_salary_2yr"),
                F.max(salary).alias("High_salary_per_agency"),
                F.min(salary).alias("Min_salary_per_agency"))
               .where(F.col("job_count_2yr") >= min_jobs))
    high = F.col("High_salary_per_agency")
    avg = F.col("avg_salary_2yr")
    premium = high.cast(EXACT_PAY) - avg
    pct = F.round(premium / avg * 100, 1)
    return (stats.select(
                agency, "job_count_2yr", avg.cast("double").alias("avg_salary_2yr"),
                premium.cast("double").alias("salary_premium"),
                pct.cast("double").alias("premium_pct_per_agency"),
                "High_salary_per_agency", "Min_salary_per_agency")
              .orderBy(F.col("avg_salary_2yr").desc(), F.col(agency).asc()))


def top_paid_per_group(df: DataFrame, keys: Sequence[str], salary: str, carry: Sequence[str],
                       tiebreak: str, round_cols: Sequence[str] = ()) -> DataFrame:
    """K8: the best-paid row per group with its details.

    ``max_by`` over (salary, tiebreak) is an ordinary aggregate with a
    partial step, so a hot group is reduced on the map side.  Rows without a
    salary or with a null key are skipped.  ``round_cols`` are rounded
    half-even to whole units.  Ordered by salary descending.
    """
    keys, carry = list(keys), list(carry)
    cond = F.col(salary).isNotNull()
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    payload = F.struct(*[F.col(c) for c in [salary, *carry]])
    best = (df.where(cond).groupBy(*keys)
              .agg(F.max_by(payload, F.struct(F.col(salary), F.col(tiebreak))).alias("_best")))
    out = best.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in [salary, *carry]])
    out = out.withColumns({c: F.bround(F.col(c), 0) for c in round_cols})
    return out.orderBy(F.col(salary).desc(), *[F.col(k).asc() for k in keys])


def recent_avg_by_group(df: DataFrame, keys: Sequence[str], date_col: str, salary: str = SALARY_MID,
                        years: int = 2, min_count: int = 2, partition_year: str | None = None,
                        dates: DataFrame | None = None) -> DataFrame:
    """K9: count of known salaries and mean (half-even, whole units) per group
    over the last ``years`` calendar years, with the window bounds stamped."""
    keys = list(keys)
    recent = recent_years(df, date_col, years, bounds=("from_date", "to_date"), partition_year=partition_year,
                          dates=dates)
    for k in keys:
        recent = recent.where(F.col(k).isNotNull())
    return (recent.groupBy(*keys).agg(
                F.count(salary).alias("job_count"),
                F.bround(reproducible_mean(F.col(salary)), 0).alias("avg_salary"),
                F.first("from_date").alias("from_date"),
                F.first("to_date").alias("to_date"))
              .where(F.col("job_count") >= min_count)
              .orderBy(F.col("avg_salary").desc(), *[F.col(k).asc() for k in keys]))


def _mentions_with_markers(df: DataFrame, skills: str, job_id: str, salary: str) -> DataFrame:
    """One row per skill in ``skills`` plus one marker row (null skill) per
    posting, for postings with a known salary.  The marker rows carry the
    posting-level figures (the global mean) through the same aggregation as
    the skills, so the text is scanned and shuffled once."""
    items = F.concat(F.coalesce(F.col(skills), F.array().cast("array<string>")),
                     F.array(F.lit(None).cast("string")))
    rows = df.where(F.col(salary).isNotNull()).select(F.explode(items).alias(SKILL), salary, job_id)
    return rows.where(F.col(SKILL).isNull() | (F.length(F.col(SKILL)) > 0))


def _per_skill(per_job: DataFrame) -> DataFrame:
    """(skill, job) -> skill: mention count, mean pay, distinct postings.

    Two aggregation levels instead of a ``count(DISTINCT id)`` next to
    plain aggregates, which Spark would plan with an Expand that doubles
    every mention row before the shuffle.  The first level is combined
    map-side and spread by posting, so a hot skill is split over many tasks.
    The null skill (the markers) holds the figures of all postings.
    """
    return per_job.groupBy(SKILL).agg(
        F.sum("_n").alias("job_count"),
        (reproducible_sum(F.col("_s")) / F.sum("_n")).alias("_mean"),
        F.count(F.lit(1)).alias("unique_jobs"))


def _best_paid(per_skill: DataFrame, min_jobs: int, top: int) -> DataFrame:
    """The ``top`` skills by ``avg_salary``, each with the mean pay of all postings
    (``_global``), which the null skill carries.

    The null skill is put first and kept beside the best ones, each task handing on
    no more than that many rows; only those meet in one row, which gives them the
    mean.  A subquery for it would be planned apart from the skills, with other
    columns and joins, and then runs the scan, the joins, the dedup and the text
    a second time.
    """
    marker = F.col(SKILL).isNull()
    first = (per_skill.where(marker | (F.col("job_count") >= min_jobs))
             .orderBy(marker.desc(), F.col("avg_salary").desc(), F.col(SKILL).asc()).limit(top + 1))
    row = first.agg(F.collect_list(F.when(~marker, F.struct(*per_skill.columns))).alias("_skills"),
                    F.max(F.when(marker, F.col("_mean"))).alias("_global"))
    return row.select("_global", F.inline("_skills"))


def highest_paid_skills(df: DataFrame, text_col: str, job_id: str, salary: str = SALARY_MID,
                        keywords: Sequence[str] | None = None, min_jobs: int = 3,
                        top: int = 20) -> DataFrame:
    """Pay per skill mention against the mean pay of all postings.

    ``job_count`` counts mentions (a posting naming a skill twice counts
    twice) and ``avg_salary`` is mention-weighted; ``unique_jobs`` is the
    exact number of postings.  Only ``(skill, salary, id)`` leaves the text
    scan, and everything -- including the global mean, through one marker
    row per posting -- comes out of one pass over the text and one chain of
    aggregations.
    """
    with_sk = extract_mentions(df, text_col, keywords, EXTRACTED_SKILLS)
    return highest_paid_mentions(with_sk, EXTRACTED_SKILLS, job_id, salary, min_jobs, top)


def highest_paid_mentions(df: DataFrame, mentions: str, job_id: str, salary: str = SALARY_MID,
                          min_jobs: int = 3, top: int = 20) -> DataFrame:
    """K10 on a table that already has the array of ``mentions``."""
    rows = _mentions_with_markers(df, mentions, job_id, salary)
    per_job = rows.groupBy(SKILL, job_id).agg(F.count(salary).alias("_n"), reproducible_sum(F.col(salary)).alias("_s"))
    st = _best_paid(_per_skill(per_job).withColumn("avg_salary", F.col("_mean")), min_jobs, top)
    premium = F.col("avg_salary") - F.col("_global")
    return (st.select(SKILL, "job_count", "avg_salary", "unique_jobs",
                      premium.alias("salary_premium"),
                      F.round(premium / F.col("_global") * 100, 1).alias("premium_pct"))
              .orderBy(F.col("avg_salary").desc(), F.col(SKILL).asc())
              .limit(top))


def highest_paid_skills_generalized(df: DataFrame, text_col: str, qual_col: str, job_id: str,
                                    salary: str = SALARY_MID, taxonomy=TAXONOMY, cap: int | None = None,
                                    min_jobs: int = 3, top: int = 20) -> DataFrame:
    """Presence-based skills (T5-T7) with count, mean, exact median and
    distinct postings, all rounded half-even; premium taken from the rounded
    mean against the mean pay of all postings.

    The mentions are dealt by (skill, posting) and aggregated twice from there, by
    posting for the per-skill figures and by pay for the medians: both branches start
    from that one shuffle, so the taxonomy scan of the text runs once, however the
    input is partitioned, and a hot skill is spread by posting.
    """
    sk = generalized_skills(df, text_col, qual_col, taxonomy, cap, SKILLS_LIST)
    rows = _mentions_with_markers(sk, SKILLS_LIST, job_id, salary).repartition(SKILL, job_id)
    per_job = rows.groupBy(SKILL, job_id).agg(F.count(salary).alias("_n"), reproducible_sum(F.col(salary)).alias("_s"))
    # the marker rows cover no rank; the null-safe join infers no filter on the
    # skill, which would make the two branches over the mentions different plans
    weight = F.when(F.col(SKILL).isNull(), F.lit(0)).otherwise(F.lit(1)).cast("long")
    pairs = rows.groupBy(SKILL, salary).agg(F.sum(weight).alias("_c"))
    med = median_from_pairs(pairs, [SKILL], salary, "_c", "median_salary").withColumnRenamed(SKILL, "_mk")
    st = (_best_paid(_per_skill(per_job).withColumn("avg_salary", F.bround("_mean", 0)), min_jobs, top)
          .join(med, F.col(SKILL).eqNullSafe(F.col("_mk")), "left")
          .withColumn("median_salary", F.bround("median_salary", 0)))
    premium = F.col("avg_salary") - F.col("_global")
    return (st.select(SKILL, "job_count", "avg_salary", "median_salary", "unique_jobs",
                      premium.alias("salary_premium"),
                      F.bround(premium / F.col("_global") * 100, 1).alias("premium_pct"))
              .orderBy(F.col("avg_salary").desc(), F.col(SKILL).asc())
              .limit(top))


def global_stats(df: DataFrame, salary: str = SALARY_MID, date_col: str | None = None) -> DataFrame:
    """One-row global mean (and maximum) pay, and latest date if given."""
    aggs = [F.count(salary).alias("salary_count"), reproducible_mean(F.col(salary)).alias("global_avg_salary"),
            F.max(salary).alias("global_max_salary")]
    if date_col:
        aggs.append(F.max(date_col).alias("latest_date"))
    return df.agg(*aggs)
