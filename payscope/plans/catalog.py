"""Registered queries: one per operator of the inventory, over the test tables.

Postings come from adapter A (``lineitem`` joined to part, supplier, nation,
orders); long-text queries (suffix ``_docs``) run on adapter B
(``documents``).  Every query reads whole tables and whole texts.

Where a result column is a mean of doubles, the query rounds it to cents
(2 decimals) so that engines that add in a different order agree (the last
bits of a double sum depend on the order); the operators themselves return
unrounded values.
Arrays are shown joined with ``|`` so they compare as plain text.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payscope.columns import (COMBINED_TEXT, EXTRACTED_SKILLS, POSTING_DATE, PRIMARY_CATEGORY,
                              QUAL_MEDIAN, QUALIFICATION, RANGE_MID, SALARY_FLAG, SALARY_FROM_NUM,
                              SALARY_MID, SALARY_TO_NUM, SKILLS_LIST)
from payscope.columns import RAW
from payscope.columns import SNAKE as S
from payscope.operators import anova as A
from payscope.operators import clean as C
from payscope.operators import features as T
from payscope.operators import filters as FL
from payscope.operators import kpis as K
from payscope.operators import profile as P
from payscope.operators import skills as SK
from payscope.plans import jobs
from payscope.sources.adapters import (POSTED, TIEBREAK, lines_from_tpch, postings_from_documents, postings_from_lines,
                                       postings_from_tpch, postings_in_steps)
from payscope.session import checkpoint_dir, stored_in_turn
from payscope.sources.csv import read_postings_csv
from payscope.sources.sink import write_kpi_csv
from payscope.sources.taxonomy import TAXONOMY, TECH_SKILLS, read_taxonomy_json, vocabulary, write_taxonomy_json

# ---------------------------------------------------------------------------
# Test vocabularies.  The part-name words are the 16 words the
# table generator draws part names from; the plain words are frequent words
# of the generated English prose.
# ---------------------------------------------------------------------------
PART_WORDS = ["anvil", "blue", "bolt", "cold", "gear", "gizmo", "hot", "large",
              "new", "old", "plate", "red", "ring", "rod", "small", "widget"]
PLAIN_WORDS = ["the", "of", "and", "to", "in", "that", "for", "with", "this", "from"]
PLAIN_TAXONOMY = {"plain": {"words": PLAIN_WORDS}}

# The vocabularies with the plain words added: documents have hits, and the
# whole vocabulary is still looked for.
DOCS_TAXONOMY = {**TAXONOMY, **PLAIN_TAXONOMY}
DOCS_VOCABULARY = {**TECH_SKILLS, "plain": PLAIN_WORDS}

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


# ------------------------------------------------------------------ inputs
def raw(spark: SparkSession, d: str) -> DataFrame:
    return postings_from_tpch(spark, d)


def dedup(spark: SparkSession, d: str) -> DataFrame:
    return postings_from_lines(C.dedup_keep_latest(lines_from_tpch(spark, d), S.job_id, POSTED, TIEBREAK), spark, d)


def m1(spark: SparkSession, d: str, **kw) -> DataFrame:
    return jobs.clean(lines_from_tpch(spark, d), S, TIEBREAK, date=POSTED,
                      write_out=lambda kept: postings_from_lines(kept, spark, d), **kw)


def m2(spark: SparkSession, d: str) -> DataFrame:
    return jobs.enrich(m1(spark, d), S)


def qualified(spark: SparkSession, d: str) -> DataFrame:
    """Cleaned postings with their qualification class, no pay band."""
    return T.categorize_qualification(m1(spark, d), S.min_qual)


def with_text(spark: SparkSession, d: str) -> DataFrame:
    """Cleaned postings with their combined text, no pay band."""
    return T.combined_text(m1(spark, d), [S.preferred_skills, S.job_description, S.min_qual])


def dates(spark: SparkSession, d: str) -> DataFrame:
    """Posting dates before dedup, whose latest is that of the kept postings."""
    return C.posting_date_to_date(raw(spark, d).select(S.posting_date), S.posting_date)


def docs(spark: SparkSession, d: str) -> DataFrame:
    return postings_from_documents(spark, d)


def _round(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), n) for c, n in digits.items()})


def _joined(c, name: str):
    return F.array_join(c, "|").alias(name)


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# ------------------------------------------------------------------ source and sink
@query("S1")
def s1(spark, d):
    """The postings as a CSV of the original header (gzip: its texts repeat), read by
    name; an empty field is null."""
    path = _folder(spark, "postings-csv")
    columns = list(zip(S.names(), RAW.names(), strict=True))
    (raw(spark, d).select(*[F.col(a).cast("string").alias(b) for a, b in reversed(columns)])
     .write.options(header=True, escape='"', compression="gzip", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path))
    return read_postings_csv(spark, path).select(*[F.col(b).alias(a) for a, b in columns])


@query("S3")
def s3(spark, d):
    """A KPI as the job writes it, read back from its file."""
    kpi = K.salary_distribution_exact(m1(spark, d, category_rule="clean"), PRIMARY_CATEGORY)
    path = write_kpi_csv(kpi, "Skill_Salary_Distribution", _folder(spark, "kpi"), order_by=[F.col(PRIMARY_CATEGORY)])
    return spark.read.schema(kpi.schema).options(header=True, escape='"').csv(path)


# ------------------------------------------------------------------ profiling
COLUMNS_AT_ONCE = 6  # of the 17 of the postings: three passes over the stored lines


@query("P1")
def p1(spark, d):
    with stored_in_turn(spark) as store:
        return P.profile(postings_in_steps(spark, d, store), at_once=COLUMNS_AT_ONCE)


@query("P2")
def p2(spark, d):
    return P.preview(raw(spark, d), 5, [S.job_id, "line_number", "part_key", "supp_key", S.salary_to])


@query("P3")
def p3(spark, d):
    return P.value_counts(raw(spark, d), S.salary_frequency)


@query("P4")
def p4(spark, d):
    return P.distinct_values(raw(spark, d), S.salary_frequency)


# ------------------------------------------------------------------ cleaning
@query("C1")
def c1(spark, d):
    return dedup(spark, d)


@query("C2")
def c2(spark, d):
    df = C.salary_to_numeric(dedup(spark, d), S.salary_from, S.salary_to, keep_bounds=True)
    return df.select(S.job_id, S.salary_from, S.salary_to, SALARY_FROM_NUM, SALARY_TO_NUM, SALARY_MID)


@query("C3")
def c3(spark, d):
    df = C.coerce_numeric(dedup(spark, d), [S.salary_from, S.salary_to, S.positions])
    df = C.range_midpoint(df, S.salary_from, S.salary_to)
    return df.select(S.job_id, S.salary_from, S.salary_to, S.positions, RANGE_MID)


@query("C4")
def c4(spark, d):
    return C.posting_date_to_date(dedup(spark, d), S.posting_date).select(S.job_id, POSTING_DATE)


@query("C5")
def c5(spark, d):
    cols = [S.posting_date, S.posting_updated, S.process_date]
    return C.coerce_timestamps(dedup(spark, d), cols).select(S.job_id, *cols)


@query("C6")
def c6(spark, d):
    return m1(spark, d).select(S.job_id, S.salary_frequency, SALARY_MID)


@query("C7")
def c7(spark, d):
    df = C.salary_to_numeric(dedup(spark, d), S.salary_from, S.salary_to, out=RANGE_MID, keep_bounds=True)
    df = C.annualize_columns(df, S.salary_frequency, {
        SALARY_FROM_NUM: "Annual_Salary_From", SALARY_TO_NUM: "Annual_Salary_To", RANGE_MID: SALARY_MID})
    return df.select(S.job_id, S.salary_frequency, "Annual_Salary_From", "Annual_Salary_To", SALARY_MID)


@query("C8")
def c8(spark, d):
    return m1(spark, d).select(S.job_id, S.job_category, PRIMARY_CATEGORY)


@query("C9")
def c9(spark, d):
    return C.primary_category_clean(dedup(spark, d), S.job_category).select(
        S.job_id, S.job_category, PRIMARY_CATEGORY)


@query("C10")
def c10(spark, d):
    return C.drop_columns(m1(spark, d), [S.job_description, S.preferred_skills, S.posting_updated,
                                         S.process_date, "line_number", "part_key", "supp_key"])


@query("C11")
def c11(spark, d):
    return C.project(m2(spark, d), {
        S.job_id: "Job ID", S.agency: "Agency", PRIMARY_CATEGORY: "Primary Job Category",
        QUALIFICATION: "Qualification", SALARY_FLAG: "Pay Band", SALARY_MID: "Annual Salary"})


@query("C12")
def c12(spark, d):
    df = C.stamp_constants(m1(spark, d), {"salary_basis": "Annual"})
    df = C.attach_scalars(df, df.agg(F.avg(SALARY_MID).alias("global_avg_salary")))
    return _round(df.select(S.job_id, "salary_basis", "global_avg_salary"), {"global_avg_salary": 2})


# ------------------------------------------------------------------ filters
@query("F1")
def f1(spark, d):
    g = m1(spark, d).groupBy(S.agency, S.business_title).agg(F.count(F.lit(1)).alias("job_count"))
    return FL.having_min_count(g, "job_count", 3)


@query("F2")
def f2(spark, d):
    df = FL.require_present(m1(spark, d), not_null=[SALARY_MID], non_empty=[PRIMARY_CATEGORY])
    return df.select(S.job_id, SALARY_MID, PRIMARY_CATEGORY)


@query("F3")
def f3(spark, d):
    df = FL.recent_days(m1(spark, d), POSTING_DATE, 730, bounds=("from_date", "to_date"), dates=dates(spark, d))
    return df.select(S.job_id, POSTING_DATE, "from_date", "to_date")


@query("F4")
def f4(spark, d):
    df = FL.recent_years(m1(spark, d), POSTING_DATE, 2, bounds=("from_date", "to_date"), dates=dates(spark, d))
    return df.select(S.job_id, POSTING_DATE, "from_date", "to_date")


# ------------------------------------------------------------------ features
@query("T1")
def t1(spark, d):
    return qualified(spark, d).select(S.job_id, S.min_qual, QUALIFICATION)


@query("T2")
def t2(spark, d):
    df = T.flag_salary_vs_qualification(qualified(spark, d), keep_median=True, labels=T.QUALIFICATIONS)
    return df.select(S.job_id, QUALIFICATION, SALARY_MID, QUAL_MEDIAN, SALARY_FLAG)


@query("J1")
def j1(spark, d):
    df = T.attach_qualification_median(qualified(spark, d), labels=T.QUALIFICATIONS)
    return df.select(S.job_id, QUALIFICATION, QUAL_MEDIAN)


@query("T3")
def t3(spark, d):
    return with_text(spark, d).select(S.job_id, COMBINED_TEXT)


@query("T4")
def t4(spark, d):
    df = SK.extract_mentions(with_text(spark, d), COMBINED_TEXT, PART_WORDS)
    return df.select(S.job_id, _joined(F.col(EXTRACTED_SKILLS), "skills"),
                     F.size(EXTRACTED_SKILLS).alias("n_mentions"))


@query("T4_docs")
def t4_docs(spark, d):
    df = SK.extract_mentions(docs(spark, d), COMBINED_TEXT, PLAIN_WORDS)
    return df.select(S.job_id, _joined(F.col(EXTRACTED_SKILLS), "skills"),
                     F.size(EXTRACTED_SKILLS).alias("n_mentions"))


@query("T5_docs")
def t5_docs(spark, d):
    return docs(spark, d).select(S.job_id, _joined(SK.namespaced_presence(F.col(COMBINED_TEXT), DOCS_TAXONOMY), "labels"))


@query("T6_docs")
def t6_docs(spark, d):
    return docs(spark, d).select(S.job_id, _joined(SK.contextual_skills(F.col(S.min_qual)), "labels"))


@query("T7_docs")
def t7_docs(spark, d):
    df = SK.generalized_skills(docs(spark, d), COMBINED_TEXT, S.min_qual, DOCS_TAXONOMY)
    return df.select(S.job_id, _joined(F.col(SKILLS_LIST), "skills"))


@query("T8_docs")
def t8_docs(spark, d):
    return docs(spark, d).select(S.job_id, _joined(SK.tech_skills(F.col(COMBINED_TEXT), DOCS_VOCABULARY), "skills"))


@query("T5")
def t5(spark, d):
    return with_text(spark, d).select(S.job_id, _joined(SK.namespaced_presence(F.col(COMBINED_TEXT)), "labels"))


@query("T5_table")
def t5_table(spark, d):
    path = write_taxonomy_json(spark, _folder(spark, "taxonomy"))
    known = vocabulary(read_taxonomy_json(spark, path))
    df = SK.vocabulary_presence(with_text(spark, d), S.job_id, COMBINED_TEXT, known)
    return df.select(S.job_id, _joined(F.col("labels"), "labels"))


@query("T6")
def t6(spark, d):
    return m1(spark, d).select(S.job_id, _joined(SK.contextual_skills(F.col(S.min_qual)), "labels"))


@query("T7")
def t7(spark, d):
    df = SK.generalized_skills(with_text(spark, d), COMBINED_TEXT, S.min_qual)
    return df.select(S.job_id, _joined(F.col(SKILLS_LIST), "skills"))


@query("T8")
def t8(spark, d):
    text = F.concat_ws(" ", F.coalesce(F.col(S.preferred_skills), F.lit("")),
                       F.coalesce(F.col(S.job_description), F.lit("")),
                       F.coalesce(F.col(S.min_qual), F.lit("")))
    return m1(spark, d).select(S.job_id, _joined(SK.tech_skills(text), "skills"))


@query("T9")
def t9(spark, d):
    df = m1(spark, d)
    return df.select(S.job_id, _joined(SK.parse_preferred(F.col(S.preferred_skills),
                                                           F.col(S.job_description)), "skills"))


@query("T10_docs")
def t10_docs(spark, d):
    return docs(spark, d).select(S.job_id, _joined(SK.skill_phrases(F.col(COMBINED_TEXT)), "skills"))


@query("T10")
def t10(spark, d):
    df = m1(spark, d)
    text = F.concat_ws(" ", F.col(S.job_description), F.col(S.min_qual), F.col(S.preferred_skills))
    return df.select(S.job_id, _joined(SK.skill_phrases(text), "skills"))


def _docs_as_postings(spark, d):
    none = F.lit(None).cast("string")
    return docs(spark, d).withColumns({S.preferred_skills: none, "no_qual": none})


@query("T11_docs")
def t11_docs(spark, d):
    df = SK.skills_cascade(_docs_as_postings(spark, d), S.preferred_skills, S.min_qual, "no_qual", vocab=DOCS_VOCABULARY)
    return df.select(S.job_id, _joined(F.col(SKILLS_LIST), "skills"), "skills_count")


@query("T11")
def t11(spark, d):
    df = SK.skills_cascade(m1(spark, d), S.preferred_skills, S.job_description, S.min_qual)
    return df.select(S.job_id, _joined(F.col(SKILLS_LIST), "skills"), "skills_count")


@query("T12_docs")
def t12_docs(spark, d):
    df = docs(spark, d).withColumn(SKILLS_LIST, SK.tech_skills(F.col(COMBINED_TEXT), DOCS_VOCABULARY))
    return SK.with_skills_count(df).select(S.job_id, "skills_count")


@query("T12")
def t12(spark, d):
    df = SK.skills_cascade(m1(spark, d), S.preferred_skills, S.job_description, S.min_qual)
    return df.select(S.job_id, "skills_count")


@query("T13")
def t13(spark, d):
    df = SK.extract_mentions(with_text(spark, d), COMBINED_TEXT, PART_WORDS)
    return SK.explode_skills(df, EXTRACTED_SKILLS, [S.job_id, SALARY_MID])


@query("T13_docs")
def t13_docs(spark, d):
    df = SK.extract_mentions(docs(spark, d), COMBINED_TEXT, PLAIN_WORDS)
    return SK.explode_skills(df, EXTRACTED_SKILLS, [S.job_id, SALARY_MID])


# ------------------------------------------------------------------ KPIs
@query("K1")
def k1(spark, d):
    return K.salary_distribution(m1(spark, d), PRIMARY_CATEGORY)


@query("K2")
def k2(spark, d):
    return K.salary_distribution_exact(m1(spark, d, category_rule="clean"), PRIMARY_CATEGORY)


@query("K3")
def k3(spark, d):
    return K.top_categories(m1(spark, d, category_rule="clean"), PRIMARY_CATEGORY, 10)


@query("K4")
def k4(spark, d):
    return K.degree_salary_from_pay(qualified(spark, d))


_ANOVA_COLS = ["groups", "n_obs", "df_between", "df_within", "F_statistic", "eta_squared"]


@query("K5")
def k5(spark, d):
    st = A.anova_stats(qualified(spark, d), QUALIFICATION, SALARY_MID).select(*_ANOVA_COLS)
    return _round(st, {"F_statistic": 6, "eta_squared": 9})


@query("K5_docs")
def k5_docs(spark, d):
    st = A.anova_stats(docs(spark, d), "lang", SALARY_MID).select(*_ANOVA_COLS)
    return _round(st, {"F_statistic": 6, "eta_squared": 9})


@query("K5_test")
def k5_test(spark, d):
    return _round(A.anova_oneway(qualified(spark, d), QUALIFICATION, SALARY_MID),
                  {"F_statistic": 6, "p_value": 9, "eta_squared": 9})


@query("K5_groups")
def k5_groups(spark, d):
    return _round(A.salary_stats(qualified(spark, d), QUALIFICATION, SALARY_MID), {"mean": 2})


@query("K6")
def k6(spark, d):
    return K.median_by_group(qualified(spark, d), [QUALIFICATION])


@query("K7")
def k7(spark, d):
    return _round(K.agency_insights(m1(spark, d), S.agency, POSTING_DATE, dates=dates(spark, d)),
                  {"avg_salary_2yr": 2, "salary_premium": 2})


@query("K8")
def k8(spark, d):
    df = m1(spark, d, category_rule="clean", keep_bounds=True)
    return K.top_paid_per_group(df, [S.agency, PRIMARY_CATEGORY], SALARY_MID,
                                carry=[S.job_id, SALARY_FROM_NUM, SALARY_TO_NUM, S.business_title],
                                tiebreak=S.job_id, round_cols=[SALARY_MID, SALARY_FROM_NUM, SALARY_TO_NUM])


@query("K9")
def k9(spark, d):
    return K.recent_avg_by_group(m1(spark, d, category_rule="clean"), [S.agency, PRIMARY_CATEGORY],
                                 POSTING_DATE, dates=dates(spark, d))


_K10_ROUND = {"avg_salary": 2, "salary_premium": 2}


@query("K10")
def k10(spark, d):
    return _round(K.highest_paid_skills(with_text(spark, d), COMBINED_TEXT, S.job_id), _K10_ROUND)


@query("K10_parts")
def k10_parts(spark, d):
    return _round(K.highest_paid_skills(with_text(spark, d), COMBINED_TEXT, S.job_id, keywords=PART_WORDS),
                  _K10_ROUND)


@query("K10_docs")
def k10_docs(spark, d):
    return _round(K.highest_paid_skills(docs(spark, d), COMBINED_TEXT, S.job_id, keywords=PLAIN_WORDS),
                  _K10_ROUND)


@query("K11")
def k11(spark, d):
    return _round(K.highest_paid_skills_generalized(with_text(spark, d), COMBINED_TEXT, S.min_qual, S.job_id),
                  {"salary_premium": 2})


@query("K11_docs")
def k11_docs(spark, d):
    return _round(K.highest_paid_skills_generalized(docs(spark, d), COMBINED_TEXT, S.min_qual, S.job_id,
                                                    taxonomy=DOCS_TAXONOMY), {"salary_premium": 2})


@query("K12")
def k12(spark, d):
    return _round(K.global_stats(m1(spark, d), SALARY_MID, POSTING_DATE), {"global_avg_salary": 2})


# ------------------------------------------------------------------ sorts, jobs
@query("O1")
def o1(spark, d):
    return (m1(spark, d).select(S.job_id, SALARY_MID)
            .orderBy(F.col(SALARY_MID).desc_nulls_last(), F.col(S.job_id).asc()))


@query("O2")
def o2(spark, d):
    return (m1(spark, d).select(S.agency, SALARY_MID, S.job_id)
            .orderBy(F.col(S.agency).asc(), F.col(SALARY_MID).desc(), F.col(S.job_id).asc()))


@query("O3")
def o3(spark, d):
    return (m1(spark, d).select(S.job_id, S.agency, SALARY_MID)
            .orderBy(F.col(SALARY_MID).desc_nulls_last(), F.col(S.job_id).asc()).limit(10))


@query("M1")
def q_m1(spark, d):
    return m1(spark, d)


@query("M2")
def q_m2(spark, d):
    return m2(spark, d)


# what M2 and the KPI table read of a cleaned posting
_KPI_INPUT = [S.job_id, S.agency, POSTING_DATE, SALARY_MID, PRIMARY_CATEGORY, S.preferred_skills, S.job_description, S.min_qual]


def _m3(name: str, digits: dict[str, int]) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        cleaned = C.project(m1(spark, d), _KPI_INPUT)
        base = jobs.kpi_base(jobs.enrich(cleaned, S, checkpoint_input=True), S)
        return _round(jobs.kpi_tables(base, S)[name][0], digits)
    return run


# M3 on the path that the job ships: stored cleaned input, stored narrow table, then the KPI
QUERIES["M3_skills"] = _m3("Highest_Paid_Skills", _K10_ROUND)
QUERIES["M3_distribution"] = _m3("Skill_Salary_Distribution", {})
QUERIES["M3_degrees"] = _m3("Degree_Salary_Correlation", {})
QUERIES["M3_agencies"] = _m3("Agency_insights", {"avg_salary_2yr": 2, "salary_premium": 2})
