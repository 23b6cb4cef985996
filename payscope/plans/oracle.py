"""DuckDB SQL for the registered queries (the correctness oracle).

Each string runs on the pre-registered views ``lineitem part supplier nation
orders documents ...`` and must give the same rows and column names as the
Spark query of the same key.  The SQL is written independently of the Spark
plans: window functions where Spark uses an aggregate, ``quantile_disc`` /
``median`` for the medians, tokens for word matching.

K7 uses exact decimal pay: mean, premium and percentage are rounded half-up
from exact integer arithmetic here, so ties at half a cent agree.

Regex notes: DuckDB's RE2 has no look-around.  A whole-word *presence* test
is written with consuming boundary groups, which is exact for a yes/no
test.  *Mention lists* of single-word keywords are taken as the maximal
word-character runs that equal a keyword, which is what the look-around
pattern finds for such keywords.  For phrases and ``c++`` every separator
is doubled first, so that neighbouring hits do not share one and boundaries
can be consumed.  In the phrase patterns the look-ahead for ``. , ;`` is
consumed too: no hit starts with one of these.
"""

from __future__ import annotations

from payscope.plans.catalog import DOCS_TAXONOMY, DOCS_VOCABULARY, PART_WORDS, PLAIN_WORDS
from payscope.sources.adapters import DESCRIPTION_TEXTS, PREFERRED_TEXTS, QUAL_TEXTS
from payscope.sources.taxonomy import TAXONOMY, TECH_SKILLS, flat_keywords, taxonomy_entries

WORDCH = r"[\p{L}\p{Nd}_]"
NONWORD = r"[^\p{L}\p{Nd}_]"
# Unicode blanks by code point
WS = " || ".join(f"chr({c})" for c in [*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288])
META = set("\\.^$|?*+()[]{}")


def esc(s: str) -> str:
    return "".join("\\" + c if c in META else c for c in s)


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def str_list(items) -> str:
    return "[" + ", ".join(lit(x) for x in items) + "]::VARCHAR[]"


def annual(v: str) -> str:
    return (f"CASE WHEN salary_frequency = 'Hourly' THEN {v} * 2080 "
            f"WHEN salary_frequency = 'Daily' THEN {v} * 260 ELSE {v} END")


def num(c: str) -> str:
    return f"TRY_CAST(regexp_replace({c}, '[^\\d.]', '', 'g') AS DOUBLE)"


def pick(texts, key: str) -> str:
    """The text at ``key`` modulo the list's length."""
    whens = " ".join(f"WHEN {i} THEN {'NULL' if t is None else lit(t)}" for i, t in enumerate(texts))
    return f"CASE {key} % {len(texts)} {whens} END"


def money(v: str) -> str:
    return f"(CASE WHEN l.l_quantity >= 20 THEN '' ELSE '$' END) || CAST(CAST({v} AS DECIMAL(12,2)) AS VARCHAR)"


ISO = "'%Y-%m-%dT%H:%M:%S.%g'"

POSTINGS = f"""postings AS (
  SELECT l.l_orderkey AS job_id,
         n.n_name AS agency,
         p.p_name AS business_title,
         CAST(l.l_linenumber AS VARCHAR) AS number_of_positions,
         CASE WHEN p.p_partkey % 17 = 0 THEN NULL
              ELSE p.p_type || (CASE p.p_partkey % 3 WHEN 0 THEN ' & ' WHEN 1 THEN ', ' ELSE '/' END) || p.p_brand
         END AS job_category,
         CASE WHEN l.l_quantity = 13 THEN 'N/A'
              ELSE {money('l.l_extendedprice')} END AS salary_range_from,
         {money('l.l_extendedprice + 100 * l.l_quantity')} AS salary_range_to,
         CASE WHEN l.l_quantity = 7 THEN 'Weekly' WHEN l.l_returnflag = 'A' THEN 'Annual'
              WHEN l.l_returnflag = 'N' THEN 'Daily' ELSE 'Hourly' END AS salary_frequency,
         {pick(QUAL_TEXTS, 'p.p_size')} AS minimum_qual_requirements,
         p.p_type || ' ' || p.p_brand || {pick(DESCRIPTION_TEXTS, 'p.p_partkey')} AS job_description,
         replace({pick(PREFERRED_TEXTS, 'p.p_partkey')}, '{{name}}', p.p_name) AS preferred_skills,
         strftime(l.l_shipdate, '%Y-%m-%d') || 'T00:00:00.000' AS posting_date,
         strftime(o.o_orderdate, {ISO}) AS posting_updated,
         strftime(o.o_orderdate, {ISO}) AS process_date,
         l.l_linenumber AS line_number,
         l.l_partkey AS part_key,
         l.l_suppkey AS supp_key
  FROM lineitem l
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

DEDUP = f"""dedup AS (
  SELECT * EXCLUDE (_rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY
        try_strptime(posting_date, {ISO}) DESC NULLS LAST, line_number DESC NULLS LAST, part_key DESC NULLS LAST,
        supp_key DESC NULLS LAST, salary_range_to DESC NULLS LAST,
        salary_frequency DESC NULLS LAST) AS _rn
    FROM postings) WHERE _rn = 1)"""

PDATE = f"CAST(try_strptime(posting_date, {ISO}) AS DATE)"

M1 = f"""m1 AS (
  SELECT * EXCLUDE (posting_date, _mid),
         {annual('_mid')} AS Annual_Salary_Mid,
         {PDATE} AS Posting_Date,
         regexp_extract(job_category, '^[^,&/]+', 0) AS Primary_Job_Category
  FROM (SELECT *, ({num('salary_range_from')} + {num('salary_range_to')}) / 2.0 AS _mid FROM dedup))"""

C9_TRIM = "'\"'' ' || chr(9) || chr(10)"

# clean variant: C9 category, numeric bounds kept
M1C = f"""m1c AS (
  SELECT * EXCLUDE (posting_date, _lo, _hi, _c, _h),
         _lo AS Salary_From_Value, _hi AS Salary_To_Value,
         {annual('(_lo + _hi) / 2.0')} AS Annual_Salary_Mid,
         {PDATE} AS Posting_Date,
         CASE WHEN job_category IS NULL THEN 'Unknown'
              ELSE upper(substr(CASE WHEN _h <> '' THEN trim(_h, {WS}) ELSE trim(_c, {WS}) END, 1, 1))
                || lower(substr(CASE WHEN _h <> '' THEN trim(_h, {WS}) ELSE trim(_c, {WS}) END, 2))
         END AS Primary_Job_Category
  FROM (SELECT *, regexp_extract(_c, '^[^,&/]+', 0) AS _h FROM (
          SELECT *, {num('salary_range_from')} AS _lo, {num('salary_range_to')} AS _hi,
                 trim(job_category, {C9_TRIM}) AS _c FROM dedup)))"""

QUAL_CASE = """CASE WHEN contains(lower(minimum_qual_requirements), 'master') THEN 'Masters Degree'
       WHEN contains(lower(minimum_qual_requirements), 'baccalaureate') THEN 'Bachelors Degree'
       WHEN contains(lower(minimum_qual_requirements), 'diploma') THEN 'Diploma'
       WHEN contains(lower(minimum_qual_requirements), 'matriculat') THEN 'Matriculation'
       ELSE 'Experienced' END"""

Q1 = f"q1 AS (SELECT *, {QUAL_CASE} AS Qualification_Category FROM m1)"
MED = """med AS (SELECT Qualification_Category, quantile_disc(Annual_Salary_Mid, 0.5) AS qual_median_salary
        FROM q1 GROUP BY Qualification_Category)"""
FLAGGED = """flagged AS (
  SELECT q1.*, med.qual_median_salary,
         CASE WHEN Annual_Salary_Mid < qual_median_salary * 0.85 THEN 'underpaid'
              WHEN Annual_Salary_Mid < qual_median_salary * 0.95 THEN 'below standard'
              WHEN Annual_Salary_Mid <= qual_median_salary * 1.105 THEN 'industry standard'
              WHEN Annual_Salary_Mid <= qual_median_salary * 1.115 THEN 'above standard'
              ELSE 'highly paid' END AS Salary_Qual_Flag
  FROM q1 LEFT JOIN med ON q1.Qualification_Category = med.Qualification_Category)"""
M2 = """m2 AS (
  SELECT * EXCLUDE (qual_median_salary),
         lower(concat_ws(' ', coalesce(preferred_skills, ''), coalesce(job_description, ''),
                         coalesce(minimum_qual_requirements, ''))) AS combined_text
  FROM flagged)"""

DOCS = """docs AS (
  SELECT doc_id AS job_id, source AS agency, lang, lower(text) AS combined_text,
         text AS minimum_qual_requirements, CAST(n_chars AS DOUBLE) AS Annual_Salary_Mid
  FROM documents)"""


def w(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE_M1 = (POSTINGS, DEDUP, M1)
BASE_M1C = (POSTINGS, DEDUP, M1C)
BASE_M2 = (POSTINGS, DEDUP, M1, Q1, MED, FLAGGED, M2)


# ------------------------------------------------------------------ regex helpers
def present(text: str, kw: str) -> str:
    return f"regexp_matches({text}, '(^|{NONWORD}){esc(kw)}({NONWORD}|$)')"


def presence_list(text: str, entries) -> str:
    items = ", ".join(f"CASE WHEN {present(text, kw)} THEN {lit(label)} END" for label, kw in entries)
    return f"list_filter([{items}]::VARCHAR[], lambda x: x IS NOT NULL)"


def word_mentions(text: str, words) -> str:
    """Mentions of single-word keywords, in text order."""
    inside = ", ".join(lit(x) for x in words)
    return (f"list_filter(regexp_extract_all({text}, '{WORDCH}+'), "
            f"lambda x: x IN ({inside}))")


def alternation_mentions(text: str, keywords) -> str:
    """Mentions via one RE2 alternation over the text with doubled separators."""
    uniq = sorted(set(k.lower() for k in keywords), key=lambda k: (-len(k), k))
    body = "|".join(esc("".join(c if c.isalnum() or c == "_" else c + c for c in k)) for k in uniq)
    doubled = f"regexp_replace({text}, '({NONWORD})', '\\1\\1', 'g')"
    found = f"regexp_extract_all({doubled}, '(?:^|{NONWORD})({body})(?:{NONWORD}|$)', 1)"
    return f"list_transform({found}, lambda x: replace(replace(x, '  ', ' '), '++++', '++'))"


def phrases(text: str) -> str:
    t = f"lower({text})"
    patterns = [r"(?:proficiency?|experience|knowledge|skilled)[\s:]*in[\s]*([a-zA-Z0-9\s&/]+?)[.,;]",
                r"(?:requires?|need|must have)[\s]*([a-zA-Z0-9\s&/]+?)[.,;]",
                r"([a-zA-Z0-9\s&/]+?)(?:programming|development|analysis|expertise)",
                r"\b([a-z]{3,})[\s]+(?:skills?|experience?|proficiency?)\b"]
    hits = "list_concat(" + ", ".join(f"regexp_extract_all({t}, '{p}', 1)" for p in patterns) + ")"
    trimmed = f"list_transform({hits}, lambda x: trim(x, {WS}))"
    kept = f"list_filter({trimmed}, lambda x: length(x) > 2 AND length(x) <= 20)"
    return f"CASE WHEN {text} IS NULL THEN []::VARCHAR[] ELSE list_sort(list_distinct({kept})) END"


def contextual(qual: str) -> str:
    t = f"lower(coalesce({qual}, ''))"
    return (f"CASE WHEN contains({t}, 'engineering') OR contains({t}, 'architecture') "
            f"THEN ['engineering_design', 'technical_drafting'] "
            f"WHEN contains({t}, 'legal') THEN ['legal_research', 'contract_review'] "
            f"WHEN contains({t}, 'health') OR contains({t}, 'medical') THEN ['patient_care', 'clinical_assessment'] "
            f"WHEN contains({t}, 'finance') OR contains({t}, 'accounting') "
            f"THEN ['financial_reporting', 'audit_compliance'] ELSE []::VARCHAR[] END")


def namespaced(text: str, tax) -> str:
    return presence_list(text, [(f"{d}_{s}_{k}", k) for d, s, k in taxonomy_entries(tax)])


def generalized(text: str, qual: str, tax) -> str:
    labels = f"list_concat({namespaced(text, tax)}, {contextual(qual)})"
    cut = f"list_transform({labels}, lambda x: substr(x, strpos(x, '_') + 1))"
    return f"list_sort(list_distinct({cut}))"


def tech(text: str, vocab=TECH_SKILLS) -> str:
    t = f"lower(coalesce({text}, ''))"
    return f"list_sort(list_distinct({presence_list(t, [(k, k) for ks in vocab.values() for k in ks])}))"


def joined(expr: str, name: str) -> str:
    return f"array_to_string({expr}, '|') AS {name}"


# ------------------------------------------------------------------ queries
SQL: dict[str, str] = {}

P1_FIELDS = [("job_id", "bigint"), ("agency", "string"), ("business_title", "string"),
             ("number_of_positions", "string"), ("job_category", "string"),
             ("salary_range_from", "string"), ("salary_range_to", "string"),
             ("salary_frequency", "string"), ("minimum_qual_requirements", "string"),
             ("job_description", "string"), ("preferred_skills", "string"),
             ("posting_date", "string"), ("posting_updated", "string"), ("process_date", "string"),
             ("line_number", "int"), ("part_key", "bigint"), ("supp_key", "bigint")]
SQL["P1"] = w(POSTINGS) + "\nUNION ALL\n".join(
    f"SELECT {i} AS position, '{c}' AS \"column\", '{t}' AS data_type, count(*) AS \"rows\", "
    f"count({c}) AS non_null, count(DISTINCT {c}) AS \"distinct\" FROM postings" for i, (c, t) in enumerate(P1_FIELDS))

_SHARE = "round_even(CAST(\"count\" AS DOUBLE) / CAST(_total AS DOUBLE) * 100.0, 1)"
SQL["P3"] = w(POSTINGS, """c AS (SELECT salary_frequency, count(*) AS "count" FROM postings
      WHERE salary_frequency IS NOT NULL GROUP BY salary_frequency)""",
              't AS (SELECT sum("count") AS _total FROM c)') + \
    f"SELECT salary_frequency, \"count\", {_SHARE} AS share_pct, CAST({_SHARE} AS VARCHAR) || '%' AS percentage FROM c, t"

SQL["P4"] = w(POSTINGS) + "SELECT DISTINCT salary_frequency FROM postings"

SQL["S1"] = w(POSTINGS) + """SELECT CAST(job_id AS VARCHAR) AS job_id, agency, business_title, number_of_positions, job_category,
  salary_range_from, salary_range_to, salary_frequency, minimum_qual_requirements, job_description,
  nullif(preferred_skills, '') AS preferred_skills, posting_date, posting_updated, process_date FROM postings"""
SQL["C1"] = w(POSTINGS, DEDUP) + "SELECT * FROM dedup"
SQL["C2"] = w(POSTINGS, DEDUP) + f"""SELECT job_id, salary_range_from, salary_range_to,
  {num('salary_range_from')} AS Salary_From_Value, {num('salary_range_to')} AS Salary_To_Value,
  ({num('salary_range_from')} + {num('salary_range_to')}) / 2.0 AS Annual_Salary_Mid FROM dedup"""
SQL["C3"] = w(POSTINGS, DEDUP) + """SELECT job_id, TRY_CAST(salary_range_from AS DOUBLE) AS salary_range_from,
  TRY_CAST(salary_range_to AS DOUBLE) AS salary_range_to,
  TRY_CAST(number_of_positions AS DOUBLE) AS number_of_positions,
  (TRY_CAST(salary_range_from AS DOUBLE) + TRY_CAST(salary_range_to AS DOUBLE)) / 2.0 AS Salary_Range_Mid
  FROM dedup"""
SQL["C4"] = w(POSTINGS, DEDUP) + f"SELECT job_id, {PDATE} AS Posting_Date FROM dedup"
SQL["C5"] = w(POSTINGS, DEDUP) + f"""SELECT job_id, try_strptime(posting_date, {ISO}) AS posting_date,
  try_strptime(posting_updated, {ISO}) AS posting_updated, try_strptime(process_date, {ISO}) AS process_date
  FROM dedup"""
SQL["C6"] = w(*BASE_M1) + "SELECT job_id, salary_frequency, Annual_Salary_Mid FROM m1"
_C7_NULL = ("CASE WHEN salary_frequency = 'Annual' THEN {v} WHEN salary_frequency = 'Hourly' THEN {v} * 2080 "
            "WHEN salary_frequency = 'Daily' THEN {v} * 260 END")
SQL["C7"] = w(POSTINGS, DEDUP) + f"""SELECT job_id, salary_frequency,
  {_C7_NULL.format(v='_lo')} AS Annual_Salary_From, {_C7_NULL.format(v='_hi')} AS Annual_Salary_To,
  {_C7_NULL.format(v='(_lo + _hi) / 2.0')} AS Annual_Salary_Mid
  FROM (SELECT *, {num('salary_range_from')} AS _lo, {num('salary_range_to')} AS _hi FROM dedup)"""
SQL["C8"] = w(*BASE_M1) + "SELECT job_id, job_category, Primary_Job_Category FROM m1"
SQL["C9"] = w(*BASE_M1C) + "SELECT job_id, job_category, Primary_Job_Category FROM m1c"
SQL["C10"] = w(*BASE_M1) + """SELECT * EXCLUDE (job_description, preferred_skills, posting_updated,
  process_date, line_number, part_key, supp_key) FROM m1"""
SQL["C11"] = w(*BASE_M2) + """SELECT job_id AS "Job ID", agency AS "Agency",
  Primary_Job_Category AS "Primary Job Category", Qualification_Category AS "Qualification",
  Salary_Qual_Flag AS "Pay Band", Annual_Salary_Mid AS "Annual Salary" FROM m2"""
SQL["C12"] = w(*BASE_M1) + """SELECT job_id, 'Annual' AS salary_basis,
  round((SELECT avg(Annual_Salary_Mid) FROM m1), 2) AS global_avg_salary FROM m1"""

SQL["F1"] = w(*BASE_M1) + """SELECT agency, business_title, count(*) AS job_count FROM m1
  GROUP BY agency, business_title HAVING count(*) >= 3"""
SQL["F2"] = w(*BASE_M1) + """SELECT job_id, Annual_Salary_Mid, Primary_Job_Category FROM m1
  WHERE Annual_Salary_Mid IS NOT NULL AND Primary_Job_Category IS NOT NULL AND length(Primary_Job_Category) > 0"""
SQL["F3"] = w(*BASE_M1, "mx AS (SELECT max(Posting_Date) AS _max FROM m1)") + """SELECT job_id, Posting_Date,
  CAST(_max - INTERVAL 730 DAY AS DATE) AS from_date, _max AS to_date FROM m1, mx
  WHERE _max IS NULL OR Posting_Date >= CAST(_max - INTERVAL 730 DAY AS DATE)"""
SQL["F4"] = w(*BASE_M1, "mx AS (SELECT max(Posting_Date) AS _max FROM m1)") + """SELECT job_id, Posting_Date,
  CAST(_max - INTERVAL 2 YEAR AS DATE) AS from_date, _max AS to_date FROM m1, mx
  WHERE Posting_Date >= CAST(_max - INTERVAL 2 YEAR AS DATE)"""

SQL["T1"] = w(*BASE_M1, Q1) + "SELECT job_id, minimum_qual_requirements, Qualification_Category FROM q1"
SQL["T2"] = w(*BASE_M1, Q1, MED, FLAGGED) + """SELECT job_id, Qualification_Category, Annual_Salary_Mid,
  qual_median_salary, Salary_Qual_Flag FROM flagged"""
SQL["J1"] = w(*BASE_M1, Q1, MED) + """SELECT job_id, q1.Qualification_Category, qual_median_salary
  FROM q1 LEFT JOIN med ON q1.Qualification_Category = med.Qualification_Category"""
SQL["T3"] = w(*BASE_M2) + "SELECT job_id, combined_text FROM m2"

_T4 = word_mentions("combined_text", PART_WORDS)
SQL["T4"] = w(*BASE_M2) + f"SELECT job_id, {joined(_T4, 'skills')}, CAST(len({_T4}) AS INTEGER) AS n_mentions FROM m2"
_T4D = word_mentions("combined_text", PLAIN_WORDS)
SQL["T4_docs"] = w(DOCS) + f"SELECT job_id, {joined(_T4D, 'skills')}, CAST(len({_T4D}) AS INTEGER) AS n_mentions FROM docs"
SQL["T5_docs"] = w(DOCS) + f"SELECT job_id, {joined(namespaced('combined_text', DOCS_TAXONOMY), 'labels')} FROM docs"
SQL["T6_docs"] = w(DOCS) + f"SELECT job_id, {joined(contextual('minimum_qual_requirements'), 'labels')} FROM docs"
SQL["T7_docs"] = w(DOCS) + f"""SELECT job_id,
  {joined(generalized('combined_text', 'minimum_qual_requirements', DOCS_TAXONOMY), 'skills')} FROM docs"""
SQL["T8_docs"] = w(DOCS) + f"SELECT job_id, {joined(tech('combined_text', DOCS_VOCABULARY), 'skills')} FROM docs"
_T9_SPLIT = (f"list_transform(list_filter(string_split_regex(lower(preferred_skills), '[;,|]'), "
             f"lambda x: length(trim(x, {WS})) > 2 AND NOT starts_with(x, 'http')), lambda x: trim(x, {WS}))")
SQL["T5"] = w(*BASE_M2) + f"SELECT job_id, {joined(namespaced('combined_text', TAXONOMY), 'labels')} FROM m2"
SQL["T5_table"] = w(*BASE_M2) + f"""SELECT * FROM (
  SELECT job_id, array_to_string(list_sort({namespaced('combined_text', TAXONOMY)}), '|') AS labels FROM m2) WHERE labels <> ''"""
SQL["T6"] = w(*BASE_M2) + f"SELECT job_id, {joined(contextual('minimum_qual_requirements'), 'labels')} FROM m2"
SQL["T7"] = w(*BASE_M2) + f"""SELECT job_id,
  {joined(generalized('combined_text', 'minimum_qual_requirements', TAXONOMY), 'skills')} FROM m2"""
SQL["T8"] = w(*BASE_M2) + f"""SELECT job_id, {joined(tech("concat_ws(' ', coalesce(preferred_skills, ''), "
                                                    "coalesce(job_description, ''), coalesce(minimum_qual_requirements, ''))"),
                                               'skills')} FROM m2"""
SQL["T13"] = w(*BASE_M2) + f"""SELECT skill, job_id, Annual_Salary_Mid FROM (
  SELECT unnest({_T4}) AS skill, job_id, Annual_Salary_Mid FROM m2)
  WHERE skill IS NOT NULL AND length(skill) > 0"""
SQL["T9"] = w(*BASE_M2) + f"""SELECT job_id, array_to_string(CASE WHEN preferred_skills IS NULL
  THEN {tech('job_description')} ELSE {_T9_SPLIT} END, '|') AS skills FROM m2"""
SQL["T12_docs"] = w(DOCS) + f"SELECT job_id, CAST(len({tech('combined_text', DOCS_VOCABULARY)}) AS INTEGER) AS skills_count FROM docs"
SQL["T13_docs"] = w(DOCS) + f"""SELECT skill, job_id, Annual_Salary_Mid FROM (
  SELECT unnest({_T4D}) AS skill, job_id, Annual_Salary_Mid FROM docs)
  WHERE skill IS NOT NULL AND length(skill) > 0"""

SQL["K1"] = w(*BASE_M1) + """SELECT Primary_Job_Category, count(*) AS job_count,
  round(avg(Annual_Salary_Mid), 0) AS avg_salary,
  quantile_disc(Annual_Salary_Mid, 0.5) AS median_salary,
  min(Annual_Salary_Mid) AS min_salary, max(Annual_Salary_Mid) AS max_salary
  FROM m1 GROUP BY Primary_Job_Category HAVING count(*) > 1"""
SQL["K2"] = w(*BASE_M1C) + """SELECT Primary_Job_Category, count(Annual_Salary_Mid) AS "count",
  round_even(min(Annual_Salary_Mid), 0) AS "min", round_even(max(Annual_Salary_Mid), 0) AS "max",
  round_even(median(Annual_Salary_Mid), 0) AS median, round_even(avg(Annual_Salary_Mid), 0) AS mean
  FROM m1c GROUP BY Primary_Job_Category"""
_K3_SHARE = "round_even(CAST(job_postings AS DOUBLE) / CAST(_total AS DOUBLE) * 100.0, 1)"
SQL["K3"] = w(*BASE_M1C, """c AS (SELECT Primary_Job_Category, count(*) AS job_postings FROM m1c
      WHERE Primary_Job_Category IS NOT NULL GROUP BY Primary_Job_Category)""",
              "t AS (SELECT sum(job_postings) AS _total FROM c)") + \
    f"""SELECT Primary_Job_Category, job_postings, {_K3_SHARE} AS share_pct,
  CAST({_K3_SHARE} AS VARCHAR) || '%' AS percentage FROM c, t
  ORDER BY job_postings DESC, Primary_Job_Category ASC LIMIT 10"""
SQL["K4"] = w(*BASE_M2) + """SELECT Qualification_Category, Salary_Qual_Flag, count(*) AS job_count,
  round(avg(Annual_Salary_Mid), 0) AS avg_salary FROM m2
  GROUP BY Qualification_Category, Salary_Qual_Flag
  ORDER BY Qualification_Category, job_count DESC, Salary_Qual_Flag"""


def anova_sql(source: str, group: str) -> str:
    return f"""SELECT groups, n_obs, groups - 1 AS df_between, n_obs - groups AS df_within,
  round(CASE WHEN groups > 1 THEN (ssb / (groups - 1)) / (ssw / (n_obs - groups)) END, 6) AS F_statistic,
  round(CASE WHEN groups > 1 THEN ssb / (ssb + ssw) END, 9) AS eta_squared
FROM (
  SELECT count(*) AS groups, CAST(sum(n) AS BIGINT) AS n_obs,
         sum(n * (mean - grand) * (mean - grand)) AS ssb,
         sum((n - 1) * var) AS ssw
  FROM (SELECT g.*, (SELECT sum(n * mean) / sum(n) FROM g) AS grand FROM g) x) s"""


def anova_groups(source: str, group: str) -> str:
    return f"""g AS (SELECT {group}, count(Annual_Salary_Mid) AS n, avg(Annual_Salary_Mid) AS mean,
      coalesce(var_samp(Annual_Salary_Mid), 0.0) AS var FROM {source}
      WHERE {group} IS NOT NULL AND Annual_Salary_Mid IS NOT NULL GROUP BY {group})"""


SQL["K5"] = w(*BASE_M2, anova_groups("m2", "Qualification_Category")) + anova_sql("m2", "Qualification_Category")
SQL["K5_docs"] = w(DOCS, anova_groups("docs", "lang")) + anova_sql("docs", "lang")
SQL["K6"] = w(*BASE_M2) + """SELECT Qualification_Category, median(Annual_Salary_Mid) AS median_salary
  FROM m2 WHERE Annual_Salary_Mid IS NOT NULL GROUP BY Qualification_Category"""
SQL["K7"] = w(*BASE_M1, "mx AS (SELECT max(Posting_Date) AS _max FROM m1)",
              """r AS (SELECT m1.* FROM m1, mx
      WHERE _max IS NULL OR Posting_Date >= CAST(_max - INTERVAL 730 DAY AS DATE))""",
              """a AS (SELECT agency, count(*) AS job_count_2yr,
      CAST(sum(CAST(Annual_Salary_Mid AS DECIMAL(30,4))) * 10000 AS HUGEINT) AS _u,
      count(Annual_Salary_Mid) AS _n,
      CAST(CAST(max(Annual_Salary_Mid) AS DECIMAL(30,4)) * 10000 AS HUGEINT) AS _m,
      max(Annual_Salary_Mid) AS High_salary_per_agency, min(Annual_Salary_Mid) AS Min_salary_per_agency
      FROM r WHERE agency IS NOT NULL GROUP BY agency HAVING count(*) >= 3)""") + \
    """SELECT agency, job_count_2yr,
  CAST((2 * _u + 100 * _n) // (200 * _n) AS DOUBLE) / 100.0 AS avg_salary_2yr,
  CAST((2 * (_m * _n - _u) + 100 * _n) // (200 * _n) AS DOUBLE) / 100.0 AS salary_premium,
  CAST((2000 * (_m * _n - _u) + _u) // (2 * _u) AS DOUBLE) / 10.0 AS premium_pct_per_agency,
  High_salary_per_agency, Min_salary_per_agency FROM a"""
SQL["K8"] = w(*BASE_M1C) + """SELECT agency, Primary_Job_Category, round_even(Annual_Salary_Mid, 0) AS Annual_Salary_Mid,
  job_id, round_even(Salary_From_Value, 0) AS Salary_From_Value, round_even(Salary_To_Value, 0) AS Salary_To_Value,
  business_title FROM (
    SELECT *, row_number() OVER (PARTITION BY agency, Primary_Job_Category
                                 ORDER BY Annual_Salary_Mid DESC, job_id DESC) AS _rn
    FROM m1c WHERE Annual_Salary_Mid IS NOT NULL AND agency IS NOT NULL AND Primary_Job_Category IS NOT NULL)
  WHERE _rn = 1 ORDER BY Annual_Salary_Mid DESC"""
SQL["K9"] = w(*BASE_M1C, "mx AS (SELECT max(Posting_Date) AS _max FROM m1c)") + """SELECT agency, Primary_Job_Category,
  count(Annual_Salary_Mid) AS job_count, round_even(avg(Annual_Salary_Mid), 0) AS avg_salary,
  CAST(any_value(_max) - INTERVAL 2 YEAR AS DATE) AS from_date, any_value(_max) AS to_date
  FROM m1c, mx
  WHERE Posting_Date >= CAST(_max - INTERVAL 2 YEAR AS DATE) AND agency IS NOT NULL AND Primary_Job_Category IS NOT NULL
  GROUP BY agency, Primary_Job_Category HAVING count(Annual_Salary_Mid) >= 2
  ORDER BY avg_salary DESC"""


def k10_sql(base: tuple, source: str, mentions: str) -> str:
    return w(*base, f"ready AS (SELECT * FROM {source} WHERE Annual_Salary_Mid IS NOT NULL)",
             f"""ex AS (SELECT skill, Annual_Salary_Mid, job_id FROM (
          SELECT unnest({mentions}) AS skill, Annual_Salary_Mid, job_id FROM ready)
          WHERE skill IS NOT NULL AND length(skill) > 0)""",
             """st AS (SELECT skill, count(Annual_Salary_Mid) AS job_count, avg(Annual_Salary_Mid) AS avg_salary,
          count(DISTINCT job_id) AS unique_jobs FROM ex GROUP BY skill HAVING count(Annual_Salary_Mid) >= 3)""",
             "gm AS (SELECT avg(Annual_Salary_Mid) AS _g FROM ready)") + \
        """SELECT skill, job_count, round(avg_salary, 2) AS avg_salary, unique_jobs,
  round(avg_salary - _g, 2) AS salary_premium, round((avg_salary - _g) / _g * 100, 1) AS premium_pct
  FROM st, gm ORDER BY st.avg_salary DESC, skill LIMIT 20"""


SQL["K10"] = k10_sql(BASE_M2, "m2", alternation_mentions("combined_text", flat_keywords()))
SQL["K10_parts"] = k10_sql(BASE_M2, "m2", word_mentions("combined_text", PART_WORDS))
SQL["K10_docs"] = k10_sql((DOCS,), "docs", word_mentions("combined_text", PLAIN_WORDS))


def k11_sql(base: tuple, source: str, tax) -> str:
    sk = generalized("coalesce(combined_text, '')", "minimum_qual_requirements", tax)
    return w(*base, f"""ex AS (SELECT skill, Annual_Salary_Mid, job_id FROM (
          SELECT unnest({sk}) AS skill, Annual_Salary_Mid, job_id FROM {source})
          WHERE skill IS NOT NULL AND length(skill) > 0 AND Annual_Salary_Mid IS NOT NULL)""",
             """st AS (SELECT skill, count(Annual_Salary_Mid) AS job_count,
          round_even(avg(Annual_Salary_Mid), 0) AS avg_salary,
          round_even(median(Annual_Salary_Mid), 0) AS median_salary,
          count(DISTINCT job_id) AS unique_jobs FROM ex GROUP BY skill HAVING count(Annual_Salary_Mid) >= 3)""",
             f"gm AS (SELECT avg(Annual_Salary_Mid) AS _g FROM {source})") + \
        """SELECT skill, job_count, avg_salary, median_salary, unique_jobs,
  round(avg_salary - _g, 2) AS salary_premium, round_even((avg_salary - _g) / _g * 100, 1) AS premium_pct
  FROM st, gm ORDER BY avg_salary DESC, skill LIMIT 20"""


SQL["K11"] = k11_sql(BASE_M2, "m2", TAXONOMY)
SQL["K11_docs"] = k11_sql((DOCS,), "docs", DOCS_TAXONOMY)
SQL["K12"] = w(*BASE_M1) + """SELECT count(Annual_Salary_Mid) AS salary_count,
  round(avg(Annual_Salary_Mid), 2) AS global_avg_salary, max(Annual_Salary_Mid) AS global_max_salary,
  max(Posting_Date) AS latest_date FROM m1"""
SQL["O1"] = w(*BASE_M1) + "SELECT job_id, Annual_Salary_Mid FROM m1 ORDER BY Annual_Salary_Mid DESC NULLS LAST, job_id"
SQL["O2"] = w(*BASE_M1) + "SELECT agency, Annual_Salary_Mid, job_id FROM m1 ORDER BY agency, Annual_Salary_Mid DESC, job_id"
SQL["O3"] = w(*BASE_M1) + """SELECT job_id, agency, Annual_Salary_Mid FROM m1
  ORDER BY Annual_Salary_Mid DESC NULLS LAST, job_id LIMIT 10"""
SQL["M1"] = w(*BASE_M1) + "SELECT * FROM m1"
SQL["M2"] = w(*BASE_M2) + "SELECT * FROM m2"


SQL["P2"] = w(POSTINGS) + """SELECT * FROM postings ORDER BY job_id, line_number, part_key, supp_key, salary_range_to LIMIT 5"""
_ALL_TEXT = "concat_ws(' ', job_description, minimum_qual_requirements, preferred_skills)"
SQL["T10"] = w(*BASE_M2) + f"SELECT job_id, {joined(phrases(_ALL_TEXT), 'skills')} FROM m2"
SQL["T10_docs"] = w(DOCS) + f"SELECT job_id, {joined(phrases('combined_text'), 'skills')} FROM docs"
_CASCADE = (f"(SELECT job_id, CASE WHEN preferred_skills IS NOT NULL AND len(_split) > 0 THEN _split WHEN len(_tech) > 0 THEN _tech "
            f"ELSE _phrases END AS s FROM (SELECT job_id, preferred_skills, {_T9_SPLIT} AS _split, {tech(_ALL_TEXT)} AS _tech, "
            f"{phrases(_ALL_TEXT)} AS _phrases FROM m2))")
SQL["T11"] = w(*BASE_M2) + f"SELECT job_id, {joined('s', 'skills')}, CAST(len(s) AS INTEGER) AS skills_count FROM {_CASCADE}"
SQL["T12"] = w(*BASE_M2) + f"SELECT job_id, CAST(len(s) AS INTEGER) AS skills_count FROM {_CASCADE}"
_CASCADE_DOCS = (f"(SELECT job_id, CASE WHEN len(_tech) > 0 THEN _tech ELSE _phrases END AS s FROM (SELECT job_id, "
                 f"{tech('minimum_qual_requirements', DOCS_VOCABULARY)} AS _tech, {phrases('minimum_qual_requirements')} AS _phrases FROM docs))")
SQL["T11_docs"] = w(DOCS) + f"SELECT job_id, {joined('s', 'skills')}, CAST(len(s) AS INTEGER) AS skills_count FROM {_CASCADE_DOCS}"

# five groups, so df1 = 4 and the tail has a closed form: x^a (1 + a (1 - x))
SQL["K5_test"] = w(*BASE_M2, anova_groups("m2", "Qualification_Category"),
                   f"st AS ({anova_sql('m2', 'Qualification_Category')})",
                   """raw AS (SELECT st.*, (SELECT sum(n * (mean - gm) * (mean - gm)) FROM g, (SELECT sum(n * mean) / sum(n) AS gm FROM g)) AS ssb,
      (SELECT sum((n - 1) * var) FROM g) AS ssw FROM st)""",
                   "x AS (SELECT *, df_within / (df_within + 4 * (ssb / 4) / (ssw / df_within)) AS x, df_within / 2.0 AS a FROM raw)") + \
    """SELECT 'ANOVA F-statistic' AS method, F_statistic, round(pow(x, a) * (1 + a * (1 - x)), 9) AS p_value, eta_squared,
  CASE WHEN pow(x, a) * (1 + a * (1 - x)) < 0.05 THEN 'significant' ELSE 'not significant' END AS interpretation,
  groups AS qual_groups, df_between, df_within, CAST(NULL AS VARCHAR) AS error FROM x WHERE groups = 5"""
SQL["K5_groups"] = w(*BASE_M2) + """SELECT Qualification_Category, count(*) AS n, round(avg(Annual_Salary_Mid), 2) AS mean,
  median(Annual_Salary_Mid) AS median FROM m2 WHERE Annual_Salary_Mid IS NOT NULL GROUP BY Qualification_Category"""
SQL["M3_skills"] = SQL["K10"]
SQL["M3_distribution"] = SQL["K1"]
SQL["M3_degrees"] = SQL["K4"]
SQL["M3_agencies"] = SQL["K7"]
SQL["S3"] = SQL["K2"]
