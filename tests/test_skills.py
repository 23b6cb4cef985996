"""Skill extraction: value tests and brute force against Python ``re`` on whole documents."""

import re

import pytest
from pyspark.sql import functions as F

from payscope.operators import skills as SK
from payscope.plans.catalog import PLAIN_WORDS
from payscope.sources.adapters import postings_from_documents
from payscope.sources.taxonomy import TAXONOMY, TECH_SKILLS, taxonomy_entries

from .conftest import SF001

# Python reference semantics: whole word = not next to a Unicode word character.
def _bounded(kw):
    return r"(?<!\w)" + re.escape(kw) + r"(?!\w)"


def py_mentions(text, keywords):
    uniq = sorted(set(keywords), key=lambda k: (-len(k), k))
    pat = r"(?<!\w)(" + "|".join(re.escape(k) for k in uniq) + r")(?!\w)"
    return re.findall(pat, text)


def py_presence(text, entries):
    return [label for label, kw in entries if re.search(_bounded(kw), text)]


def py_tech(text):
    text = (text or "").lower()
    return sorted(set(k for ks in TECH_SKILLS.values() for k in ks if re.search(_bounded(k), text)))


def py_phrases(text):
    if text is None:
        return []
    text = text.lower()
    out = []
    for p in SK.PHRASE_PATTERNS:
        out += [m.strip() for m in re.findall(p, text, re.IGNORECASE) if len(m.strip()) > 2]
    return sorted(set(s for s in out if len(s) <= 20))


def py_context(q):
    q = (q or "").lower()
    for needles, labels in SK.CONTEXT_RULES:
        if any(n in q for n in needles):
            return list(labels)
    return []


def py_generalized(text, qual, tax=TAXONOMY):
    found = py_presence(text, [(f"{d}_{s}_{k}", k) for d, s, k in taxonomy_entries(tax)])
    found += py_context(qual)
    return sorted(set(s.split("_", 1)[1] for s in found))


def py_cascade(pref, desc, qual):
    if pref is not None:
        pieces = re.split(r"[;,|]", pref.lower())
        got = [s.strip() for s in pieces if len(s.strip()) > 2 and not s.startswith("http")]
        if got:
            return got
    all_text = " ".join(x for x in (desc, qual, pref) if x is not None)
    kw = py_tech(all_text)
    return kw or py_phrases(all_text)


def _rows(spark, col_expr):
    df = postings_from_documents(spark, SF001)
    return {r.job_id: (r.text, r.qual, r.out) for r in df.select(
        "job_id", F.col("combined_text").alias("text"),
        F.col("minimum_qual_requirements").alias("qual"), col_expr.alias("out")).collect()}


def test_mentions_value_cases(spark):
    df = spark.createDataFrame([("c++ and c# then java, javascript; vendor management team lead c",),
                                ("üthe the theñ _the the_ the",), (None,)], "t string")
    out = [r.s for r in SK.extract_mentions(df, "t", ["c++", "c#", "java", "javascript", "management",
                                                      "vendor management", "team lead", "the"], "s").collect()]
    assert out[0] == ["c++", "c#", "java", "javascript", "vendor management", "team lead"]
    assert out[1] == ["the", "the"]
    assert out[2] is None


def test_presence_finds_overlapping_keywords(spark):
    df = spark.createDataFrame([("vendor management and c++11 or c++",)], "t string")
    labels = df.select(SK.keyword_presence(F.col("t"), [("m", "management"), ("v", "vendor management"),
                                                        ("c", "c++")]).alias("a")).collect()[0].a
    assert labels == ["m", "v", "c"]


def test_mentions_match_python_on_documents(spark):
    got = _rows(spark, F.regexp_extract_all(F.col("combined_text"),
                                            F.lit(SK.keyword_alternation(PLAIN_WORDS)), F.lit(1)))
    assert len(got) >= 200
    for text, _, out in got.values():
        assert out == py_mentions(text, PLAIN_WORDS)


def test_namespaced_presence_matches_python(spark):
    entries = [(f"{d}_{s}_{k}", k) for d, s, k in taxonomy_entries(TAXONOMY)]
    got = _rows(spark, SK.namespaced_presence(F.col("combined_text")))
    for text, _, out in got.values():
        assert out == py_presence(text, entries)


def test_generalized_matches_python(spark):
    got = _rows(spark, SK.trim_labels(F.concat(SK.namespaced_presence(F.col("combined_text")),
                                               SK.contextual_skills(F.col("minimum_qual_requirements")))))
    for text, qual, out in got.values():
        assert out == py_generalized(text, qual)


def test_tech_skills_match_python(spark):
    got = _rows(spark, SK.tech_skills(F.col("combined_text")))
    for text, _, out in got.values():
        assert out == py_tech(text)


def test_phrases_match_python_on_whole_documents(spark):
    # (the generated prose holds none of the trigger words: no false hits)
    got = _rows(spark, SK.skill_phrases(F.col("combined_text")))
    for text, _, out in got.values():
        assert out == py_phrases(text)


PHRASE_TEXTS = [
    "Experience in project management, budgeting; and reporting. Knowledge in SQL/Python.",
    "Requires strong writing skills. Must have valid license, need CDL.",
    "Software development and data analysis expertise; web programming with React.",
    "excellent communication skills and leadership experience plus Excel proficiency",
    "Proficiency in AutoCAD & Revit; skilled in HVAC. analysisanalysis development",
    "No match here at all",
    "Experience in a very long list of things that never ends with punctuation",
    "requires;need,must have. experience in , knowledge in.",
    "élan skills and naïve experience; über proficiency",
]


def test_phrases_match_python_on_constructed_text(spark):
    df = spark.createDataFrame([(t,) for t in PHRASE_TEXTS], "t string")
    outs = [r.p for r in df.select(SK.skill_phrases(F.col("t")).alias("p")).collect()]
    assert sum(1 for o in outs if o) >= 5
    for t, o in zip(PHRASE_TEXTS, outs):
        assert o == py_phrases(t), t


def test_phrase_guard_on_long_unpunctuated_text(spark):
    text = ("data " * 4000) + "analysis, java skills. need python, " + ("x " * 3000)
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(SK.skill_phrases(F.col("t")).alias("p")).collect()[0].p == py_phrases(text)


def test_cascade_matches_python(spark):
    df = postings_from_documents(spark, SF001).withColumn("pref", F.lit(None).cast("string"))
    out = SK.skills_cascade(df, "pref", "minimum_qual_requirements", "pref")
    for r in out.select("minimum_qual_requirements", "skills_list", "skills_count").collect():
        exp = py_cascade(None, r.minimum_qual_requirements, None)
        assert r.skills_list == exp and r.skills_count == len(exp)


@pytest.mark.parametrize("pref,desc,expected", [
    ("Excel; SQL server | http://x.y, ab", None, ["excel", "sql server", "http://x.y"]),
    ("http://a.b;Excel", None, ["excel"]),
    (None, "Knows SQL Server and C# well", ["c#", "sql", "sql server"]),
    ("  ;, |", "uses Spark and Kafka", ["kafka", "spark"]),
    (None, None, []),
])
def test_cascade_cases(spark, pref, desc, expected):
    df = spark.createDataFrame([(pref, desc, None)], "p string, d string, q string")
    r = SK.skills_cascade(df, "p", "d", "q").collect()[0]
    assert r.skills_list == expected == py_cascade(pref, desc, None)


def test_parse_preferred_null_uses_description(spark):
    df = spark.createDataFrame([(None, "python and r"), ("Python, R", "ignored")], "p string, d string")
    out = [r.a for r in df.select(SK.parse_preferred(F.col("p"), F.col("d")).alias("a")).collect()]
    assert out == [["python", "r"], ["python"]]


def test_contextual_and_trim(spark):
    df = spark.createDataFrame([("Degree in Engineering",), ("LEGAL and health",), (None,)], "q string")
    got = [r.a for r in df.select(SK.contextual_skills(F.col("q")).alias("a")).collect()]
    assert got == [["engineering_design", "technical_drafting"], ["legal_research", "contract_review"], []]
    lab = spark.createDataFrame([(["it_data_programming_python", "engineering_design", "x_b", "y_b"],)],
                                "a array<string>")
    assert lab.select(SK.trim_labels(F.col("a"), 2).alias("t")).collect()[0].t == ["b", "data_programming_python"]


def test_explode_drops_empty(spark):
    df = spark.createDataFrame([(1, ["a", "", "a"]), (2, []), (3, None)], "id int, s array<string>")
    assert sorted(tuple(r) for r in SK.explode_skills(df, "s", ["id"]).collect()) == [("a", 1), ("a", 1)]


def test_phrases_and_cascade_on_postings_match_python(spark):
    from payscope.plans import catalog as c
    from payscope.columns import SNAKE as S
    df = c.m2(spark, SF001)
    text = F.concat_ws(" ", F.col(S.job_description), F.col(S.min_qual), F.col(S.preferred_skills))
    casc = SK.skills_cascade(df, S.preferred_skills, S.job_description, S.min_qual)
    rows = casc.select(S.preferred_skills, S.job_description, S.min_qual, SK.skill_phrases(text).alias("ph"),
                       "skills_list").collect()
    assert len(rows) > 1000
    for r in rows:
        all_text = " ".join(x for x in (r[S.job_description], r[S.min_qual], r[S.preferred_skills]) if x is not None)
        assert r.ph == py_phrases(all_text)
        assert r.skills_list == py_cascade(r[S.preferred_skills], r[S.job_description], r[S.min_qual])


@pytest.mark.parametrize("tax_name", ["plain", "taxonomy"])
def test_generalized_kpi_matches_pandas_on_documents(spark, tax_name):
    import numpy as np
    import pandas as pd
    from payscope.operators import kpis as K
    from payscope.plans.catalog import PLAIN_TAXONOMY
    tax = PLAIN_TAXONOMY if tax_name == "plain" else TAXONOMY
    df = postings_from_documents(spark, SF001)
    got = K.highest_paid_skills_generalized(df, "combined_text", "minimum_qual_requirements", "job_id",
                                            taxonomy=tax, min_jobs=3).collect()
    pdf = df.select("job_id", "combined_text", "minimum_qual_requirements", "Annual_Salary_Mid").toPandas()
    pdf["skills"] = [py_generalized(t, q, tax) for t, q in zip(pdf.combined_text, pdf.minimum_qual_requirements)]
    ex = pdf.explode("skills").dropna(subset=["skills", "Annual_Salary_Mid"])
    st_ = ex.groupby("skills").agg(job_count=("Annual_Salary_Mid", "count"), avg=("Annual_Salary_Mid", "mean"),
                                   med=("Annual_Salary_Mid", "median"), uniq=("job_id", "nunique"))
    st_ = st_[st_.job_count >= 3]
    overall = pdf["Annual_Salary_Mid"].mean()
    st_["avg_r"] = np.round(st_["avg"])
    st_ = st_.reset_index().sort_values(["avg_r", "skills"], ascending=[False, True]).head(20)
    assert [r.skill for r in got] == list(st_["skills"])
    for r, (_, e) in zip(got, st_.iterrows()):
        assert (r.job_count, r.avg_salary, r.median_salary, r.unique_jobs) == (
            e.job_count, e.avg_r, float(np.round(e.med)), e.uniq)
        assert r.salary_premium == pytest.approx(e.avg_r - overall, rel=1e-9)
        assert r.premium_pct == float(np.round((e.avg_r - overall) / overall * 100, 1))


def test_mentions_kpi_matches_pandas_on_documents(spark):
    import pandas as pd
    from payscope.operators import kpis as K
    df = postings_from_documents(spark, SF001)
    got = K.highest_paid_skills(df, "combined_text", "job_id", keywords=PLAIN_WORDS).collect()
    pdf = df.select("job_id", "combined_text", "Annual_Salary_Mid").toPandas()
    ready = pdf.dropna(subset=["Annual_Salary_Mid"]).copy()
    ready["skill"] = [py_mentions(t, PLAIN_WORDS) for t in ready.combined_text]
    ex = ready.explode("skill").dropna(subset=["skill"])
    st_ = ex.groupby("skill").agg(job_count=("Annual_Salary_Mid", "count"), avg=("Annual_Salary_Mid", "mean"),
                                  uniq=("job_id", "nunique")).reset_index()
    st_ = st_[st_.job_count >= 3].sort_values(["avg", "skill"], ascending=[False, True]).head(20)
    g = ready["Annual_Salary_Mid"].mean()
    assert [r.skill for r in got] == list(st_["skill"])
    for r, (_, e) in zip(got, st_.iterrows()):
        assert (r.job_count, r.unique_jobs) == (e.job_count, e.uniq)
        assert r.avg_salary == pytest.approx(e.avg, rel=1e-12)
        assert r.salary_premium == pytest.approx(e.avg - g, rel=1e-9)


def test_phrases_by_clauses_match_whole_text(spark):
    import random
    r = random.Random(23)
    pieces = ["knowledge", "in", "python", " ", " ", " ", ".", ",", ";", "experience", "skilled:", "must have", "need", "requires", "sql",
              "programming", "development", "analysis", "data", "&", "/", "(", "\n", "\t", "skills", "skill", "proficiency", "é", "x1", "-", "excel"]
    texts = ["", ".", None, "need sql", "need sql;", "a,need b&c.d", "data\nanalysis", "knowledge in x", "knowledge in x,"]
    texts += ["".join(r.choices(pieces, k=r.randint(1, 60))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [x.p for x in df.select(SK.skill_phrases(F.col("t")).alias("p")).collect()]
    assert got == [py_phrases(t) if t is not None else [] for t in texts]
    assert sum(map(bool, got)) > 100


def test_vocabulary_table_matches_the_fixed_vocabulary(spark):
    from payscope.plans import catalog as c
    table = {x.job_id: x.labels for x in c.QUERIES["T5_table"](spark, SF001).collect()}
    fixed = {x.job_id: "|".join(sorted(x.labels.split("|"))) for x in c.QUERIES["T5"](spark, SF001).collect() if x.labels}
    assert table == fixed and len(table) > 500


def test_large_vocabulary_table(spark):
    import random
    import re
    r = random.Random(29)
    odd = ["c++", "c#", ".net", "r&d", "a", "first aid", "first", "aid first aid", "naïve bayes", "漢字", "x_1", "-", "node.js", "tab\tkept"]
    keywords = odd + [f"kw{k}" for k in range(60_000)] + [f"kw{k} of{k % 7}" for k in range(40_000)]
    vocab = spark.createDataFrame([(k, f"label {k}") for k in keywords] + [("first aid", "second label"), (None, "no"), ("", "no"), (" ", "no")], "keyword string, label string")
    words = odd + [f"kw{r.randrange(60_000)}" for _ in range(300)] + [f"of{k}" for k in range(7)] + ["theme", "first", "aid", "xc++", "c++x", "c+", ".netx", "x.net"]
    texts = [None, "", " ", "first aid", "first  aid", "c++,c#;.net", "c++c", "a.net a -"]
    texts += ["".join(w + r.choice([" ", " ", " ", ", ", ".", "-", "/", "\n"]) for w in r.choices(words, k=r.randint(1, 40))) for _ in range(150)]
    texts += [f"kw{k} of{k % 7}" for k in range(0, 40_000, 997)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    got = {x.id: x.labels for x in SK.vocabulary_presence(df, "id", "t", vocab).collect()}
    w = r"[^\W]"  # letters, digits and underscore
    truth = {}
    for k, t in enumerate(texts):
        near = {x for x in keywords if t and x in t and re.search(rf"(?<!{w}){re.escape(x)}(?!{w})", t)}
        labels = sorted({f"label {x}" for x in near} | ({"second label"} if "first aid" in near else set()))
        if labels:
            truth[k] = labels
    assert got == truth and len(got) > 150
    assert SK.vocabulary_presence(df, "id", "t", vocab.where("false")).count() == 0
