"""Skill vocabularies (S4, S5) as data.

The pattern builders read the constants below directly, because a
vocabulary of a few dozen words is a fixed parameter of the query.  The same
content is also available as a DataFrame (``taxonomy_df``) and can be read
from a JSON file of the same shape (``read_taxonomy_json``); as a table of
keywords and labels (``vocabulary``) it may have any size.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# The skills taxonomy (domain -> subdomain -> keywords),
# 5 domains, 18 subdomains, 77 keywords, in their original order.
# ---------------------------------------------------------------------------
TAXONOMY: dict[str, dict[str, list[str]]] = {
    "technical": {
        "engineering": ["cad", "solidworks", "autocad", "matlab", "ansys", "revit"],
        "construction": ["procore", "bluebeam", "primavera", "ms project"],
        "healthcare": ["epic", "cerner", "ehr", "hl7", "emr"],
        "finance": ["sap", "oracle", "peoplesoft", "quickbooks", "salesforce"],
        "legal": ["lexisnexis", "westlaw", "pacers", "case management"],
    },
    "it_data": {
        "programming": ["python", "java", "sql", "javascript", "r", "scala", "c++"],
        "cloud": ["aws", "azure", "gcp", "docker", "kubernetes"],
        "data": ["tableau", "powerbi", "snowflake", "databricks", "spark"],
    },
    "certifications": {
        "project": ["pmp", "agile", "scrum", "six sigma"],
        "finance": ["cpa", "cfa", "cfp", "frs"],
        "health": ["rn", "cna", "lpn", "emt"],
        "safety": ["osha", "hazwoper", "first aid", "cpr"],
    },
    "professional": {
        "leadership": ["supervisory", "management", "team lead", "director"],
        "communication": ["public speaking", "negotiation", "stakeholder"],
        "analysis": ["data analysis", "financial modeling", "risk assessment"],
    },
    "operations": {
        "maintenance": ["hvac", "plumbing", "electrical", "carpentry"],
        "procurement": ["vendor management", "contract negotiation", "rfp"],
        "hr": ["recruiting", "talent acquisition", "onboarding"],
    },
}

# ---------------------------------------------------------------------------
# The second (technical) vocabulary, group -> keywords.
# ---------------------------------------------------------------------------
TECH_SKILLS: dict[str, list[str]] = {
    "programming": ["python", "java", "sql", "r", "scala", "javascript", "c++", "c#", "php", "ruby"],
    "cloud": ["aws", "azure", "gcp", "docker", "kubernetes", "terraform"],
    "databases": ["sql server", "mysql", "postgresql", "oracle", "mongodb", "redis"],
    "bigdata": ["spark", "hadoop", "kafka", "hive", "airflow", "snowflake"],
    "tools": ["excel", "tableau", "powerbi", "jenkins", "git", "jira"],
}


def taxonomy_entries(tax: dict[str, dict[str, list[str]]] = TAXONOMY) -> list[tuple[str, str, str]]:
    """(domain, subdomain, keyword) triples in vocabulary order."""
    return [(d, s, k) for d, subs in tax.items() for s, kws in subs.items() for k in kws]


def flat_keywords(tax: dict[str, dict[str, list[str]]] = TAXONOMY) -> list[str]:
    return [k for _, _, k in taxonomy_entries(tax)]


def taxonomy_df(spark: SparkSession, tax: dict[str, dict[str, list[str]]] = TAXONOMY) -> DataFrame:
    rows = taxonomy_entries(tax)
    return spark.createDataFrame(rows, "domain string, subdomain string, skill string")


def read_taxonomy_json(spark: SparkSession, path: str) -> DataFrame:
    """Read ``{"domain": {"subdomain": ["kw", ...]}}`` into (domain, subdomain, skill).

    The file is parsed as one map<string, map<string, array<string>>> value and
    exploded twice; no driver-side parsing.
    """
    raw = (spark.read.option("multiLine", True)
           .schema("value string").text(path, wholetext=True))
    tree = raw.select(F.from_json("value", "map<string, map<string, array<string>>>").alias("t"))
    doms = tree.select(F.explode("t").alias("domain", "subs"))
    subs = doms.select("domain", F.explode("subs").alias("subdomain", "skills"))
    return subs.select("domain", "subdomain", F.explode("skills").alias("skill"))


def write_taxonomy_json(spark: SparkSession, path: str, tax: dict[str, dict[str, list[str]]] = TAXONOMY) -> str:
    """Store a vocabulary as the JSON file that ``read_taxonomy_json`` reads."""
    spark.createDataFrame([(json.dumps(tax),)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path


def vocabulary(entries: DataFrame) -> DataFrame:
    """(keyword, label) of (domain, subdomain, skill) entries: the keyword in lower
    case, and the name-spaced label of T5."""
    return entries.select(F.lower("skill").alias("keyword"), F.concat_ws("_", "domain", "subdomain", "skill").alias("label"))
