"""Licence scan by digest of canonical texts.

A text is made canonical: lower case, copyright lines dropped, equivalent
spellings made one, everything but letters, digits and line breaks one blank.
Its SHA-256 is looked up by a hash join among the digests of known licences.
A match is thus an entire text: the whole document, an entire paragraph
(between blank lines) or line of it, which finds notices, or a run of paragraphs: the
paragraphs of a known text are looked up by digest each, and a licence stands inside a
document where all of them follow one another in order, above code or under a title.

Only DataFrame functions, one pass over the text.  Known licences are
broadcast while there are at most ``MAX_BROADCAST`` digests (64 bytes and a
name each), beyond that the join is left to the planner.  A notice in a
third of all documents is one row of the known side, and matches are reduced
to a set per document before the shuffle.

Defined results: null and empty texts, and texts of punctuation or copyright
lines alone, have no licence.  Rows of one doc_id share their findings.  Very
long texts are read whole.  Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payscope.llm.licence_texts import LICENCE_TEXTS

MAX_BROADCAST = 100_000

# Fixed values: (pattern, replacement), applied in order to lower-cased text.
# Written so that Java's and RE2's regular expressions read them alike.
CANONICAL = [
    # copyright lines
    (r"(^|\n)[^\p{L}\p{N}\n]*(?:copyright[ \t]*(?:\(c\)|©|[0-9]{4}|<|\[|by )|\(c\)[ \t]*[0-9]{4}|©)[^\n]*", "$1"),
    # equivalent spellings
    (r"licence", "license"),
    (r"sub[- ]license", "sublicense"),
    (r"non[- ]commercial", "noncommercial"),
    (r"non[- ]infringement", "noninfringement"),
    (r"([a-z]{3})is(e|ed|es|ing|ation|ations)([^\p{L}\p{N}]|$)", "$1iz$2$3"),
    (r"copyright owner", "copyright holder"),
    (r"https://", "http://"),
    (r"all rights reserved", ""),
    # punctuation
    (r"[^\p{L}\p{N}\n]+", " "),
    (r" ?\n ?", "\n"),
]


def canonical(text: Column) -> Column:
    """Canonical lines of a text."""
    out = F.lower(text)
    for pattern, put in CANONICAL:
        out = F.regexp_replace(out, pattern, put)
    return out


def _joined(lines: Column) -> Column:
    return F.trim(F.replace(lines, F.lit("\n"), F.lit(" ")))


def _one_blank(text: Column) -> Column:
    return F.regexp_replace(text, r"[ \n]+", " ")


def _digest(unit: Column) -> Column:
    return F.sha2(unit.cast("binary"), 256)


def _paragraphs(lines: Column) -> Column:
    """The paragraphs of canonical lines that have a letter or digit, each in one line."""
    return F.filter(F.transform(F.split(lines, "\n\n+"), lambda u: _joined(_one_blank(u))), lambda u: u != "")


def known_licences(spark: SparkSession, texts: Iterable[tuple[str, str]] = LICENCE_TEXTS) -> DataFrame:
    """(digest, licence, known_text, number, paragraphs) of (licence, text) pairs: an entry
    for each whole text (number 0), and for each paragraph of a text with several."""
    given = spark.createDataFrame(list(texts), "licence string, text string").withColumn("lines", canonical(F.col("text")))
    given = given.select("licence", _digest(_joined(_one_blank(F.col("lines")))).alias("known_text"), _paragraphs(F.col("lines")).alias("parts"))
    given = given.groupBy("known_text").agg(F.min("licence").alias("licence"), F.first("parts").alias("parts"))
    whole = given.select(F.col("known_text").alias("digest"), "licence", "known_text", F.lit(0).alias("number"), F.lit(1).alias("paragraphs"))
    several = given.where(F.size("parts") > 1).select("licence", "known_text", F.size("parts").alias("paragraphs"), F.posexplode("parts"))
    return whole.union(several.select(_digest(F.col("col")).alias("digest"), "licence", "known_text", (F.col("pos") + 1).alias("number"), "paragraphs"))


def scan(docs: DataFrame, known: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, text_licence (of the entire text,
    else null), licences (sorted names found in any unit, joined by commas)."""
    lines = docs.select(F.col(doc_id).alias("doc_id"), canonical(F.coalesce(F.col(text), F.lit(""))).alias("lines"))
    lines = lines.select("doc_id", "lines", _joined(_one_blank(F.col("lines"))).alias("whole"))
    entire = F.array_distinct(F.filter(F.transform(F.array_append(F.split("lines", "\n"), F.col("lines")), lambda u: _joined(_one_blank(u))), lambda u: u != ""))
    # a paragraph goes with its place, a line or the document without one
    units = F.concat(F.transform(entire, lambda u: F.struct(u.alias("unit"), F.lit(None).cast("int").alias("place"))),
                     F.transform(_paragraphs(F.col("lines")), lambda u, k: F.struct(u.alias("unit"), k.alias("place"))))
    found = lines.select("doc_id", "whole", F.explode(units).alias("u"))
    found = found.select("doc_id", (F.col("u.unit") == F.col("whole")).alias("is_whole"), F.col("u.place").alias("place"), _digest(F.col("u.unit")).alias("digest"))
    if known.count() <= MAX_BROADCAST:
        known = F.broadcast(known)
    # paragraphs that follow one another share the difference of place and number; an entire
    # text is one of one paragraph
    matched = found.join(known, "digest").where((F.col("number") == 0) | F.col("place").isNotNull())
    runs = matched.groupBy("doc_id", "known_text", "licence", "paragraphs", F.when(F.col("number") > 0, F.col("place") - F.col("number")).alias("run")).agg(
        F.count_distinct("number").alias("seen"), F.max(F.col("is_whole") & (F.col("number") == 0)).alias("is_whole"))
    hits = runs.where(F.col("seen") == F.col("paragraphs")).groupBy("doc_id").agg(
        F.min(F.when(F.col("is_whole"), F.col("licence"))).alias("text_licence"),
        F.array_join(F.sort_array(F.collect_set("licence")), ",").alias("licences"))
    hits = hits.withColumnRenamed("doc_id", "_doc")
    ids = docs.select(F.col(doc_id).alias("doc_id"))
    return ids.join(hits, F.col("doc_id").eqNullSafe(F.col("_doc")), "left").select(
        "doc_id", "text_licence", F.coalesce("licences", F.lit("")).alias("licences"))
