"""Corpus pipeline: documents in, packed training sequences out.

Each stage takes what its predecessor kept and returns the columns of
documents (the last one: packed pieces).  ``run`` stores every stage's result
in the shared checkpoint folder and reads it again, so a lost executor repeats
part of one stage.

Defined results: an empty table gives no rows.  A null or empty text has no language and
goes in the first stage; in a stage on its own it has no words, is equal to other
empty texts, and packs as one empty document.  Where one of a group stays, it
is one with an id if there is any.
Where nothing is labelled with a language, none can be recognised, and no document
stays.  Further columns are kept up to the last stage, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payscope.llm import exact_dedup, language_id, near_dedup, packing, quality_rules
from payscope.llm.common import table
from payscope.llm.queries import BYTE_BPE_JSON
from payscope.session import checkpoint_dir

MIN_LANGUAGE_SCORE = 0.2
POLICY = "web-3"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of no recognised language (null texts are of none)."""
    found = language_id.predictor(language_id.train_on_documents(docs))(F.col("text"))
    return docs.where((found["lang_pred"] != language_id.UNKNOWN) & (found["score"] >= MIN_LANGUAGE_SCORE))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that fail a rule of the policy (null texts have too few words)."""
    return docs.where(quality_rules.passes(F.col("text"), POLICY))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (null counts as empty), keep the row with the largest doc_id; of equal
    rows one, and of texts whose ids are all null one.

    Rows join on digest and id: of a text with very many copies only the row that stays has a
    partner, and the others are spread by their ids."""
    found = exact_dedup.classes(docs)
    digest = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)
    mine = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), digest.alias("own"))
    kept = mine.join(found, (F.col("own") == F.col("digest")) & F.col("id").eqNullSafe(F.col("keep_id")))
    return kept.dropDuplicates(["own", "id"]).select("row.*")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates, keep the document with the smallest doc_id.  Rows are told apart by
    doc_id: if some class has no id at all, every row without an id stays."""
    kept = near_dedup.classes(docs).where("kept").select(F.col("doc_id").alias("kept_id"))
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept_id"]), "left_semi")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in training sequences."""
    return packing.pack(packing.tokenize(docs, BYTE_BPE_JSON))


STAGES = [("language_id", language), ("quality_rules", quality), ("exact_dedup", exact), ("near_dedup", near), ("packing", pack)]

# Learned language filters and order MinHash have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
