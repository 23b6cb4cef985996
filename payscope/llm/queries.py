"""One production query per operator, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payscope.llm import (
    byte_bpe,
    chat_format,
    exact_dedup,
    filter_audit,
    language_id,
    license_scan,
    near_dedup,
    packing,
    quality_rules,
    simhash,
    source_divergence,
    token_counts,
    url_filter,
)
from payscope.llm.common import table
from payscope.llm.oracle import SQL

__all__ = ["QUERIES", "SQL"]

BYTE_BPE_JSON = public_tokenizers.path("byte_bpe_50k.json")
BYTE_BPE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    model = url_filter.train(pages.select("url", url_filter.host_word_label(url_filter.host_of(F.col("url"))).alias("label")))
    judged = url_filter.judge(pages, model)
    return judged.select("page_id", "host", "path", "rule", "verdict", "bad_score")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.tokenize(table(spark, sf_dir, "documents"), BYTE_BPE_JSON, capacity=2048)
    return packing.pack(pieces, capacity=2048).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), BYTE_BPE_RANKS)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = quality_rules.measure(table(spark, sf_dir, "documents"))
    base = quality_rules.apply_policy(ledger, "base-1", "base_kept")
    return quality_rules.apply_policy(base, "web-3", "kept").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~F.col("base_kept")).alias("base_failed"), "kept", "fail_bits")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = byte_bpe.encode(table(spark, sf_dir, "documents"), BYTE_BPE_RANKS)
    return encoded.select("doc_id", "n_tokens", F.sha2(F.col("ids").cast("binary"), 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = f"{chat_format.END}{chat_format.START}assistant ok"
    control = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(control)
    back = chat_format.read_back(chat_format.windows(turns, budget=8192, history=1024, system=1024))
    hexed = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    return back.select("conv_id", F.col("n_turns").cast("long").alias("n_turns"), hexed("turns").alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), hexed("loss").alias("loss_sha256"), "formatted_chars")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train_on_documents(docs)
    found = docs.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), language_id.predictor(model)(F.col("text")).alias("p"))
    return found.select("doc_id", "held_out", "p.lang_pred", "p.score")


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"), license_scan.known_licences(spark))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.classes(table(spark, sf_dir, "documents"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_packing": op2_packing,
    "op3_token_counts": op3_token_counts,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_chat_format": op7_chat_format,
    "op8_language_id": op8_language_id,
    "op9_minhash_near_dedup": op9_minhash_near_dedup,
    "op10_license_scan": op10_license_scan,
    "op11_filter_audit": op11_filter_audit,
    "op12_simhash_near_dedup": op12_simhash_near_dedup,
    "op13_source_divergence": op13_source_divergence,
}
