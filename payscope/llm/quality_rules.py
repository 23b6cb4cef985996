"""Quality rules as a bitmask ledger.

``measure`` evaluates every rule once per document and stores one failure bit
per rule beside the measurements.  A policy is a named, versioned set of
rules, that is a mask: ``apply_policy`` compares it with the stored bits and
``ablations`` counts, for each rule of a policy, what only that rule rejects,
both without reading a text again.

One Arrow pass over the text, no shuffle; the ledger is a few numbers a row.
``ablations`` pre-aggregates to one row per distinct bit set (at most
2^rules) in each task.

Defined results: null text has no words, so it fails MIN_WORDS; empty text
likewise.  Repeated rows each get a row.  A document of any length is read
whole.  Only the id and text columns are read, so others cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the word and symbol definitions.
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

MEASURES = {"n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long",
            "n_repeat_words": "long", "n_lines": "long", "n_distinct_words": "long", "n_shouts": "long",
            "n_blocks": "long", "n_dull_blocks": "long"}

# Words are looked at in blocks of so many, the last with what remains; a block is
# dull if less than a tenth of its words are distinct.
BLOCK_WORDS = 1000


@dataclass(frozen=True)
class Rule:
    name: str
    bit: int
    fails: Column


def rules(c: Callable[[str], Column] = F.col) -> list[Rule]:
    """Every rule, evaluated on the measurements.  A bit's meaning never
    changes; new rules take new bits."""
    words = c("n_words")
    return [
        Rule("min_words", 0, words < 50),
        Rule("repeated_windows", 1, 100 * c("n_repeat_words") > 50 * words),
        Rule("symbols", 2, 10 * c("n_symbols") > words),
        Rule("duplicate_lines", 3, (c("n_lines") >= 4) & (10 * c("n_dup_lines") > 5 * c("n_lines"))),
        Rule("long_words", 4, c("word_chars") > 20 * words),
        Rule("short_words", 5, 10 * c("word_chars") < 15 * words),
        # of web-2 only: it does not look at long texts, which dull_blocks does alike at any length
        Rule("few_distinct_words", 6, (words >= 50) & (words < 2000) & (20 * c("n_distinct_words") < words)),
        Rule("shouting", 7, 4 * c("n_shouts") > words),
        Rule("dull_blocks", 8, (words >= 50) & (2 * c("n_dull_blocks") > c("n_blocks"))),
    ]


BASE_RULES = ("min_words", "repeated_windows")

# Versioned policies: published versions are never edited, only added to.
POLICIES = {
    "base-1": BASE_RULES,
    "web-1": (*BASE_RULES, "symbols", "duplicate_lines", "shouting"),
    "web-2": (*BASE_RULES, "symbols", "duplicate_lines", "long_words", "short_words", "few_distinct_words", "shouting"),
    "web-3": (*BASE_RULES, "symbols", "duplicate_lines", "long_words", "short_words", "dull_blocks", "shouting"),
}


def mask(names: tuple[str, ...]) -> int:
    bits = {r.name: r.bit for r in rules()}
    return sum(1 << bits[n] for n in set(names))


def _repeat_words(ids: np.ndarray, distinct: int) -> int:
    """Words covered by three-word windows that occur twice or more."""
    if len(ids) < 4:
        return 0
    pairs = ids[:-1] * distinct + ids[1:]
    if distinct > 2_000_000:  # keep the packed window within 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * distinct + ids[2:]
    order = np.argsort(windows, kind="stable")
    equal = np.diff(windows[order]) == 0
    if not equal.any():
        return 0
    twice = np.zeros(len(windows) + 2, dtype=bool)
    found = np.r_[False, equal] | np.r_[equal, False]
    at = order[found]
    twice[at] = twice[at + 1] = twice[at + 2] = True
    return int(twice.sum())


def _dull_blocks(ids: np.ndarray, distinct: int) -> tuple[int, int]:
    """Blocks of a text's words, and how many of them are dull."""
    blocks = max(1, len(ids) // BLOCK_WORDS)
    if blocks == 1:
        return 1, int(10 * distinct < len(ids))
    ends = [*range(BLOCK_WORDS, blocks * BLOCK_WORDS, BLOCK_WORDS), len(ids)]
    return blocks, sum(10 * len(np.unique(part)) < len(part) for part in np.split(ids, ends[:-1]))


def measure_text(text: str) -> tuple[int, ...]:
    """Measurements of one text, in the order of MEASURES."""
    words = text.encode("utf-8", "surrogatepass").split()  # splits bytes at ASCII blanks exactly
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return (len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)),
            _repeat_words(ids, len(number)), len(lines), len(number), text.count("!!"), *_dull_blocks(ids, len(number)))


def measures(text: Column) -> Column:
    """Struct of the measurements of a text column."""

    @F.pandas_udf(", ".join(f"{k} {v}" for k, v in MEASURES.items()))
    def measured(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([measure_text(t or "") for t in texts], columns=list(MEASURES), dtype="int64")

    return measured(text)


def fail_bits(measured: Callable[[str], Column] = F.col) -> Column:
    """One bit per failed rule; ``measured`` gives a measurement's column."""
    bits = F.lit(0).cast("long")
    for r in rules(measured):
        bits = bits.bitwiseOR(F.when(r.fails, F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long"))
    return bits


def measure(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The ledger: doc_id, measurements, ``fail_bits`` (one bit per rule)."""
    ledger = docs.select(F.col(doc_id).alias("doc_id"), measures(F.col(text)).alias("m")).select("doc_id", "m.*")
    return ledger.withColumn("fail_bits", fail_bits())


def passes(text: Column, policy: str = "web-3") -> Column:
    """Whether a policy keeps a text, as a filter condition."""
    m = measures(text)
    return fail_bits(lambda name: m[name]).bitwiseAND(F.lit(mask(POLICIES[policy]))) == 0


def apply_policy(ledger: DataFrame, policy: str = "web-3", column: str = "kept") -> DataFrame:
    """``ledger`` with whether the policy keeps the document."""
    return ledger.withColumn(column, F.col("fail_bits").bitwiseAND(F.lit(mask(POLICIES[policy]))) == 0)


def ablations(ledger: DataFrame, policy: str = "web-3") -> DataFrame:
    """(rule, n_failed, n_only, n_kept_without): per rule of the policy, the
    documents that fail it, those that fail nothing else, and those the policy
    keeps once the rule is left out."""
    whole = mask(POLICIES[policy])
    per_set = ledger.groupBy(F.col("fail_bits").bitwiseAND(F.lit(whole)).alias("bits")).agg(F.count("*").alias("n"))
    one = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit"))
                              for r in rules() if r.name in POLICIES[policy]])).alias("r")
    rest = F.col("bits").bitwiseAND(F.bitwise_not(F.col("r.bit")))
    return (per_set.select("bits", "n", one).groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only"),
        F.sum(F.when(rest == 0, F.col("n")).otherwise(0)).alias("n_kept_without")))
