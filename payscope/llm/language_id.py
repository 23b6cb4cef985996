"""Language identification with language-bitmask n-gram filters.

``train`` learns, per language, the set of letter n-grams typical of it and
puts each set into a Bloom filter.  The filters are bit-sliced: one array
with, at each position, a word whose bit l is that position's bit in language
l's filter; past 64 languages, another word for each 64.  The AND of an n-gram's
``HASHES`` positions is thus the bitmask of all languages that may contain it, by one
lookup for all languages of a word.

``predict`` counts, per language, the n-grams of a text whose bitmask has its
bit (popcounts per bit), corrects the count for the false positives that a
filter of that fill gives (hits = true + (n - true) * fp), and takes the
language with the largest corrected share.

N-grams are four characters of the lower-cased text in which every run of other
characters than letters is one blank.  An n-gram is typical of a language if
it makes up at least ``MIN_SHARE`` of the language's n-grams (so a language
has at most 1 / MIN_SHARE of them, which bounds the filters' fill and what is
gathered, whatever the corpus) and its share is at least ``MIN_RATIO`` of its
largest share in any language.

Scale: the classifier is fitted on a sample, by hash of text and place, of
blocks with about ``max_train_chars`` characters per language (a documented
bound); a language with fewer is taken whole.  Copies of a text count once.  The
counts of characters per language that set the sampling rate cover all labelled
documents.  N-gram counts are pre-aggregated in each task.  Filters are put together
by position: what reaches the driver is one word for each position and 64
languages, whatever the corpus.  Prediction is one Arrow pass with no shuffle; the
filter is one megabyte for up to 8 languages, 8 for each 64, and is sent to tasks with
the function.

Defined results: null text, or text without a letter, is ``und`` with score 0.
Ties go to the language first in text order.  Repeated rows are predicted
alike.  Texts of any length are read whole, in blocks.  If nothing is labelled,
every document is ``und``.  Only the columns named are read.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

N = 4
HASHES = 3
SLOTS = 1 << 20
MIN_SHARE = 2e-6
MIN_RATIO = 0.2
WORD_BITS = 64  # languages a word
BLOCK = 1 << 20
SAMPLE_BLOCK = 2000  # characters taken or left together
UNKNOWN = "und"

_P1, _P2, _P3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Whether each code point is a letter; made once per process."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), dtype=bool, count=0x110000))
    return _LETTERS[0]


def ngrams(text: str) -> np.ndarray:
    """Hashes of the n-grams of one text, in order; empty without a letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letters()[points]
    if not letter.any():
        return np.empty(0, np.uint64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # of each run of other characters the first, as a blank
    body = np.where(letter, points, 32)[keep]
    padded = np.concatenate([[32], body, [32] * int(body[-1] != 32)])
    padded = np.pad(padded, (0, max(0, N - len(padded))), constant_values=32).astype(np.uint64)
    n = len(padded) - N + 1
    h = np.zeros(n, np.uint64)
    for k in range(N):
        h = h * _P1 + padded[k:k + n]
    return h


def _positions(hashed: np.ndarray) -> Iterator[np.ndarray]:
    x = (hashed ^ (hashed >> np.uint64(29))) * _P2
    y = (x ^ (x >> np.uint64(32))) * _P3
    for k in range(HASHES):
        yield ((x + np.uint64(k) * y) >> np.uint64(40)) & np.uint64(SLOTS - 1)


@dataclass(frozen=True)
class LanguageModel:
    """Bit-sliced filters: ``slots[w, p]`` has bit l if language 64 w + l has p set."""

    languages: tuple[str, ...]
    slots: np.ndarray

    def count(self, words: np.ndarray) -> np.ndarray:
        """Per language, how many columns of ``words`` (as slots) have its bit."""
        one = words.dtype.type
        return np.array([np.count_nonzero(words[k // WORD_BITS] & one(1 << k % WORD_BITS)) for k in range(len(self.languages))])

    def false_positives(self) -> np.ndarray:
        """Chance, per language, that an n-gram of no language is found."""
        return (self.count(self.slots) / self.slots.shape[1]) ** HASHES

    def masks(self, hashed: np.ndarray) -> np.ndarray:
        """Bitmask of the languages that have each n-gram."""
        found = None
        for p in _positions(hashed):
            at = self.slots[:, p]
            found = at if found is None else found & at
        return found

    def predict(self, text: str | None, fp: np.ndarray) -> tuple[str, float]:
        hashed = ngrams(text or "")
        if not len(hashed) or not self.languages:
            return UNKNOWN, 0.0
        hits = np.zeros(len(self.languages))
        for at in range(0, len(hashed), BLOCK):
            hits += self.count(self.masks(hashed[at:at + BLOCK]))
        share = np.clip((hits / len(hashed) - fp) / (1 - fp), 0, 1)
        best = int(share.argmax())
        return self.languages[best], float(share[best])


def _count_ngrams(sample: DataFrame) -> DataFrame:
    """(lang, gram, n) per task of ``sample`` (lang, text)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                grams, n = np.unique(np.concatenate([ngrams(t) for t in texts]), return_counts=True)
                yield pd.DataFrame({"lang": lang, "gram": grams.view(np.int64), "n": n})

    return sample.mapInPandas(run, "lang string, gram long, n long")


def _sampled(rows: DataFrame, rates: dict[str, float]) -> DataFrame:
    """(lang, text) of sampled blocks, each distinct text once.  A language that
    is taken whole keeps its texts whole."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for lang, text, key in zip(batch["lang"], batch["text"], batch["key"], strict=True):
                if rates[lang] >= 1:
                    out.append((lang, key, 0, text))
                    continue
                at = np.arange(0, len(text), SAMPLE_BLOCK)
                unit = np.uint64(key & (1 << 64) - 1) + at.astype(np.uint64) * _P1
                unit = (unit ^ (unit >> np.uint64(30))) * _P2
                unit = ((unit ^ (unit >> np.uint64(27))) * _P3 >> np.uint64(11)) / float(1 << 53)
                out += [(lang, key, k, text[k:k + SAMPLE_BLOCK]) for k in at[unit < rates[lang]].tolist()]
            yield pd.DataFrame(out, columns=["lang", "key", "at", "text"])

    blocks = rows.where(F.col("lang").isin(*rates)).select("lang", "text", "key").mapInPandas(run, "lang string, key long, at long, text string")
    return blocks.distinct().select("lang", "text")


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", max_train_chars: float = 4e6) -> LanguageModel:
    """Learn from the rows of ``labelled`` with a text and a language."""
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text is not null and lang is not null")
    rows = rows.withColumn("key", F.xxhash64(F.lit(5), F.col("text")))
    folded = rows.groupBy("lang", "key").agg(F.max(F.length("text").cast("double")).alias("n"))
    chars = {r["lang"]: r["n"] for r in folded.groupBy("lang").agg(F.sum("n").alias("n")).collect() if r["n"]}
    languages = tuple(sorted(chars))
    kind = np.uint8 if len(languages) <= 8 else np.uint64
    words = -(-len(languages) // WORD_BITS)
    slots = np.zeros((max(1, words), SLOTS), kind)
    if not languages:
        return LanguageModel(languages, slots)
    rates = {name: min(1.0, max_train_chars / n) for name, n in chars.items()}
    counts = _count_ngrams(_sampled(rows, rates)).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    known = counts.where(F.col("lang").isin(*totals))
    share = F.col("n") / F.element_at(F.create_map(*[F.lit(x) for k, n in totals.items() for x in (k, float(n))]), F.col("lang"))
    most = known.groupBy("gram").agg(F.max(share).alias("top"))
    typical = known.withColumn("share", share).join(most, "gram").where((F.col("share") >= MIN_SHARE) & (F.col("share") >= MIN_RATIO * F.col("top")))
    filters = _filter_words(typical.select("lang", "gram"), languages).toPandas()  # at most SLOTS rows a word
    slots[filters["word"].to_numpy(), filters["slot"].to_numpy()] = filters["mask"].to_numpy(np.int64).view(np.uint64).astype(kind)
    return LanguageModel(languages, slots)


def _filter_words(typical: DataFrame, languages: tuple[str, ...]) -> DataFrame:
    """(word, slot, mask): the filters' words that are not zero, from (lang, gram)."""
    number = {name: k for k, name in enumerate(languages)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at = batch["lang"].map(number).to_numpy(np.int64)
            bit = np.uint64(1) << (at % WORD_BITS).astype(np.uint64)
            for p in _positions(batch["gram"].to_numpy(np.int64).view(np.uint64)):
                yield pd.DataFrame({"word": at // WORD_BITS, "slot": p.astype(np.int64), "mask": bit.view(np.int64)})

    return typical.mapInPandas(run, "word long, slot long, mask long").groupBy("word", "slot").agg(F.bit_or("mask").alias("mask"))


def predictor(model: LanguageModel):
    """Column function: struct(lang_pred, score) of a text column."""
    fp = model.false_positives()

    @F.pandas_udf("lang_pred string, score double")
    def language(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.predict(t, fp) for t in texts], columns=["lang_pred", "score"])

    return language


def held_out(doc_id: Column) -> Column:
    """Documents that are never learnt from: crc32 of the id as text, mod 4 is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train_on_documents(docs: DataFrame, **options) -> LanguageModel:
    return train(docs.where(~held_out(F.col("doc_id"))).select("text", "lang"), **options)
