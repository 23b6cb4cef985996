"""Source divergence audit with count-level bitmaps.

Every source of a language gives each kept term of the language a smoothed share
of its words; two sources diverge by a chi-square-like sum over all kept terms.  The sum
depends on a term only through its two counts, so it is taken by cells: for each
(source, count) a bitset holds the terms with that count, AND plus popcount gives
the number of terms with count a in one source and b in another, and that number is
multiplied by the cell's value.  Cells with a zero count follow by complement: with
B(a) terms of count a, n(a, 0) is B(a) less the joint cells of a, and n(0, 0) is V less
all others.  The zero cells need only the sizes B, so

    sum = sum n(a, b) * (f(a, b) - f(a, 0) - f(0, b) + f(0, 0))
        + sum B(a) * (f(a, 0) - f(0, 0)) + sum B(b) * (f(0, b) - f(0, 0)) + V * f(0, 0).

1. Tasks count words in dictionaries, emptied when large; one shuffle by (language,
   term) adds them up and finds the terms in enough documents.  Kept counts are stored.
2. Terms are dealt into blocks by language, binary order of their total and hash:
   terms alike in frequency share few counts, so bitsets are dense, and a block has about
   ``BLOCK_ROWS`` counts at any size of the input.  A term of ever so many words is one row
   a source.  A task joins the bitsets of a block at a time and adds up pairs of
   sources over its blocks.
3. The result has one row per ordered pair of sources of a language; the levels
   (count, size) of both join there.

All arithmetic is exact: shares are computed in decimals, cell values fit 64 bits,
and their sums are kept as a high and a low part.

Defined results: null text, lang and source are empty strings.  Documents are rows, so
repeated rows count each.  A group without kept terms gives every term the share of a zero
count; a language without kept terms has pairs of value 0 and no terms.  Terms of equal
value rank by UTF-8 bytes.  An empty table gives no rows.  Texts are read whole, long ones
in blocks.  Only the named columns are read, so others cannot clash.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payscope.llm.common import stored

MIN_DOCUMENTS = 3
SCALE = 1_000_000_000
TOP_TERMS = 200

TABLE_ENTRIES = 400_000  # counts held by a task before it empties its tables
TEXT_BLOCK = 4 << 20
BLOCK_ROWS = 8192
CELLS = 2_000_000  # words of bitsets joined at a time
PAIR_SUMS = 1_000_000  # sums of pairs held by a task

# bytes of a term as they are, A-Z as a-z, all others blank
_LETTERS = bytes(b if b >= 0x80 else ord(chr(b).lower()) if chr(b).isalpha() else 0x20 for b in range(256))


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in blocks."""
    at = 0
    while at < len(text):
        part = text[at:at + TEXT_BLOCK].translate(_LETTERS)
        if at + len(part) < len(text):
            cut = part.rfind(b" ")
            if cut < 0:  # one term longer than a block
                part = text[at:].translate(_LETTERS)
                cut = part.find(b" ")
            part = part if cut < 0 else part[:cut + 1]
        at += len(part)
        yield part.split()


def count_terms(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents, in parts that
    add up.  No row has an empty term."""
    def emptied(tables: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
        for (in_lang, in_source), (n, found) in tables.items():
            terms = list(n)
            for at in range(0, len(terms), 50_000):
                part = terms[at:at + 50_000]
                yield pa.RecordBatch.from_arrays([
                    pa.array([in_lang] * len(part), pa.string()), pa.array([in_source] * len(part), pa.string()),
                    pa.array(part, pa.binary()).cast(pa.string()), pa.array(map(n.__getitem__, part), pa.int64()),
                    pa.array(map(found.__getitem__, part), pa.int64())], ["lang", "source", "term", "n", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        entries = 0
        for batch in batches:
            for in_lang, in_source, content in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                n, found = tables.setdefault((in_lang, in_source), (Counter(), Counter()))
                entries -= len(n)
                seen: set[bytes] = set()
                for terms in terms_of(content):
                    n.update(terms)
                    seen.update(terms)
                found.update(seen)
                entries += len(n)
                if entries > TABLE_ENTRIES:
                    yield from emptied(tables)
                    tables, entries = {}, 0
        yield from emptied(tables)

    def plain(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(""))

    rows = docs.select(plain(lang).alias("lang"), plain(source).alias("source"), plain(text).cast("binary").alias("text"))
    return rows.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def kept_counts(parts: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(lang, source, term, n, total, first) of the terms found in enough documents
    of their language; ``total`` is over its sources, ``first`` marks one row a term."""
    # dealt by (lang, term): the sums and the window share one shuffle
    summed = parts.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    return (summed.select("lang", "source", "term", "n", F.sum("n").over(term).alias("total"), F.sum("docs").over(term).alias("documents"),
                          (F.min("source").over(term) == F.col("source")).alias("first"))
            .where(F.col("documents") >= min_documents).drop("documents"))


def share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + kept)), exactly."""
    above = (n + 1).cast("decimal(20,0)") * F.lit(Decimal(SCALE)).cast("decimal(10,0)")
    return F.call_function("div", above, (total + kept).cast("decimal(20,0)")) + 1


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def group_table(docs: DataFrame, counts: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, v, total, lang_total, p0) of every group: kept terms of its
    language, words of the group and of the language, share of a zero count.
    Without kept terms v is 0 and p0 null."""
    groups = docs.select(F.coalesce(F.col(lang), F.lit("")).alias("lang"), F.coalesce(F.col(source), F.lit("")).alias("source")).distinct()
    words = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = counts.groupBy("lang").agg(F.sum(F.when(F.col("first"), 1).otherwise(0)).alias("v"), F.sum("n").alias("lang_total"))
    joined = groups.join(words, ["lang", "source"], "left").join(langs, "lang", "left")
    zero = joined.select("lang", "source", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("v", "total", "lang_total")])
    return zero.withColumn("p0", F.when(F.col("v") > 0, share(F.lit(0), F.col("total"), F.col("v"))))


def with_shares(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """``counts`` with p (share in the group), q (in the language) and p0."""
    joined = counts.join(groups, ["lang", "source"])
    return joined.select("lang", "source", "term", "n", "total_of_term", "p0", share(F.col("n"), F.col("total"), F.col("v")).alias("p"),
                         share(F.col("total_of_term"), F.col("lang_total"), F.col("v")).alias("q"))


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def level_bitsets(bit: np.ndarray, source: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row of the first entry, and bitset of term ids, of each (source, count)."""
    order = np.lexsort((n, source))
    new = np.r_[True, (source[order][1:] != source[order][:-1]) | (n[order][1:] != n[order][:-1])]
    level = np.empty(len(bit), np.int64)
    level[order] = np.cumsum(new) - 1
    held = np.zeros((int(new.sum()), -(-(int(bit.max()) + 1) // 64) * 64), bool)
    held[level, bit] = True
    return order[new], np.packbits(held, axis=1).view(np.uint64)


def joint_cells(bitsets: np.ndarray, source: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(level, level, terms in both) of levels of different sources, in parts."""
    step = max(1, CELLS // max(1, bitsets.size))
    for at in range(0, len(bitsets), step):
        both = np.bitwise_count(bitsets[at:at + step, None, :] & bitsets[None, :, :]).sum(axis=2, dtype=np.int64)
        both[source[at:at + step, None] == source[None, :]] = 0
        i, j = np.nonzero(both)
        yield i + at, j, both[i, j]


class PairSums:
    """Exact sums by (source, item): high and low 32 bits apart."""

    def __init__(self) -> None:
        self.parts: list[np.ndarray] = []
        self.rows = 0

    def add(self, source: np.ndarray, item: np.ndarray, value: np.ndarray, terms: np.ndarray) -> None:
        rows = self._by_pair(np.stack([source << 32 | item, (value >> 32) * terms, (value & 0xFFFFFFFF) * terms]))
        self.parts.append(rows)
        self.rows += rows.shape[1]
        if self.rows > PAIR_SUMS:
            self.parts = [self.summed()]
            self.rows = self.parts[0].shape[1]

    @staticmethod
    def _by_pair(rows: np.ndarray) -> np.ndarray:
        pairs, at = np.unique(rows[0], return_inverse=True)
        out = np.zeros((3, len(pairs)), np.int64)
        out[0] = pairs
        for k in (1, 2):
            np.add.at(out[k], at, rows[k])
        return out

    def summed(self) -> np.ndarray:
        return self._by_pair(np.concatenate(self.parts, axis=1))


def add_block(sums: PairSums, term: np.ndarray, source: np.ndarray, n: np.ndarray, p: np.ndarray, p0: np.ndarray) -> None:
    """A block's rows, those of a term together, into ``sums``."""
    bit = np.cumsum(np.r_[False, term[1:] != term[:-1]])
    at, bitsets = level_bitsets(bit, source, n)
    source, p, p0 = source[at], p[at], p0[at]
    for i, j, terms in joint_cells(bitsets, source):
        value = _f(p[i], p[j]) - _f(p[i], p0[j]) - _f(p0[i], p[j]) + _f(p0[i], p0[j])
        sums.add(source[i], source[j], value, terms)


def joint_sums(shares: DataFrame, blocks: int) -> DataFrame:
    """(lang, source, item, high, low): the joint cells' part of each ordered pair's
    sum, in parts that add up."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names: dict[str, int] = {}
        sums, at_lang, rest = PairSums(), None, None

        def told() -> pd.DataFrame:
            pair, high, low = sums.summed()
            known = np.array(list(names), dtype=object)
            return pd.DataFrame({"lang": at_lang, "source": known[pair >> 32], "item": known[pair & 0xFFFFFFFF], "high": high, "low": low})

        def blocks_of(rows: pd.DataFrame, whole: bool) -> tuple[list[slice], pd.DataFrame]:
            key = [rows[c].to_numpy() for c in ("lang", "octave", "slice")]
            starts = np.flatnonzero(np.r_[True, np.logical_or.reduce([k[1:] != k[:-1] for k in key])]) if len(rows) else np.empty(0, int)
            ends = np.r_[starts[1:], len(rows)] if len(rows) else starts
            done = len(starts) if whole else len(starts) - 1
            left = rows.iloc[len(rows):] if whole or not len(rows) else rows.iloc[starts[-1]:]
            return [slice(a, b) for a, b in zip(starts[:done], ends[:done], strict=True)], left

        def taken(rows: pd.DataFrame, whole: bool) -> Iterator[pd.DataFrame]:
            nonlocal sums, at_lang, rest
            found, rest = blocks_of(rows, whole)
            codes, seen = pd.factorize(rows["source"])
            number = np.array([names.setdefault(s, len(names)) for s in seen], np.int64)[codes] if len(rows) else codes
            lang, term = rows["lang"].to_numpy(), rows["term"].to_numpy()
            n, p, p0 = (rows[c].to_numpy(np.int64) for c in ("n", "p", "p0"))
            for x in found:
                if sums.rows and (lang[x.start] != at_lang or sums.rows > PAIR_SUMS):
                    yield told()
                    sums = PairSums()
                at_lang = lang[x.start]
                add_block(sums, term[x], number[x], n[x], p[x], p0[x])

        for batch in batches:
            yield from taken(batch if rest is None or not len(rest) else pd.concat([rest, batch], ignore_index=True), False)
        if rest is not None:
            yield from taken(rest.reset_index(drop=True), True)
        if sums.rows:
            yield told()

    block = [F.length(F.bin("total_of_term")).alias("octave"), F.pmod(F.xxhash64("term"), F.lit(blocks)).alias("slice")]
    rows = shares.select("lang", *block, "term", "source", "n", "p", "p0")
    dealt = rows.repartition("lang", "octave", "slice").sortWithinPartitions("lang", "octave", "slice", "term")
    return dealt.mapInPandas(run, "lang string, source string, item string, high long, low long")


def _zero_cells(p: Column, p_terms: Column, p0: Column, q: Column, q_terms: Column, q0: Column, v: Column) -> Column:
    """The part of a pair's sum that needs only the sizes of its levels."""
    @F.pandas_udf("decimal(38,0)")
    def parts(p: pd.Series, p_terms: pd.Series, p0: pd.Series, q: pd.Series, q_terms: pd.Series, q0: pd.Series, v: pd.Series) -> pd.Series:
        def one(p, p_terms, p0, q, q_terms, q0, v) -> Decimal:
            if not v:
                return Decimal(0)
            both = _f(np.int64(p0), np.int64(q0))
            total = int(v) * int(both)
            for value, terms in ((_f(p, np.int64(q0)) - both, p_terms), (_f(np.int64(p0), q) - both, q_terms)):
                total += (int(((value >> 32) * terms).sum()) << 32) + int(((value & 0xFFFFFFFF) * terms).sum())
            return Decimal(total)

        return pd.Series([one(*x) for x in zip(p, p_terms, p0, q, q_terms, q0, v, strict=True)], dtype=object)

    return parts(p, p_terms, p0, q, q_terms, q0, v)


def pair_values(groups: DataFrame, shares: DataFrame, joint: DataFrame) -> DataFrame:
    """(lang, source, item, value) of each ordered pair of sources of a language."""
    sizes = shares.groupBy("lang", "source", "n", "p").agg(F.count("*").alias("terms"))
    levels = sizes.groupBy("lang", "source").agg(F.collect_list(F.struct("p", "terms")).alias("levels"))
    of = groups.join(levels, ["lang", "source"], "left").select(
        "lang", "source", "v", F.coalesce("p0", F.lit(1)).alias("p0"),
        *[F.coalesce(F.col(f"levels.{c}"), F.array().cast("array<bigint>")).alias(c) for c in ("p", "terms")])
    other = of.select(F.col("lang").alias("of_lang"), F.col("source").alias("item"), F.col("p0").alias("q0"), F.col("p").alias("q"),
                      F.col("terms").alias("q_terms"))
    pairs = of.join(other, (F.col("lang") == F.col("of_lang")) & (F.col("source") != F.col("item"))).select(
        "lang", "source", "item",
        _zero_cells(F.col("p"), F.col("terms"), F.col("p0"), F.col("q"), F.col("q_terms"), F.col("q0"), F.col("v")).alias("zeros"))
    summed = joint.groupBy("lang", "source", "item").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    wide = "decimal(30,0)"
    both = F.coalesce(F.col("high"), F.lit(0)).cast("decimal(20,0)") * F.lit(Decimal(1 << 32)).cast("decimal(10,0)")
    value = F.col("zeros").cast(wide) + both + F.coalesce(F.col("low"), F.lit(0)).cast(wide)
    return pairs.join(summed, ["lang", "source", "item"], "left").select("lang", "source", "item", value.cast("long").alias("value"))


def ranked(values: DataFrame, part: str, top: int | None = None) -> DataFrame:
    """``values`` with their rank in the group, by value and UTF-8 bytes of the item."""
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item").asc())
    out = values.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    return out if top is None else out.where(F.col("rank") <= top)


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_documents: int = MIN_DOCUMENTS,
          top_terms: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): for part ``pair`` every other source of
    the language, for part ``term`` the terms that the group uses more than its language."""
    counts = stored(kept_counts(count_terms(docs, lang, source, text), min_documents), "term-counts")
    groups = stored(group_table(docs, counts, lang, source), "term-groups")
    shares = with_shares(counts.withColumnRenamed("total", "total_of_term"), groups)
    blocks = max(1, counts.count() // BLOCK_ROWS)
    pairs = pair_values(groups, shares, joint_sums(shares, blocks))
    more = shares.where(F.col("p") > F.col("q")).select("lang", "source", F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value"))
    return ranked(pairs, "pair").union(ranked(more, "term", top_terms))
