"""Near duplicates by order MinHash.

A document is the sequence of its words (letters and digits, lower case).  Its
symbols are windows of five words labelled with their occurrence number, so
that a window found twice counts twice.  One order MinHash takes, under one
random order, the ``TUPLE`` smallest symbols and joins them *in text order*:
equal sketches need the same symbols in the same order, which follows edit
similarity rather than mere overlap.  Three sketches make a band key; documents
that share one of the keys of ``BANDS`` are candidates.  Four bits of each
sketch make a signature: candidates that agree in fewer than ``AGREEING`` of the
48 are skipped.  A pair of similarity 0.8 agrees in about 32, with a
standard deviation of 3.3; either step misses it with a chance of about 1 in
10,000.

Candidates are verified by banded alignment: the longest common subsequence of
the two sequences of windows, without labels, which shift where an early
occurrence is missing.  It is the longest increasing run of matching positions
within a diagonal band or, where windows recur so often that matches are too
many, comes from rows of bits over the whole width.  Similarity is
common / (n + m - common); pairs of 0.8 or more are linked.  The band is as wide
as a pair of that similarity can need.  1 - similarity is a metric, used below.

No bucket is expanded into all pairs of a group:

1. documents of one word sequence are one node (pre-aggregated by digest);
2. in each bucket every node is compared with one leader, the node that
   meets most others in its buckets: linear in its size;
3. links are turned into components.  Nodes of a bucket left outside their
   leader's component are compared with the bucket's other components; a pair
   whose distances to the leader differ by more than 0.2 cannot be linked
   (triangle inequality), nor can one of too different lengths; those are
   skipped, and so are pairs whose 256 one-byte bin minima (one permutation
   hashing) agree three standard deviations less than at similarity 0.8, which a
   pair at 0.8 does with a chance of about 1 in 1,000: of pairs that meet in this step
   alone, so many are missed.  A pair is looked at in one of its buckets only.  All
   others are aligned, however many they are.

Results: one row per document: class_id is the smallest doc_id of its class,
class_size its number of documents, kept whether it stays (one per class).

Defined results: null and empty texts, and texts without a word, are one class.
Texts of fewer than five words are one symbol, alike only if equal.  Repeated
rows fall in one class, and each row of the class's smallest doc_id is marked
kept.  Very long texts are sketched in blocks, whole.  A null doc_id is never a
class id unless a class has no other.  Only the id and text columns are read.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payscope.llm.common import stored
from payscope.llm.components import components

WINDOW = 5
THRESHOLD = 0.8
TUPLE = 2
SKETCHES = 48
# which sketches make each band; each sketch serves two
BANDS = [(b, 16 + b, 32 + b) for b in range(16)] + [(b, 16 + (b + 5) % 16, 32 + (b + 11) % 16) for b in range(16)]
AGREEING = 18
BIN_DEVIATIONS = 3
BLOCK = 16384
MATCHES = 1 << 20  # matches of an alignment held at a time
MATCH_COST, ROW_COST = 1000, 5000  # of a match, and of a row of bits besides its length
WORD = re.compile(r"[^\W_]+")

_P1, _P2, _P3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_SEEDS = np.random.default_rng(20240229).integers(1, 2**63, size=SKETCHES, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _P2
    x = (x ^ (x >> np.uint64(27))) * _P3
    return x ^ (x >> np.uint64(31))


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def windows(words: list[str]) -> np.ndarray:
    """Hashes of the windows, in text order."""
    if not words:
        return np.empty(0, np.uint64)
    numbers: dict[str, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), dtype=np.int64, count=len(words))
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, numbers), dtype=np.uint64, count=len(numbers))[ids]
    n = max(1, len(words) - WINDOW + 1)
    h = np.full(n, len(words) if len(words) < WINDOW else 0, np.uint64)
    for k in range(min(WINDOW, len(words))):
        h = _mix(h * _P1 + hashed[k:k + n])
    return h


def symbols(words: list[str]) -> np.ndarray:
    """Hashes of the occurrence-labelled windows, in text order."""
    h = windows(words)
    n = len(h)
    if not n:
        return h
    order = np.argsort(h, kind="stable")
    first = np.r_[True, h[order][1:] != h[order][:-1]]
    start = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    occurrence = np.empty(n, np.uint64)
    occurrence[order] = (np.arange(n) - start).astype(np.uint64)
    return _mix(h + occurrence * _P1)


def order_minhash(labelled: np.ndarray) -> np.ndarray:
    """One hash per random order: its TUPLE smallest symbols in text order."""
    rows = np.arange(len(_SEEDS))
    best = np.empty((len(_SEEDS), 0), np.uint64)  # smallest values so far
    place = np.empty((len(_SEEDS), 0), np.int64)  # and their positions
    for at in range(0, len(labelled), BLOCK):
        v = _mix((labelled[None, at:at + BLOCK] ^ _SEEDS[:, None]) * _P1)
        for _ in range(min(TUPLE, v.shape[1])):
            k = v.argmin(axis=1)
            best, place = np.c_[best, v[rows, k]], np.c_[place, at + k]
            v[rows, k] = np.iinfo(np.uint64).max
        if best.shape[1] > TUPLE:
            keep = np.argsort(best, axis=1, kind="stable")[:, :TUPLE]
            best, place = np.take_along_axis(best, keep, 1), np.take_along_axis(place, keep, 1)
    out = _SEEDS.copy()
    for column in np.sort(place, axis=1).T:
        out = _mix(out * _P1 + labelled[column])
    return out


def band_keys(sketch: np.ndarray) -> np.ndarray:
    key = np.arange(1, len(BANDS) + 1, dtype=np.uint64)
    for column in sketch[np.array(BANDS)].T:
        key = _mix(key * _P1 + column)
    return key.view(np.int64)


def signature(sketch: np.ndarray) -> np.ndarray:
    """Four bits of each sketch, sixteen sketches to a number."""
    places = np.arange(16, dtype=np.uint64) * np.uint64(4)
    return ((sketch & np.uint64(15)).reshape(-1, 16) << places).sum(axis=1, dtype=np.uint64).view(np.int64)


def bins(labelled: np.ndarray) -> np.ndarray:
    """One byte for each of 256 bins: of its smallest symbol, 0 if empty."""
    out = np.zeros(256, np.uint8)
    falling = np.sort(labelled >> np.uint64(8) | (labelled << np.uint64(56)))[::-1]  # the bin is on top
    out[(falling >> np.uint64(56)).astype(np.int64)] = 1 + _mix(falling) % np.uint64(255)  # the last, smallest, stays
    return out.view("<i8")


def may_be_similar(x: str, y: str, threshold: float) -> Column:
    """False if the share of equal bins lies BIN_DEVIATIONS below what a pair at
    the threshold has."""
    ones = lambda d: d.bitwiseAND(F.lit(0x0101010101010101))

    def set_bytes(d: Column) -> Column:
        d = d.bitwiseOR(F.shiftrightunsigned(d, 4))
        d = d.bitwiseOR(F.shiftrightunsigned(d, 2))
        return ones(d.bitwiseOR(F.shiftrightunsigned(d, 1)))

    def counted(a: Column, b: Column) -> Column:
        used = F.bit_count(set_bytes(a.bitwiseOR(b)))
        return used * 1000 + used - F.bit_count(set_bytes(a.bitwiseXOR(b)))

    total = F.aggregate(F.zip_with(x, y, counted), F.lit(0), lambda s, c: s + c)
    used, equal = F.floor(total / 1000), total % 1000
    return equal / used >= threshold - BIN_DEVIATIONS * (threshold * (1 - threshold)) ** 0.5 / F.sqrt(used)


def agreeing(x: str, y: str) -> Column:
    """In how many sketches two signature columns agree, by their four bits."""
    total = F.lit(0)
    for k in range(SKETCHES // 16):
        d = F.get(x, F.lit(k)).bitwiseXOR(F.get(y, F.lit(k)))
        d = d.bitwiseOR(F.shiftrightunsigned(d, 1))
        d = d.bitwiseOR(F.shiftrightunsigned(d, 2)).bitwiseAND(F.lit(0x1111111111111111))
        total = total + (16 - F.bit_count(d))
    return total


def _by_matches(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Longest common subsequence within the band: longest increasing run over
    the matches, those of one position of ``a`` from the last to the first."""
    in_b = np.bincount(b, minlength=a.max() + 1)
    places = len(b) - 1 - np.argsort(b[::-1], kind="stable")  # by number, descending
    starts, matches = (np.cumsum(in_b) - in_b)[a], in_b[a]
    upto = np.cumsum(matches)
    tails: list[int] = []
    at = 0
    while at < len(a):
        end = max(at + 1, int(np.searchsorted(upto, MATCHES + upto[at] - matches[at], side="right")))
        count = matches[at:end]
        within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        i, j = np.repeat(np.arange(at, end), count), places[np.repeat(starts[at:end], count) + within]
        for p in j[np.abs(i - j) <= band].tolist():
            k = bisect.bisect_left(tails, p)
            if k == len(tails):
                tails.append(p)
            else:
                tails[k] = p
        at = end
    return len(tails)


def _by_bits(a: np.ndarray, b: np.ndarray) -> int:
    """Longest common subsequence, a row of bits for each position of ``b``."""
    in_a = np.bincount(a, minlength=b.max() + 1)
    places, starts = np.argsort(a, kind="stable"), np.cumsum(in_a) - in_a

    @lru_cache(maxsize=256)
    def mask(number: int) -> int:
        row = np.zeros(len(a), np.uint8)
        row[places[starts[number]:starts[number] + in_a[number]]] = 1
        return int.from_bytes(np.packbits(row, bitorder="little").tobytes(), "little")

    every = row = (1 << len(a)) - 1
    for number in b[in_a[b] > 0].tolist():
        met = row & mask(number)
        row = (row + met | row - met) & every
    return len(a) - row.bit_count()


def similarity(x: np.ndarray, y: np.ndarray, threshold: float = THRESHOLD) -> float:
    """Banded alignment of two sequences of windows."""
    n, m = len(x), len(y)
    if not n or not m:
        return float(n == m)
    # matches lie no further from the diagonal than symbols stay unmatched;
    # wide enough to be exact up to twice the threshold's distance
    band = int((1 - threshold) / threshold * (n + m)) + 1
    common = 0
    for _ in range(2):  # equal beginnings, then equal ends, are common
        k = min(len(x), len(y))
        differ = x[:k] != y[:k]
        k = int(differ.argmax()) if differ.any() else k
        common, x, y = common + k, x[k:][::-1], y[k:][::-1]
    if len(x) and len(y):
        ids = np.unique(np.concatenate([x, y]), return_inverse=True)[1]
        a, b = ids[:len(x)], ids[len(x):]
        matches = int(np.bincount(b, minlength=len(ids))[a].sum())
        # whichever is less work; a text of few distinct windows has many matches
        few = matches * MATCH_COST <= len(b) * (ROW_COST + len(a))
        common += _by_matches(a, b, band) if few else _by_bits(a, b)
    return common / (n + m - common)


def _digest(words: list[str]) -> str:
    return hashlib.md5(" ".join(words).encode("utf-8", "surrogatepass")).hexdigest()


def sketches(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, digest, n, bands, signature, bins) per row: digest of the word
    sequence, number of symbols, band keys."""

    @F.pandas_udf("digest string, n long, bands array<long>, signature array<long>, bins array<long>")
    def sketched(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for words in map(words_of, texts):
            labelled = symbols(words)
            sketch = order_minhash(labelled) if len(labelled) else None
            rows.append((_digest(words), len(labelled), [] if sketch is None else band_keys(sketch),
                         [0] * (SKETCHES // 16) if sketch is None else signature(sketch), bins(labelled)))
        return pd.DataFrame(rows, columns=["digest", "n", "bands", "signature", "bins"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), sketched(F.col(text)).alias("s")).select("doc_id", "s.*")


def _symbols_of(docs: DataFrame, wanted: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(node, symbols) of ``wanted`` (node, first_id, digest); symbols are the
    windows without labels, as little-endian bytes.  Rows of one id may differ in text: the digest tells."""
    source = docs.select(F.col(doc_id).cast("long").alias("first_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None
        for batch in batches:
            rows = []
            for node, digest, words in zip(batch["node"], batch["digest"], map(words_of, batch["text"]), strict=True):
                if node != last and _digest(words) == digest:
                    rows.append((node, windows(words).astype("<u8").tobytes()))
                    last = node
            yield pd.DataFrame(rows, columns=["node", "symbols"])

    return (source.join(wanted, source["first_id"].eqNullSafe(wanted["first_id"])).select("node", "digest", "text")
            .mapInPandas(run, "node long, symbols binary"))


def _similar(pairs: DataFrame, content: DataFrame, threshold: float) -> DataFrame:
    """``pairs`` (a, b) with the similarity of their symbols."""
    both = (pairs.join(content.select(F.col("node").alias("a"), F.col("symbols").alias("x")), "a")
            .join(content.select(F.col("node").alias("b"), F.col("symbols").alias("y")), "b"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [similarity(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), threshold) for x, y in zip(batch["x"], batch["y"], strict=True)]
            yield pd.DataFrame({"a": batch["a"], "b": batch["b"], "similarity": pd.array(found, dtype="float64")})

    return both.select("a", "b", "x", "y").mapInPandas(run, "a long, b long, similarity double")


def links(nodes: DataFrame, symbols_of: Callable[[DataFrame], DataFrame], threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(links (a, b), components) among ``nodes`` (node, n, bands, signature, bins);
    ``symbols_of(nodes)`` gives (node, symbols) for some of them."""
    rows = nodes.select(F.explode("bands").alias("key"), "node", "n")
    sizes = rows.groupBy("key").agg(F.count("*").alias("k")).where("k > 1")
    shared = stored(rows.join(sizes, "key"), "shared")
    # the leader is the node that meets most others in its buckets: of copies
    # of one text that is the text itself, to which each copy is nearest
    met = shared.groupBy("node").agg(F.sum("k").alias("met"))
    rank = F.col("met") * 65536 + F.pmod(F.xxhash64("key", "node"), F.lit(65536))
    heads = shared.join(met, "node").groupBy("key").agg(F.max_by(F.struct("node", "n"), rank).alias("lead"))
    alike = lambda n, m: F.least(n, m) >= threshold * F.greatest(n, m)
    held = stored(shared.drop("k").join(heads.select("key", F.col("lead.node").alias("leader")), "key"), "buckets")

    # 1: each node with its bucket's leader, whatever the lengths: the
    # distance, where it is known, also serves to skip pairs in 2
    signed = lambda to: nodes.select(F.col("node").alias(to), F.col("signature").alias(f"signature_{to}"))
    first = held.where("node != leader").select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct()
    first = first.join(signed("a"), "a").join(signed("b"), "b").where(agreeing("signature_a", "signature_b") >= AGREEING)
    first = stored(first.select("a", "b"), "pairs")
    ends = lambda pairs: pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    content = stored(symbols_of(ends(first)), "symbols")
    seen = stored(_similar(first, content, threshold), "similar")
    linked = seen.where(F.col("similarity") >= threshold).select("a", "b")
    roots = components(linked)

    # 2: pairs of other components
    # null where the signatures skipped the pair: least() alone would pass over it
    near = F.when(F.col("similarity").isNotNull(), F.least(1 - F.col("similarity"), F.lit(2 * (1 - threshold))))
    distance = F.when(F.col("node") == F.col("leader"), 0.0).otherwise(near)
    known = held.join(seen.select(F.col("a").alias("node"), F.col("b").alias("leader"), "similarity"), ["node", "leader"], "left")
    known = (known.withColumn("distance", distance).drop("similarity")
             .join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    split = known.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.max(F.when(F.col("node") == F.col("leader"), F.col("root"))).alias("lead_root")).where("lo != hi")
    known = known.where("node != leader").join(split.select("key", "lead_root"), "key").join(nodes.select("node", "signature", "bins", "bands"), "node")
    known = stored(known, "unsettled")
    outside = known.where("root != lead_root").select("key", *[F.col(c).alias(f"x_{c}") for c in ("node", "n", "distance", "root", "signature", "bins", "bands")])
    may = ((F.col("x_root") != F.col("root")) & alike(F.col("x_n"), F.col("n"))
           & (agreeing("x_signature", "signature") >= AGREEING)
           & F.coalesce(F.abs(F.col("x_distance") - F.col("distance")) <= 1 - threshold + 1e-9, F.lit(True))
           & (F.array_min(F.array_intersect("x_bands", "bands")) == F.col("key"))
           & may_be_similar("x_bins", "bins", threshold)
           & ((F.col("root") == F.col("lead_root")) | (F.col("x_node") < F.col("node"))))
    rest = outside.join(known, "key").where(may).select(F.col("x_node").alias("a"), F.col("node").alias("b")).distinct()
    rest = stored(rest, "pairs")
    content = content.union(symbols_of(ends(rest).join(content.select("node"), "node", "left_anti")))
    more = stored(_similar(rest, content, threshold).where(F.col("similarity") >= threshold).select("a", "b"), "links")
    if more.isEmpty():
        return linked, roots
    every = linked.union(more)
    return every, components(every)


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, class_size, kept, text_digest
    (of the word sequence) and n_copies (rows of that sequence)."""
    rows = stored(sketches(docs, doc_id, text), "sketches")
    nodes = rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("signature").alias("signature"), F.first("bins").alias("bins"), F.count("*").alias("copies"))
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")

    def symbols_of(wanted: DataFrame) -> DataFrame:
        return _symbols_of(docs, nodes.join(wanted, "node", "left_semi").select("node", "first_id", "digest"), doc_id, text)

    _, roots = links(nodes.select("node", "n", "bands", "signature", "bins"), symbols_of, threshold)
    placed = nodes.select("node", "digest", "first_id", "copies").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    totals = placed.groupBy("root").agg(F.min("first_id").alias("class_id"), F.sum("copies").alias("class_size"))
    placed = placed.join(totals, "root").select("digest", "class_id", "class_size", "copies")
    return (rows.select("doc_id", "digest").join(placed, "digest")
            .select("doc_id", "class_id", "class_size", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"),
                    F.col("digest").alias("text_digest"), F.col("copies").alias("n_copies")))
