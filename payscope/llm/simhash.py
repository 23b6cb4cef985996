"""Near duplicates by SimHash, found through Golay codes.

A fingerprint has 64 bits: bit b is set if it is set in more than half of the
document's shingle hashes.  Fingerprints link at 3 or fewer differing bits.

The Golay code of 23 bits is perfect: every word lies within 3 bits of exactly one
of its 4096 codewords, whose 12 message bits serve as its index.  A word's keys are
the indices of the codewords within 4 bits of it, one or six of them.  Two words that
differ in at most 2 bits share a key: a word halfway between lies within 3 of a
codeword, so both lie within 4.  Of two words that differ in 1 bit, one has even
weight; there its nearest codeword alone will do, as the odd one has it among its
keys.

A fingerprint is cut into segments of 22, 21 and 21 bits.  At 3 or fewer errors, either

- some segment has none and the next one (the first follows the last) at most 2: the key
  is the segment as it is with an index of the next, 33 bits; or
- each segment has exactly one: the key is an index of each, 36 bits.

A fingerprint has 48 keys on average.  A random pair shares a key with a chance of 3 in 10^8,
so buckets stay small at any corpus size that 64 bits can tell apart.

1. One Arrow pass makes fingerprints, stored as (doc_id, fingerprint).
2. Distinct fingerprints, however many documents share one, are dealt by key.  A task reads
   a bucket at a time and verifies distances.  A long bucket is searched breadth first
   against the fingerprints not reached yet: it gives a spanning tree, not all pairs.
3. A bucket of more than ``BUCKET`` fingerprints is not held: its fingerprints go a second,
   exact way, by all their 560 keys of 13 hex digits out of 16.  Three errors touch three
   digits at most, and a bucket has at most 16^3 = 4096 fingerprints whatever the data.
4. Links become components; documents join them on the fingerprint.

Defined results: null and empty texts, and texts without a word, have fingerprint zero, linked
like any other.  Fewer than three words are one shingle.  Repeated rows get a row each.  A null
doc_id is never a component's id unless the component has no other.  Very long texts are
hashed in blocks, whole.  An empty table gives no rows.  Only the id and text columns are read,
so others cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payscope.llm.common import shuffle_partitions, stored
from payscope.llm.components import components

SEED = 42
SHINGLE_WORDS = 3
DISTANCE = 3
TEXT_BLOCK = 4 << 20
BUCKET = 4096
SHORT = 16  # buckets compared without a search

# The Golay code's length, generator polynomial and radius.
LENGTH, GENERATOR, RADIUS = 23, 0b101011100011, 3
CHECK_BITS = 11
SEGMENTS = ((0, 22), (22, 21), (43, 21))

# A-Z as a-z and ASCII blanks as spaces; all other bytes as they are
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))


# fingerprints

def words_of(text: bytes) -> Iterator[list[bytes]]:
    """The lower-cased words of a text, in blocks."""
    at = 0
    while at < len(text):
        part = text[at:at + TEXT_BLOCK].translate(_PLAIN)
        if at + len(part) < len(text):
            cut = part.rfind(b" ")
            if cut < 0:  # one word longer than a block
                part = text[at:].translate(_PLAIN)
                cut = part.find(b" ")
            part = part if cut < 0 else part[:cut + 1]
        at += len(part)
        yield part.split()


def shingle_hashes(text: bytes, size: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """XXH64 of the shingles, in blocks."""
    held: list[bytes] = []
    found = False
    for block in words_of(text):
        held += block
        if len(held) >= size:
            shingles = map(b" ".join, zip(*[held[k:] for k in range(size)], strict=False))
            yield np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, len(held) - size + 1)
            found, held = True, held[len(held) - size + 1:]
    if held and not found:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(held), SEED)], np.uint64)


def fingerprint(text: bytes, size: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit fingerprint."""
    set_in, n = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text, size):
        for at in range(0, len(hashes), 255):  # counts of 255 fit a byte
            part = hashes[at:at + 255]
            set_in += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint8)
        n += len(hashes)
    return int(np.packbits(2 * set_in > n, bitorder="little").view(np.int64)[0])


def fingerprint_of(text: Column, size: int = SHINGLE_WORDS) -> Column:
    @F.pandas_udf("long")
    def hashed(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t or b"", size) for t in texts], dtype="int64")

    return hashed(text.cast("binary"))


# keys

@lru_cache
def _golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of a word's bytes (3, 256); by syndrome, the error patterns of up to
    RADIUS + 1 bits that lead to codewords, lightest first, and how many there are."""
    unit = [1 << k for k in range(LENGTH + 1)]
    for k in range(LENGTH + 1):
        while unit[k].bit_length() > CHECK_BITS:
            unit[k] ^= GENERATOR << (unit[k].bit_length() - 1 - CHECK_BITS)

    def syndrome(bits: tuple[int, ...]) -> int:
        out = 0
        for k in bits:
            out ^= unit[k]
        return out

    by_byte = np.array([[syndrome(tuple(8 * k + i for i in range(8) if b >> i & 1)) for b in range(256)] for k in range(3)], np.int64)
    patterns: list[list[int]] = [[] for _ in range(1 << CHECK_BITS)]
    for weight in range(RADIUS + 2):
        for bits in combinations(range(LENGTH), weight):
            patterns[syndrome(bits)].append(sum(1 << k for k in bits))
    most = max(map(len, patterns))
    return by_byte, np.array([p + [0] * (most - len(p)) for p in patterns], np.int64), np.array([len(p) for p in patterns])


def codewords(words: np.ndarray, one_error: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the codewords near each word (words, 6), and which of them count.
    Words that differ in up to 2 bits share one; with ``one_error``, those
    that differ in 1."""
    by_byte, patterns, many = _golay()
    syndrome = by_byte[0][words & 255] ^ by_byte[1][words >> 8 & 255] ^ by_byte[2][words >> 16]
    count = many[syndrome]
    if one_error:
        count = np.where(np.bitwise_count(words) % 2 == 0, 1, count)
    return (words[:, None] ^ patterns[syndrome]) >> CHECK_BITS, np.arange(patterns.shape[1]) < count[:, None]


def golay_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, tag, key) of every key of ``prints`` (uint64)."""
    segments = [(prints >> np.uint64(at) & np.uint64((1 << width) - 1)).astype(np.int64) for at, width in SEGMENTS]
    rows, tags, keys = [], [], []
    for tag, exact in enumerate(segments):
        index, counts = codewords(segments[(tag + 1) % 3])
        row, which = np.nonzero(counts)
        rows.append(row)
        keys.append(exact[row] << 12 | index[row, which])
        tags.append(np.full(len(row), tag))
    (x, in_x), (y, in_y), (z, in_z) = (codewords(s, one_error=True) for s in segments)
    row, i, j, k = np.nonzero(in_x[:, :, None, None] & in_y[:, None, :, None] & in_z[:, None, None, :])
    rows.append(row)
    keys.append(x[row, i] << 24 | y[row, j] << 12 | z[row, k])
    tags.append(np.full(len(row), 3))
    return np.concatenate(rows), np.concatenate(tags), np.concatenate(keys)


def digit_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, tag, key): each fingerprint without each three of its 16 hex digits."""
    whole = (1 << 64) - 1
    masks = np.array([whole ^ sum(15 << 4 * d for d in digits) for digits in combinations(range(16), DISTANCE)], np.uint64)
    keys = (prints[:, None] & masks[None, :]).view(np.int64)
    row, tag = np.divmod(np.arange(keys.size), len(masks))
    return row, tag + 4, keys.ravel()


def dealt(prints: DataFrame, make_keys) -> DataFrame:
    """(tag, key, fp), dealt and sorted by key, of distinct fingerprints (fp: long)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column(0).to_numpy()
            for at in range(0, len(held), 2000):
                part = held[at:at + 2000]
                row, tag, key = make_keys(part.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(tag.astype(np.int32)), pa.array(key), pa.array(part[row])], ["tag", "key", "fp"])

    return prints.select("fp").mapInArrow(run, "tag int, key long, fp long").repartition("tag", "key").sortWithinPartitions("tag", "key")


# links

def far(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y)


def search(prints: np.ndarray) -> tuple[list[np.ndarray], list[int]]:
    """Links that span the components of a bucket: fingerprints reached, and from where."""
    reached, roots, rest = [], [], prints
    while len(rest) > 1:
        root, rest = rest[0], rest[1:]
        todo = [root]
        while todo and len(rest):
            near = far(rest, todo.pop()) <= DISTANCE
            if near.any():
                reached.append(rest[near])
                roots.append(root)
                todo += list(rest[near])
                rest = rest[~near]
    return reached, roots


def links(buckets: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(a, b) for links within buckets; (a, null) for each fingerprint of a bucket of more
    than ``bucket`` of them."""
    def told(a: list[np.ndarray], b: list[np.ndarray], large: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if a:
            pairs = np.unique(np.stack([np.concatenate(a), np.concatenate(b)]), axis=1).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])
        for x in large:
            yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.nulls(len(x), pa.int64())], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.empty(0, np.int64)
        tag, key, fp = none, none, none.view(np.uint64)  # of the bucket that may go on
        streaming = None  # the bucket whose fingerprints are only passed on

        def taken(tag: np.ndarray, key: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
            """Whole buckets."""
            starts = np.flatnonzero(np.r_[True, (tag[1:] != tag[:-1]) | (key[1:] != key[:-1])])
            sizes = np.diff(np.r_[starts, len(fp)])
            a, b, large = [], [], []
            of, place = np.repeat(sizes, sizes), np.arange(len(fp)) - np.repeat(starts, sizes)
            for step in range(1, SHORT):
                at = np.flatnonzero((of <= SHORT) & (place + step < of))
                if not len(at):
                    break
                at = at[far(fp[at], fp[at + step]) <= DISTANCE]
                a.append(fp[at + step])
                b.append(fp[at])
            for k in np.flatnonzero(sizes > SHORT):
                held = fp[starts[k]:starts[k] + sizes[k]]
                if len(held) > bucket:
                    large.append(held)
                    continue
                for found, root in zip(*search(held), strict=True):
                    a.append(found)
                    b.append(np.full(len(found), root))
            yield from told(a, b, large)

        for batch in batches:
            own = [c.to_numpy() for c in batch.columns]
            tag, key = np.r_[tag, own[0].astype(np.int64)], np.r_[key, own[1]]
            fp = np.r_[fp, own[2].view(np.uint64)]
            if streaming is not None:
                ends = np.flatnonzero((tag != streaming[0]) | (key != streaming[1]))
                cut = ends[0] if len(ends) else len(fp)
                yield from told([], [], [fp[:cut]] if cut else [])
                tag, key, fp = tag[cut:], key[cut:], fp[cut:]
                streaming = None if len(fp) else streaming
            if not len(fp):
                continue
            last = len(fp) - np.argmax(((tag != tag[-1]) | (key != key[-1]))[::-1]) if (tag[0], key[0]) != (tag[-1], key[-1]) else 0
            if last:
                yield from taken(tag[:last], key[:last], fp[:last])
                tag, key, fp = tag[last:], key[last:], fp[last:]
            if len(fp) > bucket:
                streaming = (tag[0], key[0])
                yield from told([], [], [fp])
                tag, key, fp = none, none, none.view(np.uint64)
        if len(fp):
            yield from taken(tag, key, fp)

    return buckets.mapInArrow(run, "a long, b long")


def near_links(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(a, b) of distinct fingerprints (fp), stored: their components are those of all pairs at
    DISTANCE or less."""
    def spread(prints: DataFrame) -> DataFrame:
        # keys are many times what they are made from: tasks by number, not by the size of a fingerprint
        return prints.select("fp").repartition(shuffle_partitions(prints.sparkSession), F.xxhash64("fp"))

    found = stored(links(dealt(spread(prints), golay_keys), bucket), "simhash-links")
    large = found.where(F.col("b").isNull()).select(F.col("a").alias("fp")).distinct()
    again = links(dealt(spread(large), digit_keys), max(bucket, 16**DISTANCE))
    return stored(found.where(F.col("b").isNotNull()).union(again).distinct(), "simhash-links")


def hexed(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp) per row of ``docs``."""
    return docs.select(F.col(doc_id).alias("doc_id"), fingerprint_of(F.col(text), size).alias("fp"))


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE_WORDS, bucket: int = BUCKET) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint, component_id (the smallest doc_id
    linked to it, directly or by way of others)."""
    rows = stored(fingerprints(docs, doc_id, text, size), "simhash")
    prints = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    found = components(near_links(prints, bucket))
    members = found.select(F.col("node").alias("member"), "root").union(found.select(F.col("root").alias("member"), "root").distinct())
    # stored tables, so that plain joins follow: a fingerprint of very many documents, or a
    # component of very many fingerprints, is split
    least = stored(members.join(prints, F.col("member") == F.col("fp")).groupBy("root").agg(F.min("least").alias("component")), "simhash-least")
    of = members.join(least, "root").select("member", "component")
    known = stored(prints.join(of, F.col("fp") == F.col("member"), "left").select(
        F.col("fp").alias("known"), F.when(F.col("member").isNull(), F.col("least")).otherwise(F.col("component")).alias("component_id")), "simhash-classes")
    return rows.join(known, F.col("fp") == F.col("known")).select("doc_id", hexed(F.col("fp")).alias("fingerprint"), "component_id")
