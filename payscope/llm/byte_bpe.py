"""Byte-level BPE encoding and decoding with higher-order functions.

Each distinct word of the corpus is encoded once:

1. Texts are packed (compressed, about ``BLOB_BYTES`` together) and dealt out in
   groups of about ``group_bytes``.  This is the only time that texts move.
2. A group's distinct words, by the split pattern, go out by hash bucket, packed.
3. A bucket's distinct words, each an array of bytes, are folded by ``aggregate``:
   * a piece is written as one character (a byte as itself, a longer piece by its
     rank), so that the array is a string whose characters are its pieces;
   * each step looks up the ranks of all adjacent pairs and replaces every
     occurrence, from the left, of the pair of lowest rank by the merged piece;
   * ranks come from a literal: an array of small maps, indexed by the pair's
     hash, so that a lookup reads a few entries;
   * decoding concatenates the binary pieces of the ids, from a literal array.
4. Words are found again by their decoded bytes, so one that ids do not give back
   stops the job.  Buckets send each group its words with their ids, packed, and groups
   put their documents together.

A word found in every group takes one row a group, in packed form, and is folded once.
A group's words are bounded by its text, a bucket's by the vocabulary of the corpus
over the number of buckets.

To find a group's words, texts are cut into units at single spaces and newlines between
characters that are not blank; no word crosses such a place.

The cost of one word grows with its length times the number of distinct merges
in it; runs of many thousand letters without a blank are slow but whole.

Defined results: null and empty texts have no ids.  Texts of any length are
encoded whole.  Repeated rows are encoded alike.  Only the id and text columns
are read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payscope.llm.common import shuffle_partitions
from payscope.llm.tokens import load_ranks

GROUP_BYTES = 24 << 20
BLOB_BYTES = 1 << 20
BUCKETS = 1 << 16  # of pairs, by hash
WORD_BUCKETS = 4  # a shuffle partition

# Unicode's White_Space characters.
WHITE = "\\t-\\r \u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CUT = rf"(?<=[^{WHITE}])(?=[ \n][^{WHITE}])"


def code_point(rank: int) -> int:
    """The character of a longer piece: by rank, past Latin-1, around surrogates."""
    return rank + 0x100 if rank + 0x100 < 0xD800 else rank + 0x900


@dataclass(frozen=True)
class Vocabulary:
    """A rank file as literals (constant columns).

    ``merges``: array<map<string, long>>, two characters -> code point of the
    merged piece, times 2^32, by the pair's hash; ``ids`` and ``characters`` by code point, ``pieces``
    (hex) by id."""

    merges: Column
    ids: Column
    characters: Column
    pieces: Column


def _literal(value, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(value, separators=(",", ":"))), kind)


def vocabulary(path: str) -> Vocabulary:
    ranks = load_ranks(path)
    point = {piece: piece[0] if len(piece) == 1 else code_point(rank) for piece, rank in ranks.items()}
    if len(point) != len(set(point.values())) or max(point.values()) > 0xFFFF:
        raise ValueError("the vocabulary does not fit one character per piece")
    buckets: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
    for piece, merged in point.items():
        for cut in range(1, len(piece)):
            left, right = point.get(piece[:cut]), point.get(piece[cut:])
            if left is not None and right is not None:
                pair = chr(left) + chr(right)
                buckets[xxhash.xxh64_intdigest(pair.encode(), 42) % BUCKETS][pair] = merged << 32
    ids = [-1] * (max(point.values()) + 1)
    pieces = [""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        ids[point[piece]], pieces[rank] = rank, piece.hex()
    characters = ["" if 0xD800 <= c < 0xE000 else chr(c) for c in range(len(ids))]
    return Vocabulary(_literal(buckets, "array<map<string,bigint>>"), _literal(ids, "array<int>"),
                      _literal(characters, "array<string>"), _literal(pieces, "array<string>"))


def word_ids(word: Column, v: Vocabulary) -> Column:
    """array<int>: ids of one word (a string), by folding its ranked merges."""

    def merged_point(pair: Column) -> Column:
        bucket = F.get(v.merges, F.xxhash64(pair).bitwiseAND(F.lit(BUCKETS - 1)).cast("int"))
        return F.try_element_at(bucket, pair)

    def lowest(pieces: Column) -> Column:
        # code point of the merged pair above its place: the least is the
        # lowest rank, the leftmost of equals; -1 if there is none
        pairs = F.regexp_extract_all(pieces, F.lit("(?s)(?=(..))"), F.lit(1))
        return F.coalesce(F.array_min(F.transform(pairs, lambda p, i: merged_point(p) + i)), F.lit(-1).cast("long"))

    def replaced(pieces: Column, low: Column) -> Column:
        pair = F.substr(pieces, low.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int") + 1, F.lit(2))
        return F.replace(pieces, pair, F.get(v.characters, F.shiftright(low, 32).cast("int")))

    # steps look for the lowest pair and merge it in turn, until there is none
    def step(s: Column) -> Column:
        found = F.struct(s["pieces"].alias("pieces"), lowest(s["pieces"]).alias("low"))
        merged = F.struct(replaced(s["pieces"], s["low"]).alias("pieces"), F.lit(None).cast("long").alias("low"))
        return F.when(s["low"].isNull(), found).when(s["low"] >= 0, merged).otherwise(s)

    raw = F.decode(F.encode(word, "utf-8"), "iso-8859-1")
    start = F.struct(raw.alias("pieces"), F.lit(None).cast("long").alias("low"))
    folded = F.aggregate(F.sequence(F.lit(1), 2 * F.length(raw)), start, lambda s, _: step(s), lambda s: s["pieces"])
    return F.transform(F.split(folded, ""), lambda p: F.get(v.ids, F.ascii(p)))


def cut_units(text: str) -> list[str]:
    """The units of a text."""
    return re.split(CUT, text) if text else []


# Blanks besides space and newline, as Unicode or Python have them.
_OTHER = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]


def even(text: str) -> bool:
    """Whether every blank of a text is a single space or newline between others."""
    return not (text[0] in " \n" or text[-1] in " \n" or any(x in text for x in ("  ", "\n\n", " \n", "\n "))
                or any(map(text.__contains__, _OTHER)))


# No text has a lone surrogate.
_MARK = "\ud800"


def unit_keys(text: str) -> list[str]:
    """A key for each unit of a text.  A unit that the text was cut before goes by what
    follows its space, or by itself after a newline; any other (the first of a text) is
    marked."""
    if not text:
        return []
    if even(text):
        head, *rest = text.replace("\n", " \n").split(" ")
        return [_MARK + head, *rest]
    return [u[1:] if u[0] == " " and len(u) > 1 and not u[1].isspace() else u if u[0] == "\n" and len(u) > 1 and not u[1].isspace()
            else _MARK + u for u in cut_units(text)]


def unit_of(key: str) -> str:
    return key[1:] if key[0] == _MARK else key if key[0] == "\n" else " " + key


def pack(items: list[bytes]) -> bytes:
    """A list of byte strings in one, compressed."""
    lengths = np.fromiter(map(len, items), "<u8", len(items))
    return zstandard.ZstdCompressor(level=3).compress(np.uint64(len(items)).tobytes() + lengths.tobytes() + b"".join(items))


def unpack(packed: bytes) -> list[bytes]:
    whole = zstandard.ZstdDecompressor().decompress(packed)
    n = int(np.frombuffer(whole, "<u8", 1)[0])
    ends = (8 + 8 * n + np.cumsum(np.frombuffer(whole, "<u8", n, 8))).tolist()
    return [whole[a:b] for a, b in zip([8 + 8 * n, *ends], ends, strict=False)]


class UnitTable(dict):
    """Ids (decimal, joined by blanks) and decoded bytes by unit key, put together
    from those of words when first asked for.  ``ids`` are by decoded word."""

    def __init__(self, pattern: str, ids: dict[str, str]) -> None:
        self.ids, self.find = ids, regex.compile(pattern).findall

    def __missing__(self, key: str) -> tuple[str, bytes]:
        words = self.find(unit_of(key))
        found = self[key] = " ".join([self.ids[w] for w in words]), "".join(words).encode()
        return found


def packed_texts(docs: DataFrame, groups: int, blob_bytes: int) -> DataFrame:
    """(part, ids, texts): documents in packs, dealt to parts in turn."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() * 7919  # tasks begin at different parts
        ids, texts, size = [], [], 0

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([at % groups], pa.int64()), pa.array([ids], pa.list_(id_type)),
                                               pa.array([pack(texts)], pa.large_binary()).cast(pa.binary())], ["part", "ids", "texts"])

        for batch in batches:
            id_type = batch.schema.field(0).type
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(k)
                texts.append(text)
                size += len(text)
                if size >= blob_bytes:
                    yield told()
                    ids, texts, size, at = [], [], 0, at + 1
        if ids:
            yield told()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, f"part long, ids array<{kind}>, texts binary")


def encode(docs: DataFrame, vocabulary_path: str, doc_id: str = "doc_id", text: str = "text", group_bytes: int = GROUP_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, ids (decimal, joined by one blank),
    n_tokens, and decoded, the bytes that the ids stand for.  ``ids_array`` gives
    the ids as numbers."""
    import public_tokenizers

    pattern = public_tokenizers.PATTERN
    v = vocabulary(vocabulary_path)
    parts = shuffle_partitions(docs.sparkSession)
    buckets = WORD_BUCKETS * parts
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    total = narrow.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    dealt = packed_texts(narrow, total // group_bytes + 1, min(BLOB_BYTES, group_bytes)).repartition(parts, "part")

    def words_of(group: pa.Table) -> pa.Table:
        keys: set[str] = set()
        for blob in group.column("texts"):
            for x in unpack(blob.as_py()):
                keys.update(unit_keys(x.decode()))
        find = regex.compile(pattern).findall
        by_bucket: dict[int, list[bytes]] = {}
        for word in sorted({w for key in keys for w in find(unit_of(key))}):
            raw = word.encode()
            by_bucket.setdefault(xxhash.xxh32_intdigest(raw) % buckets, []).append(raw)
        part = group.column("part")[0].as_py()
        return pa.table({"bucket": pa.array(by_bucket, pa.int64()), "part": pa.array([part] * len(by_bucket), pa.int64()),
                         "words": pa.array(map(pack, by_bucket.values()), pa.binary())})

    used = dealt.groupBy("part").applyInArrow(words_of, "bucket long, part long, words binary").repartition(parts, "bucket")

    def distinct(group: pa.Table) -> pa.Table:
        words = list({w for blob in group.column("words") for w in unpack(blob.as_py())})
        return pa.table({"bucket": pa.array([group.column("bucket")[0].as_py()] * len(words), pa.int64()),
                         "word": pa.array(words, pa.binary()).cast(pa.string())})

    folded = used.groupBy("bucket").applyInArrow(distinct, "bucket long, word string").withColumn("n", word_ids(F.col("word"), v))
    pieces = F.array_join(F.transform("n", lambda i: F.get(v.pieces, i)), "")
    folded = folded.select("bucket", F.unhex(pieces).alias("decoded"), F.array_join("n", " ").alias("ids"))

    def attached(wanted: pa.Table, known: pa.Table) -> pa.Table:
        ids = dict(zip(known.column("decoded").to_pylist(), known.column("ids").cast(pa.binary()).to_pylist(), strict=True))
        out = []
        for blob in wanted.column("words"):
            words = unpack(blob.as_py())
            out.append(pack([*words, *map(ids.__getitem__, words)]))
        return pa.table({"part": wanted.column("part"), "words": pa.array(out, pa.binary())})

    known = used.groupBy("bucket").cogroup(folded.groupBy("bucket")).applyInArrow(attached, "part long, words binary")

    def put_together(group: pa.Table, known: pa.Table) -> pa.Table:
        of_word: dict[str, str] = {}
        for blob in known.column("words"):
            items = [x.decode() for x in unpack(blob.as_py())]
            of_word.update(zip(items[:len(items) // 2], items[len(items) // 2:], strict=True))
        units = UnitTable(pattern, of_word)
        out = []
        for row in range(len(group)):
            ids, decoded = [], []
            for x in unpack(group.column("texts")[row].as_py()):
                of = list(map(units.__getitem__, unit_keys(x.decode())))
                ids.append(" ".join([a for a, _ in of]))
                decoded.append(b"".join([b for _, b in of]))
            out.append(pa.record_batch({
                "doc_id": group.column("ids")[row].values, "ids": pa.array(ids, pa.string()),
                "n_tokens": pa.array([x.count(" ") + 1 if x else 0 for x in ids], pa.int64()), "decoded": pa.array(decoded, pa.binary())}))
        return pa.Table.from_batches(out)

    kind = narrow.schema["doc_id"].dataType.simpleString()
    return dealt.groupBy("part").cogroup(known.groupBy("part")).applyInArrow(
        put_together, f"doc_id {kind}, ids string, n_tokens long, decoded binary")


def ids_array(ids: Column) -> Column:
    return F.transform(F.filter(F.split(ids, " "), lambda x: x != ""), lambda x: x.cast("int"))
