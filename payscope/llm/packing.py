"""Best-fit packing of token pieces by large-item matching.

Pieces (documents, and 2048-token cuts of longer ones) are put into
sequences of ``capacity`` tokens.  Since a length is a whole number up to the
capacity, the packing is decided on the histogram of lengths:

* pieces above a third of the capacity fit at most two to a sequence; from the
  longest down, each is matched with the longest remaining one that fits
  (for such pieces this greedy matching needs the fewest sequences);
* shorter pieces, longest first, go to the sequence with the smallest gap
  that takes them, and open a new one only when none does.

Sequences in the same state form a run, so the plan has at most some tens
of rows per length whatever the number of pieces: the gap of a run at least
halves each time a length is put in, and each length opens or splits a
bounded number of runs.  With 2048 tokens it stays below 10^5 rows; it is made
on the driver from at most 2048 counts and broadcast.

Pieces are numbered within their length in two levels: counts per (length,
salt), running sums of those counts, and a row number within each salt, so that
a length with a third of all pieces is spread over all partitions.  A piece
finds its place by a broadcast join on length and number range.

Defined results: null text is empty and has the end id alone.  Every row is
packed, repeated ones too.  An empty table gives no rows.  Further columns
are dropped.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from payscope.llm.common import shuffle_partitions, stored
from payscope.llm.tokens import TextEncoder


def piece_bounds(n: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids; only the first may be shorter."""
    start, length = 0, n % capacity or min(n, capacity)
    while start < n:
        yield start, length
        start, length = start + length, capacity


def tokenize(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", capacity: int = 2048,
             end_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """Pieces of each document: doc_id, piece, start, length, ids_crc32, and
    ``ids`` (array<int>) with ``keep_ids``."""
    kinds = ["starts array<long>", "lengths array<long>", "crcs array<long>", *["ids array<array<int>>"] * keep_ids]

    @F.pandas_udf(", ".join(kinds))
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encode = TextEncoder(vocabulary).encode_bytes
        end = np.array([end_id], "<u4").tobytes()
        for texts in batches:
            rows = []
            for text in texts:
                ids = memoryview(encode(text) + end)
                bounds = list(piece_bounds(len(ids) // 4, capacity))
                pieces = [ids[4 * start:4 * (start + length)] for start, length in bounds]
                rows.append(([x for x, _ in bounds], [n for _, n in bounds], [zlib.crc32(p) for p in pieces],
                             *[[np.frombuffer(p, "<u4").astype("int32").tolist() for p in pieces]] * keep_ids))
            yield pd.DataFrame(rows, columns=[k.split()[0] for k in kinds])

    whole = docs.select(F.col(doc_id).alias("doc_id"), cut(F.coalesce(F.col(text), F.lit(""))).alias("c"))
    zipped = F.arrays_zip("c.starts", "c.lengths", "c.crcs", *["c.ids"] * keep_ids)
    return whole.select("doc_id", F.posexplode(zipped).alias("piece", "p")).select(
        "doc_id", "piece", F.col("p.starts").alias("start"), F.col("p.lengths").alias("length"), F.col("p.crcs").alias("ids_crc32"),
        *[F.col("p.ids").alias("ids")] * keep_ids)


PLAN_SCHEMA = "length long, first long, last long, per_run long, sequence long, offset long"


def plan(counts: dict[int, int], capacity: int = 2048) -> list[tuple[int, int, int, int, int, int]]:
    """Where the pieces of each length go: rows (length, first, last, per_run,
    sequence, offset).  Piece number i of that length, first <= i < last, has
    sequence + (i - first) // per_run and offset + (i - first) % per_run * length."""
    out: list[tuple[int, int, int, int, int, int]] = []
    left = {s: n for s, n in counts.items() if n}
    used = dict.fromkeys(left, 0)
    sequences = 0
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> runs (first sequence, how many)
    order: list[int] = []  # the gaps that have runs, ascending

    def place(length: int, n: int, per_run: int, sequence: int, offset: int) -> None:
        out.append((length, used[length], used[length] + n, per_run, sequence, offset))
        used[length] += n
        left[length] -= n

    def leave(gap: int, first: int, many: int) -> None:
        if gap and many:
            if gap not in gaps:
                bisect.insort(order, gap)
                gaps[gap] = []
            gaps[gap].append((first, many))

    large = sorted(s for s in left if 3 * s > capacity)
    for a in reversed(large):
        while left[a]:
            k = bisect.bisect_right(large, min(capacity - a, a))
            b = next((large[i] for i in range(k - 1, -1, -1) if left[large[i]] > (large[i] == a)), None)
            many = left[a] if b is None else left[a] // 2 if b == a else min(left[a], left[b])
            if b == a:  # two pieces of this length in each sequence
                place(a, 2 * many, 2, sequences, 0)
            else:
                place(a, many, 1, sequences, 0)
                if b is not None:
                    place(b, many, 1, sequences, a)
            leave(capacity - a - (b or 0), sequences, many)
            sequences += many

    for s in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        while left[s]:
            at = bisect.bisect_left(order, s)
            if at == len(order):
                each = capacity // s
                full, rest = divmod(left[s], each)
                if full:
                    place(s, full * each, each, sequences, 0)
                    leave(capacity - each * s, sequences, full)
                    sequences += full
                if rest:
                    place(s, rest, rest, sequences, 0)
                    leave(capacity - rest * s, sequences, 1)
                    sequences += 1
                continue
            gap = order[at]
            first, many = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap], order[at]
            each = gap // s
            full = min(many, left[s] // each)
            if full:
                place(s, full * each, each, first, capacity - gap)
                leave(gap - each * s, first, full)
            rest = left[s] if full < many else 0  # fewer than `each`: one sequence takes them all
            if rest:
                place(s, rest, rest, first + full, capacity - gap)
                leave(gap - rest * s, first + full, 1)
                full += 1
            leave(gap, first + full, many - full)
    return out


def number_within(pieces: DataFrame, key: str, tie_breaks: Iterable[str], column: str) -> DataFrame:
    """``pieces`` with a number from 0 within ``key``, without bringing a key's
    rows together: salted row numbers plus running sums of the salts' counts.

    ``pieces`` must be a stored table with the even ``_salt`` column."""
    per_salt = pieces.groupBy(key, "_salt").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(key).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_salt.select(key, "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    own = F.row_number().over(Window.partitionBy(key, "_salt").orderBy(*tie_breaks)) - 1
    return (pieces.withColumn("_own", own).join(starts, [key, "_salt"])
            .withColumn(column, F.col("_own") + F.col("_start")).drop("_own", "_start"))


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """``pieces`` (doc_id, piece, start, length, ids_crc32 and more) with
    sequence_id and offset."""
    salts = shuffle_partitions(pieces.sparkSession)
    rows = stored(pieces.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")), "pieces")
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    places = rows.sparkSession.createDataFrame(plan(counts, capacity), PLAN_SCHEMA)
    numbered = number_within(rows, "length", ["doc_id", "piece", "start", "ids_crc32"], "_number")
    p = F.broadcast(places.withColumnRenamed("length", "_length"))
    within = (F.col("length") == F.col("_length")) & (F.col("_number") >= F.col("first")) & (F.col("_number") < F.col("last"))
    step = F.col("_number") - F.col("first")
    return (numbered.join(p, within)
            .withColumn("sequence_id", F.col("sequence") + F.floor(step / F.col("per_run")).cast("long"))
            .withColumn("offset", F.col("offset") + step % F.col("per_run") * F.col("length"))
            .drop("_salt", "_number", "_length", "first", "last", "per_run", "sequence"))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) from packed pieces that carry ``ids``; a sequence has
    at most the capacity, so grouping it is bounded."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
