"""Exact deduplication by Grace hash partitioning.

1. Every task first folds its own rows: an open-addressing table keeps one
   record per distinct text with the largest id and the number of rows, and
   is emptied when it holds ``table_bytes`` of text.  A text with a third of all
   rows thus leaves each task as a handful of records.
2. Buckets are planned by recursion on the digest's leading hex digits:
   starting from the depth at which the whole corpus fits evenly, a bucket
   whose distinct texts exceed ``bucket_bytes`` is split by its next digit, and
   again, until each fits.  Only (digest, size) rows are read for the plan.
3. Records then go to their leaf bucket's spill file in one shuffle (Spark's
   shuffle files are the spill files: written by partition, sorted by bucket,
   made again if an executor is lost).  Each task fills one table per
   bucket, comparing complete texts, and yields one row per distinct text.
4. Documents take their class by a join on the digest; the class side has
   one row per digest, and AQE splits a digest with very many rows.

Two texts of one SHA-256 would be told apart by the table; the job then
stops with an error rather than mix them.

Defined results: null counts as empty; repeated rows count each; ties cannot
occur among different ids, and rows of one id and text share a result.  Null
ids: kept is false unless the whole class has null ids.  An empty table
gives no rows.  Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payscope.llm.common import shuffle_partitions, stored

TABLE_BYTES = 64 << 20
BUCKET_BYTES = 16 << 20
DIGEST_DIGITS = 64


class ContentTable:
    """Open addressing with linear probing over complete contents.

    A slot holds the index of an entry; entries hold (hash, content, largest
    id, rows).  A probe ends at an empty slot or where hash and content equal.
    """

    def __init__(self) -> None:
        self.slots = [-1] * 1024
        self.entries: list[list] = []
        self.bytes = 0

    def add(self, hashed: int, content: str, largest, rows: int) -> None:
        at = self._find(hashed, content)
        if self.slots[at] < 0:
            self.slots[at] = len(self.entries)
            self.entries.append([hashed, content, largest, rows])
            self.bytes += len(content) + 200
            if 2 * len(self.entries) > len(self.slots):
                self._grow()
            return
        entry = self.entries[self.slots[at]]
        if entry[2] is None or largest is not None and largest > entry[2]:
            entry[2] = largest
        entry[3] += rows

    def _find(self, hashed: int, content: str) -> int:
        wrap = len(self.slots) - 1
        at = hashed & wrap
        while (k := self.slots[at]) >= 0 and not (self.entries[k][0] == hashed and self.entries[k][1] == content):
            at = (at + 1) & wrap
        return at

    def _grow(self) -> None:
        self.slots = [-1] * (4 * len(self.slots))
        wrap = len(self.slots) - 1
        for k, entry in enumerate(self.entries):
            at = entry[0] & wrap
            while self.slots[at] >= 0:
                at = (at + 1) & wrap
            self.slots[at] = k


def _rows_of(batch: pd.DataFrame) -> Iterator[tuple]:
    # ids come as text: pandas would turn a column with nulls into floats
    ids = (None if x is None else int(x) for x in batch["largest"])
    return zip(batch["digest"], batch["content"], ids, batch["rows"], strict=True)


RECORD = "digest string, content string, largest long, rows long"


def fold_locally(records: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One record per distinct content of each stretch of a task's rows."""

    def emptied(t: ContentTable, digests: list[str]) -> pd.DataFrame:
        return pd.DataFrame({"digest": digests, "content": [e[1] for e in t.entries],
                             "largest": pd.array([e[2] for e in t.entries], dtype="Int64"), "rows": [e[3] for e in t.entries]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t, digests = ContentTable(), []
        for batch in batches:
            for digest, content, largest, rows in _rows_of(batch):
                t.add(int(digest[:15], 16), content, largest, rows)
                if len(t.entries) > len(digests):
                    digests.append(digest)
                if t.bytes >= table_bytes:
                    yield emptied(t, digests)
                    t, digests = ContentTable(), []
        if digests:
            yield emptied(t, digests)

    return records.withColumn("largest", F.col("largest").cast("string")).mapInPandas(run, RECORD)


def plan_depth(total: int, bucket_bytes: int) -> int:
    """Hex digits at which ``total`` bytes, evenly spread, fit buckets half full."""
    depth = 0
    while depth < DIGEST_DIGITS and total > bucket_bytes // 2 * 16**depth:
        depth += 1
    return depth


def split_buckets(sizes: DataFrame, depth: int, bucket_bytes: int) -> list[DataFrame]:
    """Buckets to split further, by level: element k has the prefixes of
    ``depth + k`` digits whose distinct texts exceed ``bucket_bytes``.

    ``sizes`` has (digest, bytes), one row per distinct text.  The recursion
    ends where a level has no oversize bucket of two or more texts (a single
    text, however long, cannot be split).
    """
    levels: list[DataFrame] = []
    todo = sizes
    while depth + len(levels) < DIGEST_DIGITS:
        prefix = F.substring("digest", 1, depth + len(levels))
        large = stored(todo.groupBy(prefix.alias("prefix")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("texts"))
                       .where((F.col("bytes") > bucket_bytes) & (F.col("texts") > 1)).select("prefix"), "oversize")
        if large.isEmpty():
            break
        levels.append(large)
        todo = todo.join(large, prefix == large["prefix"], "left_semi")
    return levels


def leaf_bucket(records: DataFrame, depth: int, levels: list[DataFrame]) -> DataFrame:
    """``records`` with ``bucket``: the digest's prefix down to its leaf."""
    out = records.withColumn("bucket", F.substring("digest", 1, depth))
    for k, large in enumerate(levels):
        side = large.select(F.col("prefix").alias("_prefix"))
        deeper: Column = F.when(F.col("_prefix").isNotNull(), F.substring("digest", 1, depth + k + 1)).otherwise(F.col("bucket"))
        out = out.join(side, F.col("bucket") == F.col("_prefix"), "left").withColumn("bucket", deeper).drop("_prefix")
    return out


def resolve_buckets(bucketed: DataFrame) -> DataFrame:
    """(digest, content_no, largest, rows) per distinct content.  Tasks hold
    one bucket's table at a time."""

    def emptied(t: ContentTable, digests: list[str]) -> pd.DataFrame:
        seen: dict[str, int] = {}
        numbers = [seen[d] for d in digests if [seen.__setitem__(d, seen.get(d, -1) + 1)]]
        return pd.DataFrame({"digest": digests, "content_no": numbers, "largest": pd.array([e[2] for e in t.entries], dtype="Int64"),
                             "rows": [e[3] for e in t.entries]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t, digests, at = ContentTable(), [], None
        for batch in batches:
            for bucket, (digest, content, largest, rows) in zip(batch["bucket"], _rows_of(batch), strict=True):
                if bucket != at and digests:
                    yield emptied(t, digests)
                    t, digests = ContentTable(), []
                at = bucket
                t.add(int(digest[-15:], 16), content, largest, rows)
                if len(t.entries) > len(digests):
                    digests.append(digest)
        if digests:
            yield emptied(t, digests)

    dealt = bucketed.repartition(shuffle_partitions(bucketed.sparkSession), "bucket").sortWithinPartitions("bucket")
    return dealt.select("bucket", "digest", "content", F.col("largest").cast("string").alias("largest"), "rows").mapInPandas(
        run, "digest string, content_no long, largest long, rows long")


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bucket_bytes: int = BUCKET_BYTES,
            table_bytes: int = TABLE_BYTES) -> DataFrame:
    """(digest, keep_id, group_size) per distinct text of ``docs``."""
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.sha2(content.cast("binary"), 256).alias("digest"), content.alias("content"),
                       F.col(doc_id).cast("long").alias("largest"), F.lit(1).cast("long").alias("rows"))
    sizes = stored(rows.groupBy("digest").agg(F.max(F.octet_length("content")).cast("long").alias("bytes")), "text-sizes")
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    depth = plan_depth(total, bucket_bytes)
    levels = split_buckets(sizes, depth, bucket_bytes)
    found = resolve_buckets(leaf_bucket(fold_locally(rows, table_bytes), depth, levels))
    same = F.when(F.col("content_no") > 0, F.raise_error(F.concat(F.lit("two texts of one SHA-256: "), F.col("digest")))).otherwise(F.col("digest"))
    return found.select(same.alias("digest"), F.col("largest").alias("keep_id"), F.col("rows").alias("group_size"))


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **sizes: int) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    digest = F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)
    members = docs.select(F.col(doc_id).alias("doc_id"), digest.alias("text_sha256"))
    found = classes(docs, doc_id, text, **sizes)
    return (members.join(found, members["text_sha256"] == found["digest"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"))
