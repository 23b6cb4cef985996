"""Filter interaction audit by contraction of contingency tensors.

Five filters are evaluated once per document.  A part's documents are then
counted into the cells of a 2x2x2x2x2 tensor, one axis per filter (0 passes, 1
fails), for all documents, the good ones and the toxic ones.  Whatever a filter
does at a step of any order is a contraction of that tensor: along each axis a
vector selects pass (1, 0), fail (0, 1) or all (1, 1), and one ``einsum`` takes
every step of every order.  Texts are read once, whatever the number of orders.

The four text filters are one Arrow pass.  The duplicate filter joins narrow rows
only: (digest, id) against the least id of each digest, both keys, so a text with a
third of all rows is spread over its ids.  What leaves the last aggregation is at
most 32 rows a part; a task contracts one part at a time.

Defined results: null and empty texts have no words and are equal to each other;
equality is that of SHA-256 digests.  A null source is the part ''.  Repeated rows
count each; those with the smallest id of their text all pass the duplicate filter.  A
null doc_id is neither smaller nor larger than another, so it passes it, and has no
label.  A document is good (toxic) if any of its label rows says so; null labels
say nothing.  An empty table gives no rows.  Texts are read whole.  Only the named columns
are read, so others cannot clash.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payscope.llm.common import stored

FILTERS = "ABCDE"
TEXT_FILTERS = "ABCD"
DUPLICATE = 1 << FILTERS.index("E")

# Fixed values of the filters.
MIN_WORDS = 200
SYMBOLS = b"#$%&*|"
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
# bytes of UTF-8 that go on with a character rather than begin one
CONTINUED = bytes(range(0x80, 0xC0))

COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS)


def text_fails(text: bytes) -> int:
    """One bit per text filter that a text fails."""
    words = text.split()  # bytes split at ASCII blanks exactly
    capitals = len(text) - len(text.translate(None, CAPITALS))
    fails = (len(words) < MIN_WORDS, 100 * len(set(words)) < 50 * len(words),
             100 * capitals > 2 * len(text.translate(None, CONTINUED)), len(text.translate(None, SYMBOLS)) < len(text))
    return sum(failed << k for k, failed in enumerate(fails))


def text_fail_bits(text: Column) -> Column:
    @F.pandas_udf("int")
    def bits(texts: pd.Series) -> pd.Series:
        return pd.Series([text_fails(t or b"") for t in texts], dtype="int32")

    return bits(text.cast("binary"))


def ledger(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(id, part, digest, bits) per document, with the bits of the text filters."""
    content = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(source), F.lit("")).alias("part"),
                       F.unhex(F.sha2(content.cast("binary"), 256)).alias("digest"), text_fail_bits(F.col(text)).alias("bits"))


def with_duplicates(rows: DataFrame) -> DataFrame:
    """(id, part, bits, n): the ledger's rows, equal ones counted, with the bit of
    the duplicate filter."""
    folded = rows.groupBy("digest", "id", "part", "bits").agg(F.count("*").alias("n"))
    first = rows.where(F.col("id").isNotNull()).groupBy(F.col("digest").alias("same")).agg(F.min("id").alias("first"))
    seen = folded.join(first, (F.col("digest") == F.col("same")) & (F.col("id") == F.col("first")), "left")
    repeated = F.col("id").isNotNull() & F.col("first").isNull()
    return seen.select("id", "part", F.when(repeated, F.col("bits") + DUPLICATE).otherwise(F.col("bits")).alias("bits"), "n")


def with_labels(rows: DataFrame, labels: DataFrame, doc_id: str = "doc_id", quality: str = "quality", toxic: str = "toxic") -> DataFrame:
    """``rows`` with ``good`` and ``toxic`` (boolean)."""
    def says(c: str) -> Column:
        return F.max(F.coalesce(F.col(c) == 1, F.lit(False)))

    told = labels.where(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("labelled")).agg(
        says(quality).alias("is_good"), says(toxic).alias("is_toxic"))
    # rows without an id stay out of the join: as one key they would meet in one task
    found = rows.where(F.col("id").isNotNull()).join(told, F.col("id") == F.col("labelled"), "left")
    flags = [F.coalesce(F.col(c), F.lit(False)).alias(a) for c, a in (("is_good", "good"), ("is_toxic", "toxic"))]
    nothing = [F.lit(False).alias(a) for a in ("good", "toxic")]
    return found.select("part", "bits", "n", *flags).union(rows.where(F.col("id").isNull()).select("part", "bits", "n", *nothing))


def cells(rows: DataFrame) -> DataFrame:
    """(part, bits, n, good, toxic): documents of each cell of each part's tensor."""
    return rows.groupBy("part", "bits").agg(F.sum("n").alias("n"), *[
        F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c) for c in ("good", "toxic")])


@lru_cache
def _steps() -> tuple[list[str], list[int], list[str], dict[str, np.ndarray]]:
    """Orders, step numbers, the step's filter, and for each count the vectors that
    select along every axis: an array (steps, axes, 2)."""
    taken, fail, whole = np.array([1, 0]), np.array([0, 1]), np.array([1, 1])
    orders, numbers, own = [], [], []
    select: dict[str, list] = {"kept": [], "removed": [], "failing": [], "unique_fails": []}
    for order in permutations(FILTERS):
        for k, letter in enumerate(order):
            orders.append("".join(order))
            numbers.append(k + 1)
            own.append(letter)
            before, rest = set(order[:k]), set(order[k + 1:])
            select["kept"].append([whole if f in rest else taken for f in FILTERS])
            select["removed"].append([fail if f == letter else taken if f in before else whole for f in FILTERS])
            select["failing"].append([fail if f == letter else whole for f in FILTERS])
            select["unique_fails"].append([fail if f == letter else taken for f in FILTERS])
    return orders, numbers, own, {k: np.array(v, dtype=np.int64) for k, v in select.items()}


def contract(tensor: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """``tensor`` (tables, 2, ..., 2) under the vectors of each step: (steps, tables)."""
    axes = FILTERS.lower()
    return np.einsum(f"t{axes},{','.join('n' + a for a in axes)}->nt", tensor, *[vectors[:, k] for k in range(len(axes))])


def audit_part(bits: np.ndarray, counts: np.ndarray) -> pd.DataFrame:
    """Every step of every order, from a part's cells: ``counts`` (cells, 3) of all,
    good and toxic documents."""
    flat = np.zeros((2 ** len(FILTERS), 3), dtype=np.int64)
    np.add.at(flat, bits, counts)
    # cell number: the first filter is the lowest bit, so the last axis of the reshaped array
    tensor = np.moveaxis(flat.T.reshape(3, *[2] * len(FILTERS)), range(1, 1 + len(FILTERS)), range(len(FILTERS), 0, -1))
    orders, numbers, own, select = _steps()
    got = {name: contract(tensor, vectors) for name, vectors in select.items()}
    removed = got["removed"][:, 0]
    total = pd.Series(removed).groupby(own).sum()
    return pd.DataFrame({
        "filter_order": orders, "step": np.array(numbers, np.int32), "kept": got["kept"][:, 0], "removed": removed,
        "redundant": got["failing"][:, 0] - removed, "unique_fails": got["unique_fails"][:, 0],
        "good_lost": got["removed"][:, 1], "toxic_lost": got["removed"][:, 2], "shapley": total[own].to_numpy()})


def interactions(counted: DataFrame) -> DataFrame:
    """The audit of every part of ``cells``."""
    def run(part: pd.DataFrame) -> pd.DataFrame:
        out = audit_part(part["bits"].to_numpy(np.int64), part[["n", "good", "toxic"]].to_numpy(np.int64))
        out.insert(0, "part", part["part"].iloc[0])
        return out

    return counted.groupBy("part").applyInPandas(run, SCHEMA)


def audit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per part, order of the filters and step."""
    rows = stored(ledger(docs, doc_id, text, source), "filter-ledger")
    return interactions(cells(with_labels(with_duplicates(rows), labels)))
