"""Connected components by alternating stars, as joins and aggregations.

Each round links every node to the smallest node it has seen: the large star
for its larger neighbours, the small star for its smaller ones.  The number of
edges never grows, and rounds grow with the logarithm of a component's
diameter.  Edges are stored in the shared checkpoint folder after each round,
so a lost executor repeats one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payscope.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))


def _distinct(edges: DataFrame) -> DataFrame:
    return edges.where(F.col("a") != F.col("b")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 31)))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long) but the roots:
    root is the smallest node of the component.  Loops and repeated edges do
    no harm; no edges give no rows."""
    now = stored(_distinct(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))), "edges")
    state = _state(now)
    while state[0]:
        after = stored(_distinct(_small_star(_large_star(now))), "edges")
        if (reached := _state(after)) == state:
            break
        now, state = after, reached
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
