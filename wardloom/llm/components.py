"""Connected components by distributed union-find."""

from __future__ import annotations

from collections.abc import Hashable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardloom.llm.common import settle


class UnionFind:
    """Sets of comparable ids; the root of a set is its smallest member."""

    def __init__(self) -> None:
        self.parent: dict[Hashable, Hashable] = {}

    def root(self, x):
        parent = self.parent
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while x != top:
            parent[x], x = top, parent.get(x, x)
        return top

    def union(self, a, b) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def _forest(read: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What one task's links amount to: each id with the root of its set in this task."""
    sets, kind = UnionFind(), None
    for batch in read:
        kind = batch.column(0).type
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            sets.union(a, b)
    if kind is not None:
        ids = list(sets.parent)
        for start in range(0, len(ids), 100_000):
            part = ids[start : start + 100_000]
            yield pa.record_batch([pa.array(part, kind), pa.array([sets.root(x) for x in part], kind)], names=["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """id, root of every id with a link to another: the smallest id that links lead to.

    ``links`` has two columns of one comparable type, in any order and number; links of an id with itself don't count.
    Each task first turns its own links into a forest. Then, until nothing changes, every id hands its larger
    neighbours (then its smaller ones) to the smallest of them, until each set is a star around its smallest id. Least
    neighbours are aggregated before they are shuffled, so ids may have any number of links.
    """
    a, b = links.columns
    kind = links.schema[a].dataType.simpleString()
    pairs = links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
    edges = settle(pairs.mapInArrow(_forest, f"a {kind}, b {kind}").filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least"))
        down = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.least("a", "least").alias("b"))
        down = down.unionByName(least.filter("least < a").select("a", F.col("least").alias("b")))
        lowest = down.groupBy("a").agg(F.min("b").alias("least"))
        small = down.join(lowest, "a").filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        handed = settle(small.unionByName(lowest.select("a", F.col("least").alias("b"))).distinct())
        # neither holds an edge twice: of equal number, they are the same if the one holds all of the other
        if handed.count() == edges.count() and handed.join(edges, ["a", "b"], "left_anti").isEmpty():
            found = edges.unionByName(edges.select("b", F.col("b").alias("a")).distinct())
            return found.select(F.col("a").alias("id"), F.col("b").alias("root"))
        edges = handed
