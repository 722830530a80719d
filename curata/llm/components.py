"""Connected components of a table of links, by alternating large-star and small-star steps.

Each step keeps the components and moves links towards the smallest node: large-star hangs the larger neighbours of a
node on the smallest one, small-star hangs a node and its smaller neighbours on it. When a round changes nothing, every
link leads to its component's smallest node. A step is a minimum by node, combined before the shuffle, and a join back;
no neighbourhood is gathered in one row. Rounds are cut off by tables in the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curata.llm.common import written


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a batch as stars: fewer links, the same components."""
    for b in batches:
        above: dict[int, int] = {}

        def find(x: int, above: dict[int, int] = above) -> int:
            root = x
            while (up := above.get(root, root)) != root:
                root = up
            while x != root:
                x, above[x] = above.get(x, x), root
            return root

        for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            x, y = find(x), find(y)
            if x != y:
                above[max(x, y)] = min(x, y)
                above.setdefault(min(x, y), min(x, y))
        nodes = [x for x in above if find(x) != x]
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([find(x) for x in nodes], pa.int64())], names=["a", "b"])


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """node, component (its smallest node) of every node of links (a, b: bigint) that isn't the smallest itself."""
    now = written(links.select("a", "b").where("a <> b").mapInArrow(_forest, "a bigint, b bigint").distinct(), name)
    mark = _mark(now)
    while True:
        # large-star
        both = now.select("a", "b").unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        hung = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # small-star: links lead from the larger node to the smaller
        least = hung.groupBy("a").agg(F.min("b").alias("m"))
        moved = hung.join(least, "a")
        moved = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        now = written(moved, name)
        if (after := _mark(now)) == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        mark = after


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())


class Union:
    """Union-find over 0..n-1; the root of a set is its smallest member."""

    def __init__(self, n: int) -> None:
        self.above = np.arange(n).tolist()

    def find(self, x: int) -> int:
        above = self.above
        root = x
        while above[root] != root:
            root = above[root]
        while above[x] != root:
            above[x], x = root, above[x]
        return root

    def join(self, x: int, y: int) -> int:
        x, y = self.find(x), self.find(y)
        if x > y:
            x, y = y, x
        self.above[y] = x
        return x
