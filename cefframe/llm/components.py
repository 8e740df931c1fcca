"""Connected components of an edge table, by union-find in tasks and contraction between them.

Each round runs union-find over the edges of each partition (memory is bounded by the partition),
which leaves one row (node, local root) per node and partition; hubs with many neighbours shrink
there, before anything is shuffled.  A node whose partitions disagree on its root links those roots,
and the next round works on these links only.  Once at most SMALL rows are left, one task finishes.
All rounds' tables are stored in the shared folder.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, stored

SMALL = 20_000


class UnionFind:
    """Disjoint sets whose root is their smallest member."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        top = x
        while (nxt := up.setdefault(top, top)) != top:
            top = nxt
        while up[x] != top:
            up[x], x = top, up[x]
        return top

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def local_forest(batches):
    sets = UnionFind()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            sets.join(a, b)
    nodes = list(sets.up)
    for at in range(0, len(nodes), 50_000):
        some = nodes[at:at + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array([sets.root(x) for x in some], pa.int64())],
                                         ["node", "root"])


def connected_components(edges: DataFrame, run: str) -> DataFrame:
    """(a, b) -> (node, component) for every node of an edge; a component is named by its smallest node."""
    levels, k = [], 0
    edges = edges.select(F.col("a").cast("long"), F.col("b").cast("long"))
    while True:
        forest = stored(map_arrow(edges, local_forest, "node long, root long"), f"{run}/forest{k}")
        if forest.count() <= SMALL:
            # A bounded rest: one task.
            levels.append(stored(map_arrow(forest.repartition(1), local_forest, "node long, root long"), f"{run}/last"))
            break
        level = stored(forest.groupBy("node").agg(F.min("root").alias("root")), f"{run}/level{k}")
        levels.append(level)
        parent = level.select("node", F.col("root").alias("b"))
        edges = forest.join(parent, "node").filter("root <> b").select(F.col("root").alias("a"), "b").distinct()
        k += 1
    found = levels.pop()
    while levels:
        level = levels.pop()
        top = found.select(F.col("node").alias("root"), F.col("root").alias("top"))
        found = stored(level.join(top, "root", "left").select("node", F.coalesce("top", "root").alias("root")),
                       f"{run}/found{len(levels)}")
    return found.withColumnRenamed("root", "component")
