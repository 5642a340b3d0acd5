"""Connected components of a graph that is only ever held in tables."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import dropped, written

#: Edges that a task takes together to replace them by as few.
LOCAL_EDGES = 1 << 19


class Forest:
    """Union-find whose roots are the least members."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up, top = self.up, x
        while (y := up.setdefault(top, top)) != top:
            top = y
        while up[x] != top:
            up[x], x = top, up[x]
        return top

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def thinned(batches):
    """Edges (a, b) of spanning trees in place of the given ones: as many as nodes, and the same components."""
    forest = Forest()

    def trees():
        pairs = [(x, r) for x in list(forest.up) if (r := forest.root(x)) != x]
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["a", "b"])

    for batch in batches:
        for a, b in zip(batch["a"].to_pylist(), batch["b"].to_pylist()):
            forest.join(a, b)
        if len(forest.up) >= LOCAL_EDGES:
            yield trees()
            forest = Forest()
    if forest.up:
        yield trees()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node that has an edge (a, b); label is the least node of its component.

    Each round hooks a root to its least neighbour, follows the hooks to their ends, and keeps the
    edges between different roots. Tasks first replace edges by spanning trees, so a node with very
    many edges keeps few. All state is in written tables; the driver sees counts only.
    """
    edges = written(edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a <> b").mapInArrow(thinned, "a long, b long"), "edges")
    ends = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")
    labels = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("label", F.col("node"))
    while not edges.isEmpty():
        hooks = edges.select(ends).groupBy(F.col("e.a").alias("node")).agg(F.min("e.b").alias("up"))
        hooks = written(hooks.select("node", F.least("node", "up").alias("up")), "hooks")
        while True:
            above = hooks.select(F.col("node").alias("up"), F.col("up").alias("top"))
            jumped = written(hooks.join(above, "up").select("node", F.col("top").alias("up"), (F.col("top") != F.col("up")).alias("moved")), "hooks")
            dropped(hooks)
            hooks = jumped
            if jumped.where("moved").isEmpty():
                break
        by_label = hooks.select(F.col("node").alias("label"), "up")
        labels = written(labels.join(by_label, "label", "left").select("node", F.coalesce("up", "label").alias("label")), "labels")
        a, b = (hooks.select(F.col("node").alias(c), F.col("up").alias(f"{c}_up")) for c in "ab")
        rest = edges.join(a, "a").join(b, "b").where("a_up <> b_up").select(F.col("a_up").alias("a"), F.col("b_up").alias("b"))
        fewer = written(rest.distinct().mapInArrow(thinned, "a long, b long"), "edges")
        dropped(edges, hooks)
        edges = fewer
    return labels
