"""Connected components by distributed union-find.

Every task first reduces its edges to local forests; forests are merged level by level over ever fewer tasks, each
level again keeping only forest edges, so what is passed on never exceeds one edge a node. Edges are dealt out evenly, whatever their
ends, so a hub's star is spread like any other edges, and the number of tasks follows from the number of edges: each holds about ``TASK_EDGES`` at a time and starts
a new forest beyond. When a level no longer shrinks what it gets, the rest runs as alternating large-star and small-star rounds on the cluster
(each round written out), which hold for any size. No links ever come to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import hot_split_join
from ..session import materialize

TASK_EDGES = 500_000


def forest(batches: Iterator[pa.RecordBatch], most: int = TASK_EDGES) -> Iterator[pa.RecordBatch]:
    """Union-find over one task's edges; one edge (node, least node of its tree) per node that isn't least. Beyond ``most`` nodes the forest is passed on and a new one begun."""
    parent: dict = {}

    def find(x):  # noqa: ANN001, ANN202
        root = x
        while (p := parent.get(root, root)) != root:
            root = p
        while x != root:
            parent[x], x = root, parent.get(x, x)
        return root

    def edges(schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        pairs = [(x, r) for x in parent if (r := find(x)) != x]
        parent.clear()
        for i in range(0, len(pairs), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, schema.field(0).type) for c in zip(*pairs[i : i + 50_000])], ["a", "b"])

    schema = None
    for b in batches:
        schema = b.schema
        for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            u, v = find(u), find(v)
            if u != v:
                parent[max(u, v)] = min(u, v)
                parent.setdefault(min(u, v), min(u, v))
        if len(parent) > most:
            yield from edges(schema)
    if parent:
        yield from edges(schema)


def stars(edges: DataFrame) -> DataFrame:
    """Alternating large-star and small-star until nothing changes. Edges (a, b) with b < a on return: each node and its root.
    A hot node's neighbours are only aggregated (least) and joined by ``hot_split_join``, never gathered."""
    seen = None
    while True:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = materialize(both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")).select("a", F.least("a", "m").alias("m"), "n"), "least")
        large = hot_split_join(both.filter("b > a"), least, ["a"], "n").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        large = materialize(large, "large")
        own = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = materialize(own.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")), "low")
        small = hot_split_join(own, low, ["a"], "n").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").unionByName(low.select("a", F.col("m").alias("b"))).distinct()
        edges = materialize(small, "small")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == seen:
            return edges
        seen = tuple(now)


def components(edges: DataFrame, a: str, b: str, task_edges: int = TASK_EDGES) -> DataFrame:
    """(node, root): every node of an edge and the least node of its component. Null ends and loops are ignored, repeated edges count
    once, other columns too are ignored; an empty input gives an empty result."""
    e = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a is not null and b is not null and a <> b")
    schema = e.schema
    merged = lambda x: materialize(x.mapInArrow(lambda it: forest(it, task_edges), schema), "forest")
    level = merged(e)
    count = level.count()
    while count > task_edges:
        before, level = count, merged(level.repartition(-(-2 * count // task_edges)))  # dealt out evenly, not by key
        count = level.count()
        if task_edges < count > 0.9 * before:
            level, count = stars(level), 0
    if count:
        level = merged(level.coalesce(1))
    nodes = level.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(level.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


__all__ = ["components", "forest", "stars"]
