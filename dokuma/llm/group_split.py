"""Problem 5: splits that keep related records together.

Records and the entities they name (source, channel) form a bipartite graph; distributed union-find (``components``) gives each
entity its group. Groups are then dealt largest first, each to the split furthest below its target. For that the driver sees classes of groups of one
size with their numbers, never the groups: sizes of at least 1/``SINGLE`` of the total count exactly, smaller ones to three digits (within 0.1 %), so there
are at most ``SINGLE`` + 9,000 a power of ten classes at any size of data. The groups of a class are interchangeable: each gets its split from its rank in
the class. Groups without weight are dealt by the shares of their number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import channel_names
from ..operators.skew import fresh, hot_split_join, ranked
from ..session import materialize
from .components import components

SINGLE = 10_000


def named(clips: DataFrame) -> DataFrame:
    """Each clip id once: source ("s..."), channel ("c...", by channel name) and duration in milliseconds (null, negative and
    non-finite durations weigh nothing)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), channel_names(b.column(2)), b.column(3)], ["id", "source", "channel", "duration"])

    d = F.col("duration")
    rows = clips.select("id", F.col("source_id").cast("string").alias("source"), "channel", "duration").mapInArrow(run, "id string, source string, channel string, duration double")
    ms = F.when((d > 0) & (d < 1e12), F.round(d * 1000).cast("long")).otherwise(0)
    return rows.filter("id is not null").dropDuplicates(["id"]).select("id", F.concat(F.lit("s"), "source").alias("source"), F.concat(F.lit("c"), "channel").alias("channel"), ms.alias("ms"))


def entity_groups(records: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root) of all entities that occur together with another; null entities join nothing."""
    return components(records.select(left, right).filter(F.col(left).isNotNull() & F.col(right).isNotNull()).distinct(), left, right)


def linked_pairs(roots: DataFrame, prefix: str) -> DataFrame:
    """Pairs (a < b) of entities with ``prefix`` that are in one group."""
    own = roots.filter(F.col("node").startswith(prefix)).select(F.substring("node", len(prefix) + 1, 1 << 30).alias("n"), "root")
    return own.alias("x").join(own.alias("y"), F.expr("x.root = y.root AND x.n < y.n")).select(F.col("x.n").alias("a"), F.col("y.n").alias("b"))


def shared(n: int, shares: dict[str, float]) -> dict[str, int]:
    """``n`` by largest remainders of ``shares``."""
    quota = {k: n * s / sum(shares.values()) for k, s in shares.items()}
    out = {k: math.floor(q) for k, q in quota.items()}
    for k in sorted(shares, key=lambda k: out[k] - quota[k])[: n - sum(out.values())]:
        out[k] += 1
    return out


def deal(classes: list[tuple[float, int]], shares: dict[str, float]) -> list[dict[str, int]]:
    """How many of the groups of each class (size, number) go to each split: largest first, each to the split furthest below its target (of the total; ties: as listed).
    Many groups of one size are poured in at once, down to a common distance from the targets as single ones would reach, and the last few singly."""
    lack = {k: s * sum(w * n for w, n in classes) / sum(shares.values()) for k, s in shares.items()}
    out: list[dict[str, int]] = [{} for _ in classes]
    for i in sorted(range(len(classes)), key=lambda i: -classes[i][0]):
        size, left = classes[i]
        if not size:
            out[i] = shared(left, shares)
            continue
        given = dict.fromkeys(shares, 0)
        if left > 8 * len(shares):
            order = sorted(lack.values(), reverse=True)
            level = max((sum(order[: j + 1]) - left * size) / (j + 1) for j in range(len(order)))  # to which the furthest ones sink
            given = {k: max(0, math.floor((v - level) / size) - 1) for k, v in lack.items()}
        for k, n in given.items():
            lack[k] -= n * size
        for _ in range(left - sum(given.values())):
            best = max(shares, key=lack.__getitem__)
            given[best] += 1
            lack[best] -= size
        out[i] = given
    return out


def assign(records: DataFrame, left: str, right: str, weight: str, shares: dict[str, float]) -> DataFrame:
    """``records`` with ``group_id`` and ``split``. Records that share a value of ``left`` or ``right``, directly or through others, get one split; a
    record with neither is a group of its own. Empty input: empty result."""
    spark = records.sparkSession
    key, = fresh(records, "_entity")
    records = materialize(records, "records")
    roots = materialize(entity_groups(records, left, right), "roots")
    entity = F.coalesce(left, right, F.concat(F.lit("r"), F.col("id")))
    own = records.withColumn(key, entity)
    counts = own.groupBy(key).agg(F.count("*").alias("_n")).join(roots.withColumnRenamed("node", key), key, "left").select(key, F.coalesce("root", key).alias("group_id"), "_n")
    grouped = hot_split_join(own, materialize(counts, "entities"), [key], "_n").drop(key)
    sums = materialize(grouped.groupBy("group_id").agg(F.sum(weight).alias("w"), F.count("*").alias("_n")), "groups")
    total = sums.agg(F.sum("w")).first()[0] or 0
    step = F.pow(F.lit(10.0), F.greatest(F.floor(F.log10("w")) - 2, F.lit(0)))
    size = F.when(F.col("w") * SINGLE >= total, F.col("w").cast("double")).otherwise(F.floor(F.col("w") / step) * step)
    sums = sums.withColumn("size", F.when(F.col("w") > 0, size).otherwise(0.0))
    classes = sums.groupBy("size").agg(F.sum("w").alias("w"), F.count("*").alias("n")).collect()  # see above: few
    found = deal([((r.w or 0) / r.n, r.n) for r in classes], shares)
    rows = []
    for r, given in zip(classes, found):
        upto = 0
        for k, n in given.items():
            if n:
                rows.append((r.size, upto, upto + n, k))
                upto += n
    table = F.broadcast(spark.createDataFrame(rows or [(0.0, 0, 0, "")], "size double, above long, upto long, split string"))
    order = ranked(sums, ["size"], [F.asc("group_id")], "nth").alias("g")
    splits = order.join(table.alias("t"), F.expr("g.size = t.size AND g.nth > t.above AND g.nth <= t.upto")).select("group_id", "split", "_n")
    return hot_split_join(grouped, materialize(splits, "dealt"), ["group_id"], "_n")
