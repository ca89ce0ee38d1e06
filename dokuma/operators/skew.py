"""Joins and ranks that hold when one key has a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have (names compare without case)."""
    have = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in have:
            n = "_" + n
        have.add(n.lower())
        out.append(n)
    return out


def hot_split_join(left: DataFrame, right: DataFrame, on: list[str], weight: str, max_hot: int = 512) -> DataFrame:
    """Inner equi-join of many rows with a table of unique keys. ``weight``: column of ``right``, the number of left
    rows of its key (null: none known). Keys holding at least 1/``max_hot`` of the weight - so at most ``max_hot`` of them - are
    broadcast; all others are joined by shuffle, where no key is large any more. ``weight`` is dropped. Null keys
    match nothing. Keys of ``right`` must be unique."""
    (hot,) = fresh(left, "_hot")
    extra = [c for c in right.columns if c not in {*on, weight}]
    right = right.withColumn(weight, F.coalesce(weight, F.lit(0)))
    total = right.agg(F.sum(weight)).first()[0] or 0
    limit = max(total / max_hot, 1000)
    few = right.filter(F.col(weight) >= limit).limit(max_hot).select(*on, F.lit(True).alias(hot), *extra)
    flagged = left.join(F.broadcast(few), on, "left")
    done = flagged.filter(F.col(hot)).select(*left.columns, *extra)
    rest = flagged.filter(F.col(hot).isNull()).select(*left.columns)
    cold = right.filter(F.col(weight) < limit).select(*on, *extra)
    return done.unionByName(rest.join(cold, on).select(*left.columns, *extra))


def ranked(df: DataFrame, groups: list[str], order: list[Column], rank: str = "rank") -> DataFrame:
    """Exact row number (from 1, long) within ``groups`` by ``order``, without ever holding a group in one task: rows are
    range-partitioned over (groups, order) and written once; ranks are local numbers plus the counts of the
    partitions before. ``order`` must be total, else ties are broken at will. Null group values are a group."""
    part, here, n, before_ = fresh(df, "_part", "_local", "_n", "_before")
    keys = [F.col(c).asc_nulls_first() for c in groups]
    kept = materialize(df.repartitionByRange(*keys, *order).withColumn(part, F.spark_partition_id()), "ranged")
    local = Window.partitionBy(part, *groups).orderBy(*order)
    sizes = kept.groupBy(part, *groups).agg(F.count("*").alias(n))
    before = Window.partitionBy(*groups, F.lit(0)).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # a row per partition of the group
    offsets = sizes.withColumn(before_, F.coalesce(F.sum(n).over(before), F.lit(0))).drop(n)
    same = F.col(f"l.{part}") == F.col(f"r.{part}")
    for c in groups:
        same = same & F.col(f"l.`{c}`").eqNullSafe(F.col(f"r.`{c}`"))
    out = kept.withColumn(here, F.row_number().over(local)).alias("l").join(offsets.alias("r"), same)
    return out.select(*[F.col(f"l.`{c}`") for c in df.columns], (F.col(here) + F.col(before_)).cast("long").alias(rank))


def running_before(df: DataFrame, groups: list[str], order: list[Column], amount: Column, name: str) -> DataFrame:
    """Adds the sum of ``amount`` over the rows before each row of its group in ``order`` (0 for the first), as a double. Like ``ranked``, it is made of local windows over
    range partitions plus the sums of the partitions before."""
    part, value, here, total, before_ = fresh(df, "_part", "_amount", "_local", "_sum", "_before")
    keys = [F.col(c).asc_nulls_first() for c in groups]
    kept = materialize(df.withColumn(value, F.coalesce(amount.cast("double"), F.lit(0.0))).repartitionByRange(*keys, *order).withColumn(part, F.spark_partition_id()), "running")
    local = Window.partitionBy(part, *groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    sums = kept.groupBy(part, *groups).agg(F.sum(value).alias(total))
    before = Window.partitionBy(*groups, F.lit(0)).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # a row per partition of the group
    offsets = sums.withColumn(before_, F.coalesce(F.sum(total).over(before), F.lit(0.0))).drop(total)
    same = F.col(f"l.{part}") == F.col(f"r.{part}")
    for c in groups:
        same = same & F.col(f"l.`{c}`").eqNullSafe(F.col(f"r.`{c}`"))
    out = kept.withColumn(here, F.coalesce(F.sum(value).over(local), F.lit(0.0))).alias("l").join(offsets.alias("r"), same)
    return out.select(*[F.col(f"l.`{c}`") for c in df.columns], (F.col(here) + F.col(before_)).alias(name))
