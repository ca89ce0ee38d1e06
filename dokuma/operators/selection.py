"""Deterministic selection: round-robin with budgets, first-n in hash order, banded and strided samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .skew import ranked
from .split import hash_order


def interleave(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Adds ``ord``: first rows of all groups, then second rows, and so on; groups by name. Ranks come from range partitions."""
    inner = ranked(df, [group], [F.asc(c) for c in order], "_rn")
    return ranked(inner, [], [F.asc("_rn"), F.asc(group)], "ord").drop("_rn")


def budgeted(df: DataFrame, amount: Column, budget: float, limit: int | None = None, order: str = "ord") -> DataFrame:
    """Rows in ``order`` while the amount before is below ``budget`` (the one that crosses is kept), at most ``limit``. The running sum is made of sums per
    range partition and a window inside each, so no task holds all rows."""
    from ..session import materialize

    parts = materialize(df.withColumn("_a", amount.cast("double")).repartitionByRange(order).withColumn("_p", F.spark_partition_id()), "budget")
    sums = parts.groupBy("_p").agg(F.sum("_a").alias("_s"))
    before = F.coalesce(F.sum("_s").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))  # one row a partition
    offsets = sums.select("_p", before.alias("_before"))
    inner = F.coalesce(F.sum("_a").over(Window.partitionBy("_p").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    out = parts.withColumn("_in", inner).join(F.broadcast(offsets), "_p").filter(F.col("_before") + F.col("_in") < budget)
    if limit is not None:
        out = out.filter(F.col(order) <= limit)
    return out.drop("_a", "_p", "_in", "_before")


def round_robin(sources: DataFrame, cap_sec: float, max_hours: float, max_sources: int | None = None, max_per_channel: int | None = None, max_channels: int | None = None) -> DataFrame:
    """Recordings interleaved over channels by path, within limits on channels, recordings and hours (each counted up to ``cap_sec``)."""
    s = sources
    if max_channels is not None:
        s = s.join(s.select("channel").distinct().orderBy("channel").limit(max_channels), "channel", "left_semi")
    if max_per_channel is not None:
        s = s.withColumn("_rn", F.row_number().over(Window.partitionBy("channel").orderBy("path"))).filter(F.col("_rn") <= max_per_channel).drop("_rn")
    s = interleave(s, "channel", ["path"])
    return budgeted(s, F.least(F.coalesce("duration", F.lit(0.0)), F.lit(cap_sec)) / 3600, max_hours, max_sources)


def first_n(df: DataFrame, group: str, seed: str, n: int, id_col: str = "id") -> DataFrame:
    """The first n rows of each group in seeded hash order."""
    w = Window.partitionBy(group).orderBy(hash_order(seed, F.col(id_col)), id_col)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def banded_sample(df: DataFrame, value: Column, bands: list[tuple[float, float]], group: str, seed: str, n: int, closed: str = "right", id_col: str = "id") -> DataFrame:
    """At most n rows per group and band in hash order. Bands are (lo, hi], or [lo, hi) with closed="left"; rows outside all bands are left out."""
    band = F.lit(None).cast("int")
    for i, (lo, hi) in reversed(list(enumerate(bands))):
        inside = (value > lo) & (value <= hi) if closed == "right" else (value >= lo) & (value < hi)
        band = F.when(inside, F.lit(i)).otherwise(band)
    b = df.withColumn("band", band).filter("band is not null")
    w = Window.partitionBy(group, "band").orderBy(hash_order(seed, F.col(id_col)), id_col)
    return b.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def strided(df: DataFrame, order: list[str], step: int) -> DataFrame:
    """Every ``step``-th row in order, from the first."""
    return ranked(df, [], [F.asc(c) for c in order], "_r").filter((F.col("_r") - 1) % step == 0).drop("_r")


def risk_first(df: DataFrame, risky: Column, seed: str, n: int, id_col: str = "id") -> DataFrame:
    """n rows, risky ones first, each part in hash order."""
    return df.orderBy(F.coalesce(risky, F.lit(False)).desc(), hash_order(seed, F.col(id_col)), id_col).limit(n)


def sample_channels(sources: DataFrame, n_channels: int, per_channel: int, seed: str) -> DataFrame:
    """At most ``per_channel`` recordings of ``n_channels`` channels, both in seeded hash order."""
    chosen = sources.select("channel").filter("channel is not null").distinct().orderBy(hash_order(seed, F.col("channel")), "channel").limit(n_channels)
    return first_n(sources.join(F.broadcast(chosen), "channel", "left_semi"), "channel", seed, per_channel)
