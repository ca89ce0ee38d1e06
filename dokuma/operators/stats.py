"""Rank correlation, error-rate thresholds, quantile variants, bands and outliers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .skew import ranked


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """(n, rho): rank correlation with average ranks, rows with a null left out. Ranks are worked out over distinct values with their counts, whose
    running sums come from range partitions; no task holds a whole column."""
    d = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna()
    for c in ("x", "y"):
        d = d.join(average_ranks(d, c), c)
    return d.agg(F.count("*").alias("n"), F.corr("rank_x", "rank_y").alias("rho"))


def average_ranks(d: DataFrame, c: str) -> DataFrame:
    """(value, rank): average rank of each distinct value of column ``c``."""
    from ..session import materialize

    counts = d.groupBy(c).agg(F.count("*").alias("_n"))
    parts = materialize(counts.repartitionByRange(c).withColumn("_p", F.spark_partition_id()), "ranks")
    sums = parts.groupBy("_p").agg(F.sum("_n").alias("_s"))
    offsets = sums.select("_p", F.coalesce(F.sum("_s").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inner = F.coalesce(F.sum("_n").over(Window.partitionBy("_p").orderBy(c).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return parts.withColumn("_in", inner).join(F.broadcast(offsets), "_p").select(c, (F.col("_before") + F.col("_in") + (F.col("_n") + 1) / 2).alias(f"rank_{c}"))


def eer_threshold(samples: DataFrame, value: str, positive: str) -> DataFrame:
    """(threshold, error): where the share of positives below it and of negatives at or above it differ least (first such). Candidates are the values at three decimals.
    Counts per candidate are summed over a window of the distinct candidates (at most 2001 for cosines), not over the samples."""
    v = F.col(value).cast("double")
    s = samples.select(v.alias("v"), F.round(v, 3).alias("t"), F.col(positive).cast("boolean").alias("p")).dropna()
    totals = s.agg(F.count_if("p").alias("np"), F.count_if(~F.col("p")).alias("nn"))
    # A sample is below candidate t when v < t: it is counted at the first candidate above v.
    step = F.when(s["v"] < s["t"], s["t"]).otherwise(s["t"] + 0.0005)
    marks = s.select(F.col("t").alias("at"), F.lit(1).alias("c"), F.lit(0).alias("p"), F.lit(0).alias("n")).distinct().unionByName(s.select(step.alias("at"), F.lit(0).alias("c"), F.col("p").cast("int").alias("p"), (~F.col("p")).cast("int").alias("n")))
    by = marks.groupBy("at").agg(F.max("c").alias("c"), F.sum("p").alias("p"), F.sum("n").alias("n"))
    w = Window.orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    run = by.select("at", "c", F.sum("p").over(w).alias("below_p"), F.sum("n").over(w).alias("below_n")).filter("c = 1").crossJoin(F.broadcast(totals))  # totals: one row
    rates = run.select("at", (F.col("below_p") / F.col("np")).alias("fn"), (1 - F.col("below_n") / F.col("nn")).alias("fp"))
    best = rates.agg(F.min(F.struct(F.round(F.abs(F.col("fn") - F.col("fp")), 12).alias("d"), F.col("at").alias("threshold"), ((F.col("fn") + F.col("fp")) / 2).alias("error"))).alias("b"))
    return best.select("b.threshold", "b.error")


def threshold_sweep(samples: DataFrame, value: str, positive: str, thresholds: list[float]) -> DataFrame:
    """(threshold, missed, needless, errors): positives below and negatives at or above each stated threshold, in one aggregation."""
    v, p = F.col(value), F.col(positive).cast("boolean")
    aggs = []
    for i, t in enumerate(thresholds):
        aggs += [F.count_if(p & (v < t)).alias(f"m{i}"), F.count_if(~p & (v >= t)).alias(f"n{i}")]
    one = samples.agg(*aggs)
    return one.select(F.explode(F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.col(f"m{i}").alias("missed"), F.col(f"n{i}").alias("needless"), (F.col(f"m{i}") + F.col(f"n{i}")).alias("errors")) for i, t in enumerate(thresholds)])).alias("r")).select("r.*")


def floor_quantiles(df: DataFrame, value: str, ps: list[float], last: bool = False) -> DataFrame:
    """(p, value): the sorted values at index min(floor(p n), n - 1), or floor(p (n - 1)) with ``last``. Ranks come from range partitions."""
    d = df.select(F.col(value).cast("double").alias("v")).dropna()
    r = ranked(d, [], [F.asc("v")], "r")
    n = d.count()
    at = [(float(p), int(p * (n - 1)) if last else min(int(p * n), n - 1)) for p in ps] if n else []
    wanted = df.sparkSession.createDataFrame(at, "p double, r0 long")
    return F.broadcast(wanted).join(r, F.col("r0") + 1 == F.col("r")).select("p", F.col("v").alias("value"))


def linear_percentiles(df: DataFrame, groups: list[str], value: str, ps: dict[str, float], floor: tuple[str, ...] = ()) -> DataFrame:
    """(groups, n and a column of each name in ``ps``): interpolated percentiles; for names in ``floor`` the sorted value at index min(floor(p n), n - 1). Ranks come from range partitions, so neither a group nor the distinct values of one are ever in one
    task; of each group only the two neighbours of a position are looked at. Nulls and NaN are left out."""
    d = df.select(*groups, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    r = ranked(d, groups, [F.asc("_v")], "_r")
    n = d.groupBy(*groups).agg(F.count("*").alias("n"))
    same = F.lit(True)
    for g in groups:
        same = same & F.col(f"r.`{g}`").eqNullSafe(F.col(f"n.`{g}`"))
    j = r.alias("r").join(F.broadcast(n.alias("n")) if not groups else n.alias("n"), same).select("r.*", "n.n")
    out = []
    for name, p in ps.items():
        at = F.least(F.floor(F.col("n") * F.lit(float(p))), F.col("n") - 1).cast("double") if name in floor else (F.col("n") - 1) * F.lit(float(p))
        lo = F.floor(at)
        v = lambda k: F.max(F.when(F.col("_r") == k + 1, F.col("_v")))
        low, high = v(lo), v(F.least(lo + 1, F.col("n") - 1))
        out.append((low + (high - low) * F.max(at - lo)).alias(name))
    return j.groupBy(*groups).agg(F.first("n").alias("n"), *out)


def bands(value: Column, edges: list[float]) -> Column:
    """Label of the band [lo, hi) of a value: "<e0", "e0-e1", ..., ">=en"; null stays null."""
    out = F.when(value < edges[0], F.lit(f"<{edges[0]:g}"))
    for lo, hi in zip(edges, edges[1:]):
        out = out.when((value >= lo) & (value < hi), F.lit(f"{lo:g}-{hi:g}"))
    return out.when(value >= edges[-1], F.lit(f">={edges[-1]:g}"))


def share(n: Column, total: Column, digits: int = 2) -> Column:
    """Percentage; null where the total is zero."""
    return F.round(F.try_divide(100.0 * n, total), digits)
