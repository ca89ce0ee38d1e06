"""Recording-level train, dev, test and rest splits: assignment, leakage, quota and checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .skew import fresh, running_before


def hash_order(seed: str, *parts: Column) -> Column:
    """Seeded order: the hex SHA-256 of seed and parts, joined by colons."""
    return F.sha2(F.concat_ws(":", F.lit(seed), *[p.cast("string") for p in parts]), 256)


def hours_by_source(clips: DataFrame) -> DataFrame:
    return clips.groupBy("source_id").agg((F.sum("duration") / 3600).alias("hours"))


def assign_sources(sources: DataFrame, hours: DataFrame, dev_hours: float, test_hours: float, seed: str) -> DataFrame:
    """(id, channel, split) of each recording. Each channel has an equal share of the dev and test hours. Its recordings are taken in hash order, each by
    the split whose share is open widest (ties: test), as long as one usable recording stays in train; the last one taken may
    exceed the share. Recordings without hours are train.

    Which split takes the next recording depends on those before it, so the loop is a fold over the channel's recordings in hash order. While a split is
    open, the hours taken before are below both shares plus the longest recording taken; only recordings that meet this are folded, all later ones are train."""
    import pyarrow as pa

    n = sources.select("channel").distinct().count() or 1
    quota = {"test": test_hours / n, "dev": dev_hours / n}
    s = sources.join(hours.withColumnRenamed("source_id", "id"), "id", "left").select("id", "channel", F.coalesce("hours", F.lit(0.0)).alias("hours"))
    order = Window.partitionBy("channel").orderBy("_o", "id")
    usable = s.filter("hours > 0").withColumn("_o", hash_order(seed, F.col("channel"), F.col("id")))
    usable = usable.withColumn("_rn", F.row_number().over(order)).withColumn("_before", F.coalesce(F.sum("hours").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    usable = usable.withColumn("_longest", F.coalesce(F.max("hours").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    counts = s.filter("hours > 0").groupBy("channel").agg(F.count("*").alias("_usable"))
    few = usable.join(counts, "channel").filter((F.col("_rn") < F.col("_usable")) & (F.col("_before") < quota["test"] + quota["dev"] + F.col("_longest")))

    def fold(t: pa.Table) -> pa.Table:
        rows = sorted(t.to_pylist(), key=lambda r: r["_rn"])
        left, out = dict(quota), []
        for r in rows:
            open_ = [k for k in ("test", "dev") if left[k] > 0]
            pick = max(open_, key=lambda k: (left[k], k == "test")) if open_ else "train"
            if open_:
                left[pick] -= r["hours"]
            out.append((r["id"], pick))
        return pa.table({"id": pa.array([o[0] for o in out], t.schema.field("id").type), "split": pa.array([o[1] for o in out], pa.string())})

    kind = dict(s.dtypes)["id"]
    picked = few.select("id", "channel", "hours", "_rn").groupBy("channel").applyInArrow(fold, f"id {kind}, split string")
    return s.join(picked, "id", "left").select("id", "channel", F.coalesce("split", F.lit("train")).alias("split"))


def text_leakage(clips: DataFrame, key: str, split: str = "split") -> DataFrame:
    """Dev and test clips whose non-empty key also stands in train (semi join on distinct keys)."""
    train = clips.filter(F.col(split) == "train").select(key).filter(F.col(key) != "").distinct()
    return clips.filter(F.col(split).isin("dev", "test")).join(train, key, "left_semi")


def quota_trim(clips: DataFrame, quotas: dict[str, float], seed: str) -> DataFrame:
    """Clips of the quota splits that are kept: per split and channel in hash order while the hours before are below the quota. The one that crosses is kept. Null
    durations count as 0."""
    quota = F.lit(None).cast("double")
    for k, v in quotas.items():
        quota = F.when(F.col("split") == k, F.lit(float(v))).otherwise(quota)
    order, before = fresh(clips, "_order", "_hours")
    own = clips.filter(F.col("split").isin(*quotas)).withColumn(order, hash_order(seed, F.col("channel"), F.col("id")))
    run = running_before(own, ["split", "channel"], [F.asc(order), F.asc("id")], F.col("duration") / 3600, before)
    return run.filter(F.col(before) < quota).select(*clips.columns)


def rest(all_: DataFrame, used: DataFrame, key: str = "id") -> DataFrame:
    """Rows in no split."""
    return all_.join(used.select(key).distinct(), key, "left_anti")


def source_leakage(clips: DataFrame) -> DataFrame:
    """Recordings with clips in several splits."""
    return clips.filter("source_id is not null AND split is not null").groupBy("source_id").agg(F.countDistinct("split").alias("n_splits")).filter("n_splits > 1")


def shared_keys(clips: DataFrame, key: str, a: str, b: str) -> DataFrame:
    """Keys that two splits share."""
    of = lambda s: clips.filter((F.col("split") == s) & (F.col(key) != "")).select(key)
    return of(a).intersect(of(b))


def report(clips: DataFrame) -> DataFrame:
    """Clips, hours, recordings and channels of each split."""
    return clips.groupBy("split").agg(F.count("*").alias("clips"), F.round(F.sum("duration") / 3600, 3).alias("hours"), F.countDistinct("source_id").alias("sources"), F.countDistinct("channel").alias("channels"))
