"""Listening: decks drawn over a channel's recordings, readiness of channels, and scoring of blind audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .split import hash_order


def ready_channels(sources: DataFrame, clips: DataFrame) -> DataFrame:
    """Channels whose readable recordings all have clips."""
    missing = sources.filter("error is null AND channel is not null").join(clips.select(F.col("source_id").alias("id")).filter("id is not null").distinct(), "id", "left_anti").select("channel").distinct()
    return sources.filter("error is null AND channel is not null").select("channel").distinct().join(missing, "channel", "left_anti")


def draw_deck(clips: DataFrame, n: int, seed: str) -> DataFrame:
    """n clips a channel, taken in turn from its recordings: each recording's clips and the recordings of each turn in hash order. Both ranks are
    limits below the shuffle, so a recording passes on at most n clips and a channel at most n a recording."""
    inner = Window.partitionBy("channel", "source_id").orderBy(hash_order(seed, F.col("id")), "id")
    few = clips.filter("channel is not null").withColumn("_turn", F.row_number().over(inner)).filter(F.col("_turn") <= n)
    outer = Window.partitionBy("channel").orderBy("_turn", hash_order(seed, F.col("source_id")), "id")
    return few.withColumn("place", F.row_number().over(outer)).filter(F.col("place") <= n).drop("_turn")


def audit(answers: DataFrame, key: DataFrame, judged: Column, arm: str = "arm") -> DataFrame:
    """Blind audit: answers (code, ...) joined with the key (code, clip, arm); per arm the answers and the share for which ``judged`` holds."""
    j = answers.join(key, "code")
    return j.groupBy(arm).agg(F.count("*").alias("n"), F.count_if(F.coalesce(judged, F.lit(False))).alias("hits")).withColumn("share", F.round(F.try_divide(F.col("hits"), F.col("n")), 6))


def blind_key(clips: DataFrame, arm: Column, per_arm: int, seed: str) -> DataFrame:
    """(code, id, arm): the first clips of each arm in hash order under codes that tell nothing."""
    w = Window.partitionBy("arm").orderBy(hash_order(seed, F.col("id")), "id")
    c = clips.select("id", arm.alias("arm")).filter("arm is not null").withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= per_arm)
    return c.select(F.substring(F.sha2(F.concat_ws(":", F.lit(seed), F.lit("code"), "id"), 256), 1, 12).alias("code"), "id", "arm")
