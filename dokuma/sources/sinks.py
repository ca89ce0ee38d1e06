"""Sinks."""

from __future__ import annotations

import json
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_splits(df: DataFrame, path: str, split: str = "split") -> None:
    """One folder a split."""
    df.write.mode("overwrite").partitionBy(split).parquet(path)


def write_manifest(df: DataFrame, path: str, record: dict, metrics: str = "metrics") -> None:
    """JSON lines of the rows, their metrics as columns of their own (null values left out), and the run's record in run.json beside them. The names of the metrics are those that occur:
    few, as stages declare them."""
    names = sorted(r.k for r in df.select(F.explode(F.map_keys(metrics)).alias("k")).distinct().collect())
    flat = df.select(*[c for c in df.columns if c != metrics], *[F.try_element_at(metrics, F.lit(n)).alias(n) for n in names if n not in df.columns])
    flat.write.mode("overwrite").option("ignoreNullFields", "true").json(f"{path}/clips.jsonl")
    df.sparkSession.createDataFrame([(json.dumps(record, ensure_ascii=False, sort_keys=True, default=str),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/run.json")


def shards_for(df: DataFrame, bytes_col: str, duration_col: str, target_bytes: int, sample: int, seed: str, id_col: str = "id") -> int:
    """Shards of about ``target_bytes``, from the bytes a second of ``sample`` rows (in hash order) and the duration of all."""
    from ..operators.split import hash_order

    few = df.filter(F.col(duration_col) > 0).orderBy(hash_order(seed, F.col(id_col)), id_col).limit(sample)
    rate = few.agg(F.try_divide(F.sum(bytes_col), F.sum(duration_col)).alias("r")).first()["r"] or 0.0
    seconds = df.agg(F.sum(duration_col).alias("s")).first()["s"] or 0.0
    return max(1, math.ceil(rate * seconds / target_bytes))


def missing_shards(df: DataFrame, path: str, shards: int, order: list[str], done: set[int]) -> list[int]:
    """Writes the shards not yet in ``done`` as folders shard=k of ``path``, each of a contiguous range in order, and returns their numbers: a driver that lost its run goes on where it was.
    Ranges come from exact ranks, so a shard holds the same rows in every run."""
    from ..operators.skew import ranked

    n = df.count()
    k = F.least(F.floor((F.col("_r") - 1) * shards / F.lit(max(n, 1))), F.lit(shards - 1)).cast("int")
    todo = [i for i in range(shards) if i not in done]
    if todo and n:
        part = ranked(df, [], [F.asc(c) for c in order], "_r").withColumn("shard", k).drop("_r").filter(F.col("shard").isin(todo))
        part.repartition(len(todo), "shard").sortWithinPartitions("shard", *order).write.mode("append").partitionBy("shard").parquet(path)
    return todo


def shard_count(df: DataFrame, bytes_col: str, target_bytes: int) -> int:
    """Shards of about ``target_bytes``: from the column's sum."""
    total = df.agg(F.sum(bytes_col)).first()[0] or 0
    return max(1, math.ceil(total / target_bytes))


def write_shards(df: DataFrame, path: str, shards: int, order: list[str], rows: int | None = None) -> None:
    """Contiguous shards in order, zstd; ``rows`` bounds a file's rows. Rewriting a folder replaces it, so a lost run starts over cleanly."""
    w = df.repartitionByRange(shards, *order).sortWithinPartitions(*order).write.mode("overwrite").option("compression", "zstd")
    (w.option("maxRecordsPerFile", rows) if rows else w).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(path)


def append_missing(new: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` that a resumed run still has to append."""
    return new.join(existing.select(key).distinct(), key, "left_anti")


def valid_notes(notes: DataFrame, verdicts: list[str], tags: list[str]) -> DataFrame:
    """Notes with a known verdict, unknown tags removed."""
    known = F.array(*[F.lit(t) for t in tags])
    return notes.filter(F.col("verdict").isin(verdicts)).withColumn("tags", F.array_intersect(F.coalesce("tags", F.array().cast("array<string>")), known))


def edit_presets(presets: DataFrame, changes: DataFrame) -> DataFrame:
    """Saved filters (name, value): changes replace by name, a null value deletes; sorted by name without case."""
    return presets.join(changes.select("name"), "name", "left_anti").unionByName(changes.filter("value is not null")).orderBy(F.lower("name"), "name")
