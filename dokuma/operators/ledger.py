"""Completion ledger and merges over immutable tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_marks(done: DataFrame) -> DataFrame:
    """The last mark of each (kind, item_key, stage): an upsert of repeated and late rows. Ties in time: the greater version."""
    best = F.max(F.struct("done_at", "version")).alias("m")
    return done.groupBy("kind", "item_key", "stage").agg(best).select("kind", "item_key", "stage", F.col("m.version").alias("version"), F.col("m.done_at").alias("done_at"))


def is_done(items: DataFrame, key: Column, done: DataFrame, kind: str, stage: str, version: str) -> DataFrame:
    """Items whose latest mark of the stage has exactly this version."""
    return items.join(_marked(done, kind, stage, version), key.cast("string") == F.col("_k"), "left_semi")


def pending(items: DataFrame, key: Column, done: DataFrame, kind: str, stage: str, version: str) -> DataFrame:
    """Items without such a mark: missing or of another version."""
    return items.join(_marked(done, kind, stage, version), key.cast("string") == F.col("_k"), "left_anti")


def _marked(done: DataFrame, kind: str, stage: str, version: str) -> DataFrame:
    own = done.filter((F.col("kind") == kind) & (F.col("stage") == stage))
    return latest_marks(own).filter(F.col("version") == version).select(F.col("item_key").alias("_k"))


def add_new(existing: DataFrame, new: DataFrame, key: str, id_col: str = "id") -> DataFrame:
    """Rows of ``new`` with unseen keys (each once), numbered on from the greatest id: insert-or-ignore. Numbers come from range partitions by key."""
    from .skew import ranked

    top = existing.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("top")).first()["top"]
    fresh = new.join(existing.select(key), key, "left_anti").dropDuplicates([key])
    return ranked(fresh, [], [F.asc(key)], "_r").withColumn(id_col, (F.col("_r") + top).cast("long")).drop("_r")


def update(df: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Rows with the non-null values of ``changes`` (unique by key) in place of their own."""
    cols = [c for c in changes.columns if c != key]
    j = df.alias("x").join(changes.alias("y"), key, "left")
    return j.select(*[F.coalesce(F.col(f"y.{c}"), F.col(f"x.{c}")).alias(c) if c in cols else F.col(key) if c == key else F.col(f"x.{c}") for c in df.columns])


def upsert(df: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``new`` rows replace those of the same key and are added otherwise."""
    return df.join(new.select(key).distinct(), key, "left_anti").unionByName(new)


def remove(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return df.join(keys.select(key).distinct(), key, "left_anti")


def replace_children(children: DataFrame, new: DataFrame, parent: str, done: DataFrame, key: str = "id", kind: str = "clip") -> tuple[DataFrame, DataFrame]:
    """(children, done) after the children of all parents in ``new`` are replaced; marks of the old children go first, so none outlives its child."""
    parents = new.select(parent).distinct()
    old = children.join(parents, parent, "left_semi").select(F.col(key).cast("string").alias("_k"))
    kept = done.filter(F.col("kind") != kind).unionByName(done.filter(F.col("kind") == kind).join(old, F.col("item_key") == F.col("_k"), "left_anti"))
    return children.join(parents, parent, "left_anti").unionByName(new), kept


def merge_owned(df: DataFrame, results: DataFrame, owned_metrics: list[str], owned_flags: list[str], key: str = "id") -> DataFrame:
    """Upsert of a stage's results (key, metrics map, flags array): what the stage owned goes, what it brings is added; flags keep their order without repeats."""
    mine, marks = F.array(*[F.lit(x) for x in owned_metrics]).cast("array<string>"), F.array(*[F.lit(x) for x in owned_flags]).cast("array<string>")
    j = df.alias("x").join(results.select(key, F.col("metrics").alias("_m"), F.col("flags").alias("_f"), F.lit(True).alias("_hit")), key, "left")
    none_m, none_f = F.expr("cast(map() as map<string,double>)"), F.array().cast("array<string>")
    kept = F.map_filter(F.coalesce("x.metrics", none_m), lambda k, v: ~F.array_contains(mine, k))
    fresh = F.coalesce("_m", none_m)
    kept = F.map_filter(kept, lambda k, v: ~F.array_contains(F.map_keys(fresh), k))
    metrics = F.when(F.col("_hit"), F.map_concat(kept, fresh)).otherwise(F.col("x.metrics"))
    flags = F.when(F.col("_hit"), F.array_union(F.array_except(F.coalesce("x.flags", none_f), marks), F.coalesce("_f", none_f))).otherwise(F.col("x.flags"))
    return j.select(*[metrics.alias(c) if c == "metrics" else flags.alias(c) if c == "flags" else F.col(key) if c == key else F.col(f"x.{c}") for c in df.columns])


def unmatched(df: DataFrame, results: DataFrame, key: str = "id") -> DataFrame:
    """Results without a row: the caller's error."""
    return results.join(df.select(key), key, "left_anti")


def migrate(done: DataFrame, clips: DataFrame, stage: str, old: str, new: str, still_valid: Column) -> DataFrame:
    """The ledger with marks (stage, old) of clips that meet ``still_valid`` moved to version ``new``."""
    ok = clips.filter(still_valid).select(F.col("id").cast("string").alias("_k"), F.lit(True).alias("_ok")).distinct()
    j = done.join(ok, F.col("item_key") == F.col("_k"), "left")
    moved = (F.col("kind") == "clip") & (F.col("stage") == stage) & (F.col("version") == old) & F.coalesce(F.col("_ok"), F.lit(False))
    return j.select(*[F.when(moved, F.lit(new)).otherwise(F.col("version")).alias("version") if c == "version" else F.col(c) for c in done.columns])
