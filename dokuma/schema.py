"""Typed schemas of the entities, and the published form of a clip."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = T.StructType([T.StructField("source_id", T.IntegerType()), T.StructField("pos", T.IntegerType()), T.StructField("text", T.StringType()), T.StructField("start", T.DoubleType()), T.StructField("end", T.DoubleType()), T.StructField("prob", T.DoubleType())])

METRICS = T.MapType(T.StringType(), T.DoubleType())
FLAGS = T.ArrayType(T.StringType())

# Column, type and whether it is published.
MANIFEST = [
    ("id", "string", True), ("source_id", "int", True), ("channel", "string", True), ("idx", "int", True), ("start_sec", "double", True), ("end_sec", "double", True), ("duration", "double", True),
    ("audio", "string", True), ("source_path", "string", False), ("text_raw", "string", True), ("text", "string", True), ("text_spoken", "string", True), ("flags", "array<string>", True), ("metrics", "map<string,double>", True),
    ("recommended", "boolean", True), ("exclusion_reasons", "array<string>", True), ("policy_version", "string", True), ("duplicate_of", "string", True),
]


def manifest_ddl(published_only: bool = False) -> str:
    return ", ".join(f"`{n}` {t}" for n, t, p in MANIFEST if p or not published_only)


def column_names(published_only: bool = False) -> list[str]:
    return [n for n, _, p in MANIFEST if p or not published_only]


def markdown_table(published_only: bool = False) -> str:
    rows = [f"| {n} | {t} | {'yes' if p else 'no'} |" for n, t, p in MANIFEST if p or not published_only]
    return "\n".join(["| column | type | published |", "| --- | --- | --- |", *rows])


def decode_clips(clips: DataFrame) -> DataFrame:
    """Each clip id once, its JSON columns decoded in the JVM: flags as array, metrics as map of doubles (finite numbers, also as texts with point or comma; what isn't whole JSON is null)."""
    once = clips.filter("id is not null").dropDuplicates(["id"])
    raw = F.from_json("metrics_json", "map<string,string>", {"mode": "PERMISSIVE"})
    metrics = F.map_filter(F.transform_values(raw, lambda k, v: F.replace(v, F.lit(","), F.lit(".")).try_cast("double")), lambda k, v: F.abs(v) < float("inf"))
    return once.withColumn("flags", F.from_json("flags_json", "array<string>")).withColumn("metrics", metrics).drop("flags_json", "metrics_json")


def published(manifest: DataFrame) -> DataFrame:
    """Published rows: private columns dropped, maps and lists as JSON text, the recording as srcNNNNN."""
    out = manifest.drop(*[n for n, _, p in MANIFEST if not p])
    for f in out.schema:
        if isinstance(f.dataType, (T.MapType, T.ArrayType, T.StructType)):
            out = out.withColumn(f.name, F.to_json(f.name))
    return out.withColumn("source", F.when(F.col("source_id").isNotNull(), F.format_string("src%05d", F.col("source_id"))))
