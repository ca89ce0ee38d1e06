"""Scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..schema import WORD


def files(spark: SparkSession, root: str, extensions: tuple[str, ...] = (), exclude: tuple[str, ...] = ()) -> DataFrame:
    """(path, channel, ext, bytes) of all files below ``root``: the channel is the parent folder, the extension in lower case. Contents are never read (the column is pruned)."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", F.col("length").alias("bytes"))
    f = f.withColumn("channel", F.element_at(F.split("path", "/"), -2)).withColumn("ext", F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)))
    if extensions:
        f = f.filter(F.col("ext").isin([x.lower().lstrip(".") for x in extensions]))
    for x in exclude:
        f = f.filter(~F.contains("path", F.lit(x)))
    return f.select("path", "channel", "ext", "bytes")


def word_files(spark: SparkSession, path: str) -> DataFrame:
    """Word rows of JSON-lines files with the name of their file; lines of other shape have nulls."""
    return spark.read.schema(WORD).json(path).withColumn("file", F.element_at(F.split(F.input_file_name(), "/"), -1))


def id_lists(spark: SparkSession, path: str) -> DataFrame:
    """Distinct ids of text files, separated by white space."""
    return spark.read.text(path).select(F.explode(F.split("value", r"\s+")).alias("id")).filter("id <> ''").distinct()


def log_lines(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """Log lines that match a pattern."""
    return spark.read.text(path).filter(F.col("value").rlike(pattern))


def log_tail(spark: SparkSession, path: str, pattern: str, n: int) -> DataFrame:
    """The last ``n`` lines that match a pattern in the last log (by name) of a folder, with their place from the end: a top-n, so no task holds the log."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    last = lines.agg(F.max("file").alias("file"))
    own = lines.join(F.broadcast(last), "file").filter(F.col("value").rlike(pattern)).withColumn("at", F.monotonically_increasing_id())  # one row
    found = own.orderBy(F.desc("block"), F.desc("at")).limit(n)
    return found.withColumn("nth", F.row_number().over(Window.orderBy(F.desc("block"), F.desc("at")))).select("nth", F.col("value").alias("line"))  # n rows


def manifests(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Union by name of Parquet or JSON-lines manifests, missing columns null, each row with its split (the file's stem)."""
    out = None
    for p in paths:
        d = spark.read.parquet(p) if p.endswith(".parquet") else spark.read.json(p)
        d = d.withColumn("split", F.lit(p.rstrip("/").rsplit("/", 1)[-1].split(".")[0]))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out


def stage_results(clips: DataFrame, results: DataFrame, stage: str, values: dict[str, str], key: str = "id", item: str = "item_key", payload: str = "payload_json") -> DataFrame:
    """Clips with the values of one stage out of a two-table store: its result rows' JSON by path. Clips without a result, and values that aren't of the kind, are null."""
    own = results.filter(F.col("stage") == stage)
    for path, kind in values.items():
        own = nested_key(own, payload, path, kind)
    names = [p.rsplit(".", 1)[-1] for p in values]
    return clips.join(own.select(F.col(item).alias(key), *names), key, "left")


def nested_key(df: DataFrame, json_col: str, path: str, kind: T.DataType | str = "string") -> DataFrame:
    """``df`` with one value out of a JSON column."""
    return df.withColumn(path.rsplit(".", 1)[-1], F.get_json_object(json_col, f"$.{path}").try_cast(kind))
