"""Streaming counterparts of the incremental batch operators (an extension)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def sessions(events: DataFrame, ts: str, key: str, gap: str, late: str | None = "10 minutes") -> DataFrame:
    """Sessions of a key: events closer than ``gap``. Works on a batch, or on a stream with the watermark ``late``. Zone-less times are read as UTC."""
    e = events.withColumn(ts, F.col(ts).cast("timestamp"))
    if e.isStreaming and late:
        e = e.withWatermark(ts, late)
    g = e.groupBy(F.session_window(ts, gap).alias("w"), key).agg(F.count("*").alias("n"))
    return g.select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def windows(events: DataFrame, ts: str, key: str, length: str, slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Counts per key and sliding window."""
    e = events.withColumn(ts, F.col(ts).cast("timestamp"))
    if e.isStreaming:
        e = e.withWatermark(ts, late)
    g = e.groupBy(F.window(ts, length, slide) if slide else F.window(ts, length), key).agg(F.count("*").alias("n"))
    return g.select(key, F.col("window.start").alias("start"), F.col("window.end").alias("end"), "n")


def latest(stream: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key so far (update or complete mode)."""
    rest = [c for c in stream.columns if c != key]
    return stream.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("r")).select(key, "r.*")


def run_pending(spark: SparkSession, incoming: str, schema: str, done_path: str, out_path: str, checkpoint: str, key: str, stage, version: str) -> StreamingQuery:  # noqa: ANN001
    """Each new file's rows that the ledger has no mark for go through ``stage`` (a DataFrame function); its output and the marks are written per batch. A batch that is
    run again after a failure replaces its own files, so results are written once. Runs until the files present are taken."""

    def step(batch: DataFrame, n: int) -> None:
        batch = batch.dropDuplicates([key])
        try:
            seen = spark.read.parquet(done_path).filter((F.col("version") == version) & (F.col("_batch") != n)).select(key)
            batch = batch.join(seen, key, "left_anti")
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
        stage(batch).write.mode("overwrite").parquet(f"{out_path}/_batch={n}")
        batch.select(key).withColumn("version", F.lit(version)).write.mode("overwrite").parquet(f"{done_path}/_batch={n}")

    return spark.readStream.schema(schema).parquet(incoming).writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_with_late(spark: SparkSession, incoming: str, schema: str, ts: str, delay: str, on_time: str, late: str, checkpoint: str) -> StreamingQuery:
    """Rows of new files go to the table ``on_time``, or to the side table ``late`` where they are older than the newest row of the batches before, less ``delay``: a window over on-time
    rows may close at that mark, and a sweep over the side table corrects it later. The mark of each batch is written beside it, so a batch that is run again parts its rows alike."""
    marks = f"{late}-marks"

    def step(batch: DataFrame, n: int) -> None:
        try:
            mark = spark.read.parquet(marks).filter(F.col("_batch") < n).agg(F.max("newest")).first()[0]
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            mark = None
        t = F.col(ts).cast("timestamp")
        behind = F.coalesce(t < F.lit(mark).cast("timestamp") - F.expr(f"INTERVAL {delay}"), F.lit(False))
        batch.filter(~behind).write.mode("overwrite").parquet(f"{on_time}/_batch={n}")
        batch.filter(behind).write.mode("overwrite").parquet(f"{late}/_batch={n}")
        batch.agg(F.max(t).alias("newest")).write.mode("overwrite").parquet(f"{marks}/_batch={n}")

    return spark.readStream.schema(schema).parquet(incoming).writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
