"""Session defaults and tables that cut lineage."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
}


def get_session(app: str = "dokuma", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; ``conf`` keys use ``__`` for dots."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in (DEFAULTS | {k.replace("__", "."): v for k, v in conf.items()}).items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. Where it is unset, a local session gets a folder of its own; on several machines that is an error, since
    each would write to its own disk and reads would be incomplete."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder for master {master}")
        found = "file://" + os.path.join(tempfile.gettempdir(), "dokuma-shared")
    return found.rstrip("/")


def materialize(df: DataFrame, what: str = "t") -> DataFrame:
    """Write ``df`` once as Parquet into the shared folder and read it back: lineage is cut, lost executors only
    repeat reads, and later readers prune columns. The files go when the application ends."""
    path = folder(df.sparkSession, what)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def folder(spark: SparkSession, what: str = "t") -> str:
    """A new folder of this application within the shared one."""
    base = f"{shared_dir(spark)}/dokuma-{spark.sparkContext.applicationId}"
    _forget_at_exit(spark, base)
    return f"{base}/{what}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Drop all tables written so far by ``materialize`` in this application; DataFrames that read them end here. For sessions that go on for long."""
    base = f"{shared_dir(spark)}/dokuma-{spark.sparkContext.applicationId}"
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def spread(scan: DataFrame) -> DataFrame:
    """A scan (with at most projections and filters) that would run in fewer tasks than there are cores - a small file - dealt out to all of them. Larger inputs,
    which are split by size, stay as they are and move no data."""
    if not hasattr(scan, "_jdf"):  # a remote session doesn't show its plans
        return scan
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if "Adaptive" in scan._jdf.queryExecution().executedPlan().nodeName():  # not a mere scan: its shuffles would run for the count
        return scan
    return scan.repartition(cores) if scan._jdf.queryExecution().toRdd().getNumPartitions() < cores else scan


_bases: set[str] = set()


def _forget_at_exit(spark: SparkSession, base: str) -> None:
    if base in _bases:
        return
    _bases.add(base)

    def drop() -> None:
        try:
            jvm = spark.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(base)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # noqa: BLE001 - the session may already be gone
            pass

    atexit.register(drop)
