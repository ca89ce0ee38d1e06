"""Problem 6: percentiles of very large numeric columns by radix selection.

Doubles become 64-bit integers of the same order. Equal values of a group are counted before the shuffle. Per group the counts of the
first 16-bit digit are summed; the digit that contains each target rank is followed, and only its values are looked at for
the next digit: four passes give the exact value. Stopping after d digits gives a bucket that contains it: ``state`` is
that form, a table (group, bucket, n) whose sums over files, days or partitions are the state of all of them, with a
relative error of at most 2**-(16 d - 12) for normal doubles (2**-20 at two digits).

The percentile p of n values is the ceil(p n)-th smallest (at least the first). Nulls and non-finite numbers are left out; -0.0 is 0.0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.text import channel_names
from ..operators.skew import hot_split_join
from ..session import materialize

DIGIT = 16
SIGN = np.int64(0x7FFFFFFFFFFFFFFF)


def to_order(x: np.ndarray) -> np.ndarray:
    """Doubles to signed 64-bit integers of the same order."""
    b = (np.asarray(x, np.float64) + 0.0).view(np.int64)
    return np.where(b < 0, b ^ SIGN, b)


def from_order(k: np.ndarray) -> np.ndarray:
    k = np.asarray(k, np.int64)
    return np.where(k < 0, k ^ SIGN, k).view(np.float64)


@F.pandas_udf(T.DoubleType())
def value_of(k):  # noqa: ANN001, ANN202
    """The double that an order-preserving integer stands for."""
    import pandas as pd

    return pd.Series(from_order(k.to_numpy()))


def clip_values(clips: DataFrame, by_file: bool = False) -> DataFrame:
    """(channel, metric, v, n), with ``by_file`` (file, channel, metric, v, n): how often each number occurs, over ``duration`` and all finite numbers of whole ``metrics_json`` objects, texts with
    decimal point or comma included; each clip id once; clips without channel take no part. ``clips`` is a scan if its files are asked for; an id that several files hold
    counts in one of them."""
    import json
    import math

    def number(v: object) -> float | None:
        if isinstance(v, str):
            try:
                v = float(v.strip().replace(",", "."))
            except ValueError:
                return None
        return float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) and math.isfinite(v) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            channels = channel_names(b.column(1)).dictionary_encode()
            codes = channels.indices.to_pylist()
            names, of, at, vs = [], {}, [], []
            files = b.column(4).dictionary_encode()
            place: dict[tuple[int, int], int] = {}
            for c, d, m, f in zip(codes, b.column(2).to_pylist(), b.column(3).to_pylist(), files.indices.to_pylist()):
                if c is None:
                    continue
                c = place.setdefault((c, f), len(place))
                try:
                    o = json.loads(m) if m else {}
                except (ValueError, RecursionError):
                    o = {}
                items = list(o.items()) if isinstance(o, dict) else []
                for k, x in [("duration", d), *((k, x) for k, x in items if k != "duration")]:
                    try:
                        v = number(x)
                    except OverflowError:
                        v = None
                    if v is not None:
                        if k not in of:
                            of[k] = len(names)
                            names.append(k)
                        at.append((c << 32) | of[k])
                        vs.append(v)
            if not vs:
                continue
            pair = np.empty(len(vs), [("g", np.int64), ("v", np.int64)])
            pair["g"], pair["v"] = at, to_order(np.array(vs))
            order = np.lexsort((pair["v"], pair["g"]))
            pair = pair[order]
            first = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
            n = np.diff(np.append(first, len(pair)))
            g = pair["g"][first]
            where = np.array(list(place))[g >> 32]
            yield pa.RecordBatch.from_arrays([files.dictionary.take(pa.array(where[:, 1])), channels.dictionary.take(pa.array(where[:, 0])), pa.array(names, pa.string()).take(pa.array(g & 0xFFFFFFFF)), pa.array(pair["v"][first]), pa.array(n)], ["file", "channel", "metric", "v", "n"])

    file = F.input_file_name() if by_file else F.lit("")  # at the scan: behind a shuffle no row knows its file
    once = clips.select("id", "channel", "duration", "metrics_json", file.alias("file")).filter("id is not null").dropDuplicates(["id"])
    return once.mapInArrow(run, "file string, channel string, metric string, v long, n long").groupBy(*["file"] * by_file, "channel", "metric", "v").agg(F.sum("n").alias("n"))


def state(values: DataFrame, groups: list[str], digits: int = 2) -> DataFrame:
    """Mergeable counts by the first ``digits`` digits: (groups, bucket, n)."""
    return values.groupBy(*groups, F.shiftright("v", 64 - DIGIT * digits).alias("bucket")).agg(F.sum("n").alias("n"))


def merge(states: list[DataFrame], groups: list[str]) -> DataFrame:
    """The state of all values that the states hold."""
    out = states[0]
    for s in states[1:]:
        out = out.unionByName(s)
    return out.groupBy(*groups, "bucket").agg(F.sum("n").alias("n"))


def _follow(counts: DataFrame, keys: list[str], targets: DataFrame, digit: str) -> DataFrame:
    """The digit that contains each target rank; the rank becomes one within it. Each window holds the at most 2**16 digits of one prefix."""
    w = Window.partitionBy(*keys).orderBy(digit).rowsBetween(Window.unboundedPreceding, 0)
    run = counts.withColumn("_upto", F.sum("n").over(w)).withColumnRenamed("n", "_in")
    j = targets.join(run, keys)
    return j.filter("rank <= _upto AND rank > _upto - _in").withColumn("rank", F.col("rank") - (F.col("_upto") - F.col("_in"))).drop("_upto")


def _ranks(counts: DataFrame, groups: list[str], ps: list[float]) -> DataFrame:
    """Target rank of each percentile of each group."""
    n = counts.groupBy(*groups).agg(F.sum("n").alias("n_values"))
    p = F.explode(F.array(*[F.lit(float(p)) for p in ps]))
    return n.select(*groups, "n_values", p.alias("p")).withColumn("rank", F.greatest(F.lit(1), F.ceil(F.col("p") * F.col("n_values") - 1e-9)).cast("long"))


def from_state(merged: DataFrame, groups: list[str], ps: list[float], digits: int = 2) -> DataFrame:
    """(groups, p, n_values, low, high): the percentile lies within low <= x <= high, the ends of its bucket. Walks the state digit by digit, like
    ``percentiles`` the values."""
    v = merged.select(*groups, F.shiftleft("bucket", 64 - DIGIT * digits).alias("v"), "n")
    found = select(v, groups, ps, digits)
    rest = (1 << (64 - DIGIT * digits)) - 1
    return found.select(*groups, "p", "n_values", value_of("v").alias("low"), value_of(F.col("v") + F.lit(rest)).alias("high"))


def select(values: DataFrame, groups: list[str], ps: list[float], digits: int = 4) -> DataFrame:
    """(groups, p, n_values, v): the order-preserving integer at each target rank, its digits beyond ``digits`` zero."""
    values = materialize(values, "values")
    prefix = lambda d: F.shiftleft(F.shiftright("v", 64 - DIGIT * d), 64 - DIGIT * d)
    level = materialize(values.groupBy(*groups, prefix(1).alias("next")).agg(F.sum("n").alias("n")), "digit")
    targets = _follow(level, groups, _ranks(level, groups, ps), "next")
    for d in range(2, digits + 1):
        targets = materialize(targets.withColumnRenamed("next", "at"), "targets")
        wanted = targets.groupBy(*groups, "at").agg(F.max("_in").alias("_in"))
        values = hot_split_join(values.withColumn("at", prefix(d - 1)), materialize(wanted, "wanted"), [*groups, "at"], "_in").drop("at")
        level = values.withColumn("at", prefix(d - 1)).groupBy(*groups, "at", prefix(d).alias("next")).agg(F.sum("n").alias("n"))
        targets = _follow(level, [*groups, "at"], targets.drop("_in"), "next").drop("at")
    return targets.select(*groups, "p", "n_values", F.col("next").alias("v"))


def percentiles(values: DataFrame, groups: list[str], ps: list[float]) -> DataFrame:
    """(groups, p, n_values, value): exact percentiles of counted values (groups, v, n). Empty groups have no row."""
    return select(values, groups, ps).select(*groups, "p", "n_values", value_of("v").alias("value"))
