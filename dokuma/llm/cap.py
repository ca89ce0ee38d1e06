"""Problem 2: capping records per dominant contributor.

Stratum-aware cap: a contributor's cap is split over its strata (topics, periods) by the largest-remainder method, in proportion to the weight of the strata in the
whole collection (``balanced``: what is kept of a dominant contributor then mirrors all records) or in the contributor; slots that a stratum cannot fill go
to the others in the same way; inside each stratum the best records by quality stay. Only contributors above their cap are touched. Their strata are ranked by range partitioning (``ranked``), so
neither a contributor nor a stratum is ever gathered into one task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import fresh, ranked
from ..session import materialize, spread


def apportion(sizes: list[int], cap: int, weights: list[int] | None = None) -> list[int]:
    """Slots of each stratum: in proportion to ``weights`` (positive; the sizes by default), none beyond its size. Strata whose quota exceeds their size are filled and
    leave the rest to the others, until none does; then quotas are rounded down and the largest remainders get one more, ties to the heavier, then earlier stratum."""
    weights = weights or sizes
    slots, open_ = [0] * len(sizes), list(range(len(sizes)))
    left = min(cap, sum(sizes))
    while full := [i for i in open_ if left * weights[i] > sizes[i] * sum(weights[j] for j in open_)]:
        for i in full:
            slots[i] = sizes[i]
        left -= sum(sizes[i] for i in full)
        open_ = [i for i in open_ if i not in full]
    total = sum(weights[i] for i in open_)
    for i in open_:
        slots[i] = left * weights[i] // total
    rest = left - sum(slots[i] for i in open_)
    for i in sorted(open_, key=lambda i: (-(left * weights[i] % total), -weights[i], i))[:rest]:
        slots[i] += 1
    return slots


def over_cap(records: DataFrame, contributor: str, quality: list[Column], share: float | None = None, cap: int | None = None, stratum: str | None = None, balanced: bool = False) -> DataFrame:
    """Records that go when each contributor keeps at most ``cap`` records, or floor(``share`` of all records that have a contributor).

    ``records`` holds each record once. A null contributor is no contributor and loses nothing. A null stratum is a stratum
    of its own. ``quality``: best first, made total by its last expression. ``balanced``: strata weigh what they weigh among all records with a contributor.
    Empty input: empty result."""
    st, quota, rank = fresh(records, "_stratum", "_slots", "_rank")
    records = materialize(records, "records")  # read twice: for the sizes, and to rank
    has = records.filter(F.col(contributor).isNotNull()).withColumn(st, F.col(stratum).cast("string") if stratum else F.lit(None).cast("string"))
    sizes = has.select(F.col(contributor).alias("owner"), F.col(st).alias("part")).groupBy("owner", "part").agg(F.count("*").alias("size"))
    sizes = materialize(sizes, "strata")
    if cap is None:
        total = sizes.agg(F.sum("size")).first()[0] or 0
        cap = math.floor(Fraction(str(share)) * total)
    heavy = sizes.groupBy("owner").agg(F.sum("size").alias("all")).filter(F.col("all") > cap).select("owner")

    def plan(t: pa.Table) -> pa.Table:
        rows = sorted(t.to_pylist(), key=lambda r: (r["part"] is not None, r["part"] or ""))
        slots = apportion([r["size"] for r in rows], cap, [r["weight"] for r in rows])
        return pa.table({"owner": pa.array([r["owner"] for r in rows], t.schema.field("owner").type), "part": pa.array([r["part"] for r in rows], pa.string()), "slots": pa.array(slots, pa.int64()), "size": pa.array([r["size"] for r in rows], pa.int64())})

    kind = dict(records.dtypes)[contributor]
    weights = sizes.groupBy("part").agg(F.sum("size").alias("weight")) if balanced else None
    sizes = sizes.alias("s").join(weights.alias("w"), F.expr("s.part <=> w.part")).select("s.*", "weight") if balanced else sizes.withColumn("weight", F.col("size"))
    slots = sizes.join(heavy, "owner").groupBy("owner").applyInArrow(plan, f"owner {kind}, part string, slots long, size long")
    cut = materialize(slots.filter("slots < size").drop("size"), "slots")
    # Contributors above a share s are fewer than 1/s, so their strata are few; they are broadcast only while they are.
    few = cut.count() <= 10_000
    s = (F.broadcast(cut) if few else cut).alias("s")
    touched = has.alias("r").join(s, (F.col(f"r.`{contributor}`") == F.col("s.owner")) & F.col(f"r.`{st}`").eqNullSafe(F.col("s.part"))).select("r.*", F.col("s.slots").alias(quota))
    return ranked(touched, [contributor, st], quality, rank).filter(F.col(rank) > F.col(quota)).select(*records.columns)


def metric_of(column: pa.Array, key: str) -> pa.Array:
    """A finite number of each JSON object, or null: texts count with decimal point or comma; JSON that isn't whole has none."""
    import json

    out = []
    for text in column.to_pylist():
        v = None
        try:
            v = json.loads(text).get(key) if text else None
            if isinstance(v, str):
                v = float(v.strip().replace(",", "."))
            v = float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) and math.isfinite(v) else None
        except (ValueError, AttributeError, RecursionError, OverflowError):
            v = None
        out.append(v)
    return pa.array(out, pa.float64())


def scored_clips(clips: DataFrame, key: str = "dnsmos_ovrl") -> DataFrame:
    """Each clip id once, with channel name, score and duration."""
    from ..functions.text import channel_names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), channel_names(b.column(1)), metric_of(b.column(3), key), b.column(2)], ["id", "channel", "score", "duration"])

    once = clips.select("id", "channel", "duration", "metrics_json").filter("id is not null")
    return spread(once).mapInArrow(run, "id string, channel string, score double, duration double").dropDuplicates(["id"])


def quality() -> list[Column]:
    """Best first: score, then duration, nulls last; NaN durations count as null; then the smaller id."""
    d = F.when(~F.isnan("duration"), F.col("duration"))
    return [F.desc_nulls_last("score"), d.desc_nulls_last(), F.asc("id")]


__all__ = ["apportion", "metric_of", "over_cap", "quality", "scored_clips"]
