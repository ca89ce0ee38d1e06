"""Measurement stages, notes, presets and other small operators of the store, each against SQL."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import providers, streaming
from ..operators import ledger, segment, vectors
from ..session import folder
from ..sources import audio, sinks
from .base import ONCE, clips, query, table
from .measures import VECTORS
from .store import LATEST, TOP, _version
from .texts import WORDS, timed_words


def _measure(pdf: pd.DataFrame) -> pd.DataFrame:
    if pdf["id"].str.endswith("77").any():
        raise ValueError("unreadable")
    return pd.DataFrame({"id": pdf["id"], "half": pdf["duration"] / 2, "brief": pdf["duration"] < 4})


@query(f"""WITH p AS (SELECT id FROM {ONCE} WHERE id NOT IN (SELECT item_key FROM {LATEST} WHERE kind = 'clip' AND stage = 'clip_qc' AND version = {TOP} AND item_key IS NOT NULL))
    SELECT id, CASE WHEN id IN (SELECT id FROM p) AND NOT ends_with(id, '77') AND NOT isnan(duration) THEN duration / 2 END AS half, coalesce(id IN (SELECT id FROM p) AND NOT ends_with(id, '77') AND duration < 4, false) AS brief, id IN (SELECT id FROM p) AND NOT ends_with(id, '77') AS marked FROM {ONCE}""")
def stage_run(spark: SparkSession, sf: str) -> DataFrame:
    """A stage over the pending clips: its metric and flag are merged, clips on which it raises stay as they were, without a mark."""
    p = providers.Provider("clip_qc", _version(spark, sf), ("duration",), ("half",), ("brief",), _measure)
    c = clips(spark, sf).select("id", "duration", "metrics", F.coalesce("flags", F.array().cast("array<string>")).alias("flags"))
    merged, marks = providers.advance(c, table(spark, sf, "done"), p)
    m = marks.select(F.col("item_key").alias("id"), F.lit(True).alias("marked"))
    half = F.try_element_at(F.col("metrics"), F.lit("half"))
    return merged.join(m, "id", "left").select("id", half.alias("half"), F.array_contains("flags", "brief").alias("brief"), F.coalesce("marked", F.lit(False)).alias("marked"))


@query("SELECT DISTINCT clip_id, ts, verdict, array_to_string(list_sort(list_distinct(list_filter(coalesce(tags, []), lambda x: x IN ('kesik_son', 'gurultu', 'kesik_bas')))), ',') AS tags FROM notes WHERE verdict IN ('temiz', 'kusurlu', 'bozuk')")
def checked_notes(spark: SparkSession, sf: str) -> DataFrame:
    """Notes with a known verdict, without unknown tags."""
    n = sinks.valid_notes(table(spark, sf, "notes"), ["temiz", "kusurlu", "bozuk"], ["kesik_son", "gurultu", "kesik_bas"])
    return n.select("clip_id", "ts", "verdict", F.array_join(F.array_sort("tags"), ",").alias("tags")).distinct()


@query("SELECT channel AS name, CASE WHEN length(channel) % 3 = 0 THEN 'new' ELSE 'old' END AS value FROM (SELECT DISTINCT channel FROM sources WHERE channel IS NOT NULL) WHERE length(channel) % 3 <> 1")
def presets_edited(spark: SparkSession, sf: str) -> DataFrame:
    """A saved filter a channel; some are replaced, some deleted."""
    names = table(spark, sf, "sources").select(F.col("channel").alias("name")).filter("name is not null").distinct()
    n = F.length("name") % 3
    return sinks.edit_presets(names.withColumn("value", F.lit("old")), names.filter(n < 2).withColumn("value", F.when(n == 0, "new")))


@query(f"SELECT id FROM {ONCE} WHERE idx % 3 <> 0 OR idx IS NULL")
def recheck_rest(spark: SparkSession, sf: str) -> DataFrame:
    """What a resumed recheck still has to append: results of every third clip are there already."""
    at = folder(spark, "recheck")
    c = table(spark, sf, "clips").select("id", "idx").filter("id is not null").dropDuplicates(["id"])
    c.filter("idx % 3 = 0").write.json(at)
    return sinks.append_missing(c, spark.read.schema("id string").json(at), "id").select("id")


@query("SELECT id, len(list_filter([1], lambda x: duration * (id % 4) / 3 < 0.95 * least(duration, 3000))) > 0 AS truncated FROM sources WHERE duration IS NOT NULL")
def truncated_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Recordings of which far less was decoded than the container holds, up to the cap; decoded lengths are planted."""
    s = table(spark, sf, "sources").filter("duration is not null").withColumn("decoded", F.col("duration") * (F.col("id") % 4) / 3)
    return audio.truncated(s, "decoded", "duration", 3000.0).select("id", (F.size("source_flags") > 0).alias("truncated"))


@query(f"SELECT source_id, count(*) AS n_words, 0::BIGINT AS holes, 0::BIGINT AS long FROM {WORDS} GROUP BY source_id")
def chunk_cover(spark: SparkSession, sf: str) -> DataFrame:
    """Alignment chunks of each recording: the words they hold, holes or overlaps between them, and chunks of several words that go on beyond the limit."""
    c = segment.chunks(segment.gather_words(timed_words(spark, sf)))
    return c.groupBy("source_id").agg(F.sum(F.col("b") - F.col("a")).alias("n_words"), (F.max("b") - F.sum(F.col("b") - F.col("a")) + F.min("a")).cast("long").alias("holes"), F.count_if((F.col("end") - F.col("start") > 60 + 15 + 1) & (F.col("b") - F.col("a") > 1)).alias("long"))


@query(f"""WITH f AS (SELECT label, u FROM (SELECT label, u, row_number() OVER (PARTITION BY label ORDER BY sha256('5:' || CAST(vec_id AS VARCHAR)), vec_id) AS r, vec_id FROM {VECTORS}) WHERE r <= 12), n AS (SELECT label, count(*) AS n, row_number() OVER () AS x FROM f GROUP BY label), g AS (SELECT *, row_number() OVER () AS k FROM f)
    SELECT n.label, n.n, round(avg(list_dot_product(a.u, b.u)), 6) AS mean, round(min(list_dot_product(a.u, b.u)), 6) AS least FROM n JOIN g a ON a.label = n.label JOIN g b ON b.label = n.label AND a.k < b.k GROUP BY n.label, n.n""")
def pair_extremes(spark: SparkSession, sf: str) -> DataFrame:
    """Mean and least similarity of the first twelve vectors of each label in hash order: the feature."""
    e = table(spark, sf, "embeddings").filter("label is not null")
    return vectors.pair_extremes(e, "label", "embedding", "vec_id", "5").select("label", "n", F.round("mean", 6).alias("mean"), F.round("least", 6).alias("least"))


@query("SELECT user_id, m.t AS ts, m.e AS event_id FROM (SELECT user_id, max({'t': ts, 'e': event_id}) AS m FROM events GROUP BY user_id)")
def last_events(spark: SparkSession, sf: str) -> DataFrame:
    """The last row of each user so far, as the stream has it; ties in time by number."""
    e = table(spark, sf, "events").withColumn("at", F.struct("ts", "event_id"))
    return streaming.latest(e.select("user_id", "ts", "event_id", "at"), "user_id", "at").select("user_id", "ts", "event_id")


@query(f"SELECT id, duration FROM {ONCE} WHERE idx < 2 UNION ALL SELECT id, -1.0 FROM {ONCE} WHERE idx >= 2 AND idx < 4")
def upserted(spark: SparkSession, sf: str) -> DataFrame:
    """Rows replaced and added by key, others removed by key."""
    c = table(spark, sf, "clips").select("id", "duration", "idx").filter("id is not null").dropDuplicates(["id"])
    kept = ledger.remove(c.filter("idx < 3").select("id", "duration"), c.filter("idx >= 4 OR idx is null").select("id"), "id")
    return ledger.upsert(kept, c.filter("idx >= 2 AND idx < 4").select("id", F.lit(-1.0).alias("duration")), "id")
