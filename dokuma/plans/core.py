"""Policy, duplicates, splits and selection over the clip tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import dedupe_key
from ..operators import dedupe, policy, selection, split
from .base import ONCE, clips, key, metric, query, table

POLICY = policy.Policy.of({"version": "1", "rules": [{"metric": "speech_ratio", "min": 0.6}, {"metric": "internal_silence_sec", "max": 1.0}, {"metric": "music_to_speech_db", "max": -6.0, "allow_missing": True}, {"flag_absent": ["duplicate", "oversize", "short", "background_music"]}]})
SEED = "42"

FLAGS = "CASE WHEN flags_json IS NULL OR NOT json_valid(flags_json) THEN [] ELSE json_extract_string(flags_json, '$[*]') END"
REASONS = f"""(SELECT id, channel, duration, list_filter([CASE WHEN sr IS NULL THEN 'eksik_olcum:speech_ratio' WHEN sr < 0.6 THEN 'speech_ratio<0.6' END, CASE WHEN si IS NULL THEN 'eksik_olcum:internal_silence_sec' WHEN si > 1.0 THEN 'internal_silence_sec>1.0' END,
    CASE WHEN mu > -6.0 THEN 'music_to_speech_db>-6.0' END, CASE WHEN len(bad) > 0 THEN 'isaret:' || array_to_string(bad, ',') END], lambda x: x IS NOT NULL) AS r
  FROM (SELECT id, channel, duration, {metric("speech_ratio")} AS sr, {metric("internal_silence_sec")} AS si, {metric("music_to_speech_db")} AS mu, list_sort(list_distinct(list_filter({FLAGS}, lambda x: x IN ('duplicate', 'oversize', 'short', 'background_music')))) AS bad FROM {ONCE}))"""


def annotated(spark: SparkSession, sf: str) -> DataFrame:
    return POLICY.annotate(clips(spark, sf))


@query(f"SELECT id, array_to_string(r, ';') AS reasons, len(r) = 0 AS recommended, '1' AS policy_version FROM {REASONS}")
def policy_annotate(spark: SparkSession, sf: str) -> DataFrame:
    return annotated(spark, sf).select("id", F.array_join("exclusion_reasons", ";").alias("reasons"), "recommended", "policy_version")


@query(f"SELECT reason, count(*) AS n FROM (SELECT unnest(r) AS reason FROM {REASONS}) GROUP BY reason")
def policy_reason_counts(spark: SparkSession, sf: str) -> DataFrame:
    return policy.reason_counts(annotated(spark, sf))


@query(f"SELECT flag, count(*) AS n FROM (SELECT unnest({FLAGS}) AS flag FROM {ONCE}) GROUP BY flag")
def flag_counts(spark: SparkSession, sf: str) -> DataFrame:
    return policy.reason_counts(clips(spark, sf), "flags", "flag")


@query(f"""SELECT channel, CAST(count(*) FILTER (rec) AS BIGINT) AS n_recommended, CAST(count(*) FILTER (rec AND d < 3.0) AS BIGINT) AS n_lost, round(100.0 * count(*) FILTER (rec AND d < 3.0) / nullif(count(*) FILTER (rec), 0), 3) AS lost_pct
    FROM (SELECT r.channel, len(r.r) = 0 AS rec, c.d FROM {REASONS} r JOIN (SELECT id, {metric("dnsmos_ovrl")} AS d FROM {ONCE}) c USING (id)) GROUP BY channel""")
def policy_whatif(spark: SparkSession, sf: str) -> DataFrame:
    return policy.what_if(annotated(spark, sf), "dnsmos_ovrl", 3.0, "channel")


@query(f"""SELECT m AS metric, count(x) AS n, count(DISTINCT x) AS n_distinct, count(DISTINCT x) <= 1 AND count(*) >= 500 AS dead FROM (SELECT 'speech_ratio' AS m, {metric("speech_ratio")} AS x FROM {ONCE} UNION ALL SELECT 'internal_silence_sec', {metric("internal_silence_sec")} FROM {ONCE}
    UNION ALL SELECT 'music_to_speech_db', {metric("music_to_speech_db")} FROM {ONCE}) GROUP BY m""")
def dead_rule_check(spark: SparkSession, sf: str) -> DataFrame:
    return policy.dead_rules(clips(spark, sf), POLICY)


@query(f"SELECT id, {key('text')} AS dedupe_key FROM {ONCE}")
def dedupe_keys(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "clips").filter("id is not null").dropDuplicates(["id"]).select("id", dedupe_key(F.col("text")).alias("dedupe_key"))


IDENTITY = ["duration", "loudness_lufs", "rms_dbfs", "peak_dbfs"]
MARKED = f"""(SELECT id, k, CASE WHEN k <> '' AND duration IS NOT NULL AND l IS NOT NULL AND r IS NOT NULL AND p IS NOT NULL THEN first_value(id) OVER (PARTITION BY k, duration, l, r, p ORDER BY wc DESC NULLS LAST, id) END AS keeper
    FROM (SELECT id, duration, {key("text")} AS k, {metric("loudness_lufs")} AS l, {metric("rms_dbfs")} AS r, {metric("peak_dbfs")} AS p, {metric("word_confidence")} AS wc FROM {ONCE}))"""


def marked(spark: SparkSession, sf: str) -> DataFrame:
    m = lambda k: F.try_element_at(F.col("metrics"), F.lit(k))
    return dedupe.mark_duplicates(clips(spark, sf), dedupe_key(F.col("text")), [F.col("duration"), *[m(k) for k in IDENTITY[1:]]], m("word_confidence"), [F.col("id")])


@query(f"SELECT id, keeper AS duplicate_of FROM {MARKED} WHERE keeper <> id")
def duplicate_mark(spark: SparkSession, sf: str) -> DataFrame:
    return marked(spark, sf).filter("duplicate_of is not null").select("id", "duplicate_of")


@query(f"SELECT count(*) AS duplicates, count(DISTINCT keeper) AS kept_groups FROM {MARKED} WHERE keeper <> id")
def duplicate_summary(spark: SparkSession, sf: str) -> DataFrame:
    return dedupe.summary(marked(spark, sf))


@query(f"""WITH c AS (SELECT channel, duration, {key("text")} AS k FROM {ONCE}) SELECT 'text_channel' AS definition, coalesce(sum(n - 1), 0)::BIGINT AS duplicates, count(*) AS groups FROM (SELECT count(*) AS n FROM c WHERE k IS NOT NULL AND channel IS NOT NULL GROUP BY k, channel HAVING count(*) > 1)
    UNION ALL SELECT 'text_duration', coalesce(sum(n - 1), 0)::BIGINT, count(*) FROM (SELECT count(*) AS n FROM c WHERE k IS NOT NULL AND duration IS NOT NULL GROUP BY k, duration HAVING count(*) > 1)""")
def duplicate_definitions(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "clips").filter("id is not null").dropDuplicates(["id"]).select("channel", "duration", dedupe_key(F.col("text")).alias("k"))
    return dedupe.compare_definitions(c, {"text_channel": ["k", "channel"], "text_duration": ["k", "duration"]})


SPLIT = "(SELECT DISTINCT id, lower(trim(split)) AS split FROM clip_splits WHERE id IS NOT NULL AND split IS NOT NULL)"
SPLIT_CLIPS = f"(SELECT c.id, c.source_id, c.channel, c.duration, c.text, s.split FROM {ONCE} c JOIN {SPLIT} s USING (id))"


def split_clips(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "clip_splits").filter("id is not null AND split is not null").select("id", F.lower(F.trim("split")).alias("split")).distinct()
    return table(spark, sf, "clips").filter("id is not null").dropDuplicates(["id"]).join(s, "id")


@query(f"SELECT id, sha256('{SEED}:' || coalesce(channel || ':', '') || id) AS h FROM {ONCE}")
def split_order_hash(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "clips").filter("id is not null").dropDuplicates(["id"]).select("id", split.hash_order(SEED, F.col("channel"), F.col("id")).alias("h"))


@query()
def split_assign(spark: SparkSession, sf: str) -> DataFrame:
    """Which split takes a recording depends on those before it: no SQL twin, tested against a plain loop."""
    c = table(spark, sf, "clips").filter("id is not null").dropDuplicates(["id"])
    return split.assign_sources(table(spark, sf, "sources").filter("channel is not null"), split.hours_by_source(c), 1.0, 1.0, SEED)


@query(f"SELECT split, id FROM (SELECT *, {key('text')} AS k FROM {SPLIT_CLIPS}) WHERE split IN ('dev', 'test') AND k <> '' AND k IN (SELECT {key('text')} FROM {SPLIT_CLIPS} WHERE split = 'train' AND text IS NOT NULL)")
def text_leakage(spark: SparkSession, sf: str) -> DataFrame:
    return split.text_leakage(split_clips(spark, sf).withColumn("k", dedupe_key(F.col("text"))), "k").select("split", "id")


@query(f"""SELECT id, split FROM (SELECT *, coalesce(sum(duration / 3600) OVER (PARTITION BY split, channel ORDER BY sha256('{SEED}:' || coalesce(channel || ':', '') || id), id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM {SPLIT_CLIPS} WHERE split IN ('dev', 'test')) WHERE b < 0.01""")
def quota_trim(spark: SparkSession, sf: str) -> DataFrame:
    return split.quota_trim(split_clips(spark, sf), {"dev": 0.01, "test": 0.01}, SEED).select("id", "split")


@query(f"SELECT id, channel FROM {ONCE} WHERE id NOT IN (SELECT id FROM {SPLIT} WHERE split IN ('train', 'dev', 'test'))")
def rest_split(spark: SparkSession, sf: str) -> DataFrame:
    return split.rest(table(spark, sf, "clips").filter("id is not null").dropDuplicates(["id"]), split_clips(spark, sf).filter(F.col("split").isin("train", "dev", "test"))).select("id", "channel")


@query(f"SELECT source_id, count(DISTINCT split) AS n_splits FROM {SPLIT_CLIPS} WHERE source_id IS NOT NULL GROUP BY source_id HAVING count(DISTINCT split) > 1")
def source_leakage(spark: SparkSession, sf: str) -> DataFrame:
    return split.source_leakage(split_clips(spark, sf))


@query(f"SELECT DISTINCT k FROM (SELECT {key('text')} AS k FROM {SPLIT_CLIPS} WHERE split = 'dev') JOIN (SELECT DISTINCT {key('text')} AS k FROM {SPLIT_CLIPS} WHERE split = 'test') USING (k) WHERE k <> ''")
def shared_keys_dev_test(spark: SparkSession, sf: str) -> DataFrame:
    return split.shared_keys(split_clips(spark, sf).withColumn("k", dedupe_key(F.col("text"))), "k", "dev", "test")


@query(f"SELECT split, count(*) AS clips, round(sum(duration) / 3600, 3) AS hours, count(DISTINCT source_id) AS sources, count(DISTINCT channel) AS channels FROM {SPLIT_CLIPS} GROUP BY split")
def split_report(spark: SparkSession, sf: str) -> DataFrame:
    return split.report(split_clips(spark, sf))


@query("""WITH s AS (SELECT id, path, channel, duration, row_number() OVER (PARTITION BY channel ORDER BY path) AS rn FROM sources WHERE channel IS NOT NULL), o AS (SELECT *, row_number() OVER (ORDER BY rn, channel) AS ord FROM s)
    SELECT id, ord FROM (SELECT *, coalesce(sum(least(coalesce(duration, 0), 600) / 3600) OVER (ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM o) WHERE b < 3.0""")
def round_robin_sources(spark: SparkSession, sf: str) -> DataFrame:
    """The budget of hours is the feature."""
    return selection.round_robin(table(spark, sf, "sources").filter("channel is not null"), 600.0, 3.0).select("id", "ord")


@query(f"SELECT source_id, id FROM (SELECT source_id, id, row_number() OVER (PARTITION BY source_id ORDER BY sha256('{SEED}:' || id), id) AS r FROM {ONCE} WHERE duration >= 3) WHERE r <= 3")
def first_n_hash(spark: SparkSession, sf: str) -> DataFrame:
    return selection.first_n(table(spark, sf, "clips").filter("id is not null").dropDuplicates(["id"]).filter("duration >= 3"), "source_id", SEED, 3).select("source_id", "id")


@query(f"""SELECT channel, band, id FROM (SELECT channel, band, id, row_number() OVER (PARTITION BY channel, band ORDER BY sha256('{SEED}:' || id), id) AS r FROM (SELECT id, channel, CASE WHEN d > -60 AND d <= -20 THEN 0 WHEN d > -20 AND d <= -10 THEN 1 WHEN d > -10 AND d <= 0 THEN 2 END AS band FROM (SELECT id, channel, {metric("music_to_speech_db")} AS d FROM {ONCE})) WHERE band IS NOT NULL) WHERE r <= 2""")
def banded_sample(spark: SparkSession, sf: str) -> DataFrame:
    c = clips(spark, sf)
    return selection.banded_sample(c, F.try_element_at(F.col("metrics"), F.lit("music_to_speech_db")), [(-60, -20), (-20, -10), (-10, 0)], "channel", SEED, 2).select("channel", "band", "id")


@query(f"SELECT id FROM (SELECT id, row_number() OVER (ORDER BY id) AS r FROM {ONCE}) WHERE (r - 1) % 500 = 0")
def strided_sample(spark: SparkSession, sf: str) -> DataFrame:
    return selection.strided(table(spark, sf, "clips").select("id").filter("id is not null").distinct(), ["id"], 500)


@query(f"""SELECT id, channel, array_to_string(list_sort(list_distinct(CASE WHEN dup IS NOT NULL THEN list_append(f, 'duplicate') ELSE f END)), ',') AS flags, dup AS duplicate_of,
    array_to_string(list_filter([CASE WHEN sr IS NULL THEN 'eksik_olcum:speech_ratio' WHEN sr < 0.6 THEN 'speech_ratio<0.6' END, CASE WHEN si IS NULL THEN 'eksik_olcum:internal_silence_sec' WHEN si > 1.0 THEN 'internal_silence_sec>1.0' END, CASE WHEN mu > -6.0 THEN 'music_to_speech_db>-6.0' END,
      CASE WHEN len(bad) > 0 THEN 'isaret:' || array_to_string(bad, ',') END], lambda x: x IS NOT NULL), ';') AS reasons, path AS source_path
  FROM (SELECT c.id, c.channel, {FLAGS} AS f, CASE WHEN m.keeper <> c.id THEN m.keeper END AS dup, {metric("speech_ratio")} AS sr, {metric("internal_silence_sec")} AS si, {metric("music_to_speech_db")} AS mu, s.path,
      list_sort(list_distinct(list_filter(CASE WHEN m.keeper <> c.id THEN list_append({FLAGS}, 'duplicate') ELSE {FLAGS} END, lambda x: x IN ('duplicate', 'oversize', 'short', 'background_music')))) AS bad
    FROM {ONCE} c LEFT JOIN {MARKED} m ON m.id = c.id LEFT JOIN sources s ON s.id = c.source_id)""")
def manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Export: duplicates marked, policy applied to the marked flags, recordings joined; every clip is kept."""
    sources = table(spark, sf, "sources").select(F.col("id").alias("source_id"), F.col("path").alias("source_path"))
    m = POLICY.annotate(marked(spark, sf)).join(sources, "source_id", "left")
    flags = F.array_join(F.array_sort(F.array_distinct(F.coalesce("flags", F.array().cast("array<string>")))), ",")
    return m.select("id", "channel", flags.alias("flags"), "duplicate_of", F.array_join("exclusion_reasons", ";").alias("reasons"), "source_path")
