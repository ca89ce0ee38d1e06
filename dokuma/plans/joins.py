"""Joins and group figures over planted measurements: speakers, alignments, error rates, similarities; selections with seeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import browse, policy, report, segment, selection, vectors
from .base import ONCE, clips, key, query, table
from .core import FLAGS, REASONS, annotated
from .measures import VECTORS
from .texts import CL, ONE_BYTE, WORDS, timed_words


@query(f"SELECT c.id, c.source_id % 10 AS speaker_cluster, CASE WHEN s.id % 4 > 0 THEN (s.id % 4) / 4.0::DOUBLE END AS speaker_consistency FROM {ONCE} c LEFT JOIN sources s ON s.id = c.source_id")
def clip_speakers(spark: SparkSession, sf: str) -> DataFrame:
    """Clusters and consistencies are planted by the recording's number."""
    c = table(spark, sf, "clips").filter("id is not null").dropDuplicates(["id"]).select("id", "source_id")
    clusters = c.select("source_id").filter("source_id is not null").distinct().withColumn("cluster", F.col("source_id") % 10)
    s = table(spark, sf, "sources").select("id", F.when(F.col("id") % 4 > 0, F.format_string('{"speaker_consistency": %.2f}', F.col("id") % 4 / F.lit(4.0))).otherwise("{}").alias("meta_json"))
    return report.with_speakers(c, clusters, s).select("id", "speaker_cluster", "speaker_consistency")


ALIGNED = f"""(SELECT *, CASE WHEN pos % 5 > 0 THEN (pos % 10) / 10.0::DOUBLE END AS score FROM {WORDS})"""


@query(f"WITH n AS (SELECT source_id, max(pos) AS n FROM {WORDS} GROUP BY 1) SELECT source_id, CAST(k AS INTEGER) AS span, count(*) AS n, round(min(score), 4) AS least, round(avg(score), 4) AS mean, count(*) FILTER (score IS NULL) AS n_missing FROM (SELECT *, pos // 20 AS k FROM {ALIGNED} WHERE source_id % 9 <> 0) GROUP BY 1, 2")
def aligned_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Word and alignment files zipped by place; scores of each twenty words. Every ninth alignment lacks its last word and is left out."""
    return segment.span_scores(_zipped(spark, sf)[0].withColumn("span", F.floor(F.col("pos") / 20).cast("int")), "align_score", "source_id", "span")


@query(f"SELECT source_id, count(*) AS n_words, count(*) - 1 AS n_aligned FROM {WORDS} WHERE source_id % 9 = 0 GROUP BY 1")
def unequal_alignments(spark: SparkSession, sf: str) -> DataFrame:
    return _zipped(spark, sf)[1]


def _zipped(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    w = timed_words(spark, sf)
    last = w.groupBy("source_id").agg(F.max("pos").alias("last"))
    a = w.join(last, "source_id").filter("source_id % 9 <> 0 OR pos < last").select("source_id", "pos", F.col("start").alias("align_start"), F.col("end").alias("align_end"), F.when(F.col("pos") % 5 > 0, F.col("pos") % 10 / F.lit(10.0)).alias("align_score"))
    return segment.zip_aligned(w, a)


TWO = ["speech_ratio", "internal_silence_sec"]


@query(f"SELECT id FROM {REASONS} WHERE len(r) > 0 AND len(list_filter(r, lambda x: NOT (starts_with(replace(x, 'eksik_olcum:', ''), 'speech_ratio') OR starts_with(replace(x, 'eksik_olcum:', ''), 'internal_silence_sec')))) = 0")
def excluded_by_two_rules(spark: SparkSession, sf: str) -> DataFrame:
    return policy.only_reasons(annotated(spark, sf), TWO).select("id")


LOW = rf"""coalesce(regexp_matches(f, '\p{{L}}') AND f = lower(translate(f, 'IİÇĞÖŞÜ', 'ıiçğöşü')) AND f <> upper(translate(f, 'ıiçğöşü', 'IİÇĞÖŞÜ')), false)"""


@query(rf"""WITH c AS (SELECT {FLAGS} AS fl, text, regexp_extract(text, '([\p{{L}}\p{{Nd}}])', 1) AS f FROM {ONCE}), b AS (SELECT unnest(CASE WHEN len(fl) > 0 THEN list_distinct(fl) ELSE [''] END) AS flag, {LOW} AS low, NOT coalesce(regexp_matches(regexp_replace(text, '{CL}+$', ''), '[.!?…]$'), false) AS open FROM c)
    SELECT flag, count(*) AS n, count(*) FILTER (low) AS lower_start, count(*) FILTER (open) AS no_end, count(*) FILTER (low AND open) AS both FROM b GROUP BY flag""".replace("\\\\", "\\"))
def broken_by_flag(spark: SparkSession, sf: str) -> DataFrame:
    return report.broken_by_flag(clips(spark, sf).withColumn("flags", F.coalesce("flags", F.array().cast("array<string>"))))


@query(rf"""WITH c AS (SELECT duration, idx, text, {FLAGS} AS fl, regexp_extract(text, '([\p{{L}}\p{{Nd}}])', 1) AS f FROM {ONCE}), b AS (SELECT duration, len(fl) = 0 AS bare, coalesce(text, '') <> '' AND {LOW} AS low, coalesce(text, '') <> '' AND NOT coalesce(regexp_matches(regexp_replace(text, '{CL}+$', ''), '[.!?…]$'), false) AS open, CASE WHEN idx % 4 > 0 THEN idx % 10 / 10.0::DOUBLE END AS m FROM c),
    q AS (SELECT list_sort(list(duration)) AS d FROM b WHERE duration IS NOT NULL)
    SELECT count(*) AS n, round(sum(duration) / 3600, 3) AS hours, count(*) FILTER (low) AS lower_start, count(*) FILTER (open) AS no_end, count(*) FILTER (low AND bare) AS lower_start_unflagged, count(*) FILTER (open AND bare) AS no_end_unflagged, count(*) FILTER (low AND open) AS both, count(*) FILTER (duration >= 14.95) AS at_cap,
      round(100.0 * count(*) FILTER (low) / count(*), 2) AS lower_start_pct, round(100.0 * count(*) FILTER (open) / count(*), 2) AS no_end_pct, round(100.0 * count(*) FILTER (low AND bare) / count(*), 2) AS lower_start_unflagged_pct, round(100.0 * count(*) FILTER (open AND bare) / count(*), 2) AS no_end_unflagged_pct, round(100.0 * count(*) FILTER (duration >= 14.95) / count(*), 2) AS at_cap_pct,
      round(quantile_cont(duration, 0.5), 2) AS median, (SELECT round(d[CAST(floor(0.05 * len(d)) AS INTEGER) + 1], 2) FROM q) AS p05, (SELECT round(d[CAST(floor(0.95 * len(d)) AS INTEGER) + 1], 2) FROM q) AS p95, round(avg(m), 4) AS align_mean, round(avg(m / 2), 4) AS align_least FROM b""".replace("\\\\", "\\"))
def arm_figures(spark: SparkSession, sf: str) -> DataFrame:
    """The clips as one arm of a comparison of segmentations; alignment scores are planted."""
    c = clips(spark, sf).withColumn("flags", F.coalesce("flags", F.array().cast("array<string>"))).withColumn("m", F.when(F.col("idx") % 4 > 0, F.col("idx") % 10 / F.lit(10.0)))
    return segment.arm_stats(c.withColumn("l", F.col("m") / 2), scores=("m", "l"))


@query(rf"""WITH e AS (SELECT id, levenshtein({ONE_BYTE('text')}, {ONE_BYTE('text_spoken')}) / length({key('text')}) AS cer FROM {ONCE} WHERE length({key('text')}) > 0), j AS (SELECT len(r) = 0 AS recommended, cer FROM e JOIN {REASONS} USING (id) WHERE cer IS NOT NULL)
    SELECT recommended, count(*) AS n, round(avg(cer), 6) AS mean, round(quantile_cont(cer, 0.5), 6) AS median, round(quantile_cont(cer, 0.9), 6) AS p90, round(100 * avg((cer > 0.1)::INT), 3) AS above_pct FROM j GROUP BY recommended""")
def cer_by_eligibility(spark: SparkSession, sf: str) -> DataFrame:
    return report.error_rates(annotated(spark, sf).select("recommended", text.cer(F.col("text"), F.col("text_spoken")).alias("cer")), "recommended", "cer")


@query(f"""WITH n AS (SELECT label, unnest(u) AS x, generate_subscripts(u, 1) AS i FROM {VECTORS}), s AS (SELECT label, i, sum(x) AS x FROM n GROUP BY 1, 2), c AS (SELECT label, list(x ORDER BY i) AS v, sqrt(sum(x * x)) AS l FROM s GROUP BY label),
    p AS (SELECT CASE WHEN a.label % 3 = b.label % 3 THEN 'same_channel' ELSE 'cross_channel' END AS kind, list_dot_product(a.v, b.v) / (a.l * b.l) AS x FROM c a JOIN c b ON a.label < b.label)
    SELECT kind, count(*) AS n, round(avg(x), 6) AS mean, round(quantile_cont(x, 0.05), 6) AS p05, round(quantile_cont(x, 0.95), 6) AS p95 FROM p GROUP BY kind""")
def similarity_kinds(spark: SparkSession, sf: str) -> DataFrame:
    """Labels taken as recordings, every third of one channel."""
    c = vectors.centroids(table(spark, sf, "embeddings").filter("label is not null"), "label", "embedding")
    channels = c.select(F.col("label").alias("group"), (F.col("label") % 3).alias("channel"))
    g = vectors.similarity_groups(vectors.center_pairs(c, "label"), channels, {"p05": 0.05, "p95": 0.95})
    return g.select("kind", "n", *[F.round(x, 6).alias(x) for x in ("mean", "p05", "p95")])


@query(f"SELECT id FROM {ONCE} ORDER BY coalesce(duration < 2, false) DESC, sha256('7:' || id), id LIMIT 200")
def risk_first(spark: SparkSession, sf: str) -> DataFrame:
    """Two hundred clips, short ones first: the size of the sample is the feature."""
    return selection.risk_first(table(spark, sf, "clips").filter("id is not null").dropDuplicates(["id"]), F.col("duration") < 2, "7", 200).select("id")


@query(f"SELECT id FROM {ONCE} WHERE duration > 5 ORDER BY sha256('9:' || id), id LIMIT 50")
def seeded_sample(spark: SparkSession, sf: str) -> DataFrame:
    """Fifty clips of a pool: the size of the sample is the feature."""
    return browse.seeded_sample(table(spark, sf, "clips").filter("id is not null AND duration > 5").dropDuplicates(["id"]), 50, "9").select("id")


@query("SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY channel ORDER BY sha256('3:' || CAST(id AS VARCHAR)), id) AS r FROM sources WHERE channel IN (SELECT channel FROM (SELECT DISTINCT channel FROM sources WHERE channel IS NOT NULL) ORDER BY sha256('3:' || channel), channel LIMIT 5)) WHERE r <= 2")
def channel_sample(spark: SparkSession, sf: str) -> DataFrame:
    """Two recordings of five channels: the feature."""
    return selection.sample_channels(table(spark, sf, "sources"), 5, 2, "3").select("id")


@query(rf"""WITH c AS (SELECT id, text, {LOW} AS low, NOT coalesce(regexp_matches(regexp_replace(text, '{CL}+$', ''), '[.!?…]$'), false) AS open FROM (SELECT id, text, regexp_extract(text, '([\p{{L}}\p{{Nd}}])', 1) AS f FROM {ONCE} WHERE text IS NOT NULL))
    SELECT id, CASE WHEN low AND open THEN 'iki' WHEN low THEN 'bas' ELSE 'son' END AS cut, text FROM c WHERE low OR open""")
def broken_clips(spark: SparkSession, sf: str) -> DataFrame:
    """Clips that begin or end within a sentence, with the kind of cut, written as JSON lines and read again."""
    from ..session import folder

    at = folder(spark, "broken")
    c = table(spark, sf, "clips").filter("id is not null AND text is not null").dropDuplicates(["id"])
    report.broken_clips(c).write.json(at)
    return spark.read.schema("id string, cut string, text string").json(at)


@query(f"SELECT id, channel, floor(r * 1000) AS rate FROM (SELECT id, channel, r, quantile_cont(r, 0.5) OVER (PARTITION BY channel) AS m FROM (SELECT id, channel, duration / len(string_split_regex(trim(text), '\\s+')) AS r FROM {ONCE} WHERE duration > 0 AND trim(text) <> '' AND channel IS NOT NULL)) WHERE r > 2 * m OR r < 0.5 * m".replace("\\\\", "\\"))
def odd_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Clips read more than twice as fast or as slowly as their channel's median."""
    c = table(spark, sf, "clips").filter("id is not null").dropDuplicates(["id"]).filter("duration > 0 AND trim(text) <> '' AND channel is not null")
    rate = F.col("duration") / F.size(F.split(F.trim("text"), r"\s+"))
    return report.odd_values(c.select("id", "channel", rate.alias("rate")), "channel", "rate", 2.0).select("id", "channel", F.floor(F.col("rate") * 1000).cast("double").alias("rate"))


@query("""SELECT id, CASE WHEN bytes < 1000 THEN format('{} B', bytes) WHEN bytes < 1e6 THEN printf('%.1f kB', round(bytes / 1e3, 1)) WHEN bytes < 1e9 THEN printf('%.1f MB', round(bytes / 1e6, 1)) ELSE printf('%.1f GB', round(bytes / 1e9, 1)) END AS size, printf('%d:%02d:%02d', s // 3600, s // 60 % 60, s % 60) AS length
    FROM (SELECT id, bytes, CAST(round(duration) AS BIGINT) AS s FROM sources WHERE bytes IS NOT NULL AND duration IS NOT NULL)""")
def readable(spark: SparkSession, sf: str) -> DataFrame:
    """Sizes and lengths of recordings for people."""
    s = table(spark, sf, "sources").filter("bytes is not null AND duration is not null")
    return s.select("id", report.human_size(F.col("bytes")).alias("size"), report.clock(F.col("duration")).alias("length"))


@query(f"SELECT id FROM {ONCE} WHERE contains(' ' || {key('text')} || ' ', ' eski ')")
def phrase_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Texts that hold a phrase as whole words, by comparison keys."""
    c = table(spark, sf, "clips").filter("id is not null").dropDuplicates(["id"])
    return c.filter(text.holds_phrase(F.col("text"), F.lit("ESKİ"))).select("id")
