"""Statistics, vectors and signal arithmetic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import signal
from ..operators import stats, vectors
from .base import ONCE, clips, metric, query, table

RANK = lambda c: f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0"


@query(f"SELECT count(*) AS n, round(corr(rx, ry), 6) AS rho FROM (SELECT {RANK('x')} AS rx, {RANK('y')} AS ry FROM (SELECT {metric('dnsmos_ovrl')} AS x, {metric('speech_ratio')} AS y FROM {ONCE}) WHERE x IS NOT NULL AND y IS NOT NULL)")
def spearman(spark: SparkSession, sf: str) -> DataFrame:
    m = lambda k: F.try_element_at(F.col("metrics"), F.lit(k)).alias(k)
    return stats.spearman(clips(spark, sf).select(m("dnsmos_ovrl"), m("speech_ratio")), "dnsmos_ovrl", "speech_ratio").select("n", F.round("rho", 6).alias("rho"))


@query("SELECT count(*) AS n, round(corr(rx, ry), 6) AS rho FROM (SELECT rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS rx, rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0 AS ry FROM lineitem)")
def spearman_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    return stats.spearman(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice").select("n", F.round("rho", 6).alias("rho"))


SAMPLE = f"(SELECT {metric('speech_ratio')} AS v, {metric('dnsmos_ovrl')} >= 3.2 AS p FROM {ONCE})"


def samples(spark: SparkSession, sf: str) -> DataFrame:
    m = lambda k: F.try_element_at(F.col("metrics"), F.lit(k))
    return clips(spark, sf).select(m("speech_ratio").alias("v"), (m("dnsmos_ovrl") >= 3.2).alias("p"))


@query(f"""WITH s AS (SELECT * FROM {SAMPLE} WHERE v IS NOT NULL AND p IS NOT NULL), c AS (SELECT DISTINCT round(v, 3) AS t FROM s), r AS (SELECT t, count(*) FILTER (p AND v < t) / count(*) FILTER (p) AS fn, count(*) FILTER (NOT p AND v >= t) / count(*) FILTER (NOT p) AS fp FROM c, s GROUP BY t)
    SELECT t AS threshold, round((fn + fp) / 2, 9) AS error FROM r ORDER BY round(abs(fn - fp), 12), t LIMIT 1""")
def eer_threshold(spark: SparkSession, sf: str) -> DataFrame:
    return stats.eer_threshold(samples(spark, sf), "v", "p").select("threshold", F.round("error", 9).alias("error"))


TS = [0.5, 0.6, 0.7, 0.8, 0.9]


@query(" UNION ALL ".join(f"SELECT CAST({t} AS DOUBLE) AS threshold, count(*) FILTER (p AND v < {t}) AS missed, count(*) FILTER (NOT p AND v >= {t}) AS needless, count(*) FILTER (p AND v < {t}) + count(*) FILTER (NOT p AND v >= {t}) AS errors FROM {SAMPLE}" for t in TS))
def threshold_sweep(spark: SparkSession, sf: str) -> DataFrame:
    return stats.threshold_sweep(samples(spark, sf), "v", "p", TS)


@query(f"SELECT CASE WHEN duration < 2 THEN '<2' WHEN duration < 5 THEN '2-5' WHEN duration < 10 THEN '5-10' WHEN duration < 15 THEN '10-15' WHEN duration >= 15 THEN '>=15' END AS band, count(*) AS n, round(sum(duration), 3) AS seconds FROM {ONCE} GROUP BY band")
def length_bands(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "clips").filter("id is not null").dropDuplicates(["id"])
    return c.groupBy(stats.bands(F.col("duration"), [2, 5, 10, 15]).alias("band")).agg(F.count("*").alias("n"), F.round(F.sum("duration"), 3).alias("seconds"))


VECTORS = "(SELECT label, vec_id, list_transform(embedding, lambda x: x::DOUBLE / sqrt(list_sum(list_transform(embedding, lambda y: y::DOUBLE * y)))) AS u FROM embeddings WHERE embedding IS NOT NULL)"


@query(f"SELECT a.label, (SELECT count(*) FROM embeddings e WHERE e.label IS NOT DISTINCT FROM a.label) AS n, round(avg(list_dot_product(a.u, b.u)), 6) AS mean_cosine FROM {VECTORS} a JOIN {VECTORS} b ON a.label = b.label AND a.vec_id < b.vec_id GROUP BY a.label")
def pairwise_consistency(spark: SparkSession, sf: str) -> DataFrame:
    return vectors.consistency(table(spark, sf, "embeddings"), "label", "embedding").select("label", "n", F.round("mean_cosine", 6).alias("mean_cosine"))


CENTERS = f"(SELECT label, n, list_transform(s, lambda x: x / sqrt(list_sum(list_transform(s, lambda y: y * y)))) AS center FROM (SELECT label, any_value(n) AS n, list(s ORDER BY i) AS s FROM (SELECT label, i, sum(x) AS s, count(*) AS n FROM (SELECT label, unnest(u) AS x, generate_subscripts(u, 1) AS i FROM {VECTORS}) GROUP BY label, i) GROUP BY label))"


@query(f"SELECT label, n, round(center[1], 6) AS first, round(center[64], 6) AS last FROM {CENTERS}")
def centroids(spark: SparkSession, sf: str) -> DataFrame:
    c = vectors.centroids(table(spark, sf, "embeddings"), "label", "embedding")
    return c.select("label", "n", F.round(F.get("center", F.lit(0)), 6).alias("first"), F.round(F.get("center", F.lit(63)), 6).alias("last"))


@query(f"SELECT a.label AS a, b.label AS b, round(list_dot_product(a.center, b.center), 6) AS cosine FROM {CENTERS} a JOIN {CENTERS} b ON a.label < b.label")
def cross_channel_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return vectors.center_pairs(vectors.centroids(table(spark, sf, "embeddings"), "label", "embedding"), "label").select("a", "b", F.round("cosine", 6).alias("cosine"))


@query(f"SELECT v.vec_id, round(max(list_dot_product(v.u, c.center)) FILTER (v.label = c.label), 6) AS own, round(max(list_dot_product(v.u, c.center)) FILTER (v.label <> c.label), 6) AS other FROM {VECTORS} v, {CENTERS} c GROUP BY 1")
def margins(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings")
    return vectors.margins(e, vectors.centroids(e, "label", "embedding"), "label", "embedding", "vec_id").select("vec_id", F.round("own", 6).alias("own"), F.round("other", 6).alias("other"))


@query()
def cluster(spark: SparkSession, sf: str) -> DataFrame:
    """Agglomerative: no SQL twin, tested on planted clusters."""
    return vectors.cluster(vectors.centroids(table(spark, sf, "embeddings"), "label", "embedding"), "label", 0.5)


@query("""SELECT label, vec_id, round(20 * log10(greatest(list_max(list_transform(embedding, lambda x: abs(x::DOUBLE))), 1e-6)), 2) AS peak_dbfs, round(20 * log10(greatest(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x)) / len(embedding)), 1e-6)), 2) AS rms_dbfs, round(len(list_filter(embedding, lambda x: abs(x) >= 0.99)) / len(embedding), 5) AS clipping FROM embeddings""")
def level_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Levels of the vectors, taken as samples."""
    return table(spark, sf, "embeddings").select("label", "vec_id", signal.level_metrics(F.col("embedding")).alias("m")).select("label", "vec_id", "m.*")


@query(f"""WITH r AS (SELECT source_id, start_sec AS s, end_sec AS e, lead(start_sec) OVER w - end_sec AS g FROM {ONCE} WHERE source_id IS NOT NULL AND end_sec > start_sec WINDOW w AS (PARTITION BY source_id ORDER BY start_sec, end_sec, id)), a AS (SELECT source_id, sum(e - s) AS t, max(g) AS g, min(s) AS lo, arg_max(e, (s, e)) AS hi FROM r GROUP BY 1)
    SELECT x.id AS source_id, CASE WHEN t IS NOT NULL AND duration > 0 THEN round(least(t / duration, 1), 4) ELSE 0 END AS speech_ratio, round(greatest(coalesce(g, 0), 0), 3) AS internal_silence, round(CASE WHEN t IS NULL THEN duration ELSE greatest(lo, 0) END, 3) AS lead_silence, round(CASE WHEN t IS NULL THEN duration ELSE greatest(duration - hi, 0) END, 3) AS trail_silence FROM sources x LEFT JOIN a ON a.source_id = x.id""")
def speech_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Share of speech and silences of each recording, its clips taken as speech."""
    from .texts import regions

    s = table(spark, sf, "sources").select(F.col("id").alias("source_id"), "duration")
    j = s.join(regions(spark, sf), "source_id", "left").withColumn("regions", F.coalesce("regions", F.array().cast("array<struct<start:double,end:double>>")))
    return j.select("source_id", signal.speech_metrics(F.col("regions"), F.col("duration")).alias("m")).select("source_id", "m.*")


@query(f"SELECT id, CAST(CASE WHEN duration > 0 THEN greatest(floor(CASE WHEN duration < 9.01 THEN duration * pow(2, ceil(log2(9.01 / duration))) ELSE duration END) - 9, 1) ELSE 0 END AS INTEGER) AS n_quality, len(list_distinct(list_concat(range(0, greatest(CAST(round(duration * 100) AS BIGINT) - 1024, 0) + 1, 500), [greatest(CAST(round(duration * 100) AS BIGINT) - 1024, 0)]))) AS n_tail FROM {ONCE} WHERE duration IS NOT NULL")
def window_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Analysis windows of each clip: 9.01 s by 1 s, and 10.24 s by 5 s with an anchored tail."""
    c = table(spark, sf, "clips").filter("id is not null").dropDuplicates(["id"]).filter("duration is not null")
    n = F.round(F.col("duration") * 100).cast("int")
    return c.select("id", signal.quality_windows(F.col("duration")).alias("n_quality"), F.size(signal.tail_windows(n, 1024, 500)).cast("long").alias("n_tail"))


@query("SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: -0.06766283 * x::DOUBLE * x::DOUBLE + 1.11546468 * x::DOUBLE + 0.04602535)) / len(embedding), 6) AS mos FROM embeddings")
def mos_poly(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select("vec_id", F.round(signal.mos(F.transform("embedding", lambda x: x.cast("double")), "ovrl"), 6).alias("mos"))


@query("""WITH x AS (SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings), f AS (SELECT *, v < 0 AS low, row_number() OVER (PARTITION BY vec_id ORDER BY i) - row_number() OVER (PARTITION BY vec_id, v < 0 ORDER BY i) AS g FROM x) SELECT vec_id, CAST(min(i) - 1 AS INTEGER) AS a, CAST(max(i) AS INTEGER) AS b FROM f WHERE low GROUP BY vec_id, g""")
def silence_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Index ranges where a vector, taken as an envelope, is below zero."""
    e = table(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("x"))
    return e.select("vec_id", F.explode(signal.runs_below(F.col("x"), F.lit(0.0))).alias("r")).select("vec_id", "r.a", "r.b")


@query(f"SELECT id, m > -10 AS background FROM (SELECT id, coalesce({metric('music_to_speech_db')}, -80) AS m FROM {ONCE})")
def background_music(spark: SparkSession, sf: str) -> DataFrame:
    return clips(spark, sf).select("id", signal.background_music(F.try_element_at(F.col("metrics"), F.lit("music_to_speech_db")), -10.0).alias("background"))


@query(f"SELECT channel, count(*) AS n, round(quantile_cont(r, 0.5), 6) AS median, round(min(r), 6) AS least, round(max(r), 6) AS most FROM (SELECT channel, duration / len(string_split_regex(trim(text), '\\s+')) AS r FROM {ONCE} WHERE duration > 0 AND trim(text) <> '' AND channel IS NOT NULL) GROUP BY channel".replace("\\\\", "\\"))
def outlier_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Seconds per word by channel."""
    c = table(spark, sf, "clips").filter("id is not null").dropDuplicates(["id"]).filter("duration > 0 AND trim(text) <> '' AND channel is not null")
    r = F.col("duration") / F.size(F.split(F.trim("text"), r"\s+"))
    c = c.select("channel", r.alias("rate"))
    ends = c.groupBy("channel").agg(F.round(F.min("rate"), 6).alias("least"), F.round(F.max("rate"), 6).alias("most"))
    return stats.linear_percentiles(c, ["channel"], "rate", {"median": 0.5}).join(ends, "channel").select("channel", "n", F.round("median", 6).alias("median"), "least", "most")
