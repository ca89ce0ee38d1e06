"""Ledger, merges, comparison and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import compare, ledger, quality, report
from .base import ONCE, clips, metric, query, table

LATEST = "(SELECT kind, item_key, stage, m.v AS version, m.t AS done_at FROM (SELECT kind, item_key, stage, max({'t': done_at, 'v': version}) AS m FROM done GROUP BY ALL))"
TOP = "(SELECT max(version) FROM done WHERE stage = 'clip_qc' AND kind = 'clip')"


@query(f"SELECT kind, item_key, stage, version, done_at FROM {LATEST}")
def ledger_latest(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.latest_marks(table(spark, sf, "done"))


def _version(spark: SparkSession, sf: str) -> str:
    return table(spark, sf, "done").filter("stage = 'clip_qc' AND kind = 'clip'").agg(F.max("version")).first()[0] or ""


@query(f"SELECT id FROM {ONCE} WHERE id NOT IN (SELECT item_key FROM {LATEST} WHERE kind = 'clip' AND stage = 'clip_qc' AND version = {TOP} AND item_key IS NOT NULL)")
def pending_anti_join(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "clips").select("id").filter("id is not null").distinct()
    return ledger.pending(c, F.col("id"), table(spark, sf, "done"), "clip", "clip_qc", _version(spark, sf))


@query(f"SELECT id FROM {ONCE} WHERE id IN (SELECT item_key FROM {LATEST} WHERE kind = 'clip' AND stage = 'clip_qc' AND version = {TOP})")
def done_semi_join(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "clips").select("id").filter("id is not null").distinct()
    return ledger.is_done(c, F.col("id"), table(spark, sf, "done"), "clip", "clip_qc", _version(spark, sf))


@query(f"SELECT kind, stage, count(*) AS items, count(DISTINCT version) AS versions FROM {LATEST} GROUP BY 1, 2")
def stage_summary(spark: SparkSession, sf: str) -> DataFrame:
    return report.stage_summary(table(spark, sf, "done"))


@query("SELECT item_key, array_to_string(list_sort(list(DISTINCT stage)), ',') AS stages FROM done WHERE kind = 'source' GROUP BY 1")
def stages_by_source(spark: SparkSession, sf: str) -> DataFrame:
    return report.stages_by_item(table(spark, sf, "done"), "source")


@query(f"""SELECT kind, stage, version, count(*) AS n FROM (SELECT d.kind, d.stage, CASE WHEN d.kind = 'clip' AND d.stage = 'clip_qc' AND d.version = {TOP} AND c.id IS NOT NULL THEN 'next' ELSE d.version END AS version FROM done d LEFT JOIN (SELECT id FROM {ONCE} WHERE {metric("speech_ratio")} >= 0.7) c ON c.id = d.item_key) GROUP BY ALL""")
def version_migration(spark: SparkSession, sf: str) -> DataFrame:
    ok = F.try_element_at(F.col("metrics"), F.lit("speech_ratio")) >= 0.7
    m = ledger.migrate(table(spark, sf, "done"), clips(spark, sf), "clip_qc", _version(spark, sf), "next", ok)
    return m.groupBy("kind", "stage", "version").agg(F.count("*").alias("n"))


@query(f"""SELECT id, {metric("speech_ratio")} AS speech_ratio, CASE WHEN duration >= 10 THEN 1.0 END AS dnsmos_new, CASE WHEN duration < 10 OR duration IS NULL THEN {metric("dnsmos_ovrl")} END AS dnsmos_old, array_to_string(CASE WHEN duration >= 10 THEN list_concat(list_filter(f, lambda x: x NOT IN ('short', 'checked')), ['checked']) ELSE f END, ',') AS flags
    FROM (SELECT *, CASE WHEN flags_json IS NULL OR NOT json_valid(flags_json) THEN [] ELSE json_extract_string(flags_json, '$[*]') END AS f FROM {ONCE})""")
def owned_key_merge(spark: SparkSession, sf: str) -> DataFrame:
    """A stage that owns dnsmos_ovrl, dnsmos_new and the flags short and checked reports on clips of 10 s or more."""
    c = clips(spark, sf)
    found = c.filter("duration >= 10").select("id", F.create_map(F.lit("dnsmos_new"), F.lit(1.0)).alias("metrics"), F.array(F.lit("checked")).alias("flags"))
    m = ledger.merge_owned(c.select("id", F.expr("coalesce(metrics, cast(map() as map<string,double>))").alias("metrics"), F.coalesce("flags", F.array().cast("array<string>")).alias("flags")), found, ["dnsmos_ovrl", "dnsmos_new"], ["short", "checked"])
    get = lambda k: F.try_element_at(F.col("metrics"), F.lit(k))
    return m.select("id", get("speech_ratio").alias("speech_ratio"), get("dnsmos_new").alias("dnsmos_new"), get("dnsmos_ovrl").alias("dnsmos_old"), F.array_join("flags", ",").alias("flags"))


@query(f"""WITH a AS (SELECT id, duration, text, audio FROM {ONCE}), b AS (SELECT id, round(duration, 1) AS duration, trim(text) AS text, 'x/' || audio AS audio FROM a WHERE duration IS NULL OR duration > 1), j AS (SELECT a.id AS ia, b.id AS ib, a.duration AS da, b.duration AS db, a.text AS ta, b.text AS tb FROM a FULL JOIN b ON a.id = b.id)
    SELECT k AS "column", (SELECT count(*) FROM j WHERE ib IS NULL) AS only_a, (SELECT count(*) FROM j WHERE ia IS NULL) AS only_b, (SELECT count(*) FROM j WHERE ia = ib) AS common, CASE k WHEN 'duration' THEN (SELECT count(*) FROM j WHERE ia = ib AND da IS DISTINCT FROM db) WHEN 'text' THEN (SELECT count(*) FROM j WHERE ia = ib AND ta IS DISTINCT FROM tb) ELSE 0 END AS n_differ,
    CASE k WHEN 'duration' THEN (SELECT round(max(abs(da - db)), 9) FROM j WHERE ia = ib) END AS max_delta, CASE k WHEN 'duration' THEN (SELECT min(ia) FROM j WHERE ia = ib AND da IS DISTINCT FROM db) WHEN 'text' THEN (SELECT min(ia) FROM j WHERE ia = ib AND ta IS DISTINCT FROM tb) END AS example FROM (SELECT unnest(['duration', 'text', 'audio']) AS k)""")
def manifest_diff(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "clips").filter("id is not null").dropDuplicates(["id"]).select("id", "duration", "text", "audio")
    b = a.filter("duration IS NULL OR duration > 1").select("id", F.round("duration", 1).alias("duration"), F.trim("text").alias("text"), F.concat(F.lit("x/"), "audio").alias("audio"))
    d = compare.table_diff(a, b, "id", ["duration", "text", "audio"], paths=("audio",))
    return d.withColumn("max_delta", F.round("max_delta", 9))


M = {k: metric(k) for k in ("speech_ratio", "word_confidence", "dnsmos_ovrl", "internal_silence_sec", "peak_dbfs", "rms_dbfs", "music_to_speech_db")}
BAD = {
    "id_form": "NOT regexp_full_match(id, 'src[0-9]{5}-[0-9]{5}')", "id_names_source": "source_id IS NOT NULL AND NOT starts_with(id, format('src{:05d}-', source_id))", "duration_is_end_minus_start": "abs(duration - (end_sec - start_sec)) > 0.002", "duration_positive": "duration <= 0",
    "text_present": "coalesce(trim(text) = '', true)", "speech_ratio_range": f"({M['speech_ratio']}) IS NOT NULL AND NOT ({M['speech_ratio']}) BETWEEN 0 AND 1", "word_confidence_range": f"({M['word_confidence']}) IS NOT NULL AND NOT ({M['word_confidence']}) BETWEEN 0 AND 1",
    "dnsmos_range": f"({M['dnsmos_ovrl']}) IS NOT NULL AND NOT ({M['dnsmos_ovrl']}) BETWEEN 1 AND 5", "silence_within_duration": f"({M['internal_silence_sec']}) > duration + 0.002", "peak_not_below_rms": f"({M['peak_dbfs']}) < ({M['rms_dbfs']})", "music_db_floor": f"({M['music_to_speech_db']}) < -80",
}


@query(" UNION ALL ".join(f"SELECT '{k}' AS \"check\", count(*) FILTER ({c}) AS bad, count(*) AS total, count(*) FILTER ({c}) = 0 AS ok, min(id) FILTER ({c}) AS example FROM {ONCE}" for k, c in BAD.items()))
def clip_integrity(spark: SparkSession, sf: str) -> DataFrame:
    return quality.check(clips(spark, sf), quality.clip_assertions())


@query(f"""WITH n AS (SELECT idx, end_sec, lead(idx) OVER w AS ni, lead(start_sec) OVER w AS ns FROM {ONCE} WHERE source_id IS NOT NULL WINDOW w AS (PARTITION BY source_id ORDER BY idx)) SELECT 'idx_contiguous' AS "check", count(*) FILTER (ni <> idx + 1) AS bad FROM n UNION ALL SELECT 'no_overlap', count(*) FILTER (ns < end_sec - 0.001) FROM n""")
def clip_order(spark: SparkSession, sf: str) -> DataFrame:
    return quality.order_assertions(table(spark, sf, "clips").filter("id is not null").dropDuplicates(["id"]))


@query("SELECT id, count(*) AS n FROM clips WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1")
def repeated_ids(spark: SparkSession, sf: str) -> DataFrame:
    return quality.unique(table(spark, sf, "clips").filter("id is not null"), "id")


@query("""WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events), s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM e)
    SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS "end", count(*) AS n FROM s GROUP BY user_id, k""")
def session_regions(spark: SparkSession, sf: str) -> DataFrame:
    from ..streaming import sessions

    return sessions(table(spark, sf, "events"), "ts", "user_id", "30 minutes").select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "n")


@query("SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS \"end\", count(*) AS n FROM events GROUP BY ALL")
def event_windows(spark: SparkSession, sf: str) -> DataFrame:
    from ..streaming import windows

    return windows(table(spark, sf, "events"), "ts", "event_type", "1 hour").select("event_type", F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "n")


@query(f"SELECT DISTINCT channel FROM sources WHERE error IS NULL AND channel IS NOT NULL AND channel NOT IN (SELECT channel FROM sources WHERE error IS NULL AND channel IS NOT NULL AND id NOT IN (SELECT source_id FROM {ONCE} WHERE source_id IS NOT NULL))")
def ready_channels(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import listening

    return listening.ready_channels(table(spark, sf, "sources"), table(spark, sf, "clips"))


@query(f"""SELECT channel, id, CAST(place AS INTEGER) AS place FROM (SELECT channel, id, row_number() OVER (PARTITION BY channel ORDER BY turn, sha256('7:' || CAST(source_id AS VARCHAR)), id) AS place FROM (SELECT channel, source_id, id, row_number() OVER (PARTITION BY channel, source_id ORDER BY sha256('7:' || id), id) AS turn FROM {ONCE} WHERE channel IS NOT NULL AND source_id IS NOT NULL) WHERE turn <= 10) WHERE place <= 10""")
def deck_draw(spark: SparkSession, sf: str) -> DataFrame:
    """Ten clips a channel are the feature."""
    from ..operators import listening

    c = table(spark, sf, "clips").filter("id is not null AND source_id is not null").dropDuplicates(["id"])
    return listening.draw_deck(c, 10, "7").select("channel", "id", "place")


@query(f"""SELECT arm, count(*) AS n, count(*) FILTER (verdict = 'temiz') AS hits, round(count(*) FILTER (verdict = 'temiz') / count(*), 6) AS share FROM (SELECT CASE WHEN duration < 7 THEN 'short' ELSE 'long' END AS arm, verdict FROM {ONCE} c JOIN (SELECT clip_id, arg_max(CASE verdict WHEN 'iyi' THEN 'temiz' WHEN 'kotu' THEN 'bozuk' WHEN 'kötü' THEN 'bozuk' WHEN 'orta' THEN 'kusurlu' ELSE verdict END, {{'a': ts, 'b': received_at, 'c': coalesce(verdict, ''), 'd': coalesce(note, '')}}) AS verdict FROM notes WHERE clip_id IS NOT NULL GROUP BY 1) n ON n.clip_id = c.id WHERE duration IS NOT NULL) GROUP BY arm""")
def blind_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Notes taken as answers about short and long clips."""
    from ..operators import listening

    c = table(spark, sf, "clips").filter("id is not null").dropDuplicates(["id"])
    arm = F.when(F.col("duration") < 7, "short").when(F.col("duration") >= 7, "long")
    key = listening.blind_key(c, arm, 1 << 30, "audit")
    answers = report.latest_notes(table(spark, sf, "notes")).join(key.select(F.col("id").alias("clip_id"), "code"), "clip_id").select("code", "verdict")
    return listening.audit(answers, key, F.col("verdict") == "temiz")


CARD = f"(SELECT channel, count(*) AS clips, count(DISTINCT source_id) AS recordings, round(sum(duration) / 3600, 2) AS hours FROM {ONCE} WHERE channel IS NOT NULL GROUP BY channel ORDER BY count(*) DESC, channel LIMIT 20)"


@query(f"""SELECT channel || ': ' || figure AS figure, CASE WHEN figure = 'clips' AND channel = (SELECT min(channel) FROM {CARD}) THEN x + 1 ELSE x END AS expected, x AS found, NOT (figure = 'clips' AND channel = (SELECT min(channel) FROM {CARD})) AS ok
    FROM (SELECT channel, 'clips' AS figure, CAST(clips AS DOUBLE) AS x FROM {CARD} UNION ALL SELECT channel, 'recordings', recordings FROM {CARD} UNION ALL SELECT channel, 'hours', hours FROM {CARD})""")
def published_figures(spark: SparkSession, sf: str) -> DataFrame:
    """Figures of a card's table (the twenty largest channels, as text with thousands marks, one of them planted wrong) against those worked out again. Twenty rows are the feature."""
    c = table(spark, sf, "clips").filter("id is not null AND channel is not null").dropDuplicates(["id"])
    figures = {"clips": F.count("*"), "recordings": F.countDistinct("source_id"), "hours": F.round(F.sum("duration") / 3600, 2)}
    g = c.groupBy("channel").agg(*[x.alias(k) for k, x in figures.items()])
    top = sorted(g.orderBy(F.desc("clips"), "channel").limit(20).collect(), key=lambda r: r.channel)
    rows = [f"| {r.channel} | {r.clips + (i == 0):,} | {r.recordings:,} | {r.hours:,.2f} |" for i, r in enumerate(top)]
    card = "\n".join(["# Corpus", "## Channels", "", "| channel | clips | recordings | hours |", "| --- | ---: | ---: | ---: |", *rows, "## Licence"])
    return quality.card_figures(card, "Channels", g, "channel", list(figures), 0.005)
