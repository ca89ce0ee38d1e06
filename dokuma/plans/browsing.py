"""Filters, sorting, profiles and reports over the clip tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import browse, report, stats
from .base import ONCE, clips, low, metric, query, table
from .core import FLAGS, annotated

NOTES = """(SELECT clip_id, r.ts AS ts, CASE r.verdict WHEN 'iyi' THEN 'temiz' WHEN 'kotu' THEN 'bozuk' WHEN 'kötü' THEN 'bozuk' WHEN 'orta' THEN 'kusurlu' ELSE r.verdict END AS verdict, r.tags AS tags, r.note AS note
    FROM (SELECT clip_id, arg_max({'ts': ts, 'verdict': verdict, 'tags': tags, 'note': note}, {'a': ts, 'b': received_at, 'c': coalesce(verdict, ''), 'd': coalesce(note, '')}) AS r FROM notes WHERE clip_id IS NOT NULL GROUP BY clip_id))"""


def notes(spark: SparkSession, sf: str) -> DataFrame:
    return report.latest_notes(table(spark, sf, "notes"))


@query(f"SELECT clip_id, ts, verdict, array_to_string(list_sort(tags), ',') AS tags FROM {NOTES}")
def latest_note(spark: SparkSession, sf: str) -> DataFrame:
    return notes(spark, sf).select("clip_id", "ts", "verdict", F.array_join(F.array_sort("tags"), ",").alias("tags"))


@query(f"SELECT c.id, c.text_raw <> c.text AS raw_differs, c.text_spoken <> c.text AS spoken_differs, length(c.text) AS n_chars, coalesce(c.audio, '') <> '' AS has_audio, {low('c.text')} AS search_key, n.verdict FROM {ONCE} c LEFT JOIN {NOTES} n ON n.clip_id = c.id")
def base_rows(spark: SparkSession, sf: str) -> DataFrame:
    from ..functions.text import lower_tr

    c = table(spark, sf, "clips").filter("id is not null").dropDuplicates(["id"])
    n = notes(spark, sf).select(F.col("clip_id").alias("id"), "verdict")
    return c.join(n, "id", "left").select("id", (F.col("text_raw") != F.col("text")).alias("raw_differs"), (F.col("text_spoken") != F.col("text")).alias("spoken_differs"), F.length("text").cast("long").alias("n_chars"), (F.coalesce("audio", F.lit("")) != "").alias("has_audio"), lower_tr(F.col("text")).alias("search_key"), "verdict")


NUM = {"gt": "d > 3", "ge": "d >= 3", "lt": "d < 3", "le": "d <= 3", "eq": "d = 3", "ne": "d IS DISTINCT FROM 3", "empty": "d IS NULL", "notempty": "d IS NOT NULL"}
STR = {
    "contains": "contains(t, 'deniz')", "ncontains": "NOT contains(t, 'deniz')", "eq": "t = 'tamam dedi.'", "ne": "t <> 'tamam dedi.'", "starts": "starts_with(t, 'i')", "ends": "ends_with(t, 'ı')", "empty": "t = ''", "notempty": "t <> ''",
}
STR_IN = {"contains": "DENİZ", "ncontains": "DENİZ", "eq": "Tamam dedi.", "ne": "Tamam dedi.", "starts": "İ", "ends": "I"}
LIST = {"has": "len(list_filter(f, lambda x: contains(x, 'short'))) > 0", "nothas": "len(list_filter(f, lambda x: contains(x, 'short'))) = 0", "empty": "len(f) = 0", "notempty": "len(f) > 0", "count_gt": "len(f) > 1", "count_lt": "len(f) < 1"}
LIST_IN = {"has": "SHORT", "nothas": "SHORT", "count_gt": "1", "count_lt": "1"}


def _matrix(rows: DataFrame, column: str, kind: str, ops: dict[str, str]) -> DataFrame:
    one = rows.agg(*[F.count_if(browse.match(browse.field(rows, column), kind, op, v)).alias(op) for op, v in ops.items()])
    return one.select(F.explode(F.array(*[F.struct(F.lit(op).alias("op"), F.col(op).alias("n")) for op in ops])).alias("r")).select("r.*")


def _matrix_sql(source: str, ops: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{op}' AS op, count(*) AS n FROM {source} WHERE {cond}" for op, cond in ops.items())


@query(_matrix_sql(f"(SELECT {metric('dnsmos_ovrl')} AS d FROM {ONCE})", NUM))
def filter_matrix_num(spark: SparkSession, sf: str) -> DataFrame:
    return _matrix(clips(spark, sf), "dnsmos_ovrl", "num", dict.fromkeys(NUM, "3"))


@query(_matrix_sql(f"(SELECT {low('''coalesce(text, '')''')} AS t FROM {ONCE})", STR))
def filter_matrix_str(spark: SparkSession, sf: str) -> DataFrame:
    return _matrix(clips(spark, sf), "text", "str", {op: STR_IN.get(op, "") for op in STR})


@query(_matrix_sql(f"(SELECT {FLAGS} AS f FROM {ONCE})", LIST))
def filter_matrix_list(spark: SparkSession, sf: str) -> DataFrame:
    return _matrix(clips(spark, sf), "flags", "list", {op: LIST_IN.get(op, "") for op in LIST})


@query(f"SELECT id, duration FROM (SELECT *, {metric('dnsmos_ovrl')} AS d, {metric('speech_ratio')} AS s FROM {ONCE}) WHERE duration >= 2 AND duration <= 12 AND d > 3 AND s >= 0.7 AND len({FLAGS}) = 0 AND contains({low('''coalesce(text, '')''')}, 'deniz')")
def select_clips(spark: SparkSession, sf: str) -> DataFrame:
    f = json.dumps([{"c": "speech_ratio", "o": "ge", "v": "0.7"}])
    return browse.select_clips(clips(spark, sf), q="Deniz", flag="none", least=2, most=12, cond="dnsmos_ovrl > 3; not a condition", f=f).select("id", "duration")


@query(f"SELECT id, duration, CAST(rank AS INTEGER) AS rank FROM (SELECT id, duration, row_number() OVER (ORDER BY duration DESC NULLS LAST, id) AS rank FROM {ONCE}) WHERE rank > 40 AND rank <= 65")
def page_offset(spark: SparkSession, sf: str) -> DataFrame:
    """A page is the feature."""
    from pyspark.sql.window import Window

    p = browse.page(clips(spark, sf), "duration", 40, 25, descending=True)
    return p.select("id", "duration", (F.row_number().over(Window.orderBy(F.desc_nulls_last("duration"), "id")) + 40).alias("rank"))  # over one page


@query(f"""WITH v AS (SELECT {metric("dnsmos_ovrl")} AS v FROM {ONCE}), e AS (SELECT min(v) AS lo, max(v) AS hi, count(v) AS total FROM v), b AS (SELECT CAST(least(floor((v - lo) / ((hi - lo) / 24)), 23) AS INTEGER) AS bin FROM v, e WHERE v IS NOT NULL),
    c AS (SELECT g.bin, (SELECT count(*) FROM b WHERE b.bin = g.bin) AS n FROM (SELECT CAST(unnest(range(24)) AS INTEGER) AS bin) g)
    SELECT bin, round(lo + bin * ((hi - lo) / 24), 6) AS "from", round(lo + (bin + 1) * ((hi - lo) / 24), 6) AS "to", n, CAST(coalesce(sum(n) OVER (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS below, CAST(total - coalesce(sum(n) OVER (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS above FROM c, e""")
def distribution_hist(spark: SparkSession, sf: str) -> DataFrame:
    d = browse.distribution(clips(spark, sf), "dnsmos_ovrl")
    return d.select("bin", F.round("from", 6).alias("from"), F.round("to", 6).alias("to"), "n", "below", "above")


@query(f"""SELECT count(v) AS n, min(v) AS min, max(v) AS max, round(avg(v), 6) AS mean, {", ".join(f"round(quantile_cont(v, {p}), 6) AS p{round(100 * p):02d}" for p in (0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99))} FROM (SELECT {metric("dnsmos_ovrl")} AS v FROM {ONCE})""")
def percentile_linear(spark: SparkSession, sf: str) -> DataFrame:
    return browse.describe(clips(spark, sf), "dnsmos_ovrl")


@query(f"WITH s AS (SELECT list_sort(list(duration)) AS l FROM {ONCE} WHERE duration IS NOT NULL) SELECT p, l[least(CAST(floor(p * len(l)) AS BIGINT), len(l) - 1) + 1] AS value FROM s, (SELECT unnest([0.05::DOUBLE, 0.5, 0.95]) AS p)")
def quantile_floor(spark: SparkSession, sf: str) -> DataFrame:
    return stats.floor_quantiles(table(spark, sf, "clips").filter("id is not null").dropDuplicates(["id"]), "duration", [0.05, 0.5, 0.95])


@query(f"WITH s AS (SELECT list_sort(list(duration)) AS l FROM {ONCE} WHERE duration IS NOT NULL) SELECT p, l[CAST(floor(p * (len(l) - 1)) AS BIGINT) + 1] AS value FROM s, (SELECT unnest([0.1::DOUBLE, 0.5, 0.9]) AS p)")
def quantile_index(spark: SparkSession, sf: str) -> DataFrame:
    return stats.floor_quantiles(table(spark, sf, "clips").filter("id is not null").dropDuplicates(["id"]), "duration", [0.1, 0.5, 0.9], last=True)


PROFILE = f"(SELECT 'channel' AS \"column\", channel AS value FROM {ONCE} UNION ALL SELECT 'duration', CAST(CAST(duration AS DECIMAL(18, 3)) AS VARCHAR) FROM {ONCE} UNION ALL SELECT 'flags', array_to_string({FLAGS}, ', ') FROM {ONCE})"


@query(f"""WITH c AS (SELECT "column", value, count(*) AS n FROM {PROFILE} WHERE value IS NOT NULL AND value <> '' GROUP BY ALL), t AS (SELECT "column", CAST(sum(n) AS BIGINT) AS n_filled, CAST(sum(CASE WHEN TRY_CAST(value AS DOUBLE) IS NOT NULL THEN n ELSE 0 END) AS BIGINT) AS n_numeric, count(*) AS n_distinct FROM c GROUP BY 1)
    SELECT "column", value, n, CAST(rank AS INTEGER) AS rank, n_filled, n_numeric, n_distinct FROM (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS rank FROM c) JOIN t USING ("column") WHERE rank <= 60""")
def column_profile(spark: SparkSession, sf: str) -> DataFrame:
    c = clips(spark, sf).withColumn("duration", F.col("duration").cast("decimal(18,3)").cast("string"))
    return browse.profile(c, ["channel", "duration", "flags"])


REC = "len(list_filter([sr IS NULL OR sr < 0.6, si IS NULL OR si > 1.0, coalesce(mu > -6.0, false), bad], lambda x: x)) = 0"


@query(f"""SELECT count(*) AS n, round(sum(duration) / 3600, 4) AS hours, count(verdict) AS judged, count(*) FILTER (verdict = 'temiz') AS clean, round(count(*) FILTER (verdict = 'temiz') / nullif(count(verdict), 0), 4) AS clean_rate, count(*) FILTER (rec) AS rec_yes, count(*) FILTER (NOT rec) AS rec_no, count(*) FILTER (rec IS NULL) AS rec_none
    FROM (SELECT c.*, n.verdict, {REC} AS rec FROM (SELECT id, duration, {metric("speech_ratio")} AS sr, {metric("internal_silence_sec")} AS si, {metric("music_to_speech_db")} AS mu, len(list_filter({FLAGS}, lambda x: x IN ('duplicate', 'oversize', 'short', 'background_music'))) > 0 AS bad FROM {ONCE}) c LEFT JOIN {NOTES} n ON n.clip_id = c.id)""")
def scorecard(spark: SparkSession, sf: str) -> DataFrame:
    return browse.scorecard(annotated(spark, sf).join(notes(spark, sf).select(F.col("clip_id").alias("id"), "verdict"), "id", "left"))


@query("SELECT value, n FROM (SELECT value, count(*) AS n FROM (SELECT unnest(tags) AS value FROM notes) GROUP BY value ORDER BY n DESC, value LIMIT 6)")
def top_tags(spark: SparkSession, sf: str) -> DataFrame:
    """A top-k report."""
    return browse.top_values(table(spark, sf, "notes"), "tags", 6)


@query(f"SELECT channel, count(*) AS clips, count(DISTINCT source_id) AS sources, round(sum(duration) / 3600, 4) AS hours, round(100.0 * sum(duration) / (SELECT sum(duration) FROM {ONCE}), 4) AS pct FROM {ONCE} GROUP BY channel")
def by_channel(spark: SparkSession, sf: str) -> DataFrame:
    return report.by_channel(table(spark, sf, "clips").filter("id is not null").dropDuplicates(["id"]))


@query(f"SELECT (SELECT count(*) FROM sources) AS sources, (SELECT count(error) FROM sources) AS errors, count(DISTINCT channel) AS channels, count(*) AS clips, round(sum(duration) / 3600, 4) AS hours FROM {ONCE}")
def corpus_counts(spark: SparkSession, sf: str) -> DataFrame:
    return report.corpus_counts(table(spark, sf, "clips").filter("id is not null").dropDuplicates(["id"]), table(spark, sf, "sources"))


@query(f"""SELECT s.id, s.path, s.channel, coalesce(n, 0) AS n_clips, round(coalesce(sec, 0), 3) AS clip_sec, CASE WHEN error IS NOT NULL THEN 'decode_failure' WHEN coalesce(n, 0) > 0 THEN 'clips' WHEN id % 3 = 0 THEN 'no_asr_words' ELSE 'no_clips' END AS status FROM sources s LEFT JOIN (SELECT source_id, count(*) AS n, sum(duration) AS sec FROM {ONCE} GROUP BY 1) c ON c.source_id = s.id""")
def source_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """The tables know no word counts, so those of every third recording are planted as 0."""
    sources = table(spark, sf, "sources").withColumn("meta_json", F.format_string('{"n_words": %d}', F.col("id") % 3))
    return report.source_ledger(sources, table(spark, sf, "clips").filter("id is not null").dropDuplicates(["id"]))


@query(f"""SELECT c.source_id, count(*) AS n_clips, round(60.0 * sum(len(string_split_regex(trim(text), '\\s+'))) / nullif(sum(c.duration), 0), 3) AS words_per_min, round(100.0 * sum(c.duration) / nullif(any_value(s.duration), 0), 3) AS yield_pct FROM {ONCE} c JOIN sources s ON s.id = c.source_id GROUP BY 1""".replace("\\\\", "\\"))
def source_yield(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "clips").filter("id is not null").dropDuplicates(["id"])
    return report.source_yield(table(spark, sf, "sources"), c, F.size(F.split(F.trim("text"), r"\s+")))


VERDICTS, TAGS = ["temiz", "kusurlu", "bozuk"], ["gurultu", "muzik", "kesik"]


@query(f"""WITH n AS (SELECT c.channel, n.* FROM {NOTES} n JOIN {ONCE} c ON c.id = n.clip_id)
    SELECT CASE WHEN grouping(channel) = 1 THEN 'TOTAL' ELSE channel END AS channel, count(*) AS n, {", ".join(f"count(*) FILTER (verdict = '{v}') AS v_{v}" for v in VERDICTS)}, {", ".join(f"count(*) FILTER (list_contains(tags, '{t}')) AS t_{t}" for t in TAGS)} FROM n GROUP BY ROLLUP (channel)""")
def findings_pivot(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "clips").filter("id is not null").dropDuplicates(["id"]).select(F.col("id").alias("clip_id"), "channel")
    return report.findings(notes(spark, sf).join(c, "clip_id"), VERDICTS, TAGS)


@query(f"""SELECT coalesce(s.channel, c.channel, n.channel) AS channel, coalesce(sources, 0) AS sources, coalesce(errors, 0) AS errors, coalesce(source_hours, 0) AS source_hours, coalesce(clips, 0) AS clips, coalesce(segmented, 0) AS segmented, coalesce(noted, 0) AS noted
    FROM (SELECT channel, count(*) AS sources, count(error) AS errors, round(sum(duration) / 3600, 4) AS source_hours FROM sources WHERE channel IS NOT NULL GROUP BY 1) s FULL JOIN (SELECT channel, count(*) AS clips, count(DISTINCT source_id) AS segmented FROM {ONCE} WHERE channel IS NOT NULL GROUP BY 1) c ON s.channel = c.channel
    FULL JOIN (SELECT channel, count(DISTINCT clip_id) AS noted FROM notes WHERE channel IS NOT NULL GROUP BY 1) n ON n.channel = coalesce(s.channel, c.channel)""")
def channel_summary(spark: SparkSession, sf: str) -> DataFrame:
    named = lambda d: d.filter("channel is not null")
    return report.channel_summary(named(table(spark, sf, "sources")), named(table(spark, sf, "clips").filter("id is not null").dropDuplicates(["id"])), named(table(spark, sf, "notes")))


BAND = "CASE WHEN duration < 30 THEN '<30' WHEN duration < 60 THEN '30-60' WHEN duration < 120 THEN '60-120' WHEN duration >= 120 THEN '>=120' END"


@query(f"SELECT ext, {BAND} AS band, count(*) AS n, round(sum(duration) / 3600, 4) AS hours, CAST(sum(bytes) AS BIGINT) AS bytes, round(100.0 * round(sum(duration) / 3600, 4) / sum(round(sum(duration) / 3600, 4)) OVER (), 4) AS pct FROM sources GROUP BY ext, band")
def inventory(spark: SparkSession, sf: str) -> DataFrame:
    return report.inventory(table(spark, sf, "sources"), stats.bands(F.col("duration"), [30, 60, 120]))


@query("SELECT CASE WHEN grouping(channel) = 1 THEN 'TOTAL' ELSE channel END AS channel, count(*) AS n, round(sum(coalesce(duration, 0)) / 3600, 4) AS hours, round(sum(least(coalesce(duration, 0), 60.0)) / 3600, 4) AS capped_hours FROM sources GROUP BY ROLLUP (channel)")
def dry_run(spark: SparkSession, sf: str) -> DataFrame:
    return report.dry_run(table(spark, sf, "sources"), 60.0)
