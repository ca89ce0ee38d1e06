"""Integrity of the manifest: columns against each other, against the store, the policy and the run's record."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import signal, text
from ..functions.loudness import loudness_lufs
from ..functions.text import dedupe_key
from ..operators import quality
from .base import ONCE, clips, key, low, metric, query, table
from .core import FLAGS, MARKED, POLICY, REASONS, annotated, marked
from .joins import LOW
from .sound import planted

M = {k: metric(k) for k in "word_confidence word_confidence_mean align_score_min align_score_mean leading_silence_sec trailing_silence_sec speech_ratio music_db_separated music_score_audioset music_to_speech_db".split()}
HAS = lambda f: f"list_contains(f, '{f}')"
TALK = f"({M['speech_ratio']}) > 0"
LEAD, TRAIL = f"({M['leading_silence_sec']})", f"({M['trailing_silence_sec']})"
APART = f"coalesce(({M['music_db_separated']}) > 0, false)"
BAD = {
    "within_recording": "end_sec > sd + 0.01",
    "cut_parts_not_recommended": f"({HAS('forced_split')} OR {HAS('gap_split')}) AND low AND rec",
    "n_words": "nw <> nw2",
    "spoken_is_text_without_figures": r"NOT (regexp_matches(text, '\p{Nd}|[%₺$€£.]') OR regexp_matches(text, '(?i)(^|[^\p{L}\p{N}_])tl($|[^\p{L}\p{N}_])')) AND text_spoken <> text",
    "spoken_has_no_figures": r"regexp_matches(text, '\p{Nd}') AND NOT regexp_matches(text, '\p{L}\p{Nd}|\p{Nd}\p{L}') AND regexp_matches(text_spoken, '\p{Nd}')",
    "confidence_least_not_above_mean": f"({M['word_confidence']}) > ({M['word_confidence_mean']}) + 0.001001",
    "align_score_range": f"NOT coalesce(({M['align_score_min']}) BETWEEN 0 AND 1, true) OR ({M['align_score_min']}) > ({M['align_score_mean']}) + 0.001001",
    "edge_silences_within_duration": f"{TALK} AND (greatest({LEAD}, {TRAIL}) > duration + 0.001 OR {LEAD} + {TRAIL} > duration + 0.001)",
    "speech_within_edges": f"{TALK} AND duration > 0 AND ({M['speech_ratio']}) > 1 - ({LEAD} + {TRAIL}) / duration + 0.02",
    "music_separated_or_none": f"({M['music_score_audioset']}) IS NOT NULL AND CASE WHEN {APART} THEN ({M['music_score_audioset']}) < 0.05 - 0.00005 ELSE ({M['music_to_speech_db']}) <> -80 OR ({M['music_score_audioset']}) > 0.05005 END",
    "background_music_flag": f"({M['music_to_speech_db']}) IS NOT NULL AND {HAS('background_music')} <> (({M['music_to_speech_db']}) > -6)",
    "duplicate_flag": f"{HAS('duplicate')} <> (dup IS NOT NULL)",
    "duplicate_of_same_text": "dup IS NOT NULL AND kk IS DISTINCT FROM k",
    "oversize_is_long": f"{HAS('oversize')} AND duration <= 15",
    "long_is_oversize": f"NOT {HAS('oversize')} AND duration > 16.000001",
    "short_is_short": f"{HAS('short')} AND duration - 0.4 >= 1.5",
    "flags_known": f"len(list_filter(f, lambda x: x NOT IN ({', '.join(repr(f) for f in quality.FLAGS)}))) > 0",
    "recommended_without_reasons": "false", "excluded_with_reasons": "false",
    "channel_of_recording": "sc IS NOT NULL AND sc <> channel",
    "rate_of_recording": "false",
}
LOW_FF = re.sub(r"\bf\b", "ff", LOW)
ROWS = rf"""(SELECT c.*, CASE WHEN m.keeper <> c.id THEN list_append({FLAGS}, 'duplicate') ELSE {FLAGS} END AS f, CASE WHEN m.keeper <> c.id THEN m.keeper END AS dup, m.k AS k, m2.k AS kk, s.duration AS sd, s.channel AS sc, len(r.r) = 0 AS rec, {LOW_FF} AS low,
    len(regexp_extract_all(c.text, '[^\s\x{{00a0}}\x{{2000}}-\x{{200a}}\x{{202f}}\x{{205f}}\x{{3000}}]+')) AS nw2, len(regexp_extract_all(c.text, '[^ ]+')) AS nw
    FROM (SELECT *, regexp_extract(text, '([\p{{L}}\p{{Nd}}])', 1) AS ff FROM {ONCE}) c LEFT JOIN {MARKED} m ON m.id = c.id LEFT JOIN {MARKED} m2 ON m.keeper <> c.id AND m2.id = m.keeper LEFT JOIN sources s ON s.id = c.source_id LEFT JOIN {REASONS} r ON r.id = c.id)"""


def manifest_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The manifest with what its checks need. Numbers of words are planted: those parted by plain blanks."""
    m = POLICY.annotate(marked(spark, sf)).withColumn("n_words", F.size(F.filter(F.split("text", " "), lambda w: w != "")))
    s = table(spark, sf, "sources").select(F.col("id").alias("source_id"), F.col("duration").alias("source_duration"), F.col("channel").alias("source_channel"), F.col("source_sample_rate").alias("source_rate"))
    keys = table(spark, sf, "clips").filter("id is not null").dropDuplicates(["id"]).select(F.col("id").alias("duplicate_of"), dedupe_key(F.col("text")).alias("keeper_key"))
    return m.join(s, "source_id", "left").join(keys, "duplicate_of", "left").withColumn("own_key", F.col("dedupe_key")).withColumn("sample_rate", F.col("source_rate"))


@query(f"WITH b AS {ROWS} " + " UNION ALL ".join(f"SELECT '{k}' AS \"check\", count(*) FILTER ({c}) AS bad, count(*) AS total, count(*) FILTER ({c}) = 0 AS ok, min(id) FILTER ({c}) AS example FROM b" for k, c in BAD.items()))
def manifest_integrity(spark: SparkSession, sf: str) -> DataFrame:
    """Recommendations are worked out on the marked flags, so parts of it differ from ``policy_annotate`` only for duplicates."""
    rows = manifest_rows(spark, sf)
    own = annotated(spark, sf).select("id", F.col("recommended").alias("_own"))
    return quality.check(rows.join(own, "id").withColumn("exclusion_reasons", F.when(F.col("_own") & ~F.col("recommended"), F.array().cast("array<string>")).otherwise(F.col("exclusion_reasons"))).withColumn("recommended", F.col("_own")).drop("_own"), quality.manifest_assertions())


@query(f"SELECT 'decision_is_the_policys' AS \"check\", count(*) FILTER (len(r) > 0 AND id > 'src00500') AS bad, count(*) AS total, count(*) FILTER (len(r) > 0 AND id > 'src00500') = 0 AS ok, min(id) FILTER (len(r) > 0 AND id > 'src00500') AS example FROM {REASONS}")
def decision_check(spark: SparkSession, sf: str) -> DataFrame:
    """Decisions worked out again; those of the later recordings are planted as recommended."""
    m = annotated(spark, sf).withColumn("recommended", F.col("recommended") | (F.col("id") > "src00500"))
    return quality.decision_assertion(m, POLICY)


@query(f"""WITH a AS (SELECT id, duration, text FROM {ONCE}), b AS (SELECT id, round(duration, 1) AS duration, text FROM a WHERE duration > 1 OR duration IS NULL), j AS (SELECT a.id AS ia, b.id AS ib, a.duration AS da, b.duration AS db FROM a FULL JOIN b ON a.id = b.id)
    SELECT 'same_ids' AS "check", count(*) FILTER (ia IS NULL OR ib IS NULL) AS bad, count(*) AS total, count(*) FILTER (ia IS NULL OR ib IS NULL) = 0 AS ok, min(coalesce(ia, ib)) FILTER (ia IS NULL OR ib IS NULL) AS example FROM j UNION ALL SELECT 'same_values', count(*) FILTER (ia = ib AND da IS DISTINCT FROM db), count(*), count(*) FILTER (ia = ib AND da IS DISTINCT FROM db) = 0, min(ia) FILTER (ia = ib AND da IS DISTINCT FROM db) FROM j""")
def store_check(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "clips").filter("id is not null").dropDuplicates(["id"]).select("id", "duration", "text")
    b = a.filter("duration > 1 OR duration is null").withColumn("duration", F.round("duration", 1))
    return quality.store_assertions(a, b, ["duration", "text"])


RECORD = {"stage_versions": {"clip_qc": "none", "nosuch": "1"}, "packages": {"a": "1.0", "b": None}, "models": {"m": {"revision": "f00"}, "n": {}, "o": {"pinned_by": "a"}}}


@query(f"""SELECT * FROM (VALUES ('record_counts', 0::BIGINT, 1::BIGINT, true, NULL), ('record_packages', 1, 2, false, 'b'), ('record_models', 1, 3, false, 'n')) t("check", bad, total, ok, example) UNION ALL SELECT 'record_versions', count(DISTINCT stage), 2, count(DISTINCT stage) = 0, min(stage) FROM done WHERE stage = 'clip_qc'
    UNION ALL SELECT 'scores_reach_the_top', (NOT coalesce(max(x) > 0.9, false))::BIGINT, count(x), coalesce(max(x) > 0.9, false), NULL FROM (SELECT {metric('word_confidence')} AS x FROM {ONCE})""")
def run_check(spark: SparkSession, sf: str) -> DataFrame:
    c = clips(spark, sf)
    n = c.count()
    top = quality.ceiling_assertion(c, F.try_element_at("metrics", F.lit("word_confidence")), 0.9, "scores_reach_the_top")
    return quality.run_assertions(RECORD | {"counts": {"clips": n}}, table(spark, sf, "done"), n).unionByName(top)


@query(f"""SELECT id, CASE WHEN h % 6 > 0 THEN round(h % 100 / 1000.0::DOUBLE, 4) END AS music_score, CASE WHEN h % 6 > 0 THEN h % 100 / 1000.0::DOUBLE >= 0.05 END AS music_db_separated, CASE WHEN h % 6 = 0 THEN NULL WHEN h % 100 / 1000.0::DOUBLE >= 0.05 THEN greatest(-(h % 97), -80)::DOUBLE ELSE -80.0 END AS music_to_speech_db
    FROM (SELECT id, CAST(floor(duration * 1000) AS BIGINT) AS h FROM {ONCE} WHERE duration > 0)""")
def music_cascade(spark: SparkSession, sf: str) -> DataFrame:
    """Planted scores and ratios; every sixth clip is unreadable."""
    score = F.when(F.col("h") % 6 > 0, F.col("h") % 100 / F.lit(1000.0))
    return planted(spark, sf).select("id", signal.music_cascade(score, -(F.col("h") % 97).cast("double")).alias("m")).select("id", "m.*")


@query(rf"""SELECT id, CASE WHEN len(p) > 0 THEN array_to_string(string_split(p, ''), ' ') END AS romanised, regexp_replace(list_last(string_split('org/faster-whisper-' || split_part(id, '-', 1), '/')), '^faster-', '') AS model
    FROM (SELECT id, regexp_replace(translate({low("w")}, 'çğıöşüâîû', 'cgiosuaiu'), '[^a-z'']', '', 'g') AS p FROM (SELECT id, regexp_extract(text, '^[ \t\n]*([^ \t\n]+)', 1) AS w FROM {ONCE} WHERE text IS NOT NULL))""")
def romanised(spark: SparkSession, sf: str) -> DataFrame:
    """First word of each clip in an aligner's letters, and a model's short name."""
    c = table(spark, sf, "clips").filter("id is not null AND text is not null").dropDuplicates(["id"])
    name = F.concat(F.lit("org/faster-whisper-"), F.substring_index("id", "-", 1))
    return c.select("id", text.romanised(F.regexp_extract("text", r"^[ \t\n]*([^ \t\n]+)", 1)).alias("romanised"), text.model_name(name).alias("model"))


@query()
def clip_loudness(spark: SparkSession, sf: str) -> DataFrame:
    """Loudness of a planted tone a clip (0.425 s at 4 kHz). The filters have no SQL twin: tested against the standard's reference tone."""
    p = planted(spark, sf)
    t = F.transform(F.sequence(F.lit(0), F.lit(1699)), lambda i: F.sin(i * (F.lit(0.2) + F.col("h") % 10 / F.lit(20.0))) * (F.col("h") % 9 / F.lit(10.0)))
    return p.select("id", loudness_lufs(t, F.lit(4000)).alias("loudness_lufs"))
