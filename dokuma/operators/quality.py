"""Data-quality assertions: each is a predicate of bad rows; a family is counted in one aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def check(df: DataFrame, assertions: dict[str, Column], id_col: str = "id") -> DataFrame:
    """(check, bad, total, ok, example): bad rows of each assertion (a predicate that is true for bad rows; null counts as good), and the least bad id."""
    aggs = [F.count("*").alias("_n")]
    for i, bad in enumerate(assertions.values()):
        aggs += [F.count_if(F.coalesce(bad, F.lit(False))).alias(f"b{i}"), F.min(F.when(bad, F.col(id_col).cast("string"))).alias(f"e{i}")]
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(name).alias("check"), F.col(f"b{i}").alias("bad"), F.col("_n").alias("total"), (F.col(f"b{i}") == 0).alias("ok"), F.col(f"e{i}").alias("example")) for i, name in enumerate(assertions)]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def outside(c: Column, lo: float, hi: float) -> Column:
    """Present and not within lo..hi."""
    return c.isNotNull() & ~((c >= lo) & (c <= hi))


def clip_assertions(metrics: str = "metrics", tolerance: float = 0.002) -> dict[str, Column]:
    """Invariants of single clips."""
    m = lambda k: F.try_element_at(F.col(metrics), F.lit(k))
    return {
        "id_form": ~F.col("id").rlike(r"^src\d{5}-\d{5}$"),
        "id_names_source": F.col("source_id").isNotNull() & ~F.col("id").startswith(F.format_string("src%05d-", F.col("source_id"))),
        "duration_is_end_minus_start": F.abs(F.col("duration") - (F.col("end_sec") - F.col("start_sec"))) > tolerance,
        "duration_positive": F.col("duration") <= 0,
        "text_present": F.coalesce(F.trim("text") == "", F.lit(True)),
        "speech_ratio_range": outside(m("speech_ratio"), 0.0, 1.0),
        "word_confidence_range": outside(m("word_confidence"), 0.0, 1.0),
        "dnsmos_range": outside(m("dnsmos_ovrl"), 1.0, 5.0),
        "silence_within_duration": m("internal_silence_sec") > F.col("duration") + tolerance,
        "peak_not_below_rms": m("peak_dbfs") < m("rms_dbfs"),
        "music_db_floor": m("music_to_speech_db") < -80,
    }


FLAGS = ("forced_split", "gap_split", "short", "oversize", "background_music", "duplicate", "boilerplate", "unreadable_audio")


def manifest_assertions(least_sec: float = 1.5, most_sec: float = 15.0, pads_sec: float = 1.0, music_db: float = -6.0, metrics: str = "metrics") -> dict[str, Column]:
    """Invariants between the columns of a manifest row: text, texts as read, flags, measurements and decision. Columns: those of ``schema.MANIFEST`` and n_words, keeper_key, own_key
    (comparison keys of the kept and the own text), source_duration, source_rate, sample_rate, source_channel."""
    from ..functions.text import is_lower_start

    m = lambda k: F.try_element_at(F.col(metrics), F.lit(k))
    has = lambda f: F.array_contains(F.coalesce("flags", F.array().cast("array<string>")), F.lit(f))
    words = F.size(F.filter(F.split("text", r"(?U)\s+"), lambda w: w != ""))
    cut = has("forced_split") | has("gap_split")
    lead, trail, ratio = m("leading_silence_sec"), m("trailing_silence_sec"), m("speech_ratio")
    talk = ratio > 0
    apart = F.coalesce(m("music_db_separated") > 0, F.lit(False))
    return {
        "within_recording": F.col("end_sec") > F.col("source_duration") + 0.01,
        "cut_parts_not_recommended": cut & is_lower_start(F.col("text")) & F.col("recommended"),
        "n_words": F.col("n_words") != words,
        "spoken_is_text_without_figures": ~F.col("text").rlike(r"\p{Nd}|[%₺$€£.]|(?iu)\btl\b") & (F.col("text_spoken") != F.col("text")),
        "spoken_has_no_figures": F.col("text").rlike(r"\p{Nd}") & ~F.col("text").rlike(r"\p{L}\p{Nd}|\p{Nd}\p{L}") & F.col("text_spoken").rlike(r"\p{Nd}"),
        "confidence_least_not_above_mean": m("word_confidence") > m("word_confidence_mean") + 1e-3 + 1e-6,
        "align_score_range": outside(m("align_score_min"), 0.0, 1.0) | (m("align_score_min") > m("align_score_mean") + 1e-3 + 1e-6),
        "edge_silences_within_duration": talk & ((F.greatest(lead, trail) > F.col("duration") + 1e-3) | (lead + trail > F.col("duration") + 1e-3)),
        "speech_within_edges": talk & (F.col("duration") > 0) & (ratio > 1 - (lead + trail) / F.col("duration") + 0.02),
        "music_separated_or_none": m("music_score_audioset").isNotNull() & F.when(apart, m("music_score_audioset") < 0.05 - 5e-5).otherwise((m("music_to_speech_db") != -80) | (m("music_score_audioset") > 0.05 + 5e-5)),
        "background_music_flag": m("music_to_speech_db").isNotNull() & (has("background_music") != (m("music_to_speech_db") > music_db)),
        "duplicate_flag": has("duplicate") != F.col("duplicate_of").isNotNull(),
        "duplicate_of_same_text": F.col("duplicate_of").isNotNull() & ~F.col("keeper_key").eqNullSafe(F.col("own_key")),
        "oversize_is_long": has("oversize") & (F.col("duration") <= most_sec),
        "long_is_oversize": ~has("oversize") & (F.col("duration") > most_sec + pads_sec + 1e-6),
        "short_is_short": has("short") & (F.col("duration") - 0.4 >= least_sec),
        "flags_known": F.size(F.array_except(F.coalesce("flags", F.array().cast("array<string>")), F.array(*[F.lit(f) for f in FLAGS]))) > 0,
        "recommended_without_reasons": F.col("recommended") & (F.size("exclusion_reasons") > 0),
        "excluded_with_reasons": ~F.col("recommended") & (F.size("exclusion_reasons") == 0),
        "channel_of_recording": F.col("source_channel").isNotNull() & (F.col("source_channel") != F.col("channel")),
        "rate_of_recording": F.col("sample_rate") != F.col("source_rate"),
    }


def decision_assertion(manifest: DataFrame, policy) -> DataFrame:  # noqa: ANN001
    """(check, bad, total, ok, example): rows whose decision differs from the policy's, worked out again."""
    again = policy.annotate(manifest.withColumnsRenamed({"exclusion_reasons": "_r", "recommended": "_ok", "policy_version": "_v"}))
    differs = ~(F.array_sort("exclusion_reasons").eqNullSafe(F.array_sort("_r")) & F.col("recommended").eqNullSafe(F.col("_ok")) & F.col("policy_version").eqNullSafe(F.col("_v")))
    return check(again, {"decision_is_the_policys": differs})


def store_assertions(store: DataFrame, manifest: DataFrame, columns: list[str], key: str = "id") -> DataFrame:
    """(check, bad, total, ok, example): ids in one of the tables only, and rows with another value in any of the columns."""
    one = manifest.select(key, F.struct(*columns).alias("_m")).join(store.select(key, F.struct(*columns).alias("_s")), key, "full")
    return check(one, {"same_ids": F.col("_m").isNull() | F.col("_s").isNull(), "same_values": F.col("_m").isNotNull() & F.col("_s").isNotNull() & ~F.col("_m").eqNullSafe(F.col("_s"))}, key)


def ceiling_assertion(df: DataFrame, value: Column, least: float, name: str, least_rows: int = 1) -> DataFrame:
    """(check, bad, total, ok, example): whether a measurement reaches ``least`` anywhere; a scale that is off does not. No values at all are bad, unless there are fewer than ``least_rows`` rows."""
    one = df.agg(F.max(value).alias("m"), F.count(value).alias("n"), F.count("*").alias("all"))
    bad = (F.col("all") >= least_rows) & ~F.coalesce(F.col("m") > least, F.lit(False))
    return one.select(F.lit(name).alias("check"), bad.cast("long").alias("bad"), F.col("n").alias("total"), (~bad).alias("ok"), F.lit(None).cast("string").alias("example"))


def run_assertions(record: dict, done: DataFrame, rows: int) -> DataFrame:
    """(check, bad, total, ok, example): a run record against the ledger and the manifest: number of clips, versions of the stages that have marks, resolved packages, pinned models."""
    spark = done.sparkSession
    found = {r.stage: r.versions for r in done.groupBy("stage").agg(F.collect_set("version").alias("versions")).collect()}  # a row a stage
    stages = record.get("stage_versions", {})
    versions = sorted(s for s, v in stages.items() if s in found and found[s] != [v])
    packages = sorted(k for k, v in record.get("packages", {}).items() if v is None)
    models = sorted(k for k, v in record.get("models", {}).items() if not v.get("revision") and not v.get("pinned_by"))
    counts = [] if record.get("counts", {}).get("clips") == rows else ["clips"]
    out = [("record_counts", counts, 1), ("record_versions", versions, len(stages)), ("record_packages", packages, len(record.get("packages", {}))), ("record_models", models, len(record.get("models", {})))]
    return spark.createDataFrame([(n, len(b), t, not b, b[0] if b else None) for n, b, t in out], "check string, bad long, total long, ok boolean, example string")


def order_assertions(df: DataFrame, group: str = "source_id", tolerance: float = 0.001) -> DataFrame:
    """(check, bad): clips out of sequence and clips that overlap the next one of their recording."""
    w = Window.partitionBy(group).orderBy("idx")
    n = df.filter(F.col(group).isNotNull()).withColumn("_next_idx", F.lead("idx").over(w)).withColumn("_next_start", F.lead("start_sec").over(w))
    one = n.agg(F.count_if(F.col("_next_idx") != F.col("idx") + 1).alias("a"), F.count_if(F.col("_next_start") < F.col("end_sec") - tolerance).alias("b"))
    return one.select(F.explode(F.array(F.struct(F.lit("idx_contiguous").alias("check"), F.col("a").alias("bad")), F.struct(F.lit("no_overlap").alias("check"), F.col("b").alias("bad")))).alias("r")).select("r.*")


def unique(df: DataFrame, key: str) -> DataFrame:
    """(key, n): values that occur more than once."""
    return df.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")


def figures(df: DataFrame, expected: dict[str, tuple[Column, float, float]]) -> DataFrame:
    """(figure, expected, found, ok): recomputed aggregates against published values within a tolerance."""
    one = df.agg(*[c.cast("double").alias(f"f{i}") for i, (c, _, _) in enumerate(expected.values())])
    rows = [F.struct(F.lit(k).alias("figure"), F.lit(float(v)).alias("expected"), F.col(f"f{i}").alias("found"), F.coalesce(F.abs(F.col(f"f{i}") - v) <= tol, F.lit(False)).alias("ok")) for i, (k, (_, v, tol)) in enumerate(expected.items())]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def card_figures(card: str, heading: str, found: DataFrame, key: str, columns: list[str], tolerance: float) -> DataFrame:
    """(figure, expected, found, ok): the cells of a card's table (its first column is the key, the header names the others) against a table of the same figures. A cell without a number,
    and a row that isn't found, are wrong."""
    head, *body = table_rows(card, heading)
    cells = [(r[0], c, parse_number(r[head.index(c)])) for r in body for c in columns]
    stated = found.sparkSession.createDataFrame(cells, "k string, c string, expected double")
    long = found.select(F.col(key).alias("k"), F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("found")) for c in columns])).alias("x")).select("k", "x.*")
    j = stated.join(long, ["k", "c"], "left")
    ok = F.coalesce(F.abs(F.col("expected") - F.col("found")) <= tolerance, F.lit(False))
    return j.select(F.concat_ws(": ", "k", "c").alias("figure"), "expected", "found", ok.alias("ok"))


def parse_number(cell: str) -> float | None:
    """A number of a table cell: thousands by comma, percent and unit signs ignored; None where there is none."""
    import re

    m = re.search(r"-?\d[\d,]*(?:\.\d+)?", cell)
    return float(m[0].replace(",", "")) if m else None


def table_rows(markdown: str, heading: str, until: str | None = None) -> list[list[str]]:
    """Cells of the table rows between two headings of a text."""
    lines = markdown.splitlines()
    start = next((i + 1 for i, x in enumerate(lines) if x.lstrip("# ").strip() == heading), len(lines))
    end = next((i for i in range(start, len(lines)) if lines[i].startswith("#") and (until is None or lines[i].lstrip("# ").strip() == until)), len(lines))
    rows = [[c.strip() for c in x.strip().strip("|").split("|")] for x in lines[start:end] if x.strip().startswith("|")]
    return [r for r in rows if not all(set(c) <= {"-", ":", " "} for c in r)]
