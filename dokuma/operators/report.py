"""Reports over clips, recordings, notes and the ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .stats import share

# Former names of verdicts.
VERDICTS = {"iyi": "temiz", "kotu": "bozuk", "kötü": "bozuk", "orta": "kusurlu"}


def recode(c: Column, names: dict[str, str]) -> Column:
    """Old names to new ones; others stay."""
    m = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    return F.coalesce(F.try_element_at(m, c), c)


def latest_notes(notes: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """The last note of each clip by time (then arrival, verdict and text), verdicts under their present names. One aggregation with map-side combine."""
    order = F.struct("ts", "received_at", F.coalesce("verdict", F.lit("")).alias("v"), F.coalesce("note", F.lit("")).alias("n"))
    best = notes.filter("clip_id is not null").groupBy("clip_id").agg(F.max_by(F.struct("ts", "verdict", "tags", "note"), order).alias("r"))
    return best.select("clip_id", F.col("r.ts").alias("ts"), recode(F.col("r.verdict"), VERDICTS if names is None else names).alias("verdict"), F.col("r.tags").alias("tags"), F.col("r.note").alias("note"))


def corpus_counts(clips: DataFrame, sources: DataFrame) -> DataFrame:
    """One row of corpus counters."""
    s = sources.agg(F.count("*").alias("sources"), F.count("error").alias("errors"))
    c = clips.agg(F.countDistinct("channel").alias("channels"), F.count("*").alias("clips"), F.round(F.sum("duration") / 3600, 4).alias("hours"))
    return s.crossJoin(c)  # one row each


def by_channel(clips: DataFrame) -> DataFrame:
    """(channel, clips, recordings, hours, share of all hours in percent)."""
    g = clips.groupBy("channel").agg(F.count("*").alias("clips"), F.countDistinct("source_id").alias("sources"), F.sum("duration").alias("_s"))
    total = g.agg(F.sum("_s").alias("_t"))
    return g.crossJoin(F.broadcast(total)).select("channel", "clips", "sources", F.round(F.col("_s") / 3600, 4).alias("hours"), share(F.col("_s"), F.col("_t"), 4).alias("pct"))  # total: one row


def source_ledger(sources: DataFrame, clips: DataFrame) -> DataFrame:
    """Each recording with its clip count and status; one whose ``meta_json`` says that no words were recognised is told from others without clips."""
    n = clips.groupBy("source_id").agg(F.count("*").alias("n_clips"), F.sum("duration").alias("clip_sec"))
    j = sources.join(n, sources["id"] == n["source_id"], "left").withColumn("n_clips", F.coalesce("n_clips", F.lit(0)))
    status = F.when(F.col("error").isNotNull(), "decode_failure").when(F.col("n_clips") > 0, "clips").when(F.get_json_object("meta_json", "$.n_words").try_cast("double") == 0, "no_asr_words").otherwise("no_clips")
    return j.select("id", "path", "channel", "n_clips", F.round(F.coalesce("clip_sec", F.lit(0.0)), 3).alias("clip_sec"), status.alias("status"))


def with_speakers(clips: DataFrame, clusters: DataFrame, sources: DataFrame) -> DataFrame:
    """Clips with the speaker cluster of their recording (source_id, cluster) and its consistency out of the recording's meta; null where either is unknown."""
    meta = sources.select(F.col("id").alias("source_id"), F.get_json_object("meta_json", "$.speaker_consistency").try_cast("double").alias("speaker_consistency"))
    return clips.join(clusters.select("source_id", F.col("cluster").alias("speaker_cluster")), "source_id", "left").join(meta, "source_id", "left")


def broken_by_flag(clips: DataFrame) -> DataFrame:
    """(flag, n, lower_start, no_end, both): broken ends of the clips with each flag; those without any under ''."""
    from ..functions.text import has_sentence_end, is_lower_start

    low, end = is_lower_start(F.col("text")), has_sentence_end(F.col("text"))
    f = F.explode(F.when(F.size("flags") > 0, F.array_distinct("flags")).otherwise(F.array(F.lit(""))))
    marked = clips.select(low.alias("low"), (~end).alias("open"), "flags").select("low", "open", f.alias("flag"))
    return marked.groupBy("flag").agg(F.count("*").alias("n"), F.count_if("low").alias("lower_start"), F.count_if("open").alias("no_end"), F.count_if(F.col("low") & F.col("open")).alias("both"))


def broken_clips(clips: DataFrame) -> DataFrame:
    """(id, cut, text) of clips that begin ("bas") or end ("son") within a sentence, or both ("iki")."""
    from ..functions.text import has_sentence_end, is_lower_start

    c = clips.select("id", "text", is_lower_start(F.col("text")).alias("low"), (~has_sentence_end(F.col("text"))).alias("open")).filter("low OR open")
    return c.select("id", F.when(F.col("low") & F.col("open"), "iki").when(F.col("low"), "bas").otherwise("son").alias("cut"), "text")


def odd_values(rows: DataFrame, group: str, value: str, factor: float) -> DataFrame:
    """Rows whose value is more than ``factor`` times their group's median, or less than its ``factor``-th part."""
    from .stats import linear_percentiles

    m = linear_percentiles(rows, [group], value, {"_median": 0.5}).select(F.col(group).alias("_g"), "_median")
    j = rows.join(m, F.col(group).eqNullSafe(F.col("_g")))
    return j.filter((F.col(value) > factor * F.col("_median")) | (F.col(value) < F.col("_median") / factor)).select(*rows.columns)


def error_rates(rows: DataFrame, group: str, rate: str, above: float = 0.1) -> DataFrame:
    """(group, n, mean, median, p90, above_pct) of an error rate by group; rows without a rate are left out."""
    from .stats import linear_percentiles

    d = rows.filter(F.col(rate).isNotNull())
    m = d.groupBy(group).agg(F.round(F.avg(rate), 6).alias("mean"), F.round(100 * F.avg((F.col(rate) > above).cast("int")), 3).alias("above_pct"))
    q = linear_percentiles(d, [group], rate, {"median": 0.5, "p90": 0.9})
    return q.alias("q").join(m.alias("m"), F.col(f"q.{group}").eqNullSafe(F.col(f"m.{group}"))).select(F.col(f"q.{group}").alias(group), "n", "mean", F.round("median", 6).alias("median"), F.round("p90", 6).alias("p90"), "above_pct")


def source_yield(sources: DataFrame, clips: DataFrame, words: Column) -> DataFrame:
    """Per recording: clips, words per minute and the share of its time in clips."""
    c = clips.withColumn("_w", words).groupBy("source_id").agg(F.count("*").alias("n_clips"), F.sum("duration").alias("s"), F.sum("_w").alias("w"))
    return c.join(sources.select(F.col("id").alias("source_id"), F.col("duration").alias("total")), "source_id").select("source_id", "n_clips", F.round(F.try_divide(60.0 * F.col("w"), F.col("s")), 3).alias("words_per_min"), share(F.col("s"), F.col("total"), 3).alias("yield_pct"))


def findings(noted: DataFrame, verdicts: list[str], tags: list[str]) -> DataFrame:
    """Pivot of channels by verdicts and tags, with a TOTAL row: one rollup."""
    v = [F.count_if(F.col("verdict") == x).alias(f"v_{x}") for x in verdicts]
    t = [F.count_if(F.array_contains("tags", x)).alias(f"t_{x}") for x in tags]
    r = noted.rollup("channel").agg(F.grouping("channel").alias("_g"), F.count("*").alias("n"), *v, *t)
    return r.select(F.when(F.col("_g") == 1, "TOTAL").otherwise(F.col("channel")).alias("channel"), "n", *[f"v_{x}" for x in verdicts], *[f"t_{x}" for x in tags])


def channel_summary(sources: DataFrame, clips: DataFrame, notes: DataFrame) -> DataFrame:
    """Per channel: recordings, errors, hours, clips, noted clips; each side is aggregated before the join."""
    s = sources.groupBy("channel").agg(F.count("*").alias("sources"), F.count("error").alias("errors"), F.round(F.sum("duration") / 3600, 4).alias("source_hours"))
    c = clips.groupBy("channel").agg(F.count("*").alias("clips"), F.countDistinct("source_id").alias("segmented"))
    n = notes.groupBy("channel").agg(F.countDistinct("clip_id").alias("noted"))
    j = s.join(c, "channel", "full_outer").join(n, "channel", "full_outer")
    return j.select("channel", *[F.coalesce(x, F.lit(0)).alias(x) for x in ("sources", "errors")], F.coalesce("source_hours", F.lit(0.0)).alias("source_hours"), *[F.coalesce(x, F.lit(0)).alias(x) for x in ("clips", "segmented", "noted")])


def stage_summary(done: DataFrame) -> DataFrame:
    """Per kind and stage: marked items and versions in use."""
    from .ledger import latest_marks

    return latest_marks(done).groupBy("kind", "stage").agg(F.count("*").alias("items"), F.countDistinct("version").alias("versions"))


def stages_by_item(done: DataFrame, kind: str) -> DataFrame:
    """Stages done of each item, sorted and joined."""
    return done.filter(F.col("kind") == kind).groupBy("item_key").agg(F.array_join(F.array_sort(F.collect_set("stage")), ",").alias("stages"))


def inventory(sources: DataFrame, bands: Column) -> DataFrame:
    """Recordings by extension and length band: count, hours, bytes and share of hours."""
    g = sources.groupBy("ext", bands.alias("band")).agg(F.count("*").alias("n"), F.round(F.sum("duration") / 3600, 4).alias("hours"), F.sum("bytes").alias("bytes"))
    return g.withColumn("pct", share(F.col("hours"), F.sum("hours").over(Window.partitionBy()), 4))


def dry_run(sources: DataFrame, cap_sec: float) -> DataFrame:
    """Recordings, raw and capped hours per channel, with a TOTAL row."""
    d = F.coalesce("duration", F.lit(0.0))
    r = sources.rollup("channel").agg(F.grouping("channel").alias("_g"), F.count("*").alias("n"), F.round(F.sum(d) / 3600, 4).alias("hours"), F.round(F.sum(F.least(d, F.lit(cap_sec))) / 3600, 4).alias("capped_hours"))
    return r.select(F.when(F.col("_g") == 1, "TOTAL").otherwise(F.col("channel")).alias("channel"), "n", "hours", "capped_hours")


def human_size(n: Column) -> Column:
    """Bytes as text with a unit."""
    out = F.format_string("%.1f GB", n / 1e9)
    return F.when(n < 1000, F.format_string("%d B", n.cast("long"))).when(n < 1e6, F.format_string("%.1f kB", n / 1e3)).when(n < 1e9, F.format_string("%.1f MB", n / 1e6)).otherwise(out)


def clock(seconds: Column) -> Column:
    """Seconds as h:mm:ss."""
    s = F.round(seconds).cast("long")
    return F.format_string("%d:%02d:%02d", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60)
