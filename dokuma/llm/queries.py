"""The queries of the nine problems over the project's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bags, cap, cross_split, group_split, leakage, lines, near_dup, packing, percentiles, residue

Query = Callable[[SparkSession, str], DataFrame]

CAPACITY = 2048
PERCENTILES = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]
SHARES = {"train": 0.9, "dev": 0.05, "test": 0.05}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _clip_bags(spark: SparkSession, sf: str) -> DataFrame:
    """The text of a clip is text_spoken, or text where that is null or blank."""
    text = F.when(F.regexp_replace("text_spoken", r"(?U)\s+", "") != "", F.col("text_spoken")).otherwise(F.col("text"))
    return bags.bags(table(spark, sf, "clips"), "id", text, 12)


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return near_dup.expand(*near_dup.near_duplicates(_clip_bags(spark, sf), 0.7))


def p1_groups(spark: SparkSession, sf: str) -> DataFrame:
    """One row per clip of 12 words or more: class, links of the class, group."""
    return near_dup.groups(*near_dup.near_duplicates(_clip_bags(spark, sf), 0.7))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    clips = cap.scored_clips(table(spark, sf, "clips"))
    return cap.over_cap(clips, "channel", cap.quality(), share=0.05).select("id")


def p2_strata(spark: SparkSession, sf: str) -> DataFrame:
    """As p2_found, with each channel's cap split over three bands of duration (and none), as all clips fall into them."""
    clips = cap.scored_clips(table(spark, sf, "clips")).withColumn("band", F.when(F.col("duration") < 4, "short").when(F.col("duration") < 9, "middle").when(F.col("duration") >= 9, "long"))
    return cap.over_cap(clips, "channel", cap.quality(), share=0.05, stratum="band", balanced=True).select("id", "channel", "band")


def _cross(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    texts = cross_split.split_bags(table(spark, sf, "clips"), table(spark, sf, "clip_splits"), 12)
    pairs = cross_split.cosine_join(texts, 1.4 / 1.7, jaccard=0.7).filter(F.col("jaccard") >= 0.7 - 1e-12)
    return texts, cross_split.overlaps(texts, pairs)


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    found = _cross(spark, sf)[1]
    return found.select(F.least("held_id", "train_id").alias("id_a"), F.greatest("held_id", "train_id").alias("id_b")).distinct()


def p3_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Per held-out split and channel: clips that a train clip overlaps, and train clips that overlap one."""
    from ..functions.text import channel_key

    found = _cross(spark, sf)[1]
    channels = table(spark, sf, "clips").select(F.col("id").alias("held_id"), channel_key("channel").alias("channel")).filter("held_id is not null").dropDuplicates(["held_id"])
    return found.join(channels, "held_id").groupBy(F.col("held_split").alias("split"), "channel").agg(F.countDistinct("held_id").alias("n_clips"), F.countDistinct("train_id").alias("n_train"))


def p3_weighted(spark: SparkSession, sf: str) -> DataFrame:
    """Held-out and train clips whose vectors of rarity weights, ln(1 + texts / texts with the term), have a cosine of at least 0.8."""
    texts = cross_split.split_bags(table(spark, sf, "clips"), table(spark, sf, "clip_splits"), 12)
    found = cross_split.overlaps(texts, cross_split.cosine_join(texts, 0.8, "idf"))
    return found.select("held_id", "train_id", F.round("cosine", 6).alias("cosine")).distinct()


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return lines.boilerplate(table(spark, sf, "clips"))[1].filter("long").select("id", "line_no").distinct()


def p4_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Boilerplate blocks by channel: their first place (by id and line), number of lines in them, and of their places."""
    blocks, places = lines.boilerplate(table(spark, sf, "clips"))
    first = places.groupBy("channel", "block").agg(F.min(F.struct("id", "line_no")).alias("first"), F.count("*").alias("n_places"))
    sizes = blocks.groupBy("channel", "block").agg(F.count("*").alias("n_lines"), F.count_if("long").alias("n_long"))
    return sizes.join(first, ["channel", "block"]).select("channel", F.col("first.id").alias("first_id"), F.col("first.line_no").alias("first_line"), "n_lines", "n_long", "n_places")


def p4_clean(spark: SparkSession, sf: str) -> DataFrame:
    return lines.cleaned(table(spark, sf, "clips"), lines.boilerplate(table(spark, sf, "clips"))[1])


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    roots = group_split.entity_groups(group_split.named(table(spark, sf, "clips")), "source", "channel")
    return group_split.linked_pairs(roots, "c").select(F.col("a").alias("channel_a"), F.col("b").alias("channel_b"))


def p5_splits(spark: SparkSession, sf: str) -> DataFrame:
    """Each clip with its group and split."""
    return group_split.assign(group_split.named(table(spark, sf, "clips")), "source", "channel", "ms", SHARES).select("id", "group_id", "split")


def p5_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Faults of the splits by kind, and the number of clips in them."""
    from ..session import materialize

    done = materialize(group_split.assign(group_split.named(table(spark, sf, "clips")), "source", "channel", "ms", SHARES), "splits")
    torn = lambda c: done.filter(F.col(c).isNotNull()).groupBy(c).agg(F.countDistinct("split").alias("n")).agg(F.count_if(F.col("n") > 1).alias("n_bad")).select(F.lit(f"{c} in several splits").alias("fault"), "n_bad")
    most = done.groupBy("group_id").agg(F.sum("ms").alias("w")).agg(F.max("w").alias("most"), F.sum("w").alias("all"))
    target = F.create_map(*[F.lit(x) for kv in SHARES.items() for x in kv])[F.col("split")]
    far = done.groupBy("split").agg(F.sum("ms").alias("w")).crossJoin(F.broadcast(most)).agg(F.count_if(F.abs(F.col("w") - target * F.col("all")) > 2 * F.col("most")).alias("n_bad"))  # a row a split, and one row
    out = torn("source").unionByName(torn("channel")).unionByName(far.select(F.lit("split further from its share than two of the largest groups").alias("fault"), "n_bad"))
    return out.unionByName(done.agg(F.count("*").alias("n_bad")).select(F.lit("none: clips in all").alias("fault"), "n_bad"))


def p6_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    return percentiles.percentiles(percentiles.clip_values(table(spark, sf, "clips")), ["channel", "metric"], PERCENTILES)


def _file_states(spark: SparkSession, sf: str) -> DataFrame:
    """The two-digit states of all metrics, one of each input file: (file, channel, metric, bucket, n)."""
    return percentiles.state(percentiles.clip_values(table(spark, sf, "clips"), by_file=True), ["file", "channel", "metric"])


def p6_mergeable(spark: SparkSession, sf: str) -> DataFrame:
    """The same from states: one per input file, added up; bounds of each percentile."""
    return percentiles.from_state(percentiles.merge([_file_states(spark, sf)], ["channel", "metric"]), ["channel", "metric"], PERCENTILES)


def p6_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """Each exact percentile, whether the bounds from added-up states hold it, and whether they are as near as promised (2**-20 of it). States of two halves of the
    clips are merged."""
    clips = table(spark, sf, "clips")
    half = F.pmod(F.xxhash64("id"), F.lit(2))
    groups = ["channel", "metric"]
    states = [percentiles.state(percentiles.clip_values(clips.filter(half == i)), groups) for i in (0, 1)]
    low_high = percentiles.from_state(percentiles.merge(states, groups), groups, PERCENTILES).withColumnRenamed("n_values", "n")
    j = p6_percentiles(spark, sf).join(low_high, [*groups, "p"], "left")
    inside = (F.col("n") == F.col("n_values")) & (F.col("low") <= F.col("value")) & (F.col("value") <= F.col("high"))
    near = (F.col("high") - F.col("low") <= F.lit(2.0**-20) * F.abs("value")) | (F.abs("value") < 1e-300)
    return j.select(*groups, "p", "n_values", "value", F.coalesce(inside, F.lit(False)).alias("inside"), F.coalesce(near, F.lit(False)).alias("near"))


def p7_packed(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(packing.token_counts(table(spark, sf, "documents")), CAPACITY)


def p7_summary(spark: SparkSession, sf: str) -> DataFrame:
    return packing.summary(p7_packed(spark, sf), CAPACITY)


def p7_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Faults of the packing by kind, and the number of documents in it."""
    from ..session import materialize

    packed = materialize(p7_packed(spark, sf), "packed")
    sizes = packing.token_counts(table(spark, sf, "documents")).groupBy("doc_id").agg(F.sum("n_tokens").alias("tokens"))
    own = packed.filter("container is not null").groupBy("container").agg(F.sum("n_tokens").alias("filled"), F.max(F.col("place") + F.col("n_tokens")).alias("upto"))
    docs = packed.groupBy("doc_id").agg(F.count("*").alias("n"), F.countDistinct("piece").alias("pieces"), F.sum("n_tokens").alias("placed"), F.count_if(F.col("container").isNull() & (F.col("n_tokens") > 0)).alias("lost"))
    docs = docs.join(sizes, "doc_id", "full")
    bad = lambda df, name, c: df.agg(F.count_if(c).alias("n_bad")).select(F.lit(name).alias("fault"), "n_bad")
    out = bad(own, "container above its capacity", F.col("filled") > CAPACITY)
    out = out.unionByName(bad(own, "container with a gap or an overlap", F.col("filled") != F.col("upto")))
    out = out.unionByName(bad(docs, "text cut although it fits", (F.col("tokens") <= CAPACITY) & (F.col("n") > 1)))
    out = out.unionByName(bad(docs, "piece placed twice", F.col("n") != F.col("pieces")))
    out = out.unionByName(bad(docs, "tokens lost or added", ~F.col("placed").eqNullSafe(F.col("tokens")) | (F.col("lost") > 0)))
    return out.unionByName(docs.agg(F.count("*").alias("n_bad")).select(F.lit("none: documents in all").alias("fault"), "n_bad"))


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    return leakage.exact_leaks(table(spark, sf, "documents"), table(spark, sf, "eval_items"))


def p8_near(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with a passage of an item within one word edit, and the least distance."""
    return leakage.leaks(table(spark, sf, "documents"), table(spark, sf, "eval_items"))


def p8_items(spark: SparkSession, sf: str) -> DataFrame:
    """Which items leaked, and into how many documents."""
    return p8_found(spark, sf).groupBy("item_id").agg(F.count("*").alias("n_documents"))


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return residue.residue(table(spark, sf, "documents")).select("doc_id")


def p9_evidence(spark: SparkSession, sf: str) -> DataFrame:
    return residue.residue(table(spark, sf, "documents"))


ALL: dict[str, Query] = {
    f.__name__: f
    for f in (
        p1_found, p1_groups, p2_found, p2_strata, p3_found, p3_counts, p3_weighted, p4_found, p4_blocks, p4_clean, p5_found, p5_splits, p5_checks, p6_percentiles, p6_mergeable, p6_bounds, p7_packed, p7_checks, p7_summary, p8_found, p8_near, p8_items, p9_found, p9_evidence,
    )
}


def queries() -> dict[str, Query]:
    return dict(ALL)
