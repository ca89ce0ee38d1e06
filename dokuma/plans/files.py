"""Scans and sinks: files are written from the tables into the shared folder and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema, sources
from ..config import Config, run_record, stage_versions
from ..operators import compare, dedupe, ledger
from ..session import folder
from ..sources import sinks
from .base import ONCE, metric, query, table
from .core import FLAGS, REASONS, SPLIT_CLIPS, annotated, split_clips
from .texts import WORDS, timed_words


@query("SELECT 'k=' || CAST(id % 50 AS VARCHAR) AS channel, 'txt' AS ext, 1::BIGINT AS n_files, CAST(sum(length(CAST(id AS VARCHAR)) + 1) AS BIGINT) AS bytes FROM sources GROUP BY id % 50")
def file_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Recursive scan of a tree of text files by extension, with their sizes."""
    at = folder(spark, "tree")
    s = table(spark, sf, "sources").select(F.col("id").cast("string").alias("value"), (F.col("id") % 50).alias("k"))
    s.repartition("k").write.partitionBy("k").text(at)
    return sources.files(spark, at, (".TXT",), ("/_",)).groupBy("channel", "ext").agg(F.count("*").alias("n_files"), F.sum("bytes").alias("bytes"))


@query(f"SELECT source_id, count(*) AS n_words, CAST(sum(length(text)) AS BIGINT) AS n_chars, CAST(max(pos) AS INTEGER) AS last FROM {WORDS} GROUP BY source_id")
def word_files(spark: SparkSession, sf: str) -> DataFrame:
    """Word rows written as JSON lines and read again."""
    at = folder(spark, "words")
    timed_words(spark, sf).write.json(at)
    return sources.word_files(spark, at).groupBy("source_id").agg(F.count("*").alias("n_words"), F.sum(F.length("text")).alias("n_chars"), F.max("pos").alias("last"))


@query(f"SELECT DISTINCT unnest([id, 'x' || id]) AS id FROM {ONCE}")
def id_lists(spark: SparkSession, sf: str) -> DataFrame:
    at = folder(spark, "ids")
    table(spark, sf, "clips").filter("id is not null").select(F.concat("id", F.lit("  x"), "id")).write.text(at)
    return sources.id_lists(spark, at)


LOG = "concat_ws(' ', strftime(done_at, '%Y-%m-%d %H:%M:%S'), kind, item_key, stage, version)"


@query(f"SELECT CAST(row_number() OVER (ORDER BY line DESC) AS INTEGER) AS nth, line FROM (SELECT {LOG} AS line FROM done WHERE contains({LOG}, 'clip_qc') ORDER BY line DESC LIMIT 100)")
def log_tail(spark: SparkSession, sf: str) -> DataFrame:
    """The last hundred matching lines are the feature."""
    at = folder(spark, "logs")
    line = F.concat_ws(" ", F.date_format("done_at", "yyyy-MM-dd HH:mm:ss"), "kind", "item_key", "stage", "version")
    table(spark, sf, "done").select(line.alias("value")).coalesce(1).sortWithinPartitions("value").write.text(at)  # one log
    return sources.log_tail(spark, at, "clip_qc", 100)


@query(f"SELECT split, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS n_chars, count(DISTINCT channel) AS channels FROM {SPLIT_CLIPS} WHERE split IN ('train', 'dev', 'test') GROUP BY split")
def split_files(spark: SparkSession, sf: str) -> DataFrame:
    """One JSON-lines manifest a split, and the three read as one table."""
    at = folder(spark, "splits")
    c = split_clips(spark, sf)
    for s in ("train", "dev", "test"):
        c.filter(F.col("split") == s).drop("split").write.json(f"{at}/{s}.jsonl")
    m = sources.manifests(spark, [f"{at}/{s}.jsonl" for s in ("train", "dev", "test")])
    return m.groupBy("split").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("n_chars"), F.countDistinct("channel").alias("channels"))


@query(f"SELECT id, CASE WHEN source_id IS NOT NULL THEN format('src{{:05d}}', source_id) END AS source, CAST(to_json(r) AS VARCHAR) AS exclusion_reasons, len(r) = 0 AS recommended FROM {REASONS} JOIN (SELECT id, source_id FROM {ONCE}) USING (id)")
def published_rows(spark: SparkSession, sf: str) -> DataFrame:
    return schema.published(annotated(spark, sf)).select("id", "source", "exclusion_reasons", "recommended")


@query(f"SELECT id, {metric('speech_ratio')} AS speech_ratio, {metric('dnsmos_ovrl')} AS dnsmos_ovrl, len(r) = 0 AS recommended, (SELECT count(*) FROM {ONCE}) AS n_run FROM {REASONS} JOIN (SELECT id, metrics_json FROM {ONCE}) USING (id)")
def manifest_export(spark: SparkSession, sf: str) -> DataFrame:
    """The manifest as JSON lines with one column a metric, and the run's record, both read again."""
    at = folder(spark, "export")
    m = annotated(spark, sf)
    cfg = Config({"policy": {"version": "1"}})
    sinks.write_manifest(m, at, run_record(cfg, stage_versions(cfg, {"policy": {"revision": 1, "sections": ["policy"]}}), {"clips": m.count()}))
    run = spark.read.text(f"{at}/run.json").select(F.get_json_object("value", "$.counts.clips").cast("long").alias("n_run"))
    return spark.read.json(f"{at}/clips.jsonl").select("id", "speech_ratio", "dnsmos_ovrl", "recommended").crossJoin(F.broadcast(run))  # one row


@query("SELECT shard, count(*) AS n, min(id) AS first, max(id) AS last FROM (SELECT id, CAST(least(floor((row_number() OVER (ORDER BY id) - 1) * 7 / count(*) OVER ()), 6) AS INTEGER) AS shard FROM (SELECT DISTINCT id FROM clips WHERE id IS NOT NULL)) GROUP BY shard")
def shards_resumed(spark: SparkSession, sf: str) -> DataFrame:
    """Seven shards; the second run writes those that the first one left out."""
    at = folder(spark, "shards")
    ids = table(spark, sf, "clips").select("id").filter("id is not null").distinct()
    first = sinks.missing_shards(ids, at, 7, ["id"], {0, 2, 5})
    sinks.missing_shards(ids, at, 7, ["id"], set(first))
    return spark.read.schema("id string, shard int").parquet(at).groupBy("shard").agg(F.count("*").alias("n"), F.min("id").alias("first"), F.max("id").alias("last"))


@query("WITH e AS (SELECT id, path FROM sources WHERE id % 2 = 0) SELECT path, (SELECT max(id) FROM e) + row_number() OVER (ORDER BY path) AS id FROM (SELECT DISTINCT path FROM sources WHERE path IS NOT NULL AND path NOT IN (SELECT path FROM e))")
def insert_new(spark: SparkSession, sf: str) -> DataFrame:
    """Insert-or-ignore by path: half of the recordings are known, all arrive twice."""
    s = table(spark, sf, "sources").select("id", "path").filter("path is not null")
    return ledger.add_new(s.filter("id % 2 = 0"), s.select("path").unionByName(s.select("path")), "path").select("path", "id")


@query("SELECT id, CASE WHEN id % 5 = 0 THEN coalesce(duration + 1, duration) ELSE duration END AS duration, CASE WHEN id % 5 = 0 THEN coalesce(CASE WHEN id % 10 = 0 THEN 'new' END, channel) ELSE channel END AS channel FROM sources")
def point_update(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "sources").select("id", "duration", "channel")
    new = s.filter("id % 5 = 0").select("id", (F.col("duration") + 1).alias("duration"), F.when(F.col("id") % 10 == 0, "new").alias("channel"))
    return ledger.update(s, new, "id")


@query(f"""SELECT 'clips' AS what, count(*) AS n FROM (SELECT id FROM {ONCE} WHERE source_id % 7 <> 0 OR source_id IS NULL UNION ALL SELECT id FROM {ONCE} WHERE source_id % 7 = 0 AND idx < 3)
    UNION ALL SELECT 'marks', count(*) FROM done WHERE kind <> 'clip' OR (kind = 'clip' AND (item_key IS NULL OR item_key NOT IN (SELECT id FROM {ONCE} WHERE source_id IN (SELECT source_id FROM {ONCE} WHERE source_id % 7 = 0 AND idx < 3))))""".replace("SELECT id FROM " + ONCE + " WHERE source_id % 7 <> 0 OR source_id IS NULL", "SELECT id FROM " + ONCE + " WHERE source_id IS NULL OR source_id NOT IN (SELECT source_id FROM " + ONCE + " WHERE source_id % 7 = 0 AND idx < 3)"))
def replace_clips(spark: SparkSession, sf: str) -> DataFrame:
    """New clips for every seventh recording: old ones and their marks go first."""
    c = table(spark, sf, "clips").filter("id is not null").dropDuplicates(["id"]).select("id", "source_id", "idx")
    children, done = ledger.replace_children(c, c.filter("source_id % 7 = 0 AND idx < 3"), "source_id", table(spark, sf, "done"))
    return children.agg(F.count("*").alias("n")).select(F.lit("clips").alias("what"), "n").unionByName(done.agg(F.count("*").alias("n")).select(F.lit("marks").alias("what"), "n"))


@query(f"SELECT id, CASE WHEN a <= 2 THEN 'first' ELSE 'last' END AS place FROM (SELECT id, row_number() OVER (PARTITION BY source_id ORDER BY idx, id) AS a, row_number() OVER (PARTITION BY source_id ORDER BY idx DESC, id DESC) AS b FROM {ONCE} WHERE source_id IS NOT NULL) WHERE a <= 2 OR b <= 2")
def first_and_last(spark: SparkSession, sf: str) -> DataFrame:
    """Two clips at either end of each recording are the feature."""
    c = table(spark, sf, "clips").filter("id is not null AND source_id is not null").dropDuplicates(["id"])
    a = dedupe.first_in_group(c, ["source_id"], [F.asc("idx"), F.asc("id")], 2).select("id", F.lit("first").alias("place"))
    b = dedupe.first_in_group(c, ["source_id"], [F.desc("idx"), F.desc("id")], 2).select("id", F.lit("last").alias("place"))
    return a.unionByName(b.join(a, "id", "left_anti"))


@query("""SELECT * FROM (VALUES ('missing', 'flags'), ('missing', 'metrics'), ('missing', 'recommended'), ('missing', 'exclusion_reasons'), ('missing', 'policy_version'), ('missing', 'source_path'), ('unknown', 'flags_json'), ('unknown', 'metrics_json'), ('unknown', 'meta_json')) t(kind, "column")""")
def schema_check(spark: SparkSession, sf: str) -> DataFrame:
    """Columns of the clip table against those of the manifest (duplicate_of is optional)."""
    from pyspark.sql.types import StructType

    drift = compare.schema_drift(table(spark, sf, "clips"), StructType.fromDDL(schema.manifest_ddl()), ("duplicate_of",))
    return spark.createDataFrame([(k, c) for k, cs in drift.items() for c in cs], "kind string, `column` string")


CFG = {"asr": {"beam": 5.0, "log": "x"}, "align": {"pad": 0.5}}
STAGES = {"asr": {"revision": 3, "sections": ["asr"], "ignore": ["log"]}, "align": {"revision": 7, "sections": ["align"], "depends_on": ["asr"]}}


@query("""WITH a AS (SELECT '3-' || left(sha1('{"depends_on": {}, "sections": {"asr": {"beam": 5}}}'), 8) AS v) SELECT 'asr' AS stage, v AS version FROM a UNION ALL SELECT 'align', '7-' || left(sha1('{"depends_on": {"asr": "' || v || '"}, "sections": {"align": {"pad": 0.5}}}'), 8) FROM a""")
def versions(spark: SparkSession, sf: str) -> DataFrame:
    """Stage versions of a configuration: equal numbers are one, ignored keys don't count, those of the stages below do."""
    return spark.createDataFrame(list(stage_versions(Config(CFG), STAGES).items()), "stage string, version string")


@query(f"SELECT c.id, c.source_id, CASE WHEN CAST(right(d.item_key, 1) AS VARCHAR) IN ('1', '3', '5') THEN 1.5 END AS score FROM {ONCE} c LEFT JOIN (SELECT DISTINCT item_key FROM done WHERE kind = 'clip' AND stage = 'clip_qc' AND item_key IS NOT NULL) d ON d.item_key = c.id")
def legacy_store(spark: SparkSession, sf: str) -> DataFrame:
    """A two-table store: results of a stage as JSON beside the clips, planted for the clips with marks."""
    payload = F.when(F.substring("item_key", -1, 1).isin("1", "3", "5"), F.lit('{"quality": {"score": 1.5}}')).otherwise(F.lit('{"quality": {"score": "none"}}'))
    r = table(spark, sf, "done").filter("kind = 'clip' AND stage = 'clip_qc' AND item_key is not null").select("item_key", "stage").distinct().withColumn("payload_json", payload)
    c = table(spark, sf, "clips").filter("id is not null").dropDuplicates(["id"]).select("id", "source_id")
    return sources.stage_results(c, r, "clip_qc", {"quality.score": "double"}).select("id", "source_id", "score")
