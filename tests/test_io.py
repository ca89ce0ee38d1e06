"""Sources, sinks and streams on small files."""

import datetime

import pytest
from pyspark.sql import functions as F

from dokuma import schema, sources, streaming
from dokuma.sources import sinks


def test_files_and_lists(spark, tmp_path):
    for p in ("chA/a1.wav", "chA/a2.WAV", "chB/b1.mp3", "chB/skip/b2.wav"):
        (tmp_path / p).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / p).write_bytes(b"x" * 7)
    got = {(r.channel, r.ext, r.bytes) for r in sources.files(spark, str(tmp_path), (".wav",), ("/skip/",)).collect()}
    assert got == {("chA", "wav", 7)}
    (tmp_path / "ids.txt").write_text("a b\n\nb c\n")
    assert {r.id for r in sources.id_lists(spark, str(tmp_path / "ids.txt")).collect()} == {"a", "b", "c"}
    (tmp_path / "w.jsonl").write_text('{"source_id": 1, "pos": 0, "text": "a", "start": 0.0, "end": 1.0}\n')
    assert sources.word_files(spark, str(tmp_path / "w.jsonl")).first().file == "w.jsonl"


def test_sinks(spark, tmp_path):
    df = spark.range(100).select(F.col("id"), F.when(F.col("id") < 10, "dev").otherwise("train").alias("split"))
    sinks.write_splits(df, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).filter("split = 'dev'").count() == 10
    sinks.write_shards(df, str(tmp_path / "p"), sinks.shard_count(df, "id", 1000), ["id"])
    assert spark.read.parquet(str(tmp_path / "p")).count() == 100
    assert sinks.append_missing(df, df.filter("id < 90"), "id").count() == 10
    notes = spark.createDataFrame([("a", "temiz", ["x", "q"]), ("b", "nosuch", [])], "id string, verdict string, tags array<string>")
    assert [tuple(r) for r in sinks.valid_notes(notes, ["temiz"], ["x"]).collect()] == [("a", "temiz", ["x"])]


def test_published_rows(spark, sf):
    from dokuma.plans.core import annotated

    p = schema.published(annotated(spark, sf))
    assert dict(p.dtypes)["flags"] == "string" and p.filter("source_id = 1").first().source == "src00001"
    assert "source_path" not in p.columns and "| id |" in schema.markdown_table()


def test_pending_stream_takes_each_item_once(spark, tmp_path):
    d = {k: str(tmp_path / k) for k in ("in", "done", "out", "cp")}

    def run():
        streaming.run_pending(spark, d["in"], "id string, x int", d["done"], d["out"], d["cp"], "id", lambda b: b.withColumn("y", F.col("x") * 2), "1").awaitTermination()

    spark.createDataFrame([("a", 1), ("b", 2), ("a", 1)], "id string, x int").write.parquet(d["in"])
    run()
    spark.createDataFrame([("b", 2), ("c", 3)], "id string, x int").write.mode("append").parquet(d["in"])
    run()
    assert sorted((r.id, r.y) for r in spark.read.parquet(d["out"]).collect()) == [("a", 2), ("b", 4), ("c", 6)]


def test_sessions_stream_equals_batch(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    events.coalesce(1).write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "e"))
    q = streaming.sessions(stream, "ts", "user_id", "30 minutes").writeStream.outputMode("append").format("memory").queryName("sess").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    got, want = ({(r.user_id, r.start, r.end, r.n) for r in d.collect()} for d in (spark.table("sess"), streaming.sessions(events, "ts", "user_id", "30 minutes")))
    assert got <= want and len(got) >= 0.95 * len(want)


def test_wav_files(spark, tmp_path):
    import wave

    import numpy as np

    from dokuma.functions import signal
    from dokuma.sources import audio

    with wave.open(str(tmp_path / "a.wav"), "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(8000)
        w.writeframes((np.sin(np.arange(8000)) * 16384).astype("<i2").tobytes())
    (tmp_path / "bad.wav").write_bytes(b"no audio")
    files = audio.wav_files(spark, str(tmp_path))
    got = {r.path.rsplit("/", 1)[1]: (r.sample_rate, r.duration, r.error is None) for r in audio.probe(files).collect()}
    assert got == {"a.wav": (8000, 1.0, True), "bad.wav": (None, None, False)}
    m = {r.path.rsplit("/", 1)[1]: r.m for r in audio.samples(files).select("path", signal.level_metrics(F.col("samples")).alias("m")).collect()}
    assert abs(m["a.wav"].peak_dbfs + 6.02) < 0.02 and abs(m["a.wav"].rms_dbfs + 9.03) < 0.02 and m["bad.wav"] is None
    where = files.filter("path like '%a.wav'").select("path").first().path
    clips = spark.createDataFrame([("x", where, 0.25, 0.75), ("y", where, 0.9, 9.0), ("z", where.replace("a.wav", "bad.wav"), 0.0, 1.0)], "id string, path string, start double, end double")
    cuts = audio.cut(files, clips)
    assert {r.path: r.duration for r in audio.probe(cuts.filter("error is null").select(F.col("id").alias("path"), "content")).collect()} == {"x": 0.5, "y": 0.1}
    assert [(r.id, r.content) for r in cuts.filter("error is not null").collect()] == [("z", None)]


def test_late_rows_go_to_a_side_table(spark, tmp_path):
    d = {k: str(tmp_path / k) for k in ("in", "ok", "late", "cp")}

    def run(rows):
        spark.createDataFrame(rows, "id int, ts timestamp").coalesce(1).write.mode("append").parquet(d["in"])
        streaming.run_with_late(spark, d["in"], "id int, ts timestamp", "ts", "10 minutes", d["ok"], d["late"], d["cp"]).awaitTermination()

    at = lambda h, m: datetime.datetime(2026, 1, 1, h, m)
    run([(1, at(10, 0)), (2, at(12, 0)), (3, None)])
    run([(4, at(11, 55)), (5, at(11, 40)), (6, at(12, 30))])
    run([(7, at(12, 19)), (8, at(12, 21))])
    ids = lambda k: {r.id for r in spark.read.parquet(d[k]).collect()}
    assert ids("ok") == {1, 2, 3, 4, 6, 8} and ids("late") == {5, 7}


def test_shards_are_the_same_in_every_run(spark, tmp_path):
    df = spark.range(103).select(F.format_string("k%05d", "id").alias("id"))
    assert sinks.missing_shards(df, str(tmp_path / "s"), 4, ["id"], {1, 3}) == [0, 2] and sinks.missing_shards(df, str(tmp_path / "s"), 4, ["id"], {0, 2}) == [1, 3]
    got = spark.read.parquet(str(tmp_path / "s"))
    assert got.count() == 103 and got.groupBy("shard").agg(F.max("id").alias("m")).orderBy("shard").first().m == "k00025"
    sized = df.select("id", F.lit(1000).alias("bytes"), F.lit(2.0).alias("duration"))
    assert sinks.shards_for(sized, "bytes", "duration", 10_000, 10, "s") == 11 and sinks.shards_for(sized.limit(0), "bytes", "duration", 10, 10, "s") == 1


def test_shared_folder_must_be_named_on_a_cluster():
    from dokuma.session import shared_dir

    class Conf:
        def get(self, _k, default=None):
            return default

    class Session:
        conf = Conf()

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="checkpoint.dir"):
        shared_dir(Session())
