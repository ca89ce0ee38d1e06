"""PCM WAV files as tables: probing headers, reading samples and cutting clips. Files are opened where their bytes are needed, through the file system of their path, and
only what is needed is read: a header, or the interval of a clip. Other codecs and models plug in as providers."""

from __future__ import annotations

import io
import wave
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pa_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PROBE = "path string, sample_rate int, channels int, frames long, duration double, error string"


def _opened(path: str, content: bytes | None):  # noqa: ANN202
    """A seekable file of a path (any file system Arrow knows), or of bytes that are at hand."""
    if content is not None:
        return io.BytesIO(content)
    if ":" not in path.split("/", 1)[0]:
        return open(path, "rb")
    fs, at = pa_fs.FileSystem.from_uri(path)
    return fs.open_input_file(at)


def _probe(path: str, content: bytes | None) -> tuple:
    with _opened(path, content) as f, wave.open(f) as w:
        return w.getframerate(), w.getnchannels(), w.getnframes(), w.getnframes() / w.getframerate()


def _samples(path: str, content: bytes | None) -> tuple[int, np.ndarray]:
    """Sample rate and mono samples in -1..1."""
    with _opened(path, content) as f, wave.open(f) as w:
        width, n = w.getsampwidth(), w.getnchannels()
        raw = w.readframes(w.getnframes())
        rate = w.getframerate()
    kind = {1: np.uint8, 2: np.int16, 4: np.int32}.get(width)
    if kind is None:
        raise ValueError(f"{8 * width}-bit samples are not supported")
    x = np.frombuffer(raw, kind).astype(np.float32)
    x = (x - 128) / 128 if width == 1 else x / float(1 << (8 * width - 1))
    return rate, x.reshape(-1, n).mean(1)


def wav_files(spark: SparkSession, root: str) -> DataFrame:
    """Paths of all WAV files below ``root``; contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.wav").load(root).select("path")


def _with_content(files: DataFrame) -> DataFrame:
    return files.select("path", "content" if "content" in files.columns else F.lit(None).cast("binary").alias("content"))


def probe(files: DataFrame) -> DataFrame:
    """Header values of each file (path, or path and content); files that cannot be read have an error and nulls, and stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for p, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                try:
                    rows.append((p, *_probe(p, c), None))
                except Exception as e:  # noqa: BLE001 - errors are data
                    rows.append((p, None, None, None, None, f"{type(e).__name__}: {e}"[:300]))
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["path", "sample_rate", "channels", "frames", "duration", "error"])

    return _with_content(files).mapInArrow(run, PROBE)


def samples(files: DataFrame) -> DataFrame:
    """(path, sample_rate, samples): mono samples in -1..1; unreadable files have null samples."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rates, xs = [], []
            for p, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                try:
                    rate, x = _samples(p, c)
                except Exception:  # noqa: BLE001
                    rate, x = None, None
                rates.append(rate)
                xs.append(x)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rates, pa.int32()), pa.array(xs, pa.list_(pa.float32()))], ["path", "sample_rate", "samples"])

    return _with_content(files).mapInArrow(run, "path string, sample_rate int, samples array<float>")


def truncated(sources: DataFrame, decoded: str, container: str, cap_sec: float, ratio: float = 0.95) -> DataFrame:
    """Adds source_flags: truncated_source where far less was decoded than the container, up to the cap, promises."""
    short = F.col(decoded) < ratio * F.least(F.col(container), F.lit(cap_sec))
    return sources.withColumn("source_flags", F.when(short, F.array(F.lit("truncated_source"))).otherwise(F.array().cast("array<string>")))


def cut(files: DataFrame, clips: DataFrame, path: str = "path") -> DataFrame:
    """(id, content, error): WAV bytes of each clip (id, path, start, end). Clips are joined to their file, which is opened once; of it only their intervals are read. Clips of files that can't be read stay, with an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, out, errors = [], [], []
            for name, content, own in zip(*(c.to_pylist() for c in b.columns)):
                try:
                    file = _opened(name, content)
                    source = wave.open(file)
                except Exception as e:  # noqa: BLE001 - errors are data
                    ids += [c["id"] for c in own]
                    out += [None] * len(own)
                    errors += [f"{type(e).__name__}: {e}"[:300]] * len(own)
                    continue
                rate = source.getframerate()
                for c in own:
                    first = min(max(round(c["start"] * rate), 0), source.getnframes())
                    source.setpos(first)
                    frames = source.readframes(max(0, min(round(c["end"] * rate), source.getnframes()) - first))
                    buffer = io.BytesIO()
                    with wave.open(buffer, "wb") as w:
                        w.setparams(source.getparams())
                        w.writeframes(frames)
                    ids.append(c["id"])
                    out.append(buffer.getvalue())
                    errors.append(None)
                file.close()
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(out, pa.binary()), pa.array(errors, pa.string())], ["id", "content", "error"])

    own = clips.groupBy(path).agg(F.collect_list(F.struct(F.col("id").cast("string").alias("id"), "start", "end")).alias("clips"))  # bounded by a recording
    return _with_content(files).withColumnRenamed("path", "_file").join(own, F.col("_file") == F.col(path)).select("_file", "content", "clips").mapInArrow(run, "id string, content binary, error string")
