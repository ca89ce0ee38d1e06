"""Texts as word multisets: hashed features, class keys and bitmaps, computed over whole Arrow batches.

A multiset is held as a set of features (word, which occurrence of it), so multiset Jaccard of two texts is plain Jaccard
of their features. Features are 64-bit hashes; texts with equal multisets share a 128-bit class key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import words
from ..session import materialize, spread

CACHE = 1_000_000
BUCKET_BITS, HASHES = 18, 3
BUCKETS = 1 << BUCKET_BITS
CROWD = 5_000
U = np.uint64


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64) after adding ``salt``."""
    with np.errstate(over="ignore"):
        x = x + U(salt * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


class Hasher:
    """Word to 64-bit hash, remembered for at most ``CACHE`` words."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def __call__(self, ws: list[str]) -> list[int]:
        known = self.known
        try:
            return [known[w] for w in ws]
        except KeyError:
            if len(known) > CACHE:
                known.clear()
            for w in ws:
                if w not in known:
                    known[w] = xxhash.xxh3_64_intdigest(w)
            return [known[w] for w in ws]


def features(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Features of all texts of a batch, sorted within each text. ``starts``: where each text's word hashes begin."""
    n = len(hashes)
    doc = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, n)))
    order = np.lexsort((hashes, doc))
    h = hashes[order]
    new = np.ones(n, bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    at = np.arange(n)
    nth = at - np.maximum.accumulate(np.where(new, at, 0))
    f = mix(h ^ (nth.astype(U) << U(32)) ^ nth.astype(U))
    return f[np.lexsort((f, doc))]


def bags(df: DataFrame, id_col: str, text: Column, least_words: int) -> DataFrame:
    """One row per row of ``df`` whose text has at least ``least_words`` words: id, class key k1 k2, number of words n, a bitmap of 256 bits
    (w0 to w3, one bit per feature), its union bm of 64 bits, and the features as bytes. Null texts have no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for b in batches:
            ids, hs, ns = [], [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if t is not None and i is not None:
                    ws = words(t)
                    if len(ws) >= least_words:
                        ids.append(i)
                        ns.append(len(ws))
                        hs += hasher(ws)
            if not ids:
                continue
            n = np.array(ns, np.int64)
            starts = np.cumsum(n) - n
            f = features(np.array(hs, U), starts)
            k1, k2 = np.add.reduceat(mix(f, 1), starts), np.add.reduceat(mix(f, 2), starts)
            bit = U(1) << (f >> U(56) & U(63))
            wide = [np.bitwise_or.reduceat(np.where(f >> U(62) == j, bit, U(0)), starts) for j in range(4)]
            bm = wide[0] | wide[1] | wide[2] | wide[3]
            offsets = np.append(starts, len(f)) * 8  # 64 bits: a batch may hold more than 2**31 bytes of features
            blob = pa.Array.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(offsets), pa.py_buffer(f)])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), pa.array(n.astype(np.int32)), *[pa.array(x.view(np.int64)) for x in (bm, *wide)], blob], ["id", "k1", "k2", "n", "bm", "w0", "w1", "w2", "w3", "feats"])

    two = spread(df.select(F.col(id_col).cast("string").alias("id"), text.alias("text")))
    return two.mapInArrow(run, "id string, k1 long, k2 long, n int, bm long, w0 long, w1 long, w2 long, w3 long, feats binary")


def blobs(column: pa.Array, dtype: type = np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """A binary column without nulls as one array and the lengths of its rows, in items."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros(0, dtype), np.zeros(0, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view(dtype)
    return data, np.diff(offsets).astype(np.int64) // np.dtype(dtype).itemsize


def buckets(f: np.ndarray, hashes: int = HASHES) -> np.ndarray:
    """(hashes, n): the bucket of each feature in each of the tables of a count-min sketch."""
    return np.stack([(mix(f, 50 + i) >> U(64 - BUCKET_BITS)).astype(np.int64) + i * BUCKETS for i in range(hashes)])


def look_up(table: np.ndarray, f: np.ndarray) -> np.ndarray:
    """The sketch's value of each feature: the least of its buckets, an upper bound that is exact unless all of them are shared."""
    return table[buckets(f, len(table) // BUCKETS)].min(0)


def frequencies(texts: DataFrame, hashes: int = HASHES) -> tuple[np.ndarray, int]:
    """A count-min sketch (one table is enough for an order of terms) of how many texts have each feature, over all texts; and the number of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, rows = np.zeros(hashes * BUCKETS, np.int64), 0
        for b in batches:
            f = blobs(b.column(0))[0]
            if len(f):
                count += np.bincount(buckets(f, hashes).reshape(-1), minlength=hashes * BUCKETS)
            rows += b.num_rows
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(count[at], rows))], ["bucket", "n"])

    got = texts.select("feats").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()  # hashes * BUCKETS rows at most
    out = np.zeros(hashes * BUCKETS, np.int64)
    own = got[got.bucket >= 0]
    out[own.bucket.to_numpy()] = own.n.to_numpy()
    return out, int(got[got.bucket < 0].n.sum())


def parts(rows: DataFrame, key: str, crowd: int | None = None) -> DataFrame:
    """``rows`` with ``parts``: into how many shares the pairs of its key are dealt, 1 for keys of at most ``crowd`` rows (``CROWD``). The crowded keys are few: a
    ``crowd``-th of the rows at most."""
    crowd = crowd or CROWD
    many = materialize(rows.groupBy(key).agg(F.count("*").alias("rows")).filter(F.col("rows") > crowd).select(key, F.least(F.lit(256), F.ceil(F.col("rows") / crowd)).cast("int").alias("parts")), "crowded")
    n = many.count()
    return rows.withColumn("parts", F.lit(1)) if not n else rows.join(F.broadcast(many) if n <= 500_000 else many, key, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))


def dealt(rows: DataFrame, one: bool) -> DataFrame:
    """A side of a join of ``parts``, with ``part``: each row in one share, or in all of them."""
    part = F.pmod(F.xxhash64("k1"), F.col("parts")).cast("int") if one else F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    return rows.withColumn("part", part)


def overlaps(a: pa.Array, b: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each pair of feature blobs: shared features, and the sizes of both."""
    fa, na = blobs(a)
    fb, nb = blobs(b)
    rows = np.arange(len(na))
    pair = np.concatenate([np.repeat(rows, na), np.repeat(rows, nb)])
    f = np.concatenate([fa, fb])
    order = np.lexsort((f, pair))
    f, pair = f[order], pair[order]
    same = (f[1:] == f[:-1]) & (pair[1:] == pair[:-1])
    return np.bincount(pair[1:][same], minlength=len(na)), na, nb


def close_enough(least: float, a: str = "a", b: str = "b", bits: tuple[str, ...] = ("bm",)) -> Column:
    """Necessary for Jaccard >= ``least``, from sizes and bitmaps alone: each differing bit stands for at least one feature
    that only one text has, and those are at most (na + nb) (1 - 2 least / (1 + least))."""
    most = 1 - 2 * least / (1 + least)
    differ = " + ".join(f"bit_count({a}.{w} ^ {b}.{w})" for w in bits)
    return F.expr(f"{differ} <= ({a}.n + {b}.n) * {most + 1e-9}D AND {a}.n >= {least - 1e-9}D * {b}.n AND {b}.n >= {least - 1e-9}D * {a}.n")
