"""Problem 8: evaluation texts leaking into training text, by pigeonhole edit matching.

The passages of a test item are all its runs of ``window`` words (the whole item where it is shorter). A passage may differ by up to ``budget``
word edits, so it is cut into budget + 1 pieces, of which at least one stands unchanged wherever the passage occurs. The pieces of all distinct passages are
a table, keyed by hash. Documents are passed over once, whatever the number of items: hashes of all their word runs of piece length are held against a bitmap
of the piece hashes (at most 2**26 bits, so of bounded size; it lets everything through that could be a piece), and the runs that remain, with the words around them, are
joined to the table of pieces. Myers' bit-parallel algorithm, over all candidates of a batch at once, gives the edit distance of each passage to
the words around the hit, and alone decides. Exact leaks are those of distance 0.

A small table of pieces (its rows are counted) is broadcast. A larger one is joined by shuffle, each piece dealt out to ``SALTS`` places, so
that a phrase which a third of the documents hold doesn't meet in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import fresh
from ..session import materialize, spread
from .bags import Hasher, blobs, mix
from .folding import folded_words

U = np.uint64
BASE = 0x9E3779B97F4A7C15
FEW, SALTS = 100_000, 8
BITS = (16, 26)  # least and greatest size of the bitmap, as powers of two
ROWS = 20_000


def myers(patterns: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Least edit distance between each pattern and any part of its text: (n, m) and (n, k) numbers, m at most 64. One bit a pattern position, one step a
    text position, all rows at once."""
    n, m = patterns.shape
    if not 0 < m <= 64:
        raise ValueError("patterns have 1 to 64 words")
    one, high = U(1), U(m - 1)
    pv, mv = np.full(n, ~U(0)), np.zeros(n, U)
    score = np.full(n, m, np.int64)
    best = score.copy()
    for j in range(texts.shape[1]):
        eq = np.zeros(n, U)
        for i in range(m):
            eq |= (patterns[:, i] == texts[:, j]).astype(U) << U(i)
        xv = eq | mv
        with np.errstate(over="ignore"):
            xh = (((eq & pv) + pv) ^ pv) | eq
        ph, mh = mv | ~(xh | pv), pv & xh
        score += ((ph >> high) & one).astype(np.int64) - ((mh >> high) & one).astype(np.int64)
        ph, mh = ph << one, mh << one
        pv, mv = mh | ~(xv | ph), ph & xv
        np.minimum(best, score, out=best)
    return best


def run_hashes(x: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` numbers."""
    with np.errstate(over="ignore"):
        out = np.zeros(max(len(x) - size + 1, 0), U)
        for j in range(size):
            out = out * U(BASE) + x[j : len(x) - size + 1 + j]
    return mix(out, size)


def cuts(m: int, edits: int) -> list[tuple[int, int]]:
    """(place, size) of the edits + 1 pieces of a passage of ``m`` words."""
    at = [m * i // (edits + 1) for i in range(edits + 2)]
    return [(a, b - a) for a, b in zip(at, at[1:])]


def index(tests: DataFrame, window: int, budget: int, short: bool) -> DataFrame:
    """One row per item, passage and piece: item_id, passage key, place and size of the piece in it, hash of the piece, and the passage as word hashes. Passages of
    less than ``window`` words get pieces for ``budget`` edits (one less than their words at most) if ``short``, else as a whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for b in batches:
            out: list[tuple] = []
            for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = np.array(hasher(folded_words(text)), U)
                m = min(len(ids), window)
                if not m:
                    continue
                edits = budget if m == window else min(budget, m - 1) if short else 0
                for at, size in cuts(m, edits):
                    h = run_hashes(ids, size).view(np.int64)
                    for start in range(len(ids) - m + 1):
                        words = ids[start : start + m].tobytes()
                        out.append((item, xxhash.xxh3_128_digest(words), at, size, int(h[start + at]), words))
            kinds = [b.schema.field(0).type, pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
            for i in range(0, len(out), ROWS):
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out[i : i + ROWS]), kinds)], ["item_id", "passage", "at", "size", "h", "words"])

    own = tests.select("item_id", "text").filter("item_id is not null AND text is not null")
    return spread(own).mapInArrow(run, f"item_id {dict(tests.dtypes)['item_id']}, passage binary, at int, size int, h long, words binary")


def bitmap(pieces: DataFrame, n: int) -> np.ndarray:
    """Bits of the piece hashes, 16 a piece or ``BITS[1]`` in all: 64-bit words, of which at most 2**20 come to the driver."""
    size = 1 << min(max((16 * n).bit_length(), BITS[0]), BITS[1])
    bit = F.col("h").bitwiseAND(F.lit(size - 1))
    words = pieces.groupBy(F.shiftright(bit, 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, int(h & 63))")).alias("bits"))
    got = words.toPandas()
    out = np.zeros(size >> 6, U)
    out[got.w.to_numpy(np.int64)] = got.bits.to_numpy(np.int64).view(U)
    return out


def hits(docs: DataFrame, bits, sizes: list[int], margin: int) -> DataFrame:  # noqa: ANN001
    """(doc_id, h, around): word runs of documents that may be pieces, with ``margin`` words before and after them (zeros beyond the text)."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, hasher = bits.value, Hasher()
        for b in batches:
            flat, n = [], []
            for t in b.column(1).to_pylist():
                ids = hasher(folded_words(t)) if t else []
                flat += ids
                n.append(len(ids))
            x, n = np.array(flat, U), np.array(n, np.int64)
            doc, end = np.repeat(np.arange(len(n)), n), np.repeat(np.cumsum(n), n)
            for size in sizes:
                h = run_hashes(x, size)
                w = h & U(len(known) * 64 - 1)
                at = np.flatnonzero((known[(w >> U(6)).astype(np.int64)] >> (w & U(63))) & U(1))
                at = at[at + size <= end[at]]
                for i in range(0, len(at), ROWS):
                    p = at[i : i + ROWS]
                    place = p[:, None] + np.arange(-margin, size + margin)[None, :]
                    inside = (place >= (end - n[doc])[p][:, None]) & (place < end[p][:, None])
                    around = np.where(inside, x[np.clip(place, 0, len(x) - 1)], U(0))
                    width = around.shape[1] * 8
                    blob = pa.Array.from_buffers(pa.binary(), len(p), [None, pa.py_buffer(np.arange(len(p) + 1, dtype=np.int32) * width), pa.py_buffer(np.ascontiguousarray(around))])
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(doc[p])), pa.array(h[p].view(np.int64)), blob], ["doc_id", "h", "around"])

    return spread(docs.select("doc_id", "text")).mapInArrow(run, f"doc_id {kind}, h long, around binary")


def verify(batches: Iterator[pa.RecordBatch], budget: int, margin: int) -> Iterator[pa.RecordBatch]:
    """Distance of each passage to the words around the hit of one of its pieces, where within ``budget``."""
    for b in batches:
        words, m = blobs(b.column("words"))
        around, width = blobs(b.column("around"))
        first, begin, at = np.cumsum(m) - m, np.cumsum(width) - width, np.asarray(b.column("at"))
        least = np.full(b.num_rows, budget + 1, np.int64)
        for k in np.unique(m):
            own = np.flatnonzero(m == k)
            text = begin[own] + margin - at[own] - budget
            least[own] = myers(words[first[own][:, None] + np.arange(k)], around[text[:, None] + np.arange(k + 2 * budget)])
        out = pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("passage"), pa.array(least)], ["doc_id", "passage", "distance"])
        yield out.filter(pa.array(least <= budget))


def leaks(docs: DataFrame, tests: DataFrame, window: int = 12, budget: int = 1, short: bool = True) -> DataFrame:
    """(doc_id, item_id, distance): documents with a passage of an item within ``budget`` word edits, and the least distance of any. Null and blank texts have no words
    and take no part; items under several ids are reported under each; repeated rows count once; an empty side gives an empty result. A passage of no more
    than ``budget`` words counts only unchanged; without ``short`` so does any item of fewer words than ``window``."""
    spark = docs.sparkSession
    table = materialize(index(tests, window, budget, short), "index")
    pieces = materialize(table.drop("item_id").dropDuplicates(["h", "passage", "at"]), "pieces")
    n = pieces.count()
    sizes = sorted(r.size for r in pieces.select("size").distinct().collect())  # window rows at most
    margin = window + budget
    found = hits(docs, spark.sparkContext.broadcast(bitmap(pieces, n)), sizes, margin)
    if n <= FEW:
        met = found.join(F.broadcast(pieces), "h")
    else:
        (salt,) = fresh(found, "_salt")
        found = found.withColumn(salt, F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
        met = found.join(pieces.withColumn(salt, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))), ["h", salt])
    kind = dict(docs.dtypes)["doc_id"]
    near = met.select("doc_id", "around", "passage", "at", "words").mapInArrow(lambda it: verify(it, budget, margin), f"doc_id {kind}, passage binary, distance long")
    near = near.groupBy("doc_id", "passage").agg(F.min("distance").alias("distance"))
    owners = table.select("passage", "item_id").distinct()
    return near.join(owners, "passage").groupBy("doc_id", "item_id").agg(F.min("distance").alias("distance"))


def exact_leaks(docs: DataFrame, tests: DataFrame, window: int = 12, budget: int = 1) -> DataFrame:
    """(doc_id, item_id): at least ``window`` words in a row are shared, or the whole item where it is shorter: the leaks of distance 0."""
    return leaks(docs, tests, window, budget, short=False).filter("distance = 0").select("doc_id", "item_id")
