"""Problem 7: filling fixed-capacity containers with texts, by exact-complement hashing.

Only the histogram of lengths goes to the driver: at most ``capacity`` numbers. There, for each length from the largest down, the gap to the capacity
is filled exactly by one, two or three further lengths, looked up in hashed sums of single, pair and triple lengths, as often as
their availability allows; what has no exact complement is packed best-fit. The result is a list of patterns with
repeat counts. Texts of one length are interchangeable, so each gets its place from its rank within its length (``ranked``,
range-partitioned: a length may hold a third of all texts) by binary search in the plan.

A text above the capacity is cut into full containers and a rest; no other text is cut. Texts without tokens (null, empty) need no
place: their container is null.
"""

from __future__ import annotations

import base64
import os
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import ranked
from ..session import materialize, spread

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the pattern that byte-level BPE vocabularies of this family split by.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def encoder(path: str):  # noqa: ANN201
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(docs: DataFrame, id_col: str = "doc_id", tokenizer: str = TOKENIZER) -> DataFrame:
    """(id, n_tokens) of each text; null texts have none. The vocabulary is read on the driver's machine and sent to the workers, unless only they have it."""
    sent = os.path.exists(tokenizer)
    if sent:
        docs.sparkSession.sparkContext.addFile(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(SparkFiles.get(os.path.basename(tokenizer)) if sent else tokenizer)
        for b in batches:
            n = [len(e.encode_ordinary(t)) if t else 0 for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64())], [id_col, "n_tokens"])

    kind = dict(docs.dtypes)[id_col]
    return spread(docs.select(id_col, "text")).mapInArrow(run, f"{id_col} {kind}, n_tokens long")


class Sums:
    """Which available lengths make a sum: single lengths, and a hash from pair sums to a pair. Pairs are looked up anew when one
    of theirs has run out."""

    def __init__(self, have: np.ndarray) -> None:
        self.have = have
        self.pair: dict[int, tuple[int, int] | None] = {}

    def fits(self, parts: tuple[int, ...]) -> bool:
        return all(self.have[x] >= k for x, k in Counter(parts).items())

    def two(self, s: int) -> tuple[int, int] | None:
        known = self.pair.get(s, ())
        if known is None or known and self.fits(known):
            return known
        a = np.arange(1, s // 2 + 1)
        a = a[(self.have[a] > 0) & (self.have[s - a] > 0)] if s >= 2 else a[:0]
        a = a[(2 * a != s) | (self.have[a] > 1)]
        found = (int(s - a[0]), int(a[0])) if len(a) else None
        self.pair[s] = found  # lengths only run out, so none stays none
        return found

    def three(self, s: int) -> tuple[int, ...] | None:
        for a in np.flatnonzero(self.have[: s - 1])[::-1].tolist() if s >= 3 else ():
            p = self.two(s - a) if s - a >= 2 else None
            if p and self.fits((a, *p)):
                return (a, *p)
        return None


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths, none above ``capacity`` in sum, with repeat counts; each length is used exactly as often as given."""
    have = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        have[length] = n
    sums, out = Sums(have), []
    for length in range(capacity, 0, -1):
        while have[length]:
            gap = capacity - length
            have[length] -= 1
            parts: tuple[int, ...] | None = () if gap == 0 else (gap,) if have[gap] else sums.two(gap) or sums.three(gap)
            have[length] += 1
            if parts is None:
                break
            pattern = (length, *parts)
            times = int(min(have[x] // k for x, k in Counter(pattern).items()))
            for x in pattern:
                have[x] -= times
            out.append((pattern, times))
    # Best fit of the rest: open containers by their gap, each gap with patterns and counts.
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    gaps: list[int] = []

    def put(gap: int, pattern: tuple[int, ...], n: int) -> None:
        if gap not in open_:
            gaps.insert(bisect_left(gaps, gap), gap)
            open_[gap] = []
        open_[gap].append((pattern, n))

    for length in np.flatnonzero(have)[::-1].tolist():
        left = int(have[length])
        while left:
            i = bisect_left(gaps, length)
            if i < len(gaps):
                gap = gaps[i]
                pattern, n = open_[gap].pop()
                if not open_[gap]:
                    del open_[gap]
                    gaps.pop(i)
                used = min(n, left)
                if n > used:
                    put(gap, pattern, n - used)
                put(gap - length, (*pattern, length), used)
                left -= used
            else:
                each = min(capacity // length, left)
                n = left // each
                put(capacity - each * length, (length,) * each, n)
                left -= n * each
    out += [x for gap in gaps for x in open_[gap]]
    return out


def places(patterns: list[tuple[tuple[int, ...], int]], capacity: int) -> tuple[np.ndarray, ...]:
    """The plan by length: entries sorted by (length, first rank), with first container, how many of the length each container takes, and where
    in it the first one begins."""
    used, rows, base = np.zeros(capacity + 1, np.int64), [], 0
    for pattern, times in patterns:
        at = 0
        for x, k in sorted(Counter(pattern).items(), reverse=True):
            rows.append((x, used[x], base, k, at))
            used[x] += times * k
            at += x * k
        base += times
    rows.sort()
    return tuple(np.array(c, np.int64) for c in zip(*rows)) if rows else tuple(np.zeros(0, np.int64) for _ in range(5))


def pack(sizes: DataFrame, capacity: int, id_col: str = "doc_id") -> DataFrame:
    """(id, piece, n_tokens, container, place): ``place`` is the first token's position in the container. ``sizes``: (id, n_tokens), ids unique."""
    if capacity < 1:
        raise ValueError("capacity must be at least 1")
    spark = sizes.sparkSession
    full, rest = F.floor(F.col("n_tokens") / capacity), F.col("n_tokens") % capacity
    pieces = F.concat(F.array_repeat(F.lit(capacity).cast("long"), full.cast("int")), F.when((rest > 0) | (F.col("n_tokens") == 0), F.array(rest)).otherwise(F.array().cast("array<bigint>")))
    items = materialize(sizes.select(id_col, F.posexplode(pieces).alias("piece", "n_tokens")), "items")
    histogram = {r.n_tokens: r.n for r in items.filter("n_tokens > 0").groupBy("n_tokens").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    table = spark.sparkContext.broadcast(places(plan(histogram, capacity), capacity))
    order = ranked(items.filter("n_tokens > 0"), ["n_tokens"], [F.asc(id_col), F.asc("piece")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, first, base, each, at = table.value
        for b in batches:
            n, r = np.asarray(b.column(2)), np.asarray(b.column(3)) - 1
            pos = np.empty(len(n), np.int64)
            for x in np.unique(n):
                lo, hi = np.searchsorted(length, [x, x + 1])
                own = n == x
                pos[own] = lo + np.searchsorted(first[lo:hi], r[own], "right") - 1
            k = r - first[pos]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(base[pos] + k // each[pos]), pa.array(at[pos] + k % each[pos] * n)], [id_col, "piece", "n_tokens", "container", "place"])

    kind = dict(sizes.dtypes)[id_col]
    packed = order.select(id_col, "piece", "n_tokens", "rank").mapInArrow(run, f"{id_col} {kind}, piece int, n_tokens long, container long, place long")
    none = items.filter("n_tokens = 0").select(id_col, "piece", "n_tokens", F.lit(None).cast("long").alias("container"), F.lit(None).cast("long").alias("place"))
    return packed.unionByName(none)


def summary(packed: DataFrame, capacity: int) -> DataFrame:
    """One row: containers, fewest possible by volume, tokens, unused places and the share filled."""
    return packed.filter("container is not null").agg((F.max("container") + 1).alias("n_containers"), F.ceil(F.sum("n_tokens") / capacity).alias("least_containers"), F.sum("n_tokens").alias("n_tokens")).select(
        "n_containers", "least_containers", "n_tokens", (F.col("n_containers") * capacity - F.col("n_tokens")).alias("unused"), F.round(F.col("n_tokens") / (F.col("n_containers") * capacity), 6).alias("filled")
    )
