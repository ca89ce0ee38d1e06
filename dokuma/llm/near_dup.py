"""Problem 1: near-duplicate texts by HyperMinHash.

Texts become word multisets (``bags``); equal multisets collapse into one class before anything is compared. Each class gets
a HyperMinHash sketch: per bucket the leading-zero count of the least hash and the mantissa bits after it. Bands of registers
are shuffled as 64-bit keys; classes that share one are compared by size and bitmap inside the join, then by a wider bitmap (bounds that lose
no pair), then by the collision-corrected Jaccard estimate, then exactly.

With 5 registers a band and 44 bands a pair of similarity 0.7 is missed with a chance of 3e-4, one of 0.75 with 7e-6.
A band that more than ``HOT`` classes share - a template that fills a large part of the texts - would mean comparing all of them. Classes in such bands are paired
exactly instead: two texts of similarity t share one of their n - ceil(t n) + 1 rarest features, so they are joined on those. That loses no pair, and is
used for over-full bands only. Pairs of a crowded feature are dealt out over several tasks (``bags.parts``).

The estimate comes from 220 registers (deviation 0.031 at 0.7) and rejects only below the threshold less 0.2.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import bags
from .components import components

ROWS, BANDS, MANTISSA = 5, 44, 4
MARGIN = 0.2
HOT = 2_000
BAND_ROW = "band long, k1 long, bm long, n int"


def registers(f: np.ndarray, starts: np.ndarray, count: int) -> np.ndarray:
    """HyperMinHash registers, (texts, count) bytes: leading-zero count (up to 15) of the least 32-bit hash of a bucket in the
    high bits, the ``MANTISSA`` bits after its first one in the low bits. Every feature falls into every bucket,
    by a hash of its own, so that short texts leave none empty."""
    with np.errstate(over="ignore"):
        base = (f >> bags.U(32)).astype(np.uint32) ^ f.astype(np.uint32)
        odd = (bags.mix(np.arange(count, dtype=bags.U), 7) | bags.U(1)).astype(np.uint32)
        out = np.empty((len(starts), count), np.uint8)
        step = max(1, min(count, (1 << 22) // max(1, len(f))))
        for j in range(0, count, step):
            x = base[:, None] * odd[None, j : j + step]
            x ^= x >> np.uint32(15)
            x *= np.uint32(0x846CA68B)
            x ^= x >> np.uint32(16)
            least = np.minimum.reduceat(x, starts, axis=0)
            zeros = 31 - np.floor(np.log2(np.maximum(least, 1).astype(np.float64))).astype(np.int64)
            mantissa = ((least.astype(np.uint64) << (zeros.astype(bags.U) + bags.U(1))) & bags.U(0xFFFFFFFF)) >> bags.U(32 - MANTISSA)
            out[:, j : j + step] = np.minimum(zeros, 15).astype(np.uint8) << MANTISSA | mantissa.astype(np.uint8)
    return out


def collisions(na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Chance that a register of two texts without common features agrees: both minima in one leading-zero class, by the
    sizes na and nb, and equal mantissas within it."""
    above = 1 - 2.0 ** -np.append(np.arange(16), np.inf)[None, :]  # chance of a hash of being above each class
    share = lambda n: np.diff(above ** n.astype(float)[:, None], axis=1)
    return (share(na) * share(nb)).sum(1) / 2**MANTISSA


def estimates(ra: np.ndarray, rb: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Jaccard from agreeing registers, corrected for chance collisions."""
    chance = collisions(na, nb)
    return np.clip(((ra == rb).mean(1) - chance) / (1 - chance), 0, 1)


def sketch(batches: Iterator[pa.RecordBatch], rows: int, bands: int) -> Iterator[pa.RecordBatch]:
    """Band keys of each class, as rows."""
    for b in batches:
        f, n = bags.blobs(b.column("feats"))
        starts = np.cumsum(n) - n
        if not len(n):
            continue
        reg = registers(f, starts, rows * bands).reshape(len(n), bands, rows)
        key = np.zeros((len(n), bands), bags.U)
        for r in range(rows):
            key = bags.mix(key ^ reg[:, :, r].astype(bags.U), r + 1)
        key = bags.mix(key + np.arange(bands, dtype=bags.U)[None, :], 99)
        k1, bm, size = (np.repeat(np.asarray(b.column(c)), bands) for c in ("k1", "bm", "n"))
        yield pa.RecordBatch.from_arrays([pa.array(key.reshape(-1).view(np.int64)), pa.array(k1), pa.array(bm), pa.array(size)], ["band", "k1", "bm", "n"])


def hot_bands(texts: DataFrame, rows: int, bands: int, among: int = 64, least: int = 200) -> DataFrame | None:
    """The largest bands, as far as every ``among``-th class shows (by its key; those with ``least`` of them at least), or None. They only decide how rows travel: a
    band listed here has several classes for certain, so its rows needn't meet in one task to be kept. At most 1,000 a band position on average."""
    few = texts.filter(F.pmod("k1", F.lit(among)) == 0).select("k1", "k2", "n", "bm", "feats").dropDuplicates(["k1", "k2"])
    some = few.mapInArrow(lambda it: sketch(it, rows, bands), BAND_ROW).groupBy("band").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    hot = some.orderBy(F.desc("n")).limit(1_000 * bands).select("band").collect()
    return texts.sparkSession.createDataFrame(hot, "band long") if hot else None


def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows, sorted by band, whose band another row has too, or is marked as hot. Streams: only the last row of a batch waits for the next one."""
    held: pa.RecordBatch | None = None
    like = False
    for b in batches:
        if not b.num_rows:
            continue
        x = np.asarray(b.column(0))
        hot = np.asarray(b.column(4)) if b.num_columns > 4 else np.zeros(len(x), bool)
        b = b.select([0, 1, 2, 3])
        same = x[1:] == x[:-1]
        if held is not None:
            goes_on = held.column(0)[0].as_py() == x[0]
            if like or goes_on:
                yield held
        else:
            goes_on = False
        before = np.append(goes_on, same)
        keep = before[:-1] | same | hot[:-1]
        if keep.any():
            yield b.slice(0, b.num_rows - 1).filter(pa.array(keep))
        held, like = b.slice(b.num_rows - 1), bool(before[-1] or hot[-1])
    if held is not None and like:
        yield held


def rare_rows(batches: Iterator[pa.RecordBatch], count, least: float) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
    """The rarest features of each class, as many as a partner of similarity ``least`` must share one of."""
    for b in batches:
        f, n = bags.blobs(b.column("feats"))
        if not len(n):
            continue
        doc = np.repeat(np.arange(len(n)), n)
        order = np.lexsort((f, bags.look_up(count.value, f), doc))
        place = np.arange(len(f)) - np.repeat(np.cumsum(n) - n, n)
        keep = place < (n - np.ceil(least * n - 1e-9).astype(np.int64) + 1)[doc]
        k1, bm, size = (np.asarray(b.column(c))[doc][keep] for c in ("k1", "bm", "n"))
        yield pa.RecordBatch.from_arrays([pa.array(f[order][keep].view(np.int64)), pa.array(k1), pa.array(bm), pa.array(size)], ["band", "k1", "bm", "n"])


def verify(batches: Iterator[pa.RecordBatch], least: float, count: int) -> Iterator[pa.RecordBatch]:
    """Estimate, then exact similarity of candidate classes."""
    for b in batches:
        fa, na = bags.blobs(b.column("fa"))
        fb, nb = bags.blobs(b.column("fb"))
        if not len(na):
            continue
        sa, sb = np.cumsum(na) - na, np.cumsum(nb) - nb
        guess = estimates(registers(fa, sa, count), registers(fb, sb, count), na, nb)
        t = pa.Table.from_batches([b]).filter(pa.array(guess >= least - MARGIN))
        if not t.num_rows:
            continue
        both, na, nb = bags.overlaps(t.column("fa"), t.column("fb"))
        ok = both >= least * (na + nb - both) - 1e-9
        t = t.select(["a1", "a2", "b1", "b2"]).append_column("jaccard", pa.array(both / (na + nb - both))).filter(pa.array(ok))
        yield from t.combine_chunks().to_batches()


def class_pairs(texts: DataFrame, least: float, rows: int = ROWS, bands: int = BANDS, hot: int = HOT) -> DataFrame:
    """Pairs of different classes (a1, a2) and (b1, b2) with exact similarity >= ``least``; ``texts``: a written table of ``bags``."""
    kind = BAND_ROW
    # Copies are dropped before the shuffle, so a text that fills a third of the table sends one row a task.
    wide = ("w0", "w1", "w2", "w3")
    classes = texts.select("k1", "k2", "n", "bm", *wide, "feats").dropDuplicates(["k1", "k2"])
    keys = classes.select("k1", "n", "bm", "feats").mapInArrow(lambda it: sketch(it, rows, bands), kind)
    hot_ = hot_bands(texts, rows, bands)
    if hot_ is None:
        keys = keys.repartition("band")
    else:
        keys = keys.join(F.broadcast(hot_.withColumn("hot", F.lit(True))), "band", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
        keys = keys.repartition("band", F.when(F.col("hot"), F.pmod("k1", F.lit(64))))
    # One shuffle; most bands belong to one class and end here. Rows of bands known to be hot are dealt out.
    keys = materialize(keys.sortWithinPartitions("band").mapInArrow(shared, kind), "shared")

    def joined(k: DataFrame, crowded: bool = False) -> DataFrame:
        k = bags.parts(k, "band") if crowded else k
        a, b = (bags.dealt(k, one).alias(x) if crowded else k.alias(x) for x, one in (("a", True), ("b", False)))
        same = (F.col("a.band") == F.col("b.band")) & (F.col("a.part") == F.col("b.part") if crowded else F.lit(True))
        near = a.join(b, same & F.expr("a.k1 < b.k1") & bags.close_enough(least))
        return near.select(F.col("a.k1").alias("a1"), F.col("b.k1").alias("b1"))

    full = materialize(keys.groupBy("band").agg(F.count("*").alias("rows")).filter(F.col("rows") > hot), "full")
    n_full = full.count()
    if n_full:
        full = F.broadcast(full) if n_full <= 500_000 else full
        marked = keys.join(full, "band", "left")
        members = classes.join(marked.filter("rows is not null").select("k1").distinct(), "k1", "left_semi")
        count = texts.sparkSession.sparkContext.broadcast(bags.frequencies(texts, 1)[0])
        rare = materialize(members.select("k1", "n", "bm", "feats").mapInArrow(lambda it: rare_rows(it, count, least), kind), "rare")
        pairs = joined(marked.filter("rows is null").drop("rows")).unionByName(joined(rare, crowded=True)).distinct()
    else:
        pairs = joined(keys).distinct()
    # The wide bitmaps leave few pairs below the threshold before any features are moved.
    bits = classes.select("k1", "n", *wide)
    pairs = pairs.join(bits.alias("a"), F.col("a1") == F.col("a.k1")).join(bits.alias("b"), (F.col("b1") == F.col("b.k1")) & bags.close_enough(least, bits=wide)).select("a1", "b1").distinct()
    left = classes.select(F.col("k1").alias("a1"), F.col("k2").alias("a2"), F.col("feats").alias("fa"))
    right = classes.select(F.col("k1").alias("b1"), F.col("k2").alias("b2"), F.col("feats").alias("fb"))
    both = pairs.join(left, "a1").join(right, "b1").select("a1", "a2", "fa", "b1", "b2", "fb")
    return both.mapInArrow(lambda it: verify(it, least, 220), "a1 long, a2 long, b1 long, b2 long, jaccard double")


def near_duplicates(texts: DataFrame, least: float = 0.7, rows: int = ROWS, bands: int = BANDS) -> tuple[DataFrame, DataFrame]:
    """(members, pairs) of ``bags`` output: each id with its class, and pairs between classes. Ids delivered repeatedly with
    equal texts are one member; ties do not arise; an empty input gives empty results; extra columns are ignored."""
    texts = materialize(texts, "bags")
    return texts.select("id", "k1", "k2").distinct(), class_pairs(texts, least, rows, bands)


def expand(members: DataFrame, pairs: DataFrame) -> DataFrame:
    """All pairs of ids: across linked classes and within a class of equal multisets."""
    m = lambda s: members.select(F.col("id").alias(f"id_{s}"), F.col("k1").alias(f"{s}1"), F.col("k2").alias(f"{s}2"))
    across = pairs.join(m("a"), ["a1", "a2"]).join(m("b"), ["b1", "b2"]).select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"))
    within = members.alias("x").join(members.alias("y"), F.expr("x.k1 = y.k1 AND x.k2 = y.k2 AND x.id < y.id")).select(F.col("x.id").alias("id_a"), F.col("y.id").alias("id_b"))
    return across.unionByName(within).filter("id_a < id_b").distinct()


def groups(members: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row per text: its class, the number of links its class has to other classes, and the group of all classes reached
    over links (the least class key among them, as hex)."""
    name = lambda a, b: F.concat(F.lpad(F.hex(a), 16, "0"), F.lpad(F.hex(b), 16, "0"))
    links = materialize(pairs.select(name("a1", "a2").alias("a"), name("b1", "b2").alias("b")), "links")
    ends = links.select("a").unionByName(links.select(F.col("b").alias("a"))).groupBy("a").agg(F.count("*").alias("n_links"))
    roots = components(links, "a", "b")
    named = members.select("id", name("k1", "k2").alias("class_id"))
    return named.join(ends.withColumnRenamed("a", "class_id"), "class_id", "left").join(roots.select(F.col("node").alias("class_id"), F.col("root")), "class_id", "left").select(
        "id", "class_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("root", "class_id").alias("group_id")
    )
