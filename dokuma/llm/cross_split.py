"""Problem 3: same or near-same texts across splits, by a weighted cosine join.

Texts are unit vectors of term weights over the features of ``bags``. Terms are put into one global order, rare first. Frequencies
and largest weights are kept in count-min sketches of fixed size, over all texts: upper bounds, exact for all but a few terms. The tail of a vector stays out of the
inverted lists while no partner could reach the threshold from it alone: neither by its residual norm nor by the largest weights
of the other side. Any pair at or above the threshold then shares a listed term, and at the first one its product plus
the product of both residual norms reaches the threshold; pairs below are dropped inside the join, which deals the pairs of a long list out over several
tasks. So are pairs whose bitmaps show that one of them has more terms of its own than it may: the terms that a partner lacks weigh at most 1 - threshold² of
a unit vector's squares, and no number of terms weighs less than as many of the lightest. What is left gets the exact dot product.

With weighting "unit" all terms weigh the same, and multiset Jaccard >= j implies cosine >= 2j/(1+j).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import bags

def raw_weights(f: np.ndarray, df: np.ndarray, n_texts: int, weighting: str) -> np.ndarray:
    if weighting == "unit":
        return np.ones(len(f))
    return np.log1p(n_texts / np.maximum(bags.look_up(df, f), 1))


def unit(f: np.ndarray, n: np.ndarray, df: np.ndarray, n_texts: int, weighting: str) -> np.ndarray:
    w = raw_weights(f, df, n_texts, weighting)
    starts = np.cumsum(n) - n
    return w / np.repeat(np.sqrt(np.add.reduceat(w * w, starts)), n)


def largest(texts: DataFrame, df, n_texts: int, weighting: str) -> dict[bool, np.ndarray]:  # noqa: ANN001
    """Largest weight of any text per bucket of the sketch, for each side."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(df.value)
        most = np.zeros((2, size), np.float64)
        for b in batches:
            f, n = bags.blobs(b.column(0))
            if not len(n):
                continue
            w = unit(f, n, df.value, n_texts, weighting)
            held = np.repeat(np.asarray(b.column(1)).astype(np.int64), n)
            for at in bags.buckets(f, size // bags.BUCKETS):
                np.maximum.at(most.reshape(-1), held * size + at, w)
        for s in (0, 1):
            at = np.flatnonzero(most[s])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), s)), pa.array(at), pa.array(most[s][at])], ["side", "bucket", "w"])

    got = texts.select("feats", F.col("held").cast("int")).mapInArrow(run, "side long, bucket long, w double").groupBy("side", "bucket").agg(F.max("w").alias("w")).toPandas()  # twice the sketch's rows at most
    out = {}
    for s in (0, 1):
        out[bool(s)] = np.zeros(len(df.value))
        own = got[got.side == s]
        out[bool(s)][own.bucket.to_numpy()] = own.w.to_numpy()
    return out


def listed(batches: Iterator[pa.RecordBatch], df, most, n_texts: int, weighting: str, least: float, bits: tuple[str, ...]) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
    """Entries of the inverted lists: feature, class, weight, residual norm after it, size, terms to spare, side and bitmaps."""
    for b in batches:
        f, n = bags.blobs(b.column("feats"))
        if not len(n):
            continue
        w = unit(f, n, df.value, n_texts, weighting)
        doc = np.repeat(np.arange(len(n)), n)
        light = (w * w)[np.lexsort((w, doc))]
        upto = np.cumsum(light)
        upto -= np.repeat(upto[np.cumsum(n) - n] - light[np.cumsum(n) - n], n)
        spare = np.bincount(doc[upto <= 1 - least * least + 1e-7], minlength=len(n)).astype(np.int32)
        order = np.lexsort((f, bags.look_up(df.value, f), doc))  # rare first within each text
        f, w = f[order], w[order]
        held = np.repeat(np.asarray(b.column("held")).astype(bool), n)
        other = np.where(held, bags.look_up(most.value[False], f), bags.look_up(most.value[True], f))
        ends = np.cumsum(n)

        def tail(x: np.ndarray) -> np.ndarray:
            """Sum of x from each entry to the end of its text."""
            c = np.append(0.0, np.cumsum(x))
            return np.repeat(c[ends], n) - c[:-1]  # noqa: B023

        rest = tail(w * w)
        bound = np.minimum(np.sqrt(np.maximum(rest, 0)), tail(w * other))
        keep = bound >= least - 1e-7
        after = np.sqrt(np.maximum(rest - w * w, 0) + 1e-9)
        k1, size, *maps = (np.asarray(b.column(c))[doc][keep] for c in ("k1", "n", *bits))
        spare = spare[doc][keep]
        yield pa.RecordBatch.from_arrays([pa.array(f[keep].view(np.int64)), pa.array(k1), pa.array(w[keep].astype(np.float32)), pa.array(after[keep].astype(np.float32)), pa.array(size), pa.array(spare), pa.array(held[keep]), *map(pa.array, maps)], ["f", "k1", "w", "after", "n", "spare", "held", *bits])


def dots(batches: Iterator[pa.RecordBatch], df, n_texts: int, weighting: str, least: float) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
    """Exact dot product and multiset Jaccard of candidate classes."""
    for b in batches:
        fa, na = bags.blobs(b.column("fa"))
        fb, nb = bags.blobs(b.column("fb"))
        if not len(na):
            continue
        rows = np.arange(len(na))
        pair = np.concatenate([np.repeat(rows, na), np.repeat(rows, nb)])
        f = np.concatenate([fa, fb])
        w = np.concatenate([unit(fa, na, df.value, n_texts, weighting), unit(fb, nb, df.value, n_texts, weighting)])
        order = np.lexsort((f, pair))
        f, pair, w = f[order], pair[order], w[order]
        same = (f[1:] == f[:-1]) & (pair[1:] == pair[:-1])
        dot = np.bincount(pair[1:][same], w[1:][same] * w[:-1][same], len(na))
        both = np.bincount(pair[1:][same], minlength=len(na))
        t = pa.Table.from_batches([b]).select(["a1", "a2", "b1", "b2"]).append_column("cosine", pa.array(dot)).append_column("jaccard", pa.array(both / (na + nb - both)))
        yield from t.filter(pa.array(dot >= least - 1e-9)).combine_chunks().to_batches()


def cosine_join(texts: DataFrame, least: float, weighting: str = "unit", jaccard: float | None = None) -> DataFrame:
    """Pairs of a class with held-out texts (a1, a2) and one with training texts (b1, b2) whose cosine is ``least`` or more, with the exact
    cosine and multiset Jaccard. ``texts``: a written table of ``bags`` with a boolean ``held``. ``jaccard`` (unit weights
    only): also drop in the join what sizes and bitmaps show to be below it."""
    spark = texts.sparkSession
    count, n_texts = bags.frequencies(texts, 1 if weighting == "unit" else bags.HASHES)
    df = spark.sparkContext.broadcast(count)
    most = spark.sparkContext.broadcast(largest(texts, df, n_texts, weighting))
    bits = ("bm",) if jaccard is not None else ("w0", "w1", "w2", "w3")  # uneven weights leave more terms to spare, so more has to be seen of them
    classes = texts.select("k1", "k2", "held", "n", *bits, "feats").dropDuplicates(["k1", "k2", "held"])
    lists = materialize(classes.mapInArrow(lambda it: listed(it, df, most, n_texts, weighting, least, bits), f"f long, k1 long, w float, after float, n int, spare int, held boolean, {', '.join(f'{x} long' for x in bits)}"), "lists")
    lists = bags.parts(lists, "f")
    a, b = bags.dealt(lists.filter("held"), False).alias("a"), bags.dealt(lists.filter("not held"), True).alias("b")
    alone = lambda x, y: " + ".join(f"bit_count({x}.{c} & ~{y}.{c})" for c in bits)
    reach = F.expr(f"double(a.w) * b.w + double(a.after) * b.after >= {least - 1e-4}D AND {alone('a', 'b')} <= a.spare AND {alone('b', 'a')} <= b.spare")
    if jaccard is not None:
        reach = reach & bags.close_enough(jaccard)
    pairs = a.join(b, (F.col("a.f") == F.col("b.f")) & (F.col("a.part") == F.col("b.part")) & reach).select(F.col("a.k1").alias("a1"), F.col("b.k1").alias("b1")).distinct()
    left = classes.filter("held").select(F.col("k1").alias("a1"), F.col("k2").alias("a2"), F.col("feats").alias("fa"))
    right = classes.filter("not held").select(F.col("k1").alias("b1"), F.col("k2").alias("b2"), F.col("feats").alias("fb"))
    full = pairs.join(left, "a1").join(right, "b1").select("a1", "a2", "fa", "b1", "b2", "fb")
    return full.mapInArrow(lambda it: dots(it, df, n_texts, weighting, least), "a1 long, a2 long, b1 long, b2 long, cosine double, jaccard double")


def split_bags(clips: DataFrame, splits: DataFrame, least_words: int, text: str = "text", held: tuple[str, ...] = ("dev", "test"), train: str = "train") -> DataFrame:
    """``bags`` of all clips that have a split, with that split: trimmed and lower-cased; repeated rows of a clip or split count once;
    nulls and other splits take no part."""
    own = splits.select("id", F.lower(F.trim(F.regexp_replace("split", r"(?U)^\s+|\s+$", ""))).alias("split")).filter(F.col("split").isin(train, *held)).distinct()
    all_ = bags.bags(clips, "id", F.col(text), least_words)
    return materialize(all_.join(own, "id").dropDuplicates(["id", "split"]).withColumn("held", F.col("split") != train), "split-bags")


def overlaps(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs of ids (held-out clip first) with both splits."""
    m = lambda c, s: texts.filter(c).select(F.col("id").alias(f"{s}_id"), F.col("split").alias(f"{s}_split"), F.col("k1").alias(f"{s}1"), F.col("k2").alias(f"{s}2")).distinct()
    return pairs.join(m("held", "a"), ["a1", "a2"]).join(m("not held", "b"), ["b1", "b2"]).select(F.col("a_id").alias("held_id"), F.col("a_split").alias("held_split"), F.col("b_id").alias("train_id"), "cosine", "jaccard").filter("held_id <> train_id").distinct()
