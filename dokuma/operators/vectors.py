"""Embeddings: group consistency, centroids, cross-group pairs, margins and average-linkage clustering."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vector import dot, unit


def dimension_sums(df: DataFrame, group: str, vector: str) -> DataFrame:
    """(group, n, sums): per-dimension sums of unit vectors, with map-side combine over (group, dimension)."""
    d = df.filter(F.col(vector).isNotNull()).select(group, F.posexplode(unit(F.col(vector))).alias("i", "x")).groupBy(group, "i").agg(F.sum("x").alias("s"), F.count("*").alias("n"))
    return d.groupBy(group).agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("i", "s"))).alias("v")).select(group, "n", F.transform("v", lambda x: x["s"]).alias("sums"))


def consistency(df: DataFrame, group: str, vector: str) -> DataFrame:
    """(group, n, mean_cosine) over all pairs i < j of a group, from sums alone: the squared length of the sum of n unit vectors is n plus twice the
    sum over pairs. No pair is formed, so groups may be of any size. Groups below two vectors have null."""
    s = dimension_sums(df, group, vector)
    return s.select(group, "n", F.when(F.col("n") > 1, (dot(F.col("sums"), F.col("sums")) - F.col("n")) / (F.col("n") * (F.col("n") - 1))).alias("mean_cosine"))


def centroids(df: DataFrame, group: str, vector: str) -> DataFrame:
    """(group, n, center): normalised mean vectors."""
    return dimension_sums(df, group, vector).select(group, "n", unit(F.col("sums")).alias("center"))


def margins(df: DataFrame, centers: DataFrame, group: str, vector: str, key: str, most_centers: int = 10_000) -> DataFrame:
    """(key, own, other, margin): cosine to the own centre, the best other one, and their difference. The centres are dealt into blocks of at most ``most_centers``, each block
    is held as one matrix, and rows meet all blocks: products of matrices over whole Arrow batches, no pair of rows is ever formed. Only the best of each block leaves a task."""
    c = centers.select(F.col(group).cast("string").alias("name"), "center").filter("center is not null")
    blocks = max(1, -(-c.count() // most_centers))
    kind = dict(df.dtypes)[key]
    out = None
    for block in range(blocks):
        own = c if blocks == 1 else c.filter(F.pmod(F.xxhash64("name"), F.lit(blocks)) == block)
        rows = own.collect()  # a block: about ``most_centers`` rows
        held = df.sparkSession.sparkContext.broadcast(({r["name"]: i for i, r in enumerate(rows)}, np.array([r["center"] for r in rows], float)))

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            where, m = held.value
            norm = np.linalg.norm(m, axis=1) if len(m) else np.zeros(0)
            for b in batches:
                vs, mine = b.column(2).to_pylist(), np.array([where.get(g, -1) for g in b.column(1).to_pylist()], int)
                ok = np.array([v is not None and len(v) == m.shape[-1] for v in vs]) if len(m) else np.zeros(len(vs), bool)
                own, other = np.full(len(vs), np.nan), np.full(len(vs), np.nan)
                if ok.any():
                    x = np.array([v for v, k in zip(vs, ok) if k], float)
                    s = x @ m.T / np.maximum(np.linalg.norm(x, axis=1)[:, None] * norm[None, :], 1e-300)
                    at, has = mine[ok], mine[ok] >= 0
                    r = np.arange(len(x))
                    own[ok] = np.where(has, s[r, np.maximum(at, 0)], np.nan)
                    s[r[has], at[has]] = -np.inf
                    best = s.max(1)
                    other[ok] = np.where(np.isfinite(best), best, np.nan)
                yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(y, pa.float64(), from_pandas=True) for y in (own, other)]], [key, "own", "other"])

        part = df.select(key, F.col(group).cast("string").alias("g"), vector).mapInArrow(run, f"{key} {kind}, own double, other double")
        out = part if out is None else out.unionByName(part)
    if blocks > 1:
        out = out.groupBy(key).agg(F.max("own").alias("own"), F.max("other").alias("other"))
    return out.withColumn("margin", F.col("own") - F.col("other"))


def center_pairs(centers: DataFrame, group: str) -> DataFrame:
    """Similarities of all pairs of centres i < j: a stated set against itself."""
    a, b = centers.alias("a"), centers.alias("b")
    return a.join(b, F.col(f"a.{group}") < F.col(f"b.{group}")).select(F.col(f"a.{group}").alias("a"), F.col(f"b.{group}").alias("b"), dot(F.col("a.center"), F.col("b.center")).alias("cosine"))


def similarity_groups(pairs: DataFrame, channels: DataFrame, ps: dict[str, float]) -> DataFrame:
    """(kind, n, mean and percentiles) of the similarities of ``center_pairs``: of recordings of the same channel and of different ones. ``channels``: (group, channel)."""
    from .stats import linear_percentiles

    c = lambda s: channels.select(F.col("group").alias(s), F.col("channel").alias(f"c{s}"))
    kind = F.when(F.col("ca") == F.col("cb"), "same_channel").otherwise("cross_channel")
    d = pairs.join(c("a"), "a").join(c("b"), "b").select(kind.alias("kind"), "cosine")
    return linear_percentiles(d, ["kind"], "cosine", ps).join(d.groupBy("kind").agg(F.avg("cosine").alias("mean")), "kind")


def average_linkage(x: np.ndarray, threshold: float) -> np.ndarray:
    """Labels of agglomerative clustering of unit vectors: clusters of least mean cosine distance merge while it is below 1 - threshold. Labels by first member."""
    n = len(x)
    dist = 1.0 - x @ x.T
    np.fill_diagonal(dist, np.inf)
    size, label = np.ones(n), np.arange(n)
    while n > 1:
        i, j = divmod(int(np.argmin(dist)), len(x))
        if not dist[i, j] <= 1 - threshold:
            break
        i, j = min(i, j), max(i, j)
        row = (size[i] * dist[i] + size[j] * dist[j]) / (size[i] + size[j])
        dist[i], dist[:, i] = row, row
        dist[i, i] = np.inf
        dist[j], dist[:, j] = np.inf, np.inf
        size[i] += size[j]
        label[label == j] = i
    return np.unique(label, return_inverse=True)[1]


def cluster(centers: DataFrame, key: str, threshold: float, most: int = 5_000) -> DataFrame:
    """(key, cluster) by average linkage over at most ``most`` centres, in one task; the pairwise distances of more need not fit and are refused."""
    if centers.count() > most:
        raise ValueError(f"average linkage holds all pairwise distances: at most {most} centres")
    kind = dict(centers.dtypes)[key]

    def run(t: pa.Table) -> pa.Table:
        rows = sorted(t.to_pylist(), key=lambda r: r[key])
        labels = average_linkage(np.array([r["center"] for r in rows], float), threshold)
        return pa.table({key: pa.array([r[key] for r in rows], t.schema.field(key).type), "cluster": pa.array(labels, pa.int64())})

    return centers.select(key, "center", F.lit(1).alias("_all")).groupBy("_all").applyInArrow(run, f"{key} {kind}, cluster long")


def pair_extremes(df: DataFrame, group: str, vector: str, key: str, seed: str, most: int = 12) -> DataFrame:
    """(group, n, mean, least) cosine over all pairs of the first ``most`` vectors of each group in hash order: the bound is the operator's own (few clips stand for a
    recording), so a group holds at most ``most`` vectors. Groups below two vectors have null."""
    from .selection import first_n

    few = first_n(df.filter(F.col(vector).isNotNull()), group, seed, most, key)
    kind = dict(df.dtypes)[group]

    def run(t: pa.Table) -> pa.Table:
        x = np.array(t.column(vector).to_pylist(), float)
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
        s = (x @ x.T)[np.triu_indices(len(x), 1)]
        return pa.table({group: t.column(group).slice(0, 1), "n": [len(x)], "mean": pa.array([float(s.mean()) if len(s) else None], pa.float64()), "least": pa.array([float(s.min()) if len(s) else None], pa.float64())})

    return few.select(group, vector).groupBy(group).applyInArrow(run, f"{group} {kind}, n long, mean double, least double")
