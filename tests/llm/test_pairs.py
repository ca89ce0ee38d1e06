"""Near-duplicates and cross-split overlaps against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dokuma.functions.text import words
from dokuma.llm import bags, cross_split, near_dup
from dokuma.session import materialize

from .helpers import LONG, clips, rows


def similar(a, b):
    x, y = Counter(words(a)), Counter(words(b))
    if sum(x.values()) < 12 or sum(y.values()) < 12:
        return False
    return 10 * sum((x & y).values()) >= 7 * sum((x | y).values())


def planted(n=60, seed=5):
    r = random.Random(seed)
    vocab = [f"söz{i}" for i in range(400)]
    out = []
    for i in range(n):
        base = [r.choice(vocab) for _ in range(r.randint(12, 24))]
        out.append(base)
        for _ in range(r.randint(0, 3)):
            t = list(base)
            for _ in range(r.randint(0, 4)):
                k = r.randrange(len(t))
                t[k : k + 1] = r.choice([[], [r.choice(vocab)], [t[k], r.choice(vocab)]])
            r.shuffle(t)
            out.append(t)
    return [" ".join(t) for t in out]


def table(spark, texts, extra_rows=()):
    data = [(f"c{i:04d}", 1, "k", 1.0, t) for i, t in enumerate(texts)]
    return clips(spark, [*data, *data[:5], *extra_rows])


def test_all_pairs_found(spark):
    texts = planted() + ["", "   ", "kısa metin", LONG, LONG + " son", "AYNI " * 12, "aynı " * 12]
    df = table(spark, texts, [("z1", None, None, None, None), (None, 1, "k", 1.0, texts[0])])
    members, pairs = near_dup.near_duplicates(bags.bags(df, "id", F.col("text"), 12), 0.7)
    got = {(a, b) for a, b in rows(near_dup.expand(members, pairs))}
    want = {(f"c{i:04d}", f"c{j:04d}") for i in range(len(texts)) for j in range(i + 1, len(texts)) if similar(texts[i], texts[j])}
    assert got == want and len(want) > 30


@pytest.mark.parametrize(("hot", "crowd"), [(20, 5_000), (20, 7), (2000, 5_000)])
def test_template_that_fills_bands(spark, monkeypatch, hot, crowd):
    """Many texts share most of their words, yet few pairs reach the threshold; also where crowded words are dealt out."""
    monkeypatch.setattr(bags, "CROWD", crowd)
    r = random.Random(11)
    template = [f"kalıp{i}" for i in range(12)]
    texts = [" ".join(template + [f"özel{r.randrange(300)}" for _ in range(4)]) for _ in range(250)] + planted(10)
    b = materialize(bags.bags(table(spark, texts), "id", F.col("text"), 12))
    got = {(x, y) for x, y in rows(near_dup.expand(b.select("id", "k1", "k2").distinct(), near_dup.class_pairs(b, 0.7, hot=hot)))}
    assert got == {(f"c{i:04d}", f"c{j:04d}") for i in range(len(texts)) for j in range(i + 1, len(texts)) if similar(texts[i], texts[j])} and got


def test_hot_bands_stay_where_they_are(spark, monkeypatch):
    """Bands listed as hot are dealt out over tasks; the pairs are the same."""
    r = random.Random(12)
    template = [f"kalıp{i}" for i in range(14)]
    texts = [" ".join(template + [f"özel{r.randrange(300)}" for _ in range(3)]) for _ in range(150)] + planted(10)
    b = materialize(bags.bags(table(spark, texts), "id", F.col("text"), 12))
    hot = near_dup.hot_bands(b, near_dup.ROWS, near_dup.BANDS, among=1, least=20)
    assert hot is not None and near_dup.hot_bands(b, near_dup.ROWS, near_dup.BANDS) is None
    want = sorted(map(tuple, near_dup.class_pairs(b, 0.7).select("a1", "b1").collect()))
    monkeypatch.setattr(near_dup, "hot_bands", lambda *_: hot)
    assert sorted(map(tuple, near_dup.class_pairs(b, 0.7).select("a1", "b1").collect())) == want and want


def test_groups_cover_links(spark):
    texts = planted(20, 9)
    members, pairs = near_dup.near_duplicates(bags.bags(table(spark, texts), "id", F.col("text"), 12), 0.7)
    group = {r.id: r.group_id for r in near_dup.groups(members, pairs).collect()}
    for a, b in rows(near_dup.expand(members, pairs)):
        assert group[a] == group[b]
    assert len(group) == sum(len(words(t)) >= 12 for t in texts)


def test_empty(spark):
    df = clips(spark, [])
    members, pairs = near_dup.near_duplicates(bags.bags(df, "id", F.col("text"), 12), 0.7)
    assert rows(near_dup.expand(members, pairs)) == [] and rows(near_dup.groups(members, pairs)) == []


def test_hot_copies_collapse_before_comparison(spark):
    """A group of copies is one class: comparisons see it once."""
    one = " ".join(f"w{i}" for i in range(15))
    df = spark.range(3000).select(F.concat(F.lit("c"), F.lpad("id", 6, "0")).alias("id"), F.lit(one).alias("text"))
    members, pairs = near_dup.near_duplicates(bags.bags(df, "id", F.col("text"), 12), 0.7)
    assert members.select("k1", "k2").distinct().count() == 1 and members.count() == 3000 and pairs.count() == 0


def test_estimate_is_close():
    r = np.random.default_rng(1)
    both, own = r.integers(0, 2**63, 70).astype(np.uint64), r.integers(0, 2**63, (2, 15)).astype(np.uint64)
    a, b = np.concatenate([both, own[0]]), np.concatenate([both, own[1]])
    ra, rb = (near_dup.registers(x, np.array([0]), 2000) for x in (a, b))
    got = near_dup.estimates(ra, rb, np.array([85]), np.array([85]))[0]
    assert abs(got - 0.7) < 0.05
    other = near_dup.registers(r.integers(0, 2**63, 85).astype(np.uint64), np.array([0]), 2000)
    assert near_dup.estimates(ra, other, np.array([85]), np.array([85]))[0] < 0.03


def test_estimate_drops_no_pair():
    """Of 4,000 pairs at the threshold the estimate lets all pass: it rejects only what is six deviations below."""
    r = np.random.default_rng(2)
    n, low = 20, []
    for _ in range(40):
        f = r.integers(0, 2**63, (100, 23)).astype(np.uint64)  # 17 shared and 3 own features each: 17/23
        a, b = np.sort(f[:, :20], 1), np.sort(np.concatenate([f[:, :17], f[:, 20:]], 1), 1)
        at, size = np.arange(100) * n, np.full(100, n)
        low.append(near_dup.estimates(near_dup.registers(a.reshape(-1), at, 220), near_dup.registers(b.reshape(-1), at, 220), size, size).min())
    assert min(low) > 0.7 - near_dup.MARGIN + 0.05


def test_sketch_of_frequencies(spark):
    b = materialize(bags.bags(table(spark, planted(40, 2)), "id", F.col("text"), 12))
    count, n = bags.frequencies(b)
    own = Counter(f for r in b.select("feats").collect() for f in np.frombuffer(bytes(r.feats), np.uint64).tolist())
    f = np.array(list(own), np.uint64)
    assert n == b.count() and bags.look_up(count, f).tolist() == list(own.values())


@settings(max_examples=30, deadline=None)
@given(st.lists(st.sampled_from("abcdefgh"), min_size=1, max_size=20), st.lists(st.sampled_from("abcdefgh"), min_size=1, max_size=20))
def test_features_are_multisets(a, b):
    h = bags.Hasher()
    f = bags.features(np.array(h(a) + h(b), np.uint64), np.array([0, len(a)]))
    shared = len(set(f[: len(a)].tolist()) & set(f[len(a) :].tolist()))
    assert shared == sum((Counter(a) & Counter(b)).values())


def split_table(spark, pairs):
    return spark.createDataFrame(pairs, "id string, split string")


@pytest.mark.parametrize(("weighting", "crowd"), [("unit", 5_000), ("idf", 5_000), ("idf", 2)])
def test_cross_split(spark, monkeypatch, weighting, crowd):
    monkeypatch.setattr(bags, "CROWD", crowd)
    texts = planted(50, 7)
    r = random.Random(3)
    of = {f"c{i:04d}": r.choice([" Train", "train", "dev", "TEST ", "rest", None]) for i in range(len(texts))}
    splits = split_table(spark, [*of.items(), *list(of.items())[:4], ("nobody", "train"), (None, "dev")])
    b = cross_split.split_bags(table(spark, texts, [("z", None, None, None, None)]), splits, 12)
    side = {k: (v or "").strip().lower() for k, v in of.items()}
    held = [k for k, v in side.items() if v in ("dev", "test")]
    train = [k for k, v in side.items() if v == "train"]
    t = {f"c{i:04d}": x for i, x in enumerate(texts)}
    if weighting == "unit":
        p = cross_split.cosine_join(b, 1.4 / 1.7, jaccard=0.7).filter("jaccard >= 0.7 - 1e-12")
        got = {(x[0], x[2]) for x in rows(cross_split.overlaps(b, p))}
        assert got == {(h, k) for h in held for k in train if similar(t[h], t[k])} and got
    else:
        got = {(x[0], x[2]): x[3] for x in rows(cross_split.overlaps(b, cross_split.cosine_join(b, 0.6, "idf")))}
        assert got == pytest.approx(brute_idf(b, 0.6), abs=1e-6) and got


def brute_idf(b, least):
    data = [(r.id, r.held, np.frombuffer(bytes(r.feats), np.uint64)) for r in b.select("id", "held", "feats").collect()]
    count, n = bags.frequencies(b)
    unit = {}
    for i, held, f in data:
        w = cross_split.unit(f, np.array([len(f)]), count, n, "idf")
        unit[i] = (held, dict(zip(f.tolist(), w.tolist())))
    out = {}
    for i, (h, x) in unit.items():
        for j, (g, y) in unit.items():
            if h and not g:
                c = sum(v * y.get(k, 0) for k, v in x.items())
                if c >= least:
                    out[i, j] = c
    return out


def test_cross_split_empty(spark):
    b = cross_split.split_bags(clips(spark, []), split_table(spark, []), 12)
    assert rows(cross_split.overlaps(b, cross_split.cosine_join(b, 0.8))) == []
