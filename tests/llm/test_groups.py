"""Caps, repeated lines, grouped splits, percentiles and packing."""

import json
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dokuma.functions.text import DIGITS, channel_name, words
from dokuma.llm import cap, components, group_split, lines, packing, percentiles, queries

from .helpers import LONG, clips, documents, rows

CH = ["Ana  Kanal", "ANA KANAL", "ana kanal", "Öbür", "Üçüncü"]


def cap_rows(n=300, seed=1):
    r = random.Random(seed)
    metric = lambda: r.choice([json.dumps({"dnsmos_ovrl": round(r.uniform(1, 5), 1)}), json.dumps({"dnsmos_ovrl": "3,5"}), json.dumps({"dnsmos_ovrl": None}), "{", None, "[]", '{"dnsmos_ovrl": "NaN"}', "{}"])
    return [(f"c{i:03d}", i % 9, r.choice(CH + [None]), r.choice([1.0, 2.0, None, 0.0]), "t", None, metric()) for i in range(n)]


def score(m):
    try:
        v = json.loads(m)["dnsmos_ovrl"]
        v = float(v.replace(",", ".")) if isinstance(v, str) else float(v)
        return v if math.isfinite(v) else None
    except (TypeError, ValueError, KeyError):
        return None


def test_over_cap_is_a_ranking(spark):
    data = cap_rows()
    got = {r[0] for r in rows(cap.over_cap(cap.scored_clips(clips(spark, data + data[:20])), "channel", cap.quality(), share=0.05).select("id"))}
    by, total = defaultdict(list), 0
    for i, _, c, d, _, _, m in data:
        if c is not None:
            total += 1
            s = score(m)
            by[channel_name(c)].append((s is None, -(s or 0), d is None, -(d or 0), i))
    want = {x[-1] for v in by.values() for x in sorted(v)[total // 20 :]}
    assert got == want


def test_strata_share_the_cap(spark):
    data = [(f"a{i:03d}", "x", i % 10 < 7, float(i)) for i in range(100)] + [(f"b{i}", "y", None, 1.0) for i in range(3)] + [("n", None, None, 1.0)]
    df = spark.createDataFrame(data, "id string, owner string, topic boolean, q double").withColumn("_rank", F.lit(0)).withColumn("_slots", F.lit(0))
    left = df.join(cap.over_cap(df, "owner", [F.desc("q"), F.asc("id")], cap=10, stratum="topic"), "id", "left_anti")
    kept = Counter((r.owner, r.topic) for r in left.collect())
    assert kept == {("x", True): 7, ("x", False): 3, ("y", None): 3, (None, None): 1}
    assert min(r.q for r in left.filter("owner = 'x' AND topic").collect()) == sorted((x[3] for x in data if x[1] == "x" and x[2]), reverse=True)[6]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=8), st.integers(0, 120))
def test_apportion(sizes, c):
    got = cap.apportion(sizes, c)
    assert sum(got) == min(c, sum(sizes)) and all(0 <= g <= s for g, s in zip(got, sizes))


def test_spare_slots_go_to_the_others(spark):
    """Weights of the whole collection: a stratum that the contributor hardly has is filled, and what it leaves goes to the others by their weights."""
    assert cap.apportion([2, 50, 40], 30, [60, 30, 10]) == [2, 21, 7] and cap.apportion([5, 5], 20, [1, 9]) == [5, 5] and cap.apportion([9, 9, 9], 10) == [4, 3, 3]
    data = [(f"a{i:03d}", "x", "big" if i < 2 else "small", float(i)) for i in range(60)] + [(f"b{k}{i}", f"y{k}", "big", 1.0) for k in range(40) for i in range(9)]
    df = spark.createDataFrame(data, "id string, owner string, topic string, q double")
    left = df.join(cap.over_cap(df, "owner", [F.desc("q"), F.asc("id")], cap=20, stratum="topic", balanced=True), "id", "left_anti")
    assert Counter(r.topic for r in left.filter("owner = 'x'").collect()) == {"big": 2, "small": 18}


def test_cap_empty(spark):
    assert rows(cap.over_cap(cap.scored_clips(clips(spark, [])), "channel", cap.quality(), share=0.05)) == []


NOTICE = "Kanalımıza abone olmayı unutmayın, bölüm {}"


def line_table():
    data = [(f"c{i:02d}", i % 7, CH[i % 3], 1.0, f"Satır başı {i} bir iki üç\r\n{NOTICE.format(i)}\nson söz {i}\nDinlediğiniz için çok teşekkür ederiz") for i in range(12)]
    data += [("d1", None, "ana kanal", 1.0, NOTICE.format(7)), ("d2", 3, "Öbür", 1.0, NOTICE.format(7)), ("d3", 1, None, 1.0, NOTICE.format(1)), ("d4", 1, "ana kanal", 1.0, None), ("d5", 1, "ana kanal", 1.0, "  \n\n "), ("d6", 2, "ana kanal", 1.0, LONG)]
    return data + data[:3]


def brute_lines(data, support=5, with_edges=True):
    """(places of long lines in blocks, all places that go) by plain loops."""
    at, held, follow = defaultdict(list), defaultdict(set), defaultdict(set)
    for i, s, c, _, t, *_ in set(data):
        if c is not None and t is not None:
            own = [(k, tuple(DIGITS.sub("0", w) for w in words(x))) for k, x in enumerate(t.split("\n")) if words(x)]
            for n, (k, key) in enumerate(own):
                at[i].append((k, n, (channel_name(c), key)))
                if s is not None:
                    held[channel_name(c), key].add(s)
    nodes = {x for x, ss in held.items() if len(ss) >= support}
    source = {d[0]: d[1] for d in data}
    for i, ls in at.items():
        kept = [x for x in ls if x[2] in nodes]
        for x, y in zip(kept, kept[1:]):
            if y[1] == x[1] + 1 and source[i] is not None:
                follow[x[2], y[2]].add(source[i])
    block = {x: x for x in nodes} | truth([e for e, ss in follow.items() if len(ss) >= support and with_edges])
    whole = {block[x] for x in nodes if len(x[1]) >= 4}
    found, gone = set(), set()
    for i, ls in at.items():
        row = []
        for x in [*[x for x in ls if x[2] in nodes], None]:
            if row and (x is None or block[x[2]] != block[row[-1][2]] or x[1] != row[-1][1] + 1):
                if block[row[0][2]] in whole and any(len(y[2][1]) >= 4 for y in row):
                    gone |= {(i, y[0]) for y in row}
                    found |= {(i, y[0]) for y in row if len(y[2][1]) >= 4}
                row = []
            row.append(x)
    return found, gone


def test_repeated_lines(spark):
    data = line_table()
    found, places = lines.boilerplate(clips(spark, data))
    want, gone = brute_lines(data)
    assert {tuple(r) for r in places.filter("long").select("id", "line_no").collect()} == want and want
    assert {tuple(r) for r in places.select("id", "line_no").collect()} == gone and len(gone) > len(want)
    assert found.count() >= 1
    clean = {r.id: (r.text_clean, r.n_removed) for r in lines.cleaned(clips(spark, data), places).collect()}
    assert clean["d1"] == ("", 1) and clean["d2"] == (NOTICE.format(7), 0) and clean["d4"] == (None, 0)
    assert NOTICE.format(3) not in clean["c03"][0]


def test_lines_empty(spark):
    found, places = lines.boilerplate(clips(spark, []))
    assert rows(found) == rows(places) == [] and rows(lines.cleaned(clips(spark, []), places)) == []


def test_consecutive_lines_form_one_block(spark):
    data = [(f"c{i}", i, "k", 1.0, f"başka satır {'abcdefgh'[i]} x y\nilk tekrar eden satır burada\n\nikinci tekrar eden satır burada") for i in range(6)]
    b = lines.boilerplate(clips(spark, data))[0]
    assert b.count() == 2 and b.select("block").distinct().count() == 1


def test_edges_decide_what_goes(spark):
    """A short line goes with the notice it belongs to, and stays where it stands alone; without edges it stays everywhere."""
    data = [(f"c{i}", i, "k", 1.0, f"{'abcdefgh'[i]} satırı burada duruyor işte\nKanala abone olmayı unutmayın\nHoşça kalın\nzili açmayı da unutmayın\n{'abcdefgh'[i]} ile bitti her şey") for i in range(6)]
    data += [(f"e{i}", i, "k", 1.0, f"Hoşça kalın\n{'abcdefgh'[i]} dedi ve gitti o da") for i in range(6)]
    nodes, occurrences = lines.repeated(lines.line_rows(clips(spark, data)))
    links = lines.edges(occurrences)
    cut = lambda e: {tuple(r) for r in lines.members(occurrences, lines.blocks(nodes, e)).select("id", "line_no").collect()}
    assert cut(links) == brute_lines(data)[1] == {(f"c{i}", k) for i in range(6) for k in (1, 2, 3)}
    assert cut(links.limit(0)) == brute_lines(data, with_edges=False)[1] == {(f"c{i}", k) for i in range(6) for k in (1, 3)}


def truth(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(parent)}


@pytest.mark.parametrize("task_edges", [500_000, 10])
def test_components(spark, task_edges):
    r = random.Random(4)
    edges = [(f"n{r.randrange(150):03d}", f"n{r.randrange(150):03d}") for _ in range(110)] + [("p%03d" % i, "p%03d" % (i + 1)) for i in range(40)] + [("hub", f"h{i}") for i in range(60)] + [(None, "x"), ("y", None), ("z", "z")]
    got = dict(rows(components.components(spark.createDataFrame(edges + edges[:9], "a string, b string"), "a", "b", task_edges)))
    want = {x: y for x, y in truth([e for e in edges if None not in e and e[0] != e[1]]).items()}
    assert got == want


def test_groups_stay_together(spark):
    r = random.Random(2)
    data = [(f"c{i:03d}", r.choice([None, *range(40)]), r.choice([None, *[f"k{j}" for j in range(30)]]), r.choice([1.0, 2.5, None, -1.0, float("nan")]), "t") for i in range(200)]
    out = group_split.assign(group_split.named(clips(spark, data + data[:10])), "source", "channel", "ms", {"train": 0.6, "dev": 0.2, "test": 0.2}).collect()
    assert len(out) == 200
    for col in ("source", "channel"):
        split = defaultdict(set)
        for x in out:
            if x[col] is not None:
                split[x[col]].add(x.split)
        assert all(len(s) == 1 for s in split.values())
    assert group_split.assign(group_split.named(clips(spark, [])), "source", "channel", "ms", {"train": 1.0}).count() == 0


def test_weightless_groups_follow_the_shares(spark):
    data = spark.createDataFrame([(f"i{k}", f"s{k}", f"c{k}", 0) for k in range(60)], "id string, source string, channel string, ms long")
    got = Counter(r.split for r in group_split.assign(data, "source", "channel", "ms", {"train": 0.9, "test": 0.1}).collect())
    assert got == {"train": 54, "test": 6}


def test_small_groups_are_dealt_to_the_targets(spark):
    """Thousands of groups below 1/10,000 of the total, of many sizes: every split ends within the smallest of them of its target."""
    r = random.Random(3)
    sizes = [r.randint(1, 4000) for _ in range(30_000)] + [3_000_000, 9_000_000]
    data = spark.createDataFrame([(f"i{k}", f"s{k}", None, w) for k, w in enumerate(sizes)], "id string, source string, channel string, ms long")
    got = Counter()
    for x in group_split.assign(data, "source", "channel", "ms", {"train": 0.9, "dev": 0.05, "test": 0.05}).groupBy("split").agg(F.sum("ms").alias("w")).collect():
        got[x.split] = x.w
    assert all(abs(got[k] / sum(sizes) - v) < 1e-4 for k, v in {"train": 0.9, "dev": 0.05, "test": 0.05}.items())


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 300), st.integers(1, 120), min_size=1, max_size=12))
def test_pouring_is_dealing_singly(classes):
    """Many equal groups at once end where dealing them one by one does."""
    shares = {"a": 0.7, "b": 0.2, "c": 0.1}
    want = dict.fromkeys(shares, 0)
    total = sum(k * n for k, n in classes.items())
    for size, n in sorted(classes.items(), reverse=True):
        for _ in range(n):
            best = max(shares, key=lambda k: shares[k] * total - want[k])
            want[best] += size
    got = dict.fromkeys(shares, 0)
    for (size, n), given in zip(classes.items(), group_split.deal(list(classes.items()), shares)):
        assert sum(given.values()) == n and min(given.values()) >= 0
        for k, c in given.items():
            got[k] += c * size
    assert all(abs(got[k] - want[k]) <= 2 * max(classes) for k in shares)


def test_linked_channels(spark):
    data = [("a", 1, "x"), ("b", 1, "y"), ("c", 2, "Y"), ("d", 2, "z"), ("e", None, "q"), ("f", None, "x"), ("g", 5, None), ("h", 6, "w")]
    roots = group_split.entity_groups(group_split.named(clips(spark, [(*d, 1.0, "t") for d in data])), "source", "channel")
    assert rows(group_split.linked_pairs(roots, "c")) == [("x", "y"), ("x", "z"), ("y", "z")]


def test_deal_is_close_to_the_shares():
    classes = [(s, 5) for s in (50, 30, 20, 10, 5, 5, 4, 3, 2, 1)]
    train = sum(s * g.get("train", 0) for (s, _), g in zip(classes, group_split.deal(classes, {"train": 0.8, "dev": 0.1, "test": 0.1})))
    assert abs(train / 650 - 0.8) < 0.05


@settings(max_examples=100, deadline=None)
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=2))
def test_order_preserving(xs):
    x = np.array(xs)
    k = percentiles.to_order(x)
    assert (percentiles.from_order(k) == x).all()
    assert ((k[:, None] < k[None, :]) == (x[:, None] < x[None, :])).all()


PS = [0.0, 0.01, 0.5, 0.99, 1.0]


def test_percentiles_exact_and_mergeable(spark):
    r = random.Random(8)
    data = [(g, r.choice([r.gauss(0, 1), -0.0, 0.0, 5e-324, -1e300, 2.0, 2.0])) for g in ("a", "b") for _ in range(400)] + [(None, 1.5)]
    df = spark.createDataFrame([(g, int(k)) for (g, _), k in zip(data, percentiles.to_order([v for _, v in data]))], "g string, v long")
    counted = df.groupBy("g", "v").agg(F.count("*").alias("n")).filter("g is not null")
    got = {(x.g, x.p): x.value for x in percentiles.percentiles(counted, ["g"], PS).collect()}
    for g in ("a", "b"):
        s = sorted(v for h, v in data if h == g)
        for p in PS:
            assert got[g, p] == s[max(1, math.ceil(p * len(s) - 1e-9)) - 1]
    halves = [percentiles.state(c, ["g"]) for c in (counted.filter("v < 0"), counted.filter("v >= 0"))]
    for x in percentiles.from_state(percentiles.merge(halves, ["g"]), ["g"], PS).collect():
        assert x.low <= got[x.g, x.p] <= x.high and (x.high - x.low <= 2**-20 * abs(got[x.g, x.p]) or abs(got[x.g, x.p]) < 1e-300)


def test_values_of_clips(spark):
    data = [("a", 1, " Kanal ", 2.0, "t", None, '{"x": "1,5", "y": null, "duration": 9, "z": true, "w": [1]}'), ("b", 1, "kanal", None, "t", None, '{"x": 1.5, "y": NaN'), ("c", 1, None, 3.0, "t", None, '{"x": 7}'), ("d", 1, "kanal", 2.0, "t", None, None)]
    got = rows(percentiles.clip_values(clips(spark, data + data[:1])).withColumn("v", percentiles.value_of("v")))
    assert got == [("kanal", "duration", 2.0, 2), ("kanal", "x", 1.5, 1)]
    assert rows(percentiles.percentiles(percentiles.clip_values(clips(spark, [])), ["channel", "metric"], PS)) == []


def test_states_of_files_add_up_for_all_metrics(spark, sf, tmp_path):
    clips_of = spark.read.parquet(f"{sf}/clips.parquet")
    clips_of.repartition(3, "source_id", "idx").unionByName(clips_of.limit(20).coalesce(1)).write.parquet(str(tmp_path / "clips.parquet"))  # some ids stand in two files
    files = {r.file for r in queries._file_states(spark, str(tmp_path)).select("file").distinct().collect()}
    assert len(files) >= 3 and "" not in files
    exact = {(r.channel, r.metric, r.p): (r.n_values, r.value) for r in queries.p6_percentiles(spark, sf).collect()}
    got = {(r.channel, r.metric, r.p): r for r in queries.p6_mergeable(spark, str(tmp_path)).collect()}
    assert got.keys() == exact.keys() and len({m for _, m, _ in got}) > 1
    assert all(got[k].n_values == n and got[k].low <= v <= got[k].high for k, (n, v) in exact.items())


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=20), st.integers(40, 60))
def test_plan_uses_each_length_once(histogram, capacity):
    used, bins = Counter(), 0
    for pattern, n in packing.plan(histogram, capacity):
        assert 0 < sum(pattern) <= capacity and n > 0
        bins += n
        for x in pattern:
            used[x] += n
    assert used == Counter(histogram)
    volume = sum(k * v for k, v in histogram.items())
    assert -(-volume // capacity) <= bins <= max(1, 2 * volume // capacity + 1)


def test_exact_complements_fill_up():
    plan = packing.plan({7: 3, 3: 3, 5: 2, 6: 1, 2: 2}, 10)
    assert sum(n for p, n in plan if sum(p) == 10) == sum(n for _, n in plan)


def test_pack(spark):
    r = random.Random(6)
    sizes = [(i, r.choice([0, 1, 5, 9, 10, 23, 100, 7, 7, 7])) for i in range(400)] + [(9999, 1_234)]
    df = spark.createDataFrame([(*s, 1) for s in sizes], "doc_id long, n_tokens long, rank int")
    out = packing.pack(df, 10).collect()
    total, spans = Counter(), defaultdict(list)
    for x in out:
        total[x.doc_id] += x.n_tokens
        if x.n_tokens:
            spans[x.container].append((x.place, x.place + x.n_tokens))
        else:
            assert x.container is None
    assert total == {i: n for i, n in sizes if n} | {i: 0 for i, n in sizes if not n}
    assert sorted(spans) == list(range(len(spans)))
    for s in spans.values():
        s.sort()
        assert s[0][0] == 0 and s[-1][1] <= 10 and all(a[1] == b[0] for a, b in zip(s, s[1:]))
    whole = Counter(x.doc_id for x in out)
    assert all(whole[i] == 1 for i, n in sizes if n <= 10)


def test_token_counts_round_trip(spark):
    texts = ["Merhaba dünya!", "", None, "a" * 5000, LONG]
    df = documents(spark, [(i, "s", t) for i, t in enumerate(texts)])
    got = dict(rows(packing.token_counts(df)))
    e = packing.encoder(packing.TOKENIZER)
    for i, t in enumerate(texts):
        ids = e.encode_ordinary(t or "")
        assert got[i] == len(ids) and e.decode(ids) == (t or "")
    assert packing.summary(packing.pack(packing.token_counts(documents(spark, [])), 10), 10).count() == 1
