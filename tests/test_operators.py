"""Operators against plain loops and planted cases."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from dokuma import config, providers, schema
from dokuma.operators import boilerplate, boundaries, browse, compare, dedupe, ledger, policy, quality, segment, selection, split, stats, vectors
from dokuma.operators.skew import hot_split_join, ranked, running_before


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_ranked_with_ties_nulls_and_clashing_names(spark):
    r = random.Random(1)
    data = [(r.choice(["a", "b", None]), r.choice([1.0, 2.0, None]), i) for i in range(500)]
    df = spark.createDataFrame(data, "_part string, v double, _n int")
    got = {(x._part, x._n): x.rank for x in ranked(df, ["_part"], [F.desc_nulls_last("v"), F.asc("_n")]).collect()}
    for g in ("a", "b", None):
        own = sorted((x for x in data if x[0] == g), key=lambda x: (x[1] is None, -(x[1] or 0), x[2]))
        assert [got[g, x[2]] for x in own] == list(range(1, len(own) + 1))
    assert ranked(df.limit(0), ["_part"], [F.asc("v")]).count() == 0


def test_running_sums(spark):
    r = random.Random(2)
    data = [(r.choice(["a", None]), i, r.choice([1.0, 0.25, None])) for i in range(300)]
    df = spark.createDataFrame(data, "g string, i int, v double")
    got = {x.i: x.s for x in running_before(df, ["g"], [F.asc("i")], F.col("v"), "s").collect()}
    for g in ("a", None):
        total = 0.0
        for x in (x for x in data if x[0] == g):
            assert got[x[1]] == total
            total += x[2] or 0.0


def test_hot_join(spark):
    left = spark.range(9000).select(F.when(F.col("id") < 4000, 0).otherwise(F.col("id") % 100).alias("k"), "id")
    right = left.groupBy("k").agg(F.count("*").alias("w"), F.max("id").alias("m")).filter("k < 50")
    got = hot_split_join(left, right, ["k"], "w")
    assert got.count() == left.filter("k < 50").count() and rows(got.groupBy("k").agg(F.max("m"))) == rows(right.select("k", "m"))


POLICY = policy.Policy.of({"version": 6, "rules": [{"metric": "speech_ratio", "min": 0.6}, {"metric": "x", "max": 1, "allow_missing": True}, {"flag_absent": ["oversize", "duplicate"]}]})


def test_policy(spark):
    data = [("a", {"speech_ratio": 0.5}, ["duplicate"]), ("b", {"speech_ratio": 0.9, "x": 2.0}, None), ("c", {}, []), ("d", {"speech_ratio": 0.6}, ["short"]), ("e", None, ["oversize", "duplicate"])]
    df = spark.createDataFrame(data, "id string, metrics map<string,double>, flags array<string>")
    got = {r.id: (r.exclusion_reasons, r.recommended) for r in POLICY.annotate(df).collect()}
    assert got == {"a": (["speech_ratio<0.6", "isaret:duplicate"], False), "b": (["x>1"], False), "c": (["eksik_olcum:speech_ratio"], False), "d": ([], True), "e": (["eksik_olcum:speech_ratio", "isaret:duplicate,oversize"], False)}
    with pytest.raises(ValueError):
        policy.Rule.of({"metric": "a", "most": 1})


def test_duplicates(spark):
    data = [("a", "Merhaba", 1.0, 0.5, ["x"]), ("b", "merhaba!", 1.0, 0.9, []), ("c", "merhaba", 1.0, 0.9, None), ("d", "merhaba", 2.0, 1.0, []), ("e", "", 1.0, 1.0, []), ("f", "!", 1.0, 1.0, []), ("g", "merhaba", None, 1.0, []), ("h", None, 1.0, 1.0, [])]
    df = spark.createDataFrame(data, "id string, text string, duration double, q double, flags array<string>")
    from dokuma.functions.text import dedupe_key

    m = dedupe.mark_duplicates(df, dedupe_key(F.col("text")), [F.col("duration")], F.col("q"), [F.col("id")])
    assert {r.id: r.duplicate_of for r in m.collect() if r.duplicate_of} == {"a": "b", "c": "b"}
    assert {r.id: r.flags for r in m.collect()}["a"] == ["x", "duplicate"] and m.count() == 8
    assert rows(dedupe.summary(m)) == [(2, 1)]


def plain_split(sources, hours, quota, seed):
    out = {}
    for ch in {c for _, c in sources}:
        own = sorted((s for s, c in sources if c == ch), key=lambda s: hashlib.sha256(f"{seed}:{ch}:{s}".encode()).hexdigest())
        left, room = {"test": quota, "dev": quota}, max(0, sum(hours.get(s, 0) > 0 for s in own) - 1)
        for s in own:
            out[s] = "train"
            options = [k for k in ("test", "dev") if left[k] > 0]
            if hours.get(s, 0) > 0 and room and options:
                out[s] = max(options, key=lambda k: (left[k], k == "test"))
                left[out[s]] -= hours[s]
                room -= 1
    return out


def test_split_assign(spark):
    r = random.Random(3)
    sources = [(i, r.choice("abcd")) for i in range(80)] + [(100, "z"), (101, "y"), (102, "y"), (103, "y")]
    hours = {i: r.choice([0.0, 0.2, 1.0, 5.0]) for i, _ in sources} | {101: 1.0, 102: 1.0, 103: 1.0}
    n = len({c for _, c in sources})
    got = {x.id: x.split for x in split.assign_sources(spark.createDataFrame(sources, "id int, channel string"), spark.createDataFrame(list(hours.items()), "source_id int, hours double"), 4.0, 4.0, "s").collect()}
    assert got == plain_split(sources, hours, 4.0 / n, "s")
    assert sorted(got[i] for i in (101, 102, 103)) == ["dev", "test", "train"]


WORDS = "Ali eve geldi. Sonra kapıyı açtı, içeri girdi. Anne nerede? dedi. Hava çok güzeldi; kuşlar ötüyordu. Dr. Ahmet Bey aradı.".split()


def words_table(spark, words, step=0.5, gaps=()):
    t, data = 0.0, []
    for i, w in enumerate(words):
        t += dict(gaps).get(i, 0.1)
        data.append((1, i, w, t, t + step, 0.9))
        t += step
    return spark.createDataFrame(data, schema.WORD)


@pytest.mark.parametrize("limits", [segment.Limits(), segment.Limits(min_sec=0.5, target_sec=2.0, max_sec=4.0), segment.Limits(max_sec=1.5, min_sec=0.1, target_sec=1.0)])
def test_segment_invariants(spark, limits):
    got = segment.segment(segment.gather_words(words_table(spark, WORDS * 5, gaps={20: 3.0, 41: 2.0}.items())), limits).orderBy("idx").collect()
    assert " ".join(c.text for c in got) == " ".join(WORDS * 5)
    assert [(c.a, c.b) for c in got] == list(zip([0] + [c.b for c in got[:-1]], [c.b for c in got]))
    for c, d in zip(got, got[1:]):
        assert c.end <= d.start + 1e-9 and c.start < c.end
    for c in got:
        if not c.flags and limits.max_sec > 3:
            assert c.text[0].isupper() and c.text[-1] in ".?!"
        if "oversize" not in c.flags:
            assert c.end - c.start <= limits.max_sec + 0.4 + 1e-6


def test_segment_keeps_fixed_spans_apart(spark):
    r = segment.gather_words(words_table(spark, WORDS)).withColumn("fixed", F.expr("array(named_struct('a', 1, 'b', 3))"))
    got = segment.segment(r, fixed="fixed").orderBy("idx").collect()
    assert [(c.a, c.b) for c in got if "boilerplate" in c.flags] == [(1, 3)]
    assert segment.segment(r.withColumn("words", F.expr("cast(null as array<struct<text:string,start:double,end:double,prob:double>>)"))).count() == 0


def test_backward_stamps_never_invert_a_clip(spark):
    data = [(1, 0, "Anna", 15736.19, 15736.33, None), (1, 1, "13", 15734.23, 15734.81, None), (1, 2, "geldi.", 15736.4, 15736.9, None)]
    got = segment.segment(segment.gather_words(spark.createDataFrame(data, schema.WORD))).collect()
    assert all(c.end > c.start for c in got)


def test_clitics(spark):
    data = [(1, 0, "'ın", 0.0, 0.1, 0.5), (1, 1, "Button", 0.2, 0.5, 0.8), (1, 2, "'ın", 0.5, 0.7, 0.3), (1, 3, "P", 1.0, 1.1, None), (1, 4, ".O", 1.1, 1.2, 0.4), (1, 5, ".Y", 1.2, 1.3, 0.9), (1, 6, "!", 1.3, 1.4, None)]
    got = segment.gather_words(spark.createDataFrame(data, schema.WORD)).select(segment.attach_clitics(F.col("words")).alias("w")).first().w
    assert [tuple(x) for x in got] == [("'ın", 0.0, 0.1, 0.5), ("Button'ın", 0.2, 0.7, 0.3), ("P.O.Y!", 1.0, 1.4, 0.4)]


def test_silence_clips(spark):
    df = spark.createDataFrame([(1, [(0.0, 3.0), (3.5, 6.0), (9.0, 12.0)]), (2, [(0.0, 40.0)]), (3, [(0.0, 1.0)]), (4, [])], "source_id int, regions array<struct<start:double,end:double>>")
    got = segment.silence_clips(df, pad=False).collect()
    assert sorted((r.source_id, r.start, r.end, tuple(r.flags)) for r in got) == [(1, 0.0, 6.0, ()), (1, 9.0, 12.0, ()), (2, 0.0, 15.0, ("hard_cut",)), (2, 15.0, 30.0, ("hard_cut",)), (2, 30.0, 40.0, ())]


def test_chunks_cover_all_words(spark):
    r = segment.gather_words(words_table(spark, ["w"] * 300, gaps=[(i, 0.4) for i in range(0, 300, 10)]))
    got = segment.chunks(r).orderBy("idx").collect()
    assert got[0].a == 0 and got[-1].b == 300 and all(x.b == y.a for x, y in zip(got, got[1:]))
    assert all(20 <= (c.b - c.a) * 0.6 <= 61 for c in got[:-1])


def borders(spoken, words, clips, total=3.5, floor=-60.0):
    """Refined clips of a recording that is loud within the spans ``spoken`` and quiet elsewhere."""
    env = np.full(int(total * 100), floor)
    for a, b in spoken:
        env[int(a * 100) : int(b * 100) - 1] = -10.0 + np.arange(int(b * 100) - 1 - int(a * 100)) % 5
    return boundaries.refine([{"start": s, "end": e, "a": a, "b": b} for s, e, a, b in clips], [{"start": s, "end": e} for s, e in words], env, boundaries.Search())


def test_border_moves_into_the_silence_after_an_early_stamp():
    a, b = borders([(0.5, 1.2), (1.55, 2.2)], [(0.5, 1.12), (1.12, 2.2)], [(0.35, 1.12, 0, 1), (1.12, 2.3, 1, 2)])
    assert 1.2 <= a["end"] <= b["start"] <= 1.55 and a["flags"] == ["snapped_end"] and b["flags"] == ["snapped_start"]


def test_border_keeps_each_pad_within_a_short_silence():
    e = boundaries.Envelope(np.where((np.arange(300) >= 100) & (np.arange(300) < 129), -60.0, -10.0), boundaries.Search())
    assert e.border(1.0, 1.02) == boundaries.Border(1.25, 1.25, 1.0)
    e = boundaries.Envelope(np.where((np.arange(300) >= 100) & (np.arange(300) < 159), -60.0, -10.0), boundaries.Search())
    assert e.border(1.0, 1.02) == boundaries.Border(1.25, 1.45, 1.0)


def test_border_without_silence_is_the_quietest_frame_but_not_beyond_the_next_word():
    e = boundaries.Envelope(np.where(np.arange(300) == 130, -20.0, -10.0), boundaries.Search())
    assert e.border(1.0, 1.02) == boundaries.Border(1.31, 1.31)
    a, b = borders([(0.0, 3.5)], [(0.5, 1.0), (1.02, 1.6)], [(0.4, 1.01, 0, 1), (1.01, 1.7, 1, 2)])
    assert a["end"] == b["start"] <= 1.02


def test_wide_pauses_stay():
    clips = [(0.35, 2.3, 0, 1), (3.8, 4.7, 1, 2)]
    a, b = borders([(0.5, 2.2), (4.0, 4.6)], [(0.5, 2.2), (4.0, 4.6)], clips, 5.0)
    assert (a["end"], b["start"]) == (2.3, 3.8) and "flags" not in a


def test_silence_after_the_next_word_moves_nothing_beyond_its_start():
    a, b = borders([(0.5, 1.15), (1.17, 1.5), (2.2, 3.0)], [(0.5, 1.15), (1.17, 1.5)], [(0.4, 1.16, 0, 1), (1.16, 1.75, 1, 2)])
    assert a["end"] <= b["start"] <= 1.17


def test_overlapping_stamps_share_the_overlap():
    a, b = borders([(0.0, 3.5)], [(0.5, 1.4), (1.1, 1.9)], [(0.4, 1.25, 0, 1), (1.25, 2.0, 1, 2)])
    assert a["end"] == b["start"] == 1.25


def test_one_word_clips_keep_some_length():
    out = borders([(0.5, 2.0), (2.1, 2.3), (2.9, 4.0)], [(0.5, 1.9), (1.9, 2.05), (2.9, 4.0)], [(0.4, 1.9, 0, 1), (1.9, 2.1, 1, 2), (2.8, 4.1, 2, 3)], 5.0)
    assert all(c["end"] > c["start"] for c in out) and all(x["end"] <= y["start"] for x, y in zip(out, out[1:]))


def test_mining_and_places(spark):
    phrase = "bu kitabı sesli kütüphane sunar ve seslendirir".split()
    r = random.Random(5)
    docs = [(i, "k", phrase + [f"söz{r.randrange(500)}" for _ in range(200)] + ["iyi", "dinlemeler", "dileriz", str(i)]) for i in range(6)] + [(9, "k", []), (10, "z", phrase)]
    df = spark.createDataFrame(docs, "doc int, channel string, tokens array<string>")
    got = {(x.channel, x.phrase): x.n for x in boilerplate.mine(df, "doc").collect()}
    assert got == {("k", " ".join(phrase)): 6, ("k", "iyi dinlemeler dileriz"): 6}
    spans = {x.doc: [tuple(s) for s in x.spans] for x in boilerplate.find_places(df, boilerplate.mine(df, "doc"), "doc").collect()}
    assert spans[0] == [(0, 7), (207, 210)] and spans[9] == [] and spans[10] == []


def test_long_phrases_merge():
    a, b = tuple("abcdefghijkl"), tuple("bcdefghijklm")
    assert boilerplate.merge([a, b]) == [tuple("abcdefghijklm")]


def test_filters(spark):
    data = [("a", 1.0, "DENİZ", ["x"]), ("b", None, None, None), ("c", 3.0, "ılık (su", [])]
    df = spark.createDataFrame(data, "id string, duration double, text string, flags array<string>")
    hit = lambda c, kind, op, v="": {r.id for r in df.filter(browse.match(F.col(c), kind, op, v)).collect()}
    assert hit("duration", "num", "ne", "1") == {"b", "c"} and hit("duration", "num", "gt", "0") == {"a", "c"} and hit("duration", "num", "eq", "") == {"b"}
    assert hit("text", "str", "contains", "deniz") == {"a"} and hit("text", "str", "contains", "(") == {"c"} and hit("text", "str", "re", "(") == set()
    assert hit("flags", "list", "empty") == {"b", "c"} and hit("flags", "list", "nothas", "x") == {"c"} and hit("flags", "list", "count_gt", "zz") == set()
    assert browse.parse_filters("{") == [] and browse.parse_conditions("a > 1; b ! 2; c<=-3.5") == [("a", ">", 1.0), ("c", "<=", -3.5)]
    assert [r.id for r in browse.sort_clips(df, "duration", True).collect()] == ["c", "a", "b"]


def test_round_robin_matches_a_loop(spark):
    r = random.Random(6)
    data = [(i, r.choice("abc"), f"p{r.random()}", r.choice([600.0, 1200.0, None])) for i in range(60)]
    got = [x.id for x in selection.round_robin(spark.createDataFrame(data, "id int, channel string, path string, duration double"), 900.0, 3.0).orderBy("ord").collect()]
    queues = [sorted((x for x in data if x[1] == c), key=lambda x: x[2]) for c in "abc"]
    order = [q[i] for i in range(60) for q in queues if i < len(q)]
    want, used = [], 0.0
    for x in order:
        if used >= 3.0 - 1e-12:
            break
        want.append(x[0])
        used += min(x[3] or 0.0, 900.0) / 3600
    assert got == want


def test_statistics(spark):
    r = np.random.default_rng(2)
    x, y = r.integers(0, 9, 200).astype(float), r.normal(size=200)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    rank = lambda v: np.array([(v < a).sum() + ((v == a).sum() + 1) / 2 for a in v])
    assert stats.spearman(df, "x", "y").first().rho == pytest.approx(np.corrcoef(rank(x), rank(y))[0, 1], abs=1e-12)
    s = sorted(y)
    assert [q.value for q in stats.floor_quantiles(df, "y", [0.0, 0.5, 1.0]).orderBy("p").collect()] == [s[0], s[100], s[-1]]
    assert stats.floor_quantiles(df.limit(0), "y", [0.5]).count() == 0


def test_vectors(spark):
    r = np.random.default_rng(3)
    axes = np.eye(8)[:2]
    data = [(i, "ab"[i % 2], [float(v) for v in axes[i % 2] * 3 + r.normal(scale=0.1, size=8)]) for i in range(30)]
    df = spark.createDataFrame(data, "id int, g string, v array<float>")
    for row in vectors.consistency(df, "g", "v").collect():
        u = np.array([x[2] for x in data if x[1] == row.g])
        u /= np.linalg.norm(u, axis=1, keepdims=True)
        m = u @ u.T
        assert row.mean_cosine == pytest.approx(m[np.triu_indices(len(u), 1)].mean(), abs=1e-6) and row.mean_cosine > 0.95
    c = vectors.centroids(df, "g", "v")
    assert vectors.margins(df, c, "g", "v", "id").agg(F.min("margin")).first()[0] > 0.5
    labels = vectors.average_linkage(np.array([np.array(x[2]) / np.linalg.norm(x[2]) for x in data]), 0.7)
    assert len(set(labels)) == 2 and len({(x[1], int(k)) for x, k in zip(data, labels)}) == 2


def test_ledger(spark):
    items = spark.createDataFrame([("a", {"m": 1.0, "k": 2.0}, ["f", "g"]), ("b", None, None)], "id string, metrics map<string,double>, flags array<string>")
    found = spark.createDataFrame([("a", {"m": 9.0}, ["h"]), ("z", {"m": 1.0}, [])], "id string, metrics map<string,double>, flags array<string>")
    got = {r.id: (r.metrics, r.flags) for r in ledger.merge_owned(items, found, ["m"], ["g"]).collect()}
    assert got == {"a": ({"k": 2.0, "m": 9.0}, ["f", "h"]), "b": (None, None)} and ledger.unmatched(items, found).count() == 1
    done = spark.createDataFrame([("clip", "a", "qc", "1", 1), ("clip", "a", "qc", "2", 2), ("clip", "b", "qc", "1", 5), ("source", "b", "qc", "2", 9)], "kind string, item_key string, stage string, version string, done_at int")
    assert [r.id for r in ledger.pending(items, F.col("id"), done, "clip", "qc", "2").collect()] == ["b"]
    kids, marks = ledger.replace_children(spark.createDataFrame([("a", 1), ("b", 2)], "id string, p int"), spark.createDataFrame([("n", 1)], "id string, p int"), "p", done)
    assert {r.id for r in kids.collect()} == {"b", "n"} and {(r.kind, r.item_key) for r in marks.collect()} == {("clip", "b"), ("source", "b")}
    new = ledger.add_new(spark.createDataFrame([(1, "x"), (7, "y")], "id long, path string"), spark.createDataFrame([("x",), ("b",), ("a",), ("a",)], "path string"), "path")
    assert {(r.id, r.path) for r in new.collect()} == {(8, "a"), (9, "b")}


def test_provider_errors_are_data(spark):
    def measure(pdf):
        if (pdf.text == "bad").any():
            raise RuntimeError("unreadable")
        return pdf.assign(length=pdf.text.str.len(), long=pdf.text.str.len() > 3)

    p = providers.Provider("len", "1", ("text",), ("length",), ("long",), measure)
    items = spark.createDataFrame([("a", "xx", {"old": 1.0}, ["q"]), ("b", "bad", {}, []), ("c", "xxxx", {}, [])], "id string, text string, metrics map<string,double>, flags array<string>")
    done = spark.createDataFrame([("clip", "a", "len", "1", 1)], "kind string, item_key string, stage string, version string, done_at int")
    merged, marks = providers.advance(items, done, p)
    assert {r.id: (r.metrics, r.flags) for r in merged.collect()} == {"a": ({"old": 1.0}, ["q"]), "b": ({}, []), "c": ({"length": 4.0}, ["long"])}
    assert [r.item_key for r in marks.collect()] == ["c"]
    assert "unreadable" in providers.run(items.filter("id = 'b'"), p).first().error
    with pytest.raises(ValueError):
        providers.Provider("x", "1", (), ("recommended",), (), measure)
    providers.register(p, override=True)
    with pytest.raises(ValueError):
        providers.register(p)


def test_compare_and_quality(spark):
    a = spark.createDataFrame([("a", 1.0, ["x", "y"]), ("b", 2.0, None), ("c", None, [])], "id string, v double, t array<string>")
    b = spark.createDataFrame([("a", 1.5, ["y", "x"]), ("b", 2.0, []), ("d", 1.0, [])], "id string, v double, t array<string>")
    got = {r.column: (r.only_a, r.only_b, r.common, r.n_differ, r.max_delta) for r in compare.table_diff(a, b, "id", ["v", "t"]).collect()}
    assert got == {"v": (1, 1, 2, 1, 0.5), "t": (1, 1, 2, 1, None)}
    assert rows(quality.check(a, {"v_known": F.col("v").isNull()})) == [("v_known", 1, 3, False, "c")]
    assert compare.schema_drift(a, b.drop("t").withColumn("z", F.lit(1)).schema)["missing"] == ["z"]


def test_config_versions():
    stages = {"a": {"revision": 2, "sections": ["asr"], "ignore": ["batch"]}, "b": {"revision": 1, "sections": ["align"], "depends_on": ["a"]}}
    v = lambda raw: config.stage_versions(config.Config(raw), stages)
    one = v({"asr": {"x": 1, "batch": 4}})
    assert one == v({"asr": {"x": 1.0, "batch": 8}}) and one["b"] != v({"asr": {"x": 2}})["b"]
    with pytest.raises(ValueError):
        config.Config({"nosuch": {}})
    with pytest.raises(ValueError):
        config.stage_version(config.Config({}), {"a": {"revision": 1, "depends_on": ["a"]}}, "a")
    assert config.Config({"asr": {"x": {"y": 3}}}).get("asr.x.y") == 3 and config.Config({}).get("asr.q", 7) == 7


def test_small_helpers(spark):
    text = "# Card\n## Sizes\n| what | n |\n|---|---|\n| clips | 1,840,404 |\n| share | 84.1 % |\n## End\n| x | 1 |"
    rows_ = quality.table_rows(text, "Sizes")
    assert [quality.parse_number(r[1]) for r in rows_[1:]] == [1840404.0, 84.1] and quality.parse_number("none") is None
    from dokuma.operators import report

    one = spark.range(1).select(report.clock(F.lit(3723.4)).alias("c"), report.human_size(F.lit(2_500_000)).alias("s")).first()
    assert (one.c, one.s) == ("1:02:03", "2.5 MB")
    src = spark.createDataFrame([(i, f"k{i % 5}") for i in range(50)], "id int, channel string")
    got = selection.sample_channels(src, 2, 3, "s")
    assert got.count() == 6 and got.select("channel").distinct().count() == 2
    v = spark.createDataFrame([(0, "a", [1.0, 0.0]), (1, "a", [0.0, 1.0]), (2, "a", [1.0, 1.0]), (3, "b", [1.0, 0.0]), (4, "b", None)], "id int, g string, v array<double>")
    ext = {r.g: (r.n, r.least) for r in vectors.pair_extremes(v, "g", "v", "id", "s").collect()}
    assert ext["a"][0] == 3 and abs(ext["a"][1]) < 1e-9 and ext["b"] == (1, None)
