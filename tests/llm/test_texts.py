"""Leaked passages and residue."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dokuma.llm import leakage, residue
from dokuma.llm.folding import folded_words

from .helpers import LONG, documents, rows


def brute(doc, item):
    d, i = folded_words(doc or ""), folded_words(item or "")
    k = min(len(i), 12)
    if not k:
        return False
    runs = {tuple(i[j : j + k]) for j in range(len(i) - k + 1)}
    return any(tuple(d[j : j + k]) in runs for j in range(len(d) - k + 1))


def corpus(seed=3):
    r = random.Random(seed)
    vocab = [f"kök{i}" for i in range(60)]
    text = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    items = [(i, text(r.choice([0, 1, 4, 11, 12, 13, 25, 40]))) for i in range(40)] + [(90, None), (91, "  "), (92, "Çağ­rı IŞIK — işte!")]
    items.append((93, items[6][1]))
    docs = []
    for d in range(120):
        t = text(r.randint(0, 60)).split()
        if r.random() < 0.7:
            w = r.choice(items)[1] or ""
            w = w.split()
            a = r.randrange(max(1, len(w)))
            t[r.randrange(len(t) + 1) : 0] = w[a : a + r.choice([6, 11, 12, 20, 40])]
        docs.append((d, "s", " ".join(t)))
    docs += [(200, "s", None), (201, "s", ""), (202, "s", "x cagri isik iste y"), (203, "s", LONG), (204, "s", (items[5][1] or "") + " " + LONG)]
    return docs + docs[:3], items


def test_exact_leaks(spark):
    docs, items = corpus()
    tests = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, run string")
    got = {tuple(r) for r in leakage.exact_leaks(documents(spark, docs), tests).collect()}
    want = {(d, i) for d, _, t in docs for i, x in items if brute(t, x)}
    assert got == want and len(want) > 20


def test_near_leaks(spark):
    a = [f"w{i}" for i in range(30)]
    near = a[:3] + ["başka"] + a[4:12]  # one word replaced in a passage of twelve
    far = a[:3] + ["b1", "b2"] + a[5:9] + ["b3"] + a[10:12]
    docs = documents(spark, [(1, "s", " ".join(["x"] * 5 + near + ["y"] * 5)), (2, "s", " ".join(far)), (3, "s", " ".join(a))])
    tests = spark.createDataFrame([(7, " ".join(a))], "item_id long, text string")
    got = {(r.doc_id): r.distance for r in leakage.leaks(docs, tests).collect()}
    assert got == {1: 1, 3: 0}


def distance(p, t):
    """Least edit distance between ``p`` and any part of ``t``, by the whole table."""
    row = list(range(len(p) + 1))
    best = row[-1]
    for c in t:
        new = [0]
        for i, x in enumerate(p):
            new.append(min(row[i] + (x != c), row[i + 1] + 1, new[i] + 1))
        row = new
        best = min(best, row[-1])
    return best


def test_near_leaks_are_those_of_brute_force(spark):
    r = random.Random(11)
    vocab = [f"k{i}" for i in range(400)]
    items = [(i, [r.choice(vocab) for _ in range(n)]) for i, n in enumerate([1, 2, 3, 4, 5, 7, 11, 12, 13, 17, 18, 25, 40] * 2)]
    docs = []
    for d in range(300):
        ws = list(r.choice(items)[1])
        a = r.randrange(max(1, len(ws) - 11))
        ws = ws[a : a + r.choice([12, 12, 13, 14, 40])]
        for _ in range(r.choice([0, 1, 1, 1, 2])):
            i = r.randrange(len(ws) + 1)
            ws[i : i + r.choice([0, 1, 1])] = r.choice([[], ["yeni"], [r.choice(vocab)]])
        docs.append((d, "s", " ".join([r.choice(vocab) for _ in range(r.randint(0, 6))] + ws + [r.choice(vocab) for _ in range(r.randint(0, 6))])))
    tests = spark.createDataFrame([(i, " ".join(ws)) for i, ws in items], "item_id long, text string")
    got = {(x.doc_id, x.item_id): x.distance for x in leakage.leaks(documents(spark, docs), tests).collect()}
    want = {}
    for d, _, t in docs:
        for i, ws in items:
            m = min(12, len(ws))
            least = min(distance(ws[j : j + m], t.split()) for j in range(len(ws) - m + 1))
            if least <= min(1, m - 1):  # a single word only unchanged
                want[d, i] = least
    assert got == want and sum(x == 1 for x in want.values()) > 50


def test_leaks_empty(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert rows(leakage.exact_leaks(documents(spark, [(1, "s", "bir iki")]), none)) == []
    assert rows(leakage.exact_leaks(documents(spark, []), spark.createDataFrame([(1, "bir iki")], "item_id long, text string"))) == []


def test_many_items_are_joined_by_shuffle(spark, monkeypatch):
    docs, items = corpus(4)
    tests = spark.createDataFrame(items, "item_id long, text string")
    want = {tuple(r) for r in leakage.leaks(documents(spark, docs), tests).collect()}
    monkeypatch.setattr(leakage, "FEW", 0)
    assert {tuple(r) for r in leakage.leaks(documents(spark, docs), tests).collect()} == want and want


def test_every_place_of_an_edit(spark):
    """Passages of twelve words from any place of an item, with one word replaced, dropped or added anywhere: all are found."""
    a = [f"w{i}" for i in range(30)]
    edits = {"replaced": lambda p, j: p[:j] + ["x"] + p[j + 1 :], "dropped": lambda p, j: p[:j] + p[j + 1 :], "added": lambda p, j: p[: j + 1] + ["x"] + p[j + 1 :]}
    docs = [["u"] * 3 + e(a[o : o + 12], j) + ["v"] * 3 for e in edits.values() for o in range(12) for j in range(12)]
    tests = spark.createDataFrame([(7, " ".join(a))], "item_id long, text string")
    got = {r.doc_id for r in leakage.leaks(documents(spark, [(i, "s", " ".join(d)) for i, d in enumerate(docs)]), tests).collect()}
    assert got == set(range(3 * 144))


def test_myers_rejects(spark):
    """Documents that hold a whole piece, but no passage within the budget, are candidates that only the distance drops."""
    a = [f"w{i}" for i in range(12)]
    tests = spark.createDataFrame([(7, " ".join(a))], "item_id long, text string")
    docs = documents(spark, [(1, "s", " ".join(a[:6] + ["x"] * 6)), (2, "s", " ".join(a[:6] + ["x"] + a[7:]))])
    assert {tuple(r) for r in leakage.leaks(docs, tests).collect()} == {(2, 7, 1)} and not leakage.exact_leaks(docs, tests).collect()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=64), st.lists(st.integers(0, 3), max_size=90))
def test_myers(p, t):
    row = list(range(len(p) + 1))
    best = row[-1]
    for c in t:
        new = [0]
        for i, x in enumerate(p):
            new.append(min(row[i] + (x != c), row[i + 1] + 1, new[i] + 1))
        row = new
        best = min(best, row[-1])
    assert leakage.myers(np.array([p, p], np.uint64), np.array([t, t], np.uint64).reshape(2, len(t))).tolist() == [best, best]


CASES = [
    "Merhaba {{ad}}, dizimize hoş geldiniz.", "Seslendiren: %s", "Bölüm ${bolum_no} – deniz", "Yayın tarihi: undefined · süre: undefined", "[KİTAP ADI BURAYA] adlı kitabın ilk bölümü.", "<buraya okuyanın adı>, Arşivden", "Bölüm {0} – ata",
    "Lorem ipsum dolor sit amet, consectetur adipiscing elit.", "deneme deneme 1 deneme deneme", "xxx xxxx xx xxxxx", "404 Not Found\nnginx", "HTTP Error 503. Service Unavailable.", "Bu sayfayı görüntülemek için JavaScript'i etkinleştirin.",
    "BU SAYFAYI GÖRÜNTÜLEMEK İÇİN JAVASCRİPT'İ ETKİNLEŞTİRİN.", "Bir şeyler ters gitti. Olay no: 29086fe2c2", "Site bakımda, kısa süre sonra buradayız.", "Please enable JavaScript to continue using this application.", "Fatal error: Uncaught TypeError in render.php on line 349",
    "Açıklama eklenecek (TODO)", "Taslak – deniz içeriği henüz girilmedi.", "asdf qwer asdf zxcv asdf qwer kuşlar bugün denizin üstünde uçtu.", "deneme deneme 1 deneme", "Your description goes here.", "Erişim engellendi. Bu sayfayı görüntüleme yetkiniz yok.", "Deniz sakindi.\nAradığınız sayfa bulunamadı veya taşınmış olabilir.\nKuşlar uçtu.", "nginx", "Olay no: 0a1b2c",
]
PROSE = [
    "Derste Lumkit şablondaki {{ad}} işaretinin ne işe yaradığını uzun uzun açıkladı.", "Programcı Bıklün ekranda 'undefined' yazısını görünce kahkahayı bastı.", "Kitapta sayfa bulunamadı diye üzülen Bünrök, nar ile teselli oldu.", "Bekçi Pombaz, erişim engellendi diye kapıya tabela astı.",
    "Matematikte {1, 2, 3} bir kümedir, dedi Ramle.", "Dizideki x[0] ile x[1] yer değiştirince program parladı.", "Fiyatı $5 olan düş için %30 indirim istedi.", "[gülüşmeler] Selrur gülüyor {alkışlar} ve öğretmen yeniden başlıyor.", "00:05:48 Serin ceviz gümüşlü bir merdivene söyledi.",
    "Zuzyi, lorem ipsum denen dolgu yazısının matbaacı çıraklarından kaldığını anlattı.", "JavaScript öğrenmek isteyen Bamnus önce anne çizmeyi denedi.", "TODO defterini kaybeden Yilgın bütün gün el aradı.", "%35 oranında yükseldi.", "Deneme, deneme, bir iki üç dedi ve güldü.", "Yazar metni henüz okumadı.", "", "   ", None, "[müzik]", "<3 işaretini mektubun sonuna koyan Bıklin, avlu çizdi.",
    "Ramle 404 numaralı odanın kapısında durup altın aradı, oda bulunamadı diye fısıldadı.", "Bölüm 500'de Vizruk sunucu gibi sessizce yemek dağıttı; hata yapmadı.", LONG,
]


@pytest.mark.parametrize("where", ["alone", "among"])
def test_residue(spark, where):
    around = lambda t: t if where == "alone" or t is None else f"Deniz bugün sakindi. Kuşlar uçuyordu.\n{t}\nAkşam oldu, herkes uyudu."
    cases = CASES if where == "alone" else CASES[:-2]
    data = [(i, "Kaynak", around(t)) for i, t in enumerate(cases)] + [(100 + i, None, around(t)) for i, t in enumerate(PROSE)]
    got = {r[0] for r in rows(residue.residue(documents(spark, data + data[:4])).select("doc_id"))}
    assert got == set(range(len(cases)))


def test_boilerplate_is_subtracted(spark):
    footer = "Bizi dinlediğiniz için teşekkürler"
    data = [(i, "K", f"{footer}\nnginx") for i in range(3)] + [(50 + i, "K", f"Gerçek bir metin {'abcdefghijklmnopqrstuvwxyz'[i]} burada.\n{footer}") for i in range(25)]
    got = {r.doc_id: r.n_boilerplate for r in residue.residue(documents(spark, data)).collect()}
    assert got == {0: 1, 1: 1, 2: 1}


# Notices of kinds that no pattern knows.
UNKNOWN = ["Oynatıcı eklentisi güncel sürümü bekliyor", "Sistem hizmet veremiyor", "Yetki denetimi: kullanılamaz sayfa", "Captcha adımı: robot sınaması", "Server login service paused", "Oturum hizmeti askıda"]


def test_unknown_notices_are_found_by_counts(spark):
    """None of them is evidence by itself; where the same line stands in documents of several hosts, all are found. Prose about the same things that no two hosts share isn't."""
    judge = residue.Judge()
    assert all(judge.line(residue.fold(x)) == residue.TOPICAL for x in UNKNOWN)
    text = lambda i, x: f"Gerçek bir metin {'abcdefghijklmnopqrstuvwxyz'[i % 26]} {'bcdfghjk'[i // 26]} burada.\n{x}"
    data = [(10 * k + i, f"H{i % 3}", text(10 * k + i, x)) for k, x in enumerate(UNKNOWN) for i in range(4)]
    data += [(900 + i, "H1", text(i, f"Sistem hizmet {'abcdefghijklmnopqrstuvwxyz'[i]} veremiyor")) for i in range(10)] + [(950 + i, "H2", text(i, "Oturum hizmeti durgun")) for i in range(4)]
    got = {r.doc_id for r in residue.residue(documents(spark, data)).collect()}
    assert got == {d for d, *_ in data if d < 900}
    assert not residue.residue(documents(spark, data), template=5).collect()


def test_subtraction_decides(spark):
    """Documents of which nothing but fragments is left without their host's boilerplate are found with it off, too, only if they hold nothing else."""
    footer = "Bizi dinlediğiniz için teşekkürler"
    data = [(i, "K", f"{footer}\nRef: 0a{i}b{i}") for i in range(3)] + [(50 + i, "K", f"Gerçek bir metin {'abcdefghijklmnopqrstuvwxyz'[i]} burada.\n{footer}") for i in range(25)]
    found = lambda **k: {r.doc_id for r in residue.residue(documents(spark, data), **k).collect()}
    assert found() == {0, 1, 2} and found(recurs=10**9) == set()


def test_residue_empty(spark):
    assert rows(residue.residue(documents(spark, []))) == []
