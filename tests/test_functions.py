"""Text, sentences, readings, signal: known values."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dokuma.functions import sentences, signal, speech, text


def col(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in df.select("i", expr(F.col("x")).alias("y")).orderBy("i").collect()]


@pytest.mark.parametrize(("n", "want"), [(0, "sıfır"), (101, "yüz bir"), (1001, "bin bir"), (1923, "bin dokuz yüz yirmi üç"), (1234567, "bir milyon iki yüz otuz dört bin beş yüz altmış yedi"), (-5, "eksi beş"), (100, "yüz"), (2000, "iki bin"), (10**12, "bir trilyon"), (10**15, "bin trilyon")])
def test_numbers(n, want):
    assert speech.number_to_words(n) == want


@given(st.integers(0, 10**15))
@settings(max_examples=200, deadline=None)
def test_numbers_read_back(n):
    value = {w: i for i, w in enumerate(speech.ONES)} | {w: 10 * i for i, w in enumerate(speech.TENS)}
    total, part = 0, 0
    for w in speech.number_to_words(n).split():
        if w == "yüz":
            part = (part or 1) * 100 if part < 10 else part - part % 10 + (part % 10 or 1) * 100
        elif w in speech.THOUSANDS:
            total, part = (total + (part or 1) * 1000 ** speech.THOUSANDS.index(w)) if w != "trilyon" else (total + part) * 10**12, 0
        else:
            part += value[w]
    assert total + part == n


@pytest.mark.parametrize(("n", "want"), [(4, "dördüncü"), (21, "yirmi birinci"), (1000, "bininci")])
def test_ordinals(n, want):
    assert speech.ordinal_to_words(n) == want


SPOKEN = [
    ("%50 arttı", "yüzde elli arttı"), ("1,5 litre", "bir virgül beş litre"), ("saat 09:00 oldu", "saat dokuz oldu"), ("50₺ verdi", "elli lira verdi"), ("1.234 kişi", "bin iki yüz otuz dört kişi"), ("3G çekmiyor", "üç ge çekmiyor"),
    ("F-16 havalandı", "fe on altı havalandı"), ("mp3", "mp3"), ("TBMM", "TBMM"), ("Sonra 1. Naip geldi", "Sonra birinci Naip geldi"), ("Bölüm 5. Ali eve gitti.", "Bölüm beş. Ali eve gitti."), ("14:30 treni", "on dört otuz treni"), (None, None), ("", ""),
]


def test_spoken(spark):
    assert col(spark, [a for a, _ in SPOKEN], speech.to_spoken) == [b for _, b in SPOKEN]
    assert speech.spoken("bitti 1918. Yeni").endswith("sekiz. Yeni")


def test_clean_and_keys(spark):
    assert col(spark, ["1923'te  doğdu..", "a  b", None], text.light_clean) == ["1923'te doğdu.", "a b", None]
    a = col(spark, ["Merhaba, dünya!", "merhaba dünya", "IĞDIR", "ığdır", "İ̇", "ç", "ç", "!!", None], text.dedupe_key)
    assert a[0] == a[1] and a[2] == a[3] == "ığdır" and a[5] == a[6] and a[7] == "" and a[8] is None


def test_broken_ends(spark):
    assert col(spark, ["ama geldi", "Ama", "3 elma", "«ılık", "IŞIK", "", None, "İyi"], text.is_lower_start) == [True, False, False, True, False, False, False, False]
    assert col(spark, ["geldi.", 'geldi."', "geldi", "ne?) ", "", None, "son…"], text.has_sentence_end) == [True, True, False, True, False, False, True]


BOUNDARIES = [
    ("güzeldi. Sonra", True), ("mi? Gelmedi", True), ('"Geliyorum." Sonra', True), ("Dr. Ali", False), ("A. Hamdi", False), ("M.Ö. Roma", False), ("3. bölüm", False), ("1. Naip", False), ("1918. Yeni", True), ("geldi. ama", False), ("dedi! Ama", True), ("geldi Ali", False),
]


@pytest.mark.parametrize(("pair", "want"), BOUNDARIES)
def test_boundary(spark, pair, want):
    got = spark.range(1).select(sentences.boundaries(F.split(F.lit(pair), " ")).alias("b")).first().b
    assert got[0] is want


def test_boundary_after_label_and_at_the_end(spark):
    got = lambda s: spark.range(1).select(sentences.boundaries(F.split(F.lit(s), " ")).alias("b")).first().b
    assert got("Bölüm 5. Ali") == [False, True, False] and got("Sayfa 5.") == [False, False] and got("Bitti.") == [True]


def test_spans(spark):
    df = spark.createDataFrame([(["Ali", "geldi.", "Sonra", "gitti"],), ([],), (["Bitti."],)], "t array<string>")
    assert [[tuple(s) for s in r.s] for r in df.select(sentences.sentence_spans(F.col("t")).alias("s")).collect()] == [[(0, 2), (2, 4)], [], [(0, 1)]]


def test_speech_metrics(spark):
    df = spark.createDataFrame([([(0.2, 1.0), (2.5, 3.0)], 3.5), ([], 3.5)], "r array<struct<start:double,end:double>>, d double")
    got = [tuple(x.m) for x in df.select(signal.speech_metrics(F.col("r"), F.col("d")).alias("m")).collect()]
    assert got == [(0.3714, 1.5, 0.2, 0.5), (0.0, 0.0, 3.5, 3.5)]


def test_music_db(spark):
    df = spark.createDataFrame([(0.05, 0.5), (0.0, 0.5), (0.1, 0.0)], "m double, s double")
    assert [round(r.x, 6) for r in df.select(signal.music_to_speech_db(F.col("m"), F.col("s")).alias("x")).collect()] == [-20.0, -80.0, 0.0]


def test_windows(spark):
    assert col(spark, [2.0, 12.0, 9.01, 17.0, 30.0, 121.0, 0.0], lambda c: signal.quality_windows(c), "double") == [7, 3, 1, 8, 21, 112, 0]
    for n in (105, 512, 1024, 1210):
        starts = col(spark, [n], lambda c: signal.tail_windows(c, 1024, 500), "int")[0]
        assert starts[-1] + 1024 == max(n, 1024)


def test_runs_and_envelope(spark):
    assert [tuple(x) for x in col(spark, [[1.0, -1.0, -1.0, 2.0, -3.0]], lambda c: signal.runs_below(c, F.lit(0.0)), "array<double>")[0]] == [(1, 3), (4, 5)]
    env = col(spark, [[0.5] * 40 + [0.0] * 40], lambda c: signal.envelope(c, 20, 10), "array<double>")[0]
    assert len(env) == 7 and env[0] == pytest.approx(-6.0206, abs=1e-3) and env[-1] == pytest.approx(-120.0)


def test_loudness():
    import numpy as np

    from dokuma.functions.loudness import loudness

    rate = 48000
    tone = np.sin(2 * np.pi * 997 * np.arange(2 * rate) / rate)
    assert loudness(tone, rate) == pytest.approx(-3.01, abs=0.1)  # a full-scale tone near 1 kHz
    noise = np.random.default_rng(0).standard_normal(2 * 24000) * 0.1
    assert -30 < loudness(noise, 24000) < -10 and loudness(noise, 24000) - loudness(noise * 0.1, 24000) == pytest.approx(20, abs=0.02)
    assert loudness(np.zeros(48000), 24000) is None and loudness(noise[:7200], 24000) is None and loudness(noise[:9600], 24000) is None
    half = np.concatenate([noise, np.zeros(5 * 24000)])  # silence falls through the gate
    assert loudness(half, 24000) == pytest.approx(loudness(noise, 24000), abs=0.5)


def test_loudness_column(spark):
    from dokuma.functions.loudness import loudness_lufs

    df = spark.createDataFrame([(1, [0.5, -0.5] * 8000, 8000), (2, None, 8000), (3, [0.1], None), (4, [], 8000)], "i int, x array<double>, r int")
    got = {r.i: r.l for r in df.select("i", loudness_lufs("x", "r").alias("l")).collect()}
    assert got[1] is not None and (got[2], got[3], got[4]) == (None, None, None)


def test_filters_and_digests(tmp_path):
    import hashlib

    from dokuma.providers import verified

    assert signal.decode_filters() == "highpass=f=40.0" and signal.decode_filters(ceiling_db=-1.0).endswith("alimiter=limit=0.8913:level=false")
    p = tmp_path / "w.bin"
    p.write_bytes(b"weights")
    assert verified(str(p), hashlib.sha256(b"weights").hexdigest()) == str(p)
    for path, digest in ((str(p), "0" * 64), (str(p), None), (str(tmp_path / "no"), "0" * 64)):
        with pytest.raises((ValueError, FileNotFoundError)):
            verified(path, digest)
