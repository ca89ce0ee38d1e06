"""Signals and borders: envelopes, loudness, stems, planted recordings. The tables hold no sound, so signals are formulas of their values that SQL can state too."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import signal
from ..operators import boundaries
from ..session import spread
from .base import ONCE, query, table

# One mini recording a clip: two words that meet at 1 to 1.4 s, a silence near by, noise elsewhere; all in hundredths of a second, from the clip's milliseconds h.
PLANTED = f"""(SELECT id, h, 100 + h % 37 AS e, 80 + h % 37 + h // 37 % 60 AS n, 90 + h % 37 + h // 7 % 50 AS s, h // 11 % 30 AS l, h % 5 AS k FROM (SELECT id, CAST(floor(duration * 1000) AS BIGINT) AS h FROM {ONCE} WHERE duration > 0))"""
FRAME = lambda t: f"CAST(least(greatest(round_even(({t} - 0.01::DOUBLE) / 0.01::DOUBLE, 0), 0), 299) AS INTEGER)"
REFINED = f"""WITH p AS (SELECT *, e / 100.0::DOUBLE AS te, n / 100.0::DOUBLE AS tn, greatest(e, n) / 100.0::DOUBLE AS tl FROM {PLANTED} WHERE n - e < 40),
    w AS (SELECT *, {FRAME('te - 0.05::DOUBLE')} AS lo, {FRAME('tl + 0.6::DOUBLE')} AS hi, {FRAME('te - 1.0::DOUBLE')} AS clo, {FRAME('tl + 1.0::DOUBLE')} AS chi FROM p),
    v AS (SELECT w.*, i, CASE WHEN i >= s AND i < s + l THEN -70.0::DOUBLE ELSE -20.0::DOUBLE - (i * 7919 + h) % 13 * 0.5::DOUBLE END AS db FROM w, range(300) t(i)),
    c AS (SELECT id, quantile_cont(db, 0.9) AS level FROM v WHERE i BETWEEN clo AND chi GROUP BY id),
    q AS (SELECT v.*, db < level - 25 AS low FROM v JOIN c USING (id) WHERE i BETWEEN lo AND hi),
    g AS (SELECT *, i - row_number() OVER (PARTITION BY id, low ORDER BY i) AS run FROM q),
    r AS (SELECT id, min(i) AS a, max(i) + 1 AS b FROM g WHERE low GROUP BY id, run HAVING count(*) >= 6),
    r1 AS (SELECT id, arg_min(a, (a - b, a)) AS a, arg_min(b, (a - b, a)) AS b FROM r GROUP BY id),
    m AS (SELECT id, arg_min(i, (db, i)) AS i FROM q GROUP BY id),
    f AS (SELECT w.*, a * 0.01::DOUBLE AS s0, (b - 1) * 0.01::DOUBLE + 0.02::DOUBLE AS s1, m.i * 0.01::DOUBLE + 0.01::DOUBLE AS t FROM w JOIN m USING (id) LEFT JOIN r1 USING (id)),
    b0 AS (SELECT *, s0 IS NOT NULL AND round(s0, 3) <= tn + 0.1::DOUBLE AS early, CASE WHEN s0 IS NULL THEN round(t, 3) ELSE round(least(s0 + 0.25::DOUBLE, s1), 3) END AS x, CASE WHEN s0 IS NULL THEN round(t, 3) ELSE round(greatest(s1 - 0.15::DOUBLE, least(s0 + 0.25::DOUBLE, s1)), 3) END AS y FROM f),
    b1 AS (SELECT *, greatest(x, te - 0.4::DOUBLE + 0.05::DOUBLE) AS x1 FROM b0), b2 AS (SELECT *, greatest(y, x1) AS y1 FROM b1),
    b3 AS (SELECT *, CASE WHEN early THEN y1 ELSE least(y1, tn) END AS y2 FROM b2), b4 AS (SELECT *, least(x1, y2) AS x2 FROM b3),
    b5 AS (SELECT *, tn < te AND y2 < te AS lap, round((te + tn) / 2, 3) AS mid FROM b4), b6 AS (SELECT *, CASE WHEN lap THEN greatest(y2, mid) ELSE y2 END AS y3 FROM b5),
    b7 AS (SELECT *, CASE WHEN lap THEN least(greatest(x2, mid), y3) ELSE x2 END AS x3, tn + 0.1::DOUBLE + k / 10.0::DOUBLE + 0.2::DOUBLE - 0.05::DOUBLE AS last FROM b6), b8 AS (SELECT *, CASE WHEN y3 > last THEN greatest(last, tn) ELSE y3 END AS y4 FROM b7)
    SELECT id, round(CASE WHEN y3 > last THEN least(x3, y4) ELSE x3 END, 6) AS end_sec, round(y4, 6) AS start_sec, 'snapped_end' AS flag_a, 'snapped_start' AS flag_b FROM b8"""


def planted(spark: SparkSession, sf: str) -> DataFrame:
    h = F.floor(F.col("duration") * 1000).cast("long")
    p = spread(table(spark, sf, "clips").filter("id is not null AND duration > 0").select("id", h.alias("h"))).dropDuplicates(["id"])
    e = F.expr("100 + h % 37")
    return p.select("id", "h", e.alias("e"), F.expr("80 + h % 37 + h div 37 % 60").alias("n"), F.expr("90 + h % 37 + h div 7 % 50").alias("s"), F.expr("h div 11 % 30").alias("l"), F.expr("h % 5").alias("k"))


def sec(c: str) -> Column:
    return F.col(c) / F.lit(100.0)


@query(REFINED)
def refined_ends(spark: SparkSession, sf: str) -> DataFrame:
    """New borders of two clips of each planted recording, where its pause can't hold both pads."""
    p = planted(spark, sf).filter("n - e < 40")
    noise = F.transform(F.sequence(F.lit(0), F.lit(299)), lambda i: F.when((i >= F.col("s")) & (i < F.col("s") + F.col("l")), F.lit(-70.0)).otherwise(F.lit(-20.0) - (i * F.lit(7919) + F.col("h")) % 13 * F.lit(0.5)))
    word = lambda a, b: F.struct(a.alias("start"), b.alias("end"))
    clip = lambda s, e, a: F.struct(s.alias("start"), e.alias("end"), F.lit(a).alias("a"), F.lit(a + 1).alias("b"), F.array().cast("array<string>").alias("flags"))
    until = sec("n") + 0.1 + F.col("k") / F.lit(10.0)
    r = p.select("id", F.array(clip(F.lit(0.3), sec("e") + 0.1, 0), clip(sec("n") - 0.1, until + 0.2, 1)).alias("clips"), F.array(word(sec("e") - 0.4, sec("e")), word(sec("n"), until)).alias("words"), noise.alias("envelope"))
    out = boundaries.refine_boundaries(r, group="id")
    a, b = F.col("clips")[0], F.col("clips")[1]
    return out.select("id", F.round(a["end"], 6).alias("end_sec"), F.round(b["start"], 6).alias("start_sec"), a["flags"][0].alias("flag_a"), b["flags"][0].alias("flag_b"))


@query("""WITH x AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings), n AS (SELECT vec_id, len(embedding) AS n FROM embeddings)
    SELECT x.vec_id, CAST(k AS INTEGER) AS frame, round(20 * log10(greatest(sqrt(sum(v * v) / 20), 1e-6)), 6) AS db FROM n, range(0, 1000) t(k), x WHERE x.vec_id = n.vec_id AND k <= greatest(n - 20, 0) // 10 AND i > k * 10 AND i <= k * 10 + 20 GROUP BY ALL""")
def envelope(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors taken as samples: RMS envelope of 20 samples every 10, in dB."""
    e = table(spark, sf, "embeddings").select("vec_id", signal.envelope(F.transform("embedding", lambda x: x.cast("double")), 20, 10).alias("e"))
    return e.select("vec_id", F.posexplode("e").alias("frame", "db")).select("vec_id", "frame", F.round("db", 6).alias("db"))


@query(f"""SELECT id, round(greatest(10 * log10(pow(10, a / 10) + pow(10, b / 10) + pow(10, c / 10)) - v, -80), 6) AS stems_db, round(CASE WHEN q <= 0 THEN 0 WHEN p <= 0 THEN -80 ELSE greatest(20 * log10(p / q), -80) END, 6) AS music_db
    FROM (SELECT id, -10 - h % 31 AS a, -12 - h % 17 AS b, -5 - h % 41 AS c, -3 - h % 13 AS v, (h % 7) / 10.0::DOUBLE AS p, (h % 11) / 10.0::DOUBLE AS q FROM (SELECT id, CAST(floor(duration * 1000) AS BIGINT) AS h FROM {ONCE} WHERE duration > 0))""")
def music_ratios(spark: SparkSession, sf: str) -> DataFrame:
    """Power sum of three stems against the voice, and music against speech, of planted levels."""
    p = planted(spark, sf)
    level = lambda a, m: F.lit(float(a)) - F.col("h") % m
    stems = signal.stem_power_db([level(-10, 31), level(-12, 17), level(-5, 41)], level(-3, 13))
    return p.select("id", F.round(stems, 6).alias("stems_db"), F.round(signal.music_to_speech_db(F.col("h") % 7 / F.lit(10.0), F.col("h") % 11 / F.lit(10.0)), 6).alias("music_db"))
