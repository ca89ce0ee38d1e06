"""Level, silence and window arithmetic on arrays, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FLOOR = 1e-6


def rms(x: Column) -> Column:
    return F.sqrt(F.aggregate(x, F.lit(0.0), lambda s, v: s + v.cast("double") * v) / F.size(x))


def decibel(x: Column, floor: float = FLOOR) -> Column:
    return 20 * F.log10(F.greatest(x, F.lit(floor)))


def level_metrics(x: Column) -> Column:
    """struct<peak_dbfs, rms_dbfs, clipping> of samples in -1..1; null for no samples."""
    peak = F.array_max(F.transform(x, lambda v: F.abs(v.cast("double"))))
    loud = F.size(F.filter(x, lambda v: F.abs(v) >= 0.99)) / F.size(x)
    return F.when(F.size(x) > 0, F.struct(F.round(decibel(peak), 2).alias("peak_dbfs"), F.round(decibel(rms(x)), 2).alias("rms_dbfs"), F.round(loud, 5).alias("clipping")))


def speech_metrics(regions: Column, duration: Column) -> Column:
    """struct<speech_ratio, internal_silence, lead_silence, trail_silence> of sorted speech regions {start, end}. No region: ratio 0, no inner silence, both
    edges as long as the recording."""
    total = F.aggregate(regions, F.lit(0.0), lambda s, r: s + (r["end"] - r["start"]))
    gaps = F.transform(F.slice(regions, 2, F.greatest(F.size(regions) - 1, F.lit(0))), lambda r, i: r["start"] - F.get(regions, i)["end"])
    any_ = F.size(regions) > 0
    first, last = F.get(regions, F.lit(0)), F.element_at(regions, -1)
    return F.struct(
        F.when(any_ & (duration > 0), F.round(F.least(total / duration, F.lit(1.0)), 4)).otherwise(0.0).alias("speech_ratio"),
        F.round(F.greatest(F.coalesce(F.array_max(gaps), F.lit(0.0)), F.lit(0.0)), 3).alias("internal_silence"),
        F.round(F.when(any_, F.greatest(first["start"], F.lit(0.0))).otherwise(duration), 3).alias("lead_silence"),
        F.round(F.when(any_, F.greatest(duration - last["end"], F.lit(0.0))).otherwise(duration), 3).alias("trail_silence"),
    )


def music_to_speech_db(music: Column, speech: Column) -> Column:
    """20 log10(music / speech) with floor -80; silent speech gives 0."""
    return F.when(speech <= 0, F.lit(0.0)).when(music <= 0, F.lit(-80.0)).otherwise(F.greatest(20 * F.log10(music / speech), F.lit(-80.0)))


def stem_power_db(levels: list[Column], vocals: Column) -> Column:
    """Power sum of stems against the vocals, in dB with floor -80."""
    total = sum((F.pow(F.lit(10.0), x / 10) for x in levels[1:]), F.pow(F.lit(10.0), levels[0] / 10))
    return F.greatest(10 * F.log10(total) - vocals, F.lit(-80.0))


# The quality model's polynomials (square, linear, constant) for signal, background and overall scores.
MOS = {"sig": (-0.08397278, 1.22083953, 0.0052439), "bak": (-0.13166888, 1.60915514, -0.39604546), "ovrl": (-0.06766283, 1.11546468, 0.04602535)}


def mos(raw: Column, kind: str) -> Column:
    """Mean over windows of the mapped raw scores (each mapped first)."""
    a, b, c = MOS[kind]
    return F.aggregate(raw, F.lit(0.0), lambda s, x: s + (a * x * x + b * x + c)) / F.size(raw)


def hop_windows(n: Column, window: int, hop: int) -> Column:
    """Starts of windows that fit into n samples, at least one."""
    return F.sequence(F.lit(0), F.greatest(n - window, F.lit(0)), F.lit(hop))


def tail_windows(n: Column, window: int, hop: int) -> Column:
    """As ``hop_windows``, with a last window that ends with the signal where the hops leave a tail."""
    last = F.greatest(n - window, F.lit(0))
    return F.array_distinct(F.concat(F.sequence(F.lit(0), last, F.lit(hop)), F.array(last)))


def quality_windows(seconds: Column) -> Column:
    """Number of 9.01 s windows at a 1 s hop; a shorter signal is doubled until it fills one."""
    length = F.when(seconds < 9.01, seconds * F.pow(F.lit(2.0), F.ceil(F.log2(9.01 / seconds)))).otherwise(seconds)
    return F.when(seconds > 0, F.greatest(F.floor(length) - 9, F.lit(1)).cast("int")).otherwise(0)


def envelope(x: Column, frame: int, hop: int) -> Column:
    """RMS envelope in dB: frames of ``frame`` samples every ``hop``, at least one; a signal shorter than a frame is filled up with silence."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(x) - frame + 1, F.lit(1)), F.lit(hop))
    mean = lambda y: F.aggregate(y, F.lit(0.0), lambda s, v: s + v.cast("double") * v) / frame
    return F.transform(starts, lambda i: decibel(F.sqrt(mean(F.slice(x, i, frame)))))


def runs_below(x: Column, level: Column) -> Column:
    """array<struct<a,b>>: half-open index ranges where x stays below ``level``, found in one fold."""
    state = "struct<open:int,runs:array<struct<a:int,b:int>>>"
    zero = F.struct(F.lit(None).cast("int").alias("open"), F.array().cast("array<struct<a:int,b:int>>").alias("runs")).cast(state)
    marked = F.transform(F.concat(x, F.array(F.lit(float("inf")))), lambda v, i: F.struct(v.alias("v"), i.alias("i")))

    def step(s: Column, e: Column) -> Column:
        low = e["v"] < level
        return F.struct(
            F.when(low, F.coalesce(s["open"], e["i"])).alias("open"),
            F.when(~low & s["open"].isNotNull(), F.concat(s["runs"], F.array(F.struct(s["open"].alias("a"), e["i"].alias("b"))))).otherwise(s["runs"]).alias("runs"),
        ).cast(state)

    return F.aggregate(marked, zero, step, lambda s: s["runs"])


def music_cascade(score: Column, separated_db: Column, threshold: float = 0.05) -> Column:
    """struct<music_score, music_db_separated, music_to_speech_db>: the cheap score decides whether the dear separation counts. Below the threshold a clip has no music, -80 dB; without
    a score (unreadable audio) nothing is known; with one, the ratio is that of the separation."""
    apart = score >= threshold
    db = F.when(~apart, F.lit(-80.0)).when(apart, F.greatest(separated_db, F.lit(-80.0)))
    return F.struct(F.round(score, 4).alias("music_score"), apart.alias("music_db_separated"), F.round(db, 2).alias("music_to_speech_db"))


def decode_filters(highpass_hz: float = 40.0, ceiling_db: float | None = None) -> str:
    """Filter chain for decoding a recording: a high pass, and a limiter (without automatic gain) only where a ceiling is asked for."""
    return ",".join([f"highpass=f={float(highpass_hz)}"] + ([] if ceiling_db is None else [f"alimiter=limit={10 ** (ceiling_db / 20):.4f}:level=false"]))


def background_music(db: Column, threshold: float, tagger: Column | None = None, tagger_min: float | None = None) -> Column:
    """Music above the threshold and, where a second opinion is asked for, that at its minimum too; null is false."""
    ok = db > threshold
    if tagger is not None and tagger_min is not None:
        ok = ok & (tagger >= tagger_min)
    return F.coalesce(ok, F.lit(False))
