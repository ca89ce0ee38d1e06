"""Integrated loudness of whole clips after ITU-R BS.1770: K-weighting, overlapping blocks, two gates. Vectorised over the samples of a clip, in Arrow batches."""

from __future__ import annotations

import functools
import math

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK_SEC, STEP = 0.4, 0.25
ABSOLUTE, RELATIVE, OFFSET = -70.0, -10.0, -0.691
# The shelf lifts by so many dB around this frequency, the high pass begins at that one.
SHELF_DB, SHELF_HZ, SHELF_Q = 4.0, 1500.0, 1 / math.sqrt(2)
PASS_HZ, PASS_Q = 38.0, 0.5


def _shelf(rate: int) -> tuple[np.ndarray, np.ndarray]:
    g, w = 10 ** (SHELF_DB / 40), 2 * math.pi * SHELF_HZ / rate
    c, s = math.cos(w), 2 * math.sqrt(g) * math.sin(w) / (2 * SHELF_Q)
    return g * np.array([g + 1 + (g - 1) * c + s, -2 * (g - 1 + (g + 1) * c), g + 1 + (g - 1) * c - s]), np.array([g + 1 - (g - 1) * c + s, 2 * (g - 1 - (g + 1) * c), g + 1 - (g - 1) * c - s])


def _high_pass(rate: int) -> tuple[np.ndarray, np.ndarray]:
    w = 2 * math.pi * PASS_HZ / rate
    c, s = math.cos(w), math.sin(w) / (2 * PASS_Q)
    return np.array([1 + c, -2 * (1 + c), 1 + c]) / 2, np.array([1 + s, -2 * c, 1 - s])


@functools.lru_cache(maxsize=16)
def weighting(rate: int) -> np.ndarray:
    """Impulse response of both filters; it has died away (below 1e-15) after a quarter of a second."""
    x = np.zeros(rate // 4 + 1)
    x[0] = 1.0
    for b, a in (_shelf(rate), _high_pass(rate)):
        b, a = b / a[0], a / a[0]
        y = np.zeros_like(x)
        for i in range(len(x)):
            y[i] = sum(b[k] * x[i - k] for k in range(3) if i >= k) - sum(a[k] * y[i - k] for k in (1, 2) if i >= k)
        x = y
    return x


def loudness(x: np.ndarray, rate: int) -> float | None:
    """LUFS of mono samples, to two decimals; None up to one block, and where nothing passes the gates."""
    if rate <= 0 or len(x) <= int(BLOCK_SEC * rate):
        return None
    h = weighting(rate)
    n = 1 << (len(x) + len(h) - 2).bit_length()
    y = np.fft.irfft(np.fft.rfft(x, n) * np.fft.rfft(h, n), n)[: len(x)]
    blocks = int(round((len(x) / rate - BLOCK_SEC) / (BLOCK_SEC * STEP))) + 1
    at = np.arange(blocks)
    lo, hi = (BLOCK_SEC * (at * STEP) * rate).astype(int), np.minimum((BLOCK_SEC * (at * STEP + 1) * rate).astype(int), len(x))
    energy = np.append(0.0, np.cumsum(np.square(y)))
    power = (energy[hi] - energy[lo]) / (BLOCK_SEC * rate)
    level = lambda p: OFFSET + 10 * np.log10(np.maximum(p, 1e-300))
    loud = power[level(power) >= ABSOLUTE]
    if not len(loud):
        return None
    kept = power[(level(power) > level(loud.mean()) + RELATIVE) & (level(power) > ABSOLUTE)]
    return round(float(level(kept.mean())), 2) if len(kept) else None


@F.pandas_udf(T.DoubleType())
def loudness_lufs(samples, rate):  # noqa: ANN001, ANN201
    """Column version: array of mono samples in -1..1 and the rate; nulls stay null."""
    import pandas as pd

    return pd.Series([None if x is None or pd.isna(r) else loudness(np.asarray(x, float), int(r)) for x, r in zip(samples, rate)], dtype="float64")
