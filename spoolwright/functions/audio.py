"""Signals as arrays of samples: mixing, gain, reverb, ducking, energy segments, channel plans.

Each function works on one clip (a row), in Arrow batches; the plain NumPy forms are beside the column functions. Decoding
files isn't part of the library: samples come as array<float> columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SAMPLES = T.ArrayType(T.FloatType())
PEAK = 0.98
# Weights-free caps of the six channel differences, as fractions of full scale.
CHANNEL_CAPS = {"rms": 0.2, "peak": 0.4, "zero_crossings": 0.2, "difference": 1.0, "correlation": 1.0, "silence": 0.5}


def rms(x: np.ndarray) -> float:
    return float(np.sqrt(np.mean(np.square(x, dtype=np.float64)))) if len(x) else 0.0


def peak_limited(x: np.ndarray, peak: float = PEAK, always: bool = False) -> np.ndarray:
    top = float(np.max(np.abs(x))) if len(x) else 0.0
    return x * (peak / top) if top > 0 and (always or top > peak) else x


def fitted_to(noise: np.ndarray, n: int, offset: int = 0) -> np.ndarray:
    """n samples of a noise that is repeated as needed."""
    return np.resize(np.roll(noise, -offset), n) if len(noise) else np.zeros(n)


def mixed_at(clean: np.ndarray, noise: np.ndarray, snr_db: float, duck: float = 1.0, offset: int = 0) -> np.ndarray:
    """Clean plus noise at the signal-to-noise ratio; silent noise or speech gives the clean signal. Scaled down only where the peak is above 0.99."""
    n = fitted_to(noise, len(clean), offset)
    a, b = rms(clean), rms(n)
    if not a or not b:
        return clean
    return peak_limited(clean + n * (a / b / 10 ** (snr_db / 20)) * duck, 0.99)


def voices_mixed(target: np.ndarray, other: np.ndarray, snr_db: float, overlap: float) -> np.ndarray:
    """The other voice laid over the last part `overlap` of the target (0: behind it), at the ratio, with the peak at PEAK."""
    a, b = rms(target), rms(other)
    start = int(round(len(target) * (1 - min(max(overlap, 0.0), 1.0))))
    out = np.zeros(max(len(target), start + len(other)))
    out[: len(target)] += target
    if a and b:
        out[start : start + len(other)] += other * (a / b / 10 ** (snr_db / 20))
    return peak_limited(out, PEAK, always=True)


def gained(x: np.ndarray, db: float) -> np.ndarray:
    """Gain, then the peak at PEAK: for a signal that isn't silent the second undoes the first, as published."""
    return peak_limited(x * 10 ** (db / 20), PEAK, always=True)


def reverberated(x: np.ndarray, response: np.ndarray, wet: float) -> np.ndarray:
    """Convolution with a room response of energy 1, mixed with the dry signal; as long as the dry one."""
    energy = np.sqrt(np.sum(np.square(response, dtype=np.float64)))
    if not len(x) or not energy:
        return x
    size = 1 << (len(x) + len(response) - 2).bit_length()
    tail = np.fft.irfft(np.fft.rfft(x, size) * np.fft.rfft(response / energy, size), size)[: len(x)]
    return peak_limited((1 - wet) * x + wet * tail, 0.99)


def ducked(x: np.ndarray, side: np.ndarray, threshold: float = 0.05, ratio: float = 4.0) -> np.ndarray:
    """Per-sample gain of at most 1 where the side signal is above the threshold."""
    level = np.abs(fitted_to(side, len(x)))
    gain = np.where(level > threshold, (threshold / np.maximum(level, 1e-12)) ** (1 - 1 / ratio), 1.0)
    return x * np.minimum(gain, 1.0)


def energy_runs(x: np.ndarray, rate: int, threshold: float, frame_s: float = 0.03, least_s: float = 0.1) -> list[tuple[float, float]]:
    """Stretches whose frames lie above an RMS threshold and that last long enough, in seconds."""
    n = max(1, int(rate * frame_s))
    frames = len(x) // n
    on = np.sqrt(np.mean(np.square(x[: frames * n].reshape(frames, n), dtype=np.float64), axis=1)) >= threshold if frames else np.zeros(0, bool)
    edge = np.flatnonzero(np.diff(np.r_[0, on.astype(int), 0]))
    return [(a * n / rate, b * n / rate) for a, b in zip(edge[::2], edge[1::2], strict=True) if (b - a) * n / rate >= least_s]


def channel_differences(left: np.ndarray, right: np.ndarray) -> dict[str, float]:
    """Six differences of two channels, each capped to its limit, and their mean as score (above 0.3 counts as different)."""
    n = min(len(left), len(right))
    a, b = np.asarray(left[:n], float), np.asarray(right[:n], float)
    if not n:
        return dict.fromkeys([*CHANNEL_CAPS, "score"], 0.0)
    crossings = lambda x: float(np.mean(np.diff(np.signbit(x)) != 0)) if n > 1 else 0.0
    whole = max(rms(a), rms(b))
    spread = np.std(a) * np.std(b)
    raw = {
        "rms": abs(rms(a) - rms(b)),
        "peak": abs(np.max(np.abs(a)) - np.max(np.abs(b))),
        "zero_crossings": abs(crossings(a) - crossings(b)),
        "difference": rms(a - b) / whole if whole else 0.0,
        "correlation": 1 - abs(float(np.mean((a - a.mean()) * (b - b.mean())) / spread)) if spread else 0.0,
        "silence": abs(float(np.mean(np.abs(a) < 0.01)) - float(np.mean(np.abs(b) < 0.01))),
    }
    out = {k: float(min(v, CHANNEL_CAPS[k]) / CHANNEL_CAPS[k]) for k, v in raw.items()}
    return out | {"score": float(np.mean(list(out.values())))}


def stereo_plan(left: np.ndarray, right: np.ndarray, silent: float = 0.001, same: float = 0.05) -> str:
    """'left', 'right' or 'both': a silent channel is dropped, of two alike the left one is kept."""
    a, b = rms(left), rms(right)
    if a < silent <= b:
        return "right"
    if b < silent or channel_differences(left, right)["difference"] < same:
        return "left"
    return "both"


def _arrow(kind: T.DataType, run: Callable) -> Callable[..., Column]:
    """A column function of a NumPy one; a row with a null array gives null."""

    def call(*columns: Column) -> Column:
        def batches(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for part in parts:
                series = part if isinstance(part, tuple) else (part,)
                out = [None if any(v is None for v in row) else run(*[np.asarray(v, float) if hasattr(v, "__len__") else v for v in row]) for row in zip(*series, strict=True)]
                yield pd.Series(out, dtype=object)

        if len(columns) == 1:

            def one(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
                yield from batches(parts)

            return F.pandas_udf(one, kind)(*columns)
        return F.pandas_udf(batches, kind)(*columns)

    return call


noise_mix = _arrow(_SAMPLES, lambda x, n, db: mixed_at(x, n, db).astype(np.float32))
voice_mix = _arrow(_SAMPLES, lambda x, o, db, part: voices_mixed(x, o, db, part).astype(np.float32))
gain = _arrow(_SAMPLES, lambda x, db: gained(x, db).astype(np.float32))
reverb = _arrow(_SAMPLES, lambda x, r, wet: reverberated(x, r, wet).astype(np.float32))
duck = _arrow(_SAMPLES, lambda x, s: ducked(x, s).astype(np.float32))
channel_plan = _arrow(T.StringType(), stereo_plan)
channel_score = _arrow(T.DoubleType(), lambda a, b: channel_differences(a, b)["score"])
