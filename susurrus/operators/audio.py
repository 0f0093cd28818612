"""PCM audio in WAV bytes: decoding, duration, loudness matching, frame features."""

from __future__ import annotations

import io
import math
import wave
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .segmentation import pelt_rbf

FACTS = T.StructType([T.StructField("seconds", T.DoubleType()), T.StructField("rate", T.IntegerType()), T.StructField("channels", T.IntegerType()), T.StructField("rms", T.DoubleType()), T.StructField("peak", T.DoubleType())])


def decode(data: bytes) -> tuple[np.ndarray, int]:
    """(samples x channels in [-1, 1], rate) of 16- or 32-bit PCM."""
    with wave.open(io.BytesIO(data)) as w:
        kind = {2: "<i2", 4: "<i4"}[w.getsampwidth()]
        x = np.frombuffer(w.readframes(w.getnframes()), kind).reshape(-1, w.getnchannels())
        return x / float(2 ** (8 * w.getsampwidth() - 1)), w.getframerate()


def encode(x: np.ndarray, rate: int) -> bytes:
    """16-bit PCM, clipped to [-1, 1]."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(x.shape[1])
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes(np.round(np.clip(x, -1, 1) * 32767).astype("<i2").tobytes())
    return out.getvalue()


@F.pandas_udf(FACTS)
def audio_facts(content: pd.Series) -> pd.DataFrame:
    """Duration, rate, channels, RMS and peak; nulls for null and for what is no PCM WAV."""

    def one(b):
        try:
            x, rate = decode(b)
        except Exception:  # noqa: BLE001 - any broken file counts as unreadable
            return (None, None, None, None, None)
        return (len(x) / rate, rate, x.shape[1], float(np.sqrt((x**2).mean())) if x.size else 0.0, float(np.abs(x).max()) if x.size else 0.0)

    return pd.DataFrame([one(b) for b in content], columns=["seconds", "rate", "channels", "rms", "peak"]).astype({"rate": "Int32", "channels": "Int32"})


def gain(source_rms, reference_rms, peak, limit: float = 0.99):
    """The factor that brings a clip to the reference RMS, 1 for silence, lowered so that its peak stays below `limit`."""
    g = F.when(source_rms <= 1e-10, F.lit(1.0)).otherwise(reference_rms / source_rms)
    return F.when(peak * g > limit, limit / peak).otherwise(g)


@F.pandas_udf(T.BinaryType())
def amplified(content: pd.Series, factor: pd.Series) -> pd.Series:
    """The clip times a factor, as 16-bit PCM; null for what is no PCM WAV."""

    def one(b, g):
        if b is None or g is None:
            return b
        try:
            x, rate = decode(b)
        except Exception:  # noqa: BLE001 - as above
            return None
        return encode(x * g, rate)

    return pd.Series([one(b, g) for b, g in zip(content, factor, strict=True)])


def left_slice(x: np.ndarray, rate: int, start: float, end: float) -> np.ndarray:
    """The first channel between two times (whole samples around them); empty beyond the sound."""
    lo, hi = max(0, math.floor(start * rate)), min(len(x), math.ceil(end * rate))
    return x[lo:hi, 0] if hi > lo else np.zeros(0)


def _frames(y: np.ndarray, size: int, hop: int) -> np.ndarray:
    """Frames of `size` centred at every `hop` samples, the sound padded with silence by half a frame."""
    padded = np.concatenate([np.zeros(size // 2), y, np.zeros(size // 2)])
    return np.lib.stride_tricks.sliding_window_view(padded, size)[::hop][: 1 + len(y) // hop]


def mel_bands(rate: int, size: int, bands: int = 128) -> np.ndarray:
    """Triangular filters (bands x bins) evenly spaced in mel, linear below 1 kHz and logarithmic above, of equal area."""
    def mel(hz):
        return np.where(hz < 1000, hz * 3 / 200, 15 + 27 * np.log(np.maximum(hz, 1e-9) / 1000) / np.log(6.4))

    def hertz(m):
        return np.where(m < 15, m * 200 / 3, 1000 * np.exp(np.log(6.4) * (m - 15) / 27))

    edges = hertz(np.linspace(0, float(mel(np.array(rate / 2))), bands + 2))
    bins = np.fft.rfftfreq(size, 1 / rate)
    up = (bins[None] - edges[:-2, None]) / np.diff(edges)[:-1, None]
    down = (edges[2:, None] - bins[None]) / np.diff(edges)[1:, None]
    return np.maximum(0, np.minimum(up, down)) * (2 / (edges[2:] - edges[:-2]))[:, None]


def cepstrum(power: np.ndarray, rate: int, size: int, kept: int = 20, bands: int = 128) -> np.ndarray:
    """The first `kept` cepstral coefficients of power spectra (frames x bins): cosine transform of the mel bands in dB, at
    most 80 dB below the loudest."""
    db = 10 * np.log10(np.maximum(power @ mel_bands(rate, size, bands).T, 1e-10))
    db = np.maximum(db, db.max() - 80) if db.size else db
    k = np.arange(bands)
    basis = np.cos(np.pi * np.outer(np.arange(kept), 2 * k + 1) / (2 * bands)) * np.sqrt(2 / bands)
    basis[0] /= np.sqrt(2)
    return db @ basis.T


def slope(x: np.ndarray, width: int = 9) -> np.ndarray:
    """Local slope of each column over `width` rows, by least squares; the edges repeat their nearest whole window."""
    half = width // 2
    if len(x) < width:
        return np.zeros_like(x)
    t = np.arange(-half, half + 1)
    inner = np.tensordot(np.lib.stride_tricks.sliding_window_view(x, width, axis=0), t, axes=([2], [0])) / (t**2).sum()
    return np.concatenate([np.repeat(inner[:1], half, 0), inner, np.repeat(inner[-1:], half, 0)])


def contrast(magnitude: np.ndarray, rate: int, size: int, bands: int = 6, low: float = 200.0, share: float = 0.02) -> np.ndarray:
    """Per octave band the difference in dB of the loudest and the quietest `share` of the bins."""
    hz, edges = np.fft.rfftfreq(size, 1 / rate), np.concatenate([[0.0], low * 2.0 ** np.arange(bands + 1)])
    out = np.zeros((len(magnitude), bands + 1))
    for b in range(bands + 1):
        inside = np.sort(magnitude[:, (hz >= edges[b]) & (hz <= edges[b + 1])], 1)
        if inside.shape[1]:
            n = max(1, round(share * inside.shape[1]))
            out[:, b] = 20 * np.log10(np.maximum(inside[:, -n:].mean(1), 1e-10)) - 20 * np.log10(np.maximum(inside[:, :n].mean(1), 1e-10))
    return out


def sound_features(y: np.ndarray, rate: int, size: int = 1024, hop: int = 128, kept: int = 20) -> np.ndarray:
    """Per frame: cepstral coefficients with their slopes and second slopes, spectral contrast, flatness, zero crossings,
    RMS, centroid, bandwidth, roll-off (85 %), flux, share of energy from 4 kHz on, onset strength."""
    if not len(y):
        return np.zeros((0, 3 * kept + 7 + 9))
    f = _frames(np.asarray(y, float), size, hop)
    magnitude = np.abs(np.fft.rfft(f * (0.5 - 0.5 * np.cos(2 * np.pi * np.arange(size) / size)), axis=1))
    power, hz = magnitude**2, np.fft.rfftfreq(size, 1 / rate)
    c = cepstrum(power, rate, size, kept)
    d = slope(c)
    sure = np.maximum(power, 1e-10)
    weight = magnitude / np.maximum(magnitude.sum(1, keepdims=True), 1e-10)
    center = (weight * hz).sum(1)
    roll = hz[(magnitude.cumsum(1) >= 0.85 * magnitude.sum(1, keepdims=True)).argmax(1)]
    flux = np.sqrt((np.diff(magnitude, axis=0, prepend=magnitude[:1]) ** 2).sum(1))
    mel = 10 * np.log10(np.maximum(power @ mel_bands(rate, size).T, 1e-10))
    onset = np.maximum(0, np.diff(mel, axis=0, prepend=mel[:1])).mean(1)
    return np.column_stack([
        c, d, slope(d), contrast(magnitude, rate, size), np.exp(np.log(sure).mean(1)) / sure.mean(1), (np.diff(np.signbit(f), axis=1) != 0).mean(1), np.sqrt((f**2).mean(1)),
        center, np.sqrt((weight * (hz - center[:, None]) ** 2).sum(1)), roll, flux, power[:, hz >= 4000].sum(1) / (power.sum(1) + 1e-8), onset,
    ])


def window_statistics(x: np.ndarray, window: int, step: int, eps: float = 1e-8) -> tuple[np.ndarray, np.ndarray]:
    """(centres, mean and deviation of every column) of each `step`-th full window of `window` rows, by running sums."""
    first = np.arange(0, len(x) - window + 1, step) if len(x) >= window else np.zeros(0, int)
    sums = lambda v: np.concatenate([np.zeros((1, v.shape[1])), v.cumsum(0)])
    a, b = sums(x), sums(x**2)
    mean = (a[first + window] - a[first]) / window
    spread = np.maximum((b[first + window] - b[first]) / window - mean**2, 0)
    return first + window // 2, np.column_stack([mean, np.sqrt(spread + eps)])


def cut_sound(y: np.ndarray, rate: int, start: float, end: float, size: int = 1024, hop: int = 128, window: float = 3.0, step: float = 0.5, penalty: float = 15.0, least: float = 10.0, keep: float = 10.0, gap: float = 2.0) -> list[tuple[float, float, bool]]:
    """Stretches (start, end, kept) of one sound between changes of its texture.

    The mean is taken off, features are scaled by median and quartiles, windows get mean and deviation, these are
    standardised and brought to unit length, change points of them are searched, boundaries nearer than `least` are merged,
    lie halfway between the centres beside them, inner edges shrink by half of `gap`, and stretches under `keep` aren't
    kept. An empty sound, or one shorter than a window, is an error.
    """
    if end <= start or not len(y):
        raise ValueError("empty segment")
    x = sound_features(y - np.mean(y), rate, size, hop)
    low, mid, high = np.percentile(x, [25, 50, 75], axis=0)
    dt = hop / rate
    centres, v = window_statistics((x - mid) / (high - low + 1e-8), max(2, round(window / dt)), max(1, round(step / dt)))
    if not len(v):
        raise ValueError("no window fits")
    v = (v - v.mean(0)) / np.where(v.std(0) > 0, v.std(0), 1)
    v = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
    fewest = max(1, round(least / step))
    bounds = [0, *pelt_rbf(v, penalty, fewest)] if len(v) >= 2 * fewest else [0, len(v)]
    kept = [bounds[0]]
    for b in bounds[1:-1]:
        if b - kept[-1] >= fewest:
            kept.append(b)
    kept.append(bounds[-1])
    at = [start, *(start + (centres[b - 1] + centres[b]) * dt / 2 for b in kept[1:-1]), end]
    out = []
    for k in range(len(kept) - 1):
        lo, hi = at[k] + (gap / 2 if k else 0), at[k + 1] - (gap / 2 if k < len(kept) - 2 else 0)
        out.append((float(lo), float(hi), hi - lo >= keep))
    return out


def cut_videos(lines: DataFrame, sounds: DataFrame, video: str, start: str, end: str, content: str, **how) -> DataFrame:
    """Rows (video, start, end, clean_start, clean_end, kept, error): every timeline line (video, start, end) cut by its
    sound (video, content: PCM WAV). A line that can't be cut keeps its own bounds and tells why: no sound, a sound that
    can't be read, too short, or a failed search. Each line is one task of work; a sound is decoded for each of its lines.
    """
    x = lines.join(sounds.select(video, F.col(content).alias("__content")), video, "left").select(video, F.col(start).alias("start"), F.col(end).alias("end"), "__content")
    kind = dict(lines.dtypes)[video]

    def one(content, a, b) -> tuple[list, str | None]:
        if content is None:
            return [(a, b, True)], "no sound"
        try:
            pcm, rate = decode(content)
        except Exception:  # noqa: BLE001 - any broken file counts as unreadable
            return [(a, b, True)], "unreadable sound"
        try:
            return cut_sound(left_slice(pcm, rate, a, b), rate, a, b, **how), None
        except ValueError as e:
            return [(a, b, True)], str(e)

    def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            rows = [(v, a, b, *piece, error) for v, a, b, c in zip(pdf[video], pdf["start"], pdf["end"], pdf["__content"], strict=True) for pieces, error in [one(c, a, b)] for piece in pieces]
            yield pd.DataFrame(rows, columns=[video, "start", "end", "clean_start", "clean_end", "kept", "error"])

    return x.where("start is not null and end is not null").mapInPandas(cut, f"{video} {kind}, start double, end double, clean_start double, clean_end double, kept boolean, error string")


def frame_features(x: np.ndarray, rate: int, frame: int = 1024, hop: int = 512) -> np.ndarray:
    """Per frame RMS, zero-crossing rate, spectral centroid, flatness and roll-off of the first channel."""
    y = x[:, 0] - x[:, 0].mean() if len(x) else np.zeros(0)
    n = 1 + max(0, (len(y) - frame) // hop) if len(y) >= frame else 0
    if not n:
        return np.zeros((0, 5))
    f = np.lib.stride_tricks.sliding_window_view(y, frame)[::hop][:n]
    power = np.abs(np.fft.rfft(f * np.hanning(frame), axis=1)) ** 2 + 1e-12
    hz = np.fft.rfftfreq(frame, 1 / rate)
    total = power.sum(1)
    roll = hz[(power.cumsum(1) >= 0.85 * total[:, None]).argmax(1)]
    return np.column_stack([np.sqrt((f**2).mean(1)), (np.diff(np.signbit(f), axis=1) != 0).mean(1), (power * hz).sum(1) / total, np.exp(np.log(power).mean(1)) / power.mean(1), roll])
