"""Waveform kernels in numpy, and Arrow UDFs over waveforms as packed float32 (BINARY)."""

from __future__ import annotations

import io
import math
import wave
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as t

# What counts as clipped or silent, and the ratios that warn or fail.
CLIP, SILENT_RMS, FRAME_S = 0.99, 0.005, 0.05
CLIP_WARN, CLIP_FAIL, SILENCE_WARN, SILENCE_FAIL = 0.01, 0.05, 0.5, 0.8
FLOOR_DB = -120.0


def unpack(raw: bytes | None) -> np.ndarray:
    return np.frombuffer(raw or b"", np.float32)


def decode_pcm(raw: bytes) -> tuple[np.ndarray, int, int, int] | None:
    """PCM WAV bytes as (samples x channels, rate, channels, bits); None if they are no such file."""
    try:
        with wave.open(io.BytesIO(raw)) as f:
            rate, channels, width, frames = f.getframerate(), f.getnchannels(), f.getsampwidth(), f.readframes(f.getnframes())
    except (wave.Error, EOFError):
        return None
    if width == 1:
        x = (np.frombuffer(frames, np.uint8).astype(np.float32) - 128) / 128
    elif width == 3:
        b = np.frombuffer(frames[: len(frames) // 3 * 3], np.uint8).reshape(-1, 3).astype(np.int32)
        x = (((b[:, 0] << 8) | (b[:, 1] << 16) | (b[:, 2] << 24)) >> 8).astype(np.float32) / 2**23
    else:
        x = np.frombuffer(frames[: len(frames) // width * width], {2: "<i2", 4: "<i4"}[width]).astype(np.float32) / 2 ** (8 * width - 1)
    return x[: len(x) // channels * channels].reshape(-1, channels), rate, channels, 8 * width


def resample(x: np.ndarray, rate: int, to: int) -> np.ndarray:
    if rate == to or not len(x):
        return x.astype(np.float32)
    n = max(1, round(len(x) * to / rate))
    return np.interp(np.arange(n) * (rate / to), np.arange(len(x)), x).astype(np.float32)


def encode_pcm16(x: np.ndarray, rate: int) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(1)
        f.setsampwidth(2)
        f.setframerate(rate)
        f.writeframes((np.clip(x, -1, 1) * 32767).astype("<i2").tobytes())
    return out.getvalue()


def peak_normalise(x: np.ndarray, peak: float = 0.95) -> np.ndarray:
    top = float(np.abs(x).max(initial=0.0))
    return x if top < 1e-6 else (x / top * peak).astype(np.float32)


def preprocess(x: np.ndarray) -> np.ndarray:
    """Without its mean, at peak 0.95."""
    return peak_normalise(x - x.mean(dtype=np.float64)).astype(np.float32) if len(x) else x


def rms(x: np.ndarray) -> float:
    return math.sqrt(float(np.mean(np.square(x, dtype=np.float64)))) if len(x) else 0.0


def rms_db(x: np.ndarray, least: float = 1e-9) -> float:
    level = rms(x)
    return FLOOR_DB if level <= least else 20 * math.log10(level)


def _padded(parts: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(parts), max((len(p) for p in parts), default=0)), np.float64)
    for row, p in zip(out, parts, strict=True):
        row[: len(p)] = p
    return out


def mix(parts: list[np.ndarray]) -> tuple[np.ndarray, dict]:
    """Any number of channels at one loudness (their median, .01 to .35, gain of 2 at most), averaged, limited above .98."""
    x = _padded(parts)
    levels = np.array([rms(p) for p in parts])
    heard = levels[levels > 1e-9]
    target = float(np.clip(np.median(heard), 0.01, 0.35)) if len(heard) else 0.0
    gain = np.where(levels > 1e-9, np.minimum(2.0, target / np.maximum(levels, 1e-9)), 1.0)
    out = (x * gain[:, None]).sum(axis=0) / max(1, len(parts))
    before = float(np.abs(out).max(initial=0.0))
    if before > 0.98:
        out = out / before * 0.95
    return out.astype(np.float32), {"peak_before": before, "peak_after": float(np.abs(out).max(initial=0.0)), "clipping_prevented": before > 0.98}


def mix_pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Two sides at peak .95, brought to their mean loudness (1e-4 to .35, gain of 2 at most), halved and limited above .98."""
    sides = [peak_normalise(a), peak_normalise(b)]
    levels = [rms(s) for s in sides]
    target = min(0.35, max(1e-4, sum(levels) / 2))
    x = _padded([s * min(2.0, target / v) if v > 1e-9 else s for s, v in zip(sides, levels, strict=True)]).sum(axis=0) * 0.5
    top = float(np.abs(x).max(initial=0.0))
    return (x / top * 0.98 if top > 0.98 else x).astype(np.float32)


def clipping_ratio(x: np.ndarray) -> float:
    return float(np.mean(np.abs(x) >= CLIP)) if len(x) else 0.0


def frames(x: np.ndarray, size: int) -> np.ndarray:
    """Rows of `size` samples, the last one padded with zeros."""
    size = max(1, size)
    out = np.zeros((-(-len(x) // size), size), np.float64)
    out.ravel()[: len(x)] = x
    return out


def silence_ratio(x: np.ndarray, rate: int) -> float:
    if not len(x):
        return 1.0
    level = np.sqrt(np.mean(frames(x, int(rate * FRAME_S)) ** 2, axis=1))
    return float(np.mean(level < SILENT_RMS))


def session_snr_db(x: np.ndarray, rate: int, speech: list[tuple[float, float]]) -> float:
    """Mean power inside speech against outside, in dB; 0 where either is missing."""
    edge = np.zeros(len(x) + 1, np.int64)
    for a, b in speech:
        edge[min(len(x), max(0, int(a * rate)))] += 1
        edge[min(len(x), max(0, int(b * rate)))] -= 1
    inside = np.cumsum(edge[:-1]) > 0
    if not inside.any() or inside.all():
        return 0.0
    power = np.square(x, dtype=np.float64)
    return 10 * math.log10(max(1e-12, power[inside].mean()) / (power[~inside].mean() + 1e-12))


#: Segments under half a second tell nothing of noise, nor do parts below the floor, nor constant ones.
SNR_SHORTEST_S, SNR_FLOOR_DB, SNR_CLIPPED, SNR_FLAT = 0.5, -60.0, 0.005, 1e-6


def snr_table(x: np.ndarray, rate: int, spans: np.ndarray, speech: np.ndarray | None = None) -> pd.DataFrame:
    """snr_db, snr_reason, clipping_ratio of all segments (rows start, end in seconds) of a recording; speech: a mask of samples that alone are measured, where a segment has any.

    Each segment is first reduced to its level, spread, clipped share and the 20th and 90th percentile of its
    magnitudes; the rules then run over whole columns. The ratio of the percentiles in dB is kept within -10 and 60.
    """
    spans = np.asarray(spans, np.float64).reshape(-1, 2)
    edges = np.clip((spans * rate).astype(np.int64), 0, len(x))
    stats = np.zeros((len(spans), 5))
    stats[:, 0] = FLOOR_DB
    for k in np.flatnonzero(np.diff(spans, axis=1)[:, 0] >= SNR_SHORTEST_S):
        keep = slice(*edges[k]) if speech is None or not speech[slice(*edges[k])].any() else edges[k, 0] + np.flatnonzero(speech[slice(*edges[k])])
        size = np.abs(x[keep].astype(np.float64))
        if len(size):
            stats[k] = rms_db(x[keep], 1e-12), x[keep].std(dtype=np.float64), (size >= np.float32(CLIP)).mean(), *np.quantile(size, (0.2, 0.9))
    level, spread, clipped, quiet, loud = stats.T
    short, faint = np.diff(spans, axis=1)[:, 0] < SNR_SHORTEST_S, level < SNR_FLOOR_DB
    known = ~short & ~faint & (spread >= SNR_FLAT) & (quiet > 1e-9) & (loud > quiet)
    ratio = np.divide(loud, quiet, out=np.ones_like(loud), where=known)
    rules = {"short_segment": short, "below_noise_floor": faint, "clipped": clipped > SNR_CLIPPED, "unreliable_estimate": ~known}
    reason = np.select(list(rules.values()), list(rules), default="")
    return pd.DataFrame({"snr_db": [float(v) if k else None for v, k in zip(np.clip(20 * np.log10(ratio), -10, 60), known, strict=True)], "snr_reason": [r or None for r in reason.tolist()], "clipping_ratio": clipped}).astype({"snr_db": object})


def decay_time(x: np.ndarray, rate: int, windows: int = 6, seconds: float = 2.0) -> float:
    """Median time in which the loudness of a few windows falls to 1/e of its peak, 3 s at most: a stand-in for reverberation."""
    size, hop = int(seconds * rate), max(1, int(0.01 * rate))
    if len(x) < size // 2 or not size:
        return 0.0
    at = np.linspace(0, max(0, len(x) - size), min(windows, max(1, len(x) // size))).astype(int)
    found = []
    for a in at:
        level = np.sqrt(np.mean(frames(x[a : a + size], hop) ** 2, axis=1))
        top = int(level.argmax())
        below = np.flatnonzero(level[top:] < level[top] / math.e)
        if level[top] > 1e-6 and len(below):
            found.append(below[0] * hop / rate)
    return float(np.clip(np.median(found), 0, 3)) if found else 0.0


def spectrum(x: np.ndarray, rate: int, size: int = 2048) -> tuple[float, float]:
    """(spectral centroid in kHz, median frequency below which 95 % of the magnitude lies, in Hz)."""
    if not len(x):
        return 0.0, 0.0
    mag = np.abs(np.fft.rfft(frames(x, size) * np.hanning(size), axis=1))
    freq = np.fft.rfftfreq(size, 1 / rate)
    total = mag.sum(axis=1)
    heard = total > 1e-9
    if not heard.any():
        return 0.0, 0.0
    mag, total = mag[heard], total[heard]
    roll = freq[(np.cumsum(mag, axis=1) >= 0.95 * total[:, None]).argmax(axis=1)]
    return float(np.mean(mag @ freq / total) / 1000), float(np.median(roll))


def energy_vad(x: np.ndarray, rate: int, frame_s: float = 0.03, share: float = 0.15, shortest_s: float = 0.25, gap_s: float = 0.3, pad_s: float = 0.12) -> list[tuple[float, float]]:
    """Speech as runs of frames at 15 % of the recording's loudness or more, merged over short gaps, then padded."""
    if not len(x):
        return []
    size = max(1, int(rate * frame_s))
    part = frames(x, size)
    used = np.minimum(size, len(x) - np.arange(len(part)) * size)
    loud = np.sqrt((part**2).sum(axis=1) / used) >= (rms(x) + 1e-9) * share
    edge = np.flatnonzero(np.diff(np.concatenate([[0], loud.astype(np.int8), [0]])))
    spans = [(a * size / rate, min(b * size, len(x)) / rate) for a, b in edge.reshape(-1, 2)]
    out: list[list[float]] = []
    for a, b in (s for s in spans if s[1] - s[0] >= shortest_s):
        if out and a - out[-1][1] <= gap_s:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(max(0.0, a - pad_s), min(len(x) / rate, b + pad_s)) for a, b in out]


def lag_products(x: np.ndarray, y: np.ndarray, reach: int, block: int = 4096) -> np.ndarray:
    """Sums of x[i] * y[i + lag] for lag from -reach to reach, by overlapping blocks: each block of x meets the stretch of y within reach of it, and the blocks' spectra add up before one inverse transform."""
    count = -(-len(x) // block)
    heads = np.zeros((count, block))
    heads.ravel()[: len(x)] = x
    field = np.zeros(count * block + 2 * reach)
    field[reach : reach + len(y)] = y
    stretch = np.lib.stride_tricks.sliding_window_view(field, block + 2 * reach)[::block]
    size = 1 << (block + 2 * reach - 1).bit_length()
    spectrum = np.zeros(size // 2 + 1, complex)
    for k in range(0, count, 64):
        spectrum += (np.fft.rfft(stretch[k : k + 64], size) * np.fft.rfft(heads[k : k + 64], size).conj()).sum(axis=0)
    return np.fft.irfft(spectrum, size)[: 2 * reach + 1]


def estimate_offset(a: np.ndarray, b: np.ndarray, rate: int, max_lag_s: float = 1.5, least: float = 0.35, analysis: int = 4000) -> dict:
    """How much later b is than a: offset_ms, confidence, lag_samples, passed.

    Both are thinned to about `analysis` samples a second. The lag whose product is largest in magnitude wins; confidence is three
    quarters its share of the largest product possible and one quarter its lead over the runner-up. Under 16 samples nothing is told.
    """
    thin = max(1, round(rate / analysis))
    pair = [v.astype(np.float64) - v.mean(dtype=np.float64) if len(v) else np.zeros(0) for v in (a, b)]
    pair = [v[::thin] / (np.abs(v).max(initial=0.0) if np.abs(v).max(initial=0.0) > 1e-9 else 1.0) for v in pair]
    both = min(map(len, pair))
    if both < 16:
        return dict.fromkeys(("offset_ms", "lag_samples"), 0) | {"confidence": 0.0, "passed": False}
    pair = [v[:both] for v in pair]
    reach = int(np.clip(round(max_lag_s * rate / thin), 1, both - 1))
    height = np.abs(lag_products(*pair, reach))
    runner_up, peak = np.sort(height)[-2:]
    lag = (int(height.argmax()) - reach) * thin
    most = max(math.sqrt(math.prod(float(v @ v) for v in pair)), 1e-9)
    confidence = min(1.0, max(0.0, 0.75 * peak / most + 0.25 * (peak - runner_up) / max(peak, 1e-9)))
    return {"offset_ms": round(1000 * lag / rate), "confidence": round(confidence, 4), "lag_samples": lag, "passed": confidence >= least}


def shift(x: np.ndarray, lag: int) -> np.ndarray:
    """Moved earlier by lag samples (later, if negative), silence where nothing is left; the length stays."""
    out = np.zeros_like(x, np.float32)
    if lag >= 0:
        out[: max(0, len(x) - lag)] = x[lag:]
    else:
        out[-lag:] = x[: max(0, len(x) + lag)]
    return out


def mel_embedding(x: np.ndarray, rate: int, coefficients: int = 20, bands: int = 40, size: int = 512) -> np.ndarray:
    """Mean and deviation of cepstral coefficients and of their changes, at length 1."""
    x = np.pad(x, (0, max(0, int(0.1 * rate) - len(x))))
    power = np.abs(np.fft.rfft(frames(x, size) * np.hanning(size), axis=1)) ** 2
    hz = lambda m: 700 * (10 ** (m / 2595) - 1)
    points = hz(np.linspace(0, 2595 * math.log10(1 + rate / 2 / 700), bands + 2))
    freq = np.fft.rfftfreq(size, 1 / rate)
    up = (freq[None, :] - points[:-2, None]) / np.diff(points)[:-1, None]
    down = (points[2:, None] - freq[None, :]) / np.diff(points)[1:, None]
    log = np.log(power @ np.clip(np.minimum(up, down), 0, None).T + 1e-10)
    k = np.arange(bands)
    cep = log @ np.cos(np.pi / bands * (k[:, None] + 0.5) * np.arange(coefficients)[None, :])
    delta = np.gradient(cep, axis=0) if len(cep) > 1 else np.zeros_like(cep)
    v = np.concatenate([cep.mean(0), cep.std(0), delta.mean(0), delta.std(0)])
    return (v / (np.linalg.norm(v) + 1e-8)).astype(np.float32)


MEASURES = t.StructType([t.StructField(n, t.DoubleType()) for n in ("duration_s", "clipping_ratio", "silence_ratio", "rms_db", "rt60_s", "centroid_khz", "bandwidth_hz")])
SPANS = t.ArrayType(t.StructType([t.StructField("s", t.DoubleType()), t.StructField("e", t.DoubleType())]))
DECODED = t.StructType([t.StructField("waveform", t.BinaryType()), t.StructField("sample_rate", t.IntegerType()), t.StructField("channels", t.IntegerType()), t.StructField("bits", t.IntegerType())])
OFFSET = t.StructType([t.StructField("offset_ms", t.IntegerType()), t.StructField("confidence", t.DoubleType()), t.StructField("lag_samples", t.IntegerType()), t.StructField("passed", t.BooleanType())])
TARGET_RATE = 16_000


#: Files that are decoded at once: samples at 16 kHz may be many times their file's bytes.
DECODED_AT_ONCE = 32


def _decoded(content: pd.Series) -> pd.DataFrame:
    rows = []
    for raw in content:
        got = decode_pcm(raw) if raw else None
        rows.append((None, None, None, None) if got is None else (resample(got[0].mean(axis=1), got[1], TARGET_RATE).tobytes(), *got[1:]))
    return pd.DataFrame(rows, columns=DECODED.names)


@F.pandas_udf(DECODED)
def decode(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """WAV bytes as mono float32 at 16 kHz with what the header says; nulls where they can't be read."""
    for content in parts:
        for at in range(0, len(content), DECODED_AT_ONCE):
            yield _decoded(content.iloc[at : at + DECODED_AT_ONCE])


@F.pandas_udf(t.ArrayType(t.BinaryType()))
def channels(content: pd.Series) -> pd.Series:
    """The channels of WAV bytes, two at least: a mono file gives its one channel twice."""

    def split(raw: bytes) -> list[bytes] | None:
        got = decode_pcm(raw) if raw else None
        if got is None:
            return None
        parts = [resample(got[0][:, k], got[1], TARGET_RATE).tobytes() for k in range(got[2])]
        return parts * 2 if len(parts) == 1 else parts

    return content.map(split)


@F.pandas_udf(MEASURES)
def measure(raw: pd.Series, rate: pd.Series) -> pd.DataFrame:
    rows = []
    for b, r in zip(raw, rate, strict=True):
        x = unpack(b)
        khz, roll = spectrum(x, int(r))
        rows.append((len(x) / r, clipping_ratio(x), silence_ratio(x, int(r)), rms_db(x), decay_time(x, int(r)), khz, roll))
    return pd.DataFrame(rows, columns=MEASURES.names)


SNR = t.ArrayType(t.StructType([t.StructField("snr_db", t.DoubleType()), t.StructField("snr_reason", t.StringType()), t.StructField("clipping_ratio", t.DoubleType())]))


@F.pandas_udf(SNR)
def segment_snrs(raw: pd.Series, rate: pd.Series, spans: pd.Series) -> pd.Series:
    """snr_table() of the spans (structs s, e in seconds) of each waveform, in their order."""
    return pd.Series([snr_table(unpack(x), int(r), [(v["s"], v["e"]) for v in s]).to_dict("records") for x, r, s in zip(raw, rate, spans, strict=True)])


@F.pandas_udf(t.BinaryType())
def packed(samples: pd.Series) -> pd.Series:
    """Numbers as packed float32."""
    return samples.map(lambda x: np.asarray(x, np.float32).tobytes())


#: Waveforms that are made at once, of identifiers that are thousands to a batch.
MADE = 256


def noise_steps(k: int, p: int, n: int) -> np.ndarray:
    """n samples of noise in steps of silence, murmur, speech and overload; remainders have the sign of what is divided, and a step of no level is full scale."""
    i = np.arange(n, dtype=np.int64)
    noise = np.fmod(k * 131 + i * (i % 97) * 7 + p * 17, 2001) - 1000
    step = np.fmod(i // 200 + k + p, 4)
    x = noise * np.array([0, 4, 300, 1200])[np.maximum(step, 0)] / 1e6
    return np.where(step < 0, 1.0, np.clip(x, -1.0, 1.0)).astype(np.float32)


@F.pandas_udf(t.BinaryType())
def _stepped_noise(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for part in parts:
        for at in range(0, len(part[0]), MADE):
            rows = zip(*(x.iloc[at : at + MADE].tolist() for x in part), strict=True)
            yield pd.Series([(noise_steps(k, p, n) if known else np.ones(n, np.float32)).tobytes() for k, known, p, n in rows], dtype=object)


def stepped_noise(key: str, p: F.Column, samples: F.Column) -> F.Column:
    """A waveform of noise_steps() for an integer key (null: full scale), a few hundred at a time."""
    return _stepped_noise(F.coalesce(F.col(key).cast("long"), F.lit(0)), F.col(key).isNotNull(), p, samples)


@F.pandas_udf(SPANS)
def speech(raw: pd.Series, rate: pd.Series) -> pd.Series:
    return pd.Series([[{"s": a, "e": b} for a, b in energy_vad(unpack(x), int(r))] for x, r in zip(raw, rate, strict=True)])


@F.pandas_udf(OFFSET)
def offset(a: pd.Series, b: pd.Series, rate: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([estimate_offset(unpack(x), unpack(y), int(r)) for x, y, r in zip(a, b, rate, strict=True)], columns=OFFSET.names)


@F.pandas_udf(t.BinaryType())
def shifted(raw: pd.Series, lag: pd.Series) -> pd.Series:
    return pd.Series([shift(unpack(x), int(k)).tobytes() for x, k in zip(raw, lag, strict=True)])


@F.pandas_udf(t.BinaryType())
def prepared(raw: pd.Series) -> pd.Series:
    return raw.map(lambda x: preprocess(unpack(x)).tobytes())


@F.pandas_udf(t.BinaryType())
def wav_bytes(raw: pd.Series, rate: pd.Series) -> pd.Series:
    return pd.Series([encode_pcm16(unpack(x), int(r)) for x, r in zip(raw, rate, strict=True)])


@F.pandas_udf(t.ArrayType(t.FloatType()))
def embedding(raw: pd.Series, rate: pd.Series) -> pd.Series:
    return pd.Series([mel_embedding(unpack(x), int(r)).tolist() for x, r in zip(raw, rate, strict=True)])


def clip_span(raw: F.Column, rate: F.Column, start: F.Column, end: F.Column) -> F.Column:
    """The packed samples of start..end seconds; a substring, so it stays in the JVM."""
    a, b = F.floor(start * rate).cast("int"), F.floor(end * rate).cast("int")
    return F.substring(raw, a * 4 + 1, (b - a) * 4)


def fingerprint(raw: F.Column, rate: F.Column, seconds: int = 5) -> F.Column:
    """SHA-256 of the first seconds' samples."""
    return F.sha2(F.substring(raw, F.lit(1), rate * 4 * seconds), 256)
