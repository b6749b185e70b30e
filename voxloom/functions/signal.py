"""Waveform code in numpy, for use inside pandas UDFs: decoding, resampling, and signal measures."""

from __future__ import annotations

import io
import wave
from math import gcd

import numpy as np

from .numbers import WADA_CURVE, WADA_FIRST_DB


def decode_wav(data: bytes) -> tuple[np.ndarray, int]:
    """(channels, samples) float32 in [-1, 1], and the sample rate, of PCM WAV bytes."""
    with wave.open(io.BytesIO(data)) as f:
        width, channels, rate = f.getsampwidth(), f.getnchannels(), f.getframerate()
        raw = f.readframes(f.getnframes())
    if width == 1:
        x = (np.frombuffer(raw, np.uint8).astype(np.float32) - 128) / 128
    elif width == 3:
        b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        x = ((b[:, 0] | b[:, 1] << 8 | b[:, 2] << 16) << 8 >> 8).astype(np.float32) / (1 << 23)
    else:
        x = np.frombuffer(raw, f"<i{width}").astype(np.float32) / (1 << (8 * width - 1))
    return x.reshape(-1, channels).T, rate


def encode_wav(samples: np.ndarray, rate: int) -> bytes:
    """16-bit mono WAV bytes."""
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(1)
        f.setsampwidth(2)
        f.setframerate(rate)
        f.writeframes((np.clip(samples, -1, 1) * 32767).astype("<i2").tobytes())
    return out.getvalue()


def wav_header(data: bytes) -> dict | None:
    """frames, sample_rate, channels, bit_rate and duration; None where it isn't a WAV file."""
    try:
        with wave.open(io.BytesIO(data)) as f:
            n, rate, channels, width = f.getnframes(), f.getframerate(), f.getnchannels(), f.getsampwidth()
        return {"frames": n, "sample_rate": rate, "channels": channels, "bit_rate": str(rate * channels * width * 8), "duration": n / rate if rate else 0.0}
    except (wave.Error, EOFError):
        return None


def mono(samples: np.ndarray) -> np.ndarray:
    return samples.mean(axis=0) if samples.ndim > 1 else samples


def resample(x: np.ndarray, rate: int, target: int, zeros: int = 16) -> np.ndarray:
    """Windowed-sinc resampling by the ratio in lowest terms."""
    if rate == target or not len(x):
        return x.astype(np.float32)
    g = gcd(rate, target)
    up, down = target // g, rate // g
    cutoff = min(1.0, up / down)
    half = int(np.ceil(zeros / cutoff))
    n = -(-len(x) * up // down)
    padded = np.pad(x.astype(np.float64), (half, half + 1))
    out = np.empty(n)
    taps = np.arange(-half, half + 1)
    for phase in range(min(up, n)):
        at = np.arange(phase, n, up) * down  # in units of 1 / up samples
        base, frac = at // up, (at % up) / up
        t = taps - frac[:1, None]
        kernel = (cutoff * np.sinc(cutoff * t) * np.cos(np.pi * np.clip(t / (half + 1), -1, 1) / 2) ** 2).ravel()
        out[phase::up] = padded[base[:, None] + taps + half] @ kernel
    return out.astype(np.float32)


def decode(data: bytes) -> tuple[np.ndarray, int]:
    """Samples and rate: PCM WAV by decode_wav, everything else (FLAC, OGG, MP3) by soundfile, where that is installed."""
    if data[:4] == b"RIFF":
        return decode_wav(data)
    try:
        import soundfile
    except ImportError:
        raise ValueError("only WAV files can be read without the package soundfile") from None
    x, rate = soundfile.read(io.BytesIO(data), dtype="float32", always_2d=True)
    return x.T, rate


def load(data: bytes, target: int | None = None) -> tuple[np.ndarray, int]:
    x, rate = decode(data)
    x = mono(x)
    return (x, rate) if target is None else (resample(x, rate, target), target)


def prepared(data: bytes, target: int = 16_000) -> np.ndarray:
    """Mono samples at the target rate, clipped to [-1, 1]; samples that aren't finite or lie
    outside are refused."""
    x, rate = decode(data)
    if not np.isfinite(x).all() or (np.abs(x) > 1).any():
        raise ValueError("samples must be finite and within -1 and 1")
    return np.clip(resample(mono(x), rate, target), -1.0, 1.0)


def _frames(x: np.ndarray, size: int, hop: int) -> np.ndarray:
    padded = np.pad(x, size // 2)
    return np.lib.stride_tricks.sliding_window_view(padded, size)[::hop]


def bandwidth(x: np.ndarray, rate: int, floor_db: float = -50.0, ratio: float = 0.92, size: int = 2048) -> tuple[float, bool]:
    """The highest frequency whose mean power lies within floor_db of the peak, and whether that is
    so far below the Nyquist frequency that the clip looks upsampled."""
    if len(x) < size:
        return 0.0, False
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(size) / size)
    power = (np.abs(np.fft.rfft(_frames(x, size, size // 4) * window, axis=1)) ** 2).mean(axis=0)
    level = 10 * np.log10(power + 1e-12)
    top = np.flatnonzero(level >= level.max() + floor_db)[-1] * rate / size
    return round(float(top), 1), bool(top < ratio * rate / 2)


def rms_levels(x: np.ndarray, size: int = 2048, hop: int = 512) -> np.ndarray:
    rms = np.sqrt((_frames(x, size, hop).astype(np.float64) ** 2).mean(axis=1))
    return 20 * np.log10(np.maximum(rms, 1e-8))


def pitch_track(x: np.ndarray, rate: int, low: float = 65.0, high: float = 1000.0, threshold: float = 0.15, hop: int = 512) -> np.ndarray:
    """Fundamental frequencies of voiced frames by the YIN difference function; an approximation of
    probabilistic trackers, within a percent on steady tones."""
    longest = int(rate / low) + 1
    size = 2 * longest
    if len(x) < size:
        return np.zeros(0)
    f = np.lib.stride_tricks.sliding_window_view(x.astype(np.float64), size)[::hop]
    n = 1 << (2 * size - 1).bit_length()
    head = f[:, :longest]
    cross = np.fft.irfft(np.fft.rfft(f, n) * np.conj(np.fft.rfft(head, n)), n)[:, :longest]
    sums = np.cumsum(np.pad(f**2, ((0, 0), (1, 0))), axis=1)
    lags = np.arange(longest)
    energy = sums[:, lags + longest] - sums[:, lags]
    diff = energy[:, :1] + energy - 2 * cross
    mean = np.cumsum(diff[:, 1:], axis=1)
    norm = np.ones_like(diff)
    norm[:, 1:] = diff[:, 1:] * lags[1:] / np.maximum(mean, 1e-12)
    first = max(2, int(rate / high))
    out = []
    for row, e in zip(norm, energy[:, 0]):
        below = np.flatnonzero(row[first : longest - 1] < threshold)
        if e <= 1e-8 or not len(below):
            continue
        k = first + below[0]
        while k + 1 < longest - 1 and row[k + 1] < row[k]:
            k += 1
        a, b, c = row[k - 1], row[k], row[k + 1]
        bend = a - 2 * b + c
        out.append(rate / (k + (0.5 * (a - c) / bend if bend > 0 else 0.0)))
    return np.array(out)


def pitch_stats(x: np.ndarray, rate: int, sample: bool = False, **options) -> tuple[float, float]:
    """Mean and deviation over voiced frames; zeros without any."""
    f0 = pitch_track(x, rate, **options)
    return (float(f0.mean()), float(f0.std(ddof=int(sample and len(f0) > 1)))) if len(f0) else (0.0, 0.0)


def style(x: np.ndarray, rate: int, pitch: tuple[float, float] | None = None) -> tuple[float, float, float]:
    """Mean level, its deviation, and pitch deviation over pitch mean."""
    level = rms_levels(x)
    mean, std = pitch if pitch and None not in pitch else pitch_stats(x, rate)
    return float(level.mean()), float(level.std()), std / mean if mean and mean > 0 else 0.0


def wada_snr(x: np.ndarray) -> float:
    """Blind signal-to-noise ratio; NaN for silence. An empty clip is an error."""
    if not len(x):
        raise ValueError("no samples")
    peak = np.abs(x).max()
    if not peak:
        return float("nan")
    level = np.maximum(np.abs(x.astype(np.float64)) / peak, 1e-10)
    gap = np.log(max(1e-10, level.mean())) - np.log(level).mean()
    below = np.flatnonzero(np.array(WADA_CURVE) < gap)
    if not len(below):
        return float(WADA_FIRST_DB)
    k = int(below[-1])
    if k == len(WADA_CURVE) - 1:
        return float(WADA_FIRST_DB + k)
    return WADA_FIRST_DB + k + (gap - WADA_CURVE[k]) / (WADA_CURVE[k + 1] - WADA_CURVE[k])
