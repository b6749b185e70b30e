"""Array, JSON and hash expressions."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import let


def windows(values: Column, sample_rate: Column | int, seconds: float) -> Column:
    """Consecutive windows of at least one value; the rest at the end is kept, and an array
    no longer than a window is its own window."""
    rate = F.lit(sample_rate) if isinstance(sample_rate, int) else sample_rate
    size = F.greatest(F.lit(1), F.floor(rate * seconds).cast("int"))
    starts = F.sequence(F.lit(0), F.greatest(F.size(values) - 1, F.lit(0)), size)
    return F.transform(starts, lambda s: F.slice(values, s + 1, size))


def array_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + x.cast("double"))


def array_mean(values: Column) -> Column:
    return F.try_divide(array_sum(values), F.size(values))


def array_std(values: Column, sample: bool = False) -> Column:
    """Population deviation, or that of a sample."""
    squares = lambda mean: F.aggregate(values, F.lit(0.0), lambda s, x: s + (x.cast("double") - mean) * (x.cast("double") - mean))
    return F.sqrt(F.try_divide(let(array_mean(values), squares), F.size(values) - int(sample)))


def window_means(values: Column, sample_rate: Column | int, seconds: float) -> Column:
    return F.transform(windows(values, sample_rate, seconds), array_mean)


def rms_frames(samples: Column, frame: int = 2048, hop: int = 512) -> Column:
    """Root mean square of centered, zero-padded frames."""
    half, n = frame // 2, F.size(samples)
    at = F.sequence(F.lit(0), F.floor(n / hop).cast("int"))

    def one(i: Column) -> Column:
        first = F.greatest(i * hop - half, F.lit(0))
        last = F.least(i * hop + half, n)
        return F.sqrt(F.aggregate(F.slice(samples, first + 1, F.greatest(last - first, F.lit(0))), F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")) / frame)

    return F.transform(at, one)


def softmax(logits: Column) -> Column:
    parts = let(F.array_max(logits), lambda top: F.transform(logits, lambda x: F.exp((x - top).cast("double"))))
    return let(parts, lambda p: let(array_sum(p), lambda total: F.transform(p, lambda x: x / total)))


def label_and_score(logits: Column, labels: list[str]) -> Column:
    """struct (label, score) of the greatest logit, the first of equals."""
    best = F.array_position(logits, F.array_max(logits)).cast("int")
    return F.struct(F.array(*map(F.lit, labels))[best - 1].alias("label"), softmax(logits)[best - 1].alias("score"))


def compact_json(value: Column) -> Column:
    """JSON without spaces, other alphabets as they are."""
    return F.to_json(value)


def content_hash(content: Column) -> Column:
    return F.sha2(content, 256)


def input_fingerprint(content: Column, *more: Column) -> Column:
    """What a cached result depends on: the file's hash, with other inputs of the operator."""
    digest = content_hash(content)
    return digest if not more else F.sha2(F.to_json(F.struct(digest.alias("sha"), *[x.alias(f"in{i}") for i, x in enumerate(more)])), 256)


def identity_hash(settings: dict) -> str:
    """The hash of an operator's settings, which names its checkpoint table."""
    return hashlib.sha256(json.dumps(settings, sort_keys=True, ensure_ascii=False, separators=(",", ":"), default=str).encode()).hexdigest()


#: File extensions and their types.
MIME_TYPES = {".wav": "audio/wav", ".mp3": "audio/mpeg", ".flac": "audio/flac", ".ogg": "audio/ogg", ".opus": "audio/ogg", ".m4a": "audio/mp4", ".aac": "audio/aac"}


def file_stem(path: Column) -> Column:
    return F.regexp_replace(F.substring_index(path, "/", -1), r"\.[^.]*$", "")


def mime_type(path: Column) -> Column:
    ext = F.lower(F.regexp_extract(path, r"(\.[^./]*)$", 1))
    out = F.lit("audio/wav")
    for k, v in MIME_TYPES.items():
        out = F.when(ext == k, v).otherwise(out)
    return out


def data_url(content: Column, path: Column) -> Column:
    return F.concat(F.lit("data:"), mime_type(path), F.lit(";base64,"), F.base64(content))
