"""The catalogue of metrics: signal measures computed here, expressions, and models to plug in.

Signal measures share one pandas UDF, so a clip is decoded once for all of them. Metrics that need a
neural model name their columns, packages and failure values here; the model itself is a backend
that the user registers, and a metric without one says so before anything runs.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import signal
from ..functions.arrays import label_and_score
from ..functions.numbers import NAN_VALUE, speaking_rates
from ..functions.text import transfer_punctuation, with_error_rates
from ..schema import named
from .consensus import transcript_columns
from .resume import fill_missing_text
from .scoring import Scorer, run_scorer
from .spans import alignment_columns, diarization_columns

SIGNAL_COLUMNS = {
    "bandwidth": ("bandwidth_hz double", "is_upsampled_est boolean"),
    "wada_snr": ("wada_snr double",),
    "pitch": ("pitch_mean double", "pitch_std double"),
    "style": ("energy_db double", "energy_dynamics double", "expressiveness double"),
    "energy": ("energy_db double", "energy_dynamics double"),
}


def _measure(data: bytes | None, wanted: tuple[str, ...], options: dict[str, dict]) -> dict[str, Any]:
    out: dict[str, Any] = {}
    try:
        x, rate = signal.load(bytes(data))
    except Exception:  # noqa: BLE001  an unreadable file fails all its measures, not the job
        return out
    for name in wanted:
        try:
            o = options.get(name, {})
            if name == "bandwidth":
                out["bandwidth_hz"], out["is_upsampled_est"] = signal.bandwidth(x, rate, **o)
            elif name == "wada_snr":
                out["wada_snr"] = signal.wada_snr(x)
            elif name == "pitch":
                out["pitch_mean"], out["pitch_std"] = signal.pitch_stats(x, rate, **o)
            else:
                known = (out["pitch_mean"], out["pitch_std"]) if "pitch_mean" in out else None
                level = signal.rms_levels(x)
                out["energy_db"], out["energy_dynamics"] = float(level.mean()), float(level.std())
                if name == "style":
                    out["expressiveness"] = signal.style(x, rate, known)[2]
        except Exception:  # noqa: BLE001
            continue
    return out


def signal_metrics(clips: DataFrame, wanted: list[str], content: str = "content", options: dict[str, dict] | None = None) -> DataFrame:
    """clips with the columns of the wanted measures (bandwidth, wada_snr, pitch, style, energy) of the WAV
    bytes in `content`. A measure that fails is NaN, or null if it isn't a number. Pitch comes before
    style, which uses it."""
    names = tuple(sorted(dict.fromkeys(wanted), key=lambda x: list(SIGNAL_COLUMNS).index(x) if x != "pitch" else -1))
    columns = dict(c.split() for n in names for c in SIGNAL_COLUMNS[n])
    opts = options or {}

    @F.pandas_udf(", ".join(f"{k} {v}" for k, v in columns.items()))
    def run(data: pd.Series) -> pd.DataFrame:
        rows = [_measure(d, names, opts) for d in data]
        return pd.DataFrame({k: [r.get(k, NAN_VALUE if v == "double" else None) for r in rows] for k, v in columns.items()})

    found = clips.withColumn("_signal", run(named(content)))
    got = {k: F.coalesce(F.col(f"_signal.{k}"), F.lit(NAN_VALUE)) if v == "double" else F.col(f"_signal.{k}") for k, v in columns.items()}  # pandas makes NaN null
    return found.withColumns(got).drop("_signal")


def speaking_rate(clips: DataFrame, text: str = "text", duration: str = "duration") -> DataFrame:
    """speaking_rate, phonemes_per_word and char_rate, a character counting as a phoneme."""
    rates = ("speaking_rate", "phonemes_per_word", "char_rate")
    found = clips.withColumn("_rates", speaking_rates(named(text), named(duration)))
    return found.withColumns({k: F.col("_rates")[k] for k in rates}).drop("_rates")


def word_errors(clips: DataFrame, transcript: str, text: str = "text", prefix: str = "whisper") -> DataFrame:
    """<prefix>_wer and <prefix>_cer of a transcript against the text; -1 for both without a text."""
    return with_error_rates(clips, named(text), named(transcript), f"{prefix}_wer", f"{prefix}_cer")


def labelled(clips: DataFrame, logits: str, labels: list[str], output: str, columns: list[str] | tuple[str, ...] | str, target: str | None = None) -> DataFrame:
    """Columns from a classifier's logits. output: label, label_score, score (the best label's) or prob (the
    probability of `target`)."""
    columns = [columns] if isinstance(columns, str) else list(columns)
    best = label_and_score(named(logits), labels)
    from ..functions.arrays import softmax

    values: dict[str, list[Column]] = {"label": [best["label"]], "label_score": [best["label"], best["score"]], "score": [best["score"]]}
    if output == "prob":
        if target not in labels:
            raise ValueError(f"{target} is none of the labels")
        values["prob"] = [softmax(named(logits))[labels.index(target)]]
    if output not in values or len(values[output]) != len(columns):
        raise ValueError(f"output {output} doesn't fit the columns {columns}")
    return clips.withColumns(dict(zip(columns, values[output])))


@dataclass(frozen=True)
class ModelMetric:
    columns: dict[str, str]
    requires: tuple[str, ...] = ()
    failed: tuple = ()
    inputs: tuple[str, ...] = ("audio_file",)
    batch_size: int = 16
    batch_seconds: float = 480.0


NAN = NAN_VALUE
#: Metrics that a model computes: columns, packages, and what a clip gets that can't be scored.
MODELS: dict[str, ModelMetric] = {
    "crepe_pitch": ModelMetric({"pitch_mean": "double", "pitch_std": "double"}, ("torchcrepe",), (NAN, NAN)),
    "penn_pitch": ModelMetric({"pitch_mean": "double", "pitch_std": "double"}, ("penn",), (NAN, NAN)),
    "phonemes": ModelMetric({"n_phonemes": "int"}, ("phonemizer",), (None,), ("text",)),
    "distillmos": ModelMetric({"distillmos": "double"}, ("distillmos", "torch"), (NAN,)),
    "squim": ModelMetric({"pyt_stoi": "double", "pyt_pesq": "double", "pyt_si_sdr": "double"}, ("torchaudio",), (-1.0, -1.0, -1.0), batch_size=1),
    "snr_reverb": ModelMetric({"snr": "double", "c50": "double"}, ("pyannote.audio",), (NAN, NAN)),
    "whisper": ModelMetric({"transcript": "string"}, ("faster_whisper",), (None,)),
    "whisper_words": ModelMetric({"words": "array<struct<word:string,start:double,end:double>>"}, ("faster_whisper",), (None,)),
    "gigaam3": ModelMetric({"gigaam3_text": "string", "gigaam3_cer": "double"}, ("gigaam",), ("", -1.0), batch_seconds=320.0),
    "punctuation": ModelMetric({"text_punctuated": "string"}, ("torch",), (None,), ("text",)),
    "audio_model": ModelMetric({"logits": "array<double>"}, ("transformers", "torch"), (None,)),
    "gender": ModelMetric({"gender_pred": "string"}, ("transformers", "torch"), (None,)),
    "emotion": ModelMetric({"emotion_pred": "string", "emotion_score": "double"}, ("transformers", "torch"), (None, NAN)),
    "accent": ModelMetric({"accent": "string"}, ("speechbrain",), (None,)),
    "wv_mos": ModelMetric({"wv_mos": "double"}, ("wvmos",), (-1.0,)),
    "qwen3_alignment": ModelMetric({"words": "array<struct<text:string,start:double,end:double>>"}, ("qwen_asr",), (None,), ("audio_file", "text")),
    "senko": ModelMetric({
        "merged": "array<struct<speaker:string,start:double,end:double>>", "raw": "array<struct<speaker:string,start:double,end:double>>",
        "merged_speakers": "int", "timing": "map<string,double>"}, ("senko",), (None, None, None, None)),
    "diarization": ModelMetric({"turns": "array<struct<speaker:string,start:double,end:double>>"}, ("pyannote.audio",), (None,)),
    "speaker_embedding": ModelMetric({"speaker_embedding": "array<double>"}, ("speechbrain", "torch"), (None,)),
    "asr_gigaam": ModelMetric({"transcript": "string"}, ("gigaam",), (None,)),
    "asr_wav2vec2": ModelMetric({"transcript": "string"}, ("transformers", "torch"), (None,)),
    "asr_tone": ModelMetric({"transcript": "string"}, ("tone",), (None,)),
    "asr_qwen3": ModelMetric({"transcript": "string"}, ("qwen_asr",), (None,)),
}


class Backend(Scorer):
    """A model for a metric of the catalogue: load() and score() come from the user."""

    def __init__(self, metric: str, load: Callable[[], Any] | None, score: Callable[[Any, dict], Any], requires: tuple[str, ...] | None = None, recover: Callable[[Any, dict], Any] | None = None):
        m = MODELS[metric]
        self.metric, self._load, self._score, self._recover = metric, load, score, recover
        self.outputs, self.inputs, self.batch_size, self.batch_seconds = m.columns, m.inputs, m.batch_size, m.batch_seconds
        self.requires = m.requires if requires is None else requires

    def cache_key(self) -> tuple:
        return ("backend", self.metric)

    def load(self):
        return self._load() if self._load else None

    def score(self, model, clip):
        return self._score(model, clip)

    def recover(self, model, clip):
        return self._recover(model, clip) if self._recover else super().recover(model, clip)

    def failed(self) -> tuple:
        return MODELS[self.metric].failed


_backends: dict[str, Backend] = {}


def register(backend: Backend) -> Backend:
    _backends[backend.metric] = backend
    return backend


def backend(metric: str) -> Backend:
    """The registered backend of a metric."""
    if metric not in MODELS:
        raise ValueError(f"no such metric: {metric}")
    if metric not in _backends:
        raise ImportError(f"{metric} needs a backend (packages: {', '.join(MODELS[metric].requires)}); register one, or all of them with backends.register_all()")
    return _backends[metric]


def model_metric(clips: DataFrame, metric: str, error: str | None = None) -> DataFrame:
    """clips with the columns of a metric whose backend is registered."""
    return run_scorer(clips, backend(metric), error)


def transcribed(clips: DataFrame, backends: list[str], only_missing: bool = True, overwrite_text: bool = True, min_agreement: float | None = None, prefer_punctuated: bool = True) -> DataFrame:
    """clips with the transcripts of several recognizers and their consensus: see consensus.transcript_columns(). A
    recognizer that can't be loaded counts as failed on every clip and the others go on. With
    only_missing, clips that have a text never reach a recognizer."""
    options = {"overwrite_text": overwrite_text, "min_agreement": min_agreement, "prefer_punctuated": prefer_punctuated, "only_missing": False}

    def heard(rows: DataFrame) -> DataFrame:
        texts = {}
        for name in backends:
            rows = run_scorer(rows, backend(name), f"_{name}_code", optional=True)
            rows = rows.withColumn(f"_{name}", F.when(F.col(f"_{name}_code").isNull(), F.coalesce("transcript", F.lit("")))).drop("transcript", f"_{name}_code")
            texts[name.removeprefix("asr_")] = F.col(f"_{name}")
        return transcript_columns(rows, texts, **options).drop(*[f"_{name}" for name in backends])

    return fill_missing_text(clips, heard) if only_missing else heard(clips)


def aligned(clips: DataFrame, tolerance_ms: int = 80) -> DataFrame:
    """clips with qwen3_alignment and its status, from the aligner's words."""
    found = run_scorer(clips, backend("qwen3_alignment"), "_code")
    frames = F.round(F.col("duration") * F.col("sample_rate")).cast("long")
    return alignment_columns(found, "text", "words", frames, F.col("sample_rate"), tolerance_ms).drop("words", "_code")


def diarized(clips: DataFrame) -> DataFrame:
    """clips with the senko_ columns, from the diarizer's turns."""
    found = run_scorer(clips, backend("senko"), "_code")
    silent = F.col("_code").isNull() & F.col("merged").isNull() & F.col("raw").isNull()
    return diarization_columns(found, "merged", "raw", "merged_speakers", "timing", silent).drop("merged", "raw", "merged_speakers", "timing", "_code")


def punctuated(clips: DataFrame, transcript: str, column: str = "text_punctuated", text: str = "text", min_match: float = 0.6) -> DataFrame:
    """clips with the text's own words and the marks of a transcript; empty where too few words match."""
    moved = transfer_punctuation(min_match)(named(text), named(transcript))
    return clips.withColumn("_moved", moved).withColumn(column, F.coalesce("_moved.text", F.lit(""))).drop("_moved")


def output_type(metric: str) -> T.StructType:
    return T.StructType([T.StructField(k, T._parse_datatype_string(v)) for k, v in MODELS[metric].columns.items()])
