"""Models of the catalogue, behind the scorer interface.

Each class names the package that it loads when a worker first needs it, turns a clip into what the model
takes, and the model's answer into the metric's columns. Audio comes from the clip's `content` where the
table has the bytes, else from the file at `audio_file`. register_all() makes the catalogue's metrics
usable; a job that names one whose packages are missing is refused before it runs.
"""

from __future__ import annotations

import importlib
import json
import re
from typing import Any

import numpy as np

from ..functions import signal
from ..functions.text import PUNCTUATION, moved_punctuation, word_edits
from .metrics import MODELS, NAN, Backend, register
from .scoring import Scorer

#: What the models take and stand.
SQUIM_LEAST_SAMPLES, GIGAAM_MOST_SECONDS, WINDOW_SECONDS = 1024, 24.9, 20.0
#: Tried in this order where a device lacks one.
COMPUTE_TYPES = ("int8_float16", "int8_float32", "float32")


def device_of(name: str = "auto") -> str:
    """cuda where torch sees it, else cpu; any other name stands."""
    if name != "auto":
        return name
    try:
        return "cuda" if importlib.import_module("torch").cuda.is_available() else "cpu"
    except ImportError:
        return "cpu"


def audio_bytes(clip: dict) -> bytes:
    if clip.get("content") is not None:
        return bytes(clip["content"])
    with open(clip["audio_file"], "rb") as f:
        return f.read()


def samples_of(clip: dict, rate: int) -> np.ndarray:
    return signal.load(audio_bytes(clip), rate)[0]


def windows_of(samples: np.ndarray, rate: int, seconds: float = WINDOW_SECONDS) -> list[np.ndarray]:
    step = max(1, int(rate * seconds))
    return [samples[a : a + step] for a in range(0, len(samples), step)]


def plain_text(result: Any) -> str:
    """The text of a recognizer's answer, which may be a text, an object or a dict that has it."""
    text = result if isinstance(result, str) else result.get("text") if isinstance(result, dict) else getattr(result, "text", None)
    if not isinstance(text, str):
        raise TypeError(f"no text in a {type(result).__name__}")
    return text


class Adapter(Backend):
    """A metric's model. Subclasses load() it for a device and give values() of samples; `inputs` adds the bytes
    of the audio where the table has them. If memory runs out, windows are scored one by one and
    their values averaged, on the device and then on the CPU."""

    metric = ""
    rate = 16_000

    def __init__(self, device: str = "auto", **options: Any):
        super().__init__(self.metric, None, lambda model, clip: None)
        self.inputs = (*MODELS[self.metric].inputs, "content")
        self.device, self.options = device, options

    def cache_key(self) -> tuple:
        return (type(self).__qualname__, self.device, *sorted((k, repr(v)) for k, v in self.options.items()))

    def load_on(self, device: str) -> Any:
        raise NotImplementedError

    def load(self) -> Any:
        return self.load_on(device_of(self.device))

    def values(self, model: Any, samples: np.ndarray, clip: dict) -> tuple:
        raise NotImplementedError

    def score(self, model: Any, clip: dict) -> tuple:
        return self.values(model, samples_of(clip, self.rate), clip)

    def recover(self, model: Any, clip: dict) -> tuple:
        parts = [self.values(model, w, clip) for w in windows_of(samples_of(clip, self.rate), self.rate)]
        return tuple(np.mean([p[k] for p in parts], axis=0).tolist() for k in range(len(self.outputs))) if parts else self.failed()

    def score_on_cpu(self, model: Any, clip: dict) -> tuple:
        return self.recover(self.load_on("cpu"), clip)


class DistillMos(Adapter):
    metric = "distillmos"

    def load_on(self, device):
        return importlib.import_module("distillmos").ConvTransformerSQAModel().to(device).eval(), device

    def values(self, model, samples, clip):
        torch = importlib.import_module("torch")
        with torch.no_grad():
            return (float(model[0](torch.from_numpy(samples)[None].to(model[1])).squeeze()),)


class Squim(Adapter):
    metric = "squim"

    def load_on(self, device):
        return importlib.import_module("torchaudio.pipelines").SQUIM_OBJECTIVE.get_model().to(device), device

    def values(self, model, samples, clip):
        """Clips too short for the model's kernels can't be scored, which is no error."""
        if len(samples) < SQUIM_LEAST_SAMPLES:
            return self.failed()
        torch = importlib.import_module("torch")
        with torch.no_grad():
            return tuple(float(x) for x in model[0](torch.from_numpy(samples)[None].to(model[1])))


class SnrReverb(Adapter):
    """Means of the SNR and clarity of frames."""

    metric = "snr_reverb"

    def load_on(self, device):
        audio = importlib.import_module("pyannote.audio")
        return audio.Inference(audio.Model.from_pretrained(self.options.get("model", "pyannote/brouhaha"), token=self.options.get("token")), device=device)

    def values(self, model, samples, clip):
        torch = importlib.import_module("torch")
        frames = np.asarray([f[-2:] for _, f in model({"waveform": torch.from_numpy(samples)[None], "sample_rate": self.rate})], dtype=float)
        return tuple(frames.mean(axis=0).tolist()) if len(frames) else (NAN, NAN)


class CrepePitch(Adapter):
    metric = "crepe_pitch"

    def load_on(self, device):
        return importlib.import_module("torchcrepe"), device

    def values(self, model, samples, clip):
        torch = importlib.import_module("torch")
        found = np.asarray(model[0].predict(torch.from_numpy(samples)[None], self.rate, device=model[1], model=self.options.get("model", "full"), batch_size=self.options.get("batch", 1024)), dtype=float).ravel()
        return (float(found.mean()), float(found.std())) if len(found) else (NAN, NAN)


class Logits(Adapter):
    """An audio classifier: the logits, which metrics.labelled() turns into labels and scores. In windows, the
    mean of the windows' logits."""

    metric = "audio_model"

    def load_on(self, device):
        t = importlib.import_module("transformers")
        name = self.options["model"]
        return t.AutoFeatureExtractor.from_pretrained(name), t.AutoModelForAudioClassification.from_pretrained(name).to(device).eval(), device

    def values(self, model, samples, clip):
        torch = importlib.import_module("torch")
        extract, net, device = model
        with torch.no_grad():
            given = {k: v.to(device) for k, v in extract(samples, sampling_rate=self.rate, return_tensors="pt").items()}
            return (np.asarray(net(**given).logits[0].cpu(), dtype=float).tolist(),)


class Labels(Logits):
    """The best label, and with two columns its score too, of a classifier with its own labels."""

    def values(self, model, samples, clip):
        logits = np.asarray(super().values(model, samples, clip)[0])
        e = np.exp(logits - logits.max())
        best = int(logits.argmax())
        return (model[1].config.id2label[best], float(e[best] / e.sum()))[: len(self.outputs)]

    def recover(self, model, clip):
        logits = np.mean([Logits.values(self, model, w, clip)[0] for w in windows_of(samples_of(clip, self.rate), self.rate)], axis=0)
        e = np.exp(logits - logits.max())
        best = int(logits.argmax())
        return (model[1].config.id2label[best], float(e[best] / e.sum()))[: len(self.outputs)]


class Gender(Labels):
    metric = "gender"


class Emotion(Labels):
    metric = "emotion"


class SpeakerEmbedding(Adapter):
    metric = "speaker_embedding"

    def load_on(self, device):
        return importlib.import_module("speechbrain.inference.speaker").EncoderClassifier.from_hparams(source=self.options.get("model", "speechbrain/spkrec-ecapa-voxceleb"), run_opts={"device": device})

    def values(self, model, samples, clip):
        torch = importlib.import_module("torch")
        return (np.asarray(model.encode_batch(torch.from_numpy(samples)[None]).cpu(), dtype=float).ravel().tolist(),)


class Accent(Adapter):
    metric = "accent"

    def load_on(self, device):
        return importlib.import_module("speechbrain.inference.classifiers").EncoderClassifier.from_hparams(source=self.options["model"], run_opts={"device": device})

    def values(self, model, samples, clip):
        torch = importlib.import_module("torch")
        return (str(model.classify_batch(torch.from_numpy(samples)[None])[-1][0]),)

    recover = Scorer.recover


class Recognition(Adapter):
    """A recognizer; a clip's windows are transcribed one by one only where a subclass says so."""

    recover = Scorer.recover
    score_on_cpu = Scorer.score_on_cpu


class Whisper(Recognition):
    metric = "whisper"

    def load_on(self, device):
        make = importlib.import_module("faster_whisper").WhisperModel
        wanted = self.options.get("compute_type", COMPUTE_TYPES[0] if device != "cpu" else COMPUTE_TYPES[1])
        for kind in dict.fromkeys((wanted, *COMPUTE_TYPES)):
            try:
                return make(self.options.get("model", "large-v3"), device=device, compute_type=kind)
            except ValueError as e:  # the device has no such arithmetic
                error = e
        raise error

    def values(self, model, samples, clip):
        segments, _ = model.transcribe(samples, language=self.options.get("language"))
        return (" ".join(t for t in (plain_text(s).strip() for s in segments) if t),)


class WhisperWords(Whisper):
    """Words with times, for sentences()."""

    metric = "whisper_words"

    def score(self, model, clip):
        segments, _ = model.transcribe(samples_of(clip, self.rate), language=self.options.get("language"), word_timestamps=True)
        return [{"word": w.word, "start": float(w.start), "end": float(w.end)} for s in segments for w in s.words or []]


class GigaAm(Recognition):
    """Text and character error rate; the first GIGAAM_MOST_SECONDS of a longer clip. Batches share a forward pass."""

    metric = "gigaam3"

    def load_on(self, device):
        return importlib.import_module("gigaam").load_model(self.options.get("model", "v3_e2e_rnnt"), device=device), device

    def decoded(self, model: Any, batch: list[np.ndarray], words: bool = False) -> list[tuple[str, list]]:
        torch = importlib.import_module("torch")
        sizes = torch.tensor([len(x) for x in batch])
        padded = torch.zeros(len(batch), max(map(len, batch)))
        for row, x in zip(padded, batch):
            row[: len(x)] = torch.from_numpy(x)
        with torch.inference_mode():
            encoded, lengths = model[0].forward(padded.to(model[1]), sizes.to(model[1]))
            return [(plain_text(t), w or []) for t, w in model[0]._decode(encoded, lengths, wav_lens=sizes, word_timestamps=words)]

    def cut(self, clip: dict) -> np.ndarray:
        return samples_of(clip, self.rate)[: int(GIGAAM_MOST_SECONDS * self.rate)]

    def score_batch(self, model, clips):
        return [self.row(c, text, words) for c, (text, words) in zip(clips, self.decoded(model, [self.cut(c) for c in clips], bool(self.options.get("words"))))]

    def row(self, clip: dict, text: str, words: list) -> tuple:
        return text, character_errors(clip.get("text") or "", text)

    def score_on_cpu(self, model, clip):
        return self.score_batch(self.load_on("cpu"), [clip])[0]


def word_json(words: list) -> str:
    """Words and their times to the millisecond, as JSON."""
    return json.dumps([{"text": w.text, "start": round(w.start, 3), "end": round(w.end, 3)} for w in words], ensure_ascii=False)


def character_errors(reference: str, hypothesis: str) -> float:
    """Edit distance over the length of normalized texts, -1 without a reference: one pair, within a worker."""
    def norm(text: str) -> str:
        bare = re.sub(r"\([^\n]*?\)|<[^\n]*?>", " ", text.lower())
        return " ".join(re.sub(PUNCTUATION, " ", bare).split())

    ref, hyp = norm(reference), norm(hypothesis)
    return word_edits(list(ref), list(hyp)) / len(ref) if ref else -1.0


class Punctuated(GigaAm):
    """The clip's own words with the marks that the recognizer heard."""

    metric = "punctuation"

    def __init__(self, device: str = "auto", min_match: float = 0.6, **options: Any):
        super().__init__(device, **options)
        self.inputs, self.min_match = ("audio_file", "text", "content"), min_match
        self.requires = ("gigaam", "torch")

    def row(self, clip, text, words):
        return (moved_punctuation(clip.get("text"), text, self.min_match)[0] or "",)


class AsrGigaAm(Recognition):
    metric = "asr_gigaam"

    def load_on(self, device):
        return importlib.import_module("gigaam").load_model(self.options.get("model", "v2_rnnt"), device=device)

    def score(self, model, clip):
        return plain_text(model.transcribe(clip["audio_file"]))


class AsrWav2Vec2(Recognition):
    metric = "asr_wav2vec2"

    def load_on(self, device):
        return importlib.import_module("transformers").pipeline("automatic-speech-recognition", model=self.options["model"], device=device)

    def score(self, model, clip):
        return plain_text(model({"raw": samples_of(clip, self.rate), "sampling_rate": self.rate}))


class AsrTone(Recognition):
    metric, rate = "asr_tone", 8_000

    def load_on(self, device):
        return importlib.import_module("tone").StreamingCTCPipeline.from_hugging_face()

    def score(self, model, clip):
        x = np.clip(samples_of(clip, self.rate) * 32767, -32768, 32767).astype(np.int32)
        return " ".join(t for t in (plain_text(p).strip() for p in model.forward_offline(x)) if t)


class AsrQwen3(Recognition):
    metric = "asr_qwen3"

    def load_on(self, device):
        return importlib.import_module("qwen_asr").Qwen3ASRModel.from_pretrained(self.options.get("model", "Qwen/Qwen3-ASR-1.7B"), device_map=device, max_new_tokens=self.options.get("max_new_tokens", 256))

    def score(self, model, clip):
        (found,) = model.transcribe([(signal.prepared(audio_bytes(clip)), self.rate)], language=self.options.get("language"))
        return plain_text(found)


class Aligner(Recognition):
    """The text's words with their times, as the model gives them; alignment_columns() judges them."""

    metric = "qwen3_alignment"

    def load_on(self, device):
        return importlib.import_module("qwen_asr").Qwen3ForcedAligner.from_pretrained(self.options.get("model", "Qwen/Qwen3-ForcedAligner-0.6B"), device_map=device)

    def score(self, model, clip):
        if not (clip.get("text") or "").strip():
            return None
        (found,) = model.align([(signal.prepared(audio_bytes(clip)), self.rate)], [clip["text"]], [self.options.get("language", "Russian")])
        return [{"text": w.text, "start": float(w.start_time), "end": float(w.end_time)} for w in found]


class Diarizer(Recognition):
    """Turns as the model gives them; diarization_columns() judges them. No speech gives nulls."""

    metric = "senko"

    def load_on(self, device):
        return importlib.import_module("senko").Diarizer(device=device, vad=self.options.get("vad", "silero"), clustering=self.options.get("clustering", "cpu"), warmup=False)

    def score(self, model, clip):
        found = model.diarize(clip["audio_file"])
        if not found:
            return None, None, None, None
        turns = lambda key: [{"speaker": str(t["speaker"]), "start": float(t["start"]), "end": float(t["end"])} for t in found[key]]
        return turns("merged_segments"), turns("raw_segments"), int(found["merged_speakers_detected"]), {k: float(v) for k, v in found["timing_stats"].items()}


class PhonemeCount(Adapter):
    metric = "phonemes"

    def load_on(self, device):
        return importlib.import_module("phonemizer.backend").EspeakBackend(self.options.get("language", "ru"))

    def score(self, model, clip):
        text = (clip.get("text") or "").strip()
        return sum(not ch.isspace() for ch in model.phonemize([text], strip=True)[0]) if text else 0


ADAPTERS = (DistillMos, Squim, SnrReverb, CrepePitch, Logits, Gender, Emotion, SpeakerEmbedding, Accent, Whisper, WhisperWords, GigaAm, Punctuated, AsrGigaAm, AsrWav2Vec2, AsrTone, AsrQwen3, Aligner, Diarizer, PhonemeCount)


def register_all(device: str = "auto", options: dict[str, dict[str, Any]] | None = None) -> dict[str, Adapter]:
    """Registers every adapter; options by metric."""
    return {a.metric: register(a(device, **(options or {}).get(a.metric, {}))) for a in ADAPTERS}
