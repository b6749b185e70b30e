"""Jobs: a YAML description becomes a chain of DataFrame steps and one write.

    reader: {type: csv, path: data/set/metadata.csv, audio_key: audio_path}
    steps:
      - {step: speaking_rate}
      - lanes:
          cpu: [{step: signal, wanted: [bandwidth, pitch, style]}]
          gpu: [{step: model, metric: distillmos}]
      - {step: clean, distillmos: 3.0}
    writer: {type: csv, path: outputs/set}

Steps are checked before anything runs: their names and options, that each needs only columns
that are there by then, and that lanes of one fork don't write the same column. Lanes are
branches of one plan over the same rows; Spark runs them together, no join is needed.
"""

from __future__ import annotations

import os
import pathlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, fields
from functools import reduce
from typing import Any

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import metrics, quality, resume, scoring, spans
from ..operators.consensus import consensus_columns
from ..operators.metrics import MODELS, SIGNAL_COLUMNS
from ..operators.speakers import assign_speakers, cluster_speakers
from ..schema import require
from ..sources import clips, sinks
from ..storage import new_folder


@dataclass(frozen=True)
class Step:
    run: Callable[..., DataFrame]
    needs: Callable[[dict], list[str]]
    gives: Callable[[dict], list[str]]
    options: frozenset[str] = frozenset()


def _thresholds(options: dict) -> quality.Thresholds:
    named = {f.name for f in fields(quality.Thresholds)}
    as_tuple = lambda v: tuple(v) if isinstance(v, list) else v
    return quality.Thresholds(**{k: frozenset(v) if k.endswith("_text") else as_tuple(v) for k, v in options.items() if k in named})


LIMITS = frozenset(f.name for f in fields(quality.Thresholds))
CONSENSUS = [f"consensus_{x}" for x in ("medoid", "selected", "text", "eligible", "pairwise", "means", "agreement", "punctuated", "changed", "status")]


def _label_speakers(df: DataFrame, distance: float = 0.5, threshold: float = 0.75, margin: float = 0.10) -> DataFrame:
    labels = cluster_speakers(df, "id", "speaker_embedding", distance, folder=new_folder(df.sparkSession, "clusters"))
    return assign_speakers(df.join(labels, "id"), "id", "speaker_embedding", "label", threshold, margin).drop("label")


STEPS: dict[str, Step] = {
    "speaking_rate": Step(lambda df, **o: metrics.speaking_rate(df, **o), lambda o: ["text", "duration"], lambda o: ["speaking_rate", "phonemes_per_word", "char_rate"]),
    "signal": Step(lambda df, **o: metrics.signal_metrics(df, **o), lambda o: ["content"], lambda o: [c.split()[0] for w in o["wanted"] for c in SIGNAL_COLUMNS[w]], frozenset({"wanted", "options"})),
    "model": Step(lambda df, **o: metrics.model_metric(df, **o), lambda o: list(MODELS[o["metric"]].inputs), lambda o: list(MODELS[o["metric"]].columns), frozenset({"metric", "error"})),
    "word_errors": Step(lambda df, **o: metrics.word_errors(df, **o), lambda o: ["text", o["transcript"]], lambda o: [f"{o.get('prefix', 'whisper')}_{x}" for x in ("wer", "cer")], frozenset({"transcript", "prefix"})),
    "consensus": Step(
        lambda df, candidates, **o: consensus_columns(df, [tuple(x) for x in candidates], **o), lambda o: [c for x in o["candidates"] for c in x[1:]],
        lambda o: CONSENSUS + ["text"] * bool(o.get("overwrite_text")), frozenset({"candidates", "prefer_punctuated", "overwrite_text"}),
    ),
    "speakers": Step(_label_speakers, lambda o: ["id", "speaker_embedding"], lambda o: ["speaker", "speaker_conf", "speaker_margin"], frozenset({"distance", "threshold", "margin"})),
    "candidate": Step(
        lambda df, backend, name, **o: scoring.candidate_columns(df, metrics.backend(backend), name, **o), lambda o: ["audio_file"],
        lambda o: list(({k: f"asr_{o['name']}_{k}" for k in ("id", "status", "text", "error_code")} | o.get("columns", {})).values()), frozenset({"backend", "name", "columns"}),
    ),
    "transcribe": Step(
        lambda df, **o: metrics.transcribed(df, **o), lambda o: ["audio_file", "text"],
        lambda o: [f"asr_text_{b.removeprefix('asr_')}" for b in o["backends"]] + ["asr_chosen_backend", "asr_agreement"] + ["asr_low_confidence"] * (o.get("min_agreement") is not None) + ["text"] * o.get("overwrite_text", True),
        frozenset({"backends", "only_missing", "overwrite_text", "min_agreement", "prefer_punctuated"}),
    ),
    "align": Step(lambda df, **o: metrics.aligned(df, **o), lambda o: ["audio_file", "text", "duration", "sample_rate"], lambda o: ["qwen3_alignment_status", "qwen3_alignment"], frozenset({"tolerance_ms"})),
    "diarize": Step(lambda df: metrics.diarized(df), lambda o: ["audio_file"], lambda o: [f"senko_{x}" for x in ("status", "segments", "raw_segments", "num_speakers", "timing")]),
    "labelled": Step(lambda df, **o: metrics.labelled(df, **o), lambda o: [o["logits"]], lambda o: [o["columns"]] if isinstance(o["columns"], str) else list(o["columns"]), frozenset({"logits", "labels", "output", "columns", "target"})),
    "punctuation": Step(lambda df, **o: metrics.punctuated(df, **o), lambda o: ["text", o["transcript"]], lambda o: [o.get("column", "text_punctuated")], frozenset({"transcript", "column", "min_match"})),
    "sentences": Step(lambda df, **o: spans.clip_sentences(df, **o), lambda o: ["id", "audio_file", "duration", o.get("words", "words")], lambda o: ["sentence", "text", "start_timestamp", "end_timestamp"], frozenset({"words", "folder", "buffer"})),
    "cuts": Step(lambda df: sinks.write_files(sinks.cut_sentences(df)), lambda o: ["audio_file", "content", "start_timestamp", "end_timestamp"], lambda o: []),
    "reasons": Step(lambda df, **o: quality.with_reasons(df, _thresholds(o)), lambda o: [], lambda o: ["reasons"], LIMITS),
    "clean": Step(lambda df, **o: quality.clean(df, _thresholds(o)), lambda o: [], lambda o: [], LIMITS),
}


@dataclass
class Job:
    reader: dict[str, Any]
    writer: dict[str, Any]
    steps: list[dict[str, Any]] = field(default_factory=list)
    name: str = "job"
    checkpoints: str | None = None
    resume: bool = True
    fingerprint: list[str] = field(default_factory=list)  # columns; a clip in which they changed is done anew


def filled(value: Any) -> Any:
    """${NAME} and ${NAME:default} in texts, from the environment."""
    if isinstance(value, dict):
        return {k: filled(v) for k, v in value.items()}
    if isinstance(value, list):
        return [filled(v) for v in value]
    if not isinstance(value, str):
        return value

    def one(m: re.Match) -> str:
        if m[1] in os.environ or m[2] is not None:
            return os.environ.get(m[1], m[2] or "")
        raise KeyError(f"{m[1]} is not set")

    return re.sub(r"\$\{(\w+)(?::([^}]*))?\}", one, value)


def parse_job(text: str, **overrides: Any) -> Job:
    """A job of YAML; overrides name places by dots, as reader.limit."""
    raw = yaml.safe_load(text) or {}
    for place, value in overrides.items():
        at, *rest = place.split(".")
        target = raw
        for x in rest:
            target, at = target.setdefault(at, {}), x
        target[at] = value
    unknown = set(raw) - {f.name for f in fields(Job)}
    if unknown or not {"reader", "writer"} <= set(raw):
        raise ValueError(f"a job has a reader, a writer and steps; unknown: {', '.join(sorted(unknown)) or 'nothing'}")
    job = Job(**filled(raw))
    for s in flat_steps(job.steps):
        _step(s)
    return job


def _step(s: dict) -> tuple[Step, dict]:
    if s.get("step") not in STEPS:
        raise ValueError(f"no such step: {s.get('step')}")
    step, options = STEPS[s["step"]], {k: v for k, v in s.items() if k != "step"}
    if bad := set(options) - step.options:
        raise ValueError(f"{s['step']} has no option {', '.join(sorted(bad))}")
    return step, options


PRESETS = pathlib.Path(__file__).parent / "presets"


def preset(name: str, **overrides: Any) -> Job:
    """One of the jobs that come with the package, by name."""
    return parse_job((PRESETS / f"{name}.yaml").read_text(encoding="utf-8"), **overrides)


def flat_steps(steps: list[dict]) -> Iterator[dict]:
    for s in steps:
        if "lanes" in s:
            for lane in s["lanes"].values():
                yield from flat_steps(lane)
        else:
            yield s


def declared(steps: list[dict]) -> list[str]:
    """The columns that steps add, in order, each once."""
    return list(dict.fromkeys(c for s in flat_steps(steps) for step, o in [_step(s)] for c in step.gives(o)))


def check_steps(steps: list[dict], columns: list[str]) -> None:
    have = set(columns)
    for s in steps:
        if "lanes" in s:
            written: dict[str, str] = {}
            for name, lane in s["lanes"].items():
                check_steps(lane, sorted(have))
                for c in declared(lane):
                    if c in written:
                        raise ValueError(f"lanes {written[c]} and {name} both write {c}")
                    written[c] = name
            have |= set(written)
        else:
            step, o = _step(s)
            if gone := [c for c in step.needs(o) if c not in have]:
                raise ValueError(f"{s['step']} needs columns that nothing before it gives: {', '.join(gone)}")
            have |= set(step.gives(o))


def apply_steps(df: DataFrame, steps: list[dict | Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Steps in order; a plain function of a DataFrame is a step too."""
    for s in steps:
        if callable(s):
            df = s(df)
        elif "lanes" in s:
            for name, lane in s["lanes"].items():
                try:
                    df = apply_steps(df, lane)
                except (ImportError, ValueError) as e:
                    raise type(e)(f"lane {name}: {e}") from e
        else:
            step, options = _step(s)
            df = step.run(df, **options)
    return df


def read(spark: SparkSession, reader: dict) -> DataFrame:
    o = dict(reader)
    kind, path = o.pop("type"), o.pop("path")
    readers = {"csv": clips.read_csv, "jsonl": clips.read_jsonl, "parquet": clips.read_export, "folder": clips.read_folder}
    if kind not in readers:
        raise ValueError(f"no such reader: {kind}")
    with_content, root = o.pop("with_content", False), o.pop("content_root", path)
    df = readers[kind](spark, path, **o)
    return clips.with_audio_information(clips.read_bytes(spark, df, root)) if with_content else df


def write(df: DataFrame, writer: dict, columns: list[str]) -> None:
    o = dict(writer)
    kind, path = o.pop("type"), o.pop("path")
    df = df.drop("content") if "content" in df.columns else df
    if kind == "csv":
        sinks.write_csv(df, path, columns, **o)
    elif kind == "jsonl":
        sinks.write_jsonl(df, path, **o)
    elif kind == "parquet":
        df.write.mode(o.pop("mode", "overwrite")).options(**o).parquet(path)
    else:
        raise ValueError(f"no such writer: {kind}")


def build(spark: SparkSession, job: Job) -> DataFrame:
    """The job's plan, without what earlier runs have kept."""
    df = read(spark, job.reader)
    check_steps(job.steps, df.columns)
    return apply_steps(df, job.steps)


def run_job(spark: SparkSession, job: Job) -> None:
    """Run the steps and write. With checkpoints, results are kept by id: a clip that an earlier run has done with
    the same steps, and whose fingerprint (a hash of the columns that the job names) is unchanged, skips
    the steps. Clips of which a status says error are kept for this run's output alone and tried again by
    the next one; other failure values stand. A run counts when all of it is written. Clips that
    share an id share results."""
    if not job.checkpoints:
        return write(build(spark, job), job.writer, declared(job.steps))
    if any(s["step"] == "sentences" for s in flat_steps(job.steps)):
        raise ValueError("results are kept by clip, so a step that makes several rows of one takes no checkpoints")
    df = read(spark, job.reader)
    check_steps(job.steps, df.columns)
    require(df, ["id", *job.fingerprint], "a job with checkpoints")
    columns = declared(job.steps)
    path = resume.checkpoint_path(job.checkpoints, "job", job.name, {"steps": job.steps, "fingerprint": job.fingerprint})
    mark = resume.FINGERPRINT if job.fingerprint else None
    if mark:
        df = df.withColumn(mark, F.sha2(F.to_json(F.struct(*[F.coalesce(F.col(x).cast("string"), F.lit("\0")).alias(x) for x in job.fingerprint])), 256))
    runs = resume.kept_runs(spark, path)
    old = resume.kept_results(spark, path, runs) if runs and job.resume else None
    new = df if old is None else resume.todo(df, old, "id", mark)
    done = apply_steps(new, job.steps)
    failed = [F.col(x) == "error" for x in columns if x.endswith("_status") and x in done.columns]
    kept = done.withColumn(resume.RESUMABLE, ~reduce(lambda a, b: a | b, [F.coalesce(x, F.lit(False)) for x in failed], F.lit(False)))
    run = f"{path}/run={int(runs[-1][4:]) + 1 if runs else 0:08d}"
    kept.select("id", *[mark] * bool(mark), resume.RESUMABLE, *columns).write.mode("overwrite").parquet(run)
    fresh = spark.read.parquet(run).drop(resume.RESUMABLE)
    out = resume.restore(new, fresh.dropDuplicates(["id"]), columns, "id", mark)
    if old is not None:
        out = resume.restore(df, old, columns, "id", mark).unionByName(out)
    write(out.drop(mark) if mark else out, job.writer, columns)


def sweep(spark: SparkSession, root: str, make: Callable[[str, str], Job], done: Callable[[str], str], only: set[str] | None = None) -> dict[str, str]:
    """Run a job for each data set under root, the smallest first; make(dataset, path) gives the job and
    done(dataset) its output, whose mark means that it is finished. A failing one doesn't stop the
    others. Returns what became of each."""
    out = {}
    for row in clips.datasets(spark, root).collect():  # a row a data set
        if only and row["dataset"] not in only:
            continue
        if sinks.is_done(spark, done(row["dataset"])):
            out[row["dataset"]] = "skipped"
            continue
        try:
            run_job(spark, make(row["dataset"], row["path"]))
            out[row["dataset"]] = "done"
        except Exception as e:  # noqa: BLE001
            out[row["dataset"]] = f"failed: {type(e).__name__}: {e}"[:300]
    return out


@dataclass(frozen=True)
class Profile:
    """What is known of a data set, for job_for()."""

    has_text: bool = True
    has_speaker: bool = True
    human_text: bool = False
    gender: bool = False
    emotion: bool = False


def job_for(dataset: str, path: str, output: str, profile: Profile = Profile()) -> str:
    """A job's YAML for a data set: signal measures beside models, transcripts where there is no
    text, word errors where it is human, speakers where there are none."""
    model = lambda m: {"step": "model", "metric": m}
    cpu = [{"step": "signal", "wanted": ["bandwidth", "pitch", "style", "wada_snr"]}, {"step": "speaking_rate"}]
    gpu = [model("distillmos"), model("squim")]
    gpu += [model("whisper"), {"step": "word_errors", "transcript": "transcript"}] if profile.human_text else []
    gpu += [model("gender")] * profile.gender + [model("emotion")] * profile.emotion
    steps: list[dict] = [] if profile.has_text else [{"step": "consensus", "overwrite_text": True, "candidates": [[x, f"asr_{x}_status", f"asr_{x}_text"] for x in ("gigaam", "whisper")]}]
    steps.append({"lanes": {"cpu": cpu, "gpu": gpu}})
    steps += [] if profile.has_speaker else [model("speaker_embedding"), {"step": "speakers"}]
    spec = {"name": dataset, "reader": {"type": "csv", "path": path, "audio_key": "audio_path", "with_content": True}, "steps": steps, "writer": {"type": "csv", "path": output}}
    return yaml.safe_dump(spec, sort_keys=False, allow_unicode=True)


def revision(name: str) -> str:
    """A model revision as it must be given: 40 hexadecimal digits."""
    if not re.fullmatch(r"[0-9a-f]{40}", name or ""):
        raise ValueError("a revision is 40 hexadecimal digits")
    return name


def row_shard(df: DataFrame, index: str, rank: int, shards: int) -> DataFrame:
    """The rows of one of several equal slices by row number, for runs outside one cluster."""
    return df.where(F.pmod(F.col(index), F.lit(shards)) == rank)
