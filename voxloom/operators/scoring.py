"""Scorers: models and signal code behind one guarded, batched interface.

A Scorer computes values for clips. run_scorer() feeds it Arrow batches in length-bounded
groups. A failing group is halved, down to single clips; a clip that fails for lack of memory is
tried by recover() and then by the CPU; one that fails for good gets its failure values and an
error code, and the job goes on. A long unbroken row of failures means the scorer itself is
broken and stops the job.
"""

from __future__ import annotations

import importlib.util
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.text import is_blank

NAN = float("nan")
#: Parts of messages that mean memory ran out.
MEMORY_SIGNS = ("out of memory", "cublas_status_alloc_failed", "cudnn_status_alloc_failed", "failed to allocate")


class Scorer:
    """Subclass it: name the inputs and outputs, load the model, and score."""

    inputs: tuple[str, ...] | None = ("audio_file",)  # None: all columns
    outputs: dict[str, str] = {}  # column: Spark type
    requires: tuple[str, ...] = ()
    batch_size: int = 16
    batch_seconds: float = 480.0
    most_failures: int = 50

    def load(self) -> Any:
        """The model; it is kept for the life of the worker process, by cache_key."""
        return None

    def cache_key(self) -> tuple:
        return (type(self).__qualname__, *sorted((k, repr(v)) for k, v in vars(self).items()))

    def settings(self) -> dict:
        return {"scorer": type(self).__qualname__} | vars(self)

    def score(self, model: Any, clip: dict) -> Any:
        raise NotImplementedError

    def score_batch(self, model: Any, clips: list[dict]) -> list[Any]:
        return [self.score(model, x) for x in clips]

    def recover(self, model: Any, clip: dict) -> Any:
        """A second try, in less memory."""
        raise MemoryError("out of memory")

    def score_on_cpu(self, model: Any, clip: dict) -> Any:
        raise MemoryError("out of memory")

    def failed(self) -> tuple:
        """NaN for numbers, null for all else."""
        return tuple(NAN if t in ("double", "float") else None for t in self.outputs.values())


_models: dict[tuple, Any] = {}


def cached_model(scorer: Scorer) -> Any:
    key = scorer.cache_key()
    if key not in _models:
        _models[key] = scorer.load()
    return _models[key]


def missing_packages(scorer: Scorer) -> list[str]:
    """Packages that any class of the scorer's line requires and that aren't installed."""
    wanted = dict.fromkeys(p for k in type(scorer).__mro__ for p in getattr(k, "requires", ()))
    return [p for p in wanted if importlib.util.find_spec(p) is None]


def out_of_memory(error: BaseException) -> bool:
    return isinstance(error, MemoryError) or any(s in str(error).lower() for s in MEMORY_SIGNS)


def error_code(error: BaseException) -> str:
    if out_of_memory(error):
        return "out_of_memory"
    if isinstance(error, ImportError):
        return "dependency_error"
    return "invalid_result" if isinstance(error, TypeError | ValueError) else "inference_error"


def length_batches(durations: list[float], most_seconds: float, most: int) -> list[list[int]]:
    """Places of clips in groups of similar length: shortest first, a group closes when one more
    clip would make its padded length (clips times the longest) exceed most_seconds, or at
    `most` clips. A clip longer than that is alone."""
    out: list[list[int]] = []
    longest = 0.0
    for i in sorted(range(len(durations)), key=lambda k: durations[k]):
        seconds = max(0.0, durations[i])
        if out and len(out[-1]) < most and (len(out[-1]) + 1) * max(longest, seconds) <= most_seconds:
            out[-1].append(i)
            longest = max(longest, seconds)
        else:
            out.append([i])
            longest = seconds
    return out


class _Guard:
    def __init__(self, scorer: Scorer, types: list[pa.DataType], endless: bool = False):
        self.scorer, self.types, self.streak, self.endless = scorer, types, 0, endless

    def values(self, got: Any) -> tuple:
        names = self.scorer.outputs
        got = got if isinstance(got, tuple | list) and len(names) > 1 else (got,)
        if len(got) != len(names):
            raise ValueError(f"{len(got)} values for {len(names)} columns")
        return self.typed(got)  # a value that doesn't fit its column fails its clip, not the job

    def typed(self, values: tuple | list) -> tuple:
        return tuple(pa.scalar(v, t) for v, t in zip(values, self.types))

    def one(self, model: Any, clip: dict) -> tuple[tuple, str | None]:
        s = self.scorer
        try:
            out = self.values(s.score_batch(model, [clip])[0]), None
        except Exception as first:  # noqa: BLE001
            out = self.ladder(model, clip, first)
        self.streak = self.streak + 1 if out[1] else 0
        if self.streak >= s.most_failures and not self.endless:
            raise RuntimeError(f"{type(s).__name__}: {self.streak} clips failed in an unbroken row, the last with {out[1]}")
        return out

    def ladder(self, model: Any, clip: dict, error: Exception) -> tuple[tuple, str | None]:
        for again in (self.scorer.recover, self.scorer.score_on_cpu):
            if not out_of_memory(error):
                break
            try:
                return self.values(again(model, clip)), None
            except Exception as e:  # noqa: BLE001
                error = e
        return self.typed(self.scorer.failed()), error_code(error)

    def many(self, model: Any, clips: list[dict]) -> list[tuple[tuple, str | None]]:
        if len(clips) == 1:
            return [self.one(model, clips[0])]
        try:
            got = self.scorer.score_batch(model, clips)
            if len(got) != len(clips):
                raise ValueError(f"{len(got)} results for {len(clips)} clips")
            out = [(self.values(x), None) for x in got]
            self.streak = 0
            return out
        except Exception:  # noqa: BLE001
            half = len(clips) // 2
            return self.many(model, clips[:half]) + self.many(model, clips[half:])


#: Columns that every scorer gets where the table has them.
ALWAYS = ("id", "duration", "sample_rate", "text")


def run_scorer(df: DataFrame, scorer: Scorer, error: str | None = None, optional: bool = False) -> DataFrame:
    """df with the scorer's columns, and with `error` a column of error codes. Packages are checked
    here, before the plan is built. Only the scorer's inputs become Python values; the other columns
    pass through as they are, NaN and all. An optional scorer doesn't stop the job: where its packages are
    missing, or missing in a worker, every clip fails with dependency_error, and no row of failures is too long."""
    gone = missing_packages(scorer)
    if gone and not optional:
        raise ImportError(f"{type(scorer).__name__} needs packages that aren't installed: pip install {' '.join(gone)}")
    names = list(scorer.outputs)
    inputs = [x for x in df.columns if scorer.inputs is None or x in scorer.inputs or x in ALWAYS]
    own = [x for x in df.columns if x not in names and x != error]
    added = T.StructType([*(T.StructField(k, T._parse_datatype_string(v)) for k, v in scorer.outputs.items()), *([T.StructField(error, T.StringType())] if error else [])])
    schema = T.StructType([*(df.schema[x] for x in own), *added])
    types = list(to_arrow_schema(added).types)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        guard = _Guard(scorer, types[: len(names)], endless=optional)
        try:
            model, absent = None if gone else cached_model(scorer), bool(gone)
        except ImportError:
            if not optional:
                raise
            absent = True
        for batch in batches:
            if absent:
                failed = [pa.array([v.as_py()] * batch.num_rows, t) for v, t in zip(guard.typed(scorer.failed()), types)]
                yield pa.RecordBatch.from_arrays([*map(batch.column, own), *failed, *([pa.array(["dependency_error"] * batch.num_rows)] if error else [])], schema.fieldNames())
                continue
            clips = batch.select(inputs).to_pylist()
            seconds = [float(x.get("duration") or 0.0) for x in clips]
            got: list[tuple[tuple, str | None]] = [((), None)] * len(clips)
            for group in length_batches(seconds, scorer.batch_seconds, scorer.batch_size):
                for i, r in zip(group, guard.many(model, [clips[k] for k in group])):
                    got[i] = r
            new = [pa.array([r[0][j].as_py() for r in got], types[j]) for j in range(len(names))]
            if error:
                new.append(pa.array([r[1] for r in got], types[-1]))
            yield pa.RecordBatch.from_arrays([*map(batch.column, own), *new], schema.fieldNames())

    return df.mapInArrow(run, schema)


def failure_share(df: DataFrame, failed: Column, most: float) -> DataFrame:
    """Stops the job, on the driver, where more than the share `most` of the rows failed."""
    share = df.agg(F.coalesce(F.avg(failed.cast("double")), F.lit(0.0))).first()[0]
    if share > most:
        raise RuntimeError(f"{share:.0%} of the rows failed")
    return df


class FunctionScorer(Scorer):
    """A scorer from a plain function of a clip, which gets all columns unless `inputs` names some."""

    inputs = None

    def __init__(self, function: Callable[[dict], Any], outputs: dict[str, str], **options):
        self.function, self.outputs = function, outputs
        for k, v in options.items():
            setattr(self, k, v)

    def score(self, model, clip):
        return self.function(clip)


class Recognizer(Scorer):
    """A speech recognizer: transcribe(model, path) gives a text."""

    outputs = {"transcript": "string"}

    def transcribe(self, model: Any, path: str) -> str:
        raise NotImplementedError

    def score(self, model, clip):
        text = self.transcribe(model, clip["audio_file"])
        if not isinstance(text, str):
            raise TypeError(f"a transcript must be a string, not {type(text).__name__}")
        return text


def candidate_columns(df: DataFrame, recognizer: Scorer, name: str, columns: dict[str, str] | None = None) -> DataFrame:
    """df with asr_<name>_id, _status (ok, no_speech or error), _text and _error_code, or as `columns` names them
    (by id, status, text, error_code). The text is empty unless the status is ok; of an error only the code is kept."""
    found = run_scorer(df, recognizer, "_code")
    named_as = {k: f"asr_{name}_{k}" for k in ("id", "status", "text", "error_code")} | (columns or {})
    status = F.when(F.col("_code").isNotNull(), "error").when(is_blank(F.col("transcript")), "no_speech").otherwise("ok")
    found = found.withColumn("_status", status)
    ok = F.col("_status") == "ok"
    values = {"id": F.lit(name), "status": F.col("_status"), "text": F.when(ok, F.col("transcript")).otherwise(""), "error_code": F.coalesce("_code", F.lit(""))}
    return found.withColumns({named_as[k]: v for k, v in values.items()}).drop("transcript", "_code", "_status")


def resumable(status: Column) -> Column:
    """Errors are tried again, so they aren't kept."""
    return status != "error"


def batches_of(df: DataFrame, key: str, duration: str, most_seconds: float, most: int, by: str) -> DataFrame:
    """key, by and batch: the number of the group that length_batches would make of the rows with one value
    of `by`, ties by the key. Rows come sorted by length, so a task holds no more than a batch of them, and
    neither partitions nor batches of transport change what comes out. Lengths that are null count as 0."""
    rows = df.select(df[key].alias(key), df[by].alias(by), F.greatest(F.coalesce(F.nanvl(F.col(duration).cast("double"), F.lit(0.0)), F.lit(0.0)), F.lit(0.0)).alias("_s"))
    schema = T.StructType([rows.schema[key], rows.schema[by], T.StructField("batch", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, nth, size = None, 0, 0
        for batch in batches:
            of = []
            for g, s in zip(batch.column(by).to_pylist(), batch.column("_s").to_pylist()):
                if (g,) != group:
                    group, nth, size = (g,), 0, 1
                elif size < most and (size + 1) * s <= most_seconds:
                    size += 1
                else:
                    nth, size = nth + 1, 1
                of.append(nth)
            yield pa.RecordBatch.from_arrays([batch.column(key), batch.column(by), pa.array(of, pa.int32())], schema.fieldNames())

    return rows.repartition(by).sortWithinPartitions(by, "_s", key).mapInArrow(run, schema)
