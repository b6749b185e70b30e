"""Writing clip tables, merged and clean tables, run records, sentence cuts and the report."""

from __future__ import annotations

import json
from collections.abc import Callable
from string import Template

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.signal import encode_wav, load
from ..schema import named, ordered
from .clips import CSV_DIALECT

CSV_OUT = {k: v for k, v in CSV_DIALECT.items() if k != "multiLine"} | {"emptyValue": "", "nullValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
#: For write_csv: empty texts are quoted, so that a reader can tell them from nulls (see clips.EMPTY_KEPT).
EMPTY_QUOTED = {"emptyValue": '""'}


def flat(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs as compact JSON text, the rest as it is; a metadata struct's fields
    become columns."""
    if "metadata" in df.columns and isinstance(df.schema["metadata"].dataType, T.StructType):
        df = df.select(*[named(x) for x in df.columns if x != "metadata"], "metadata.*")
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(*[F.to_json(named(f.name)).alias(f.name) if isinstance(f.dataType, nested) else named(f.name) for f in df.schema])


def relative(df: DataFrame) -> DataFrame:
    """audio_file as it was read, where `path` has that."""
    return df.withColumn("audio_file", F.coalesce("path", "audio_file")).drop("path") if "path" in df.columns else df


def write_csv(df: DataFrame, folder: str, declared: list[str] | None = None, adapter: Callable[[DataFrame], DataFrame] | None = None, compression: str | None = None, by: str | None = None, rows_a_file: int | None = None, mode: str = "overwrite", options: dict | None = None) -> None:
    """One header a file, columns fixed: the clip's, the others, and declared ones that are absent, empty.
    `by` deals files into folders by a column's value; rows_a_file starts a new file every so many rows."""
    out = flat(ordered(relative(df), declared)) if adapter is None else adapter(df)
    w = out.write.mode(mode).options(**CSV_OUT | (options or {}))
    w = w.option("compression", compression) if compression else w
    w = w.option("maxRecordsPerFile", rows_a_file) if rows_a_file else w
    (w.partitionBy(by) if by else w).csv(folder)


def write_jsonl(df: DataFrame, folder: str, compression: str = "gzip", by: str | None = None, mode: str = "overwrite") -> None:
    """One JSON object a line, other alphabets as they are. Nulls are left out; zeros, empty texts and
    false stay."""
    w = ordered(relative(df)).write.mode(mode).option("compression", compression)
    (w.partitionBy(by) if by else w).json(folder)


def file_name(template: str, rank: int | str, **values: str) -> str:
    """A file name from a template of $rank (five digits) and other names."""
    return Template(template).safe_substitute(rank=str(rank).zfill(5), **values)


def file_name_column(template: str, df: DataFrame) -> Column:
    """The same from the columns of df."""
    out = F.lit(template)
    for x in sorted(df.columns, key=len, reverse=True):
        out = F.replace(out, F.lit(f"${x}"), F.coalesce(named(x).cast("string"), F.lit("")))
    return out


def write_single_csv(df: DataFrame, folder: str) -> None:
    """A table in one file, for people: a merged or clean table of one data set."""
    df.coalesce(1).write.mode("overwrite").options(**CSV_OUT).csv(folder)


def write_record(spark: SparkSession, folder: str, record: dict) -> None:
    """A JSON line that describes a run, written by Spark so that any store will do."""
    spark.createDataFrame([(json.dumps(record, ensure_ascii=False, default=str),)], "value string").coalesce(1).write.mode("overwrite").text(folder)


def is_done(spark: SparkSession, folder: str) -> bool:
    """Whether a folder has the mark that Spark leaves when all of it is written."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/_SUCCESS")
    return bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path))


def unfinished(spark: SparkSession, folders: dict[str, str]) -> list[str]:
    return [k for k, v in folders.items() if not is_done(spark, v)]


def cut_sentences(sentences: DataFrame, content: str = "content", rate: int | None = None) -> DataFrame:
    """sentences (start_timestamp, end_timestamp and the file's content) with audio: the WAV bytes between."""

    @F.pandas_udf("binary")
    def cut(data, start, end):
        import pandas as pd

        out = []
        for d, a, b in zip(data, start, end):
            x, sr = load(bytes(d), rate)
            out.append(encode_wav(x[int(a * sr) : int(b * sr)], sr))
        return pd.Series(out)

    return sentences.withColumn("audio", cut(content, "start_timestamp", "end_timestamp"))


def write_files(rows: DataFrame, path: str = "audio_file", content: str = "audio") -> DataFrame:
    """rows without `content`, each of which has been written to the file at its path by the time the row is read: to a
    name beside it first, which is then renamed, so a task that runs twice leaves one whole file. Paths are local
    or URIs that pyarrow knows; rows without content write nothing."""
    kept = [x for x in rows.columns if x != content]

    def run(batches):
        from pyarrow import fs

        folders = set()
        for batch in batches:
            for name, data in zip(batch.column(path).to_pylist(), batch.column(content)):
                if data.is_valid and name:
                    store, at = fs.FileSystem.from_uri(name) if "://" in name else (fs.LocalFileSystem(), name.removeprefix("file:"))
                    folder = at.rpartition("/")[0]
                    if folder and folder not in folders:
                        store.create_dir(folder, recursive=True)
                        folders.add(folder)
                    partial = f"{at}.{TaskContext.get().taskAttemptId()}.part"
                    with store.open_output_stream(partial) as f:
                        f.write(data.as_buffer())
                    store.move(partial, at)
            yield batch.select(kept)

    return rows.mapInArrow(run, T.StructType([rows.schema[x] for x in kept]))
