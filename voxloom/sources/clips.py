"""Reading clip tables: CSV, JSON lines, Parquet exports, and folders of audio with texts."""

from __future__ import annotations

import ast
import json
import re
from collections.abc import Callable
from functools import reduce
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.arrays import file_stem
from ..functions.signal import wav_header
from ..schema import CLIP_COLUMNS, named

# Left unset, charToEscapeQuoteEscaping is the null character, which is then lost from quoted cells
CSV_DIALECT = {"sep": "|", "header": "true", "quote": '"', "escape": '"', "charToEscapeQuoteEscaping": '"', "multiLine": "true", "encoding": "UTF-8"}
#: For read_csv: only cells that aren't quoted are null when empty, as sinks.EMPTY_QUOTED writes them. What stands for
#: null while parsing is a code point that Unicode leaves to programs and no text should have.
EMPTY_KEPT = {"nullValue": "\uffff", "emptyValue": ""}


def file_pattern(pattern: str | None) -> str | None:
    """`.ext` means every file with that ending; anything else stands as it is."""
    return f"*{pattern}" if pattern and pattern.startswith(".") and "*" not in pattern else pattern


def resolve(root: str, path: Column) -> Column:
    """path under root, unless it is absolute or names a store itself."""
    absolute = path.startswith("/") | path.rlike("^[A-Za-z][A-Za-z0-9+.-]*://")
    return F.when(absolute, path).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), path))


def adapt(df: DataFrame, audio_key: str = "audio_file", id_key: str = "id", audio_format: str = "wav", root: str | None = None, defaults: dict | None = None, source: Column | None = None, row: Column | None = None, missing_text: str | None = "") -> DataFrame:
    """Rows as clips: numbers parsed where they parse, the audio column renamed, its path as given kept in
    `path`, a missing id made from source and row, all other columns passed through as they are.
    The keys of a `metadata` column of texts become columns: see spread_metadata(). Defaults are added
    where there is no value; a text that is missing is missing_text. Rows without audio go."""
    if "metadata" in df.columns and df.schema["metadata"].dataType == T.StringType():
        df = spread_metadata(df)
    has = lambda k: named(k) if k in df.columns else F.lit(None).cast("string")
    audio = has(audio_key)
    made = F.concat_ws("/", source if source is not None else F.lit(""), (row if row is not None else F.monotonically_increasing_id()).cast("string"))
    out = {
        "id": F.coalesce(has(id_key).cast("string"), made), "audio_file": resolve(root, audio) if root else audio, "format": F.coalesce(has("format"), F.lit(audio_format)),
        "sample_rate": has("sample_rate").cast("string").try_cast("int"), "channels": has("channels").cast("string").try_cast("int"), "bit_rate": has("bit_rate").cast("string"),
        "duration": has("duration").cast("string").try_cast("double"), "text": F.coalesce(has("text").cast("string"), F.lit(missing_text)), "path": audio,
    }
    more = [x for x in df.columns if x not in {*CLIP_COLUMNS, audio_key, id_key, "path"} and not x.startswith("_src")]
    added = {k: F.lit(v) for k, v in (defaults or {}).items() if k not in more}
    rows = df.where(F.coalesce(F.length(audio), F.lit(0)) > 0)
    kept = [F.coalesce(named(x), F.lit(str(defaults[x]))).alias(x) if defaults and x in defaults else named(x) for x in more]
    return rows.select(*[v.alias(k) for k, v in out.items()], *kept, *[v.alias(k) for k, v in added.items()])


@F.pandas_udf(T.StringType())
def literal_to_json(cells: pd.Series) -> pd.Series:
    """Python dict literals as JSON objects of texts, null for anything else. They aren't an SQL
    expression, so this runs in Python, on the cells that aren't JSON."""

    def one(cell: str | None) -> str | None:
        try:
            value = ast.literal_eval(cell)
            return json.dumps({str(k): v if v is None or isinstance(v, str) else str(v) for k, v in value.items()}, ensure_ascii=False)
        except (AttributeError, ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
            return None

    return cells.map(one).astype(object)


def spread_metadata(df: DataFrame, most_keys: int = 1000) -> DataFrame:
    """df with the keys of `metadata` as columns of texts, but for those that df has. A cell is a JSON object
    or a Python dict literal; where it is neither, it stays in `metadata`. Every key becomes a
    column of the plan, so more than most_keys of them are refused."""
    kind, cell = "map<string,string>", named("metadata")
    given = F.nullif(F.trim(cell), F.lit(""))
    as_json = F.from_json(given, kind)
    parsed = F.coalesce(as_json, F.from_json(literal_to_json(F.when(as_json.isNull(), given)), kind))
    df = df.withColumn("_src_meta", parsed)
    left = F.when(F.col("_src_meta").isNull(), given)
    found = df.select(F.explode(F.when(left.isNotNull(), F.array(F.lit(None).cast("string"))).otherwise(F.map_keys("_src_meta"))).alias("k")).distinct().limit(most_keys + 1)
    keys = [r["k"] for r in found.collect()]
    if len(keys) > most_keys:
        raise ValueError(f"metadata has more than {most_keys} keys")
    df = df.withColumn("metadata", left) if None in keys else df.drop("metadata")
    return df.withColumns({k: F.col("_src_meta")[k] for k in sorted(k for k in keys if k is not None) if k not in df.columns}).drop("_src_meta")


def header_groups(spark: SparkSession, path: str) -> list[list[str]]:
    """The files of a path, those with equal header lines together; one file alone isn't opened for it."""
    files = [unquote(x) for x in spark.read.text(path).inputFiles()]
    if len(files) < 2:
        return [files]
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("n"))
    heads = lines.where("at = 0").groupBy("f").agg(F.min_by("value", "n").alias("head"))
    return [[unquote(f) for f in r["files"]] for r in heads.groupBy("head").agg(F.array_sort(F.collect_list("f")).alias("files")).orderBy("head").collect()]


def read_csv(spark: SparkSession, path: str, adapter: Callable[[DataFrame], DataFrame] | None = None, limit: int = -1, options: dict | None = None, one_header: bool = False, **adapting) -> DataFrame:
    """Clips of CSV files (gzip and others by their ending). Every column is read as a string, so
    passed-through values stay as they are. Ids that are missing are file and row number.

    Each file is read by its own header: files are grouped by header, for which their lines are scanned
    once, and columns that a file lacks are null. With one_header nothing is scanned beforehand,
    and a file whose header differs from the first one's fails the job."""
    dialect = CSV_DIALECT | (options or {})

    def rows(paths: str | list[str]) -> DataFrame:
        names = spark.read.options(**dialect | {"multiLine": "false"}).csv(paths).columns
        return spark.read.options(**dialect, enforceSchema="false").schema(T.StructType([T.StructField(x, T.StringType()) for x in names])).csv(paths)

    groups = [] if one_header else header_groups(spark, path)
    if len(groups) < 2:
        return _clips(_tagged(rows(path)), adapter, limit, adapting)
    literal = lambda f: re.sub(r"([\[\]{}*?\\])", r"\\\1", f)
    parts = [_tagged(rows([literal(f) for f in files])) for files in groups]
    return _clips(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), adapter, limit, adapting)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str | None = None, adapter: Callable[[DataFrame], DataFrame] | None = None, limit: int = -1, **adapting) -> DataFrame:
    """Clips of JSON lines; lines that don't parse are left out: see bad_lines()."""
    reader = spark.read.option("mode", "DROPMALFORMED")
    return _clips(_tagged((reader.schema(schema) if schema else reader).json(path)), adapter, limit, adapting)


def bad_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The lines that don't parse."""
    full = T.StructType([*schema, T.StructField("_bad", T.StringType())])
    lines = spark.read.text(path).select(F.from_json("value", full, {"columnNameOfCorruptRecord": "_bad"}).alias("row"))
    return lines.select("row._bad").where("_bad IS NOT NULL")


def read_export(spark: SparkSession, path: str, dataset: str | None = None, limit: int = -1, **adapting) -> DataFrame:
    """Clips of a data set exported to Parquet, where audio may be a struct of path and sampling_rate."""
    df = _tagged(spark.read.parquet(path))
    if "audio" in df.columns and isinstance(df.schema["audio"].dataType, T.StructType):
        inner = df.schema["audio"].dataType.fieldNames()
        df = df.withColumns({"audio_file": F.col("audio.path")} | ({"sample_rate": F.col("audio.sampling_rate")} if "sampling_rate" in inner else {})).drop("audio")
    if dataset is not None and "dataset" not in df.columns:
        df = df.withColumn("dataset", F.lit(dataset))
    return _clips(df, None, limit, adapting)


def _tagged(rows: DataFrame) -> DataFrame:
    """rows with the file that each is from, and its place there."""
    return rows.select("*", F.col("_metadata.file_path").alias("_src_file"), F.col("_metadata.file_block_start").alias("_src_at"), F.monotonically_increasing_id().alias("_src_n"))


def _clips(tagged: DataFrame, adapter, limit: int, adapting: dict) -> DataFrame:
    """limit: the first so many clips, in order of file and place; below 0, all of them."""
    place = ["_src_file", "_src_at", "_src_n"]
    if adapter is not None:
        return adapter((tagged.orderBy(*place).limit(limit) if limit >= 0 else tagged).drop(*place))
    needs_ids = adapting.get("id_key", "id") not in tagged.columns
    if needs_ids:  # only then are rows numbered by file
        tagged = tagged.withColumn("_src_row", F.row_number().over(Window.partitionBy("_src_file").orderBy("_src_at", "_src_n")) - 1)
    key = adapting.get("audio_key", "audio_file")
    if limit >= 0:
        tagged = tagged.where(F.length(named(key)) > 0).orderBy(*place).limit(limit) if key in tagged.columns else tagged.limit(0)
    return adapt(tagged, source=F.col("_src_file"), row=F.col("_src_row") if needs_ids else F.col("_src_n"), **adapting)


def list_files(spark: SparkSession, root: str, pattern: str | None = None, recursive: bool = True) -> DataFrame:
    """path, length and modificationTime of files; their contents aren't read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if p := file_pattern(pattern):
        reader = reader.option("pathGlobFilter", p)
    return reader.load(root).select("path", "length", "modificationTime")


def beside(audio: DataFrame, texts: DataFrame) -> DataFrame:
    """audio (with path) and texts (with text_file) of the same base name, `_stem`. Of audio files that share one,
    the last by path."""
    last = audio.groupBy(file_stem(F.col("path")).alias("_stem")).agg(F.max_by(F.struct(*audio.columns), "path").alias("a")).select("_stem", "a.*")
    return last.join(texts.withColumn("_stem", file_stem(F.col("text_file"))), "_stem")


def read_folder(spark: SparkSession, root: str, pattern: str = ".wav", text_ending: str | None = None, recursive: bool = True, limit: int = -1) -> DataFrame:
    """A clip a file, named path/0. With text_ending, clips of the files that have a text beside them of
    the same base name (of audio files that share one, the last by path), newlines taken out."""
    audio = list_files(spark, root, pattern, recursive).select("path", F.lower(F.regexp_extract("path", r"\.([^./]*)$", 1)).alias("format"))
    if text_ending is not None:
        texts = spark.read.option("recursiveFileLookup", str(recursive).lower()).option("pathGlobFilter", file_pattern(text_ending)).text(root, wholetext=True)
        texts = texts.select(F.col("_metadata.file_path").alias("text_file"), F.regexp_replace("value", r"\r?\n", "").alias("text"))
        audio = beside(audio, texts)
    out = audio.select(F.concat("path", F.lit("/0")).alias("id"), F.col("path").alias("audio_file"), "format", F.col("text") if text_ending is not None else F.lit("").alias("text"))
    return out.orderBy("audio_file").limit(limit) if limit >= 0 else out


def read_bytes(spark: SparkSession, clips: DataFrame, root: str, pattern: str | None = None) -> DataFrame:
    """clips with content: the bytes of their files, read by Spark so that any store will do."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if p := file_pattern(pattern):
        reader = reader.option("pathGlobFilter", p)
    files = reader.load(root).select(F.regexp_replace("path", "^file:(?=/)", "").alias("_path"), "content")
    return clips.join(files, F.regexp_replace(clips["audio_file"], "^file:/*(?=/)", "") == files["_path"], "left").drop("_path")


HEADER = T.StructType([
    T.StructField("frames", T.LongType()), T.StructField("sample_rate", T.IntegerType()), T.StructField("channels", T.IntegerType()),
    T.StructField("bit_rate", T.StringType()), T.StructField("duration", T.DoubleType()),
])


@F.pandas_udf(HEADER)
def wav_info(content: pd.Series) -> pd.DataFrame:
    rows = [wav_header(bytes(x)) if x is not None else None for x in content]
    return pd.DataFrame([r or dict.fromkeys(("frames", "sample_rate", "channels", "bit_rate", "duration")) for r in rows], columns=["frames", "sample_rate", "channels", "bit_rate", "duration"])


def with_audio_information(clips: DataFrame, content: str = "content") -> DataFrame:
    """Durations, rates and channels that are missing, from the files; unreadable files change nothing."""
    found = clips.withColumn("_info", wav_info(content))
    fill = {k: F.coalesce(named(k), F.col(f"_info.{k}")) for k in ("sample_rate", "channels", "bit_rate", "duration")}
    return found.withColumns(fill).drop("_info")


def durations(clips: DataFrame, content: str = "content") -> DataFrame:
    """duration where it is missing: from the header, 0 where that can't be read."""
    return clips.withColumn("duration", F.coalesce("duration", wav_info(content)["duration"], F.lit(0.0)))


def datasets(spark: SparkSession, root: str, table: str = "metadata.csv") -> DataFrame:
    """dataset, path and length of each folder of root that holds a table, the smallest first."""
    found = list_files(spark, root, table)
    return found.select(F.element_at(F.split("path", "/"), -2).alias("dataset"), "path", "length").orderBy("length", "dataset")
