"""Incremental runs: cached results, what is left to do, and merged runs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.arrays import identity_hash
from ..schema import named

FINGERPRINT, RESUMABLE = "input_fingerprint", "_resumable"


def checkpoint_path(folder: str, operator: str, column: str, settings: dict) -> str:
    """Where an operator's results are kept: its settings are part of the name."""
    return f"{folder.rstrip('/')}/{operator}.{column}.{identity_hash(settings)}"


def append_checkpoint(results: DataFrame, path: str, columns: list[str], resumable: Column | None = None) -> None:
    """Append id, columns and the fingerprint as JSON lines; rows that aren't resumable, such as those
    with errors, are left out so that the next run tries them again."""
    kept = results if resumable is None else results.where(resumable)
    names = ["id", *columns, *([FINGERPRINT] if FINGERPRINT in results.columns else [])]
    kept.select(*map(named, names)).write.mode("append").option("ignoreNullFields", "false").json(path)


def read_checkpoint(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The last result of each id. Torn lines are skipped; the last line of an id is that of the
    latest file, and within it the latest line."""
    columns = T.StructType([*schema, T.StructField("_bad", T.StringType())])
    rows = spark.read.schema(columns).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").json(path)
    rows = rows.select("*", F.col("_metadata.file_modification_time").alias("_m"), F.col("_metadata.file_name").alias("_f"), F.monotonically_increasing_id().alias("_n")).where("_bad IS NULL AND id IS NOT NULL")
    latest = rows.groupBy("id").agg(F.max_by(F.struct(*map(named, schema.fieldNames())), F.struct("_m", "_f", "_n")).alias("r"))
    return latest.select("r.*")


def todo(clips: DataFrame, cached: DataFrame, key: str = "id", fingerprint: str | None = None) -> DataFrame:
    """Clips without a cached result, or whose result was made from another input."""
    on = clips[key] == cached[key]
    if fingerprint:
        on = on & clips[fingerprint].eqNullSafe(cached[fingerprint])
    return clips.join(cached, on, "left_anti")


def restore(clips: DataFrame, cached: DataFrame, columns: list[str], key: str = "id", fingerprint: str | None = None) -> DataFrame:
    """Clips with a cached result, and its columns."""
    c = cached.select(F.col(key).alias("_k"), *([F.col(fingerprint).alias("_p")] if fingerprint else []), *[named(x).alias(f"_c_{x}") for x in columns])
    on = clips[key] == c["_k"]
    if fingerprint:
        on = on & clips[fingerprint].eqNullSafe(c["_p"])
    kept = [x for x in clips.columns if x not in columns]
    return clips.join(c, on).select(*[clips[x] for x in kept], *[F.col(f"_c_{x}").alias(x) for x in columns])


def resume(clips: DataFrame, cached: DataFrame, run, columns: list[str], key: str = "id", fingerprint: str | None = None) -> DataFrame:
    """Cached results where they stand, and those of run (a function of a DataFrame) for the rest."""
    return restore(clips, cached, columns, key, fingerprint).unionByName(run(todo(clips, cached, key, fingerprint)), allowMissingColumns=True)


def kept_runs(spark: SparkSession, path: str) -> list[str]:
    """The finished runs below a checkpoint's path, in order."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    names = sorted(x.getPath().getName() for x in fs.listStatus(at)) if fs.exists(at) else []
    return [n for n in names if n.startswith("run=") and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))]


def kept_results(spark: SparkSession, path: str, runs: list[str]) -> DataFrame:
    """The last result of each id among runs that may be used again: those marked resumable."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [spark.read.parquet(f"{path}/{n}").withColumn("_run", F.lit(n)) for n in runs])
    names = [x for x in rows.columns if x not in ("_run", RESUMABLE)]
    latest = rows.groupBy("id").agg(F.max_by(F.struct(*map(named, [*names, RESUMABLE])), "_run").alias("r"))
    return latest.select("r.*").where(named(RESUMABLE)).drop(RESUMABLE)


def extend(previous: DataFrame, clips: DataFrame, run, key: str = "id") -> DataFrame:
    """A table annotated before, and run's results for clips that it doesn't have."""
    return previous.unionByName(run(clips.join(previous.select(key).distinct(), key, "left_anti")), allowMissingColumns=True)


def merge_first(shards: list[DataFrame], key: str = "id", order: str | None = None) -> DataFrame:
    """All rows of the shards, of equal keys the first: that of the first shard, there the first by
    `order` (or as read). Rows with a null or empty key all stay. The first shard names the columns."""
    head = shards[0].columns
    rows = []
    for i, s in enumerate(shards):
        s = s.withColumns({"_shard": F.lit(i), "_row": named(order) if order else F.monotonically_increasing_id()})
        rows.append(s.select(*[c for c in s.columns if c in head or c in ("_shard", "_row")]))
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    empty = F.coalesce(named(key).cast("string"), F.lit("")) == ""
    first = F.row_number().over(Window.partitionBy(named(key)).orderBy("_shard", "_row"))
    # rows without a key don't go through the window, where they would be one group in one task
    kept = both.where(~empty).withColumn("_n", first).where("_n = 1").drop("_n")
    return kept.unionByName(both.where(empty)).select(*map(named, head))


def join_runs(runs: list[DataFrame], key: str = "id") -> DataFrame:
    """Runs of different models over the same clips, side by side; columns of the first win."""
    out = runs[0]
    for r in runs[1:]:
        out = out.join(r.select(key, *[x for x in r.columns if x not in out.columns]), key)
    return out


def fill_missing_text(df: DataFrame, run, text: str = "text", columns: list[str] | None = None) -> DataFrame:
    """run over the rows whose text is blank; the others go by with nulls. The two are split before
    run's Python sees a row."""
    blank = F.coalesce(F.regexp_replace(named(text), r"(?U)^\s+|\s+$", ""), F.lit("")) == ""
    return df.where(~blank).unionByName(run(df.where(blank)), allowMissingColumns=True)
