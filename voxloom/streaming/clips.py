"""Clip tables as streams: files that arrive are annotated once, in small batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def stream_clips(spark: SparkSession, folder: str, schema: T.StructType, kind: str = "json", files_a_batch: int = 100) -> DataFrame:
    """Rows of files as they arrive in a folder, with the time of their file as `arrived`."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).format(kind).load(folder)
    return rows.select("*", F.col("_metadata.file_modification_time").alias("arrived"))


def once_by_id(clips: DataFrame, key: str = "id", delay: str | None = "7 days") -> DataFrame:
    """Each id once. With a delay, ids are forgotten that long after their file came, so that the state
    doesn't grow for ever; None keeps them all."""
    if delay is None:
        return clips.dropDuplicates([key])
    return clips.withWatermark("arrived", delay).dropDuplicatesWithinWatermark([key])


def windowed_counts(clips: DataFrame, width: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Clips and hours of speech by the window in which they came; late files count until delay."""
    return clips.withWatermark("arrived", delay).groupBy(F.window("arrived", width)).agg(F.count(F.lit(1)).alias("clips"), (F.sum(F.coalesce("duration", F.lit(0.0))) / 3600).alias("hours"))


def annotate(clips: DataFrame, run: Callable[[DataFrame], DataFrame], output: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """run over every batch, appended to output as Parquet. A batch that is tried again after a failure
    replaces its own folder, so nothing is written twice."""

    def write(batch: DataFrame, number: int) -> None:
        run(batch).write.mode("overwrite").parquet(f"{output.rstrip('/')}/batch={number}")

    writer = clips.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
