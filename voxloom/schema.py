"""The clip row and the columns that operators add."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CLIP = T.StructType([
    T.StructField("id", T.StringType(), False), T.StructField("audio_file", T.StringType()), T.StructField("format", T.StringType()),
    T.StructField("sample_rate", T.IntegerType()), T.StructField("channels", T.IntegerType()), T.StructField("bit_rate", T.StringType()),
    T.StructField("duration", T.DoubleType()), T.StructField("text", T.StringType()),
])
CLIP_COLUMNS = CLIP.fieldNames()
WORD = T.StructType([T.StructField("text", T.StringType()), T.StructField("start", T.DoubleType()), T.StructField("end", T.DoubleType())])
TURN = T.StructType([T.StructField("speaker", T.StringType()), T.StructField("start", T.DoubleType()), T.StructField("end", T.DoubleType())])
CANDIDATE = T.StructType([T.StructField("id", T.StringType()), T.StructField("status", T.StringType()), T.StructField("text", T.StringType())])


def named(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def ordered(df: DataFrame, declared: list[str] | None = None) -> DataFrame:
    """df with the clip's columns first, then the others as they come, then the declared ones
    that are absent, as nulls. The path of the source goes."""
    own = [x for x in CLIP_COLUMNS if x in df.columns]
    more = [x for x in df.columns if x not in own and x != "path"]
    absent = [x for x in declared or [] if x not in df.columns]
    return df.select(*map(named, own + more), *[F.lit(None).cast("string").alias(x) for x in absent])


def require(df: DataFrame, columns: list[str], who: str) -> None:
    missing = [x for x in columns if x not in df.columns]
    if missing:
        raise ValueError(f"{who} needs columns that are missing: {', '.join(missing)}")
