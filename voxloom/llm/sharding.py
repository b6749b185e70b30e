"""Shards of near-equal bytes by sampled splitters.

Records are ordered by (hash of the text, id), so equal texts are neighbours. A
size-weighted sample of these keys gives the quantiles that cut the order into many
small ranges; a text that together exceeds a SPLIT-th of a shard and on which several quantiles
fall is subdivided by id. Exact sums of the ranges, then running sums within each range, give every
record its exact place in bytes and in rows; equal parts of the bytes are the shards.
Equal texts go to the shard that the middle of their bytes falls into, unless together they exceed a
SPLIT-th of a shard: then each of them goes by its own place. So a shard's size is at most a
SPLIT-th of a shard from equal, and the sample changes no record's shard.
What the driver holds is the sample (about SAMPLES keys) and a row for each of the
ranges, at most MOST_RANGES, however many records there are.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import c, documents, stash

SHARDS, SPLIT, RANGES, MOST_RANGES, RANGE_ROWS, SAMPLES_A_RANGE = 24, 10, 960, 8192, 200_000, 25
NO_ID = -(1 << 63)


def sample_splitters(keys: DataFrame, total: int, samples: int, ranges: int, whole: int) -> list[tuple[int, int]]:
    """Quantile boundaries (h, d) of a size-weighted sample: a record is drawn with
    the probability that its size bears to a total/samples-th; a larger one is always drawn
    and weighs its size. A boundary takes in the whole text that it falls on (least d), unless others fall on it
    too and its records together exceed `whole` bytes; then it takes the sampled id, which subdivides the text."""
    step = max(1.0, total / samples)
    drawn = keys.where(F.rand(5) * step < F.col("size")).select("h", "d", "size").toPandas()
    if drawn.empty:
        return []
    drawn = drawn.sort_values(["h", "d"], ignore_index=True)
    upto = drawn["size"].clip(lower=step).cumsum().to_numpy()
    at = np.unique(np.searchsorted(upto, upto[-1] * np.arange(1, ranges) / ranges))
    cut = drawn.loc[at, ["h", "d"]].drop_duplicates()
    several = sorted(set(cut.loc[cut["h"].duplicated(), "h"].tolist()))
    large = {r["h"] for r in keys.where(F.col("h").isin(several)).groupBy("h").agg(F.sum("size").alias("s")).where(F.col("s") > whole).collect()} if several else set()
    return sorted({(int(h), int(d) if h in large else NO_ID) for h, d in zip(cut["h"], cut["d"])})


def range_of(splitters: list[tuple[int, int]]):
    """A function of the columns h and d: how many boundaries lie at or before (h, d)."""
    hs = np.array([h for h, _ in splitters], dtype=np.int64)
    inner: dict[int, np.ndarray] = {}
    for h in np.unique(hs).tolist():
        inner[h] = np.array([d for g, d in splitters if g == h], dtype=np.int64)

    @F.pandas_udf("int")
    def place(h: pd.Series, d: pd.Series) -> pd.Series:
        h, d = h.to_numpy(), d.to_numpy()
        out = np.searchsorted(hs, h, "left")
        for x in np.intersect1d(h, hs).tolist():
            own = h == x
            out[own] += np.searchsorted(inner[x], d[own], "right")
        return pd.Series(out.astype(np.int32))

    return place


def shard(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, ranges: int | None = None) -> DataFrame:
    """id_col, size, text_crc32, law, shard, slot and grown_shard of each row of df.

    size is the text's UTF-8 bytes plus 8, a null text has none and so 8; its crc32 is
    the empty text's. slot counts the rows of a shard from 0 without a gap, in the order of
    the key. Rows with null ids come first among equal texts. Repeated rows are rows like
    any other: they get slots of their own, in any order. An empty table gives an empty
    one; more shards than rows leave some empty. Other columns of df aren't read.
    """
    text = F.coalesce(c(text_col), F.lit(""))
    keys = stash(
        df.select(
            c(id_col).cast("long").alias("id"), (F.octet_length(text) + F.lit(8).cast("long")).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("h"), F.coalesce(c(id_col).cast("long"), F.lit(NO_ID)).alias("d"),
        ), "shard_keys"
    )
    total, n = keys.agg(F.coalesce(F.sum("size"), F.lit(0).cast("long")), F.count(F.lit(1))).first()
    ranges = ranges or min(MOST_RANGES, max(RANGES, n // RANGE_ROWS))
    whole = total // (shards * SPLIT)
    splitters = sample_splitters(keys, total, ranges * SAMPLES_A_RANGE, ranges, whole)
    placed = keys.withColumn("r", range_of(splitters)("h", "d") if splitters else F.lit(0))

    in_range = Window.partitionBy("r").orderBy("h", "d")
    group = Window.partitionBy("r", "h")
    before = F.sum("size").over(in_range.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    local = stash(
        placed.withColumns({"at": before, "row": F.row_number().over(in_range) - 1}).withColumns({"group_at": F.min("at").over(group), "group_size": F.sum("size").over(group)}), "shard_ranges"
    )
    sums = {r["r"]: (r["b"], r["n"]) for r in local.groupBy("r").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).collect()}
    starts, b, n = [], 0, 0
    for r in range(len(splitters) + 1):
        starts.append((r, b, n))
        b, n = b + sums.get(r, (0, 0))[0], n + sums.get(r, (0, 0))[1]
    table = pa.table([pa.array(x, t) for x, t in zip(zip(*starts), (pa.int32(), pa.int64(), pa.int64()))], ["q", "first_byte", "first_row"])
    local = local.join(F.broadcast(df.sparkSession.createDataFrame(table)), F.col("r") == F.col("q"))
    # a text that ranges subdivide exceeds `whole`, and so do its parts count as alone
    parted = sorted({h for h, d in splitters if d != NO_ID})
    alone = F.col("group_size") > F.lit(whole)
    alone = alone | F.col("h").isin(parted) if parted else alone
    at = F.col("first_byte") + F.when(alone, F.col("at")).otherwise(F.col("group_at") + F.expr("group_size div 2"))
    dealt = local.withColumns({"shard": F.least(F.floor(at.cast("double") * shards / max(1, total)), F.lit(shards - 1)).cast("int"), "nth": F.col("first_row") + F.col("row")})
    firsts = {r["shard"]: r["f"] for r in dealt.groupBy("shard").agg(F.min("nth").alias("f")).collect()}
    first = F.array(*[F.lit(firsts.get(s, 0)).cast("long") for s in range(shards)])[F.col("shard")]
    return dealt.select(
        F.col("id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("nth") - first).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )


def query(spark, sf_dir):
    return shard(documents(spark, sf_dir))
