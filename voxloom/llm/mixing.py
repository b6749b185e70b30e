"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source has a target in words. As often as its whole size fits into the target
it is taken whole (complete epochs); the rest is a weighted sample without replacement:
every document draws an exponential key, -ln(u) / weight, and the smallest keys are
taken until their summed sizes reach the rest. u is a hash of the id and the text, so
reruns agree. Keys are cut into ranges at quantiles of a sample that grows with the table, at most
RANGE_ROWS rows a range or so whatever the weights; sums of ranges and running sums within each range
give exact prefix sums while no task holds a whole source.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD, c, documents, fresh, stash, unit_hash

WEIGHTS, MOST, RANGE_ROWS, RANGES, MOST_RANGES, SAMPLES_A_RANGE = (5, 2, 1), 3, 50_000, 256, 8192, 64


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality(text: Column, size: Column) -> Column:
    """The weight of a document where the caller has none, above 0 and at most 1: the product of how near its
    mean word length is to 5 characters, how much of it are letters, digits and spaces, and how many of its lines end a
    sentence or are alone. Each is a plain share, so no document's weight depends on another's."""
    known = F.coalesce(text, F.lit(""))
    length = F.greatest(F.length(known), F.lit(1))
    near = 1 / (1 + F.abs(F.length(known) / F.greatest(size, F.lit(1)) - 6) / 3)
    signs = F.length(F.translate(known, "#*$%&|<>{}[]=\\^~_", "")) / length
    lines = F.length(known) - F.length(F.replace(known, F.lit("\n"))) + 1
    closed = (F.regexp_count(known, F.lit("[.!?:;][\"')]*(?=\n|$)")) + 1) / (lines + 1)
    return near * signs * F.least(F.lit(1.0), closed)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """source, source_size and target of each source, from its source and source_size.

    Sources in order of code points, null last, get the weights in turn, and shares of
    the total by weight. A target stops at `most` times the source's size; the excess is
    shared by weight among the others until none is above. In closed form: with the sources
    ordered by cap per weight, the first k are capped, k being the first at which the level
    (what the caps leave, per weight left) is below the next cap per weight. One row a
    source, so one task can order them.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    upto = Window.orderBy("ratio", F.col("source").isNull(), "source")
    every = Window.partitionBy()
    w = F.array(*[F.lit(x).cast("double") for x in weights])
    s = sizes.withColumn("w", w[((F.row_number().over(order) - 1) % len(weights)).cast("int")])
    s = s.withColumns({"cap": F.col("source_size") * float(most), "ratio": F.col("source_size") * float(most) / F.col("w")})
    before = upto.rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumns({
        "left": F.sum(F.col("source_size").cast("double")).over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
        "w_left": F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0)),
    })
    s = s.withColumn("level", F.min(F.when(F.col("left") <= F.col("ratio") * F.col("w_left"), F.struct("ratio", (F.col("left") / F.col("w_left")).alias("l")))).over(every)["l"])
    return s.select("source", "source_size", F.least("cap", F.col("level") * F.col("w")).alias("target"))


def _ranged(rows: DataFrame, range_rows: int) -> DataFrame:
    """rows with bucket: which range of keys each falls into. Boundaries are quantiles of the keys of a sample
    of SAMPLES_A_RANGE rows a range, drawn with the row's own hash; the driver holds the sample, at most
    MOST_RANGES times so many keys, and the boundaries are broadcast with the plan."""
    n = rows.count()
    ranges = min(MOST_RANGES, max(1, n // range_rows, min(RANGES, n // 100)))
    if ranges == 1:
        return rows.withColumn("bucket", F.lit(0))
    share = ranges * SAMPLES_A_RANGE / n
    drawn = rows.where(F.rand(11) < share).select("key").toArrow().column("key").to_numpy()
    edges = np.unique(np.quantile(drawn, np.arange(1, ranges) / ranges)) if len(drawn) else np.zeros(0)

    def run(batches):
        for batch in batches:
            place = np.searchsorted(edges, batch.column("key").to_numpy(zero_copy_only=False), "right").astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place)], [*batch.schema.names, "bucket"])

    return rows.mapInArrow(run, T.StructType([*rows.schema, T.StructField("bucket", T.IntegerType())]))


def mix(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weight: Column | None = None, weights: tuple[int, ...] = WEIGHTS, most: float = MOST, range_rows: int = RANGE_ROWS, seed: int = 8
) -> DataFrame:
    """id_col, size, source_size, target, taken, copies, h (a hash of the text) and group (the source) of each row of df.

    size counts the words of the text (null: 0); taken is size times copies. Each source's
    taken words are within half a document of its target. weight: a column of df, quality()
    if None; null or not above 0 counts as the least weight, 1e-6. Null sources are a source
    like another, null ids draw keys by text alone. Of documents with equal keys (repeated
    rows) any may be the one taken. Documents without words are never taken. An empty table
    gives an empty one. Columns of df beyond those named aren't read, and an id column named like one of
    the output's other columns is refused.
    """
    if id_col in ("size", "source_size", "target", "taken", "copies", "h", "group"):
        raise ValueError(f"the id column can't be named {id_col}")
    size = word_count(c(text_col))
    rows = df.select(
        c(id_col).alias("id"), c(source_col).alias("source"), size.alias("size"), (quality(c(text_col), size) if weight is None else weight).alias("w"),
        F.xxhash64(F.coalesce(c(text_col), F.lit(""))).alias("h"),
    )
    rows = rows.withColumn("key", -F.log(unit_hash(F.col("id"), F.col("h"), F.lit(seed))) / F.greatest(F.coalesce("w", F.lit(0.0)), F.lit(1e-6)))
    rows = stash(_ranged(stash(rows.drop("w"), "mix_keys"), range_rows), "mix_ranges")
    parts = rows.groupBy("source", "bucket").agg(F.sum("size").alias("part"))
    goal = targets(parts.groupBy("source").agg(F.sum("part").alias("source_size")), weights, most)
    ahead = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("ahead", F.coalesce(F.sum("part").over(ahead), F.lit(0).cast("long"))).drop("part")
    parts = parts.join(goal.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    parts = parts.withColumn("epochs", epochs).withColumnsRenamed({"source": "s", "bucket": "b"})
    both = rows.join(parts, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    run = Window.partitionBy("source", "bucket").orderBy("key", "id", "h").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = F.col("ahead") + F.sum("size").over(run)
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    chosen = (upto - F.col("size") / 2 <= rest) & (F.col("size") > 0) & (F.col("epochs") < int(most))
    out = both.withColumn("copies", F.col("epochs") + F.when(chosen, 1).otherwise(0))
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies", "h", F.col("source").alias("group"))


def mixed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """df's rows as the mix has them: each as often as it is taken, with df's columns. Of repeated rows with
    the same id, text and source as many copies are dealt in all as mix() takes of them."""
    h, kid, kh, ks, n, rows = (fresh(df, x) for x in ("h", "id", "kh", "ks", "copies", "rows"))
    took = mix(df, id_col, text_col, source_col, **options).select(c(id_col).alias(kid), F.col("h").alias(kh), F.col("group").alias(ks), F.col("copies").alias(n))
    took = stash(took.groupBy(kid, kh, ks).agg(F.sum(n).alias(n), F.count(F.lit(1)).alias(rows)).where(F.col(n) > 0), "mix_taken")
    own = df.withColumn(h, F.xxhash64(F.coalesce(c(text_col), F.lit(""))))
    both = own.join(took, (F.col(h) == F.col(kh)) & c(id_col).eqNullSafe(F.col(kid)) & c(source_col).eqNullSafe(F.col(ks)))
    if took.where(F.col(rows) > 1).limit(1).count():
        both = both.where(F.col(rows) == 1).unionByName(_dealt(both.where(F.col(rows) > 1), [h, kid, ks], n, rows))
    return both.withColumn(n, F.explode(F.array_repeat(F.lit(1), F.col(n).cast("int")))).select(*[c(x) for x in df.columns])


def _dealt(repeated: DataFrame, group: list[str], n: str, rows: str, parts: int = 256) -> DataFrame:
    """Of the n copies that a group of `rows` rows has, each row's share, n made so. Rows are numbered within
    `parts` parts of a group, so that no task numbers a whole one."""
    part, at, k = (fresh(repeated, x) for x in ("part", "at", "k"))
    rows_in = stash(repeated.withColumn(part, (F.rand(12) * parts).cast("int")), "mix_repeated")
    sizes = rows_in.groupBy(*group, part).agg(F.count(F.lit(1)).alias(k))
    sizes = sizes.select(*(F.col(x).alias(f"{x}_p") for x in [*group, part]), (F.sum(k).over(Window.partitionBy(*group).orderBy(part)) - F.col(k)).alias(at))
    on = [F.col(x).eqNullSafe(F.col(f"{x}_p")) for x in [*group, part]]
    both = rows_in.join(sizes, on).withColumn(at, F.col(at) + F.row_number().over(Window.partitionBy(*group, part).orderBy(F.lit(1))) - 1)
    share = F.floor(F.col(n) / F.col(rows)) + F.when(F.col(at) < F.pmod(F.col(n), F.col(rows)), 1).otherwise(0)
    return both.withColumn(n, share).select(*map(c, repeated.columns))


def query(spark, sf_dir):
    return mix(documents(spark, sf_dir)).drop("h", "copies", "group")
