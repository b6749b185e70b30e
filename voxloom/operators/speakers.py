"""Speaker labels from embeddings, and summaries of who speaks."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import dot, unit_vector
from ..schema import named


def centroids(df: DataFrame, label: str, embedding: str) -> DataFrame:
    """label and centroid: the mean vector of each label, at unit length. Sums by position are
    combined before the shuffle; what is collected is one vector a label."""
    parts = df.select(named(label).alias("label"), F.posexplode(named(embedding)).alias("pos", "x"))
    means = parts.groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    vectors = means.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda p: p["x"]).alias("mean"))
    return vectors.select("label", unit_vector(F.col("mean")).alias("centroid"))


def checked(centers: DataFrame, most_centers: int) -> DataFrame:
    """centers, which are to be broadcast, refused where there are more than most_centers."""
    if centers.limit(most_centers + 1).count() > most_centers:
        raise ValueError(f"more than {most_centers} centroids")
    return centers


def similarities(df: DataFrame, key: str, embedding: str, centers: DataFrame, most_centers: int = 10_000) -> DataFrame:
    """key, label and similarity of each row to each centroid. The centroids, a row a label, are
    broadcast; more than most_centers of them are refused, as every pair is asked for."""
    centers = checked(centers, most_centers)
    rows = df.select(named(key).alias(key), unit_vector(named(embedding)).alias("_unit"))
    return rows.crossJoin(F.broadcast(centers)).select(named(key), "label", dot(F.col("_unit"), F.col("centroid")).alias("similarity"))


def assign_speakers(df: DataFrame, key: str, embedding: str, label: str, threshold: float = 0.75, margin: float = 0.10, prefix: str = "spk", most_centers: int = 10_000) -> DataFrame:
    """df with speaker, speaker_conf and speaker_margin.

    conf is the similarity to the row's own centroid, margin that of the best less that of the second
    best (-1 where there is one label only). A row is assigned if conf reaches the threshold and, with
    several labels, margin reaches the margin; else its speaker is "unknown". The centroids are
    broadcast as one row; more than most_centers of them are refused."""
    centers = checked(centroids(df, label, embedding), most_centers)
    packed = centers.agg(F.array_sort(F.collect_list(F.struct("label", "centroid"))).alias("_centers"))  # one row
    rows = df.withColumn("_unit", unit_vector(named(embedding))).crossJoin(F.broadcast(packed))
    sims = F.transform("_centers", lambda x: F.struct(dot(F.col("_unit"), x["centroid"]).alias("s"), x["label"].alias("label")))
    rows = rows.withColumn("_sims", sims)
    top = F.sort_array(F.transform("_sims", lambda x: x["s"]), asc=False)
    conf = F.element_at(F.filter("_sims", lambda x: x["label"] == named(label)), 1)["s"]
    best, second = F.element_at(top, 1), F.when(F.size("_sims") > 1, F.try_element_at(top, F.lit(2))).otherwise(-1.0)
    sure = (conf >= threshold) & ((F.size("_sims") == 1) | (best - second >= margin))
    spk = F.when(sure, F.format_string(f"{prefix}_%03d", named(label).cast("int"))).otherwise("unknown")
    return rows.withColumns({"speaker": spk, "speaker_conf": F.bround(conf, 4), "speaker_margin": F.bround(best - second, 4)}).drop("_unit", "_centers", "_sims")


def average_linkage(vectors: np.ndarray, distance: float) -> np.ndarray:
    """Labels of agglomerative clustering with cosine distances and average linkage: the two nearest
    clusters merge until none are nearer than distance. Labels count in order of first members."""
    n = len(vectors)
    unit = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    gaps = 1 - unit @ unit.T
    np.fill_diagonal(gaps, np.inf)
    size, label = np.ones(n), np.arange(n)
    nearest = gaps.argmin(axis=1) if n else np.zeros(0, int)
    least = gaps[np.arange(n), nearest]
    for _ in range(n - 1):
        i = int(least.argmin())
        if not least[i] < distance:
            break
        i, j = sorted((i, int(nearest[i])))
        merged = (gaps[i] * size[i] + gaps[j] * size[j]) / (size[i] + size[j])
        gaps[i], gaps[:, i] = merged, merged
        gaps[j], gaps[:, j] = np.inf, np.inf
        gaps[i, i] = np.inf
        size[i] += size[j]
        label[label == j] = i
        least[j] = np.inf
        for k in np.flatnonzero((nearest == i) | (nearest == j) | (merged < least)):
            if least[k] < np.inf or k == i:
                nearest[k] = gaps[k].argmin()
                least[k] = gaps[k, nearest[k]]
    return np.unique(label, return_inverse=True)[1]


def _nearest(rows: DataFrame, centers: DataFrame) -> DataFrame:
    """rows with s and near: the similarity and the label of the nearest centroid, of equals the least label."""
    packed = centers.agg(F.array_sort(F.collect_list(F.struct("label", "centroid"))).alias("_c"))
    sims = F.transform("_c", lambda x: F.struct(dot(F.col("_unit"), x["centroid"]).alias("s"), (-x["label"]).alias("neg")))
    both = rows.crossJoin(F.broadcast(packed)).withColumn("_best", F.array_max(sims)).drop("_c")
    return both.withColumns({"s": F.col("_best.s"), "near": -F.col("_best.neg")}).drop("_best")


def cluster_speakers(df: DataFrame, key: str, embedding: str, distance: float = 0.5, most: int = 5000, folder: str | None = None) -> DataFrame:
    """key and label of every row.

    Average linkage compares all pairs, so one task clusters at most `most` rows, those that come first by a
    hash of the key. Where there are no more, that is the whole result. Else every other row nearer to one of
    these clusters' centroids than distance takes its label, and the rows that are near none go through
    the same again, until none are left; so a speaker whom no round has fitted yet gets a cluster of
    their own and not a distant one's. What is broadcast is at most `most` centroids. folder: where rounds
    are kept; given a folder that executors share, their lineage ends there."""
    spark, kind = df.sparkSession, df.schema[key].dataType.simpleString()
    rows = df.select(named(key).alias(key), named(embedding).cast("array<double>").alias("v"))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(key, ignore_index=True)
        return pd.DataFrame({key: part[key], "v": part["v"], "label": average_linkage(np.stack(part["v"].to_numpy()), distance).astype(np.int64)})

    def kept(x: DataFrame, name: str) -> DataFrame:
        if folder is None:
            return x.checkpoint() if spark.sparkContext._jsc.sc().getCheckpointDir().isDefined() else x
        x.write.mode("overwrite").parquet(f"{folder}/{name}")
        return spark.read.schema(x.schema).parquet(f"{folder}/{name}")

    out, first, nth = [], 0, 0
    while True:
        fitted = rows.orderBy(F.xxhash64(named(key)), named(key)).limit(most)
        labelled = kept(fitted.withColumn("_all", F.lit(1)).groupBy("_all").applyInPandas(run, f"`{key}` {kind}, v array<double>, label long").withColumn("label", F.col("label") + first), f"fitted_{nth}")
        out.append(labelled.select(key, "label"))
        n, highest = labelled.agg(F.count(F.lit(1)), F.max("label")).first()
        if n < most:
            break
        rest = rows.join(labelled.select(named(key).alias("_k")), rows[key] == F.col("_k"), "left_anti").withColumn("_unit", unit_vector(F.col("v")))
        rest = kept(_nearest(rest, checked(centroids(labelled, "label", "v"), most)).drop("_unit"), f"rest_{nth}")
        near = 1 - F.col("s") < distance
        out.append(rest.where(near).select(key, F.col("near").alias("label")))
        rows, first, nth = rest.where(~near).select(key, "v"), highest + 1, nth + 1
        if not rows.limit(1).count():
            break
    return reduce(DataFrame.unionByName, out)


def diarization_summary(turns: DataFrame, clip: str, speaker: str, seconds: Column) -> DataFrame:
    """clip, num_speakers and top_speaker_ratio (4 places): the longest speaker's share."""
    by = turns.groupBy(named(clip), named(speaker)).agg(F.sum(seconds).alias("s"))
    return by.groupBy(named(clip)).agg(F.count(F.lit(1)).alias("num_speakers"), F.bround(F.try_divide(F.max("s"), F.sum("s")), 4).alias("top_speaker_ratio"))


def silent_clips(clips: DataFrame, clip: str, summary: DataFrame) -> DataFrame:
    """Each clip's summary; (0, 0.0) for those without a turn."""
    joined = clips.select(named(clip)).join(summary, clip, "left")
    return joined.select(named(clip), F.coalesce("num_speakers", F.lit(0).cast("long")).alias("num_speakers"), F.coalesce("top_speaker_ratio", F.lit(0.0)).alias("top_speaker_ratio"))
