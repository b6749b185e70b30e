"""Exact dedup by content-defined chunk recipes, in DataFrame functions only.

A text is cut where its content says so: after the first sentence or line end
from CHUNK_MIN characters on, or at CHUNK_MAX. Chunks are deduplicated by
their 64-bit hash, and each hash is verified: all contents with one hash must be
equal (their least and greatest agree). A verified hash identifies the chunk, so
two texts are equal exactly when their ordered lists of identifiers are. Only
these lists, 8 bytes a chunk, are grouped and joined; texts cross the network once,
as distinct chunks, for the verification. Where hashes do collide, the SHA-256 of
the text joins the list of the texts concerned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import c, id_keys, kept_once, lower_az

CHUNK_MIN, CHUNK_MAX = 256, 1024


def chunk_pattern(least: int = CHUNK_MIN, most: int = CHUNK_MAX) -> str:
    return rf"(?s).{{{least},{most}}}?(?:[.!?\n]|\z)|.{{1,{most}}}"


def _rows(df: DataFrame, id_col: str, text_col: str, chunk_min: int, chunk_max: int) -> DataFrame:
    norm = df.select(c(id_col).alias("id"), lower_az(F.coalesce(c(text_col), F.lit(""))).alias("norm"))
    return norm.withColumn("chunks", F.regexp_extract_all("norm", F.lit(chunk_pattern(chunk_min, chunk_max)), F.lit(0)))


def collisions(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk_min: int = CHUNK_MIN, chunk_max: int = CHUNK_MAX) -> DataFrame:
    """Chunk hashes (h) that more than one content has: those that don't identify."""
    chunks = _rows(df, id_col, text_col, chunk_min, chunk_max).select(F.explode("chunks").alias("chunk"))
    same = chunks.groupBy(F.xxhash64("chunk").alias("h")).agg(F.min("chunk").alias("lo"), F.max("chunk").alias("hi"))
    return same.where("lo <> hi").select("h")


def recipes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk_min: int = CHUNK_MIN, chunk_max: int = CHUNK_MAX) -> DataFrame:
    """id, sha (of the normalised text), recipe (identifiers in order) and salt
    (empty if all of them are verified) of each row."""
    args = (id_col, text_col, chunk_min, chunk_max)
    rows = _rows(df, *args).select("id", F.sha2("norm", 256).alias("sha"), F.transform("chunks", lambda x: F.xxhash64(x)).alias("recipe"))
    bad = collisions(df, *args)
    if bad.agg(F.count(F.lit(1))).first()[0] == 0:
        return rows.withColumn("salt", F.lit(""))
    struck = rows.select("sha", F.explode("recipe").alias("h")).join(bad, "h", "left_semi").select("sha").distinct().withColumn("salt", F.col("sha"))
    return rows.join(struck, "sha", "left").withColumn("salt", F.coalesce("salt", F.lit("")))


def _grouped(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The distinct (recipe, id) with their counts, and the groups of equal texts.
    jk is made after the grouping, so that the join that uses it deals out both
    sides anew and a hot recipe can be split there."""
    uniq = rows.groupBy("recipe", "salt", "sha", "id").agg(F.count(F.lit(1)).alias("copies"))
    groups = uniq.groupBy("recipe", "salt").agg(F.max("id").alias("keep_id"), F.sum("copies").alias("group_size"))
    return uniq.withColumn("jk", F.xxhash64("recipe")), groups.withColumn("jk", F.xxhash64("recipe"))


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk_min: int = CHUNK_MIN, chunk_max: int = CHUNK_MAX) -> DataFrame:
    """A row for each row of df: id_col, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; of equal texts the row with
    the largest id stays. A null text counts as empty; empty texts are equal to each
    other. Null ids count as less than any other; if a group has no other, keep_id is
    null and one of its rows stays. Of repeated rows (same id, equal text) one stays.
    Other columns of df aren't read. An empty table gives an empty one.
    """
    uniq, groups = _grouped(recipes(df, id_col, text_col, chunk_min, chunk_max))
    joined = uniq.join(groups, ["jk", "recipe", "salt"]).withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return joined.select(
        F.col("id").alias(id_col), "keep_id", "group_size", ((F.col("nth") == 1) & F.col("id").eqNullSafe(F.col("keep_id"))).alias("kept"), F.col("sha").alias("text_sha256")
    )


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk_min: int = CHUNK_MIN, chunk_max: int = CHUNK_MAX) -> DataFrame:
    """The rows of df that stay, with df's columns; the rules are exact_groups'."""
    _, groups = _grouped(rows := recipes(df, id_col, text_col, chunk_min, chunk_max))
    shas = rows.select("recipe", "salt", "sha").distinct().withColumn("jk", F.xxhash64("recipe"))
    keep = groups.join(shas, ["jk", "recipe", "salt"]).select("sha", *id_keys(F.col("keep_id")))
    return kept_once(df, [F.sha2(lower_az(F.coalesce(c(text_col), F.lit(""))), 256), *id_keys(c(id_col))], keep)


def query(spark, sf_dir):
    from .common import documents

    return exact_groups(documents(spark, sf_dir))


ORACLE = """
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
FROM n
"""
