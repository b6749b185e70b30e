"""The corpus pipeline: documents through five of the operators.

Documents whose language isn't found go; of equal texts one stays, then one of each
group of near-duplicates; sources are mixed to their target weights, so a document may come
more than once; the texts become SentencePiece ids, and what these decode to is told by its crc32.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voxloom.llm.exact_dedup import exact_dedup
from voxloom.llm.language_id import reject_unknown
from voxloom.llm.mixing import mixed
from voxloom.llm.sentencepieces import round_trip
from voxloom.llm.simhash import near_dedup

#: SQL can't express the network of the first stage.
ORACLE_SQL = None


def find_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return reject_unknown(docs)


def dedup_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup(docs)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed(docs)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return round_trip(docs)


STAGES = [
    ("language ID", find_language),
    ("exact dedup", dedup_exact),
    ("SimHash near-dedup", dedup_near),
    ("mixing to target weights", mix_sources),
    ("SentencePiece encoding and decoding", to_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each result written to the shared folder and read again by the next."""
    from voxloom.llm.common import documents, stash

    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), "pipeline_" + name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)
