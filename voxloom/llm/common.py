"""Helpers that the training-data operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import delete_folder, new_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: White space of the word rule, and a word.
SPACES = r"\x20\x09-\x0D"
WORD = r"[^\x20\x09-\x0D]+"


SLICE, SIZE = 4 << 20, 1 << 14


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def c(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that no column of df has, in any case."""
    taken = {x.lower() for x in df.columns}
    name, n = f"_{stem}", 0
    while name.lower() in taken:
        n += 1
        name = f"_{stem}{n}"
    return name


#: Folders and tables that the operators have made, for clean_up().
_made: list[tuple[str, str]] = []


def new_dir(spark: SparkSession, stem: str) -> str:
    path = new_folder(spark, stem)
    _made.append((path, ""))
    return path


def clean_up(spark: SparkSession) -> None:
    """Delete the tables between steps. Results that haven't been written need them."""
    while _made:
        path, table = _made.pop()
        if table:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        delete_folder(spark, path)


def stash(df: DataFrame, stem: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: the lineage
    ends there, so a lost executor costs no recomputation before it."""
    spark, path = df.sparkSession, new_dir(df.sparkSession, stem)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def kept_once(df: DataFrame, keys: list[Column], chosen: DataFrame) -> DataFrame:
    """The rows of df whose keys, none of them null, are among the rows of chosen (as many columns), one
    for each. Rows cross the network once: they are made distinct where the join dealt them."""
    own, other = ([fresh(df, f"{side}{i}") for i in range(len(keys))] for side in ("own", "other"))
    left, right = df.withColumns(dict(zip(own, keys))), chosen.toDF(*other)
    on = [F.col(a) == F.col(b) for a, b in zip(own, other)]
    return left.join(right, on, "left_semi").dropDuplicates(own).drop(*own)


def id_keys(x: Column) -> list[Column]:
    """An id of any type, null or not, as keys that aren't null."""
    return [F.coalesce(x.cast("string"), F.lit("")), x.isNull()]


def bucketed(rows: DataFrame, stem: str, by: str) -> DataFrame:
    """rows as a table in the shared folder, bucketed by a column: grouping and joining by it moves what
    comes to the rows, not the rows. The table's name is the session's."""
    spark = rows.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = new_dir(spark, stem)
    name = path.rpartition("/")[2]
    rows.write.options(path=path, compression="zstd").bucketBy(buckets, by).sortBy(by).saveAsTable(name)
    _made.append((path, name))
    return spark.table(name)


def slices(batch: pa.RecordBatch, text: str, most: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about `most` bytes of text, or one longer text."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(upto):
        end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + most, "right")))
        yield batch.slice(at, end - at)
        at = end


def chunked(rows: DataFrame, stem: str, chunk_rows: int, text: str = "text") -> DataFrame:
    """rows as a table in the shared folder, with rid (a number of each row) and chunk, bucketed by chunk. Of texts below
    2 * SIZE bytes about chunk_rows neighbouring rows have one chunk, of those twice as long half as many, and so
    on, so a chunk's texts never exceed 2 * SIZE * chunk_rows bytes, or one text."""
    longer = F.floor(F.log2(F.greatest(F.coalesce(F.octet_length(text), F.lit(0)) / SIZE, F.lit(1.0)))).cast("int")
    rows = rows.withColumns({"rid": F.monotonically_increasing_id(), "_class": F.least(longer, F.lit(31))})
    place = F.expr(f"(rid & {(1 << 33) - 1}) div greatest(1, shiftright({chunk_rows}, _class))")
    rows = rows.withColumn("chunk", F.shiftright("rid", 33) * (1 << 38) + F.col("_class") * F.lit(1 << 33) + place).drop("_class")
    return bucketed(rows, stem, "chunk")


def lower_az(text: Column) -> Column:
    """A-Z to lower case, nothing else. lower() does that for ASCII texts, and
    faster than translate()."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def unit_hash(*cols: Column) -> Column:
    """A number in (0, 1) that depends on the columns alone."""
    return (F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double") + 0.5) / float(1 << 53)
