"""The folder that driver and executors share, for tables between steps."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, of the session or as set on its context. Where none is named, a temporary folder if the
    session runs on this machine alone; on a cluster every executor would write to its own disk, so there that is
    an error."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    set_to = context._jsc.sc().getCheckpointDir()
    if not named and set_to.isDefined():
        named = set_to.get()
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="voxloom_")
        context.setCheckpointDir(named)
    return named.rstrip("/")


def new_folder(spark: SparkSession, stem: str) -> str:
    return f"{shared_folder(spark)}/{stem}_{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
