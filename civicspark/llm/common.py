"""Shared pieces: tables, the shared work folder, text constants."""

from __future__ import annotations

import contextlib
import ctypes
import string
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; those of whole texts over all cores, see spread()."""
    found = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(found) if name in ("documents", "pages") else found


def spread(df: DataFrame) -> DataFrame:
    """A table of one small file can't be split by its reader, so its rows are dealt over the session's cores. A table that
    is read in as many parts as there are cores, or more, stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = df.select(F.spark_partition_id().alias("part")).distinct().count()
    return df.repartition(cores) if parts < cores else df


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(column: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(column, UPPER, LOWER)


def give_back() -> None:
    """At the end of a task: what it has freed goes back to the system. Python workers live on, idle or in other
    stages, and their memory counts as the executor's."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees. Only a local session may go without the setting."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-work-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Writes df as Parquet in the shared folder and reads it back: the lineage ends there."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
