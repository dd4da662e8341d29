"""Folders for files that a job writes and reads again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def folder(spark: SparkSession, label: str) -> str:
    """A new folder where every executor can write: below spark.checkpoint.dir, or a temporary one of a session in
    one process."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="spark-work-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
