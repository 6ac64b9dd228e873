"""Folders that driver and executors share, for checkpoints and staged tables."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir; where that is unset, under the warehouse. It goes when the driver's session ends."""
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
    path = f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    made = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = made.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.mkdirs(made)
    store.deleteOnExit(made)
    return path
