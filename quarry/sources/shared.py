"""Folders that driver and executors share, for tables that a job writes."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, name: str = "quarry") -> str:
    """A new folder name below ``spark.checkpoint.dir``.  Where that is unset, a
    scratch folder is made, in local mode only: on a cluster a machine-local folder
    would not be seen by the other machines, so its absence is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        root = "file://" + tempfile.mkdtemp(prefix="quarry-shared-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
