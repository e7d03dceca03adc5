"""Paths for tables that queries write on the way, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_own: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in spark.checkpoint.dir, or in a temporary folder where a local session has none."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not _own:
            _own.append("file://" + tempfile.mkdtemp(prefix="spark-"))
        folder = _own[0]
    return f"{folder}/{name}-{uuid.uuid4().hex}"
