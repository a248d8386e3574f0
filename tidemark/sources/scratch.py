"""Work folders that the whole cluster shares."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_own: dict[str, str] = {}


def fresh_path(spark: SparkSession, name: str, root: str | None = None) -> str:
    """A new path below root, or else spark.checkpoint.dir.  Unset, it is a temporary folder in local mode, as in tests, and an error on a cluster."""
    root = root or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if context.applicationId not in _own:
            _own[context.applicationId] = tempfile.mkdtemp(prefix="spark-")
        root = _own[context.applicationId]
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """df computed once into a shared folder, and read from there."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
