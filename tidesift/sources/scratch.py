"""Shared scratch folder: where lineage is cut and round trips are written."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_local_root: str | None = None


def scratch_root(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``.

    Only a session in local mode may go without: it gets a fresh folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    global _local_root
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="tidesift-")
    return _local_root


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/tidesift/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, schema: StructType | None = None) -> DataFrame:
    """Write a table once and read it back: later branches start from its columns.

    Unlike a cache it outlives the executors that made it, and a reader of two
    columns reads two columns. ``schema`` reads it back under other types of the
    same layout.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema or df.schema).parquet(path)
