"""Written tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir, which all executors share.

    Only where that is unset on a local master (tests on one machine) a local folder takes its place.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "local")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='spark-')}"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
