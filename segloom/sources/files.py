"""Which files are new or changed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_signatures(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, modified, sha256) of the files that a path or glob names."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", "length", F.col("modificationTime").alias("modified"), F.sha2("content", 256).alias("sha256"))


def changed_files(spark: SparkSession, path: str, registry: DataFrame) -> DataFrame:
    """Signatures of files that the registry lacks or knows with another content; size and time are compared first.

    Contents are read only of files whose size or time differs from the registry's.
    """
    files = spark.read.format("binaryFile").load(path)
    known = registry.select("path", "length", F.col("modified").alias("modificationTime"))
    suspects = files.join(known, ["path", "length", "modificationTime"], "left_anti")
    signed = suspects.select("path", "length", F.col("modificationTime").alias("modified"), F.sha2("content", 256).alias("sha256"))
    old = registry.select("path", F.col("sha256").alias("__old"))
    return signed.join(old, "path", "left").where(~F.col("sha256").eqNullSafe(F.col("__old"))).drop("__old")
