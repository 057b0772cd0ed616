"""Small helpers that the operators share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the contracts: space and U+0009 to U+000D.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(column: str) -> Column:
    """The text in UTF-8; null counts as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def id_remainder(column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo divisor; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % divisor


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir, which driver and executors share.

    Only where that is unset (tests on one machine) a local folder takes its place.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        import tempfile

        base = tempfile.mkdtemp(prefix="spark-")
        if not base.startswith("file:"):
            base = f"file://{base}"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def identity(column: str) -> Column:
    """The id as a key under which null equals null, so joins on it stay equi-joins."""
    return F.struct(F.col(column).isNull().alias("no_id"), F.col(column).alias("id"))


def rows_of(df: DataFrame, text: Column, kept: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row of df for each (key, text) that ``kept`` names; its columns stay as they are.

    ``kept``: distinct (key, text), the key as ``identity`` makes it. Of rows that repeat an id and its text the one
    of smallest hash over all columns but maps stays. They are merged before the shuffle, so a row that a third of
    the table repeats is no hot key, and the join reuses that shuffle.
    """
    own = {c: f"c{i}" for i, c in enumerate(df.columns)}
    hashed = F.xxhash64(*(F.col(c) for c in df.columns if "map<" not in df.schema[c].dataType.simpleString()))
    rows = df.select(identity(id_col).alias("key"), text.alias("text"), hashed.alias("h"), F.struct(*(F.col(c).alias(n) for c, n in own.items())).alias("row"))
    once = rows.groupBy("key", "text").agg(F.min_by("row", "h").alias("row"))
    return once.join(kept, ["key", "text"], "left_semi").select(*(F.col(f"row.{n}").alias(c) for c, n in own.items()))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
