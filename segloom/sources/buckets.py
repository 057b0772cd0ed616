"""A table in buckets by key, so that an upsert or a sync rewrites only the buckets that it changes.

A bucket is a hash of the key. Below the target, ``data`` has a folder for each write with the buckets that it wrote, and
``manifest`` a table for each version: for every bucket the folder it lies in, its rows and a digest of them, which does
not depend on their order. A version exists once its manifest does; it is one file and comes last, so a write that broke
off leaves the version before it. Choose ``buckets`` so that one is a good size for a task, about a GB.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.sync import one_per_key, upsert_changed

BUCKETS = 64
_FOLDER = "bucket__"


def versions(spark: SparkSession, target: str) -> list[tuple[int, str]]:
    """(number, folder name) of the complete versions, by Hadoop's file system, in order."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{target}/manifest")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    done = [s.getPath().getName() for s in fs.listStatus(path) if fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
    return sorted((int(n[2:].split("-")[0]), n) for n in done if n.startswith("v="))


def manifest(spark: SparkSession, target: str, version: int | None = None) -> list:
    """(bucket, folder, rows, digest, keys, schema) of each bucket of a version, by default the last; empty without one."""
    found = [name for n, name in versions(spark, target) if version in (None, n)]
    return spark.read.parquet(f"{target}/manifest/{found[-1]}").orderBy("bucket").collect() if found else []


def read(spark: SparkSession, target: str, version: int | None = None, only: set[int] | None = None) -> DataFrame | None:
    """The rows of a version, or of some of its buckets; None if it isn't there."""
    held = manifest(spark, target, version)
    return _read(spark, target, held, only) if held else None


def _read(spark: SparkSession, target: str, held: list, only: set[int] | None) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(held[0]["schema"]))
    paths = [f"{target}/data/{r['folder']}/{_FOLDER}={r['bucket']}" for r in held if r["rows"] and (only is None or r["bucket"] in only)]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _digests(df: DataFrame, columns: list[str], bucket: Column) -> DataFrame:
    """(bucket, rows, digest): sums of two hashes of the rows."""
    columns = [F.to_json(c) if "map<" in df.schema[c].dataType.simpleString() else F.col(c) for c in columns]
    sums = [F.sum(F.xxhash64(F.lit(seed), *columns).cast("decimal(38,0)")).cast("string") for seed in (0, 1)]
    return df.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("rows"), F.concat_ws(":", *sums).alias("digest"))


def _write(df: DataFrame, target: str, keys: list[str], name: str, buckets: int) -> list:
    """Writes the rows by bucket; their digests, of what was written."""
    path = f"{target}/data/{name}"
    df.withColumn(_FOLDER, _bucket(keys, buckets)).repartition(_FOLDER).write.partitionBy(_FOLDER).mode("overwrite").parquet(path)
    wrote = df.sparkSession.read.schema(T.StructType([*df.schema, T.StructField(_FOLDER, T.IntegerType())])).parquet(path)
    return _digests(wrote, df.columns, F.col(_FOLDER)).collect()


def _commit(spark: SparkSession, target: str, number: int, mark: str, schema: T.StructType, keys: list[str], held: dict[int, tuple], buckets: int) -> None:
    rows = [(b, *held.get(b, (None, 0, "")), keys, schema.json()) for b in range(buckets)]
    kind = "bucket int, folder string, rows long, digest string, keys array<string>, schema string"
    spark.createDataFrame(rows, kind).coalesce(1).write.mode("overwrite").parquet(f"{target}/manifest/v={number:09}-{mark}")


def create(df: DataFrame, target: str, keys: list[str], buckets: int = BUCKETS, mark: str = "create") -> None:
    """Version 0: the table's rows, whose keys are unique."""
    wrote = _write(df, target, keys, f"v={0:09}-{mark}", buckets)
    _commit(df.sparkSession, target, 0, mark, df.schema, keys, {r["bucket"]: (f"v={0:09}-{mark}", r["rows"], r["digest"]) for r in wrote}, buckets)


def _next(target: str, batch: DataFrame, old: DataFrame, new: DataFrame, held: list, touched: set[int], mark: str) -> list[int]:
    """The version after the last: the touched buckets hold ``new``, all others what they held. The buckets that differ."""
    spark, keys = batch.sparkSession, list(held[0]["keys"])
    number = versions(spark, target)[-1][0] + 1
    name = f"v={number:09}-{mark}"
    wrote = {r["bucket"]: (name, r["rows"], r["digest"]) for r in _write(new, target, keys, name, len(held))} if touched else {}
    after = {r["bucket"]: (r["folder"], r["rows"], r["digest"]) for r in held}
    changed = [b for b in sorted(touched) if wrote.get(b, (name, 0, ""))[1:] != after[b][1:]]
    _commit(spark, target, number, mark, old.schema, keys, after | {b: wrote.get(b, (None, 0, "")) for b in changed}, len(held))
    return changed


def upsert(batch: DataFrame, target: str, order_by: str | None = None, mark: str = "upsert") -> list[int]:
    """U1, ST1. The next version: new keys inserted, rows that differ updated. Returns the buckets that changed.

    Only the buckets of the batch's keys are read, joined and written; of those that come out equal the old files stay.
    """
    spark = batch.sparkSession
    held = manifest(spark, target)
    if not held:
        raise ValueError(f"{target} holds no table")
    keys = list(held[0]["keys"])
    touched = {r[0] for r in batch.select(_bucket(keys, len(held))).distinct().collect()}  # no more than buckets
    old = _read(spark, target, held, touched)
    return _next(target, batch, old, upsert_changed(old, batch, keys, order_by=order_by), held, touched, mark)


def sync(source: DataFrame, target: str, order_by: str | None = None, mark: str = "sync") -> list[int]:
    """U4, U9. The next version: the source's rows as a whole, those of other keys gone. Returns the buckets that changed.

    One aggregation of the source gives its digests; only buckets whose digest differs from the manifest's are written.
    """
    spark = source.sparkSession
    held = manifest(spark, target)
    if not held:
        raise ValueError(f"{target} holds no table")
    keys = list(held[0]["keys"])
    schema = _read(spark, target, held, set()).schema
    fresh = one_per_key(source, keys, order_by).select(*(F.col(f.name).cast(f.dataType) for f in schema))
    now = {r["bucket"]: (r["rows"], r["digest"]) for r in _digests(fresh, fresh.columns, _bucket(keys, len(held))).collect()}
    touched = {r["bucket"] for r in held if now.get(r["bucket"], (0, "")) != (r["rows"], r["digest"])}
    rows = fresh.where(_bucket(keys, len(held)).isin(*touched)) if touched else fresh.limit(0)
    return _next(target, source, fresh, rows, held, touched, mark)


def changes(spark: SparkSession, target: str, old: int, new: int) -> tuple[DataFrame, DataFrame]:
    """U10. The rows of two versions in the buckets that differ between them: all that a change set must compare."""
    a, b = manifest(spark, target, old), manifest(spark, target, new)
    only = {x["bucket"] for x, y in zip(a, b, strict=True) if (x["rows"], x["digest"]) != (y["rows"], y["digest"])}
    return _read(spark, target, a, only), _read(spark, target, b, only)


def drop_old(spark: SparkSession, target: str, keep: int) -> None:
    """Removes all versions but the last ``keep``, and the files that none of those needs."""
    done = versions(spark, target)
    stay = {r["folder"] for n, _ in done[-keep:] for r in manifest(spark, target, n)}
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    data = hadoop(f"{target}/data")
    fs = data.getFileSystem(spark._jsc.hadoopConfiguration())
    for _, name in done[:-keep]:
        fs.delete(hadoop(f"{target}/manifest/{name}"), True)
    for s in fs.listStatus(data):
        if s.getPath().getName() not in stay:
            fs.delete(s.getPath(), True)
