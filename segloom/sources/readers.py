"""Readers (S1-S8). Files of one call are read in parallel; partitions take the place of chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geo
from . import clouds


def read_table(spark: SparkSession, path: str | list[str], kind: str, schema: T.StructType | str | None = None, **options) -> DataFrame:
    """S1-S3. parquet, csv (header), tsv (a real tab) or json (whole documents, objects or lists)."""
    reader = spark.read.options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    if kind == "parquet":
        return reader.parquet(*([path] if isinstance(path, str) else path))
    if kind in ("csv", "tsv"):
        reader = reader.option("header", True)
        if schema is None:
            reader = reader.option("inferSchema", True)
        return reader.csv(path, sep=options.get("sep", "\t" if kind == "tsv" else ","))
    if kind == "json":
        return reader.json(path, multiLine=True)
    raise ValueError(f"unknown kind {kind}")


def _feature_schema(props: dict[str, str]) -> T.StructType:
    fields = ", ".join(f"`{k}`: {t}" for k, t in props.items())
    return T.StructType.fromDDL(f"features ARRAY<STRUCT<properties: STRUCT<{fields}>, geometry: STRUCT<type: STRING, coordinates: STRING>>>")


def read_features(spark: SparkSession, path: str, props: dict[str, str], srid: int = 4326, target_srid: int | None = None, kind: str = "point") -> tuple[DataFrame, DataFrame]:
    """S4, S5. (rows, bad rows) of GeoJSON collections, gzip included: properties, and ``geometry`` in the target system.

    Features without a geometry of this kind are the bad rows.
    """
    raw = spark.read.schema(_feature_schema(props)).json(path, multiLine=True).select(F.explode("features").alias("f"))
    wanted = {"point": "Point", "line": "LineString", "polygon": "Polygon"}[kind]
    depth = {"point": "ARRAY<DOUBLE>", "line": "ARRAY<ARRAY<DOUBLE>>", "polygon": "ARRAY<ARRAY<ARRAY<DOUBLE>>>"}[kind]
    coordinates = F.when(F.col("f.geometry.type") == wanted, F.from_json("f.geometry.coordinates", depth))

    def pair(c: Column) -> Column:
        return F.when(F.get(c, F.lit(0)).isNotNull() & F.get(c, F.lit(1)).isNotNull(), F.struct(F.get(c, F.lit(0)).alias("x"), F.get(c, F.lit(1)).alias("y")))

    shape = pair(coordinates) if kind == "point" else F.transform(coordinates, pair) if kind == "line" else F.transform(coordinates, lambda r: F.transform(r, pair))
    rows = raw.select(*(F.col(f"f.properties.{p}").alias(p) for p in props), geo.reproject(shape, srid, target_srid or srid, kind).alias("geometry"), F.to_json("f").alias("feature"))
    return rows.where("geometry is not null").drop("feature"), rows.where("geometry is null").select("feature")


def feed_links(spark: SparkSession, path: str, suffix: str = ".zip") -> DataFrame:
    """S6. (href) of the links with this ending in the first entry of an XML feed."""
    schema = "entry ARRAY<STRUCT<link: ARRAY<STRUCT<_href: STRING>>>>"
    feed = spark.read.format("xml").option("rowTag", "feed").option("ignoreNamespace", True).schema(schema).load(path)
    return feed.select(F.explode(F.get("entry", F.lit(0))["link"]).alias("l")).select(F.col("l._href").alias("href")).where(F.col("href").endswith(suffix))


def _xyz(line: Column) -> list[Column]:
    parts = F.filter(F.split(F.translate(line, ",;\t", "   "), " "), lambda p: p != "")
    return [F.get(parts, F.lit(i)).try_cast("double").alias(n) for i, n in enumerate("xyz")]


def read_xyz(spark: SparkSession, path: str) -> DataFrame:
    """S7. (x, y, z) of text lines, separated by blanks or commas; short or unreadable lines are skipped."""
    return spark.read.text(path).select(*_xyz(F.col("value"))).where("x is not null and y is not null and z is not null")


def read_xyz_zip(spark: SparkSession, path: str, every: bool = False, block: int = clouds.BLOCK) -> DataFrame:
    """S8. The same from the first ``.xyz`` member of each zip archive, or from all of them; a task a member, as a stream."""
    raw = clouds.read_archive_lines(spark, path, ".xyz", every, block)
    return raw.select("path", *_xyz(F.trim("value"))).where("x is not null and y is not null and z is not null")
