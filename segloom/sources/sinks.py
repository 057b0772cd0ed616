"""Sinks (S17, S18, S20)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geo


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in its types; columns that df lacks are null, others are left out."""

    def one(f: T.StructField):
        if f.name not in df.columns:
            return F.lit(None).cast(f.dataType).alias(f.name)
        nested = isinstance(df.schema[f.name].dataType, (T.StructType, T.ArrayType, T.MapType)) and isinstance(f.dataType, T.StringType)
        return (F.to_json(f.name) if nested else F.col(f.name).cast(f.dataType)).alias(f.name)

    return df.select(*(one(f) for f in schema.fields))


def append_raw(df: DataFrame, path: str, schema: T.StructType) -> None:
    """S17. Append to a raw table; arrays and structs for text columns become JSON."""
    conform(df, schema).write.mode("append").parquet(path)


def copy_common(src: DataFrame, dst_schema: T.StructType, exclude: set[str] = frozenset()) -> DataFrame:
    """S18. The columns that both have, in the destination's types, without the excluded ones."""
    return src.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in dst_schema.fields if f.name in src.columns and f.name not in exclude))


def to_geojson(df: DataFrame, geom: str, props: list[str]) -> DataFrame:
    """S20. (value): one GeoJSON feature a row."""
    feature = F.struct(F.lit("Feature").alias("type"), geo.geojson_geometry(geom, geo.kind_of(df.schema[geom].dataType)).alias("geometry"), F.struct(*props).alias("properties"))
    return df.select(F.to_json(feature, {"ignoreNullFields": "false"}).alias("value"))


def write_geojson_lines(df: DataFrame, path: str, geom: str, props: list[str]) -> None:
    to_geojson(df, geom, props).write.text(path)
