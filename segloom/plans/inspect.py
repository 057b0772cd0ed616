"""Inspection of mappings: coverage, features in a box, nearest segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..operators.match import nearest
from ..operators.raster import value_stats

Box = tuple[float, float, float, float]


def coverage(base: DataFrame, mapping: DataFrame, value: str, map_id: str = "way_id") -> DataFrame:
    """I1, R12. (total, covered, uncovered, pct): segments with a mapped value that is not null, at most all."""
    total = base.agg(F.count("*").alias("total"))
    found = mapping.where(F.col(value).isNotNull()).agg(F.count_distinct(map_id).alias("c"))
    both = total.crossJoin(found).select("total", F.least("total", "c").alias("covered"))  # one row each
    pct = F.coalesce(F.round(F.try_divide(F.col("covered") * 100.0, F.col("total")), 1), F.lit(0.0))
    return both.select("total", "covered", (F.col("total") - F.col("covered")).alias("uncovered"), pct.alias("pct"))


def coverage_features(base: DataFrame, mapping: DataFrame, value: str, bbox: Box, limit: int | None = None, map_id: str = "way_id", geom: str = "geometry") -> DataFrame:
    """I2. Segments of a box with a flag ``covered``; a limit takes the smallest ids."""
    inside = base.where(geo.bbox_intersects(geom, geo.kind_of(base.schema[geom].dataType), bbox))
    keys = mapping.where(F.col(value).isNotNull()).select(F.col(map_id).alias("id")).distinct().withColumn("covered", F.lit(True))
    out = inside.join(keys, "id", "left").select("id", geom, F.coalesce("covered", F.lit(False)).alias("covered"))
    return out if limit is None else out.orderBy("id").limit(limit)


def mapping_features(mapping: DataFrame, base: DataFrame, enr: DataFrame, on: str, map_id: str = "way_id", geom: str = "geometry") -> DataFrame:
    """I4, W3. One row a mapped segment: its nearest enrichment row by key, distance and shortest line."""
    kinds = (geo.kind_of(base.schema[geom].dataType), geo.kind_of(enr.schema[geom].dataType))
    a = base.select(F.col("id").alias(map_id), F.col(geom).alias("base_geometry"))
    b = enr.select(on, F.col(geom).alias("enr_geometry"))
    joined = mapping.join(a, map_id).join(b, on)
    measured = joined.withColumns({"distance": geo.distance("base_geometry", "enr_geometry", kinds), "shortest": geo.shortest_line("base_geometry", "enr_geometry", kinds)})
    order = F.struct(F.col("distance").isNull(), "distance", on)
    best = measured.groupBy(map_id).agg(F.min_by(F.struct(on, "distance", "shortest"), order).alias("b"))
    return best.select(map_id, "b.*")


def mapped_segments(mapping: DataFrame, base: DataFrame, map_id: str = "way_id") -> DataFrame:
    """I5. Geometry of the segments that have a mapping row."""
    return base.join(mapping.select(F.col(map_id).alias("id")).distinct(), "id", "left_semi")


def nearest_way(points: DataFrame, base: DataFrame, point_id: str = "point_id", geom: str = "geometry") -> DataFrame:
    """I6. For each query point the nearest segment: (point id, way_id, distance)."""
    segments = base.select(F.col("id").alias("way_id"), geom)
    return nearest(points, segments, 1, base_geom=geom, enr_geom=geom, base_id=point_id, enr_id="way_id").select(point_id, "way_id", "distance")


def bbox_rows(df: DataFrame, geom: str, bbox: Box) -> DataFrame:
    """I8. Rows whose envelope meets the box."""
    return df.where(geo.bbox_intersects(geom, geo.kind_of(df.schema[geom].dataType), bbox))


def bbox_stats(df: DataFrame, geom: str, bbox: Box, columns: list[str]) -> DataFrame:
    """I8. Minimum, maximum and mean of columns over those rows."""
    return value_stats(bbox_rows(df, geom, bbox), columns)
