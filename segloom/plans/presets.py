"""MATCH x REDUCE x PROJECT as one call, and its named presets."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo
from ..operators import match as m
from ..operators import reduce as r
from ..operators.sync import upsert

#: Preset (with its other names) to match and reduce.
PRESETS: dict[str, tuple[dict, dict]] = {
    "knn": ({"type": "nearest", "k": 1}, {"type": "none"}),
    "nearest_k": ({"type": "nearest"}, {"type": "none"}),
    "within_distance": ({"type": "within"}, {"type": "none"}),
    "intersection": ({"type": "intersects"}, {"type": "none"}),
    "aggregate_within_distance": ({"type": "within", "keep_unmatched": True}, {"type": "agg"}),
    "idw": ({"type": "nearest", "k": 4}, {"type": "idw"}),
    "attribute_join": ({"type": "key"}, {"type": "none"}),
}
ALIASES = {
    "nearest_neighbour": "knn", "nearest_neighbor": "knn", "nearest_station": "knn", "inverse_distance": "idw", "inverse_distance_weighting": "idw", "k_nearest": "nearest_k", "knn_multiple": "nearest_k",
    "buffer_aggregate": "aggregate_within_distance", "aggregate_buffer": "aggregate_within_distance", "id_join": "attribute_join", "key_join": "attribute_join",
}


def tidy_filter(text: str) -> str:
    """P8. A condition without a leading WHERE and trailing semicolons."""
    return re.sub(r"^\s*where\s+", "", text.strip().rstrip(";").rstrip(), flags=re.I)


def _where(df: DataFrame, condition: Column | str | None) -> DataFrame:
    if condition is None:
        return df
    return df.where(tidy_filter(condition) if isinstance(condition, str) else condition)


def map_to_base(
    base: DataFrame,
    enrichment: DataFrame | None,
    match: dict,
    reduce: dict | None = None,
    project: dict[str, Column | str] | None = None,
    staging: DataFrame | None = None,
    base_filter: Column | str | None = None,
    enrichment_filter: Column | str | None = None,
    base_id: str = "id",
    enr_id: str = "id",
    base_geom: str = "geometry",
    enr_geom: str = "geometry",
    distance_alias: str = "distance",
) -> DataFrame:
    """M10. Enrichment rows mapped to base segments.

    match: ``type`` nearest (k, order_by, bound, small_rows), within (distance, predicate, bounded, keep_unmatched, limit),
    intersects (predicate, keep_unmatched, cell) or key (base_col, enr_col, how, columns). reduce: ``type`` none, agg (aggs: name to aggregate),
    lists (columns, order, keep: arrays of the points within the distance, one row a segment; within only) or idw (values or arrays, power, epsilon, skip_null_weights; nearest only). Both filters apply before the join, so
    an outer join still keeps base rows. project: name to expression. Without an enrichment, staging takes
    its place (M17).
    """
    enr = staging if enrichment is None else enrichment
    if enr is None:
        raise ValueError("no enrichment and no staging rows")
    match, reduce = dict(match), dict(reduce or {"type": "none"})
    kind, how = match.pop("type"), reduce.pop("type", "none")
    base, enr = _where(base, base_filter), _where(enr, enrichment_filter)
    spatial = {"base_geom": base_geom, "enr_geom": enr_geom, "base_id": base_id, "enr_id": enr_id}
    if how == "idw" and kind != "nearest":
        raise ValueError("inverse distance weighting needs a nearest match")
    if how == "idw" and bool(reduce.get("values")) == bool(reduce.get("arrays")):
        raise ValueError("inverse distance weighting takes value columns or array columns, not both")
    if how == "lists" and (kind != "within" or match.get("predicate") is not None or match.get("limit") is not None):
        raise ValueError("lists need a match within a distance alone")
    if how == "lists":
        pairs = m.lists_within(base, enr, match.get("distance", 500), reduce["columns"], reduce.get("order", reduce["columns"]), reduce.get("keep"), distance=distance_alias, **spatial)
    elif kind == "nearest":
        pairs = m.nearest(base, enr, match.get("k", 1), match.get("order_by"), distance=distance_alias, bound=match.get("bound"), small_rows=match.get("small_rows", m.SMALL_ROWS), **spatial)
    elif kind == "within":
        pairs = m.within(base, enr, match.get("distance", 500), match.get("predicate"), match.get("keep_unmatched", False), match.get("limit"), distance=distance_alias, bounded=match.get("bounded", False), homes=how == "agg", **spatial)
    elif kind == "intersects":
        pairs = m.intersects(base, enr, match.get("predicate"), match.get("keep_unmatched", False), match.get("cell"), **spatial)
    elif kind == "key":
        pairs = m.key_join(base, enr, match["base_col"], match["enr_col"], match.get("how", "inner"), match.get("columns"))
    else:
        raise ValueError(f"unknown match {kind}")
    if how == "agg":
        home = [c for c in m.HOME if c in pairs.columns]
        out = r.reduce_agg(pairs, [*home, base_id], reduce["aggs"]).drop(*home)
    elif how == "idw":
        options = {k: v for k, v in reduce.items() if k in ("power", "epsilon")}
        if reduce.get("arrays"):
            out = r.idw_arrays(pairs, base_id, reduce["arrays"], distance=distance_alias, **options)
        else:
            out = r.idw(pairs, base_id, reduce["values"], skip_null_weights=reduce.get("skip_null_weights", False), distance=distance_alias, **options)
    elif how in ("none", "lists"):
        out = pairs
    else:
        raise ValueError(f"unknown reduce {how}")
    if project is None:
        return out
    return out.select(*((F.expr(e) if isinstance(e, str) else e).alias(n) for n, e in project.items()))


def map_preset(preset: str, base: DataFrame, enrichment: DataFrame, match: dict | None = None, reduce: dict | None = None, **options) -> DataFrame:
    """A named preset with its defaults: 500 m within, 50 m to aggregate, the 4 nearest to interpolate."""
    name = ALIASES.get(preset, preset)
    if name not in PRESETS:
        raise ValueError(f"unknown preset {preset}")
    own_match, own_reduce = PRESETS[name]
    defaults = {"distance": 50} if name == "aggregate_within_distance" else {}
    return map_to_base(base, enrichment, defaults | own_match | (match or {}), own_reduce | (reduce or {}), **options)


def one_row_per_base(match: dict, reduce: dict | None) -> bool:
    """M18. Whether a mapping has at most one row a segment."""
    how = (reduce or {}).get("type", "none")
    return how in ("agg", "idw", "lists") or (match["type"] == "nearest" and match.get("k", 1) == 1)


def store_mapping(target: DataFrame, rows: DataFrame, match: dict, reduce: dict | None, map_id: str = "way_id") -> DataFrame:
    """M18. One row a segment is upserted on it, others are appended."""
    if one_row_per_base(match, reduce):
        return upsert(target, rows, [map_id], [c for c in target.columns if c != map_id])
    return target.unionByName(rows.select(*target.columns))


def map_sql(spark: SparkSession, sql: str, **dataframes: DataFrame) -> DataFrame:
    """M13. SQL over named DataFrames, given as ``{name}`` in the text."""
    return spark.sql(sql, **dataframes)


def with_geometry(df: DataFrame, target: str, planar: str, geographic: str, srid: int) -> DataFrame:
    """M12. The planar geometry, or where it is null the projected geographic one."""
    kind = geo.kind_of(df.schema[planar].dataType)
    return df.withColumn(target, F.coalesce(F.col(planar), geo.reproject(geographic, 4326, srid, kind)))
