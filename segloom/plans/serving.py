"""Serving views: one row a segment (V1-V7). base: (id, way_id, way_link_index, ...); mappings are keyed by way_id = id."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo

KEYS = ["id", "way_id", "way_link_index"]


def _left(base: DataFrame, mapping: DataFrame) -> DataFrame:
    """Segments with their mapping row; the mapping's columns as they are, but for its key."""
    own = [c for c in mapping.columns if c != "way_id"]
    m = mapping.select(F.col("way_id").alias("__map"), *own)
    return base.select(*(c for c in base.columns if c not in own)).join(m, F.col("id") == F.col("__map"), "left").drop("__map")


def view_pollution(base: DataFrame, mapping: DataFrame, enrichment: DataFrame, arrays: list[str], time_col: str = "forecast_time") -> DataFrame:
    """V1. Every segment with its arrays and the forecast's first and last hour over the whole enrichment."""
    usable = enrichment.where(F.col(arrays[0]).isNotNull() & F.col(time_col).isNotNull())
    hours = F.make_dt_interval(hours=F.col("n") - 1)
    span = usable.agg(F.min(time_col).alias("forecast_start"), F.max(F.size(arrays[0])).alias("n")).select("forecast_start", (F.col("forecast_start") + hours).alias("forecast_end"))
    return _left(base, mapping.select("way_id", *arrays)).crossJoin(F.broadcast(span)).select(*KEYS, "forecast_start", "forecast_end", *arrays)  # one row


def view_defaults(base: DataFrame, mapping: DataFrame, columns: dict[str, float]) -> DataFrame:
    """V2. Mapped values, or the default of each."""
    return _left(base, mapping.select("way_id", *columns)).select(*KEYS, *(F.coalesce(c, F.lit(d)).alias(c) for c, d in columns.items()))


def view_count_flag(base: DataFrame, mapping: DataFrame, count: str, flag: str) -> DataFrame:
    """V3. A count, 0 where nothing is mapped, and whether it is positive."""
    n = F.coalesce(count, F.lit(0))
    return _left(base, mapping.select("way_id", count)).select(*KEYS, n.alias(count), (n > 0).alias(flag))


def view_hourly_array(base: DataFrame, mapping: DataFrame, enrichment: DataFrame, link: str, value: str, out: str, missing: float = -1.0) -> DataFrame:
    """V4. 24 values by hour of day. Arrays are built once for each link, not for each segment and hour."""
    rows = enrichment.where(F.col("hour").between(0, 23)).groupBy(link).agg(F.map_from_entries(F.collect_list(F.struct("hour", value))).alias("m"))
    hours = F.sequence(F.lit(0), F.lit(23))
    arrays = rows.select(link, F.transform(hours, lambda h: F.coalesce(F.try_element_at("m", h), F.lit(missing))).alias(out))
    joined = _left(base, mapping.select("way_id", link)).join(arrays, link, "left")
    return joined.select(*KEYS, F.coalesce(out, F.array_repeat(F.lit(missing), 24)).alias(out))


def view_json_count(base: DataFrame | None, mapping: DataFrame, column: str, count: str) -> DataFrame:
    """V5. A JSON list, ``[]`` where nothing is mapped, and its length.

    Without a base the mapping has a row for every segment, with its keys and an array in place of the list; it isn't shuffled.
    """
    if base is None:
        return mapping.select(*KEYS, F.to_json(column).alias(column), F.size(column).alias(count))
    return _left(base, mapping.select("way_id", column)).select(*KEYS, F.coalesce(column, F.lit("[]")).alias(column), F.coalesce(F.json_array_length(column), F.lit(0)).alias(count))


def view_hourly_forecast(base: DataFrame, mapping: DataFrame, enrichment: DataFrame, station: str, values: list[str], as_of: datetime | Column, time_col: str = "timestamp", missing: float = -1.0) -> DataFrame:
    """V6. Gap-filled hourly arrays over the forecast's span, and the values of the hour of ``as_of``.

    One reading a station and hour is used (the earliest). Arrays are built once for each station and then joined to
    segments; a missing hour is ``missing`` in the array and null as current value.
    """
    now = F.lit(as_of) if isinstance(as_of, datetime) else as_of
    hour = F.date_trunc("hour", time_col)
    span = enrichment.agg(F.date_trunc("hour", F.min(time_col)).alias("forecast_start"), F.date_trunc("hour", F.max(time_col)).alias("forecast_end"))
    once = enrichment.groupBy(station, hour.alias("h")).agg(*(F.min_by(v, time_col).alias(v) for v in values))
    maps = once.groupBy(station).agg(F.map_from_entries(F.collect_list(F.struct("h", F.struct(*values)))).alias("m"))
    slots = F.sequence("forecast_start", "forecast_end", F.expr("interval 1 hour"))

    def series(v: str) -> Column:
        return F.transform(slots, lambda s: F.coalesce(F.try_element_at("m", s)[v], F.lit(missing)))

    filled = {f"{v}_hourly": series(v) for v in values}
    arrays = maps.crossJoin(F.broadcast(span)).select(station, *(c.alias(n) for n, c in filled.items()))
    empty = {f"{v}_hourly": F.transform(slots, lambda s: F.lit(missing)) for v in values}
    at = F.greatest(F.lit(0), F.floor((F.unix_timestamp(F.date_trunc("hour", now)) - F.unix_timestamp("forecast_start")) / 3600)).cast("int")
    joined = _left(base, mapping).join(arrays, station, "left").crossJoin(F.broadcast(span))
    joined = joined.withColumns({n: F.coalesce(n, c) for n, c in empty.items()})
    extra = [c for c in mapping.columns if c not in ("way_id", station)]
    return joined.select(*KEYS, *extra, "forecast_start", "forecast_end", *filled, *(F.nullif(F.get(f"{v}_hourly", at), F.lit(missing)).alias(v) for v in values))


def view_snapshot(base: DataFrame, mapping: DataFrame, enrichment: DataFrame, station: str, at: datetime | Column, columns: list[str], time_col: str = "timestamp") -> DataFrame:
    """V7. Mapped segments with their station's reading at exactly this time, and their bearing."""
    when = F.lit(at) if isinstance(at, datetime) else at
    readings = enrichment.where(F.col(time_col) == when).select(F.col(station).alias("__s"), time_col, *columns)
    m = mapping.select(F.col("way_id").alias("__map"), station)
    joined = base.join(m, F.col("id") == F.col("__map")).join(readings, F.col(station) == F.col("__s"))
    return joined.select(*KEYS, station, time_col, *columns, geo.azimuth_degrees(geo.start_point("geometry"), geo.end_point("geometry")).alias("bearing_deg"))
