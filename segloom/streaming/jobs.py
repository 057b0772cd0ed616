"""Recurring jobs as streams (ST1-ST3)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..operators.match import nearest
from ..operators.shared import materialize
from ..operators.sync import one_per_key
from ..sources import buckets


def _versions(spark: SparkSession, target: str) -> list[tuple[int, str]]:
    return buckets.versions(spark, target)


def current_version(spark: SparkSession, target: str) -> int | None:
    """The last complete version; None if there is none."""
    return max((n for n, _ in _versions(spark, target)), default=None)


def read_version(spark: SparkSession, target: str, version: int | None = None) -> DataFrame | None:
    return buckets.read(spark, target, version)


def stream_upsert(stream: DataFrame, target: str, keys: list[str], order_by: str, keep: int = 3, into: int = buckets.BUCKETS) -> DataStreamWriter:
    """ST1. Each micro-batch is upserted into the target, a table in ``into`` buckets (``sources.buckets``).

    A batch reads and writes the buckets of its keys only. A version carries the stream's id and the batch's: a batch
    that runs again after its version was complete does nothing, one that broke off before starts from the same
    version. A new stream goes on from what the target holds. The last ``keep`` versions stay, so readers of the
    previous ones aren't cut off; a target has one writer at a time.
    """

    def one(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        mark = f"{spark.sparkContext.getLocalProperty('sql.streaming.queryId')}-{batch_id}"
        done = _versions(spark, target)
        if any(name.split("-", 1)[1] == mark for _, name in done):
            return
        if done:
            buckets.upsert(batch, target, order_by, mark)
        else:
            buckets.create(one_per_key(batch, keys, order_by), target, keys, into, mark)
        buckets.drop_old(spark, target, keep)

    return stream.writeStream.foreachBatch(one)


def stream_hourly(stream: DataFrame, ts: str, keys: list[str], values: list[str], delay: str = "1 hour") -> DataFrame:
    """ST2. Hourly means and counts; slots later than the delay are dropped, hours appear once complete."""
    hours = stream.withWatermark(ts, delay).groupBy(F.window(ts, "1 hour").alias("w"), *keys)
    return hours.agg(*(F.avg(v).alias(v) for v in values), F.count("*").alias("n")).select(F.col("w.start").alias("hour"), *keys, *values, "n")


def stream_nearest(stream: DataFrame, stations: DataFrame, sites: DataFrame, station: str, site_id: str = "site_id") -> DataFrame:
    """ST3. Readings with the nearest site of their station: (station, geometry) and sites are static.

    The site map is computed once, then joined to the stream by station.
    """
    near = nearest(stations, sites, 1, base_id=station, enr_id=site_id).select(station, site_id, F.col("distance").alias("site_distance"))
    return stream.join(near, station)


def stream_nearest_moving(stream: DataFrame, stations: str, sites: DataFrame, station: str, write: Callable[[DataFrame, int], None], site_id: str = "site_id") -> DataStreamWriter:
    """ST3. The same while stations move, come and go: they are a table in buckets (``sources.buckets``) at this path.

    Each micro-batch takes the table's last version and hands its rows, with their station's nearest site, to
    ``write(rows, batch_id)``. A new version maps only the stations of the buckets that differ from the one before.
    """
    held: dict = {"version": None, "near": None}

    def mapped(rows: DataFrame) -> DataFrame:
        return nearest(rows, sites, 1, base_id=station, enr_id=site_id).select(station, site_id, F.col("distance").alias("site_distance"))

    def one(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        there = [n for n, _ in buckets.versions(spark, stations)]
        if not there:
            raise ValueError(f"{stations} holds no table")
        if held["version"] != there[-1]:
            if held["version"] in there:
                old, new = buckets.changes(spark, stations, held["version"], there[-1])
                near = held["near"].join(old.select(station), station, "left_anti").unionByName(mapped(new))
            else:
                near = mapped(buckets.read(spark, stations, there[-1]))
            held.update(version=there[-1], near=materialize(near, "near"))
        write(batch.join(held["near"], station), batch_id)

    return stream.writeStream.foreachBatch(one)
