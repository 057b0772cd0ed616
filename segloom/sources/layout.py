"""Tables laid out along a space-filling curve, of which a box reads few row groups.

Rows are sorted by the curve's key of the middle of their box and carry the key and the box's corners as columns, whose
least and greatest values Parquet keeps for each row group. A box becomes ranges of keys and conditions on the corners;
both reach the scan, which skips the groups that can't hold a row. A one-row table beside the rows keeps the curve's frame
and the largest half width and height, by which a box is widened before it becomes keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import curve

_KEY, _CORNERS = "curve_key", ("curve_x1", "curve_y1", "curve_x2", "curve_y2")
Box = tuple[float, float, float, float]


def write_by_place(df: DataFrame, path: str, box: Column, group_bytes: int = 64 << 20) -> None:
    """Writes df to ``path`` in the order of the curve. ``box``: struct x1, y1, x2, y2 (as ``geo.envelope``), null for rows without a place.

    ``group_bytes`` is the size of a row group. A range partitioning by key and hash deals the rows out, so neither rows
    without a place nor many at one place make a large task.
    """
    spark = df.sparkSession
    boxed = df.select("*", *(box[c].alias(n) for c, n in zip(("x1", "y1", "x2", "y2"), _CORNERS, strict=True)))
    x1, y1, x2, y2 = (F.col(c) for c in _CORNERS)
    e = boxed.agg(F.min(x1), F.min(y1), F.max(x2), F.max(y2), F.max(x2 - x1) / 2, F.max(y2 - y1) / 2).first()
    low, half = ([0.0 if v is None else v for v in e[:4]], [v or 0.0 for v in e[4:]])
    frame = curve.Frame.around(*low)
    spark.createDataFrame([(frame.x, frame.y, frame.side, *half)], "x double, y double, side double, half_width double, half_height double").coalesce(1).write.parquet(f"{path}/frame")
    keyed = boxed.withColumn(_KEY, curve.z_key((x1 + x2) / 2, (y1 + y2) / 2, frame))
    plain = [c for c in df.columns if "map<" not in df.schema[c].dataType.simpleString()]
    keyed.repartitionByRange(F.col(_KEY), F.xxhash64(*plain)).sortWithinPartitions(_KEY).write.option("parquet.block.size", group_bytes).parquet(f"{path}/rows")


def read_box(spark: SparkSession, path: str, box: Box, ranges: int = 32) -> DataFrame:
    """The rows whose box meets this one, borders included; the same as a filter on the whole table."""
    f = spark.read.parquet(f"{path}/frame").first()
    rows = spark.read.parquet(f"{path}/rows")
    wide = (box[0] - f["half_width"], box[1] - f["half_height"], box[2] + f["half_width"], box[3] + f["half_height"])
    found = curve.box_ranges(curve.Frame(f["x"], f["y"], f["side"]), wide, ranges)
    keys = reduce(lambda a, b: a | b, (F.col(_KEY).between(a, b) for a, b in found), F.lit(False))
    x1, y1, x2, y2 = (F.col(c) for c in _CORNERS)
    return rows.where(keys & (x1 <= box[2]) & (x2 >= box[0]) & (y1 <= box[3]) & (y2 >= box[1])).drop(_KEY, *_CORNERS)
