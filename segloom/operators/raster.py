"""Rasters as tables of cells (col, row, z), and profiles along lines."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geo
from .reduce import collected

NO_DATA = -9999.0
#: Cells along a side of a tile.
TILE = 32
#: Samples that a task makes at once; a longer line's are made together.
SAMPLES = 1 << 17


def to_cells(points: DataFrame, pixel: float, order_by: str, origin: tuple[float, float] | None = None) -> DataFrame:
    """X1. (col, row, z) from (x, y, z): rows go down from the top; of points in one cell the last one stays.

    The origin (left, top) defaults to the points' own extent. No-data values become null.
    """
    if origin is None:
        e = points.agg(F.min("x"), F.max("y")).first()
        origin = (e[0] or 0.0, e[1] or 0.0)
    col, row = F.floor((F.col("x") - origin[0]) / pixel), F.floor((origin[1] - F.col("y")) / pixel)
    z = F.nullif(F.max_by("z", order_by), F.lit(NO_DATA))
    return points.where("x is not null and y is not null").groupBy(col.alias("col"), row.alias("row")).agg(z.alias("z"))


def dedup_tiles(cells: DataFrame, tile: int = 1000, load: str = "load") -> DataFrame:
    """X2. Cells with (tile_col, tile_row, tile_hash); of loads with an equal tile only the first keeps it."""
    placed = cells.withColumns({"tile_col": F.expr(f"floor(col / {tile})"), "tile_row": F.expr(f"floor(row / {tile})")})
    # order-free digest of a tile: sums of two hashes of its cells, and their number
    parts = [F.sum(F.xxhash64("col", "row", "z").cast("decimal(20,0)")), F.sum(F.hash("z", "col", "row").cast("long")), F.count("*")]
    hashes = placed.groupBy(load, "tile_col", "tile_row").agg(F.md5(F.concat_ws("|", *(p.cast("string") for p in parts))).alias("tile_hash"))
    first = hashes.groupBy("tile_col", "tile_row", "tile_hash").agg(F.min(load).alias(load))
    return placed.join(first, [load, "tile_col", "tile_row"])


def value_at(points: DataFrame, cells: DataFrame, pixel: float, origin: tuple[float, float], geom: str = "geometry") -> DataFrame:
    """X3. Points with the z of their cell, null outside: an equi-join on the cell."""
    col, row = F.floor((F.col(geom)["x"] - origin[0]) / pixel), F.floor((origin[1] - F.col(geom)["y"]) / pixel)
    keyed = points.withColumns({"__col": col, "__row": row})
    found = cells.select(F.col("col").alias("__col"), F.col("row").alias("__row"), "z")
    return keyed.join(found, ["__col", "__row"], "left").drop("__col", "__row")


def _along(offsets: np.ndarray, x: np.ndarray, y: np.ndarray, length: np.ndarray, last: np.ndarray, step: float):
    """(line, i, x, y) of the samples 0 to ``last`` of lines that have a length; offsets: where each line's points begin."""
    d = np.hypot(np.diff(x), np.diff(y))  # by point; that of a line's last point isn't used
    line = np.repeat(np.arange(len(last)), last + 1)
    first = np.cumsum(last + 1) - last - 1
    i = np.arange(len(line)) - first[line]
    wanted = np.minimum(1.0, i * step / length[line]) * length[line]
    edge = offsets[line].astype(np.int64)
    done = np.zeros(len(line))
    for k in np.flatnonzero(np.diff(offsets) > 2).tolist():
        a, z, own = int(offsets[k]), int(offsets[k + 1]) - 1, slice(int(first[k]), int(first[k] + last[k] + 1))
        ends = np.cumsum(d[a:z])
        at = np.minimum(np.searchsorted(ends, wanted[own]), z - a - 1)
        edge[own], done[own] = a + at, np.concatenate([[0.0], ends])[at]
    size = d[edge]
    t = np.where(size == 0, 0.0, (wanted - done) / np.where(size == 0, 1.0, size))
    beyond = done + size < wanted  # by rounding: the end
    out = [np.where(beyond, v[edge + 1], v[edge] + t * (v[edge + 1] - v[edge])) for v in (x, y)]
    return line, i, *out


def sample_lines(df: DataFrame, geom: str, step: float, columns: list[str] | None = None) -> DataFrame:
    """X4. (i, point) along each line every ``step``, the end included; lines without length give no rows.

    ``columns``: those of df that each sample carries along with the line's length, by default all.
    """
    carried = [c for c in (df.columns if columns is None else columns) if c not in ("length", "i", "point")]
    lines = df.select(*carried, geo.length(geom).alias("length"), F.col(geom).alias("__line")).where("length > 0")
    counted = lines.withColumn("__last", F.greatest(F.lit(1), F.ceil(F.col("length") / step).cast("int")))

    def run(batches):
        for b in batches:
            kept = b.select([*carried, "length"])
            g, length, last = b.column("__line"), b.column("length").to_numpy(), b.column("__last").to_numpy().astype(np.int64)
            offsets, x, y = g.offsets.to_numpy(), *(g.values.field(c).to_numpy(zero_copy_only=False) for c in ("x", "y"))
            turn = np.cumsum(last + 1) // SAMPLES
            cuts = np.flatnonzero(np.diff(turn, prepend=turn[:1])).tolist()
            for a, z in zip([0, *cuts], [*cuts, len(last)], strict=True):
                if a == z:
                    continue
                at, end = int(offsets[a]), int(offsets[z])
                line, i, px, py = _along(offsets[a : z + 1] - at, x[at:end], y[at:end], length[a:z], last[a:z], step)
                for k in range(0, len(line), SAMPLES):
                    part = slice(k, k + SAMPLES)
                    own = kept.take(pa.array(line[part] + a))
                    point = pa.StructArray.from_arrays([pa.array(px[part]), pa.array(py[part])], ["x", "y"])
                    yield pa.RecordBatch.from_arrays([*own.columns, pa.array(i[part], pa.int32()), point], names=[*own.schema.names, "i", "point"])

    point = T.StructType([T.StructField(c, T.DoubleType()) for c in ("x", "y")])
    fields = [*counted.select(*carried, "length").schema.fields, T.StructField("i", T.IntegerType()), T.StructField("point", point)]
    return counted.mapInArrow(run, T.StructType(fields))


def to_tiles(cells: DataFrame, tile: int = TILE) -> DataFrame:
    """(tile_col, tile_row, heights): a row a tile, its heights row by row in one array, null where there is no cell.

    Cells are gathered into rows of a tile and those into the tile, so both groupings have a bounded number of values.
    """
    parts = {"tile_col": F.floor(F.col("col") / tile), "tile_row": F.floor(F.col("row") / tile)}
    placed = cells.select(*(c.alias(n) for n, c in parts.items()), F.pmod("row", F.lit(tile)).alias("r"), F.pmod("col", F.lit(tile)).alias("c"), F.col("z").cast("double").alias("z"))
    rows = placed.groupBy(*parts, "r").agg(F.array(*(F.max(F.when(F.col("c") == k, F.col("z"))) for k in range(tile))).alias("zs"))
    none = F.array_repeat(F.lit(None).cast("double"), tile)
    return rows.groupBy(*parts).agg(F.flatten(F.array(*(F.coalesce(F.max(F.when(F.col("r") == k, F.col("zs"))), none) for k in range(tile)))).alias("heights"))


def heights_along(samples: DataFrame, tiles: DataFrame, pixel: float, origin: tuple[float, float], line_id: str, point: str = "point", tile: int = TILE) -> DataFrame:
    """(line_id, heights): for each line the (i, z) of its samples that have data, in order of i.

    A line's samples in one tile travel as one row, before and after they meet the tile; lines without data have no row.
    """
    col, row = F.floor((F.col(point)["x"] - origin[0]) / pixel), F.floor((origin[1] - F.col(point)["y"]) / pixel)
    parts = {"tile_col": F.floor(col / tile), "tile_row": F.floor(row / tile)}
    offset = F.pmod(row, F.lit(tile)) * tile + F.pmod(col, F.lit(tile))
    grouped = samples.groupBy(line_id, *(c.alias(n) for n, c in parts.items())).agg(F.collect_list(F.struct("i", offset.cast("int").alias("at"))).alias("spots"))
    met = grouped.join(tiles, list(parts))
    read = F.filter(F.transform("spots", lambda s: F.struct(s["i"].alias("i"), F.get("heights", s["at"]).alias("z"))), lambda s: s["z"].isNotNull() & (s["z"] != NO_DATA))
    return met.select(line_id, read.alias("part")).where(F.size("part") > 0).groupBy(line_id).agg(F.array_sort(F.flatten(F.collect_list("part"))).alias("heights"))


def elevation_stats(lines: DataFrame, cells: DataFrame, pixel: float, origin: tuple[float, float], step: float = 10.0, line_id: str = "id", geom: str = "geometry") -> DataFrame:
    """X5. (way_id, total_ascent, total_descent, max_slope, avg_slope, sample_count) of every line.

    Slopes divide by the step, also for the shorter last one. Lines without geometry, length or data get zeros. Of
    cells that share a place the highest counts.
    """
    samples = sample_lines(lines, geom, step, [line_id]).select(line_id, "i", "point")
    found = heights_along(samples, to_tiles(cells), pixel, origin, line_id)
    n = F.size("heights")
    steps = F.zip_with(F.slice("heights", 2, F.greatest(n - 1, F.lit(0))), F.slice("heights", 1, F.greatest(n - 1, F.lit(0))), lambda b, a: b["z"] - a["z"])
    stats = found.select(line_id, steps.alias("dz")).select(
        line_id,
        F.aggregate("dz", F.lit(0.0), lambda t, v: t + F.greatest(v, F.lit(0.0))).alias("up"),
        F.aggregate("dz", F.lit(0.0), lambda t, v: t + F.greatest(-v, F.lit(0.0))).alias("down"),
        F.coalesce(F.array_max(F.transform("dz", F.abs)), F.lit(0.0)).alias("rise"),
        F.size("dz").cast("long").alias("n"),
    )
    all_ = lines.select(line_id, geo.length(geom).alias("length")).join(stats, line_id, "left")
    up, down = F.coalesce("up", F.lit(0.0)), F.coalesce("down", F.lit(0.0))
    return all_.select(
        F.col(line_id).alias("way_id"),
        up.alias("total_ascent"),
        down.alias("total_descent"),
        (F.coalesce("rise", F.lit(0.0)) / step).alias("max_slope"),
        F.when(F.col("length") > 0, (up + down) / F.col("length")).otherwise(0.0).alias("avg_slope"),
        F.coalesce("n", F.lit(0)).alias("sample_count"),
    )


def elevation_profile(lines: DataFrame, cells: DataFrame, pixel: float, origin: tuple[float, float], most: float = 100.0, srid: int | None = None, line_id: str = "id", geom: str = "geometry") -> DataFrame:
    """X6. (way_id, elevation_profile): a JSON list of x, y, z along the line, cut to edges of at most ``most``.

    With an srid the coordinates are given in degrees. Places without data are left out, and lines without any.
    """
    dumped = lines.select(line_id, F.posexplode(geo.segmentize(geom, most)).alias("i", "p"))
    found = value_at(dumped, cells, pixel, origin, "p").where(F.col("z").isNotNull())
    shown = F.col("p") if srid is None else geo.reproject("p", srid, 4326)
    rows = found.withColumn("s", shown).select(line_id, "i", F.struct(F.col("s.x").alias("x"), F.col("s.y").alias("y"), "z").alias("v"))
    return rows.groupBy(F.col(line_id).alias("way_id")).agg(F.to_json(collected("v", "i")).alias("elevation_profile"))


def raster_aggregate(cells: DataFrame, factor: float, algorithm: str = "average") -> DataFrame:
    """E8. A coarser grid, ``factor`` cells a side: average, min, max or mode of each block; or bilinear.

    Bilinear weighs the four cells around the middle of each block.
    """
    col, row = F.floor(F.col("col") / factor), F.floor(F.col("row") / factor)
    if algorithm == "bilinear":
        blocks = cells.select(col.alias("c"), row.alias("r")).distinct()
        u, v = (F.col("c") + 0.5) * factor - 0.5, (F.col("r") + 0.5) * factor - 0.5
        corner = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1))))
        four = blocks.withColumns({"u": u, "v": v}).withColumn("k", corner)
        at_c, at_r = F.floor("u") + F.col("k.i"), F.floor("v") + F.col("k.j")
        w = (1 - F.abs(F.col("u") - at_c)) * (1 - F.abs(F.col("v") - at_r))
        met = four.select("c", "r", at_c.alias("col"), at_r.alias("row"), w.alias("w")).join(cells, ["col", "row"])
        return met.where("z is not null").groupBy(F.col("c").alias("col"), F.col("r").alias("row")).agg(F.try_divide(F.sum(F.col("z") * F.col("w")), F.sum("w")).alias("z"))
    functions = {"average": F.avg, "min": F.min, "max": F.max, "mode": lambda c: F.mode(c, deterministic=True)}
    if algorithm not in functions:
        raise ValueError(f"unknown algorithm {algorithm}")
    return cells.groupBy(col.alias("col"), row.alias("row")).agg(functions[algorithm]("z").alias("z"))


def cells_in_bbox(cells: DataFrame, box: tuple[float, float, float, float], target_cells: int, pixel: float, origin: tuple[float, float]) -> DataFrame:
    """X7. Cells of a box, coarsened to about ``target_cells``, as (col, row, z, polygon); before the pixels spread."""
    c1, c2 = math.floor((box[0] - origin[0]) / pixel), math.floor((box[2] - origin[0]) / pixel)
    r1, r2 = math.floor((origin[1] - box[3]) / pixel), math.floor((origin[1] - box[1]) / pixel)
    clipped = cells.where(F.col("col").between(c1, c2) & F.col("row").between(r1, r2))
    factor = max(1, math.ceil(math.sqrt((c2 - c1 + 1) * (r2 - r1 + 1) / target_cells)))
    coarse = raster_aggregate(clipped, factor) if factor > 1 else clipped
    size = pixel * factor
    left, top = origin[0] + F.col("col") * size, origin[1] - F.col("row") * size
    return coarse.where("z is not null").withColumn("polygon", geo.rectangle(left, top - size, left + size, top))


def value_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """(name_min, name_max, name_avg) of each column in one row."""
    aggs: list[Column] = []
    for c in columns:
        aggs += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"), F.avg(c).alias(f"{c}_avg")]
    return df.agg(*aggs)
