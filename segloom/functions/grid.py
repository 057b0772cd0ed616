"""Grid cells: the equi-join key of spatial joins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import geo


def cell(p: Column, size: float) -> Column:
    """STRUCT<cx, cy> of a point's cell."""
    return F.struct(F.floor(p["x"] / size).alias("cx"), F.floor(p["y"] / size).alias("cy"))


def box_cells(box: Column, size: Column | float) -> Column:
    """All cells that a box meets."""
    across = F.sequence(F.floor(box["x1"] / size), F.floor(box["x2"] / size))
    down = F.sequence(F.floor(box["y1"] / size), F.floor(box["y2"] / size))
    return F.flatten(F.transform(across, lambda i: F.transform(down, lambda j: F.struct(i.alias("cx"), j.alias("cy")))))


def cells(g: Column, kind: str, size: float, margin: float = 0.0) -> Column:
    """Distinct cells near a geometry: those of its box widened by margin, edge by edge for a line.

    A line takes the cells of each edge's own box, so a long diagonal line does not take those of its whole box.
    """
    if kind == "point":
        box = F.struct((g["x"] - margin).alias("x1"), (g["y"] - margin).alias("y1"), (g["x"] + margin).alias("x2"), (g["y"] + margin).alias("y2"))
        return F.when(g.isNotNull(), box_cells(box, size))
    if kind == "line":

        def edge_box(e: Column) -> Column:
            return F.struct(
                (F.least(e["a"]["x"], e["b"]["x"]) - margin).alias("x1"),
                (F.least(e["a"]["y"], e["b"]["y"]) - margin).alias("y1"),
                (F.greatest(e["a"]["x"], e["b"]["x"]) + margin).alias("x2"),
                (F.greatest(e["a"]["y"], e["b"]["y"]) + margin).alias("y2"),
            )

        parts = F.when(F.size(g) > 1, geo.edges(g)).otherwise(F.transform(g, lambda p: F.struct(p.alias("a"), p.alias("b"))))
        return F.array_distinct(F.flatten(F.transform(parts, lambda e: box_cells(edge_box(e), size))))
    e = geo.envelope(g, kind)
    wide = F.struct((e["x1"] - margin).alias("x1"), (e["y1"] - margin).alias("y1"), (e["x2"] + margin).alias("x2"), (e["y2"] + margin).alias("y2"))
    return F.when(e.isNotNull(), box_cells(wide, size))
