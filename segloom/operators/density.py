"""An index of where a table's rows are dense, of bounded size, and the parts of it that another table's rows must look at.

Rows are cut into leaves along a space-filling curve at quantiles of their keys, so dense places get small leaves and empty
land none. Leaves carry their count and the box around their geometries; boxes are gathered into larger ones by 16. This
tree, at most ``MOST_LEAVES`` leaves, is broadcast. For each row of the other table a search by levels keeps an upper bound
of the distance to its k-th neighbour (k rows lie in boxes whose far corners are that near) and drops boxes that begin
beyond it. What is left is the list of leaves to join with: one equi-join, whatever the distribution.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import curve

#: Leaves of a table at most while they hold LEAF_ROWS rows each, rows of a leaf wanted until then, boxes gathered into one.
LEAVES, LEAF_ROWS, FANOUT = 1 << 16, 2, 16
#: Rows of a leaf in larger tables, and leaves at most: up to 2^23 rows no leaf grows with the table.
FULL_ROWS, MOST_LEAVES = 8, 1 << 20
_ROWS = 1024
_BOX = ("x1", "y1", "x2", "y2")


@dataclass
class Index:
    """``starts``: first key of each leaf. ``levels``: (boxes, counts) from the largest boxes to the leaves."""

    frame: curve.Frame
    starts: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray]]

    def leaves_of(self, keys: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, keys, side="right") - 1


def _middle_key(box: Column, frame: curve.Frame) -> Column:
    return curve.z_key((box["x1"] + box["x2"]) / 2, (box["y1"] + box["y2"]) / 2, frame)


def wanted_leaves(rows: int, leaf_rows: int = LEAF_ROWS, leaves: int = LEAVES) -> int:
    """How many leaves a table of so many rows gets."""
    return max(min(leaves, -(-rows // leaf_rows)), min(MOST_LEAVES, rows // FULL_ROWS))


def _cuts(keyed: DataFrame, wanted: int) -> np.ndarray:
    """First keys of about so many leaves, at quantiles: of the table, then of each of its parts, so neither list is long."""
    if wanted < 2:
        return np.zeros(1, np.int64)
    coarse = max(1, round(wanted**0.5))
    parts = np.zeros(1, np.int64)
    if coarse > 1:
        parts = np.unique(np.array([0, *keyed.agg(F.percentile_approx("key", [i / coarse for i in range(1, coarse)], 10_000)).first()[0]], np.int64))
    fine = -(-wanted // coarse)
    shares = [i / fine for i in range(1, fine)]
    if not shares:
        return parts
    inner = keyed.groupBy(_leaf_column(F.col("key"), parts).alias("part")).agg(F.percentile_approx("key", shares, max(10_000, 4 * fine)).alias("cuts"))
    cuts = inner.select(F.explode("cuts").alias("cut")).toArrow()["cut"].to_numpy()
    return np.unique(np.concatenate([[0], parts, cuts])).astype(np.int64)


def build(df: DataFrame, box: Column, leaf_rows: int = LEAF_ROWS, leaves: int = LEAVES) -> Index | None:
    """The index of rows by their boxes (struct x1, y1, x2, y2); rows without one are left out. None if none is left.

    Four aggregations: extent, quantiles of the keys, those within each part, counts and boxes of the leaves. Only results
    of at most ``MOST_LEAVES`` rows (six numbers each) reach the driver.
    """
    boxes = df.select(box.alias("b")).where("b.x1 is not null")
    e = boxes.agg(F.min("b.x1"), F.min("b.y1"), F.max("b.x2"), F.max("b.y2"), F.count("*")).first()
    if not e[4]:
        return None
    frame = curve.Frame.around(*e[:4])
    keyed = boxes.select("b", _middle_key(F.col("b"), frame).alias("key"))
    starts = _cuts(keyed.select("key"), wanted_leaves(e[4], leaf_rows, leaves))
    leaf = _leaf_column(F.col("key"), starts)
    sums = keyed.groupBy(leaf.alias("leaf")).agg(*(f(f"b.{c}").alias(c) for f, c in zip((F.min, F.min, F.max, F.max), _BOX, strict=True)), F.count("*").alias("n")).toArrow()
    held = sums["leaf"].to_numpy()
    order = np.argsort(held)
    held = held[order]
    levels = [(np.column_stack([sums[c].to_numpy() for c in _BOX])[order], sums["n"].to_numpy().astype(np.int64)[order])]
    while len(levels[0][1]) > FANOUT:
        below, counts = levels[0]
        first = np.arange(0, len(counts), FANOUT)
        low, high = np.minimum.reduceat(below[:, :2], first), np.maximum.reduceat(below[:, 2:], first)
        levels.insert(0, (np.hstack([low, high]), np.add.reduceat(counts, first)))
    return Index(frame, starts[held], levels)  # a leaf without rows is part of the one before


def _leaf_column(key: Column, starts: np.ndarray) -> Column:
    @F.pandas_udf("int")
    def leaf(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(starts, keys.to_numpy(), side="right") - 1)

    return leaf(key)


def with_leaf(df: DataFrame, index: Index, box: Column, name: str) -> DataFrame:
    """df with the leaf of each row; the box isn't null."""
    return df.withColumn(name, _leaf_column(_middle_key(box, index.frame), index.starts))


def probes(index: Index, anchors: np.ndarray, boxes: np.ndarray, k: int, radius: np.ndarray | None = None) -> list[np.ndarray]:
    """For each row the leaves that may hold one of its k nearest rows, or of those within its radius.

    anchors: a place of each row's geometry (n, 2); boxes: the box around it (n, 4).
    """
    n = len(anchors)
    limit = np.full(n, np.inf) if radius is None else radius.copy()
    row = np.repeat(np.arange(n), len(index.levels[0][1]))
    node = np.tile(np.arange(len(index.levels[0][1])), n)
    for depth, (around, counts) in enumerate(index.levels):
        b, own = around[node], boxes[row]
        if radius is None:
            a = anchors[row]
            far = np.hypot(np.maximum(np.abs(a[:, 0] - b[:, 0]), np.abs(a[:, 0] - b[:, 2])), np.maximum(np.abs(a[:, 1] - b[:, 1]), np.abs(a[:, 1] - b[:, 3])))
            if counts.min() >= k:  # any one box is enough
                begins = np.flatnonzero(np.diff(row, prepend=-1))
                rows, bound = row[begins], np.minimum.reduceat(far, begins) if len(row) else far
            else:
                order = np.lexsort((far, row))
                total = np.cumsum(counts[node[order]])
                begins = np.searchsorted(row[order], np.arange(n))
                before = np.concatenate([[0], total])[begins]
                enough = np.flatnonzero(total - before[row[order]] >= k)
                rows, first = np.unique(row[order][enough], return_index=True)
                bound = far[order][enough][first]
            limit[rows] = np.fmin(limit[rows], bound * (1 + 1e-9))
        gap = np.hypot(np.maximum(0, np.maximum(own[:, 0] - b[:, 2], b[:, 0] - own[:, 2])), np.maximum(0, np.maximum(own[:, 1] - b[:, 3], b[:, 1] - own[:, 3])))
        near = gap <= limit[row]
        row, node = row[near], node[near]
        if depth + 1 < len(index.levels):
            row, node = np.repeat(row, FANOUT), (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
            there = node < len(index.levels[depth + 1][1])
            row, node = row[there], node[there]
    order = np.argsort(row, kind="stable")
    return np.split(node[order].astype(np.int32), np.searchsorted(row[order], np.arange(1, n))) if n else []


def with_probes(df: DataFrame, index: Index, anchor: Column, box: Column, k: int, name: str, radius: Column | None = None) -> DataFrame:
    """A row of df for each leaf that it must be joined with."""
    sent, given_radius = df.sparkSession.sparkContext.broadcast(index), radius is not None

    @F.pandas_udf("array<int>")
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        held = sent.value
        for p in batches:
            v = p.to_numpy(np.float64)
            out = []
            for i in range(0, len(v), _ROWS):
                part = v[i : i + _ROWS]
                out += probes(held, part[:, :2], part[:, 2:6], k, part[:, 6] if given_radius else None)
            yield pd.Series(out, dtype=object)

    wide = F.lit(0.0) if radius is None else radius.cast("double") * (1 + 1e-9)
    given = F.struct(anchor["x"].alias("x"), anchor["y"].alias("y"), *(box[c].alias(c) for c in _BOX), wide.alias("radius"))
    return df.withColumn(name, F.explode(find(given)))
