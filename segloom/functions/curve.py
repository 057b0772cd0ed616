"""Keys along a space-filling curve: rows near each other in a sorted table are near each other in the plane."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Binary digits of a coordinate; a key has twice as many.
BITS = 24
#: How far each step moves the upper half of the digits, and the mask of those in place then.
_STEPS = [(16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)]


@dataclass(frozen=True)
class Frame:
    """The square whose cells are numbered; places outside count as those of its border."""

    x: float
    y: float
    side: float

    @staticmethod
    def around(x1: float, y1: float, x2: float, y2: float) -> Frame:
        return Frame(x1, y1, max(x2 - x1, y2 - y1, 1e-9) * (1 + 1e-9))

    def cell(self, value: float, low: float) -> int:
        return min(max(int((value - low) / self.side * (1 << BITS) // 1), 0), (1 << BITS) - 1)


def _spread(v: Column) -> Column:
    """The binary digits of a number with a zero after each."""
    for shift, mask in _STEPS:
        v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
    return v


def z_key(x: Column, y: Column, frame: Frame) -> Column:
    """Z-order key of a place, its digits taken in turn from y and x; null where a coordinate is."""

    def cell(c: Column, low: float) -> Column:
        n = F.floor((c - low) / frame.side * (1 << BITS))
        return F.when(c.isNotNull(), F.greatest(F.lit(0), F.least(F.lit((1 << BITS) - 1), n)).cast("long"))

    return F.shiftleft(_spread(cell(y, frame.y)), 1).bitwiseOR(_spread(cell(x, frame.x)))


def box_ranges(frame: Frame, box: tuple[float, float, float, float], most: int = 32) -> list[tuple[int, int]]:
    """Ranges of keys, ends included, that hold every place of the box: at most ``most``, so they may hold others.

    Squares of the curve are split where the box cuts them, the largest first, until there are ``most`` ranges; ranges
    that touch are joined.
    """
    x1, y1, x2, y2 = frame.cell(box[0], frame.x), frame.cell(box[1], frame.y), frame.cell(box[2], frame.x), frame.cell(box[3], frame.y)
    if x1 > x2 or y1 > y2:
        return []
    cut, whole = [(BITS, 0, 0, 0)], []  # (size in digits, cell of the corner, first key)
    while cut and len(cut) + len(whole) < most:
        cut.sort()
        size, cx, cy, key = cut.pop()
        if size == 0:
            whole.append((key, key))
            continue
        half = 1 << (size - 1)
        for quarter in range(4):
            ax, ay, first = cx + half * (quarter & 1), cy + half * (quarter >> 1), key + quarter * half * half
            bx, by = ax + half - 1, ay + half - 1
            if ax > x2 or bx < x1 or ay > y2 or by < y1:
                continue
            if x1 <= ax and bx <= x2 and y1 <= ay and by <= y2:
                whole.append((first, first + half * half - 1))
            else:
                cut.append((size - 1, ax, ay, first))
    found = sorted(whole + [(key, key + (1 << 2 * size) - 1) for size, _, _, key in cut])
    out = found[:1]
    for a, b in found[1:]:
        if a == out[-1][1] + 1:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out
