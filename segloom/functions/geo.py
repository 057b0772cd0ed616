"""Geometry as native Column expressions.

A point is STRUCT<x, y>, a line ARRAY<STRUCT<x, y>>, a polygon ARRAY<ARRAY<STRUCT<x, y>>> (rings, the first one
outside; a ring need not repeat its first point). ``kind`` names one of ``point``, ``line``, ``polygon``. Every
function gives null for a null geometry and for an empty line. A boundary belongs to its polygon.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

EARTH_M = 6_371_000.0
#: Semi-major axis and flattening of WGS 84, which GRS 80 shares to a tenth of a millimetre.
AXIS_M, FLATTENING = 6_378_137.0, 1 / 298.257223563


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def point(x: Column | str, y: Column | str) -> Column:
    """G1. Null where a coordinate is null."""
    x, y = _col(x), _col(y)
    return F.when(x.isNotNull() & y.isNotNull(), F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")))


def line(*points: Column) -> Column:
    return F.array(*points)


def rectangle(x1, y1, x2, y2) -> Column:
    """A polygon with sides along the axes."""
    return F.array(F.array(point(x1, y1), point(x2, y1), point(x2, y2), point(x1, y2)))


def kind_of(data_type: T.DataType) -> str:
    """G16. The kind that a column's type holds."""
    if isinstance(data_type, T.StructType):
        return "point"
    if isinstance(data_type, T.ArrayType):
        return "line" if isinstance(data_type.elementType, T.StructType) else "polygon"
    raise TypeError(f"no geometry type: {data_type.simpleString()}")


def x(p: Column | str) -> Column:
    """G19."""
    return _col(p)["x"]


def y(p: Column | str) -> Column:
    return _col(p)["y"]


def start_point(g: Column | str) -> Column:
    """G6. First point of a line."""
    return F.try_element_at(_col(g), F.lit(1))


def end_point(g: Column | str) -> Column:
    return F.try_element_at(_col(g), F.lit(-1))


def first_point(g: Column | str, kind: str) -> Column:
    """Some point of a geometry: the first."""
    g = _col(g)
    return g if kind == "point" else F.get(g, F.lit(0)) if kind == "line" else F.get(F.get(g, F.lit(0)), F.lit(0))


def edges(g: Column, closed: bool = False) -> Column:
    """STRUCT<a, b> of neighbouring points; a closed ring gets the edge back to its start."""
    n = F.size(g)
    follow = F.slice(g, 2, F.greatest(n - 1, F.lit(0)))
    if closed:
        return F.zip_with(g, F.concat(follow, F.slice(g, 1, 1)), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    return F.zip_with(F.slice(g, 1, F.greatest(n - 1, F.lit(0))), follow, lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def _points(g: Column, kind: str) -> Column:
    return F.array(g) if kind == "point" else g if kind == "line" else F.flatten(g)


def _edges(g: Column, kind: str) -> Column:
    return edges(g) if kind == "line" else F.flatten(F.transform(g, lambda r: edges(r, closed=True)))


def _point_point(a: Column, b: Column) -> Column:
    return F.hypot(a["x"] - b["x"], a["y"] - b["y"])


def _share(p: Column, e: Column) -> Column:
    """Where on the edge the point nearest to p lies, from 0 to 1."""
    dx, dy = e["b"]["x"] - e["a"]["x"], e["b"]["y"] - e["a"]["y"]
    square = dx * dx + dy * dy
    t = ((p["x"] - e["a"]["x"]) * dx + (p["y"] - e["a"]["y"]) * dy) / F.when(square > 0, square)
    return F.when(t.isNull(), 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), t)))


def _on_edge(p: Column, e: Column) -> Column:
    t = _share(p, e)
    return F.struct((e["a"]["x"] + t * (e["b"]["x"] - e["a"]["x"])).alias("x"), (e["a"]["y"] + t * (e["b"]["y"] - e["a"]["y"])).alias("y"))


def _point_edges(p: Column, es: Column) -> Column:
    return F.array_min(F.transform(es, lambda e: _point_point(p, _on_edge(p, e))))


def _turn(a: Column, b: Column, c: Column) -> Column:
    return F.signum((b["x"] - a["x"]) * (c["y"] - a["y"]) - (b["y"] - a["y"]) * (c["x"] - a["x"]))


def _within_box(a: Column, b: Column, p: Column) -> Column:
    return p["x"].between(F.least(a["x"], b["x"]), F.greatest(a["x"], b["x"])) & p["y"].between(F.least(a["y"], b["y"]), F.greatest(a["y"], b["y"]))


def _cross(e: Column, f: Column) -> Column:
    """Whether two edges have a point in common, ends and collinear overlaps included."""
    a, b, c, d = e["a"], e["b"], f["a"], f["b"]
    o1, o2, o3, o4 = _turn(a, b, c), _turn(a, b, d), _turn(c, d, a), _turn(c, d, b)
    touch = ((o1 == 0) & _within_box(a, b, c)) | ((o2 == 0) & _within_box(a, b, d)) | ((o3 == 0) & _within_box(c, d, a)) | ((o4 == 0) & _within_box(c, d, b))
    return ((o1 != o2) & (o3 != o4) & (o1 * o2 <= 0) & (o3 * o4 <= 0)) | touch


def _any_cross(es: Column, fs: Column) -> Column:
    return F.exists(es, lambda e: F.exists(fs, lambda f: _cross(e, f)))


def edge_test(p: Column, a: Column, b: Column) -> tuple[Column, Column]:
    """(1 if the ray from p to the right passes the edge, else 0; whether p lies on it)."""
    over = (a["y"] > p["y"]) != (b["y"] > p["y"])
    at = a["x"] + (p["y"] - a["y"]) * (b["x"] - a["x"]) / F.when(b["y"] != a["y"], b["y"] - a["y"])
    return F.when(over & (p["x"] < at), 1).otherwise(0), (_turn(a, b, p) == 0) & _within_box(a, b, p)


def polygon_edges(g: Column | str) -> Column:
    """STRUCT<a, b> of the edges of all rings."""
    return _edges(_col(g), "polygon")


def _inside(p: Column, polygon: Column) -> Column:
    """Crossing-number parity over all rings, or on an edge."""
    es = _edges(polygon, "polygon")
    parity = F.aggregate(F.transform(es, lambda e: edge_test(p, e["a"], e["b"])[0]), F.lit(0), lambda s, v: s + v) % 2 == 1
    return parity | F.exists(es, lambda e: edge_test(p, e["a"], e["b"])[1])


def _empty(g: Column, kind: str) -> Column:
    return g.isNull() if kind == "point" else g.isNull() | (F.size(_points(g, kind)) == 0)


def intersects(a: Column | str, b: Column | str, kinds: tuple[str, str]) -> Column:
    """G9. Whether two geometries have a point in common."""
    a, b, (ka, kb) = _col(a), _col(b), kinds
    if (ka, kb) in (("line", "point"), ("polygon", "point"), ("polygon", "line")):
        a, b, ka, kb = b, a, kb, ka
    if (ka, kb) == ("point", "point"):
        found = (a["x"] == b["x"]) & (a["y"] == b["y"])
    elif (ka, kb) == ("point", "line"):
        found = F.exists(edges(b), lambda e: (_turn(e["a"], e["b"], a) == 0) & _within_box(e["a"], e["b"], a)) | F.exists(b, lambda q: (q["x"] == a["x"]) & (q["y"] == a["y"]))
    elif (ka, kb) == ("point", "polygon"):
        found = _inside(a, b)
    else:
        found = _any_cross(_edges(a, ka), _edges(b, kb))
        if kb == "polygon":
            found = found | _inside(_points(a, ka)[0], b)
        if ka == "polygon":
            found = found | _inside(_points(b, kb)[0], a)
    return F.when(~_empty(a, ka) & ~_empty(b, kb), found)


def distance(a: Column | str, b: Column | str, kinds: tuple[str, str] = ("point", "point")) -> Column:
    """G2. Planar distance; 0 where they intersect."""
    a, b, (ka, kb) = _col(a), _col(b), kinds
    order = ("point", "line", "polygon")
    if order.index(ka) > order.index(kb):
        a, b, ka, kb = b, a, kb, ka
    if kb == "point":
        found = _point_point(a, b)
    elif (ka, kb) == ("point", "line"):
        # a line of two points, the commonest, takes plain columns that Spark compiles
        only = {"a": F.get(b, F.lit(0)), "b": F.get(b, F.lit(1))}
        found = F.when(F.size(b) == 2, _point_point(a, _on_edge(a, only))).otherwise(F.coalesce(_point_edges(a, edges(b)), _point_point(a, F.get(b, F.lit(0)))))
    elif (ka, kb) == ("point", "polygon"):
        found = F.when(_inside(a, b), 0.0).otherwise(_point_edges(a, _edges(b, kb)))
    else:
        near = F.least(F.array_min(F.transform(_points(a, ka), lambda p: _point_edges(p, _edges(b, kb)))), F.array_min(F.transform(_points(b, kb), lambda p: _point_edges(p, _edges(a, ka)))))
        found = F.when(intersects(a, b, (ka, kb)), 0.0).otherwise(near)
    return F.when(~_empty(a, ka) & ~_empty(b, kb), found)


def edge_distance(e: Column, f: Column) -> Column:
    """Distance of two edges (struct a, b), which may be points; 0 where they cross or touch."""
    ends = [_point_point(p, _on_edge(p, g)) for g, h in ((e, f), (f, e)) for p in (h["a"], h["b"])]
    return F.when(_cross(e, f), 0.0).otherwise(F.least(*ends))


def solid_edges(g: Column | str, kind: str) -> Column:
    """The edges of a point or line; one that is a single point is an edge without length."""
    g = _col(g)
    if kind == "point":
        return F.when(g.isNotNull(), F.array(F.struct(g.alias("a"), g.alias("b"))))
    return F.when(F.size(g) > 1, edges(g)).otherwise(F.transform(g, lambda p: F.struct(p.alias("a"), p.alias("b"))))


def within(a, b, limit, kinds: tuple[str, str] = ("point", "point")) -> Column:
    """G4."""
    return distance(a, b, kinds) <= limit


def shortest_line(a: Column | str, b: Column | str, kinds: tuple[str, str] = ("point", "line")) -> Column:
    """G13. From a to the nearest place on b (points and lines); of equal ones the first edge's."""
    a, b, (ka, kb) = _col(a), _col(b), kinds

    def pairs(points: Column, es: Column, swap: bool) -> Column:
        def to_edge(p: Column, e: Column) -> Column:
            q = _on_edge(p, e)
            u, v = (q, p) if swap else (p, q)
            return F.struct(_point_point(p, q).alias("d"), u.alias("u"), v.alias("v"))

        return F.flatten(F.transform(points, lambda p: F.transform(es, lambda e: to_edge(p, e))))

    def solid(g: Column, kind: str) -> Column:
        return F.array(F.struct(g.alias("a"), g.alias("b"))) if kind == "point" else F.when(F.size(g) > 1, edges(g)).otherwise(F.transform(g, lambda p: F.struct(p.alias("a"), p.alias("b"))))

    options = pairs(_points(a, ka), solid(b, kb), False)
    if ka != "point":
        options = F.concat(options, pairs(_points(b, kb), solid(a, ka), True))
    first = F.aggregate(options, options[0], lambda m, o: F.when(o["d"] < m["d"], o).otherwise(m))
    return F.when(~_empty(a, ka) & ~_empty(b, kb), F.array(first["u"], first["v"]))


def envelope(g: Column | str, kind: str) -> Column:
    """G14. STRUCT<x1, y1, x2, y2>."""
    g = _col(g)
    ps = _points(g, kind)
    xs, ys = F.transform(ps, lambda p: p["x"]), F.transform(ps, lambda p: p["y"])
    low, high = [F.array_min(xs), F.array_min(ys)], [F.array_max(xs), F.array_max(ys)]
    return F.when(~_empty(g, kind), F.struct(low[0].alias("x1"), low[1].alias("y1"), high[0].alias("x2"), high[1].alias("y2")))


def bbox_intersects(g: Column | str, kind: str, box: tuple[float, float, float, float]) -> Column:
    """G14. Whether the envelope meets the box (x1, y1, x2, y2)."""
    e = envelope(g, kind)
    return (e["x1"] <= box[2]) & (e["x2"] >= box[0]) & (e["y1"] <= box[3]) & (e["y2"] >= box[1])


def length(g: Column | str) -> Column:
    """G10. Length of a line; 0 for a single point."""
    g = _col(g)
    total = F.aggregate(F.transform(edges(g), lambda e: _point_point(e["a"], e["b"])), F.lit(0.0), lambda s, v: s + v)
    return F.when(~_empty(g, "line"), total)


def interpolate(g: Column | str, share: Column) -> Column:
    """G11. The point at this share (0 to 1, clamped) of a line's length."""
    g = _col(g)
    wanted = F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)) * length(g)
    zero = F.struct(F.lit(0.0).alias("done"), g[0].alias("at"), F.lit(False).alias("found"))

    def step(s: Column, e: Column) -> Column:
        d = _point_point(e["a"], e["b"])
        t = F.when(d > 0, (wanted - s["done"]) / F.when(d > 0, d)).otherwise(0.0)
        here = F.struct((e["a"]["x"] + t * (e["b"]["x"] - e["a"]["x"])).alias("x"), (e["a"]["y"] + t * (e["b"]["y"] - e["a"]["y"])).alias("y"))
        inside = s["done"] + d >= wanted
        moved = F.struct((s["done"] + d).alias("done"), F.when(inside, here).otherwise(e["b"]).alias("at"), inside.alias("found"))
        return F.when(s["found"], s).otherwise(moved)

    return F.when(~_empty(g, "line") & share.isNotNull(), F.aggregate(edges(g), zero, step)["at"])


def segmentize(g: Column | str, most: float) -> Column:
    """G12. The line with points added so that no edge is longer than ``most``, in equal parts of each edge."""
    g = _col(g)

    def cut(e: Column) -> Column:
        n = F.greatest(F.lit(1), F.ceil(_point_point(e["a"], e["b"]) / most).cast("int"))

        def at(i: Column) -> Column:
            t = i / n
            return F.struct((e["a"]["x"] + t * (e["b"]["x"] - e["a"]["x"])).alias("x"), (e["a"]["y"] + t * (e["b"]["y"] - e["a"]["y"])).alias("y"))

        return F.transform(F.sequence(F.lit(0), n - 1), at)

    return F.when(~_empty(g, "line"), F.concat(F.flatten(F.transform(edges(g), cut)), F.slice(g, -1, 1)))


def meters_per_degree(latitude: float, longitudes: float = 360.0, radius: float = 6_371_000.0) -> float:
    """A lower bound of great-circle metres for each degree of planar distance between points in degrees.

    It holds up to this latitude (absolute) and for points at most so many degrees of longitude apart, not counted
    across the 180th meridian.
    """
    half = math.radians(min(longitudes, 180.0)) / 2
    return radius * math.radians(1) * math.cos(math.radians(latitude)) * (math.sin(half) / half if half else 1.0)


def azimuth_degrees(a: Column, b: Column) -> Column:
    """G7. Planar bearing from a to b in [0, 360), clockwise from north; null for equal points."""
    dx, dy = b["x"] - a["x"], b["y"] - a["y"]
    return F.when((dx != 0) | (dy != 0), F.pmod(F.degrees(F.atan2(dx, dy)), F.lit(360.0)))


def snap(g: Column | str, cell: float, kind: str = "point") -> Column:
    """G21. Coordinates at the nearest multiples of ``cell``."""

    def one(p: Column) -> Column:
        return F.struct((F.rint(p["x"] / cell) * cell).alias("x"), (F.rint(p["y"] / cell) * cell).alias("y"))

    return map_points(g, kind, one)


def map_points(g: Column | str, kind: str, f) -> Column:
    """f applied to each point."""
    g = _col(g)
    if kind == "point":
        return F.when(g.isNotNull(), f(g))
    return F.transform(g, f) if kind == "line" else F.transform(g, lambda r: F.transform(r, f))


def haversine(a: Column, b: Column) -> Column:
    """G3. Great-circle metres between points in degrees."""
    p, q = F.radians(a["y"]), F.radians(b["y"])
    h = F.pow(F.sin((q - p) / 2), 2) + F.cos(p) * F.cos(q) * F.pow(F.sin(F.radians(b["x"] - a["x"]) / 2), 2)
    return 2 * EARTH_M * F.atan2(F.sqrt(h), F.sqrt(1 - h))


def geodesic(a: Column, b: Column) -> Column:
    """G3. Metres on the spheroid to first order in the flattening (Andoyer-Lambert); not for antipodes."""
    half, mean, turn = F.radians(a["y"] - b["y"]) / 2, F.radians(a["y"] + b["y"]) / 2, F.radians(a["x"] - b["x"]) / 2
    sf, cf, sg, cg, sl, cl = (f(v) for v in (mean, half, turn) for f in (F.sin, F.cos))
    s, c = sg * sg * cl * cl + cf * cf * sl * sl, cg * cg * cl * cl + sf * sf * sl * sl
    w = F.atan(F.sqrt(s / F.when(c > 0, c)))
    r = F.sqrt(s * c) / F.when(w > 0, w)
    first, second = (3 * r - 1) / (2 * F.when(c > 0, c)), (3 * r + 1) / (2 * F.when(s > 0, s))
    d = 2 * w * AXIS_M * (1 + FLATTENING * (first * sf * sf * cg * cg - second * cf * cf * sg * sg))
    return F.when((a["x"] == b["x"]) & (a["y"] == b["y"]), 0.0).otherwise(d)


def great_circle_bearing(a: Column, b: Column) -> Column:
    """G8. Initial bearing in [0, 360)."""
    p, q, d = F.radians(a["y"]), F.radians(b["y"]), F.radians(b["x"] - a["x"])
    return F.pmod(F.degrees(F.atan2(F.sin(d) * F.cos(q), F.cos(p) * F.sin(q) - F.sin(p) * F.cos(q) * F.cos(d))), F.lit(360.0))


def great_circle_midpoint(a: Column, b: Column) -> Column:
    """G8. Halfway point in degrees."""
    p, q, d = F.radians(a["y"]), F.radians(b["y"]), F.radians(b["x"] - a["x"])
    bx, by = F.cos(q) * F.cos(d), F.cos(q) * F.sin(d)
    lat = F.atan2(F.sin(p) + F.sin(q), F.hypot(F.cos(p) + bx, by))
    lon = F.radians(a["x"]) + F.atan2(by, F.cos(p) + bx)
    return F.struct((F.pmod(F.degrees(lon) + 180, F.lit(360.0)) - 180).alias("x"), F.degrees(lat).alias("y"))


def great_circle_length(g: Column | str) -> Column:
    """Sum of great-circle metres along a line in degrees."""
    g = _col(g)
    return F.when(~_empty(g, "line"), F.aggregate(F.transform(edges(g), lambda e: haversine(e["a"], e["b"])), F.lit(0.0), lambda s, v: s + v))


def _number(v: Column) -> Column:
    return F.regexp_replace(v.cast("string"), r"\.0$", "")


def as_wkt(g: Column | str, kind: str, srid: int | None = None) -> Column:
    """G18. WKT, or EWKT with an srid."""
    g = _col(g)

    def pair(p: Column) -> Column:
        return F.concat_ws(" ", _number(p["x"]), _number(p["y"]))

    def ring(r: Column) -> Column:
        return F.concat(F.lit("("), F.array_join(F.transform(r, pair), ", "), F.lit(")"))

    if kind == "point":
        text = F.concat(F.lit("POINT ("), pair(g), F.lit(")"))
    elif kind == "line":
        text = F.concat(F.lit("LINESTRING "), ring(g))
    else:
        text = F.concat(F.lit("POLYGON ("), F.array_join(F.transform(g, lambda r: ring(F.concat(r, F.slice(r, 1, 1)))), ", "), F.lit(")"))
    return F.when(g.isNotNull(), F.concat(F.lit(f"SRID={srid};" if srid else ""), text))


def from_wkt(text: Column | str, kind: str) -> Column:
    """G18. Points and lines from WKT or EWKT; null where the text is something else."""
    name = {"point": "POINT", "line": "LINESTRING"}[kind]
    body = F.regexp_extract(_col(text), rf"(?i)^\s*(?:SRID=\d+;)?\s*{name}\s*\(([^()]*)\)\s*$", 1)

    def one(pair: Column) -> Column:
        parts = F.split(F.trim(pair), r"\s+")
        return F.struct(F.get(parts, F.lit(0)).try_cast("double").alias("x"), F.get(parts, F.lit(1)).try_cast("double").alias("y"))

    points = F.transform(F.split(body, ","), one)
    sound = (F.length(body) > 0) & ~F.exists(points, lambda p: p["x"].isNull() | p["y"].isNull())
    return F.when(sound, points[0] if kind == "point" else points)


def geojson_geometry(g: Column | str, kind: str) -> Column:
    """G17. STRUCT<type, coordinates> for to_json."""
    g = _col(g)

    def pair(p: Column) -> Column:
        return F.array(p["x"], p["y"])

    if kind == "point":
        coordinates = pair(g)
    elif kind == "line":
        coordinates = F.transform(g, pair)
    else:
        coordinates = F.transform(g, lambda r: F.transform(F.concat(r, F.slice(r, 1, 1)), pair))
    return F.when(g.isNotNull(), F.struct(F.lit({"point": "Point", "line": "LineString", "polygon": "Polygon"}[kind]).alias("type"), coordinates.alias("coordinates")))


def as_geojson(g: Column | str, kind: str) -> Column:
    return F.to_json(geojson_geometry(g, kind))


def _series() -> tuple[float, list[float], list[float], list[float]]:
    """Kruger's series to the third power of n, latitude to the fourth: rectifying radius, forward, backward and latitude terms."""
    n = FLATTENING / (2 - FLATTENING)
    radius = AXIS_M / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    forward = [n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240]
    backward = [n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480]
    latitude = [2 * n - 2 * n**2 / 3 - 2 * n**3 + 116 * n**4 / 45, 7 * n**2 / 3 - 8 * n**3 / 5 - 227 * n**4 / 45, 56 * n**3 / 15 - 136 * n**4 / 35, 4279 * n**4 / 630]
    return radius, forward, backward, latitude


def utm_zone(srid: int) -> int:
    """Zone of a northern UTM system: 258xx (ETRS 89) or 326xx (WGS 84)."""
    if srid // 100 in (258, 326) and 1 <= srid % 100 <= 60:
        return srid % 100
    raise ValueError(f"only 4326 and northern UTM zones are known, not {srid}")


def _to_utm(p: Column, zone: int) -> Column:
    radius, forward, _, _ = _series()
    n = FLATTENING / (2 - FLATTENING)
    e = 2 * math.sqrt(n) / (1 + n)
    lat, lon = F.radians(p["y"]), F.radians(p["x"] - (6 * zone - 183))
    t = F.sinh(F.atanh(F.sin(lat)) - e * F.atanh(e * F.sin(lat)))
    xi, eta = F.atan2(t, F.cos(lon)), F.asinh(F.sin(lon) / F.hypot(t, F.cos(lon)))
    north, east = xi, eta
    for j, a in enumerate(forward, 1):
        north = north + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        east = east + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    return F.struct((500_000 + 0.9996 * radius * east).alias("x"), (0.9996 * radius * north).alias("y"))


def _from_utm(p: Column, zone: int) -> Column:
    radius, _, backward, latitude = _series()
    xi, eta = p["y"] / (0.9996 * radius), (p["x"] - 500_000) / (0.9996 * radius)
    north, east = xi, eta
    for j, b in enumerate(backward, 1):
        north = north - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        east = east - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(north) / F.cosh(east))
    lat = chi
    for j, d in enumerate(latitude, 1):
        lat = lat + d * F.sin(2 * j * chi)
    return F.struct((F.degrees(F.atan2(F.sinh(east), F.cos(north))) + (6 * zone - 183)).alias("x"), F.degrees(lat).alias("y"))


def reproject(g: Column | str, from_srid: int, to_srid: int, kind: str = "point") -> Column:
    """G20. Between 4326 and northern UTM zones, ETRS 89 and WGS 84 taken as one."""
    if from_srid == to_srid:
        return _col(g)

    def one(p: Column) -> Column:
        degrees = p if from_srid == 4326 else _from_utm(p, utm_zone(from_srid))
        return degrees if to_srid == 4326 else _to_utm(degrees, utm_zone(to_srid))

    return map_points(g, kind, one)
