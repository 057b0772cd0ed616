import math
import random

import pytest
from pyspark.sql import functions as F

from segloom.functions import geo

P = "struct<x:double,y:double>"


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def build(g):
    """Columns need a session, which parameters do not have yet."""
    name, *args = g
    return {"pt": pt, "ln": ln, "square": square}[name](*args)


def later(name):
    return lambda *args: (name, *args)


PT, LN, SQ = later("pt"), later("ln"), later("square")


def pt(x, y):
    return geo.point(F.lit(float(x)), F.lit(float(y)))


def ln(*pairs):
    return geo.line(*(pt(*p) for p in pairs))


def square(a, b):
    return geo.rectangle(*(F.lit(float(v)) for v in (a, a, b, b)))


@pytest.mark.parametrize(
    ("a", "b", "kinds", "want"),
    [
        (PT(0, 0), PT(3, 4), ("point", "point"), 5.0),
        (PT(5, 5), LN((0, 0), (10, 0)), ("point", "line"), 5.0),
        (PT(13, 4), LN((0, 0), (10, 0)), ("point", "line"), 5.0),
        (PT(1, 1), LN((4, 5)), ("point", "line"), 5.0),
        (PT(3, 4), LN((0, 0), (0, 0)), ("point", "line"), 5.0),
        (LN((0, 0), (10, 10)), LN((0, 10), (10, 0)), ("line", "line"), 0.0),
        (LN((0, 0), (10, 0)), LN((0, 3), (10, 3)), ("line", "line"), 3.0),
        (LN((0, 0), (4, 0)), LN((2, 0), (9, 0)), ("line", "line"), 0.0),
        (PT(1, 1), SQ(0, 2), ("point", "polygon"), 0.0),
        (PT(5, 1), SQ(0, 2), ("point", "polygon"), 3.0),
        (LN((5, 0), (5, 2)), SQ(0, 2), ("line", "polygon"), 3.0),
    ],
)
def test_distance(spark, a, b, kinds, want):
    a, b = build(a), build(b)
    assert value(spark, geo.distance(a, b, kinds)) == pytest.approx(want)
    assert value(spark, geo.distance(b, a, kinds[::-1])) == pytest.approx(want)


@pytest.mark.parametrize(
    ("g", "kind", "want"),
    [(PT(0, 1), "point", True), (PT(2, 2), "point", True), (PT(2.001, 1), "point", False), (LN((-1, 1), (3, 1)), "line", True), (LN((3, 0), (3, 3)), "line", False), (SQ(1, 5), "polygon", True), (SQ(-9, 9), "polygon", True)],
)
def test_intersects_boundary_counts(spark, g, kind, want):
    assert value(spark, geo.intersects(build(g), square(0, 2), (kind, "polygon"))) is want


def test_non_convex_ring_with_hole(spark):
    ring = "array(named_struct('x',0D,'y',0D),named_struct('x',10D,'y',0D),named_struct('x',10D,'y',10D),named_struct('x',5D,'y',2D),named_struct('x',0D,'y',10D))"
    hole = "array(named_struct('x',1D,'y',0.5D),named_struct('x',2D,'y',0.5D),named_struct('x',2D,'y',1D),named_struct('x',1D,'y',1D))"
    g = F.expr(f"array({ring},{hole})")
    assert value(spark, geo.intersects(pt(5, 1), g, ("point", "polygon")))
    assert not value(spark, geo.intersects(pt(5, 6), g, ("point", "polygon")))
    assert not value(spark, geo.intersects(pt(1.5, 0.7), g, ("point", "polygon")))


def test_nulls_give_null(spark):
    none = F.lit(None).cast(P)
    line = F.lit(None).cast(f"array<{P}>")
    empty = F.array().cast(f"array<{P}>")
    for c in (geo.distance(none, pt(0, 0)), geo.length(line), geo.length(empty), geo.distance(pt(0, 0), empty, ("point", "line")), geo.interpolate(line, F.lit(0.5)), geo.snap(none, 5), geo.reproject(none, 4326, 25833), geo.envelope(line, "line"), geo.as_wkt(none, "point"), geo.shortest_line(none, line)):
        assert value(spark, c) is None


def test_lines(spark):
    g = ln((0, 0), (3, 4), (3, 10))
    assert value(spark, geo.length(g)) == 11
    assert tuple(value(spark, geo.interpolate(g, F.lit(5 / 11)))) == pytest.approx((3, 4))
    assert tuple(value(spark, geo.interpolate(g, F.lit(2.0)))) == pytest.approx((3, 10))
    assert [tuple(p) for p in value(spark, geo.segmentize(ln((0, 0), (10, 0)), 4))] == [(0, 0), (pytest.approx(10 / 3), 0), (pytest.approx(20 / 3), 0), (10, 0)]
    assert [tuple(p) for p in value(spark, geo.shortest_line(pt(5, 5), ln((0, 0), (10, 0))))] == [(5, 5), (5, 0)]
    assert value(spark, geo.azimuth_degrees(pt(0, 0), pt(-1, 0))) == 270
    assert value(spark, geo.azimuth_degrees(pt(1, 1), pt(1, 1))) is None


def test_sphere_and_spheroid(spark):
    berlin, paris = pt(13.405, 52.52), pt(2.3522, 48.8566)
    assert value(spark, geo.haversine(berlin, paris)) == pytest.approx(877_460, rel=1e-3)
    assert value(spark, geo.geodesic(berlin, paris)) == pytest.approx(879_700, rel=1e-3)
    assert value(spark, geo.geodesic(berlin, berlin)) == 0
    # a degree of latitude at the equator on the ellipsoid
    assert value(spark, geo.geodesic(pt(0, 0), pt(0, 1))) == pytest.approx(110_574.4, abs=2)  # first order in the flattening
    assert value(spark, geo.great_circle_bearing(pt(0, 0), pt(1, 0))) == pytest.approx(90)
    mid = value(spark, geo.great_circle_midpoint(pt(170, 0), pt(-170, 0)))
    assert (abs(mid["x"]), mid["y"]) == (pytest.approx(180), pytest.approx(0))


def test_utm(spark):
    p = value(spark, geo.reproject(pt(13.405, 52.52), 4326, 25833))
    assert (p["x"], p["y"]) == (pytest.approx(391779.259, abs=0.01), pytest.approx(5820072.159, abs=0.01))
    p = value(spark, geo.reproject(pt(15, 0), 4326, 32633))
    assert (p["x"], p["y"]) == (pytest.approx(500000), pytest.approx(0, abs=1e-6))
    with pytest.raises(ValueError, match="only 4326"):
        geo.reproject(pt(0, 0), 4326, 3857)


def test_utm_round_trip(spark):
    rng = random.Random(5)
    rows = [(rng.uniform(9, 21), rng.uniform(0.1, 83)) for _ in range(300)]
    df = spark.createDataFrame(rows, "lon double, lat double").withColumn("p", geo.point("lon", "lat"))
    back = geo.reproject(geo.reproject("p", 4326, 25833), 25833, 4326)
    worst = df.select(F.max(F.hypot((back["x"] - F.col("lon")) * F.cos(F.radians("lat")), back["y"] - F.col("lat")))).first()[0]
    assert worst * 111_000 < 0.001  # metres


def test_text(spark):
    assert value(spark, geo.as_wkt(ln((0, 1), (2.5, 3)), "line", 25833)) == "SRID=25833;LINESTRING (0 1, 2.5 3)"
    assert [tuple(p) for p in value(spark, geo.from_wkt(F.lit("srid=4326; LineString( 0 1 , 2.5 -3e2)"), "line"))] == [(0, 1), (2.5, -300)]
    assert value(spark, geo.from_wkt(F.lit("POINT (1 x)"), "point")) is None
    assert value(spark, geo.from_wkt(F.lit("POLYGON ((0 0))"), "line")) is None
    assert value(spark, geo.as_geojson(pt(1, 2), "point")) == '{"type":"Point","coordinates":[1.0,2.0]}'
    assert math.isclose(value(spark, geo.distance(geo.from_wkt(F.lit("POINT (3 4)"), "point"), pt(0, 0))), 5)
