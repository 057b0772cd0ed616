"""Pairs found cell by cell in numpy equal all pairs, and none is shuffled."""

import random

from pyspark.sql import functions as F
from test_match import brute, lines, pairs, points

from segloom.functions import geo
from segloom.operators import match, meet
from segloom.plans import presets


def shuffled(df):
    """Names of the columns that the plan's shuffles send."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange"), plan


def test_pairs_with_chosen_columns(spark):
    a, b = lines(spark, 120, 51, 300), points(spark, 150, 52)
    want = brute(a, b, ("line", "point")).where("distance <= 45")
    got = match.within(a, b, 45, enr_id="sid", columns=["id", "value", "sid"])
    assert got.columns == ["id", "value", "sid"] and pairs(got, "id", "sid") == pairs(want, "id", "sid") != []
    other = lines(spark, 90, 53, 20).withColumnRenamed("id", "sid")
    want, got = (match.intersects(a, other, enr_id="sid", columns=c) for c in (None, ["id", "sid"]))
    assert got.columns == ["id", "sid"] and pairs(got, "id", "sid") == pairs(want, "id", "sid") != []
    ends = [("id", "id + 5", "sid", "sid + 90")]
    want, got = (match.range_pairs(a, other, ends, columns=c) for c in (None, ["sid", "id"]))
    assert got.columns == ["sid", "id"] and pairs(got, "id", "sid") == pairs(want, "id", "sid") != []
    assert match.within(a, b.limit(0), 45, enr_id="sid", columns=["id"]).count() == 0


def test_lines_within_shuffles_no_pair(spark):
    got = match.lines_within(lines(spark, 40, 54), lines(spark, 40, 55).withColumnRenamed("id", "sid"), 50, enr_id="sid")
    assert "HashAggregate" not in shuffled(got)[1]
    corners = points(spark, 60, 56)
    assert "HashAggregate" not in shuffled(match.inside(corners.withColumnRenamed("sid", "id"), corners.select("sid", geo.rectangle("sid", "sid", F.col("sid") + 200, F.col("sid") + 90).alias("geometry")), enr_id="sid"))[1]


def test_lines_of_many_edges_in_pieces(spark):
    rng = random.Random(57)
    walk = lambda n: [(float(rng.randrange(400)), float(rng.randrange(400))) for _ in range(n)]
    rows = [(i, walk(n)) for i, n in enumerate([2, 3 * meet.PIECE, meet.PIECE + 1, meet.PIECE + 2, 1])]
    a = spark.createDataFrame(rows, "id long, geometry array<struct<x:double,y:double>>")
    b = points(spark, 80, 58)
    want = brute(a, b, ("line", "point")).where("distance <= 3")
    got = match.lines_within(a, b, 3, enr_id="sid")
    assert pairs(got, "id", "sid") == pairs(want, "id", "sid") != []


def test_lists_in_order(spark):
    a = lines(spark, 70, 59, 200)
    b = points(spark, 120, 60).withColumn("value", F.when(F.col("sid") % 5 > 0, F.col("value")))
    near = brute(a, b, ("line", "point")).where("distance <= 60")
    for order in (["value", "sid"], ["distance", "sid"]):
        items = F.sort_array(F.collect_list(F.struct(*order, F.struct("sid", "value").alias("v"))))
        want = a.join(near.groupBy("id").agg(items.alias("v")), "id", "left").select("id", F.coalesce(F.to_json(F.transform("v", lambda v: v["v"]["sid"])), F.lit("[]")).alias("sids"))
        got = presets.map_preset("aggregate_within_distance", a, b, {"distance": 60}, {"type": "lists", "columns": ["sid", "value", "distance"], "order": order}, enr_id="sid")
        assert got.columns == ["id", "sid", "value", "distance"] and got.where("size(sid) <> size(value) or size(sid) <> size(distance)").count() == 0
        assert pairs(got.select("id", F.to_json("sid").alias("sids")), "id", "sids") == pairs(want, "id", "sids")
    assert "Aggregate" not in shuffled(got)[1]
