import math
import random
import warnings

import numpy as np
import pytest
from pyspark.sql import functions as F

from segloom.functions import geo
from segloom.operators import density, match, reduce
from segloom.plans import presets


def lines(spark, n, seed, reach=60):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x, y = rng.randrange(1000), rng.randrange(1000)
        rows.append((i, [(float(x), float(y)), (float(x + rng.randint(-reach, reach)), float(y + rng.randint(-reach, reach))), (float(x), float(y))][: rng.choice([1, 2, 3])]))
    rows.append((n, None))
    return spark.createDataFrame(rows, "id long, geometry array<struct<x:double,y:double>>")


def points(spark, n, seed):
    rng = random.Random(seed)
    rows = [(i, (float(rng.randrange(0, 1000, 5)), float(rng.randrange(0, 1000, 5))), float(i % 7)) for i in range(n)] + [(n, None, 1.0)]
    return spark.createDataFrame(rows, "sid long, geometry struct<x:double,y:double>, value double")


def pairs(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def brute(base, enr, kinds):
    other = enr.withColumnRenamed("geometry", "enr_geometry")
    return base.crossJoin(other).withColumn("distance", geo.distance("geometry", "enr_geometry", kinds)).where("distance is not null")


@pytest.mark.parametrize("limit", [1.0, 40.0, 3000.0])
def test_within_equals_all_pairs(spark, limit):
    a, b = lines(spark, 60, 1), points(spark, 80, 2)
    assert pairs(match.within(a, b, limit, enr_id="sid"), "id", "sid") == pairs(brute(a, b, ("line", "point")).where(F.col("distance") <= limit), "id", "sid")


def test_within_of_lines_counts_each_pair_once(spark):
    a, b = lines(spark, 50, 3), lines(spark, 50, 4, 300).withColumnRenamed("id", "sid")
    assert pairs(match.within(a, b, 30, enr_id="sid"), "id", "sid") == pairs(brute(a, b, ("line", "line")).where("distance <= 30"), "id", "sid")


@pytest.mark.parametrize("k", [1, 3, 100])
def test_leaves_equal_all_pairs(spark, k):
    a, b = lines(spark, 30, 5), points(spark, 60, 6)
    want = match.top_k(brute(a, b, ("line", "point")), "id", [F.col("distance"), F.col("sid")], k)
    got = match.nearest(a, b, k, enr_id="sid", small_rows=0)
    assert pairs(got, "id", "sid") == pairs(want, "id", "sid")
    assert pairs(match.nearest(a, b, k, enr_id="sid"), "id", "sid") == pairs(want, "id", "sid")


def towns(spark, n, seed):
    """Two dense towns of 10 by 10 metres, 2,000 km apart, and some farms between them."""
    rng = random.Random(seed)
    spot = lambda i: ((rng.uniform(0, 10), rng.uniform(0, 10)), (2e6 + rng.uniform(0, 10), rng.uniform(0, 10)), (rng.uniform(-1e6, 3e6), rng.uniform(-1e6, 1e6)))[2 if i % 50 == 0 else i % 2]
    return spark.createDataFrame([(i, spot(i)) for i in range(n)], "id long, geometry struct<x:double,y:double>")


@pytest.mark.parametrize("k", [1, 4])
def test_uneven_tables_compare_few_rows(spark, k):
    base, enr = towns(spark, 2000, 1), towns(spark, 1500, 2).withColumnRenamed("id", "sid").withColumnRenamed("geometry", "g")
    compared = match.probed_pairs(base, enr, k, ("point", "point"), "geometry", "g").count()
    assert compared < (20 if k == 1 else 50) * 2000
    some = base.where("id % 20 = 0")
    want = match.top_k(some.crossJoin(enr).withColumn("distance", geo.distance("geometry", "g")), "id", [F.col("distance"), F.col("sid")], k)
    got = match.nearest(base, enr, k, enr_geom="g", enr_id="sid", small_rows=0)
    assert got.count() == 2000 * k
    assert pairs(got.where("id % 20 = 0"), "id", "sid") == pairs(want, "id", "sid")
    plan = got._jdf.queryExecution().toString()
    assert plan.count("== Optimized") == 1 and "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert plan[plan.index("== Physical") :].count("Join") == 1


def test_leaves_of_lines_and_areas(spark):
    a, b = lines(spark, 60, 31, 300), lines(spark, 70, 32, 200).withColumnRenamed("id", "sid")
    boxes = points(spark, 40, 33).where("geometry is not null").select("sid", geo.rectangle("geometry.x", "geometry.y", F.col("geometry.x") + F.col("sid") * 3, F.col("geometry.y") + 20).alias("geometry"))
    for enr, kind in ((b, "line"), (boxes, "polygon")):
        want = match.top_k(brute(a, enr, ("line", kind)), "id", [F.col("distance"), F.col("sid")], 3)
        assert pairs(match.nearest(a, enr, 3, enr_id="sid", small_rows=0), "id", "sid") == pairs(want, "id", "sid")


def test_probes_keep_every_neighbour():
    """The search by levels against all leaves, with ties, copies and places outside the index."""
    rng = np.random.default_rng(3)
    for n, k in ((1, 1), (17, 2), (700, 1), (5000, 7)):
        low = rng.integers(0, 50, (n, 2)).astype(float)
        boxes = np.hstack([low, low + rng.integers(0, 3, (n, 2))])
        counts = rng.integers(1, 4, n)
        levels = [(boxes, counts)]
        while len(levels[0][1]) > density.FANOUT:
            b, c = levels[0]
            first = np.arange(0, len(c), density.FANOUT)
            levels.insert(0, (np.hstack([np.minimum.reduceat(b[:, :2], first), np.maximum.reduceat(b[:, 2:], first)]), np.add.reduceat(c, first)))
        places = rng.uniform(-30, 80, (40, 2))
        got = density.probes(density.Index(None, None, levels), places, np.hstack([places, places]), k)
        for p, leaves in zip(places, got, strict=True):
            far = np.hypot(*np.maximum(np.abs(p - boxes[:, :2]), np.abs(p - boxes[:, 2:])).T)
            gap = np.hypot(*np.maximum(0, np.maximum(p - boxes[:, 2:], boxes[:, :2] - p)).T)
            order = np.argsort(far)
            enough = np.flatnonzero(np.cumsum(counts[order]) >= k)
            limit = far[order][enough[0]] if len(enough) else np.inf
            assert set(np.flatnonzero(gap <= limit)) <= set(leaves.tolist())


def test_nearest_of_nothing(spark):
    a = lines(spark, 3, 7)
    for small in (0, 10):
        assert match.nearest(a, points(spark, 0, 1), enr_id="sid", small_rows=small).count() == 0


def test_intersects_equals_all_pairs(spark):
    a = lines(spark, 80, 8)
    rng = random.Random(9)
    boxes = [(i, float(rng.randrange(900)), float(rng.randrange(900)), rng.randrange(1, 200)) for i in range(20)]
    b = spark.createDataFrame(boxes, "sid long, x double, y double, w int").select("sid", geo.rectangle("x", "y", F.col("x") + F.col("w"), F.col("y") + F.col("w")).alias("geometry"))
    other = b.withColumnRenamed("geometry", "enr_geometry")
    want = a.crossJoin(other).where(geo.intersects("geometry", "enr_geometry", ("line", "polygon")))
    for cell in (None, 7.0, 5000.0):
        assert pairs(match.intersects(a, b, cell=cell, enr_id="sid"), "id", "sid") == pairs(want, "id", "sid")
    kept = match.intersects(a, b, keep_unmatched=True, enr_id="sid")
    assert kept.select("id").distinct().count() == a.count()


def test_intersects_of_very_uneven_sizes(spark):
    rng = random.Random(10)
    widths = [0.5, 3.0, 30.0, 64.0, 400.0, 1000.0, 40_000.0, 3e6]
    boxes = [(i, float(rng.randrange(-50, 1000)), float(rng.randrange(-50, 1000)), widths[i % len(widths)]) for i in range(41)]
    box = F.when(F.col("sid") < 40, geo.rectangle("x", "y", F.col("x") + F.col("w"), F.col("y") + F.col("w")))
    b = spark.createDataFrame(boxes, "sid long, x double, y double, w double").select("sid", box.alias("geometry"))
    p = points(spark, 120, 11).withColumnRenamed("sid", "id")
    for a, kind in ((lines(spark, 80, 12, 500), "line"), (p, "point"), (b.withColumnRenamed("sid", "id"), "polygon")):
        want = a.crossJoin(b.withColumnRenamed("geometry", "enr_geometry")).where(geo.intersects("geometry", "enr_geometry", (kind, "polygon")))
        got = match.intersects(a, b, enr_id="sid")
        assert got.columns == [*a.columns, "sid", "enr_geometry"]
        assert pairs(got, "id", "sid") == pairs(want, "id", "sid")
    assert match.intersects(p.limit(0), b, enr_id="sid").count() == 0
    twice = points(spark, 50, 13)
    want = p.crossJoin(twice.withColumnRenamed("geometry", "enr_geometry")).where("geometry = enr_geometry")
    assert pairs(match.intersects(p, twice, enr_id="sid"), "id", "sid") == pairs(want, "id", "sid")


def test_levels_take_one_join(spark):
    a, b = lines(spark, 30, 5), lines(spark, 30, 6, 400).withColumnRenamed("id", "sid")
    plan = match.intersects(a, b, enr_id="sid")._jdf.queryExecution().toString()
    assert plan[plan.index("== Physical") :].count("Join") == 1


@pytest.mark.parametrize("limit", [0.0, 5.0, 400.0])
def test_edges_within_equal_all_pairs(spark, limit):
    a, b = lines(spark, 40, 21, 400), lines(spark, 40, 22, 150).withColumnRenamed("id", "sid")
    spots = points(spark, 60, 23)
    for enr, kind in ((b, "line"), (spots, "point")):
        want = brute(a, enr, ("line", kind)).where(F.col("distance") <= limit)
        got = match.lines_within(a, enr, limit, enr_id="sid")
        wanted, found = ({(r["id"], r["sid"]): r["distance"] for r in x.collect()} for x in (want, got))
        # all pairs by geo.distance, which knows none between two lines of one point each; edges do
        place = lambda df, key: {r[key]: r["geometry"][0] for r in df.collect() if r["geometry"] and kind == "line" and len(r["geometry"]) == 1}
        mine, theirs = place(a, "id"), place(enr, "sid") if kind == "line" else {}
        both = {(i, j): math.dist(p, q) for i, p in mine.items() for j, q in theirs.items()}
        wanted |= {k: d for k, d in both.items() if d <= limit}
        assert found == {k: pytest.approx(d, abs=1e-9) for k, d in wanted.items()}
    same = match.lines_within(a, a, limit).columns
    assert same == ["id", "enr_id", "distance"]


def test_ranges_equal_all_pairs(spark):
    rng = random.Random(6)
    spans = [0, 0.5, 3, 40, 5000]
    rows = [(i, v := rng.uniform(-100, 100), v + rng.choice(spans) * rng.random(), rng.uniform(-9, 9)) for i in range(150)] + [(200, None, 1.0, 1.0), (201, 5.0, 4.0, 1.0), (202, 1.0, None, 0.0)]
    a = spark.createDataFrame(rows, "id long, low double, high double, z double")
    b = a.where("id % 2 = 0").withColumnsRenamed({"id": "sid"}).withColumn("low", F.col("low") + 2)
    one, two = ("low", "high", "low", "high"), ("z", "z", "z - 2", "z + 1")
    every = a.crossJoin(b.select("sid", F.col("low").alias("enr_low"), F.col("high").alias("enr_high"), F.col("z").alias("enr_z"))).where("low <= high and enr_low <= enr_high")
    meet = every.where("low <= enr_high and enr_low <= high")
    got = match.range_pairs(a, b, [one])
    assert got.columns == every.columns and pairs(got, "id", "sid") == pairs(meet, "id", "sid") != []
    both = meet.where("z between enr_z - 2 and enr_z + 1 and id > sid")
    found = match.range_pairs(a, b, [one, two], "id > sid")
    assert pairs(found, "id", "sid") == pairs(both, "id", "sid") != []
    plan = found._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    with pytest.raises(ValueError, match="ranges"):
        match.range_pairs(a, b, [])


def test_points_in_polygons_of_many_corners(spark):
    rng = random.Random(8)

    def star(n, cx, cy, r):
        turn = lambda i: 2 * math.pi * i / n
        return [(float(round(cx + (s := rng.uniform(r / 3, r)) * math.cos(turn(i)))), float(round(cy + s * math.sin(turn(i))))) for i in range(n)]

    comb = [(float(x), y) for x in range(0, 400, 2) for y in ((0.0, 300.0) if x % 4 else (300.0, 0.0))] + [(400.0, -10.0), (0.0, -10.0)]
    rings = [[star(400, 300, 300, 300), star(40, 300, 300, 60)], [star(5, 100, 700, 90)], [comb], [[(0.0, 0.0), (9.0, 0.0), (4.0, 0.0)]], [], None]
    areas = spark.createDataFrame(list(enumerate(rings)), "sid int, geometry array<array<struct<x:double,y:double>>>")
    spots = [(float(rng.randrange(-20, 700)), float(rng.randrange(-20, 900))) for _ in range(400)] + rings[0][0][:50] + comb[:30] + [(4.0, 0.0), (5.5, 0.0)]
    points_ = spark.createDataFrame([*enumerate(spots), (9999, None)], "id int, geometry struct<x:double,y:double>")
    want = points_.crossJoin(areas.withColumnRenamed("geometry", "g")).where(geo.intersects("geometry", "g", ("point", "polygon")))
    got = match.inside(points_, areas, enr_id="sid")
    assert pairs(got, "id", "sid") == pairs(want, "id", "sid")
    assert {r["sid"] for r in got.collect()} == {0, 1, 2, 3}


def test_own_predicate_warns(spark):
    a, b = lines(spark, 5, 1), points(spark, 5, 2)
    with pytest.warns(UserWarning, match="all pairs"):
        assert match.within(a, b, 0, predicate="id = sid", enr_id="sid").count() == 6


def test_bounded_predicate_joins_on_the_grid(spark):
    a, b = lines(spark, 40, 1), points(spark, 40, 2)
    got = match.within(a, b, 30, predicate="(id + sid) % 2 = 0", enr_id="sid", bounded=True)
    want = match.within(a, b, 30, enr_id="sid").where("(id + sid) % 2 = 0")
    assert pairs(got, "id", "sid") == pairs(want, "id", "sid") != []
    assert "CartesianProduct" not in (plan := got._jdf.queryExecution().toString()) and "NestedLoop" not in plan


def test_bounds_through_presets(spark):
    a, b = lines(spark, 30, 1), points(spark, 40, 2)
    order = "abs(geometry[0].x - enr_geometry.x) + abs(geometry[0].y - enr_geometry.y)"
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        near = presets.map_preset("nearest_k", a, b, {"k": 2, "order_by": order, "bound": 1.0, "small_rows": 0}, enr_id="sid")
        some = presets.map_preset("within_distance", a, b, {"distance": 60, "predicate": "value > 2", "bounded": True}, enr_id="sid")
        assert near.count() == 60
    with pytest.warns(UserWarning, match="all pairs"):
        want = match.nearest(a, b, 2, order, enr_id="sid", small_rows=0)
    assert pairs(near, "id", "sid") == pairs(want, "id", "sid")
    assert pairs(some, "id", "sid") == pairs(match.within(a, b, 60, enr_id="sid").where("value > 2"), "id", "sid")


def test_clashing_columns_and_key_join(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string")
    b = spark.createDataFrame([(1, "x"), (3, "z")], "id long, name string")
    assert match.key_join(a, b, "id", "id", "left").orderBy("id").collect() == [(1, "a", 1, "x"), (2, "b", None, None)]
    assert match.key_join(a, b, "id", "id", columns=[]).columns == ["id", "name", "enr_id"]
    with pytest.raises(ValueError, match="how"):
        match.key_join(a, b, "id", "id", "cross")


def test_null_values_in_weights(spark):
    p = spark.createDataFrame([(1, 1.0, 10.0), (1, 1.0, None), (2, 0.0, 5.0), (3, 2.0, None)], "id int, distance double, v double")
    got = {r["id"]: r["v"] for r in reduce.idw(p, "id", ["v"]).collect()}
    assert got == {1: 5.0, 2: 5.0, 3: None}
    assert {r["id"]: r["v"] for r in reduce.idw(p, "id", ["v"], skip_null_weights=True).collect()} == {1: 10.0, 2: 5.0, 3: None}


def test_arrays_of_different_length(spark):
    p = spark.createDataFrame([(1, 1.0, [1.0, 2.0]), (1, 1.0, [3.0]), (2, 1.0, None)], "id int, distance double, a array<double>")
    assert reduce.idw_arrays(p, "id", ["a"]).collect() == [(1, [2.0, 2.0], 1.0)]  # a place that a neighbour lacks is not its


def test_arrays_equal_exploded_means(spark):
    rng = random.Random(2)
    value = lambda: rng.choice([None, rng.uniform(-5, 5), 2.0])
    rows = [(i % 9, rng.uniform(0, 3), [value() for _ in range(rng.randrange(5))] if rng.random() < 0.8 else None, [value() for _ in range(rng.randrange(5))]) for i in range(60)]
    p = spark.createDataFrame(rows, "id int, distance double, a array<double>, b array<double>")
    want = {}
    for base in range(9):
        own = [(1 / max(d, 0.001) ** 2, a, b) for i, d, a, b in rows if i == base and a is not None and max(len(a), len(b))]
        place = lambda x, i: x[i] if i < len(x) else None
        means = []
        for which in (1, 2):
            out = []
            for i in range(max((max(len(a), len(b)) for _, a, b in own), default=0)):
                there = [(w, place((a, b)[which - 1], i)) for w, a, b in own if i < max(len(a), len(b))]
                some = [w * v for w, v in there if v is not None]
                out.append(sum(some) / sum(w for w, _ in there) if some else None)
            means.append(out)
        if own:
            want[base] = means
    got = {r["id"]: [r["a"], r["b"]] for r in reduce.idw_arrays(p, "id", ["a", "b"]).collect()}
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert [[None if x is None else pytest.approx(x) for x in c] for c in v] == got[k]


def test_lists_of_unmatched_rows(spark):
    p = spark.createDataFrame([(1, None), (2, 5), (2, 3), (2, None)], "id int, v int")
    got = {r["id"]: r for r in reduce.reduce_agg(p, "id", {"a": reduce.json_list("v"), "b": reduce.json_list("v", keep_nulls=True)}).collect()}
    assert (got[1]["a"], got[1]["b"]) == ("[]", "[null]")
    assert got[2]["a"] == "[3,5]"


def test_presets_and_guards(spark):
    a, b = lines(spark, 20, 1), points(spark, 20, 2)
    for name in ("knn", "nearest_neighbour", "nearest_station"):
        assert presets.map_preset(name, a, b, enr_id="sid").count() == 20
    for name in ("idw", "inverse_distance", "inverse_distance_weighting"):
        assert presets.map_preset(name, a, b, None, {"values": ["value"]}, enr_id="sid").count() == 20
    assert presets.tidy_filter(" WHERE a = 1 ; ") == "a = 1"
    with pytest.raises(ValueError, match="needs a nearest"):
        presets.map_to_base(a, b, {"type": "within"}, {"type": "idw", "values": ["value"]}, enr_id="sid")
    with pytest.raises(ValueError, match="not both"):
        presets.map_to_base(a, b, {"type": "nearest"}, {"type": "idw"}, enr_id="sid")
    with pytest.raises(ValueError, match="unknown preset"):
        presets.map_preset("guess", a, b)
    assert presets.map_to_base(a, None, {"type": "nearest"}, staging=b, enr_id="sid", enrichment_filter="value > 2").count() == 20
    target = spark.createDataFrame([(0, -1), (99, 5)], "way_id long, sid long")
    rows = presets.map_preset("knn", a, b, enr_id="sid", project={"way_id": "id", "sid": "sid"})
    assert presets.store_mapping(target, rows, {"type": "nearest", "k": 1}, None).count() == 21


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_limited_within_makes_no_pairs_of_cells(spark):
    a, b = lines(spark, 40, 31), points(spark, 300, 32)
    got = match.within(a, b, 60, limit=2, enr_id="sid")
    assert "__cell" not in plan_of(got) and "__leaf" in plan_of(got)
    want = match.top_k(brute(a, b, ("line", "point")).where("distance <= 60"), "id", [F.col("distance"), F.col("sid")], 2)
    assert pairs(got, "id", "sid") == pairs(want, "id", "sid")


def test_leaves_of_large_tables_stay_small():
    for rows in (1_200_000, 7_200_000):
        assert rows / density.wanted_leaves(rows) <= 18
    assert density.wanted_leaves(1000) == 500 and density.wanted_leaves(1) == 1


def test_rows_dealt_to_leaves_or_cells_are_not_broadcast(spark):
    a, b = lines(spark, 40, 33), points(spark, 300, 34)
    nearest = match.nearest(a, b, 2, enr_id="sid", small_rows=0)
    boxes = match.intersects(a, lines(spark, 40, 35).withColumnRenamed("id", "sid"), enr_id="sid")
    for df in (nearest, boxes):
        assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()


def test_cuts_in_two_steps_are_even(spark):
    keys = spark.range(50_000).selectExpr("id * id as key")
    starts = density._cuts(keys, 900)
    sizes = np.diff(np.append(np.searchsorted(np.arange(50_000, dtype=np.int64) ** 2, starts), 50_000))
    assert 850 <= len(starts) <= 1000 and sizes.max() <= 120


@pytest.mark.parametrize("reach", [0, 60])
def test_unmatched_are_kept_and_grouped_without_shuffling_pairs(spark, reach):
    a, b = lines(spark, 60, 41, reach), points(spark, 120, 42)
    a = a.where("size(geometry) <= 2 or geometry is null") if reach == 0 else a
    near = brute(a, b, ("line", "point")).where("distance <= 45").groupBy("id").agg(F.count("*").alias("n"))
    want = a.join(near, "id", "left").select("id", F.coalesce("n", F.lit(0)).alias("n"))
    got = presets.map_preset("aggregate_within_distance", a, b, {"distance": 45}, {"aggs": {"n": F.count("sid")}}, enr_id="sid")
    assert got.columns == ["id", "n"] and pairs(got, "id", "n") == pairs(want, "id", "n")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("SortMergeJoin")[0]  # nothing is shuffled after the join
