import math
import random
import pytest
from pyspark.sql import functions as F

from segloom.functions import geo
from segloom.operators import enrich, network, raster, records, sync


def test_upsert_nulls_and_idempotence(spark):
    t = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k int, v string")
    s = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, None)], "k int, v string")
    status = {r["k"]: r["change"] for r in sync.upsert_status(t, s, ["k"]).collect()}
    assert status == {1: "unchanged", 2: "updated", 3: "updated", 4: "inserted"}
    once = sync.upsert_changed(t, s, ["k"])
    assert sync.upsert_counts(once, s, ["k"]).first().asDict() == {"inserted": 0, "updated": 0, "unchanged": 4}


def test_repeated_source_keys(spark):
    t = spark.createDataFrame([(1, 0, 0)], "k int, v int, o int")
    s = spark.createDataFrame([(1, 5, 1), (1, 6, 2)], "k int, v int, o int")
    with pytest.raises(Exception, match="comes twice"):
        sync.upsert_changed(t, s, ["k"]).collect()
    assert sync.upsert_changed(t, s, ["k"], order_by="o").collect() == [(1, 6, 2)]


def test_change_set_leads_from_old_to_new(spark):
    old = spark.createDataFrame([(1, 1, "a"), (2, 2, "b"), (3, 3, "c")], "id int, k int, content_hash string")
    new = spark.createDataFrame([(1, 1, "a"), (2, 2, "x"), (9, 4, "d")], "id int, k int, content_hash string")
    c = sync.change_set(old, new, ["k"])
    assert sorted((r["base_id"], r["op"]) for r in c.collect()) == [(2, "modified"), (3, "removed"), (9, "added")]
    rest = old.join(c.where("op <> 'added'"), "k", "left_anti")
    rebuilt = rest.unionByName(new.join(c.where("op <> 'removed'"), "k", "left_semi"))
    assert sorted(rebuilt.select(*new.columns).collect()) == sorted(new.collect())
    with pytest.raises(ValueError, match="aggregates"):
        sync.incremental_map(old, old, c, lambda d: d, aggregating=True)


def test_content_hash_of_nulls(spark):
    df = spark.sql("select cast(null as array<struct<x:double,y:double>>) g, cast(null as int) a, 1 b")
    assert df.select(F.hex(sync.content_hash("g", "a", "b")) == F.upper(F.md5(F.lit("||1")))).first()[0]


def test_normalize_without_spread_and_condition(spark):
    df = spark.createDataFrame([(1, 5), (2, 5)], "k int, v int")
    assert [r["s"] for r in enrich.normalize(df, "v", "s").collect()] == [None, None]
    df = spark.createDataFrame([(1, 0), (2, 10), (3, 4)], "k int, v int")
    got = {r["k"]: r["s"] for r in enrich.normalize(df, "v", "s", "minmax", "k <> 2").collect()}
    assert got == {1: 0.0, 2: None, 3: 0.4}
    with pytest.raises(ValueError, match="minmax"):
        enrich.normalize(df, "v", "s", "rank")


def test_derive_keeps_old_values(spark):
    df = spark.createDataFrame([(1, 1), (2, None)], "k int, v int")
    assert sorted(enrich.derive(df, "v", "v + 1", "v > 0").collect()) == [(1, 2), (2, None)]


def test_aggregate_without_group(spark):
    df = spark.createDataFrame([(1,), (3,)], "v int")
    assert enrich.aggregate(df, {}, {"m": ("avg", "v"), "n": ("count", "*")}).collect() == [(2.0, 2)]
    with pytest.raises(ValueError, match="unknown aggregate"):
        enrich.aggregate(df, {}, {"m": ("median", "v")})


def test_bands(spark):
    df = spark.createDataFrame([(v,) for v in (None, -1.0, 0.0, 0.5, 10.0, 25.0)], "v double")
    got = [r[0] for r in df.select(enrich.band("v", [(20, "large"), (10, "medium"), (0, "small")], "unknown")).collect()]
    assert got == ["unknown", "unknown", "unknown", "small", "medium", "large"]


def test_dedup_fill_only_blanks(spark):
    df = spark.createDataFrame([(1, 1, "", None), (1, 2, "b", "x"), (1, 3, "c", "y"), (2, 1, "k", "")], "k int, o int, a string, b string")
    assert sorted(records.dedup_fill(df, ["k"], ["a", "b"], "o").select("k", "a", "b").collect()) == [(1, "b", "x"), (2, "k", "")]


def test_flatten_drops_documents_without_source(spark):
    df = spark.sql("select * from values (array(named_struct('t', 1, 'w', 2.0)), 'a'), (array(named_struct('t', 3, 'w', 4.0)), null) as v(weather, src)")
    assert [tuple(r) for r in records.flatten_children(df, "weather", {"station": F.col("src")}).collect()] == [("a", 1, 2.0)]


def test_cells_last_write_wins(spark):
    p = spark.createDataFrame([(0.0, 10.0, 1.0, 1), (9.0, 9.5, 2.0, 2), (25.0, 0.0, -9999.0, 3)], "x double, y double, z double, o int")
    assert sorted((r["col"], r["row"], r["z"]) for r in raster.to_cells(p, 10, "o").collect()) == [(0, 0, 2.0), (2, 1, None)]


def test_profile_of_a_slope(spark):
    cells = spark.createDataFrame([(c, 0, float(c * 2)) for c in range(10)], "col long, row long, z double")
    rows = [(1, [(0.0, 5.0), (85.0, 5.0)]), (2, [(0.0, 500.0), (50.0, 500.0)]), (3, None), (4, [(5.0, 5.0), (5.0, 5.0)])]
    lines = spark.createDataFrame(rows, "id int, geometry array<struct<x:double,y:double>>")
    got = {r["way_id"]: r for r in raster.elevation_stats(lines, cells, 10, (0.0, 10.0)).collect()}
    assert (got[1]["total_ascent"], got[1]["total_descent"], got[1]["max_slope"], got[1]["sample_count"]) == (16.0, 0.0, 0.2, 9)
    assert all((got[k]["total_ascent"], got[k]["avg_slope"], got[k]["sample_count"]) == (0.0, 0.0, 0) for k in (2, 3, 4))


def test_samples_lie_where_the_line_is(spark, monkeypatch):
    """Lines of many edges, of repeated points, without length; and their samples are made outside of nested expressions."""
    monkeypatch.setattr(raster, "SAMPLES", 50)
    rng = random.Random(5)
    rows = [(k, [(rng.uniform(0, 40), rng.uniform(0, 40)) for _ in range(rng.randrange(2, 9))]) for k in range(40)]
    rows += [(40, [(0.0, 0.0), (0.0, 0.0), (6.0, 8.0), (6.0, 8.0)]), (41, [(1.0, 1.0), (1.0, 1.0)]), (42, None), (43, []), (44, [(2.0, 2.0)]), (45, [(0.0, 0.0), (2000.0, 0.0)])]
    lines = spark.createDataFrame(rows, "id int, geometry array<struct<x:double,y:double>>")
    sampled = raster.sample_lines(lines, "geometry", 2.5)
    assert sampled.columns == ["id", "geometry", "length", "i", "point"]
    got = {(r["id"], r["i"]): r for r in sampled.collect()}
    last = F.greatest(F.lit(1), F.ceil(F.col("length") / 2.5).cast("int"))
    plain = lines.withColumn("length", geo.length("geometry")).where("length > 0").withColumn("i", F.explode(F.sequence(F.lit(0), last)))
    want = plain.withColumn("point", geo.interpolate("geometry", F.least(F.lit(1.0), F.col("i") * 2.5 / F.col("length")))).collect()
    assert len(want) == len(got) == sampled.count() and {r["id"] for r in want} == {*range(41), 45}
    for r in want:
        assert tuple(got[r["id"], r["i"]]["point"]) == pytest.approx(tuple(r["point"]), abs=1e-9)
        assert got[r["id"], r["i"]]["geometry"] == r["geometry"]
    plan = raster.sample_lines(lines, "geometry", 2.5, ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" not in plan and "MapInArrow" in plan


NODES = [(1, {}), (2, {"barrier": "Gate", "foot": "yes", "hgv": "no"}), (3, {}), (4, {}), (5, {"barrier": "moat"}), (6, {})]
WAYS = [
    (10, [1, 2, 3, 4], {"highway": "residential", "name": "", "ref": "B1", "maxspeed": "30 mph", "oneway": "-1", "oneway:bicycle": "no", "foot": "designated"}),
    (11, [5, 3, 6], {"Highway": "construction", "construction": "primary", "surface": "COBBLESTONE:flattened", "smoothness": "very_good", "lit": "24/7"}),
    (12, [6, 99], {"highway": "path"}),
    (13, [1, 6], {"waterway": "river"}),
]
RELATIONS = [
    (20, [("from", "w", 10), ("via", "node", 3), ("to", "w", 11)], {"type": "restriction", "restriction:hgv": "no_left_turn", "except": "bicycle;cart"}),
    (21, [("From", "way", 10), ("from", "way", 12), ("via", "way", 11), ("to", "way", 11)], {"type": "restriction", "restriction": "no_entry"}),
    (22, [("from", "way", 10), ("from", "way", 12), ("via", "node", 3), ("to", "way", 11)], {"type": "restriction", "restriction": "no_u_turn"}),
    (23, [("from", "way", 10), ("to", "way", 11)], {"type": "restriction", "restriction": "no_u_turn"}),
    (24, [("from", "way", 10), ("via", "node", 3), ("to", "way", 11)], {"type": "route"}),
]


@pytest.fixture
def roads(spark):
    nodes = spark.createDataFrame([(i, 52 + i / 100, 13.0, t) for i, t in NODES], "id long, lat double, lon double, tags map<string,string>")
    ways = spark.createDataFrame(WAYS, "id long, nodes array<long>, tags map<string,string>")
    relations = spark.createDataFrame(RELATIONS, "id long, members array<struct<role:string,type:string,ref:long>>, tags map<string,string>")
    return nodes, ways, relations


def test_heights_from_tiles_equal_cells(spark):
    rng = random.Random(7)
    held = {(rng.randrange(-70, 70), rng.randrange(-70, 70)): rng.choice([None, -9999.0, rng.uniform(0, 50)]) for _ in range(6000)}
    cells = spark.createDataFrame([(c, r, z) for (c, r), z in held.items()], "col long, row long, z double")
    spots = [(rng.randrange(12), i, (rng.uniform(-800, 800), rng.uniform(-800, 800))) for i in range(900)]
    samples = spark.createDataFrame(spots, "id int, i int, point struct<x:double,y:double>")
    tiles = raster.to_tiles(cells)
    assert tiles.where(F.size("heights") != raster.TILE**2).count() == 0 and tiles.count() <= 36
    want = {}
    for line, i, (x, y) in sorted(spots):
        z = held.get((math.floor((x - 3) / 10), math.floor((5 - y) / 10)))
        if z is not None and z != -9999.0:
            want.setdefault(line, []).append((i, z))
    got = raster.heights_along(samples, tiles, 10, (3.0, 5.0), "id").collect()
    assert {r["id"]: [tuple(h) for h in r["heights"]] for r in got} == want


def test_links_and_dropped_index(roads):
    nodes, ways, _ = roads
    got = sorted((r["way_id"], r["way_link_index"], r["start_node_id"], r["end_node_id"], len(r["geometry"])) for r in network.split_links(nodes, ways).collect())
    assert got == [(10, 0, 1, 2, 2), (10, 1, 2, 3, 2), (10, 2, 3, 4, 2), (11, 0, 5, 3, 2), (11, 1, 3, 6, 2)]
    # without node 2 the first two links of way 10 have one known node each; the third keeps index 2
    some = network.split_links(nodes.where("id <> 2"), ways, network.barrier_nodes(nodes))
    assert [r["way_link_index"] for r in some.where("way_id = 10").collect()] == [2]


def test_barriers(roads):
    assert [tuple(r) for r in network.barrier_nodes(roads[0]).collect()] == [(2, "gate", ["foot"], ["hgv"])]


def test_tags(roads):
    got = {r["way_id"]: r for r in network.link_tags(roads[1]).collect()}
    a, b = got[10], got[11]
    assert (a["name"], round(a["max_speed_forward"], 3), a["direction"]) == ("B1", 48.280, -1)
    assert a["mode_directions"] == {"foot": -1, "access": 0, "bicycle": 2}
    assert (b["surface"], b["smoothness"], b["attributes"], b["highway_class"]) == ("sett", "excellent", ["LIT"], None)
    assert 13 not in got


def test_turns(roads):
    nodes, ways, relations = roads
    t = network.turn_restrictions(relations)
    assert sorted((r["relation_id"], r["from_way"], r["restriction"], r["modes"], r["modes_except"]) for r in t.collect()) == [
        (20, 10, "no_left_turn", ["hgv"], ["bicycle"]), (21, 10, "no_entry", [], None), (21, 12, "no_entry", [], None)]
    links = network.turn_links(t, network.split_links(nodes, ways))
    got = {(r["relation_id"], r["from_way"]): (r["from_link"], r["from_direction"], r["to_link"], r["to_direction"]) for r in links.collect()}
    assert got[20, 10] == (0, 0, 1, 0)  # node 3 is inside both ways
    assert got[21, 12] == (None, None, 0, 2)


def test_mode_tree(spark):
    e = network.mode_edges(spark)
    assert e.where("parent = 'access'").count() == 6
    assert e.where("child = 'dog'").first()["parent"] == "foot"
