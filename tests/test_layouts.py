"""Tables in buckets and along a curve: what they read and rewrite, and that rows are those of the plain way."""

import random

import pytest
from pyspark.sql import functions as F

from segloom.functions import curve, geo
from segloom.operators import sync
from segloom.sources import buckets, layout

SCHEMA = "k long, v string, tags array<string>"


def rows(df):
    return sorted((r["k"], r["v"], tuple(r["tags"] or ())) for r in df.collect())


@pytest.fixture
def table(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    df = spark.createDataFrame([(i, f"v{i}", ["a", str(i % 3)]) for i in range(2000)], SCHEMA)
    buckets.create(df, path, ["k"], 20)
    return path, df


def of_buckets(df, wanted):
    return df.where(F.pmod(F.xxhash64("k"), F.lit(20)).isin(*wanted))


def test_a_batch_rewrites_its_buckets_only(spark, table):
    path, df = table
    batch = of_buckets(df, [3, 4]).where("k % 10 = 0").withColumn("v", F.lit("new"))
    before = {r["bucket"]: r["folder"] for r in buckets.manifest(spark, path)}
    assert buckets.upsert(batch, path) == [3, 4]
    after = {r["bucket"]: r["folder"] for r in buckets.manifest(spark, path)}
    assert {b for b in before if before[b] != after[b]} == {3, 4}
    assert rows(buckets.read(spark, path)) == rows(sync.upsert_changed(df, batch, ["k"]))
    assert rows(buckets.read(spark, path, 0)) == rows(df)
    assert buckets.upsert(batch, path) == []
    assert rows(buckets.read(spark, path)) == rows(sync.upsert_changed(df, batch, ["k"]))
    old, new = buckets.changes(spark, path, 0, 2)
    assert old.count() == new.count() == of_buckets(df, [3, 4]).count()


def test_new_keys_and_null_keys(spark, table):
    path, df = table
    batch = spark.createDataFrame([(5000, "x", None), (None, "n", []), (7, None, None)], SCHEMA)
    buckets.upsert(batch, path)
    assert sorted(map(str, buckets.read(spark, path).collect())) == sorted(map(str, sync.upsert_changed(df, batch, ["k"]).collect()))
    with pytest.raises(Exception, match="a key comes twice"):
        buckets.upsert(spark.createDataFrame([(1, "x", None), (1, "y", None)], SCHEMA), path)


def test_sync_follows_the_source(spark, table):
    path, df = table
    source = df.where("k <> 17").withColumn("v", F.when(F.col("k") == 40, "other").otherwise(F.col("v")))
    touched = {r[0] for r in df.where("k in (17, 40)").select(F.pmod(F.xxhash64("k"), F.lit(20))).collect()}
    assert set(buckets.sync(source, path)) == touched
    assert rows(buckets.read(spark, path)) == rows(source)
    assert buckets.sync(source.repartition(7), path) == []
    buckets.sync(source.limit(0), path)
    assert buckets.read(spark, path).count() == 0
    buckets.sync(df, path)
    assert rows(buckets.read(spark, path)) == rows(df)


def test_a_broken_off_batch_leaves_the_version(spark, table):
    path, df = table
    broken = df.limit(50).withColumn("v", F.when(F.col("k") >= 0, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        buckets.upsert(broken, path)
    assert buckets.versions(spark, path)[-1][0] == 0
    assert rows(buckets.read(spark, path)) == rows(df)
    buckets.upsert(df.limit(5).withColumn("v", F.lit("z")), path)
    buckets.drop_old(spark, path, 1)
    assert len(buckets.versions(spark, path)) == 1
    assert buckets.read(spark, path).where("v = 'z'").count() == 5 and buckets.read(spark, path).count() == 2000


def test_empty_tables(spark, tmp_path):
    path = f"file://{tmp_path}/e"
    none = spark.createDataFrame([], SCHEMA)
    assert buckets.read(spark, path) is None
    with pytest.raises(ValueError, match="no table"):
        buckets.upsert(none, path)
    buckets.create(none, path, ["k"], 4)
    assert buckets.upsert(none, path) == [] and buckets.read(spark, path).schema == none.schema
    buckets.upsert(spark.createDataFrame([(1, "a", None)], SCHEMA), path)
    assert buckets.read(spark, path).count() == 1


# --- curve


def interleaved(x, y):
    return sum(((y >> i & 1) << (2 * i + 1)) | ((x >> i & 1) << (2 * i)) for i in range(curve.BITS))


def test_keys_take_digits_in_turn(spark):
    rng = random.Random(2)
    frame = curve.Frame(-10.0, 5.0, 100.0)
    places = [(rng.uniform(-10, 90), rng.uniform(5, 105)) for _ in range(200)] + [(-50.0, 300.0), (89.999999, 5.0)]
    df = spark.createDataFrame(places, "x double, y double").select("x", "y", curve.z_key(F.col("x"), F.col("y"), frame).alias("k"))
    for r in df.collect():
        assert r["k"] == interleaved(frame.cell(r["x"], frame.x), frame.cell(r["y"], frame.y))


@pytest.mark.parametrize("most", [1, 4, 32])
def test_ranges_cover_the_box(most):
    rng = random.Random(most)
    frame = curve.Frame(0.0, 0.0, 1000.0)
    for _ in range(40):
        x, y, w, h = rng.uniform(-100, 1000), rng.uniform(-100, 1000), rng.uniform(0, 300), rng.uniform(0, 300)
        found = curve.box_ranges(frame, (x, y, x + w, y + h), most)
        assert len(found) <= max(most, 4) + 3 and all(a <= b for a, b in found) and found == sorted(found)
        for _ in range(60):
            px, py = rng.uniform(x, x + w), rng.uniform(y, y + h)
            key = interleaved(frame.cell(px, 0.0), frame.cell(py, 0.0))
            assert any(a <= key <= b for a, b in found)


def scanned(df):
    """Rows that the scan of the table gave after skipping row groups."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_box_reads_few_rows(spark, tmp_path):
    path = f"file://{tmp_path}/places"
    n = 200_000
    df = spark.range(n).select("id", geo.point((F.col("id") * 7919 % 10007).cast("double"), (F.col("id") * 104729 % 10009).cast("double")).alias("geometry"))
    box = (4000.0, 3000.0, 5000.0, 4000.0)  # 1 % of the plane
    layout.write_by_place(df, path, geo.envelope("geometry", "point"), 8 << 10)
    got = layout.read_box(spark, path, box)
    assert got.columns == df.columns
    want = df.where(geo.bbox_intersects("geometry", "point", box))
    assert sorted(r["id"] for r in got.collect()) == sorted(r["id"] for r in want.collect())
    assert 0 < scanned(layout.read_box(spark, path, box)) < n * 0.05
    plan = got._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(curve_" in plan


def test_boxes_of_lines_and_odd_rows(spark, tmp_path):
    rng = random.Random(5)
    spot = lambda r: (float(rng.randrange(-r, r)), float(rng.randrange(-r, r)))
    data = [(i, [spot(1000), spot(1000)] if i % 3 else [(5.0, 5.0)], {"a": "b"}) for i in range(300)] + [(-1, None, None), (-2, [], None)] * 20
    df = spark.createDataFrame(data, "id long, geometry array<struct<x:double,y:double>>, tags map<string,string>")
    path = f"file://{tmp_path}/lines"
    layout.write_by_place(df, path, geo.envelope("geometry", "line"), 4096)
    assert spark.read.parquet(f"{path}/rows").count() == df.count()
    for box in ((0.0, 0.0, 10.0, 10.0), (-2000.0, -2000.0, 2000.0, 2000.0), (5000.0, 5000.0, 6000.0, 6000.0), (-700.0, 100.0, -690.0, 900.0)):
        want = sorted(r["id"] for r in df.where(geo.bbox_intersects("geometry", "line", box)).collect())
        assert sorted(r["id"] for r in layout.read_box(spark, path, box).collect()) == want
    empty = f"file://{tmp_path}/empty"
    layout.write_by_place(df.limit(0), empty, geo.envelope("geometry", "line"))
    assert layout.read_box(spark, empty, (0.0, 0.0, 1.0, 1.0)).count() == 0
