import gzip
import io
import json
import time
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segloom.sources import buckets, clouds, files, readers, sinks
from segloom.streaming import jobs


def test_tables(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,v\n1,x\n2,\n")
    (tmp_path / "a.tsv").write_text("k\tv\n1\tx,y\n")
    (tmp_path / "a.json").write_text(json.dumps([{"k": 1}, {"k": 2}]))
    assert readers.read_table(spark, f"{tmp_path}/a.csv", "csv").collect() == [(1, "x"), (2, None)]
    assert readers.read_table(spark, f"{tmp_path}/a.tsv", "tsv").collect() == [(1, "x,y")]
    assert readers.read_table(spark, f"{tmp_path}/a.json", "json", "k int").count() == 2
    with pytest.raises(ValueError, match="unknown kind"):
        readers.read_table(spark, "x", "xls")


def test_features(spark, tmp_path):
    good = {"type": "Feature", "properties": {"a": 1, "b": "x"}, "geometry": {"type": "Point", "coordinates": [13.405, 52.52]}}
    bad = [{"properties": {"a": 2}, "geometry": None}, {"properties": {"a": 3}, "geometry": {"type": "Point", "coordinates": []}}]
    with gzip.open(tmp_path / "f.json.gz", "wt") as f:
        json.dump({"type": "FeatureCollection", "features": [good, *bad]}, f)
    rows, wrong = readers.read_features(spark, f"{tmp_path}/f.json.gz", {"a": "int", "b": "string"}, 4326, 25833)
    r = rows.collect()
    assert (len(r), r[0]["a"], round(r[0]["geometry"]["x"])) == (1, 1, 391779)
    assert wrong.count() == 2


def test_feed(spark, tmp_path):
    link = '<link href="http://h/{}"/>'
    (tmp_path / "f.xml").write_text("<feed><entry>" + link.format("a.zip") + link.format("b.txt") + "</entry><entry>" + link.format("c.zip") + "</entry></feed>")
    assert [r[0] for r in readers.feed_links(spark, f"{tmp_path}/f.xml").collect()] == ["http://h/a.zip"]


def test_point_clouds(spark, tmp_path):
    text = "1 2 3\n4,5,6.5\n7 8\nx y z\n\n  9\t10  11  \n"
    (tmp_path / "p.xyz").write_text(text)
    assert sorted(readers.read_xyz(spark, f"{tmp_path}/p.xyz").collect()) == [(1, 2, 3), (4, 5, 6.5), (9, 10, 11)]
    with zipfile.ZipFile(tmp_path / "p.zip", "w") as z:
        z.writestr("readme.txt", "no")
        z.writestr("a.xyz", text)
        z.writestr("b.xyz", "0 0 0\n")
    got = readers.read_xyz_zip(spark, f"{tmp_path}/p.zip", block=7)
    assert sorted(r["x"] for r in got.collect()) == [1, 4, 9]
    every = readers.read_xyz_zip(spark, f"{tmp_path}/p.zip", every=True)
    assert sorted(r["x"] for r in every.collect()) == [0, 1, 4, 9]
    assert every.rdd.getNumPartitions() == 2
    with zipfile.ZipFile(tmp_path / "none.zip", "w") as z:
        z.writestr("readme.txt", "no")
    assert readers.read_xyz_zip(spark, f"{tmp_path}/none.zip").count() == 0


def test_members_are_unpacked_by_blocks():
    class Counted(io.BytesIO):
        most = 0

        def read(self, size=-1):
            assert 0 < size <= 10
            return super().read(size)

    text = "one\r\n\ntwo three four five\nsix"
    assert [x for b in clouds.line_blocks(Counted(text.encode()), 10) for x in b] == ["one", "", "two three four five", "six"]
    assert list(clouds.line_blocks(Counted(b""), 10)) == []


def test_archives_written_and_read(spark, tmp_path):
    lines = [f"{i} {i + 1} {i * 2}.5" for i in range(5000)]
    df = spark.createDataFrame([(x,) for x in lines], "value string").repartition(3)
    names = clouds.write_archives(df, f"file://{tmp_path}/clouds")
    assert len(names) == 3 and sorted(p.name for p in (tmp_path / "clouds").iterdir()) == sorted(n.rsplit("/", 1)[1] for n in names)
    got = readers.read_xyz_zip(spark, f"file://{tmp_path}/clouds")
    assert sorted((r["x"], r["y"], r["z"]) for r in got.collect()) == [(i, i + 1, i * 2 + 0.5) for i in range(5000)]


def test_changed_files(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"one")
    (tmp_path / "b.bin").write_bytes(b"two")
    registry = spark.createDataFrame(files.file_signatures(spark, f"{tmp_path}/*.bin").collect(), "path string, length long, modified timestamp, sha256 string")
    assert files.changed_files(spark, f"{tmp_path}/*.bin", registry).count() == 0
    time.sleep(1.1)
    (tmp_path / "a.bin").write_bytes(b"one")  # new time, same content
    (tmp_path / "b.bin").write_bytes(b"TWO")
    (tmp_path / "c.bin").write_bytes(b"new")
    assert sorted(r["path"][-5:] for r in files.changed_files(spark, f"{tmp_path}/*.bin", registry).collect()) == ["b.bin", "c.bin"]


def test_sinks(spark, tmp_path):
    schema = T.StructType.fromDDL("k long, tags string, extra double")
    df = spark.sql("select 1 as k, array(1, 2) as tags, 'drop' as other")
    sinks.append_raw(df, f"{tmp_path}/raw", schema)
    sinks.append_raw(df, f"{tmp_path}/raw", schema)
    assert spark.read.parquet(f"{tmp_path}/raw").collect() == [(1, "[1,2]", None)] * 2
    assert sinks.copy_common(df, schema, {"tags"}).columns == ["k"]
    p = df.select(F.struct(F.lit(1.0).alias("x"), F.lit(2.0).alias("y")).alias("g"), F.lit(None).cast("int").alias("n"))
    assert json.loads(sinks.to_geojson(p, "g", ["n"]).first()["value"]) == {"type": "Feature", "geometry": {"type": "Point", "coordinates": [1.0, 2.0]}, "properties": {"n": None}}
    sinks.write_geojson_lines(p, f"{tmp_path}/lines", "g", ["n"])
    assert spark.read.text(f"{tmp_path}/lines").count() == 1


def run(writer, tmp_path):
    q = writer.option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert q.exception() is None


def test_stream_upsert_over_runs(spark, tmp_path):
    schema = "k int, v string, o int"
    source, target = f"{tmp_path}/in", f"file://{tmp_path}/out"
    spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], schema).write.parquet(source)
    run(jobs.stream_upsert(spark.readStream.schema(schema).parquet(source), target, ["k"], "o"), tmp_path)
    assert sorted(jobs.read_version(spark, target).collect()) == [(1, "b", 2), (2, "c", 1)]
    spark.createDataFrame([(2, "d", 3), (3, "e", 3)], schema).write.mode("append").parquet(source)
    run(jobs.stream_upsert(spark.readStream.schema(schema).parquet(source), target, ["k"], "o"), tmp_path)
    assert sorted(jobs.read_version(spark, target).collect()) == [(1, "b", 2), (2, "d", 3), (3, "e", 3)]


def test_new_stream_goes_on_from_the_target(spark, tmp_path):
    schema, source, target = "k int, v string, o int", f"{tmp_path}/in", f"file://{tmp_path}/out"
    for i in range(5):
        spark.createDataFrame([(i, "x", i), (100, f"v{i}", i)], schema).write.mode("append").parquet(source)
        run(jobs.stream_upsert(spark.readStream.schema(schema).parquet(source), target, ["k"], "o", keep=2), tmp_path)
    assert jobs.current_version(spark, target) == 4 and len(jobs._versions(spark, target)) == 2
    other = f"{tmp_path}/other"
    spark.createDataFrame([(7, "new", 9)], schema).write.parquet(other)
    (tmp_path / "second").mkdir()
    run(jobs.stream_upsert(spark.readStream.schema(schema).parquet(other), target, ["k"], "o", keep=2), tmp_path / "second")
    assert sorted(jobs.read_version(spark, target).collect()) == [*((i, "x", i) for i in range(5)), (7, "new", 9), (100, "v4", 4)]


def test_stream_hours_drop_late_slots(spark, tmp_path):
    source = f"{tmp_path}/in"

    def add(*rows):
        spark.createDataFrame(rows, "ts string, k int, v double").selectExpr("cast(ts as timestamp) ts", "k", "v").coalesce(1).write.mode("append").parquet(source)

    add(("2024-01-01 00:10", 1, 2.0), ("2024-01-01 00:50", 1, 4.0))
    stream = lambda: jobs.stream_hourly(spark.readStream.schema("ts timestamp, k int, v double").parquet(source), "ts", ["k"], ["v"])
    writer = lambda: stream().writeStream.format("parquet").option("path", f"{tmp_path}/out").outputMode("append")
    run(writer(), tmp_path)
    add(("2024-01-01 05:00", 1, 9.0))
    run(writer(), tmp_path)
    add(("2024-01-01 00:20", 1, 100.0), ("2024-01-01 09:00", 1, 1.0))  # the first is too late
    run(writer(), tmp_path)
    got = {str(r["hour"]): (r["v"], r["n"]) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got["2024-01-01 00:00:00"] == (3.0, 2)
    assert got["2024-01-01 05:00:00"] == (9.0, 1)


def test_stream_nearest_of_moving_stations(spark, tmp_path):
    source, path, xy = f"{tmp_path}/in", f"file://{tmp_path}/stations", "struct<x:double,y:double>"
    schema = f"station int, geometry {xy}"
    buckets.create(spark.createDataFrame([(i, (float(i), 0.0)) for i in range(40)], schema), path, ["station"], 8)
    sites = spark.createDataFrame([(70, (0.0, 0.0)), (71, (100.0, 0.0))], f"site_id int, geometry {xy}")
    out: dict[int, list] = {}

    def add(*rows):
        spark.createDataFrame(rows, "station int, v double").coalesce(1).write.mode("append").parquet(source)

    def keep(df, batch):
        out[batch] = sorted((r["station"], r["v"], r["site_id"], r["site_distance"]) for r in df.collect())

    add((1, 5.0), (2, 6.0), (99, 7.0))
    stream = spark.readStream.schema("station int, v double").parquet(source)
    q = jobs.stream_nearest_moving(stream, path, sites, "station", keep).option("checkpointLocation", f"{tmp_path}/check").start()
    q.processAllAvailable()
    assert out[0] == [(1, 5.0, 70, 1.0), (2, 6.0, 70, 2.0)]
    buckets.upsert(spark.createDataFrame([(2, (90.0, 0.0)), (99, (99.0, 0.0))], schema), path)  # one moves, one is new
    add((1, 8.0), (2, 9.0), (99, 1.0))
    q.processAllAvailable()
    q.stop()
    assert out[1] == [(1, 8.0, 70, 1.0), (2, 9.0, 71, 10.0), (99, 1.0, 71, 1.0)]


def test_stream_nearest(spark, tmp_path):
    source = f"{tmp_path}/in"
    spark.createDataFrame([(1, 5.0), (2, 6.0), (9, 7.0)], "station int, v double").write.parquet(source)
    xy = "struct<x:double,y:double>"
    stations = spark.createDataFrame([(1, (0.0, 0.0)), (2, (9.0, 9.0))], f"station int, geometry {xy}")
    sites = spark.createDataFrame([(70, (1.0, 0.0)), (71, (9.0, 8.0))], f"site_id int, geometry {xy}")
    out = jobs.stream_nearest(spark.readStream.schema("station int, v double").parquet(source), stations, sites, "station")
    run(out.writeStream.format("parquet").option("path", f"{tmp_path}/out").outputMode("append"), tmp_path)
    assert sorted((r["station"], r["site_id"], r["site_distance"]) for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [(1, 70, 1.0), (2, 71, 1.0)]
