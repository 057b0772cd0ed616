"""Registered queries of readers, sinks, streams and mapping options: a given table goes through a file or stream and back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from . import fixtures as fx
from .functions import geo
from .operators import enrich, match, reduce, sync
from .operators.shared import shared_path
from .plans import presets
from .queries import MANY, RANKED, READINGS, SITES, V2, WAYS, _r, apart, query
from .sources import buckets, clouds, files, layout, readers, sinks
from .streaming import jobs

# --- readers and sinks ---------------------------------------------------------------------------------------------


def _part(s, d) -> DataFrame:
    return fx.table(s, d, "part").select("p_partkey", "p_brand", "p_size", "p_retailprice")


_PART = "SELECT p_partkey, p_brand, p_size, p_retailprice FROM part"


@query(_PART)
def read_csv(s, d):
    path = shared_path(s, "csv")
    _part(s, d).write.option("header", True).csv(path)
    return readers.read_table(s, path, "csv", _part(s, d).schema)


@query(_PART)
def read_tsv(s, d):
    path = shared_path(s, "tsv")
    _part(s, d).write.option("header", True).option("sep", "\t").csv(path)
    return readers.read_table(s, path, "tsv", _part(s, d).schema)


@query(_PART)
def read_parquet(s, d):
    path = shared_path(s, "parquet")
    _part(s, d).write.parquet(path)
    return readers.read_table(s, path, "parquet")


@query(_PART)
def read_json(s, d):
    path = shared_path(s, "json")
    lists = _part(s, d).groupBy(F.expr("p_partkey div 1000")).agg(F.to_json(F.collect_list(F.struct("p_partkey", "p_brand", "p_size", "p_retailprice"))).alias("value"))
    lists.select("value").repartition("value").write.option("maxRecordsPerFile", 1).text(path)  # a list a file
    return readers.read_table(s, path, "json", _part(s, d).schema)


@query(f"WITH {MANY} SELECT site_id, brand, x / 100 AS x, y / 100 AS y FROM many WHERE site_id % 5 <> 0")
def read_features(s, d):
    """One collection for each thousand parts; every fifth feature has no geometry and is a bad row."""
    place = F.when(F.col("site_id") % 5 != 0, F.struct(F.lit("Point").alias("type"), F.array(F.col("x") / 100, F.col("y") / 100).alias("coordinates")))
    feature = F.struct(F.lit("Feature").alias("type"), F.struct("site_id", "brand").alias("properties"), place.alias("geometry"))
    path = shared_path(s, "features")
    lists = fx.many_sites(s, d).groupBy(F.expr("site_id div 1000")).agg(F.collect_list(feature).alias("features"))
    lists.select(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), "features")).alias("value")).repartition("value").write.option("compression", "gzip").option("maxRecordsPerFile", 1).text(path)
    rows, _ = readers.read_features(s, path, {"site_id": "bigint", "brand": "string"})
    return rows.select("site_id", "brand", "geometry.x", "geometry.y")


@query("SELECT count(*) AS bad FROM part WHERE p_partkey % 5 = 0")
def bad_features(s, d):
    place = F.when(F.col("site_id") % 5 != 0, F.struct(F.lit("Point").alias("type"), F.array("x", "y").alias("coordinates")))
    feature = F.struct(F.struct("site_id").alias("properties"), place.alias("geometry"))
    path = shared_path(s, "features")
    fx.many_sites(s, d).groupBy(F.expr("site_id div 1000")).agg(F.to_json(F.struct(F.collect_list(feature).alias("features"))).alias("value")).select("value").repartition("value").write.option("maxRecordsPerFile", 1).text(path)
    return readers.read_features(s, path, {"site_id": "bigint"})[1].agg(F.count("*").alias("bad"))


@query("SELECT 'http://h/' || p_partkey || '.zip' AS href FROM part WHERE p_partkey % 2 = 0")
def feed_links(s, d):
    link = F.concat(F.lit('<link href="http://h/'), F.col("p_partkey"), F.when(F.col("p_partkey") % 2 == 0, ".zip").otherwise(".txt"), F.lit('"/>'))
    feeds = fx.table(s, d, "part").groupBy(F.expr("p_partkey div 1000")).agg(F.concat(F.lit("<feed><entry>"), F.array_join(F.collect_list(link), ""), F.lit("</entry></feed>")).alias("value"))
    path = shared_path(s, "feeds")
    feeds.select("value").repartition("value").write.option("maxRecordsPerFile", 1).text(path)  # a feed a file
    return readers.feed_links(s, path)


@query("SELECT CAST(p_partkey AS DOUBLE) AS x, CAST(p_size AS DOUBLE) AS y, p_retailprice AS z FROM part WHERE p_partkey % 7 <> 0")
def read_xyz(s, d):
    """Lines with blanks or commas; every seventh is short and skipped."""
    k = F.col("p_partkey")
    line = F.when(k % 7 == 0, k.cast("string")).when(k % 2 == 0, F.concat_ws(",", k, "p_size", "p_retailprice")).otherwise(F.concat_ws("  ", k, "p_size", "p_retailprice"))
    path = shared_path(s, "xyz")
    fx.table(s, d, "part").select(line.alias("value")).write.text(path)
    return readers.read_xyz(s, path)


@query("SELECT count(DISTINCT p_brand) AS changed FROM part WHERE p_size > 25")
def changed_files(s, d):
    """A file a brand, of which those with large parts get another one; the registry knows the old files."""
    path = shared_path(s, "files")
    parts = _part(s, d).select(F.concat_ws(",", "p_partkey", "p_size").alias("value"), "p_brand").repartition("p_brand")
    parts.write.partitionBy("p_brand").text(path)
    known = files.file_signatures(s, f"{path}/*/*.txt").collect()  # a row a file, one for each brand
    registry = s.createDataFrame(known, "path string, length long, modified timestamp, sha256 string")
    large = _part(s, d).where("p_size > 25").select(F.concat_ws(",", "p_partkey", "p_size").alias("value"), "p_brand").repartition("p_brand")
    large.write.mode("append").partitionBy("p_brand").text(path)
    return files.changed_files(s, f"{path}/*/*.txt", registry).agg(F.count("*").alias("changed"))


@query("SELECT p_partkey, '[' || p_size || ',' || p_partkey || ']' AS tags, CAST(NULL AS DOUBLE) AS extra FROM part UNION ALL SELECT p_partkey, '[' || p_size || ',' || p_partkey || ']', NULL FROM part")
def append_raw(s, d):
    path = shared_path(s, "raw")
    rows = fx.table(s, d, "part").select("p_partkey", F.array(F.col("p_size").cast("long"), "p_partkey").alias("tags"), "p_brand")
    schema = T.StructType.fromDDL("p_partkey long, tags string, extra double")
    sinks.append_raw(rows, path, schema)
    sinks.append_raw(rows, path, schema)
    return s.read.schema(schema).parquet(path)


@query("SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_retailprice FROM part")
def copy_common(s, d):
    return sinks.copy_common(_part(s, d), T.StructType.fromDDL("p_partkey string, p_size int, p_retailprice double, other int"), {"p_size"})


# --- streams -------------------------------------------------------------------------------------------------------


def _run(writer: DataStreamWriter, path: str) -> None:
    done = writer.option("checkpointLocation", f"{path}/check").trigger(availableNow=True).start()
    done.awaitTermination()


@query("SELECT user_id, max(event_id) AS event_id, max_by(value, event_id) AS value FROM events GROUP BY user_id")
def stream_upsert(s, d):
    """The last value of each user, from the events in four micro-batches."""
    path = shared_path(s, "stream")
    rows = fx.table(s, d, "events").select("user_id", "event_id", "value")
    for i in range(4):
        rows.where(F.col("event_id") % 4 == i).write.mode("append").parquet(f"{path}/in")
    source = s.readStream.schema(rows.schema).option("maxFilesPerTrigger", 8).parquet(f"{path}/in")
    ordered = source.withColumn("o", F.col("event_id"))
    _run(jobs.stream_upsert(ordered, f"{path}/all", ["user_id", "event_id"], "o"), path)
    return jobs.read_version(s, f"{path}/all").groupBy("user_id").agg(F.max("event_id").alias("event_id"), F.max_by("value", "event_id").alias("value"))


@query(f"""WITH {READINGS} SELECT date_trunc('hour', ts) AS hour, station, round(avg(value), 6) AS value, count(*) AS n FROM readings
  GROUP BY 1, 2 HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM readings) - INTERVAL 1 HOUR""")
def stream_hourly(s, d):
    """Hours that are complete by the watermark, from one stream over all events."""
    path = shared_path(s, "stream")
    rows = fx.readings(s, d).select("station", F.col("ts").cast("timestamp").alias("ts"), "value")
    rows.write.parquet(f"{path}/in")
    hours = jobs.stream_hourly(s.readStream.schema(rows.schema).parquet(f"{path}/in"), "ts", ["station"], ["value"])
    _run(hours.writeStream.format("parquet").option("path", f"{path}/out").outputMode("append"), path)
    return s.read.schema(hours.schema).parquet(f"{path}/out").select(F.col("hour").cast("timestamp_ntz").alias("hour"), "station", F.round("value", 6).alias("value"), "n")


@query(f"WITH {RANKED} SELECT e.event_id, r.id AS station, r.site_id, round(r.d, 4) AS site_distance FROM (SELECT event_id, user_id % 100 AS station FROM events) e JOIN ranked r ON r.id = e.station AND r.rk = 1")
def stream_nearest(s, d):
    path = shared_path(s, "stream")
    rows = fx.readings(s, d).select("event_id", "station")
    rows.write.parquet(f"{path}/in")
    stations = fx.ways(s, d).select(F.col("id").alias("station"), "geometry")
    out = jobs.stream_nearest(s.readStream.schema(rows.schema).parquet(f"{path}/in"), stations, fx.sites(s, d), "station")
    _run(out.writeStream.format("parquet").option("path", f"{path}/out").outputMode("append"), path)
    return s.read.schema(out.schema).parquet(f"{path}/out").select("event_id", "station", "site_id", _r("site_distance"))


# --- mapping options -----------------------------------------------------------------------------------------------


@query(f"""WITH {WAYS}, {SITES}, pairs AS (SELECT *, {apart()} AS d FROM ways, sites WHERE value > 0 AND id % 2 = 0), r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, site_id) AS rk FROM pairs)
  SELECT id AS way_id, site_id * 2 AS link, round(d, 2) AS meters FROM r WHERE rk = 1""")
def project_and_filters(s, d):
    """Filters on both sides before the join, chosen columns and expressions after it."""
    project = {"way_id": "id", "link": "site_id * 2", "meters": "round(distance, 2)"}
    return presets.map_to_base(fx.ways(s, d), fx.sites(s, d), {"type": "nearest"}, None, project, base_filter="WHERE id % 2 = 0;", enrichment_filter="value > 0", enr_id="site_id")


@query(f"WITH {RANKED} SELECT id, site_id FROM ranked WHERE rk = 1")
def staging_fallback(s, d):
    """Without an enrichment the staged rows are mapped."""
    return presets.map_to_base(fx.ways(s, d), None, {"type": "nearest"}, staging=fx.sites(s, d), enr_id="site_id").select("id", "site_id")


@query(f"WITH {RANKED}, fresh AS (SELECT id AS way_id, site_id FROM ranked WHERE rk = 1 AND id % 3 = 0) SELECT w.id AS way_id, coalesce(f.site_id, -1) AS site_id FROM ways w LEFT JOIN fresh f ON f.way_id = w.id")
def store_one_row_per_base(s, d):
    """A mapping with at most one row a segment is upserted on the segment."""
    old = fx.ways(s, d).select(F.col("id").alias("way_id"), F.lit(-1).cast("long").alias("site_id"))
    fresh = match.nearest(fx.ways(s, d).where("id % 3 = 0"), fx.sites(s, d), enr_id="site_id").select(F.col("id").alias("way_id"), "site_id")
    return presets.store_mapping(old, fresh, {"type": "nearest", "k": 1}, None)


@query(f"WITH {MANY} SELECT site_id, round(CASE WHEN site_id % 2 = 0 THEN x ELSE 500000 END, 3) AS x, round(CASE WHEN site_id % 2 = 0 THEN y ELSE 0 END, 3) AS y FROM many")
def with_geometry(s, d):
    """The planar geometry, or the projected geographic one (a place that projects to round numbers)."""
    even = F.col("site_id") % 2 == 0
    rows = fx.many_sites(s, d).select("site_id", F.when(even, F.col("geometry")).alias("planar"), geo.point(F.lit(15.0), F.lit(0.0)).alias("geographic"))
    out = presets.with_geometry(rows, "geometry", "planar", "geographic", 25833)
    return out.select("site_id", F.round("geometry.x", 3).alias("x"), F.round("geometry.y", 3).alias("y"))


@query(f"WITH {WAYS}, {SITES} SELECT id, site_id, round({apart()}, 4) AS distance FROM ways, sites WHERE x BETWEEN x1 - 200 AND x1 + 200 AND y BETWEEN y1 - 200 AND y1 + 200 AND grp = id % 25")
def custom_predicate(s, d):
    """M5: a predicate of the user's own; its box lies within 283 m, so the grid finds the pairs, and its equality is a key, too."""
    test = "grp = id % 25 AND x BETWEEN x1 - 200 AND x1 + 200 AND y BETWEEN y1 - 200 AND y1 + 200"
    return match.within(fx.ways(s, d), fx.sites(s, d), 283, predicate=test, enr_id="site_id", bounded=True).select("id", "site_id", _r("distance"))


@query(f"WITH {WAYS}, {SITES} SELECT id, site_id, round({apart()}, 4) AS distance FROM ways, sites WHERE {apart()} <= 300 AND value > x1 - 5000")
def bounded_predicate(s, d):
    """M5: a predicate of the user's own within a distance, so the grid finds the pairs."""
    return match.within(fx.ways(s, d), fx.sites(s, d), 300, predicate="value > x1 - 5000", enr_id="site_id", bounded=True).select("id", "site_id", _r("distance"))


@query(f"""WITH {RANKED}, t AS (SELECT id, d, CASE WHEN value > 0 THEN value END AS v FROM ranked WHERE rk <= 4)
  SELECT id, round(sum(v / pow(greatest(d, 0.001), 2)) / sum(CASE WHEN v IS NOT NULL THEN 1 / pow(greatest(d, 0.001), 2) END), 4) AS value FROM t GROUP BY id""")
def idw_skip_nulls(s, d):
    """Values that are null take no part in the mean's weights."""
    sites = fx.sites(s, d).withColumn("value", F.when(F.col("value") > 0, F.col("value")))
    return presets.map_preset("idw", fx.ways(s, d), sites, None, {"values": ["value"], "skip_null_weights": True}, enr_id="site_id").select("id", _r("value"))


@query("SELECT o_custkey AS k, max(o_totalprice) AS v FROM orders GROUP BY 1 UNION ALL SELECT c_custkey, -1 FROM customer WHERE c_custkey % 2 = 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders)")
def reshape_insert_ignore(s, d):
    """Reshaped output is inserted, known keys are left alone."""
    known = fx.table(s, d, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.max("o_totalprice").alias("v"))
    fresh = fx.table(s, d, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("k"), F.lit(-1.0).alias("v"))
    return sync.insert_ignore(known, fresh, ["k"])


@query("SELECT p_partkey AS id, CASE WHEN p_partkey % 3 = 0 THEN 500000 ELSE 0 END AS x, CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END AS fresh FROM part")
def upsert_reprojected(s, d):
    """Points are projected and then upserted on their id."""
    old = fx.table(s, d, "part").select(F.col("p_partkey").alias("id"), geo.point(F.lit(0.0), F.lit(0.0)).alias("geometry"), F.lit(0).alias("fresh"))
    degrees = fx.table(s, d, "part").where("p_partkey % 3 = 0").select(F.col("p_partkey").alias("id"), geo.point(F.lit(15.0), F.col("p_size").cast("double")).alias("geometry"), F.lit(1).alias("fresh"))
    out = sync.upsert(old, enrich.reproject(degrees, "geometry", "geometry", 4326, 25833), ["id"], ["geometry", "fresh"])
    return out.select("id", F.round("geometry.x").cast("int").alias("x"), "fresh")


@query(f"WITH {WAYS} SELECT id, round({apart('9000', '9000')}, 4) AS distance FROM ways ORDER BY {apart('9000', '9000')}, id LIMIT 1")
def nearest_of_all(s, d):
    """The segment nearest to one place; Spark keeps the first row of each task and then of all."""
    return match.nearest_of_all(fx.ways(s, d), geo.point(F.lit(9000.0), F.lit(9000.0))).select("id", _r("distance"))


@query(f"WITH {RANKED} SELECT id, count(*) AS sites, round(max(d), 4) AS farthest FROM ranked WHERE rk <= 3 GROUP BY id")
def nearest_then_agg(s, d):
    pairs = match.nearest(fx.ways(s, d), fx.sites(s, d), 3, enr_id="site_id")
    return reduce.reduce_agg(pairs, "id", {"sites": F.count("*"), "farthest": F.round(F.max("distance"), 4)})


@query("SELECT CAST(p_partkey AS DOUBLE) AS x, CAST(p_size AS DOUBLE) AS y, p_retailprice AS z FROM part")
def read_xyz_zip(s, d):
    """A cloud in zip archives, a member a task."""
    path = shared_path(s, "clouds")
    p = fx.table(s, d, "part")
    clouds.write_archives(p.select(F.concat_ws(" ", "p_partkey", "p_size", "p_retailprice").alias("value")).repartition(4), path)
    return readers.read_xyz_zip(s, path).select("x", "y", "z")


# --- layouts -------------------------------------------------------------------------------------------------------


@query(f"""WITH {V2} SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN a.o_custkey ELSE b.o_custkey END AS o_custkey,
  CASE WHEN b.o_orderkey IS NULL THEN a.o_totalprice ELSE b.o_totalprice END AS o_totalprice FROM v1 a FULL JOIN v2 b ON a.o_orderkey = b.o_orderkey""")
def bucketed_upsert(s, d):
    """Into a table in buckets, of which only those of the batch's keys are rewritten."""
    old, new = fx.staging(s, d)
    path = shared_path(s, "buckets")
    buckets.create(old, path, ["o_orderkey"], 16)
    buckets.upsert(new, path)
    return buckets.read(s, path).select("o_orderkey", "o_custkey", "o_totalprice")


@query(f"WITH {V2} SELECT o_orderkey, o_custkey, o_totalprice FROM v2")
def bucketed_sync(s, d):
    """The table follows its source; buckets of equal digest stay as they are."""
    old, new = fx.staging(s, d)
    path = shared_path(s, "buckets")
    buckets.create(old, path, ["o_orderkey"], 16)
    buckets.sync(new, path)
    return buckets.read(s, path).select("o_orderkey", "o_custkey", "o_totalprice")


@query(f"WITH {WAYS} SELECT id FROM ways WHERE least(x1, x2) <= 9000 AND greatest(x1, x2) >= 7000 AND least(y1, y2) <= 8000 AND greatest(y1, y2) >= 6000")
def box_layout(s, d):
    """A box on a table laid out along a curve."""
    path = shared_path(s, "layout")
    layout.write_by_place(fx.ways(s, d), path, geo.envelope("geometry", "line"))
    return layout.read_box(s, path, (7000, 6000, 9000, 8000)).select("id")


@query(f"WITH {WAYS}, {MANY}, pairs AS (SELECT id, site_id, {apart()} AS d FROM ways, many), r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, site_id) AS rk FROM pairs)\n  SELECT id, count(*) AS sites, round(max(d), 4) AS farthest FROM r WHERE rk <= 5 GROUP BY id")
def nearest_leaves(s, d):
    """M2: five nearest of the larger table, by leaves of its density."""
    near = match.nearest(fx.ways(s, d), fx.many_sites(s, d), 5, enr_id="site_id", small_rows=0)
    return near.groupBy("id").agg(F.count("*").alias("sites"), F.round(F.max("distance"), 4).alias("farthest"))


# --- matches by ranges, long segments, many vertices ---------------------------------------------------------------


@query(f"WITH {WAYS}, {MANY} SELECT id, site_id FROM ways, many WHERE x BETWEEN x1 - 90 AND x1 + 90 AND y BETWEEN y1 - 300 AND y1 + 40 AND value > 950")
def range_predicate(s, d):
    """M5: a predicate of ranges; their cells are the join's key."""
    ranges = [("x1 - 90", "x1 + 90", "x", "x"), ("y1 - 300", "y1 + 40", "y", "y")]
    return match.range_pairs(fx.ways(s, d), fx.many_sites(s, d).where("value > 950"), ranges, columns=["id", "site_id"])


@query("SELECT a.o_orderkey, b.p_partkey FROM orders a JOIN part b ON a.o_totalprice BETWEEN b.p_retailprice * 100 AND b.p_retailprice * 100 + b.p_size * 3")
def range_of_values(s, d):
    """M5: a value within a range of the other table."""
    o, p = fx.table(s, d, "orders").select("o_orderkey", "o_totalprice"), fx.table(s, d, "part").select("p_partkey", "p_retailprice", "p_size")
    ends = ("o_totalprice", "o_totalprice", "p_retailprice * 100", "p_retailprice * 100 + p_size * 3")
    return match.range_pairs(o, p, [ends], columns=["o_orderkey", "p_partkey"])


_LONG = "SELECT id, x1 AS ax, y1 AS ay, x1 + (x2 - x1) * 16 AS bx, y1 + (y2 - y1) * 16 AS by_ FROM ways WHERE x1 <> x2 OR y1 <> y2"


@query(f"""WITH {WAYS}, w AS ({_LONG}), p AS (SELECT a.id, b.id AS other, sign((a.bx-a.ax)*(b.ay-a.ay)-(a.by_-a.ay)*(b.ax-a.ax)) o1, sign((a.bx-a.ax)*(b.by_-a.ay)-(a.by_-a.ay)*(b.bx-a.ax)) o2,
    sign((b.bx-b.ax)*(a.ay-b.ay)-(b.by_-b.ay)*(a.ax-b.ax)) o3, sign((b.bx-b.ax)*(a.by_-b.ay)-(b.by_-b.ay)*(a.bx-b.ax)) o4,
    b.ax BETWEEN least(a.ax,a.bx) AND greatest(a.ax,a.bx) AND b.ay BETWEEN least(a.ay,a.by_) AND greatest(a.ay,a.by_) AS i1, b.bx BETWEEN least(a.ax,a.bx) AND greatest(a.ax,a.bx) AND b.by_ BETWEEN least(a.ay,a.by_) AND greatest(a.ay,a.by_) AS i2,
    a.ax BETWEEN least(b.ax,b.bx) AND greatest(b.ax,b.bx) AND a.ay BETWEEN least(b.ay,b.by_) AND greatest(b.ay,b.by_) AS i3, a.bx BETWEEN least(b.ax,b.bx) AND greatest(b.ax,b.bx) AND a.by_ BETWEEN least(b.ay,b.by_) AND greatest(b.ay,b.by_) AS i4
    FROM w a, w b WHERE a.id < b.id)
  SELECT id, other FROM p WHERE (o1 <> o2 AND o3 <> o4 AND o1*o2 <= 0 AND o3*o4 <= 0) OR (o1 = 0 AND i1) OR (o2 = 0 AND i2) OR (o3 = 0 AND i3) OR (o4 = 0 AND i4)""")
def crossing_lines(s, d):
    """Segments long enough to cross."""
    w = fx.ways(s, d).where("x1 <> x2 or y1 <> y2")
    far = geo.point(F.col("x1") + (F.col("x2") - F.col("x1")) * 16, F.col("y1") + (F.col("y2") - F.col("y1")) * 16)
    long = w.select("id", geo.line(geo.point("x1", "y1"), far).alias("geometry"))
    return match.intersects(long, long.withColumnRenamed("id", "other"), enr_id="other", columns=["id", "other"]).where("id < other")


def _to(p: str, q: str) -> list[str]:
    """SQL: distances of the ends of segment q to segment p, of columns ax, ay, bx, by_."""
    out = []
    for x, y in ((f"{q}.ax", f"{q}.ay"), (f"{q}.bx", f"{q}.by_")):
        dx, dy = f"({p}.bx - {p}.ax)", f"({p}.by_ - {p}.ay)"
        t = f"greatest(0, least(1, (({x} - {p}.ax) * {dx} + ({y} - {p}.ay) * {dy}) / ({dx} * {dx} + {dy} * {dy})))"
        out.append(f"sqrt(pow({x} - ({p}.ax + {t} * {dx}), 2) + pow({y} - ({p}.ay + {t} * {dy}), 2))")
    return out


@query(f"""WITH {WAYS}, w AS ({_LONG}), p AS (SELECT a.id, b.id AS other, least({", ".join(_to("a", "b") + _to("b", "a"))}) AS d,
    sign((a.bx-a.ax)*(b.ay-a.ay)-(a.by_-a.ay)*(b.ax-a.ax)) o1, sign((a.bx-a.ax)*(b.by_-a.ay)-(a.by_-a.ay)*(b.bx-a.ax)) o2, sign((b.bx-b.ax)*(a.ay-b.ay)-(b.by_-b.ay)*(a.ax-b.ax)) o3, sign((b.bx-b.ax)*(a.by_-b.ay)-(b.by_-b.ay)*(a.bx-b.ax)) o4
    FROM w a, w b WHERE a.id % 2 = 0 AND b.id % 2 = 1), q AS (SELECT id, other, CASE WHEN o1 * o2 < 0 AND o3 * o4 < 0 THEN 0 ELSE d END AS d FROM p) SELECT id, other, round(d, 4) AS distance FROM q WHERE d <= 120""")
def lines_within(s, d):
    """M4: long segments within a distance of each other, by tables of their edges."""
    w = fx.ways(s, d).where("x1 <> x2 or y1 <> y2")
    step = lambda k: geo.point(F.col("x1") + (F.col("x2") - F.col("x1")) * k, F.col("y1") + (F.col("y2") - F.col("y1")) * k)
    long = w.select("id", geo.line(*(step(k) for k in (0, 2, 4, 8, 16))).alias("geometry"))
    even, odd = long.where("id % 2 = 0"), long.where("id % 2 = 1").withColumnRenamed("id", "other")
    return match.lines_within(even, odd, 120.0, enr_id="other", digits=4)


_STARS = """stars AS (SELECT p_partkey // 200 AS area_id, p_partkey % 200 AS k, (p_partkey // 200) * 7919 % 18000 + 1000 AS cx, (p_partkey // 200) * 104729 % 18000 + 1000 AS cy, 300 + p_size * 13 % 700 AS r FROM part),
  corners AS (SELECT area_id, k, cx + round(r * cos(k * 0.0314)) AS x, cy + round(r * sin(k * 0.0314)) AS y, cx, cy FROM stars),
  edges AS (SELECT area_id, x AS ax, y AS ay, coalesce(lead(x) OVER w, first_value(x) OVER w) AS bx, coalesce(lead(y) OVER w, first_value(y) OVER w) AS by_, cx, cy FROM corners WINDOW w AS (PARTITION BY area_id ORDER BY k))"""


@query(f"""WITH {WAYS}, {_STARS}, t AS (SELECT id, area_id, ((ay > y1) <> (by_ > y1)) AND x1 < ax + (y1 - ay) * (bx - ax) / nullif(by_ - ay, 0) AS crossed,
    sign((bx - ax) * (y1 - ay) - (by_ - ay) * (x1 - ax)) = 0 AND x1 BETWEEN least(ax, bx) AND greatest(ax, bx) AND y1 BETWEEN least(ay, by_) AND greatest(ay, by_) AS touched
    FROM ways JOIN edges ON x1 BETWEEN cx - 1001 AND cx + 1001 AND y1 BETWEEN cy - 1001 AND cy + 1001)
  SELECT id, area_id FROM t GROUP BY id, area_id HAVING count(*) FILTER (crossed) % 2 = 1 OR bool_or(touched)""")
def points_in_areas(s, d):
    """M6: points in polygons of 200 corners each, by a table of their edges."""
    k, number = F.col("p_partkey") % 200, F.expr("p_partkey div 200")
    at = fx.table(s, d, "part").select(number.alias("area_id"), k.alias("k"), (300 + F.col("p_size") * 13 % 700).alias("r"), (number * 7919 % 18000 + 1000).alias("cx"), (number * 104729 % 18000 + 1000).alias("cy"))
    corner = geo.point(F.col("cx") + F.round(F.col("r") * F.cos(F.col("k") * 0.0314)), F.col("cy") + F.round(F.col("r") * F.sin(F.col("k") * 0.0314)))
    ring = F.transform(F.array_sort(F.collect_list(F.struct("k", corner.alias("p")))), lambda v: v["p"])
    areas = at.groupBy("area_id").agg(F.array(ring).alias("geometry"))
    spots = fx.ways(s, d).select("id", geo.start_point("geometry").alias("geometry"))
    return match.inside(spots, areas, enr_id="area_id")
