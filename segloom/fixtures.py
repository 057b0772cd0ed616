"""Spatial tables derived from the given tables, by arithmetic that SQL can repeat exactly."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import geo


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-point segments from customers: (id, way_id, way_link_index, x1, y1, x2, y2, geometry)."""
    c = table(spark, sf_dir, "customer").select("c_custkey")
    xy = c.selectExpr(
        "c_custkey as id", "c_custkey div 3 as way_id", "cast(c_custkey % 3 as int) as way_link_index",
        "cast((c_custkey * 7919) % 20011 as double) as x1", "cast((c_custkey * 104729) % 20021 as double) as y1",
        "cast((c_custkey * 7919) % 20011 + c_custkey % 97 - 48 as double) as x2", "cast((c_custkey * 104729) % 20021 + c_custkey % 89 - 44 as double) as y2",
    )
    return xy.withColumn("geometry", geo.line(geo.point("x1", "y1"), geo.point("x2", "y2")))


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points from suppliers: (site_id, x, y, value, grp, geometry)."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal", "s_nationkey")
    xy = s.selectExpr("s_suppkey as site_id", "cast((s_suppkey * 15485863) % 20011 as double) as x", "cast((s_suppkey * 32452843) % 20021 as double) as y", "s_acctbal as value", "s_nationkey as grp")
    return xy.withColumn("geometry", geo.point("x", "y"))


def many_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from parts, a larger table: (site_id, x, y, value, brand, geometry)."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice", "p_brand")
    xy = p.selectExpr("p_partkey as site_id", "cast((p_partkey * 15485863) % 20011 as double) as x", "cast((p_partkey * 32452843) % 20021 as double) as y", "p_retailprice as value", "p_brand as brand")
    return xy.withColumn("geometry", geo.point("x", "y"))


def grid_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites with the first 24 elements of an embedding: (site_id, x, y, series, geometry)."""
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("site_id"), F.transform(F.slice("embedding", 1, 24), lambda v: v.cast("double")).alias("series"))
    return sites(spark, sf_dir).join(e, "site_id").select("site_id", "x", "y", "series", "geometry")


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rectangles of a 5 x 5 split of the plane from nations, a tenth apart: (area_id, ax1, ay1, ax2, ay2, geometry)."""
    n = table(spark, sf_dir, "nation").selectExpr(
        "n_nationkey as area_id", "cast(n_nationkey % 5 * 4002 as double) as ax1", "cast(n_nationkey div 5 * 4004 as double) as ay1",
        "cast(n_nationkey % 5 * 4002 + 3600 as double) as ax2", "cast(n_nationkey div 5 * 4004 + 3600 as double) as ay2",
    )
    return n.withColumn("geometry", geo.rectangle("ax1", "ay1", "ax2", "ay2"))


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station readings from events: (event_id, station, ts, value, event_type, props)."""
    return table(spark, sf_dir, "events").select("event_id", (F.col("user_id") % 100).alias("station"), "ts", "value", "event_type", "props")


def staging(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two versions of orders: the second drops, changes and adds keys."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    changed = o.where("o_orderkey % 11 <> 0").withColumn("o_totalprice", F.when(F.col("o_orderkey") % 7 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    added = o.where("o_orderkey % 13 = 0").withColumn("o_orderkey", F.col("o_orderkey") + 100_000_000)
    return o, changed.unionByName(added)


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raster of 10 m cells over the plane's lower left corner, one cell an order line: (col, row, z); origin (0, 4000)."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    placed = lines.selectExpr("l_orderkey * 8 + l_linenumber as k", "l_quantity as z")
    return placed.selectExpr("(k * 7) % 400 as col", "(k * 7 div 400 + k) % 400 as row", "z").groupBy("col", "row").agg(F.max("z").alias("z"))


def network(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nodes, ways, relations): nodes from parts, ways from orders (3 to 6 nodes each), relations from customers.

    Ways and relations refer to all nodes and to a hundred that aren't there.
    """
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    refs = (p.agg(F.max("p_partkey")).first()[0] or 0) + 100
    barrier = F.when(F.col("p_size") % 10 == 0, F.create_map(F.lit("barrier"), F.lit("bollard"), F.lit("bicycle"), F.lit("yes"), F.lit("motor_vehicle"), F.lit("no")))
    barrier = barrier.when(F.col("p_size") % 10 == 1, F.create_map(F.lit("barrier"), F.lit("moat"))).otherwise(F.create_map().cast("map<string,string>"))
    nodes = p.select(F.col("p_partkey").alias("id"), (52.0 + (F.col("p_partkey") * 7919 % 10007) / 20000.0).alias("lat"), (13.0 + (F.col("p_partkey") * 104729 % 10009) / 20000.0).alias("lon"), barrier.alias("tags"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    count = F.lit(3) + (F.col("o_orderkey") % 4).cast("int")
    line = F.transform(F.sequence(F.lit(0), count - 1), lambda i: (F.col("o_orderkey") * 31 + i * 17) % refs)
    kinds = F.array(*(F.lit(x) for x in ("residential", "primary", "footway", "construction", "proposed", "motorway", "cycleway")))
    tags = F.create_map(
        F.lit("highway"), F.get(kinds, (F.col("o_orderkey") % 7).cast("int")), F.lit("name"), F.when(F.col("o_custkey") % 3 > 0, F.concat(F.lit("Street "), F.col("o_custkey").cast("string"))).otherwise(""),
        F.lit("ref"), F.when(F.col("o_custkey") % 2 > 0, F.concat(F.lit("R"), F.col("o_custkey").cast("string"))).otherwise(""),
        F.lit("maxspeed"), F.get(F.array(*(F.lit(x) for x in ("50", "30 mph", "walk", "none", "8 knots", "fast", "70 km/h"))), (F.col("o_custkey") % 7).cast("int")),
        F.lit("maxspeed:backward"), F.get(F.array(F.lit("20"), F.lit("slow"), F.lit("")), (F.col("o_custkey") % 3).cast("int")),
        F.lit("surface"), F.get(F.array(*(F.lit(x) for x in ("Asphalt", "ash", "cobblestone:flattened", "lava"))), (F.col("o_custkey") % 4).cast("int")),
        F.lit("smoothness"), F.get(F.array(*(F.lit(x) for x in ("good", "very_good", "rough"))), (F.col("o_custkey") % 3).cast("int")),
        F.lit("oneway"), F.get(F.array(*(F.lit(x) for x in ("yes", "no", "-1", "maybe", ""))), (F.col("o_custkey") % 5).cast("int")),
        F.lit("bicycle"), F.get(F.array(*(F.lit(x) for x in ("yes", "no", "designated", "unknown"))), (F.col("o_orderkey") % 4).cast("int")),
        F.lit("oneway:bicycle"), F.get(F.array(*(F.lit(x) for x in ("no", "what"))), (F.col("o_orderkey") % 2).cast("int")),
        F.lit("tunnel"), F.get(F.array(*(F.lit(x) for x in ("", "yes", "building_passage", "culvert"))), (F.col("o_custkey") % 4).cast("int")),
        F.lit("lit"), F.get(F.array(*(F.lit(x) for x in ("YES", "no", "sunset"))), (F.col("o_custkey") % 3).cast("int")),
    )
    ways_ = o.select(F.col("o_orderkey").alias("id"), line.alias("nodes"), tags.alias("tags"))
    c = table(spark, sf_dir, "customer").select("c_custkey")

    def member(role: str, kind: str, ref) -> object:
        return F.struct(F.lit(role).alias("role"), F.lit(kind).alias("type"), ref.cast("bigint").alias("ref"))

    k = F.col("c_custkey")
    members = F.array_compact(
        F.array(
            member("from", "way", k), F.when(k % 4 == 0, member("from", "way", k + 1)), F.when(k % 9 > 0, member("via", "node", (k * 31) % refs)), member("to", "way", k + 2), F.when(k % 5 == 0, member("to", "way", k + 3))
        )
    )
    kind = F.get(F.array(*(F.lit(x) for x in ("no_left_turn", "no_entry", "no_exit", "only_straight_on", "keep_left"))), (k % 5).cast("int"))
    rtags = F.map_concat(F.create_map(F.lit("type"), F.lit("restriction"), F.lit("restriction"), kind), F.when(k % 6 == 0, F.create_map(F.lit("except"), F.lit("bicycle;psv;boat"))).otherwise(F.create_map().cast("map<string,string>")))
    return nodes, ways_, c.select(k.alias("id"), members.alias("members"), rtags.alias("tags"))
