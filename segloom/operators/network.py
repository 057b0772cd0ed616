"""Road network from tables of nodes, ways and relations.

nodes(id, lat, lon, tags MAP), ways(id, nodes ARRAY<BIGINT>, tags MAP), relations(id, members ARRAY<STRUCT<role, type,
ref>>, tags MAP).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from .records import first_tag
from .shared import materialize

# Tag values of the map data.
HIGHWAYS = [
    "motorway", "motorway_link", "trunk", "trunk_link", "primary", "primary_link", "secondary", "secondary_link", "tertiary", "tertiary_link",
    "road", "residential", "living_street", "ford", "unclassified", "service", "cycleway", "path", "track", "footway", "pedestrian", "steps",
    "corridor", "bridleway",
]
BARRIERS = [
    "block", "bollard", "border_control", "bump_gate", "bus_trap", "cattle_grid", "coupure", "cycle_barrier", "debris", "entrance",
    "full-height_turnstile", "gate", "hampshire_gate", "height_restrictor", "horse_stile", "kent_carriage_gap", "kissing_gate", "lift_gate",
    "motorcycle_barrier", "planter", "sally_port", "sliding_beam", "sliding_gate", "spikes", "stile", "sump_buster", "swing_gate",
    "toll_booth", "turnstile", "wedge", "wicket_gate", "yes", "bar", "barrier_board", "chain", "jersey_barrier", "kerb", "log", "rope",
    "tank_trap", "tyres",
]
#: Travel mode to its children.
MODES = {
    "dog": [], "foot": ["dog"], "horse": [], "inline_skates": [], "ice_skates": [], "ski": [], "electric_bicycle": [],
    "bicycle": ["electric_bicycle"], "kick_scooter": [], "carriage": [], "caravan": [], "trailer": ["caravan"], "motorcycle": [],
    "speed_pedelec": [], "moped": ["speed_pedelec"], "mofa": [], "small_electric_vehicle": [], "motorcar": [], "motorhome": [], "coach": [],
    "tourist_bus": ["coach"], "goods": [], "hgv_articulated": [], "bdouble": [], "hgv": ["hgv_articulated", "bdouble"], "agricultural": [],
    "golf_cart": [], "bus": [], "taxi": [], "minibus": [], "share_taxi": [], "psv": ["bus", "taxi", "minibus", "share_taxi"], "carpool": [],
    "hov": ["carpool"], "emergency": [], "hazmat:water": [], "hazmat": ["hazmat:water"], "disabled": [], "delivery": [],
    "motor_vehicle": ["trailer", "motorcycle", "moped", "mofa", "small_electric_vehicle", "motorcar", "motorhome", "tourist_bus", "goods", "hgv",
                      "agricultural", "golf_cart", "psv", "hov", "emergency", "hazmat", "disabled", "carpool", "delivery"],
    "vehicle": ["bicycle", "kick_scooter", "carriage", "motor_vehicle"],
    "access": ["vehicle", "foot", "horse", "inline_skates", "ice_skates", "ski"],
}
SMOOTHNESS = ["excellent", "good", "intermediate", "bad", "very_bad", "horrible", "very_horrible", "impassable"]
SURFACES = [
    "paved", "asphalt", "chipseal", "concrete", "concrete:lanes", "concrete:plates", "paving_stones", "sett", "unhewn_cobblestone", "cobblestone",
    "bricks", "metal", "wood", "stepping_stones", "rubber", "unpaved", "compacted", "fine_gravel", "gravel", "shells", "rock", "pebblestone",
    "ground", "dirt", "earth", "grass", "grass_paver", "metal_grid", "mud", "sand", "woodchips", "snow", "ice", "salt", "clay", "tartan",
    "artificial_turf", "acrylic", "carpet", "plastic",
]
RESTRICTIONS = [
    "no_right_turn", "no_left_turn", "no_u_turn", "no_straight_on", "no_entry", "no_exit", "only_right_turn", "only_left_turn", "only_u_turn",
    "only_straight_on",
]

NO, FORWARD, REVERSE, BOTH = 0, 1, -1, 2


def _tag(key: str, tags: str = "tags") -> Column:
    return F.try_element_at(F.col(tags), F.lit(key))


def _any_case(tags: str, key: str) -> Column:
    """The value of the first key that equals this one in any case."""
    found = F.filter(F.map_entries(tags), lambda e: F.lower(e["key"]) == key)
    return F.try_element_at(found, F.lit(1))["value"]


def _known(value: Column, values: list[str]) -> Column:
    """The value in lower case if it is one of these; names with ``_`` for ``:`` and ``-`` count, too."""
    low = F.lower(value)
    out = F.when(low.isin(values), low)
    for v in values:
        plain = v.replace(":", "_").replace("-", "_")
        if plain != v:
            out = out.when(low == plain, F.lit(v))
    return out


def mode_of(value: Column) -> Column:
    return _known(value, list(MODES))


def mode_edges(spark) -> DataFrame:
    """N13. (parent, child) of travel modes."""
    return spark.createDataFrame([(p, c) for p, cs in MODES.items() for c in cs], "parent string, child string")


def highway_ways(ways: DataFrame) -> DataFrame:
    """N1. Ways of the highway classes and those under construction."""
    return ways.where(_any_case("tags", "highway").isin([*HIGHWAYS, "construction"]))


def node_ref_count(ways: DataFrame) -> DataFrame:
    """N2. (node_id, refs) over highway ways; a node that a way passes twice counts twice."""
    return highway_ways(ways).select(F.explode("nodes").alias("node_id")).groupBy("node_id").agg(F.count("*").alias("refs"))


def barrier_nodes(nodes: DataFrame) -> DataFrame:
    """N3. (node_id, barrier_type, modes_allowed, modes_restricted); unknown types are dropped."""
    kind = _known(_tag("barrier"), BARRIERS)

    def modes(values: list[str]) -> Column:
        return F.array_compact(F.array(*(F.when(_tag(m).isin(values), F.lit(m)) for m in MODES)))

    return nodes.select(F.col("id").alias("node_id"), kind.alias("barrier_type"), modes(["designated", "permissive", "dismount", "yes"]).alias("modes_allowed"), modes(["no", "private"]).alias("modes_restricted")).where("barrier_type is not null")


def tower_nodes(counts: DataFrame, barriers: DataFrame) -> DataFrame:
    """N4. Nodes that two ways share, and barriers."""
    return counts.where("refs > 1").select("node_id").union(barriers.select("node_id")).distinct()


def split_links(nodes: DataFrame, ways: DataFrame, barriers: DataFrame | None = None) -> DataFrame:
    """N5, N6. (way_id, way_link_index, start_node_id, end_node_id, meters, geometry) of highway ways cut at tower nodes.

    Both ends of a way are cuts. Unknown nodes are left out of a link; a link of less than two known nodes is
    dropped, but its index is used up. Counts, places and barriers of nodes come from one grouping, which is written out
    so that the join with the ways' nodes can split a hot one; the nodes of a way then meet in one list and are cut there.
    """
    barriers = barrier_nodes(nodes) if barriers is None else barriers
    steps = highway_ways(ways).select(F.col("id").alias("way_id"), F.size("nodes").alias("n"), F.posexplode("nodes").alias("pos", "node_id"))
    place = geo.point("lon", "lat")
    none = F.lit(None).cast("struct<x:double,y:double>")

    def seen(df: DataFrame, node: str, refs: int, p: Column, barrier: bool, known: bool) -> DataFrame:
        return df.select(F.col(node).alias("node_id"), F.lit(refs).alias("refs"), p.alias("p"), F.lit(barrier).alias("barrier"), F.lit(known).alias("known"))

    every = seen(steps, "node_id", 1, none, False, False).union(seen(nodes, "id", 0, place, False, True)).union(seen(barriers, "node_id", 0, none, True, False))
    merged = every.groupBy("node_id").agg(F.sum("refs").alias("refs"), F.max("p").alias("p"), F.max("barrier").alias("barrier"), F.max("known").alias("known")).where("refs > 0")
    info = materialize(merged.select("node_id", "p", "known", (F.col("barrier") | (F.col("refs") > 1)).alias("tower")), "nodes")
    cut = (F.col("pos") == 0) | (F.col("pos") == F.col("n") - 1) | F.coalesce("tower", F.lit(False))
    met = steps.join(info, "node_id", "left").select("way_id", F.struct("pos", "node_id", "p", F.coalesce("known", F.lit(False)).alias("known"), cut.alias("cut")).alias("e"))
    whole = met.groupBy("way_id").agg(F.array_sort(F.collect_list("e")).alias("s"))
    cuts = F.filter(F.transform("s", lambda e, i: F.when(e["cut"], i)), lambda i: i.isNotNull())
    between = whole.withColumn("cuts", cuts).where(F.size("cuts") > 1)

    def link(i: Column) -> Column:
        first, last = F.get("cuts", i), F.get("cuts", i + 1)
        return F.struct(i.alias("way_link_index"), F.filter(F.slice("s", first + 1, last - first + 1), lambda e: e["known"]).alias("s"))

    links = between.select("way_id", F.explode(F.transform(F.sequence(F.lit(0), F.size("cuts") - 2), link)).alias("l")).select("way_id", "l.*").where("size(s) >= 2")
    line = F.transform("s", lambda e: e["p"])
    return links.select("way_id", "way_link_index", F.col("s")[0]["node_id"].alias("start_node_id"), F.element_at("s", -1)["node_id"].alias("end_node_id"), geo.great_circle_length(line).alias("meters"), line.alias("geometry"))


def street_name(tags: str = "tags") -> Column:
    """N7. name, else ref, int_ref, reg_name."""
    return first_tag(tags, ["name", "ref", "int_ref", "reg_name"])


def link_attributes() -> Column:
    """N8. The flags that hold, sorted."""
    tunnel, lit = _tag("tunnel"), F.lower(_tag("lit"))
    some = lambda c: c.isNotNull() & (c != "")
    flags = {
        "ROUNDABOUT": _tag("junction") == "roundabout",
        "CIRCULAR": _tag("junction") == "circular",
        "TUNNEL": some(tunnel) & (tunnel != "building_passage"),
        "BUILDING_PASSAGE": tunnel == "building_passage",
        "BRIDGE": some(_tag("bridge")),
        "MOTORROAD": (_tag("motorroad") == "yes") | (_tag("highway") == "motorway"),
        "LIT": lit.isin("yes", "24/7"),
        "NOT_LIT": lit.isin("no", "disused"),
        "CONSTRUCTION": F.lower(_tag("highway")) == "construction",
        "SIDEPATH": F.coalesce(F.lower(_tag("footway")) == "sidewalk", F.lit(False)) | F.coalesce(F.lower(_tag("is_sidepath")) == "yes", F.lit(False)),
    }
    return F.array_sort(F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in flags.items()))))


def highway_class() -> Column:
    """N9. The class; of a way under construction that of its ``construction`` tag, else unclassified."""
    building = F.coalesce(F.lower(_tag("highway")) == "construction", F.lit(False))
    return F.when(building, F.coalesce(_known(_tag("construction"), HIGHWAYS), F.lit("unclassified"))).otherwise(_known(_any_case("tags", "highway"), HIGHWAYS))


def smoothness() -> Column:
    """N10. Known values; the old ``very_good`` is excellent."""
    v = F.lower(_tag("smoothness"))
    return _known(F.when(v == "very_good", "excellent").otherwise(v), SMOOTHNESS)


def surface() -> Column:
    """N10. Known values; ``cobblestone:flattened`` is sett, ``ash`` is clay."""
    v = F.lower(_tag("surface"))
    return _known(F.when(v == "cobblestone:flattened", "sett").when(v == "ash", "clay").otherwise(v), SURFACES)


def speed_kmh(value: Column) -> Column:
    """N11. km/h from a speed tag: walk 15, none 0, mph and knots converted; null where it is no number."""
    v = F.lower(F.trim(value))
    unit = F.regexp_extract(v, r"(knots|mph|km/h)$", 1)
    number = F.trim(F.regexp_replace(v, r"(knots|mph|km/h)$", "")).try_cast("double")
    scale = F.when(unit == "knots", 1.852).when(unit == "mph", 1.609344).otherwise(1.0)
    return F.when(v == "walk", 15.0).when(v == "none", 0.0).otherwise(number * scale)


def max_speeds() -> tuple[Column, Column]:
    """N11. (forward, reverse); the tag of a direction wins if it is a speed."""
    both = speed_kmh(_tag("maxspeed"))
    return F.coalesce(speed_kmh(_tag("maxspeed:forward")), both), F.coalesce(speed_kmh(_tag("maxspeed:backward")), both)


def oneway_direction(value: Column) -> Column:
    low = F.lower(value)
    return F.when(low == "yes", FORWARD).when(low == "no", BOTH).when(value.isin("-1", "reverse"), REVERSE).when(low == "reversible", NO).when(low == "alternating", BOTH)


def general_direction() -> Column:
    """N12. Direction for all modes: both without a oneway tag, null for an unknown value."""
    oneway = F.nullif(_tag("oneway"), F.lit(""))
    return F.when(oneway.isNull(), BOTH).otherwise(oneway_direction(oneway))


def travel_modes() -> Column:
    """N12. MAP<mode, direction> from access tags and ``oneway:<mode>`` tags, which win.

    A designated mode closes the way to others (access 0) unless the tags say more on access.
    """
    general = F.coalesce(general_direction(), F.lit(BOTH))
    entries = F.map_entries("tags")

    def access(e: Column) -> Column:
        low = F.lower(e["value"])
        direction = F.when(low.isin("use_sidepath", "no", "private"), NO).when(low.isin("designated", "optional_sidepath", "permissive", "dismount", "yes"), general)
        return F.struct(mode_of(e["key"]).alias("key"), direction.alias("value"))

    def oneway(e: Column) -> Column:
        return F.struct(F.when(e["key"].startswith("oneway:"), mode_of(F.substring(e["key"], 8, 100))).alias("key"), oneway_direction(e["value"]).alias("value"))

    def sound(es: Column) -> Column:
        return F.filter(es, lambda e: e["key"].isNotNull() & e["value"].isNotNull())

    own, turns = sound(F.transform(entries, access)), sound(F.transform(entries, oneway))
    closes = F.exists(entries, lambda e: mode_of(e["key"]).isNotNull() & (F.lower(e["value"]) == "designated"))
    closed = F.when(closes & ~F.exists(own, lambda e: e["key"] == "access"), F.array(F.struct(F.lit("access").alias("key"), F.lit(NO).alias("value")))).otherwise(F.filter(own, lambda e: F.lit(False)))
    kept = F.filter(F.concat(own, closed), lambda e: ~F.exists(turns, lambda t: t["key"] == e["key"]))
    return F.when(F.col("tags").isNotNull(), F.map_from_entries(F.concat(kept, turns)))


def link_tags(ways: DataFrame) -> DataFrame:
    """N7-N12. Name, flags, class, smoothness, surface, speeds and directions of highway ways."""
    forward, reverse = max_speeds()
    return highway_ways(ways).select(
        F.col("id").alias("way_id"), street_name().alias("name"), link_attributes().alias("attributes"), highway_class().alias("highway_class"),
        smoothness().alias("smoothness"), surface().alias("surface"), forward.alias("max_speed_forward"), reverse.alias("max_speed_reverse"),
        general_direction().alias("direction"), travel_modes().alias("mode_directions"),
    )


def turn_restrictions(relations: DataFrame) -> DataFrame:
    """N14. (relation_id, restriction, only, from_way, via, to_way, modes, modes_except) of restriction relations.

    ``via`` is the array of members. Several ``from`` members need no_entry, several ``to`` members no_exit, and give
    a row each; both at once, or a missing role, drop the relation. The type comes from ``restriction``, or from
    the last ``restriction:<mode>`` tag, whose modes are listed.
    """

    def role(name: str) -> Column:
        return F.filter("members", lambda m: F.lower(m["role"]) == name)

    members = {r: role(r) for r in ("from", "via", "to")}
    special = F.filter(F.map_entries("tags"), lambda e: e["key"].startswith("restriction:"))
    named = _known(F.try_element_at(special, F.lit(-1))["value"], RESTRICTIONS)
    kind = F.when(F.size(special) > 0, named).otherwise(_known(_tag("restriction"), RESTRICTIONS))
    modes = F.array_compact(F.array_distinct(F.transform(special, lambda e: mode_of(F.get(F.split(e["key"], ":"), F.lit(1))))))
    excepted = F.array_compact(F.array_distinct(F.transform(F.split(_tag("except"), ";"), mode_of)))
    rows = relations.where(_tag("type") == "restriction").select(
        F.col("id").alias("relation_id"), kind.alias("restriction"), *(c.alias(f"m_{r}") for r, c in members.items()), F.array_sort(modes).alias("modes"), F.array_sort(excepted).alias("modes_except")
    )
    whole = rows.where("size(m_from) > 0 and size(m_via) > 0 and size(m_to) > 0")
    plain = whole.where(
        "(size(m_from) = 1 or coalesce(restriction = 'no_entry', false)) and (size(m_to) = 1 or coalesce(restriction = 'no_exit', false)) and (size(m_from) = 1 or size(m_to) = 1)"
    )
    spread = plain.withColumn("f", F.explode("m_from")).withColumn("t", F.explode("m_to"))
    return spread.select("relation_id", "restriction", F.col("restriction").startswith("only_").alias("only"), F.col("f.ref").alias("from_way"), F.col("m_via").alias("via"), F.col("t.ref").alias("to_way"), "modes", "modes_except")


def turn_links(restrictions: DataFrame, links: DataFrame) -> DataFrame:
    """N15. Restrictions with the link that leads to the via member and the one that leads away, and their directions.

    A direction is 1, -1, 2 (both) or 0 (the way does not touch). Nulls where a way has no links.
    """
    order = F.col("way_link_index")
    ends = links.groupBy("way_id").agg(
        F.min_by("start_node_id", order).alias("first_node"), F.max_by("end_node_id", order).alias("last_node"), F.min("way_link_index").alias("first_link"), F.max("way_link_index").alias("last_link")
    )

    def via_nodes(df: DataFrame, which: int, out: str) -> DataFrame:
        member = F.element_at("via", which)
        keyed = df.withColumns({"__via": member["ref"], "__node": F.lower(member["type"]) == "node"})
        way = ends.select(F.col("way_id").alias("__via"), F.lit(False).alias("__node"), F.array("first_node", "last_node").alias("__ends"))
        joined = keyed.join(way, ["__via", "__node"], "left")
        return joined.withColumn(out, F.when(F.col("__node"), F.array("__via")).otherwise(F.col("__ends"))).drop("__via", "__node", "__ends")

    def direction(forward: Column, reverse: Column) -> Column:
        return F.when(forward & reverse, BOTH).when(forward, FORWARD).when(reverse, REVERSE).when(forward.isNotNull() & reverse.isNotNull(), NO)

    def of(side: str, df: DataFrame) -> DataFrame:
        own = ends.select(F.col("way_id").alias(f"{side}_way"), *(F.col(c).alias(f"__{c}") for c in ("first_node", "last_node", "first_link", "last_link")))
        joined = df.join(own, f"{side}_way", "left")
        at_first, at_last = F.array_contains(f"__via_{side}", F.col("__first_node")), F.array_contains(f"__via_{side}", F.col("__last_node"))
        forward, reverse = (at_last, at_first) if side == "from" else (at_first, at_last)
        near, far = ("__last_link", "__first_link") if side == "from" else ("__first_link", "__last_link")
        link = F.when(forward, F.col(near)).when(forward.isNotNull(), F.col(far))
        return joined.withColumns({f"{side}_link": link, f"{side}_direction": direction(forward, reverse)}).drop(*(c for c in joined.columns if c.startswith("__") and c != "__via_to"))

    both = via_nodes(via_nodes(restrictions, 1, "__via_from"), -1, "__via_to")
    return of("to", of("from", both)).drop("__via_to")
