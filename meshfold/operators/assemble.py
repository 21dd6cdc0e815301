"""From element tables to building footprints.

Keys are (id, file_key), so even one file holding a third of all rows spreads over
the whole cluster. The id comes first because sorts compare the first bytes of a key, which all
file keys of a city share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshfold import fixed_values as fv
from meshfold.functions import geometry as g
from meshfold.functions import numbers
from meshfold.session import written

BOUNDS = (fv.MIN_LAT, fv.MAX_LAT, fv.MIN_LON, fv.MAX_LON)


def tag_map(tags: Column) -> Column:
    """Tag list to map: empty keys and values go, the last duplicate stays."""
    kept = F.filter(tags, lambda t: (t["k"] != "") & (t["v"] != ""))
    return F.map_from_entries(kept)


def last_per_id(df: DataFrame) -> DataFrame:
    """The last row, by ``pos``, of each id of a file. Numbers are folded one by one, which Spark does in
    place by hash; texts and lists go together, which it can only do by sorting."""
    rest = [c for c in df.columns if c not in ("file_key", "id")]
    if all(t in ("double", "bigint", "int") for c, t in df.dtypes if c in rest):
        return df.groupBy("id", "file_key").agg(*[F.max_by(c, "pos").alias(c) for c in rest]).select(
            "file_key", "id", *rest)
    return df.groupBy("id", "file_key").agg(
        F.max_by(F.struct(*rest), "pos").alias("_last")).select("file_key", "id", "_last.*")


def valid_nodes(nodes: DataFrame, bounds=BOUNDS) -> DataFrame:
    """Nodes with readable coordinates inside the bounds (inclusive)."""
    lat, lon = numbers.read_float(F.col("lat")), numbers.read_float(F.col("lon"))
    # A list of one or none: a plain filter would be pushed below and read every number twice.
    inside = F.filter(F.array(F.struct(lat.alias("lat"), lon.alias("lon"))), lambda p: (
        p["lat"].between(bounds[0], bounds[1]) & p["lon"].between(bounds[2], bounds[3])))
    read = nodes.select("file_key", "id", "pos", F.inline(inside))
    return last_per_id(read).select(
        "file_key", "id", "lat", "lon", numbers.quantise(F.col("lat")).alias("lat_i"),
        numbers.quantise(F.col("lon")).alias("lon_i"))


def is_building(tags: Column) -> Column:
    return tags[fv.BUILDING_KEY].isNotNull() | tags[fv.PART_KEY].isNotNull()


def has_tag(tags: Column, *keys: str) -> Column:
    """Whether the tag list gives any of ``keys`` a value; true where ``tag_map`` has one, without building the map."""
    return F.exists(tags, lambda t: t["k"].isin(*keys) & (t["v"] != ""))


def building_relations(relations: DataFrame) -> DataFrame:
    """Multipolygons that stand for a building, with their outer and inner ways."""
    mapped = relations.withColumn("tags", tag_map(F.col("tags")))
    kept = mapped.filter((F.col("tags")["type"] == "multipolygon") & is_building(F.col("tags")))

    def refs(role):
        return F.transform(F.filter("members", lambda m: (m["type"] == "way") & (m["role"] == role)),
                           lambda m: m["ref"])

    return kept.select("file_key", "id", "tags", "pos", refs("outer").alias("outers"),
                       refs("inner").alias("inners"))


def usable(relations: DataFrame) -> DataFrame:
    return relations.filter(F.size("outers") == 1)


def rejected_relations(relations: DataFrame) -> DataFrame:
    return relations.filter(F.size("outers") != 1).select(
        "file_key", "id", F.size("outers").alias("n_outer"),
        F.when(F.size("outers") == 0, "no outer").otherwise("several outers").alias("cause"))


def ring_member_ways(relations: DataFrame) -> DataFrame:
    """Ways that are rings of a building relation: inners of all, outers of usable ones."""
    inners = relations.select(F.explode("inners").alias("id"), "file_key")
    outers = usable(relations).select(F.col("outers")[0].alias("id"), "file_key")
    return inners.unionByName(outers).distinct().select("file_key", "id")


def member_refs(ways: DataFrame, members: DataFrame) -> DataFrame:
    """(file_key, id, nd) of the ways in ``members(file_key, id)``; the last way of an id counts."""
    wanted = members.select("id", "file_key").distinct()
    listed = ways.select("file_key", "id", "nd", "pos").join(wanted, ["id", "file_key"], "left_semi")
    return last_per_id(listed).select("file_key", "id", "nd")


def building_ways(ways: DataFrame, relations: DataFrame) -> DataFrame:
    """Own buildings among the ways: tagged, with an identifier, no ring of a relation."""
    tagged = ways.filter(has_tag(F.col("tags"), fv.BUILDING_KEY, fv.PART_KEY) & has_tag(F.col("tags"), fv.IDENTIFIER_KEY))
    free = tagged.join(ring_member_ways(relations), ["id", "file_key"], "left_anti")
    return free.withColumn("tags", tag_map(F.col("tags"))).select(*ways.columns)


def twin_rings(ways: DataFrame, relations: DataFrame) -> DataFrame:
    """(file_key, ring, relation_id): outer rings on raw references; the last relation wins."""
    outlines = usable(relations).select(
        "file_key", F.col("id").alias("relation_id"), F.col("pos").alias("rel_pos"),
        F.col("outers")[0].alias("id"))
    keyed = outlines.join(member_refs(ways, outlines), ["id", "file_key"]).withColumn("ring", g.ring_key(F.col("nd")))
    return keyed.filter("ring is not null").groupBy("file_key", "ring").agg(
        F.max_by("relation_id", "rel_pos").alias("relation_id"))


def split_twins(candidates: DataFrame, rings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ways that stay buildings, identifier per relation taken from its twin way). Both are read several times
    from one written table; rings meet by their hash before they are compared."""
    keyed = candidates.withColumn("ring", g.ring_key(F.col("nd"))).withColumn("ring_hash", F.xxhash64("ring"))
    marked = written(keyed.join(
        rings.withColumn("ring_hash", F.xxhash64("ring")), ["ring_hash", "file_key", "ring"], "left").select(
        *candidates.columns, "relation_id"), "candidate-ways")
    stay = marked.filter("relation_id is null").drop("relation_id")
    refs = marked.filter("relation_id is not null").groupBy(
        F.col("relation_id").alias("id"), "file_key").agg(
        F.max_by(F.col("tags")[fv.IDENTIFIER_KEY], F.col("pos")).alias("twin_ref"))
    return stay, refs.select("file_key", "id", "twin_ref")


def resolve_points(rings: DataFrame, nodes: DataFrame, outer_points: int = 0) -> DataFrame:
    """Way references to points, order kept, unknown references dropped.

    ``rings``: (file_key, element, member_pos, nd). One row per element with
    ``parts``: its rings in member order, each an array of points. One shuffle to
    the nodes and one back. Elements with fewer than ``outer_points`` points in member 0 go.
    """
    refs = rings.select("file_key", "element", "member_pos", F.posexplode("nd").alias("seq", "id"))
    points = refs.join(nodes.select("file_key", "id", "lat_i", "lon_i"), ["id", "file_key"]).select(
        "element", "file_key", "member_pos", "seq", "lon_i", "lat_i")
    # The points of an element lie apart until they are shuffled: lists made before would hold one point each.
    listed = points.repartition("element", "file_key").groupBy("element", "file_key").agg(F.sort_array(F.collect_list(
        F.struct("member_pos", "seq", "lon_i", "lat_i"))).alias("pts"))
    if outer_points:
        listed = listed.filter(F.size(F.filter("pts", lambda p: p["member_pos"] == 0)) >= outer_points)
    def part(member, pts):
        points = F.transform(pts, lambda p: g.point(p["lon_i"], p["lat_i"]))
        return F.struct(member.alias("member_pos"), points.alias("points"))

    first, last = F.element_at("pts", 1)["member_pos"], F.element_at("pts", -1)["member_pos"]
    members = F.array_distinct(F.transform("pts", lambda p: p["member_pos"]))
    parts = F.when(first == last, F.array(part(first, F.col("pts")))).otherwise(
        F.transform(members, lambda m: part(m, F.filter("pts", lambda p: p["member_pos"] == m))))
    return listed.select("file_key", "element", parts.alias("parts"))


def footprints(tables: dict[str, DataFrame], bounds=BOUNDS) -> DataFrame:
    """All buildings of all files, before cleaning.

    Columns: file_key, element ('w<id>' / 'r<id>'), way_id, is_multipolygon, pos,
    tags, ``rings``: array of (ring_no, points) with ring 0 outside.
    """
    relations = written(building_relations(tables["relations"]), "building-relations")
    ways = tables["ways"]
    stay, twin_refs = split_twins(building_ways(ways, relations), twin_rings(ways, relations))
    plain = stay.select(
        "file_key", F.concat(F.lit("w"), "id").alias("element"), F.col("id").alias("way_id"),
        F.lit(0).alias("is_multipolygon"), "pos", "tags", "nd")

    merged = usable(relations).join(twin_refs, ["id", "file_key"], "left")
    merged = merged.withColumn("tags", F.when(
        F.col("twin_ref").isNotNull(),
        F.map_concat(F.map_filter("tags", lambda k, v: k != fv.IDENTIFIER_KEY),
                     F.create_map(F.lit(fv.IDENTIFIER_KEY), "twin_ref"))).otherwise(F.col("tags")))
    merged = written(merged.filter(F.col("tags")[fv.IDENTIFIER_KEY].isNotNull()).select(
        "file_key", F.concat(F.lit("r"), "id").alias("element"), F.col("id").alias("way_id"),
        F.lit(1).alias("is_multipolygon"), "pos", "tags",
        F.concat("outers", "inners").alias("refs")), "merged-relations")

    members = merged.select("file_key", "element", F.posexplode("refs").alias("member_pos", "id"))
    relation_rings = members.join(member_refs(ways, members), ["id", "file_key"]).select(
        "file_key", "element", "member_pos", "nd")
    way_rings = plain.select("file_key", "element", F.lit(0).alias("member_pos"), "nd")
    parts = resolve_points(way_rings.unionByName(relation_rings), valid_nodes(tables["nodes"], bounds), 3)

    elements = plain.drop("nd").unionByName(merged.drop("refs"))
    return elements.join(parts, ["element", "file_key"]).select(
        "file_key", "element", "way_id", "is_multipolygon", "pos", "tags",
        F.transform("parts", lambda p, i: F.struct(
            i.alias("ring_no"), p["points"].alias("points"))).alias("rings"))


def drop_bad_holes(rings: Column) -> Column:
    """Holes with fewer than four points after closing go; ring numbers stay."""
    return F.filter(rings, lambda r: (r["ring_no"] == 0) | (F.size(g.close_ring(r["points"])) >= 4))
