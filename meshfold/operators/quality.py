"""Data-quality queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshfold.functions import geometry as g
from meshfold.functions import ids
from meshfold.operators.bbox import nested_pairs
from meshfold.session import cut_lineage, written

IDENTITY_KEYS = ("name", "name:ja", "addr:street", "addr:housenumber", "amenity", "shop", "tourism",
                 "leisure", "landuse")


def duplicate_identifiers(buildings: DataFrame) -> DataFrame:
    """Identifiers used more than once within a city; should be empty."""
    return buildings.filter("building_ref is not null").groupBy("city_code", "building_ref").agg(
        F.count("*").alias("rows")).filter(F.col("rows") > 1)


def nested_buildings(buildings: DataFrame) -> DataFrame:
    """(inner, outer) buildings of one city, the inner wholly within the outer.

    Holes count as outside, and a copy of the same outline is not nested. Only buildings of
    one city whose boxes are nested meet, by cells of the size of the outer box.
    """
    # Read three times below: the boxes and areas are worked out once.
    # Four points that span twice the area of their box are its corners.
    is_box = (F.size("rings") == 1) & (F.size(F.col("rings")[0]) == 4) & (F.col("area2") == 2 * (
        F.col("max_lon") - F.col("min_lon")) * (F.col("max_lat") - F.col("min_lat")))
    boxes = written(buildings.filter("rings is not null").select(
        "id", "city_code", "min_lon", "min_lat", "max_lon", "max_lat", "area2", "rings",
        F.coalesce(is_box, F.lit(False)).alias("is_box")), "nested-boxes")
    outer = boxes.select(
        F.col("id").alias("outer_id"), "city_code", F.col("min_lon").alias("west"), F.col("min_lat").alias("south"),
        F.col("max_lon").alias("east"), F.col("max_lat").alias("north"), F.col("area2").alias("outer_area2"), "is_box")
    inner = boxes.select(F.col("id").alias("inner_id"), "city_code", "min_lon", "min_lat", "max_lon", "max_lat", "area2")
    pairs = written(nested_pairs(outer, inner, ["city_code"]).filter(
        (F.col("outer_id") != F.col("inner_id")) & (F.col("area2") < F.col("outer_area2"))).select(
        "inner_id", "outer_id", "is_box"), "nested-pairs")
    # A building that is its box covers all that lies in it. Shapes come to the other pairs only.
    shape = lambda end: boxes.select(F.col("id").alias(f"{end}_id"), F.col("rings").alias(f"{end}_rings"))
    told = pairs.filter("is_box").select("inner_id", "outer_id")
    shaped = pairs.filter("not is_box").join(shape("inner"), "inner_id").join(shape("outer"), "outer_id")
    covered = g.polygon_covers(g.edges(F.col("outer_rings")), F.col("inner_rings"), g.edges(F.col("inner_rings")))
    return told.unionByName(shaped.filter(covered).select("inner_id", "outer_id"))


def rings_by_number(nodes: DataFrame) -> DataFrame:
    return nodes.groupBy("ring_id").agg(F.count("*").alias("nodes"))


def shared_corners(nodes: DataFrame) -> DataFrame:
    """Coordinates with several node rows, the rows there, and their share."""
    per_place = nodes.groupBy("lat_i", "lon_i").agg(F.count("*").alias("n"))
    shared = F.col("n") > 1
    return per_place.agg(
        F.count_if(shared).alias("coordinates"),
        F.coalesce(F.sum(F.when(shared, F.col("n"))), F.lit(0)).alias("rows"),
        F.sum("n").alias("total")).select(
        "coordinates", "rows", "total", (F.col("rows") / F.col("total") * 100).alias("share"))


def rounding_collisions(nodes: DataFrame, lat_step: int, lon_step: int) -> DataFrame:
    """Distinct coordinates before and after rounding to coarser steps (1e-7 degree)."""
    distinct = nodes.select("lat_i", "lon_i").distinct()

    def rounded(col, step):
        return F.floor((F.col(col) + step // 2) / step) * step

    return distinct.groupBy(rounded("lat_i", lat_step).alias("a"), rounded("lon_i", lon_step).alias("b")).agg(
        F.count("*").alias("n")).agg(
        F.sum("n").alias("coordinates"), F.count("*").alias("after_rounding"),
        (F.sum("n") - F.count("*")).alias("collisions"))


def area_bands(buildings: DataFrame) -> DataFrame:
    """Small areas by number of closed outer points."""
    area = g.area_m2(F.col("area2"), F.col("cen_lat"))
    rows = buildings.filter("rings is not null").select(
        (F.size(F.col("rings")[0]) + 1).alias("n_points"), area.alias("area"))
    return rows.groupBy("n_points").agg(
        F.count("*").alias("total"), F.count_if(F.col("area") < 1).alias("below_1"),
        F.count_if(F.col("area") < 5).alias("below_5"), F.count_if(F.col("area") < 10).alias("below_10"))


def elongation(buildings: DataFrame, below_m2: float) -> DataFrame:
    """Perimeter over root of area for polygons smaller than ``below_m2``; 4 is a square."""
    rows = buildings.withColumn("area", g.area_m2(F.col("area2"), F.col("cen_lat"))).filter(
        (F.col("area") > 0) & (F.col("area") < below_m2))
    perimeter = g.perimeter_m(F.slice("rings", 1, 1), F.col("cen_lat"))
    return rows.select("id", "area", (perimeter / F.sqrt("area")).alias("elongation"))


def cross_city_duplicates(buildings: DataFrame) -> DataFrame:
    """Places (centroid, height) held by more than one city."""
    outlines = buildings.filter("building_part is null and cen_lon is not null")
    return outlines.groupBy("cen_lon", "cen_lat", "height").agg(
        F.count("*").alias("rows"), F.countDistinct("city_code").alias("cities")).filter(
        F.col("cities") > 1).agg(
        F.count("*").alias("buildings"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))


def far_parts(buildings: DataFrame) -> DataFrame:
    """Parts that do not meet their parent: count, median and largest centroid distance."""
    parents = buildings.select(F.col("id").alias("parent_building_id"), F.col("rings").alias("p_rings"),
                               F.col("cen_lon").alias("p_lon"), F.col("cen_lat").alias("p_lat"))
    pairs = buildings.filter("parent_building_id is not null").join(parents, "parent_building_id")
    apart = ~g.polygons_intersect(g.edges(F.col("rings")), g.edges(F.col("p_rings")))
    distance = g.distance_m(F.col("cen_lon"), F.col("cen_lat"), F.col("p_lon"), F.col("p_lat"))
    # The median by numbering the sorted distances: no task gathers them all.
    found = cut_lineage(pairs.filter(apart).select(distance.alias("d")))
    total = found.agg(F.count("*").alias("parts"), F.count("d").alias("known"), F.max("d").alias("max_m"))
    numbered = ids.dense_ids(found.filter("d is not null"), ["d"])
    median = numbered.crossJoin(total).filter("id in ((known + 1) div 2, (known + 2) div 2)").agg(
        F.avg("d").alias("median_m"))
    return total.crossJoin(median).select("parts", "median_m", "max_m")


def lost_identity_tags(ways: DataFrame, kept: DataFrame, keys=IDENTITY_KEYS) -> DataFrame:
    """(file, key, value) of dropped ways that no kept element of the file carries.

    ``ways`` has tag lists; ``kept`` has tag maps.
    """
    dropped = ways.join(kept.select("file_key", "id"), ["file_key", "id"], "left_anti").select(
        "file_key", F.explode("tags").alias("t")).select(
        "file_key", F.col("t.k").alias("key"), F.col("t.v").alias("value"))
    held = kept.select("file_key", F.explode("tags").alias("key", "value"))
    return dropped.filter(F.col("key").isin(*keys)).distinct().join(
        held.distinct(), ["file_key", "key", "value"], "left_anti")


def near_duplicate_parts(buildings: DataFrame) -> DataFrame:
    """Parts that repeat their outline: the only big part of a parent, of like height
    and levels, with centre and outline close by.

    Big: heights within 0.5 m, equal levels, more than half of the outline's area.
    """
    parents = buildings.select(
        F.col("id").alias("parent_building_id"), F.col("height").alias("p_height"),
        F.col("building_levels").alias("p_levels"), F.col("area2").alias("p_area2"),
        F.col("cen_lon").alias("p_lon"), F.col("cen_lat").alias("p_lat"), F.col("rings").alias("p_rings"))
    big = buildings.filter("building_part = 'yes'").join(parents, "parent_building_id").filter(
        (F.abs(F.col("height") - F.col("p_height")) < 0.5) & (F.col("building_levels") == F.col("p_levels"))
        & (F.col("area2") * 2 > F.col("p_area2")))
    per_parent = big.groupBy("parent_building_id").agg(F.count("*").alias("n_big"))
    close = g.distance_m(F.col("cen_lon"), F.col("cen_lat"), F.col("p_lon"), F.col("p_lat")) < 5
    return big.join(per_parent.filter("n_big = 1"), "parent_building_id").filter(
        close & (g.hausdorff_m(F.col("rings"), F.col("p_rings")) < 10)).select("id", "parent_building_id")


def role_swaps(buildings: DataFrame) -> DataFrame:
    """Parents whose largest part is bigger than the outline and covers every member.

    Equal areas: the smaller id. Report only.
    """
    parts = buildings.filter("parent_building_id is not null and rings is not null").select(
        "id", "parent_building_id", "area2", "rings")
    largest = parts.groupBy("parent_building_id").agg(
        F.max_by(F.struct("id", "area2", "rings"), F.struct("area2", -F.col("id"))).alias("big"))
    outlines = buildings.select(F.col("id").alias("parent_building_id"), F.col("area2").alias("o_area2"),
                                F.col("rings").alias("o_rings"))
    bigger = largest.join(outlines, "parent_building_id").filter(F.col("big.area2") > F.col("o_area2"))
    members = bigger.select("parent_building_id", "big", F.col("o_rings").alias("rings")).unionByName(
        bigger.select("parent_building_id", "big").join(parts, "parent_building_id")
        .filter(F.col("id") != F.col("big.id")).select("parent_building_id", "big", "rings"))
    covers = g.polygon_covers(g.edges(F.col("big.rings")), F.col("rings"), g.edges(F.col("rings")))
    return members.groupBy("parent_building_id", F.col("big.id").alias("swap_id")).agg(
        F.bool_and(covers).alias("covers")).filter("covers").drop("covers")
