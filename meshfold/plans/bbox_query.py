"""The bounding-box query for a whole table of requests.

Everything that depends on a building alone (boundary flag, position key, tie
order, part-meets-parent, interior point) is worked out once per building. Pairs of
request and building, which are far more, carry only integers.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meshfold.functions import geometry as g
from meshfold.functions.ids import dense_ids
from meshfold.operators import boundary, dedup, firsts, layout
from meshfold.operators.bbox import box_pairs, candidates, strip_pairs
from meshfold.session import cut_lineage, written

ATTRIBUTES = [
    "id", "osm_id", "building", "height", "ele", "building_levels", "name", "addr_housenumber",
    "addr_street", "start_date", "building_material", "roof_material", "roof_shape", "amenity",
    "shop", "tourism", "leisure", "landuse", "building_part", "parent_building_id"]

BOX = ["min_lon", "min_lat", "max_lon", "max_lat", "cen_lon", "cen_lat"]


def flagged(buildings: DataFrame, master: DataFrame | None) -> DataFrame:
    return boundary.with_inside(buildings, master)


def prepared(buildings: DataFrame, master: DataFrame | None) -> DataFrame:
    """Outlines and orphan parts that may be answered, in one total order.

    ``rank`` numbers them by position key, then boundary flag, city and id; ``place``
    is the first rank of the same position key, ``copies`` their number. So within a request the copies of a
    building share ``place``, the one to keep has the least ``rank``, and the limit
    counts in order of ``place``, so in that of ``key_lon`` too. Shapes stay behind: only boxes and keys are ranked.
    """
    standing = F.col("building_part").isNull() | (
        (F.col("building_part") == "yes") & F.col("parent_building_id").isNull())
    narrow = buildings.filter(standing).select(
        "id", "city_code", "building_part", "height", "building_levels", *BOX)
    rows = boundary.keep_own_city(flagged(narrow, master)).filter("cen_lon is not null")
    keyed = dedup.position_key(rows).select(
        "id", "city_code", "building_part", *BOX, *dedup.POSITION_KEY,
        F.when(F.col("inside"), 0).otherwise(1).alias("sort_flag"))
    numbered = dense_ids(keyed, [*dedup.POSITION_KEY, "sort_flag", "city_code", "id"], 1, "rank")
    first = numbered.groupBy(*dedup.POSITION_KEY).agg(F.min("rank").alias("place"), F.count("*").alias("copies"))
    return numbered.join(first, dedup.POSITION_KEY).select(
        "id", "building_part", "rank", "place", "copies", "key_lon", *BOX)


def outline_candidates(requests, ready, shapes, mode="intersects", pairs_of=box_pairs) -> DataFrame:
    """(request_id, row_limit, id, rank, place) of outlines; ``ready`` = prepared(), ``shapes`` has id and rings."""
    pairs = candidates(requests, ready.filter(F.col("building_part").isNull()), mode, shapes, pairs_of)
    return pairs.select("request_id", "row_limit", "id", "rank", "place")


def first_copies(pairs: DataFrame) -> DataFrame:
    """One row per request and place: a hash aggregate on integers, folded map-side."""
    return pairs.groupBy("request_id", "row_limit", "place").agg(F.min("rank").alias("rank"))


def _ids(kept: DataFrame, ready: DataFrame) -> DataFrame:
    return kept.join(ready.select("rank", "id"), "rank").select("request_id", "id")


def first_places(requests, ready, shapes, mode="intersects") -> DataFrame:
    """(request_id, row_limit, place, rank) of the first outlines of each request, up to its limit.

    Places count from west to east, so each request is looked at in a strip at its west side. One that does not
    fill its limit there is looked at again in a wider strip, in the end as a whole: what is found is
    the same, but the pairs made grow with the limits, not with the square of the map.
    """
    rows = written(ready.filter(F.col("building_part").isNull()), "outlines")
    asked, found, turn = firsts.guessed(requests, rows), [], 0
    while True:
        asked = cut_lineage(firsts.strips(asked, turn))
        ways = {r.whole for r in asked.select((F.col("until") >= firsts.ALL).alias("whole")).distinct().collect()}

        def pairs_of(some, boxes, within=None):
            parts = [box_pairs(some.filter(F.col("until") >= firsts.ALL), boxes, within) if whole
                     else strip_pairs(some.filter(F.col("until") < firsts.ALL), boxes, within) for whole in ways or {True}]
            return reduce(DataFrame.unionByName, parts)

        kept = first_copies(outline_candidates(asked, rows, shapes, mode, pairs_of))
        cut = written(dedup.limit_per_group(kept, ["request_id"], [F.col("place")], "row_limit", ["rank"]), "firsts")
        more = cut_lineage(firsts.open_requests(asked, cut))
        if more.isEmpty():
            return reduce(DataFrame.unionByName, [*found, cut])
        again = more.select(F.col("request_id").alias("_again")).distinct()
        found.append(cut.join(again, F.col("request_id").eqNullSafe(F.col("_again")), "left_anti"))
        asked, turn = more.drop("until"), turn + 1


def outlines(requests, ready, shapes, mode="intersects") -> DataFrame:
    """(request_id, id) of deduplicated outlines, cut to each request's limit."""
    return _ids(first_places(requests, ready, shapes, mode), ready)


def orphan_parts(requests, ready, shapes, mode="intersects") -> DataFrame:
    """(request_id, id) of parts without a parent; they are not limited.

    A part without copies, met by a request of a single box, needs no folding: such pairs go on from where they are made.
    """
    boxes = Window.partitionBy("request_id")
    asked = cut_lineage(requests.select("request_id", "row_limit", "west", "south", "east", "north").distinct().withColumn(
        "_boxes", F.count("*").over(boxes)))
    parts = ready.filter(F.col("building_part").isNotNull())
    single, alone = F.col("_boxes") == 1, F.col("copies") == 1
    met = [candidates(asked.filter(single), parts.filter(alone), mode, shapes).select("request_id", "id")]
    for some, of in ((asked.filter(single), parts.filter(~alone)), (asked.filter(~single), parts)):
        if not some.isEmpty() and not of.isEmpty():
            met.append(_ids(first_copies(candidates(some, of, mode, shapes)), ready))
    return reduce(DataFrame.unionByName, met)


def part_links(buildings: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """(id, parent_building_id, intersects_parent) of every part with a parent; with ``wanted(id)`` of the
    parts of those only, and neither other parts nor other parents are looked at."""
    parents = buildings.select(F.col("id").alias("parent_building_id"), F.col("rings").alias("_parent"))
    parts = buildings.filter(F.col("parent_building_id").isNotNull()).select(
        "id", "parent_building_id", "rings")
    if wanted is not None:
        few = wanted.select(F.col("id").alias("parent_building_id")).distinct()
        parents, parts = (rows.join(few, "parent_building_id", "left_semi") for rows in (parents, parts))
    return parts.join(parents, "parent_building_id").select(
        "id", "parent_building_id", g.polygons_intersect(
            g.edges(F.col("rings")), g.edges(F.col("_parent"))).alias("intersects_parent"))


def related_parts(chosen: DataFrame, buildings: DataFrame) -> DataFrame:
    """All parts of the chosen outlines, in or out of the box, with the parent test. A part is
    tested once, however many requests chose its parent."""
    parents = chosen.select("request_id", F.col("id").alias("parent_building_id"))
    return part_links(buildings, chosen).join(parents, "parent_building_id").select(
        "request_id", "id", "intersects_parent")


def run(requests: DataFrame, buildings: DataFrame, master: DataFrame | None,
        mode: str = "intersects") -> DataFrame:
    """Outlines, their parts and orphan parts of every request.

    One row per (request, building), in the order of request and ``osm_id``: attributes,
    ``intersects_parent`` and the interior point.
    """
    ready = cut_lineage(prepared(buildings, master))  # boxes and keys only
    chosen = cut_lineage(outlines(requests, ready, buildings, mode))
    unknown = F.lit(None).cast("boolean").alias("intersects_parent")
    rows = (
        chosen.select("request_id", "id", unknown)
        .unionByName(related_parts(chosen, buildings))
        .unionByName(orphan_parts(requests, ready, buildings, mode).select("request_id", "id", unknown)))
    rows = written(rows, "answers")
    answered = buildings.select(*ATTRIBUTES, "rings").join(rows.select("id").distinct(), "id", "left_semi")
    return rows.join(with_interior_point(answered), "id").select(
        "request_id", *ATTRIBUTES, "intersects_parent", "representative_point").orderBy("request_id", "osm_id", "id")


def run_stored(requests: DataFrame, path: str, master: DataFrame | None, mode: str = "intersects") -> DataFrame:
    """``run`` over a stored table, of which only the files near the requests are opened, ranked and written."""
    return run(requests, layout.near(requests, path), master, mode)


def with_interior_point(df: DataFrame) -> DataFrame:
    return (
        df.withColumn("_scan", g.scan_line(F.col("rings")))
        .withColumn("_edges", g.edges(F.col("rings")))
        .withColumn("representative_point",
                    g.point_on_surface(F.col("rings"), F.col("_edges"), F.col("_scan")))
        .drop("_scan", "_edges", "rings")
    )


def observability(requests, ready, shapes, mode="intersects") -> DataFrame:
    """Per request: outline candidates, whether the limit cut, rows removed as copies.

    The number returned is the number of distinct places up to the limit, and copies are told of requests only
    that the limit does not cut: so places are sought up to the limit, and all pairs are counted where they are made.
    """
    counts = outline_candidates(requests, ready, shapes, mode).groupBy("request_id").agg(
        F.count("*").alias("outline_candidates"))
    largest = F.max(F.coalesce("row_limit", F.lit(firsts.ALL))).over(Window.partitionBy("request_id"))
    places = first_places(requests.withColumn("row_limit", largest), ready, shapes, mode).groupBy("request_id").agg(
        F.count("*").alias("_places"))
    full = requests.select("request_id", "row_limit").join(counts, "request_id", "left").join(
        places, "request_id", "left").fillna(0, ["outline_candidates", "_places"])
    hit = F.col("outline_candidates") > F.col("row_limit")
    shown = F.least("_places", "row_limit")
    return full.select(
        "request_id", "outline_candidates", shown.alias("outlines"), hit.alias("limit_hit"),
        F.when(~hit, F.greatest(F.lit(0), F.col("outline_candidates") - shown)).alias("deduped"))
