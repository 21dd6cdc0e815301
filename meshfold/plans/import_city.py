"""Import: element tables to clean buildings, nodes, rejects and counts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshfold import fixed_values as fv
from meshfold.functions import geometry as g
from meshfold.functions import ids, numbers
from meshfold.functions.text import city_from_directory
from meshfold.operators import assemble, boundary, layout, maintenance, normalise
from meshfold.plans import id_ranges
from meshfold.session import cut_lineage

REPORT_TAGS = ("building", "height", "name", "addr:full")


@dataclass
class Imported:
    buildings: DataFrame   # accepted, with id, attributes, rings, centroid, bounds
    nodes: DataFrame       # one row per (building, node)
    rejects: DataFrame     # one row per rejected building, with its reason
    counts: DataFrame      # processed / duplicate / skipped by city
    ranges: DataFrame | None = None  # the span of ids given to each city


def with_city(df: DataFrame) -> DataFrame:
    """City from the first folder of the file key, file name from its last part."""
    return df.withColumn("city", city_from_directory(F.substring_index("file_key", "/", 1))) \
        .withColumn("file_name", F.substring_index("file_key", "/", -1))


def first_footprints(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The first building of every footprint within a city, and how many copies it had.

    Comes before the area test: a rejected triangle still claims its footprint. An
    aggregate, so a footprint repeated millions of times folds inside each task. ``keep`` names
    the columns that go on, by default all: only these are shuffled and sorted.
    """
    outer = F.col("rings")[0]["points"]
    keyed = df.withColumn("footprint", g.footprint_key(g.open_ring(outer)))
    rest = [c for c in keep or df.columns if c not in ("city",)]
    order = F.struct("file_key", "is_multipolygon", "pos")
    # The footprint first: sorts compare the first bytes of a key.
    return keyed.groupBy("footprint", "city").agg(
        F.min_by(F.struct(*rest), order).alias("_first"),
        (F.count("*") - 1).alias("copies")).select("city", "_first.*", "copies")


def judge(df: DataFrame) -> DataFrame:
    """Add n_coords (closed), area_m2 of triangles and reject_reason (NULL = accepted)."""
    outer = F.col("rings")[0]["points"]
    closed = df.withColumn("n_coords", F.size(g.close_ring(outer)))
    area = F.when(F.col("n_coords") == 4, g.triangle_area_m2(g.open_ring(outer)))
    reason = (
        F.when(F.size(outer) < 3, "too_few_coords")
        .when(F.col("n_coords") < 4, "too_few_points")
        .when(F.col("area_m2") < fv.TINY_AREA_M2, "tiny_area")
        .when(normalise.unreadable(F.col("tags")), "error"))
    return closed.withColumn("area_m2", area).withColumn("reject_reason", reason)


def reject_report(judged: DataFrame) -> DataFrame:
    """Reason, element, file, size, the first five coordinates and some tags."""
    closed = g.close_ring(F.col("rings")[0]["points"])
    return judged.filter("reject_reason is not null").select(
        "city", F.col("reject_reason").alias("reason"), "way_id", "file_name",
        F.col("n_coords"), "area_m2",
        F.transform(F.slice(closed, 1, 5), lambda v: F.struct(
            (v["lon_i"] / 1e7).alias("lon"), (v["lat_i"] / 1e7).alias("lat"))).alias("coords"),
        F.map_filter("tags", lambda k, v: k.isin(*REPORT_TAGS)).alias("tags"))


def node_rows(buildings: DataFrame) -> DataFrame:
    """Stored nodes: a node is kept once per building, at its first place.

    Works on the building's own array (sorted by node, then place), so the closing
    point and corners shared by two rings go without a shuffle.
    """
    listed = F.flatten(F.transform("numbered_rings", lambda r: F.transform(
        r["points"], lambda v, i: F.struct(
            ids.node_id(v["lat_i"], v["lon_i"], F.lit(0)).alias("osm_id"),
            r["ring_no"].alias("ring_id"), i.alias("sequence_id"),
            v["lat_i"].alias("lat_i"), v["lon_i"].alias("lon_i")))))
    sorted_nodes = buildings.select("id", "city_code", F.array_sort(listed).alias("_n"))
    kept = F.filter("_n", lambda n, i: (i == 0) | (F.get("_n", i - 1)["osm_id"] != n["osm_id"]))
    return sorted_nodes.select(F.col("id").alias("building_id"), "city_code",
                               F.explode(kept).alias("n")).select(
        "building_id", "city_code", "n.osm_id", "n.ring_id", "n.sequence_id", "n.lat_i", "n.lon_i",
        numbers.to_degrees(F.col("n.lat_i")).alias("lat"), numbers.to_degrees(F.col("n.lon_i")).alias("lon"))


def shaped(df: DataFrame) -> DataFrame:
    """Plain rings (open, holes kept), centroid, area and bounds."""
    plain = df.withColumn("rings", F.transform("numbered_rings", lambda r: g.open_ring(r["points"])))
    m = plain.withColumn("_m", g.moments(F.col("rings")))
    c = m.withColumn("_c", g.centroid(F.col("rings"), F.col("_m")))
    b = c.withColumn("_b", g.bounds(F.col("rings")))
    return b.select("*", F.col("_m.a").alias("area2"), F.col("_c.lon").alias("cen_lon"),
                    F.col("_c.lat").alias("cen_lat"), "_b.min_lon", "_b.min_lat", "_b.max_lon",
                    "_b.max_lat").drop("_m", "_c", "_b")


def run(tables: dict[str, DataFrame], master: DataFrame | None = None, first_id: int = 1,
        bounds=assemble.BOUNDS) -> Imported:
    """``tables`` as given by the mesh scan. Buildings outside of their own city's
    boundary are left out, together with their nodes. Ids count from ``first_id``; storing
    moves them to the range that each city has in the stored tables."""
    raw = with_city(assemble.footprints(tables, bounds)).withColumn(
        "rings", assemble.drop_bad_holes(F.col("rings")))
    # Read three times below (accepted, rejected, counts): frozen once.
    judged = cut_lineage(judge(first_footprints(raw)))
    # Numbered first: the range shuffle reads its input twice.
    accepted = ids.dense_ids(judged.filter("reject_reason is null").withColumnRenamed("rings", "numbered_rings"),
                             ["city", "file_key", "is_multipolygon", "pos"], first_id)
    numbered = normalise.normalise(accepted)
    buildings = shaped(numbered).withColumn("osm_id", F.col("id"))
    buildings = boundary.drop_outside(buildings, master).drop(
        "tags", "reject_reason", "area_m2", "n_coords")
    counts = judged.groupBy("city").agg(
        F.count_if(F.col("reject_reason").isNull()).alias("processed"),
        F.sum("copies").alias("duplicates"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("skipped"),
        F.max(F.size("rings") - 1).alias("max_inner_rings"))
    return Imported(buildings, node_rows(buildings), reject_report(judged), counts,
                    cut_lineage(id_ranges.used(numbered)))


def store(result: Imported, buildings_path: str, nodes_path: str, cities: DataFrame | None = None,
          ids_path: str | None = None) -> None:
    """Replace the imported cities in the stored tables: by default those that were judged. A
    city without accepted rows ends empty. Ids come from the ranges kept in ``ids_path``, by
    default beside the buildings, so they never meet those of other cities, and a repeated
    import gives the same ids."""
    spark = result.buildings.sparkSession
    ids_path = ids_path or buildings_path.rstrip("/") + "_ids"
    given = result.ranges if result.ranges is not None else cut_lineage(id_ranges.used(result.buildings))
    taken = id_ranges.take(spark, ids_path, given, buildings_path)
    buildings = id_ranges.moved(result.buildings, taken, given, "id", "osm_id")
    nodes = id_ranges.moved(result.nodes, taken, given, "building_id")
    if cities is None:
        cities = result.counts.select(F.col("city").alias("city_code"))
    layout.replace_cities(buildings.drop("numbered_rings", "copies"), buildings_path, cities)
    maintenance.replace_cities(nodes, nodes_path, ["building_id"], cities)
