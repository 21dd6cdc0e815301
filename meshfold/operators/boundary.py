"""Point-in-city-boundary by parity.

A boundary has up to 1e5 edges and a city up to a third of all buildings, so a
boundary is never attached to a building row, nor a building's shape to a boundary. Edges are
cut into horizontal bands, crowded bands into sub-bands; a point, which carries its key and two
numbers only, meets single edges of its own (city, band). Each meeting is one bit, whether the
edge is crossed, and the bits of a point are folded with XOR where the join has put them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshfold.functions import geometry as g

BAND = 50_000  # band height in 1e-7 degree (0.005 degree)
CROWD = 64     # edges beyond which a band is cut into sub-bands
_EDGE = ["e.x1", "e.y1", "e.x2", "e.y2"]


def _sub(y: Column, band: int) -> Column:
    """The sub-band of ``subs`` of a place in its band; one formula for points and edges, so never apart."""
    return F.floor((y.cast("double") - F.col("band") * band) * F.col("subs") / band)


def edge_bands(polygons: DataFrame, band: int = BAND, crowd: int = CROWD) -> tuple[DataFrame, DataFrame]:
    """(city_code, band, sub, x1, y1, x2, y2), one row for each edge and sub-band it touches, and
    (city_code, band, subs) of the bands that are cut; ``polygons(city_code, boundary)``."""
    rings = polygons.filter(F.col("boundary").isNotNull()).select("city_code", F.explode("boundary").alias("rings"))
    edges = rings.select("city_code", F.explode(g.edges(F.col("rings"))).alias("e")).select("city_code", *_EDGE)
    low, high = F.floor(F.least("y1", "y2") / band), F.floor(F.greatest("y1", "y2") / band)
    banded = edges.select("*", low.alias("first"), high.alias("last"), F.explode(F.sequence(low, high)).alias("band"))
    cut = banded.groupBy("city_code", "band").agg(F.ceil(F.count("*") / crowd).alias("subs")).filter("subs > 1")
    banded = banded.join(cut, ["city_code", "band"], "left").withColumn("subs", F.coalesce("subs", F.lit(1)))
    start = F.when(F.col("band") == F.col("first"), _sub(F.least("y1", "y2"), band)).otherwise(0)
    end = F.when(F.col("band") == F.col("last"), _sub(F.greatest("y1", "y2"), band)).otherwise(F.col("subs") - 1)
    return banded.select("city_code", "band", F.explode(F.sequence(start, end)).alias("sub"), "x1", "y1", "x2", "y2"), cut


def crossings(points: DataFrame, keys: list[str], x: str, y: str, polygons: DataFrame, band: int = BAND,
              crowd: int = CROWD, spread: int = 8) -> DataFrame:
    """``keys``, ``odd`` and ``on`` of every point: whether a ray from it crosses its city's edges an odd number of
    times, and whether it lies on one. ``keys`` tell points apart and hold city_code; ``spread`` splits a hot band.
    A point without edges in its band, or without a place, crosses none."""
    edges, cut = edge_bands(polygons, band, crowd)
    sliced = edges.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    own = points.select(*keys, F.col(x).alias("_x"), F.col(y).alias("_y"), F.floor(F.col(y) / band).alias("band"))
    placed = own.join(cut, ["city_code", "band"], "left").withColumn("subs", F.coalesce("subs", F.lit(1))).withColumn(
        "sub", _sub(F.col("_y"), band)).withColumn("_slice", F.pmod(F.xxhash64(*keys, "_x"), F.lit(spread)).cast("int"))
    place = ["city_code", "band", "sub", "_slice"]
    crossed, on = g.edge_crossing(F.col("_x"), F.col("_y"))
    met = placed.join(sliced, place, "left").select(
        *place, *[k for k in keys if k not in place], F.coalesce(crossed, F.lit(False)).cast("int").alias("bit"),
        F.coalesce(on, F.lit(False)).alias("on"))
    # A point's meetings are where the join has put them: no shuffle more.
    bits = met.groupBy(*place, *[k for k in keys if k not in place]).agg(
        (F.bit_xor("bit") == 1).alias("odd"), F.bool_or("on").alias("on"))
    return bits.select(*keys, "odd", "on")


def inside_flags(points: DataFrame, master: DataFrame | None, band: int = BAND, spread: int = 8) -> DataFrame:
    """(id, inside) of every point: strictly within the row's own city boundary. ``id`` tells points apart.

    NULL where the city is not in the master table, has no boundary, the master
    table is missing, or the point is NULL.
    """
    unknown = F.lit(None).cast("boolean")
    if master is None:
        return points.select("id", unknown.alias("inside"))
    known = master.groupBy("city_code").agg(F.bool_or(F.col("boundary").isNotNull()).alias("_known"))
    keys = ["id", "city_code", "cen_lon"]
    flags = crossings(points, keys, "cen_lon", "cen_lat", master, band, spread=spread)
    return flags.join(known, "city_code", "left").select("id", F.when(
        F.col("_known") & F.col("cen_lon").isNotNull(), F.col("odd") & ~F.col("on")).alias("inside"))


def with_inside(points: DataFrame, master: DataFrame | None, band: int = BAND, spread: int = 8) -> DataFrame:
    """``points`` and ``inside``; only keys and flags take part until the rows are looked up by id."""
    if master is None:
        return points.withColumn("inside", F.lit(None).cast("boolean"))
    return points.join(inside_flags(points, master, band, spread), "id").select(*[points[c] for c in points.columns], "inside")


def keep_own_city(points: DataFrame) -> DataFrame:
    """Rows that are not known to be outside of their own city."""
    return points.filter(F.coalesce(F.col("inside"), F.lit(True)))


def drop_outside(points: DataFrame, master: DataFrame | None, band: int = BAND) -> DataFrame:
    """``points`` without those known to be outside of their own city: only the ids that go are joined."""
    if master is None:
        return points
    return points.join(inside_flags(points, master, band).filter("not inside").select("id"), "id", "left_anti")
