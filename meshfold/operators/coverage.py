"""Per-city coverage: count and hull of the outlines' centroids.

Hulls are combined like an aggregate: every task reduces its rows to hull corners
per city, a salted second step does it again, and only corners meet in the final
group. No city's points are ever gathered in one task.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshfold import fixed_values as fv
from meshfold.functions import geometry as g
from meshfold.operators import boundary, maintenance

CORNERS = "city_code string, lon_i bigint, lat_i bigint"


def city_counts(buildings: DataFrame) -> DataFrame:
    return outlines(buildings).groupBy("city_code").agg(F.count("*").alias("building_count"))


def outlines(buildings: DataFrame) -> DataFrame:
    return buildings.filter(F.col("city_code").isNotNull() & F.col("building_part").isNull())


def outline_points(buildings: DataFrame) -> DataFrame:
    return outlines(buildings).filter(F.col("cen_lon").isNotNull()).select(
        "city_code", F.round("cen_lon").cast("bigint").alias("lon_i"),
        F.round("cen_lat").cast("bigint").alias("lat_i"))


def convex_corners(xy: np.ndarray) -> np.ndarray:
    """Strict corners of the convex hull, counter-clockwise from the lowest lon."""
    pts = np.unique(xy, axis=0)
    if len(pts) < 3:
        return pts
    # Only the lowest and highest point of every column can be a corner.
    first = np.r_[True, pts[1:, 0] != pts[:-1, 0]]
    last = np.r_[pts[1:, 0] != pts[:-1, 0], True]
    pts = pts[first | last].tolist()

    def chain(points):
        out = []
        for px, py in points:
            while len(out) >= 2 and ((out[-1][0] - out[-2][0]) * (py - out[-2][1])
                                     - (out[-1][1] - out[-2][1]) * (px - out[-2][0])) <= 0:
                out.pop()
            out.append((px, py))
        return out[:-1]

    return np.array(chain(pts) + chain(pts[::-1]), dtype="int64")


def _corners_per(keys: list[str], most: int = 1 << 20):
    """Reduces the rows of one task to hull corners per key, folding batch by batch. What is
    held is given out, and begun anew, above ``most`` corners; a later step meets them again."""
    def given(kept):
        sizes = [len(xy) for xy in kept.values()]
        both = np.vstack(list(kept.values()))
        columns = {k: np.repeat(np.array([key[i] for key in kept], dtype=object), sizes).tolist()
                   for i, k in enumerate(keys)}
        return columns, both

    def run(batches):
        kept: dict = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch]).sort_by([(k, "ascending") for k in keys])
            values = [np.array(table.column(k).to_pylist(), dtype=object) for k in keys]
            xy = np.column_stack([table.column("lon_i").to_numpy(), table.column("lat_i").to_numpy()])
            new = np.r_[True, np.any([v[1:] != v[:-1] for v in values], axis=0)]
            starts = np.flatnonzero(new)
            for key, part in zip(zip(*(v[starts] for v in values)), np.split(xy, starts[1:])):
                kept[key] = convex_corners(np.vstack([kept[key], part]) if key in kept else part)
            if sum(map(len, kept.values())) > most:
                yield record(*given(kept), batch.schema)
                kept = {}
        if kept:
            yield record(*given(kept), batch.schema)

    def record(columns, xy, schema):
        arrays = [pa.array(columns[k], schema.field(k).type) for k in keys]
        return pa.RecordBatch.from_arrays(
            [*arrays, pa.array(xy[:, 0], pa.int64()), pa.array(xy[:, 1], pa.int64())], [*keys, "lon_i", "lat_i"])

    return run


def _hull_row(pdf, ring) -> pd.DataFrame:
    return pd.DataFrame({"city_code": pd.Series([pdf["city_code"].iloc[0]], dtype=object),
                         "lons": [ring[:, 0].tolist()], "lats": [ring[:, 1].tolist()]})


def convex_hulls(points: DataFrame, slices: int = 64) -> DataFrame:
    """(city_code, hull ring) from (city_code, lon_i, lat_i)."""
    reduce_task = _corners_per(["city_code"])
    partial = points.mapInArrow(reduce_task, CORNERS)
    salted = partial.repartition("city_code", F.pmod(F.xxhash64("lon_i", "lat_i"), F.lit(slices)))
    fewer = salted.mapInArrow(reduce_task, CORNERS)

    def finish(pdf):
        return _hull_row(pdf, convex_corners(pdf[["lon_i", "lat_i"]].to_numpy("int64")))

    hulls = fewer.groupBy("city_code").applyInPandas(
        finish, "city_code string, lons array<bigint>, lats array<bigint>")
    return hulls.select("city_code", F.transform(
        F.arrays_zip("lons", "lats"), lambda z: g.point(z["lons"], z["lats"])).alias("hull"))


def _side(a, b, p) -> np.ndarray:
    return (b[..., 0] - a[..., 0]) * (p[..., 1] - a[..., 1]) - (b[..., 1] - a[..., 1]) * (p[..., 0] - a[..., 0])


def _crossed(p, q, starts: np.ndarray, ends: np.ndarray) -> bool:
    """Whether the segment pq meets any of the segments that do not share an end with it."""
    apart = ~((starts == p).all(1) | (starts == q).all(1) | (ends == p).all(1) | (ends == q).all(1))
    r, s = starts[apart], ends[apart]
    return bool(((_side(p, q, r) * _side(p, q, s) <= 0) & (_side(r, s, p) * _side(r, s, q) <= 0)).any())


def dig_hull(xy: np.ndarray, ratio: float, cells: np.ndarray | None = None, tries: int = 8) -> np.ndarray:
    """Concave ring: long edges of the convex hull are dug in, the longest first, to the point
    that sees them under the widest angle.

    An edge is long above ``ratio`` times the longest edge of the convex hull. Points
    on an edge become corners first. A dig is taken if its triangle holds no other
    point and crosses no other edge, so the ring stays simple and no point falls
    outside; an edge for which the first ``tries`` points fail stays as it is. With ``cells``, the number of each
    point's grid cell, the points stand for the convex hulls of their cells: a dig may not
    cut into any of these either, so whatever lies in them stays inside.
    """
    ring = [tuple(p) for p in convex_corners(xy).tolist()]
    if len(ring) < 3:
        return np.array(ring, dtype="int64").reshape(-1, 2)
    hulls = []
    if cells is not None:
        order = np.argsort(cells, kind="stable")
        hulls = map(convex_corners, np.split(xy[order], np.flatnonzero(np.diff(cells[order])) + 1))
        hulls = [h for h in hulls if len(h) > 1]
    wall0 = np.vstack([np.empty((0, 2)), *hulls])
    wall1 = np.vstack([np.empty((0, 2)), *(np.roll(h, -1, axis=0) for h in hulls)])
    walls = {frozenset((tuple(p), tuple(q))) for p, q in zip(wall0.tolist(), wall1.tolist())}
    pts = np.unique(xy, axis=0).astype("float64")
    place = {tuple(p): i for i, p in enumerate(pts.tolist())}
    free = np.ones(len(pts), bool)
    free[[place[p] for p in ring]] = False
    def length(p, q):
        return float(np.hypot(q[0] - p[0], q[1] - p[1]))

    queue = [(-length(p, q), (p, q)) for p, q in zip(ring, ring[1:] + ring[:1])]
    heapq.heapify(queue)
    limit = -ratio * queue[0][0]
    while queue and -queue[0][0] > limit:
        edge = heapq.heappop(queue)[1]
        a, b = np.array(edge, float)
        if frozenset(edge) in walls:
            continue
        turn, along = _side(a, b, pts), (pts - a) @ (b - a)
        between = free & (turn == 0) & (along > 0) & (along < (b - a) @ (b - a))
        found = np.flatnonzero(between if between.any() else free & (turn > 0))
        # The widest angle over the edge first: no other point lies in that triangle.
        narrow = ((a - pts[found]) * (b - pts[found])).sum(1) / np.where(turn[found] == 0, 1, turn[found])
        start = np.array(ring, float)
        end = np.roll(start, -1, axis=0)
        at = ring.index(edge[0])
        others = np.arange(len(ring)) != at
        for i in found[np.argsort(narrow, kind="stable")[:1 if between.any() else tries]]:
            c = pts[i]
            if not between.any():
                inside = (turn >= 0) & (_side(b, c, pts) >= 0) & (_side(c, a, pts) >= 0)
                if inside.sum() > 3 or any(_crossed(p, q, x, y) for p, q in ((a, c), (c, b))
                                           for x, y in ((start[others], end[others]), (wall0, wall1))):
                    continue
            corner = tuple(int(v) for v in c)
            ring.insert(at + 1, corner)
            free[i] = False
            for p, q in ((edge[0], corner), (corner, edge[1])):
                heapq.heappush(queue, (-length(p, q), (p, q)))
            break
    return np.array(ring, dtype="int64")


def concave_hulls(points: DataFrame, ratio: float = fv.CONCAVE_RATIO, cells: int = 32) -> DataFrame:
    """(city_code, hull): concave ring per city that covers every point; one or two corners
    where the points have no area.

    The points of each grid cell (a city's box has cells x cells) are reduced to the corners
    of their convex hull, in every task and then per cell; a city gathers corners only,
    and its ring never cuts into a cell's hull.
    """
    box = points.groupBy("city_code").agg(
        F.min("lon_i").alias("x0"), F.max("lon_i").alias("x1"),
        F.min("lat_i").alias("y0"), F.max("lat_i").alias("y1"))

    def cell(v, low, high):
        return F.floor((F.col(v) - F.col(low)) * cells / (F.col(high) - F.col(low) + 1))

    placed = points.join(box, "city_code").select(
        "city_code", (cell("lon_i", "x0", "x1") * cells + cell("lat_i", "y0", "y1")).cast("int").alias("cell"),
        "lon_i", "lat_i")
    schema = "city_code string, cell int, lon_i bigint, lat_i bigint"
    reduce_task = _corners_per(["city_code", "cell"])
    corners = placed.mapInArrow(reduce_task, schema).repartition("city_code", "cell").mapInArrow(reduce_task, schema)

    def finish(pdf):
        return _hull_row(pdf, dig_hull(pdf[["lon_i", "lat_i"]].to_numpy("int64"), ratio, pdf["cell"].to_numpy()))

    hulls = corners.groupBy("city_code").applyInPandas(
        finish, "city_code string, lons array<bigint>, lats array<bigint>")
    return hulls.select("city_code", F.transform(
        F.arrays_zip("lons", "lats"), lambda z: g.point(z["lons"], z["lats"])).alias("hull"))


def covered_counts(points: DataFrame, hulls: DataFrame) -> DataFrame:
    """(city_code, points, outside): how many points their city's hull does not cover."""
    polygons = hulls.select("city_code", F.array(F.array("hull")).alias("boundary"))
    places = points.groupBy("city_code", "lon_i", "lat_i").agg(F.count("*").alias("n"))
    keys = ["city_code", "lon_i", "lat_i", "n"]
    met = boundary.crossings(places, keys, "lon_i", "lat_i", polygons)
    return met.groupBy("city_code").agg(F.sum("n").alias("points"), F.coalesce(
        F.sum(F.when(~(F.col("odd") | F.col("on")), F.col("n"))), F.lit(0)).alias("outside"))


def coverage(buildings: DataFrame, ratio: float = fv.CONCAVE_RATIO) -> DataFrame:
    """(city_code, hull, building_count): the coverage table."""
    hulls = concave_hulls(outline_points(buildings), ratio)
    return city_counts(buildings).join(hulls, "city_code", "left").select(
        "city_code", "hull", "building_count")


def refresh(buildings: DataFrame, path: str, changed: DataFrame | None = None) -> None:
    """Write the coverage table, whole or only the changed cities; cities without buildings go."""
    rows = buildings if changed is None else buildings.join(
        changed.select("city_code").distinct(), "city_code", "left_semi")
    (coverage(rows).write.mode("overwrite")
     .option("partitionOverwriteMode", "static" if changed is None else "dynamic")
     .partitionBy("city_code").parquet(path))
    if changed is not None:
        maintenance.empty_cities(changed, rows, path)


def features(table: DataFrame) -> DataFrame:
    """One GeoJSON feature per city: a polygon, or a point or line where its points have no area."""
    place = lambda v: F.array(v["lon_i"] / 1e7, v["lat_i"] / 1e7)

    def feature(kind, coordinates):
        geometry = F.struct(F.lit(kind).alias("type"), coordinates.alias("coordinates"))
        return F.to_json(F.struct(
            F.lit("Feature").alias("type"), F.col("city_code").alias("id"),
            F.when(F.size("hull") >= 1, geometry).alias("geometry"),
            F.struct("city_code", "building_count").alias("properties"),
        ), {"ignoreNullFields": "false"})

    hull = F.col("hull")
    return table.select("city_code", F.when(F.size(hull) == 1, feature("Point", place(hull[0])))
                        .when(F.size(hull) == 2, feature("LineString", F.transform(hull, place)))
                        .otherwise(feature("Polygon", F.array(F.transform(g.close_ring(hull), place))))
                        .alias("feature"))


def feature_collection(table: DataFrame) -> DataFrame:
    """The FeatureCollection as ordered lines (line_no orders them).

    Lines, not one string: the document is never gathered in one row.
    """
    rows = features(table)
    first = rows.agg(F.min("city_code").alias("_first"))
    body = rows.join(first).select(
        F.lit(1).alias("section"), F.col("city_code").alias("line_key"),
        F.when(F.col("city_code") == F.col("_first"), F.col("feature"))
        .otherwise(F.concat(F.lit(","), F.col("feature"))).alias("line"))
    ends = table.sparkSession.createDataFrame(
        [(0, "", '{"type":"FeatureCollection","features":['), (2, "", "]}")],
        "section int, line_key string, line string")
    return body.unionByName(ends)
