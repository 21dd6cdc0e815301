"""Geometry as Column expressions over rings of integer coordinates.

A ring is ARRAY<STRUCT<lon_i BIGINT, lat_i BIGINT>> without the repeated closing
point; a polygon is ARRAY<ring> with ring 0 outside and the others holes. Units
are 1e-7 degree. Inside is even-odd, so holes need no special case. Everything
stays in the JVM.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from meshfold import fixed_values as fv

POINT = "struct<lon_i:bigint,lat_i:bigint>"
RING = f"array<{POINT}>"
POLYGON = f"array<{RING}>"


def point(lon_i: Column, lat_i: Column) -> Column:
    return F.struct(lon_i.cast("bigint").alias("lon_i"), lat_i.cast("bigint").alias("lat_i"))


def vertices(rings: Column) -> Column:
    return F.flatten(rings)


# ---- rings ---------------------------------------------------------------

def close_ring(ring: Column) -> Column:
    """Append the first element unless the ring is closed already."""
    return F.when((F.size(ring) > 0) & (F.element_at(ring, 1) != F.element_at(ring, -1)),
                  F.concat(ring, F.slice(ring, 1, 1))).otherwise(ring)


def open_ring(ring: Column) -> Column:
    """Drop a repeated closing element."""
    return F.when((F.size(ring) >= 2) & (F.element_at(ring, 1) == F.element_at(ring, -1)),
                  F.slice(ring, F.lit(1), F.size(ring) - 1)).otherwise(ring)


def _rotated_to_min(seq: Column) -> Column:
    at = F.array_position(seq, F.array_min(seq)).cast("int")
    return F.concat(F.slice(seq, at, F.size(seq)), F.slice(seq, F.lit(1), at - 1))


def ring_key(refs: Column) -> Column:
    """One form for a closed ring, whatever its start and direction; NULL below 3."""
    ring = open_ring(refs)
    return F.when(F.size(ring) >= 3,
                  F.least(_rotated_to_min(ring), _rotated_to_min(F.reverse(ring))))


def ring_edges(ring: Column) -> Column:
    """Segments of a ring, the closing one included."""
    return F.transform(ring, lambda v, i: F.struct(
        v["lon_i"].alias("x1"), v["lat_i"].alias("y1"),
        F.get(ring, (i + 1) % F.size(ring))["lon_i"].alias("x2"),
        F.get(ring, (i + 1) % F.size(ring))["lat_i"].alias("y2")))


def edges(rings: Column) -> Column:
    return F.flatten(F.transform(rings, ring_edges))


# ---- measures ------------------------------------------------------------

def _ring_moments(ring: Column, x0: Column, y0: Column) -> Column:
    """(twice the area, x moment, y moment) of one ring around (x0, y0), made positive. The
    moments are doubles: exact to about 0.01 degree, and beyond it they never overflow."""
    zero, none = F.lit(0).cast("bigint"), F.lit(0.0)
    start = F.struct(zero.alias("a"), none.alias("mx"), none.alias("my"))

    def add(acc, e):
        dx1, dy1, dx2, dy2 = e["x1"] - x0, e["y1"] - y0, e["x2"] - x0, e["y2"] - y0
        cross = dx1 * dy2 - dx2 * dy1
        return F.struct((acc["a"] + cross).alias("a"),
                        (acc["mx"] + cross.cast("double") * (dx1 + dx2)).alias("mx"),
                        (acc["my"] + cross.cast("double") * (dy1 + dy2)).alias("my"))

    def positive(acc):
        s = F.when(acc["a"] < 0, F.lit(-1)).otherwise(F.lit(1)).cast("bigint")
        return F.struct((acc["a"] * s).alias("a"), (acc["mx"] * s).alias("mx"),
                        (acc["my"] * s).alias("my"))

    return F.aggregate(ring_edges(ring), start, add, positive)


def moments(rings: Column) -> Column:
    """Moments of a polygon, holes taken off; relative to its first vertex."""
    first = rings[0][0]
    per_ring = F.transform(rings, lambda r: _ring_moments(r, first["lon_i"], first["lat_i"]))
    zero, none = F.lit(0).cast("bigint"), F.lit(0.0)
    start = F.struct(zero.alias("n"), zero.alias("a"), none.alias("mx"), none.alias("my"))

    def add(acc, m):
        s = F.when(acc["n"] == 0, F.lit(1)).otherwise(F.lit(-1)).cast("bigint")
        return F.struct((acc["n"] + 1).alias("n"), (acc["a"] + s * m["a"]).alias("a"),
                        (acc["mx"] + s * m["mx"]).alias("mx"),
                        (acc["my"] + s * m["my"]).alias("my"))

    return F.aggregate(per_ring, start, add)


def area2(rings: Column) -> Column:
    """Twice the area in (1e-7 degree)^2, holes taken off; safe for whole countries."""
    def ring_area2(ring):
        x0, y0 = ring[0]["lon_i"], ring[0]["lat_i"]
        return F.abs(F.aggregate(ring_edges(ring), F.lit(0).cast("bigint"), lambda acc, e: acc + (
            (e["x1"] - x0) * (e["y2"] - y0) - (e["x2"] - x0) * (e["y1"] - y0))))

    signed = F.transform(rings, lambda r, i: F.when(i == 0, ring_area2(r)).otherwise(-ring_area2(r)))
    return F.aggregate(signed, F.lit(0).cast("bigint"), lambda acc, a: acc + a)


def _line_centroid(rings: Column) -> Column:
    """Length-weighted centre of the outline, for shapes without area."""
    start = F.struct(*[F.lit(0.0).alias(c) for c in ("w", "x", "y")])

    def add(acc, e):
        length = F.hypot((e["x2"] - e["x1"]).cast("double"), (e["y2"] - e["y1"]).cast("double"))
        return F.struct((acc["w"] + length).alias("w"),
                        (acc["x"] + length * (e["x1"] + e["x2"]) / 2).alias("x"),
                        (acc["y"] + length * (e["y1"] + e["y2"]) / 2).alias("y"))

    def finish(acc):
        first = rings[0][0]
        return F.struct(
            F.when(acc["w"] > 0, acc["x"] / acc["w"])
            .otherwise(first["lon_i"].cast("double")).alias("lon"),
            F.when(acc["w"] > 0, acc["y"] / acc["w"])
            .otherwise(first["lat_i"].cast("double")).alias("lat"))

    return F.aggregate(edges(rings), start, add, finish)


def centroid(rings: Column, m: Column) -> Column:
    """STRUCT<lon, lat> (DOUBLE, 1e-7 degree) from ``m = moments(rings)``."""
    first = rings[0][0]
    by_area = F.struct(
        (first["lon_i"] + m["mx"] / (3 * m["a"]).cast("double")).alias("lon"),
        (first["lat_i"] + m["my"] / (3 * m["a"]).cast("double")).alias("lat"))
    return F.when(m["a"] != 0, by_area).otherwise(_line_centroid(rings))


def triangle_area_m2(ring: Column) -> Column:
    """Area of the first three vertices in square metres."""
    def x(i): return ring[i]["lon_i"].cast("double") / 1e7
    def y(i): return ring[i]["lat_i"].cast("double") / 1e7
    square_degrees = F.abs(
        (x(0) * (y(1) - y(2)) + x(1) * (y(2) - y(0)) + x(2) * (y(0) - y(1))) / 2)
    mean_lat = (y(0) + y(1) + y(2)) / 3 * F.lit(math.pi / 180)
    return square_degrees * fv.METRES_PER_DEGREE * (fv.METRES_PER_DEGREE * F.cos(mean_lat))


def area_m2(area2_col: Column, lat: Column) -> Column:
    """Square metres from ``area2``, at latitude ``lat`` (1e-7 degree)."""
    metres = fv.METRES_PER_DEGREE / 1e7
    return area2_col / 2.0 * (metres * metres) * F.cos(lat / 1e7 * F.lit(math.pi / 180))


def perimeter_m(rings: Column, lat: Column) -> Column:
    metres = fv.METRES_PER_DEGREE / 1e7
    shrink = F.cos(lat / 1e7 * F.lit(math.pi / 180))
    return F.aggregate(edges(rings), F.lit(0.0), lambda acc, e: acc + F.hypot(
        (e["x2"] - e["x1"]) * shrink, (e["y2"] - e["y1"]).cast("double")) * metres)


def distance_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Flat distance in metres between two points in 1e-7 degree."""
    metres = fv.METRES_PER_DEGREE / 1e7
    shrink = F.cos((lat1 + lat2) / 2e7 * F.lit(math.pi / 180))
    return F.hypot((lon2 - lon1) * shrink, lat2 - lat1) * metres


def bounds(rings: Column) -> Column:
    xs = F.transform(vertices(rings), lambda v: v["lon_i"])
    ys = F.transform(vertices(rings), lambda v: v["lat_i"])
    return F.struct(F.array_min(xs).alias("min_lon"), F.array_min(ys).alias("min_lat"),
                    F.array_max(xs).alias("max_lon"), F.array_max(ys).alias("max_lat"))


def footprint_key(ring: Column) -> Column:
    """Duplicate key: md5 over the sorted vertices, so order and holes do not count."""
    return F.md5(F.array_join(F.transform(F.sort_array(ring), lambda v: F.concat_ws(
        ",", v["lon_i"].cast("string"), v["lat_i"].cast("string"))), "|"))


# ---- predicates ----------------------------------------------------------

def _orient(ax, ay, bx, by, px, py) -> Column:
    return (bx - ax) * (py - ay) - (by - ay) * (px - ax)


def edge_crossing(x: Column, y: Column) -> tuple[Column, Column]:
    """(crossed, on) of a rightward ray from (x, y) and the edge in the columns x1, y1, x2, y2."""
    x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))
    o = _orient(x1, y1, x2, y2, x, y)
    up = (y1 <= y) & (y2 > y) & (o > 0)
    down = (y2 <= y) & (y1 > y) & (o < 0)
    on = (o == 0) & x.between(F.least(x1, x2), F.greatest(x1, x2)) & y.between(F.least(y1, y2), F.greatest(y1, y2))
    return up | down, on


def _crossings(edge_list: Column, x: Column, y: Column) -> Column:
    """(parity, on) of a rightward ray from (x, y) over the edges."""
    start = F.struct(F.lit(False).alias("odd"), F.lit(False).alias("on"))

    def add(acc, e):
        o = _orient(e["x1"], e["y1"], e["x2"], e["y2"], x, y)
        up = (e["y1"] <= y) & (e["y2"] > y) & (o > 0)
        down = (e["y2"] <= y) & (e["y1"] > y) & (o < 0)
        on = ((o == 0) & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
              & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])))
        return F.struct((acc["odd"] != (up | down)).alias("odd"), (acc["on"] | on).alias("on"))

    return F.aggregate(edge_list, start, add)


def contains_point(edge_list: Column, x: Column, y: Column) -> Column:
    """Strictly inside: the boundary does not count."""
    c = _crossings(edge_list, x, y)
    return c["odd"] & ~c["on"]


def covers_point(edge_list: Column, x: Column, y: Column) -> Column:
    """Inside or on the boundary."""
    c = _crossings(edge_list, x, y)
    return c["odd"] | c["on"]


def box_contains_point(west, south, east, north, x: Column, y: Column) -> Column:
    return (x > west) & (x < east) & (y > south) & (y < north)


def _edge_meets_box(e: Column, west, south, east, north) -> Column:
    near = ((F.least(e["x1"], e["x2"]) <= east) & (F.greatest(e["x1"], e["x2"]) >= west)
            & (F.least(e["y1"], e["y2"]) <= north) & (F.greatest(e["y1"], e["y2"]) >= south))
    sides = [_orient(e["x1"], e["y1"], e["x2"], e["y2"], px, py)
             for px in (west, east) for py in (south, north)]
    return near & (F.least(*sides) <= 0) & (F.greatest(*sides) >= 0)


def box_intersects(edge_list: Column, west, south, east, north) -> Column:
    """Box and polygon share a point; touching counts."""
    return (F.exists(edge_list, lambda e: _edge_meets_box(e, west, south, east, north))
            | covers_point(edge_list, west, south))


def _segments_meet(a: Column, b: Column) -> Column:
    near = ((F.least(a["x1"], a["x2"]) <= F.greatest(b["x1"], b["x2"]))
            & (F.least(b["x1"], b["x2"]) <= F.greatest(a["x1"], a["x2"]))
            & (F.least(a["y1"], a["y2"]) <= F.greatest(b["y1"], b["y2"]))
            & (F.least(b["y1"], b["y2"]) <= F.greatest(a["y1"], a["y2"])))
    b1 = _orient(a["x1"], a["y1"], a["x2"], a["y2"], b["x1"], b["y1"])
    b2 = _orient(a["x1"], a["y1"], a["x2"], a["y2"], b["x2"], b["y2"])
    a1 = _orient(b["x1"], b["y1"], b["x2"], b["y2"], a["x1"], a["y1"])
    a2 = _orient(b["x1"], b["y1"], b["x2"], b["y2"], a["x2"], a["y2"])
    return (near & (F.signum(b1.cast("double")) * F.signum(b2.cast("double")) <= 0)
            & (F.signum(a1.cast("double")) * F.signum(a2.cast("double")) <= 0))


def polygons_intersect(edges_a: Column, edges_b: Column) -> Column:
    """The two polygons share a point; NULL if either is NULL."""
    meet = F.exists(edges_a, lambda a: F.exists(edges_b, lambda b: _segments_meet(a, b)))
    a_in_b = covers_point(edges_b, edges_a[0]["x1"], edges_a[0]["y1"])
    b_in_a = covers_point(edges_a, edges_b[0]["x1"], edges_b[0]["y1"])
    return (F.when(edges_a.isNull() | edges_b.isNull(), F.lit(None).cast("boolean"))
            .otherwise(meet | a_in_b | b_in_a))


def polygon_covers(outer_edges: Column, inner_rings: Column, inner_edges: Column) -> Column:
    """Every vertex of the inner polygon is in the outer one, no edges properly cross,
    and no corner of the outer one (such as of its hole) is within the inner."""
    def cross(a, b):
        def side(s, t, end):
            return F.signum(_orient(s["x1"], s["y1"], s["x2"], s["y2"],
                                    t[f"x{end}"], t[f"y{end}"]).cast("double"))
        return (side(a, b, 1) * side(a, b, 2) < 0) & (side(b, a, 1) * side(b, a, 2) < 0)

    return (F.forall(vertices(inner_rings),
                     lambda v: covers_point(outer_edges, v["lon_i"], v["lat_i"]))
            & ~F.exists(outer_edges, lambda a: contains_point(inner_edges, a["x1"], a["y1"]))
            & ~F.exists(outer_edges, lambda a: F.exists(inner_edges, lambda b: cross(a, b))))


def scan_line(rings: Column) -> Column:
    """Ordinate half-way between the vertices next to the vertical middle."""
    ys = F.transform(vertices(rings), lambda v: v["lat_i"])
    middle = (F.array_min(ys) + F.array_max(ys)) / 2.0
    below = F.array_max(F.filter(ys, lambda y: y <= middle))
    above = F.array_min(F.filter(ys, lambda y: y > middle))
    return F.when(above.isNull(), below.cast("double")).otherwise((below + above) / 2.0)


def point_on_surface(rings: Column, edge_list: Column, y: Column) -> Column:
    """Middle of the widest inside stretch of ``y = scan_line(rings)``.

    A shape without an inside gives its first vertex.
    """
    hits = F.filter(edge_list, lambda e: (e["y1"] > y) != (e["y2"] > y))
    xs = F.array_sort(F.transform(hits, lambda e: e["x1"].cast("double")
                                  + (y - e["y1"]) * (e["x2"] - e["x1"]).cast("double")
                                  / (e["y2"] - e["y1"]).cast("double")))

    def stretch(x, i):
        return F.struct((F.get(xs, i + 1) - x).alias("width"), (-i).alias("order"),
                        ((x + F.get(xs, i + 1)) / 2).alias("mid"))

    stretches = F.filter(F.transform(xs, stretch), lambda s: (s["order"] % 2 == 0)
                         & (s["width"] > 0))
    widest = F.array_max(stretches)
    first = rings[0][0]
    return (F.when(F.coalesce(F.size(rings), F.lit(0)) < 1, F.lit(None))
            .when(widest.isNull(), F.struct(first["lon_i"].cast("double").alias("lon"),
                                            first["lat_i"].cast("double").alias("lat")))
            .otherwise(F.struct(widest["mid"].alias("lon"), y.alias("lat"))))


def is_valid(rings: Column, edge_list: Column, polygon_area2: Column) -> Column:
    """Rings of three or more corners, an area, no touching or crossing inside a ring,
    holes inside the outer ring and not crossing it."""
    outer = ring_edges(rings[0])

    def simple(ring):
        # Arrays of one element bind a value, so that it is computed once and not per pair.
        def apart(segs):
            n = F.size(segs)
            return ~F.exists(F.sequence(F.lit(0), n - 3), lambda i: F.exists(
                F.slice(segs, i + 1, F.lit(1)), lambda a: F.exists(
                    F.slice(segs, i + 3, n - 2 - F.greatest(i, F.lit(1))), lambda b: _segments_meet(a, b))))

        return F.forall(F.array(ring_edges(ring)), apart)

    holes = F.slice(rings, F.lit(2), F.greatest(F.size(rings) - 1, F.lit(0)))
    return (F.when(rings.isNull(), F.lit(None).cast("boolean"))
            .when(F.exists(rings, lambda r: F.size(r) < 3), F.lit(False))
            .otherwise((polygon_area2 > 0) & F.forall(rings, simple)
                       & F.forall(holes, lambda h: polygon_covers(
                           outer, F.array(h), ring_edges(h)))))


def hausdorff_m(rings_a: Column, rings_b: Column) -> Column:
    """Largest of the nearest vertex-to-edge distances, degrees times 111000."""
    def to_segment(v, e):
        dx, dy = (e["x2"] - e["x1"]).cast("double"), (e["y2"] - e["y1"]).cast("double")
        length2 = dx * dx + dy * dy
        t = F.when(length2 > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), (
            (v["lon_i"] - e["x1"]) * dx + (v["lat_i"] - e["y1"]) * dy) / length2))).otherwise(0.0)
        return F.hypot(v["lon_i"] - e["x1"] - t * dx, v["lat_i"] - e["y1"] - t * dy)

    def one_way(a, b):
        segs = edges(b)
        return F.array_max(F.transform(vertices(a), lambda v: F.array_min(
            F.transform(segs, lambda e: to_segment(v, e)))))

    return F.greatest(one_way(rings_a, rings_b), one_way(rings_b, rings_a)) / 1e7 * 111000


# ---- text forms ----------------------------------------------------------

def to_wkt(rings: Column) -> Column:
    """POLYGON text with closed rings and seven decimals."""
    from meshfold.functions.numbers import degrees_text

    def ring_text(ring):
        return F.concat(F.lit("("), F.array_join(F.transform(
            close_ring(ring), lambda v: F.concat_ws(
                " ", degrees_text(v["lon_i"]), degrees_text(v["lat_i"]))), ","), F.lit(")"))

    return F.concat(F.lit("POLYGON("), F.array_join(F.transform(rings, ring_text), ","), F.lit(")"))


def from_wkt(text: Column) -> Column:
    """POLYGON text to rings; NULL for anything else."""
    from meshfold.functions.numbers import quantise

    def to_point(pair):
        xy = F.split(F.trim(pair), r"\s+")
        return point(quantise(xy[0].cast("double")), quantise(xy[1].cast("double")))

    bodies = F.regexp_extract_all(text, F.lit(r"\(([^()]+)\)"), 1)
    rings = F.transform(bodies, lambda body: open_ring(F.transform(F.split(body, ","), to_point)))
    return F.when(text.rlike(r"^\s*POLYGON\s*\("), rings)


def to_geojson(rings: Column) -> Column:
    coords = F.transform(rings, lambda ring: F.transform(
        close_ring(ring), lambda v: F.array(v["lon_i"] / 1e7, v["lat_i"] / 1e7)))
    return F.to_json(F.struct(F.lit("Polygon").alias("type"), coords.alias("coordinates")))
