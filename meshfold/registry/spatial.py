"""Geometry functions, spatial joins and the bounding-box query."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from meshfold.functions import geometry as g
from meshfold.functions import numbers
from meshfold.operators import bbox, boundary, layout
from meshfold.plans import bbox_query
from meshfold.registry import fixture_sql as fs
from meshfold.registry import fixture_tables as ft
from meshfold.registry.core import query

GEO = [fs.POS, fs.GEOM]


def whole(c):
    return F.round(c).cast("bigint")


# ---- geometry ------------------------------------------------------------

@query("geo_01_triangle_area", fs.with_ctes(fs.POS, body="""
SELECT k, round(abs((x1*(y2-y3) + x2*(y3-y1) + x3*(y1-y2)) / 2) * 111320.0
  * (111320.0 * cos((y1+y2+y3)/3 * (pi()/180))), 6) AS area_m2
FROM (SELECT k, (x-h)/1e7 AS x1, (y-h)/1e7 AS y1, (x+h)/1e7 AS x2, (y-h)/1e7 AS y2,
             x/1e7 AS x3, (y+h)/1e7 AS y3 FROM pos WHERE shape = 0
      UNION ALL SELECT k, (x-h)/1e7, y/1e7, x/1e7, y/1e7, (x+h)/1e7, y/1e7 FROM pos WHERE shape = 3)"""))
def _(spark, sf):
    rows = ft.positions(spark, sf).filter(F.size(F.col("full_rings")[0]) == 3)
    return rows.select("k", F.round(g.triangle_area_m2(F.col("full_rings")[0]), 6).alias("area_m2"))


@query("geo_02_ring_key", "WITH " + fs.POS + """
, one AS (SELECT k, list('-' || ((j+1)*100 + seq) ORDER BY seq) AS l FROM vert JOIN pos USING (k)
     WHERE ring = 0 GROUP BY k),
two AS (SELECT k, l, list_position(l, list_min(l)) AS i, list_reverse(l) AS rl FROM one),
three AS (SELECT k, list_concat(l[i:], l[1:i-1]) AS a,
   list_concat(rl[list_position(rl, list_min(rl)):], rl[1:list_position(rl, list_min(rl))-1]) AS b FROM two)
SELECT k, array_to_string(least(a, b), ' ') AS ring_key, true AS reversed_is_same FROM three""")
def _(spark, sf):
    rows = ft.positions(spark, sf).withColumn("refs", ft._node_refs(0, F.col("full_rings")[0]))
    closed = F.concat("refs", F.slice("refs", 1, 1))
    turned = F.concat(F.slice(F.reverse("refs"), F.lit(2), F.size("refs")), F.slice(F.reverse("refs"), 1, 2))
    return rows.select("k", F.array_join(g.ring_key(closed), " ").alias("ring_key"),
                       (g.ring_key(closed) == g.ring_key(turned)).alias("reversed_is_same"))


@query("geo_03_ring_closure", fs.with_ctes(fs.POS, body="""
SELECT k, ring, count(*) + 1 AS closed_points, true AS is_closed, true AS closing_twice_is_same
FROM vert GROUP BY ALL""").replace("SELECT k, ring,", "SELECT k, CAST(ring AS INTEGER) AS ring,"))
def _(spark, sf):
    rows = ft.positions(spark, sf).select("k", F.posexplode("full_rings").alias("ring", "r"))
    closed = rows.withColumn("c", g.close_ring(F.col("r")))
    return closed.select(
        "k", "ring", F.size("c").cast("bigint").alias("closed_points"),
        (F.element_at("c", 1) == F.element_at("c", -1)).alias("is_closed"),
        (g.close_ring(F.col("c")) == F.col("c")).alias("closing_twice_is_same"))


@query("geo_04_footprint_hash", fs.with_ctes(fs.POS, body="""
SELECT k, md5(string_agg(vx || ',' || vy, '|' ORDER BY vx, vy)) AS footprint
FROM vert WHERE ring = 0 GROUP BY k"""))
def _(spark, sf):
    return ft.positions(spark, sf).select("k", g.footprint_key(F.col("full_rings")[0]).alias("footprint"))


WKT_SQL = """
, ringtext AS (SELECT k, ring, '(' || string_agg(printf('%d.%07d %d.%07d', vx // 10000000, vx % 10000000,
     vy // 10000000, vy % 10000000), ',' ORDER BY seq) || ')' AS t FROM (
   SELECT * FROM vert UNION ALL SELECT k, ring, 99, vx, vy FROM vert WHERE seq = 0) GROUP BY ALL)"""


@query("geo_05_polygon_wkt", "WITH " + fs.POS + WKT_SQL + """
SELECT k, 'POLYGON(' || string_agg(t, ',' ORDER BY ring) || ')' AS wkt FROM ringtext GROUP BY k""")
def _(spark, sf):
    return ft.positions(spark, sf).select("k", g.to_wkt(F.col("full_rings")).alias("wkt"))


@query("geo_06_wkt_reader", fs.with_ctes(fs.POS, body="""
SELECT k, count(DISTINCT ring) AS rings, count(*) AS points, CAST(sum(vx) AS BIGINT) AS sum_x,
  CAST(sum(vy) AS BIGINT) AS sum_y, true AS same FROM vert GROUP BY k"""))
def _(spark, sf):
    text = ft.positions(spark, sf).select("k", "full_rings", g.to_wkt(F.col("full_rings")).alias("wkt"))
    read = text.withColumn("r", g.from_wkt(F.col("wkt")))
    zero = F.lit(0).cast("bigint")
    return read.select(
        "k", F.size("r").cast("bigint").alias("rings"),
        F.size(g.vertices(F.col("r"))).cast("bigint").alias("points"),
        F.aggregate(g.vertices(F.col("r")), zero, lambda a, v: a + v["lon_i"]).alias("sum_x"),
        F.aggregate(g.vertices(F.col("r")), zero, lambda a, v: a + v["lat_i"]).alias("sum_y"),
        (F.col("r") == F.col("full_rings")).alias("same"))


@query("geo_07_centroid", fs.on_shapes("""
SELECT id, area2, round(cen_lon, 4) AS cen_lon, round(cen_lat, 4) AS cen_lat FROM s"""))
def _(spark, sf):
    return ft.stored_buildings(spark, sf).select(
        "id", "area2", F.round("cen_lon", 4).alias("cen_lon"), F.round("cen_lat", 4).alias("cen_lat"))


@query("geo_08_node_points", fs.on_nodes("SELECT id, lon_i, lat_i FROM n"))
def _(spark, sf):
    nodes = ft.stored_nodes(spark, sf)
    pt = nodes.select("id", g.point(numbers.quantise(F.col("lon")), numbers.quantise(F.col("lat"))).alias("p"))
    return pt.select("id", "p.lon_i", "p.lat_i")


@query("geo_18_bounds", fs.on_shapes("SELECT id, min_lon, min_lat, max_lon, max_lat FROM s"))
def _(spark, sf):
    return ft.stored_buildings(spark, sf).select("id", "min_lon", "min_lat", "max_lon", "max_lat")


@query("geo_15_validity", fs.on_shapes("""
SELECT id, CASE WHEN area2 IS NULL THEN NULL ELSE shape <> 3 END AS valid,
  CASE WHEN area2 IS NULL THEN NULL ELSE false END AS bow_valid FROM s"""))
def _(spark, sf):
    rows = ft.stored_buildings(spark, sf)
    # A bow-tie of the same bounds is never valid.
    bow = F.when(F.col("rings").isNotNull(), F.array(F.array(
        g.point(F.col("min_lon"), F.col("min_lat")), g.point(F.col("max_lon") + 1, F.col("max_lat") + 1),
        g.point(F.col("max_lon") + 1, F.col("min_lat")), g.point(F.col("min_lon"), F.col("max_lat") + 1))))
    with_bow = rows.withColumn("bow", bow)
    return with_bow.select(
        "id", g.is_valid(F.col("rings"), g.edges(F.col("rings")), F.col("area2")).alias("valid"),
        g.is_valid(F.col("bow"), g.edges(F.col("bow")), F.lit(1).cast("bigint")).alias("bow_valid"))


@query("geo_13_even_odd_rule", fs.on_shapes("""
SELECT id, true AS lobe_inside, false AS gap_inside FROM s WHERE area2 IS NOT NULL"""))
def _(spark, sf):
    # A self-crossing bow-tie is read by the even-odd rule: its lobes are inside, the
    # gap above the crossing is not.
    rows = ft.stored_buildings(spark, sf).filter("rings is not null")
    west, south, east, north = F.col("min_lon"), F.col("min_lat"), F.col("max_lon") + 1, F.col("max_lat") + 1
    bow = F.array(F.array(g.point(west, south), g.point(east, north), g.point(east, south), g.point(west, north)))
    e = rows.withColumn("e", g.edges(bow))
    return e.select(
        "id", g.contains_point(F.col("e"), west + (east - west) / 8, (south + north) / 2).alias("lobe_inside"),
        g.contains_point(F.col("e"), (west + east) / 2, north - (north - south) / 8).alias("gap_inside"))


@query("flt_13_outlines_and_orphans", fs.on_buildings("""
SELECT city_code, count(*) FILTER (WHERE building_part IS NULL) AS outlines, count(*) FILTER (WHERE building_part = 'yes'
 AND parent_building_id IS NULL) AS orphans FROM b GROUP BY 1"""))
def _(spark, sf):
    part, parent = F.col("building_part"), F.col("parent_building_id")
    return ft.stored_buildings(spark, sf).groupBy("city_code").agg(
        F.count_if(part.isNull()).alias("outlines"),
        F.count_if((part == "yes") & parent.isNull()).alias("orphans"))


SCAN = fs.POS + "," + fs.GEOM + """,
mids AS (SELECT k, (min_lat + max_lat) / 2.0 AS mid FROM box),
scan AS (SELECT v.k, max(CASE WHEN vy <= mid THEN vy END) AS below, min(CASE WHEN vy > mid THEN vy END) AS above
   FROM vert v JOIN mids USING (k) GROUP BY v.k),
line AS (SELECT k, CASE WHEN above IS NULL THEN below::DOUBLE ELSE (below + above) / 2.0 END AS sy FROM scan),
hit AS (SELECT k, sy, x1 + (sy - y1) * (x2 - x1)::DOUBLE / (y2 - y1)::DOUBLE AS hx FROM edge JOIN line USING (k)
   WHERE (y1 > sy) <> (y2 > sy)),
ordered AS (SELECT k, sy, hx, row_number() OVER w AS rn, lead(hx) OVER w AS nx FROM hit
   WINDOW w AS (PARTITION BY k ORDER BY hx)),
wide AS (SELECT k, arg_max((hx + nx) / 2, (nx - hx) * 1000 - rn) AS mx, any_value(sy) AS sy FROM ordered
   WHERE rn % 2 = 1 AND nx > hx GROUP BY k),
rep AS (SELECT b.k, CASE WHEN box.k IS NULL THEN NULL ELSE coalesce(mx, x0) END AS rlon,
   CASE WHEN box.k IS NULL THEN NULL ELSE coalesce(wide.sy, y0) END AS rlat FROM pos b
   LEFT JOIN box USING (k) LEFT JOIN wide USING (k) LEFT JOIN org USING (k))"""


@query("geo_12_point_on_surface", "WITH " + SCAN + """
SELECT k + 1 AS id, CAST(round(rlon) AS BIGINT) AS lon, CAST(round(rlat) AS BIGINT) AS lat,
  CASE WHEN rlon IS NULL THEN NULL ELSE shape <> 3 END AS inside FROM rep JOIN pos USING (k)""")
def _(spark, sf):
    rows = ft.stored_buildings(spark, sf).withColumn("y", g.scan_line(F.col("rings")))
    rows = rows.withColumn("e", g.edges(F.col("rings"))).withColumn(
        "p", g.point_on_surface(F.col("rings"), F.col("e"), F.col("y")))
    return rows.select("id", whole(F.col("p.lon")).alias("lon"), whole(F.col("p.lat")).alias("lat"),
                       g.contains_point(F.col("e"), F.col("p.lon"), F.col("p.lat")).alias("inside"))


@query("geo_17_geojson", "WITH " + fs.POS + """, closed AS (
  SELECT k, ring, seq, vx, vy FROM vert UNION ALL SELECT k, ring, 99, vx, vy FROM vert WHERE seq = 0)
SELECT k, count(DISTINCT ring) AS rings, count(*) AS positions,
  CAST(sum(vx) AS BIGINT) AS sum_x, CAST(sum(vy) AS BIGINT) AS sum_y, 'Polygon' AS kind FROM closed GROUP BY k""")
def _(spark, sf):
    text = ft.positions(spark, sf).select("k", g.to_geojson(F.col("full_rings")).alias("t"))
    back = text.select("k", F.from_json("t", "type string, coordinates array<array<array<double>>>").alias("j"))
    zero = F.lit(0).cast("bigint")
    flat = back.select("k", "j.type", F.size("j.coordinates").cast("bigint").alias("rings"),
                       F.flatten("j.coordinates").alias("c"))
    return flat.select(
        "k", "rings", F.size("c").cast("bigint").alias("positions"),
        F.aggregate("c", zero, lambda a, v: a + numbers.quantise(v[0])).alias("sum_x"),
        F.aggregate("c", zero, lambda a, v: a + numbers.quantise(v[1])).alias("sum_y"),
        F.col("type").alias("kind"))


# ---- box predicates ------------------------------------------------------

MEETS = """(f.min_lon <= r.east AND f.max_lon >= r.west AND f.min_lat <= r.north AND f.max_lat >= r.south
  AND CASE f.shape
    WHEN 0 THEN 2*r.east - r.south >= 2*(f.x-f.h) - (f.y-f.h) AND 2*(f.x+f.h) - 2*r.west >= r.south - (f.y-f.h)
    WHEN 4 THEN (f.y >= r.south) OR (f.x >= r.west) ELSE true END)"""
CENTRED = """(f.cen_lon > r.west AND f.cen_lon < r.east AND f.cen_lat > r.south AND f.cen_lat < r.north)"""


def on_requests(body: str, extra: str = "") -> str:
    return fs.with_ctes(fs.POS, fs.GEOM, fs.BLD, fs.SHAPED, fs.MASTER, fs.FLAGGED, fs.REQ, body="") .rstrip() \
        + extra + "\n" + body


def _pairs(spark, sf, mode):
    return bbox.candidates(ft.requests(spark, sf), ft.stored_buildings(spark, sf), mode).select(
        "request_id", "id")


@query("geo_09_box_meets_polygon", on_requests(f"""
SELECT r.request_id, f.id FROM r JOIN f ON {MEETS}"""))
def _(spark, sf):
    return _pairs(spark, sf, "intersects")


@query("geo_10_box_contains_centroid", on_requests(f"""
SELECT r.request_id, f.id FROM r JOIN f ON {CENTRED}"""))
def _(spark, sf):
    return _pairs(spark, sf, "centroid")


@query("join_10_request_range_join", on_requests(f"""
SELECT r.request_id, count(*) AS buildings, min(f.id) AS first_id, max(f.id) AS last_id FROM r JOIN f
ON f.min_lon <= r.east AND f.max_lon >= r.west AND f.min_lat <= r.north AND f.max_lat >= r.south GROUP BY ALL"""))
def _(spark, sf):
    pairs = bbox.box_pairs(ft.requests(spark, sf), ft.stored_buildings(spark, sf))
    return pairs.groupBy("request_id").agg(
        F.count("*").alias("buildings"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))


@query("flt_12_bbox_modes", on_requests(f"""
SELECT r.request_id, count(*) FILTER (WHERE {MEETS}) AS meeting, count(*) FILTER (WHERE {CENTRED}) AS centred
FROM r JOIN f ON f.min_lon <= r.east AND f.max_lon >= r.west AND f.min_lat <= r.north AND f.max_lat >= r.south
GROUP BY ALL HAVING count(*) FILTER (WHERE {MEETS}) > 0"""))
def _(spark, sf):
    req, stored = ft.requests(spark, sf), ft.stored_buildings(spark, sf)
    by_shape = bbox.candidates(req, stored, "intersects").groupBy("request_id").agg(
        F.count("*").alias("meeting"))
    by_point = bbox.candidates(req, stored, "centroid").groupBy("request_id").agg(
        F.count("*").alias("centred"))
    return by_shape.join(by_point, "request_id", "left").fillna(0, ["centred"])


# ---- boundaries ----------------------------------------------------------

def _placed(spark, sf):
    return bbox_query.flagged(ft.stored_buildings(spark, sf), ft.city_master(spark, sf))


@query("geo_11_boundary_contains", fs.on_flagged("SELECT id, inside FROM f"))
def _(spark, sf):
    return _placed(spark, sf).select("id", "inside")


@query("join_07_import_boundary_filter", fs.on_flagged("""
SELECT city_code, count(*) AS rows_before, count(*) FILTER (WHERE coalesce(inside, true)) AS rows_kept,
  count(*) FILTER (WHERE inside = false) AS rows_outside FROM f GROUP BY city_code"""))
def _(spark, sf):
    flags = _placed(spark, sf)
    return flags.groupBy("city_code").agg(
        F.count("*").alias("rows_before"), F.count_if(F.coalesce("inside", F.lit(True))).alias("rows_kept"),
        F.count_if(F.col("inside") == F.lit(False)).alias("rows_outside"))


@query("join_08_query_boundary_filter", fs.on_flagged("SELECT id FROM f WHERE coalesce(inside, true)"))
def _(spark, sf):
    return boundary.keep_own_city(_placed(spark, sf)).select("id")


@query("flt_14_city_boundary_rule", fs.on_flagged("""
SELECT coalesce(CAST(inside AS VARCHAR), 'unknown') AS state, count(*) AS buildings,
  count(*) FILTER (WHERE coalesce(inside, true)) AS passing FROM f GROUP BY 1"""))
def _(spark, sf):
    return _placed(spark, sf).groupBy(
        F.coalesce(F.col("inside").cast("string"), F.lit("unknown")).alias("state")).agg(
        F.count("*").alias("buildings"),
        F.count_if(F.coalesce("inside", F.lit(True))).alias("passing"))


@query("join_07_without_master_table", fs.on_shapes("SELECT count(*) AS kept, count(*) AS total FROM s"))
def _(spark, sf):
    rows = boundary.with_inside(ft.stored_buildings(spark, sf), None)
    return rows.agg(F.count_if(F.coalesce("inside", F.lit(True))).alias("kept"), F.count("*").alias("total"))


@query("join_09_boundary_tiebreak", fs.on_flagged("""
SELECT id, CAST(CASE WHEN inside THEN 0 ELSE 1 END AS INTEGER) AS sort_flag FROM f"""))
def _(spark, sf):
    return _placed(spark, sf).select("id", F.when(F.col("inside"), 0).otherwise(1).alias("sort_flag"))


def _ready(spark, sf):
    return bbox_query.prepared(ft.stored_buildings(spark, sf), ft.city_master(spark, sf))


# ---- dedup and limits ----------------------------------------------------

KEYED = """, keyed AS (SELECT r.request_id, r.row_limit, f.*, CAST(round(cen_lon / 10) AS BIGINT) AS key_lon,
  CAST(round(cen_lat / 10) AS BIGINT) AS key_lat, coalesce(CAST(height AS VARCHAR), '') AS key_height,
  coalesce(CAST(building_levels AS VARCHAR), '') AS key_levels, coalesce(building_part, '') AS key_part
  FROM r JOIN f ON {cond} WHERE coalesce(f.inside, true) AND {part}),
dd AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY request_id, key_lon, key_lat, key_height, key_levels,
   key_part ORDER BY CASE WHEN inside THEN 0 ELSE 1 END, city_code, id) AS rn FROM keyed) WHERE rn = 1),
lim AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY key_lon, key_lat, key_height,
   key_levels, key_part) AS pos_no FROM dd) WHERE pos_no <= row_limit)"""
OUTLINE = "f.building_part IS NULL"
ORPHAN = "f.building_part = 'yes' AND f.parent_building_id IS NULL"


def keyed(cond, part):
    return KEYED.replace("{cond}", cond).replace("{part}", part)


@query("win_01_cross_city_dedup", on_requests("SELECT request_id, id FROM dd", keyed(CENTRED, OUTLINE)))
def _(spark, sf):
    ready = _ready(spark, sf)
    pairs = bbox_query.outline_candidates(ft.requests(spark, sf), ready, ft.stored_buildings(spark, sf), "centroid")
    return bbox_query._ids(bbox_query.first_copies(pairs), ready)


@query("win_02_orphan_part_dedup", on_requests("SELECT request_id, id FROM dd", keyed(MEETS, ORPHAN)))
def _(spark, sf):
    return bbox_query.orphan_parts(ft.requests(spark, sf), _ready(spark, sf), ft.stored_buildings(spark, sf))


@query("win_03_candidates_before_dedup", on_requests("""
SELECT request_id, count(*) AS outline_candidates FROM keyed GROUP BY request_id""", keyed(MEETS, OUTLINE)))
def _(spark, sf):
    pairs = bbox_query.outline_candidates(ft.requests(spark, sf), _ready(spark, sf), ft.stored_buildings(spark, sf))
    return pairs.groupBy("request_id").agg(F.count("*").alias("outline_candidates"))


@query("srt_01_limit_in_key_order", on_requests("SELECT request_id, id FROM lim", keyed(CENTRED, OUTLINE)))
def _(spark, sf):
    return bbox_query.outlines(ft.requests(spark, sf), _ready(spark, sf), ft.stored_buildings(spark, sf), "centroid")


@query("agg_15_dedup_observability", on_requests("""
SELECT r.request_id, coalesce(c, 0) AS outline_candidates, coalesce(n, 0) AS outlines,
  coalesce(c, 0) > r.row_limit AS limit_hit,
  CASE WHEN coalesce(c, 0) > r.row_limit THEN NULL ELSE greatest(0, coalesce(c, 0) - coalesce(n, 0)) END AS deduped
FROM r LEFT JOIN (SELECT request_id, count(*) AS c FROM keyed GROUP BY 1) USING (request_id)
LEFT JOIN (SELECT request_id, count(*) AS n FROM lim GROUP BY 1) USING (request_id)""", keyed(MEETS, OUTLINE)))
def _(spark, sf):
    return bbox_query.observability(ft.requests(spark, sf), _ready(spark, sf), ft.stored_buildings(spark, sf))


# ---- parts ---------------------------------------------------------------

def pair_meets(pairs: str) -> str:
    """CTEs telling whether polygons ck and pk of table ``pairs`` intersect."""
    o = "sign(({b}2x-{b}1x)*({p}y-{b}1y) - ({b}2y-{b}1y)*({p}x-{b}1x))"
    return f"""
, segs AS (SELECT q.ck, q.pk, a.x1 AS a1x, a.y1 AS a1y, a.x2 AS a2x, a.y2 AS a2y, c.x1 AS c1x, c.y1 AS c1y,
   c.x2 AS c2x, c.y2 AS c2y, a.ring = 0 AND a.seq = 0 AS afirst, c.ring = 0 AND c.seq = 0 AS cfirst
   FROM {pairs} q JOIN edge a ON a.k = q.ck JOIN edge c ON c.k = q.pk),
cut AS (SELECT ck, pk, bool_or(
    least(a1x,a2x) <= greatest(c1x,c2x) AND least(c1x,c2x) <= greatest(a1x,a2x)
    AND least(a1y,a2y) <= greatest(c1y,c2y) AND least(c1y,c2y) <= greatest(a1y,a2y)
    AND {o.format(b='a', p='c1')} * {o.format(b='a', p='c2')} <= 0
    AND {o.format(b='c', p='a1')} * {o.format(b='c', p='a2')} <= 0) AS crossing,
  count(*) FILTER (WHERE afirst AND ((c1y <= a1y AND c2y > a1y AND {o.format(b='c', p='a1')} > 0)
     OR (c2y <= a1y AND c1y > a1y AND {o.format(b='c', p='a1')} < 0))) % 2 = 1 AS a_in,
  count(*) FILTER (WHERE cfirst AND ((a1y <= c1y AND a2y > c1y AND {o.format(b='a', p='c1')} > 0)
     OR (a2y <= c1y AND a1y > c1y AND {o.format(b='a', p='c1')} < 0))) % 2 = 1 AS c_in
  FROM segs GROUP BY ck, pk),
meet AS (SELECT ck, pk, crossing OR a_in OR c_in AS meets FROM cut)"""


KIN = """, kin AS (SELECT k AS ck, parent_building_id - 1 AS pk FROM b WHERE parent_building_id IS NOT NULL)"""


@query("geo_14_part_meets_parent", "WITH " + fs.POS + "," + fs.GEOM + "," + fs.BLD + KIN + pair_meets("kin") + """
SELECT ck + 1 AS id, pk + 1 AS parent_building_id, meets AS intersects_parent FROM kin LEFT JOIN meet USING (ck, pk)
""")
def _(spark, sf):
    return bbox_query.part_links(ft.stored_buildings(spark, sf))


FULL = ", kin2 AS (SELECT DISTINCT k AS ck, parent_building_id - 1 AS pk FROM b WHERE parent_building_id IS NOT NULL)" \
    + pair_meets("kin2") + keyed("{COND}", OUTLINE) + """,
rel AS (SELECT lim.request_id, b.id, meets AS intersects_parent FROM lim
   JOIN b ON b.parent_building_id = lim.id LEFT JOIN meet ON ck = b.k AND pk = b.parent_building_id - 1),
orph_keyed AS (SELECT r.request_id, f.*, row_number() OVER (PARTITION BY r.request_id, CAST(round(cen_lon / 10) AS BIGINT),
   CAST(round(cen_lat / 10) AS BIGINT), height, building_levels, building_part
   ORDER BY CASE WHEN inside THEN 0 ELSE 1 END, city_code, id) AS rn
   FROM r JOIN f ON {COND} WHERE coalesce(f.inside, true) AND f.building_part = 'yes' AND f.parent_building_id IS NULL),
res AS (SELECT request_id, id, NULL::BOOLEAN AS intersects_parent, 'outline' AS kind FROM lim
   UNION ALL SELECT request_id, id, intersects_parent, 'part' FROM rel
   UNION ALL SELECT request_id, id, NULL, 'orphan' FROM orph_keyed WHERE rn = 1)"""


@query("join_11_related_parts", on_requests("SELECT request_id, id, intersects_parent FROM rel",
                                            FULL.replace("{COND}", MEETS)))
def _(spark, sf):
    stored = ft.stored_buildings(spark, sf)
    chosen = bbox_query.outlines(ft.requests(spark, sf), _ready(spark, sf), stored)
    return bbox_query.related_parts(chosen, stored)


@query("flt_15_drop_far_parts", on_requests("""
SELECT request_id, id FROM res WHERE intersects_parent IS DISTINCT FROM false""", FULL.replace("{COND}", MEETS)))
def _(spark, sf):
    rows = bbox_query.run(ft.requests(spark, sf), ft.stored_buildings(spark, sf), ft.city_master(spark, sf))
    return rows.filter("intersects_parent is distinct from false").select("request_id", "id")


@query("set_01_union_of_kinds", on_requests("""
SELECT request_id, count(*) AS buildings, count(*) FILTER (WHERE kind = 'part') AS parts,
  count(*) FILTER (WHERE kind = 'orphan') AS orphans FROM res GROUP BY request_id""", FULL.replace("{COND}", MEETS)))
def _(spark, sf):
    rows = bbox_query.run(ft.requests(spark, sf), ft.stored_buildings(spark, sf), ft.city_master(spark, sf))
    part = F.col("building_part") == "yes"
    return rows.groupBy("request_id").agg(
        F.count("*").alias("buildings"),
        F.count_if(part & F.col("parent_building_id").isNotNull()).alias("parts"),
        F.count_if(part & F.col("parent_building_id").isNull()).alias("orphans"))


def _bbox_rows(spark, sf, mode):
    return _shown(bbox_query.run(ft.requests(spark, sf), ft.stored_buildings(spark, sf), ft.city_master(spark, sf), mode))


def _shown(rows):
    return rows.select(
        "request_id", "id", "osm_id", "building", "height", "building_levels", "name", "building_part",
        "parent_building_id", "intersects_parent",
        whole(F.col("representative_point.lon")).alias("rep_lon"),
        whole(F.col("representative_point.lat")).alias("rep_lat"))


REP = SCAN[len(fs.POS) + 1 + len(fs.GEOM) + 1:]  # the interior-point CTEs alone
ROWS = """SELECT request_id, id, osm_id, building, height, building_levels, name, building_part, parent_building_id,
 intersects_parent, CAST(round(rlon) AS BIGINT) AS rep_lon, CAST(round(rlat) AS BIGINT) AS rep_lat
 FROM res JOIN b USING (id) JOIN rep USING (k)"""


@query("plan_bbox_query_intersects", on_requests(ROWS, FULL.replace("{COND}", MEETS) + "," + REP))
def _(spark, sf):
    return _bbox_rows(spark, sf, "intersects")


@query("plan_bbox_query_centroid", on_requests(ROWS, FULL.replace("{COND}", CENTRED) + "," + REP))
def _(spark, sf):
    return _bbox_rows(spark, sf, "centroid")


@query("plan_bbox_query_stored", on_requests(ROWS, FULL.replace("{COND}", MEETS) + "," + REP))
def _(spark, sf):
    return _shown(bbox_query.run_stored(
        ft.requests(spark, sf), ft.clustered_buildings(spark, sf), ft.city_master(spark, sf)))


# One request of its own, as the service gets them: a box in the middle of the map and its first 50 outlines.
ONE_BOX = (0, 1393600000, 359300000, 1394300000, 360100000, 50)
ONE = dict(zip(("west", "south", "east", "north"), ONE_BOX[1:]))


def _one_box(spark):
    return spark.createDataFrame([ONE_BOX], "request_id bigint, west bigint, south bigint, east bigint, north bigint, row_limit int")


@query("src_09_one_box_scan", fs.on_shapes(f"""SELECT id, city_code, building, height FROM s
WHERE (building_part IS NULL OR parent_building_id IS NULL) AND min_lon <= {ONE["east"]} AND max_lon >= {ONE["west"]} AND min_lat <= {ONE["north"]} AND max_lat >= {ONE["south"]}"""))
def _(spark, sf):
    near = layout.near(_one_box(spark), ft.clustered_buildings(spark, sf))
    standing = near.filter("building_part is null or parent_building_id is null")
    return standing.filter((F.col("min_lon") <= ONE["east"]) & (F.col("max_lon") >= ONE["west"])
                       & (F.col("min_lat") <= ONE["north"]) & (F.col("max_lat") >= ONE["south"])).select(
        "id", "city_code", "building", "height")


@query("srt_02_plan_order", on_requests("""SELECT request_id, id,
 CAST(row_number() OVER (PARTITION BY request_id ORDER BY id) AS INTEGER) AS place FROM res""", FULL.replace("{COND}", CENTRED)))
def _(spark, sf):
    """Places as the plan gives its rows out: the number is that of the row's arrival, not of its ``osm_id``."""
    rows = bbox_query.run_stored(ft.requests(spark, sf), ft.clustered_buildings(spark, sf), ft.city_master(spark, sf),
                                 "centroid").select("request_id", "id")
    arrived = rows.withColumn("_at", F.monotonically_increasing_id())
    return arrived.select("request_id", "id", F.row_number().over(
        Window.partitionBy("request_id").orderBy("_at")).alias("place"))
