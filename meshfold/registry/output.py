"""Output elements, identifiers, coverage, maintenance and quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from meshfold import fixed_values as fv
from meshfold.functions import geometry as g
from meshfold.functions import ids, numbers, text
from meshfold.operators import bbox, coverage, elements, layout, maintenance, quality
from meshfold.plans import bbox_query
from meshfold.registry import fixture_sql as fs
from meshfold.registry import fixture_tables as ft
from meshfold.registry import spatial
from meshfold.registry.core import query
from meshfold.session import cut_lineage, new_folder

YEAR = 2026  # fixed for determinism

RES = spatial.FULL.replace("{COND}", spatial.CENTRED)
OUT = RES + "," + spatial.REP + """,
-- result rows that are drawn: far parts go, every derived building has valid rings
o AS (SELECT res.request_id, res.kind, b.*, rlon, rlat FROM res JOIN b USING (id) JOIN rep USING (k)
   WHERE intersects_parent IS DISTINCT FROM false),
oring AS (SELECT request_id, o.id, o.k, ring, count(*) AS n FROM o JOIN vert USING (k) GROUP BY ALL),
point AS (SELECT k, ring, seq, -(1 + (vy - 200000000) * 320000001 + (vx - 1220000000)) AS nid, vx, vy FROM vert),
tag AS (SELECT *, CASE WHEN building_part = 'yes' THEN 'building:part=yes' ELSE 'building=' || building END AS t0 FROM o)"""


def out(body: str) -> str:
    return spatial.on_requests(body, OUT)


def _rows(spark, sf):
    return bbox_query.run(ft.requests(spark, sf), ft.stored_buildings(spark, sf), ft.city_master(spark, sf),
                          "centroid")


_EMITTED: dict = {}


def _emitted(spark, sf):
    """Drawn rows of all requests, kept as a table since many outputs start here."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _EMITTED:
        path = new_folder(spark, "emitted")
        elements.emitted_buildings(elements.keep_related(_rows(spark, sf)), ft.stored_nodes(spark, sf)
                                   ).write.parquet(path)
        _EMITTED[key] = path
    return spark.read.parquet(_EMITTED[key])


# ---- identifiers and text ------------------------------------------------

SPOTS = """spots AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 5 = 0 THEN 190000000 ELSE 200000000 END
  + c_custkey * 3000017 % 300000000 AS lat_i, 1220000000 + c_custkey * 2000029 % 330000000 AS lon_i FROM customer)"""


def _spots(spark, sf):
    k = F.col("c_custkey")
    return ft.table(spark, sf, "customer").select(
        k.alias("k"), (F.when(k % 5 == 0, 190000000).otherwise(200000000) + k * 3000017 % 300000000).alias("lat_i"),
        (F.lit(1220000000) + k * 2000029 % 330000000).alias("lon_i"))


@query("id_02_node_ids", f"""WITH {SPOTS} SELECT k, CASE WHEN lat_i BETWEEN 200000000 AND 460000000
  AND lon_i BETWEEN 1220000000 AND 1540000000 THEN -(1 + (lat_i - 200000000) * 320000001 + (lon_i - 1220000000))
  ELSE -(k + 7) END AS node_id FROM spots""")
def _(spark, sf):
    spots = _spots(spark, sf)
    lat = numbers.quantise(numbers.to_degrees(F.col("lat_i")))
    lon = numbers.quantise(numbers.to_degrees(F.col("lon_i")))
    return spots.select("k", ids.node_id(lat, lon, F.col("k") + 7).alias("node_id"))


@query("id_03_way_ids", fs.with_ctes(fs.POS, body="""
SELECT k + 1 AS id, CAST(ring AS INTEGER) AS ring, -((k + 1) * 1000 + ring) AS way_id FROM (SELECT DISTINCT k, ring FROM vert)"""))
def _(spark, sf):
    rings = ft.positions(spark, sf).select((F.col("k") + 1).alias("id"), F.posexplode("full_rings").alias("ring", "r"))
    return rings.select("id", "ring", ids.way_id(F.col("id"), F.col("ring")).alias("way_id"))


@query("id_04_relation_ids", "SELECT o_orderkey + 1 AS id, -((o_orderkey + 1) * 10 + 1) AS building_relation, "
                             "-((o_orderkey + 1) * 10 + 2) AS multipolygon_relation FROM orders")
def _(spark, sf):
    return ft.stored_buildings(spark, sf).select(
        "id", ids.relation_id(F.col("id"), fv.RELATION_KIND_BUILDING).alias("building_relation"),
        ids.relation_id(F.col("id"), fv.RELATION_KIND_MULTIPOLYGON).alias("multipolygon_relation"))


@query("geo_19_coordinate_keys", fs.on_nodes("""
SELECT printf('%d.%07d,%d.%07d', lat_i // 10000000, lat_i % 10000000, lon_i // 10000000, lon_i % 10000000) AS coord_key,
 count(*) AS node_rows FROM n GROUP BY 1"""))
def _(spark, sf):
    nodes = ft.stored_nodes(spark, sf)
    return nodes.groupBy("lat_i", "lon_i").agg(F.count("*").alias("node_rows")).select(
        F.concat_ws(",", numbers.degrees_text(F.col("lat_i")), numbers.degrees_text(F.col("lon_i"))).alias("coord_key"),
        "node_rows")


@query("txt_01_seven_decimals", f"""WITH {SPOTS} SELECT k, printf('%d.%07d', lat_i // 10000000, lat_i % 10000000) AS lat,
 printf('%d.%07d', lon_i // 10000000, lon_i % 10000000) AS lon FROM spots""")
def _(spark, sf):
    spots = _spots(spark, sf)
    return spots.select("k", *[F.call_function("format_number", numbers.to_degrees(F.col(f"{c}_i")),
                                               F.lit("0.0000000")).alias(c) for c in ("lat", "lon")])


@query("flt_16_node_validity", f"""WITH {SPOTS} SELECT k, (lat_i * 3.0 / 1e7) <= 90 AND (lon_i * 1.2 / 1e7) <= 180 AS valid
 FROM spots""")
def _(spark, sf):
    lat, lon = F.col("lat_i") * F.lit(3.0) / 1e7, F.col("lon_i") * F.lit(1.2) / 1e7
    node = F.array(F.struct(F.lit(0).alias("ring_id"), F.col("k").alias("id"), lat.alias("lat"), lon.alias("lon")))
    return _spots(spark, sf).select("k", (F.size(elements.ring_lists(node)[0]["nodes"]) == 1).alias("valid"))


@query("flt_21_start_dates", fs.on_buildings("""
SELECT id, start_date, CASE WHEN k % 9 IN (1, 4, 5) THEN true ELSE false END AS plausible FROM b"""))
def _(spark, sf):
    return ft.stored_buildings(spark, sf).select(
        "id", "start_date", text.plausible_start_date(F.col("start_date"), YEAR).alias("plausible"))


@query("flt_22_bbox_text", """
SELECT c_custkey AS request_id, CASE c_custkey % 7 WHEN 0 THEN 'not a number' WHEN 1 THEN 'not four numbers'
 WHEN 2 THEN 'longitude range' WHEN 3 THEN 'latitude range' WHEN 4 THEN 'min not below max' END AS reason FROM customer""")
def _(spark, sf):
    k = F.col("c_custkey")
    t = (F.when(k % 7 == 0, F.concat(F.lit("a"), k.cast("string"), F.lit(",35,140,36")))
         .when(k % 7 == 1, F.concat(F.lit("139,35,140,36,"), k.cast("string")))
         .when(k % 7 == 2, "139,35,181,36").when(k % 7 == 3, "139,-91,140,36").when(k % 7 == 4, "140,35,139,36")
         .when(k % 7 == 5, " 139.1 ,35e0,140,36").otherwise("139,35,140.5,36"))
    rows = ft.table(spark, sf, "customer").select(k.alias("request_id"), t.alias("bbox"))
    return bbox.read_bbox(rows).select("request_id", "reason")


@query("flt_23_city_codes", """SELECT c_custkey AS k, c_custkey % 4 = 0 AS is_code,
 CASE c_custkey % 3 WHEN 0 THEN lpad(CAST(c_custkey % 99999 AS VARCHAR), 5, '0') END AS from_dataset FROM customer""")
def _(spark, sf):
    k = F.col("c_custkey")
    five = F.lpad((k % 99999).cast("string"), 5, "0")
    code = (F.when(k % 4 == 0, five).when(k % 4 == 1, F.concat(five, F.lit("1")))
            .when(k % 4 == 2, F.translate(five, "0123456789", "０１２３４５６７８９")).otherwise(F.substring(five, 1, 4)))
    dataset = (F.when(k % 3 == 0, F.concat(F.lit("x_plateau_"), five, F.lit("_a_plateau_99999_b")))
               .when(k % 3 == 1, F.concat(F.lit("plateau_"), five)).otherwise(F.concat(
                   F.lit("plateau_"), F.translate(five, "0123456789", "０１２３４５６７８９"), F.lit("_a"))))
    return ft.table(spark, sf, "customer").select(
        "c_custkey", code.alias("c"), dataset.alias("d")).select(
        F.col("c_custkey").alias("k"), text.is_city_code(F.col("c")).alias("is_code"),
        text.city_from_dataset(F.col("d")).alias("from_dataset"))


@query("flt_24_control_characters", """SELECT doc_id, length(text) AS chars, false AS has_control FROM
 (SELECT doc_id, regexp_replace(text, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F]', '', 'g') AS text FROM documents)""")
def _(spark, sf):
    docs = ft.table(spark, sf, "documents").withColumn("dirty", F.concat(
        F.lit("\x01"), F.regexp_replace("text", " ", " \x0b"), F.lit("\x7f")))
    clean = docs.withColumn("t", text.strip_control(F.col("dirty")))
    return clean.select("doc_id", F.length("t").cast("bigint").alias("chars"),
                        F.col("t").rlike("[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F]").alias("has_control"))


# ---- elements ------------------------------------------------------------

@query("out_01_rings", out("SELECT request_id, id, CAST(ring AS INTEGER) AS ring_no, n AS nodes FROM oring"))
def _(spark, sf):
    return elements._ring_rows(_emitted(spark, sf)).select(
        "request_id", "id", F.col("ring_no").cast("int").alias("ring_no"), F.size("nodes").cast("bigint").alias("nodes"))


@query("flt_17_closing_point", fs.on_nodes("""
SELECT building_id, CAST(coalesce(ring_id, 0) AS INTEGER) AS ring_no,
 count(*) - any_value(CASE WHEN (building_id - 1) % 12 = 0 THEN 1 ELSE 0 END) AS nodes FROM n GROUP BY ALL"""))
def _(spark, sf):
    from meshfold.operators import statistics

    rings = statistics.ordered_nodes(ft.stored_nodes(spark, sf)).select(
        "building_id", F.explode(elements.ring_lists(F.col("nodes"))).alias("r"))
    return rings.select("building_id", F.col("r.ring_no").cast("int").alias("ring_no"),
                        F.size("r.nodes").cast("bigint").alias("nodes"))


@query("flt_18_three_valid_nodes", fs.with_ctes(fs.POS, fs.BLD, fs.NODES, body="""
SELECT id FROM b WHERE shape NOT IN (0, 2, 3) OR (shape IN (0, 3) AND k % 12 = 0)"""))
def _(spark, sf):
    # Outer rings lose their first node and holes have their last two off the globe:
    # rings fall below three, and one bad ring takes the building with it.
    nodes = ft.stored_nodes(spark, sf)
    first = nodes.filter("sequence_id > 0 or ring_id = 1")
    rows = ft.stored_buildings(spark, sf).select("id")
    moved = first.withColumn("lat", F.when((F.col("ring_id") == 1) & (F.col("sequence_id") > 1), 95.0).otherwise(F.col("lat")))
    return elements.emitted_buildings(rows, moved).select("id")


@query("flt_19_ring_number_limit", fs.on_buildings("""
SELECT id, shape = 2 AS holed FROM b WHERE shape <> 2 OR k % 4 <> 0"""))
def _(spark, sf):
    nodes = ft.stored_nodes(spark, sf)
    high = nodes.withColumn("ring_id", F.when(
        (F.col("ring_id") == 1) & ((F.col("building_id") - 1) % 4 == 0), 1000).otherwise(F.col("ring_id")))
    return elements.emitted_buildings(ft.stored_buildings(spark, sf).select("id"), high).select("id", "holed")


@query("flt_20_no_nodes", fs.on_buildings("SELECT id FROM b WHERE city_code <> '13104'"))
def _(spark, sf):
    nodes = ft.stored_nodes(spark, sf).filter("city_code <> '13104'")
    return elements.emitted_buildings(ft.stored_buildings(spark, sf).select("id"), nodes).select("id")


@query("out_02_unique_nodes", out("""
SELECT DISTINCT request_id, nid AS node_id, printf('%d.%07d', vy // 10000000, vy % 10000000) AS lat,
 printf('%d.%07d', vx // 10000000, vx % 10000000) AS lon FROM o JOIN point USING (k)"""))
def _(spark, sf):
    return elements.node_elements(_emitted(spark, sf))


@query("out_03_way_refs", out("""
SELECT request_id, -(o.id * 1000 + ring) AS way_id, string_agg(nid, ' ' ORDER BY seq) || ' ' || arg_min(nid, seq) AS refs
 FROM o JOIN point USING (k) GROUP BY request_id, o.id, ring"""))
def _(spark, sf):
    return elements.way_elements(_emitted(spark, sf), YEAR).select(
        "request_id", "way_id", F.array_join(F.transform("refs", lambda r: r.cast("string")), " ").alias("refs"))


def tag_text(part: str) -> str:
    """SQL for the tag list as text."""
    number = "CASE WHEN {c} <> 0 THEN '{k}=' || CAST({c} AS VARCHAR) END"
    plain = "CASE WHEN trim({c}) <> '' THEN '{k}=' || {c} END"
    items = [part]
    for k, c in fv.OUTPUT_TAGS:
        if c in ("height", "ele", "building_levels"):
            items.append(number.format(c=c, k=k))
        elif c == "start_date":
            items.append("CASE WHEN k % 9 IN (1, 4, 5) THEN 'start_date=' || start_date END")
        elif c in ("roof_material", "tourism", "leisure"):
            continue
        else:
            items.append(plain.format(c=c, k=k))
    items.append("CASE WHEN rlon IS NOT NULL THEN 'representative_point=' || printf('%.7f,%.7f', rlon / 1e7, rlat / 1e7) END")
    return "concat_ws(';', " + ", ".join(items) + ")"


def joined(tags):
    return F.array_join(F.transform(tags, lambda t: F.concat_ws("=", t["k"], t["v"])), ";")


@query("out_04_tags", out(f"SELECT request_id, id, {tag_text('t0')} AS tags FROM tag"))
def _(spark, sf):
    return _emitted(spark, sf).select("request_id", "id", joined(elements.tag_list(YEAR)).alias("tags"))


@query("out_05_simple_ways", out(f"SELECT request_id, -(id * 1000) AS way_id, {tag_text('t0')} AS tags FROM tag WHERE shape <> 2"))
def _(spark, sf):
    ways = elements.way_elements(_emitted(spark, sf).filter(~F.col("holed")), YEAR)
    return ways.select("request_id", "way_id", joined(F.col("tags")).alias("tags"))


@query("out_06_multipolygons", out(f"""SELECT request_id, -(id * 10 + 2) AS relation_id,
 -(id * 1000) || ':outer ' || -(id * 1000 + 1) || ':inner' AS members, 'type=multipolygon;' || {tag_text('t0')} AS tags
 FROM tag WHERE shape = 2"""))
def _(spark, sf):
    return _relation_text(elements.multipolygon_relations(_emitted(spark, sf), YEAR))


def _relation_text(rel):
    return rel.select("request_id", "relation_id", F.array_join(F.transform("members", lambda m: F.concat_ws(
        ":", m["ref"].cast("string"), m["role"])), " ").alias("members"), joined(F.col("tags")).alias("tags"))


KIDS = """, kids AS (SELECT request_id, parent_building_id AS id, string_agg(-(id * 1000) || ':part', ' ' ORDER BY id) AS parts
 FROM o WHERE building_part = 'yes' AND parent_building_id IS NOT NULL GROUP BY ALL)"""


@query("out_07_part_relations", spatial.on_requests(f"""SELECT request_id, -(id * 10 + 1) AS relation_id,
 -(id * 1000) || ':outline ' || parts AS members, 'type=building;' || {tag_text("'building=' || building")} AS tags
 FROM tag JOIN kids USING (request_id, id) WHERE building_part IS NULL""", OUT + KIDS))
def _(spark, sf):
    return _relation_text(elements.part_relations(_emitted(spark, sf), YEAR))


@query("srt_04_member_order", spatial.on_requests("""SELECT request_id, -(o.id * 10 + 1) AS relation_id,
 CAST(1 + (SELECT count(*) FROM o c WHERE c.request_id = o.request_id AND c.parent_building_id = o.id AND
   c.building_part = 'yes') AS INTEGER) AS members, true AS ordered FROM o JOIN kids USING (request_id, id)
 WHERE building_part IS NULL""", OUT + KIDS))
def _(spark, sf):
    rel = elements.part_relations(_emitted(spark, sf), YEAR)
    parts = F.transform(F.filter("members", lambda m: m["role"] == "part"), lambda m: m["ref"])
    return rel.select("request_id", "relation_id", F.size("members").alias("members"),
                      (F.sort_array(parts, asc=False) == parts).alias("ordered"))


@query("out_08_duplicate_ids", "SELECT count(*) AS duplicates FROM orders WHERE false")
def _(spark, sf):
    e = _emitted(spark, sf)
    return elements.duplicate_ids(elements.way_elements(e, YEAR), elements.relation_elements(e, YEAR)).agg(
        F.count("*").alias("duplicates"))


@query("out_10_dangling_refs", "SELECT count(*) AS dangling FROM orders WHERE false")
def _(spark, sf):
    e = _emitted(spark, sf)
    return elements.dangling_refs(elements.way_elements(e, YEAR), elements.node_elements(e)).agg(
        F.count("*").alias("dangling"))


NREL = """, nrel AS (SELECT request_id, count(*) AS relations FROM (
   SELECT request_id FROM o WHERE shape = 2 UNION ALL
   SELECT request_id FROM o JOIN kids USING (request_id, id) WHERE building_part IS NULL) GROUP BY 1)"""


@query("agg_16_output_counts", spatial.on_requests("""
SELECT r.request_id, coalesce(bl, 0) AS buildings, coalesce(wy, 0) AS ways, coalesce(relations, 0) AS relations,
 coalesce(nn, 0) AS nodes, coalesce(far, 0) AS dropped_far_parts, CAST(0 AS BIGINT) AS out_of_range
FROM r LEFT JOIN (SELECT request_id, count(*) AS bl FROM o GROUP BY 1) USING (request_id)
LEFT JOIN (SELECT request_id, count(*) AS wy FROM oring GROUP BY 1) USING (request_id)
LEFT JOIN nrel USING (request_id)
LEFT JOIN (SELECT request_id, count(DISTINCT nid) AS nn FROM o JOIN point USING (k) GROUP BY 1) USING (request_id)
LEFT JOIN (SELECT request_id, count(*) FILTER (WHERE intersects_parent = false) AS far FROM res GROUP BY 1)
 USING (request_id)""", OUT + KIDS + NREL))
def _(spark, sf):
    rows = cut_lineage(_rows(spark, sf))
    return elements.output_counts(rows, _emitted(spark, sf), ft.requests(spark, sf), YEAR)


@query("snk_04_osm_documents", spatial.on_requests("""
SELECT r.request_id, CASE WHEN bl IS NULL THEN 1 ELSE 2 + nn + wy + coalesce(relations, 0) END AS lines, bl IS NULL AS empty
FROM r LEFT JOIN (SELECT request_id, count(*) AS bl FROM o GROUP BY 1) USING (request_id)
LEFT JOIN (SELECT request_id, count(*) AS wy FROM oring GROUP BY 1) USING (request_id)
LEFT JOIN nrel USING (request_id)
LEFT JOIN (SELECT request_id, count(DISTINCT nid) AS nn FROM o JOIN point USING (k) GROUP BY 1) USING (request_id)
""", OUT + KIDS + NREL))
def _(spark, sf):
    lines = _documents(spark, sf)
    return lines.groupBy("request_id").agg(
        F.count("*").alias("lines"), F.bool_or(F.col("line").endswith(elements.EMPTY_DOCUMENT)).alias("empty"))


def _documents(spark, sf):
    e = _emitted(spark, sf)
    return elements.document_lines(ft.requests(spark, sf), elements.node_elements(e),
                                   elements.way_elements(e, YEAR), elements.relation_elements(e, YEAR))


@query("out_09_empty_documents", out("SELECT request_id FROM r WHERE request_id NOT IN (SELECT request_id FROM o)"))
def _(spark, sf):
    lines = _documents(spark, sf)
    return lines.filter(F.col("line").endswith(elements.EMPTY_DOCUMENT)).select("request_id")


@query("id_06_response_tags", out("""SELECT request_id, md5(west || ',' || south || ',' || east || ',' || north || '-' ||
 row_limit || '-' || coalesce(n, 0)) AS tag FROM r LEFT JOIN (SELECT request_id, count(*) AS n FROM res GROUP BY 1)
 USING (request_id)"""))
def _(spark, sf):
    counts = _rows(spark, sf).groupBy("request_id").agg(F.count("*").alias("n"))
    full = ft.requests(spark, sf).join(counts, "request_id", "left").fillna(0, ["n"])
    box = F.concat_ws(",", *[F.col(c).cast("string") for c in ("west", "south", "east", "north")])
    return full.select("request_id", ids.response_tag(box, F.col("row_limit"), F.col("n")).alias("tag"))


# ---- coverage ------------------------------------------------------------

HULL = """, pts AS (SELECT DISTINCT city_code, CAST(round(cen_lon) AS BIGINT) AS px, CAST(round(cen_lat) AS BIGINT) AS py
   FROM s WHERE building_part IS NULL AND cen_lon IS NOT NULL),
cities AS (SELECT city_code, list({'x': px, 'y': py}) AS l, arg_min({'x': px, 'y': py}, px::HUGEINT * 10000000000 + py) AS p0
   FROM pts GROUP BY 1)"""
WRAP = """
SELECT city_code, CAST(count(*) AS INTEGER) AS corners, CAST(min(cx) AS BIGINT) AS min_lon, CAST(max(cx) AS BIGINT) AS max_lon,
  CAST(abs(sum(cross2)) AS BIGINT) AS hull_area2 FROM (
  SELECT city_code, n, cur.x AS cx, cur.y AS cy, (cur.x - p0.x) * (nxt.y - p0.y) - (nxt.x - p0.x) * (cur.y - p0.y) AS cross2
  FROM wrapped JOIN cities USING (city_code)) GROUP BY city_code"""
RECURSIVE_HULL = "WITH RECURSIVE " + fs.POS + "," + fs.GEOM + "," + fs.BLD + "," + fs.SHAPED + HULL + """,
nextof AS (SELECT 1 AS one),
wrapped AS (
  SELECT city_code, 0 AS n, p0 AS cur, list_reduce(l, lambda a, q: CASE WHEN a = p0 THEN q WHEN q = p0 THEN a
     WHEN (a.x-p0.x)*(q.y-p0.y) - (a.y-p0.y)*(q.x-p0.x) < 0 OR ((a.x-p0.x)*(q.y-p0.y) - (a.y-p0.y)*(q.x-p0.x) = 0 AND
       (q.x-p0.x)*(q.x-p0.x) + (q.y-p0.y)*(q.y-p0.y) > (a.x-p0.x)*(a.x-p0.x) + (a.y-p0.y)*(a.y-p0.y)) THEN q ELSE a END) AS nxt
  FROM cities
  UNION ALL
  SELECT city_code, n + 1, nxt, list_reduce(l, lambda a, q: CASE WHEN a = nxt THEN q WHEN q = nxt THEN a
     WHEN (a.x-nxt.x)*(q.y-nxt.y) - (a.y-nxt.y)*(q.x-nxt.x) < 0 OR ((a.x-nxt.x)*(q.y-nxt.y) - (a.y-nxt.y)*(q.x-nxt.x) = 0 AND
       (q.x-nxt.x)*(q.x-nxt.x) + (q.y-nxt.y)*(q.y-nxt.y) > (a.x-nxt.x)*(a.x-nxt.x) + (a.y-nxt.y)*(a.y-nxt.y)) THEN q ELSE a END)
  FROM wrapped JOIN cities USING (city_code) WHERE nxt <> p0 AND n < 200)""" + WRAP


@query("geo_16_convex_hulls", RECURSIVE_HULL)
def _(spark, sf):
    hulls = coverage.convex_hulls(coverage.outline_points(ft.stored_buildings(spark, sf)))
    xs = F.transform("hull", lambda v: v["lon_i"])
    return hulls.select("city_code", F.size("hull").alias("corners"), F.array_min(xs).alias("min_lon"),
                        F.array_max(xs).alias("max_lon"), g.area2(F.array("hull")).alias("hull_area2"))


@query("geo_16_concave_hulls", fs.on_shapes("""
SELECT city_code, true AS simple, true AS corners_are_points, true AS not_above_convex, count(*) AS points,
  CAST(0 AS BIGINT) AS outside FROM s
 WHERE building_part IS NULL AND cen_lon IS NOT NULL AND city_code IS NOT NULL GROUP BY 1"""))
def _(spark, sf):
    # The hull itself is not fixed by a formula; its properties are checked.
    points = coverage.outline_points(ft.stored_buildings(spark, sf))
    hulls = cut_lineage(coverage.concave_hulls(points))
    corners = hulls.select("city_code", F.explode("hull").alias("v")).select("city_code", "v.lon_i", "v.lat_i")
    strange = corners.join(points, ["city_code", "lon_i", "lat_i"], "left_anti").select("city_code").distinct()
    convex = coverage.convex_hulls(points).withColumnRenamed("hull", "convex")
    ring = F.array("hull")
    rows = hulls.join(convex, "city_code").join(strange.withColumn("bad", F.lit(True)), "city_code", "left").select(
        "city_code", g.is_valid(ring, g.edges(ring), g.area2(ring)).alias("simple"),
        F.col("bad").isNull().alias("corners_are_points"),
        (g.area2(ring) <= g.area2(F.array("convex"))).alias("not_above_convex"))
    return rows.join(coverage.covered_counts(points, hulls), "city_code")


@query("agg_05_coverage_counts", fs.on_shapes("""
SELECT city_code, count(*) AS building_count, count(cen_lon) AS covered FROM s
 WHERE building_part IS NULL AND city_code IS NOT NULL GROUP BY 1"""))
def _(spark, sf):
    buildings = ft.stored_buildings(spark, sf)
    table = cut_lineage(coverage.coverage(buildings))
    covered = coverage.covered_counts(coverage.outline_points(buildings), table)
    return table.join(covered, "city_code", "left").select(
        "city_code", "building_count", F.coalesce(F.col("points") - F.col("outside"), F.lit(0)).alias("covered"))


@query("snk_05_coverage_geojson", fs.on_buildings("""
SELECT city_code, 'Feature' AS kind, city_code AS id, count(*) AS building_count, true AS closed FROM b
 WHERE building_part IS NULL GROUP BY 1"""))
def _(spark, sf):
    rows = coverage.features(coverage.coverage(ft.stored_buildings(spark, sf)))
    schema = ("type string, id string, geometry struct<type:string,coordinates:array<array<array<double>>>>, "
              "properties struct<city_code:string,building_count:bigint>")
    back = rows.select("city_code", F.from_json("feature", schema).alias("f"))
    ring = F.col("f.geometry.coordinates")[0]
    return back.select("city_code", F.col("f.type").alias("kind"), F.col("f.id").alias("id"),
                       F.col("f.properties.building_count").alias("building_count"),
                       (F.element_at(ring, 1) == F.element_at(ring, -1)).alias("closed"))


@query("snk_05_feature_collection_lines", fs.on_buildings("""
SELECT 2 + count(DISTINCT city_code) AS lines, count(DISTINCT city_code) - 1 AS commas FROM b WHERE building_part IS NULL"""))
def _(spark, sf):
    lines = coverage.feature_collection(coverage.coverage(ft.stored_buildings(spark, sf)))
    return lines.agg(F.count("*").alias("lines"), F.count_if(F.col("line").startswith(",")).alias("commas"))


@query("snk_17_coverage_refresh", fs.on_buildings("""
SELECT city_code, count(*) FILTER (WHERE building_part IS NULL AND (city_code <> '13102' OR building = 'house')) AS
 building_count FROM b GROUP BY 1"""))
def _(spark, sf):
    path, rows = new_folder(spark, "coverage"), ft.stored_buildings(spark, sf)
    coverage.refresh(rows, path)
    later = rows.filter("city_code <> '13102' or building = 'house'")
    coverage.refresh(later, path, later.filter("city_code = '13102'"))
    return spark.read.parquet(path).select("city_code", "building_count")


# ---- maintenance ---------------------------------------------------------

def _copies(spark, sf, rows=None):
    b, n = new_folder(spark, "b"), new_folder(spark, "n")
    maintenance.write_table(ft.stored_buildings(spark, sf).drop("rings") if rows is None else rows, b, ["id"])
    maintenance.write_table(ft.stored_nodes(spark, sf), n, ["building_id"])
    return b, n


@query("snk_03_replace_by_city", fs.on_buildings("""
SELECT city_code, count(*) AS buildings, count(*) FILTER (WHERE city_code = '13106') AS replaced,
 CAST(sum(corners) AS BIGINT) AS corners, CAST(sum(sx) AS BIGINT) AS sum_lon, CAST(sum(sy) AS BIGINT) AS sum_lat FROM b
 LEFT JOIN (SELECT k, count(*) AS corners, sum(vx) AS sx, sum(vy) AS sy FROM vert WHERE k % 997 <> 5 GROUP BY k) USING (k)
 WHERE city_code <> '13106' OR id % 3 = 0 GROUP BY 1"""))
def _(spark, sf):
    path, whole = new_folder(spark, "b"), ft.stored_buildings(spark, sf)
    layout.write(whole, path)
    new = whole.filter("city_code = '13106' and id % 3 = 0").withColumn("building", F.lit("replaced"))
    layout.replace_cities(new, path, new.select("city_code"))
    corners, zero = F.flatten("rings"), F.lit(0).cast("bigint")
    return spark.read.parquet(path).withColumn("_c", corners).groupBy("city_code").agg(
        F.count("*").alias("buildings"), F.count_if(F.col("building") == "replaced").alias("replaced"),
        F.sum(F.when(F.col("_c").isNotNull(), F.size("_c"))).alias("corners"),
        F.sum(F.aggregate("_c", zero, lambda a, v: a + v["lon_i"])).alias("sum_lon"),
        F.sum(F.aggregate("_c", zero, lambda a, v: a + v["lat_i"])).alias("sum_lat"))


@query("snk_15_purge_city", fs.on_nodes("""
SELECT city_code, count(*) AS buildings, (SELECT count(*) FROM n WHERE n.city_code = b.city_code) AS nodes,
 (SELECT count(*) FROM b WHERE city_code <> '13107') AS buildings_left, (SELECT count(*) FROM n WHERE city_code <> '13107')
 AS nodes_left FROM b WHERE city_code = '13107' GROUP BY 1"""))
def _(spark, sf):
    b, n = _copies(spark, sf)
    deleted = maintenance.purge_city(b, n, "13107", spark)
    left = spark.read.parquet(b).agg(F.count("*").alias("buildings_left"))
    return deleted.join(left).join(spark.read.parquet(n).agg(F.count("*").alias("nodes_left")))


@query("snk_10_purge_audit", fs.on_nodes("""
SELECT city_code, count(*) AS buildings_deleted, (SELECT count(*) FROM n WHERE n.city_code = b.city_code) AS nodes_deleted
 FROM b GROUP BY 1"""))
def _(spark, sf):
    path = new_folder(spark, "history")
    counts = maintenance.purge_preview(ft.stored_buildings(spark, sf), ft.stored_nodes(spark, sf))
    for half in ("city_code < '13110'", "city_code >= '13110'"):
        maintenance.append_history(counts.filter(half), path, F.lit("2026-01-01 00:00:00").cast("timestamp"),
                                   "job", "host", 1.5)
    history = spark.read.schema(maintenance.HISTORY).parquet(path)
    return history.select("city_code", "buildings_deleted", "nodes_deleted")


@query("snk_11_plan_csv", fs.on_buildings("SELECT city_code, row_number() OVER (ORDER BY city_code) AS line_no FROM b GROUP BY 1"))
def _(spark, sf):
    from meshfold.sources import plans

    path = new_folder(spark, "plan")
    rows = ft.stored_buildings(spark, sf).groupBy("city_code").agg(F.count("*").alias("bytes"))
    plans.write_plan(rows.select("city_code", F.lit("p").alias("package"), F.lit(2024).alias("year"),
                                 F.lit(1).alias("citygml_v"), "bytes", F.lit("u").alias("url")), path)
    # Numbered by file and place in it, as they were written.
    back = plans.read_plan(spark, path).select("city_code", F.col("_metadata.file_name").alias("_file")).withColumn(
        "_at", F.monotonically_increasing_id())
    return ids.dense_ids(back, ["_file", "_at"], 1, "line_no").drop("_file", "_at")


@query("snk_12_schema_evolution", fs.on_nodes("""
SELECT 'buildings' AS source, count(*) AS n, count(building_part) AS filled FROM b
UNION ALL SELECT 'nodes', count(*), count(*) FILTER (WHERE coalesce(ring_id, 0) = 0) FROM n"""))
def _(spark, sf):
    path = new_folder(spark, "ages")
    rows = ft.stored_buildings(spark, sf).select("id", "osm_id", "city_code", "building_part")
    rows.filter("building_part is null").drop("building_part").write.parquet(f"{path}/age=old")
    rows.filter("building_part is not null").write.parquet(f"{path}/age=new")
    both = maintenance.read_evolved(spark, path)
    nodes = maintenance.evolve_nodes(ft.stored_nodes(spark, sf))
    return both.agg(F.lit("buildings").alias("source"), F.count("*").alias("n"), F.count("building_part").alias("filled")
                    ).unionByName(nodes.agg(F.lit("nodes").alias("source"), F.count("*").alias("n"),
                                            F.count_if(F.col("ring_id") == 0).alias("filled")))


@query("snk_13_backfill_city", fs.on_buildings("""
SELECT id, CASE WHEN k % 50 IN (0, 1) AND k % 2 = 0 THEN NULL ELSE city_code END AS city_code FROM b"""))
def _(spark, sf):
    rows = ft.stored_buildings(spark, sf).select("id", "source_dataset", F.when(
        F.col("id") % 2 == 0, F.col("city_code")).alias("city_code"))
    return maintenance.backfill_city(rows).select("id", "city_code")


@query("snk_14_not_null_gate", fs.on_buildings("SELECT id, city_code FROM b"))
def _(spark, sf):
    return maintenance.require_city(ft.stored_buildings(spark, sf)).select("id", "city_code")


GONE = "(SELECT id FROM b WHERE id % 7 = 3 UNION SELECT c.id FROM b c JOIN b p ON c.parent_building_id = p.id WHERE p.id % 7 = 3)"


@query("snk_16_cascade_delete", fs.on_nodes(f"""
SELECT (SELECT count(*) FROM b WHERE id NOT IN {GONE}) AS buildings_left,
 (SELECT count(*) FROM n WHERE building_id NOT IN {GONE}) AS nodes_left"""))
def _(spark, sf):
    rows = ft.stored_buildings(spark, sf)
    b, n = maintenance.delete_buildings(rows, ft.stored_nodes(spark, sf), rows.filter("id % 7 = 3"))
    return b.agg(F.count("*").alias("buildings_left")).join(n.agg(F.count("*").alias("nodes_left")))


@query("join_21_cascade_closure", fs.on_buildings(f"SELECT id FROM {GONE}"))
def _(spark, sf):
    rows = ft.stored_buildings(spark, sf)
    return maintenance.cascade_ids(rows, rows.filter("id % 7 = 3"))


@query("snk_18_schema_checks", fs.on_buildings("""
SELECT 'city_code' AS "column", true AS present, count(*) - count(city_code) AS missing_values FROM b
UNION ALL SELECT 'source_dataset', true, count(*) - count(source_dataset) FROM b
UNION ALL SELECT 'no_such_column', false, NULL"""))
def _(spark, sf):
    return maintenance.schema_checks(ft.stored_buildings(spark, sf), ["city_code", "source_dataset", "no_such_column"])


@query("join_05_node_key_remap", fs.on_nodes("""
SELECT n.id, b.id + 1000000 AS building_id, b.id IS NULL AS orphan FROM n LEFT JOIN b ON b.id = n.building_id AND b.k % 19 <> 0"""))
def _(spark, sf):
    keys = ft.stored_buildings(spark, sf).filter("(id - 1) % 19 <> 0").select(
        "osm_id", (F.col("id") + 1000000).alias("id"))
    nodes = ft.stored_nodes(spark, sf).withColumnRenamed("building_id", "building_osm_id").drop("osm_id")
    mapped, orphans = maintenance.remap_nodes(nodes, keys)
    return mapped.select("id", "building_id", F.lit(False).alias("orphan")).unionByName(orphans.select(
        "id", F.lit(None).cast("bigint").alias("building_id"), F.lit(True).alias("orphan")))


@query("join_06_parent_resolution", fs.on_buildings("""
SELECT c.osm_id AS part_osm_id, c.id AS child_id, p.id AS parent_id, p.id IS NOT NULL AS resolved FROM b c
 LEFT JOIN b p ON p.osm_id = c.parent_building_id AND p.k % 3 <> 0 WHERE c.parent_building_id IS NOT NULL AND c.k % 3 <> 0
UNION ALL SELECT c.osm_id, NULL, p.id, false FROM b c LEFT JOIN b p ON p.osm_id = c.parent_building_id AND p.k % 3 <> 0
 WHERE c.parent_building_id IS NOT NULL AND c.k % 3 = 0"""))
def _(spark, sf):
    rows = ft.stored_buildings(spark, sf)
    pairs = rows.filter("parent_building_id is not null").select(
        F.col("osm_id").alias("part_osm_id"), F.col("parent_building_id").alias("parent_osm_id"))
    return maintenance.resolve_parents(pairs, rows.filter("(id - 1) % 3 <> 0").select("osm_id", "id")).select(
        "part_osm_id", "child_id", "parent_id", "resolved")


# ---- quality -------------------------------------------------------------

@query("qa_01_duplicate_identifiers", fs.on_buildings("""
SELECT city_code, building_ref, count(*) AS rows FROM b GROUP BY ALL HAVING count(*) > 1"""))
def _(spark, sf):
    return quality.duplicate_identifiers(ft.stored_buildings(spark, sf))


def _middle(spark, sf):
    """The stored table with every shape replaced by a square of half the size."""
    rows = ft.stored_buildings(spark, sf).filter("rings is not null")
    w = F.floor((F.col("max_lon") - F.col("min_lon")) / 4).cast("bigint")
    h = F.floor((F.col("max_lat") - F.col("min_lat")) / 4).cast("bigint")
    west, south = F.col("min_lon") + w, F.col("min_lat") + h
    east, north = F.col("max_lon") - w, F.col("max_lat") - h
    ring = F.array(g.point(west, south), g.point(east, south), g.point(east, north), g.point(west, north))
    return ft.with_shape(rows.withColumn("rings", F.array(ring)).drop(
        "area2", "cen_lon", "cen_lat", "min_lon", "min_lat", "max_lon", "max_lat"))


@query("qa_02_nested_buildings", fs.on_shapes("""
SELECT o.id AS outer_id, i.id + 1000000000 AS inner_id FROM s o JOIN s i ON i.city_code = o.city_code AND i.p = o.p
 WHERE o.shape > 4 AND o.area2 IS NOT NULL AND i.area2 IS NOT NULL"""))
def _(spark, sf):
    # Every building also gets a smaller one in its middle; squares contain it, while
    # triangles, Ls and holes do not.
    rows = ft.stored_buildings(spark, sf)
    inner = _middle(spark, sf).withColumn("id", F.col("id") + 1000000000)
    both = rows.unionByName(inner)
    return quality.nested_buildings(both).select("outer_id", "inner_id")


@query("qa_03_holed_buildings", fs.on_buildings("SELECT city_code, count(*) AS holed FROM b WHERE shape = 2 AND k % 997 <> 5 GROUP BY 1"))
def _(spark, sf):
    return ft.stored_buildings(spark, sf).filter(F.size("rings") > 1).groupBy("city_code").agg(
        F.count("*").alias("holed"))


@query("qa_04_parent_links", fs.on_buildings("""
SELECT count(*) FILTER (WHERE parent_building_id IS NOT NULL) AS linked, count(*) AS total FROM b"""))
def _(spark, sf):
    return ft.stored_buildings(spark, sf).agg(F.count("parent_building_id").alias("linked"), F.count("*").alias("total"))


@query("qa_05_ring_distribution", fs.on_nodes("SELECT ring_id, count(*) AS nodes FROM n GROUP BY 1"))
def _(spark, sf):
    return quality.rings_by_number(ft.stored_nodes(spark, sf))


@query("qa_06_shared_corners", fs.on_nodes("""
SELECT count(*) FILTER (WHERE c > 1) AS coordinates, CAST(sum(c) FILTER (WHERE c > 1) AS BIGINT) AS rows,
 CAST(sum(c) AS BIGINT) AS total, round(sum(c) FILTER (WHERE c > 1) / sum(c) * 100, 6) AS share
 FROM (SELECT count(*) AS c FROM n GROUP BY lat_i, lon_i)"""))
def _(spark, sf):
    return quality.shared_corners(ft.stored_nodes(spark, sf)).withColumn("share", F.round("share", 6))


@query("qa_07_rounding_collisions", fs.on_nodes("""
SELECT (SELECT count(*) FROM (SELECT DISTINCT lat_i, lon_i FROM n)) AS coordinates, count(*) AS after_rounding,
 (SELECT count(*) FROM (SELECT DISTINCT lat_i, lon_i FROM n)) - count(*) AS collisions
 FROM (SELECT DISTINCT (lat_i + 500) // 1000 AS a, (lon_i + 500) // 1000 AS b FROM n)"""))
def _(spark, sf):
    return quality.rounding_collisions(ft.stored_nodes(spark, sf), 1000, 1000)


AREA = "(area2 / 2.0 * ((111320.0 / 1e7) * (111320.0 / 1e7)) * cos(cen_lat / 1e7 * (pi() / 180)))"


@query("qa_08_area_bands", fs.on_shapes(f"""
SELECT CAST(CASE shape WHEN 0 THEN 4 WHEN 4 THEN 7 WHEN 3 THEN 4 ELSE 5 END AS INTEGER) AS n_points, count(*) AS total,
 count(*) FILTER (WHERE {AREA} < 1) AS below_1, count(*) FILTER (WHERE {AREA} < 5) AS below_5,
 count(*) FILTER (WHERE {AREA} < 10) AS below_10 FROM s WHERE area2 IS NOT NULL GROUP BY 1"""))
def _(spark, sf):
    return quality.area_bands(ft.stored_buildings(spark, sf))


@query("qa_09_elongation", fs.on_shapes(f"""
SELECT id, round(area, 4) AS area, round(length / sqrt(area), 4) AS elongation FROM (
 SELECT id, {AREA} AS area, sum(sqrt(((x2 - x1) * cos(cen_lat / 1e7 * (pi() / 180))) ** 2 + (y2 - y1) ** 2))
   * (111320.0 / 1e7) AS length FROM s JOIN edge USING (k) WHERE ring = 0 GROUP BY id, area2, cen_lat)
WHERE area < 60 AND area > 0"""))
def _(spark, sf):
    return quality.elongation(ft.stored_buildings(spark, sf), 60.0).select(
        "id", F.round("area", 4).alias("area"), F.round("elongation", 4).alias("elongation"))


@query("qa_10_cross_city_duplicates", fs.on_shapes("""
SELECT count(*) AS buildings, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows FROM (SELECT count(*) AS n FROM s
 WHERE building_part IS NULL AND cen_lon IS NOT NULL GROUP BY cen_lon, cen_lat, height
 HAVING count(DISTINCT city_code) > 1)"""))
def _(spark, sf):
    return quality.cross_city_duplicates(ft.stored_buildings(spark, sf))


@query("qa_11_far_parts", "WITH " + fs.POS + "," + fs.GEOM + "," + fs.BLD + "," + fs.SHAPED + spatial.KIN
       + spatial.pair_meets("kin") + """
SELECT count(*) AS parts, round(median(d), 3) AS median_m, round(max(d), 3) AS max_m FROM (
 SELECT sqrt(pow((p.cen_lon - c.cen_lon) * cos((p.cen_lat + c.cen_lat) / 2e7 * (pi() / 180)), 2)
  + pow(p.cen_lat - c.cen_lat, 2)) * (111320.0 / 1e7) AS d
 FROM meet JOIN s c ON c.k = ck JOIN s p ON p.k = pk WHERE NOT meets)""")
def _(spark, sf):
    return quality.far_parts(ft.stored_buildings(spark, sf)).select(
        "parts", F.round("median_m", 3).alias("median_m"), F.round("max_m", 3).alias("max_m"))


@query("dsg_01_near_duplicate_parts", fs.on_shapes("""
SELECT c.id, c.parent_building_id FROM s c JOIN s q ON q.id = c.parent_building_id WHERE c.p = q.p
 AND q.height IS NOT NULL AND q.building_levels IS NOT NULL AND c.area2 > 0 AND q.area2 > 0"""))
def _(spark, sf):
    return quality.near_duplicate_parts(_with_close_parts(spark, sf))


def _with_close_parts(spark, sf):
    """The stored table with each part given its parent's height and levels, so that
    shape decides."""
    rows = ft.stored_buildings(spark, sf)
    parents = rows.select(F.col("id").alias("parent_building_id"), F.col("height").alias("ph"),
                          F.col("building_levels").alias("pl"))
    return rows.join(parents, "parent_building_id", "left").withColumns({
        "height": F.coalesce("ph", "height"), "building_levels": F.coalesce("pl", "building_levels")}).drop("ph", "pl")


@query("dsg_02_role_swaps", fs.on_shapes("""
SELECT c.id AS swap_id, c.parent_building_id FROM s c JOIN s q ON q.id = c.parent_building_id
 WHERE c.p = q.p AND c.shape > 4 AND c.area2 IS NOT NULL AND q.area2 IS NOT NULL"""))
def _(spark, sf):
    # Outlines shrink to half the size, so a part in the same place outgrows them.
    rows = ft.stored_buildings(spark, sf)
    small = _middle(spark, sf).filter("building_part is null")
    return quality.role_swaps(rows.filter("building_part is not null").unionByName(small))
