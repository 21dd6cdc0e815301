"""The formulas of ``fixture_tables`` as DuckDB CTEs.

Shapes are built here by relational steps (vertex rows, lead, group by) rather
than by array expressions, so the two sides check one another.
"""

from __future__ import annotations

POS = """
k0 AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 10 = 1 THEN o_orderkey - 1
        WHEN o_orderkey % 17 = 0 AND o_orderkey % 4 = 0 AND o_orderkey % 10 <> 0
        THEN o_orderkey - 1 WHEN o_orderkey % 440 = 44 THEN o_orderkey - 22 ELSE o_orderkey END AS p FROM orders),
pos AS (SELECT k, p, 1390000000 + (p * 104729 % 1000003) * 10 AS x,
        356000000 + (p * 7919 % 1000003) * 10 AS y, 300 + (p % 7) * 50 AS h, p % 20 AS shape,
        CAST(13101 + k % 22 AS VARCHAR) AS city, CAST(53390000 + k // 4000 AS VARCHAR) AS mesh,
        k // 22 AS j FROM k0),
tmpl AS (SELECT * FROM (VALUES
  ('tri',0,0,-1,-1),('tri',0,1,1,-1),('tri',0,2,0,1),
  ('ell',0,0,-1,-1),('ell',0,1,1,-1),('ell',0,2,1,0),('ell',0,3,0,0),('ell',0,4,0,1),('ell',0,5,-1,1),
  ('flat',0,0,-1,0),('flat',0,1,0,0),('flat',0,2,1,0),
  ('sq',0,0,-1,-1),('sq',0,1,1,-1),('sq',0,2,1,1),('sq',0,3,-1,1),
  ('donut',0,0,-1,-1),('donut',0,1,1,-1),('donut',0,2,1,1),('donut',0,3,-1,1),
  ('donut',1,0,-1,-1),('donut',1,1,1,-1),('donut',1,2,1,1),('donut',1,3,-1,1)
  ) AS t(cls, ring, seq, fx, fy)),
vert AS (SELECT k, ring, seq, x + fx * (CASE WHEN ring = 1 THEN h // 3 ELSE h END) AS vx,
        y + fy * (CASE WHEN ring = 1 THEN h // 3 ELSE h END) AS vy
        FROM pos JOIN tmpl ON cls = CASE shape WHEN 0 THEN 'tri' WHEN 4 THEN 'ell'
          WHEN 2 THEN 'donut' WHEN 3 THEN 'flat' ELSE 'sq' END)"""

GEOM = """
edge AS (SELECT k, ring, seq, vx AS x1, vy AS y1,
        coalesce(lead(vx) OVER w, first_value(vx) OVER w) AS x2,
        coalesce(lead(vy) OVER w, first_value(vy) OVER w) AS y2 FROM vert
        WHERE k % 997 <> 5 WINDOW w AS (PARTITION BY k, ring ORDER BY seq)),
org AS (SELECT k, vx AS x0, vy AS y0 FROM vert WHERE ring = 0 AND seq = 0),
ringm AS (SELECT k, ring, sum((x1-x0)*(y2-y0) - (x2-x0)*(y1-y0)) AS a,
        sum(((x1-x0)*(y2-y0) - (x2-x0)*(y1-y0)) * (x1+x2-2*x0)) AS mx,
        sum(((x1-x0)*(y2-y0) - (x2-x0)*(y1-y0)) * (y1+y2-2*y0)) AS my
        FROM edge JOIN org USING (k) GROUP BY ALL),
geom AS (SELECT k, CAST(sum(abs(a) * CASE WHEN ring = 0 THEN 1 ELSE -1 END) AS BIGINT) AS area2,
        CAST(sum(sign(a) * mx * CASE WHEN ring = 0 THEN 1 ELSE -1 END) AS BIGINT) AS mx,
        CAST(sum(sign(a) * my * CASE WHEN ring = 0 THEN 1 ELSE -1 END) AS BIGINT) AS my
        FROM ringm GROUP BY k),
box AS (SELECT k, min(vx) AS min_lon, min(vy) AS min_lat, max(vx) AS max_lon, max(vy) AS max_lat
        FROM vert WHERE k % 997 <> 5 GROUP BY k)"""

BLD = """
b AS (SELECT k + 1 AS id, k + 1 AS osm_id, k, p,
        CASE WHEN k % 13 = 0 THEN 'house' ELSE 'yes' END AS building,
        CASE WHEN k % 11 <> 0 THEN 3 + (p % 40) * 0.5::DOUBLE END AS height,
        CASE WHEN k % 6 = 0 THEN 0::DOUBLE ELSE CAST(k % 50 - 5 AS DOUBLE) END AS ele,
        CAST(CASE WHEN p % 9 <> 0 THEN 1 + p % 30 END AS INTEGER) AS building_levels,
        CASE WHEN k % 50 = 0 THEN NULL WHEN k % 50 = 1 THEN 'import_' || (k % 7)
             ELSE 'plateau_' || city || '_' || mesh || '_bldg_6697_op.osm' END AS source_dataset,
        CASE WHEN k % 8 = 0 THEN 'b' || k WHEN k % 8 = 1 THEN '' END AS name,
        CASE WHEN k % 5 = 0 THEN CAST(k % 90 AS VARCHAR) END AS addr_housenumber,
        CASE WHEN k % 10 = 0 THEN 's & ' || (k % 30) END AS addr_street,
        CASE k % 9 WHEN 0 THEN '0001' WHEN 1 THEN '1987' WHEN 2 THEN '9999' WHEN 3 THEN 'abcd'
             WHEN 4 THEN '2020-05-01' WHEN 5 THEN ' 1999 ' WHEN 6 THEN '' END AS start_date,
        CASE WHEN k % 21 = 0 THEN 'wood' END AS building_material,
        CASE WHEN k % 12 = 5 THEN 'flat' END AS roof_shape,
        CASE WHEN k % 14 = 0 THEN 'school' END AS amenity,
        CASE WHEN k % 15 = 0 THEN 'books' END AS shop,
        CASE WHEN k % 25 = 0 THEN 'retail' END AS landuse,
        city AS city_code, CASE WHEN k % 17 = 0 AND k % 10 NOT IN (0, 1) THEN 'yes' END AS building_part,
        city || '-bldg-' || (CASE WHEN k % 440 = 22 THEN k - 22 ELSE k END) AS building_ref,
        CASE WHEN k % 17 = 0 AND k % 10 NOT IN (0, 1) AND k % 2 = 0 THEN k END AS parent_building_id,
        shape, h, x, y, mesh, j FROM pos)"""

SHAPED = """
s AS (SELECT b.*, area2, min_lon, min_lat, max_lon, max_lat,
        CASE WHEN area2 <> 0 THEN x0 + mx::DOUBLE / (3 * area2)::DOUBLE
             WHEN area2 = 0 THEN x::DOUBLE END AS cen_lon,
        CASE WHEN area2 <> 0 THEN y0 + my::DOUBLE / (3 * area2)::DOUBLE
             WHEN area2 = 0 THEN y::DOUBLE END AS cen_lat
      FROM b LEFT JOIN geom USING (k) LEFT JOIN box USING (k) LEFT JOIN org USING (k))"""

NODES = """
vclosed AS (SELECT * FROM vert UNION ALL
        SELECT v.k, v.ring, n.n, v.vx, v.vy FROM vert v
        JOIN (SELECT k, ring, count(*) AS n FROM vert GROUP BY ALL) n
          ON n.k = v.k AND n.ring = v.ring WHERE v.seq = 0 AND v.k % 12 = 0),
n AS (SELECT (k + 1) * 100 + ring * 20 + seq AS id,
        -(1 + (vy - 200000000) * 320000001 + (vx - 1220000000)) AS osm_id,
        vy / 1e7 AS lat, vx / 1e7 AS lon, vy AS lat_i, vx AS lon_i, CAST(seq AS INTEGER) AS sequence_id,
        k + 1 AS building_id,
        CAST(CASE WHEN ring = 0 AND k % 16 = 3 THEN NULL ELSE ring END AS INTEGER) AS ring_id,
        CAST(13101 + k % 22 AS VARCHAR) AS city_code FROM vclosed)"""

MASTER = """
m AS (SELECT CAST(13101 + n_nationkey + CASE WHEN n_nationkey >= 20 THEN 5 ELSE 0 END AS VARCHAR)
        AS city_code, n_nationkey AS nk, n_nationkey % 5 <> 0 AS has_boundary,
        1390000000 + (n_nationkey % 3) * 2500000 AS bx FROM nation)"""

# Strictly inside the boundary of the row's own city; NULL without a boundary.
INSIDE = """CASE WHEN m.has_boundary IS NOT TRUE OR s.cen_lon IS NULL THEN NULL ELSE
   s.cen_lat > 355000000 AND s.cen_lat < 367000000 AND s.cen_lon > m.bx AND s.cen_lon < m.bx + 5000000
   AND (m.nk % 4 <> 3 OR s.cen_lon < m.bx + 2000000 OR s.cen_lon > m.bx + 3000000)
   AND (m.nk % 4 <> 2 OR NOT (s.cen_lon BETWEEN m.bx + 2000000 AND m.bx + 3000000
                              AND s.cen_lat BETWEEN 360000000 AND 361000000)) END"""

REQ = """
r AS (SELECT c_custkey AS request_id, 1390000000 + c_custkey * 199933 % 9000000 AS west,
        356000000 + c_custkey * 77773 % 9000000 AS south,
        1390000000 + c_custkey * 199933 % 9000000 + 200000 + (c_custkey % 5) * 150000 AS east,
        356000000 + c_custkey * 77773 % 9000000 + 200000 + (c_custkey % 5) * 150000 AS north,
        5 + c_custkey % 20 AS row_limit FROM customer)"""

FLAGGED = f"""
f AS (SELECT s.*, {INSIDE} AS inside FROM s LEFT JOIN m ON m.city_code = s.city_code)"""


def with_ctes(*parts: str, body: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + body


def on_buildings(body: str) -> str:
    return with_ctes(POS, BLD, body=body)


def on_shapes(body: str) -> str:
    return with_ctes(POS, GEOM, BLD, SHAPED, body=body)


def on_nodes(body: str) -> str:
    return with_ctes(POS, BLD, NODES, body=body)


def on_flagged(body: str) -> str:
    return with_ctes(POS, GEOM, BLD, SHAPED, MASTER, FLAGGED, body=body)
