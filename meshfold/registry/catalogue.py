"""Archives, catalogues, plans and inventories."""

from __future__ import annotations

import io
import zipfile

import pyarrow as pa
from pyspark.sql import functions as F

from meshfold import fixed_values as fv
from meshfold.functions import ids, text
from meshfold.operators import inventory, maintenance
from meshfold.registry import fixture_sql as fs
from meshfold.registry import fixture_tables as ft
from meshfold.registry.core import query
from meshfold.session import new_folder
from meshfold.sources import archives, catalogue, plans


# ---- archives: one zip per supplier --------------------------------------

def _zips(spark, sf):
    """Supplier s has 1 + s % 4 models, a readme, and a clash if s % 5 = 0; every
    ninth archive is garbage. Model m of s is 100 + (s % 7) * 10 + m bytes long."""
    def build(batches):
        for batch in batches:
            names, contents = [], []
            for s in batch.column("s_suppkey").to_pylist():
                buffer = io.BytesIO()
                with zipfile.ZipFile(buffer, "w") as z:
                    for m in range(1 + s % 4):
                        z.writestr(f"udx/bldg/{53390000 + s + m}_bldg_6697_op.gml", b"x" * (100 + (s % 7) * 10 + m))
                    if s % 5 == 0:
                        z.writestr(f"udx/bldg/sub/{53390000 + s}_bldg_6697_op.gml", b"y")
                    z.writestr("readme.txt", b"r")
                    z.writestr(f"{53390000 + s}.osm", f'<osm><node id="-{s}"/></osm>')
                names.append(f"{53390000 + s}.zip" if s % 2 else f"{53390000 + s}_bldg_6697_op.zip")
                contents.append(b"garbage" if s % 9 == 8 else buffer.getvalue())
            yield pa.RecordBatch.from_pydict({"archive": pa.array(names, pa.string()),
                                              "content": pa.array(contents, pa.binary())})

    rows = ft.table(spark, sf, "supplier").select("s_suppkey")
    return rows.mapInArrow(build, "archive string, content binary").withColumn(
        "length", F.octet_length("content"))


NAME = "CAST(53390000 + s AS VARCHAR) || CASE WHEN s % 2 = 1 THEN '.zip' ELSE '_bldg_6697_op.zip' END"
SUP = f"z AS (SELECT s_suppkey AS s, {NAME.replace('+ s ', '+ s_suppkey ').replace('s % 2', 's_suppkey % 2')} AS archive FROM supplier)"
MODEL = """, model AS (SELECT s, archive, 'udx/bldg/' || (53390000 + s + m) || '_bldg_6697_op.gml' AS member,
  CAST(53390000 + s + m AS VARCHAR) AS mesh, 100 + (s % 7) * 10 + m AS raw FROM z JOIN (SELECT unnest(range(4)) AS m)
  ON m < 1 + s % 4 WHERE s % 9 <> 8
  UNION ALL SELECT s, archive, 'udx/bldg/sub/' || (53390000 + s) || '_bldg_6697_op.gml', CAST(53390000 + s AS VARCHAR), 1
  FROM z WHERE s % 9 <> 8 AND s % 5 = 0)"""


@query("src_04_zip_members", f"WITH {SUP} SELECT archive, CAST(53390000 + s AS VARCHAR) || '.osm' AS member, "
       "'<osm><node id=\"-' || s || '\"/></osm>' AS body FROM z WHERE s % 9 <> 8")
def _(spark, sf):
    return archives.members(_zips(spark, sf), ".osm").select(
        "archive", "member", F.decode("content", "UTF-8").alias("body"))


@query("src_04_bad_archives", f"WITH {SUP} SELECT archive FROM z WHERE s % 9 = 8")
def _(spark, sf):
    zips = _zips(spark, sf)
    return archives.bad_archives(zips, archives.directory(zips))


@query("src_05_zip_inventory", f"WITH {SUP}{MODEL} SELECT archive, member, mesh AS mesh_code, raw FROM model")
def _(spark, sf):
    return archives.model_members(archives.directory(_zips(spark, sf))).select("archive", "member", "mesh_code", "raw")


@query("src_06_extraction_checks", f"""WITH {SUP}{MODEL}
SELECT archive, split_part(member, '/', -1) AS basename, count(*) AS uses, false AS wrong_size FROM model GROUP BY 1, 2
 HAVING count(*) > 1""")
def _(spark, sf):
    zips = _zips(spark, sf)
    clashes = archives.basename_clashes(archives.directory(zips))
    wrong = archives.size_mismatches(archives.members(zips, ".gml", fv.ARCHIVE_MEMBER_PREFIX)).select(
        "archive").distinct().withColumn("w", F.lit(True))
    return clashes.join(wrong, "archive", "left").select(
        "archive", "basename", "uses", F.coalesce("w", F.lit(False)).alias("wrong_size"))


@query("agg_12_inventory_totals", f"""WITH {SUP}{MODEL}
SELECT archive, count(*) AS meshes, CAST(sum(raw) AS BIGINT) AS raw, string_agg(mesh, ' ' ORDER BY mesh) AS mesh_codes
 FROM model GROUP BY 1""")
def _(spark, sf):
    rows = archives.inventory(archives.directory(_zips(spark, sf)))
    return rows.select("archive", "meshes", "raw", F.array_join("mesh_codes", " ").alias("mesh_codes"))


@query("flt_26_mesh_from_file_name", f"""WITH {SUP} SELECT archive, CAST(53390000 + s AS VARCHAR) AS mesh,
 CAST(53390000 + s AS VARCHAR) AS leading FROM z""")
def _(spark, sf):
    return _zips(spark, sf).select("archive", text.mesh_from_file_name(F.col("archive")).alias("mesh"),
                                   text.leading_digits(F.col("archive")).alias("leading"))


@query("flt_27_archive_size", """SELECT page_id FROM pages WHERE strlen(html) > 1000""")
def _(spark, sf):
    rows = ft.table(spark, sf, "pages").select("page_id", F.octet_length("html").alias("length"))
    return archives.big_enough(rows).select("page_id")


# ---- catalogues in HTML --------------------------------------------------

def _pages(spark, sf):
    """Each page gets a script with two cities and two meshes: strict JSON, script
    style or none, and a link to the archive of the first mesh."""
    p = F.col("page_id")
    code, mesh = F.lpad((p % 99999).cast("string"), 5, "0"), (F.lit(53390000) + p).cast("string")

    def two(name, fields):
        def obj(shift, quote):
            items = [F.concat(F.lit(quote + k + quote + ":"), v(shift, quote)) for k, v in fields]
            return F.concat(F.lit("{"), F.concat_ws(",", *items), F.lit("}"))

        strict = F.concat(F.lit(f"const {name} = ["), obj(0, '"'), F.lit(","), obj(1, '"'), F.lit("];"))
        loose = F.concat(F.lit(f"const {name} = ["), obj(0, "'"), F.lit(","), obj(1, "'"), F.lit("];"))
        return F.when(p % 3 == 0, strict).when(p % 3 == 1, loose).otherwise("")

    def quoted(value):
        return lambda shift, q: F.concat(F.lit(q), value(shift), F.lit(q))

    cities = two("cities", [
        ("citycode", quoted(lambda s: F.concat(code, F.lit("" if s == 0 else "7")))),
        ("cityname", quoted(lambda s: F.concat(F.lit("city "), p.cast("string")))),
        ("folder", quoted(lambda s: F.when(p % 4 == 0, "").otherwise(F.concat(F.lit("f"), p.cast("string"))))),
        ("status", quoted(lambda s: F.lit("open")))])
    meshes = two("meshes", [
        ("meshcode", quoted(lambda s: F.concat(mesh, F.lit(str(s))))),
        ("status", quoted(lambda s: F.lit("done"))), ("version", quoted(lambda s: F.lit(f"v{s}")))])
    link = F.concat(F.lit('<a href="/data/'), mesh, F.lit('0_bldg_6697_op.zip">zip</a>'))
    return ft.table(spark, sf, "pages").select(
        "page_id", F.concat("html", F.lit("<script>"), cities, meshes, F.lit("</script>"), link).alias("html"))


CITIES = """SELECT page_id, CAST(s AS INTEGER) AS pos, lpad(CAST(page_id % 99999 AS VARCHAR), 5, '0') || CASE WHEN s = 1
 THEN '7' ELSE '' END AS citycode, 'city ' || page_id AS cityname, CASE WHEN page_id % 4 = 0 THEN CASE WHEN page_id % 3 = 0
 THEN '' END ELSE 'f' || page_id END AS folder, 'open' AS status
 FROM pages, (SELECT unnest(range(2)) AS s) WHERE page_id % 3 < 2"""


@query("src_10_city_catalogue", CITIES)
def _(spark, sf):
    return catalogue.cities(_pages(spark, sf)).drop("lng", "lat")


MESHES = """SELECT page_id, CAST(s AS INTEGER) AS pos, (53390000 + page_id) || '' || s AS meshcode, 'done' AS status,
 'v' || s AS version FROM pages, (SELECT unnest(range(2)) AS s) WHERE page_id % 3 < 2"""


@query("src_11_mesh_catalogue", MESHES)
def _(spark, sf):
    return catalogue.meshes(_pages(spark, sf))


@query("src_12_archive_links", """SELECT page_id, '/data/' || (53390000 + page_id) || '0_bldg_6697_op.zip' AS url,
 (53390000 + page_id) || '0' AS meshcode FROM pages""")
def _(spark, sf):
    return catalogue.archive_links(_pages(spark, sf))


@query("src_12_all_links", """SELECT page_id, count(*) AS links FROM (SELECT page_id, unnest(regexp_extract_all(html,
 'href="([^"]*)"', 1)) AS u FROM pages) GROUP BY 1""")
def _(spark, sf):
    rows = ft.table(spark, sf, "pages").select("page_id", F.explode(F.regexp_extract_all(
        "html", F.lit('href="([^"]*)"'), 1)).alias("u"))
    return rows.groupBy("page_id").agg(F.count("*").alias("links"))


@query("join_16_download_urls", """SELECT page_id, (53390000 + page_id) || '' || s AS meshcode, CASE WHEN s = 0 THEN
 '/data/' || (53390000 + page_id) || '0_bldg_6697_op.zip' WHEN page_id % 4 <> 0 THEN 'https://example.org/f' || page_id ||
 '/bldg/' || (53390000 + page_id) || '1_bldg_6697_op.zip' END AS download_url
 FROM pages, (SELECT unnest(range(2)) AS s) WHERE page_id % 3 < 2""")
def _(spark, sf):
    pages = _pages(spark, sf)
    folder = F.when(F.col("page_id") % 4 != 0, F.concat(F.lit("f"), F.col("page_id").cast("string"))).otherwise("")
    return catalogue.with_download_url(
        catalogue.meshes(pages), catalogue.archive_links(pages), "https://example.org", folder).select(
        "page_id", "meshcode", "download_url")


@query("flt_25_city_search", f"SELECT page_id, citycode FROM ({CITIES}) WHERE contains(cityname, '12') OR contains(citycode, '12')")
def _(spark, sf):
    return catalogue.search_cities(catalogue.cities(_pages(spark, sf)), "12").select("page_id", "citycode")


# ---- packages and plans --------------------------------------------------

PACK = """pack AS (SELECT p_partkey AS v, 'plateau-' || lpad(CAST(CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INTEGER) + 13100
 AS VARCHAR), 5, '0') || '-city-' || (2000 + p_size) AS package, lpad(CAST(CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS
 INTEGER) + 13100 AS VARCHAR), 5, '0') AS city_code, 2000 + p_size AS year, p_partkey % 3 <> 0 AS model,
 p_partkey % 11 <> 0 AS proper FROM part)"""


def _resources(spark, sf):
    brand = F.regexp_extract("p_brand", "([0-9]+)", 1).cast("int") + 13100
    k = F.col("p_partkey")
    package = F.concat(F.when(k % 11 != 0, "plateau-").otherwise("other-"), F.lpad(brand.cast("string"), 5, "0"),
                       F.lit("-city-"), (F.lit(2000) + F.col("p_size")).cast("string"))
    resource = F.when(k % 3 != 0, F.concat(F.lit(" CityGML（v"), k.cast("string"), F.lit("）"))).otherwise("3D Tiles")
    return ft.table(spark, sf, "part").select(package.alias("package"), resource.alias("resource"),
                                              F.concat(F.lit("u"), k.cast("string")).alias("url"))


@query("src_14_package_names", f"""WITH {PACK} SELECT v AS k, CASE WHEN proper THEN city_code END AS city_code,
 CASE WHEN proper THEN 'city' END AS slug, CAST(CASE WHEN proper THEN year END AS INTEGER) AS year,
 CAST(CASE WHEN model THEN v END AS INTEGER) AS citygml_v FROM pack""")
def _(spark, sf):
    rows = _resources(spark, sf)
    return rows.select(F.substring("url", 2, 20).cast("bigint").alias("k"),
                       catalogue.parse_package(F.col("package")).alias("p"),
                       catalogue.resource_version(F.col("resource")).alias("citygml_v")).select("k", "p.*", "citygml_v")


BEST = """best AS (SELECT city_code, package, year, v, row_number() OVER (PARTITION BY city_code ORDER BY year DESC, package DESC,
 v DESC) AS rn FROM pack WHERE model AND proper)"""


@query("win_06_latest_package", f"""WITH {PACK}, {BEST} SELECT city_code, package, CAST(year AS INTEGER) AS year,
 CAST(v AS INTEGER) AS citygml_v, 'u' || v AS url FROM best WHERE rn = 1""")
def _(spark, sf):
    return catalogue.latest_packages(_resources(spark, sf))


@query("src_13_plan_csv", f"""WITH {PACK}, {BEST} SELECT city_code, package, CAST(year AS INTEGER) AS year,
 CAST(v AS INTEGER) AS citygml_v, CAST(v * 10 AS BIGINT) AS bytes, 'u' || v AS url FROM best WHERE rn = 1""")
def _(spark, sf):
    path = new_folder(spark, "plan")
    plans.write_plan(catalogue.latest_packages(_resources(spark, sf)).withColumn("bytes", F.col("citygml_v") * 10), path)
    return plans.read_plan(spark, path)


@query("join_20_plan_upsert", f"""WITH {PACK}, {BEST},
old AS (SELECT DISTINCT lpad(CAST(13095 + n_nationkey AS VARCHAR), 5, '0') AS city_code FROM nation)
SELECT coalesce(b.city_code, old.city_code) AS city_code, coalesce(b.package, 'kept') AS package,
 CAST(coalesce(b.year, 1999) AS INTEGER) AS year FROM old FULL JOIN (SELECT * FROM best WHERE rn = 1) b
 ON b.city_code = old.city_code""")
def _(spark, sf):
    old = ft.table(spark, sf, "nation").select(
        F.lpad((F.lit(13095) + F.col("n_nationkey")).cast("string"), 5, "0").alias("city_code"),
        F.lit("kept").alias("package"), F.lit(1999).alias("year"), F.lit(1).alias("citygml_v"),
        F.lit(0).cast("bigint").alias("bytes"), F.lit("u").alias("url"))
    new = catalogue.latest_packages(_resources(spark, sf)).withColumn("bytes", F.lit(1).cast("bigint"))
    return plans.upsert_plan(old, new).select("city_code", "package", "year")


# ---- inventories ---------------------------------------------------------

def _available(spark, sf):
    return ft.table(spark, sf, "part").select((F.lit(53390000) + F.col("p_partkey") % 700).cast("string").alias("meshcode"))


AVAIL = "a AS (SELECT CAST(53390000 + p_partkey % 700 AS VARCHAR) AS meshcode FROM part)"
HELD = "h AS (SELECT DISTINCT CAST(53390000 + s_suppkey AS VARCHAR) AS meshcode FROM supplier)"


@query("join_15_held_meshes", f"""WITH {AVAIL}, {HELD} SELECT *, round(matched / available * 100, 6) AS completion_rate FROM (
SELECT (SELECT count(*) FROM a) AS available, count(*) FILTER (WHERE h.meshcode IS NOT NULL) AS matched,
 count(*) FILTER (WHERE h.meshcode IS NULL) AS missing FROM (SELECT DISTINCT meshcode FROM a) d LEFT JOIN h USING (meshcode))""")
def _(spark, sf):
    held = inventory.held_meshes(_zips(spark, sf), "archive")
    return inventory.completion(_available(spark, sf), held).withColumn(
        "completion_rate", F.round("completion_rate", 6))


@query("set_02_mesh_sets", f"""WITH {AVAIL}, {HELD} SELECT meshcode, 'both' AS kind FROM (SELECT meshcode FROM a INTERSECT
 SELECT meshcode FROM h) UNION ALL SELECT meshcode, 'missing' FROM (SELECT meshcode FROM a EXCEPT SELECT meshcode FROM h)""")
def _(spark, sf):
    available, held = _available(spark, sf), inventory.held_meshes(_zips(spark, sf), "archive")
    return available.intersect(held).withColumn("kind", F.lit("both")).unionByName(
        available.subtract(held).withColumn("kind", F.lit("missing")))


RESULTS = """res AS (SELECT event_id, event_type <> 'error' AS ok, CASE event_id % 4 WHEN 0 THEN 'timeout: read' WHEN 1 THEN
 'file_not_found' ELSE 'http:50' || event_id % 3 END AS reason, event_id % 5000 AS bytes FROM events)"""


def _results(spark, sf):
    e = F.col("event_id")
    reason = (F.when(e % 4 == 0, "timeout: read").when(e % 4 == 1, "file_not_found")
              .otherwise(F.concat(F.lit("http:50"), (e % 3).cast("string"))))
    return ft.table(spark, sf, "events").select(
        e.cast("string").alias("meshcode"), (F.col("event_type") != "error").alias("ok"), reason.alias("reason"),
        (e % 5000).alias("bytes"))


@query("snk_08_download_report", f"""WITH {RESULTS} SELECT count(*) FILTER (WHERE ok) AS succeeded, count(*) FILTER
 (WHERE NOT ok) AS failed, CAST(sum(bytes) FILTER (WHERE ok) AS BIGINT) AS total_bytes,
 round(count(*) FILTER (WHERE ok) / count(*) * 100, 6) AS success_rate FROM res""")
def _(spark, sf):
    report = inventory.download_report(_results(spark, sf)).withColumn("success_rate", F.round("success_rate", 6))
    return maintenance.written_json(report, "download-report")


@query("agg_13_failure_types", f"""WITH {RESULTS} SELECT split_part(reason, ':', 1) AS failure, count(*) AS n FROM res
 WHERE NOT ok GROUP BY 1""")
def _(spark, sf):
    return inventory.failure_counts(_results(spark, sf))


@query("join_23_mesh_growth", fs.with_ctes(fs.POS, fs.BLD, body="""
SELECT coalesce(a.city_code, h.city_code) AS city_code, coalesce(a.mesh, h.mesh) AS mesh_code,
 CASE WHEN h.mesh IS NULL THEN 'new' WHEN a.mesh IS NULL THEN 'gone' ELSE 'known' END AS status
FROM (SELECT DISTINCT CAST(13101 + s_suppkey % 30 AS VARCHAR) AS city_code, CAST(53390000 + s_suppkey % 5 AS VARCHAR) AS mesh
  FROM supplier) a FULL JOIN (SELECT DISTINCT city_code, mesh FROM b WHERE source_dataset LIKE 'plateau%') h
 ON a.city_code = h.city_code AND a.mesh = h.mesh"""))
def _(spark, sf):
    s = F.col("s_suppkey")
    listed = ft.table(spark, sf, "supplier").select(
        (F.lit(13101) + s % 30).cast("string").alias("city_code"),
        (F.lit(53390000) + s % 5).cast("string").alias("mesh_code"))
    return inventory.mesh_growth(listed, ft.stored_buildings(spark, sf))


FILES = """SELECT CAST(13101 + o_orderkey % 22 AS VARCHAR) AS city_code, o_orderkey AS k FROM orders"""


@query("join_24_manifest_check", f"""SELECT city_code, CASE WHEN city_code % 5 <> 0 THEN found - CASE WHEN city_code % 4 = 0
 THEN 1 ELSE 0 END END AS declared, found, city_code % 5 <> 0 AND city_code % 4 <> 0 AS passed FROM
 (SELECT CAST(city_code AS INTEGER) AS cc, city_code, count(*) AS found FROM ({FILES}) GROUP BY ALL)""".replace(
    "city_code % ", "cc % "))
def _(spark, sf):
    rows = ft.table(spark, sf, "orders").select(
        (F.lit(13101) + F.col("o_orderkey") % 22).cast("string").alias("city_code"))
    c = F.col("city_code").cast("int")
    manifest = rows.groupBy("city_code").count().select("city_code", F.when(c % 5 == 0, "x1").otherwise(F.concat(
        F.lit(" "), (F.col("count") - F.when(c % 4 == 0, 1).otherwise(0)).cast("string"), F.lit("\n"))).alias("declared"))
    return inventory.manifest_check(rows, manifest)


@query("flt_28_conversion_check", """SELECT city_code, osm, gml, empty, unclosed, osm = gml AND empty = 0 AND unclosed = 0 AS passed
FROM (SELECT CAST(13101 + page_id % 22 AS VARCHAR) AS city_code, count(*) FILTER (WHERE page_id % 9 <> 1) AS osm, count(*) AS gml,
 count(*) FILTER (WHERE page_id % 9 <> 1 AND page_id % 31 = 5) AS empty, count(*) FILTER (WHERE page_id % 9 <> 1 AND
 page_id % 31 <> 5 AND NOT regexp_matches(html, '</html>\\s*$')) AS unclosed FROM pages GROUP BY 1)""")
def _(spark, sf):
    p = F.col("page_id")
    pages = ft.table(spark, sf, "pages").withColumn("city_code", (F.lit(13101) + p % 22).cast("string"))
    osm = pages.filter(p % 9 != 1).select(
        "city_code", F.concat(p.cast("string"), F.lit(".osm")).alias("name"),
        F.when(p % 31 == 5, 0).otherwise(F.octet_length("html")).alias("length"),
        F.col("html").rlike(r"</html>\s*$").alias("closed"))
    gml = pages.select("city_code", F.concat(p.cast("string"), F.lit(".gml")).alias("name"),
                       F.lit(1).alias("length"), F.lit(True).alias("closed"))
    return inventory.conversion_check(osm.unionByName(gml))
