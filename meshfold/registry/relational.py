"""Aggregates, joins, windows, sorts and set operations over the stored tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from meshfold.functions import text
from meshfold.operators import runlog, statistics
from meshfold.registry import fixture_sql as fs
from meshfold.registry import fixture_tables as ft
from meshfold.registry.core import query

BN = fs.with_ctes(fs.POS, fs.BLD, fs.NODES, body="")
CODE = "nullif(regexp_extract(source_dataset, 'plateau_([0-9]{5})_', 1), '')"


def stored(spark, sf):
    return ft.stored_buildings(spark, sf)


def nodes(spark, sf):
    return ft.stored_nodes(spark, sf)


# ---- sources over stored tables -------------------------------------------

@query("src_09_table_scan", BN + """SELECT 'buildings' AS source, city_code, count(*) AS n FROM b GROUP BY ALL
UNION ALL SELECT 'nodes', city_code, count(*) FROM n GROUP BY ALL""")
def _(spark, sf):
    b = stored(spark, sf).groupBy(F.lit("buildings").alias("source"), "city_code")
    n = nodes(spark, sf).groupBy(F.lit("nodes").alias("source"), "city_code")
    return b.agg(F.count("*").alias("n")).unionByName(n.agg(F.count("*").alias("n")))


@query("src_09_city_pruned_scan", fs.on_buildings(
    "SELECT id, building, height FROM b WHERE city_code = '13105'"))
def _(spark, sf):
    return stored(spark, sf).filter("city_code = '13105'").select("id", "building", "height")


# ---- aggregates ----------------------------------------------------------

@query("agg_01_outline_statistics", BN + """SELECT count(*) AS buildings, count(height) AS with_height,
  round(avg(height), 6) AS avg_height, max(height) AS max_height, (SELECT count(*) FROM n) AS nodes
  FROM b WHERE building_part IS NULL""")
def _(spark, sf):
    return statistics.outline_statistics(stored(spark, sf), nodes(spark, sf)).withColumn(
        "avg_height", F.round("avg_height", 6))


@query("agg_02_by_dataset", fs.on_buildings(
    "SELECT source_dataset, count(*) AS buildings FROM b GROUP BY 1"))
def _(spark, sf):
    return statistics.by_dataset(stored(spark, sf))


@query("agg_03_validity_rate", fs.on_shapes("""
SELECT count(*) FILTER (WHERE shape <> 3) AS valid, count(*) FILTER (WHERE shape = 3) AS invalid, count(*) AS total,
 round(count(*) FILTER (WHERE shape <> 3) / count(*) * 100, 6) AS validity_rate FROM s WHERE area2 IS NOT NULL"""))
def _(spark, sf):
    return statistics.validity(stored(spark, sf)).withColumn("validity_rate", F.round("validity_rate", 6))


@query("agg_04_id_ranges", BN + """SELECT (SELECT min(id) FROM b) AS min_building, (SELECT max(id) FROM b) AS
 max_building, min(osm_id) AS min_node, max(osm_id) AS max_node FROM n WHERE osm_id < 0""")
def _(spark, sf):
    return statistics.id_ranges(stored(spark, sf), nodes(spark, sf))


@query("agg_06_city_distribution", fs.on_buildings(
    f"SELECT {CODE} AS city_code, count(*) AS buildings FROM b WHERE {CODE} IS NOT NULL GROUP BY 1"))
def _(spark, sf):
    return statistics.city_distribution(stored(spark, sf))


@query("agg_07_extraction_quality", fs.on_buildings(f"""
SELECT count(*) FILTER (WHERE {CODE} IS NOT NULL) AS extractable,
 count(*) FILTER (WHERE source_dataset IS NULL) AS missing,
 count(*) FILTER (WHERE source_dataset IS NOT NULL AND {CODE} IS NULL) AS failed FROM b"""))
def _(spark, sf):
    return statistics.extraction_quality(stored(spark, sf))


@query("agg_07_failed_samples", fs.on_buildings(f"""
SELECT source_dataset, count(*) AS buildings FROM b WHERE source_dataset IS NOT NULL AND {CODE} IS NULL
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""))
def _(spark, sf):
    return statistics.failed_extractions(stored(spark, sf))


@query("agg_08_purge_preview", BN + """SELECT b.city_code, count(DISTINCT b.id) AS buildings, count(n.id) AS nodes
 FROM b LEFT JOIN n ON n.building_id = b.id GROUP BY 1""")
def _(spark, sf):
    from meshfold.operators import maintenance

    return maintenance.purge_preview(stored(spark, sf), nodes(spark, sf))


@query("agg_11_coverage_status", fs.on_buildings("""
SELECT city_code, count(*) AS building_count, (SELECT count(DISTINCT city_code) FROM b WHERE building_part IS NULL)
 AS city_count FROM b WHERE building_part IS NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5"""))
def _(spark, sf):
    from meshfold.operators import coverage

    counts = coverage.city_counts(stored(spark, sf))
    top = counts.orderBy(F.desc("building_count"), "city_code").limit(5)
    return top.join(counts.agg(F.count("*").alias("city_count")))


@query("agg_17_import_gate", fs.on_buildings(
    "SELECT count(*) AS buildings, count(*) > 0 AS passed FROM b WHERE city_code = '13110'"))
def _(spark, sf):
    return statistics.import_gate(stored(spark, sf), "13110")


@query("agg_18_unmigrated_count", fs.on_buildings(f"""
SELECT count(*) FILTER (WHERE {CODE} IS NULL) AS unmigrated, count(*) AS total FROM b"""))
def _(spark, sf):
    code = text.city_from_dataset(F.col("source_dataset"))
    return stored(spark, sf).agg(F.count_if(code.isNull()).alias("unmigrated"), F.count("*").alias("total"))


@query("agg_19_imported_cities", fs.on_buildings("""
SELECT DISTINCT regexp_extract(source_dataset, '([0-9]{5})', 1) AS city_code FROM b
WHERE source_dataset IS NOT NULL AND regexp_matches(source_dataset, '[0-9]{5}')"""))
def _(spark, sf):
    return statistics.imported_cities(stored(spark, sf))


@query("agg_20_ordered_nodes", BN + """SELECT building_id, count(*) AS n_nodes,
 string_agg(coalesce(CAST(ring_id AS VARCHAR), '-') || ':' || sequence_id || ':' || osm_id, ' '
   ORDER BY ring_id NULLS LAST, sequence_id) AS node_list FROM n GROUP BY 1""")
def _(spark, sf):
    rows = statistics.ordered_nodes(nodes(spark, sf))
    return rows.select(
        "building_id", F.size("nodes").cast("bigint").alias("n_nodes"),
        F.array_join(F.transform("nodes", lambda s: F.concat_ws(
            ":", F.coalesce(s["ring_id"].cast("string"), F.lit("-")), s["sequence_id"].cast("string"),
            s["osm_id"].cast("string"))), " ").alias("node_list"))


# ---- joins ---------------------------------------------------------------

@query("join_12_left_join_nodes", BN + """SELECT b.id, count(n.id) AS n_nodes, min(n.id) AS first_node
 FROM b LEFT JOIN n ON n.building_id = b.id GROUP BY 1""")
def _(spark, sf):
    rows = statistics.with_nodes(stored(spark, sf).select("id"), nodes(spark, sf))
    ids = F.transform("nodes", lambda s: s["id"])
    return rows.select("id", F.coalesce(F.size("nodes"), F.lit(0)).cast("bigint").alias("n_nodes"),
                       F.array_min(ids).alias("first_node"))


@query("join_13_orphan_nodes", BN + """SELECT n.building_id, count(*) AS orphans FROM n
 WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.id = n.building_id AND b.source_dataset IS NOT NULL) GROUP BY 1""")
def _(spark, sf):
    held = stored(spark, sf).filter("source_dataset is not null")
    return statistics.orphan_nodes(nodes(spark, sf), held).groupBy("building_id").agg(
        F.count("*").alias("orphans"))


@query("join_14_nodes_of_city", BN + """SELECT n.id, n.building_id FROM n WHERE n.building_id IN
 (SELECT id FROM b WHERE city_code = '13103')""")
def _(spark, sf):
    return statistics.nodes_of_city(nodes(spark, sf), stored(spark, sf), "13103").select("id", "building_id")


EXPECTED = "SELECT DISTINCT CAST(13095 + n_nationkey AS VARCHAR) AS city_code FROM nation"


def _expected(spark, sf):
    return ft.table(spark, sf, "nation").select(
        (F.lit(13095) + F.col("n_nationkey")).cast("string").alias("city_code"))


@query("join_17_expected_cities", fs.on_buildings(f"""
SELECT coalesce(e.city_code, f.city_code) AS city_code, CASE WHEN f.city_code IS NULL THEN 'missing'
  WHEN e.city_code IS NULL THEN 'unexpected' ELSE 'matched' END AS status
FROM ({EXPECTED}) e FULL JOIN (SELECT DISTINCT {CODE} AS city_code FROM b WHERE {CODE} IS NOT NULL) f
  ON e.city_code = f.city_code"""))
def _(spark, sf):
    return statistics.compare_cities(_expected(spark, sf), statistics.city_distribution(stored(spark, sf)))


@query("join_18_targets_without_boundary", fs.with_ctes(fs.POS, fs.BLD, fs.MASTER, body="""
SELECT t.city_code FROM (SELECT DISTINCT city_code FROM b) t LEFT JOIN m
 ON m.city_code = t.city_code AND m.has_boundary WHERE m.city_code IS NULL"""))
def _(spark, sf):
    targets = stored(spark, sf).select("city_code").distinct()
    with_boundary = ft.city_master(spark, sf).filter("boundary is not null")
    return targets.join(with_boundary, "city_code", "left_anti")


@query("join_19_targets_without_input", fs.on_buildings(
    f"{EXPECTED} EXCEPT SELECT city_code FROM b"))
def _(spark, sf):
    return _expected(spark, sf).subtract(stored(spark, sf).select("city_code"))


@query("set_03_city_code_sets", fs.on_buildings(f"""
SELECT city_code, 'union' AS kind FROM ({EXPECTED} UNION SELECT city_code FROM b)
UNION ALL SELECT city_code, 'only_found' FROM (SELECT city_code FROM b EXCEPT {EXPECTED})"""))
def _(spark, sf):
    found, expected = stored(spark, sf).select("city_code"), _expected(spark, sf)
    return found.union(expected).distinct().withColumn("kind", F.lit("union")).unionByName(
        found.subtract(expected).withColumn("kind", F.lit("only_found")))


@query("set_04_distinct_datasets", fs.on_buildings("SELECT DISTINCT source_dataset FROM b"))
def _(spark, sf):
    return stored(spark, sf).select("source_dataset").distinct()


# ---- run logs ------------------------------------------------------------

RUNS = """SELECT event_id // 500 AS run_id, event_id % 500 + 1 AS seq, event_type = 'error' AS failed,
  CAST(13095 + user_id % 40 AS VARCHAR) AS city_code FROM events"""


def _log(spark, sf):
    e = ft.table(spark, sf, "events")
    return e.select(
        F.floor(F.col("event_id") / 500).alias("run_id"), (F.col("event_id") % 500 + 1).alias("seq"),
        (F.col("event_type") == "error").alias("failed"),
        (F.lit(13095) + F.col("user_id") % 40).cast("string").alias("city_code"))


@query("win_08_failure_bursts", """SELECT event_id + 1 AS seq, CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END)
  OVER (ORDER BY event_id ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS BIGINT) AS recent_failures,
  sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (ORDER BY event_id ROWS BETWEEN 11 PRECEDING AND
  CURRENT ROW) >= 3 AS burst FROM events""")
def _(spark, sf):
    e = ft.table(spark, sf, "events").select(
        F.lit(0).alias("run_id"), (F.col("event_id") + 1).alias("seq"),
        (F.col("event_type") == "error").alias("failed"))
    return runlog.failure_bursts(e, bucket=1000).select("seq", "recent_failures", "burst")


@query("win_07_consecutive_failures", f"""
SELECT run_id, min(seq) AS first_seq, max(seq) AS last_seq, count(*) AS failures FROM (
  SELECT *, count(*) FILTER (WHERE NOT failed) OVER (PARTITION BY run_id ORDER BY seq) AS island FROM ({RUNS}))
WHERE failed GROUP BY run_id, island""")
def _(spark, sf):
    return runlog.failure_runs(_log(spark, sf), bucket=100)


@query("win_07_early_abort", f"""
SELECT run_id, count(*) AS lines, min(seq) FILTER (WHERE NOT failed) AS first_success,
  count(*) >= 2 AND coalesce(min(seq) FILTER (WHERE NOT failed) > 2, true) AS aborted,
  CASE WHEN count(*) >= 2 AND coalesce(min(seq) FILTER (WHERE NOT failed) > 2, true) THEN min(seq) + 1 END AS abort_seq
FROM ({RUNS}) GROUP BY run_id""")
def _(spark, sf):
    return runlog.early_abort(_log(spark, sf), 2)


DONE = "SELECT DISTINCT CAST(13095 + n_nationkey AS VARCHAR) AS city_code FROM nation WHERE n_regionkey <> 2"


def _done(spark, sf):
    return ft.table(spark, sf, "nation").filter("n_regionkey <> 2").select(
        (F.lit(13095) + F.col("n_nationkey")).cast("string").alias("city_code"))


@query("agg_14_batch_totals", f"""
SELECT run_id, count(*) AS total, count(*) FILTER (WHERE d.city_code IS NOT NULL) AS skipped,
 count(*) FILTER (WHERE d.city_code IS NULL AND NOT failed) AS ok,
 count(*) FILTER (WHERE d.city_code IS NULL AND failed) AS failed
FROM ({RUNS}) l LEFT JOIN ({DONE}) d USING (city_code) GROUP BY run_id""")
def _(spark, sf):
    return runlog.batch_totals(_log(spark, sf), _done(spark, sf))


@query("join_22_resume_targets", fs.on_buildings(f"""
SELECT city_code FROM (SELECT DISTINCT city_code FROM b) WHERE city_code NOT IN ({DONE})
 AND city_code NOT IN (SELECT city_code FROM b WHERE id % 997 = 0)"""))
def _(spark, sf):
    targets = stored(spark, sf).select("city_code").distinct()
    fixed = stored(spark, sf).filter("id % 997 = 0").select("city_code").distinct()
    return runlog.resume_targets(targets, _done(spark, sf), fixed)


@query("snk_09_batch_report", f"""
SELECT run_id, count(*) AS total, count(*) FILTER (WHERE NOT failed) AS success, count(*) FILTER (WHERE failed) AS failed
FROM ({RUNS}) GROUP BY run_id""")
def _(spark, sf):
    from meshfold.operators import maintenance

    report = runlog.batch_totals(_log(spark, sf)).select(
        "run_id", "total", F.col("ok").alias("success"), "failed")
    return maintenance.written_json(report, "batch-report")


# ---- sorts ---------------------------------------------------------------

@query("srt_02_final_order", fs.on_buildings(
    "SELECT osm_id, row_number() OVER (ORDER BY osm_id) AS place FROM b"))
def _(spark, sf):
    from meshfold.functions.ids import dense_ids

    return dense_ids(stored(spark, sf).select("osm_id"), ["osm_id"], 1, "place")


@query("srt_03_top_rows", fs.on_buildings("""
(SELECT 'coverage' AS list, city_code AS item, count(*) AS n FROM b WHERE building_part IS NULL GROUP BY 2
 ORDER BY n DESC, item LIMIT 5)
UNION ALL (SELECT 'failed', source_dataset, count(*) AS n FROM b WHERE source_dataset LIKE 'import%' GROUP BY 2
 ORDER BY n DESC, source_dataset LIMIT 10)"""))
def _(spark, sf):
    from meshfold.operators import coverage

    top = coverage.city_counts(stored(spark, sf)).orderBy(F.desc("building_count"), "city_code").limit(5)
    failed = statistics.failed_extractions(stored(spark, sf))
    return top.select(F.lit("coverage").alias("list"), F.col("city_code").alias("item"),
                      F.col("building_count").alias("n")).unionByName(
        failed.select(F.lit("failed").alias("list"), F.col("source_dataset").alias("item"),
                      F.col("buildings").alias("n")))


@query("srt_05_large_cities_last", fs.on_buildings("""
SELECT city_code, n >= 682 AS is_large, row_number() OVER (ORDER BY n >= 682, city_code) AS place
FROM (SELECT city_code, count(*) AS n FROM b GROUP BY 1)"""))
def _(spark, sf):
    from meshfold.functions.ids import dense_ids

    counts = stored(spark, sf).groupBy("city_code").agg(F.count("*").alias("n"))
    targets = counts.select("city_code", F.col("city_code").alias("pos"))
    ordered = runlog.small_first(targets, counts.filter("n >= 682"))
    return dense_ids(ordered, ["is_large", "pos"], 1, "place").select("city_code", "is_large", "place")


@query("srt_06_cities_by_code", fs.on_buildings("""
SELECT city_code, row_number() OVER (ORDER BY city_code) AS place FROM (SELECT DISTINCT city_code FROM b)"""))
def _(spark, sf):
    from meshfold.functions.ids import dense_ids

    return dense_ids(stored(spark, sf).select("city_code").distinct(), ["city_code"], 1, "place")
