"""Stored tables kept city by city: replace, purge, cascade, backfill, audit.

``city_code`` is the partition column, so replacing or purging a city rewrites
only that city's folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meshfold.functions import text
from meshfold.session import cut_lineage, new_folder

HISTORY = T.StructType([
    T.StructField("city_code", T.StringType(), False),
    T.StructField("buildings_deleted", T.LongType(), False),
    T.StructField("nodes_deleted", T.LongType(), False),
    T.StructField("executed_at", T.TimestampType(), False),
    T.StructField("executed_by", T.StringType()),
    T.StructField("hostname", T.StringType()),
    T.StructField("duration_seconds", T.FloatType()),
])


# ---- writing -------------------------------------------------------------

def _spread_by_city(df: DataFrame, order: list[str]) -> DataFrame:
    """Range partitions split a huge city over several files and pack small ones."""
    return df.repartitionByRange("city_code", *order).sortWithinPartitions("city_code", *order)


def write_table(df: DataFrame, path: str, order: list[str], mode: str = "errorifexists", file_rows: int = 0) -> None:
    """``file_rows``: rows of a file at most, 0 for any number."""
    (_spread_by_city(df, order).write.mode(mode).option("maxRecordsPerFile", file_rows)
     .partitionBy("city_code").parquet(path))


def replace_cities(df: DataFrame, path: str, order: list[str], cities: DataFrame | None = None, file_rows: int = 0) -> None:
    """Replace the cities in ``df`` and empty those of ``cities`` that have no row in it; all
    other cities stay as they are."""
    (_spread_by_city(df, order).write.mode("overwrite").option("maxRecordsPerFile", file_rows)
     .option("partitionOverwriteMode", "dynamic").partitionBy("city_code").parquet(path))
    if cities is not None:
        empty_cities(cities, df, path)


def empty_cities(cities: DataFrame, df: DataFrame, path: str) -> None:
    """Remove the stored rows of those ``cities`` that ``df`` has no row of."""
    gone = cities.select("city_code").distinct().join(df.select("city_code"), "city_code", "left_anti")
    for row in gone.where(F.col("city_code").rlike("^[0-9]{5}$")).collect():  # one short text per city
        drop_city(df.sparkSession, path, row.city_code)


def drop_city(spark: SparkSession, path: str, city_code: str) -> None:
    """Remove one city's folder through the file system of the table."""
    if not (len(city_code) == 5 and city_code.isascii() and city_code.isdigit()):
        raise ValueError("city code must be five digits")
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{path}/city_code={city_code}")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(folder):
        fs.delete(folder, True)


def written_json(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write a report as JSON lines in the shared folder and read it back."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.json(path)
    schema = T.StructType([f for f in df.schema if f.name != partition_by]
                          + [f for f in df.schema if f.name == partition_by])
    return spark.read.schema(schema).json(path)


# ---- purge and audit -----------------------------------------------------

def purge_preview(buildings: DataFrame, nodes: DataFrame, city_code: str | None = None) -> DataFrame:
    """Buildings and nodes a purge would remove, per city."""
    b = buildings if city_code is None else buildings.filter(F.col("city_code") == city_code)
    owner = b.select(F.col("id").alias("building_id"), F.col("city_code").alias("_city"))
    n = nodes.groupBy("building_id").agg(F.count("*").alias("_n")).join(owner, "building_id").groupBy(
        F.col("_city").alias("city_code")).agg(F.sum("_n").alias("nodes"))
    counts = b.groupBy("city_code").agg(F.count("*").alias("buildings"))
    return counts.join(n, "city_code", "left").fillna(0, ["nodes"])


def purge_city(buildings_path: str, nodes_path: str, city_code: str, spark: SparkSession) -> DataFrame:
    """Delete a city's nodes, then its buildings; returns both counts (materialised first)."""
    preview = cut_lineage(purge_preview(spark.read.parquet(buildings_path),
                                        spark.read.parquet(nodes_path), city_code))
    drop_city(spark, nodes_path, city_code)
    drop_city(spark, buildings_path, city_code)
    return preview


def append_history(counts: DataFrame, path: str, executed_at: Column, executed_by: str,
                   hostname: str, seconds: float) -> None:
    counts.select(
        "city_code", F.col("buildings").alias("buildings_deleted"), F.col("nodes").alias("nodes_deleted"),
        executed_at.alias("executed_at"), F.lit(executed_by).alias("executed_by"),
        F.lit(hostname).alias("hostname"), F.lit(seconds).cast("float").alias("duration_seconds"),
    ).write.mode("append").parquet(path)


def last_purges(history: DataFrame, city_code: str, k: int = 5) -> DataFrame:
    return history.filter(F.col("city_code") == city_code).orderBy(F.desc("executed_at")).limit(k)


# ---- cascade -------------------------------------------------------------

def cascade_ids(buildings: DataFrame, seeds: DataFrame) -> DataFrame:
    """Seeds and everything below them through ``parent_building_id``.

    Level by level until nothing new appears; the number of rounds is the depth of
    the hierarchy (one in practice), not its size.
    """
    links = buildings.filter(F.col("parent_building_id").isNotNull()).select("id", "parent_building_id")
    found = cut_lineage(seeds.select("id").distinct())
    frontier = found
    while True:
        below = links.join(frontier.select(F.col("id").alias("parent_building_id")),
                           "parent_building_id", "left_semi").select("id")
        frontier = cut_lineage(below.join(found, "id", "left_anti").distinct())
        if frontier.isEmpty():
            return found
        found = cut_lineage(found.unionByName(frontier))


def delete_buildings(buildings: DataFrame, nodes: DataFrame, seeds: DataFrame):
    """(remaining buildings, remaining nodes) after a cascading delete."""
    gone = cascade_ids(buildings, seeds)
    return (buildings.join(gone, "id", "left_anti"),
            nodes.join(gone.select(F.col("id").alias("building_id")), "building_id", "left_anti"))


# ---- schema --------------------------------------------------------------

LATER_COLUMNS = (("building_part", "string"), ("parent_building_id", "bigint"),
                 ("building_ref", "string"))


def evolve_buildings(df: DataFrame) -> DataFrame:
    """Add the columns older files do not have."""
    missing = {c: F.lit(None).cast(t) for c, t in LATER_COLUMNS if c not in df.columns}
    return df.withColumns(missing) if missing else df


def evolve_nodes(df: DataFrame) -> DataFrame:
    """``ring_id`` exists and is never NULL; its default is 0."""
    if "ring_id" not in df.columns:
        return df.withColumn("ring_id", F.lit(0))
    return df.withColumn("ring_id", F.coalesce("ring_id", F.lit(0)))


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    """Files of different ages as one table."""
    return evolve_buildings(spark.read.option("mergeSchema", "true").parquet(path))


def backfill_city(df: DataFrame) -> DataFrame:
    return df.withColumn("city_code", F.coalesce(
        "city_code", text.city_from_dataset(F.col("source_dataset"))))


def require_city(df: DataFrame) -> DataFrame:
    """NOT NULL gate: the job fails on the first row without a city."""
    return df.withColumn("city_code", F.when(F.col("city_code").isNull(), F.raise_error(
        F.lit("city_code is missing"))).otherwise(F.col("city_code")))


def schema_checks(df: DataFrame, required: list[str]) -> DataFrame:
    """One row per required column: is it there, and does any row lack a value?"""
    have = {f.name: f for f in df.schema}
    counted = df.agg(F.count("*").alias("_rows"), *[F.count(c).alias(c) for c in required if c in have])
    rows = [F.struct(F.lit(c).alias("column"), F.lit(c in have).alias("present"),
                     ((F.col("_rows") - F.col(c)) if c in have else F.lit(None).cast("bigint"))
                     .alias("missing_values")) for c in required]
    return counted.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def table_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


# ---- keys ----------------------------------------------------------------

def remap_nodes(nodes: DataFrame, keys: DataFrame):
    """(nodes with the stored building key, nodes whose building was not stored).

    ``keys`` maps osm_id to id.
    """
    mapping = keys.select(F.col("osm_id").alias("building_osm_id"), F.col("id").alias("building_id"))
    return (nodes.join(mapping, "building_osm_id"),
            nodes.join(mapping, "building_osm_id", "left_anti"))


def resolve_parents(pairs: DataFrame, keys: DataFrame) -> DataFrame:
    """(part_osm_id, parent_osm_id) to stored ids; NULL where either is unknown."""
    child = keys.select(F.col("osm_id").alias("part_osm_id"), F.col("id").alias("child_id"))
    parent = keys.select(F.col("osm_id").alias("parent_osm_id"), F.col("id").alias("parent_id"))
    both = pairs.join(child, "part_osm_id", "left").join(parent, "parent_osm_id", "left")
    resolved = F.col("child_id").isNotNull() & F.col("parent_id").isNotNull()
    return both.withColumn("resolved", resolved)
