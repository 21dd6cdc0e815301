"""Counts and checks over the stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshfold import fixed_values as fv
from meshfold.functions import geometry as g
from meshfold.functions import text


def percentage(part: Column, total: Column) -> Column:
    """part / total * 100, 0 for an empty total."""
    return F.when(total > 0, part / total * 100).otherwise(F.lit(0.0))


def outline_statistics(buildings: DataFrame, nodes: DataFrame) -> DataFrame:
    outlines = buildings.filter(F.col("building_part").isNull()).agg(
        F.count("*").alias("buildings"), F.count("height").alias("with_height"),
        F.avg("height").alias("avg_height"), F.max("height").alias("max_height"))
    return outlines.join(nodes.agg(F.count("*").alias("nodes")))


def by_dataset(buildings: DataFrame) -> DataFrame:
    return buildings.groupBy("source_dataset").agg(F.count("*").alias("buildings")).orderBy(
        F.desc("buildings"), "source_dataset")


def validity(buildings: DataFrame) -> DataFrame:
    """valid, invalid, total and the valid share; a NULL geometry is neither."""
    valid = g.is_valid(F.col("rings"), g.edges(F.col("rings")), F.col("area2"))
    counted = buildings.select(valid.alias("valid")).agg(
        F.count_if("valid").alias("valid"), F.count_if(~F.col("valid")).alias("invalid"))
    total = F.col("valid") + F.col("invalid")
    return counted.select("valid", "invalid", total.alias("total"),
                          percentage(F.col("valid"), total).alias("validity_rate"))


def id_ranges(buildings: DataFrame, nodes: DataFrame) -> DataFrame:
    b = buildings.agg(F.min("id").alias("min_building"), F.max("id").alias("max_building"))
    n = nodes.agg(F.min(F.when(F.col("osm_id") < 0, F.col("osm_id"))).alias("min_node"),
                  F.max(F.when(F.col("osm_id") < 0, F.col("osm_id"))).alias("max_node"))
    return b.join(n)


def next_building_id(buildings: DataFrame) -> DataFrame:
    return buildings.agg((F.coalesce(F.max("id"), F.lit(0)) + 1).alias("next_id"))


def extraction_quality(buildings: DataFrame) -> DataFrame:
    found = text.city_from_dataset(F.col("source_dataset")).isNotNull()
    return buildings.agg(
        F.count_if(found).alias("extractable"),
        F.count_if(F.col("source_dataset").isNull()).alias("missing"),
        F.count_if(F.col("source_dataset").isNotNull() & ~found).alias("failed"))


def failed_extractions(buildings: DataFrame, k: int = 10) -> DataFrame:
    return (
        buildings.filter(F.col("source_dataset").isNotNull()
                         & text.city_from_dataset(F.col("source_dataset")).isNull())
        .groupBy("source_dataset").agg(F.count("*").alias("buildings"))
        .orderBy(F.desc("buildings"), "source_dataset").limit(k))


def city_distribution(buildings: DataFrame) -> DataFrame:
    code = text.city_from_dataset(F.col("source_dataset"))
    return (
        buildings.select(code.alias("city_code")).filter("city_code is not null")
        .groupBy("city_code").agg(F.count("*").alias("buildings"))
        .orderBy(F.desc("buildings"), "city_code"))


def imported_cities(buildings: DataFrame) -> DataFrame:
    """Distinct five-digit codes found anywhere in the dataset names."""
    names = buildings.select("source_dataset").distinct()
    return names.select(text.first_group(F.col("source_dataset"), "([0-9]{5})").alias("city_code")) \
        .filter("city_code is not null").distinct()


def compare_cities(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Full comparison of two city lists with a status per city."""
    e = expected.select("city_code").distinct().withColumn("_e", F.lit(True))
    f = found.select("city_code").distinct().withColumn("_f", F.lit(True))
    return e.join(f, "city_code", "full_outer").select(
        "city_code", F.when(F.col("_f").isNull(), "missing").when(F.col("_e").isNull(), "unexpected")
        .otherwise("matched").alias("status"))


def import_gate(buildings: DataFrame, city_code: str) -> DataFrame:
    """The check after an import: does the city have rows?"""
    return buildings.filter(F.col("city_code") == city_code).agg(
        F.count("*").alias("buildings")).select(
        "buildings", (F.col("buildings") > 0).alias("passed"))


def import_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """before/after = ``validity`` rows."""
    b = before.select(F.col("total").alias("total_before"), F.col("validity_rate").alias("rate_before"))
    a = after.select(F.col("total").alias("total_after"), F.col("validity_rate").alias("rate_after"))
    return b.join(a).select(
        "total_before", "total_after", (F.col("total_after") - F.col("total_before")).alias("growth"),
        "rate_before", "rate_after", (F.col("rate_after") >= fv.VALIDITY_TARGET).alias("high_quality"))


def ordered_nodes(nodes: DataFrame) -> DataFrame:
    """Per building the node list ordered by ring and sequence.

    A missing ring number sorts last, as it does in the stored tables' SQL.
    """
    entry = F.struct(
        F.col("ring_id").isNull().alias("_last"), "ring_id", "sequence_id", "id", "osm_id", "lat", "lon")
    return nodes.groupBy("building_id").agg(
        F.transform(F.array_sort(F.collect_list(entry)), lambda s: F.struct(
            s["id"].alias("id"), s["osm_id"].alias("osm_id"), s["lat"].alias("lat"),
            s["lon"].alias("lon"), s["sequence_id"].alias("sequence_id"),
            s["ring_id"].alias("ring_id"))).alias("nodes"))


def with_nodes(buildings: DataFrame, nodes: DataFrame) -> DataFrame:
    """Buildings with their ordered nodes; only the nodes of these buildings are read on."""
    wanted = nodes.join(buildings.select(F.col("id").alias("building_id")).distinct(),
                        "building_id", "left_semi")
    lists = ordered_nodes(wanted).withColumnRenamed("building_id", "id")
    return buildings.join(lists, "id", "left")


def orphan_nodes(nodes: DataFrame, buildings: DataFrame) -> DataFrame:
    return nodes.join(buildings.select(F.col("id").alias("building_id")), "building_id", "left_anti")


def nodes_of_city(nodes: DataFrame, buildings: DataFrame, city_code: str) -> DataFrame:
    ids = buildings.filter(F.col("city_code") == city_code).select(F.col("id").alias("building_id"))
    return nodes.join(ids, "building_id", "left_semi")
