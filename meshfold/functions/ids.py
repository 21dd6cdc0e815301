"""Deterministic identifiers, all closed-form BIGINT arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meshfold import fixed_values as fv
from meshfold.session import cut_lineage


def node_id_in_range(lat_i: Column, lon_i: Column) -> Column:
    return (lat_i.between(fv.LAT_OFFSET, fv.LAT_OFFSET + fv.LAT_STEPS - 1)
            & lon_i.between(fv.LON_OFFSET, fv.LON_OFFSET + fv.LON_STEPS - 1))


def node_id(lat_i: Column, lon_i: Column, fallback: Column) -> Column:
    """Node id from the coordinate; out of range falls back to -(row id)."""
    lat_step = lat_i.cast("bigint") - F.lit(fv.LAT_OFFSET).cast("bigint")
    lon_step = lon_i.cast("bigint") - F.lit(fv.LON_OFFSET).cast("bigint")
    ident = -(F.lit(1) + lat_step * F.lit(fv.LON_STEPS).cast("bigint") + lon_step)
    return F.when(node_id_in_range(lat_i, lon_i), ident).otherwise(-fallback.cast("bigint"))


def way_id(building_id: Column, ring_no: Column) -> Column:
    return -(building_id.cast("bigint") * F.lit(fv.WAY_RING_STEPS) + ring_no.cast("bigint"))


def relation_id(building_id: Column, kind: int) -> Column:
    return -(building_id.cast("bigint") * F.lit(fv.RELATION_KIND_STEPS) + F.lit(kind))


def response_tag(bbox: Column, limit: Column, n_rows: Column) -> Column:
    return F.md5(F.concat_ws("-", bbox, limit.cast("string"), n_rows.cast("string")))


def dense_ids(df: DataFrame, order: list[str], start: int = 1, name: str = "id") -> DataFrame:
    """Consecutive ids in ``order`` without a one-task sort.

    A range shuffle splits even one huge city over many tasks. Each task numbers
    its own rows, the checkpoint freezes that numbering, and a table with one row
    per task gives the offsets.
    """
    ranged = (
        df.repartitionByRange(*[F.col(c) for c in order])
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    frozen = cut_lineage(ranged).withColumn("_task", F.shiftright("_mid", 33))
    sizes = frozen.groupBy("_task").count()
    before = F.sum("count").over(
        Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_task", F.coalesce(before, F.lit(0)).alias("_before"))
    local = F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        frozen.join(offsets, "_task")
        .withColumn(name, F.lit(start).cast("bigint") + F.col("_before") + local)
        .drop("_mid", "_task", "_before")
    )
