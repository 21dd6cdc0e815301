"""Duplicate removal and ranked limits that survive hot groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The first row of every key (NULL equals NULL) under a total order.

    An aggregate rather than a window: each task folds its copies to one row
    before the shuffle, so a group holding a third of the table stays cheap.
    """
    rest = [c for c in df.columns if c not in keys]
    ordering = F.struct(*[(F.col(o) if isinstance(o, str) else o).alias(f"o{i}")
                          for i, o in enumerate(order)])
    best = F.min_by(F.struct(*rest), ordering).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, "_best.*").select(*df.columns)


def limit_per_group(df: DataFrame, keys: list[str], order: list[Column], limit: str,
                    spread_by: list[str], pieces: int = 32) -> DataFrame:
    """The first ``limit`` rows (a column, constant per group) of every group.

    Rows are ranked inside ``pieces`` slices of the group first; whatever is in
    the group's first n rows is also in its slice's first n, so dropping the rest
    early is exact and only pieces * n rows of a group meet in one task.
    """
    slice_no = F.pmod(F.xxhash64(*spread_by), F.lit(pieces))
    in_slice = Window.partitionBy(*keys, "_slice").orderBy(*order)
    in_group = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_slice", slice_no)
        .withColumn("_rank", F.row_number().over(in_slice))
        .filter(F.col("_rank") <= F.col(limit)).drop("_slice", "_rank")
        .withColumn("_rank", F.row_number().over(in_group))
        .filter(F.col("_rank") <= F.col(limit)).drop("_rank")
    )


def rounded_micro_degrees(value: Column, digits: int) -> Column:
    """1e-7 degree (DOUBLE) to whole 1e-6 degree, half away from zero in decimal.

    ``digits`` is the number of digits kept below 1e-7 degree before rounding.
    """
    return F.round(value.cast(f"decimal(20,{digits})"), -1).cast("bigint") / F.lit(10)


def key_lon(cen_lon: Column) -> Column:
    """The first part of the position key: whole 1e-6 degrees."""
    return rounded_micro_degrees(cen_lon, 5).cast("bigint")


def position_key(df: DataFrame) -> DataFrame:
    """The five-part key of one building seen from several cities."""
    def whole(col, digits):
        return rounded_micro_degrees(F.col(col), digits).cast("bigint")

    return (
        df.withColumn("key_lon", key_lon(F.col("cen_lon")))
        .withColumn("key_lat", whole("cen_lat", 6))
        .withColumn("key_height", F.coalesce(F.col("height").cast("string"), F.lit("")))
        .withColumn("key_levels", F.coalesce(F.col("building_levels").cast("string"), F.lit("")))
        .withColumn("key_part", F.coalesce(F.col("building_part"), F.lit("")))
    )


POSITION_KEY = ["key_lon", "key_lat", "key_height", "key_levels", "key_part"]
