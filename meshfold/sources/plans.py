"""Download plans as CSV: (city_code, package, year, citygml_v, bytes, url)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshfold import fixed_values as fv

SCHEMA = "city_code string, package string, year int, citygml_v int, bytes bigint, url string"


def read_plan(spark: SparkSession, path: str) -> DataFrame:
    """City codes stay text (leading zeros)."""
    return spark.read.schema(SCHEMA).option("header", "true").csv(path)


def write_plan(plan: DataFrame, path: str) -> None:
    """Sorted by city; the commit protocol replaces the whole folder or nothing."""
    (plan.select(*fv.PLAN_FIELDS).orderBy("city_code")
     .write.mode("overwrite").option("header", "true").csv(path))


def upsert_plan(old: DataFrame, new: DataFrame) -> DataFrame:
    """Resolved cities are replaced, all others keep their row."""
    joined = old.alias("o").join(new.alias("n"), "city_code", "full_outer")
    found = F.col("n.package").isNotNull()
    return joined.select("city_code", *[
        F.when(found, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c)
        for c in fv.PLAN_FIELDS if c != "city_code"])
