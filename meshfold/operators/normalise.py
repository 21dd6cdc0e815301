"""Tag values to typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshfold import fixed_values as fv
from meshfold.functions import numbers

# Column to tag key where they differ.
TAG_KEYS = {
    "addr_housenumber": "addr:housenumber", "addr_street": "addr:street",
    "building_material": "building:material", "roof_material": "roof:material",
    "roof_shape": "roof:shape",
}


def building_type(tags: Column) -> Column:
    value = F.coalesce(tags[fv.BUILDING_KEY], tags[fv.PART_KEY], F.lit("yes"))
    return F.when(value == "no", "yes").otherwise(value)


def height(tags: Column) -> Column:
    return numbers.within(numbers.read_float(tags["height"]), *fv.HEIGHT_RANGE)


def elevation(tags: Column) -> Column:
    return numbers.within(numbers.read_float(tags["ele"]), *fv.ELE_RANGE)


def levels(tags: Column) -> Column:
    """Truncated to a whole number, then range-checked."""
    whole = numbers.read_float(tags["building:levels"]).try_cast("bigint")
    return numbers.within(whole, *fv.LEVEL_RANGE).cast("int")


def unreadable(tags: Column) -> Column:
    """An infinite storey count makes the whole building a reject."""
    return F.coalesce(numbers.is_infinite_text(tags["building:levels"]), F.lit(False))


def short_text(tags: Column, column: str) -> Column:
    value = tags[TAG_KEYS.get(column, column)]
    if column == "name":
        value = F.coalesce(value, tags["name:ja"])
    return F.substring(value, 1, fv.TEXT_WIDTHS[column])


def full_address(street: Column, housenumber: Column) -> Column:
    return F.nullif(F.concat_ws(" ", street, housenumber), F.lit(""))


def source_dataset(city_code: Column, file_name: Column) -> Column:
    return F.concat(F.lit(fv.DATASET_PREFIX), city_code, F.lit("_"), file_name)


def known_city(city_code: Column) -> Column:
    return F.nullif(city_code, F.lit("unknown"))


def normalise(df: DataFrame) -> DataFrame:
    """Replace ``tags`` by the stored attribute columns; needs city and file_name."""
    tags = F.col("tags")
    texts = {c: short_text(tags, c) for c in fv.TEXT_WIDTHS}
    out = df.withColumns({
        "building": building_type(tags), "height": height(tags), "ele": elevation(tags),
        "building_levels": levels(tags), "building_ref": tags[fv.IDENTIFIER_KEY],
        "source_dataset": source_dataset(F.col("city"), F.col("file_name")),
        "city_code": known_city(F.col("city")), "source_element": F.col("element"),
        "building_part": F.lit(None).cast("string"),
        "parent_building_id": F.lit(None).cast("bigint"), **texts})
    return out.withColumn("addr_full", full_address(F.col("addr_street"), F.col("addr_housenumber")))
