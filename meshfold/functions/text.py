"""Text rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meshfold import fixed_values as fv


def first_group(text: Column, pattern: str, group: int = 1) -> Column:
    """Captured group of the first match, NULL where there is none."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def filled(text: Column) -> Column:
    """NULL for the empty string."""
    return F.nullif(text, F.lit(""))


def city_from_directory(name: Column) -> Column:
    return F.coalesce(first_group(name, "^([0-9]{5})"), F.lit("unknown"))


def city_from_dataset(text: Column) -> Column:
    return first_group(text, fv.DATASET_CITY_PATTERN)


def is_city_code(text: Column) -> Column:
    return text.rlike("^[0-9]{5}$") & (F.length(text) == 5)


def mesh_from_file_name(name: Column) -> Column:
    """Mesh code of an archive held on disk: <mesh>_bldg_… or <mesh>.zip."""
    return F.coalesce(first_group(name, "^([0-9]+)_bldg_"), first_group(name, r"^([0-9]+)\.zip$"))


def leading_digits(name: Column) -> Column:
    return first_group(name, "^([0-9]+)")


def plausible_start_date(text: Column, current_year: int) -> Column:
    """The first four characters of the trimmed text are a year 1000..next year."""
    year = F.substring(F.trim(text), 1, 4)
    digits = year.rlike("^[0-9]{1,4}$")
    return F.coalesce(
        digits & F.when(digits, year.cast("int")).between(1000, current_year + 1), F.lit(False))


def strip_control(text: Column) -> Column:
    return F.regexp_replace(text, "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F]", "")


def xml_escape(text: Column) -> Column:
    """Attribute-safe text."""
    out = text
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(raw), F.lit(safe))
    return out


def failure_type(reason: Column) -> Column:
    return F.substring_index(reason, ":", 1)
