"""City and mesh catalogues embedded in HTML text, links, and package metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshfold import fixed_values as fv
from meshfold.functions.text import filled, first_group

CITY_KEYS = ("citycode", "cityname", "folder", "status", "lng", "lat")
MESH_KEYS = ("meshcode", "status", "version")


def _array_text(html: Column, name: str) -> Column:
    return first_group(html, rf"(?s)const\s+{name}\s*=\s*(\[.*?\]);")


# Script notation that JSON proper does not allow.
SCRIPT_NOTATION = {"allowSingleQuotes": "true", "allowUnquotedFieldNames": "true", "allowComments": "true",
                   "allowBackslashEscapingAnyCharacter": "true", "mode": "PERMISSIVE"}
JSON_PROPER = {"allowSingleQuotes": "false", "allowUnquotedFieldNames": "false", "mode": "PERMISSIVE"}


def _fields(keys) -> str:
    return "struct<" + ",".join(f"{k}:string" for k in keys) + ">"


def _json_objects(array_text: Column, keys) -> Column:
    """Objects of an array in JSON proper, NULL if it is none."""
    return F.from_json(array_text, f"array<{_fields(keys)}>", JSON_PROPER)


def _script_objects(array_text: Column, keys) -> Column:
    """Objects of an array in script notation. Each flat object is parsed by itself, so a broken
    one costs no other; an empty value is NULL, and an object without its first key is left out."""
    pieces = F.regexp_extract_all(array_text, F.lit(r"\{[^{}]*\}"), 0)

    def parsed(piece):
        o = F.from_json(F.regexp_replace(piece, r",\s*\}$", "}"), _fields(keys), SCRIPT_NOTATION)
        return F.struct(*[filled(o[k]).alias(k) for k in keys])

    return F.filter(F.transform(pieces, parsed), lambda o: o[keys[0]].isNotNull())


def _objects(pages: DataFrame, name: str, keys, html: str) -> DataFrame:
    # The scanned text is a column of its own so that it is extracted once.
    found = pages.withColumn("_array", _array_text(F.col(html), name)).filter("_array is not null")
    parsed = found.withColumn("_proper", _json_objects(F.col("_array"), keys))
    objects = F.coalesce("_proper", _script_objects(F.col("_array"), keys))
    return parsed.select("page_id", F.posexplode(objects).alias("pos", "o")).select("page_id", "pos", "o.*")


def cities(pages: DataFrame, html: str = "html") -> DataFrame:
    return _objects(pages, "cities", CITY_KEYS, html)


def meshes(pages: DataFrame, html: str = "html") -> DataFrame:
    return _objects(pages, "meshes", MESH_KEYS, html)


def archive_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """(page_id, url, meshcode) of every link to a zip file."""
    links = pages.select("page_id", F.explode(F.regexp_extract_all(
        html, F.lit(r'href="([^"]*?\.zip)"'), 1)).alias("url"))
    return links.withColumn("meshcode", first_group(F.col("url"), "/([0-9]+)_bldg_"))


def with_download_url(mesh_rows: DataFrame, links: DataFrame, base_url: str, folder: Column) -> DataFrame:
    """The harvested link of the mesh, else the templated one (NULL without a folder)."""
    known = links.filter("meshcode is not null").groupBy("page_id", "meshcode").agg(F.max("url").alias("_url"))
    built = F.when(folder != "", F.concat(
        F.lit(base_url + "/"), folder, F.lit("/bldg/"), "meshcode", F.lit(fv.ARCHIVE_NAME_SUFFIX)))
    return mesh_rows.join(known, ["page_id", "meshcode"], "left").withColumn(
        "download_url", F.coalesce("_url", built)).drop("_url")


def parse_package(name: Column) -> Column:
    """STRUCT<city_code, slug, year>; NULL for other names."""
    return F.when(name.rlike(fv.PACKAGE_PATTERN), F.struct(
        F.regexp_extract(name, fv.PACKAGE_PATTERN, 1).alias("city_code"),
        F.regexp_extract(name, fv.PACKAGE_PATTERN, 2).alias("slug"),
        F.regexp_extract(name, fv.PACKAGE_PATTERN, 3).cast("int").alias("year")))


def resource_version(name: Column) -> Column:
    return first_group(F.trim(name), fv.RESOURCE_PATTERN).cast("int")


def latest_packages(resources: DataFrame) -> DataFrame:
    """Per city the newest year that has a model resource, in its highest version.

    ``resources``: (package, resource, url). An aggregate, not a ranked window.
    """
    parsed = resources.select("package", "url", parse_package(F.col("package")).alias("p"),
                              resource_version(F.col("resource")).alias("v")).filter(
        "p is not null and v is not null")
    best = F.max_by(F.struct("package", F.col("p.year").alias("year"), F.col("v").alias("citygml_v"), "url"),
                    F.struct("p.year", "package", "v"))
    return parsed.groupBy(F.col("p.city_code").alias("city_code")).agg(best.alias("b")).select("city_code", "b.*")


def search_cities(city_rows: DataFrame, text: str) -> DataFrame:
    return city_rows.filter(F.contains("cityname", F.lit(text)) | F.contains("citycode", F.lit(text))) \
        .orderBy("citycode")
