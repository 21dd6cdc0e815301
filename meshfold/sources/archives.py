"""Zip archives as tables. Input is (archive, content); a bad zip gives no members
but one row in ``bad_archives``."""

from __future__ import annotations

import io
import zipfile
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshfold import fixed_values as fv

DIRECTORY = "archive string, member string, compressed bigint, raw bigint"
_DIRECTORY_ARROW = pa.schema([("archive", pa.string()), ("member", pa.string()),
                              ("compressed", pa.int64()), ("raw", pa.int64())])
MEMBERS = "archive string, member string, declared bigint, content binary"
_MEMBERS_ARROW = pa.schema([("archive", pa.string()), ("member", pa.string()),
                            ("declared", pa.int64()), ("content", pa.binary())])


def read_archives(spark: SparkSession, root: str, glob: str = "*.zip") -> DataFrame:
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", glob).load(root))
    return files.select(F.substring_index("path", root.rstrip("/") + "/", -1).alias("archive"),
                        "length", "content")


def list_archives(spark: SparkSession, root: str, glob: str = "*.zip") -> DataFrame:
    """Names and sizes only; the content is not read."""
    return read_archives(spark, root, glob).select("archive", "length")


def big_enough(archives: DataFrame) -> DataFrame:
    """A download of 1000 bytes or less is not an archive."""
    return archives.filter(F.col("length") > fv.MIN_ARCHIVE_BYTES)


def _walk(batches, schema, rows_of):
    for batch in batches:
        for name, content in zip(batch.column("archive"), batch.column("content")):
            try:
                with zipfile.ZipFile(io.BytesIO(content.as_py())) as archive:
                    rows = list(rows_of(name.as_py(), archive))
            except (zipfile.BadZipFile, zlib.error, EOFError, OSError, ValueError, RuntimeError):
                continue  # cut, damaged, encrypted or packed by an unknown method
            # One archive per batch keeps a task's memory at one archive.
            yield pa.RecordBatch.from_pylist(rows, schema=schema)


def directory(archives: DataFrame) -> DataFrame:
    """One row per member, from the central directory; nothing is unpacked."""
    def entries(name, archive):
        return ({"archive": name, "member": i.filename, "compressed": i.compress_size, "raw": i.file_size}
                for i in archive.infolist() if not i.is_dir())

    def walk(batches):
        return _walk(batches, _DIRECTORY_ARROW, entries)

    return archives.select("archive", "content").mapInArrow(walk, DIRECTORY)


def members(archives: DataFrame, suffix: str, prefix: str = "") -> DataFrame:
    """Unpacked members whose name starts and ends as given."""
    def entries(name, archive):
        return ({"archive": name, "member": i.filename, "declared": i.file_size, "content": archive.read(i)}
                for i in archive.infolist()
                if i.filename.startswith(prefix) and i.filename.endswith(suffix))

    def walk(batches):
        return _walk(batches, _MEMBERS_ARROW, entries)

    return archives.select("archive", "content").mapInArrow(walk, MEMBERS)


def bad_archives(archives: DataFrame, listing: DataFrame) -> DataFrame:
    return archives.select("archive").join(listing.select("archive").distinct(), "archive", "left_anti")


def model_members(listing: DataFrame) -> DataFrame:
    """Members that hold building models, with their mesh code."""
    name = F.substring_index("member", "/", -1)
    return listing.filter(F.col("member").startswith(fv.ARCHIVE_MEMBER_PREFIX)
                          & F.col("member").endswith(".gml")).withColumns({
        "basename": name, "mesh_code": F.substring_index(name, "_", 1)})


def inventory(listing: DataFrame) -> DataFrame:
    """Per archive: meshes, bytes and sorted mesh codes."""
    return model_members(listing).groupBy("archive").agg(
        F.count("*").alias("meshes"), F.sum("compressed").alias("compressed"), F.sum("raw").alias("raw"),
        F.sort_array(F.collect_list("mesh_code")).alias("mesh_codes"))


def basename_clashes(listing: DataFrame) -> DataFrame:
    """Members of one archive that would unpack to the same file name."""
    return model_members(listing).groupBy("archive", "basename").agg(F.count("*").alias("uses")).filter("uses > 1")


def size_mismatches(unpacked: DataFrame) -> DataFrame:
    return unpacked.filter(F.col("declared") != F.octet_length("content")).select("archive", "member")
