"""The strips of requests that hold their first places.

The limit of a request counts places from west to east, so it is filled by a strip at the west side of
its box. How wide the strip has to be is guessed from counts of cells: a guess only says where to look first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meshfold.operators.bbox import _cells, used_levels
from meshfold.operators.cover import cell_size, level_for

ALL = 1 << 62  # ``until`` of requests of which every box is looked at
SPARE = 3      # places sought for each one needed, since copies share a place and a guess may be high


def guessed(requests: DataFrame, boxes: DataFrame) -> DataFrame:
    """The distinct rows of ``requests(request_id, row_limit, west, south, east, north)`` with ``need``, the largest limit of
    their request_id, and ``_columns``, for each column of cells from west to east its range and how many boxes are expected there.

    A request covers about four cells a side on a grid of its size; only counts of cells meet requests.
    """
    asked = requests.select("request_id", "row_limit", "west", "south", "east", "north").distinct().withColumn(
        "need", F.coalesce(F.max("row_limit").over(Window.partitionBy("request_id")), F.lit(0)).cast("bigint"))
    asked = asked.withColumn("_level", level_for(F.greatest(
        F.col("east") - F.col("west"), F.col("north") - F.col("south")), 4))
    levels = used_levels(asked, "_level") or [0]
    size = cell_size(F.col("_level"))
    counts = boxes.select(F.explode(F.array(*[F.lit(n) for n in levels])).alias("_level"), "cen_lon", "cen_lat").groupBy(
        "_level", F.floor(F.col("cen_lon") / size).alias("cx"), F.floor(F.col("cen_lat") / size).alias("cy")).agg(
        F.count("*").alias("_n"))
    keys = ["request_id", "row_limit", "west", "south", "east", "north", "need"]
    cells = asked.withColumn("_cell", F.explode(_cells(*[F.col(c) for c in ("west", "south", "east", "north")], size))).select(
        *keys, "_level", "_cell.cx", "_cell.cy")

    def shared(low: str, high: str, cell: str) -> tuple[Column, Column]:
        """Where the cell's share of the request begins, and how long it is."""
        begin = F.greatest(F.col(low), F.col(cell) * size)
        return begin, F.greatest(F.least(F.col(high), (F.col(cell) + 1) * size) - begin, F.lit(0)).cast("double")

    (x, wide), (_, high) = shared("west", "east", "cx"), shared("south", "north", "cy")
    columns = cells.join(counts, ["_level", "cx", "cy"], "left").groupBy(*keys, "cx").agg(
        F.first(x).alias("x"), F.first(wide).alias("wide"),
        F.sum(F.coalesce("_n", F.lit(0)) * wide * high / size / size).alias("n"))
    return columns.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("x", "wide", "n"))).alias("_columns"))


def until(wanted: Column) -> Column:
    """The longitude (1e-6 degree) up to which ``wanted`` boxes are expected, ``ALL`` where the request is not
    expected to have so many. ``_columns`` are a handful."""
    start = F.struct(F.lit(0.0).alias("n"), F.lit(None).cast("double").alias("x"))
    found = F.aggregate("_columns", start, lambda s, c: F.struct(
        (s["n"] + c["n"]).alias("n"),
        F.coalesce(s["x"], F.when(s["n"] + c["n"] >= wanted, c["x"] + c["wide"] * (wanted - s["n"]) / c["n"])).alias("x")))
    return F.coalesce(F.floor(found["x"] / 10).cast("bigint"), F.lit(ALL))


def strips(asked: DataFrame, turn: int) -> DataFrame:
    """``asked`` with ``until`` for the ``turn``-th look, eight times as many boxes each. The boxes of one
    request_id are looked at up to one longitude."""
    own = until((F.col("need") * SPARE + 8) * (8.0 ** turn))
    return asked.withColumn("_own", own).withColumn(
        "until", F.min("_own").over(Window.partitionBy("request_id"))).drop("_own")


def open_requests(asked: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``asked`` of which neither all boxes nor as many places as needed were seen."""
    have = kept.groupBy(F.col("request_id").alias("_id")).agg(F.count("*").alias("_have"))
    return asked.filter(F.col("until") < ALL).join(have, F.col("request_id").eqNullSafe(F.col("_id")), "left").filter(
        F.coalesce("_have", F.lit(0)) < F.col("need")).select(*asked.columns)
