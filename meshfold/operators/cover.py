"""Requests over boxes by a quadtree that is split by counted rows.

Boxes belong to one cell each, that of their centre on a grid as wide as they are. The cells'
counts are added up level by level, and the largest squares of at most ``leaf_rows`` boxes are the leaves; a
single cell of more is dealt into parts. A leaf keeps the bounds of what it holds. A request finds
the leaves it touches by equal cells: either a leaf below one of its own cells or one above. A leaf whose
bounds lie within the request needs no test of its boxes, the others form the rim. So the work of a
request is dealt by counted rows, whether it spans a street or a country, and a leaf that
very many requests share is dealt by requests as well.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshfold.session import cut_lineage

BASE_CELL = 25_000  # finest cell, 0.0025 degree
LEVELS = 15         # each level is twice as wide; the top one exceeds 40 degrees
BOUNDS = ["min_lon", "min_lat", "max_lon", "max_lat"]
SLICES = 16         # of a cell's boxes on their way to their leaf
_LEAF = ["_class", "_level", "_lx", "_ly"]


def level_for(extent: Column, cells: int) -> Column:
    """Finest level where ``cells`` cells are at least as wide as the extent."""
    level = F.ceil(F.log2(F.greatest(extent, F.lit(1)) / F.lit(float(BASE_CELL * cells))))
    return F.least(F.greatest(level, F.lit(0)), F.lit(LEVELS - 1)).cast("int")


def cell_size(level: Column) -> Column:
    return (F.lit(BASE_CELL) * F.pow(F.lit(2), level)).cast("bigint")


def _centred(boxes: DataFrame) -> DataFrame:
    """Class (the level as wide as the box) and cell of each box's centre."""
    size = cell_size(F.col("_class"))
    return boxes.filter(F.col("min_lon").isNotNull()).withColumn("_class", level_for(
        F.greatest(F.col("max_lon") - F.col("min_lon"), F.col("max_lat") - F.col("min_lat")), 1)).withColumns({
            "_cx": F.floor((F.col("min_lon") + F.col("max_lon")) / 2 / size).cast("bigint"),
            "_cy": F.floor((F.col("min_lat") + F.col("max_lat")) / 2 / size).cast("bigint")})


def _upper(cell: str, steps: str) -> Column:
    return F.expr(f"shiftright({cell}, {steps})")


def quadtree(boxes: DataFrame, leaf_rows: int) -> tuple[DataFrame, DataFrame]:
    """(cells, leaves): the leaf of each used cell, and of each leaf its bounds and number of parts.

    Only counts of cells meet: their number grows with the covered area, and is cut off where the boxes are dense.
    """
    bounds = [F.min("min_lon").alias("min_lon"), F.min("min_lat").alias("min_lat"),
              F.max("max_lon").alias("max_lon"), F.max("max_lat").alias("max_lat")]
    cells = cut_lineage(_centred(boxes).groupBy("_class", "_cx", "_cy").agg(F.count("*").alias("_n"), *bounds))
    size = cells.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.count("*").alias("cells")).first()
    # A few levels beyond those where usual squares are full: wider squares would hold too much.
    top = min(LEVELS, max(0, ceil(log2(leaf_rows * max(size.cells, 1) / max(size.rows, 1)) / 2)) + 3)
    above = cells.select("_class", "_cx", "_cy", "_n", F.explode(F.sequence(F.lit(0), F.lit(top))).alias("_level"))
    above = above.withColumns({"_lx": _upper("_cx", "_level"), "_ly": _upper("_cy", "_level")})
    fits = above.groupBy(*_LEAF).agg(F.sum("_n").alias("_all")).filter(F.col("_all") <= leaf_rows).select(*_LEAF)
    best = above.join(fits, _LEAF).groupBy("_class", "_cx", "_cy").agg(F.max("_level").alias("_level"))
    placed = cells.join(best, ["_class", "_cx", "_cy"], "left").withColumn("_level", F.coalesce("_level", F.lit(0)))
    placed = cut_lineage(placed.withColumns({"_lx": _upper("_cx", "_level"), "_ly": _upper("_cy", "_level")}))
    leaves = placed.groupBy(*_LEAF).agg(F.sum("_n").alias("_rows"), *bounds).withColumn(
        "_parts", F.ceil(F.col("_rows") / leaf_rows).cast("int"))
    return placed.select("_class", "_cx", "_cy", "_level", "_lx", "_ly"), leaves


def _cells(size: Column) -> Column:
    """Cells of the request, widened by half a cell of the class."""
    def span(low, high):
        return F.sequence(F.floor((F.col(low) - F.col("_pad")) / size).cast("bigint"),
                          F.floor((F.col(high) + F.col("_pad")) / size).cast("bigint"))

    return F.flatten(F.transform(span("west", "east"), lambda x: F.transform(
        span("south", "north"), lambda y: F.struct(x.alias("x"), y.alias("y")))))


def touched_leaves(requests: DataFrame, leaves: DataFrame) -> DataFrame:
    """Every request with each leaf whose bounds it meets; ``_within``: they lie strictly inside of it."""
    # At most LEVELS pairs of integers: the classes and the widest leaf of each.
    classes = [F.struct(F.lit(r["_class"]).alias("_class"), F.lit(r.top).alias("_top")) for r in leaves.groupBy("_class").agg(
        F.max("_level").alias("top")).collect()] or [F.struct(F.lit(-1).alias("_class"), F.lit(0).alias("_top"))]
    unit = cell_size(F.col("_class"))
    extent = F.greatest(F.col("east") - F.col("west"), F.col("north") - F.col("south")) + 2 * F.col("_pad")
    own = F.ceil(F.log2(extent / (4.0 * unit)))
    wanted = requests.select("*", F.inline(F.array(*classes))).withColumn(
        "_pad", F.floor(unit / 2) + 1).withColumn("_own", F.least(F.greatest(own, F.lit(0)), F.lit(LEVELS)).cast("int"))
    # Its own few cells, and the ever fewer cells above them.
    levels = F.sequence(F.col("_own"), F.greatest("_own", "_top"))
    squares = F.flatten(F.transform(levels, lambda n: F.transform(
        _cells((unit * F.pow(F.lit(2), n)).cast("bigint")),
        lambda c: F.struct(n.alias("n"), c["x"].alias("x"), c["y"].alias("y")))))
    wanted = wanted.withColumn("_c", F.explode(squares)).select(
        *requests.columns, "_class", F.col("_c.n").alias("_at"), F.col("_c.x").alias("_ax"), F.col("_c.y").alias("_ay"),
        (F.col("_c.n") == F.col("_own")).alias("_finest"))
    # Leaves below or at the request's own cells, and those that are one of the wider cells themselves.
    below = leaves.withColumn("_at", F.explode(F.sequence(F.col("_level"), F.lit(LEVELS)))).withColumns({
        "_ax": _upper("_lx", "_at - _level"), "_ay": _upper("_ly", "_at - _level")})
    itself = leaves.withColumns({"_at": F.col("_level"), "_ax": F.col("_lx"), "_ay": F.col("_ly")})
    meets = ((F.col("min_lon") <= F.col("east")) & (F.col("max_lon") >= F.col("west"))
             & (F.col("min_lat") <= F.col("north")) & (F.col("max_lat") >= F.col("south")))
    within = ((F.col("min_lon") > F.col("west")) & (F.col("max_lon") < F.col("east"))
              & (F.col("min_lat") > F.col("south")) & (F.col("max_lat") < F.col("north")))
    square = ["_class", "_at", "_ax", "_ay"]
    # Exploded sides are larger than Spark's size estimate of them: they are shuffled, never broadcast.
    found = wanted.filter("_finest").hint("merge").join(below, square).unionByName(
        wanted.filter("not _finest").hint("merge").join(itself, square)).filter(meets)
    return found.select(*requests.columns, *_LEAF, "_parts", within.alias("_within"))


def box_pairs(requests: DataFrame, boxes: DataFrame, leaf_rows: int = 128, leaf_requests: int = 1024,
              within: str | None = None) -> DataFrame:
    """All (request, box) pairs whose boxes overlap, touching included, with the columns of both.

    ``requests`` has request_id, west, south, east, north; ``boxes`` has id and min/max_lon/lat. With ``within`` a
    boolean column of that name tells pairs of which the box lies strictly inside of the request, for
    most of them by the leaf alone.
    """
    cells, leaves = quadtree(boxes, leaf_rows)
    met = cut_lineage(touched_leaves(requests, cut_lineage(leaves)))
    turns = met.groupBy(*_LEAF, "_parts").agg(F.ceil(F.count("*") / leaf_requests).cast("int").alias("_turns"))
    asked = met.join(turns.drop("_parts"), _LEAF).withColumns({
        "_part": F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)),
        "_turn": F.pmod(F.xxhash64("request_id", "west", "south"), F.col("_turns")).cast("int")}).drop("_parts", "_turns")
    # Cells that no request touches end here; the others come in slices, so that no cell's boxes meet in one task.
    known = cells.join(turns, _LEAF).withColumn("_slice", F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))))
    sliced = _centred(boxes).withColumn("_slice", F.pmod(F.xxhash64("id"), F.lit(SLICES)).cast("int"))
    held = sliced.hint("merge").join(known, ["_class", "_cx", "_cy", "_slice"]).withColumns({
        "_part": F.pmod(F.xxhash64(F.lit(1), "id"), F.col("_parts")).cast("int"),
        "_turn": F.explode(F.sequence(F.lit(0), F.col("_turns") - 1))}).drop("_cx", "_cy", "_slice", "_parts", "_turns")
    meets = ((F.col("min_lon") <= F.col("east")) & (F.col("max_lon") >= F.col("west"))
             & (F.col("min_lat") <= F.col("north")) & (F.col("max_lat") >= F.col("south")))
    inner = F.col("_within") | ((F.col("min_lon") > F.col("west")) & (F.col("max_lon") < F.col("east"))
                                & (F.col("min_lat") > F.col("south")) & (F.col("max_lat") < F.col("north")))
    # One key of all columns, its hash first for the sort: sides that lie by leaf already must be dealt by part and turn too,
    # whatever the session says of joins on more columns than they lie by.
    place = [*_LEAF, "_part", "_turn"]
    asked, held = (side.select("*", F.xxhash64(*place).alias("_deal"), F.struct(*place).alias("_place")).drop(*place)
                   for side in (asked, held))
    pairs = asked.hint("merge").join(held, ["_deal", "_place"]).filter(F.col("_within") | meets)
    return pairs.select(*requests.columns, *boxes.columns, *([inner.alias(within)] if within else []))
