"""Bounding-box requests over stored buildings."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshfold.functions import geometry as g
from meshfold.operators import cover
from meshfold.operators.cover import BASE_CELL, LEVELS, cell_size, level_for

WIDE = 10_000_000   # requests beyond 1 degree take the quadtree
CROWD = 4096        # boxes of a cell that one task takes


def _cells(west, south, east, north, size) -> Column:
    def span(a, b):
        return F.sequence(F.floor(a / size).cast("bigint"), F.floor(b / size).cast("bigint"))

    return F.flatten(F.transform(span(west, east), lambda cx: F.transform(
        span(south, north), lambda cy: F.struct(cx.alias("cx"), cy.alias("cy")))))


def _pairs(levels_a: str, levels_b: list[int]) -> Column:
    return F.explode(F.array(*[F.lit(n) for n in levels_b])).alias(levels_a)


def used_levels(df: DataFrame, level: str) -> list[int]:
    """At most LEVELS integers."""
    return sorted(r[0] for r in df.select(level).distinct().collect() if r[0] is not None)


def _crowds(boxes: DataFrame, r_levels: list[int], start: str) -> dict[int, int]:
    """For each level of ``boxes`` the most boxes that begin in one cell; at most LEVELS pairs of integers."""
    size = cell_size(F.greatest("_rl", "_bl"))
    cells = boxes.select("*", _pairs("_rl", r_levels)).groupBy(
        "_rl", "_bl", F.floor(F.col(start) / size), F.floor(F.col("min_lat") / size)).agg(F.count("*").alias("_n"))
    return {r["_bl"]: r["most"] for r in cells.groupBy("_bl").agg(F.max("_n").alias("most")).collect() if r["_bl"] is not None}


def grid_pairs(requests: DataFrame, boxes: DataFrame, spread: int = 8, start: str = "min_lon", reach: str = "east",
               tall: int = 1) -> DataFrame:
    """Pairs of overlapping boxes by equal cells of a grid.

    Each side is sized to a level: a request to
    one where it spans about four cells, so that little outside of it is met, a box
    to one where it spans one. A pair of levels joins at the coarser of the two, so
    neither a huge request nor a huge building multiplies. A pair found in
    several cells is kept only in the cell of its overlap's lower-left corner,
    which needs no shuffle. A crowded cell is split over up to ``spread`` tasks, by counted boxes: each
    request goes to all of them. Requests are many times larger in
    cells than their table, which Spark's size estimate does not see, so both sides are shuffled and
    neither is ever broadcast through the driver.
    """
    r = requests.withColumn("_rl", level_for(F.greatest(
        F.col("east") - F.col("west"), F.col("north") - F.col("south")), 4))
    b = boxes.filter(F.col("min_lon").isNotNull()).withColumn("_bl", level_for(F.greatest(
        F.col("max_lon") - F.col("min_lon"), F.col("max_lat") - F.col("min_lat")), 1))
    r_levels = used_levels(r, "_rl") or [0]
    crowds = _crowds(b, r_levels, start) or {0: 0}
    b_levels, spread = sorted(crowds), max(1, min(spread, ceil(max(crowds.values()) / CROWD)))
    size = cell_size(F.greatest("_rl", "_bl"))
    r_cells = (
        r.select("*", _pairs("_bl", b_levels)).withColumn("_size", size)
        .withColumn("_cell", F.explode(_cells(F.col("west"), F.col("south"), F.col(reach),
                                              F.col("north"), F.col("_size"))))
        .withColumn("_slice", F.explode(F.sequence(F.lit(0), F.lit(spread - 1)))))
    b_cells = (
        b.select("*", _pairs("_rl", r_levels)).withColumn("_size", size)
        .withColumn("_cell", F.explode(_cells(
            F.col(start), F.col("min_lat"), F.col("max_lon"), F.col("max_lat"),
            F.col("_size"))))
        .withColumn("_slice", F.pmod(F.xxhash64("id"), F.lit(spread)).cast("int"))
        .drop("_size"))
    corner_x = F.floor(F.greatest("west", start) / F.col("_size"))
    corner_y = F.floor(F.greatest("south", "min_lat") / F.col("_size"))
    return (
        r_cells.hint("merge").join(b_cells, ["_rl", "_bl", "_cell", "_slice"])
        .filter((F.col(start) <= F.col(reach)) & (F.col("max_lon") >= F.col("west"))
                & (F.col("min_lat") <= F.col("north")) & (F.col("max_lat") >= F.col("south"))
                & (F.col("_cell.cx") == corner_x) & (F.col("_cell.cy") == corner_y))
        .drop("_rl", "_bl", "_cell", "_slice", "_size")
    )


def _inner() -> Column:
    """The box lies strictly inside of the request."""
    return ((F.col("min_lon") > F.col("west")) & (F.col("max_lon") < F.col("east"))
            & (F.col("min_lat") > F.col("south")) & (F.col("max_lat") < F.col("north")))


def box_pairs(requests: DataFrame, boxes: DataFrame, within: str | None = None, wide: int = WIDE) -> DataFrame:
    """All (request, box) pairs whose boxes overlap, touching included, with the columns of both.

    ``requests`` has request_id, west, south, east, north; ``boxes`` has id and min/max_lon/lat. With ``within`` a
    boolean column of that name tells pairs of which the box lies strictly inside of the request. Requests up to
    ``wide`` meet boxes in cells of a grid; of wider ones, which would hold most rows in a few cells, the
    rows are dealt by a quadtree that is split by counted rows.
    """
    extent = F.greatest(F.col("east") - F.col("west"), F.col("north") - F.col("south"))
    columns = [*requests.columns, *boxes.columns, *([within] if within else [])]
    pairs = grid_pairs(requests.filter(extent <= wide), boxes)
    pairs = (pairs.withColumn(within, _inner()) if within else pairs).select(*columns)
    large = requests.filter(extent > wide)
    return pairs if large.isEmpty() else pairs.unionByName(cover.box_pairs(large, boxes, within=within).select(*columns))


def strip_pairs(requests: DataFrame, boxes: DataFrame, within: str | None = None) -> DataFrame:
    """Those pairs of ``box_pairs`` whose box has its ``key_lon`` (1e-6 degree, of its ``cen_lon``) at most at the request's
    ``until``, with the same columns.

    Only the strip of a request up to there is put into cells. A box is stretched to its centroid, which may lie
    outside of it: so a box that meets the request and has its centroid in or before the strip meets the strip.
    """
    r = requests.withColumn("_reach", F.greatest("west", F.least("east", (F.col("until") + 1) * 10)))
    b = boxes.withColumn("_start", F.least("min_lon", F.floor("cen_lon").cast("bigint")))
    pairs = grid_pairs(r, b, 2, "_start", "_reach", 8).filter(
        (F.col("key_lon") <= F.col("until")) & (F.col("min_lon") <= F.col("east")))
    columns = [*requests.columns, *boxes.columns, *([within] if within else [])]
    return (pairs.withColumn(within, _inner()) if within else pairs).select(*columns)


def nested_pairs(outer: DataFrame, inner: DataFrame, on: list[str]) -> DataFrame:
    """Pairs whose inner box lies within the outer one, edges included, with equal columns ``on``; other columns of both.

    ``outer`` has west, south, east, north; ``inner`` has min/max_lon/lat. A box that lies within another has its lower-left
    corner there. So an outer box goes to the cells it covers, at most four of a size just above its own, and
    the corner of an inner one to the one cell that holds it for each size in use: a pair meets exactly once.
    """
    def fit(extent):
        return F.ceil(F.log2(F.greatest(extent, F.lit(1)))).cast("int")

    o = outer.filter("west is not null").withColumn(
        "_level", fit(F.greatest(F.col("east") - F.col("west"), F.col("north") - F.col("south"))))
    levels = used_levels(o, "_level")
    size = F.pow(F.lit(2), F.col("_level")).cast("bigint")
    covered = o.withColumn("_size", size).withColumn("_cell", F.explode(_cells(
        F.col("west"), F.col("south"), F.col("east"), F.col("north"), F.col("_size")))).drop("_size").select(
        "*", "_cell.cx", "_cell.cy").drop("_cell")
    # An outer box is at least as wide as an inner one, so smaller sizes never hold it.
    extent = F.greatest(F.col("max_lon") - F.col("min_lon"), F.col("max_lat") - F.col("min_lat"))
    used = F.filter(F.array(*[F.lit(n) for n in levels or [0]]), lambda n: n >= fit(extent))
    corners = inner.filter("min_lon is not null").select("*", F.explode(used).alias("_level")).select(
        "*", F.floor(F.col("min_lon") / size).cast("bigint").alias("cx"),
        F.floor(F.col("min_lat") / size).cast("bigint").alias("cy"))
    # Both sides are many rows; cells make them larger than Spark's estimate: they are shuffled, never broadcast.
    return covered.hint("merge").join(corners, ["cx", "cy", "_level", *on]).filter(
        (F.col("min_lon") >= F.col("west")) & (F.col("max_lon") <= F.col("east"))
        & (F.col("min_lat") >= F.col("south")) & (F.col("max_lat") <= F.col("north"))).drop("cx", "cy", "_level")


def candidates(requests: DataFrame, buildings: DataFrame, mode: str = "intersects",
               shapes: DataFrame | None = None, pairs_of=box_pairs) -> DataFrame:
    """(request, building) pairs by polygon intersection or by contained centroid.

    Only ``shapes(id, rings)``, by default those of ``buildings``, are looked up for pairs on the rim of a
    request; all other pairs are told by boxes, without their rings. ``pairs_of`` gives the pairs of boxes.
    """
    shapes = buildings.select("id", "rings") if shapes is None else shapes.select("id", "rings")
    narrow = buildings.drop("rings")
    if mode == "centroid":
        # A point is a box of no extent; the stored box columns come back afterwards.
        kept = ["min_lon", "min_lat", "max_lon", "max_lat"]
        points = narrow.withColumns({f"_{c}": F.col(c) for c in kept}).withColumns({
            "min_lon": F.floor("cen_lon"), "max_lon": F.ceil("cen_lon"),
            "min_lat": F.floor("cen_lat"), "max_lat": F.ceil("cen_lat")})
        pairs = pairs_of(requests, points)
        return pairs.filter(g.box_contains_point(
            F.col("west"), F.col("south"), F.col("east"), F.col("north"),
            F.col("cen_lon"), F.col("cen_lat"))).withColumns(
            {c: F.col(f"_{c}") for c in kept}).drop(*[f"_{c}" for c in kept])
    pairs = pairs_of(requests, narrow, within="_inside")
    # Edges are several times larger than the size estimate of their table: they are shuffled, never broadcast.
    rim = pairs.filter(~F.col("_inside")).join(
        shapes.select("id", g.edges(F.col("rings")).alias("_edges")).hint("merge"), "id").filter(g.box_intersects(
            F.col("_edges"), F.col("west"), F.col("south"), F.col("east"), F.col("north")))
    return pairs.filter("_inside").drop("_inside").unionByName(rim.drop("_inside", "_edges"))


def read_bbox(requests: DataFrame, text: str = "bbox") -> DataFrame:
    """Check request text 'west,south,east,north'; adds the numbers and a ``reason``
    (NULL when the request is good)."""
    from meshfold.functions.numbers import read_float

    out = requests.withColumn("_parts", F.split(text, ",", -1))
    for i, name in enumerate(("min_lon", "min_lat", "max_lon", "max_lat")):
        out = out.withColumn(name, read_float(F.get("_parts", F.lit(i))))
    numbers = [F.col(c) for c in ("min_lon", "min_lat", "max_lon", "max_lat")]
    unread = F.exists("_parts", lambda t: read_float(t).isNull())
    reason = (
        F.when(F.col("_parts").isNull() | unread, "not a number")
        .when(F.size("_parts") != 4, "not four numbers")
        .when(~(numbers[0].between(-180, 180) & numbers[2].between(-180, 180)), "longitude range")
        .when(~(numbers[1].between(-90, 90) & numbers[3].between(-90, 90)), "latitude range")
        .when((numbers[0] >= numbers[2]) | (numbers[1] >= numbers[3]), "min not below max"))
    return out.withColumn("reason", reason).drop("_parts")
