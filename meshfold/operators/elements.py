"""Query results as OSM elements: node, way and relation tables per request.

Everything stays a table until the last step; a document is a sequence of ordered
lines, so no request is gathered in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshfold import fixed_values as fv
from meshfold.functions import ids, numbers
from meshfold.functions.text import plausible_start_date, strip_control, xml_escape
from meshfold.operators.statistics import with_nodes

GENERATOR = "meshfold"
EMPTY_DOCUMENT = f'<osm version="0.6" generator="{GENERATOR}"></osm>'


# ---- rings ---------------------------------------------------------------

def keep_related(rows: DataFrame) -> DataFrame:
    """Parts known to miss their parent go; unknown stays."""
    return rows.filter("intersects_parent is distinct from false")


def ring_lists(nodes: Column) -> Column:
    """Ordered node array to rings (ring_no, nodes); a missing ring number is 0.

    Nodes off the globe go, and so does a last point equal to the first within 1e-7.
    """
    numbered = F.transform(nodes, lambda n: F.struct(
        F.coalesce(n["ring_id"], F.lit(0)).alias("ring_no"), n["id"].alias("id"),
        n["lat"].alias("lat"), n["lon"].alias("lon")))
    ring_numbers = F.array_sort(F.array_distinct(F.transform(numbered, lambda n: n["ring_no"])))

    def valid(ring_no):
        return F.filter(numbered, lambda n: (n["ring_no"] == ring_no) & n["id"].isNotNull()
                        & n["lat"].between(-90, 90) & n["lon"].between(-180, 180))

    return F.transform(ring_numbers, lambda r: F.struct(
        r.alias("ring_no"), drop_closing(valid(r)).alias("nodes")))


def drop_closing(nodes: Column) -> Column:
    first, last = F.element_at(nodes, 1), F.element_at(nodes, -1)
    same = (F.abs(first["lat"] - last["lat"]) < 1e-7) & (F.abs(first["lon"] - last["lon"]) < 1e-7)
    return F.when((F.size(nodes) >= 2) & same, F.slice(nodes, F.lit(1), F.size(nodes) - 1)).otherwise(nodes)


def emitted_buildings(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Result rows that can be drawn, with their checked ``rings``.

    Dropped: buildings without nodes, with a ring below three nodes, with ring
    numbers of 1000 and more, or with several rings but no ring 0. A lone ring is a
    plain way whatever its number.
    """
    buildings = rows.select("id").distinct()
    listed = with_nodes(buildings, nodes).filter(F.size("nodes") > 0).select(
        "id", ring_lists(F.col("nodes")).alias("rings"))
    single = F.size("rings") == 1
    numbers_ok = (F.array_max(F.transform("rings", lambda r: r["ring_no"])) < fv.WAY_RING_STEPS) & (
        F.col("rings")[0]["ring_no"] == 0)
    drawable = listed.filter((single | numbers_ok) & F.forall("rings", lambda r: F.size(r["nodes"]) >= 3))
    as_way = F.transform("rings", lambda r: F.struct(
        F.when(single, F.lit(0)).otherwise(r["ring_no"]).alias("ring_no"), r["nodes"].alias("nodes")))
    return rows.join(drawable.select("id", as_way.alias("rings"), (~single).alias("holed")), "id")


# ---- tags ----------------------------------------------------------------

def _shown(column: str, current_year: int) -> Column:
    """Text of a tag value, NULL where the value is empty, zero or not plausible."""
    c = F.col(column)
    if column in ("height", "ele"):
        return F.when(c != 0, c.cast("string"))
    if column == "building_levels":
        return F.when(c != 0, c.cast("string"))
    if column == "start_date":
        return F.when(plausible_start_date(c, current_year), c)
    return F.when(F.trim(c) != "", c)


def tag_list(current_year: int, as_part: Column | None = None) -> Column:
    """Array of (k, v) in output order."""
    is_part = (F.col("building_part") == "yes") if as_part is None else as_part
    is_part = F.coalesce(is_part, F.lit(False))
    point = F.col("representative_point")
    pairs = [
        (F.when(is_part, "building:part").otherwise("building"),
         F.when(is_part, "yes").otherwise(F.when(F.trim("building") != "", F.col("building"))))]
    pairs += [(F.lit(k), _shown(c, current_year)) for k, c in fv.OUTPUT_TAGS]
    pairs.append((F.lit("representative_point"), F.concat_ws(
        ",", F.call_function("format_number", point["lon"] / 1e7, F.lit("0.0000000")),
        F.call_function("format_number", point["lat"] / 1e7, F.lit("0.0000000")))))
    entries = [F.struct(k.alias("k"), v.alias("v")) for k, v in pairs[:-1]]
    entries.append(F.struct(pairs[-1][0].alias("k"), F.when(point.isNotNull(), pairs[-1][1]).alias("v")))
    return F.filter(F.array(*entries), lambda t: t["v"].isNotNull())


# ---- elements ------------------------------------------------------------

def _ring_rows(emitted: DataFrame) -> DataFrame:
    return emitted.select("request_id", "id", "holed", F.explode("rings").alias("r")).select(
        "request_id", "id", "holed", F.col("r.ring_no").alias("ring_no"), F.col("r.nodes").alias("nodes"))


def _point_id(n: Column) -> Column:
    return ids.node_id(numbers.quantise(n["lat"]), numbers.quantise(n["lon"]), n["id"])


def way_elements(emitted: DataFrame, current_year: int) -> DataFrame:
    """(request_id, way_id, refs closed, tags): tags only on buildings without holes."""
    tagged = emitted.withColumn("tags", tag_list(current_year))
    rings = tagged.select("request_id", "id", "holed", "tags", F.explode("rings").alias("r"))
    refs = F.transform(F.col("r.nodes"), _point_id)
    return rings.select(
        "request_id", ids.way_id(F.col("id"), F.col("r.ring_no")).alias("way_id"),
        F.concat(refs, F.slice(refs, 1, 1)).alias("refs"),
        F.when(~F.col("holed"), F.col("tags")).otherwise(F.slice("tags", 1, 0)).alias("tags"))


def node_elements(emitted: DataFrame) -> DataFrame:
    """(request_id, node_id, lat, lon): one node per request and coordinate. Numbers are folded, in a hash
    table, and only those that stay become texts."""
    points = _ring_rows(emitted).select("request_id", F.explode("nodes").alias("n"))
    rows = points.select("request_id", _point_id(F.col("n")).alias("node_id"), "n.lat", "n.lon")
    nodes = rows.groupBy("request_id", "node_id").agg(F.min("lat").alias("lat"), F.min("lon").alias("lon"))
    return nodes.select("request_id", "node_id", *[
        F.call_function("format_number", F.col(c), F.lit("0.0000000")).alias(c) for c in ("lat", "lon")])


def _member(ref: Column, role: Column) -> Column:
    return F.struct(F.lit("way").alias("type"), ref.alias("ref"), role.alias("role"))


def multipolygon_relations(emitted: DataFrame, current_year: int) -> DataFrame:
    """Holed buildings: rings ascending, outer first, tags on the relation."""
    holed = emitted.filter("holed").withColumn("_tags", tag_list(current_year))
    members = F.transform("rings", lambda r: _member(
        ids.way_id(F.col("id"), r["ring_no"]),
        F.when(r["ring_no"] == 0, "outer").otherwise("inner")))
    kind = F.struct(F.lit("type").alias("k"), F.lit("multipolygon").alias("v"))
    return holed.select(
        "request_id", ids.relation_id(F.col("id"), fv.RELATION_KIND_MULTIPOLYGON).alias("relation_id"),
        members.alias("members"), F.concat(F.array(kind), "_tags").alias("tags"))


def part_relations(emitted: DataFrame, current_year: int) -> DataFrame:
    """Outlines with emitted parts: outline first, parts by way id descending.

    A part whose outline is not in the result stays a plain way.
    """
    is_part = F.coalesce(F.col("building_part") == "yes", F.lit(False))
    parts = emitted.filter(is_part & F.col("parent_building_id").isNotNull()).groupBy(
        "request_id", F.col("parent_building_id").alias("id")).agg(
        F.sort_array(F.collect_list(ids.way_id(F.col("id"), F.lit(0))), asc=False).alias("_parts"))
    outlines = emitted.filter(~is_part).join(parts, ["request_id", "id"])
    tagged = outlines.withColumn("_tags", tag_list(current_year, F.lit(False)))
    members = F.concat(
        F.array(_member(ids.way_id(F.col("id"), F.lit(0)), F.lit("outline"))),
        F.transform("_parts", lambda w: _member(w, F.lit("part"))))
    kind = F.struct(F.lit("type").alias("k"), F.lit("building").alias("v"))
    return tagged.select(
        "request_id", ids.relation_id(F.col("id"), fv.RELATION_KIND_BUILDING).alias("relation_id"),
        members.alias("members"), F.concat(F.array(kind), "_tags").alias("tags"))


def relation_elements(emitted: DataFrame, current_year: int) -> DataFrame:
    return multipolygon_relations(emitted, current_year).unionByName(part_relations(emitted, current_year))


def output_counts(rows: DataFrame, emitted: DataFrame, requests: DataFrame, current_year: int) -> DataFrame:
    """Per request: buildings, ways, relations, nodes, dropped far parts, nodes out of range."""
    dropped = rows.groupBy("request_id").agg(
        F.count_if(F.col("intersects_parent") == F.lit(False)).alias("dropped_far_parts"))
    rings = _ring_rows(emitted)
    ways = rings.groupBy("request_id").agg(F.count("*").alias("ways"))
    drawn = emitted.groupBy("request_id").agg(F.count("*").alias("buildings"))
    points = rings.select("request_id", F.explode("nodes").alias("n")).select(
        "request_id", _point_id(F.col("n")).alias("node_id"),
        ids.node_id_in_range(numbers.quantise(F.col("n.lat")), numbers.quantise(F.col("n.lon"))).alias("ok"))
    # Two steps, so that the distinct count folds before the request's rows meet.
    nodes = points.groupBy("request_id", "node_id").agg(F.count_if(~F.col("ok")).alias("bad")).groupBy(
        "request_id").agg(F.count("*").alias("nodes"), F.sum("bad").alias("out_of_range"))
    relations = relation_elements(emitted, current_year).groupBy("request_id").agg(
        F.count("*").alias("relations"))
    out = requests.select("request_id")
    for part in (drawn, ways, relations, nodes, dropped):
        out = out.join(part, "request_id", "left")
    return out.fillna(0)


def duplicate_ids(ways: DataFrame, relations: DataFrame) -> DataFrame:
    """(kind, id) used twice in one response; empty while the id formulas hold."""
    both = ways.select("request_id", F.lit("way").alias("kind"), F.col("way_id").alias("element_id")).unionByName(
        relations.select("request_id", F.lit("relation").alias("kind"), F.col("relation_id").alias("element_id")))
    return both.groupBy("request_id", "kind", "element_id").agg(F.count("*").alias("uses")).filter("uses > 1")


def dangling_refs(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    refs = ways.select("request_id", F.explode("refs").alias("node_id")).distinct()
    return refs.join(nodes, ["request_id", "node_id"], "left_anti")


# ---- documents -----------------------------------------------------------

def _attributes(ident: Column) -> list[Column]:
    return [F.lit('id="'), ident.cast("string"), F.lit('" visible="true" version="1"')]


def _tags_xml(tags: Column) -> Column:
    return F.array_join(F.transform(tags, lambda t: F.concat(
        F.lit('<tag k="'), t["k"], F.lit('" v="'), xml_escape(strip_control(t["v"])), F.lit('"/>'))), "")


def document_lines(requests: DataFrame, nodes: DataFrame, ways: DataFrame, relations: DataFrame) -> DataFrame:
    """(request_id, section, element_id, line): header, nodes, ways, relations, footer.

    A request without elements gets the empty document. Sorting a request by
    (section, element_id descending) and joining its lines gives the document.
    """
    n = nodes.select("request_id", F.lit(1).alias("section"), F.col("node_id").alias("element_id"), F.concat(
        F.lit("<node "), *_attributes(F.col("node_id")), F.lit(' lat="'), "lat", F.lit('" lon="'), "lon",
        F.lit('"/>')).alias("line"))
    w = ways.select("request_id", F.lit(2).alias("section"), F.col("way_id").alias("element_id"), F.concat(
        F.lit("<way "), *_attributes(F.col("way_id")), F.lit(">"),
        F.array_join(F.transform("refs", lambda r: F.concat(
            F.lit('<nd ref="'), r.cast("string"), F.lit('"/>'))), ""),
        _tags_xml(F.col("tags")), F.lit("</way>")).alias("line"))
    r = relations.select("request_id", F.lit(3).alias("section"), F.col("relation_id").alias("element_id"), F.concat(
        F.lit("<relation "), *_attributes(F.col("relation_id")), F.lit(">"),
        F.array_join(F.transform("members", lambda m: F.concat(
            F.lit('<member type="way" ref="'), m["ref"].cast("string"), F.lit('" role="'), m["role"],
            F.lit('"/>'))), ""),
        _tags_xml(F.col("tags")), F.lit("</relation>")).alias("line"))
    used = ways.select("request_id").distinct().withColumn("_used", F.lit(True))
    ends = requests.select("request_id").join(used, "request_id", "left").select(
        "request_id", F.explode(F.when(F.col("_used"), F.array(
            F.struct(F.lit(0).alias("section"), F.lit(
                f'<?xml version="1.0" encoding="UTF-8"?>\n<osm version="0.6" generator="{GENERATOR}">').alias("line")),
            F.struct(F.lit(4).alias("section"), F.lit("</osm>").alias("line")))).otherwise(F.array(
                F.struct(F.lit(0).alias("section"), F.lit(
                    f'<?xml version="1.0" encoding="UTF-8"?>\n{EMPTY_DOCUMENT}').alias("line"))))).alias("e"))
    e = ends.select("request_id", "e.section", F.lit(0).cast("bigint").alias("element_id"), "e.line")
    return n.unionByName(w).unionByName(r).unionByName(e)


def write_documents(lines: DataFrame, path: str) -> None:
    """Text files whose lines, in file order, are the documents one after another.

    A range shuffle: a huge document spans several files instead of one task.
    """
    ordered = lines.withColumn("_back", -F.col("element_id"))
    (ordered.repartitionByRange("request_id", "section", "_back")
     .sortWithinPartitions("request_id", "section", "_back").select("line").write.text(path))
