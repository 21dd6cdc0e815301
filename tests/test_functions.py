import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from meshfold.functions import geometry as g
from meshfold.functions import ids, numbers, text
from meshfold.sources import catalogue

POLY = "id int, rings array<array<struct<lon_i:bigint,lat_i:bigint>>>"


def one(make, rings):
    return make([(1, rings)], POLY)


def values(df, **columns):
    return df.select(*[c.alias(n) for n, c in columns.items()]).collect()


def test_quantise_agrees_with_seven_decimal_text(make):
    rng = random.Random(1)
    xs = [rng.uniform(20, 154) for _ in range(2000)]
    xs += [float(Decimal(rng.randrange(20 * 10**7, 154 * 10**7)) / 10**7 + Decimal("0.00000005"))
           for _ in range(2000)] + [35.00000015, -0.1234567]
    rows = make([(x,) for x in xs], "x double").select("x", numbers.quantise(F.col("x")).alias("q")).collect()
    assert all(r.q == int(f"{r.x:.7f}".replace(".", "")) for r in rows)


@pytest.mark.parametrize("raw", ["3d", "1_0", " 12.5 ", "inf", "nan", "1e2", "abc", "", "+.5", "1__0", "_1", "0x1", "5."])
def test_read_float(make, raw):
    got = make([(raw,)], "t string").select(numbers.read_float(F.col("t")).alias("v")).first().v
    try:
        want = float(raw)
    except ValueError:
        want = None
    if want is not None and (want != want or want in (float("inf"), float("-inf"))):
        want = None
    assert got == want


def test_infinite_text(make):
    rows = make([("inf",), ("-Infinity",), ("1e999",), ("3",), ("nan",), (None,)], "t string")
    assert [r[0] for r in rows.select(numbers.is_infinite_text(F.col("t"))).collect()] == [
        True, True, True, False, False, False]


@pytest.mark.parametrize("raw,good", [("0001", False), ("1987", True), ("9999", False), ("2020-05-01", True),
                                      (" 1999 ", True), ("abcd", False), ("", False), (None, False), ("999", False),
                                      ("2027", True), ("2028", False)])
def test_start_date(make, raw, good):
    assert make([(raw,)], "t string").select(text.plausible_start_date(F.col("t"), 2026)).first()[0] is good


def test_city_code_needs_ascii_digits(make):
    rows = make([("13101",), ("1310",), ("１３１０１",), ("131011",), ("13101\n",)], "t string")
    assert [r[0] for r in rows.select(text.is_city_code(F.col("t"))).collect()] == [True, False, False, False, False]


def test_ids_are_injective_at_the_range_ends(make):
    rows = make([(200000000, 1220000000), (460000000, 1540000000), (199999999, 1220000000)], "a bigint, o bigint")
    got = [r[0] for r in rows.select(ids.node_id(F.col("a"), F.col("o"), F.lit(9))).collect()]
    assert got == [-1, -83200000580000001, -9]


def test_dense_ids_are_consecutive_and_ordered(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("v"))
    rows = ids.dense_ids(df, ["v"], 5).orderBy("v").collect()
    assert [r.id for r in rows] == list(range(5, 1005))


def test_ring_key(make):
    def key(refs):
        return make([(refs,)], "r array<string>").select(g.ring_key(F.col("r"))).first()[0]

    base = key(["b", "a", "c", "d", "b"])
    assert base == key(["d", "c", "a", "b", "d"]) == key(["c", "d", "b", "a"])
    assert key(["a", "b", "a"]) is None and key([]) is None
    assert base != key(["a", "b", "c", "d", "a"])


def test_triangle_areas(make):
    def area(tri):
        return values(one(make, [tri]), a=g.triangle_area_m2(F.col("rings")[0]))[0].a

    base_lon, base_lat = 1390000000, 340000000
    assert 600 < area([(base_lon, base_lat), (base_lon + 4000, base_lat), (base_lon, base_lat + 3300)]) < 700
    assert area([(base_lon, base_lat), (base_lon + 10, base_lat), (base_lon + 20, base_lat)]) == 0


def test_wkt_round_trip(make):
    rings = [[(1390000000, 350000000), (1390000100, 350000000), (1390000100, 350000100)],
             [(1390000040, 350000010), (1390000050, 350000010), (1390000050, 350000020)]]
    df = one(make, rings)
    text_ = df.select(g.to_wkt(F.col("rings"))).first()[0]
    assert text_.startswith("POLYGON((139.0000000 35.0000000,139.0000100 35.0000000,")
    back = df.select(g.from_wkt(g.to_wkt(F.col("rings"))).alias("r")).first().r
    assert [[(p.lon_i, p.lat_i) for p in ring] for ring in back] == rings
    assert df.select(g.from_wkt(F.lit("POINT(1 2)"))).first()[0] is None


@pytest.mark.parametrize("side", [1000, 3_000_000, 50_000_000, 300_000_000])
def test_centroid_of_small_and_very_wide_rings(make, side):
    x, y = 1390000000, 350000000
    df = one(make, [[(x, y), (x + side, y), (x + side, y + side), (x, y + side)]])
    m = g.moments(F.col("rings"))
    r = df.select(m["a"].alias("a"), g.centroid(F.col("rings"), m).alias("c")).first()
    assert r.a == 2 * side * side
    assert r.c.lon == pytest.approx(x + side / 2, rel=1e-12) and r.c.lat == pytest.approx(y + side / 2, rel=1e-12)


def test_point_on_surface_and_null(make):
    ell = [(0, 0), (10, 0), (10, 2), (2, 2), (2, 10), (0, 10)]
    donut = [[(0, 0), (30, 0), (30, 30), (0, 30)], [(5, 5), (25, 5), (25, 25), (5, 25)]]
    df = make([(1, [ell]), (2, donut), (3, None), (4, [])], POLY).withColumn("e", g.edges(F.col("rings")))
    df = df.withColumn("p", g.point_on_surface(F.col("rings"), F.col("e"), g.scan_line(F.col("rings"))))
    rows = {r.id: r for r in df.select("id", "p", g.contains_point(F.col("e"), F.col("p.lon"), F.col("p.lat"))
                                       .alias("inside")).collect()}
    assert rows[1].inside and rows[2].inside
    assert rows[3].p is None and rows[4].p is None


def test_validity(make):
    square = [(0, 0), (10, 0), (10, 10), (0, 10)]
    cases = {
        1: ([square], True), 2: ([[(0, 0), (10, 10), (10, 0), (0, 10)]], False),
        3: ([[(0, 0), (5, 0), (10, 0)]], False), 4: ([square, [(2, 2), (4, 2), (4, 4), (2, 4)]], True),
        5: ([square, [(8, 8), (14, 8), (14, 14), (8, 14)]], False), 6: ([[(0, 0), (1, 1)]], False), 7: (None, None)}
    df = make([(k, v[0]) for k, v in cases.items()], POLY)
    got = df.select("id", g.is_valid(F.col("rings"), g.edges(F.col("rings")), g.area2(F.col("rings"))).alias("v"))
    assert {r.id: r.v for r in got.collect()} == {k: v[1] for k, v in cases.items()}


# ---- predicates against brute force --------------------------------------

def _star(rng, cx, cy, r):
    import math

    n = rng.randrange(3, 8)
    angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
    return [(int(cx + rng.uniform(0.3, 1) * r * math.cos(a)), int(cy + rng.uniform(0.3, 1) * r * math.sin(a)))
            for a in angles]


def _orient(a, b, p):
    v = (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])
    return (v > 0) - (v < 0)


def _on(a, b, p):
    return (_orient(a, b, p) == 0 and min(a[0], b[0]) <= p[0] <= max(a[0], b[0])
            and min(a[1], b[1]) <= p[1] <= max(a[1], b[1]))


def _meet(a, b, c, d):
    if _orient(a, b, c) != _orient(a, b, d) and _orient(c, d, a) != _orient(c, d, b):
        return True
    return _on(a, b, c) or _on(a, b, d) or _on(c, d, a) or _on(c, d, b)


def _edges(p):
    return list(zip(p, p[1:] + p[:1]))


def _covers(poly, p):
    if any(_on(a, b, p) for a, b in _edges(poly)):
        return True
    return sum((a[1] > p[1]) != (b[1] > p[1]) and
               p[0] * (b[1] - a[1]) * (1 if b[1] > a[1] else -1) <
               ((b[0] - a[0]) * (p[1] - a[1]) + a[0] * (b[1] - a[1])) * (1 if b[1] > a[1] else -1)
               for a, b in _edges(poly)) % 2 == 1


def _intersect(p, q):
    return (any(_meet(a, b, c, d) for a, b in _edges(p) for c, d in _edges(q))
            or _covers(p, q[0]) or _covers(q, p[0]))


def test_polygon_and_box_predicates_against_brute_force(make):
    rng = random.Random(7)
    rows = []
    for i in range(400):
        a = _star(rng, rng.randrange(0, 60), rng.randrange(0, 60), rng.randrange(5, 30))
        b = _star(rng, rng.randrange(0, 60), rng.randrange(0, 60), rng.randrange(5, 30))
        w, s = rng.randrange(0, 60), rng.randrange(0, 60)
        rows.append((i, [a], [b], w, s, w + rng.randrange(1, 25), s + rng.randrange(1, 25)))
    df = make(rows, "id int, a array<array<struct<lon_i:bigint,lat_i:bigint>>>, "
                    "b array<array<struct<lon_i:bigint,lat_i:bigint>>>, w bigint, s bigint, e bigint, n bigint")
    got = df.select("id", g.polygons_intersect(g.edges(F.col("a")), g.edges(F.col("b"))).alias("pp"),
                    g.box_intersects(g.edges(F.col("a")), F.col("w"), F.col("s"), F.col("e"), F.col("n")).alias("pb"),
                    g.covers_point(g.edges(F.col("a")), F.col("w"), F.col("s")).alias("pt")).collect()
    for r in got:
        _, a, b, w, s, e, n = rows[r.id]
        a, b = a[0], b[0]
        assert r.pp == _intersect(a, b), rows[r.id]
        assert r.pb == _intersect(a, [(w, s), (e, s), (e, n), (w, n)]), rows[r.id]
        assert r.pt == _covers(a, (w, s)), rows[r.id]


def test_catalogue_in_script_notation(make):
    pages = make([
        (1, """const cities = [{citycode: '13101', 'cityname': "Chiyoda", folder: '', lng: 139.75}, // first
            {'citycode': '13102', cityname: 'O\\'Hara',}, {broken, {cityname: 'no code'}];"""),
        (2, 'const cities = [{"citycode": "13103", "folder": ""}];'), (3, "const cities = [];"), (4, None)],
        "page_id int, html string")
    rows = {(r.page_id, r.citycode): r for r in catalogue.cities(pages).collect()}
    assert set(rows) == {(1, "13101"), (1, "13102"), (2, "13103")}
    first = rows[1, "13101"]
    assert (first.cityname, first.folder, first.lng, first.lat) == ("Chiyoda", None, "139.75", None)
    assert rows[1, "13102"].cityname == "O'Hara"
    assert rows[2, "13103"].folder == ""


def test_degrees_text_and_quantise_at_the_edges(make):
    xs = [0, -1, 1, 9_999_999, 10_000_000, -1390000001, 2**60]
    rows = make([(x,) for x in xs], "x bigint").select("x", numbers.degrees_text(F.col("x")).alias("t")).collect()
    assert [r.t for r in rows] == ["0.0000000", "-0.0000001", "0.0000001", "0.9999999", "1.0000000", "-139.0000001",
                                   "115292150460.6846976"]
    ys = [9_999.99999995, 12_345.00000005, -0.00000005, 0.00000015, None]
    q = make([(y,) for y in ys], "y double").select("y", numbers.quantise(F.col("y")).alias("q")).collect()
    assert [r.q for r in q] == [None if r.y is None else int(f"{r.y:.7f}".replace(".", "")) for r in q]
