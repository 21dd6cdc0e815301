"""The first places of requests are found in strips: the rows of the whole search, from few pairs."""

import random

from pyspark.sql import functions as F

from meshfold.operators import dedup
from meshfold.plans import bbox_query

X, Y = 1390000000, 356000000
READY = ("id bigint, building_part string, rank bigint, place bigint, copies bigint, key_lon bigint, min_lon bigint, "
         "min_lat bigint, max_lon bigint, max_lat bigint, cen_lon double, cen_lat double")
RINGS = "id bigint, rings array<array<struct<lon_i:bigint,lat_i:bigint>>>"
REQ = "request_id bigint, row_limit int, west bigint, south bigint, east bigint, north bigint"


def ranked(make, spots, parts=()):
    """``prepared`` rows and shapes of triangles whose corner is at each spot; equal spots are copies of one place."""
    rows, shapes = [], []
    for i, (x, y) in enumerate(spots, 1):
        cx, cy = x + 200 / 3 * 2, y + 200 / 3
        rows.append((round(cx / 10), round(cy / 10), i, x, y, cx, cy))
        shapes.append((i, [[(x, y), (x + 200, y), (x + 200, y + 200)]]))
    rows.sort()
    first, count = {}, {}
    for rank, r in enumerate(rows, 1):
        first.setdefault(r[:2], rank)
        count[r[:2]] = count.get(r[:2], 0) + 1
    ready = [(i, "yes" if i in parts else None, rank, first[kx, ky], count[kx, ky], kx, x, y, x + 200, y + 200, cx, cy)
             for rank, (kx, ky, i, x, y, cx, cy) in enumerate(rows, 1)]
    return make(ready, READY).repartition(4).localCheckpoint(), make(shapes, RINGS)


def towns(n, rng):
    """Half in one crowded town, the rest anywhere; a third are copies."""
    spots = [(X + rng.randrange(700000, 720000), Y + rng.randrange(0, 500000)) if rng.random() < 0.5 else
             (X + rng.randrange(0, 1000000), Y + rng.randrange(0, 500000)) for _ in range(n)]
    return spots + rng.sample(spots, n // 3)


def pairs_made(monkeypatch):
    """A list that gets the number of pairs of every search for first copies."""
    made, plain = [], bbox_query.first_copies

    def counted(pairs):
        made.append(pairs.count())
        return plain(pairs)

    monkeypatch.setattr(bbox_query, "first_copies", counted)
    return made


def test_a_limit_is_filled_from_few_pairs(make, monkeypatch):
    """A box over 4,000 outlines with a limit of 5 meets a strip of them."""
    rng = random.Random(3)
    ready, shapes = ranked(make, [(X + rng.randrange(0, 900000), Y + rng.randrange(0, 900000)) for _ in range(4000)])
    ask = make([(i, 5, X - 1000 - i, Y - 1000, X + 1000000, Y + 1000000) for i in range(20)], REQ)
    for mode in ("intersects", "centroid"):
        made = pairs_made(monkeypatch)
        got = bbox_query.outlines(ask, ready, shapes, mode).collect()
        monkeypatch.undo()
        assert len(got) == 100 and {r.id for r in got} == {r.id for r in ready.orderBy("rank").limit(5).collect()}
        assert sum(made) < 20 * 400  # 80,000 before


def test_strips_give_what_the_whole_search_gives(make):
    """Limits from none to more than there is, towns beyond empty land, request ids of several boxes and limits, boxes without extent."""
    rng = random.Random(5)
    ready, shapes = ranked(make, towns(1500, rng))
    rows = []
    for i in range(40):
        w, s = X + rng.randrange(-100000, 900000), Y + rng.randrange(-100000, 450000)
        rows.append((i, rng.choice([0, 1, 3, 8, 20, 5000]), w, s, w + rng.choice([0, 3000, 90000, 600000, 40000000]),
                     s + rng.choice([0, 20000, 300000, 40000000])))
    rows += [(100, 4, X, Y, X + 300000, Y + 300000), (100, 4, X + 650000, Y, X + 900000, Y + 400000),
             (100, 9, X, Y, X + 500000, Y + 500000), (None, 6, X, Y, X + 900000, Y + 500000), rows[7], (101, None, X, Y, X + 1, Y + 1)]
    ask = make(rows, REQ)
    for mode in ("intersects", "centroid"):
        pairs = bbox_query.first_copies(bbox_query.outline_candidates(ask, ready, shapes, mode))
        want = dedup.limit_per_group(pairs, ["request_id"], [F.col("place")], "row_limit", ["rank"])
        got = bbox_query.first_places(ask, ready, shapes, mode)
        if mode == "centroid":
            assert want.count() > 150
        # Equal places of one request id with two limits are ranked in any order, so ids with one limit are compared by row.
        def rows_of(df):
            return sorted((str(r.request_id), r.place, r.rank) for r in df.filter("request_id is null or request_id <> 100").collect())
        assert rows_of(got) == rows_of(want)
        assert got.filter("request_id = 100").count() == want.filter("request_id = 100").count()


def test_observability_counts_all_and_shows_up_to_the_limit(make, monkeypatch):
    rng = random.Random(7)
    spots = towns(600, rng)
    ready, shapes = ranked(make, spots)
    ask = make([(1, 5, X - 1000, Y - 1000, X + 2000000, Y + 900000), (2, 5000, X - 1000, Y - 1000, X + 2000000, Y + 900000),
                (3, 5, X - 90000, Y - 90000, X - 50000, Y - 50000)], REQ)
    made = pairs_made(monkeypatch)
    got = {r.request_id: tuple(r)[1:] for r in bbox_query.observability(ask, ready, shapes).collect()}
    places = len(set(spots))
    assert got == {1: (800, 5, True, None), 2: (800, places, False, 800 - places), 3: (0, 0, False, 0)}
    assert 0 < sum(made) < 1100  # the request that shows all, and a strip of the other


def test_parts_without_copies_are_not_folded(make, monkeypatch):
    """Parts that stand alone go on from where they are met; copies, and ids of several boxes, are folded still."""
    rng = random.Random(9)
    spots = [(X + rng.randrange(0, 400000), Y + rng.randrange(0, 400000)) for _ in range(300)]
    spots += spots[:10]
    ready, shapes = ranked(make, spots, range(1, len(spots) + 1))
    ask = make([(1, 5, X - 9, Y - 9, X + 500000, Y + 500000), (1, 5, X - 9, Y - 9, X + 500000, Y + 500000),
                (2, 5, X - 9, Y - 9, X + 200000, Y + 500000), (3, 5, X - 9, Y - 9, X + 200000, Y + 500000),
                (3, 5, X + 100000, Y - 9, X + 500000, Y + 500000)], REQ)
    pairs = bbox_query.candidates(ask, ready, "intersects", shapes)
    want = sorted(map(tuple, bbox_query._ids(bbox_query.first_copies(pairs), ready).collect()))
    made = pairs_made(monkeypatch)
    got = sorted(map(tuple, bbox_query.orphan_parts(ask, ready, shapes).collect()))
    assert got == want and got.count((1, 20)) == 1 and len([g for g in got if g[0] == 1]) == 300
    assert 0 < sum(made) < pairs.count() - 300
