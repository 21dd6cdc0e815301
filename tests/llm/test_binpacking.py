"""Hierarchical best-fit packing: whole pieces, tight windows, any number of rounds."""

from collections import Counter, defaultdict

import numpy as np
import pytest

from meshfold.llm import binpacking, tokens
from meshfold.llm.common import table
from test_llm import RAW, SCHEMA, direct_ids

SF = "/root/testdata/sf0.01"


def slow_best_fit(sizes, window):
    """Best fit decreasing by looking at every bin."""
    rooms, result = [], [None] * len(sizes)
    for item in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fits = [(room, b) for b, room in enumerate(rooms) if room >= sizes[item]]
        if not fits:
            rooms.append(window)
            fits = [(window, len(rooms) - 1)]
        b = min(fits)[1]
        rooms[b] -= sizes[item]
        result[item] = b
    return result, rooms


def test_best_fit_equals_looking_at_every_bin():
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 400):
        sizes = rng.integers(1, 60, n)
        got = binpacking.best_fit(sizes, 64)
        want, rooms = slow_best_fit(sizes.tolist(), 64)
        assert n == 0 or got.max() + 1 == len(rooms)
        used = np.bincount(got, sizes, max(len(rooms), 1))
        assert sorted(64 - used[:len(rooms)]) == sorted(rooms)


def checked(rows, window, texts):
    """Every id once, whole pieces, gapless sequences; the fills of all sequences."""
    ids = {i: direct_ids(t) for i, t in texts.items()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        assert len(r.ids) == 4 * r.length and r.start == r.piece * window
        pieces[r.doc_id].append((r.piece, np.frombuffer(r.ids, "<u4").tolist()))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(ids)
    for i, own in ids.items():
        parts = [p for _, p in sorted(pieces[i])]
        assert [k for k, _ in sorted(pieces[i])] == list(range(-(-len(own) // window)))
        assert [x for p in parts for x in p] == own and all(len(p) == window for p in parts[:-1])
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    return [sum(n for _, n in s) for s in sequences.values()]


@pytest.mark.parametrize("portion, group", [(1 << 22, 1 << 17), (3000, 1 << 17), (600, 7), (600, 2)])
def test_few_sequences_in_any_number_of_rounds(spark, portion, group):
    docs = table(spark, SF, "documents").limit(400)
    texts = {r.doc_id: r.text for r in docs.collect()}
    docs = spark.createDataFrame(list(texts.items()), SCHEMA).repartition(6)
    rows = binpacking.pack(docs, tokens.word_bpe_path(), window=512, slack=2, portion_ids=portion, group_bins=group).collect()
    fills = checked(rows, 512, texts)
    sizes = [n for t in texts.values() for n in [512] * (len(direct_ids(t)) // 512) + [len(direct_ids(t)) % 512] if n]
    _, rooms = slow_best_fit(sizes, 512)
    least = -(-sum(sizes) // 512)
    assert len(fills) <= len(rooms) + max(2, 0.01 * least) if group > 7 else len(fills) <= 1.08 * len(rooms)


def test_items_that_never_fit_together_end_the_climb(make):
    rows = {i: "word " * (30 + i % 9) for i in range(300)}  # all beyond half a window
    got = binpacking.pack(make(list(rows.items()), SCHEMA).repartition(4), tokens.word_bpe_path(), window=50, slack=1,
                          portion_ids=200, group_bins=16).collect()
    assert len(checked(got, 50, rows)) == 300


def test_bins_of_other_tasks_fill_the_room(make):
    rows = {i: "word " * (29 if i % 2 else 19) for i in range(400)}  # 30 and 20 ids, apart from each other
    docs = make(sorted(rows.items(), key=lambda r: r[0] % 2), SCHEMA).repartitionByRange(8, "doc_id")
    docs = docs.unionByName(docs.limit(0))
    fills = checked(binpacking.pack(docs, tokens.word_bpe_path(), window=50, slack=0, portion_ids=100,
                                    group_bins=1 << 17).collect(), 50, rows)
    assert len(fills) == 200


def test_awkward_rows(make):
    docs = make([(i, t, 1, "b") for i, t in RAW], SCHEMA + ", piece int, bin string")
    rows = binpacking.pack(docs, tokens.word_bpe_path(), window=64).collect()
    got = Counter((r.doc_id, r.piece, bytes(r.ids)) for r in rows)
    want = Counter()
    for i, t in RAW:
        ids = np.array(direct_ids(t), "<u4")
        want.update((i, k, ids[64 * k:64 * k + 64].tobytes()) for k in range(-(-len(ids) // 64)))
    assert got == want
    named = binpacking.pack(make([("a", "x y"), (None, None)], "name string, body string"), tokens.word_bpe_path(),
                            doc_id="name", text="body").collect()
    assert {r.doc_id for r in named} == {"a", None} and len({r.sequence_id for r in named}) == 1
    assert binpacking.pack(make([], SCHEMA), tokens.word_bpe_path()).count() == 0
