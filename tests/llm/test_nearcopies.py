"""Near copies against all pairs."""

import random
from collections import Counter

import numpy as np
import pytest
from test_llm import LONG, RAW, SCHEMA, reached

from meshfold.llm import nearcopies, simhash
from meshfold.llm.common import table


def words_of(text):
    return (text or "").encode().lower().split()


def alike(s, t):
    a, b = (set(zip(*(w[i:] for i in range(5)))) or {tuple(w)} for w in (s, t))
    return s == t or len(a & b) >= 0.8 * len(a | b)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10 ** 6)}"
    return words


def corpus(rng, families, sizes=(60, 400)):
    vocabulary = [f"v{i}" for i in range(4000)]
    texts = []
    for _ in range(families):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(*sizes))]
        texts += [base, *(edited(rng, base, max(1, len(base) // 70)) for _ in range(rng.choice([0, 0, 1, 4])))]
    return [" ".join(w) for w in texts]


def test_orders_of_bits_go_back():
    x = np.random.default_rng(1).integers(0, 2 ** 64, 500, dtype=np.uint64)
    for way in range(5):
        y = nearcopies.read(x, way)
        assert (nearcopies.unread(y, way) == x).all()
        assert (np.bitwise_count(y[1:] ^ y[:-1]) == np.bitwise_count(x[1:] ^ x[:-1])).all()


def test_shortest_forest():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 60, 400), rng.integers(0, 60, 400)
    w = rng.integers(0, 9, 400)
    keep = nearcopies.forest(60, a, b, w)
    label, total, number = list(range(60)), 0, 0
    for i in sorted(range(400), key=lambda i: w[i]):  # link by link
        if label[a[i]] != label[b[i]]:
            total, number = total + w[i], number + 1
            label = [label[a[i]] if x == label[b[i]] else x for x in label]
    assert (w[keep].sum(), len(keep)) == (total, number)


@pytest.mark.parametrize("crowded", [1024, 8])
def test_links_within_the_budget(make, crowded):
    rng = random.Random(crowded)
    prints = {rng.getrandbits(64) for _ in range(200)}
    for x in list(prints):
        for _ in range(rng.choice([0, 1, 3])):
            for bit in rng.sample(range(64), rng.randint(1, 9)):
                x ^= 1 << bit
            prints.add(x)
    prints = sorted(x - (1 << 64) if x >> 63 else x for x in prints)
    near = {(a, b) for i, b in enumerate(prints) for a in prints[:i] if ((a ^ b) & (2 ** 64 - 1)).bit_count() <= 9}
    got = {(r.a, r.b) for r in nearcopies.links(make([(x,) for x in prints], "fp bigint"), 9, recall=0.999, unit=8,
                                                crowded=crowded).collect()}
    assert got <= near
    where = {x: i for i, x in enumerate(prints)}
    label = lambda pairs: reached(len(prints), [(where[a], where[b]) for a, b in pairs])
    if crowded > 8:
        assert label(got) == label(near)
    assert sum(x != y for x, y in zip(label(got), label(near))) <= 0.05 * len(prints)


def test_one_of_each_group_stays(make):
    rng = random.Random(5)
    texts = corpus(rng, 150)
    texts += [t.upper() + "\n" for t in texts[:20]] + ["", None, " \n", "one word", "One  word", LONG, LONG + " more"]
    ids = [rng.choice([i, i, i % 40, None]) for i in range(len(texts))]
    words = [words_of(t) for t in texts]
    near = [(i, j) for i in range(len(texts)) for j in range(i) if alike(words[i], words[j])]
    label = reached(len(texts), near)
    rows = [(i, t, "r", "f", "m") for i, t in zip(ids, texts)]
    docs = make(rows, SCHEMA + ", row string, FP string, mark string").repartition(3)
    got = nearcopies.keep_one(docs)
    assert got.columns == docs.columns
    kept = Counter((r.doc_id, r.text) for r in got.collect())
    groups = {}
    for i, t, g in zip(ids, texts, label):
        groups.setdefault(g, []).append((i is None, i, t))
    # Fingerprints miss a few pairs near the bound; none of the groups goes, and its least id always stays.
    assert len(groups) <= sum(kept.values()) <= len(groups) + 0.1 * (len(texts) - len(groups))
    ids_kept = {i for i, _ in kept}
    assert all(min(m[:2] for m in members)[1] in ids_kept for members in groups.values() if not all(m[0] for m in members))


def test_a_dense_group_of_near_copies_leaves_one(make):
    rng = random.Random(6)
    base = [f"w{rng.randrange(5000)}" for _ in range(300)]
    texts = [" ".join(edited(rng, base, 3)) for _ in range(500)] + corpus(rng, 60)  # two share 0.81 and more
    kept = nearcopies.keep_one(make([(i, t) for i, t in enumerate(texts)], SCHEMA).repartition(3)).collect()
    assert sum(r.doc_id < 500 for r in kept) == 1


def test_every_link_counts(make):
    """Families at the bound, where a group hangs on few links, and distant pairs: the groups are those of all pairs."""
    rng = random.Random(8)
    base = [f"w{rng.randrange(5000)}" for _ in range(300)]
    texts = [" ".join(edited(rng, base, rng.choice([3, 4, 5, 6]))) for _ in range(150)]
    for words in range(20, 200, 3):
        pair = [rng.choice(base) + str(rng.randrange(90)) for _ in range(words)]
        texts += [" ".join(pair), " ".join(pair + [f"x{i}" for i in range(max(1, (words - 4) // 4))])]  # 0.8 where it divides
    sets = [set(zip(*(t.split()[i:] for i in range(5)))) for t in texts]
    near = [(i, j) for i, s in enumerate(sets) for j in range(i) if len(s & sets[j]) >= 0.8 * len(s | sets[j])]
    label = reached(len(texts), near)
    first = {g: i for i, g in reversed(list(enumerate(label)))}
    kept = nearcopies.keep_one(make(list(enumerate(texts)), SCHEMA).repartition(3)).collect()
    assert {r.doc_id for r in kept} == set(first.values())


def test_sketches_and_prefixes_never_lose_a_pair():
    rng = np.random.default_rng(4)
    common = np.sort(rng.integers(0, 2 ** 64, 300, np.uint64))
    for _ in range(300):
        n = int(rng.integers(1, 400))
        both = np.concatenate([rng.integers(0, 2 ** 64, n, np.uint64), rng.choice(common, n // 4, replace=False) if n // 4 <= 300 else common])
        own = rng.integers(0, 2 ** 64, len(both) // 4, np.uint64)
        cut = int(rng.integers(0, len(own) + 1))
        s, t = np.unique(np.concatenate([both, own[:cut]])), np.unique(np.concatenate([both, own[cut:]]))
        assert set(nearcopies.prefix(s, common, 0.8)) & set(nearcopies.prefix(t, common, 0.8))
        bits = [np.unpackbits(np.frombuffer(nearcopies.sketch(x), np.uint8)) for x in (s, t)]
        assert (bits[0] != bits[1]).sum() <= len(np.setxor1d(s, t))


def test_recall_on_the_documents(spark, make):
    """Of the documents that have a near copy of a smaller id, at least nine tenths go."""
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = docs.select("doc_id", "text").collect()
    kept = {r.doc_id for r in nearcopies.keep_one(docs).collect()}
    words = {r.doc_id: words_of(r.text) for r in rows}
    sets = {i: frozenset(zip(*(w[k:] for k in range(5)))) or frozenset([tuple(w)]) for i, w in words.items()}
    due = [i for i, s in sets.items() if any(len(s & t) >= 0.8 * len(s | t) for j, t in sets.items() if j < i)]
    assert len(due) > 20 and sum(i not in kept for i in due) >= 0.9 * len(due)
    assert set(sets) - kept <= {i for i, s in sets.items() if any(
        j != i and len(s & t) >= 0.8 * len(s | t) for j, t in sets.items())}


def test_empty_and_awkward_tables(make):
    assert nearcopies.keep_one(make([], SCHEMA)).count() == 0
    assert nearcopies.keep_one(make([(None, None), (None, "")], SCHEMA)).count() == 1
    kept = nearcopies.keep_one(make(RAW, SCHEMA)).collect()
    assert len(kept) == len({tuple(words_of(t)) for _, t in RAW})
    assert simhash.fingerprint(b"") == 0


@pytest.mark.parametrize("size", [3, 40, 700, 5000])
def test_long_sketches_never_take_out_a_near_pair(size):
    rng, taken = np.random.default_rng(size), 0
    for other in (size, round(size * 0.81), size * 3):
        for shared in np.linspace(0, min(size, other), 25).astype(int):
            x = rng.integers(0, 2 ** 64, size + other - shared, dtype=np.uint64)
            s, t = np.unique(x[:size]), np.unique(x[size - shared:])
            kept = nearcopies.may_be_alike(nearcopies.long_sketch(s), nearcopies.long_sketch(t), 0.8)
            assert kept or shared < 0.8 * (size + other - shared)
            taken += not kept
    assert taken >= (50 if size >= 40 else 25)  # most of the pairs that are far apart end here


def test_shingles_are_sent_for_near_pairs_only(make, monkeypatch):
    rng, sent = random.Random(5), []
    similar = nearcopies._similar
    monkeypatch.setattr(nearcopies, "_similar", lambda pairs, sets, s: sent.append(sets.count()) or similar(pairs, sets, s))
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(3000)]
    texts = [" ".join(base[:1200] + [f"x{i}y{rng.randrange(10 ** 6)}" for _ in range(1800)]) for i in range(40)]
    texts += [" ".join(base), " ".join([*base[:-9], *"a b c d e f g h i".split()])]
    kept = nearcopies.keep_one(make([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")).count()
    assert kept == 41 and max(sent) <= 4  # texts with a common first part meet, but are far apart


def test_texts_stay_where_they_are(make):
    docs = make([(i, str(i), f"{i} " * 30) for i in range(40)], "doc_id long, part string, text string").repartition(4)
    kept = nearcopies.keep_one(docs)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.split("Exchange")[1:] if "FileScan" in line and "text#" in line.split("FileScan")[1]]
    assert "Bucketed: true" in plan and not moved
    assert kept.columns == docs.columns and kept.count() == 40
