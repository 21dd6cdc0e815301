"""The ten operators against brute force, on small tables with awkward rows."""

import gzip
import hashlib
import json
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from meshfold.llm import (components, ctw, decontaminate, importance, packing, pii, quality, simhash, tokenfiles,
                          tokens, urlfilter, warc)
from meshfold.llm.common import unused
from meshfold.session import new_folder

LONG = " ".join(f"w{i % 977}" for i in range(30_000))
RAW = [(1, "the cat sat on the mat and the dog ran"), (2, "the cat sat on the mat and the dog ran"), (3, None),
       (4, ""), (5, LONG), (5, "a second row of five"), (None, "no id here, ÄÖ ü é"), (7, "the cat sat on the mat and the dog run"),
       (7, "a second row of five"), (8, "  \t\n "), (9, "tie tie tie tie"), (10, "x" * 50_000)]
SCHEMA = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def docs(make):
    """Nulls, empty and long texts, repeated rows and ids, and columns named like the operators' own."""
    return make([(i, t, "fp", "row", 0.5, "h") for i, t in RAW], SCHEMA + ", fp string, row string, score double, hits string")


@pytest.fixture(scope="module")
def none(make):
    return make([], SCHEMA)


def direct_ids(text):
    found = tokens.encoder(tokens.word_bpe_path()).tokenizer.encode(text or "", add_special_tokens=False)
    return [*found.ids, 1]


def test_encoder_equals_the_tokenizer():
    texts = [t for _, t in RAW] + ["I'LL can't <|endoftext|> A<|ENDOFTEXT|>b", "İ J̌ é ½ª ﬁ 中文 K ΑΣ Σ.", "12.5€. x\x1cq c'S!!"]
    got = tokens.Encoder(tokens.word_bpe_path(), cache_words=64).encode(texts)
    assert [g.tolist() for g in got] == [direct_ids(t) for t in texts]


# 1, 8


def test_packing_holds_every_id_once(docs, none):
    path = tokens.word_bpe_path()
    rows = packing.pack(docs, path, window=64, shard_tokens=4096).collect()
    left = Counter((i, tuple(direct_ids(t))) for i, t in RAW)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        assert len(r.ids) == 4 * r.length
        pieces[r.doc_id, r.doc_tokens].append((r.start, r.length, np.frombuffer(r.ids, "<u4").tolist()))
        sequences[r.sequence_id].append((r.offset, r.length))
    for (doc, size), n in Counter((i, len(x)) for i, x in left.elements()).items():
        assert sum(p[1] for p in pieces[doc, size]) == n * size
        if n == 1:
            whole = [x for _, _, part in sorted(pieces[doc, size]) for x in part]
            assert left[doc, tuple(whole)] == 1
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    short = sum(sum(n for _, n in s) < 64 for s in sequences.values())
    assert short <= 1 + sum(len(x) for x in left) // 4096
    assert packing.pack(none, path).count() == 0


def test_neighbours_rank_as_bm25_by_hand():
    rng = random.Random(1)
    pieces = [np.array([rng.randrange(30) for _ in range(rng.randint(1, 20))], np.uint32) for _ in range(40)]
    frequency = np.zeros(30)
    for p in pieces:
        frequency[np.unique(p)] += 1
    mean = np.mean([len(p) for p in pieces])
    model = packing.Bm25(frequency, 40, mean)
    index = packing.Index(pieces, model)
    for q in range(40):
        for d in range(40):
            want = 0.0
            for t in set(pieces[q].tolist()):
                tf = (pieces[d] == t).sum()
                idf = math.log(1 + (40 - frequency[t] + 0.5) / (frequency[t] + 0.5))
                want += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(pieces[d]) / mean))
            assert index.scores(q)[d] == pytest.approx(want)
    seen = Counter()
    sequences = list(packing.fill(pieces, 16, model))
    for parts in sequences:
        for piece, first, count in parts:
            seen.update((piece, i) for i in range(first, first + count))
    assert seen == Counter((i, j) for i, p in enumerate(pieces) for j in range(len(p)))
    assert all(sum(c for *_, c in s) == 16 for s in sequences[:-1])


def test_windows_follow_the_whole_ranking():
    rng = np.random.default_rng(8)
    pieces = [rng.integers(0, 400, 40).astype(np.uint32) for _ in range(120)]
    frequency = np.bincount(np.concatenate([np.unique(p) for p in pieces]), minlength=400).astype(float)
    model = packing.Bm25(frequency, 120, 40.0)
    whole = packing.Index(pieces, model)
    ranked = [int(p) for p in np.argsort(-whole.scores(0), kind="stable") if p]
    first = next(packing.fill(pieces, 320, model))  # a seed of about 38 terms and seven neighbours
    assert [p for p, _, _ in first] == [0, *ranked[:7]]
    first = next(packing.fill(pieces, 4000, model))  # beyond the nearest 64
    assert [p for p, _, _ in first] == [0, *ranked[:99]]


def test_every_window_takes_the_best_unused_pieces():
    rng = np.random.default_rng(9)
    pieces = [rng.integers(0, 300, n).astype(np.uint32) for n in rng.integers(1, 60, 150)]
    frequency = np.bincount(np.concatenate([np.unique(p) for p in pieces]), minlength=300).astype(float)
    model = packing.Bm25(frequency, 150, float(np.mean([len(p) for p in pieces])))
    whole, left = packing.Index(pieces, model), [len(p) for p in pieces]
    for parts in packing.fill(pieces, 256, model):
        (seed, _, size), space = parts[0], 256
        assert seed == next(i for i, n in enumerate(left) if n)
        left[seed] -= size
        space -= size
        score = whole.scores(seed)
        ranked = sorted((i for i in range(150) if left[i]), key=lambda i: (-score[i], i))
        want, cut = [], None
        for rank, i in enumerate(ranked):
            if left[i] <= space:
                want.append((i, left[i]))
                space -= left[i]
            elif cut is None:
                cut = i
            if not space or cut is not None and rank >= 63:
                break
        if space and cut is not None:
            want.append((cut, space))
        assert [(i, n) for i, _, n in parts[1:]] == want
        for i, n in want:
            left[i] -= n
    assert not any(left)


def test_frequencies_are_counted_while_encoding(make, monkeypatch):
    seen = []
    monkeypatch.setattr(packing, "_statistics", lambda *a, real=packing._statistics: seen.append(real(*a)) or seen[-1])
    packing.pack(make(RAW, "doc_id long, text string").repartition(3), tokens.word_bpe_path(), window=64).count()
    ids = [direct_ids(t) for _, t in RAW]
    want = Counter(x for own in ids for x in set(own))
    got = {int(i): int(seen[0].frequency[i]) for i in np.nonzero(seen[0].frequency)[0]}
    assert got == dict(want) and seen[0].documents == len(ids)
    assert seen[0].mean_length == pytest.approx(sum(map(len, ids)) / len(ids))


def test_token_files_come_back_whole(spark, docs, none):
    folder = new_folder(spark, "t")
    tokenfiles.write(docs, folder, tokens.word_bpe_path(), sample_documents=4)
    rows = tokenfiles.read(spark, folder).orderBy("start").collect()
    assert [r.doc_id for r in rows] == sorted((i for i, _ in RAW), key=lambda i: -1 if i is None else i)
    at = 0
    for r in rows:
        assert (r.start, 4 * r.n_tokens) == (at, len(r.ids))
        at += r.n_tokens
    assert Counter((r.doc_id, bytes(r.ids)) for r in rows) == Counter(
        (i, np.array(direct_ids(t), "<u4").tobytes()) for i, t in RAW)
    name = spark.read.parquet(f"{folder}/manifest").first().file
    one = tokenfiles.TokenFile(folder, name)
    assert one.ids(one.index()[0])[-1] == 1  # one short document by its own frame
    empty = new_folder(spark, "t")
    tokenfiles.write(none, empty, tokens.word_bpe_path())
    assert tokenfiles.read(spark, empty).count() == 0


# 2


def test_pseudonyms_keep_format_and_validity():
    c = pii.Cipher(b"key")
    text = ("joe.99@mail3.example.com DE89 3704 0044 0532 0130 00, GB82WEST12345698765432 4111 1111 1111 1111 and "
            "4111-1111-1111-1111; 10.0.0.255 2024-02-29 02/03/2020 25/03/2020 31.12.1999 123-45-6789 +1 (017) 555-7713 "
            'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" 7536784127813050 4845168114407329')
    new, n = pii.replace(text, c)
    assert n >= 13 and pii.replace(new, c, back=True)[0] == text
    assert "7536784127813050" in new or pii.luhn([7, 5, 3, 6, 7, 8, 4, 1, 2, 7, 8, 1, 3, 0, 5]) == 0
    spaced, dashed = re.search(r"(\d{4} \d{4} \d{4} \d{4}) and (\d{4}-\d{4}-\d{4}-\d{4});", new).groups()
    digits = [int(x) for x in spaced.replace(" ", "")]
    assert spaced.replace(" ", "") == dashed.replace("-", "") and pii.luhn(digits[:-1]) == digits[-1]
    assert [len(w) for w in new.split() if "." not in w] == [len(w) for w in text.split() if "." not in w]
    for plain in ("4111111111111112", "300.1.1.1", "2023-02-29", "666-45-6789", "v1.2.3.4.5", "no number 12345"):
        assert pii.replace(plain, c) == (plain, 0)
    assert pii.replace("4111111111111111", pii.Cipher(b"other")) != pii.replace("4111111111111111", c)


@pytest.mark.parametrize("iban", ["GB82 WEST 1234 5698 7654 32", "NL91 ABNA 0417 1643 00", "IE29 AIBK 9311 5212 3456 78",
                                  "BE68 5390 0754 7034", "MT84 MALT 0110 0001 2345 MTLC AST0 01S", "NO93 8601 1117 947"])
@pytest.mark.parametrize("after", ["", " 500 EUR", " EUR 5", " 1234 and", ", or\nnot", " is WORD"])
def test_spaced_ibans_are_found_whatever_follows(iban, after):
    c = pii.Cipher(b"key")
    for before in ("", "Pay to ", "on 3 May to ", "(", "Ä "):
        text = before + iban + after
        new, n = pii.replace(text, c)
        assert n == 1 and new == before + pii._iban(c, iban, False) + after and iban not in new
        assert pii.replace(new, c, back=True) == (text, 1)


def test_search_goes_on_inside_invalid_matches():
    c = pii.Cipher(b"key")
    secret = next(x for x in (hashlib.md5(b"%d" % i).hexdigest().upper() for i in range(10_000)) if re.match("[A-F]{2}[0-9]{2}", x))
    for text, value in ((f"1235 {x}", x) for x in ("4111 1111 1111 1111", "5500 0000 0000 0004")):
        new, n = pii.replace(text, c)
        assert n == 1 and value not in new and new.startswith("1235 ")
    assert pii.replace(secret, c)[1] == 1 and pii.replace(f"XX12 {secret[:4]} 4111 1111 1111 1111", c)[1] == 1
    rng = random.Random(2)
    for _ in range(2000):  # the way back reads the same values, whatever stands around them
        digits = [rng.randrange(10) for _ in range(15)]
        card = "".join(map(str, [*digits, pii.luhn(digits)]))
        text = f"{rng.randrange(10_000):04d} " + " ".join(card[i:i + 4] for i in range(0, 16, 4)) + f" {rng.randrange(100)}"
        new, n = pii.replace(text, c)
        assert n and pii.replace(new, c, back=True) == (text, n)


def test_feistel_is_a_permutation():
    c = pii.Cipher(b"key")
    all_ = [(a, b, d) for a in range(3) for b in range(7) for d in range(5)]
    images = {tuple(c.permute("k", list(x), [3, 7, 5])) for x in all_}
    assert images == set(all_)
    assert sorted(c.below("d", x, 50) for x in range(50)) == list(range(50))
    assert all(c.permute("k", c.permute("k", list(x), [3, 7, 5]), [3, 7, 5], back=True) == list(x) for x in all_)


def test_pseudonyms_over_a_table(docs, make, none):
    assert sorted(map(str, pii.pseudonymise(docs, b"k").collect())) == sorted(map(str, docs.collect()))
    rows = make([(1, "call 017-555-7713", 17), (2, "or 017-555-7713 now", 19), (3, None, None)], SCHEMA + ", n_chars bigint")
    got = {r.doc_id: r for r in pii.pseudonymise(rows, b"k", count="found").collect()}
    assert got[1].text[5:] == got[2].text[3:15] != "017-555-7713" and got[1].found == 1 and got[3].text is None
    assert pii.pseudonymise(none, b"k").count() == 0


# 3


def brute_marks(text, items, window=10):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(
        {ord(a): a.lower() for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}))
    w, hit, found = cut(text), set(), set()
    for item, t in items:
        v = cut(t)
        k = min(len(v), window)
        grams = {tuple(v[i:i + k]) for i in range(len(v) - k + 1)} if k else set()
        for i in range(len(w) - k + 1):
            if tuple(w[i:i + k]) in grams:
                hit.update(range(i, i + k))
                found.add(str(item))
    return len(w), sorted(hit), sorted(found)


@pytest.mark.parametrize("broadcast", [1 << 20, 0])
def test_decontamination_against_brute_force(make, docs, none, broadcast):
    rng = random.Random(3)
    vocabulary = ["a", "b", "É", "9"]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60))) for _ in range(60)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 6, 9, 10, 14])))) for i in range(6)] + [
        (50, None), (51, "!!"), (52, "cat sat ON the-mat"), (10, "a a")]
    benchmark = make(items, "item_id bigint, text string")
    rows = [*enumerate(texts), *RAW]
    got = decontaminate.mark(make(rows, SCHEMA), benchmark, broadcast_bytes=broadcast).collect()
    assert Counter((r.doc_id, r.n_words, tuple(r.hits), tuple(r["items"])) for r in got) == Counter(
        (i, n, tuple(h), tuple(f)) for i, t in rows for n, h, f in [brute_marks(t, items)])
    assert decontaminate.mark(none, benchmark).count() == 0
    clean = decontaminate.mark(docs, make([], "item_id bigint, text string"), names=("n_words", "hits_", "items"))
    assert clean.where("size(hits_) > 0").count() == 0 and clean.count() == len(RAW)


def test_passages_are_cut_out(make):
    passage = " ".join(f"p{i}" for i in range(12))
    rows = [(1, f"Before it, {passage}! After; more and more words, and yet many more of them.", 0), (2, passage, 0), (3, "clean text", 10),
            (4, None, None)]
    got = {r.doc_id: r for r in decontaminate.clean(
        make(rows, SCHEMA + ", n_chars bigint"), make([(1, passage)], "item_id bigint, text string")).collect()}
    assert set(got) == {1, 3, 4}
    assert got[1].text == "Before it! After; more and more words, and yet many more of them." and got[1].n_chars == len(got[1].text)
    assert got[3].text == "clean text" and got[3].n_chars == 10


# 4


def brute_tree(train, depth):
    """Counts, KT estimates and weights by recursion over a dictionary, bit by bit."""
    n = defaultdict(lambda: [0, 0])
    for text in train:
        data = b"\xff" * depth + text + b"\xff"
        for i in range(depth, len(data)):
            for j in range(8):
                for d in range(depth + 1):
                    n[d, data[i - d:i], 1 << j | data[i] >> (8 - j)][data[i] >> (7 - j) & 1] += 1
    pe = {k: math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi) for k, (a, b) in n.items()}
    below = defaultdict(float)
    pw = {}
    for d in range(depth, -1, -1):
        for k in [k for k in n if k[0] == d]:
            pw[k] = pe[k] if d == depth else math.log(.5) + np.logaddexp(pe[k], below[k])
            if d:
                below[d - 1, k[1][1:], k[2]] += pw[k]

    def probability(context, bits):
        met = [d for d in range(depth + 1) if (d, context[depth - d:], bits) in n]
        if not met:
            return .5
        q = None
        for d in range(max(met), -1, -1):
            k = d, context[depth - d:], bits
            own = (n[k][1] + .5) / (sum(n[k]) + 1)
            stay = 1.0 if q is None else math.exp(math.log(.5) + pe[k] - pw[k])
            q = own if q is None else stay * own + (1 - stay) * q
        return q

    def score(text):
        data, total = b"\xff" * depth + text + b"\xff", 0.0
        for i in range(depth, len(data)):
            for j in range(8):
                p = probability(data[i - depth:i], 1 << j | data[i] >> (8 - j))
                total += math.log10(p if data[i] >> (7 - j) & 1 else 1 - p)
        return total

    return score


def test_context_tree_against_recursion(make, none):
    rows = [(i, t) for i, t in RAW if t is None or len(t) < 1000] + [(i, f"ab{'ra' * (i % 4)} cad{i % 3}") for i in range(20, 60)]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1 for i, _ in rows]
    train = [(t or "").encode() for (_, t), h in zip(rows, held) if not h]
    score = brute_tree(train, 3)
    words = Counter(w for t in train for w in [*t.lower().split(), None])
    total, distinct = sum(words.values()), len(words)
    want = Counter()
    for (i, t), h in zip(rows, held):
        own = [*(t or "").encode().lower().split(), None]
        base = sum(math.log10((words[w] + .5) / (total + .5 * (distinct + 1))) for w in own)
        want[i, h, len(own), sum(w in words for w in own), total, round(base, 6), round(score((t or "").encode()), 3)] += 1
    for frequent in (1 << 18, 4):
        got = ctw.score(make(rows, SCHEMA), depth=3, frequent_words=frequent).collect()
        assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 3))
                       for r in got) == want
    assert ctw.score(none).count() == 0


@pytest.mark.parametrize("frequent", [1 << 21, 60, 0])
def test_rare_contexts_count_however_few_grams_are_held(make, frequent):
    rng = random.Random(4)
    rows = [(i, "".join(rng.choice("abc é") for _ in range(rng.randint(0, 60)))) for i in range(80)] + [(None, None), (7, "Ω new")]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1 for i, _ in rows]
    score = brute_tree([(t or "").encode() for (_, t), h in zip(rows, held) if not h], 4)
    got = ctw.score(make(rows, SCHEMA), depth=4, frequent_grams=frequent).collect()
    assert Counter((r.doc_id, r.n_bytes, r.held_out, round(r.score, 5)) for r in got) == Counter(
        (i, len((t or "").encode()), h, round(score((t or "").encode()), 5)) for (i, t), h in zip(rows, held))


def test_bits_are_probabilities_and_nodes_can_be_bounded(make):
    texts = make([(i, f"some text number {i % 7}") for i in range(30)], SCHEMA).select("text")
    counts = ctw.gram_counts(texts, 2)
    small = ctw.model(counts, 2, 40).toPandas()
    assert len(small) < len(ctw.model(counts, 2, 1 << 20).toPandas()) and small.q.between(0, 1).all()
    scorer = ctw.Scorer(*(small[c].to_numpy() for c in ("depth", "node", "q")), 2, slots=4)
    every = np.array([(ord("e") << 16) | (ord("x") << 8) | b for b in range(256)], np.uint64)
    assert (10 ** scorer(every)).sum() == pytest.approx(1, abs=1e-4)
    assert scorer(every) == pytest.approx(scorer.exact(every))  # remembered or not


# 5


def brute_print(text, k=3):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + k]), 42) for i in range(max(1, len(w) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def reached(n, links):
    label = list(range(n))
    for _ in range(n):
        before = list(label)
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
        if before == label:
            return label
    return label


@pytest.mark.parametrize("budget", [0, 1, 2, 5])
def test_trie_finds_all_links(make, budget):
    rng = random.Random(budget)
    prints = {rng.getrandbits(64) for _ in range(40)}
    for _ in range(400):  # dense neighbourhoods, so that slices are needed
        prints.add(rng.choice(sorted(prints)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    prints = sorted(x - (1 << 64) if x >> 63 else x for x in prints)
    near = [(i, j) for i in range(len(prints)) for j in range(i) if ((prints[i] ^ prints[j]) & (2 ** 64 - 1)).bit_count() <= budget]
    want = reached(len(prints), near)
    frame = make([(x, i) for i, x in enumerate(prints)], "fp bigint, best bigint")
    links = simhash.links(frame, budget, slice_size=16).collect()
    where = {x: i for i, x in enumerate(prints)}
    assert reached(len(prints), [(where[r.a], where[r.b]) for r in links]) == want
    got = {r.fp: r.best for r in simhash.classes(frame, budget).collect()}
    assert [got[x] for x in prints] == want


def test_near_duplicates_against_brute_force(make, docs, none):
    prints = [brute_print(t) for _, t in RAW]
    near = [(i, j) for i in range(len(RAW)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    label = reached(len(RAW), near)
    least = {c: min((RAW[i][0] for i in range(len(RAW)) if label[i] == c and RAW[i][0] is not None), default=None) for c in label}
    got = simhash.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.fp % 2 ** 64, r.component_id) for r in got) == Counter(
        (RAW[i][0], prints[i], least[label[i]]) for i in range(len(RAW)))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(label))
    assert simhash.near_duplicates(none).count() == 0 and simhash.keep_one(none).count() == 0


def test_components_of_a_chain_and_a_star(make):
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = {r.node: r.root for r in components.components(make(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 140)}}


# 6, 7


def brute_rules(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(zip(w, w[1:], w[2:]))
    hit = {i + j for i, k in enumerate(zip(w, w[1:], w[2:])) if windows[k] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit)


def quality_rows():
    rng = random.Random(6)
    good = [" ".join(rng.choice(["of", "the", "house", "é", "river", "went", "far"]) for _ in range(80)) for _ in range(60)]
    bad = [" ".join(rng.choice(["of##", "the|", "$$house", "WENT!!", "***"]) for _ in range(80)) for _ in range(40)]
    return [(100 + i, t) for i, t in enumerate(good + bad)] + [
        (1000 + i, f"{t}\n{t}\n \n\n{t}") for i, (_, t) in enumerate(RAW) if t and t != LONG]


def test_ratio_rules_against_brute_force(make, docs, none):
    rows = [*quality_rows(), *RAW]
    rows = [(i, t) for i, t in rows]
    labels = make([(100 + i, 1) for i in range(40)] + [(160 + i, 0) for i in range(20)] + [(None, 1), (100, 1)], "doc_id bigint, quality int")
    frame = make(rows, SCHEMA)
    got = importance.judge(frame, labels, quantile=0.0).collect()
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == Counter(
        (i, *b, b[0] < 50 or 100 * b[4] > 50 * b[0]) for i, t in rows for b in [brute_rules(t)])
    joined = importance.judge(frame, labels, quantile=0.0, broadcast_rows=0).collect()
    assert Counter(map(str, joined)) == Counter(map(str, got))
    ratio = {r.doc_id: r.ratio for r in got}
    target, raw = Counter(), Counter()
    hasher, buckets = importance.Hasher(), 1 << 14
    grams = {i: importance.ngrams(hasher((t or "").encode().split()), buckets).tolist() for i, t in rows}
    for i, t in rows:
        own = importance.ngrams(hasher((t or "").encode().split()), buckets).tolist()
        raw.update(own)
        if i is not None and 100 <= i < 140:
            target.update(own)
    nt, nr = sum(target.values()), sum(raw.values())
    for i in (100, 155, 170, 199):
        want = np.mean([math.log((target[g] + .5) / (nt + buckets / 2)) - math.log((raw[g] + .5) / (nr + buckets / 2)) for g in grams[i]])
        assert ratio[i] == pytest.approx(want)
    assert min(ratio[i] for i in range(100, 160)) > max(ratio[i] for i in range(160, 200))
    assert importance.judge(none, labels).count() == 0
    assert importance.judge(docs, make([], "doc_id bigint, quality int")).where("kept").count() >= 0


def test_risk_never_rewards_a_negative_part():
    rng = np.random.default_rng(7)
    good, bad = rng.normal(2, 1, (600, 3)), rng.normal(-2, 1, (200, 3))
    one = lambda x: np.hstack([np.ones((len(x), 1)), x, np.zeros((len(x), quality.WIDTH - 4))])
    weights = quality.fit(one(good[:300]), one(np.vstack([good[300:], bad])), 300 / 500)
    assert ((one(good) @ weights) > 0).mean() > 0.95 and ((one(bad) @ weights) < 0).mean() > 0.95
    assert not quality.fit(one(good[:0]), one(bad), 0.5).any()


def test_classifier_learns_only_from_its_folds(make, docs, none):
    rows = quality_rows()
    labels = [(i, int(i < 160)) for i, _ in rows if i < 200]
    frame = make(rows, SCHEMA)
    weights = quality.train(frame, make(labels, "doc_id bigint, quality int"))
    other = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q) for i, q in labels]
    assert quality.train(frame, make(other, "doc_id bigint, quality int")) == pytest.approx(weights)  # held-out labels are not read
    got = {r.doc_id: r.score for r in quality.score(frame, weights).collect()}
    held = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(got[i] >= 0.3) == (i < 160) for i in held]) > 0.9
    assert quality.score(docs, weights, name="score2").count() == len(RAW)
    kept = quality.keep_good(docs, make(labels, "doc_id bigint, quality int"))
    assert kept.columns == docs.columns
    assert quality.keep_good(none, make([], "doc_id bigint, quality int")).count() == 0


# 9, 10


def test_url_parts_and_rules(make):
    urls = ["http://A.Example.NET/en/x?y", "no scheme", None, "x://h", "ftp://example.com/de/#t", "http://fr.org/fr/", "http://org?x=/fr/",
            "a://b://c/d", "http://notexample.com/de/", "http://x.net", "HTTP://Ü.Net/\nq", ""]
    rules = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
    frame = make([(i, u) for i, u in enumerate(urls)], "page_id bigint, url string")
    parts = frame.select("page_id", urlfilter.host(F.col("url")).alias("h"), urlfilter.path(F.col("url")).alias("p"))
    rule, verdict = urlfilter.rule_of(F.col("h"), F.col("p"), rules)
    for r in parts.select("*", rule.alias("rule"), verdict.alias("verdict")).collect():
        u = urls[r.page_id]
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
        host = "".join(c.lower() if c.isascii() else c for c in host)
        fits = [x for x in rules if (host == x.split("/")[0] or host.endswith("." + x.split("/")[0])) and path.startswith(x[x.index("/"):])]
        want = max(fits, key=len, default=None)
        assert (r.h, r.p, r.rule, r.verdict) == (host, path, want, rules.get(want))


@pytest.mark.parametrize("bound", [16 << 20, 0])
def test_cascade_is_exact(make, bound):
    rows = [(i, f"key{i % 3000}", "x") for i in range(4000)] + [(9000, None, "y"), (9001, "", "z")]
    listed = make([(f"key{i}",) for i in range(0, 3000, 7)] + [("elsewhere",), ("key7",), (None,)], "key string")
    frame = make(rows, "page_id bigint, key string, places string")
    got = urlfilter.is_listed(frame, "key", listed, max_bytes=bound).collect()
    names = {f"key{i}" for i in range(0, 3000, 7)}
    assert Counter((r.page_id, r.listed) for r in got) == Counter((i, k in names) for i, k, _ in rows)
    assert urlfilter.is_listed(frame, "key", make([], "key string")).where("listed").count() == 0
    assert urlfilter.is_listed(frame.limit(0), "key", listed).count() == 0


def test_long_lists_take_shards_of_bounded_filters(make):
    """No filter outgrows the bound by much, a key of most rows is spread over tasks, and answers stay exact."""
    rows = [(i, f"key{i % 5000}" if i % 3 else "key7", None) for i in range(12_000)]
    frame = make(rows, "page_id bigint, key string, shard string").repartition(16)
    names = {f"key{i}" for i in range(0, 5000, 3)} | {"key7"}
    universe = frame.select("key").distinct().withColumn("listed", F.col("key").isin(names))
    for bound in (64, 300, 16 << 20):
        levels, shards = urlfilter.cascade(universe, bound)
        assert (shards > 4) == (bound <= 300)
        sizes = [sum(len(x.bits(s)) for x in levels) for s in range(shards)]
        assert max(sizes) <= 4 * bound + 8 * len(levels)
        got = urlfilter.is_listed(frame, "key", make([(n,) for n in names], "key string"), max_bytes=bound)
        assert Counter((r.page_id, r.listed) for r in got.collect()) == Counter((i, k in names) for i, k, _ in rows)
    plan = urlfilter.is_listed(frame, "key", make([("key7",)], "key string"))._jdf.queryExecution().toString()
    assert "Join" not in plan


def test_archives_come_back_and_copies_are_revisits(spark, make):
    big = "<p>é</p>\r\n\r\nWARC/1.1\r\n" * 100
    rows = [(1, "http://a/", big), (2, "http://b c/\n", big), (3, None, None), (4, "u", ""), (5, "u", "small"), (6, "u", "small"),
            (2, "http://b/", big), (None, "n", big), (None, "n", "x" * 2000), (8, "u", "y" * 300_000)]
    streams, archives = new_folder(spark, "w"), new_folder(spark, "w")
    warc.write(make([(*r, 1) for r in rows], "page_id bigint, url string, html string, digest int"), streams)
    warc.normalise_all(spark, streams, archives)
    got = warc.read(spark, archives).collect()
    want = Counter()
    for i, _, html in rows:
        data = (html or "").encode()
        same = [j for j, _, h in rows if (h or "").encode() == data and j is not None]
        keeper = max(same, default=None) if len(data) >= 1000 else None
        revisit = keeper is not None and i != keeper
        want[i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", keeper if revisit else None] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    assert all(r.payload is None or hashlib.sha1(bytes(r.payload)).hexdigest() == r.payload_digest for r in got)
    empty, to = new_folder(spark, "w"), new_folder(spark, "w")
    warc.write(make([], "page_id bigint, url string, html string"), empty)
    warc.normalise_all(spark, empty, to)
    assert warc.read(spark, to).count() == 0


def test_a_cut_stream_keeps_the_records_before_it(tmp_path):
    record = [warc.record(i, "u", b"p%d" % i * 500, hashlib.sha1(b"p%d" % i * 500).hexdigest(), None, False) for i in range(5)]
    whole = gzip.compress(b"".join(record[:3])) + gzip.compress(b"".join(record[3:]))  # members of several records
    (tmp_path / "a.gz").write_bytes(whole)
    (tmp_path / "b.gz").write_bytes(gzip.compress(b"".join(record))[:-30])
    at = str(tmp_path)
    assert warc.normalise(f"{at}/a.gz", f"{at}/a.new.gz", f"{at}/a.idx") == (5, True)
    found = list(warc.members(f"{at}/a.new.gz", f"{at}/a.idx", ahead=10))
    assert [int(h["x-page-id"]) for h, _ in found] == list(range(5))
    assert b"".join(record) == gzip.decompress((tmp_path / "a.new.gz").read_bytes())
    n, complete = warc.normalise(f"{at}/b.gz", f"{at}/b.new.gz", f"{at}/b.idx")
    assert n < 5 and not complete
    place, size = map(int, (tmp_path / "a.idx").read_text().splitlines()[3].split()[:2])
    assert zlib.decompress((tmp_path / "a.new.gz").read_bytes()[place:place + size], 31) == record[3]


def test_a_fault_of_the_store_is_raised(tmp_path, monkeypatch):
    body = b"p" * 500
    (tmp_path / "a.gz").write_bytes(gzip.compress(warc.record(1, "u", body, hashlib.sha1(body).hexdigest(), None, False)))

    class Full:
        def __enter__(self):
            return self

        def __exit__(self, *_):
            return False

        def write(self, _):
            raise OSError("no space left")

    monkeypatch.setattr(warc.files, "writer", lambda _: Full())
    with pytest.raises(OSError, match="no space"):
        warc.normalise(str(tmp_path / "a.gz"), str(tmp_path / "b.gz"), str(tmp_path / "b.idx"))


def test_classifier_does_not_depend_on_the_layout(make):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(("good", "fine", "#", "bad", "word")) for _ in range(rng.randint(0, 30)))) for i in range(300)]
    rows += [(7, "a copy")] * 40
    labels = make([(i, i % 2) for i in range(300)], "doc_id bigint, quality int")
    weights = [quality.train(make(rows, SCHEMA).repartition(n), labels, fit_rows=50).tobytes() for n in (1, 3, 7)]
    assert len(set(weights)) == 1
    own = make(rows, SCHEMA)
    marked = own.select("text", F.xxhash64("doc_id", "text").alias("m")).collect()
    marked.sort(key=lambda r: (r.m % 1_000_003, r.m, quality.features(r.text.encode()).tobytes()))
    want = np.stack([quality.features(r.text.encode()) for r in marked[:50]])
    assert np.array_equal(quality._chosen(own.repartition(4), "doc_id", "text", 50), want)


def test_names_do_not_clash(docs):
    assert unused(docs, "fp", "ROW", "new") == ["fp_", "ROW_", "new"]


def test_pipeline_keeps_columns_and_rejects_what_it_should(spark, make, tmp_path):
    import corpus_pipeline

    passage = " ".join(f"p{i}" for i in range(12))
    rows = quality_rows()[:100]
    rng = random.Random(7)
    own = [" ".join(rng.choice(["of", "the", "house", "é", "river", "went", "far"]) for _ in range(80)) for _ in range(2)]
    near = rows[1][1].split()
    near[40] = "near"  # 71 of 81 shingles are shared
    rows += [(5000, rows[0][1]), (5001, own[0] + " " + passage), (5002, own[1] + " mail me.12@mail3.example.com"), (5003, " ".join(near))]
    frame = make([(i, t, "en", "src0", len(t)) for i, t in rows], SCHEMA + ", lang string, source string, n_chars bigint")
    sf = str(tmp_path)
    frame.write.parquet(f"{sf}/documents.parquet")
    make([(i, int(i < 160), 0) for i, _ in rows if i < 200], "doc_id bigint, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    make([(1, passage)], "item_id bigint, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs, seen = spark.read.parquet(f"{sf}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == frame.columns
        seen[name] = {r.doc_id: r.text for r in docs.collect()}
    ids = [set(s) for s in seen.values()]
    assert all(i >= 5000 or i < 160 for i in ids[0]) and len(ids[0]) >= 58
    assert not {5000, 5003} & ids[1] and {100, 101, 5001, 5002} <= ids[1]
    assert passage not in seen["benchmark_decontamination"][5001]
    assert "me.12@" not in seen["pii_pseudonyms"][5002]
    final = corpus_pipeline.run(spark, sf)
    assert {r.doc_id for r in final.collect()} == ids[3] and json.dumps(final.columns)
