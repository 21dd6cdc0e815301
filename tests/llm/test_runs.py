"""Periodic runs against their definition."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from meshfold.llm import queries, runs
from meshfold.llm.registry import load_all


def brute(words, min_length=24, min_exponent=3):
    """Every period tried at every place; a stretch counts where no smaller period holds in it."""
    n, found = len(words), {}
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(min_length, min_exponent * q):
                found.setdefault((i, length), q)
            i = max(j, i) + 1
    return sorted(((s, n_, q) for (s, n_), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def rows_of(seed):
    rng = random.Random(seed)
    for _ in range(300):
        letters = rng.choice(["a", "ab", "abc", "abcdefgh"])
        words = []
        for _ in range(rng.randint(0, 6)):
            if rng.random() < 0.6:
                block = [rng.choice(letters) for _ in range(rng.choice([1, 1, 2, 3, 5, 9, 20]))]
                words += (block * 12)[:rng.randint(1, 90)]
            else:
                words += [rng.choice(letters) for _ in range(rng.randint(1, 40))]
        yield words


@pytest.mark.parametrize("length, exponent", [(24, 3), (6, 3), (9, 4), (1, 3)])
def test_runs_of_many_documents_at_once(length, exponent):
    lists = list(rows_of(length))
    codes = np.array([ord(w) for words in lists for w in words], np.int64)
    got = runs.find(codes, np.cumsum([0, *map(len, lists)]), length, exponent)
    assert got == [brute(words, length, exponent) for words in lists]
    assert sum(map(len, got)) > 100


def test_a_whole_document_of_one_word_and_a_fibonacci_word():
    a, b = "a", "ab"
    while len(b) < 3000:
        a, b = b, b + a
    lists = [["x"] * 20_000, list(b)]
    codes = np.array([ord(w) for words in lists for w in words], np.int64)
    got = runs.find(codes, np.cumsum([0, *map(len, lists)]))
    assert got[0] == [(0, 20_000, 1)] and got[1] == brute(lists[1])


def test_marked_tables(make):
    texts = [" ".join(w) for w in rows_of(3)] + [None, "", " \t\n", "é " * 30, "a\x0bb\x0ca\rb " * 10, "one", "x" * 50_000,
                                                 "\xa0 a " * 24]
    schema = "doc_id bigint, text string, RUNS string, n_words string"
    rows = [(i, t, "r", "n") for i, t in enumerate(texts)] + [(0, texts[0], "r", "n"), (None, texts[1], None, None)]
    for most in (50, 400_000):
        got = runs.mark(make(rows, schema), most_words=most)
        assert got.columns == ["doc_id", "text", "n_words", "runs", "collapsed"]
        got = got.collect()
        assert len(got) == len(rows)
        for r in got:
            words = [w.decode() for w in (r.text or "").encode().split()]
            want = brute(words)
            assert r.n_words == len(words) and [tuple(x) for x in r.runs] == want
            assert r.collapsed == collapsed(words, want)
    assert runs.mark(make([], schema)).count() == 0


def test_query_against_its_contract(spark, tmp_path, make):
    rng = random.Random(4)
    texts = [" ".join(w) for w in rows_of(5)] + [" ".join(rng.choice(["la", "le", "lü", "lo"]) for _ in range(200)) for _ in range(100)]
    rows = [(i, t and rng.choice([" ", ""]) + t) for i, t in enumerate([*texts, None, "", "w"])]
    make(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in load_all()[0]["op13_periodic_runs"](spark, str(tmp_path)).collect()}
    seen = 0
    for i, text in rows:
        words = [w.decode() for w in (text or "").encode().split()]
        n, h = len(words), zlib.crc32(str(i).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if j < a else words[a + (j - a) % p] for j, w in enumerate(words)]
            seen += 1
        want = brute(words)
        r = got[i]
        assert r.n_runs == len(want)
        best = max(want, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=None)
        assert (r.start, r.length, r.period, r.exponent_milli) == ((*best, 1000 * best[1] // best[2]) if best else (None,) * 4)
        assert r.runs_sha256 == hashlib.sha256("".join("%d,%d,%d\n" % x for x in want).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, want).encode()).hexdigest()
    assert seen > 20
