"""Whitening against a direct computation with whole numbers."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from meshfold.llm import whitening
from meshfold.llm.registry import load_all

SCHEMA = "vec_id bigint, embedding array<float>, n string, whitened string, component double"


def direct(vectors, components=8):
    """n, deviations, eigenvalues, shares and projections of a list of vectors."""
    x = [[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors]
    n = len(x)
    s = [sum(col) for col in zip(*x)]
    deviation = [sum((n * v - t) ** 2 for v, t in zip(row, s)) for row in x]
    c = np.array([[(n * v - t) / n for v, t in zip(row, s)] for row in x])
    cov = c.T @ c / n
    values, vecs = np.linalg.eigh(cov)
    values, vecs = values[::-1][:components], vecs[:, ::-1][:, :components]
    return n, deviation, values, values / np.trace(cov), c @ vecs / np.sqrt(values)


def awkward(rng, n, d):
    rows = [(i, [float(np.float32(v)) for v in rng.normal(0, 1 + np.arange(d) % 5, d)]) for i in range(n)]
    rows += [rows[3], rows[3], (None, rows[5][1]), (5, rows[6][1])]
    bad = [(900, None), (901, [None] * d), (902, [float("nan")] * d), (903, [math.inf] * d), (904, [1.0] * (d - 1)), (905, []),
           (906, [1.0] * (d - 1) + [None]), (907, [1.0] * (d - 1) + [-math.inf]), (908, [3e38] * d)]
    return rows, bad


@pytest.mark.parametrize("n, d, most, parts", [(60, 5, 1024, 1), (300, 12, 7, 3), (40, 3, 1, 2), (500, 9, 64, 8)])
def test_query_against_a_direct_computation(spark, make, tmp_path, monkeypatch, n, d, most, parts):
    rows, bad = awkward(np.random.default_rng(n), n, d)
    table = make([(i, v, "n", "w", 1.0) for i, v in rows + bad], SCHEMA).repartition(parts)
    table.write.parquet(f"{tmp_path}/embeddings.parquet")
    inner = whitening.whiten
    monkeypatch.setattr(whitening, "whiten", lambda t: inner(t, most_rows=most))
    got = load_all()[0]["op12_block_matrix_whitening"](spark, str(tmp_path)).collect()
    k = min(d, 8)
    count, deviation, values, shares, want = direct([v for _, v in rows])
    assert len(got) == k * len(rows) and {r.n for r in got} == {count}
    assert Counter((r.vec_id, r.deviation) for r in got if r.component == 1) == Counter(
        (i, v) for (i, _), v in zip(rows, deviation))
    lists = defaultdict(list)
    for r in got:
        lists[r.vec_id, r.component].append(r.whitened)
        assert abs(r.explained / shares[r.component - 1] - 1) < 1e-9
    assert {r.component for r in got} == set(range(1, k + 1))
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    for c in range(k):
        mine = np.concatenate([sorted(lists[i, c + 1]) for i in sorted({i for i, _ in rows}, key=str)])
        own = defaultdict(list)
        for (i, _), v in zip(rows, want[:, c]):
            own[i].append(v)
        for sign in (1, -1):
            theirs = np.concatenate([sorted(sign * np.array(own[i])) for i in sorted(own, key=str)])
            if np.allclose(mine, theirs, atol=1e-7):
                break
        else:
            raise AssertionError(f"component {c + 1}")


def test_little_or_no_variance(make):
    same = make([(i, [1.0, 2.0], "", "", 0.0) for i in range(5)], SCHEMA)
    got, model = whitening.whiten(same)
    assert len(model.values) == 0 and [(r.deviation, r.whitened) for r in got.collect()] == [(0, [])] * 5
    line = make([(i, [float(i), 2.0 * i, 7.0], "", "", 0.0) for i in range(50)], SCHEMA)
    got, model = whitening.whiten(line)
    assert len(model.values) == 1 and abs(model.explained[0] - 1) < 1e-12
    assert whitening.identity_error(got, 1) < 1e-12
    for rows in ([], [(1, None, "", "", 0.0)], [(1, [], "", "", 0.0), (2, [], "", "", 0.0)]):
        got, model = whitening.whiten(make(rows, SCHEMA))
        assert model is None and got.count() == 0


def test_numbers_beyond_a_long(make):
    rows = [(i, [2.0 ** 40 * i, float(i % 3)]) for i in range(40)]
    got, model = whitening.whiten(make(rows, "vec_id bigint, embedding array<double>"))
    n, deviation, values, shares, want = direct([v for _, v in rows], 2)
    have = {r.vec_id: r for r in got.collect()}
    for (i, _), v in zip(rows, deviation):
        assert have[i].deviation == (v if v < 2 ** 63 else None)
    assert sum(v < 2 ** 63 for v in deviation) < 40
    assert np.allclose([abs(have[i].whitened[0]) for i, _ in rows], np.abs(want[:, 0]))
