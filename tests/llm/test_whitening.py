"""Whitening against numpy's eigenvectors, and the eigensolver on hard matrices."""
import math
import random

import numpy as np
import pytest

from milepost.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label string, x string, n string, v string, component string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, *["c"] * 5) for i, v in rows], SCHEMA).repartition(parts)


def brute(rows, k=4):
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    d = max((len(v) for _, v in kept), default=0)
    x = [[math.floor(256 * float(np.float32(c))) for c in v] + [0] * (d - len(v)) for _, v in kept]
    u = np.unique(np.array(x), axis=0)
    n, s = len(u), u.sum(axis=0)
    cov = np.cov(u.T.astype(float), bias=True).reshape(d, d)
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    dev = [sum((n * a - int(b)) ** 2 for a, b in zip(r, s)) for r in x]
    return [i for i, _ in kept], n, dev, ((np.array(x) - s / n) @ q) / np.sqrt(e), e / np.trace(cov)


def check(got, rows, k=4):
    ids, n, dev, w, share = brute(rows, k)
    assert len(got) == len(ids) * k
    assert {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-10
    for c in range(k):
        own = [r for r in got if r.component == c + 1]
        sign = np.sign(sum(r.whitened * w[ids.index(r.vec_id), c] for r in own if r.vec_id in ids))
        a = sorted((repr(r.vec_id), r.deviation, round(sign * r.whitened, 7) + 0.0) for r in own)
        b = sorted((repr(i), d, round(x, 7) + 0.0) for i, d, x in zip(ids, dev, w[:, c]))
        assert [x[:2] for x in a] == [x[:2] for x in b]
        assert np.allclose([x[2] for x in a], [x[2] for x in b], atol=1e-6)
        assert all(abs(r.explained / share[c] - 1) < 1e-9 for r in own)


def table(n=300, d=9, seed=5):
    r = random.Random(seed)
    rows = [(i, [r.gauss(0, 1 + j / 3) for j in range(d)]) for i in range(n)]
    bad = [(1000, None), (1001, [float("nan")] + [0.0] * (d - 1)), (1002, [None] * d), (1003, [float("inf")] * d)]
    short = [(1004, [0.5] * 3), (1005, [])]
    return rows + bad + short + [(2000 + i, rows[7][1]) for i in range(150)] + [(None, rows[8][1]), (3, rows[9][1])]


def test_against_numpy(spark):
    rows = [(i, v) for i, v in table() if i != 3]
    check(whitening.whiten(frame(spark, rows)).collect(), rows)


def test_repeated_ids_stay_rows(spark):
    rows = table()
    got = whitening.whiten(frame(spark, rows)).where("component = 1").collect()
    assert sum(r.vec_id == 3 for r in got) == 2 and sum(r.vec_id is None for r in got) == 1


def test_large_offset_is_centred(spark):
    r = random.Random(1)
    rows = [(i, [4000.0 + r.random(), -3000.0 + r.random(), r.random()]) for i in range(200)]
    check(whitening.whiten(frame(spark, rows), 3).collect(), rows, 3)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(i, [0.5, 0.5]) for i in range(9)]])
def test_nothing_to_whiten(spark, rows):
    out = whitening.whiten(frame(spark, rows))
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert out.collect() == []


def test_fewer_components_than_asked(spark):
    rows = [(i, [float(i), 2.0 * i, 0.0, 1.0, 1.0]) for i in range(12)]
    got = whitening.whiten(frame(spark, rows)).collect()
    assert {r.component for r in got} == {1} and abs(got[0].explained - 1) < 1e-12


def test_huge_entries(spark):
    rows = [(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [1.0, 3.0])]
    got = whitening.whiten(frame(spark, rows)).where("component = 1").collect()
    assert all(r.deviation is None for r in got if r.vec_id < 3) and len(got) == 3


@pytest.mark.parametrize("seed", range(24))
def test_leading_pairs(seed):
    r = np.random.default_rng(seed)
    d = int(r.integers(1, 50))
    q = np.linalg.qr(r.standard_normal((d, d)))[0]
    e = [r.random(d) * 10, np.r_[np.full(d // 2, 5.0), np.ones(d - d // 2)], np.full(d, 3.0),
         5 + 1e-9 * r.random(d), 10.0 ** -np.arange(d), np.r_[1e12, r.random(d - 1)]][seed % 6]
    a = (q * e) @ q.T
    a = (a + a.T) / 2
    values, vectors = whitening.leading_pairs(a, 4)
    want = np.linalg.eigvalsh(a)[::-1][:len(values)]
    assert np.allclose(values, want, rtol=1e-12, atol=1e-13 * abs(want[0]))
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
    assert np.abs(a @ vectors - vectors * values).max() < 1e-12 * want[0]
