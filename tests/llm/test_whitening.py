"""Whitening against numpy on every odd case, and its solver against eigenvalues known otherwise."""

import math

import numpy as np
import pytest

from provtally.llm import bidiagonal, whitening


def _same_up_to_sign(a, b, rtol=1e-8):
    for k in range(a.shape[1]):
        assert min(np.abs(a[:, k] - b[:, k]).max(), np.abs(a[:, k] + b[:, k]).max()) < rtol


def _factor(x):
    r = np.linalg.qr(x - x.mean(axis=0), mode="r")
    return np.vstack((r, np.zeros((x.shape[1] - len(r), x.shape[1]))))


RND = np.random.default_rng(0)
SPHERE = np.linalg.qr(RND.standard_normal((300, 20)))[0]
TABLES = {
    "normal": RND.standard_normal((400, 24)),
    "fewer rows than dimensions": RND.standard_normal((9, 24)),
    "graded": RND.standard_normal((300, 12)) * np.logspace(0, -6, 12),
    "equal values": np.vstack((np.eye(8), -np.eye(8))),
    "equal values, coupled": np.eye(9),
    "copied dimensions": np.hstack([RND.standard_normal((100, 4))] * 3),
    "all alike": np.linalg.qr(SPHERE - SPHERE.mean(axis=0))[0],
    "nearly alike": SPHERE @ np.diag(1 + 1e-7 * RND.standard_normal(20)),
    "one dimension": np.array([[1.0], [4.0], [5.0]]),
    "constant": np.ones((5, 4)),
    "one row": np.ones((1, 3)),
}


@pytest.mark.parametrize("name", TABLES)
def test_solver_finds_values_and_orthogonal_directions(name):
    x = TABLES[name] - TABLES[name].mean(axis=0)
    values, vectors, trace = bidiagonal.principal(_factor(x), x.shape[1])
    want = np.linalg.svd(x, compute_uv=False) ** 2
    rank = int((want > max(trace, 1e-300) * x.shape[1] * np.finfo(float).eps).sum())
    assert len(values) == rank
    assert np.allclose(values, want[:rank], rtol=1e-9, atol=0) and trace == pytest.approx((x**2).sum())
    if rank:
        assert np.abs(vectors.T @ vectors - np.eye(rank)).max() < 1e-12
        assert np.abs(x.T @ (x @ vectors) - vectors * values).max() < 1e-12 * want[0]


def _expected(vectors, most=16):
    """Contract in numpy: kept rows, whitened columns and figures."""
    sound = [(i, v) for i, v in vectors if v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v)]
    lengths = [len(v) for _, v in sound]
    d = max(set(lengths), key=lambda n: (lengths.count(n), n))
    rows = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in sound if len(v) == d]
    x = np.array([v for _, v in rows])
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    c = fit - sums / n
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1], u[:, ::-1]
    k = min(most, int((e > e.sum() * d * np.finfo(float).eps).sum()))
    deviation = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(r, sums, strict=True)) for r in x]
    return rows, (x - sums / n) @ u[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum(), n, deviation


SCHEMA = "vec_id long, embedding array<float>, x long, n long, component int"


def _vectors(d, rows):
    rnd = np.random.default_rng(d)
    made = [(i, v.tolist()) for i, v in enumerate(rnd.standard_normal((rows, d)) * np.linspace(1, 3, d))]
    odd = [None, [], [1.0] * (d + 1), [None] * d, [float("nan")] * d, [float("inf"), *[0.0] * (d - 1)]]
    return made + [(1000 + i, v) for i, v in enumerate(odd)] + [made[3], (None, made[4][1]), (2000, made[0][1])] + [(3000, made[5][1])] * 40


@pytest.mark.parametrize(("d", "rows", "fan"), [(3, 60, 64), (20, 90, 2), (20, 6, 64)])
def test_query_equals_numpy(spark, d, rows, fan, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", fan)
    vectors = _vectors(d, rows)
    table = spark.createDataFrame([(*v, 1, 2, 3) for v in vectors], SCHEMA).repartition(7)
    got = whitening.whiten(table).collect()
    kept, want, explained, n, deviation = _expected(vectors)
    k = want.shape[1]
    assert len(got) == len(kept) * k and {r["component"] for r in got} == set(range(1, k + 1))
    assert {r["n"] for r in got} == {n} and max(r["identity_error"] for r in got) < 1e-9
    by_id = {}
    for r in got:
        by_id.setdefault((r["vec_id"], r["component"]), set()).add((r["whitened"], r["deviation"], r["explained"]))
    assert all(len(v) == 1 for v in by_id.values())
    found = np.array([[next(iter(by_id[i, c + 1]))[0] for c in range(k)] for i, _ in kept])
    _same_up_to_sign(found, want)
    for (i, _), dev in zip(kept, deviation, strict=True):
        assert next(iter(by_id[i, 1]))[1] == dev
    assert np.allclose([next(iter(by_id[kept[0][0], c + 1]))[2] for c in range(k)], explained, rtol=1e-9)


def test_tables_without_spread_give_no_rows(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    for rows in ([(1, [1.0, 2.0])] * 5, [(1, None)], [(1, [])]):
        table = spark.createDataFrame([(i, v, 0, 0, 0) for i, v in rows], SCHEMA)
        assert whitening.whiten(table).count() == 0


def test_huge_entries_stay_exact_or_are_dropped(spark):
    rows = [(1, [1e13, 2.0]), (2, [-1e13, 3.0]), (3, [5.0, 1e12]), (4, [1e300, 0.0])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r["vec_id"] for r in got} == {1, 2, 3} and {r["deviation"] for r in got} == {None}
    assert max(r["identity_error"] for r in got) < 1e-9
