"""Embedding whitening against numpy in exact integers and double precision."""

import math

import numpy as np
import pytest

from keelson.llm import queries, whitening
from tests.conftest import MEDIUM


def brute(rows, k=8):
    """{row number: (deviation, whitened up to sign)}, explained."""
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    sizes = [len(v) for _, v in good]
    d = max(set(sizes), key=lambda s: (sizes.count(s), s))
    good = [(i, [math.floor(1024 * float(c)) + 100000 for c in v]) for i, v in good if len(v) == d]
    n, sums = len(good), [sum(col) for col in zip(*(v for _, v in good))]
    y = [[n * c - s for c, s in zip(v, sums)] for _, v in good]
    centred = np.array(y, dtype=np.longdouble) / n
    cov = (centred.T @ centred / n).astype(float)
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    white = centred.astype(float) @ axes / np.sqrt(values)
    return n, [(i, sum(c * c for c in r), w) for (i, _), r, w in zip(good, y, white)], values / np.trace(cov)


def same_up_to_sign(got, want, tolerance):
    return min(np.abs(got - want).max(), np.abs(got + want).max()) < tolerance


def test_given_vectors(spark):
    queries.ship(spark)
    table = spark.read.parquet(f"{MEDIUM}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    n, want, explained = brute(rows)
    got = queries.op12_whitening(spark, MEDIUM).collect()
    assert len(got) == 8 * n and {r.n for r in got} == {n}
    assert {(r.vec_id, r.deviation) for r in got} == {(i, dev) for i, dev, _ in want}
    error = {r.identity_error for r in got}
    assert len(error) == 1 and error.pop() < 1e-9
    for c in range(1, 9):
        mine = {r.vec_id: r.whitened for r in got if r.component == c}
        assert same_up_to_sign(np.array([mine[i] for i, _, _ in want]), np.array([w[c - 1] for _, _, w in want]), 1e-8)
        assert {r.explained for r in got if r.component == c}.pop() == pytest.approx(explained[c - 1], rel=1e-9)


def test_awkward_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(c) for c in rng.normal(size=3)], 9) for i in range(20)]
    rows += [(20, None, 1), (21, [1.0, None, 2.0], 1), (22, [1.0, math.nan, 2.0], 1), (23, [math.inf, 1.0, 2.0], 1)]
    rows += [(24, [], 1), (25, [1.0, 2.0], 1), (None, [0.5, 0.25, -7.0], 1), rows[0], rows[0]]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n int")
    plain = [(r.vec_id, r.embedding) for r in docs.collect()]
    n, want, explained = brute(plain)
    got = whitening.whiten(docs.repartition(4)).collect()
    assert n == 23 and len(got) == n
    key = lambda r: (r[0] is None, r[0] or 0)
    mine = sorted(((r.vec_id, int(r.deviation), r.whitened) for r in got), key=key)
    for (i, dev, white), (j, want_dev, _) in zip(mine, sorted(want, key=key)):
        assert (i, dev) == (j, want_dev) and len(white) == 3
    for c in range(3):
        a = np.array([m[2][c] for m in mine])
        assert same_up_to_sign(a, np.array([w[2][c] for w in sorted(want, key=key)]), 1e-9)
    assert got[0].explained == pytest.approx(list(explained)) and got[0].identity_error < 1e-9


def test_no_variance_and_no_rows(spark):
    same = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>")
    none = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    for table in (same, none, same.limit(0), none.limit(0)):
        assert whitening.whiten(table).collect() == []


def test_line_of_vectors_has_one_component(spark):
    rows = [(i, [i / 64, 2 * i / 64, 0.0]) for i in range(50)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {len(r.whitened) for r in got} == {1}
    assert np.var([r.whitened[0] for r in got]) == pytest.approx(1) and got[0].explained[0] == pytest.approx(1)


def test_squares_are_exact_beyond_a_long():
    y = np.array([[3_000_000_000, -4_000_000_001], [1, 2]], np.int64) * 1000
    assert [int(v) for v in whitening._squares(y).to_pylist()] == [sum(int(c) ** 2 for c in row) for row in y.tolist()]


def spectrum(values, seed=0):
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values),) * 2))[0]
    m = (q * np.asarray(values, float)) @ q.T
    return (m + m.T) / 2


@pytest.mark.parametrize(
    "values",
    [
        np.linspace(1, 9, 64),
        np.r_[1 + 1e-9 * np.arange(20), np.linspace(2, 9, 44)],
        np.r_[1 + 1e-12 * np.arange(20), np.linspace(2, 9, 44)],
        np.repeat(np.arange(1.0, 33), 2),
        10.0 ** np.linspace(-9, 6, 64),
        np.r_[np.ones(3), np.zeros(61)],
        [4.0],
        [],
    ],
)
def test_refined_to_double_precision(values):
    m = spectrum(values) if len(values) else np.zeros((0, 0))
    got, x = whitening.refined(m)
    assert (np.diff(got) <= 0).all()
    if len(values):
        wide = x.astype(np.longdouble)
        assert np.abs(wide.T @ wide - np.eye(len(m))).max() < 1e-15
        assert np.abs(m.astype(np.longdouble) @ wide - wide * got).max() < 1e-15 * np.abs(m).max()
        assert np.abs(got - np.linalg.eigvalsh(m)[::-1]).max() < 1e-14 * np.abs(m).max()


def test_single_precision_alone_is_not_enough():
    m = spectrum(np.linspace(1, 9, 64))
    rough = np.linalg.eigh(m.astype(np.float32))[1].astype(float)
    assert np.abs(rough.T @ rough - np.eye(64)).max() > 1e-8
