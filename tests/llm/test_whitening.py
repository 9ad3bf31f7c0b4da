import math
import random

import numpy as np
import pytest
from logweave.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int, component int, n string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 7, "x") for i, v in rows], SCHEMA).repartition(7)


def brute(vectors, components=32):
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1000000 for c in v] for v in vectors], dtype=np.float64)
    y = x - x.mean(axis=0)
    values, vectors = np.linalg.eigh(y.T @ y / len(y))
    order = np.argsort(values)[::-1][:components]
    deviation = [int(d) for d in ((len(x) * x.astype(np.int64) - x.astype(np.int64).sum(axis=0)) ** 2).sum(axis=1)]
    return y, values[order], vectors[:, order], values.sum(), deviation


def check(rows, got, components=32):
    """Against numpy: figures, eigenvectors up to sign, and the measured error."""
    y, values, vectors, trace, deviation = brute([v for _, v in rows], components)
    by_row = {}
    for r in got:
        by_row.setdefault(r.vec_id, {})[r.component] = r
    w = np.array([[by_row[i][c + 1].whitened for c in range(len(values))] for i, _ in rows])
    assert [by_row[i][1].deviation for i, _ in rows] == deviation
    first = by_row[rows[0][0]]
    assert np.allclose([first[c + 1].explained for c in range(len(values))], values / trace, rtol=1e-9)
    expected = y @ vectors / np.sqrt(values)
    signs = np.sign((w * expected).sum(axis=0))
    assert np.abs(w - expected * signs).max() < 1e-7
    centred = w - w.mean(axis=0)
    assert np.abs(centred.T @ centred / len(w) - np.eye(len(values))).max() < 1e-9
    assert {r.n for r in got} == {len(rows)} and max(r.identity_error for r in got) < 1e-9


@pytest.mark.parametrize("fan", [2, 16])
def test_against_numpy(spark, fan, monkeypatch):
    monkeypatch.setattr(W, "FAN", fan)
    monkeypatch.setattr(W, "BLOCK", 37)
    rng = np.random.default_rng(3)
    spread = rng.normal(size=(400, 40)) * np.linspace(4, .3, 40) @ np.linalg.qr(rng.normal(size=(40, 40)))[0]
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(spread)]
    check(rows, W.whitened_components(frame(spark, rows)).collect())


def test_rows_that_take_no_part_and_short_vectors(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) for _ in range(5)]) for i in range(60)]
    left_out = [(100, None), (101, [1.0, None, 0.0, 0.0, 0.0]), (102, [1.0, float("nan"), 0.0, 0.0, 0.0]), (103, [float("inf")] * 5)]
    got = W.whitened_components(frame(spark, rows + left_out)).collect()
    check(rows, got)
    short = rows + [(200, []), (201, [2.0, 3.0])]
    padded = rows + [(200, [0.0] * 5), (201, [2.0, 3.0, 0.0, 0.0, 0.0])]
    check(padded, W.whitened_components(frame(spark, short)).collect())


def test_repeated_and_null_ids(spark):
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, 1.0]), (2, [0.0, 5.0]), (3, [2.0, 2.0])]
    got = W.whitened_components(frame(spark, rows)).collect()
    assert sorted((r.vec_id or -1, r.component) for r in got) == sorted((i or -1, c) for i, _ in rows for c in (1, 2))


def test_tables_without_variance(spark):
    columns = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)], [(1, [])]):
        got = W.whitened_components(frame(spark, rows))
        assert got.columns == columns and got.collect() == []


def test_too_large_entries_are_an_error(spark):
    with pytest.raises(Exception, match="too large"):
        W.whitened_components(frame(spark, [(1, [1e30]), (2, [0.0])])).collect()


NUMERICS = {
    "noise": lambda g: g.normal(size=(300, 40)),
    "graded": lambda g: g.normal(size=(300, 40)) * np.logspace(0, -8, 40),
    "graded the other way": lambda g: g.normal(size=(300, 40)) * np.logspace(-8, 0, 40),
    "equal values": lambda g: np.linalg.qr(g.normal(size=(300, 40)) - 0)[0],
    "few values": lambda g: np.eye(6)[g.integers(0, 6, 300)] * 64,
    "copied columns": lambda g: np.hstack([g.normal(size=(300, 8))] * 3),
    "constant columns": lambda g: np.hstack([np.ones((300, 9)), g.normal(size=(300, 5)), np.zeros((300, 4))]),
    "fewer rows than columns": lambda g: g.normal(size=(6, 40)),
    "one column": lambda g: g.normal(size=(30, 1)),
}


@pytest.mark.parametrize("name", NUMERICS)
def test_directions(name):
    y = NUMERICS[name](np.random.default_rng(7))
    y = y - y.mean(axis=0)
    values, vectors = W.principal_directions(W._triangle(y), len(y), 32)
    expected = np.linalg.svd(y, compute_uv=False) ** 2 / len(y)
    rank = np.linalg.matrix_rank(y, tol=1e-11 * expected[0] ** .5 * len(y) ** .5)
    assert len(values) == min(rank, 32)
    assert np.abs(values / expected[:len(values)] - 1).max() < 1e-9
    white = y @ (vectors / np.sqrt(values))
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-9
    assert np.abs(white.T @ white / len(y) - np.eye(len(values))).max() < 1e-4


def test_dqds_on_a_known_bidiagonal():
    a, b = np.array([4.0, 3.0, 1e-9, 2.0]), np.array([1.0, 1e-3, 0.5])
    expected = np.linalg.svd(np.diag(a) + np.diag(b, 1), compute_uv=False)
    assert np.allclose(np.sqrt(W.dqds(a, b))[:3], expected[:3], rtol=1e-14)
    assert np.prod(np.sqrt(W.dqds(a, b))) == pytest.approx(np.prod(a), rel=1e-13)  # the determinant keeps the tiny value
