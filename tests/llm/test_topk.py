import math

import numpy as np
import pytest
from logweave.llm import topk as T


def brute(rows, k=5):
    ok = [(i, r.vec_id, [math.floor(256 * float(x)) for x in r.embedding]) for i, r in enumerate(rows)
          if r.embedding is not None and all(x is not None and math.isfinite(x) for x in r.embedding)]
    out = []
    for i, q, a in ok:
        if q is not None and q % 50 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), math.inf if v is None else v) for j, v, b in ok if j != i)
            out += [(q, n + 1, None if v == math.inf else v, -s) for n, (s, v) in enumerate(scored[:k])]
    return sorted(out, key=str)


def test_odd_vectors_ties_and_repeats(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in np.round(rng.normal(size=6), 1)]) for i in range(260)]
    rows += [(50, rows[50][1]), (7, rows[7][1]), (None, rows[3][1]), (300, None), (350, []), (400, [1.0, None]), (450, [float("nan")] * 6),
             (500, [float("inf")] + [0.0] * 5), (550, [1e6] * 6), (600, [2.0]), (650, [0.0] * 6)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, score int, block string")
    for size in (16, 1024):
        got = sorted(((r.query_id, r.rank, r.vec_id, r.score) for r in T.top_k(df, block_rows=size).collect()), key=str)
        assert got == brute(df.collect())
    assert T.top_k(df.limit(0)).count() == 0
    assert T.top_k(df.where("vec_id = 50").limit(1)).count() == 0
    assert T.top_k(df.where("vec_id in (50, 51)").dropDuplicates(["vec_id"])).count() == 1


def test_too_large_components_are_an_error(spark):
    df = spark.createDataFrame([(50, [1e30]), (1, [1.0])], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="too large"):
        T.top_k(df).collect()


def test_scores_are_exact_for_large_integers():
    rows = np.array([[1 << 40, -(1 << 40), 3], [1, 2, 3]])
    assert T._exact(np.array([1 << 20, 1 << 20, 5]), rows).tolist() == [15, (1 << 20) * 3 + 15]


def test_only_empty_vectors(spark):
    df = spark.createDataFrame([(50, []), (1, []), (2, [])], "vec_id long, embedding array<float>")
    assert sorted(map(tuple, T.top_k(df).collect())) == [(50, 1, 1, 0), (50, 2, 2, 0)]


def test_bounds_never_lose_a_member_and_do_prune():
    rng = np.random.default_rng(5)
    m = rng.integers(-400, 400, (900, 32)) // rng.integers(1, 30, (900, 1))
    q = m[:40]
    open_rows = T.ImpactIndex(m).possible(q, 6)
    exact = q @ m.T
    for i in range(40):
        top = np.argsort(-exact[i], kind="stable")[:6]
        assert open_rows[i, exact[i] >= exact[i, top[-1]]].all()
    assert open_rows.mean() < 0.2
