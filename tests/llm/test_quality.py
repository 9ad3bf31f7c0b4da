import zlib

import numpy as np
from logweave.llm import quality as Q


def test_trees_split_like_an_exhaustive_search():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 12, (400, 3)).astype(np.float32)
    y = ((x[:, 1] > 6) ^ (rng.random(400) < 0.05)).astype(float)
    tree = Q.fit_trees(x, y, n_trees=1, depth=1, rate=1.0, min_rows=1)
    p = y.mean()
    g, h = y - p, np.full(400, p * (1 - p))

    def gain(f, t):
        left = x[:, f] <= t
        return sum(g[m].sum() ** 2 / (h[m].sum() + 1) for m in (left, ~left))
    best = max(((f, t) for f in range(3) for t in range(12) if 0 < (x[:, f] <= t).sum() < 400), key=lambda c: gain(*c))
    f, t = tree.feature[0, 0], tree.threshold[0, 0]
    assert f == best[0] and np.array_equal(x[:, f] <= t, x[:, f] <= best[1])
    left = x[:, f] <= t
    assert np.allclose(tree.leaf[0], [g[m].sum() / (h[m].sum() + 1) for m in (left, ~left)])


def test_flat_traversal_equals_recursion():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 5)).astype(np.float32)
    y = (x[:, 0] * x[:, 3] > 0).astype(float)
    trees = Q.fit_trees(x, y, n_trees=8, depth=3, min_rows=2)

    def walk(row, t):
        node = 0
        while node < 7:
            node = 2 * node + 1 + int(row[trees.feature[t, node]] > trees.threshold[t, node])
        return trees.leaf[t, node - 7]
    assert np.allclose(trees.margin(x), [trees.base + sum(walk(r, t) for t in range(8)) for r in x])


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in Q.op1_quality(spark, sf).collect()}
    labels = [r for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if got[r.doc_id].held_out]
    assert len(labels) > 500
    assert all(got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in labels)
    assert sum(got[r.doc_id].predicted == r.quality for r in labels) / len(labels) > 0.98
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())


def test_odd_rows(spark, docs, empty):
    labels = spark.createDataFrame([(9002, 0), (9004, 1), (9009, 1), (9009, 0), (None, 1), (9006, None)], "doc_id long, quality int")
    trees = Q.fit_quality(docs, labels)
    rows = Q.score_quality(docs, trees).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out for r in rows if r.doc_id is None)
    kept = Q.keep_good(docs, trees)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.predicted for r in rows)
    assert Q.score_quality(empty, trees).count() == 0
    none = Q.fit_quality(docs, labels.limit(0))
    assert {r.score for r in Q.score_quality(docs, none).collect()} == {0.5}


def test_sample_is_bounded(spark, docs):
    labels = docs.select("doc_id").distinct().selectExpr("doc_id", "cast(doc_id % 2 as int) quality")
    Q.fit_quality(docs, labels, max_rows=10)  # more labels than rows asked for
