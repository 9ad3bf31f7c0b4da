"""What the model queries check fails when an estimator stops after one iteration or fits something else."""

import numpy as np
import pytest
from paths import SF_SMALL
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from logweave.operators import clusters as C
from logweave.operators import learn as L
from logweave.operators.linalg import entries, gramian, sparse_vector
from logweave.plans import q_models as Q
from logweave.plans.renders import dashboard_lines
from logweave.session import read_table

SF = "/root/testdata/sf0.01"


def only(df, *names):
    rows = df.select(*names).distinct().collect()
    assert len(rows) == 1
    return tuple(rows[0])


def test_svm(spark):
    train, test = Q._emb_split(spark, SF, binary=True)
    assert only(Q.svm_rows(train, test, L.linear_svm(train, iters=100, reg=.01)), "optimal") == (True,)
    assert only(Q.svm_rows(train, test, L.linear_svm(train, iters=1, reg=.01)), "optimal") == (False,)
    assert only(Q.svm_rows(train, test, L.linear_svm(train, iters=100, reg=1000)), "optimal") == (False,)


def test_kmeans(spark):
    e = Q._emb(spark, SF)
    assert only(Q.kmeans_rows(e, C.kmeans(e, 10, 20, 3, Q.SEED)), "nearest", "centres_are_means", "cheaper") == (True, True, True)
    assert False in only(Q.kmeans_rows(e, C.kmeans(e, 10, 1, 1, Q.SEED + 1)), "centres_are_means", "cheaper")


def test_mixture(spark):
    e = Q.mixture_vectors(spark, SF)
    assert only(Q.mixture_rows(e, C.gaussian_mixture(e, 2, Q.SEED, 400, tol=1e-8)), "stationary") == (True,)
    assert only(Q.mixture_rows(e, C.gaussian_mixture(e, 2, Q.SEED, max_iter=1)), "stationary") == (False,)


def test_power_iteration(spark):
    edges = Q.supplier_part_edges(spark, SF_SMALL)
    assert only(Q.power_rows(edges, Q.PIC_STEPS), "split_at_embedding") == (True,)
    assert only(Q.power_rows(edges, 1, "random"), "split_at_embedding") == (False,)


def test_lda(spark):
    docs = read_table(spark, SF_SMALL, "documents").select("doc_id", "text")
    assert only(Q.lda_rows(spark, docs), "predicts") == (True,)
    assert only(Q.lda_rows(spark, docs, max_iter=1), "predicts") == (False,)


def test_log_clusters(spark):
    text = dashboard_lines(read_table(spark, SF, "events"))
    assert only(Q.text_cluster_rows(text, 20), "nearest", "centres_are_means") == (True, True)
    assert only(Q.text_cluster_rows(text, 1), "centres_are_means") == (False,)


def test_jobs(spark):
    assert only(Q.metric_rows(spark, SF_SMALL), "classified", "figures", "learned") == (True, True, True)
    assert only(Q.metric_rows(spark, SF_SMALL, iters=1), "learned") == (False,)
    assert only(Q.click_rows(spark, SF_SMALL, iters=1), "learned") == (False,)


def test_text_job(spark):
    docs = read_table(spark, SF, "documents").select("doc_id", "text")
    lab = read_table(spark, SF, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    rows = docs.join(lab, "doc_id")
    assert only(Q.text_class_rows(rows), "most_likely", "figures") == (True, True)
    assert (False,) in [tuple(r) for r in Q.text_class_rows(rows, smoothing=1e6).select("most_likely").distinct().collect()]


def test_gramian_and_entries(spark):
    rng = np.random.default_rng(1)
    x = np.column_stack([rng.normal(3, 2, (300, 5)), np.ones(300)])
    df = spark.createDataFrame([(v,) for v in x.tolist()], "a array<double>").select(array_to_vector("a").alias("v"))
    products, sums, n = gramian(df, "v")
    assert n == 300 and np.allclose(products, x.T @ x, rtol=1e-10) and np.allclose(sums, x.sum(axis=0))
    assert gramian(df.limit(0), "v")[2] == 0 and np.allclose(gramian(df.limit(1), "v")[0], np.outer(*(df.first()[0].toArray(),) * 2))
    one = spark.createDataFrame([([(5, 2.0), (1, 3.0)],), ([],)], "e array<struct<j: int, x: double>>").select(sparse_vector(F.col("e"), 9).alias("v"))
    got = [r.v for r in one.collect()]
    assert [(v.size, v.indices.tolist(), v.values.tolist()) for v in got] == [(9, [1, 5], [3.0, 2.0]), (9, [], [])]
    assert [[tuple(e) for e in r.e] for r in one.select(entries(F.col("v")).alias("e")).collect()] == [[(1, 3.0), (5, 2.0)], []]


@pytest.mark.parametrize("d", [2, 500])
def test_gradient_descent_on_wide_vectors(spark, d):
    rng = np.random.default_rng(d)
    x = rng.normal(size=(600, d))
    y = x @ rng.normal(size=d)
    df = spark.createDataFrame([(v, float(t)) for v, t in zip(x.tolist(), y)], "a array<double>, label double").select(array_to_vector("a").alias("features"), "label")
    w = np.zeros(d)
    for t in range(1, 11):
        new = w - (0.1 / t ** .5) * (x.T @ (x @ w - y)) / len(x)
        w = new
    assert np.allclose(L.linear_sgd(df, "features", step=0.1, tol=0.0), w, atol=1e-9)


def test_hinge_bound_is_below_every_loss(spark):
    e = Q._emb(spark, SF_SMALL, binary=True)
    rows = e.collect()
    x, y = np.array([r.features.toArray() for r in rows]), np.array([2 * r.label - 1 for r in rows])
    loss = lambda w: np.maximum(0, 1 - y * (x @ w)).mean() + .005 * w @ w
    m = L.linear_svm(e, iters=100, reg=.01)
    for w in (m.coefficients.toArray(), np.zeros(x.shape[1]), np.ones(x.shape[1])):
        value, bound = L.hinge_bounds(e, w.tolist(), .01)
        assert value == pytest.approx(loss(w)) and bound <= loss(m.coefficients.toArray()) + 1e-9


def test_clusters_are_numbered_alike_and_a_start_is_settled(spark):
    df = spark.createDataFrame([([float(v)],) for v in (1, 2, 3, 50, 51, 52, 90, 91)], "a array<double>").select(array_to_vector("a").alias("features"))
    settled = C.lloyd(df, C.range_start(df, 3), 10)
    assert settled == [[2.0], [51.0], [90.5]] == C.in_order(reversed(settled))
    for seed in range(4):
        assert C.in_order(C.model_centers(C.kmeans(df, 3, 20, 4, seed))) == settled
    rows = C.assign_nearest(df, settled, out="cluster")
    assert C.centre_gap(rows, settled) == 0 and C.centre_gap(rows, [[2.0], [51.0], [91.0]]) == pytest.approx(.5)
    assert C.range_start(df.limit(0), 3) == []
