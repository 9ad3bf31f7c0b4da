"""Regression and classification (L1-L10), on Spark ML estimators.

Where the original jobs used an estimator Spark ML still ships, it is used
directly with the settings spelled out. Two things are built here as DataFrame
jobs: the closed-form multinomial naive Bayes on exact terms (SQL-checkable twin
of L4) and second-order (Newton) boosting with margin offsets (L6-L8).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC,
                                       LogisticRegression, NaiveBayes)
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, default_parallelism, written
from .linalg import gramian


# --------------------------------------------------------------------------- L1
def linear_fit(df: DataFrame, features: str = "features", label: str = "label"):
    """Exact least squares without intercept (normal equations inside Spark ML)."""
    return LinearRegression(featuresCol=features, labelCol=label, fitIntercept=False,
                            regParam=0.0, solver="normal").fit(df)


def gram_summary(df: DataFrame, features: str | Sequence[str], label: str) -> tuple[np.ndarray, np.ndarray, int]:
    """X^T X, X^T y and n of a vector column (or of some number columns): one Gramian of (features, label), summed by the
    executors' BLAS, so that hundreds of columns are one aggregate. Rows with a null take no part."""
    if isinstance(features, str):
        joined = VectorAssembler(inputCols=[features, label], outputCol="_z", handleInvalid="skip").transform(df.select(features, F.col(label).cast("double").alias(label)))
    else:
        numbers = [F.col(c).cast("double") for c in [*features, label]]
        joined = df.select(F.array(*numbers).alias("_a")).where(F.forall("_a", lambda x: x.isNotNull())).select(array_to_vector("_a").alias("_z"))
    products, _, n = gramian(joined, "_z")
    if not n:
        d = 0 if isinstance(features, str) else len(features)
        return np.zeros((d, d)), np.zeros(d), 0
    return products[:-1, :-1], products[:-1, -1], n


def linear_sgd(df: DataFrame, features: str | Sequence[str], label: str = "label", iters: int = 10,
               step: float = 1.0, tol: float = 0.001) -> np.ndarray:
    """Full-batch gradient descent, step/sqrt(t), from zero weights, no intercept; ``features`` names a
    vector column or number columns.

    With the full batch every gradient is ``(X^T X w - X^T y) / n``, so one pass
    over the data gives the d x d summary and the iterations run on it.
    """
    xx, xy, n = gram_summary(df, features, label)
    w = np.zeros(len(xy))
    for t in range(1, iters + 1):
        grad = (xx @ w - xy) / max(n, 1)
        new = w - (step / math.sqrt(t)) * grad
        done = np.linalg.norm(new - w) < tol * max(np.linalg.norm(new), 1.0)
        w = new
        if done:
            break
    return w


# --------------------------------------------------------------------------- L2
def linear_svm(df: DataFrame, features: str = "features", label: str = "label", iters: int = 100,
               reg: float = 0.01):
    return LinearSVC(featuresCol=features, labelCol=label, maxIter=iters, regParam=reg,
                     fitIntercept=False, standardization=False).fit(df)


def svm_margins(model, df: DataFrame, out: str = "margin") -> DataFrame:
    """Raw margin (threshold cleared) = second component of rawPrediction."""
    return model.transform(df).withColumn(out, vector_to_array("rawPrediction")[1])


def _dot(x: Column, w: Sequence[float]) -> Column:
    return F.aggregate(F.zip_with(x, F.from_json(F.lit(str([float(v) for v in w])), "array<double>"), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)


def hinge_bounds(df: DataFrame, weights: Sequence[float], reg: float = 0.01, features: str = "features", label: str = "label",
                 widths: Sequence[float] = (0.003, 0.01, 0.03, 0.1, 0.3)) -> tuple[float, float]:
    """(value, bound): the regularised hinge loss of the weights over all rows, and a proven lower bound of its minimum.

    Loss: ``mean(max(0, 1 - y w.x)) + reg / 2 |w|^2`` with y = -1 or 1. Any shares a_i in [0, 1] bound the minimum from below by
    ``mean(a) - |mean(a y x)|^2 / (2 reg)`` (the dual); the shares tried fall from 1 to 0 as the margin passes 1, over
    several widths, and the best bound counts. The gap closes only near the optimum. One aggregate of widths x d sums."""
    y = 2 * (F.col(label) > 0.5).cast("double") - 1
    x = vector_to_array(features)
    rows = df.select(x.alias("x"), y.alias("y")).withColumn("m", F.col("y") * _dot(F.col("x"), weights))
    shares = [F.least(F.greatest((1 + h - F.col("m")) / (2 * h), F.lit(0.0)), F.lit(1.0)) for h in widths]
    rows = rows.withColumn("a", F.array(*shares))
    loss, n, *means = rows.agg(F.avg(F.greatest(1 - F.col("m"), F.lit(0.0))), F.count(F.lit(1)), *[F.avg(F.get("a", F.lit(i))) for i in range(len(widths))]).first()
    if not n:
        return 0.0, 0.0
    parts = rows.select("a", "y", F.posexplode("x").alias("j", "v")).groupBy("j").agg(*[
        F.sum(F.get("a", F.lit(i)) * F.col("y") * F.col("v")).alias(f"s{i}") for i in range(len(widths))]).collect()
    value = loss + reg / 2 * float(np.dot(weights, weights))
    bounds = [means[i] - sum((r[f"s{i}"] / n) ** 2 for r in parts) / (2 * reg) for i in range(len(widths))]
    return value, max(bounds)


# --------------------------------------------------------------------------- L3
def logistic(df: DataFrame, features: str = "features", label: str = "label",
             num_classes: int | None = None, max_iter: int = 100):
    """Multinomial logistic regression without intercept. ``num_classes`` fixes the classes as
    0..n-1 even where the training rows miss some; otherwise the largest label decides."""
    if num_classes:
        attribute = {"ml_attr": {"type": "nominal", "name": label, "vals": [str(float(i)) for i in range(num_classes)]}}
        df = df.withColumn(label, F.col(label).cast("double").alias(label, metadata=attribute))
    return LogisticRegression(featuresCol=features, labelCol=label, family="multinomial",
                              fitIntercept=False, maxIter=max_iter).fit(df)


# --------------------------------------------------------------------------- L4
def naive_bayes(df: DataFrame, features: str = "features", label: str = "label",
                smoothing: float = 1.0):
    return NaiveBayes(featuresCol=features, labelCol=label, smoothing=smoothing,
                      modelType="multinomial").fit(df)


def nb_fit_terms(tf: DataFrame, labels: DataFrame, doc: str = "doc_id", label: str = "label",
                 smoothing: float = 1.0, vocabulary: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Closed-form multinomial naive Bayes on exact (doc, term, tf) counts.

    Returns ``priors (label, log_prior, log_denominator)`` and
    ``theta (label, term, log_theta)`` with the vocabulary = training terms, or
    of a stated size (slots of a hashed width):
    log_prior = ln(n_c + a) - ln(N + C a),
    log_theta = ln(tf_sum(c, t) + a) - ln(tf_sum(c) + V a).
    All are grouped aggregates; three counts reach the driver. The (class, term) counts feed
    the vocabulary, the priors and theta, and are written once.
    """
    a = float(smoothing)
    lt = tf.join(labels.select(doc, label), doc)
    docs = labels.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    n_docs, n_cls = labels.agg(F.count(F.lit(1)), F.countDistinct(label)).first()
    ct = cut_lineage(lt.groupBy(label, "term").agg(F.sum("tf").alias("tf_ct")))
    v = vocabulary or ct.agg(F.countDistinct("term")).first()[0]
    cls = ct.groupBy(label).agg(F.sum("tf_ct").alias("tf_c"))
    priors = (docs.join(cls, label, "left").fillna({"tf_c": 0})
              .select(label,
                      (F.log(F.col("n_c") + a) - F.log(F.lit(n_docs + n_cls * a))).alias("log_prior"),
                      F.log(F.col("tf_c") + v * a).alias("log_den")))
    theta = (ct.join(priors.select(label, "log_den"), label)
             .select(label, "term", (F.log(F.col("tf_ct") + a) - F.col("log_den")).alias("log_theta")))
    return priors, theta


def nb_predict_terms(tf: DataFrame, priors: DataFrame, theta: DataFrame, doc: str = "doc_id",
                     label: str = "label", smoothing: float = 1.0,
                     docs: DataFrame | None = None, unseen: bool = False) -> DataFrame:
    """argmax_c log_prior_c + sum_t tf(d,t) log_theta(c,t); ties go to the smaller class.

    The class parameters (one row per class: prior and denominator) are model
    coefficients and are read once. theta is pivoted to one row per term with one
    column per class, so each (doc, term) row meets its term once: one join on
    term and one aggregation by doc give every class score — no documents x
    classes product. Terms outside the training vocabulary are ignored; a term
    seen in training but not in class c has log_theta = ln(a) - log_den_c.
    """
    la = math.log(float(smoothing))
    pri = priors.orderBy(label).collect()
    classes = [r[label] for r in pri]
    wide = (theta.groupBy("term").pivot(label, classes).agg(F.first("log_theta"))
            .toDF("term", *[f"_t{i}" for i in range(len(classes))]))
    dt = tf.join(wide, "term", "left" if unseen else "inner")  # inner join: only in-vocabulary terms
    sums = dt.groupBy(doc).agg(*[
        F.sum(F.col("tf") * F.coalesce(F.col(f"_t{i}"), F.lit(la - r["log_den"]))).alias(f"_s{i}")
        for i, r in enumerate(pri)])
    base = docs.select(doc).distinct() if docs is not None else tf.select(doc).distinct()
    sc = base.join(sums, doc, "left")
    cand = F.array(*[F.struct((F.lit(r["log_prior"]) + F.coalesce(F.col(f"_s{i}"), F.lit(0.0))).alias("s"),
                              F.lit(-i).alias("neg_i"), F.lit(r[label]).alias("c"))
                     for i, r in enumerate(pri)])
    return sc.select(doc, F.array_max(cand)["c"].cast("double").alias("prediction"))


# --------------------------------------------------------------------------- L5/L9/L10
class BinnedModel:
    """A tree model fitted to binned features that takes rows with the original ones; all else is the model's own."""

    def __init__(self, model, edges: Sequence[Sequence[float]], features: str, label: str, fitted: tuple[DataFrame, DataFrame] | None = None):
        """``fitted``: the training rows and their distinct binned rows, which need not be made again for their losses."""
        self._model, self._edges, self._features, self._label = model, edges, features, label
        self._rows, self._groups = fitted or (None, None)

    def transform(self, df: DataFrame) -> DataFrame:
        return self._model.transform(self._binned(df)).drop("_binned")

    def evaluateEachIteration(self, df: DataFrame) -> list[float]:
        """The mean loss of all rows after each round, from the distinct binned rows and their numbers."""
        groups = self._groups if df is self._rows and df is not None else binned_groups(df, self._edges, self._features, self._label)
        return self._model.evaluateEachIteration(as_vectors(groups))

    def _binned(self, df: DataFrame) -> DataFrame:
        return as_vectors(binned(df, self._edges, self._features))

    def __getattr__(self, name: str):
        if name.startswith("_"):
            raise AttributeError(name)
        return getattr(self._model, name)


def bin_edges(df: DataFrame, features: str = "features", max_bins: int = 32) -> list[list[float]]:
    """Each feature's thresholds, from all rows, less than ``max_bins`` of them: the middles between its values or, where it
    has more than ``max_bins``, their quantiles. A value goes left of a threshold that it equals."""
    x = vector_to_array(features)
    found = written(df.select(F.posexplode(x).alias("j", "x")).distinct(), "cells")
    counts = found.groupBy("j").agg(F.count(F.lit(1)).alias("n"))
    sizes = {r["j"]: r["n"] for r in counts.collect()}
    edges: list[list[float]] = [[] for _ in range(max(sizes, default=-1) + 1)]
    few = [j for j, n in sizes.items() if n <= max_bins]
    many = [j for j, n in sizes.items() if n > max_bins]
    if few:
        values: dict[int, list[float]] = {j: [] for j in few}
        for r in found.where(F.col("j").isin(few)).collect():
            values[r["j"]].append(r["x"])
        for j, of_j in values.items():
            of_j = sorted(v for v in of_j if not math.isnan(v))
            # the middle of two neighbouring numbers may round to the upper one
            edges[j] = [m if a <= (m := a / 2 + b / 2) < b else a for a, b in zip(of_j, of_j[1:])]
    if many:
        shares = [i / max_bins for i in range(1, max_bins)]
        cells = df.select(x.alias("_x")).select(F.inline(F.array(*[F.struct(F.lit(j).alias("j"), F.get("_x", F.lit(j)).alias("x")) for j in many]))).where("x is not null")
        marks = cells.groupBy("j").agg(F.percentile_approx("x", shares, 10_000).alias("q"), F.max("x").alias("top"))
        for r in marks.collect():
            edges[r["j"]] = sorted({q for q in r["q"] if q < r["top"]})
    return edges


def binned(df: DataFrame, edges: Sequence[Sequence[float]], features: str = "features", out: str = "_binned") -> DataFrame:
    """Add ``out``, an array of bytes: per feature the number of thresholds below its value."""
    columns = [f"_b{j}" for j in range(len(edges))]
    x = vector_to_array(features)
    wide = df.withColumn("_x", F.when(F.size(x) == len(edges), x).otherwise(F.raise_error(F.lit("Vectors MUST have one size"))))
    wide = wide.select("*", *[F.get("_x", F.lit(j)).alias(f"_x{j}") for j in range(len(edges))])
    # buckets are closed below, bins above: the next number after a threshold starts a bucket
    splits = [[-math.inf, *(math.nextafter(t, math.inf) for t in e if t < math.inf), math.inf] for e in edges]
    cut = Bucketizer(splitsArray=[s if len(s) > 2 else [-math.inf, 0.0, math.inf] for s in splits], inputCols=[f"_x{j}" for j in range(len(edges))],
                     outputCols=columns, handleInvalid="keep").transform(wide)
    bins = [F.col(c) if len(s) > 2 else F.lit(0.0) for c, s in zip(columns, splits)]
    return cut.withColumn(out, F.array(*[b.cast("byte") for b in bins])).drop("_x", *[f"_x{j}" for j in range(len(edges))], *columns)


def binned_groups(df: DataFrame, edges: Sequence[Sequence[float]], features: str = "features", label: str = "label") -> DataFrame:
    """(_binned, label, _weight): the distinct binned rows and how many rows each stands for."""
    return binned(df, edges, features).groupBy("_binned", F.col(label).cast("double").alias(label)).agg(
        F.count(F.lit(1)).cast("double").alias("_weight"))


def as_vectors(df: DataFrame) -> DataFrame:
    return df.withColumn("_binned", array_to_vector(F.col("_binned").cast("array<double>")))


def gbt(df: DataFrame, features: str = "features", label: str = "label", iters: int = 10,
        depth: int = 5, seed: int = 0, max_bins: int = 32):
    """Gradient-boosted trees on all rows.

    Trees see a feature only through its bins, so rows that agree in all bins and the label are one row of that weight:
    every row is binned once, and the passes of each tree level go over the distinct ones, dealt evenly over the tasks."""
    rows = df.select(features, F.col(label).cast("double").alias(label))
    held = written(rows, "boosted")
    edges = bin_edges(held, features, max_bins)
    estimator = GBTClassifier(featuresCol="_binned", labelCol=label, weightCol="_weight", maxIter=iters, maxDepth=depth,
                              maxBins=max_bins, seed=seed)
    groups = cut_lineage(binned_groups(held, edges, features, label))
    n, slots = groups.count(), 2 * default_parallelism(df.sparkSession)
    parts = max(1, min(-(-n // GROUPS_PER_TASK), slots), -(-n // MOST_PER_TASK))
    return BinnedModel(estimator.fit(as_vectors(groups.repartition(parts))), edges, features, label, (df, groups))


#: Distinct binned rows of a boosting task: as few tasks as have work, and more of them past a bound of their size.
GROUPS_PER_TASK, MOST_PER_TASK = 10_000, 2_000_000


def decision_tree(df: DataFrame, features: str = "features", label: str = "label", depth: int = 5):
    return DecisionTreeClassifier(featuresCol=features, labelCol=label, impurity="gini",
                                  maxDepth=depth, maxBins=32).fit(df)


def metric_classifier(df: DataFrame, estimator: str = "gbt", features: str = "features",
                      label: str = "label", **kw):
    """The estimator choices of the metric-log job: gbt (used), tree, nb, svm, logistic."""
    if estimator == "gbt":
        return gbt(df, features, label, iters=kw.get("iters", 100), depth=kw.get("depth", 10))
    if estimator == "tree":
        return decision_tree(df, features, label, depth=kw.get("depth", 5))
    if estimator == "nb":
        return naive_bayes(df, features, label)
    if estimator == "svm":
        return linear_svm(df, features, label)
    if estimator == "logistic":
        return logistic(df, features, label)
    raise ValueError(estimator)


# --------------------------------------------------------------------------- L6-L8
def _sigmoid(m):
    return 1.0 / (1.0 + F.exp(-m))


def newton_boost(train: DataFrame, test: DataFrame | None = None, *, features: str = "features",
                 label: str = "label", rounds: int = 1, eta: float = 1.0, depth: int = 2,
                 lam: float = 1.0, init_margin: str | None = None, seed: int = 0,
                 checkpoint_interval: int = 5):
    """Second-order boosting with logistic loss.

    Per round: gradient g = p - y and hessian h = p(1-p) at the current margin;
    a regression tree is fitted to -g/h with weight h (Spark ML tree, leaf ids via
    ``leafCol``); each leaf's value is -sum(g)/(sum(h)+lam) from a grouped
    aggregate (at most 2^depth rows, broadcast); margins move by eta * leaf value.
    Splits use the weighted variance gain, which equals the Newton gain at lam = 0;
    lam shrinks leaf values. Starting margins come from ``init_margin`` (continue
    boosting) or 0.

    Each round's margins are persisted (the previous round's are released) and the
    lineage is cut with a reliable checkpoint every ``checkpoint_interval`` rounds
    and after the last one. A round's metrics are computed while its margins are held.

    Returns (train_with_margin, test_with_margin or None, metrics DataFrame with
    rows (round, dataset, logloss, error)).
    """
    def start(df):
        m = F.col(init_margin) if init_margin else F.lit(0.0)
        return df.withColumn("margin", m.cast("double"))

    tr = start(train)
    te = start(test) if test is not None else None
    metrics = []
    held: list[DataFrame] = []
    for r in range(1, rounds + 1):
        p = _sigmoid(F.col("margin"))
        gh = tr.withColumn("_g", p - F.col(label)).withColumn("_h", F.greatest(p * (1 - p), F.lit(1e-16)))
        gh = gh.withColumn("_target", -F.col("_g") / F.col("_h"))
        tree = DecisionTreeRegressor(featuresCol=features, labelCol="_target", weightCol="_h",
                                     maxDepth=depth, leafCol="_leaf", seed=seed).fit(gh)
        values = tree.transform(gh).groupBy("_leaf").agg(
            (-F.sum("_g") / (F.sum("_h") + lam)).alias("_w"))
        vb = F.broadcast(values)

        def step(df):
            out = tree.transform(train_cols(df)).join(vb, "_leaf", "left").fillna({"_w": 0.0})
            return out.withColumn("margin", F.col("margin") + eta * F.col("_w")).drop("_leaf", "_w", "prediction")

        cut = r % checkpoint_interval == 0 or r == rounds
        new_tr = cut_lineage(step(tr)) if cut else step(tr).persist()
        new_te = None
        if te is not None:
            new_te = cut_lineage(step(te)) if cut else step(te).persist()
        for d in held:
            d.unpersist()
        held = [d for d in (new_tr, new_te) if d is not None and not cut]
        tr, te = new_tr, new_te
        metrics.append(_round_metrics(tr, label, r, "train"))
        if te is not None:
            metrics.append(_round_metrics(te, label, r, "test"))
    met = train.sparkSession.createDataFrame(metrics, "round int, dataset string, logloss double, error double")
    return tr, te, met


def train_cols(df: DataFrame) -> DataFrame:
    return df.drop("_g", "_h", "_target", "_leaf", "_w", "prediction")


def _round_metrics(df: DataFrame, label: str, r: int, name: str) -> tuple:
    m = margin_metrics(df, "margin", label).first()
    return r, name, m["logloss"], m["error"]


def margin_metrics(df: DataFrame, margin: str = "margin", label: str = "label") -> DataFrame:
    """Mean logistic loss and error of margins (margin > 0 -> class 1)."""
    m, y = F.col(margin), F.col(label)
    # log(1 + exp(-|m|)) + max(m, 0) - y m  : stable logistic loss on the margin
    loss = F.log1p(F.exp(-F.abs(m))) + F.greatest(m, F.lit(0.0)) - y * m
    err = (((m > 0).cast("double")) != y).cast("double")
    return df.agg(F.avg(loss).alias("logloss"), F.avg(err).alias("error"))
