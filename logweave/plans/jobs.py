"""Composite jobs: the original end-to-end programs as one lazily planned Spark job
each (B5, B6, C7-C9, L11-L13). Only model parameters (centres, trees) ever reach
the driver; every row stays on the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import clusters as C
from ..operators import evaluate as E
from ..operators import features as V
from ..operators import learn as L
from ..operators import mining as M
from ..operators import parsing as P
from ..operators.relational import distinct_points
from ..operators.split import split, split_written
from ..session import cut_lineage, spread, written
from ..sources.io import write_partitioned


AGENT_PATTERN = P.get_format("agent_error").pattern


def sql_text(s: str) -> str:
    """A SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


# --------------------------------------------------------------------------- B5
def mine_tenant_logs(lines: DataFrame, tenant: str, min_support: float = 0.1, line: str = "line",
                     num_partitions: int | None = None) -> DataFrame:
    """Compute-log lines of one tenant -> (module, request, user, instance, message)
    item sets."""
    p = P.parse_log(lines, line, "compute", keep=[], matched_col=None)
    p = P.drop_unparsed(p, "tenant_id").where(F.col("tenant_id") == tenant)
    kv = P.key_by_group(p, "tenant_id", ["module", "request_id", "user_id", "instance", "message"])
    items = P.split_tokens(kv, "value", ",", "items", distinct=True)
    return M.frequent_itemsets(items, min_support, "items", num_partitions)


# --------------------------------------------------------------------------- C7
def cluster_logs(lines: DataFrame, k: int = 3, max_iter: int = 20, runs: int = 3, seed: int = 1,
                 line: str = "line", keep: Sequence[str] = (), out_path: str | None = None, with_model: bool = False):
    """Agent error lines -> 6 trimmed fields -> position dictionary -> ordinal vectors
    -> k-means on the distinct vectors -> cluster of every parsed line. With
    ``out_path`` the lines are also written, one directory per cluster (every cluster).
    ``with_model`` returns (lines, k-means model)."""
    p = P.parse_log(lines, line, "agent_error", keep=list(keep), trim=True, matched_col=None)
    p = P.drop_unparsed(p, "message")
    fields = list(P.get_format("agent_error").groups[:6])
    p = p.withColumn("cats", F.array(*fields))
    d = V.category_dictionary(p, "cats")
    # encoded lines feed the dictionary-free k-means fit and the assignment: write them
    # once to the checkpoint dir (disk, survives executor loss) instead of caching on the heap
    enc = cut_lineage(V.encode_ordinal(p, d, "cats", "features", n_positions=len(fields), vector=True))
    model = C.kmeans(distinct_points(enc, "features"), k, max_iter, runs, seed)
    out = C.assign(model, enc).withColumnRenamed("prediction", "cluster")
    if out_path:
        write_partitioned(out.select(*keep, *fields, "cluster"), out_path, "cluster")
    return (out, model) if with_model else out


# --------------------------------------------------------------------------- C8 / B6
def cluster_and_mine(lines: DataFrame, k: int = 3, max_iter: int = 10, runs: int = 3, seed: int = 1,
                     cluster: int = 2, min_support: float = 0.1, line: str = "line",
                     num_partitions: int | None = None, start: str = "k-means||") -> DataFrame:
    """Compute-log lines -> 10 fields -> ordinal vectors -> k-means -> item sets of
    the fields of the lines in one cluster.

    Clusters are numbered by the order of their centres. ``start="ranges"`` begins from ``range_start`` instead of
    random seeds, so that every run on the same lines gives the same clusters."""
    enc = encoded_lines(lines, line)
    if start == "ranges":
        centers = C.lloyd(enc, C.range_start(enc, k), max_iter)
    else:
        centers = C.model_centers(C.kmeans(enc, k, max_iter, runs, seed))
    assigned = C.assign_nearest(enc, C.in_order(centers), dist_out=None)
    return M.mine_cluster(assigned.withColumn("items", F.array_distinct("cats")), cluster, min_support,
                          "items", "cluster", num_partitions)


def encoded_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """Parsed compute-log lines as (cats, features): ten fields and their dictionary indices, written once."""
    p = P.parse_log(lines, line, "compute", keep=[], matched_col=None)
    p = P.drop_unparsed(p, "user_id")
    fields = list(P.get_format("compute").groups[:10])
    p = p.withColumn("cats", F.array(*fields))
    d = V.category_dictionary(p, "cats")
    return cut_lineage(V.encode_ordinal(p, d, "cats", "features", n_positions=len(fields), vector=True).select("cats", "features"))


# --------------------------------------------------------------------------- C9
def cluster_text_logs(lines: DataFrame, k: int = 3, max_iter: int = 20, seed: int = 1,
                      num_features: int = V.HASH_WIDTH, weighting: str = "tf", line: str = "line",
                      keep: Sequence[str] = (), out_path: str | None = None, with_model: bool = False):
    """Dashboard error lines -> fields 0..6 as words -> hashed TF (or TF-IDF) -> k-means.
    A line that does not match gives empty fields: a zero vector, still clustered.
    ``with_model`` returns (lines, k-means model)."""
    p = P.parse_log(lines, line, "dashboard_error", keep=list(keep), matched_col=None)
    fields = ["match"] + list(P.get_format("dashboard_error").groups[:6])
    p = p.withColumn("words", F.filter(F.array(*fields), lambda x: x != ""))
    tf = HashingTF(inputCol="words", outputCol="features", numFeatures=num_features).transform(p)
    if weighting == "tfidf":
        from pyspark.ml.feature import IDF
        tf = IDF(inputCol="features", outputCol="_w").fit(tf).transform(tf).drop("features") \
            .withColumnRenamed("_w", "features")
    tf = spread(cut_lineage(tf))
    model = C.kmeans(tf, k, max_iter, 1, seed)
    out = C.assign(model, tf).withColumnRenamed("prediction", "cluster")
    if out_path:
        write_partitioned(out.select(*keep, *fields, "cluster"), out_path, "cluster")
    return (out, model) if with_model else out


# --------------------------------------------------------------------------- L11
def classify_metrics(docs: DataFrame, feature_cols: Sequence[str], target: str, threshold: float = 133.0,
                     estimator: str = "gbt", seed: int = 1, key: str | None = None, **kw):
    """Metric documents -> numeric features + threshold label -> 70/30 split ->
    classifier -> (test predictions, accuracy, AUC of the hard predictions)."""
    train, test = metric_parts(docs, feature_cols, target, threshold, seed, key)
    model = L.metric_classifier(train, estimator, **kw)
    pred = cut_lineage(model.transform(test))  # three readers, and a hundred trees a row
    return model, pred, E.accuracy(pred), E.au_roc(pred, "prediction", "label")


def metric_parts(docs: DataFrame, feature_cols: Sequence[str], target: str, threshold: float = 133.0, seed: int = 1,
                 key: str | None = None) -> list[DataFrame]:
    """The metric job's labelled training and test rows."""
    m = P.parse_metrics(docs, feature_cols, target, threshold, vector=True, keep=[key] if key else [])
    return split(m, [0.7, 0.3], key, seed) if key else m.randomSplit([0.7, 0.3], seed)


# --------------------------------------------------------------------------- L12
def classify_clicks(lines: DataFrame, iters: int = 10, depth: int = 10, seed: int = 1,
                    mode: str = "concat", line: str = "line", parts: tuple[DataFrame, DataFrame] | None = None):
    """Click-log CSV -> id/label/categories/numbers -> dictionary on training ->
    ordinal codes (+ clamped numbers) -> boosted trees -> test error. Lines with a bad
    label or number are dropped before any vector is built. ``parts`` hands over what ``click_parts`` has already given."""
    tr, te = parts or click_parts(lines, seed, mode, line)  # the tree learner writes its own input once
    model = L.gbt(tr, iters=iters, depth=depth, seed=seed)
    pred = written(model.transform(te).select("id", "label", "features", "rawPrediction", "probability", "prediction"), "scored")
    return model, pred, E.error_rate(pred)


def click_parts(lines: DataFrame, seed: int = 1, mode: str = "concat", line: str = "line") -> tuple[DataFrame, DataFrame]:
    """The click job's training and test rows with their features, codes from the training rows' dictionary. Lines are
    parsed once and their fields written: the dictionary, the fit, its losses and the test rows all read them."""
    f = P.split_fields(lines, line)
    f = P.clamp_non_negative(f, ["nums"]).where(F.col("label").isNotNull() & P.all_numbers("nums"))
    train, test = split_written(f, [0.8, 0.2], "id", seed, "clicks")
    n_pos = 10
    d = V.category_dictionary(train, "cats")

    def featurise(df):
        e = V.encode_ordinal(df, d, "cats", "cats_idx", n_positions=n_pos)
        e = V.combine_features(e, "cats_idx", "nums", "f", mode)
        return e.withColumn("features", array_to_vector("f")).drop("f")

    return featurise(train), featurise(test)


# --------------------------------------------------------------------------- L13
def classify_text(df: DataFrame, text: str = "text", label: str = "label", key: str = "doc_id",
                  num_features: int = 500_000, seed: int = 1, smoothing: float = 1.0):
    """(label, text) -> 70/30 split -> tokenise, hashed TF, IDF (fitted on training) ->
    multinomial naive Bayes -> test accuracy. Sparse vectors end to end."""
    train, test = split(df, [0.7, 0.3], key, seed)
    pipe = Pipeline(stages=list(V.text_pipeline(text, num_features).getStages()) + [
        NaiveBayes(featuresCol="features", labelCol=label, smoothing=smoothing, modelType="multinomial")])
    model = pipe.fit(train)
    pred = model.transform(test)
    return model, pred, E.accuracy(pred, "prediction", label)
