"""Learning and evaluation queries with closed-form oracles."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clusters as C
from ..operators import evaluate as E
from ..operators import features as V
from ..operators import learn as L
from ..operators.split import split
from ..session import cut_lineage, read_table
from .q_split import edge_sql, hash_sql
from .registry import query

NB_SEED = 12345
EMB_SEED = 11


# ------------------------------------------------------------------ naive Bayes on exact terms
def _labeled_tf(spark: SparkSession, sf: str):
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    lab = read_table(spark, sf, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    train, test = split(lab, [0.6, 0.4], "doc_id", NB_SEED)
    # the term table feeds several aggregates: tokenise once, keep it in the checkpoint dir
    tf = cut_lineage(V.term_freq(docs.join(lab, "doc_id", "left_semi")))
    return tf, train, test


def _nb(spark: SparkSession, sf: str):
    tf, train, test = _labeled_tf(spark, sf)
    train_tf = tf.join(train.select("doc_id"), "doc_id", "left_semi")
    priors, theta = L.nb_fit_terms(train_tf, train, smoothing=1.0)
    test_tf = tf.join(test.select("doc_id"), "doc_id", "left_semi")
    pred = L.nb_predict_terms(test_tf, priors, theta, smoothing=1.0, docs=test)
    return priors, theta, pred.join(test, "doc_id"), train, test


_SQL_NB = f"""
tok AS (SELECT doc_id, unnest(string_split_regex(lower(text), '\\s+')) AS term
        FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)),
tf AS (SELECT doc_id, term, count(*) AS tf FROM tok WHERE term <> '' GROUP BY 1, 2),
lab AS (SELECT doc_id, CAST(quality AS DOUBLE) AS label,
               {hash_sql(NB_SEED, 'doc_id')} < {edge_sql(0.6)} AS is_train
        FROM labels),
train AS (SELECT doc_id, label FROM lab WHERE is_train),
test AS (SELECT doc_id, label FROM lab WHERE NOT is_train),
ttf AS (SELECT tf.doc_id, tf.term, tf.tf, train.label FROM tf JOIN train USING (doc_id)),
vv AS (SELECT count(DISTINCT term) AS v FROM ttf),
nn AS (SELECT count(*) AS n, count(DISTINCT label) AS c FROM train),
nc AS (SELECT label, count(*) AS n_c FROM train GROUP BY 1),
ct AS (SELECT label, term, sum(tf) AS tf_ct FROM ttf GROUP BY 1, 2),
cls AS (SELECT label, sum(tf_ct) AS tf_c FROM ct GROUP BY 1),
pri AS (SELECT nc.label, ln(CAST(n_c AS DOUBLE) + 1.0) - ln(CAST(n AS DOUBLE) + c * 1.0) AS log_prior,
               ln(CAST(coalesce(tf_c, 0) AS DOUBLE) + v * 1.0) AS log_den
        FROM nc LEFT JOIN cls USING (label), nn, vv),
theta AS (SELECT ct.label, ct.term, ln(CAST(tf_ct AS DOUBLE) + 1.0) - pri.log_den AS log_theta
          FROM ct JOIN pri USING (label)),
dt AS (SELECT tf.doc_id, tf.term, tf.tf FROM tf JOIN test USING (doc_id)
       WHERE tf.term IN (SELECT term FROM ttf)),
sc AS (SELECT d.doc_id, p.label,
              p.log_prior + coalesce(sum(dt.tf * coalesce(th.log_theta, 0.0 - p.log_den)), 0.0) AS s
       FROM test d CROSS JOIN pri p
       LEFT JOIN dt ON dt.doc_id = d.doc_id
       LEFT JOIN theta th ON th.label = p.label AND th.term = dt.term
       GROUP BY d.doc_id, p.label, p.log_prior),
pred AS (SELECT sc.doc_id, arg_max(sc.label, (sc.s, -sc.label)) AS prediction FROM sc GROUP BY sc.doc_id),
scored AS (SELECT pred.doc_id, pred.prediction, test.label FROM pred JOIN test USING (doc_id))"""


@query("nb_parameters", ops=("L4", "V2"), sql="WITH " + _SQL_NB + """
SELECT theta.label, theta.term, round(pri.log_prior, 9) AS log_prior, round(theta.log_theta, 9) AS log_theta
FROM theta JOIN pri USING (label)
""")
def q_nb_parameters(spark: SparkSession, sf: str) -> DataFrame:
    priors, theta, _, _, _ = _nb(spark, sf)
    t = theta.join(priors.select("label", "log_prior"), "label")
    return t.select("label", "term", F.round("log_prior", 9).alias("log_prior"),
                    F.round("log_theta", 9).alias("log_theta"))


@query("nb_predict", ops=("L4",), sql="WITH " + _SQL_NB + """
SELECT doc_id, prediction, label FROM scored
""")
def q_nb_predict(spark: SparkSession, sf: str) -> DataFrame:
    _, _, scored, _, _ = _nb(spark, sf)
    return scored.select("doc_id", "prediction", "label")


@query("accuracy", ops=("A3", "E2", "F7"), sql="WITH " + _SQL_NB + """
SELECT round(avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END), 9) AS accuracy, count(*) AS n FROM scored
""")
def q_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    _, _, scored, _, _ = _nb(spark, sf)
    return E.accuracy(scored).select(F.round("accuracy", 9).alias("accuracy"), "n")


@query("au_roc_hard", ops=("E3",), sql="WITH " + _SQL_NB + """,
per AS (SELECT CAST(prediction AS DOUBLE) AS s, sum(CASE WHEN label > 0.5 THEN 1 ELSE 0 END) AS p,
               sum(CASE WHEN label > 0.5 THEN 0 ELSE 1 END) AS n FROM scored GROUP BY 1),
run AS (SELECT s, p, n, coalesce(sum(n) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
        FROM per)
SELECT round(CASE WHEN sum(p) > 0 AND sum(n) > 0 THEN sum(p * (below + n / 2.0)) / (sum(p) * sum(n)) END, 9) AS au_roc
FROM run
""")
def q_au_roc_hard(spark: SparkSession, sf: str) -> DataFrame:
    _, _, scored, _, _ = _nb(spark, sf)
    return E.au_roc(scored, "prediction", "label").select(F.round("au_roc", 9).alias("au_roc"))


@query("au_roc", ops=("E3",), sql="""
WITH per AS (
  SELECT CAST(d.n_chars AS DOUBLE) AS s, sum(CASE WHEN l.quality > 0.5 THEN 1 ELSE 0 END) AS p,
         sum(CASE WHEN l.quality > 0.5 THEN 0 ELSE 1 END) AS n
  FROM documents d JOIN labels l USING (doc_id) WHERE d.n_chars IS NOT NULL GROUP BY 1),
run AS (SELECT s, p, n, coalesce(sum(n) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
        FROM per)
SELECT round(CASE WHEN sum(p) > 0 AND sum(n) > 0 THEN sum(p * (below + n / 2.0)) / (sum(p) * sum(n)) END, 9) AS au_roc
FROM run
""")
def q_au_roc(spark: SparkSession, sf: str) -> DataFrame:
    d = read_table(spark, sf, "documents").select("doc_id", "n_chars")
    lab = read_table(spark, sf, "labels").select("doc_id", "quality")
    return E.au_roc(d.join(lab, "doc_id"), "n_chars", "quality").select(F.round("au_roc", 9).alias("au_roc"))


# ------------------------------------------------------------------ least squares
def _regression_frame(spark: SparkSession, sf: str) -> DataFrame:
    li = read_table(spark, sf, "lineitem")
    return li.select((F.col("l_extendedprice") / 1000).alias("x0"), (F.col("l_discount") * 100).alias("x1"),
                     F.col("l_quantity").alias("label"))


_SQL_LS = """
WITH d AS (SELECT l_extendedprice / 1000 AS x0, l_discount * 100 AS x1, l_quantity AS y FROM lineitem),
s AS (SELECT sum(x0 * x0) AS a, sum(x0 * x1) AS b, sum(x1 * x1) AS c, sum(x0 * y) AS d, sum(x1 * y) AS e FROM d),
w AS (SELECT (c * d - b * e) / (a * c - b * b) AS w0, (a * e - b * d) / (a * c - b * b) AS w1 FROM s)"""


@query("linear_fit", ops=("L1",), sql=_SQL_LS + """
SELECT round(w0, 6) AS w0, round(w1, 6) AS w1 FROM w
""")
def q_linear_fit(spark: SparkSession, sf: str) -> DataFrame:
    d = VectorAssembler(inputCols=["x0", "x1"], outputCol="features").transform(_regression_frame(spark, sf))
    m = L.linear_fit(d)
    w = [float(x) for x in m.coefficients]
    return spark.range(1).select(F.round(F.lit(w[0]), 6).alias("w0"), F.round(F.lit(w[1]), 6).alias("w1"))


@query("mse", ops=("A2", "E1"), sql=_SQL_LS + """
SELECT round(avg((y - (w0 * x0 + w1 * x1)) * (y - (w0 * x0 + w1 * x1))), 6) AS mse FROM d, w
""")
def q_mse(spark: SparkSession, sf: str) -> DataFrame:
    d = VectorAssembler(inputCols=["x0", "x1"], outputCol="features").transform(_regression_frame(spark, sf))
    m = L.linear_fit(d)
    return E.mse(m.transform(d)).select(F.round("mse", 6).alias("mse"))


# ------------------------------------------------------------------ nearest centre on embeddings
def _embeddings(spark: SparkSession, sf: str) -> DataFrame:
    e = read_table(spark, sf, "embeddings")
    return e.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("x"))


def _label_centers(train: DataFrame) -> tuple[list[int], list[list[float]]]:
    """Per-label mean vectors (k rows of model parameters)."""
    m = (train.select("label", array_to_vector("x").alias("v")).groupBy("label")
         .agg(Summarizer.mean(F.col("v")).alias("c")).orderBy("label").collect())
    return [r["label"] for r in m], [list(map(float, r["c"])) for r in m]


_SQL_EMB = f"""
pts AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS j,
               {hash_sql(EMB_SEED, 'vec_id')} < {edge_sql(0.6)} AS is_train
        FROM embeddings),
cen AS (SELECT label AS c, j, avg(CAST(x AS DOUBLE)) AS m FROM pts WHERE is_train GROUP BY 1, 2),
dist AS (SELECT p.vec_id, p.label, p.is_train, c.c, sum((CAST(p.x AS DOUBLE) - c.m) * (CAST(p.x AS DOUBLE) - c.m)) AS d
         FROM pts p JOIN cen c USING (j) GROUP BY 1, 2, 3, 4),
near AS (SELECT vec_id, label, is_train, arg_min(c, (d, c)) AS cluster, min(d) AS sq_dist FROM dist GROUP BY 1, 2, 3)"""


def _nearest(spark: SparkSession, sf: str) -> DataFrame:
    e = _embeddings(spark, sf)
    train, _ = split(e, [0.6, 0.4], "vec_id", EMB_SEED)
    labels, centers = _label_centers(train)
    a = C.assign_nearest(e, centers, "x", "_ci", "sq_dist")
    lab = F.element_at(F.array(*[F.lit(x) for x in labels]), F.col("_ci") + 1)
    from ..operators.split import split_index
    return a.select("vec_id", "label", lab.alias("cluster"), "sq_dist",
                    (split_index("vec_id", [0.6, 0.4], EMB_SEED) == 0).alias("is_train"))


@query("kmeans_assign", ops=("C2",), sql="WITH " + _SQL_EMB + """
SELECT vec_id, cluster, round(sq_dist, 6) AS sq_dist FROM near
""")
def q_kmeans_assign(spark: SparkSession, sf: str) -> DataFrame:
    n = _nearest(spark, sf)
    return n.select("vec_id", "cluster", F.round("sq_dist", 6).alias("sq_dist"))


@query("kmeans_cost", ops=("C3",), sql="WITH " + _SQL_EMB + """
SELECT round(sum(sq_dist), 4) AS cost FROM near
""")
def q_kmeans_cost(spark: SparkSession, sf: str) -> DataFrame:
    e = _embeddings(spark, sf)
    train, _ = split(e, [0.6, 0.4], "vec_id", EMB_SEED)
    _, centers = _label_centers(train)
    return C.kmeans_cost(e, centers, "x").select(F.round("cost", 4).alias("cost"))


@query("multiclass_precision", ops=("E4",), sql="WITH " + _SQL_EMB + """
SELECT round(avg(CASE WHEN cluster = label THEN 1.0 ELSE 0.0 END), 9) AS precision
FROM near WHERE NOT is_train
""")
def q_multiclass_precision(spark: SparkSession, sf: str) -> DataFrame:
    n = _nearest(spark, sf).where(~F.col("is_train"))
    p = n.select(F.col("cluster").cast("double").alias("prediction"), F.col("label").cast("double").alias("label"))
    return E.multiclass_precision(p).select(F.round("precision", 9).alias("precision"))


@query("confusion", ops=("E4",), sql="WITH " + _SQL_EMB + """
SELECT label, cluster AS prediction, count(*) AS n FROM near WHERE NOT is_train GROUP BY 1, 2
""")
def q_confusion(spark: SparkSession, sf: str) -> DataFrame:
    n = _nearest(spark, sf).where(~F.col("is_train"))
    return E.confusion(n, "cluster", "label")
