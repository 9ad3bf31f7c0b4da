"""Worked examples (FIXTURES.md) and invariants for the operators."""

import math

import numpy as np
from pyspark.ml.feature import HashingTF, IDF, Tokenizer
from pyspark.sql import functions as F

from logweave.functions.columns import regex_groups
from logweave.functions.patterns import FORMATS
from logweave.operators import evaluate as E
from logweave.operators import features as V
from logweave.operators import learn as L
from logweave.operators import mining as M
from logweave.operators import parsing as P
from logweave.operators import relational as R
from logweave.operators import split as X
from logweave.operators import timeseries as T
from logweave.operators.indexing import with_row_id

COMPUTE = ("2016-03-21 08:15:30.123 4242 AUDIT nova.compute.claims [req-0a1b-2c3d u0001 t0009 - - -] "
           "[instance: 11-22-33] Attempting claim: memory 2048 MB, disk 20 GB, VCPUs 1")
AGENT = "2016-03-21 08:15:30.123 4242 ERROR ceilometer.agent - some failure text -"
DASH = "Mon Mar 21 08:15:30.123456 2016] [x:error] [pid 77:tid 88] boom happened"


# ------------------------------------------------------------------ parsing
def test_log_worked_lines(spark):
    df = spark.createDataFrame([(COMPUTE,), (AGENT,), (DASH,), ("junk",)], "line string")
    c = P.parse_log(df, "line", "compute", keep=["line"]).where(F.col("line") == COMPUTE).first()
    assert (c.user_id, c.tenant_id, c.instance) == ("u0001", "t0009", "11-22-33")
    mem, disk = P.parse_claim(P.parse_log(df.where(F.col("line") == COMPUTE), "line", "compute"),
                              "message").select("memory_mb", "disk_gb").first()
    assert (mem, disk) == (2048, 20)
    a = P.parse_log(df, "line", "agent_error", keep=["line"], trim=True).where(F.col("line") == AGENT).first()
    assert (a.module, a.message, a.matched) == ("ceilometer.agent", "- some failure text", True)
    t = P.parse_log(df, "line", "agent_error", keep=["line"], trim=True, groups=(7,)).where(
        F.col("line") == AGENT).first()
    assert t.tail == "-"
    d = P.parse_log(df, "line", "dashboard_error", keep=["line"]).where(F.col("line") == DASH).first()
    assert (d.day, d.time, d.year, d.pid, d.tid, d.message) == (
        "Mon Mar 21", "08:15:30.123456", "2016", "77", "88", "boom happened")
    j = P.parse_log(df, "line", "compute", keep=["line"]).where(F.col("line") == "junk").first()
    assert j.matched is False and j.user_id == ""


def test_single_pass_groups_equal_regexp_extract(spark):
    lines = [COMPUTE, AGENT, DASH, "", "x [y] z", None]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    for f in FORMATS.values():
        got = df.select(regex_groups("line", f.pattern, f.n_groups).alias("g"),
                        *[F.regexp_extract("line", f.pattern, i).alias(f"e{i}") for i in range(f.n_groups + 1)]
                        ).collect()
        for r in got:
            exp = [r[f"e{i}"] for i in range(f.n_groups + 1)]
            if r.g is None:
                assert all(e is None for e in exp)
            else:
                assert r.g == exp, f.name


def test_parse_vectors_edges_fields(spark):
    df = spark.createDataFrame([("1.5,1 2 3",), ("0, 4 5",)], "line string")
    rows = P.parse_labeled(df).collect()
    assert rows[0].label == 1.5 and rows[0].features == [1.0, 2.0, 3.0]  # last feature kept
    assert rows[1].features == [4.0, 5.0]  # leading blank trimmed, first token kept
    e = P.parse_edges(spark.createDataFrame([("1 2 0.5",)], "line string")).first()
    assert (e.src, e.dst, e.weight) == (1, 2, 0.5)
    d = P.parse_dense(spark.createDataFrame([(" 1 2 ",)], "line string")).first()
    assert d.features == [1.0, 2.0]
    ct = P.parse_category_text(spark.createDataFrame([("spam,buy now,extra",)], "line string")).first()
    assert (ct.category, ct.text) == ("spam", "buy now")
    fields = ",".join(["id7", "1", "a", "b", "c"] + [f"k{i}" for i in range(10)] + ["3", "-2", "x"])
    sf = P.split_fields(spark.createDataFrame([(fields,)], "line string"))
    sf = P.clamp_non_negative(sf, ["nums"]).first()
    assert sf.id == "id7" and sf.label == 1.0 and sf.cats == [f"k{i}" for i in range(10)]
    assert sf.nums == [3.0, 0.0, None]


def test_observations_and_metrics(spark):
    tsv = spark.createDataFrame([("2015\t8\t3\tAAPL\tx\t118.5",), ("bad\tline",)], "line string")
    o = P.parse_observations_tsv(tsv).collect()
    assert str(o[0].ts) == "2015-08-03 00:00:00" and o[0].key == "AAPL" and o[0].value == 118.5
    assert o[1].ts is None
    msg = spark.createDataFrame([("2016-03-21 08:15:42.1 rest", "h1", "1")], "message string, host string, version string")
    r = P.parse_log_observations(msg).first()
    assert str(r.ts) == "2016-03-21 08:15:00" and r.key == "h1" and r.value == 1.0
    m = spark.createDataFrame([("1", "2", "200"), ("1", "x", "5"), ("3", "4", "100")], "a string, b string, ops string")
    out = P.parse_metrics(m, ["a", "b"], "ops", 133).collect()
    assert [(r.label, r.features) for r in out] == [(0.0, [1.0, 2.0]), (1.0, [3.0, 4.0])]


def test_baskets(spark):
    df = spark.createDataFrame([(["a_1", "b_2"],), (["a_1", "b_1"],), (["a_x"],)], "items array<string>")
    v = P.validate_basket(df).collect()
    assert [r.items for r in v] == [["a_1", "b_2"], [], []]
    line = ",".join([f"f{i}" for i in range(18)] + ["x_1", "y_2", "z_3"])
    b = P.basket_from_fields(spark.createDataFrame([(line,)], "line string")).first()
    assert b.items == ["x_1", "y_2", "z_3"]


def test_contains_filter_exact(spark):
    keys = spark.createDataFrame([("u12",), ("u3",), ("xyz",), ("u1",)], "k string")
    ids = spark.createDataFrame([("u1",), ("z",)], "id string")
    got = sorted(r.k for r in P.filter_contains_any(keys, "k", ids, "id").collect())
    assert got == ["u1", "u12", "xyz"]


# ------------------------------------------------------------------ relational
def test_subtract_keeps_duplicates(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (2,), (3,)], "v int")
    b = spark.createDataFrame([(2,)], "v int")
    assert sorted(r.v for r in R.subtract_rows(a, b).collect()) == [1, 1, 3]


def test_usage_by_user_worked(spark):
    lines = spark.createDataFrame([
        (COMPUTE,), (COMPUTE.replace("2048", "1024"),), (COMPUTE.replace("u0001", "u0002"),),
        (COMPUTE.replace("Attempting claim", "Claim successful"),), ("junk",)], "line string")
    users = spark.createDataFrame([("u0001", "ann"), ("0002", None)], "user_id string, user_name string")
    out = R.usage_by_user(lines, users).collect()
    got = {r.user_id: (r.user_name, r.memory_mb, r.disk_gb, r.n_claims) for r in out}
    # u0002 contains the known id 0002 but has no exact name
    assert got == {"u0001": ("ann", 3072, 40, 2), "u0002": (None, 2048, 20, 1)}


def test_extremes_ties(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 3.0)], "k string, v double")
    r = R.extremes(df, "v", "k").first()
    assert (r.min_k, r.min_v, r.max_k, r.max_v) == ("a", 1.0, "c", 3.0)


# ------------------------------------------------------------------ time series
def test_align_fill_returns_dw(spark):
    obs = spark.createDataFrame([
        ("2024-01-01 00:00:00", "a", 1.0), ("2024-01-01 02:00:00", "a", 3.0),
        ("2024-01-01 02:00:00", "a", 2.0), ("2024-01-01 01:30:00", "a", 9.0)],
        "ts string, key string, value double").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    a = T.align(obs, "2024-01-01 00:00:00", "2024-01-01 03:00:00", "1 hour").orderBy("ts").collect()
    assert [r.value for r in a] == [1.0, None, 3.0, None]  # max on duplicates, off-index dropped
    f = T.fill(T.align(obs, "2024-01-01 00:00:00", "2024-01-01 03:00:00", "1 hour")).orderBy("ts").collect()
    assert [r.value for r in f] == [1.0, 2.0, 3.0, None]
    rr = T.return_rates(T.fill(T.align(obs, "2024-01-01 00:00:00", "2024-01-01 03:00:00", "1 hour")))
    assert [r.rate for r in rr.orderBy("ts").collect()] == [1.0, 0.5, None]
    dw = T.durbin_watson(rr).first().dw
    assert math.isclose(dw, (0.5 - 1.0) ** 2 / (1.0 + 0.25))
    idx = T.datetime_index(spark, "2015-08-03 00:00:00", "2015-09-22 00:00:00", "1 day")
    assert idx.count() == 51


def test_row_ids_dense(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("v")).repartition(7)
    got = with_row_id(df, ["v"], num_partitions=5).orderBy("v").collect()
    assert [r.row_id for r in got] == list(range(1000))
    assert all(r.row_id == r.v for r in got)


# ------------------------------------------------------------------ splits
def test_kfold_fixture(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0)], "id int, value double")
    r = X.kfold_aggregate(df, 3, "id", "value", seed=10).first()
    assert (r.train_total, r.train_average) == (12.0, 4.0)
    sums = X.kfold_training_sums(df, 3, "id", "value", seed=10).collect()
    assert sum(s.train_sum for s in sums) == 12.0


def test_hash_split_stable(spark):
    df = spark.range(0, 2000)
    a, b = X.split(df, [0.7, 0.3], "id", 5)
    na, nb = a.count(), b.count()
    assert na + nb == 2000 and 1250 < na < 1550
    a2, _ = X.split(df.repartition(13), [0.7, 0.3], "id", 5)
    assert sorted(r.id for r in a.collect()) == sorted(r.id for r in a2.collect())


# ------------------------------------------------------------------ features
def test_dictionary_and_encoding(spark):
    df = spark.createDataFrame([(["x", "p"],), (["y", "p"],), (["x", "q"],)], "cats array<string>")
    d = V.category_dictionary(df).orderBy("idx").collect()
    assert [(r.position, r.value, r.idx) for r in d] == [(0, "x", 0), (0, "y", 1), (1, "p", 2), (1, "q", 3)]
    new = spark.createDataFrame([(["y", "z"],)], "cats array<string>")
    e = V.encode_ordinal(new, V.category_dictionary(df), "cats", "f").first()
    assert e.f == [1.0, 0.0]  # unseen -> 0.0
    oh = V.encode_one_hot(new, V.category_dictionary(df), "cats", "f").first()
    assert oh.f.size == 6 and list(oh.f.toArray()) == [0, 1, 0, 0, 0, 1]  # unseen -> last slot of block


def test_tfidf_min_df_fixture(spark):
    docs = spark.createDataFrame([(0, "this is a sentence"), (1, "that is another sentence"),
                                  (2, "these are still a sentence")], "doc_id int, text string")
    tf = V.term_freq(docs)
    w = V.idf_apply(tf, V.idf_fit(tf, 3, min_doc_freq=2))
    got = {(r.term, round(r.score, 12)) for r in V.term_scores(w).collect()}
    assert got == {("is", round(math.log(4 / 3), 12)), ("a", round(math.log(4 / 3), 12))}
    # the same with Spark ML's hashed TF and IDF
    toks = Tokenizer(inputCol="text", outputCol="w").transform(docs)
    htf = HashingTF(inputCol="w", outputCol="tf").transform(toks)
    vec = IDF(inputCol="tf", outputCol="x", minDocFreq=2).fit(htf).transform(htf)
    idx = V.term_index("is", 1 << 18)
    assert math.isclose(vec.first().x[idx], 0.28768207245178085)


def test_tfidf_plain_fixture(spark):
    docs = spark.createDataFrame([(0, "this this thisis a sentence"), (1, "this this this is another sentence"),
                                  (2, "is still a sentence")], "doc_id int, text string")
    tf = V.term_freq(docs)
    w = {(r.doc_id, r.term): r.tfidf for r in V.idf_apply(tf, V.idf_fit(tf, 3)).collect()}
    assert math.isclose(w[(0, "this")], 2 * math.log(4 / 3))
    assert math.isclose(w[(1, "this")], 3 * math.log(4 / 3))
    assert (2, "this") not in w


# ------------------------------------------------------------------ mining
def test_prefixspan_fixture(spark):
    seqs = spark.createDataFrame([([[1, 2], [3]],), ([[1], [3, 2], [1, 2]],), ([[1, 2], [5]],), ([[6]],)],
                                 "sequence array<array<int>>")
    got = {(str([sorted(x) for x in r.sequence]), r.freq) for r in M.frequent_sequences(seqs, 0.5, 5).collect()}
    assert got == {("[[1]]", 3), ("[[2]]", 3), ("[[3]]", 2), ("[[1, 2]]", 3), ("[[1], [3]]", 2)}


def test_rules_from_itemsets_fixture(spark):
    sets = spark.createDataFrame([(["a"], 15), (["b"], 35), (["a", "b"], 12)], "items array<string>, freq bigint")
    got = [(r.antecedent, r.consequent, r.confidence) for r in M.rules_from_itemsets(sets, 0.8).collect()]
    assert got == [(["a"], ["b"], 0.8)]


def test_itemsets_count_empty_baskets(spark):
    df = spark.createDataFrame([(["a", "b"],), (["a"],), ([],), ([],)], "items array<string>")
    got = {tuple(sorted(r.items)): r.freq for r in M.frequent_itemsets(df, 0.5).collect()}
    assert got == {("a",): 2}  # b: 1/4 < 0.5, the empty baskets count in N


# ------------------------------------------------------------------ learning / evaluation
def test_au_roc_ties_and_brute_force(spark):
    rng = np.random.default_rng(3)
    s = rng.integers(0, 20, 400).astype(float)
    y = (rng.random(400) < 0.3 + s / 40).astype(float)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(s, y)], "score double, label double")
    got = E.au_roc(df, buckets=4).first().au_roc
    pos, neg = s[y == 1], s[y == 0]
    brute = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert math.isclose(got, brute, rel_tol=1e-12)


def test_linear_sgd_matches_numpy(spark):
    rng = np.random.default_rng(0)
    X_ = rng.normal(size=(300, 2)) * 0.3
    y = X_ @ np.array([0.5, -0.2]) + rng.normal(size=300) * 0.01
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(X_, y)], "x0 double, x1 double, y double")
    w = L.linear_sgd(df, ["x0", "x1"], "y", iters=10, step=1.0)
    ref = np.zeros(2)
    for t in range(1, 11):
        new = ref - (1.0 / math.sqrt(t)) * (X_.T @ (X_ @ ref - y)) / len(y)
        done = np.linalg.norm(new - ref) < 0.001 * max(np.linalg.norm(new), 1.0)
        ref = new
        if done:
            break
    assert np.allclose(w, ref, atol=1e-12)


def test_nb_closed_form_matches_spark_ml(spark):
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import CountVectorizer
    docs = spark.createDataFrame([
        (0, "good fine good", 1.0), (1, "bad awful", 0.0), (2, "good nice", 1.0), (3, "bad bad fine", 0.0),
        (4, "good awful", 1.0)], "doc_id int, text string, label double")
    tf = V.term_freq(docs)
    priors, theta = L.nb_fit_terms(tf, docs.select("doc_id", "label"))
    pred = {r.doc_id: r.prediction for r in L.nb_predict_terms(tf, priors, theta).collect()}
    toks = Tokenizer(inputCol="text", outputCol="w").transform(docs)
    cv = CountVectorizer(inputCol="w", outputCol="features").fit(toks).transform(toks)
    ml = NaiveBayes(smoothing=1.0).fit(cv).transform(cv)
    assert pred == {r.doc_id: r.prediction for r in ml.collect()}


def test_newton_boost_rounds_compose(spark):
    from pyspark.ml.linalg import Vectors
    rows = [(i, float(i % 3 == 0), Vectors.dense([float(i % 7), float(i % 5)])) for i in range(200)]
    df = spark.createDataFrame(rows, ["id", "label", "features"])
    two, _, met = L.newton_boost(df, rounds=2, depth=2, seed=1)
    one, _, _ = L.newton_boost(df, rounds=1, depth=2, seed=1)
    again, _, _ = L.newton_boost(one, rounds=1, depth=2, seed=1, init_margin="margin")
    a = {r.id: r.margin for r in two.collect()}
    b = {r.id: r.margin for r in again.collect()}
    assert all(math.isclose(a[k], b[k], abs_tol=1e-9) for k in a)
    m = met.orderBy("round").collect()
    assert m[1].logloss <= m[0].logloss + 1e-12


def test_save_load_model_predicts_same(spark, tmp_dir):
    from pyspark.ml.classification import LinearSVCModel
    from pyspark.ml.linalg import Vectors
    from logweave.sources import load_model, save_model
    rows = [(float(i % 2), Vectors.dense([float(i % 2) + 0.1 * (i % 5), 1.0])) for i in range(60)]
    df = spark.createDataFrame(rows, ["label", "features"])
    m = L.linear_svm(df, iters=20)
    save_model(m, tmp_dir + "/svm")
    m2 = load_model(LinearSVCModel, tmp_dir + "/svm")
    a = [r.margin for r in L.svm_margins(m, df).collect()]
    b = [r.margin for r in L.svm_margins(m2, df).collect()]
    assert a == b


def test_clustering_invariants(spark, tmp_dir):
    from pyspark.ml.linalg import Vectors
    from logweave.operators import clusters as C
    from logweave.sources import load_table, save_table, write_partitioned
    pts = [(i, Vectors.dense([float(i % 2) * 10 + (i % 3) * 0.1, float(i % 2)])) for i in range(60)]
    df = spark.createDataFrame(pts, ["id", "features"])
    m = C.kmeans(df, 2, 10, runs=2, seed=3)
    out = C.assign(m, df).withColumnRenamed("prediction", "cluster")
    assert out.count() == 60 and {r.cluster for r in out.collect()} <= {0, 1}
    cost = C.kmeans_cost(df, C.model_centers(m)).first().cost
    assert math.isclose(cost, m.summary.trainingCost, rel_tol=1e-9)
    write_partitioned(out.select("id", "cluster"), tmp_dir + "/by_cluster")
    back = load_table(spark, tmp_dir + "/by_cluster")
    assert back.count() == 60 and back.select("cluster").distinct().count() == 2
    g = C.mixture_table(C.gaussian_mixture(df, 2, seed=1))
    assert math.isclose(sum(r.weight for r in g.collect()), 1.0, rel_tol=1e-9)
    edges = spark.createDataFrame([(0, 1, 1.0), (1, 2, 1.0), (3, 4, 1.0), (4, 5, 1.0), (2, 3, 0.01)],
                                  "src long, dst long, weight double")
    pic = C.graph_clusters(edges, 2, 10)
    save_table(pic, tmp_dir + "/pic")
    assert {r.cluster for r in load_table(spark, tmp_dir + "/pic").collect()} <= {0, 1}


def test_streaming_parse_and_totals(spark, tmp_dir):
    import os
    from logweave.streaming.logs import read_line_stream, usage_stream
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.log"), "w") as fh:
        fh.write(COMPUTE + "\n" + COMPUTE.replace("2048", "1000") + "\njunk\n")
    q = (usage_stream(read_line_stream(spark, src)).writeStream.outputMode("complete").format("memory")
         .queryName("usage_stream_test").option("checkpointLocation", os.path.join(tmp_dir, "ck")).start())
    q.processAllAvailable()
    q.stop()
    r = spark.sql("select * from usage_stream_test").collect()
    assert [(x.user_id, x.memory_mb, x.disk_gb, x.n_claims) for x in r] == [("u0001", 3048, 40, 2)]


def test_hashed_long_form_matches_vector_counts(spark):
    docs = spark.createDataFrame([(0, "a b a été"), (1, ""), (2, "x " * 30)], "doc_id int, text string")
    h = V.hashed_term_freq(docs, num_features=16)
    got = {}
    for r in h.collect():
        assert 0 <= r.slot < 16
        got[r.doc_id] = got.get(r.doc_id, 0) + r.tf
    # the same words as the estimator's tokenizer, without the empty ones
    toks = V.tokenizer("text", "w").transform(docs).collect()
    assert got == {r.doc_id: n for r in toks if (n := sum(w != "" for w in r.w))}
    assert V.term_index("is", 1 << 18) == HashingTF(numFeatures=1 << 18).indexOf("is")


def test_hashing_tf_uses_the_estimators_slots(spark):
    df = P.tokenize(spark.createDataFrame([("the cat saw the dog",)], "text string"))
    v = V.hashing_tf(df).first().tf
    want = {}
    for w in ["the", "cat", "saw", "the", "dog"]:
        want[V.term_index(w)] = want.get(V.term_index(w), 0) + 1.0
    assert v.size == 1 << 20 and dict(zip(v.indices.tolist(), v.values.tolist())) == want


def test_sources_read_back(spark, tmp_dir):
    import os
    from logweave.sources import read_delimited, read_documents, read_libsvm, read_lines
    p = os.path.join(tmp_dir, "lines.txt")
    with open(p, "w") as fh:
        fh.write("1.0,1 2\n0.0,3 4\n")
    lines = read_lines(spark, p)
    assert [r.line for r in lines.collect()] == ["1.0,1 2", "0.0,3 4"]
    assert P.parse_labeled(lines).count() == 2
    svm = os.path.join(tmp_dir, "data.libsvm")
    with open(svm, "w") as fh:
        fh.write("1 1:0.5 3:2.0\n0 2:1.0\n")
    d = read_libsvm(spark, svm, num_features=3).orderBy("label").collect()
    assert d[1].label == 1.0 and list(d[1].features.toArray()) == [0.5, 0.0, 2.0]
    js = os.path.join(tmp_dir, "docs.json")
    with open(js, "w") as fh:
        fh.write('{"message": "m1", "host": "h", "@version": "1", "extra": 5}\n{"message": "m2"}\n')
    docs = read_documents(spark, js, "json", schema="message string, host string, `@version` string")
    assert docs.columns == ["message", "host", "@version"] and docs.count() == 2
    csv = os.path.join(tmp_dir, "r.csv")
    with open(csv, "w") as fh:
        fh.write("a,1\nb,x\n")
    r = read_delimited(spark, csv, "k string, v int").orderBy("k").collect()
    assert (r[0].v, r[1].v) == (1, None)


def test_small_operators(spark):
    df = spark.createDataFrame([("t1", "m", "r", "u", "i", "hello,world")],
                               "tenant string, module string, req string, user string, inst string, msg string")
    kv = P.key_by_group(df, "tenant", ["module", "req", "user", "inst", "msg"])
    items = P.split_tokens(kv, "value").first().items
    assert kv.first().key == "t1" and items == ["m", "r", "u", "i", "hello", "world"]
    pos = P.with_positions(spark.createDataFrame([(["a", "b"],)], "c array<string>"), "c").first().c
    assert [(p.pos, p.value) for p in pos] == [(0, "a"), (1, "b")]
    tok = P.tokenize(spark.createDataFrame([("Hello  World",)], "text string")).first().words
    assert tok == ["hello", "", "world"]  # whitespace split as ml Tokenizer does
    top = R.top_k(spark.range(10), 3, [F.desc("id")]).collect()
    assert [r.id for r in top] == [9, 8, 7]
    pts = spark.createDataFrame([([1.0, 2.0],), ([1.0, 2.0],), ([3.0, 4.0],)], "features array<double>")
    assert R.distinct_points(pts).count() == 2
    m = spark.createDataFrame([(0.5, 1.0), (-1.0, 1.0), (-0.1, 0.0), (2.0, 0.0)], "margin double, label double")
    assert E.margin_error_rate(m).first().error_rate == 0.5
    c = {(r.label, r.prediction): r.n for r in E.confusion(
        spark.createDataFrame([(1.0, 1.0), (1.0, 0.0), (0.0, 0.0)], "label double, prediction double")).collect()}
    assert c == {(1.0, 1.0): 1, (1.0, 0.0): 1, (0.0, 0.0): 1}


def test_text_pipeline_and_classify_text(spark):
    from logweave.plans.jobs import classify_text
    rows = [(i, ("good fine nice " if i % 2 else "bad awful poor ") * 3, float(i % 2)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id int, text string, label double")
    _, pred, acc = classify_text(df, num_features=1 << 10)
    assert acc.first().accuracy == 1.0 and pred.count() == acc.first().n


def test_skewed_user_is_combined(spark):
    # one user holds most lines: partial aggregation keeps the result exact
    lines = [(COMPUTE,)] * 300 + [(COMPUTE.replace("u0001", "u0002"),)] * 3
    users = spark.createDataFrame([("u0001", "ann"), ("u0002", "bo")], "user_id string, user_name string")
    out = {r.user_id: (r.memory_mb, r.n_claims) for r in
           R.usage_by_user(spark.createDataFrame(lines, "line string").repartition(8), users).collect()}
    assert out == {"u0001": (2048 * 300, 300), "u0002": (2048 * 3, 3)}


def test_cluster_logs_writes_every_cluster(spark, tmp_dir):
    from logweave.plans.jobs import cluster_logs
    from logweave.sources import load_table
    lines = [(i, f"2016-03-21 08:15:{i % 60:02d}.123 {i} ERROR mod{i % 4}.agent - failure {i % 3} text -")
             for i in range(120)] + [(999, "junk")]
    df = spark.createDataFrame(lines, "event_id int, line string")
    out = cluster_logs(df, k=3, max_iter=5, runs=2, keep=["event_id"], out_path=tmp_dir + "/clusters")
    got = out.select("event_id", "cluster").collect()
    assert len(got) == 120 and {r.cluster for r in got} <= {0, 1, 2}
    back = load_table(spark, tmp_dir + "/clusters")
    assert back.count() == 120
    assert {r.cluster for r in back.select("cluster").distinct().collect()} == {r.cluster for r in got}


def test_parse_log_on_mismatch_and_known_users(spark):
    df = spark.createDataFrame([(COMPUTE,), ("junk",)], "line string")
    n = P.parse_log(df, "line", "compute", keep=["line"], on_mismatch="null").where(F.col("line") == "junk").first()
    assert n.user_id is None and n.matched is False
    d = P.parse_log(df, "line", "compute", keep=["line"], on_mismatch="drop")
    assert [r.user_id for r in d.collect()] == ["u0001"]
    p = P.parse_log(spark.createDataFrame([(COMPUTE,), (COMPUTE.replace("Attempting", "Finished"),),
                                           (COMPUTE.replace("u0001", "x9"),)], "line string"), "line", "compute")
    users = spark.createDataFrame([("0001",)], "user_id string")
    got = [(r.user_id, r.message[:10]) for r in P.filter_known_users(p, users).collect()]
    assert got == [("u0001", "Attempting")]


def test_wallclock_is_zone_free(spark):
    from logweave.functions import wallclock as Wc
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        df = spark.createDataFrame([("1995-10-15 00:00:00",), ("1995-10-14 23:30:15.25",)], "s string") \
            .select(F.col("s").cast("timestamp_ntz").alias("ts"))
        r = df.select(Wc.wall_datetime("ts").alias("dt"), Wc.trunc("ts", "day").cast("string").alias("d"),
                      Wc.epoch_seconds("ts").alias("e"), Wc.wall_time("ts", millis=True).alias("ms")).collect()
        assert [x.dt for x in r] == ["1995-10-15 00:00:00", "1995-10-14 23:30:15"]
        assert [x.d for x in r] == ["1995-10-15 00:00:00", "1995-10-14 00:00:00"]
        assert r[0].e - r[1].e == 1800 - 15.25 and r[1].ms == "23:30:15.250"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_contains_filter_without_ids(spark):
    keys = spark.createDataFrame([("u1",)], "k string")
    ids = spark.createDataFrame([], "id string")
    assert P.filter_contains_any(keys, "k", ids, "id").count() == 0
