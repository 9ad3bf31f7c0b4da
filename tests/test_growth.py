"""Work that must not gather in few tasks or repeat with every row."""

import random

import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from logweave.operators import clusters as C
from logweave.operators import features as V
from logweave.operators import learn as L
from logweave.operators.split import split
from logweave.plans import jobs as J


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_positions_of_few_values_are_not_shuffled(spark, monkeypatch):
    df = spark.createDataFrame([(i, ["a" if i % 9 else "b", None if i % 4 == 0 else f"u{i % 50}"]) for i in range(500)], "id int, cats array<string>")
    d = V.category_dictionary(df.where("id < 300"), "cats")
    known = {(r.position, r.value): float(r.idx) for r in d.collect()}
    want = {r.id: [known.get((j, v), -1.0) for j, v in enumerate(r.cats)] for r in df.collect()}
    few = V.encode_ordinal(df, d, "cats", "f", -1.0, 2)
    assert "SortMergeJoin" not in plan(few)
    monkeypatch.setattr(V, "BROADCAST_VALUES", 10)
    many = V.encode_ordinal(df, d, "cats", "f", -1.0, 2)
    assert plan(many).count("SortMergeJoin") == 1
    for got in (few, many, V.encode_ordinal(df, d, "cats", "f", -1.0)):
        assert {r.id: r.f for r in got.collect()} == want
    assert [r.f for r in V.encode_ordinal(df, d.limit(0), "cats", "f", n_positions=1).select("f").distinct().collect()] == [[0.0]]


def test_few_strings_are_looked_up_without_a_join(spark, monkeypatch):
    rows = [(i, None if i == 7 else ["a" if i % 9 else "b", None if i % 4 == 0 else f"u{i % 30}", "é" if i % 2 else ""][:1 + i % 3]) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, cats array<string>")
    d = V.category_dictionary(df.where("id < 20"), "cats")
    got = V.encode_ordinal(df, d, "cats", "f", -1.0, 4)
    assert "Join" not in plan(got)
    monkeypatch.setattr(V, "LITERAL_VALUES", -1, raising=False)
    joined = V.encode_ordinal(df, d, "cats", "f", -1.0, 4)
    assert "Join" in plan(joined)
    want = {r.id: r.f for r in joined.collect()}
    assert {r.id: r.f for r in got.collect()} == want and len(want) == 300
    # a value that a dictionary holds twice gives a row each
    monkeypatch.setattr(V, "LITERAL_VALUES", 32, raising=False)
    twice = d.union(d.where("position = 0 and value = 'b'"))
    assert V.encode_ordinal(df.where("id = 9"), twice, "cats", "f", -1.0, 3).count() == 2
    numbers = spark.createDataFrame([(0, 5, 3), (0, 6, 4)], "position int, value int, idx long")
    assert [r.f for r in V.encode_ordinal(spark.createDataFrame([([6, 5],)], "cats array<int>"), numbers, "cats", "f", n_positions=1).collect()] == [[4.0]]


def test_click_lines_are_parsed_once(spark):
    rng = random.Random(4)
    rows = [f"{i}-1,{rng.randrange(2)},x,y,z," + ",".join(f"{'abc'[(i + j) % 3]}{j}" for j in range(10)) + f",{rng.randrange(9)},-{i % 5}" for i in range(200)]
    bad = [None, "", "7-2,q,x", rows[0].replace("0-1", "300-1") + ",none", "301-1,1"]
    lines = spark.createDataFrame([(r,) for r in rows + bad], "line string")
    train, test = J.click_parts(lines)
    for part in (train, test):  # the parts read written fields, not the lines
        assert "split(" not in plan(part) and "Scan parquet" in plan(part) and "md5" not in plan(part) and "Join" not in plan(part)
    want = split(spark.createDataFrame([(r.split(",")[0],) for r in [*rows, bad[-1]]], "id string"), [0.8, 0.2], "id", 1)
    for part, ids in zip((train, test), want):
        assert sorted(r.id for r in part.collect()) == sorted(r.id for r in ids.collect())
    fields = {r.id: (r.label, r.cats, r.nums) for r in train.union(test).collect()}
    assert fields["3-1"] == (float(rows[3].split(",")[1]), rows[3].split(",")[5:15], [float(rows[3].split(",")[15]), 0.0])
    assert fields["301-1"] == (1.0, [], [])


def test_losses_of_the_training_rows_need_no_second_binning(spark, monkeypatch):
    df, made, groups = boosting_rows(spark, 800), [], L.binned_groups
    monkeypatch.setattr(L, "binned_groups", lambda *a: made.append(1) or groups(*a))
    model = L.gbt(df, iters=3, depth=3)
    losses = model.evaluateEachIteration(df)
    assert len(made) == 1
    assert losses == pytest.approx(model.evaluateEachIteration(df.select("*")), abs=1e-12) and len(made) == 2


def boosting_rows(spark, n=3000):
    rng = random.Random(3)
    rows = [(i, [float(rng.randrange(4)), rng.gauss(0, 1), float(rng.randrange(60)), 5.0], 0.0) for i in range(n)]
    rows = [(i, x, float((x[0] > 1) != (x[1] > 0.3) or x[2] > 50)) for i, x, _ in rows]
    return spark.createDataFrame(rows, "id int, a array<double>, label double").withColumn("features", array_to_vector("a"))


def test_boosting_goes_over_distinct_binned_rows(spark, monkeypatch):
    df = boosting_rows(spark)
    fitted = []
    fit = GBTClassifier.fit
    monkeypatch.setattr(GBTClassifier, "fit", lambda self, rows: fitted.append(rows.count()) or fit(self, rows))
    once = L.gbt(df, iters=5, depth=4)
    twice = L.gbt(df.union(df).union(df), iters=5, depth=4)  # three times the rows, the same passes
    assert abs(fitted[0] - fitted[1]) < 0.02 * fitted[0] and max(fitted) <= 3000  # quantiles of many values are near ones
    rows = df.select("a", "features", F.col("label"), "id")
    a, b = ({r.id: round(r.m, 9) for r in m.transform(rows).select("id", F.expr("prediction").alias("m")).collect()} for m in (once, twice))
    assert sum(a[i] == b[i] for i in a) >= 0.95 * len(a)
    losses = once.evaluateEachIteration(df)
    assert len(losses) == 5 and losses[-1] < losses[0]
    assert all(abs(x - y) < 1e-12 for x, y in zip(losses, once.evaluateEachIteration(df.union(df))))
    # the losses of the distinct rows by their weights are those of every row on its own
    alone = once._model.evaluateEachIteration(once._binned(df).withColumn("_weight", F.lit(1.0)))
    assert all(abs(x - y) < 1e-9 for x, y in zip(losses, alone))


def test_bins_keep_the_side_of_every_threshold(spark):
    df = boosting_rows(spark, 500)
    edges = L.bin_edges(df)
    assert edges[0] == [0.5, 1.5, 2.5] and edges[3] == [] and 25 <= len(edges[1]) <= 31 and len(edges[2]) <= 31
    for r in L.binned(df, edges).select("a", "_binned").collect():
        assert r._binned == [sum(t < x for t in e) for x, e in zip(r.a, edges)]
    with pytest.raises(Exception, match="one size"):
        L.gbt(df.union(df.withColumn("features", array_to_vector(F.slice("a", 1, 3)))), iters=1)
    # trees over bins decide as trees over few values do
    few = df.withColumn("features", array_to_vector(F.array(F.get("a", F.lit(0)), F.get("a", F.lit(3)), F.get("a", F.lit(2)) % 7)))
    plain = GBTClassifier(maxIter=3, maxDepth=4).fit(few)
    pair = [{r.id: r.prediction for r in m.transform(few).collect()} for m in (plain, L.gbt(few, iters=3, depth=4))]
    assert pair[0] == pair[1]


def test_graph_clusters_are_steps_of_dataframes(spark):
    rng = random.Random(5)
    rows = [(a, b, 1.0 + 9 * (a // 20 == b // 20)) for a in range(40) for b in range(a, 40) if a // 20 == b // 20 or rng.random() < .02]
    edges = spark.createDataFrame(rows + [(0, 0, 50.0)], "src long, dst long, weight double")
    for mode in ("degree", "random"):
        one, two = ({r.id: r.embedding for r in C.power_embedding(e, 5, init_mode=mode).collect()} for e in (edges, edges.repartition(3)))
        assert set(one) == set(range(40)) and all(abs(one[v] - two[v]) < 1e-12 for v in one)
    found = {r.id: r.cluster for r in C.graph_clusters(edges, 2, 10).collect()}
    for row in [(1, None, 1.0), (1, 2, None), (1, 2, -1.0), (1, 2, float("nan"))]:
        with pytest.raises(ValueError):
            C.graph_clusters(edges.union(spark.createDataFrame([row], edges.schema)))
    assert len({found[v] for v in range(20)}) == 1 == len({found[v] for v in range(20, 40)}) and found[0] != found[39]


def test_hot_slots_are_not_one_task(spark):
    rows = spark.createDataFrame([(i, [1.0, float(i % 3), 0.0]) for i in range(30)], "id int, a array<double>").withColumn("features", array_to_vector("a"))
    centers = [[1.0, 0.0, 0.0], [0.0, 2.0, 5.0], [0.0, 0.0, 0.0]]
    got = C.nearest_sparse(rows, "id", centers)
    assert "SortMergeJoin" not in plan(got)
    want = {i: [sum((x - y) ** 2 for x, y in zip([1.0, float(i % 3), 0.0], c)) for c in centers] for i in range(30)}
    assert all(abs(x - y) < 1e-9 for r in got.collect() for x, y in zip(r.sq_dists, want[r.id]))
