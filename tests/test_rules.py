"""Scale rules and odd inputs: fractions of any size, long series, marks in lines, bad rows."""

import math
import time

import pytest
from pyspark.ml.feature import Tokenizer
from pyspark.sql import functions as F

from logweave import session
from logweave.functions.columns import regex_groups, regex_match
from logweave.operators import evaluate as E
from logweave.operators import learn as L
from logweave.operators import parsing as P
from logweave.operators import split as X
from logweave.operators import timeseries as T
from logweave.operators.indexing import with_row_id


# ------------------------------------------------------------------ splits
def test_small_fractions(spark):
    rows = spark.range(1_000_000)
    assert 1 <= X.sample(rows, 1e-5, "id").count() <= 30
    assert 180 <= X.sample(rows, 2.5e-4, "id").count() <= 330
    big, small = X.split(rows, [0.99999, 0.00001], "id")
    assert 1 <= small.count() <= 30 and big.count() + small.count() == 1_000_000


def test_row_ids_of_one_value(spark):
    df = spark.range(2000).select(F.lit("en").alias("lang"), "id")
    got = with_row_id(df, ["lang"], num_partitions=8)
    assert sorted(r.row_id for r in got.collect()) == list(range(2000))
    assert got.select(F.spark_partition_id().alias("p")).distinct().count() > 2


# ------------------------------------------------------------------ series
def test_long_single_series_fills_in_seconds(spark):
    n = 100_000
    df = spark.range(n).select(F.lit("a").alias("key"), (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), F.col("id").cast("decimal(18,6)"))).alias("ts"),
        F.when((F.col("id") % 50_000 == 0) | (F.col("id") == n - 1), F.col("id").cast("double")).alias("value"))
    start = time.time()
    for stretch in (T.STRETCH, 1000):
        got = T.fill(df, stretch=stretch).agg(F.count("value"), F.sum("value")).first()
        assert got[0] == n and math.isclose(got[1], n * (n - 1) / 2)
    assert time.time() - start < 60


def test_stretches_do_not_change_results(spark):
    rows = [("k%d" % (i % 2), f"2024-01-{1 + i // 2:02d} 00:00:00", None if i % 7 in (0, 1, 2) else float(i * i % 11)) for i in range(56)]
    rows += [(None, "2024-01-01 00:00:00", 1.0), (None, "2024-01-03 00:00:00", None), (None, "2024-01-05 00:00:00", 2.0)]
    df = spark.createDataFrame(rows, "key string, ts string, value double").withColumn("ts", F.col("ts").cast("timestamp_ntz"))

    def all_of(stretch):
        f = T.fill(df, stretch=stretch)
        r = T.return_rates(f, stretch=stretch)
        return [sorted(map(str, x.collect())) for x in (f, r, T.durbin_watson(r, stretch=stretch).select("key", F.round("dw", 9)))]
    assert all_of(86400) == all_of(3 * 86400) == all_of(10 ** 9)


@pytest.mark.parametrize("step,want", [
    ("1 month", ["2024-01-31", "2024-02-29", "2024-03-31", "2024-04-30"]), ("quarter", ["2024-01-31", "2024-04-30"]),
    ("business day", None), ("2 weeks", ["2024-01-31", "2024-02-14", "2024-02-28", "2024-03-13", "2024-03-27", "2024-04-10", "2024-04-24"])])
def test_steps(spark, step, want):
    idx = [str(r.ts)[:10] for r in T.datetime_index(spark, "2024-01-31 00:00:00", "2024-05-01 00:00:00", step).orderBy("ts").collect()]
    if want is None:
        from datetime import date, timedelta
        days = [date(2024, 1, 31) + timedelta(days=i) for i in range(92)]
        want = [str(d) for d in days if d.weekday() < 5]
    assert idx == want


def test_empty_series_and_no_array_literal(spark):
    none = spark.createDataFrame([], "key string, ts timestamp_ntz, value double")
    lo, hi = T.index_bounds(none)
    assert T.align(none, lo, hi).count() == 0 and T.datetime_index(spark, lo, hi).count() == 0
    obs = spark.createDataFrame([("a", "2024-01-01 00:00:00", 1.0)], "key string, ts string, value double").withColumn(
        "ts", F.col("ts").cast("timestamp_ntz"))
    plan = T.align(obs, "2024-01-01 00:00:00", "2026-01-01 00:00:00", "1 minute")._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 20_000
    assert T.align(obs, "2024-01-01 00:00:00", "2024-01-02 00:00:00", "1 minute").count() == 1441


# ------------------------------------------------------------------ lines
def test_marks_and_references_in_lines(spark):
    lines = ["a=1 b=2", "x\u0001y a=1\u0002 b=2", "\u0002", "a=\u0001 b=2 \u0001\u0002", None, ""]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    pattern = r"(\w)=(\S*) (b)"
    got = df.select(regex_groups("line", pattern, 3).alias("g"), *[F.regexp_extract("line", pattern, i).alias(f"e{i}") for i in range(4)]).collect()
    for line, r in zip(lines, got):
        assert (r.g is None) if line is None else r.g == [r.e0, r.e1, r.e2, r.e3]
    ref = spark.createDataFrame([("ab ab",)], "line string").select(regex_match("line", r"(\w+) \1", 1).alias("g")).first().g
    assert ref == ["ab ab", "ab"]


def test_parsing_starts_no_job(spark):
    lines = spark.range(100).groupBy((F.col("id") % 7).alias("k")).agg(F.max(F.col("id").cast("string")).alias("line"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("parse-only", "building a plan")
    P.parse_log(lines, "line", "compute")
    assert list(tracker.getJobIdsForGroup("parse-only")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_literal_separators(spark):
    df = spark.createDataFrame([("1|2 3",)], "line string")
    assert P.parse_labeled(df, sep="|").first().features == [2.0, 3.0]
    assert P.split_tokens(spark.createDataFrame([("a.b",)], "v string"), "v", sep=".").first().items == ["a", "b"]


def test_one_word_rule(spark):
    texts = ["a  b ", "", " ", " A\tb", "x", "\t\t", "Ünder one"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    want = [r.w for r in Tokenizer(inputCol="text", outputCol="w").transform(df).collect()]
    assert [r.words for r in P.tokenize(df).collect()] == want


def test_bad_rows_are_dropped_and_counted(spark):
    df = spark.createDataFrame([("1,1 2",), ("x,1 2",), ("0,1 z",), ("",), (None,)], "line string")
    assert [r.label for r in P.parse_labeled(df, vector=True).collect()] == [1.0]
    assert P.count_bad(P.parse_labeled(df), label="label").first() == (5, 4)
    assert P.parse_dense(spark.createDataFrame([("1 2",), ("1 q",)], "line string"), vector=True).count() == 1


# ------------------------------------------------------------------ evaluation, learning, session
def test_nan_scores_rank_highest(spark):
    df = spark.createDataFrame([(float("nan"), 1.0), (0.5, 0.0), (0.7, 1.0), (0.1, 0.0), (None, 1.0)], "score double, label double")
    assert E.au_roc(df).first().au_roc == 1.0
    df = spark.createDataFrame([(float("nan"), 0.0), (0.5, 1.0)], "score double, label double")
    assert E.au_roc(df).first().au_roc == 0.0


def test_many_buckets_separate(spark):
    df = spark.range(4000).select(F.col("id").cast("double").alias("score"), (F.col("id") % 2).cast("double").alias("label"))
    assert math.isclose(E.au_roc(df, buckets=1000).first().au_roc, 0.5 + 0.5 / 2000)


def test_number_of_classes(spark):
    from pyspark.ml.linalg import Vectors
    df = spark.createDataFrame([(float(i % 2), Vectors.dense([float(i), 1.0])) for i in range(20)], ["label", "features"])
    assert L.logistic(df, num_classes=4, max_iter=5).numClasses == 4


def test_checkpoint_folder_must_be_shared(monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="shared"):
        session.ensure_checkpoint_dir(Session())
