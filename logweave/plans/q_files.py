"""Queries on files: what is written to the shared folder, read back, must be the tables it came from."""

from __future__ import annotations

import uuid

from pyspark.ml.classification import DecisionTreeClassificationModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import learn as L
from ..operators.split import split
from ..session import ensure_checkpoint_dir, read_table
from ..sources import io
from .q_models import _SQL_TREE_ROWS, SEED, sql_left, sql_stump, supplier_part_edges, tree_rows
from .registry import query
from .renders import SQL_AGENT_LINES, agent_lines


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder in the cluster's shared checkpoint directory."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("text_lines", ops=("S1",), sql=f"""
SELECT line FROM ({SQL_AGENT_LINES}) WHERE line IS NOT NULL AND NOT regexp_matches(line, '[\\r\\n]')
""")
def q_text_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Log lines as text files and back (those that are one line)."""
    path = scratch(spark, "lines")
    lines = agent_lines(read_table(spark, sf, "events")).select("line")
    lines.where("line is not null and not line rlike '[\\\\r\\\\n]'").write.text(path)
    return io.read_lines(spark, path)


@query("libsvm_rows", ops=("S2",), sql="""
SELECT CAST(vec_id AS DOUBLE) AS label, 64 AS size, round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS total, CAST(embedding[1] AS DOUBLE) AS first
FROM embeddings
""")
def q_libsvm_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors in LIBSVM files and back, with a declared width."""
    path = scratch(spark, "libsvm")
    e = read_table(spark, sf, "embeddings").select(F.col("vec_id").cast("double").alias("label"), array_to_vector("embedding").alias("features"))
    e.write.format("libsvm").save(path)
    x = vector_to_array("features")
    rows = io.read_libsvm(spark, path, num_features=64)
    return rows.select("label", F.size(x).alias("size"), F.round(F.aggregate(x, F.lit(0.0), lambda a, v: a + v), 6).alias("total"), F.get(x, F.lit(0)).alias("first"))


#: The partition that is written anew.
RENEWED = "click"


@query("partitioned_events", ops=("S5",), sql=f"""
SELECT event_id, event_type, CASE WHEN event_type = '{RENEWED}' THEN value * 2 ELSE value END AS value FROM events
""")
def q_partitioned_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events in one directory per type; one type is then replaced by doubled values, the others stay as they were."""
    path = scratch(spark, "events")
    events = read_table(spark, sf, "events").select("event_id", "value", "event_type")
    io.write_partitioned(events, path, "event_type")
    renewed = events.where(F.col("event_type") == RENEWED).withColumn("value", F.col("value") * 2)
    io.write_partitioned(renewed, path, "event_type", only_present=True)
    return io.read_partitioned(spark, path, events.schema)


@query("saved_tree", ops=("S6",), sql="WITH" + _SQL_TREE_ROWS + ", train AS (SELECT * FROM d WHERE is_train)," + sql_stump("s", "train", "y") + f"""
SELECT l_orderkey, l_linenumber, round(CASE WHEN {sql_left("s")} THEN ls / lw ELSE rs / rw END, 9) AS share FROM d, s WHERE NOT is_train
""")
def q_saved_tree(spark: SparkSession, sf: str) -> DataFrame:
    """A fitted stump, saved and loaded, on the test rows."""
    path = scratch(spark, "model")
    train, test = split(tree_rows(spark, sf), [0.6, 0.4], ["l_orderkey", "l_linenumber"], SEED)
    io.save_model(L.decision_tree(train, depth=1), path)
    model = io.load_model(DecisionTreeClassificationModel, path)
    return model.transform(test).select("l_orderkey", "l_linenumber", F.round(vector_to_array("probability")[1], 9).alias("share"))


@query("saved_edges", ops=("S7",), sql="""
SELECT l_suppkey * 2 AS src, l_partkey * 2 + 1 AS dst, sum(l_quantity) AS weight FROM lineitem GROUP BY 1, 2
""")
def q_saved_edges(spark: SparkSession, sf: str) -> DataFrame:
    """The edge table, saved and loaded."""
    path = scratch(spark, "edges")
    io.save_table(supplier_part_edges(spark, sf), path)
    return io.load_table(spark, path)
