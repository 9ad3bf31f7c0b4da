"""Split, sample and fold queries on orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import HASH_RANGE
from ..operators.split import fold_column, kfold_aggregate, sample, split_index
from ..session import read_table
from .registry import query


def hash_sql(seed: int, key: str) -> str:
    """SQL twin of ``hash_value``."""
    return f"('0x' || substr(md5('{seed}|' || {key}), 1, 15))::BIGINT"


def edge_sql(fraction: float) -> str:
    return str(int(round(fraction * HASH_RANGE)))


@query("hash_split", ops=("X1",), sql=f"""
SELECT o_orderkey, CASE WHEN {hash_sql(12345, 'o_orderkey')} < {edge_sql(0.7)} THEN 0 ELSE 1 END AS part
FROM orders
""")
def q_hash_split(spark: SparkSession, sf: str) -> DataFrame:
    o = read_table(spark, sf, "orders")
    return o.select("o_orderkey", split_index("o_orderkey", [0.7, 0.3], 12345).cast("int").alias("part"))


@query("sample", ops=("X2",), sql=f"""
SELECT o_orderkey, o_totalprice FROM orders WHERE {hash_sql(11, 'o_orderkey')} < {edge_sql(0.6)}
""")
def q_sample(spark: SparkSession, sf: str) -> DataFrame:
    o = read_table(spark, sf, "orders")
    return sample(o, 0.6, "o_orderkey", 11).select("o_orderkey", "o_totalprice")


@query("kfold", ops=("X3",), sql=f"""
SELECT o_orderkey, CAST({hash_sql(10, 'o_orderkey')} % 3 AS INTEGER) AS fold FROM orders
""")
def q_kfold(spark: SparkSession, sf: str) -> DataFrame:
    o = read_table(spark, sf, "orders")
    return o.select("o_orderkey", fold_column("o_orderkey", 3, 10).alias("fold"))


@query("kfold_aggregate", ops=("A4",), sql="""
SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) * 2 AS DOUBLE) AS train_total,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) * 2 AS DOUBLE) / 3 AS train_average
FROM orders
""")
def q_kfold_aggregate(spark: SparkSession, sf: str) -> DataFrame:
    o = read_table(spark, sf, "orders")
    # prices have cents: summing them as decimals makes the totals exact
    o = o.withColumn("price", F.col("o_totalprice").cast("decimal(18,2)"))
    return kfold_aggregate(o, 3, "o_orderkey", "price", seed=10)


@query("sample_small", ops=("X2",), sql=f"""
SELECT l_orderkey, l_linenumber FROM lineitem
WHERE {hash_sql(13, "l_orderkey || '|' || l_linenumber")} < {edge_sql(0.002)}
""")
def q_sample_small(spark: SparkSession, sf: str) -> DataFrame:
    """A small fraction: two in a thousand of the lines."""
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return sample(li, 0.002, ["l_orderkey", "l_linenumber"], 13)
