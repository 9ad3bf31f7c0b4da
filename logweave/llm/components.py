"""Connected components of an edge table by alternating large-star and small-star steps.

Edges stay distributed throughout; each step is one aggregation (least neighbour of a
node, combined map-side) and one join, checkpointed, and the driver sees two numbers a
round. A hub with very many neighbours is no group in any one task: its minimum is a
partial aggregate, and its rows meet that one-row minimum in a join that Spark can split.

Defined cases: an edge with a null end and an edge from a node to itself are no edges; repeated edges count
once; an empty edge table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def _least(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))


def _rows(edges: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """Several (u, v) rows from each edge; a generator, so the edges are read once."""
    return edges.select(F.inline(F.array(*[F.struct(F.col(a).alias("u"), F.col(b).alias("v")) for a, b in pairs])))


def _large_star(edges: DataFrame) -> DataFrame:
    both = _rows(edges, ("u", "v"), ("v", "u"))
    return both.join(_least(both), "u").where(F.col("v") > F.col("u")).select(
        F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = _rows(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), ("u", "v"), ("u", "u")).distinct()
    return down.join(_least(down), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, v): every node with an edge that is not its component's least node, and that least node."""
    now = cut_lineage(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct())
    mark = None
    while True:
        before, mark = mark, tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if mark == before or not mark[0]:
            return now
        now = cut_lineage(_small_star(_large_star(now)))
