"""Exact top-k search (operator 7): impact-ordered, score-at-a-time index.

Vectors are cut to integers and dealt into blocks. In a block every component is a
posting: its dimension's list holds (row, impact), the impact being the component's size
quantised to a few levels, and a posting segment is what one level holds, as a matrix of signs (rows of a batch
meet it in one product, which is faster than lists here). A batch of queries processes the segments of a
block by descending level, adding the middle of the level's range to the scores; what is still open is bounded by the query's weights and
the level. Processing stops when the bounds prove that only few rows can still be among the
k best (or when no segment is left), and those rows are scored exactly from the integers.
The result is exact in every case; a stop too early only leaves more rows to score.

Query batches meet the blocks in an equi-join on the cells of a grid: blocks are dealt into as many groups as
the root of their number, batches into parts likewise, so a vector is sent as often as the root of the
other side's batches or blocks. Batches and blocks are of bounded size and a task holds one pair at a
time, whatever the table's size. Only the best k of a pair leave the task.

Defined cases: vectors that are null or hold null or non-finite components take no part;
vectors of unequal length (empty ones too) count missing components as zero; a finite component that scaled is 2^62 or
more, and a score beyond a long, are errors; a query's own row is left
out, other rows with its id are not, and queries with equal ids are searched and ranked one by one; ties
go to the smaller id, null last. Null ids are no queries. An empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import table

BLOCK_ROWS = 1024
BATCH_QUERIES = 256
LEVELS = 16
NO_ID = np.iinfo(np.int64).max

_BLOCK = "block bigint, n int, dim int, ids binary, vectors binary"
_HITS = "query_row bigint, query_id bigint, vec_id bigint, vec_row bigint, score bigint"


def integer_vectors(rows: DataFrame, scale: float = 256.0) -> DataFrame:
    """(vec_id, v): floor(scale * x) of the vectors that take part."""
    size = lambda x: F.abs(x.cast("double"))
    whole = F.transform("embedding", lambda x: F.when(size(x) * scale < float(1 << 62), F.floor(x.cast("double") * scale)).otherwise(
        F.raise_error("a component is too large for integer scores").cast("bigint")))
    fit = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (size(x) < float("inf")))
    return rows.where(F.col("embedding").isNotNull() & fit).select(F.col("vec_id").cast("bigint"), whole.alias("v"))


def _blocks(batches: Iterator[pa.RecordBatch], block_rows: int) -> Iterator[pa.RecordBatch]:
    context = TaskContext.get()
    number = (context.partitionId() if context else 0) << 32
    for batch in batches:
        for at in range(0, batch.num_rows, block_rows):
            part = batch.slice(at, block_rows)
            ids = part.column(0).fill_null(int(NO_ID)).to_numpy(zero_copy_only=False).astype(np.int64)
            lists = part.column(1)
            widths = np.diff(lists.offsets.to_numpy())
            values = lists.flatten().to_numpy(zero_copy_only=False)
            matrix = np.zeros((len(ids), int(widths.max())), np.int64)
            matrix[np.arange(matrix.shape[1]) < widths[:, None]] = values
            yield pa.RecordBatch.from_arrays([
                pa.array([number], pa.int64()), pa.array([len(ids)], pa.int32()), pa.array([matrix.shape[1]], pa.int32()),
                pa.array([ids.tobytes()], pa.binary()), pa.array([matrix.tobytes()], pa.binary())],
                ["block", "n", "dim", "ids", "vectors"])
            number += 1


def _batches_of_queries(batches: Iterator[pa.RecordBatch], every: int, size: int) -> Iterator[pa.RecordBatch]:
    """The query rows of some blocks, ``size`` at a time; ``rows`` names the rows."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def out(n: int) -> pa.RecordBatch:
        width = max(m.shape[1] for _, _, m in held)
        ids, rows = (np.concatenate([h[i] for h in held]) for i in (0, 1))
        matrix = np.concatenate([_wider(m, width) for _, _, m in held])
        held[:] = [(ids[n:], rows[n:], matrix[n:])] if len(ids) > n else []
        return pa.RecordBatch.from_arrays([
            pa.array([len(ids[:n])], pa.int32()), pa.array([width], pa.int32()), pa.array([ids[:n].tobytes()], pa.binary()),
            pa.array([rows[:n].tobytes()], pa.binary()), pa.array([matrix[:n].tobytes()], pa.binary())],
            ["q_n", "q_dim", "q_ids", "q_rows", "q_vectors"])

    for batch in batches:
        for block, n, dim, ids, vectors in zip(*(c.to_pylist() for c in batch.columns)):
            ids = np.frombuffer(ids, np.int64)
            chosen = np.flatnonzero((ids % every == 0) & (ids != NO_ID))
            if len(chosen):
                held.append((ids[chosen], (block << 12) + chosen, np.frombuffer(vectors, np.int64).reshape(n, dim)[chosen]))
            while sum(len(h[0]) for h in held) >= size:
                yield out(size)
    if held:
        yield out(size)


class ImpactIndex:
    """The posting segments of one block, from the highest impact to the lowest."""

    def __init__(self, matrix: np.ndarray, levels: int = LEVELS):
        size = np.abs(matrix)
        self.matrix = matrix
        self.step = max(1, -(-int(size.max(initial=0)) // levels))
        level = -(-size // self.step)
        self.segments = [(int(x), np.where(level == x, np.sign(matrix), 0).astype(np.float64))
                         for x in np.unique(level)[::-1] if x > 0]

    def possible(self, queries: np.ndarray, k: int, enough: float = 0.02) -> np.ndarray:
        """Boolean (queries, rows): what the bounds can't exclude from the k best."""
        weights = queries.astype(np.float64)
        mass = np.abs(weights).sum(axis=1, keepdims=True)
        scores = np.zeros((len(queries), len(self.matrix)))
        few = max(4 * k, enough * len(self.matrix))
        open_rows = np.ones(scores.shape, bool)
        if len(self.matrix) <= k:
            return open_rows
        for i, (level, signs) in enumerate(self.segments):
            scores += weights @ signs.T * ((level - 0.5) * self.step)
            if i % 4 != 3 and i + 1 < len(self.segments):
                continue  # the bounds are worked out after every fourth segment
            following = self.segments[i + 1][0] if i + 1 < len(self.segments) else 0
            # a posting is off by half a step once processed, by its whole size before
            slack = mass * max(0.5, following) * self.step * (1 + 1e-9) + 1
            least = np.partition(scores, -k, axis=1)[:, -k][:, None] - slack
            open_rows = scores + slack >= least
            if open_rows.sum(axis=1).max() <= few:
                break
        return open_rows


def _exact(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products of one query with some rows."""
    if int(np.abs(queries).max(initial=0)) * int(np.abs(rows).max(initial=0)) * rows.shape[1] < 1 << 62:
        return (queries * rows).sum(axis=1)
    exact = [sum(a * b for a, b in zip(queries.tolist(), row)) for row in rows.tolist()]
    return np.array(exact, np.int64) if exact else np.zeros(0, np.int64)  # beyond a long: an error


def best(index: ImpactIndex, queries: np.ndarray, own: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, rows, scores) of the k best of one block; ``own`` is a query's row here, or -1."""
    # one more than k, as the own row may be among them
    open_rows = index.possible(queries, k + 1)
    for q, mine in enumerate(own.tolist()):
        rows = np.flatnonzero(open_rows[q])
        rows = rows[rows != mine]
        scores = _exact(queries[q], index.matrix[rows])
        top = np.lexsort((ids[rows], -scores))[:k]
        yield q, rows[top], scores[top]


def _wider(matrix: np.ndarray, width: int) -> np.ndarray:
    return np.pad(matrix, ((0, 0), (0, width - matrix.shape[1])))


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    held, index = None, None
    for batch in batches:
        columns = [batch.column(i) for i in range(batch.num_columns)]
        for at in range(batch.num_rows):
            block, n, dim, ids, vectors, q_n, q_dim, q_ids, q_rows, q_vectors = (c[at].as_py() for c in columns)
            width = max(dim, q_dim)
            if held != (block, width):
                index = ImpactIndex(_wider(np.frombuffer(vectors, np.int64).reshape(n, dim), width))
                held = (block, width)
            ids, q_ids, q_rows = (np.frombuffer(x, np.int64) for x in (ids, q_ids, q_rows))
            queries = _wider(np.frombuffer(q_vectors, np.int64).reshape(q_n, q_dim), width)
            own = np.where(q_rows >> 12 == block, q_rows & 4095, -1)
            found = list(best(index, queries, own, ids, k))
            of = np.concatenate([np.full(len(rows), q) for q, rows, _ in found])
            rows = np.concatenate([r for _, r, _ in found])
            vec = ids[rows]
            yield pa.RecordBatch.from_arrays([
                pa.array(q_rows[of]), pa.array(q_ids[of]), pa.array(vec, mask=vec == NO_ID), pa.array((block << 12) + rows),
                pa.array(np.concatenate([s for _, _, s in found]))], ["query_row", "query_id", "vec_id", "vec_row", "score"])


def top_k(rows: DataFrame, k: int = 5, every: int = 50, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of every row whose id is divisible by ``every``."""
    if block_rows > 4096:
        raise ValueError("a block holds at most 4096 rows")
    index = cut_lineage(integer_vectors(rows).mapInArrow(partial(_blocks, block_rows=block_rows), _BLOCK))
    queries = cut_lineage(index.mapInArrow(partial(_batches_of_queries, every=every, size=BATCH_QUERIES),
                                           "q_n int, q_dim int, q_ids binary, q_rows binary, q_vectors binary"))
    groups, parts = (max(1, math.isqrt(n)) for n in (index.count(), queries.count()))
    every_one = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    dealt = index.withColumn("_group", F.pmod(F.xxhash64("block"), F.lit(groups))).withColumn("_part", every_one(parts))
    sent = queries.withColumn("_part", F.pmod(F.xxhash64("q_rows"), F.lit(parts))).withColumn("_group", every_one(groups))
    pairs = dealt.join(sent, ["_group", "_part"]).drop("_group", "_part")
    hits = pairs.mapInArrow(partial(_search, k=k), _HITS)
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "vec_row")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


OP7_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
           WHERE embedding IS NOT NULL),
q AS (SELECT vec_id, e FROM v WHERE vec_id % 50 = 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id AS vec_id, CAST(list_inner_product(q.e, v.e) AS BIGINT) AS score
      FROM q JOIN v ON q.vec_id <> v.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5
"""


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))
