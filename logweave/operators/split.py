"""Reproducible splits, samples and folds.

Rows are assigned by the md5 of ``seed|key``, a number in [0, 2**60): the assignment depends only
on the row's key, never on partition layout or task retries, so a lost executor
recomputes exactly the same split. ``randomSplit``/``sample`` remain available
for callers that want Spark's own Bernoulli sampling.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import HASH_RANGE, hash_value
from ..session import written


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def split_index(key: str | Sequence[str], weights: Sequence[float], seed: int) -> Column:
    """Index of the part (0..len(weights)-1) each row falls in."""
    total = float(sum(weights))
    b = hash_value(_keys(key), seed)
    edges, acc = [], 0.0
    for w in weights[:-1]:
        acc += w / total
        edges.append(int(round(acc * HASH_RANGE)))
    expr = F.lit(len(weights) - 1)
    for i in reversed(range(len(edges))):
        expr = F.when(b < edges[i], F.lit(i)).otherwise(expr)
    return expr


# --------------------------------------------------------------------------- X1
def split(df: DataFrame, weights: Sequence[float], key: str | Sequence[str], seed: int = 0,
          method: str = "hash") -> list[DataFrame]:
    if method == "random":
        return df.randomSplit(list(weights), seed)
    idx = split_index(key, weights, seed)
    return [df.where(idx == i) for i in range(len(weights))]


def split_written(df: DataFrame, weights: Sequence[float], key: str | Sequence[str], seed: int = 0, name: str = "split") -> list[DataFrame]:
    """The parts of ``split``, for rows that several passes read: they are made, and dealt to their parts, once."""
    rows = written(df.withColumn("_part", split_index(key, weights, seed).cast("int")), name)
    return [rows.where(F.col("_part") == i).drop("_part") for i in range(len(weights))]


# --------------------------------------------------------------------------- X2
def sample(df: DataFrame, fraction: float, key: str | Sequence[str], seed: int = 0,
           method: str = "hash") -> DataFrame:
    if method == "random":
        return df.sample(withReplacement=False, fraction=fraction, seed=seed)
    return df.where(hash_value(_keys(key), seed) < int(round(fraction * HASH_RANGE)))


# --------------------------------------------------------------------------- X3
def fold_column(key: str | Sequence[str], k: int, seed: int = 0) -> Column:
    return F.pmod(hash_value(_keys(key), seed), F.lit(k)).cast("int")


def kfold(df: DataFrame, k: int, key: str | Sequence[str], seed: int = 0, out: str = "fold") -> DataFrame:
    """Fold id per row; ``CrossValidator(foldCol=out)`` accepts it directly."""
    return df.withColumn(out, fold_column(key, k, seed))


# --------------------------------------------------------------------------- A4
def kfold_aggregate(df: DataFrame, k: int, key: str | Sequence[str], value: str,
                    seed: int = 0) -> DataFrame:
    """Sum of ``value`` over each fold's training part, then total and average.

    One aggregation by fold (k rows); the training sum of fold f is the grand
    total minus the fold's own sum, so no fold's training data is re-read.
    """
    per = kfold(df, k, key, seed).groupBy("fold").agg(F.sum(value).alias("_s"))
    folds = df.sparkSession.range(k).select(F.col("id").cast("int").alias("fold"))
    per = folds.join(per, "fold", "left").fillna({"_s": 0})
    t = per.agg(F.sum("_s").alias("_tot"))
    # every row is in k-1 training parts, so the training sums add up to (k-1) * total
    total = (F.col("_tot") * (k - 1)).cast("double")
    return t.select(total.alias("train_total"), (total / k).alias("train_average"))


def kfold_training_sums(df: DataFrame, k: int, key: str | Sequence[str], value: str,
                        seed: int = 0) -> DataFrame:
    """(fold, train_sum) — total minus fold sum, over the k fold rows only."""
    per = kfold(df, k, key, seed).groupBy("fold").agg(F.sum(value).alias("_s"))
    folds = df.sparkSession.range(k).select(F.col("id").cast("int").alias("fold"))
    per = folds.join(per, "fold", "left").fillna({"_s": 0})
    tot = per.agg(F.sum("_s")).first()[0] or 0
    return per.select("fold", (F.lit(tot) - F.col("_s")).cast("double").alias("train_sum"))
