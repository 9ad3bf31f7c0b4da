"""Lookups, aggregates, ordering and de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import CLAIM_PHRASE
from ..session import cut_lineage
from .parsing import claim_columns, drop_unparsed, filter_contains_any, is_claim, parse_log


# --------------------------------------------------------------------------- J2
def with_user_name(df: DataFrame, users: DataFrame, key: str = "user_id",
                   user_key: str = "user_id", user_name: str = "user_name") -> DataFrame:
    """Exact-id name lookup; an unknown id gives a null name (left join).

    The dimension is not force-broadcast: AQE broadcasts it when its measured
    size is under the threshold and falls back to a sort-merge join otherwise.
    """
    dim = users.select(F.col(user_key).alias("_uid"), F.col(user_name).alias(user_name))
    return (df.join(dim, F.col(key) == F.col("_uid"), "left").drop("_uid"))


# --------------------------------------------------------------------------- A1/O2/F4
def usage_by_user(logs: DataFrame, users: DataFrame, *, line: str = "line",
                  user_key: str = "user_id", user_name: str = "user_name",
                  phrase: str = CLAIM_PHRASE, order: str = "numeric") -> DataFrame:
    """Total claimed memory (MB) and disk (GB) per user from compute-log lines.

    parse (one regex pass) -> keep parsed lines with a claim message -> partial +
    final sum per user (a hot user is combined map-side, never materialised) ->
    keep users whose id *contains* a known id -> exact name lookup -> order.
    The contains-filter depends only on the user key, so it runs after the
    aggregation, on one row per user instead of one per line.
    """
    p = parse_log(logs, line, "compute", groups=(7, 10), keep=[], matched_col=None)
    p = drop_unparsed(p, "user_id").filter(is_claim("message", phrase))
    memory, disk = claim_columns("message")
    totals = p.groupBy("user_id").agg(F.sum(memory).alias("memory_mb"),
                                      F.sum(disk).alias("disk_gb"),
                                      F.count(F.lit(1)).alias("n_claims"))
    # one row per user, written to the checkpoint dir: the lines are read and parsed
    # once, and the contains-filter below works on the small table only
    totals = cut_lineage(totals)
    totals = filter_contains_any(totals, "user_id", users, user_key)
    named = with_user_name(totals, users, "user_id", user_key, user_name)
    named = named.select("user_id", user_name, "memory_mb", "disk_gb", "n_claims")
    if order == "text":  # the original ordered by the text "memory M, disk D"
        return named.orderBy(F.format_string("memory %d, disk %d", "memory_mb", "disk_gb"), "user_id")
    return named.orderBy("memory_mb", "disk_gb", "user_id")


# --------------------------------------------------------------------------- J5
def subtract_rows(df: DataFrame, other: DataFrame) -> DataFrame:
    """Rows of ``df`` with no equal row in ``other`` (all columns, null-safe).

    Duplicates of an unmatched row are kept and every copy of a matched row is
    dropped — the semantics of RDD ``subtract`` (neither EXCEPT nor EXCEPT ALL).
    The other side is de-duplicated before the anti-join so a hot row on that
    side cannot blow up the join.
    """
    o = other.select(*[F.col(c).alias(f"_o_{c}") for c in df.columns]).distinct()
    cond = None
    for c in df.columns:
        e = F.col(c).eqNullSafe(F.col(f"_o_{c}"))
        cond = e if cond is None else cond & e
    return df.join(o, cond, "left_anti")


# --------------------------------------------------------------------------- A5/T6
def extremes(df: DataFrame, value: str, key: str) -> DataFrame:
    """Smallest and largest by value in one pass; ties broken by the smaller key."""
    v, k = F.col(value), F.col(key)
    return df.where(v.isNotNull()).agg(
        F.min_by(k, F.struct(v, k)).alias(f"min_{key}"), F.min(v).alias(f"min_{value}"),
        F.min_by(k, F.struct(-v, k)).alias(f"max_{key}"), F.max(v).alias(f"max_{value}"))


# --------------------------------------------------------------------------- A6
def count_series(df: DataFrame, key: str = "key") -> DataFrame:
    return df.agg(F.countDistinct(key).alias("n_series"))


# --------------------------------------------------------------------------- O3
def top_k(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """Deterministic first-n rows (TakeOrderedAndProject: per-partition top-n, no full sort)."""
    return df.orderBy(*order).limit(n)


# --------------------------------------------------------------------------- D1/D2
def distinct_points(df: DataFrame, col: str = "features") -> DataFrame:
    """Distinct feature arrays (vectors are compared through their array form)."""
    t = dict(df.dtypes)[col]
    if t == "vector":
        from pyspark.ml.functions import array_to_vector, vector_to_array
        return (df.select(vector_to_array(col).alias(col)).distinct()
                .select(array_to_vector(col).alias(col)))
    return df.select(col).distinct()
