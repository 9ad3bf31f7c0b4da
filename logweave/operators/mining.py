"""Frequent item sets, association rules and sequential patterns."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth, PrefixSpan
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .indexing import with_row_id


def _fpgrowth(min_support: float, min_confidence: float, items: str, num_partitions: int | None):
    fp = FPGrowth(itemsCol=items, minSupport=min_support, minConfidence=min_confidence)
    if num_partitions:
        fp = fp.setNumPartitions(num_partitions)
    return fp


# --------------------------------------------------------------------------- B1
def frequent_itemsets(df: DataFrame, min_support: float, items: str = "items",
                      num_partitions: int | None = None) -> DataFrame:
    """(items, freq). Support is relative to *all* baskets, empty ones included.

    Parallel FP-growth: the baskets are split by item into ``num_partitions``
    conditional databases (one shuffle), each mined independently. Repeated items
    inside a basket are removed first (the miner rejects them).
    """
    base = df.select(F.array_distinct(F.col(items)).alias("items"))
    model = _fpgrowth(min_support, 0.0, "items", num_partitions).fit(base)
    return model.freqItemsets


# --------------------------------------------------------------------------- B2
def association_rules(df: DataFrame, min_support: float, min_confidence: float,
                      items: str = "items", num_partitions: int | None = None) -> DataFrame:
    """(antecedent, consequent, confidence, lift, support); one-item consequents."""
    base = df.select(F.array_distinct(F.col(items)).alias("items"))
    model = _fpgrowth(min_support, min_confidence, "items", num_partitions).fit(base)
    return model.associationRules


# --------------------------------------------------------------------------- B3
def rules_from_itemsets(itemsets: DataFrame, min_confidence: float, items: str = "items",
                        freq: str = "freq") -> DataFrame:
    """Rules from a given (items, freq) table: X => {c} with conf = freq(X+c)/freq(X).

    Each item set of two or more items is exploded once per consequent; the
    antecedent's frequency is found by an equi-join on the sorted antecedent.
    Sides are never empty. Confidence bound is inclusive.
    """
    s = itemsets.select(F.array_sort(F.col(items)).alias("_set"), F.col(freq).alias("_f"))
    cand = (s.where(F.size("_set") >= 2)
            .select("_set", "_f", F.explode("_set").alias("_c"))
            .select(F.array_sort(F.array_except("_set", F.array("_c"))).alias("antecedent"),
                    F.array("_c").alias("consequent"), "_f"))
    ante = s.select(F.col("_set").alias("antecedent"), F.col("_f").alias("_af"))
    return (cand.join(ante, "antecedent")
            .select("antecedent", "consequent", (F.col("_f") / F.col("_af")).alias("confidence"))
            .where(F.col("confidence") >= min_confidence))


# --------------------------------------------------------------------------- O1
def rank_rules(rules: DataFrame, out: str = "rank") -> DataFrame:
    """Every rule with its rank from 1: by confidence, highest first, then by the items of
    the antecedent and the consequent. Ranks come from range partitions, not from one task."""
    named = rules.withColumn("_a", F.array_join(F.array_sort("antecedent"), "\u0001")).withColumn(
        "_c", F.array_join(F.array_sort("consequent"), "\u0001"))
    ranked = with_row_id(named, [F.desc("confidence"), "_a", "_c"], out=out)
    return ranked.withColumn(out, F.col(out) + 1).drop("_a", "_c")


# --------------------------------------------------------------------------- B4
def frequent_sequences(df: DataFrame, min_support: float, max_len: int = 10,
                       sequence: str = "sequence", max_local_proj_db: int = 32_000_000) -> DataFrame:
    """(sequence, freq) of frequent sequential patterns (PrefixSpan)."""
    ps = PrefixSpan(minSupport=min_support, maxPatternLength=max_len, sequenceCol=sequence,
                    maxLocalProjDBSize=max_local_proj_db)
    return ps.findFrequentSequentialPatterns(df)


def session_sequences(df: DataFrame, user: str, ts: str, item: str, gap: str, order: str | None = None) -> DataFrame:
    """(user, session, sequence): a user's items in time order, one item a step, cut where a pause is longer than ``gap``.

    Rows are numbered in (user, time) order over range partitions, so no user's history meets in one task: a row opens a
    session if the row numbered before it is another user's or too far back, and a session is the run up to the next opening.
    Which rows open one is found by a join of neighbours; a running count of openings per range of
    ``_RANGE`` rows gives every row its session. Only one session's items meet in a row."""
    keys = [user, ts, *([order] if order else [])]
    rows = cut_lineage(with_row_id(df.select(*dict.fromkeys([user, ts, item, *keys])).where(F.col(user).isNotNull() & F.col(ts).isNotNull()), keys, out="_n"))
    before = rows.select((F.col("_n") + 1).alias("_n"), F.col(user).alias("_u"), F.col(ts).alias("_t"))
    pause = F.expr(f"interval {gap}")
    met = rows.join(before, "_n", "left").withColumn("_opens", F.col("_u").isNull() | (F.col("_u") != F.col(user)) | (F.col(ts) > F.col("_t") + pause))
    part = F.floor(F.col("_n") / _RANGE)
    met = cut_lineage(met.select(F.col(user), F.col(item).alias("_i"), "_n", "_opens", part.alias("_p")))
    # openings before a range: prefix sums of one number per range, as in with_row_id
    counts = sorted(tuple(r) for r in met.groupBy("_p").agg(F.count_if("_opens")).collect())
    offsets, total = [], 0
    for number, opened in counts:
        offsets.append((number, total))
        total += opened
    ranges = df.sparkSession.createDataFrame(offsets, "_p long, _before long")
    w = Window.partitionBy("_p").orderBy("_n").rowsBetween(Window.unboundedPreceding, 0)
    inside = met.join(F.broadcast(ranges), "_p").withColumn("session", F.col("_before") + F.count_if("_opens").over(w))
    steps = F.array_sort(F.collect_list(F.struct("_n", "_i")))
    return inside.groupBy("session").agg(F.first(user).alias(user), F.transform(steps, lambda s: F.array(s["_i"])).alias("sequence"))


#: Rows of the sessions' running count that one task walks over.
_RANGE = 100_000


# --------------------------------------------------------------------------- B6
def mine_cluster(df: DataFrame, cluster: int, min_support: float, items: str = "items",
                 cluster_col: str = "cluster", num_partitions: int | None = None) -> DataFrame:
    """Item sets among the rows of one cluster."""
    return frequent_itemsets(df.where(F.col(cluster_col) == cluster), min_support, items, num_partitions)
