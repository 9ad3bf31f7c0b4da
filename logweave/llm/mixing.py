"""Mixing sources to target weights (operator 6), in DataFrame operations only.

Every document gets a hash-random key (md5 of seed and id). Within a source the
documents are ordered by that key, word counts are summed along the order, and the
order is cut where the sum reaches the source's budget; a budget above the source's
size takes whole epochs first. The prefix sums are distributed: the key range is dealt
into equal buckets, bucket totals are summed along each source, and only the one
bucket that holds a source's cut is sorted row by row. So a source with a third of
all rows is spread over all its buckets, texts are never shuffled, and what travels
is one (source, bucket, total) row per bucket and task.

The outcome is a small table of cuts, one row per source; whether a document is
taken follows from its own key and its source's cut.

Defined cases: null text has size 0; null source is a source of its own, ranked last;
null ids share one key. Rows with the same key (repeated ids) at the cut share the
remaining words in proportion to their sizes, rounded down. A source without words has
target 0. An empty table gives an empty result. Other columns are left alone.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.indexing import with_row_id
from ..session import cut_lineage
from .common import GAP, WORD, table

WEIGHTS = (5, 2, 1)
KEY_BITS = 60  # 15 hex digits of the md5


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def random_key(doc_id: Column, seed: int) -> Column:
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), doc_id.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = 3.0) -> DataFrame:
    """Add ``target`` to (source, source_size, ...): weights by rank, no target above cap x size.

    Sources are ranked by code point, null last, and the weights repeat along the ranks.
    Capping and resharing converge to ``least(cap * size, level * weight)``; the level is
    found by repeating one small aggregate (three numbers) until no more source is capped.
    """
    ranked = with_row_id(sources, [F.col("source").asc_nulls_last()], out="_rank")
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    ranked = cut_lineage(ranked.withColumn("_weight", pick).withColumn("_cap", cap * F.col("source_size")).drop("_rank"))
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        over = F.col("_cap") <= level * F.col("_weight")
        n, held, open_weight = ranked.agg(F.count_if(over), F.sum(F.when(over, F.col("_cap"))),
                                          F.sum(F.when(~over, F.col("_weight")))).first()
        if n == capped or not open_weight:
            break
        capped, level = n, (total - (held or 0.0)) / open_weight
    target = F.least(F.col("_cap"), F.lit(level) * F.col("_weight"))
    return ranked.withColumn("target", target).drop("_weight", "_cap")


#: Sources whose cuts are sent to every task (about 10 MB); more meet the rows in a shuffle join.
BROADCAST_SOURCES = 100_000


def plan_mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = 3.0, seed: int = 42,
             rows_per_bucket: int = 50_000) -> tuple[DataFrame, DataFrame]:
    """(sized, cuts): (doc_id, _source, size, _key) of every row, and per source
    (_source, source_size, target, _epochs, _cut_key, _cut_words, _cut_size).

    A row is taken ``_epochs`` times, once more if its key is below ``_cut_key``; rows at
    the cut key share ``_cut_words`` of their ``_cut_size`` words.
    """
    sized = cut_lineage(docs.select("doc_id", F.col("source").alias("_source"), word_count(F.col("text")).alias("size"),
                                    random_key(F.col("doc_id"), seed).alias("_key")))
    n_rows = sized.count()
    bits = min(KEY_BITS - 1, max(0, math.ceil(math.log2(max(1, n_rows / rows_per_bucket)))))
    bucket = F.shiftright("_key", KEY_BITS - bits)
    buckets = cut_lineage(sized.groupBy("_source", bucket.alias("_bucket")).agg(F.sum("size").alias("_words")))
    sources = buckets.groupBy(F.col("_source").alias("source")).agg(F.sum("_words").alias("source_size"))
    goal = targets(sources, weights, cap)
    size = F.col("source_size")
    goal = goal.withColumn("_budget", F.floor("target")).withColumn(
        "_epochs", F.when(size > 0, F.floor(F.col("_budget") / size)).otherwise(F.lit(0)).cast("bigint")).withColumn(
        "_rest", F.col("_budget") - F.col("_epochs") * size)
    # the bucket in which the running sum passes the rest of the budget
    along = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = buckets.withColumn("_upto", F.sum("_words").over(along))
    at = summed.join(goal, summed["_source"].eqNullSafe(goal["source"])).where(
        (F.col("_upto") > F.col("_rest")) & (F.col("_upto") - F.col("_words") <= F.col("_rest"))).select(
        summed["_source"].alias("_at"), "_bucket", (F.col("_rest") - F.col("_upto") + F.col("_words")).alias("_left"))
    # inside that bucket, one row per key
    inside = sized.withColumn("_bucket", bucket).alias("d").join(
        at.alias("a"), F.col("d._source").eqNullSafe(F.col("a._at")) & (F.col("d._bucket") == F.col("a._bucket")))
    keys = inside.groupBy("_at", "_left", "_key").agg(F.sum("size").alias("_cut_size"))
    order = Window.partitionBy("_at").orderBy("_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    keys = keys.withColumn("_end", F.sum("_cut_size").over(order))
    cut = keys.where((F.col("_end") > F.col("_left")) & (F.col("_end") - F.col("_cut_size") <= F.col("_left"))).select(
        "_at", F.col("_key").alias("_cut_key"), "_cut_size",
        (F.col("_left") - F.col("_end") + F.col("_cut_size")).alias("_cut_words"))
    cuts = goal.join(cut, goal["source"].eqNullSafe(cut["_at"]), "left").select(
        F.col("source").alias("_source"), "source_size", "target", "_epochs", "_cut_key", "_cut_words", "_cut_size")
    return sized, cut_lineage(cuts)


def partial_words(size: Column, key: Column) -> Column:
    """Words that the last, unfinished epoch takes of a row; needs the row's cut columns."""
    share = F.floor(F.col("_cut_words") * size / F.col("_cut_size"))
    return F.coalesce(F.when(key < F.col("_cut_key"), size).when(key == F.col("_cut_key"), share),
                      F.lit(0)).cast("bigint")


def mix(docs: DataFrame, **how) -> DataFrame:
    """(doc_id, size, source_size, target, taken, source) for every row of ``docs``."""
    sized, cuts = plan_mix(docs, **how)
    joined = sized.alias("d").join(cuts.alias("c"), F.col("d._source").eqNullSafe(F.col("c._source")))
    taken = F.col("_epochs") * F.col("size") + partial_words(F.col("size"), F.col("_key"))
    return joined.select("doc_id", "size", "source_size", "target", taken.alias("taken"),
                         F.col("d._source").alias("source"))


def mixed_documents(docs: DataFrame, seed: int = 42, **how) -> DataFrame:
    """The mixture itself, with the columns of ``docs``: every row as often as it is taken.

    The row that holds a source's cut adds its leading words up to the budget, where the
    text ends after its last taken word; ``n_chars`` follows the text where there is such a column.
    Rows are repeated by a generator, so nothing but the table of cuts is joined.
    """
    _, cuts = plan_mix(docs, seed=seed, **how)
    row = docs.select(F.struct("*").alias("_row"))
    row = row.select("_row", F.col("_row.source").alias("_doc_source"), random_key(F.col("_row.doc_id"), seed).alias("_key"))
    if cuts.count() <= BROADCAST_SOURCES:
        cuts = F.broadcast(cuts)  # texts then stay where they are
    joined = row.join(cuts, F.col("_doc_source").eqNullSafe(F.col("_source")))
    text = F.coalesce(F.col("_row.text"), F.lit(""))
    size = word_count(text)
    joined = joined.withColumn("_size", F.when(F.col("_key") == F.col("_cut_key"), size))
    # below the cut: one copy more; at the cut: the share of the words
    part = F.when(F.col("_key") == F.col("_cut_key"), partial_words(F.col("_size"), F.col("_key")))
    whole = F.col("_epochs") + F.when(F.col("_key") < F.col("_cut_key"), 1).otherwise(0)
    copies = F.array_repeat(F.lit(None).cast("bigint"), whole.cast("int"))
    copies = F.when(part > 0, F.concat(copies, F.array(part))).otherwise(copies)
    spread = joined.select("_row", F.explode(copies).alias("_part"))
    # the first _part words with the gaps between them, a gap before included
    text = F.col("_row.text")
    pieces = F.slice(F.regexp_extract_all(text, F.lit(f"(?:{GAP})?{WORD}"), F.lit(0)), F.lit(1), F.col("_part").cast("int"))
    cut_text = F.when(F.col("_part").isNotNull(), F.array_join(pieces, "")).otherwise(text)
    spread = spread.withColumn("_row", F.col("_row").withField("text", cut_text))
    if "n_chars" in docs.columns:
        changed = F.when(F.col("_part").isNotNull(), F.length("_row.text").cast("bigint")).otherwise(F.col("_row.n_chars"))
        spread = spread.withColumn("_row", F.col("_row").withField("n_chars", changed.cast(docs.schema["n_chars"].dataType)))
    return spread.select("_row.*")


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


#: The same mixture in DuckDB: capping by closed form over the caps in ascending order.
OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5('42|' || CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT) AS k
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS i FROM s),
w AS (SELECT source, source_size, CASE i WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
             3.0::DOUBLE * source_size AS cap FROM r),
o AS (SELECT *, sum(cap) OVER (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS held,
             sum(weight) OVER (ORDER BY cap / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free,
             sum(source_size) OVER () AS total FROM w),
l AS (SELECT max(level) AS level FROM (
        SELECT (total - coalesce(held, 0)) / free AS level, cap, weight FROM o) WHERE level * weight <= cap),
t AS (SELECT source, source_size, least(cap, level * weight) AS target FROM w, l),
b AS (SELECT *, CAST(floor(target) AS BIGINT) AS budget FROM t),
e AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM b),
p AS (SELECT d.*, e.source_size, e.target, e.epochs, e.budget - e.epochs * e.source_size AS rest,
             sum(size) OVER (PARTITION BY d.source ORDER BY k) AS upto
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, source, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, rest - (upto - size))) AS BIGINT) AS taken
FROM p
"""
