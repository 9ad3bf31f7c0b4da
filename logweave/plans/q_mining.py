"""Pattern-mining queries: brand/type baskets per order, event sequences per user-day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import mining as M
from ..operators.relational import top_k
from ..session import read_table
from .registry import query

BRAND_SUPPORT = 0.02
RULE_CONFIDENCE = 0.1
TYPE_SUPPORT = 0.05
TYPE_RULE_CONFIDENCE = 0.3
SEQ_SUPPORT = 0.05
SEQ_MAX_LEN = 5
# None: FP-growth splits the conditional databases over as many partitions as the input
# has (the original fixed 10, which would cap a large job at 10 tasks)
MINING_PARTITIONS = None


def baskets(spark: SparkSession, sf: str, attr: str = "p_brand") -> DataFrame:
    """One basket per order: the distinct part attributes of its lines.

    The per-order set is bounded by the number of distinct attribute values, so a
    very large order still yields a small basket (collect_set is combined map-side).
    """
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    p = read_table(spark, sf, "part").select("p_partkey", attr)
    return (li.join(p, li.l_partkey == p.p_partkey)
            .groupBy("l_orderkey").agg(F.collect_set(attr).alias("items")))


def _items_txt(col: str) -> F.Column:
    return F.array_join(F.array_sort(col), "|")


def _sql_baskets(attr: str) -> str:
    return f"""
b AS (SELECT l_orderkey AS k, {attr} AS i FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
nb AS (SELECT count(DISTINCT k) AS n FROM b)"""


def sql_sets_from_baskets(support: float, max_size: int) -> str:
    """CTE ``sets(items, size, freq)``: item sets of size 1..max_size by self-joins on
    CTEs ``b(k, i)`` (distinct basket/item pairs) and ``nb(n)`` (number of baskets)."""
    parts = []
    for size in range(1, max_size + 1):
        al = [f"b{j}" for j in range(size)]
        frm = " JOIN ".join(f"b {a}" if j == 0 else f"b {a} ON {a}.k = b0.k AND {al[j - 1]}.i < {a}.i"
                            for j, a in enumerate(al))
        items = " || '|' || ".join(f"{a}.i" for a in al)
        parts.append(f"SELECT {items} AS items, {size} AS size, count(*) AS freq FROM {frm} GROUP BY ALL")
    union = "\nUNION ALL ".join(parts)
    return f"""
sets AS (SELECT items, size, freq FROM ({union}) WHERE freq >= (SELECT ceil({support} * n) FROM nb))"""


def _sql_itemsets(attr: str, support: float, max_size: int) -> str:
    """Item sets of part attributes per order, size 1..max_size."""
    return _sql_baskets(attr) + "," + sql_sets_from_baskets(support, max_size)


@query("frequent_itemsets", ops=("B1",), sql="WITH " + _sql_itemsets("p_brand", BRAND_SUPPORT, 3) + """
SELECT items, freq FROM sets
""")
def q_frequent_itemsets(spark: SparkSession, sf: str) -> DataFrame:
    fi = M.frequent_itemsets(baskets(spark, sf), BRAND_SUPPORT, num_partitions=MINING_PARTITIONS)
    return fi.select(_items_txt("items").alias("items"), "freq")


def _sql_rules(support_sql_sets: str, conf: float, max_size: int) -> str:
    # every set of size >= 2 gives one rule per consequent item; antecedent = rest
    return support_sql_sets + f""",
el AS (SELECT items, size, freq, unnest(string_split(items, '|')) AS c FROM sets WHERE size >= 2),
r AS (SELECT array_to_string(list_filter(string_split(el.items, '|'), lambda x: x <> el.c), '|') AS antecedent,
             el.c AS consequent, el.freq AS f FROM el)
SELECT r.antecedent, r.consequent, round(r.f / s.freq, 9) AS confidence
FROM r JOIN sets s ON s.items = r.antecedent
WHERE r.f / s.freq >= {conf}"""


@query("association_rules", ops=("B2",), sql="WITH " + _sql_rules(
    _sql_itemsets("p_brand", BRAND_SUPPORT, 3), RULE_CONFIDENCE, 3))
def q_association_rules(spark: SparkSession, sf: str) -> DataFrame:
    r = M.association_rules(baskets(spark, sf), BRAND_SUPPORT, RULE_CONFIDENCE,
                            num_partitions=MINING_PARTITIONS)
    return r.select(_items_txt("antecedent").alias("antecedent"), _items_txt("consequent").alias("consequent"),
                    F.round("confidence", 9).alias("confidence"))


@query("rules_from_itemsets", ops=("B3",), sql="WITH " + _sql_rules(
    _sql_itemsets("p_type", TYPE_SUPPORT, 4), TYPE_RULE_CONFIDENCE, 4))
def q_rules_from_itemsets(spark: SparkSession, sf: str) -> DataFrame:
    sets = M.frequent_itemsets(baskets(spark, sf, "p_type"), TYPE_SUPPORT, num_partitions=MINING_PARTITIONS)
    r = M.rules_from_itemsets(sets, TYPE_RULE_CONFIDENCE)
    return r.select(_items_txt("antecedent").alias("antecedent"), _items_txt("consequent").alias("consequent"),
                    F.round("confidence", 9).alias("confidence"))


_SQL_RANKED = "WITH " + _sql_rules(_sql_itemsets("p_brand", BRAND_SUPPORT, 3), RULE_CONFIDENCE, 3).replace(
    "SELECT r.antecedent, r.consequent, round(r.f / s.freq, 9) AS confidence",
    ", ranked AS (SELECT r.antecedent, r.consequent, round(r.f / s.freq, 9) AS confidence, row_number() OVER (ORDER BY r.f / s.freq "
    "DESC, replace(r.antecedent, '|', chr(1)), replace(r.consequent, '|', chr(1))) AS rank") + ")"


def _ranked(spark: SparkSession, sf: str) -> DataFrame:
    r = M.association_rules(baskets(spark, sf), BRAND_SUPPORT, RULE_CONFIDENCE, num_partitions=MINING_PARTITIONS)
    r = M.rank_rules(r)
    return r.select(_items_txt("antecedent").alias("antecedent"), _items_txt("consequent").alias("consequent"),
                    F.round("confidence", 9).alias("confidence"), "rank")


@query("rank_rules", ops=("O1",), sql=_SQL_RANKED + """
SELECT * FROM ranked
""")
def q_rank_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Every rule with its rank by confidence."""
    return _ranked(spark, sf)


@query("top_rules", ops=("O1", "O3"), sql=_SQL_RANKED + """
SELECT * FROM ranked WHERE rank <= 20
""")
def q_top_rules(spark: SparkSession, sf: str) -> DataFrame:
    """The first 20 rules (the size of the report)."""
    return top_k(_ranked(spark, sf), 20, ["rank"])


def event_sequences(spark: SparkSession, sf: str) -> DataFrame:
    """Per user and day, the event types in (ts, event_id) order, one item per step.

    Built with ``collect_list`` of (ts, id, type) structs then sorted: one shuffle
    by (user, day); a sequence holds one user's events of a single day.
    """
    ev = read_table(spark, sf, "events")
    g = ev.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.array_sort(F.collect_list(F.struct("ts", "event_id", "event_type"))).alias("_s"))
    return g.select(F.transform("_s", lambda x: F.array(x["event_type"])).alias("sequence"))


@query("frequent_sequences", ops=("B4",), sql=f"""
WITH s AS (SELECT user_id, CAST(ts AS DATE) AS d, event_type AS i,
                  row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS p
           FROM events),
n AS (SELECT count(*) AS n FROM (SELECT DISTINCT user_id, d FROM s)),
p1 AS (SELECT i AS pat, count(DISTINCT (user_id, d)) AS freq FROM s GROUP BY 1),
p2 AS (SELECT a.i || '|' || b.i AS pat, count(DISTINCT (a.user_id, a.d)) AS freq
       FROM s a JOIN s b ON a.user_id = b.user_id AND a.d = b.d AND a.p < b.p GROUP BY 1),
p3 AS (SELECT a.i || '|' || b.i || '|' || c.i AS pat, count(DISTINCT (a.user_id, a.d)) AS freq
       FROM s a JOIN s b ON a.user_id = b.user_id AND a.d = b.d AND a.p < b.p
                JOIN s c ON c.user_id = a.user_id AND c.d = a.d AND b.p < c.p GROUP BY 1)
SELECT pat AS sequence, freq FROM (SELECT * FROM p1 UNION ALL SELECT * FROM p2 UNION ALL SELECT * FROM p3)
WHERE freq >= (SELECT ceil({SEQ_SUPPORT} * n) FROM n)
""")
def q_frequent_sequences(spark: SparkSession, sf: str) -> DataFrame:
    fs = M.frequent_sequences(event_sequences(spark, sf), SEQ_SUPPORT, SEQ_MAX_LEN)
    return fs.select(F.array_join(F.transform("sequence", lambda s: F.array_join(F.array_sort(s), ",")), "|")
                     .alias("sequence"), "freq")


SESSION_GAP_MINUTES = 600
SESSION_SUPPORT = 0.02


@query("session_sequences", ops=("B4",), sql=f"""
WITH o AS (SELECT user_id, ts, event_id, event_type AS i, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL {SESSION_GAP_MINUTES} MINUTE
                       THEN 0 ELSE 1 END AS opens FROM events),
s AS (SELECT user_id, i, sum(opens) OVER w AS d, row_number() OVER w AS p FROM o WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)),
n AS (SELECT count(*) AS n FROM (SELECT DISTINCT user_id, d FROM s)),
p1 AS (SELECT i AS pat, count(DISTINCT (user_id, d)) AS freq FROM s GROUP BY 1),
p2 AS (SELECT a.i || '|' || b.i AS pat, count(DISTINCT (a.user_id, a.d)) AS freq
       FROM s a JOIN s b ON a.user_id = b.user_id AND a.d = b.d AND a.p < b.p GROUP BY 1),
p3 AS (SELECT a.i || '|' || b.i || '|' || c.i AS pat, count(DISTINCT (a.user_id, a.d)) AS freq
       FROM s a JOIN s b ON a.user_id = b.user_id AND a.d = b.d AND a.p < b.p
                JOIN s c ON c.user_id = a.user_id AND c.d = a.d AND b.p < c.p GROUP BY 1)
SELECT pat AS sequence, freq FROM (SELECT * FROM p1 UNION ALL SELECT * FROM p2 UNION ALL SELECT * FROM p3)
WHERE freq >= (SELECT ceil({SESSION_SUPPORT} * n) FROM n)
""")
def q_session_sequences(spark: SparkSession, sf: str) -> DataFrame:
    """Frequent sequences of event types in a user's sessions, which a pause ends."""
    ev = read_table(spark, sf, "events")
    sequences = M.session_sequences(ev, "user_id", "ts", "event_type", f"{SESSION_GAP_MINUTES} minutes", order="event_id")
    fs = M.frequent_sequences(sequences, SESSION_SUPPORT, 3)
    return fs.select(F.array_join(F.transform("sequence", lambda s: F.array_join(F.array_sort(s), ",")), "|")
                     .alias("sequence"), "freq")
