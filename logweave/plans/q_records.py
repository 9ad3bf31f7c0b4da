"""Delimited-record parsing queries: text records rendered from the tables by Spark,
parsed back by the operators (P1-P6, P14, P15), plus one-hot encoding (V7, P20)
and hashed term frequencies (V1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import wallclock as W
from ..operators import features as V
from ..operators import parsing as P
from ..session import read_table
from ..sources.io import read_documents
from .registry import query


def _num_txt(col: str) -> F.Column:
    return F.array_join(F.transform(col, lambda x: x.cast("string")), " ")


# --------------------------------------------------------------------------- P1
@query("parse_labeled", ops=("P1",), sql="""
WITH lines AS (
  SELECT l_linenumber || ',' || CAST(l_quantity AS BIGINT) || ' ' || CAST(round(l_discount * 100) AS BIGINT)
         || ' ' || CAST(round(l_tax * 100) AS BIGINT) AS line FROM lineitem)
SELECT TRY_CAST(split_part(line, ',', 1) AS DOUBLE) AS label,
       array_to_string(list_transform(string_split(trim(split_part(line, ',', 2)), ' '),
                       lambda x: CAST(TRY_CAST(x AS DOUBLE) AS VARCHAR)), ' ') AS features
FROM lines
""")
def q_parse_labeled(spark: SparkSession, sf: str) -> DataFrame:
    li = read_table(spark, sf, "lineitem")
    lines = li.select(F.format_string("%d,%d %d %d", "l_linenumber", F.col("l_quantity").cast("bigint"),
                                      F.round(F.col("l_discount") * 100).cast("bigint"),
                                      F.round(F.col("l_tax") * 100).cast("bigint")).alias("line"))
    p = P.parse_labeled(lines)
    return p.select("label", _num_txt("features").alias("features"))


# --------------------------------------------------------------------------- P2
@query("parse_dense", ops=("P2",), sql="""
WITH lines AS (
  SELECT ' ' || CAST(l_quantity AS BIGINT) || ' ' || l_linenumber || ' ' || CAST(l_partkey % 100 AS BIGINT) || ' ' AS line
  FROM lineitem)
SELECT array_to_string(list_transform(string_split(trim(line), ' '), lambda x: CAST(TRY_CAST(x AS DOUBLE) AS VARCHAR)), ' ')
       AS features
FROM lines
""")
def q_parse_dense(spark: SparkSession, sf: str) -> DataFrame:
    li = read_table(spark, sf, "lineitem")
    lines = li.select(F.format_string(" %d %d %d ", F.col("l_quantity").cast("bigint"), "l_linenumber",
                                      F.col("l_partkey") % 100).alias("line"))
    return P.parse_dense(lines).select(_num_txt("features").alias("features"))


# --------------------------------------------------------------------------- P3
@query("parse_edges", ops=("P3",), sql="""
WITH e AS (SELECT l_suppkey * 2 AS s, l_partkey * 2 + 1 AS d, CAST(sum(l_quantity) AS BIGINT) AS w
           FROM lineitem GROUP BY 1, 2),
lines AS (SELECT s || ' ' || d || ' ' || w AS line FROM e)
SELECT TRY_CAST(split_part(line, ' ', 1) AS BIGINT) AS src, TRY_CAST(split_part(line, ' ', 2) AS BIGINT) AS dst,
       TRY_CAST(split_part(line, ' ', 3) AS DOUBLE) AS weight
FROM lines
""")
def q_parse_edges(spark: SparkSession, sf: str) -> DataFrame:
    li = read_table(spark, sf, "lineitem")
    e = li.groupBy((F.col("l_suppkey") * 2).alias("s"), (F.col("l_partkey") * 2 + 1).alias("d")).agg(
        F.sum("l_quantity").cast("bigint").alias("w"))
    return P.parse_edges(e.select(F.format_string("%d %d %d", "s", "d", "w").alias("line")))


# --------------------------------------------------------------------------- P4
@query("parse_category_text", ops=("P4", "S3"), sql="""
WITH lines AS (SELECT doc_id, source || ',' || text AS line FROM documents)
SELECT doc_id, split_part(line, ',', 1) AS category, split_part(line, ',', 2) AS text FROM lines
""")
def q_parse_category_text(spark: SparkSession, sf: str) -> DataFrame:
    d = read_documents(spark, f"{sf}/documents.parquet", "parquet", "doc_id bigint, source string, text string")
    lines = d.select("doc_id", F.concat_ws(",", "source", "text").alias("line"))
    return P.parse_category_text(lines, keep=["doc_id"])


# --------------------------------------------------------------------------- P6
@query("parse_observations", ops=("P6",), sql="""
WITH lines AS (
  SELECT strftime(o_orderdate, '%Y') || chr(9) || CAST(month(o_orderdate) AS VARCHAR) || chr(9)
         || CAST(day(o_orderdate) AS VARCHAR) || chr(9) || o_orderstatus || chr(9) || o_orderpriority || chr(9)
         || CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR) AS line FROM orders)
SELECT strftime(make_timestamp(TRY_CAST(split_part(line, chr(9), 1) AS BIGINT), TRY_CAST(split_part(line, chr(9), 2) AS BIGINT),
                               TRY_CAST(split_part(line, chr(9), 3) AS BIGINT), 0, 0, 0), '%Y-%m-%d %H:%M:%S') AS ts,
       split_part(line, chr(9), 4) AS key, TRY_CAST(split_part(line, chr(9), 6) AS DOUBLE) AS value
FROM lines
""")
def q_parse_observations(spark: SparkSession, sf: str) -> DataFrame:
    o = read_table(spark, sf, "orders")
    lines = o.select(F.concat_ws("\t", F.year("o_orderdate").cast("string"), F.month("o_orderdate").cast("string"),
                                 F.dayofmonth("o_orderdate").cast("string"), "o_orderstatus", "o_orderpriority",
                                 F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string")).alias("line"))
    p = P.parse_observations_tsv(lines)
    return p.select(W.wall_datetime("ts").alias("ts"), "key", "value")


# --------------------------------------------------------------------------- P14/P15
def basket_lines(spark: SparkSession, sf: str) -> DataFrame:
    """CSV lines with 18 leading fields and three ``name_value`` items (fields 18-20)."""
    li = read_table(spark, sf, "lineitem")
    tax = F.when(F.col("l_tax") > 0.05, F.lit("hi")).otherwise(F.round(F.col("l_tax") * 100).cast("bigint").cast("string"))
    items = [F.concat(F.lit("ln_"), F.col("l_linenumber").cast("string")),
             F.concat(F.lit("sk_"), (F.col("l_suppkey") % 10).cast("string")),
             F.concat(F.lit("tx_"), tax)]
    filler = [F.col("l_orderkey").cast("string")] + [F.lit(f"f{i}") for i in range(1, 18)]
    return li.select(F.concat_ws(",", *filler, *items).alias("line"))


_SQL_BASKET_LINES = """lines AS (
  SELECT concat_ws(',', CAST(l_orderkey AS VARCHAR), 'f1', 'f2', 'f3', 'f4', 'f5', 'f6', 'f7', 'f8', 'f9', 'f10', 'f11',
                   'f12', 'f13', 'f14', 'f15', 'f16', 'f17', 'ln_' || l_linenumber, 'sk_' || (l_suppkey % 10),
                   'tx_' || CASE WHEN l_tax > 0.05 THEN 'hi' ELSE CAST(CAST(round(l_tax * 100) AS BIGINT) AS VARCHAR) END) AS line
  FROM lineitem)"""


@query("basket_valid", ops=("P14", "P15"), sql="WITH " + _SQL_BASKET_LINES + """,
b AS (SELECT [split_part(line, ',', 19), split_part(line, ',', 20), split_part(line, ',', 21)] AS items FROM lines),
v AS (SELECT items, list_transform(items, lambda x: split_part(x, '_', 2)) AS vals FROM b)
SELECT CASE WHEN list_bool_and(list_transform(vals, lambda y: regexp_matches(y, '^[0-9]')))
             AND len(list_distinct(vals)) = len(vals)
            THEN array_to_string(items, '|') ELSE '' END AS items
FROM v
""")
def q_basket_valid(spark: SparkSession, sf: str) -> DataFrame:
    b = P.validate_basket(P.basket_from_fields(basket_lines(spark, sf)))
    return b.select(F.array_join("items", "|").alias("items"))


# --------------------------------------------------------------------------- V7 + P20
@query("encode_one_hot", ops=("V7", "P20", "A8"), sql="""
WITH pairs AS (
  SELECT DISTINCT position, value FROM (
    SELECT 0 AS position, l_returnflag AS value FROM lineitem
    UNION ALL SELECT 1, l_linestatus FROM lineitem
    UNION ALL SELECT 2, CAST(l_linenumber AS VARCHAR) FROM lineitem) WHERE value IS NOT NULL),
loc AS (SELECT position, value, row_number() OVER (PARTITION BY position ORDER BY value) - 1 AS li FROM pairs),
sz AS (SELECT position, count(*) + 1 AS width FROM pairs GROUP BY 1),
off AS (SELECT position, coalesce(sum(width) OVER (ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o
        FROM sz)
SELECT l.l_orderkey, l.l_linenumber,
       CAST(o0.o + d0.li AS VARCHAR) || ',' || CAST(o1.o + d1.li AS VARCHAR) || ',' || CAST(o2.o + d2.li AS VARCHAR) AS hot
FROM lineitem l
JOIN loc d0 ON d0.position = 0 AND d0.value = l.l_returnflag JOIN off o0 ON o0.position = 0
JOIN loc d1 ON d1.position = 1 AND d1.value = l.l_linestatus JOIN off o1 ON o1.position = 1
JOIN loc d2 ON d2.position = 2 AND d2.value = CAST(l.l_linenumber AS VARCHAR) JOIN off o2 ON o2.position = 2
""")
def q_encode_one_hot(spark: SparkSession, sf: str) -> DataFrame:
    li = read_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.array("l_returnflag", "l_linestatus", F.col("l_linenumber").cast("string")).alias("cats"))
    d = V.category_dictionary(li, "cats")
    oh = V.encode_one_hot(li, d, "cats", "vec")
    dense = P.densify(oh, "vec", "arr")
    hot = F.filter(F.transform("arr", lambda x, i: F.when(x > 0, i)), lambda i: i.isNotNull())
    return dense.select("l_orderkey", "l_linenumber",
                        F.array_join(F.transform(hot, lambda i: i.cast("string")), ",").alias("hot"))


# --------------------------------------------------------------------------- V1
@query("hashed_tf", ops=("V1",), sql=f"""
WITH tok AS (SELECT doc_id, unnest(string_split_regex(lower(text), '\\s+')) AS term FROM documents)
SELECT doc_id, ('0x' || substr(md5(term), 1, 15))::BIGINT % {V.HASH_WIDTH} AS slot, count(*) AS tf
FROM tok WHERE term <> '' GROUP BY 1, 2
""")
def q_hashed_tf(spark: SparkSession, sf: str) -> DataFrame:
    """Hashed TF in long form: the slots are part of the result."""
    return V.hashed_term_freq(read_table(spark, sf, "documents").select("doc_id", "text"))


_SQL_TOKENS = """
tok AS (SELECT doc_id, CASE WHEN regexp_full_match(text, '\\s+') THEN []
                            ELSE string_split_regex(regexp_replace(lower(text), '\\s+$', ''), '\\s') END AS words FROM documents)"""


@query("token_positions", ops=("P18", "P19"), sql="WITH" + _SQL_TOKENS + """
SELECT doc_id, CAST(generate_subscripts(words, 1) - 1 AS INTEGER) AS pos, unnest(words) AS value FROM tok
""")
def q_token_positions(spark: SparkSession, sf: str) -> DataFrame:
    d = P.tokenize(read_table(spark, sf, "documents").select("doc_id", "text"))
    return P.with_positions(d, "words").select("doc_id", F.inline("words"))


@query("hashing_tf", ops=("V1", "P18"), sql="WITH" + _SQL_TOKENS + """
SELECT doc_id, CAST(len(words) AS DOUBLE) AS n_tokens FROM tok
""")
def q_hashing_tf(spark: SparkSession, sf: str) -> DataFrame:
    """The estimator's hashed vectors; a document's slots add up to its words (the slots
    themselves are compared with the estimator's index in the tests)."""
    d = V.hashing_tf(P.tokenize(read_table(spark, sf, "documents").select("doc_id", "text")))
    values = F.from_json(F.get_json_object(F.to_json(F.struct("tf")), "$.tf.values"), "array<double>")
    return d.select("doc_id", F.aggregate(values, F.lit(0.0), lambda a, x: a + x).alias("n_tokens"))


# --------------------------------------------------------------------------- B1 + B2 + O1 on validated baskets
BASKET_SUPPORT = 0.01
BASKET_CONFIDENCE = 0.1


def basket_rules_job(spark: SparkSession, sf: str) -> DataFrame:
    """The rule-mining job end to end: CSV fields 18-20 -> basket validation (invalid
    baskets become empty but still count in N) -> FP-growth -> one-item-consequent
    rules with confidence >= 0.1, ranked by confidence."""
    from ..operators.mining import association_rules, rank_rules
    baskets = P.validate_basket(P.basket_from_fields(basket_lines(spark, sf)))
    rules = association_rules(baskets, BASKET_SUPPORT, BASKET_CONFIDENCE)
    return rank_rules(rules)


def _sql_basket_rules() -> str:
    from .q_mining import sql_sets_from_baskets
    return "WITH " + _SQL_BASKET_LINES + """,
t AS (SELECT row_number() OVER () AS k,
             [split_part(line, ',', 19), split_part(line, ',', 20), split_part(line, ',', 21)] AS items FROM lines),
v AS (SELECT k, items, list_transform(items, lambda x: split_part(x, '_', 2)) AS vals FROM t),
ok AS (SELECT k, items FROM v WHERE list_bool_and(list_transform(vals, lambda y: regexp_matches(y, '^[0-9]')))
                                AND len(list_distinct(vals)) = len(vals)),
b AS (SELECT DISTINCT k, unnest(items) AS i FROM ok),
nb AS (SELECT count(*) AS n FROM t),""" + sql_sets_from_baskets(BASKET_SUPPORT, 3) + f""",
el AS (SELECT items, size, freq, unnest(string_split(items, '|')) AS c FROM sets WHERE size >= 2),
r AS (SELECT array_to_string(list_filter(string_split(el.items, '|'), lambda x: x <> el.c), '|') AS antecedent,
             el.c AS consequent, el.freq AS f FROM el)
SELECT r.antecedent, r.consequent, round(r.f / s.freq, 9) AS confidence
FROM r JOIN sets s ON s.items = r.antecedent
WHERE r.f / s.freq >= {BASKET_CONFIDENCE}
"""


@query("basket_rules", ops=("B1", "B2", "O1", "P14", "P15"), sql=_sql_basket_rules())
def q_basket_rules(spark: SparkSession, sf: str) -> DataFrame:
    r = basket_rules_job(spark, sf)
    return r.select(F.array_join(F.array_sort("antecedent"), "|").alias("antecedent"),
                    F.array_join(F.array_sort("consequent"), "|").alias("consequent"),
                    F.round("confidence", 9).alias("confidence"))
