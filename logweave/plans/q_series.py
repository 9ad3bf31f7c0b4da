"""Time-series queries: hourly series per event type, daily series per order status."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import wallclock as W
from ..operators import timeseries as T
from ..operators.indexing import with_row_id
from ..operators.relational import count_series, extremes
from ..session import read_table
from ..operators.parsing import parse_log_observations
from .registry import query
from .renders import SQL_COMPUTE_LINE, compute_lines

SQL_TS_FMT = "'%Y-%m-%d %H:%M:%S'"


def _hourly_events(spark: SparkSession, sf: str) -> tuple[DataFrame, object, object]:
    ev = read_table(spark, sf, "events")
    obs = T.snap(ev.select("ts", F.col("event_type").alias("key"), "value"), "hour")
    lo, hi = T.index_bounds(ev, "ts", "hour")
    return obs, lo, hi


def _daily_orders(spark: SparkSession, sf: str) -> T.SeriesSet:
    o = read_table(spark, sf, "orders")
    obs = o.select(F.col("o_orderdate").alias("ts"), F.col("o_orderstatus").alias("key"),
                   F.col("o_totalprice").alias("value"))
    lo, hi = T.index_bounds(obs, "ts", "day")
    return T.align_series(obs, lo, hi, "1 day")


def _sql_aligned(table: str, key: str, ts: str, value: str, unit: str) -> str:
    return f"""
b AS (SELECT date_trunc('{unit}', min({ts})) AS lo, date_trunc('{unit}', max({ts})) AS hi FROM {table}),
idx AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 {unit})) AS ts FROM b),
keys AS (SELECT DISTINCT {key} AS key FROM {table} WHERE {key} IS NOT NULL),
obs AS (SELECT {key} AS key, date_trunc('{unit}', {ts}) AS ts, CAST(max({value}) AS DOUBLE) AS value
        FROM {table} WHERE {key} IS NOT NULL GROUP BY 1, 2),
aligned AS (SELECT k.key, i.ts, o.value FROM keys k CROSS JOIN idx i
            LEFT JOIN obs o ON o.key = k.key AND o.ts = i.ts)"""


_SQL_FILLED = """
f0 AS (
  SELECT key, ts, value,
    last_value(value IGNORE NULLS) OVER (PARTITION BY key ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS vp,
    last_value(CASE WHEN value IS NOT NULL THEN epoch(ts) END IGNORE NULLS) OVER (PARTITION BY key ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS tp,
    first_value(value IGNORE NULLS) OVER (PARTITION BY key ORDER BY ts ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS vn,
    first_value(CASE WHEN value IS NOT NULL THEN epoch(ts) END IGNORE NULLS) OVER (PARTITION BY key ORDER BY ts ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS tn
  FROM aligned),
filled AS (
  SELECT key, ts, CASE WHEN value IS NOT NULL THEN value
                       ELSE vp + (vn - vp) * (epoch(ts) - tp) / (tn - tp) END AS value
  FROM f0),
rates AS (
  SELECT key, ts, value / lag(value) OVER (PARTITION BY key ORDER BY ts) - 1 AS rate,
         row_number() OVER (PARTITION BY key ORDER BY ts) AS rn
  FROM filled),
dw0 AS (
  SELECT key, rate AS e, rate - lag(rate) OVER (PARTITION BY key ORDER BY ts) AS d
  FROM rates WHERE rn > 1),
dw AS (
  SELECT key, CASE WHEN sum(e * e) <> 0 THEN sum(d * d) / sum(e * e) END AS dw FROM dw0 GROUP BY key)"""

_SQL_ORDERS = "WITH " + _sql_aligned("orders", "o_orderstatus", "o_orderdate", "o_totalprice", "day")


@query("ts_index", ops=("T1",), sql=f"""
WITH b AS (SELECT date_trunc('hour', min(ts)) AS lo, date_trunc('hour', max(ts)) AS hi FROM events)
SELECT strftime(unnest(generate_series(lo, hi, INTERVAL 1 HOUR)), {SQL_TS_FMT}) AS ts FROM b
""")
def q_ts_index(spark: SparkSession, sf: str) -> DataFrame:
    _, lo, hi = _hourly_events(spark, sf)
    return T.datetime_index(spark, lo, hi, "1 hour").select(W.wall_datetime("ts").alias("ts"))


@query("ts_align", ops=("T2",), sql="WITH " + _sql_aligned("events", "event_type", "ts", "value", "hour") + f"""
SELECT key, strftime(ts, {SQL_TS_FMT}) AS ts, value FROM aligned
""")
def q_ts_align(spark: SparkSession, sf: str) -> DataFrame:
    obs, lo, hi = _hourly_events(spark, sf)
    a = T.align(obs, lo, hi, "1 hour")
    return a.select("key", W.wall_datetime("ts").alias("ts"), "value")


@query("ts_fill_linear", ops=("T2", "T3"), sql=_SQL_ORDERS + "," + _SQL_FILLED + f"""
SELECT key, strftime(ts, {SQL_TS_FMT}) AS ts, round(value, 6) AS value FROM filled
""")
def q_ts_fill_linear(spark: SparkSession, sf: str) -> DataFrame:
    f = _daily_orders(spark, sf).fill()
    return f.select("key", W.wall_datetime("ts").alias("ts"), F.round("value", 6).alias("value"))


@query("ts_returns", ops=("T4",), sql=_SQL_ORDERS + "," + _SQL_FILLED + f"""
SELECT key, strftime(ts, {SQL_TS_FMT}) AS ts, round(rate, 6) AS rate FROM rates WHERE rn > 1
""")
def q_ts_returns(spark: SparkSession, sf: str) -> DataFrame:
    r = _daily_orders(spark, sf).return_rates()
    return r.select("key", W.wall_datetime("ts").alias("ts"), F.round("rate", 6).alias("rate"))


@query("ts_durbin_watson", ops=("T5",), sql=_SQL_ORDERS + "," + _SQL_FILLED + """
SELECT key, round(dw, 6) AS dw FROM dw
""")
def q_ts_durbin_watson(spark: SparkSession, sf: str) -> DataFrame:
    d = _daily_orders(spark, sf).durbin_watson()
    return d.select("key", F.round("dw", 6).alias("dw"))


@query("ts_extremes", ops=("T6", "A5"), sql=_SQL_ORDERS + "," + _SQL_FILLED + """
SELECT arg_min(key, (dw, key)) AS min_key, round(min(dw), 6) AS min_dw,
       arg_min(key, (-dw, key)) AS max_key, round(max(dw), 6) AS max_dw
FROM dw WHERE dw IS NOT NULL
""")
def q_ts_extremes(spark: SparkSession, sf: str) -> DataFrame:
    d = _daily_orders(spark, sf).durbin_watson()
    x = extremes(d, "dw", "key")
    return x.select("min_key", F.round("min_dw", 6).alias("min_dw"),
                    "max_key", F.round("max_dw", 6).alias("max_dw"))


@query("count_series", ops=("A6",), sql="""
SELECT count(DISTINCT o_orderstatus) AS n_series FROM orders
""")
def q_count_series(spark: SparkSession, sf: str) -> DataFrame:
    o = read_table(spark, sf, "orders")
    return count_series(o, "o_orderstatus")


@query("row_ids", ops=("W1",), sql="""
SELECT doc_id, lang, row_number() OVER (ORDER BY lang, doc_id) - 1 AS row_id FROM documents
""")
def q_row_ids(spark: SparkSession, sf: str) -> DataFrame:
    d = read_table(spark, sf, "documents").select("doc_id", "lang")
    return with_row_id(d, ["lang", "doc_id"]).select("doc_id", "lang", "row_id")


@query("ts_monthly", ops=("T1", "T2", "T3"), sql="WITH " + _sql_aligned("orders", "o_orderpriority", "o_orderdate", "o_totalprice", "month")
       + "," + _SQL_FILLED + f"""
SELECT key, strftime(ts, {SQL_TS_FMT}) AS ts, round(value, 6) AS value FROM filled
""")
def q_ts_monthly(spark: SparkSession, sf: str) -> DataFrame:
    """Calendar steps: the month's largest price per order priority on a monthly index."""
    o = read_table(spark, sf, "orders")
    obs = o.select(F.col("o_orderdate").alias("ts"), F.col("o_orderpriority").alias("key"), F.col("o_totalprice").alias("value"))
    lo, hi = T.index_bounds(obs, "ts", "month")
    f = T.align_series(T.snap(obs, "month"), lo, hi, "1 month").fill()
    return f.select("key", W.wall_datetime("ts").alias("ts"), F.round("value", 6).alias("value"))


@query("ts_business_days", ops=("T1",), sql=f"""
WITH b AS (SELECT date_trunc('day', min(o_orderdate)) AS lo, date_trunc('day', max(o_orderdate)) AS hi FROM orders),
d AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS ts FROM b)
SELECT strftime(ts, {SQL_TS_FMT}) AS ts FROM d WHERE isodow(ts) < 6
""")
def q_ts_business_days(spark: SparkSession, sf: str) -> DataFrame:
    lo, hi = T.index_bounds(read_table(spark, sf, "orders"), "o_orderdate", "day")
    return T.datetime_index(spark, lo, hi, "business day").select(W.wall_datetime("ts").alias("ts"))


# ------------------------------------------------------------------ log lines -> hourly series
def _log_docs(spark: SparkSession, sf: str) -> DataFrame:
    """Log documents: the compute-log line as ``message`` plus ``host`` and ``version``
    fields (host from the user, version from the value)."""
    ev = read_table(spark, sf, "events")
    ev = ev.withColumn("host", F.format_string("host-%d", F.col("user_id") % 5)) \
           .withColumn("version", F.floor("value").cast("string"))
    return compute_lines(ev, keep=("host", "version")).withColumnRenamed("line", "message")


@query("log_series", ops=("P7", "T2"), sql=f"""
WITH docs AS (SELECT 'host-' || (user_id % 5) AS host, CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS version,
                     {SQL_COMPUTE_LINE} AS message FROM events),
w AS (SELECT host, version, string_split(string_split(message, ' ')[1], '-') AS dd,
             string_split(string_split(message, ' ')[2], ':') AS tt FROM docs),
o AS (SELECT make_timestamp(TRY_CAST(dd[1] AS BIGINT), TRY_CAST(dd[2] AS BIGINT), TRY_CAST(dd[3] AS BIGINT),
                            TRY_CAST(tt[1] AS BIGINT), TRY_CAST(tt[2] AS BIGINT), 0) AS ts,
             host AS key, TRY_CAST(version AS DOUBLE) AS value FROM w),
b AS (SELECT date_trunc('hour', min(ts)) AS lo, date_trunc('hour', max(ts)) AS hi FROM o),
idx AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts FROM b),
keys AS (SELECT DISTINCT key FROM o WHERE key IS NOT NULL),
obs AS (SELECT key, ts, max(value) AS value FROM o WHERE key IS NOT NULL AND ts = date_trunc('hour', ts) GROUP BY 1, 2)
SELECT k.key, strftime(i.ts, {SQL_TS_FMT}) AS ts, obs.value
FROM keys k CROSS JOIN idx i LEFT JOIN obs ON obs.key = k.key AND obs.ts = i.ts
""")
def q_log_series(spark: SparkSession, sf: str) -> DataFrame:
    """Minute timestamps parsed from log lines, aligned per host to an hourly index:
    only observations on the hour align (minutes are kept, as in the original job)."""
    obs = parse_log_observations(_log_docs(spark, sf), "message", "host", "version")
    lo, hi = T.index_bounds(obs, "ts", "hour")
    a = T.align(obs, lo, hi, "1 hour")
    return a.select("key", W.wall_datetime("ts").alias("ts"), "value")
