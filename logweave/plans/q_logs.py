"""Log-job queries: parse, filter, look up and total."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.patterns import (AGENT_ERROR_LOG, API_ACCESS_LOG, COMPUTE_LOG, COMPUTE_LOG_SHORT,
                                  DASHBOARD_ACCESS_LOG, DASHBOARD_ERROR_LOG, FORMATS)
from ..operators import parsing as P
from ..operators.indexing import with_row_id
from ..operators.relational import usage_by_user, with_user_name
from ..session import read_table
from .registry import noncapturing_prefix, query
from .renders import (SQL_AGENT_LINES, SQL_API_LINES, SQL_COMPUTE_LINES, SQL_DASHBOARD_ACCESS_LINES,
                      SQL_DASHBOARD_LINES, agent_lines, api_lines, compute_lines,
                      dashboard_access_lines, dashboard_lines)

# Known users: every customer, under an id of its own numbering (only some of them occur in the lines).


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def known_users(spark: SparkSession, sf: str) -> DataFrame:
    c = read_table(spark, sf, "customer")
    return c.select(F.format_string("u%d", F.col("c_custkey") * 7 + 3).alias("user_id"), F.col("c_name").alias("user_name"))


SQL_KNOWN_USERS = "SELECT 'u' || (c_custkey * 7 + 3) AS user_id, c_name AS user_name FROM customer"

_P = q(COMPUTE_LOG)
_P_TAIL = q(noncapturing_prefix(COMPUTE_LOG, 9))  # group 10 becomes group 1


# --------------------------------------------------------------------- flagship
_SQL_USAGE = f"""
WITH lines AS ({SQL_COMPUTE_LINES}),
parsed AS (
  SELECT regexp_extract(line, {_P}, 7) AS user_id, regexp_extract(line, {_P_TAIL}, 1) AS message
  FROM lines),
claims AS (
  SELECT user_id,
         TRY_CAST(string_split(string_split(message, ',')[1], ' ')[4] AS BIGINT) AS memory_mb,
         TRY_CAST(string_split(string_split(message, ',')[2], ' ')[3] AS BIGINT) AS disk_gb
  FROM parsed WHERE user_id <> '' AND contains(message, 'Attempting claim')),
totals AS (
  SELECT user_id, CAST(sum(memory_mb) AS BIGINT) AS memory_mb, CAST(sum(disk_gb) AS BIGINT) AS disk_gb,
         count(*) AS n_claims
  FROM claims GROUP BY user_id),
users AS ({SQL_KNOWN_USERS})
SELECT t.user_id, u.user_name, t.memory_mb, t.disk_gb, t.n_claims
FROM totals t LEFT JOIN users u ON t.user_id = u.user_id
WHERE EXISTS (SELECT 1 FROM users k WHERE contains(t.user_id, k.user_id))
"""


@query("usage_by_user", ops=("P9", "F1", "F4", "P16", "A1", "J2", "O2"), sql=_SQL_USAGE)
def q_usage_by_user(spark: SparkSession, sf: str) -> DataFrame:
    lines = compute_lines(read_table(spark, sf, "events"))
    return usage_by_user(lines, known_users(spark, sf))


@query("usage_ranked", ops=("A1", "O2", "W1"), sql=f"""
WITH u AS ({_SQL_USAGE})
SELECT *, row_number() OVER (ORDER BY memory_mb, disk_gb, user_id) AS rank,
       row_number() OVER (ORDER BY 'memory ' || memory_mb || ', disk ' || disk_gb, user_id) AS text_rank FROM u
""")
def q_usage_ranked(spark: SparkSession, sf: str) -> DataFrame:
    """The totals in both orders, as numbers and as the original's text, with their ranks."""
    lines, users = compute_lines(read_table(spark, sf, "events")), known_users(spark, sf)
    a = with_row_id(usage_by_user(lines, users), out="rank").withColumn("rank", F.col("rank") + 1)
    b = with_row_id(usage_by_user(lines, users, order="text"), out="text_rank")
    return a.join(b.select("user_id", (F.col("text_rank") + 1).alias("text_rank")), "user_id")


@query("known_user_rows", ops=("F4",), sql=f"""
WITH lines AS ({SQL_COMPUTE_LINES}),
parsed AS (
  SELECT event_id, regexp_extract(line, {_P}, 7) AS user_id, regexp_extract(line, {_P_TAIL}, 1) AS message
  FROM lines),
users AS ({SQL_KNOWN_USERS}),
hit AS (SELECT DISTINCT p.user_id FROM parsed p JOIN users k ON contains(p.user_id, k.user_id))
SELECT event_id, user_id FROM parsed
WHERE contains(message, 'Attempting claim') AND user_id IN (SELECT user_id FROM hit)
""")
def q_known_user_rows(spark: SparkSession, sf: str) -> DataFrame:
    lines = compute_lines(read_table(spark, sf, "events"))
    p = P.parse_log(lines, "line", "compute", groups=(7, 10), keep=["event_id"], matched_col=None)
    return P.filter_known_users(p, known_users(spark, sf)).select("event_id", "user_id")


# --------------------------------------------------------------------- P9 per format
_COMPUTE_COLS = FORMATS["compute"].groups[:10]


@query("parse_log_compute", ops=("P9",), sql=f"""
WITH lines AS ({SQL_COMPUTE_LINES})
SELECT event_id,
       {", ".join(f"regexp_extract(line, {_P}, {i + 1}) AS {n}" for i, n in enumerate(_COMPUTE_COLS[:9]))},
       regexp_extract(line, {_P_TAIL}, 1) AS message,
       coalesce(regexp_matches(line, {_P}), false) AS matched
FROM lines
""")
def q_parse_log_compute(spark: SparkSession, sf: str) -> DataFrame:
    lines = compute_lines(read_table(spark, sf, "events"))
    return P.parse_log(lines, "line", "compute", keep=["event_id"])


_A = q(AGENT_ERROR_LOG)


@query("parse_log_agent", ops=("P9", "F2"), sql=f"""
WITH lines AS ({SQL_AGENT_LINES}),
g AS (
  SELECT event_id,
         {", ".join(f"trim(regexp_extract(line, {_A}, {i + 1})) AS {n}" for i, n in enumerate(FORMATS["agent_error"].groups[:6]))}
  FROM lines)
SELECT * FROM g WHERE message <> ''
""")
def q_parse_log_agent(spark: SparkSession, sf: str) -> DataFrame:
    lines = agent_lines(read_table(spark, sf, "events"))
    p = P.parse_log(lines, "line", "agent_error", keep=["event_id"], trim=True, matched_col=None)
    return P.drop_unparsed(p, "message")


_D = q(DASHBOARD_ERROR_LOG)


@query("parse_log_dashboard", ops=("P9",), sql=f"""
WITH lines AS ({SQL_DASHBOARD_LINES})
SELECT event_id, regexp_extract(line, {_D}, 0) AS match,
       {", ".join(f"regexp_extract(line, {_D}, {i + 1}) AS {n}" for i, n in enumerate(FORMATS["dashboard_error"].groups[:6]))}
FROM lines
""")
def q_parse_log_dashboard(spark: SparkSession, sf: str) -> DataFrame:
    lines = dashboard_lines(read_table(spark, sf, "events"))
    return P.parse_log(lines, "line", "dashboard_error", keep=["event_id"], matched_col=None)


# --------------------------------------------------------------------- F3 + P10 + P17
@query("tenant_fields", ops=("F3", "P10", "P17"), sql=f"""
WITH lines AS ({SQL_COMPUTE_LINES}),
g AS (
  SELECT event_id,
         regexp_extract(line, {_P}, 5) AS module, regexp_extract(line, {_P}, 6) AS request_id,
         regexp_extract(line, {_P}, 7) AS user_id, regexp_extract(line, {_P}, 8) AS tenant_id,
         regexp_extract(line, {_P}, 9) AS instance, regexp_extract(line, {_P_TAIL}, 1) AS message
  FROM lines)
SELECT event_id, tenant_id AS key,
       concat_ws(',', module, request_id, user_id, instance, message) AS value,
       array_to_string(list_sort(list_distinct(string_split(concat_ws(',', module, request_id, user_id, instance, message), ','))), '|') AS items
FROM g WHERE tenant_id = 't3'
""")
def q_tenant_fields(spark: SparkSession, sf: str) -> DataFrame:
    lines = compute_lines(read_table(spark, sf, "events"))
    p = P.parse_log(lines, "line", "compute", keep=["event_id"], matched_col=None)
    p = P.drop_unparsed(p, "tenant_id").filter(F.col("tenant_id") == "t3")
    kv = P.key_by_group(p, "tenant_id", ["module", "request_id", "user_id", "instance", "message"], keep=["event_id"])
    kv = P.split_tokens(kv, "value", out="items")
    # order inside the set is not part of the result: compare as sorted text
    return kv.withColumn("items", F.array_join(F.array_sort("items"), "|"))


# --------------------------------------------------------------------- P16 + J2
@query("claims_named", ops=("P16", "J2", "F1"), sql=f"""
WITH lines AS ({SQL_COMPUTE_LINES}),
parsed AS (
  SELECT event_id, regexp_extract(line, {_P}, 7) AS user_id, regexp_extract(line, {_P_TAIL}, 1) AS message
  FROM lines)
SELECT p.event_id, p.user_id, u.user_name,
       TRY_CAST(string_split(string_split(message, ',')[1], ' ')[4] AS BIGINT) AS memory_mb,
       TRY_CAST(string_split(string_split(message, ',')[2], ' ')[3] AS BIGINT) AS disk_gb
FROM parsed p LEFT JOIN ({SQL_KNOWN_USERS}) u ON p.user_id = u.user_id
WHERE p.user_id <> '' AND contains(p.message, 'Attempting claim')
""")
def q_claims_named(spark: SparkSession, sf: str) -> DataFrame:
    lines = compute_lines(read_table(spark, sf, "events"))
    p = P.parse_log(lines, "line", "compute", groups=(7, 10), keep=["event_id"], matched_col=None)
    p = P.parse_claim(P.drop_unparsed(p, "user_id").filter(P.is_claim("message")))
    p = with_user_name(p, known_users(spark, sf))
    return p.select("event_id", "user_id", "user_name", "memory_mb", "disk_gb")


# --------------------------------------------------------------------- P8 + P11 + P12 + F5
@query("json_metrics", ops=("P8", "P11", "P12", "F5"), sql="""
WITH j AS (
  SELECT event_id, CASE WHEN event_id % 97 <> 0 AND event_id % 89 <> 0
                        THEN TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS k, value,
         TRY_CAST(user_id AS DOUBLE) AS u
  FROM events)
SELECT event_id, CASE WHEN k > 50 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS label,
       round(value, 4) AS f_value, round(u, 4) AS f_user
FROM j WHERE k IS NOT NULL AND value IS NOT NULL AND u IS NOT NULL
""")
def q_json_metrics(spark: SparkSession, sf: str) -> DataFrame:
    ev = read_table(spark, sf, "events")
    # some documents have broken JSON, some a word for a number
    e = F.col("event_id")
    ev = ev.withColumn("props", F.when(e % 97 == 0, F.lit('{"k": ')).when(e % 89 == 0, F.lit('{"k": "many"}')).otherwise(F.col("props")))
    j = P.json_fields(ev, "props", "k string", keep=["event_id", "value", "user_id"])
    m = P.parse_metrics(j, ["value", "user_id"], "k", threshold=50, keep=["event_id"])
    return m.select("event_id", "label", F.round(F.col("features")[0], 4).alias("f_value"),
                    F.round(F.col("features")[1], 4).alias("f_user"))


# --------------------------------------------------------------------- P9: API access and short compute formats
_API = q(API_ACCESS_LOG)
_API_TAIL = q(noncapturing_prefix(API_ACCESS_LOG, 9))  # groups 10..13 become 1..4
_API_COLS = FORMATS["api_access"].groups


@query("parse_log_api", ops=("P9",), sql=f"""
WITH lines AS ({SQL_API_LINES})
SELECT event_id,
       {", ".join(f"regexp_extract(line, {_API}, {i + 1}) AS {n}" for i, n in enumerate(_API_COLS[:9]))},
       {", ".join(f"regexp_extract(line, {_API_TAIL}, {i + 1}) AS {n}" for i, n in enumerate(_API_COLS[9:]))},
       coalesce(regexp_matches(line, {_API}), false) AS matched
FROM lines
""")
def q_parse_log_api(spark: SparkSession, sf: str) -> DataFrame:
    """All 13 groups of the API access format."""
    lines = api_lines(read_table(spark, sf, "events"))
    return P.parse_log(lines, "line", "api_access", groups=tuple(range(1, 14)), keep=["event_id"])


_S = q(COMPUTE_LOG_SHORT)


@query("parse_log_compute_short", ops=("P9",), sql=f"""
WITH lines AS ({SQL_COMPUTE_LINES})
SELECT event_id,
       {", ".join(f"regexp_extract(line, {_S}, {i + 1}) AS {n}" for i, n in enumerate(FORMATS["compute_short"].groups))},
       coalesce(regexp_matches(line, {_S}), false) AS matched
FROM lines
""")
def q_parse_log_compute_short(spark: SparkSession, sf: str) -> DataFrame:
    """The short compute-log format (8 groups) on the same compute lines."""
    lines = compute_lines(read_table(spark, sf, "events"))
    return P.parse_log(lines, "line", "compute_short", groups=tuple(range(1, 9)), keep=["event_id"])


_DA = q(DASHBOARD_ACCESS_LOG)
_DA_TAIL = q(noncapturing_prefix(DASHBOARD_ACCESS_LOG, 9))  # groups 10..17 become 1..8
_DA_COLS = FORMATS["dashboard_access"].groups


@query("parse_log_dashboard_access", ops=("P9",), sql=f"""
WITH lines AS ({SQL_DASHBOARD_ACCESS_LINES})
SELECT event_id,
       {", ".join(f"regexp_extract(line, {_DA}, {i + 1}) AS {n}" for i, n in enumerate(_DA_COLS[:9]))},
       {", ".join(f"regexp_extract(line, {_DA_TAIL}, {i + 1}) AS {n}" for i, n in enumerate(_DA_COLS[9:]))},
       coalesce(regexp_matches(line, {_DA}), false) AS matched
FROM lines
""")
def q_parse_log_dashboard_access(spark: SparkSession, sf: str) -> DataFrame:
    """All 17 groups of the dashboard access format."""
    lines = dashboard_access_lines(read_table(spark, sf, "events"))
    return P.parse_log(lines, "line", "dashboard_access", groups=tuple(range(1, 18)), keep=["event_id"])
