"""Log lines rendered from the ``events`` table, in Spark and in SQL.

The test data has no raw log files, so the log jobs read lines that Spark
derives from ``events``: one line per event, in the shape of each log format.
The SQL twins produce byte-identical lines in DuckDB for the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import wallclock as W


def _damaged(line: Column) -> Column:
    """A share of the lines is missing, cut off, followed by a second line, or holds control
    characters, as files from many machines have them."""
    e = F.col("event_id")
    return (F.when(e % 97 == 0, F.lit(None).cast("string"))
            .when(e % 89 == 0, F.concat(F.lit("cut off "), e.cast("string")))
            .when(e % 83 == 0, F.concat(line, F.lit("\n  at frame 1")))
            .when(e % 79 == 0, F.concat(line, F.lit("\u0001x\u0002")))
            .otherwise(line))


def sql_damaged(line: str) -> str:
    return f"""CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN 'cut off ' || event_id
       WHEN event_id % 83 = 0 THEN {line} || chr(10) || '  at frame 1'
       WHEN event_id % 79 = 0 THEN {line} || chr(1) || 'x' || chr(2) ELSE {line} END"""


def _level() -> Column:
    t = F.col("event_type")
    return (F.when(t == "error", "ERROR").when(t == "purchase", "AUDIT").otherwise("INFO"))


def _claim_or_other() -> Column:
    t = F.col("event_type")
    claim = F.format_string("Attempting claim: memory %d MB, disk %s GB, VCPUs 1",
                            F.floor(F.col("value") * 16), F.get_json_object("props", "$.k"))
    other = F.format_string("Handled %s request, value %d", t, F.floor(F.col("value") * 100))
    return F.when(t == "purchase", claim).otherwise(other)


def compute_lines(events: DataFrame, keep: tuple[str, ...] | list = ("event_id",)) -> DataFrame:
    """``date time pid LEVEL module [req u t - - -] [instance: i] message``."""
    line = F.concat_ws(
        " ",
        W.wall_date("ts"), W.wall_time("ts", millis=True),
        F.col("event_id").cast("string"), _level(), F.lit("compute.claims"),
        F.format_string("[req-%d u%d t%d - - -]", "event_id", "user_id", F.col("user_id") % 7),
        F.format_string("[instance: %d]", "event_id"), _claim_or_other())
    return events.select(*keep, _damaged(line).alias("line"))


def agent_lines(events: DataFrame) -> DataFrame:
    """``date time pid LEVEL module. message tail`` (tail: one non-blank char)."""
    msg = F.format_string("polling %s failed after %d ms", F.col("event_type"),
                          F.floor(F.col("value") * 10))
    tail = F.when(F.col("event_id") % 5 == 0, F.lit("")).otherwise(F.lit("-"))
    line = F.concat_ws(
        " ",
        W.wall_date("ts"), W.wall_time("ts", millis=True),
        F.col("event_id").cast("string"), F.upper("event_type"),
        F.concat(F.lit("agent."), F.col("event_type")), msg, tail)
    return events.select("event_id", _damaged(line).alias("line"))


def dashboard_lines(events: DataFrame) -> DataFrame:
    """``Dow Mon dd HH:mm:ss.ffffff yyyy] [x:error] [pid p:tid t] message``."""
    line = F.concat_ws(
        " ",
        F.concat_ws(" ", W.day_abbr("ts"), W.month_abbr("ts"), F.format_string("%02d", F.dayofmonth("ts"))),
        F.concat(W.wall_time("ts"), F.lit(".000000")),
        F.format_string("%04d]", F.year("ts")), F.lit("[x:error]"),
        F.format_string("[pid %d:tid %d]", "user_id", "event_id"),
        F.format_string("%s boom %d", F.col("event_type"), F.floor(F.col("value"))))
    return events.select("event_id", _damaged(line).alias("line"))


def api_lines(events: DataFrame) -> DataFrame:
    """``date time pid LEVEL module [req user tenant - - -] client "METHOD path``."""
    method = F.when(F.col("event_type").isin("purchase", "signup"), "POST").otherwise("GET")
    line = F.concat_ws(
        " ",
        W.wall_date("ts"), W.wall_time("ts", millis=True), F.col("event_id").cast("string"),
        _level(), F.lit("api.wsgi"),
        F.format_string("[req-%d u%d t%d - - -]", "event_id", "user_id", F.col("user_id") % 7),
        F.format_string("10.0.%d.%d", F.col("user_id") % 250, F.col("event_id") % 250),
        F.concat(F.lit('"'), method), F.format_string("/v2/%s/%d", F.col("event_type"), "user_id"))
    return events.select("event_id", _damaged(line).alias("line"))


def dashboard_access_lines(events: DataFrame) -> DataFrame:
    """Access-log lines: client, ident, [time zone], "request", status, size, referer, agent."""
    method = F.when(F.col("event_type").isin("purchase", "signup"), "POST").otherwise("GET")
    status = F.when(F.col("event_type") == "error", "500").otherwise("200")
    line = F.concat_ws(
        " ",
        F.format_string("10.0.%d.%d", F.col("user_id") % 250, F.col("event_id") % 250), F.lit("- -"),
        F.format_string("[%02d/%s/%04d:%s", F.dayofmonth("ts"), W.month_abbr("ts"), F.year("ts"), W.wall_time("ts")),
        F.lit("+0000]"), F.concat(F.lit('"'), method), F.format_string("/dashboard/%s", F.col("event_type")),
        F.lit('HTTP/1.1"'), status, F.floor(F.col("value") * 10).cast("string"),
        F.format_string('"http://host/%d"', "user_id"),
        F.lit('"Mozilla/5.0 (X11; Linux x86_64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/49.0 Safari/537.36"'))
    return events.select("event_id", _damaged(line).alias("line"))


# ---------------------------------------------------------------- SQL twins
SQL_LEVEL = ("CASE WHEN event_type = 'error' THEN 'ERROR' WHEN event_type = 'purchase' "
             "THEN 'AUDIT' ELSE 'INFO' END")
SQL_MESSAGE = (
    "CASE WHEN event_type = 'purchase' THEN 'Attempting claim: memory ' || "
    "CAST(floor(value * 16) AS BIGINT) || ' MB, disk ' || json_extract_string(props, '$.k') || "
    "' GB, VCPUs 1' ELSE 'Handled ' || event_type || ' request, value ' || "
    "CAST(floor(value * 100) AS BIGINT) END")

SQL_COMPUTE_LINE = sql_damaged(f"""strftime(ts, '%Y-%m-%d') || ' ' || strftime(ts, '%H:%M:%S.%g') || ' ' || event_id || ' '
       || {SQL_LEVEL} || ' compute.claims [req-' || event_id || ' u' || user_id || ' t'
       || (user_id % 7) || ' - - -] [instance: ' || event_id || '] ' || {SQL_MESSAGE}""")

SQL_COMPUTE_LINES = f"""
SELECT event_id, {SQL_COMPUTE_LINE} AS line
FROM events"""

SQL_AGENT_LINE = sql_damaged("""strftime(ts, '%Y-%m-%d') || ' ' || strftime(ts, '%H:%M:%S.%g') || ' ' || event_id || ' '
       || upper(event_type) || ' agent.' || event_type || ' polling ' || event_type
       || ' failed after ' || CAST(floor(value * 10) AS BIGINT) || ' ms '
       || CASE WHEN event_id % 5 = 0 THEN '' ELSE '-' END""")

SQL_AGENT_LINES = f"""
SELECT event_id, {SQL_AGENT_LINE} AS line
FROM events"""

SQL_DASHBOARD_LINE = sql_damaged("""strftime(ts, '%a %b %d') || ' ' || strftime(ts, '%H:%M:%S') || '.000000 '
       || strftime(ts, '%Y') || '] [x:error] [pid ' || user_id || ':tid ' || event_id || '] '
       || event_type || ' boom ' || CAST(floor(value) AS BIGINT)""")

SQL_DASHBOARD_LINES = f"""
SELECT event_id, {SQL_DASHBOARD_LINE} AS line
FROM events"""

SQL_API_LINE = sql_damaged(f"""strftime(ts, '%Y-%m-%d') || ' ' || strftime(ts, '%H:%M:%S.%g') || ' ' || event_id || ' ' || {SQL_LEVEL}
       || ' api.wsgi [req-' || event_id || ' u' || user_id || ' t' || (user_id % 7) || ' - - -] 10.0.'
       || (user_id % 250) || '.' || (event_id % 250) || ' "'
       || CASE WHEN event_type IN ('purchase', 'signup') THEN 'POST' ELSE 'GET' END
       || ' /v2/' || event_type || '/' || user_id""")

SQL_API_LINES = f"""
SELECT event_id, {SQL_API_LINE} AS line
FROM events"""

SQL_DASHBOARD_ACCESS_LINE = sql_damaged("""'10.0.' || (user_id % 250) || '.' || (event_id % 250) || ' - - ' || strftime(ts, '[%d/%b/%Y:%H:%M:%S')
       || ' +0000] "' || CASE WHEN event_type IN ('purchase', 'signup') THEN 'POST' ELSE 'GET' END
       || ' /dashboard/' || event_type || ' HTTP/1.1" ' || CASE WHEN event_type = 'error' THEN '500' ELSE '200' END
       || ' ' || CAST(floor(value * 10) AS BIGINT) || ' "http://host/' || user_id || '" '
       || '"Mozilla/5.0 (X11; Linux x86_64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/49.0 Safari/537.36"'""")

SQL_DASHBOARD_ACCESS_LINES = f"""
SELECT event_id, {SQL_DASHBOARD_ACCESS_LINE} AS line
FROM events"""
