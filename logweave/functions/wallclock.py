"""Time-zone-free helpers for wall-clock (``timestamp_ntz``) values.

Some Spark functions convert a ``timestamp_ntz`` through the session time zone
(``date_format``, ``date_trunc``, ``timestamp_diff``): in a zone with a
daylight-saving gap, a local midnight that does not exist comes back as 01:00.
These helpers work on the calendar fields instead (``year``, ``month``, ``hour``,
... and casts to ``date``, which are zone-free for ``timestamp_ntz``), so the
result is the same in every session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# English day and month abbreviations of the log date fields
# (``dayofweek`` numbers Sunday as 1).
DAY_ABBR = ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]
MONTH_ABBR = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
# ---------------------------------------------------------------------------


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def wall_date(ts: str | Column) -> Column:
    """``yyyy-MM-dd``."""
    t = _c(ts)
    return F.format_string("%04d-%02d-%02d", F.year(t), F.month(t), F.dayofmonth(t))


def _seconds_with_fraction(t: Column) -> Column:
    return F.date_part(F.lit("SECOND"), t).cast("double")


def wall_time(ts: str | Column, millis: bool = False) -> Column:
    """``HH:mm:ss`` or ``HH:mm:ss.SSS`` (milliseconds truncated, as formatters do)."""
    t = _c(ts)
    base = F.format_string("%02d:%02d:%02d", F.hour(t), F.minute(t), F.second(t))
    if not millis:
        return base
    s = F.date_part(F.lit("SECOND"), t)  # decimal(8,6): exact microseconds
    ms = F.floor((s - F.floor(s)) * 1000).cast("int")
    return F.concat(base, F.format_string(".%03d", ms))


def wall_datetime(ts: str | Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``."""
    return F.concat(wall_date(ts), F.lit(" "), wall_time(ts))


def day_abbr(ts: str | Column) -> Column:
    return F.element_at(F.array(*[F.lit(d) for d in DAY_ABBR]), F.dayofweek(_c(ts)))


def month_abbr(ts: str | Column) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in MONTH_ABBR]), F.month(_c(ts)))


def epoch_seconds(ts: str | Column) -> Column:
    """Seconds (with fraction) since 1970-01-01 00:00 of the wall-clock value."""
    t = _c(ts)
    days = F.datediff(t.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    return (days * 86400 + F.hour(t) * 3600 + F.minute(t) * 60).cast("double") + _seconds_with_fraction(t)


def trunc(ts: str | Column, unit: str) -> Column:
    """Truncate to ``month``, ``day``, ``hour``, ``minute`` or ``second`` as a timestamp_ntz."""
    t = _c(ts)
    unit = unit.lower()
    zero = F.lit(0)
    day = F.lit(1) if unit == "month" else F.dayofmonth(t)
    parts = {
        "month": (zero, zero, zero),
        "day": (zero, zero, zero),
        "hour": (F.hour(t), zero, zero),
        "minute": (F.hour(t), F.minute(t), zero),
        "second": (F.hour(t), F.minute(t), F.second(t)),
    }
    if unit not in parts:
        raise ValueError(f"unsupported unit {unit!r}")
    h, m, s = parts[unit]
    return F.make_timestamp_ntz(F.year(t), F.month(t), day, h, m, s)
