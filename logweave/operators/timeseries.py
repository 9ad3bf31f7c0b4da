"""Time-series operators (T1-T6) on long-form series ``(key, ts, value)`` and on aligned sets.

An index is a number of steps, not a list of instants: instants are computed from their
position on the executors.

``align_series`` keeps a set of series on an index as one row per key and stretch of
``_CHUNK`` positions, holding that stretch's known points. Filling, rates and the Durbin-Watson
statistic all start from this one partitioning by (key, stretch): the statistic sums up each
stretch by itself (first and last point, first and last rate, sums of squares) and joins the
summaries of a key in order, so rows are never expanded; the row-wise results take the points
beyond a stretch's ends from a table with one row per key and stretch. One long series is as
well spread as many short ones.

The functions on long-form tables (``fill``, ``return_rates``, ``durbin_watson``) take any series, on an
index or not, one step at a time: series are cut into stretches of ``STRETCH`` seconds in the same way.
"""

from __future__ import annotations

import calendar
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import wallclock as W
from ..functions.wallclock import epoch_seconds

_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 7 * 86400}
_MONTHS = {"month": 1, "quarter": 3, "year": 12}
#: Seconds of a series that one task works on: a month of second-by-second data.
STRETCH = 30 * 86400
#: Instants that one row of the grid stands for before it is expanded.
_CHUNK = 4096


def parse_step(step: str) -> tuple[str, int]:
    """'15 minutes' -> ("seconds", 900), 'quarter' -> ("months", 3), '2 business days' -> ("business", 2)."""
    words = step.strip().lower().split()
    n = int(words.pop(0)) if words[0].lstrip("-").isdigit() else 1
    unit = " ".join(words).rstrip("s")
    if n <= 0:
        raise ValueError(f"a step must be positive, not {step!r}")
    if unit in _SECONDS:
        return "seconds", n * _SECONDS[unit]
    if unit in _MONTHS:
        return "months", n * _MONTHS[unit]
    if unit == "business day":
        return "business", n
    raise ValueError(f"unsupported step {step!r}")


def _instant(t: datetime | str) -> datetime:
    return t if isinstance(t, datetime) else datetime.fromisoformat(str(t))


def _add_months(t: datetime, n: int) -> datetime:
    year, month = divmod(t.year * 12 + t.month - 1 + n, 12)
    return t.replace(year=year, month=month + 1, day=min(t.day, calendar.monthrange(year, month + 1)[1]))


def _first_weekday(t: datetime) -> datetime:
    return t + timedelta(days=(7 - t.weekday()) % 7) if t.weekday() > 4 else t


def index_length(start: datetime | str | None, end: datetime | str | None, step: str) -> int:
    """Number of instants from ``start`` to ``end``, both ends included; 0 without bounds."""
    if start is None or end is None:
        return 0
    lo, hi = _instant(start), _instant(end)
    kind, n = parse_step(step)
    if kind == "seconds":
        return max(0, int((hi - lo).total_seconds() // n) + 1)
    if kind == "months":
        steps = ((hi.year - lo.year) * 12 + hi.month - lo.month) // n
        return max(0, steps + (1 if _add_months(lo, steps * n) <= hi else 0))
    lo = _first_weekday(lo)
    if hi < lo:
        return 0
    days = (hi - lo).days
    weeks, rest = divmod(days, 7)
    weekdays = weeks * 5 + sum((lo.weekday() + d) % 7 < 5 for d in range(rest + 1))
    return (weekdays - 1) // n + 1


def instant_at(start: datetime | str, step: str, position: Column) -> Column:
    """The index's instant at a 0-based position, as a timestamp_ntz."""
    kind, n = parse_step(step)
    lo = _instant(start)
    if kind == "business":
        lo = _first_weekday(lo)
    t = F.lit(str(lo)).cast("timestamp_ntz")
    if kind == "months":
        return t + F.make_ym_interval(F.lit(0), (position * n).cast("int"))
    if kind == "seconds":
        total = position * n
        zero = F.lit(0)
        return t + F.make_dt_interval(F.floor(total / 86400).cast("int"), zero, zero, F.pmod(total, F.lit(86400)).cast("decimal(18,6)"))
    days = position * n + 2 * F.floor((position * n + lo.weekday()) / 5)
    return t + F.make_dt_interval(days.cast("int"))


# --------------------------------------------------------------------------- T1
def datetime_index(spark: SparkSession, start: datetime | str | None, end: datetime | str | None,
                   step: str = "1 hour") -> DataFrame:
    """Uniform instants from ``start`` to ``end``, both ends included.

    Steps are seconds to weeks, months, quarters, years (end of month kept within the
    month) or business days (Monday to Friday).
    """
    n = index_length(start, end, step)
    at = instant_at(start, step, F.col("id")) if n else F.lit(None).cast("timestamp_ntz")
    return spark.range(n).select(at.alias("ts"))


def _trunc(df: DataFrame, ts: str, unit: str) -> Column:
    """Wall-clock truncation for timestamp_ntz (zone-free), session-zone for timestamp."""
    if dict(df.dtypes)[ts] == "timestamp_ntz":
        return W.trunc(ts, unit)
    return F.date_trunc(unit, F.col(ts))


def index_bounds(df: DataFrame, ts: str = "ts", unit: str = "hour") -> tuple[datetime, datetime]:
    """(first, last) instant of the data truncated to ``unit``: one two-value aggregate."""
    t = _trunc(df, ts, unit)
    r = df.agg(F.min(t), F.max(t)).first()
    return r[0], r[1]


def snap(df: DataFrame, unit: str, ts: str = "ts") -> DataFrame:
    """Truncate observation times to ``unit`` (minute, hour, day) before aligning."""
    return df.withColumn(ts, _trunc(df, ts, unit).cast(dict(df.dtypes)[ts]))


# --------------------------------------------------------------------------- T2
def align(obs: DataFrame, start: datetime | str | None, end: datetime | str | None, step: str = "1 hour", *,
          ts: str = "ts", key: str = "key", value: str = "value",
          duplicates: str = "max") -> DataFrame:
    """Observations on a uniform index, one row per (key, instant).

    Missing instants get a null value; observations off the index are dropped;
    several observations on one instant are reduced by ``duplicates`` (``max``
    by default, a stated order instead of "whichever came last"). Without bounds (an
    empty input) the result is empty. The grid grows from one row per key and 4,096
    instants, dealt out before they are expanded, and is joined to the (key, ts) sums.
    """
    red = {"max": F.max, "min": F.min, "sum": F.sum, "avg": F.avg}[duplicates]
    n = index_length(start, end, step)
    t = F.col(ts)
    known = obs.where(F.col(key).isNotNull())
    keys = known.select(F.col(key).alias("key")).distinct()
    last = max(0, n - 1)
    chunks = keys.where(F.lit(n > 0)).select("key", F.explode(F.sequence(F.lit(0), F.lit(last // _CHUNK))).alias("_chunk"))
    first = F.col("_chunk").cast("bigint") * _CHUNK
    places = chunks.repartition("key", "_chunk").select(
        "key", F.explode(F.sequence(first, F.least(first + (_CHUNK - 1), F.lit(last).cast("bigint")))).alias("_at"))
    if n == 0:
        return places.select("key", F.lit(None).cast("timestamp_ntz").alias("ts"), F.lit(None).cast("double").alias("value"))
    grid = places.select("key", instant_at(start, step, F.col("_at")).alias("ts"))
    inside = (t >= F.lit(str(_instant(start))).cast("timestamp_ntz")) & (t <= F.lit(str(_instant(end))).cast("timestamp_ntz"))
    o = known.where(inside).groupBy(F.col(key).alias("key"), t.cast("timestamp_ntz").alias("ts")).agg(
        red(value).cast("double").alias("value"))
    return grid.join(o, ["key", "ts"], "left")


# --------------------------------------------------------------------------- aligned sets
def position_of(start: datetime | str, step: str, ts: Column) -> Column:
    """The index position of an instant (a timestamp_ntz), null between two positions: the reverse of ``instant_at``."""
    kind, n = parse_step(step)
    lo = _instant(start)
    if kind == "business":
        lo = _first_weekday(lo)
    first = F.lit(str(lo)).cast("timestamp_ntz")
    if kind == "months":
        steps = (F.year(ts) - lo.year) * 12 + F.month(ts) - lo.month
    elif kind == "seconds":
        steps = F.floor(epoch_seconds(ts) - epoch_seconds(first))
    else:
        days = F.date_diff(ts.cast("date"), first.cast("date")) + lo.weekday()
        steps = 5 * F.floor(days / 7) + F.pmod(days, F.lit(7)) - lo.weekday()
    at = F.floor(steps / n).cast("bigint")
    return F.when(instant_at(start, step, at) == ts, at)


def align_series(obs: DataFrame, start: datetime | str | None, end: datetime | str | None, step: str = "1 hour", *,
                 ts: str = "ts", key: str = "key", value: str = "value", duplicates: str = "max", size: int = _CHUNK) -> SeriesSet:
    """``obs`` on a uniform index as a ``SeriesSet``. Missing instants, observations off the index, duplicates and null
    keys are handled as in ``align``; two shuffles, both of reduced points."""
    red = {"max": F.max, "min": F.min, "sum": F.sum, "avg": F.avg}[duplicates]
    n = index_length(start, end, step)
    at = F.lit(None).cast("bigint") if n == 0 else position_of(start, step, F.col(ts).cast("timestamp_ntz"))
    inside = F.when((at >= 0) & (at < n) & F.col(value).isNotNull(), at)
    # a key without a value on the index keeps one row, without points
    reduced = obs.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), inside.alias("i"), F.col(value).alias("v")).groupBy("key", "i").agg(
        red("v").cast("double").alias("v"))
    point = F.when(F.col("i").isNotNull(), F.struct("i", "v"))
    stretch = F.coalesce(F.floor(F.col("i") / size), F.lit(0)).cast("bigint")
    points = reduced.groupBy("key", stretch.alias("stretch")).agg(F.array_sort(F.collect_list(point)).alias("points"))
    return SeriesSet(points, start, step, n, size)


@dataclass(frozen=True)
class SeriesSet:
    """Series on one index of ``n`` positions: ``table`` has one row (key, stretch, points) per key and ``size`` positions
    with observations; points are structs (i, v) in order, and none only in a key's first row."""
    table: DataFrame
    start: datetime | str | None
    step: str
    n: int
    size: int

    def _time(self, i: Column) -> Column:
        """What linear filling is linear in: positions of even steps, else seconds."""
        kind, _ = parse_step(self.step)
        return i.cast("double") if kind == "seconds" else epoch_seconds(instant_at(self.start, self.step, i)).cast("double")

    def _line(self, a: Column, b: Column, i: Column) -> Column:
        """The value at position ``i`` of the line through two points."""
        share = (self._time(i) - self._time(a["i"])) / (self._time(b["i"]) - self._time(a["i"]))
        return a["v"] + (b["v"] - a["v"]) * share

    def _dense(self, points: Column, lo: Column, hi: Column) -> Column:
        """Values at the positions ``lo`` to ``hi`` of the lines through the points; null before the first and after the last."""
        inner = F.greatest(F.size(points) - 1, F.lit(0))
        pairs = F.zip_with(F.slice(points, 1, inner), F.slice(points, 2, inner), lambda a, b: F.struct(a.alias("a"), b.alias("b")))

        def piece(p: Column) -> Column:
            at = F.sequence(F.greatest(p["a"]["i"], lo), F.least(p["b"]["i"] - 1, hi))
            return F.when((p["a"]["i"] <= hi) & (p["b"]["i"] > lo), F.transform(at, lambda i: self._line(p["a"], p["b"], i))).otherwise(
                F.array().cast("array<double>"))

        first, last = F.get(points, F.lit(0)), F.get(points, F.size(points) - 1)
        nulls = lambda count: F.array_repeat(F.lit(None).cast("double"), F.least(F.greatest(count, F.lit(0)), hi - lo + 1).cast("int"))
        end = F.when((last["i"] >= lo) & (last["i"] <= hi), F.array(last["v"])).otherwise(F.array().cast("array<double>"))
        return F.when(F.size(points) == 0, nulls(hi - lo + 1)).otherwise(
            F.concat(nulls(first["i"] - lo), F.flatten(F.transform(pairs, piece)), end, nulls(hi - last["i"])))

    # ------------------------------------------------------------------ rows
    def _stretches(self) -> DataFrame:
        """(key, lo, hi, points) of every stretch of the index for every key; among the points are the last two
        before it and the next one behind it. One table of ends, one row per key and stretch, is ordered by key."""
        kind = self.table.schema["points"].dataType
        none = F.array().cast(kind)
        ends = self.table.select("key", "stretch", F.get("points", F.lit(0)).alias("first"), F.slice(F.reverse("points"), 1, 2).alias("ends"))
        w = Window.partitionBy("key").orderBy("stretch")
        two = lambda *parts: F.slice(F.concat(*[F.coalesce(p, none) for p in parts]), 1, 2)
        ends = ends.select("key", "stretch", "first", "ends", two(F.lag("ends").over(w), F.lag("ends", 2).over(w)).alias("before"),
                           F.lead("first").over(w).alias("after"), F.lag("stretch").over(w).alias("previous"), F.lead("stretch").over(w).alias("next"))
        last = (max(self.n, 1) - 1) // self.size

        def run(lo: Column, hi: Column, place: int) -> Column:
            numbers = F.transform(F.sequence(lo, hi), lambda s: F.struct(s.alias("stretch"), F.lit(place).alias("place")))
            return F.when(lo <= hi, numbers).otherwise(F.array().cast("array<struct<stretch: bigint, place: int>>"))

        own, zero = F.col("stretch"), F.lit(0).cast("bigint")
        # each row answers for its own stretch, for empty ones up to the next row, and the first for those before it
        ahead = run(zero, F.when(F.col("previous").isNull(), own - 1).otherwise(F.lit(-1).cast("bigint")), 0)
        behind = run(own + 1, F.coalesce(F.col("next") - 1, F.lit(last).cast("bigint")), 2)
        every = ends.select("*", F.explode(F.concat(ahead, run(own, own, 1), behind)).alias("s"))
        place = F.col("s.place")
        every = every.select("key", F.col("s.stretch").alias("stretch"),
                             F.when(place == 0, none).when(place == 1, F.reverse("before")).otherwise(F.reverse(two(F.col("ends"), F.col("before")))).alias("_left"),
                             F.when(place == 0, F.col("first")).otherwise(F.col("after")).alias("_right"))
        met = every.join(self.table, ["key", "stretch"], "left")
        right = F.when(F.col("_right").isNotNull(), F.array("_right")).otherwise(none)
        lo = F.col("stretch") * self.size
        return met.select("key", lo.alias("lo"), F.least(lo + (self.size - 1), F.lit(self.n - 1).cast("bigint")).alias("hi"),
                          F.concat("_left", F.coalesce("points", none), right).alias("points"))

    def _at(self, i: Column) -> Column:
        return instant_at(self.start, self.step, i).alias("ts") if self.n else F.lit(None).cast("timestamp_ntz").alias("ts")

    def fill(self, out: str = "value") -> DataFrame:
        """(key, ts, value) of every position: gaps inside a series filled linearly, leading and trailing ones null."""
        dense = self._stretches().where("lo <= hi").select("key", "lo", F.posexplode(self._dense(F.col("points"), F.col("lo"), F.col("hi"))).alias("_k", out))
        return dense.select("key", self._at(F.col("lo") + F.col("_k")), out)

    def return_rates(self, out: str = "rate") -> DataFrame:
        """(key, ts, rate) of the filled series: ``v_t / v_(t-1) - 1``; the first instant is dropped."""
        values = self._stretches().where("lo <= hi").select("key", "lo", self._dense(F.col("points"), F.col("lo") - 1, F.col("hi")).alias("_v"))
        n = F.size("_v") - 1
        rates = F.zip_with(F.slice("_v", 2, n), F.slice("_v", 1, n), lambda v, p: F.try_divide(v, p) - 1)
        rows = values.select("key", "lo", F.posexplode(rates).alias("_k", out)).where(F.col("lo") + F.col("_k") > 0)
        return rows.select("key", self._at(F.col("lo") + F.col("_k")), out)

    # ------------------------------------------------------------------ statistic
    def durbin_watson(self, out: str = "dw") -> DataFrame:
        """(key, dw) of the filled series' rates: ``sum((e_t - e_(t-1))^2) / sum(e_t^2)``; nulls skipped, 0/0 -> null.

        Every stretch sums up what lies between its own first and last point. In the order of a key's stretches, the line
        from the last point before a stretch to its first adds the rates on it, in pieces of ``size`` positions, and the two
        steps where it meets the rates before and behind it. Third shuffle: one summary per key and stretch."""
        first, last = F.get("points", F.lit(0)), F.get("points", F.size("points") - 1)
        values = self.table.select("key", "stretch", first.alias("first"), last.alias("last"),
                                   F.when(F.size("points") > 0, self._dense(F.col("points"), first["i"], last["i"])).alias("_v"))
        here = values.select("key", "stretch", "first", "last", (F.size("_v") > 1).alias("_many"), (F.try_divide(F.get("_v", F.lit(1)), F.get("_v", F.lit(0))) - 1).alias("_head"),
                             _sums(F.slice("_v", 2, F.greatest(F.size("_v") - 1, F.lit(0))), F.get("_v", F.lit(0)), F.lit(None).cast("double")).alias("_s"))
        w = Window.partitionBy("key").orderBy("stretch")
        a, b = F.col("_a"), F.col("first")
        rate = lambda i: F.try_divide(self._line(a, b, i), self._line(a, b, i - 1)) - 1
        led = here.withColumn("_a", F.lag("last").over(w))
        led = led.withColumn("_into", F.when(a.isNotNull(), rate(b["i"])))
        # with a single point, the last rate of a stretch is that of the line into it
        led = led.withColumn("_before", F.lag(F.when(F.col("_many"), F.col("_s.rate")).otherwise(F.col("_into"))).over(w))

        def piece(s: Column) -> Column:
            steps = F.transform(F.sequence(s, F.least(s + (self.size - 1), b["i"])), lambda i: self._line(a, b, i))
            return _sums(steps, self._line(a, b, s - 1), F.when(s == a["i"] + 1, F.col("_before")).otherwise(rate(s - 1)))

        pieces = F.when(a.isNotNull(), F.transform(F.sequence(a["i"] + 1, b["i"], F.lit(self.size).cast("bigint")), piece))
        led = led.withColumn("_pieces", F.coalesce(pieces, F.array().cast("array<struct<value: double, rate: double, num: double, den: double>>")))
        total = lambda name: F.aggregate(F.col("_pieces"), F.lit(0.0), lambda acc, p: acc + p[name])
        junction = F.when(F.col("_many") & a.isNotNull(), F.col("_head") - F.col("_into"))
        summed = led.groupBy("key").agg(
            F.sum(F.coalesce("_s.num", F.lit(0.0)) + total("num") + F.coalesce(junction * junction, F.lit(0.0))).alias("_num"),
            F.sum(F.coalesce("_s.den", F.lit(0.0)) + total("den")).alias("_den"))
        return summed.select("key", F.when(F.col("_den") != 0, F.col("_num") / F.col("_den")).alias(out))


def _sums(values: Column, before: Column, rate_before: Column) -> Column:
    """struct (value, rate, num, den) after walking over ``values``: the last value and rate, the squared differences of
    successive rates and the squared rates; null rates are skipped."""
    def step(acc: Column, v: Column) -> Column:
        rate = F.try_divide(v, acc["value"]) - 1
        change = rate - acc["rate"]
        return F.struct(v.alias("value"), rate.alias("rate"), (acc["num"] + F.coalesce(change * change, F.lit(0.0))).alias("num"),
                        (acc["den"] + F.coalesce(rate * rate, F.lit(0.0))).alias("den"))

    return F.aggregate(values, F.struct(before.alias("value"), rate_before.alias("rate"), F.lit(0.0).alias("num"), F.lit(0.0).alias("den")), step)


# --------------------------------------------------------------------------- stretches
def _stretches(df: DataFrame, ts: str, stretch: int) -> DataFrame:
    return df.withColumn("_t", epoch_seconds(F.col(ts)).cast("double")).withColumn("_b", F.floor(F.col("_t") / stretch))


def _carry(x: DataFrame, key: str, table: DataFrame) -> DataFrame:
    """``x`` with the columns that ``table`` has for its key and stretch; a null key is a key."""
    other = table.withColumnRenamed(key, "_ck").withColumnRenamed("_b", "_cb")
    return x.join(other, F.col(key).eqNullSafe(F.col("_ck")) & (F.col("_b") == F.col("_cb")), "left").drop("_ck", "_cb")


# --------------------------------------------------------------------------- T3
def fill(df: DataFrame, method: str = "linear", *, key: str = "key", ts: str = "ts",
         value: str = "value", stretch: int = STRETCH) -> DataFrame:
    """Fill gaps inside each series; leading and trailing gaps stay null."""
    if method != "linear":
        raise ValueError("only linear filling is defined")
    v = F.col(value)
    x = _stretches(df, ts, stretch).withColumn(
        "_k", F.when(v.isNotNull(), F.struct(F.col("_t").alias("t"), v.cast("double").alias("v"))))
    ends = x.groupBy(key, "_b").agg(F.min("_k").alias("_first"), F.max("_k").alias("_last"))
    up_to_here = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    over_key = Window.partitionBy(key)
    borders = ends.select(
        key, "_b", F.last("_last", True).over(up_to_here(over_key.orderBy("_b"))).alias("_before"),
        F.last("_first", True).over(up_to_here(over_key.orderBy(F.col("_b").desc()))).alias("_after"))
    x = _carry(x, key, borders)
    inside = Window.partitionBy(key, "_b")
    # the next known value is the last one of the rows in descending order
    p = F.coalesce(F.last("_k", True).over(up_to_here(inside.orderBy("_t"))), F.col("_before"))
    n = F.coalesce(F.last("_k", True).over(up_to_here(inside.orderBy(F.col("_t").desc()))), F.col("_after"))
    x = x.withColumn("_p", p).withColumn("_n", n)
    line = F.col("_p.v") + (F.col("_n.v") - F.col("_p.v")) * (F.col("_t") - F.col("_p.t")) / (F.col("_n.t") - F.col("_p.t"))
    filled = F.when(v.isNotNull(), v).otherwise(line)
    return x.select(*[filled.alias(c) if c == value else F.col(c) for c in df.columns])


def _with_previous(df: DataFrame, key: str, ts: str, value: str, stretch: int) -> DataFrame:
    """Add ``_prev``: struct (t, v) of the row before in the series, null for its first row."""
    x = _stretches(df, ts, stretch)
    row = F.struct(F.col("_t").alias("t"), F.col(value).alias("v"))
    ends = x.groupBy(key, "_b").agg(F.max(row).alias("_last"))
    borders = ends.select(key, "_b", F.lag("_last").over(Window.partitionBy(key).orderBy("_b")).alias("_before"))
    x = _carry(x, key, borders)
    inside = Window.partitionBy(key, "_b").orderBy("_t")
    return x.withColumn("_prev", F.coalesce(F.lag(row).over(inside), F.col("_before")))


# --------------------------------------------------------------------------- T4
def return_rates(df: DataFrame, *, key: str = "key", ts: str = "ts", value: str = "value",
                 out: str = "rate", stretch: int = STRETCH) -> DataFrame:
    """``v_t / v_(t-1) - 1`` per series; the first instant is dropped."""
    x = _with_previous(df, key, ts, value, stretch).where(F.col("_prev").isNotNull())
    return x.select(key, ts, (F.try_divide(F.col(value), F.col("_prev.v")) - 1).alias(out))


# --------------------------------------------------------------------------- T5
def durbin_watson(df: DataFrame, *, key: str = "key", ts: str = "ts", value: str = "rate",
                  out: str = "dw", stretch: int = STRETCH) -> DataFrame:
    """``sum((e_t - e_(t-1))^2) / sum(e_t^2)`` per series; nulls skipped, 0/0 -> null."""
    x = _with_previous(df, key, ts, value, stretch)
    step = x.select(key, F.col(value).alias("_e"), (F.col(value) - F.col("_prev.v")).alias("_d"))
    agg = step.groupBy(key).agg(F.sum(F.col("_d") * F.col("_d")).alias("_num"),
                                F.sum(F.col("_e") * F.col("_e")).alias("_den"))
    return agg.select(key, F.when(F.col("_den") != 0, F.col("_num") / F.col("_den")).alias(out))
