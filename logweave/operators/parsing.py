"""Parsing and filtering operators (text lines and documents -> typed columns).

All are narrow transformations built from native expressions: no shuffle, no
Python per row, and they run unchanged on streaming DataFrames.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.columns import non_negative, quoted, regex_match, split_get, to_double_array
from ..functions.patterns import CLAIM_PHRASE, LogFormat, get_format


# --------------------------------------------------------------------------- P9
def parse_log(df: DataFrame, col: str, fmt: str | LogFormat,
              groups: Sequence[int] | None = None, *, matched_col: str | None = "matched",
              trim: bool = False, keep: Sequence[str] | None = None,
              on_mismatch: str = "empty") -> DataFrame:
    """Capture groups of a named log format as string columns.

    ``groups`` are 1-based group numbers (0 = whole match); default = the groups
    the original job emitted. A line that does not match gives ``''`` in every
    field (and ``matched = false``), like ``regexp_extract``; a null line gives nulls.
    ``on_mismatch="null"`` gives nulls instead of ``''`` for non-matching lines, and
    ``on_mismatch="drop"`` keeps matching lines only.

    The regex runs once per line: the match goes through a one-element
    ``explode`` (a Generate node). Without it, Catalyst would copy the parse
    expression into every pushed-down filter predicate on the fields and match
    each line several times.
    """
    f = get_format(fmt)
    groups = tuple(f.default_groups if groups is None else groups)
    names = ["match" if i == 0 else f.groups[i - 1] for i in groups]
    keep_cols = [F.col(c) for c in (keep if keep is not None else df.columns)]
    m = F.struct(regex_match(col, f.pattern, f.n_groups).alias("g"), F.col(col).isNull().alias("n"))
    x = df.select(*keep_cols, F.explode(F.array(m)).alias("_m"))
    if on_mismatch not in ("empty", "null", "drop"):
        raise ValueError(f"on_mismatch must be empty, null or drop, not {on_mismatch!r}")
    if on_mismatch == "drop":
        x = x.where(F.col("_m.g").isNotNull())
    out = []
    for i, n in zip(groups, names):
        v = F.get(F.col("_m.g"), i)
        v = v if on_mismatch == "null" else F.coalesce(v, F.lit(""))
        v = F.trim(v) if trim else v
        out.append(F.when(F.col("_m.n"), F.lit(None).cast("string")).otherwise(v).alias(n))
    sel = [F.col(name) for name in (keep if keep is not None else df.columns)] + out
    if matched_col:
        sel.append(F.col("_m.g").isNotNull().alias(matched_col))
    return x.select(*sel)


# --------------------------------------------------------------------------- F1/F2
def drop_unparsed(df: DataFrame, key: str, *, require_last: str | None = None) -> DataFrame:
    """Keep rows whose key field is non-empty (and, optionally, whose last field is)."""
    cond = F.col(key).isNotNull() & (F.col(key) != "")
    if require_last:
        cond = cond & F.col(require_last).isNotNull() & (F.col(require_last) != "")
    return df.filter(cond)


# --------------------------------------------------------------------------- P10
def key_by_group(df: DataFrame, key: str, values: Sequence[str], out: str = "value",
                 sep: str = ",", keep: Sequence[str] = ()) -> DataFrame:
    """One comma-joined value per row next to its key (tenant -> fields)."""
    return df.select(*keep, F.col(key).alias("key"), F.concat_ws(sep, *values).alias(out))


# --------------------------------------------------------------------------- P17
def split_tokens(df: DataFrame, col: str, sep: str = ",", out: str = "items",
                 distinct: bool = True) -> DataFrame:
    arr = F.split(F.col(col), quoted(sep), -1)
    return df.withColumn(out, F.array_distinct(arr) if distinct else arr)


# --------------------------------------------------------------------------- P16
def claim_columns(message: str | Column) -> tuple[Column, Column]:
    """(memory_mb, disk_gb) of an "Attempting claim: memory M MB, disk D GB" text."""
    m = F.col(message) if isinstance(message, str) else message
    parts = F.split(m, ",", -1)
    memory = split_get(F.get(parts, 0), " ", 3).try_cast("bigint")
    disk = split_get(F.get(parts, 1), " ", 2).try_cast("bigint")
    return memory, disk


def parse_claim(df: DataFrame, message: str = "message") -> DataFrame:
    memory, disk = claim_columns(message)
    return df.withColumn("memory_mb", memory).withColumn("disk_gb", disk)


def is_claim(message: str | Column, phrase: str = CLAIM_PHRASE) -> Column:
    m = F.col(message) if isinstance(message, str) else message
    return m.contains(phrase)


# --------------------------------------------------------------------------- P1/P2
def parse_labeled(df: DataFrame, col: str = "line", sep: str = ",", feature_sep: str = " ",
                  vector: bool = False) -> DataFrame:
    """``label,f1 f2 ...`` -> (label double, features). All features are kept.

    Without ``vector`` a bad token is a null in its place. A vector holds no nulls: with
    ``vector`` a row with a bad label or token is dropped (``count_bad`` counts them).
    """
    label = split_get(col, sep, 0).try_cast("double")
    rest = F.trim(split_get(col, sep, 1))
    feats = to_double_array(rest, feature_sep)
    out = df.select(label.alias("label"), feats.alias("features"))
    return to_vectors(out.where(F.col("label").isNotNull())) if vector else out


def parse_dense(df: DataFrame, col: str = "line", sep: str = " ", vector: bool = False) -> DataFrame:
    """Numbers of a line; bad tokens as in ``parse_labeled``."""
    feats = to_double_array(F.trim(F.col(col)), sep)
    out = df.select(feats.alias("features"))
    return to_vectors(out) if vector else out


def all_numbers(features: str | Column = "features") -> Column:
    """Whether an array is there and holds no null."""
    c = F.col(features) if isinstance(features, str) else features
    return F.coalesce(F.forall(c, lambda x: x.isNotNull()), F.lit(False))


def to_vectors(df: DataFrame, col: str = "features") -> DataFrame:
    """Arrays to vectors; rows with a null in the array (or no array) are dropped before."""
    return df.where(all_numbers(col)).withColumn(col, array_to_vector(col))


def count_bad(df: DataFrame, features: str = "features", label: str | None = None) -> DataFrame:
    """(n_rows, n_bad): rows that vector building drops."""
    good = all_numbers(features)
    if label:
        good = good & F.col(label).isNotNull()
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(~good).alias("n_bad"))


# --------------------------------------------------------------------------- P3
def parse_edges(df: DataFrame, col: str = "line", sep: str = " ") -> DataFrame:
    return df.select(split_get(col, sep, 0).try_cast("bigint").alias("src"),
                     split_get(col, sep, 1).try_cast("bigint").alias("dst"),
                     split_get(col, sep, 2).try_cast("double").alias("weight"))


# --------------------------------------------------------------------------- P4
def parse_category_text(df: DataFrame, col: str = "line", sep: str = ",",
                        keep: Sequence[str] = ()) -> DataFrame:
    """First two comma fields: (category, text); the rest of the line is ignored."""
    return df.select(*keep, split_get(col, sep, 0).alias("category"),
                     split_get(col, sep, 1).alias("text"))


# --------------------------------------------------------------------------- P5
def split_fields(df: DataFrame, col: str = "line", sep: str = ",", id_idx: int = 0,
                 label_idx: int = 1, cats: tuple[int, int] = (5, 14), nums_from: int = 15) -> DataFrame:
    """Positional field groups: id, label, categorical slice, numeric tail.

    A line is split once behind a one-element ``explode``: the groups, and filters on them, would each split it again."""
    fields = df.select(F.explode(F.array(F.split(F.col(col), quoted(sep), -1))).alias("_f"))
    arr = F.col("_f")
    n_cats = cats[1] - cats[0] + 1
    tail = F.slice(arr, nums_from + 1, F.greatest(F.size(arr) - nums_from, F.lit(0)))
    return fields.select(F.get(arr, id_idx).alias("id"),
                     F.get(arr, label_idx).try_cast("double").alias("label"),
                     F.slice(arr, cats[0] + 1, n_cats).alias("cats"),
                     F.transform(tail, lambda x: x.try_cast("double")).alias("nums"))


# --------------------------------------------------------------------------- P6
def parse_observations_tsv(df: DataFrame, col: str = "line", sep: str = "\t") -> DataFrame:
    """year, month, day, symbol, (unused), price -> (ts, key, value)."""
    arr = F.split(F.col(col), quoted(sep), -1)
    ts = F.try_make_timestamp_ntz(F.get(arr, 0).try_cast("int"), F.get(arr, 1).try_cast("int"),
                                  F.get(arr, 2).try_cast("int"), F.lit(0), F.lit(0), F.lit(0))
    return df.select(ts.alias("ts"), F.get(arr, 3).alias("key"),
                     F.get(arr, 5).try_cast("double").alias("value"))


# --------------------------------------------------------------------------- P7
def parse_log_observations(df: DataFrame, message: str = "message", host: str = "host",
                           version: str = "version") -> DataFrame:
    """Log line prefix ``yyyy-MM-dd HH:mm...`` -> minute timestamp, host, numeric version.

    The first two words are split off once behind a one-element ``explode``, so a
    filter on the timestamp is not rewritten into the whole line expression again.
    """
    head = F.slice(F.split(F.col(message), " ", 3), 1, 2)
    x = df.select(F.col(host).cast("string").alias("key"), F.col(version).try_cast("double").alias("value"),
                  F.explode(F.array(head)).alias("_w"))
    d = F.split(F.get(F.col("_w"), 0), "-", -1)
    t = F.split(F.get(F.col("_w"), 1), ":", -1)
    ts = F.try_make_timestamp_ntz(*(F.get(d, i).try_cast("int") for i in range(3)),
                                  F.get(t, 0).try_cast("int"), F.get(t, 1).try_cast("int"), F.lit(0))
    return x.select(ts.alias("ts"), "key", "value")


# --------------------------------------------------------------------------- P8
def json_fields(df: DataFrame, col: str, schema: StructType | str, keep: Sequence[str] = ()) -> DataFrame:
    """Typed fields out of a JSON text column (declared schema, no inference)."""
    parsed = F.from_json(F.col(col), schema)
    return df.select(*keep, parsed.alias("_j")).select(*keep, "_j.*")


# --------------------------------------------------------------------------- P11/P12/F5
def parse_metrics(df: DataFrame, feature_cols: Sequence[str], target: str,
                  threshold: float = 133.0, above: float = 0.0, below: float = 1.0,
                  vector: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """Numeric features + threshold label; a row with any bad number is dropped."""
    feats = [F.col(c).cast("string").try_cast("double") for c in feature_cols]
    t = F.col(target).cast("string").try_cast("double")
    out = df.select(*keep, F.array(*feats).alias("features"), t.alias("_t"))
    out = out.filter(F.forall("features", lambda x: x.isNotNull()) & F.col("_t").isNotNull())
    out = out.select(*keep, label_by_threshold(F.col("_t"), threshold, above, below).alias("label"),
                     "features")
    return out.withColumn("features", array_to_vector("features")) if vector else out


def label_by_threshold(col: str | Column, threshold: float, above: float = 0.0,
                       below: float = 1.0) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c > threshold, F.lit(float(above))).otherwise(F.lit(float(below)))


# --------------------------------------------------------------------------- P13
def clamp_non_negative(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    out = df
    for c in cols:
        t = dict(df.dtypes)[c]
        if t.startswith("array"):
            out = out.withColumn(c, F.transform(c, non_negative))
        else:
            out = out.withColumn(c, non_negative(c))
    return out


# --------------------------------------------------------------------------- P14/P15
def basket_from_fields(df: DataFrame, col: str = "line", sep: str = ",",
                       idx: Sequence[int] = (18, 19, 20)) -> DataFrame:
    arr = F.split(F.col(col), quoted(sep), -1)
    return df.select(F.array(*[F.get(arr, i) for i in idx]).alias("items"))


def basket_is_valid(items: str | Column) -> Column:
    """Every item's part after ``_`` starts with a digit and no two items share it."""
    a = F.col(items) if isinstance(items, str) else items
    values = F.transform(a, lambda x: F.get(F.split(x, "_", -1), 1))
    digit_ok = F.forall(values, lambda v: F.coalesce(v.rlike("^[0-9]"), F.lit(False)))
    unique = F.size(F.array_distinct(values)) == F.size(values)
    return digit_ok & unique


def validate_basket(df: DataFrame, items: str = "items") -> DataFrame:
    """Invalid baskets become empty (they still count in the support denominator)."""
    empty = F.array().cast(dict(df.dtypes)[items])
    return df.withColumn(items, F.when(basket_is_valid(items), F.col(items)).otherwise(empty))


# --------------------------------------------------------------------------- P18
def tokens(text: str | Column = "text") -> Column:
    """The one word rule of the library, that of ``ml.feature.Tokenizer``: lower case, split at
    every white-space character, empty words kept except at the end."""
    c = F.col(text) if isinstance(text, str) else text
    body = F.regexp_replace(F.lower(c), "\\s+$", "")
    blank = c.rlike("^\\s+$")
    return F.when(blank, F.array().cast("array<string>")).otherwise(F.split(body, "\\s", -1))


def tokenize(df: DataFrame, col: str = "text", out: str = "words") -> DataFrame:
    """Words of a text column, see ``tokens``."""
    return df.withColumn(out, tokens(col))


# --------------------------------------------------------------------------- P19
def with_positions(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """array<T> -> array<struct<pos int, value T>>."""
    return df.withColumn(out or col, F.transform(col, lambda x, i: F.struct(i.alias("pos"), x.alias("value"))))


# --------------------------------------------------------------------------- P20
def densify(df: DataFrame, col: str = "features", out: str | None = None) -> DataFrame:
    return df.withColumn(out or col, vector_to_array(F.col(col)))


# --------------------------------------------------------------------------- F4
def substrings(col: str | Column, min_len: Column | int, max_len: Column | int) -> Column:
    """All distinct substrings of length in [min_len, max_len] (bounded by the text)."""
    c = F.col(col) if isinstance(col, str) else col
    lo = F.lit(min_len) if isinstance(min_len, int) else min_len
    hi = F.lit(max_len) if isinstance(max_len, int) else max_len
    n = F.length(c)
    lens = F.sequence(F.greatest(lo, F.lit(1)), F.least(hi, n))
    per_len = F.transform(
        F.when(F.least(hi, n) >= F.greatest(lo, F.lit(1)), lens).otherwise(F.array().cast("array<int>")),
        lambda L: F.transform(F.sequence(F.lit(1), n - L + 1), lambda i: c.substr(i, L)))
    return F.array_distinct(F.flatten(per_len))


def filter_known_users(df: DataFrame, users: DataFrame, phrase: str | None = CLAIM_PHRASE,
                       key: str = "user_id", message: str = "message",
                       user_key: str = "user_id") -> DataFrame:
    """Rows whose user key *contains* a known user id and whose message contains
    ``phrase`` (the original's loose user match; the name lookup stays exact)."""
    out = df.where(F.col(message).contains(phrase)) if phrase else df
    return filter_contains_any(out, key, users, user_key)


def filter_contains_any(df: DataFrame, key: str, ids: DataFrame, id_col: str) -> DataFrame:
    """Rows whose ``key`` *contains* any value of ``ids[id_col]`` (exact, no cross join).

    Rewritten as an equi-join: a key contains id v iff one of its substrings of
    length len(v) equals v. Only the distinct keys are expanded, and only into
    substrings whose lengths occur among the ids, so the expansion is bounded by
    key length times the spread of id lengths; the join is a plain shuffle (or
    AQE broadcast) equi-join on the substring.
    """
    ids_d = ids.select(F.col(id_col).alias("_id")).where(F.col("_id").isNotNull() & (F.length("_id") > 0)).distinct()
    # two scalars (shortest and longest id) bound the expansion
    lo, hi = ids_d.agg(F.min(F.length("_id")), F.max(F.length("_id"))).first()
    if lo is None:
        return df.limit(0)
    keys = df.select(F.col(key).alias("_k")).where(F.col("_k").isNotNull()).distinct()
    expanded = keys.select("_k", F.explode(substrings("_k", int(lo), int(hi))).alias("_id"))
    hit = expanded.join(ids_d, "_id", "left_semi").select("_k").distinct()
    return df.join(hit, F.col(key) == F.col("_k"), "left_semi")
