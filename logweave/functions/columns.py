"""Column-level building blocks (Column -> Column).

Everything here is a native Spark expression, so it stays inside whole-stage
codegen and also works on streaming DataFrames.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separator and match marker used to carry all capture groups of one regex match
# through a single regexp_replace (see regex_groups).
_SEP = "\u0001"
_MARK = "\u0002"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def quoted(sep: str) -> str:
    """A regex that matches ``sep`` literally."""
    return re.escape(sep)


def _shift_references(pattern: str) -> str:
    """The pattern with each back-reference raised by one, for an extra group around it."""
    return re.sub(r"(?<!\\)((?:\\\\)*)\\([1-9][0-9]*)", lambda m: f"{m[1]}\\{int(m[2]) + 1}", pattern)


def _wrapped(pattern: str, n_groups: int) -> tuple[str, str]:
    wrapped = "^[\\s\\S]*?(" + _shift_references(pattern) + ")[\\s\\S]*$"
    repl = _MARK + _SEP.join(f"${i}" for i in range(1, n_groups + 2))
    return wrapped, repl


def regex_match(col: str | Column, pattern: str, n_groups: int) -> Column:
    """All capture groups of the first match of ``pattern``, in one regex pass.

    Returns ``array<string>`` of length ``n_groups + 1`` (element 0 = whole match,
    element i = group i, '' for a group that took no part), or null when the
    pattern is not found or the input is null. The pattern is wrapped as
    ``^lazy-prefix (P) rest$``: the lazy prefix tries start positions left to
    right exactly like ``find``, so the groups equal ``regexp_extract(col, pattern, i)``,
    but the line is scanned once instead of once per group. A text that itself holds one
    of the two control characters used as marks is matched group by group instead.
    """
    wrapped, repl = _wrapped(pattern, n_groups)
    c = _c(col)
    replaced = F.regexp_replace(c, F.lit(wrapped), F.lit(repl))
    body = replaced.substr(F.lit(2), F.length(replaced))
    at_once = F.when(replaced.startswith(_MARK), F.split(body, _SEP, -1))
    singly = F.when(c.rlike(pattern), F.array(*[F.regexp_extract(c, pattern, i) for i in range(n_groups + 1)]))
    return F.when(c.contains(_MARK) | c.contains(_SEP), singly).otherwise(at_once)


def regex_groups(col: str | Column, pattern: str, n_groups: int) -> Column:
    """``regex_match`` with ``regexp_extract``'s conventions: '' for every group when
    there is no match, null for a null input."""
    return (F.when(_c(col).isNull(), F.lit(None))
            .otherwise(F.coalesce(regex_match(col, pattern, n_groups),
                                  F.array_repeat(F.lit(""), n_groups + 1))))


def split_get(col: str | Column, sep: str, idx: int) -> Column:
    """0-based token of a split at a literal separator; null (not an error) when absent."""
    return F.get(F.split(_c(col), quoted(sep), -1), idx)


def to_double_array(col: str | Column, sep: str = " ") -> Column:
    """Split text into numbers; tokens that are not numbers become null."""
    return F.transform(F.split(_c(col), quoted(sep), -1), lambda x: x.try_cast("double"))


def non_negative(col: str | Column) -> Column:
    """Negative numbers become 0; null stays null."""
    c = _c(col)
    return F.when(c < 0, F.lit(0)).otherwise(c)


#: Width of ``hash_value``: 15 hex digits of the md5.
HASH_RANGE = 1 << 60


def hash_value(key_cols: list[str | Column], seed: int) -> Column:
    """Deterministic integer in [0, 2**60) from md5 of ``seed|key``.

    md5 is computed the same way in Spark and DuckDB, does not depend on partition
    layout, and so gives a reproducible split on any cluster size; the range is wide
    enough for any fraction.
    """
    key = F.concat_ws("|", F.lit(str(seed)), *[_c(k).cast("string") for k in key_cols])
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("bigint")
