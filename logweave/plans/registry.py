"""Registry of the named queries exposed through ``__spark_entry__``.

Each query is a function ``(spark, sf_dir) -> DataFrame`` over the given tables;
most carry an equivalent DuckDB SQL string used as the correctness oracle.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass
class Query:
    name: str
    fn: QueryFn
    sql: str | None
    ops: tuple[str, ...]


REGISTRY: dict[str, Query] = {}


def query(name: str, *, sql: str | None = None, ops: tuple[str, ...] = ()):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql.strip() if sql else None, ops)
        return fn
    return deco


def noncapturing_prefix(pattern: str, k: int) -> str:
    """Turn the first ``k`` capturing groups of a regex into non-capturing ones.

    Only for oracle SQL: DuckDB's regexp_extract accepts group numbers 0..9, so a
    later group is reached by making the earlier groups non-capturing.
    """
    out, i, n, in_class = [], 0, len(pattern), False
    while i < n:
        ch = pattern[i]
        if ch == "\\":
            out.append(pattern[i:i + 2])
            i += 2
            continue
        if in_class:
            in_class = ch != "]"
        elif ch == "[":
            in_class = True
        elif ch == "(" and k > 0 and not pattern.startswith("(?", i):
            out.append("(?:")
            k -= 1
            i += 1
            continue
        out.append(ch)
        i += 1
    return "".join(out)
