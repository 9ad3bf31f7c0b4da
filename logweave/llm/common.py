"""Small shared expressions of the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of anything but space and the ASCII controls tab..carriage return.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lower_az(col: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(col, UPPER, UPPER.lower())


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def id_crc_mod(name: str, n: int) -> Column:
    """crc32 of the id's decimal text, modulo n; null for a null id."""
    return F.crc32(F.col(name).cast("string").cast("binary")) % n
