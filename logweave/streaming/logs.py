"""Log parsing on streams.

The parsing and filtering operators are stateless column expressions, so they
apply unchanged to a streaming DataFrame. Running per-user claim totals are a
plain streaming aggregation (state kept by Structured Streaming in the
checkpoint location, so a restarted query resumes where it stopped).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.patterns import CLAIM_PHRASE
from ..operators.parsing import claim_columns, drop_unparsed, is_claim, parse_log


def read_line_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path).withColumnRenamed("value", "line")


def usage_stream(lines: DataFrame, line: str = "line", phrase: str = CLAIM_PHRASE) -> DataFrame:
    """Running totals per user (use output mode ``update`` or ``complete``)."""
    p = parse_log(lines, line, "compute", groups=(7, 10), keep=[], matched_col=None)
    p = drop_unparsed(p, "user_id").filter(is_claim("message", phrase))
    memory, disk = claim_columns("message")
    return p.groupBy("user_id").agg(F.sum(memory).alias("memory_mb"), F.sum(disk).alias("disk_gb"),
                                    F.count(F.lit(1)).alias("n_claims"))
