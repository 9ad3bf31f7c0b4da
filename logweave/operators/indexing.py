"""Dense consecutive row numbers without a single-partition window (W1, used by A8).

``row_number() over (order by ...)`` with no partition moves every row into one
task. Here rows are range-partitioned and sorted by the order columns, each row
gets (partition id, position in partition) from ``monotonically_increasing_id``,
and the per-partition row counts — one row per partition, a bounded table — are
turned into offsets and joined back by broadcast. The numbered table is
checkpointed to the reliable checkpoint directory first, because the range
bounds are sampled at run time and must not change between the two uses.
Nothing is gathered into one task: the per-partition counts (one number per
partition) are summed on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from ..session import cut_lineage, default_parallelism

_LOW_BITS = 33  # monotonically_increasing_id: partition id << 33 | record number


def with_row_id(df: DataFrame, order: Sequence[str | Column] | None = None, out: str = "row_id",
                num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = 0, 1, 2, ... in ``order`` (or in the current partition order)."""
    base = df
    if order:
        spark = df.sparkSession
        n = num_partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                                  default_parallelism(spark))
        # rows that tie are dealt out by a hash of the row, so that a frequent value is no single task
        hashed = [f.name for f in df.schema.fields if not isinstance(f.dataType, MapType)]
        keys = [*order, F.xxhash64(*hashed)]
        base = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    ided = cut_lineage(base.withColumn("_mid", F.monotonically_increasing_id()))
    pid = F.shiftright(F.col("_mid"), _LOW_BITS)
    # one count per partition (a table bounded by the partition count): its prefix
    # sums are the partitions' first row ids, joined back by broadcast
    counts = sorted(tuple(r) for r in ided.groupBy(pid.alias("_pid")).count().collect())
    rows, acc = [], 0
    for p, c in counts:
        rows.append((int(p), acc))
        acc += int(c)
    offsets = df.sparkSession.createDataFrame(rows, "_pid long, _off long")
    local = F.col("_mid").bitwiseAND(F.lit((1 << _LOW_BITS) - 1))
    return (ided.join(F.broadcast(offsets), pid == F.col("_pid"))
            .withColumn(out, F.col("_off") + local)
            .drop("_mid", "_pid", "_off"))
