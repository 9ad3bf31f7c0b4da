"""Spark session helpers.

The library never builds its own session inside an operator; callers pass one in.
These helpers are for scripts, tests and the bench: they apply the settings the
operators are designed around (AQE on, UTC, no UI) and make sure a reliable
checkpoint directory exists for the iterative jobs.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(app: str = "logweave", master: str | None = None,
              shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint directory.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is.
    Only when it is unset and everything runs in this one process (a local master, as in
    tests) a fresh scratch folder is made; on any other master that is an error, as
    executors could not read each other's files.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # remote session: the server's checkpoint settings apply
        return spark.conf.get("spark.checkpoint.dir", "") or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError(f"spark.checkpoint.dir must name a folder shared by all executors of {sc.master}")
        configured = tempfile.mkdtemp(prefix="logweave-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss); never a local one."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once to the checkpoint directory and read from there, as Parquet: compressed and by column, where a
    checkpoint holds whole rows. For tables of raw or encoded rows that several passes read."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def default_parallelism(spark: SparkSession) -> int:
    """Task slots of the cluster; falls back to the shuffle partition count when the
    session exposes no SparkContext (e.g. a remote session)."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:
        return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def spread(df: DataFrame, rows_per_task: int = 250_000) -> DataFrame:
    """The rows dealt evenly over the task slots, and over more tasks past a bound of rows for each, so that a task's
    memory does not grow with the table. Counts the rows: call it on a table that is cheap to read."""
    return df.repartition(max(default_parallelism(df.sparkSession), -(-df.count() // rows_per_task)))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
