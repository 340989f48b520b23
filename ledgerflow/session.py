"""SparkSession construction and lineage-cutting helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "ledgerflow") -> SparkSession:
    """Session with AQE and UTC timestamps; the web UI stays off."""
    master = master or os.environ.get("LEDGERFLOW_MASTER", "local[*]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.ui.retainedExecutions", "50")
        .config("spark.driver.memory", os.environ.get("LEDGERFLOW_DRIVER_MEMORY", "8g"))
    )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder: the cluster's shared ``spark.checkpoint.dir``.

    On a cluster the setting names a shared folder and is used as is.  Only when
    it is unset (local tests) a scratch folder is registered for this context.
    """
    sc = spark.sparkContext
    current = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        current = tempfile.mkdtemp(prefix="ledgerflow-ckpt-")
        sc.setCheckpointDir(current)
    return current


#: Rows that a task sorts in memory; work on more rows gets more tasks.
TASK_ROWS = 1 << 18
_SHUFFLE = "spark.sql.shuffle.partitions"


def tasks_for(spark: SparkSession, rows: int) -> int:
    """Tasks for a step over ``rows`` rows: one a core, more where those would get over TASK_ROWS each."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))


@contextmanager
def shuffles_for(spark: SparkSession, rows: int) -> Iterator[None]:
    """Shuffles of the queries that run inside get at least ``tasks_for(rows)`` partitions, never fewer than are set."""
    before = spark.conf.get(_SHUFFLE)
    spark.conf.set(_SHUFFLE, str(max(int(before), tasks_for(spark, rows))))
    try:
        yield
    finally:
        spark.conf.set(_SHUFFLE, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored_table(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared checkpoint folder and read it back (for wide frames)."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
