"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most keys that can each hold more than 1/HEAVY_SHARE of the rows.
HEAVY_SHARE = 1000


#: Rows of one Arrow batch of whole texts; with few kilobytes a text a batch stays small.
TEXT_BATCH_ROWS = 512


def text_batches(df: DataFrame) -> DataFrame:
    """``df``, after lowering the session's Arrow batches to TEXT_BATCH_ROWS rows where they are larger."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key, "10000")) <= TEXT_BATCH_ROWS:
        conf.set(key, str(TEXT_BATCH_ROWS))
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors share.

    Only where the setting is absent (tests on one machine) a scratch folder is set.
    """
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        folder = tempfile.mkdtemp(prefix="ledgerflow-shared-")
        sc.setCheckpointDir(folder)
    return folder


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back (cuts lineage)."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint for narrow intermediate frames; files go once unused."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def join_keyed(rows: DataFrame, keyed: DataFrame, key: str, size: str, total: int,
               how: str = "inner") -> DataFrame:
    """Join ``rows`` to ``keyed`` (one row a key, ``size`` = rows of that key) without a hot task.

    At most HEAVY_SHARE keys can each hold more than ``total / HEAVY_SHARE`` rows; those,
    a proven bound, are broadcast, and every other key is small enough for a shuffle.
    ``how`` is ``inner`` or ``left``.  ``key`` must not be null.
    """
    limit = max(1, total // HEAVY_SHARE)
    heavy = keyed.where(F.col(size) > limit)
    light = keyed.where(F.col(size) <= limit)
    marked = rows.join(F.broadcast(heavy.select(key, F.lit(True).alias("__heavy"))), key, "left")
    hot = marked.where("__heavy").drop("__heavy").join(F.broadcast(heavy), key, "inner")
    cold = marked.where("__heavy is null").drop("__heavy").join(light, key, how)
    return hot.unionByName(cold)
