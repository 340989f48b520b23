"""Incremental refresh of the monthly aggregate from new journal files (Structured Streaming).

New journal files land in a folder; ``start_refresh`` reads them with
``readStream`` (fixed journal schema, no inference) and, per micro-batch,
harmonises only the new lines against the broadcast master data and
aggregates them to the monthly-aggregate grain.  Every aggregate measure is a
sum or a count, so a batch's contribution is a *delta* that merges exactly:
the served aggregate is ``base ∪ deltas`` re-aggregated on the grain keys.

Fault tolerance: each micro-batch writes its delta to ``deltas/batch_id=<id>``
with ``mode("overwrite")``, so a batch replayed after a failure (same id,
same input files, recorded in the stream checkpoint) replaces its own output
instead of adding it twice.  ``compact`` folds the deltas into a new version of the
base, whose commit names the batches it holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import ledger, materialise
from ..sources import versions

MEASURES = [
    "signed_amount_group", "signed_amount_at_actual", "signed_amount_at_budget", "gross_amount_at_budget",
    "amount_manual", "line_count", "line_count_manual", "line_count_late", "line_count_special_period",
]
_COUNTS = {"line_count", "line_count_manual", "line_count_late", "line_count_special_period"}


def batch_delta(lines: DataFrame, dims) -> DataFrame:
    """Monthly-aggregate contribution of a set of new journal lines."""
    vj = ledger.harmonised_journal(lines, dims.company, dims.gl_account, dims.cost_center, dims.programme,
                                   dims.rates, dims.close_tasks)
    return materialise.agg_journal_monthly(vj)


def merge_aggregates(*parts: DataFrame) -> DataFrame:
    """Re-aggregate additive aggregate rows on the grain keys (NULL keys group together)."""
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy(*materialise.AGG_KEYS).agg(
        *[(F.sum(m).cast("long") if m in _COUNTS else F.sum(m)).alias(m) for m in MEASURES])


def start_refresh(spark: SparkSession, incoming: str, dims, deltas_path: str, checkpoint: str,
                  available_now: bool = True):
    """Start the streaming refresh; returns the ``StreamingQuery``."""
    stream = spark.readStream.schema(schemas.SCHEMAS["journal"]).parquet(incoming)

    def process(batch: DataFrame, batch_id: int) -> None:
        batch_delta(batch, dims).write.mode("overwrite").parquet(f"{deltas_path.rstrip('/')}/batch_id={batch_id}")

    writer = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def _batches(spark: SparkSession, deltas_path: str) -> dict[str, str]:
    """Name and path of the delta batches that are written as a whole, in any file system that Spark reads."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{deltas_path.rstrip('/')}/batch_id=*/_SUCCESS")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return {f.getPath().getParent().getName(): f.getPath().getParent().toString() for f in found or ()}


def _folded(spark: SparkSession, base_path: str) -> list[str]:
    """Names of the batches that a base holds already, as its commit says."""
    done = versions.commits(spark, base_path)
    return done[-1].get("folded", []) if done else []


def _open_batches(spark: SparkSession, base_path: str, deltas_path: str) -> dict[str, str]:
    held = set(_folded(spark, base_path))
    return {n: p for n, p in sorted(_batches(spark, deltas_path).items()) if n not in held}


def served_aggregate(spark: SparkSession, base_path: str, deltas_path: str) -> DataFrame:
    """Base aggregate plus all deltas that are not folded into it yet, merged."""
    return _merged(spark, base_path, _open_batches(spark, base_path, deltas_path))


def _merged(spark: SparkSession, base_path: str, batches: dict[str, str]) -> DataFrame:
    base = versions.read_table(spark, base_path)
    if not batches:
        return base
    deltas = spark.read.parquet(*batches.values())
    return merge_aggregates(base.select(*materialise.AGG_KEYS, *MEASURES),
                            deltas.select(*materialise.AGG_KEYS, *MEASURES))


def compact(spark: SparkSession, base_path: str, deltas_path: str, new_base_path: str) -> None:
    """Fold the deltas into a new base aggregate (partitioned by fiscal year) and retire them.

    The batches are listed once.  The new base's commit names those it holds, so each counts once whatever
    lands meanwhile and wherever a crash falls; moving them to ``<deltas_path>-folded`` afterwards only tidies up.
    """
    batches = _open_batches(spark, base_path, deltas_path)
    merged = _merged(spark, base_path, batches)
    versions.replace_table(merged, new_base_path, ["fiscal_year"], {"folded": [*_folded(spark, base_path), *batches]})
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    folded = hadoop.Path(f"{deltas_path.rstrip('/')}-folded")
    fs = folded.getFileSystem(conf)
    fs.mkdirs(folded)
    for b in batches.values():
        fs.rename(hadoop.Path(b), hadoop.Path(folded, hadoop.Path(b).getName()))
