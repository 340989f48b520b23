"""Benchmark: the six dashboard questions on the base path and on the aggregate path.

Steps (one Spark session, local[$BENCH_CPUS], data at $BENCH_SF_DIR):
  1. load      derive the eleven finance tables from the driver tables and write them
               as Parquet (journal partitioned by fiscal year) — the bulk-load step;
  2. aggregate build the monthly aggregate from the stored journal and write it;
  3. queries   each question: one cold run, then the median of warm runs, measured
               client-side including result fetch, on both paths.
Also reports the base/aggregate time ratio, the aggregate reduction factor, shuffle
exchanges per question (from the physical plan) and shuffle bytes per question
(from the Spark event log in the scratch folder).

Prints one JSON line.
"""

from __future__ import annotations

import contextlib
import glob
import io
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

BENCH = [
    ("pl_actuals_full", "bench_pl_actuals_full", "bench_pl_actuals_full_agg"),
    ("pl_actuals_one_year", "bench_pl_actuals_one_year", "bench_pl_actuals_one_year_agg"),
    ("budget_variance_one_year", "bench_budget_variance_one_year", "bench_budget_variance_one_year_agg"),
    ("programme_runrate", "programme_runrate", "programme_runrate_from_agg"),
    ("close_monitor", "bench_close_monitor", None),
    ("fx_impact", "bench_fx_impact", "bench_fx_impact_agg"),
]
WARM_RUNS = int(os.environ.get("BENCH_WARM_RUNS", "5"))


def _session(cpus: int, scratch: str) -> SparkSession:
    events = os.path.join(scratch, "events")
    os.makedirs(events, exist_ok=True)
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ledgerflow-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(max(cpus * 2, 8)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", "file://" + events)
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.rolling.enabled", "false")
        .config("spark.checkpoint.dir", os.path.join(scratch, "checkpoints"))
        .getOrCreate()
    )


def _exchanges(df) -> dict:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    plan = buf.getvalue()
    return {
        "shuffle": plan.count("Exchange hashpartitioning") + plan.count("Exchange SinglePartition")
        + plan.count("Exchange rangepartitioning"),
        "broadcast": plan.count("BroadcastExchange"),
    }


def _timed(spark, label: str, build) -> tuple[float, int]:
    spark.sparkContext.setJobDescription(label)
    t0 = time.perf_counter()
    rows = build().collect()
    dt = time.perf_counter() - t0
    spark.sparkContext.setJobDescription(None)
    return dt, len(rows)


def _shuffle_bytes(scratch: str) -> dict:
    """Sum shuffle bytes written per job description from the event log."""
    files = [p for p in glob.glob(os.path.join(scratch, "events", "**"), recursive=True) if os.path.isfile(p)]
    stage_label, out = {}, {}
    for path in files:
        with open(path) as fh:
            for line in fh:
                if '"SparkListenerJobStart"' in line:
                    ev = json.loads(line)
                    label = (ev.get("Properties") or {}).get("spark.job.description")
                    if label:
                        for sid in ev.get("Stage IDs", []):
                            stage_label[sid] = label
                elif '"SparkListenerTaskEnd"' in line:
                    ev = json.loads(line)
                    label = stage_label.get(ev.get("Stage ID"))
                    if not label:
                        continue
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
                    out[label] = out.get(label, 0) + int(m.get("Shuffle Bytes Written", 0))
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    scratch = tempfile.mkdtemp(prefix="ledgerflow-bench-")
    spark = _session(cpus, scratch)
    spark.sparkContext.setLogLevel("ERROR")

    from ledgerflow.operators import materialise
    from ledgerflow.plans.catalog import QUERIES
    from ledgerflow.plans.context import Ctx
    from ledgerflow.sources.demo import DemoLedger
    from ledgerflow.sources.files import ParquetLedger, materialise_ledger

    tables = os.path.join(scratch, "tables")
    t0 = time.perf_counter()
    spark.sparkContext.setJobDescription("load")
    materialise_ledger(DemoLedger(spark, sf_dir), tables)
    load_sec = time.perf_counter() - t0

    t0 = time.perf_counter()
    spark.sparkContext.setJobDescription("aggregate_build")
    base_ledger = ParquetLedger(spark, tables)
    materialise.write_aggregate(materialise.agg_journal_monthly(Ctx(spark, ledger_obj=base_ledger).vj),
                                os.path.join(tables, "agg_journal_monthly"))
    agg_sec = time.perf_counter() - t0
    spark.sparkContext.setJobDescription(None)

    agg_ledger = ParquetLedger(spark, tables)
    journal_rows = agg_ledger.journal.count()
    agg_rows = agg_ledger.agg_journal_monthly.count()

    def builder(name, ledger_obj, use_agg):
        def build():
            ctx = Ctx(spark, ledger_obj=ledger_obj)
            if not use_agg:
                # base path: never read the stored aggregate
                ctx.__dict__["agg"] = materialise.agg_journal_monthly(ctx.vj)
            return QUERIES[name].build(ctx)
        return build

    warm, cold, rows, exchanges, builders = {}, {}, {}, {}, {}
    for question, base_name, agg_name in BENCH:
        for path, name, ledger_obj in (("base", base_name, base_ledger), ("agg", agg_name, agg_ledger)):
            if name is None:
                name, ledger_obj = base_name, agg_ledger  # question has no aggregate variant
            builders[f"{question}_{path}"] = builder(name, ledger_obj, path == "agg")
    for key, b in builders.items():  # every question on both paths once, before any is timed warm
        exchanges[key] = _exchanges(b())
        c, n = _timed(spark, key + ":cold", b)
        cold[key], rows[key] = round(c, 4), n
    runs: dict[str, list[float]] = {key: [] for key in builders}
    for k in range(WARM_RUNS):  # paths take turns, and so does which of them goes first
        for key in sorted(builders, reverse=bool(k % 2)):
            runs[key].append(_timed(spark, key, builders[key])[0])
    warm = {key: round(statistics.median(r), 4) for key, r in runs.items()}

    spark.stop()
    shuffle = _shuffle_bytes(scratch)
    base_total = sum(v for k, v in warm.items() if k.endswith("_base"))
    agg_total = sum(v for k, v in warm.items() if k.endswith("_agg"))
    result = {
        "metric": "dashboard_warm_sec_sum_agg_path",
        "value": round(agg_total, 4),
        "unit": "sec",
        "queries": warm,
        "sf": sf_dir.rstrip("/").split("sf")[-1],
        "cold": cold,
        "rows": rows,
        "base_path_warm_sec_sum": round(base_total, 4),
        "base_over_agg_ratio": round(base_total / agg_total, 3) if agg_total else None,
        "load_sec": round(load_sec, 3),
        "aggregate_build_sec": round(agg_sec, 3),
        "journal_rows": journal_rows,
        "aggregate_rows": agg_rows,
        "aggregate_reduction_factor": round(journal_rows / agg_rows, 2) if agg_rows else None,
        "exchanges": exchanges,
        "shuffle_bytes_per_warm_run": {k: v // max(WARM_RUNS, 1) for k, v in shuffle.items()
                                       if ":" not in k and k not in ("load", "aggregate_build")},
        "shuffle_bytes_load": shuffle.get("load", 0),
        "cpus": cpus,
        "warm_runs": WARM_RUNS,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
