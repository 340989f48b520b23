"""Per-query context: the demo ledger plus the derived layers every KPI shares."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from .. import config
from ..operators import kpis, ledger, materialise
from ..sources.demo import demo_ledger


class Ctx:
    """Lazily derived layers (L2 harmonised journal, close tasks, variance, aggregate).

    ``ledger`` may be a ``DemoLedger`` (derived from the driver tables) or any
    object exposing the eleven finance tables as attributes (e.g. a ledger
    read from materialised Parquet).
    """

    def __init__(self, spark: SparkSession, sf_dir: str | None = None, ledger_obj=None):
        self.spark = spark
        self.L = ledger_obj if ledger_obj is not None else demo_ledger(spark, sf_dir)

    @cached_property
    def vj(self) -> DataFrame:
        L = self.L
        # The harmonised journal only needs programme id, name and type: take them from the
        # master data when the ledger has it (the demo programme table also carries a budget
        # derived from the journal, which would be a second journal derivation).
        programme = getattr(L, "programme_master", None)
        if programme is None:
            programme = L.programme
        return ledger.harmonised_journal(L.journal, L.company, L.gl_account, L.cost_center, programme,
                                         L.rates, getattr(L, "close_schedule", None) or L.close_tasks)

    @cached_property
    def tasks_h(self) -> DataFrame:
        return kpis.close_tasks_harmonised(self.L.close_tasks, self.L.close_task, self.L.dim_date)

    @cached_property
    def budget_cells(self) -> DataFrame:
        return kpis.budget_cells(self.L.budget)

    @cached_property
    def variance(self) -> DataFrame:
        return kpis.budget_variance(kpis.actual_lines(self.vj), self.budget_cells)

    @cached_property
    def agg(self) -> DataFrame:
        agg_df = getattr(self.L, "agg_journal_monthly", None)
        return agg_df if agg_df is not None else materialise.agg_journal_monthly(self.vj)

    def runrate(self, year: int = config.AS_OF_YEAR, period: int = config.AS_OF_PERIOD,
                window: int = config.RUNRATE_WINDOW) -> DataFrame:
        return kpis.programme_runrate(self.vj, self.L.programme, year, period, window)

    @cached_property
    def ic(self) -> DataFrame:
        return kpis.ic_reconciliation(self.vj)

    @cached_property
    def forecast_rows(self) -> DataFrame:
        return kpis.forecast_accuracy_rows(self.vj, self.L.forecast)
