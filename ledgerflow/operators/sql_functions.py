"""Table functions that ``spark.sql`` can call."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import config

# Decimal types are chosen so that each division keeps more places than it is rounded to.
_RUNRATE = """
CREATE OR REPLACE TEMPORARY FUNCTION {name}(as_of_year INT, as_of_period INT, window_periods INT)
RETURNS TABLE (programme_id STRING, programme_name STRING, programme_type STRING, as_of_fiscal_year INT, as_of_fiscal_period INT,
               actuals_to_date DECIMAL(28, 2), run_rate DECIMAL(26, 8), remaining_periods INT, eac DECIMAL(30, 8),
               total_budget_eur DECIMAL(28, 2), eac_vs_budget_pct DOUBLE)
RETURN
  WITH recent AS (
    SELECT programme_id, period_cost, CASE WHEN recency <= window_periods THEN period_cost END AS recent_cost
    FROM (SELECT *, row_number() OVER (PARTITION BY programme_id ORDER BY period_key DESC) AS recency
          FROM (SELECT programme_id, fiscal_year * 100 + fiscal_period AS period_key, sum(signed_amount_group) AS period_cost
                FROM {journal}
                WHERE programme_id IS NOT NULL AND fiscal_period <= 12
                  AND fiscal_year * 100 + fiscal_period <= as_of_year * 100 + as_of_period
                GROUP BY ALL))
  ), sums AS (
    SELECT programme_id, sum(period_cost) AS actuals, sum(recent_cost) AS recent_sum, count(recent_cost) AS n
    FROM recent GROUP BY programme_id
  ), rates AS (
    SELECT p.programme_id, p.programme_name, p.programme_type, CAST(s.actuals AS DECIMAL(28, 2)) AS actuals,
           CAST(round(CAST(s.recent_sum AS DECIMAL(20, 2)) / CAST(nullif(s.n, 0) AS DECIMAL(16, 0)), 8) AS DECIMAL(26, 8)) AS run_rate,
           greatest(0, (year(p.end_date) - as_of_year) * 12 + month(p.end_date) - as_of_period) AS remaining, p.total_budget_eur
    FROM sums s JOIN {programme} p ON p.programme_id = s.programme_id
  ), complete AS (
    SELECT *, CAST(actuals + run_rate * CAST(remaining AS DECIMAL(6, 0)) AS DECIMAL(30, 8)) AS eac FROM rates
  )
  SELECT programme_id, programme_name, programme_type, as_of_year, as_of_period, actuals, run_rate, remaining, eac,
         CAST(total_budget_eur AS DECIMAL(28, 2)),
         CAST(round(CAST(eac AS DECIMAL(20, 8)) / CAST(nullif(total_budget_eur, 0) AS DECIMAL(15, 2)), 4) AS DOUBLE)
  FROM complete
"""


def register_runrate(spark: SparkSession, vj: DataFrame, programme: DataFrame, name: str = "tf_programme_runrate") -> str:
    """Register KP10 as a table function of year, period and window over the given journal and programmes.

    ``SELECT * FROM tf_programme_runrate(2001, 6, 3)``, or ``LATERAL`` for the arguments of a table.  Its filters and
    columns reach the journal's scan.  Returns the name.
    """
    vj.createOrReplaceTempView(f"{name}_journal")
    programme.createOrReplaceTempView(f"{name}_programme")
    spark.sql(_RUNRATE.format(name=name, journal=f"{name}_journal", programme=f"{name}_programme"))
    return name


def runrate(spark: SparkSession, name: str, year: int = config.AS_OF_YEAR, period: int = config.AS_OF_PERIOD,
            window: int = config.RUNRATE_WINDOW) -> DataFrame:
    return spark.sql(f"SELECT * FROM {name}(:year, :period, :window)", {"year": year, "period": period, "window": window})
