"""ledgerflow — month-end close and programme-controlling analytics on Spark DataFrames.

Layers (each a set of pure ``DataFrame -> DataFrame`` functions):

* ``sources``    typed readers/sinks and the demo adapter that derives the finance
                 star schema from the driver's TPC-H-like tables;
* ``functions``  column expressions (signing, period keys, calendar arithmetic);
* ``operators``  finance operators: calendar, FX, harmonised ledger, the eight KPIs,
                 materialised aggregate, publishing, extracts, planning, data quality,
                 signals, reconciliation and slicing;
* ``plans``      the registered query catalogue and its DuckDB oracle SQL;
* ``streaming``  incremental refresh of the monthly aggregate from new journal files.
"""

__version__ = "0.1.0"
