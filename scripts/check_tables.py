"""Compare the Spark demo finance tables with the DuckDB preamble derivation."""
import sys, time
sys.path.insert(0, "/root/repo")
from pyspark.sql import functions as F
from ledgerflow.session import get_spark
from ledgerflow.sources.demo import DemoLedger, FINANCE_TABLES
from ledgerflow.plans.oracle_preamble import oracle
from ledgerflow.plans.compare import compare, duckdb_connection

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
names = sys.argv[2:] or FINANCE_TABLES
spark = get_spark("local[8]", 8)
L = DemoLedger(spark, sf)
con = duckdb_connection(sf)
for t in names:
    df = getattr(L, t)
    drop = [c for c in ("budget_id", "forecast_id", "manager_user_id", "parent_id") if c in df.columns]
    df = df.drop(*drop)
    cols = ", ".join(df.columns)
    t0 = time.time()
    r = compare(df, oracle(f"SELECT {cols} FROM {t}"), con)
    print(t, r, round(time.time() - t0, 1), flush=True)
