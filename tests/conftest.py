import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[*]")
        .appName("ledgerflow-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def ledger(spark):
    from ledgerflow.sources.demo import DemoLedger

    return DemoLedger(spark, SF_SMALL)


@pytest.fixture(scope="session")
def ctx(spark, ledger):
    from ledgerflow.plans.context import Ctx

    return Ctx(spark, ledger_obj=ledger)


@pytest.fixture(scope="session")
def duck():
    from ledgerflow.plans.compare import duckdb_connection

    return duckdb_connection(SF_SMALL)
