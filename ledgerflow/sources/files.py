"""Typed readers and sinks (SC1, SC3-SC7, SC9, SC10) and a Parquet-backed ledger.

CSV is read all-string and cast by column name into the declared types, so a
renamed or missing column is an error rather than a silent shift; integers
that a pandas writer rendered as ``0.0`` are cast through ``double``.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, DecimalType, IntegerType, LongType

from .. import schemas
from ..functions.hints import DIM_BROADCAST_MAX_ROWS, bounded
from . import versions

#: Rows up to which a JSON result is written as one file.
JSON_ONE_FILE_ROWS = 100_000
#: Column that keeps a document and its reversal together, and the buckets of the document layout.
DOCUMENT_KEY = "document_key"
DOCUMENT_BUCKETS = 64
#: Rows of a bucket, which one task sorts, beyond which a larger journal gets more buckets.
BUCKET_ROWS = 1 << 20
#: Columns of the journal that the layout by document keeps: what rules on documents and reversals read.
DOCUMENT_COLUMNS = [
    "company_code", "document_number", "document_line", "document_type", "posting_date", "fiscal_year", "fiscal_period",
    "debit_credit_ind", "amount_doc_currency", "amount_local_currency", "amount_group_currency", "is_reversal",
    "reversed_document",
]


class MissingColumnError(ValueError):
    pass


def cast_to_contract(df: DataFrame, table: str) -> DataFrame:
    """Select the declared columns by name and cast them; extra columns are ignored."""
    schema = schemas.SCHEMAS[table]
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise MissingColumnError(f"{table}: missing columns {missing}")
    out = []
    for f in schema.fields:
        col = F.when(F.col(f.name) == "", F.lit(None)).otherwise(F.col(f.name))
        if isinstance(f.dataType, (IntegerType, LongType)):
            col = col.cast("decimal(38,6)").cast(f.dataType)  # "12.0" is 12; a double would lose long keys
        elif isinstance(f.dataType, BooleanType):
            col = F.lower(col).cast("boolean")
        elif isinstance(f.dataType, DateType):
            col = F.to_date(col, "yyyy-MM-dd")
        elif isinstance(f.dataType, DecimalType):
            col = col.cast(f.dataType)
        else:
            col = col.cast(f.dataType)
        out.append(col.alias(f.name))
    return df.select(*out)


def read_typed_csv(spark: SparkSession, table: str, path: str) -> DataFrame:
    """SC1: CSV with header -> declared types (no inference)."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return cast_to_contract(raw, table)


def l1_projection(df: DataFrame, table: str) -> DataFrame:
    """SC10/PF1: the L1 contract projection of a table (no logic)."""
    return df.select(*schemas.CONTRACT_COLUMNS[table])


def write_csv(df: DataFrame, path: str) -> None:
    """SC5: ISO dates, lower-case booleans, empty string for NULL, UTF-8."""
    out = df.select(*[
        F.lower(F.col(f.name).cast("string")).alias(f.name) if isinstance(f.dataType, BooleanType)
        else F.col(f.name) for f in df.schema.fields
    ])
    (out.write.mode("overwrite").option("header", True).option("nullValue", "")
     .option("emptyValue", "").option("dateFormat", "yyyy-MM-dd").option("lineSep", "\n").csv(path))


def write_json(df: DataFrame, path: str) -> None:
    """SC7: JSON sink; a result of up to JSON_ONE_FILE_ROWS rows is one file, a larger one a file a partition."""
    small = df.limit(JSON_ONE_FILE_ROWS + 1).count() <= JSON_ONE_FILE_ROWS
    (df.coalesce(1) if small else df).write.mode("overwrite").json(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> int:
    """SC3/SC9: full-load refresh, optionally partitioned (e.g. by fiscal year); the rows written (SC4).

    Readers of ``versions.read_table`` see the old rows until the new ones are whole.
    """
    return versions.replace_table(df, path, partition_by)


def with_document_key(journal: DataFrame) -> DataFrame:
    """The journal with the document that a line belongs to or reverses."""
    return journal.withColumn(DOCUMENT_KEY, F.coalesce("reversed_document", "document_number"))


def document_buckets(rows: int) -> int:
    """Buckets for a journal of ``rows`` lines: DOCUMENT_BUCKETS, more where those would hold over BUCKET_ROWS each."""
    return max(DOCUMENT_BUCKETS, -(-rows // BUCKET_ROWS))


def write_by_document(journal: DataFrame, table: str, path: str, buckets: int = DOCUMENT_BUCKETS) -> DataFrame:
    """SC9, hash half: the journal as a catalogue table partitioned by year and bucketed by document beside it.

    Groupings, windows and joins by document then need no shuffle.  Rows are dealt to their buckets once, so each
    bucket is one file a year.
    """
    dealt = with_document_key(journal).repartition(buckets, DOCUMENT_KEY)
    (dealt.write.partitionBy("fiscal_year").bucketBy(buckets, DOCUMENT_KEY).sortBy(DOCUMENT_KEY)
     .option("path", path).saveAsTable(table))
    return journal.sparkSession.table(table)


def load_counts(ledger, root: str | None) -> DataFrame:
    """SC4: rows of every finance table.  Of a ledger that was loaded into ``root`` they are read off the commits;
    of one that is not stored they are counted."""
    spark = ledger.spark
    if root is not None and all(versions.is_versioned(spark, f"{root}/{t}") for t in schemas.SCHEMAS):
        return versions.row_counts(spark, root, list(schemas.SCHEMAS))
    parts = [getattr(ledger, t).agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("row_count")) for t in schemas.SCHEMAS]
    return reduce(DataFrame.unionByName, parts)


def sample_slice(df: DataFrame, n: int, order_by: list[str], keep_together: str | None = None) -> DataFrame:
    """SC6: first ``n`` rows in key order; with ``keep_together`` a document's lines stay
    together (all lines of the documents that start within the first ``n`` rows)."""
    head = df.orderBy(*order_by).limit(n)
    if keep_together is None:
        return head
    docs = head.select(keep_together).distinct()
    return df.join(docs, keep_together, "left_semi")


class ParquetLedger:
    """The eleven finance tables (plus an optional monthly aggregate) read from a folder.

    Dimension row counts are read from Parquet footers at load; a dimension within the bound
    carries the broadcast hint, and the joins of any other are left to the planner.
    """

    def __init__(self, spark: SparkSession, root: str, check_dims: bool = True):
        self.spark = spark
        self.root = root.rstrip("/")
        self._frames: dict[str, DataFrame] = {}
        self.dimension_rows: dict[str, int] = {}
        for t in schemas.SCHEMAS:
            df = versions.read_table(spark, f"{self.root}/{t}")
            if t == "dim_date":
                from ..operators.calendar import add_working_day_seq

                df = add_working_day_seq(df)
            if check_dims and t in schemas.DIMENSIONS:
                n = df.count()
                self.dimension_rows[t] = n
                if n <= DIM_BROADCAST_MAX_ROWS:
                    df = bounded(df)
            self._frames[t] = df

    def __getattr__(self, name):
        frames = self.__dict__.get("_frames", {})
        if name in frames:
            return frames[name]
        raise AttributeError(name)

    @cached_property
    def periods(self) -> DataFrame:
        from ..operators.calendar import covered_periods

        return covered_periods(self.journal, "posting_date")

    @cached_property
    def fiscal_span(self):
        from ..operators.calendar import fiscal_span

        return fiscal_span(self.periods)

    @property
    def journal_by_document(self) -> DataFrame:
        return with_document_key(self.journal.select(*DOCUMENT_COLUMNS))

    def row_counts(self) -> DataFrame:
        return load_counts(self, self.root)

    @cached_property
    def agg_journal_monthly(self) -> DataFrame | None:
        path = f"{self.root}/agg_journal_monthly"
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        there = hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(hadoop)
        return versions.read_table(self.spark, path) if there else None


def materialise_ledger(ledger, root: str) -> None:
    """Write every finance table of ``ledger`` to ``root``.

    The journal is written first (partitioned by fiscal year); tables derived
    from it (programme budgets, budget, forecast) are then built from the stored
    copy, so the journal's lineage is computed once and cut by a written table.
    """
    root = root.rstrip("/")
    write_table(ledger.journal.select(*schemas.CONTRACT_COLUMNS["journal"]), f"{root}/journal", ["fiscal_year"])
    stored = versions.read_table(ledger.spark, f"{root}/journal")
    if hasattr(ledger, "use_stored_journal"):
        ledger.use_stored_journal(stored)
    for t in schemas.SCHEMAS:
        if t == "journal":
            continue
        cols = list(schemas.CONTRACT_COLUMNS[t])
        if t == "dim_date":
            cols.append("working_day_seq")  # the L2 counter, stored so readers need no window
        write_table(getattr(ledger, t).select(*cols), f"{root}/{t}")
