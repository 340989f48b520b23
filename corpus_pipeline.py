"""Training-corpus pipeline: documents are filtered, deduplicated, cleaned and packed.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet
and read again as the next stage's ``docs``; all but the last keep the columns that they are
given.  An empty table passes every stage as one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import line_dedup, packing, simhash, toxicity
from ledgerflow.llm.common import stored, table
from ledgerflow.llm.queries import vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go (threshold of the document's language).

    Null texts are scored as empty ones.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.classify(docs, model).where(~F.col("rejected")).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one document stays, that with the smallest id (a null id last).

    Documents that are no near copies all stay, whatever their ids; null and empty texts are copies of each other.
    """
    return simhash.keep_one_of_each(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document or place has go; ``n_chars`` follows the text (null texts stay as they are)."""
    cut = line_dedup.dedup_lines(docs)
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that are left, in sequences of 1024 tokens."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("substring_dedup", drop_repeated_lines),
    ("packing", pack),
]

#: SQL can express neither the trained classifier nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
