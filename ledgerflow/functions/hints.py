"""Broadcast policy for dimension tables.

Master data (entities, cost centres, accounts, programmes, rates, calendar, close schedule) is
small, and joining it to the journal by broadcast spares the journal a shuffle for each lookup.
The hint is set where the bound is known, on the ledger's frame itself: the demo adapter's
dimensions are bounded by construction, and a ledger read from files counts rows from the Parquet
footers first.  A hint survives projections, filters and aggregates on top of the frame, so the
operators set none of their own; a dimension without it is left to the planner and to adaptive
execution (sort-merge join, or a runtime broadcast if it turns out small).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a dimension read from files up to which it is broadcast (a few hundred bytes each).
DIM_BROADCAST_MAX_ROWS = 200_000


_MARK = "_ledgerflow_bounded"


def bounded(df: DataFrame) -> DataFrame:
    """Mark a frame whose size has a proven bound for broadcast."""
    out = F.broadcast(df)
    setattr(out, _MARK, True)
    return out


def is_bounded(df: DataFrame) -> bool:
    return getattr(df, _MARK, False)


def no_larger(df: DataFrame, source: DataFrame) -> DataFrame:
    """``df``, which has no more rows than ``source``, with the same mark."""
    setattr(df, _MARK, is_bounded(source))
    return df


def dim(df: DataFrame, *cols) -> DataFrame:
    """The columns of a dimension that a join needs."""
    return no_larger(df.select(*cols), df) if cols else df


def in_one_place(df: DataFrame) -> DataFrame:
    """A bounded frame as one partition, so that grouping it needs no shuffle; any other as it is."""
    return no_larger(df.coalesce(1), df) if is_bounded(df) else df


def to_one(df: DataFrame, keys: list[str], *cols: str) -> DataFrame:
    """JN16: ``df`` as the side of a to-one association: one row a key with ``cols`` (of repeated keys the smallest).

    The grouping tells the optimizer that the side is unique, so a left join to it goes where no column of it is used.
    """
    return no_larger(in_one_place(df).groupBy(*keys).agg(F.min(F.struct(*cols)).alias("__one")).select(*keys, "__one.*"), df)
