"""User-level slice and dice (QY1, QY2, TK1-TK5, ST4).

A DataFrame helper, not a query-string parser: filters are Column expressions,
measures are (output name, function, column) triples.  Top-k uses
``orderBy(...).limit(n)`` (planned as TakeOrderedAndProject: per-partition
top-k, then a merge of k rows per partition), always with the grouping keys as
tie-breakers so the cut is deterministic.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import page

_AGGS = {"sum": F.sum, "min": F.min, "max": F.max, "avg": F.avg, "count": F.count}


def slice_dice(df: DataFrame, filter: Column | None = None, group_by: list[str] | None = None,
               measures: list[tuple[str, str, str]] | None = None, order_by: list | None = None,
               top: int | None = None, skip: int = 0) -> DataFrame:
    """QY1: filter -> group -> aggregate -> order -> skip/top."""
    x = df.where(filter) if filter is not None else df
    group_by = group_by or []
    measures = measures or []
    if measures:
        x = x.groupBy(*group_by).agg(*[_AGGS[fn](col).alias(name) for name, fn, col in measures])
    if order_by:
        x = x.orderBy(*order_by, *group_by)
    if skip:
        x = x.offset(skip)
    if top is not None:
        x = x.limit(top)
    return x


def select_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """QY2: ``$select``."""
    return df.select(*columns)


def filter_eq(df: DataFrame, **equals) -> DataFrame:
    """QY2: ``$filter`` with equality terms."""
    return df.where(reduce(lambda a, b: a & b, [F.col(k) == v for k, v in equals.items()], F.lit(True)))


def worst_first(df: DataFrame, measure: str, keys: list[str], n: int | None = None) -> DataFrame:
    """TK1: presentation order, largest measure first (keys break ties)."""
    x = df.orderBy(F.col(measure).desc_nulls_last(), *keys)
    return x.limit(n) if n is not None else x


def topcount(df: DataFrame, keys: list[str], measure: str, n: int, largest: bool = True) -> DataFrame:
    """TK2: the n largest (or smallest) groups by a summed measure."""
    g = df.groupBy(*keys).agg(F.sum(measure).alias(measure))
    order = F.col(measure).desc() if largest else F.col(measure).asc()
    return g.orderBy(order, *keys).limit(n)


def slice_page(df: DataFrame, order_by: list[str], skip: int, top: int) -> DataFrame:
    """TK3: ``orderby`` + ``skip`` + ``top`` (order by a total order); a deep page costs no more than a first one."""
    return page(df, order_by, skip, top)


def ranked(df: DataFrame, measure: str, keys: list[str], rank_col: str = "rank") -> DataFrame:
    """TK4: rank by measure descending (for small results such as one row per programme)."""
    w = Window.orderBy(F.col(measure).desc_nulls_last(), *keys)
    return df.withColumn(rank_col, F.row_number().over(w))


def top_n_trend(df: DataFrame, entity: str, measure: str, n: int, period_cols: list[str]) -> DataFrame:
    """TK5: per-period measure of the n largest entities (top-n subquery + semi join)."""
    top = df.groupBy(entity).agg(F.sum(measure).alias("__tot")).orderBy(F.col("__tot").desc(), entity).limit(n)
    x = df.join(top.select(entity), entity, "left_semi")
    return x.groupBy(entity, *period_cols).agg(F.sum(measure).alias(measure))


def query_concat(df: DataFrame, levels: dict[str, list[str]], measures: list[tuple[str, str, str]]) -> DataFrame:
    """ST4: several aggregations of the same set, each tagged by its ``level``, in one pass (GROUPING SETS).

    ``levels`` names the columns that each aggregation groups by; columns that a level does not group by are null.
    Two levels may not group by the same columns.
    """
    if len({frozenset(c) for c in levels.values()}) < len(levels):
        raise ValueError("two levels group by the same columns")
    keys = list(dict.fromkeys(c for columns in levels.values() for c in columns))
    # grouping_id has a bit for each key, the first key's highest, set where the level does not group by it
    bits = {name: sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in columns) for name, columns in levels.items()}
    if not keys:
        return df.agg(*[_AGGS[fn](col).alias(name) for name, fn, col in measures]).withColumn("level", F.lit(next(iter(levels))))
    grouped = df.groupingSets([[F.col(c) for c in columns] for columns in levels.values()], *[F.col(k) for k in keys])
    out = grouped.agg(*[_AGGS[fn](col).alias(name) for name, fn, col in measures], F.grouping_id().alias("__level"))
    level = F.lit(None).cast("string")
    for name, bit in bits.items():
        level = F.when(F.col("__level") == bit, F.lit(name)).otherwise(level)
    return out.withColumn("level", level).drop("__level")
