"""Where the columns of a published view come from (QC20).

The analysed plan of a view is followed from its sources to its output: every attribute carries the names of the
source columns that its value can come from, through renames, expressions, aggregates, windows, joins and
unions.  A user column that is published under another name, or inside an expression, is found so; names alone
would miss it.  Only the plan is read here; ``exposed_values`` looks at the rows as well.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .. import config
from ..functions.columns import count_if

Sources = frozenset  # of (source column, how): "as is", "renamed" or "computed"


def _each(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def _kind(node) -> str:
    return node.getClass().getSimpleName()


def _refs(expr, known: dict[int, Sources]) -> Sources:
    found = [known.get(a.exprId().id(), frozenset()) for a in _each(expr.references().toSeq())]
    return frozenset().union(*found)


def _computed(sources: Sources) -> Sources:
    return frozenset((name, "computed") for name, _ in sources)


def _aliases(expr, known: dict[int, Sources], out: dict[int, Sources]) -> None:
    """Sources of every named expression in ``expr``."""
    if _kind(expr) == "Alias":
        sources = _refs(expr, known)
        plain = _kind(expr.child()) == "AttributeReference"
        out[expr.exprId().id()] = frozenset((n, "computed" if h == "computed" or not plain else h) for n, h in sources)
    for child in _each(expr.children()):
        _aliases(child, known, out)


def _follow(node) -> dict[int, Sources]:
    children = _each(node.children())
    outputs = _each(node.output())
    if not children:
        return {a.exprId().id(): frozenset({(a.name(), "as is")}) for a in outputs}
    below = [_follow(c) for c in children]
    known: dict[int, Sources] = reduce(lambda a, b: a | b, below)
    inner = [s for sub in _each(node.subqueries()) for s in _follow(sub).values()]
    named: dict[int, Sources] = {}
    for expr in _each(node.expressions()):
        _aliases(expr, known, named)
    if inner:  # a subquery's columns are not among the references of the expression that holds it
        hidden = _computed(frozenset().union(*inner))
        named = {k: v | hidden for k, v in named.items()}
    everything = _computed(frozenset().union(*known.values()))
    sides = [_each(c.output()) for c in children] if _kind(node) in ("Union", "Intersect", "Except") else []
    out = {}
    for i, a in enumerate(outputs):
        k = a.exprId().id()
        if sides:
            out[k] = frozenset().union(*[below[n][side[i].exprId().id()] for n, side in enumerate(sides)])
        elif _kind(node) == "Generate" and k not in known:
            out[k] = _computed(_refs(node.generator(), known))
        else:  # an output that no expression names (of a Python function, an expansion) can come from every column
            out[k] = named.get(k, known.get(k, everything))
    return out


def column_sources(df: DataFrame) -> dict[str, list[tuple[str, str]]]:
    """For each column of ``df`` the source columns that its values can come from, and how.

    ``as is`` and ``renamed`` carry the value itself, ``computed`` went through an expression.  A checkpoint or a
    stored table begins anew: its columns are sources.
    """
    plan = df._jdf.queryExecution().analyzed()
    sources = _follow(plan)
    found = {}
    for a in _each(plan.output()):
        found[a.name()] = sorted((n, "renamed" if h == "as is" and n != a.name() else h) for n, h in sources[a.exprId().id()])
    return found


def exposed_columns(views: dict[str, DataFrame], private: list[str] = config.PSEUDONYM_COLUMNS) -> list[tuple[str, str, str, str]]:
    """(view, column, private source column, how) for every published column that a private one reaches."""
    return [(view, column, name, how) for view, df in views.items() for column, sources in column_sources(df).items()
            for name, how in sources if name in private]


def exposed_values(view: str, df: DataFrame, pattern: str = config.USER_TOKEN_PATTERN) -> DataFrame:
    """One row: the view's rows, and its text columns in which a value looks like a private one."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    hits = df.agg(F.count(F.lit(1)).alias("n"), *[count_if(F.col(f"`{c}`").rlike(pattern)).alias(f"t{i}") for i, c in enumerate(texts)])
    columns = reduce(lambda a, b: a + b, [(F.col(f"t{i}") > 0).cast("long") for i in range(len(texts))], F.lit(0).cast("long"))
    return hits.select(F.lit(view).alias("view_name"), F.col("n").alias("rows_checked"), columns.alias("columns_with_tokens"))


def exposure(views: dict[str, DataFrame], private: list[str] = config.PSEUDONYM_COLUMNS) -> DataFrame:
    """QC20: per view its columns, those a private column reaches by lineage, and those whose values show one."""
    reached = {}
    for view, column, _, _ in exposed_columns(views, private):
        reached.setdefault(view, set()).add(column)
    parts = [exposed_values(v, df).withColumn("columns_checked", F.lit(len(df.columns)).cast("long"))
             .withColumn("columns_by_lineage", F.lit(len(reached.get(v, ()))).cast("long")) for v, df in views.items()]
    out = reduce(DataFrame.unionByName, parts)
    return out.select("view_name", "rows_checked", "columns_checked", "columns_by_lineage", "columns_with_tokens",
                      ((F.col("columns_by_lineage") == 0) & (F.col("columns_with_tokens") == 0)).alias("passed"))
