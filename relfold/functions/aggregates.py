"""Named aggregate functions, each usable in any roll-up spec ``{column: [function, ...]}``.

All of them except ``median`` and ``nunique`` are algebraic: Spark combines them on the map side, so a key holding
most rows costs one buffer per map task. ``median`` and ``nunique`` need the distinct values of the group in one
task; ``operators.rollup`` uses these forms only for keys of bounded size and has another way for the others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ORDERED = {"first", "last"}
HOLISTIC = {"median"}
DISTINCT = {"nunique"}
# functions that have a value on an empty set of rows, although "no rows" must read NULL
ZERO_ON_EMPTY = {"count", "size", "sum", "nunique"}


def adjusted_skew(x: Column) -> Column:
    """Adjusted Fisher-Pearson skewness: NULL below three values, 0 for constants."""
    n = F.count(x).cast("double")
    factor = F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0))
    return F.when(F.count(x) >= 3, F.coalesce(F.skewness(x) * factor, F.lit(0.0)))


def unbiased_kurtosis(x: Column) -> Column:
    """Unbiased excess kurtosis: NULL below four values, 0 for constants."""
    n = F.count(x).cast("double")
    k = F.kurtosis(x)
    value = (n - 1) / F.nullif((n - 2) * (n - 3), F.lit(0.0)) * ((n + 1) * k + 6)
    return F.when(F.count(x) >= 4, F.coalesce(value, F.lit(0.0)))


def first_by(x: Column, order: Sequence[str]) -> Column:
    """First non-null value in the given total order."""
    return F.min_by(x, F.when(x.isNotNull(), F.struct(*order)))


def last_by(x: Column, order: Sequence[str]) -> Column:
    """Last non-null value in the given total order."""
    return F.max_by(x, F.when(x.isNotNull(), F.struct(*order)))


def nunique_with_null(x: Column) -> Column:
    """Distinct values, NULL being one of them."""
    return F.count_distinct(x) + F.max(F.when(x.isNull(), 1).otherwise(0))


def aggregate_text(fn: str, name: str, cond: str | None = None, order: Sequence[str] | None = None) -> str:
    """Aggregate ``fn`` over column ``name`` as SQL text, over the rows meeting ``cond`` if given.

    Text, because a block has hundreds of aggregates and one statement reaches Spark far sooner than thousands of
    ``Column`` calls. With a condition the result is NULL when no row meets it, as if the group had been filtered first.
    """
    only = f" FILTER (WHERE {cond})" if cond else ""
    rows = f"count(1){only}"
    if fn in ORDERED:
        if not order:
            raise ValueError(f"{fn}({name}) needs an order")
        known = f"{name} IS NOT NULL" + (f" AND ({cond})" if cond else "")
        return f"{'min_by' if fn == 'first' else 'max_by'}({name}, struct({', '.join(order)})) FILTER (WHERE {known})"
    n = f"count({name}){only}"
    forms = {
        "count": n, "size": rows, "sum": f"coalesce(sum({name}){only}, 0)", "mean": f"avg({name}){only}", "min": f"min({name}){only}",
        "max": f"max({name}){only}", "std": f"stddev_samp({name}){only}", "var": f"var_samp({name}){only}",
        "range": f"max({name}){only} - min({name}){only}", "kurt": f"kurtosis({name}){only}", "median": f"median({name}){only}",
        "nunique": f"bigint(size(collect_set({name}){only}))",
        # adjusted for the group size; 0 where all values are equal
        "skew": f"CASE WHEN {n} >= 3 THEN coalesce(skewness({name}){only} * sqrt(double({n}) * ({n} - 1)) / nullif({n} - 2, 0), 0) END",
    }
    if fn not in forms:
        raise ValueError(f"unknown aggregate function: {fn}")
    return f"CASE WHEN {rows} > 0 THEN {forms[fn]} END" if cond and fn in ZERO_ON_EMPTY else forms[fn]


def aggregate(fn: str, name: str, cond: str | None = None, order: Sequence[str] | None = None) -> Column:
    """The same as a ``Column``."""
    return F.expr(aggregate_text(fn, name, cond, order))
