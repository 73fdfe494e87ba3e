"""Ordered operators inside a key: lag, lead, differences, n-th rows, ranks, trends, group normalisation.

The order must be total (end it with a tie-break), otherwise equal rows may swap between runs.

Ordinary keys use a window partitioned by the key. A hot key is cut into its own equal-depth slices of the first order
column, and where many rows share a value of it, by the next columns; each slice is its own window partition, and only the few rows at slice edges (lag) or one count per slice
(rank) are combined per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from relfold.operators.hotkeys import as_list, drop_null_keys, hot_keys, join_spread, split_hot, with_order_slice


def _sorting(order: Sequence[str], descending: bool) -> list[Column]:
    return [F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_first() for c in order]


def _window(keys: Sequence[str], order: Sequence[str], descending: bool = False):
    return W.partitionBy(*keys).orderBy(*_sorting(order, descending))


def _sliced_rank(df: DataFrame, keys: list[str], order: list[str], name: str, descending: bool) -> DataFrame:
    cut = with_order_slice(df, keys, order)
    if cut is None:
        return df.withColumn(name, F.row_number().over(_window(keys, order, descending)).cast("bigint"))
    before = W.partitionBy(*keys).orderBy(F.desc("_slice") if descending else F.asc("_slice")).rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        cut.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_n"))
        .select(*keys, "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    local = F.row_number().over(_window([*keys, "_slice"], order, descending))
    return (
        cut.withColumn("_local", local).join(offsets, [*keys, "_slice"])
        .withColumn(name, (F.col("_local") + F.col("_before")).cast("bigint"))
        .drop("_slice", "_local", "_before").select(*df.columns, name)
    )


def with_position(df: DataFrame, key, order, name: str = "position", descending: bool = False,
                  hot_rows: int | None = None) -> DataFrame:
    """Add the 1-based position of each row inside its key."""
    keys, order = as_list(key), as_list(order)
    df = drop_null_keys(df, keys)
    plain = F.row_number().over(_window(keys, order, descending)).cast("bigint")
    hot = hot_keys(df, keys, hot_rows)
    if hot is None:
        return df.withColumn(name, plain)
    cold, heavy = split_hot(df, keys, hot)
    return cold.withColumn(name, plain).unionByName(_sliced_rank(heavy, keys, order, name, descending))


def group_rank(df: DataFrame, key, value, ascending: bool = True, name: str = "rank", tie_break=(),
               hot_rows: int | None = None) -> DataFrame:
    """0-based rank of ``value`` inside the key (one key or several)."""
    order = [*as_list(value), *as_list(tie_break)]
    out = with_position(df, key, order, name, not ascending, hot_rows)
    return out.withColumn(name, F.col(name) - 1)


def _sliced_shift(df: DataFrame, keys: list[str], order: list[str], value: str, n: int, name: str,
                  descending: bool) -> DataFrame:
    cut = with_order_slice(df, keys, order)
    if cut is None:
        return df.withColumn(name, F.lag(value, n).over(_window(keys, order, descending)))
    inside = [*keys, "_slice"]
    shifted = (
        cut.withColumn(name, F.lag(value, n).over(_window(inside, order, descending)))
        .withColumn("_up", F.row_number().over(_window(inside, order, descending)))
        .withColumn("_down", F.count(F.lit(1)).over(W.partitionBy(*inside)) - F.col("_up") + 1)
    )
    # the n rows at either end of every slice, in order, contain the n-th previous row of each slice's first n rows
    edges = shifted.where((F.col("_up") <= n) | (F.col("_down") <= n))
    edges = edges.withColumn(name, F.lag(value, n).over(_window(keys, order, descending))).where(F.col("_up") <= n)
    whole = shifted.where(F.col("_up") > n).unionByName(edges)
    return whole.select(*df.columns, name)


def _shift(df, key, order, value, n, name, descending, hot_rows, together):
    keys, order = as_list(key), as_list(order)
    place = as_list(together or keys)
    df = drop_null_keys(df, keys)
    plain = F.lag(value, n).over(_window(keys, order, descending))
    hot = hot_keys(df, place, hot_rows)
    cold, heavy = split_hot(df, place, hot) if hot is not None else (df, None)
    out = (cold.repartition(*place) if together else cold).withColumn(name, plain)
    return out if heavy is None else out.unionByName(_sliced_shift(heavy, keys, order, value, n, name, descending))


def lag_value(df: DataFrame, key, order, value: str, n: int = 1, name: str | None = None,
              hot_rows: int | None = None, together=None) -> DataFrame:
    """Add the value n rows earlier inside the key.

    ``together`` (some of the keys) asks for the shuffle by those, so that a following roll-up by them needs none.
    """
    return _shift(df, key, order, value, n, name or f"{value}_lag", False, hot_rows, together)


def lead_value(df: DataFrame, key, order, value: str, n: int = 1, name: str | None = None,
               hot_rows: int | None = None, together=None) -> DataFrame:
    """Add the value n rows later inside the key."""
    return _shift(df, key, order, value, n, name or f"{value}_lead", True, hot_rows, together)


def lag_diff(df: DataFrame, key, order, value: str, n: int = 1, name: str | None = None,
             hot_rows: int | None = None, together=None) -> DataFrame:
    """Add value minus the value n rows earlier."""
    name = name or f"{value}_diff"
    return lag_value(df, key, order, value, n, name, hot_rows, together).withColumn(name, F.col(value) - F.col(name))


def _nth(df, key, order, value, n, name, descending):
    # "position = n + 1" lets Spark keep only n + 1 rows per key on the map side before it shuffles
    keys, order = as_list(key), as_list(order)
    df = drop_null_keys(df, keys)
    values = as_list(value)
    names = as_list(name) if name else values
    numbered = df.withColumn("_nth", F.row_number().over(_window(keys, order, descending)))
    return numbered.where(F.col("_nth") == n + 1).select(*keys, *[F.col(v).alias(a) for v, a in zip(values, names)])


def nth_from_last(df: DataFrame, key, order, value, n: int = 0, name=None) -> DataFrame:
    """key + the value of the n-th row before the last; keys with too few rows are absent."""
    return _nth(df, key, order, value, n, name, True)


def nth_from_first(df: DataFrame, key, order, value, n: int = 0, name=None) -> DataFrame:
    """key + the value of the n-th row after the first; keys with too few rows are absent."""
    return _nth(df, key, order, value, n, name, False)


def edge_rows(df: DataFrame, key, order, columns: Sequence[str], n: int) -> DataFrame:
    """The last n and first n rows of each key side by side: {column}_last_time{i} and {column}_first_time{i}.

    One pass per side; each keeps at most n rows per key on the map side.
    """
    keys, order = as_list(key), as_list(order)
    sides = []
    for side, descending in (("last", True), ("first", False)):
        rows = drop_null_keys(df, keys).select(*dict.fromkeys([*keys, *order, *columns]))
        rows = rows.withColumn("_nth", F.row_number().over(_window(keys, order, descending))).where(F.col("_nth") <= n)
        picks = [F.max(F.when(F.col("_nth") == i + 1, F.col(c))).alias(f"{c}_{side}_time{i}") for i in range(n) for c in columns]
        sides.append(rows.groupBy(*keys).agg(*picks))
    return sides[0].join(sides[1], keys, "left")


def trend(df: DataFrame, key, order, value: str, name: str = "trend", hot_rows: int | None = None) -> DataFrame:
    """Least-squares slope of the value over its position; NULL if any value is NULL, 0 for a single row."""
    keys = as_list(key)
    placed = with_position(df, keys, order, "_pos", hot_rows=hot_rows)
    slope = F.coalesce(F.regr_slope(F.col(value), F.col("_pos").cast("double")), F.lit(0.0))
    whole = F.count(value) == F.count(F.lit(1))
    return placed.groupBy(*keys).agg(F.when(whole, slope).alias(name))


def group_zscore(df: DataFrame, key, cols, replace: bool = False) -> DataFrame:
    """(x - mean) / std inside the key; NULL values and a zero spread give 0.

    Groups here are few and large, so the statistics are aggregated and joined back to spread rows instead of a window.
    """
    keys, cols = as_list(key), as_list(cols)
    stats = drop_null_keys(df, keys).groupBy(*keys).agg(
        *[F.avg(c).alias(f"_mean_{c}") for c in cols], *[F.stddev_samp(c).alias(f"_std_{c}") for c in cols])
    out = join_spread(df, stats, keys)
    for c in cols:
        z = F.coalesce(F.try_divide(F.col(c) - F.col(f"_mean_{c}"), F.col(f"_std_{c}")), F.lit(0.0))
        out = out.withColumn(c if replace else f"{c}_{'_'.join(keys)}_standardize", z)
    return out.drop(*[f"_mean_{c}" for c in cols], *[f"_std_{c}" for c in cols])


def group_minmax(df: DataFrame, key, cols, start: float = 0.0, replace: bool = False) -> DataFrame:
    """(x - min) / (max - min) inside the key; NULL values and a zero range give ``start``."""
    keys, cols = as_list(key), as_list(cols)
    stats = drop_null_keys(df, keys).groupBy(*keys).agg(
        *[F.min(c).alias(f"_min_{c}") for c in cols], *[F.max(c).alias(f"_max_{c}") for c in cols])
    out = join_spread(df, stats, keys)
    for c in cols:
        span = F.col(f"_max_{c}") - F.col(f"_min_{c}")
        v = F.coalesce(F.try_divide(F.col(c) - F.col(f"_min_{c}"), span), F.lit(float(start)))
        out = out.withColumn(c if replace else f"{c}_{'_'.join(keys)}_normalize", v)
    return out.drop(*[f"_min_{c}" for c in cols], *[f"_max_{c}" for c in cols])
