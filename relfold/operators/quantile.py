"""Exact interpolated quantiles, per key or over a whole table, without bringing a large group into one task.

Ordinary groups use Spark's exact ``percentile``. A hot group (or the whole table) is solved by refinement: count
per (slice, value) on the map side, where the slices are ranges of about equal depth of the group's own values; add up
the slices to see which one holds the wanted position; rank only the distinct values inside that slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from relfold.operators.hotkeys import as_list, drop_null_keys, hot_keys, is_small, one_group, split_hot, with_slice

def _refine(df: DataFrame, keys: list[str], name: str, probs: Sequence[float]) -> DataFrame:
    """keys + q0..qn for every key of df that has a value."""
    group, keys = keys, [*keys, "_all"]
    values = df.where(F.col(name).isNotNull()).select(*group, F.col(name).cast("double").alias("_v"), one_group(name).alias("_all"))
    counted = with_slice(values, keys, "_v").groupBy(*keys, F.col("_slice").alias("_b"), "_v").agg(F.count(F.lit(1)).alias("_n"))
    per_bucket = counted.groupBy(*keys, "_b").agg(F.sum("_n").alias("_n"))
    by_key = W.partitionBy(*keys)
    placed = (
        per_bucket
        .withColumn("_end", F.sum("_n").over(by_key.orderBy("_b").rowsBetween(W.unboundedPreceding, 0)))
        .withColumn("_total", F.sum("_n").over(by_key))
    )
    wanted = []
    for i, p in enumerate(probs):
        pos = F.lit(float(p)) * (F.col("_total") - 1)
        wanted.append(F.struct(F.lit(i).alias("i"), F.floor(pos).alias("at"), F.lit(0).alias("side"), (pos - F.floor(pos)).alias("frac")))
        wanted.append(F.struct(F.lit(i).alias("i"), F.ceil(pos).alias("at"), F.lit(1).alias("side"), (pos - F.floor(pos)).alias("frac")))
    targets = (
        placed.select(*keys, "_b", "_n", "_end", F.explode(F.array(*wanted)).alias("t"))
        .where((F.col("t.at") < F.col("_end")) & (F.col("t.at") >= F.col("_end") - F.col("_n")))
        .select(*keys, "_b", F.col("t.i").alias("_i"), F.col("t.side").alias("_side"), F.col("t.frac").alias("_frac"),
                (F.col("t.at") - (F.col("_end") - F.col("_n"))).alias("_at"))
    )
    inside = W.partitionBy(*keys, "_b").orderBy("_v").rowsBetween(W.unboundedPreceding, 0)
    ranked = (
        counted.join(targets.select(*keys, "_b").distinct(), [*keys, "_b"], "left_semi")
        .withColumn("_upto", F.sum("_n").over(inside))
    )
    picked = (
        ranked.join(targets, [*keys, "_b"])
        .where((F.col("_at") < F.col("_upto")) & (F.col("_at") >= F.col("_upto") - F.col("_n")))
    )
    cols = []
    for i in range(len(probs)):
        lo = F.max(F.when((F.col("_i") == i) & (F.col("_side") == 0), F.col("_v")))
        hi = F.max(F.when((F.col("_i") == i) & (F.col("_side") == 1), F.col("_v")))
        frac = F.max(F.when(F.col("_i") == i, F.col("_frac")))
        # no arithmetic where there is nothing between: infinities would give NaN
        cols.append(F.when((frac == 0) | (lo == hi), lo).otherwise(lo * (1 - frac) + hi * frac).alias(f"q{i}"))
    return picked.groupBy(*group).agg(*cols)


def exact_quantiles(df: DataFrame, keys: list[str], name: str, probs: Sequence[float] = (0.5,)) -> DataFrame:
    """Every key of df with its quantiles by refinement; NULL where the key has no value."""
    return df.select(*keys).distinct().join(_refine(df, keys, name, probs), keys, "left")


def _plain(df: DataFrame, keys: list[str], name: str, probs: Sequence[float]) -> DataFrame:
    values = F.percentile(F.col(name).cast("double"), F.array(*[F.lit(float(p)) for p in probs]))
    out = df.groupBy(*keys).agg(values.alias("_q"))
    return out.select(*keys, *[F.col("_q")[i].alias(f"q{i}") for i in range(len(probs))])


def group_quantiles(df: DataFrame, key, name: str, probs: Sequence[float] = (0.5,), hot_rows: int | None = None) -> DataFrame:
    """Exact quantiles q0, q1, ... of ``name`` per key, linear interpolation, NULLs ignored."""
    keys = as_list(key)
    df = drop_null_keys(df.select(*keys, name), keys)
    hot = hot_keys(df, keys, hot_rows)
    if hot is None:
        return _plain(df, keys, name, probs)
    cold_rows, hot_rows_df = split_hot(df, keys, hot)
    return _plain(cold_rows, keys, name, probs).unionByName(exact_quantiles(hot_rows_df, keys, name, probs))


def table_quantiles(df: DataFrame, name: str, probs: Sequence[float], force_refine: bool = False) -> DataFrame:
    """One row q0, q1, ...: exact quantiles of a column over the whole table."""
    df = df.select(name)
    if is_small(df) and not force_refine:
        return _plain(df, [], name, probs)
    return _refine(df, [], name, probs)
