"""Rates, splits and ranking metrics.

Random splits order rows by a seeded hash of their id. Positions are found per hash range, whose sizes are even by
construction, plus one running count over the ranges: no task sorts a whole class or table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from relfold.operators.hotkeys import as_list, drop_null_keys, one_group, with_slice
from relfold.operators.quantile import table_quantiles

HALF = 2147483648
HASH_RANGE = 2147483647  # a prime, so that no stride of ids falls together
RANGE_SHIFT = 11  # 1,048,576 ranges, a million rows each at 10^12 ids


def mix(key: str | Column, seed: int) -> Column:
    """Seeded 31-bit mix of both halves of an integer id; plain integer arithmetic, the same on any engine."""
    x = (F.col(key) if isinstance(key, str) else key).cast("bigint")
    low, high = F.pmod(x, F.lit(HALF)), F.pmod(F.shiftright(x, 31), F.lit(HALF))
    h = F.pmod(low * F.lit(1103515245) + high * F.lit(1220703125) + F.lit(seed), F.lit(HASH_RANGE))
    return F.pmod((h + F.shiftright(h, 16)) * F.lit(69069) + F.lit(1), F.lit(HASH_RANGE))


def hash_position(df: DataFrame, key: str, seed: int, groups: Sequence[str] = (), name: str = "position") -> DataFrame:
    """1-based position of each row by (hash, id), over the table or inside each group; rows need a group."""
    groups = as_list(groups)
    rows = drop_null_keys(df, groups).withColumn("_h", mix(key, seed)).withColumn("_r", F.shiftright(F.col("_h"), RANGE_SHIFT))
    counts = rows.groupBy(*groups, "_r").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*groups).orderBy("_r").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(*groups, "_r", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    local = F.row_number().over(W.partitionBy(*groups, "_r").orderBy("_h", key))
    placed = rows.withColumn("_local", local).join(offsets, [*groups, "_r"])
    return placed.select(*df.columns, (F.col("_local") + F.col("_before")).cast("bigint").alias(name))


def holdout(df: DataFrame, key: str, frac: float = 0.5, seed: int = 66, name: str = "part") -> DataFrame:
    """Mark a random share of the ids as 'test' (exactly round(frac * rows)), the rest as 'train'."""
    size = F.round(df.select(F.count(F.lit(1))).scalar() * F.lit(float(frac)))
    out = hash_position(df, key, seed, name="_pos")
    return out.withColumn(name, F.when(F.col("_pos") <= size, "test").otherwise("train")).drop("_pos")


def stratified_folds(df: DataFrame, key: str, label: str, k: int = 10, seed: int = 666, name: str = "fold") -> DataFrame:
    """Fold number 0..k-1; inside each class fold sizes differ by at most one."""
    out = hash_position(df, key, seed, [label], "_pos")
    return out.withColumn(name, F.pmod(F.col("_pos") - 1, F.lit(k)).cast("bigint")).drop("_pos")


def random_partition(df: DataFrame, key: str, parts: int = 2, seed: int = 1, name: str = "part") -> DataFrame:
    """Shuffle and cut into equal parts; what does not divide evenly goes to the last part."""
    size = F.greatest(F.floor(df.select(F.count(F.lit(1))).scalar() / F.lit(parts)), F.lit(1))
    out = hash_position(df, key, seed, name="_pos")
    return out.withColumn(name, F.least(F.floor((F.col("_pos") - 1) / size), F.lit(parts - 1)).cast("bigint")).drop("_pos")


def value_counts(df: DataFrame, column: str, name: str = "count") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), F.asc(column))


def _rates(df: DataFrame, by: Sequence[str], label: str) -> DataFrame:
    out = df.groupBy(*by).agg(F.count(label).alias("count"), F.coalesce(F.sum(label), F.lit(0)).alias("sum"))
    return out.withColumn("rate", F.try_divide(F.col("sum").cast("double"), F.col("count")))


def rate_by(df: DataFrame, column: str, label: str) -> DataFrame:
    """Label count, sum and rate per category."""
    return _rates(df.where(F.col(column).isNotNull()), [column], label)


def _all_bins(df: DataFrame, rates: DataFrame, bins: int) -> DataFrame:
    axis = df.sparkSession.range(1, bins + 1).withColumnRenamed("id", "bin")
    out = axis.join(rates, "bin", "left")
    return out.withColumns({"count": F.coalesce("count", F.lit(0)), "sum": F.coalesce("sum", F.lit(0))})


def rate_by_width(df: DataFrame, column: str, label: str, bins: int = 10) -> DataFrame:
    """Label rate per equal-width bin; bins are right-closed, the lowest value is in bin 1, empty bins are listed."""
    rows = df.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("_x"), label)
    low, high = rows.select(F.min("_x")).scalar(), rows.select(F.max("_x")).scalar()
    place = F.ceil(F.try_divide((F.col("_x") - low) * F.lit(float(bins)), high - low))
    number = F.least(F.greatest(F.coalesce(place, F.lit(1)), F.lit(1)), F.lit(bins)).cast("bigint")
    return _all_bins(df, _rates(rows.withColumn("bin", number), ["bin"], label), bins)


def rate_by_quantile(df: DataFrame, column: str, label: str, bins: int = 10) -> DataFrame:
    """Label rate per equal-count bin; right-closed bins between interpolated quantiles, equal edges merged."""
    rows = df.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("_x"), label)
    edges = sorted(set(table_quantiles(rows, "_x", [i / bins for i in range(bins + 1)]).first()))
    number = F.lit(1)
    for e in edges[1:-1]:
        number = number + F.when(F.col("_x") > F.lit(e), 1).otherwise(0)
    return _all_bins(df, _rates(rows.withColumn("bin", number.cast("bigint")), ["bin"], label), max(len(edges) - 1, 1))


def auc(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve, ties counting half; overall or per group. NULL without both classes.

    Works on counts per distinct score. The number of negatives below a score is a running sum inside a slice of the
    group's scores plus the total of the slices below it.
    """
    by = as_list(by)
    s = F.col(score).cast("double")
    known = df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
    points = drop_null_keys(known, by).groupBy(*by, s.alias("_s")).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("_p"), F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).alias("_n"))
    place = [*by, "_all"]
    points = with_slice(points.withColumn("_all", one_group("_s")), place, "_s")
    ranges = points.groupBy(*place, "_slice").agg(F.sum("_n").alias("_rn"))
    below = W.partitionBy(*place).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    ranges = ranges.select(*place, "_slice", F.coalesce(F.sum("_rn").over(below), F.lit(0)).alias("_base"))
    inside = W.partitionBy(*place, "_slice").orderBy("_s").rowsBetween(W.unboundedPreceding, -1)
    placed = points.withColumn("_in", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(ranges, [*place, "_slice"])
    right = F.sum(F.col("_p") * (F.col("_base") + F.col("_in") + F.col("_n") / F.lit(2.0)))
    pairs = F.sum("_p").cast("double") * F.sum("_n").cast("double")
    return placed.groupBy(*by).agg(F.try_divide(right, pairs).alias("auc"))


def smape(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Symmetric percentage error: twice the mean of |y - p| / (y + p)."""
    term = F.try_divide(F.abs(F.col(actual) - F.col(predicted)), F.col(actual) + F.col(predicted))
    return df.agg((F.lit(2.0) * F.avg(term)).alias("smape"))


def fold_average(scores: DataFrame, key, score: str = "score") -> DataFrame:
    """Mean of the fold models' scores per id."""
    return scores.groupBy(*as_list(key)).agg(F.avg(score).alias(score))


def oof_table(valid: DataFrame, test: DataFrame, key: str, score: str = "score") -> DataFrame:
    """Out-of-fold scores of training ids with the averaged scores of test ids."""
    return valid.select(key, score).unionByName(test.select(key, score))
