"""Encodings of category columns."""

from __future__ import annotations

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relfold.operators.hotkeys import as_list, drop_null_keys, join_counted, join_spread, one_group
from relfold.operators.ordered import with_position
from relfold.operators.quantile import group_quantiles
from relfold.operators.rollup import column_label, common_values, pivot_values
from relfold.sources.store import stored


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def one_to_one(values) -> dict:
    """A label for each value; values whose labels would be equal get a number, in the order of the values."""
    out, taken = {}, set()
    for v in values:
        label = base = column_label(v)
        n = 1
        while label in taken:
            n += 1
            label = f"{base}_{n}"
        taken.add(label)
        out[v] = label
    return out


def one_hot(df: DataFrame, cols=None, null_category: bool = True, keep_source: bool = False, limit: int = 1000) -> tuple[DataFrame, list[str]]:
    """0/1 column per category value; returns the table and the new column names."""
    cols = text_columns(df) if cols is None else as_list(cols)
    new = {}
    text = [c for c in cols if isinstance(df.schema[c].dataType, T.StringType)]
    found = common_values(df, text, limit=limit) | {c: pivot_values(df, c, limit) for c in cols if c not in text}
    for c in cols:
        for v, label in one_to_one(v for v in found[c] if v is not None).items():
            new[f"{c}_{label}"] = F.coalesce(F.col(c) == F.lit(v), F.lit(False)).cast("int")
        if null_category:
            new[f"{c}_null"] = F.col(c).isNull().cast("int")
    out = df.withColumns(new) if new else df
    return (out if keep_source else out.drop(*cols)), list(new)


def sparse_vector(size: int, indices: Column, values: Column) -> Column:
    """A vector for Spark ML from ascending indices and their values. It is read from its JSON form, so no Python runs."""
    parts = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"), indices.alias("indices"), values.cast("array<double>").alias("values"))
    kind = T.StructType([T.StructField("vector", VectorUDT())])
    return F.from_json(F.to_json(F.struct(parts.alias("vector"))), kind)["vector"]


def one_hot_vector(df: DataFrame, column: str) -> DataFrame:
    """Adds ``{column}_code``, the place of the value among all values in order from 0 (NULL for NULL), and ``{column}_onehot``, a sparse vector with a 1 at that
    place (all 0 for NULL). For any number of values: the dictionary is a stored table that is joined, never a list on the driver."""
    code, rows = f"{column}_code", df.where(F.col(column).isNotNull())
    values = stored(rows.groupBy(column).agg(F.count(F.lit(1)).alias("_rows")), "values")
    numbered = with_position(values.withColumn("_all", one_group(column)), "_all", column, code)
    codes = stored(numbered.select(column, "_rows", (F.col(code) - 1).cast("int").alias(code)), "codes")
    coded = join_counted(rows, codes, column, "_rows").select(*df.columns, code)
    whole = coded.unionByName(df.where(F.col(column).isNull()).withColumn(code, F.lit(None).cast("int")))
    here = F.filter(F.array(F.col(code)), lambda c: c.isNotNull())
    return whole.withColumn(f"{column}_onehot", sparse_vector(codes.count(), here, F.transform(here, lambda _: F.lit(1.0))))


def prune_rare(df: DataFrame, cols, min_count: int = 100) -> tuple[DataFrame, list[str]]:
    """Drop every 0/1 column with fewer than min_count ones or fewer than min_count zeros."""
    cols = as_list(cols)
    sums = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.sum(c).alias(c) for c in cols]).first()
    kept = [c for c in cols if (sums[c] or 0) >= min_count and sums["_rows"] - (sums[c] or 0) >= min_count]
    return df.drop(*[c for c in cols if c not in kept]), kept


def count_encode(df: DataFrame, column: str, name: str | None = None, source: DataFrame | None = None) -> DataFrame:
    """Number of rows that have the same value. ``source`` (else ``df``) has the rows to count: the plain table where encodings are chained, lest each
    one compute all earlier ones again."""
    rows = df if source is None else source
    counts = rows.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(name or f"{column}_count"))
    return join_spread(df, counts, [column])


def factorize(df: DataFrame, column: str, order, name: str | None = None, source: DataFrame | None = None) -> DataFrame:
    """0-based code by first appearance in the order; NULL becomes -1. ``source`` as in count_encode."""
    from relfold.operators.ordered import with_position

    name = name or f"{column}_code"
    firsts = (
        (df if source is None else source).where(F.col(column).isNotNull()).groupBy(column)
        .agg(F.min(F.struct(*as_list(order))).alias("_first"))
        .select(column, *[F.col(f"_first.{c}").alias(f"_o{i}") for i, c in enumerate(as_list(order))], one_group("_first").alias("_all"))
    )
    ranks = [f"_o{i}" for i in range(len(as_list(order)))]
    codes = with_position(firsts, "_all", [*ranks, column], "_code").select(column, (F.col("_code") - 1).alias(name))
    return join_spread(df, codes, [column]).withColumn(name, F.coalesce(F.col(name), F.lit(-1)))


def target_encode(df: DataFrame, key, label: str, a: float = 4.0, b: float = 46.0, name: str | None = None,
                  fold_col: str | None = None) -> DataFrame:
    """Smoothed label rate (sum + a) / (count + b) per key; NULL labels do not count.

    In-sample by default, as in plain target encoding. With ``fold_col`` each row's own fold is left out.
    """
    keys = as_list(key)
    name = name or f"{'_'.join(keys)}_rate"
    stats = drop_null_keys(df, keys).groupBy(*keys).agg(F.coalesce(F.sum(label), F.lit(0)).alias("_s"), F.count(label).alias("_n"))
    out = join_spread(df, stats, keys)
    s, n = F.col("_s"), F.col("_n")
    drop = ["_s", "_n"]
    if fold_col:
        own = drop_null_keys(df, [*keys, fold_col]).groupBy(*keys, fold_col).agg(
            F.coalesce(F.sum(label), F.lit(0)).alias("_fs"), F.count(label).alias("_fn"))
        out = join_spread(out, own, [*keys, fold_col])
        s, n = s - F.coalesce(F.col("_fs"), F.lit(0)), n - F.coalesce(F.col("_fn"), F.lit(0))
        drop += ["_fs", "_fn"]
    return out.withColumn(name, (s + F.lit(float(a))) / (n + F.lit(float(b)))).drop(*drop)


def group_median(df: DataFrame, key, column: str, name: str | None = None, hot_rows: int | None = None) -> DataFrame:
    """Exact median of a column within the row's category, as a column."""
    name = name or f"{column}_median"
    medians = group_quantiles(df, key, column, (0.5,), hot_rows).withColumnRenamed("q0", name)
    return join_spread(df, medians, as_list(key))


def pair_affinity(df: DataFrame, first, second, name: str = "affinity") -> DataFrame:
    """n(first, second) / n(first) / n(second) for every pair that occurs. The pairs are stored once; values in a large part of all pairs are sent, others joined."""
    k1, k2 = as_list(first), as_list(second)
    out = pairs = stored(drop_null_keys(df, [*k1, *k2]).groupBy(*k1, *k2).agg(F.count(F.lit(1)).alias("pair_count")), "pairs")
    for keys, total in ((k1, "first_count"), (k2, "second_count")):
        stats = pairs.groupBy(*keys).agg(F.sum("pair_count").alias(total), F.count(F.lit(1)).alias("_pairs"))
        out = join_counted(out, stats, keys, "_pairs").drop("_pairs")
    value = F.col("pair_count").cast("double") / F.col("second_count") / F.col("first_count")
    return out.select(*pairs.columns, "first_count", "second_count", value.alias(name))
