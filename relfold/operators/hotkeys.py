"""Hot groups: find keys that hold too many rows for one task, and cut such groups along their order.

Algebraic aggregates need none of this. It serves the operators that must see a whole group in order (lag, rank,
exact quantiles). Being hot only decides the route; results are the same on both.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relfold.sources.store import ensure_checkpoint_dir

# Rows of one key that a single task may sort.
HOT_ROWS = 1_000_000
# An input this small fits one task even if all of it shares one key, so no search is needed.
SMALL_BYTES = 64 * 1024 * 1024
SLICES = 256


def as_list(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows without a key belong to no group."""
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    return df


def input_bytes(df: DataFrame) -> int | None:
    """Bytes of the tables df reads, by Catalyst's statistics (after column pruning); None on a session that has no access to its plans."""
    plan = getattr(df, "_jdf", None)
    if plan is None:
        return None
    leaves = plan.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def is_small(df: DataFrame) -> bool:
    size = input_bytes(df)
    return size is not None and size <= SMALL_BYTES


def spread(df: DataFrame) -> DataFrame:
    """A small input that arrives in few splits, over all cores; for work that costs far more than moving the rows."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if is_small(df) and df.rdd.getNumPartitions() < cores else df


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int | None = None) -> DataFrame | None:
    """Keys with more than ``hot_rows`` rows, or None if there are none. All of them: up to SENT_KEYS as a local table, more as a stored one.

    With the default threshold small inputs are not searched. The search reads the key columns only and counts on
    the map side.
    """
    if hot_rows is None:
        if is_small(df):
            return None
        hot_rows = HOT_ROWS
    found = (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > hot_rows).select(*keys)
    )
    rows = found.limit(SENT_KEYS + 1).collect()
    if len(rows) > SENT_KEYS:
        ensure_checkpoint_dir(df.sparkSession)
        return found.checkpoint()
    return df.sparkSession.createDataFrame(rows, found.schema) if rows else None


def is_sent(keys: DataFrame) -> bool:
    """Whether a table of keys is so short that it goes to all tasks."""
    return keys.count() <= SENT_KEYS


def split_hot(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of ordinary keys, rows of hot keys). Up to SENT_KEYS hot keys are broadcast; for more of them the rows of each key are spread over SLICES parts."""
    if is_sent(hot):
        small = F.broadcast(hot)
        return df.join(small, list(keys), "left_anti"), df.join(small, list(keys), "left_semi")
    return _split_spread(df, keys, hot)


def _split_spread(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    marked = join_spread(df, hot.select(*keys, F.lit(True).alias("_hot")), keys, SLICES)
    return marked.where(F.col("_hot").isNull()).drop("_hot"), marked.where(F.col("_hot")).drop("_hot")


def numeric_order(df: DataFrame, name: str) -> Column | None:
    """The order column as a number that sorts the same way, or None for types without one."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.NumericType,)):
        return F.col(name).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(F.col(name)).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(name).cast("timestamp")).cast("double")
    return None


# Hot keys, and keys whose slice bounds (about 2 KB each), are sent to all tasks up to this number; more of them are joined.
SENT_KEYS = 4096
# Parts that the rows of a key are spread over where a table of statistics is joined to them.
SALTS = 16


def join_spread(df: DataFrame, stats: DataFrame, keys: Sequence[str], salts: int = SALTS) -> DataFrame:
    """Left join of statistics, one row per key. The rows of a key (and those without one) are spread over ``salts`` parts by a hash of the row,
    the statistics copied to each, so that a key with most of the rows fills no task by itself. Meant for keys of few values."""
    plain = [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]
    rows = df.withColumn("_salt", F.pmod(F.xxhash64(*plain), F.lit(salts)))
    copies = stats.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
    return rows.join(copies, [*keys, "_salt"], "left").select(*df.columns, *[c for c in stats.columns if c not in keys])


def _text_bounds(df: DataFrame, keys: Sequence[str], name: str, slices: int) -> DataFrame:
    """Per key every 20th, in byte order, of the distinct values with the smallest hashes; few of them pass the map side."""
    some = df.where(F.col(name).isNotNull()).select(*keys, name).distinct()
    some = some.withColumn("_nth", F.row_number().over(W.partitionBy(*keys).orderBy(F.xxhash64(name)))).where(F.col("_nth") <= slices * 20)
    every = F.filter(F.sort_array(F.collect_list(name)), lambda _, i: (i + 1) % 20 == 0)
    return some.groupBy(*keys).agg(every.alias("_bounds"))


def one_group(name: str) -> Column:
    """0 in every row, as a function of a column: a plain constant would be folded out of joins by it, which then are no equi joins."""
    return F.pmod(F.xxhash64(name), F.lit(1))


def with_slice(df: DataFrame, keys: Sequence[str], name: str, slices: int = SLICES) -> DataFrame | None:
    """Adds ``_slice``: for each key its own ranges of one order column, of about equal depth, NULL lowest. None for types without such ranges.

    The bounds are stored once in the shared folder, so that every later use gives the same number for the same value, whatever is computed again. Any
    bounds give right results; good ones even sizes.
    """
    if isinstance(df.schema[name].dataType, T.StringType):
        x, found = F.col(name), _text_bounds(df, keys, name, slices)
    else:
        x = numeric_order(df, name)
        if x is None:
            return None
        probs = F.array(*[F.lit(i / slices) for i in range(1, slices)])
        found = df.groupBy(*keys).agg(F.sort_array(F.percentile_approx(x, probs, slices * 20)).alias("_bounds"))
    # a key without values has no bounds; the first of each 16 bounds are looked at before the 16 themselves
    found = found.where(F.col("_bounds").isNotNull()).withColumn("_firsts", F.filter("_bounds", lambda _, i: i % 16 == 0))
    ensure_checkpoint_dir(df.sparkSession)
    found = found.checkpoint()
    # a NULL among the keys (a tied order column) is a value like any other
    safe = lambda t, prefix: t.select(*[c for c in t.columns if c not in keys], *[F.col(c).alias(f"{prefix}{c}") for c in keys])
    if found.count() <= SENT_KEYS:
        same = [F.col(c).eqNullSafe(F.col(f"_b_{c}")) for c in keys]
        rows = df.join(F.broadcast(safe(found, "_b_")), same, "left").drop(*[f"_b_{c}" for c in keys])
    else:
        rows = join_spread(df, found, keys)

    def reached(bounds: Column) -> Column:
        return F.size(F.filter(bounds, lambda b: b <= x))

    block = reached(F.col("_firsts"))
    fine = F.when(block > 0, (block - 1) * 16 + reached(F.slice("_bounds", (block - 1) * 16 + 1, F.lit(16))))
    number = F.when(x.isNull(), F.lit(-1)).otherwise(F.coalesce(fine, F.lit(0)))
    return rows.withColumn("_slice", number).select(*df.columns, "_slice")


# Rows of a key with one value of an order column above which the next order column cuts them.
TIED_ROWS = HOT_ROWS // 16


def with_order_slice(df: DataFrame, keys: Sequence[str], order: Sequence[str], tied_rows: int | None = None, slices: int = SLICES) -> DataFrame | None:
    """Adds ``_slice``, an array that sorts as the whole order does: for each key the slice of the first order column, then, where more than ``tied_rows``
    rows share a value of it (or have none), where such values lie and the slices of these rows by the next columns. None if the first column's type has no slices.

    Equal values of the whole order stay together, so slices are even unless the order is not total.
    """
    first, rest = order[0], list(order[1:])
    cut = with_slice(df, keys, first, slices)
    if cut is None:
        return None
    tied = hot_keys(df, [*keys, first], TIED_ROWS if tied_rows is None else tied_rows) if rest else None
    if tied is None:
        return cut.withColumn("_slice", F.array(F.col("_slice").cast("int")))
    known = tied.where(F.col(first).isNotNull()).groupBy(*keys).agg(F.array_sort(F.collect_list(first)).alias("_tied"))
    sent = is_sent(tied)
    cut = cut.join(F.broadcast(known), list(keys), "left") if sent else join_spread(cut, known, keys, slices)
    x = F.col(first)
    # even numbers lie between the tied values, odd ones are the tied values themselves; rows without a value come first
    below = F.coalesce(F.size(F.filter("_tied", lambda v: v < x)), F.lit(0))
    here = F.coalesce(F.array_contains("_tied", x), F.lit(False)).cast("int")
    place = F.array(F.col("_slice").cast("int"), F.when(x.isNull(), F.lit(-1)).otherwise(2 * below + here).cast("int"))
    placed = cut.withColumn("_slice", place).drop("_tied")
    if sent:
        match = F.broadcast(tied.select(*[F.col(c).alias(f"_t_{c}") for c in (*keys, first)]))
        same = [F.col(c).eqNullSafe(F.col(f"_t_{c}")) for c in (*keys, first)]
        single, many = placed.join(match, same, "left_anti"), placed.join(match, same, "left_semi")
    else:
        # equality of structs takes a NULL inside as a value like any other
        with_key = lambda t: t.withColumn("_key", F.struct(*keys, first))
        single, many = (t.drop("_key") for t in _split_spread(with_key(placed), ["_key"], with_key(tied)))
    many = many.withColumnRenamed("_slice", outer := f"_outer{len(rest)}")
    inner = with_order_slice(many, [*keys, first], rest, tied_rows, slices)
    if inner is None:
        return placed
    return single.unionByName(inner.withColumn("_slice", F.concat(outer, "_slice")).select(*single.columns))


# Keys that join_counted sends to all tasks: at most so many, and any other key has at most that part of all rows.
SENT_SHARE = 1 << 14


def join_counted(df: DataFrame, stats: DataFrame, key: str | Sequence[str], weight: str, share: int | None = None) -> DataFrame:
    """Inner join of ``stats``, one row per key, whose column ``weight`` tells how many rows of ``df`` the key has.

    A stats table of up to ``share`` rows is sent to the tasks. Of a longer one the keys with more than 1 / share of all rows are sent (there are fewer
    than ``share``) and the others are joined, so no task gets a hot key however the keys are dealt. ``df`` is then read twice; store it before.
    """
    share, key = share or SENT_SHARE, as_list(key)
    keys, rows = stats.agg(F.count(F.lit(1)), F.coalesce(F.sum(weight), F.lit(0))).first()
    if keys <= share:
        return df.join(F.broadcast(stats), key)
    usual = F.broadcast(stats.where(F.col(weight) > float(rows) / share))
    rare = stats.where(F.col(weight) <= float(rows) / share)
    return df.join(usual, key).unionByName(df.join(usual.select(key), key, "left_anti").join(rare, key))
