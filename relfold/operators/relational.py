"""Row sets and joins: projection helpers, membership, null handling, lookups, semi and anti joins."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relfold.operators.hotkeys import as_list, drop_null_keys, hot_keys, split_hot


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def where_in(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.where(F.col(column).isin(list(values)))


def where_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull())


def null_out(df: DataFrame, column: str, cond: Column) -> DataFrame:
    """Null the column where the condition holds (sentinels, impossible values, labels to hide)."""
    return df.withColumn(column, F.when(F.coalesce(cond, F.lit(False)), F.lit(None)).otherwise(F.col(column)))


def append(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of both, matched by column name; a column missing on one side is NULL there."""
    return a.unionByName(b, allowMissingColumns=True)


def except_ids(a: DataFrame, b: DataFrame, key) -> DataFrame:
    """Distinct ids of a that are not in b."""
    keys = as_list(key)
    return a.select(*keys).distinct().join(b.select(*keys).distinct(), keys, "left_anti")


def tag_columns(df: DataFrame, prefix: str = "", suffix: str = "", keep: Sequence[str] = (), unless: str | None = None) -> DataFrame:
    """Prefix / suffix every column but the kept ones (and those whose name already has ``unless`` in it)."""
    new = {c: f"{prefix}{c}{suffix}" for c in df.columns if c not in keep and not (unless and unless in c)}
    return df.withColumnsRenamed(new)


def columns_like(df: DataFrame, include: str, exclude: Sequence[str] = ()) -> list[str]:
    """Names containing ``include`` and none of ``exclude``."""
    return [c for c in df.columns if include in c and not any(e in c for e in exclude)]


def distinct(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


def dedup_keep(df: DataFrame, key, order, keep: str = "last") -> DataFrame:
    """One whole row per key: the last or first in the order. An aggregate, so it combines on the map side."""
    keys = as_list(key)
    rest = [c for c in df.columns if c not in keys]
    pick = F.max_by if keep == "last" else F.min_by
    rows = df.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*as_list(order))).alias("_r"))
    return rows.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*df.columns)


def lookup(df: DataFrame, dim: DataFrame, key, value: str, name: str | None = None, dim_key=None) -> DataFrame:
    """Value by key from a table with one row per key; NULL where there is no match."""
    keys, dim_keys = as_list(key), as_list(dim_key or key)
    side = dim.select(*[F.col(d).alias(k) for d, k in zip(dim_keys, keys)], F.col(value).alias(name or value))
    return df.join(side, keys, "left")


def keep_in(df: DataFrame, ids: DataFrame, key) -> DataFrame:
    return df.join(ids.select(*as_list(key)), as_list(key), "left_semi")


def drop_in(df: DataFrame, ids: DataFrame, key) -> DataFrame:
    return df.join(ids.select(*as_list(key)), as_list(key), "left_anti")


def assemble(blocks: Sequence[DataFrame], key, transform: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Feature blocks of the same entities side by side. The first block decides which entities there are.

    Each block has one row per entity, so the joins are one to one and need no shuffle beyond the blocks' own.
    """
    out = blocks[0]
    for block in blocks[1:]:
        out = out.join(block, as_list(key), "left")
    return out.transform(transform) if transform else out


def fill_mean(df: DataFrame, columns) -> DataFrame:
    """NULLs replaced by the column's mean over the table (a scalar subquery)."""
    means = {c: df.select(F.avg(c)).scalar() for c in as_list(columns)}
    return df.withColumns({c: F.coalesce(F.col(c), m) for c, m in means.items()})


# fixed type limits: (type, lowest, highest)
INT_LIMITS = [("tinyint", -128, 127), ("smallint", -32768, 32767), ("int", -2147483648, 2147483647)]
FLOAT_LIMIT = 2147483600


def narrow_types(df: DataFrame) -> DataFrame:
    """Cast numbers to the smallest type that holds their range, measured in one aggregate over the table."""
    whole = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.ShortType, T.IntegerType, T.LongType))]
    real = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    if not whole + real:
        return df
    found = df.agg(*[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in whole + real]).first()
    casts = {}
    for c in whole:
        lo, hi = found[c]["lo"], found[c]["hi"]
        if lo is None:
            continue
        now = df.schema[c].dataType.simpleString()
        for name, low, high in INT_LIMITS:
            if low <= lo and hi <= high:
                if name != now:
                    casts[c] = F.col(c).cast(name)
                break
    for c in real:
        lo, hi = found[c]["lo"], found[c]["hi"]
        if lo is not None and -FLOAT_LIMIT < lo and hi < FLOAT_LIMIT:
            casts[c] = F.col(c).cast("float")
    return df.withColumns(casts) if casts else df


# Tokens of a hot id that one task joins at a time.
SEGMENT = 100_000


def tokens_per(df: DataFrame, key: str, token: str, per_row: int | None = None, name: str = "tokens",
               hot_rows: int | None = None, order: str | Sequence[str] = ()) -> DataFrame:
    """Values of a column joined by blanks: one row per id, (id, part, tokens) with part 0.

    Tokens follow the ``order`` columns (those of their arrival, say; NULL first), ties by the token; without such columns they are sorted. NULL tokens
    are left out, and so are ids that have no other tokens and rows without an id.

    An ordinary id is one aggregate. The rows of a hot id are spread over tasks: equal rows are counted, cut by their positions into segments, and only
    the finished strings of its segments meet, in the row that holds them. ``per_row`` gives documents of more tokens further rows (parts 1, 2, ...), for
    ids whose document is too long for one value.
    """
    order = as_list(order)
    named = {f"_o{i}": F.col(c) for i, c in enumerate(order)}
    words = drop_null_keys(df, [key]).select(F.col(key), *[c.alias(n) for n, c in named.items()], F.col(token).cast("string").alias("_t"))
    words, sorting = words.where(F.col("_t").isNotNull()), [*named, "_t"]
    if per_row is not None:
        return _segments(words, key, sorting, per_row, name, hot_rows)
    hot = hot_keys(words, [key], hot_rows)
    cold, heavy = (words, None) if hot is None else split_hot(words, [key], hot)
    placed = F.array_sort(F.collect_list(F.struct(*sorting)))
    out = cold.groupBy(key).agg(F.array_join(F.transform(placed, lambda s: s["_t"]), " ").alias(name))
    if heavy is not None:
        segments = _segments(heavy, key, sorting, SEGMENT, name, hot_rows)
        strings = F.transform(F.array_sort(F.collect_list(F.struct("part", name))), lambda s: s[name])
        out = out.unionByName(segments.groupBy(key).agg(F.array_join(strings, " ").alias(name)))
    return out.select(key, F.lit(0).cast("bigint").alias("part"), name)


def _segments(words: DataFrame, key: str, sorting: Sequence[str], per_row: int, name: str, hot_rows: int | None) -> DataFrame:
    """(id, part, tokens) with at most per_row tokens in a part, by the position of the tokens in their id."""
    from relfold.operators.ordered import with_position

    counted = words.groupBy(key, *sorting).agg(F.count(F.lit(1)).alias("_n"))
    # position of the first copy of each distinct row inside its id
    placed = with_position(counted, key, sorting, "_rank", hot_rows=hot_rows)
    before = _running_before(placed, key, "_rank", "_n")
    first, last = F.col("_before"), F.col("_before") + F.col("_n") - 1
    parts = F.explode(F.sequence(F.floor(first / per_row), F.floor(last / per_row)))
    cut = before.withColumn("part", parts)
    copies = F.least(last, (F.col("part") + 1) * per_row - 1) - F.greatest(first, F.col("part") * per_row) + 1
    cut = cut.withColumn("_copies", copies.cast("int"))
    lists = cut.groupBy(key, "part").agg(F.array_sort(F.collect_list(F.struct(*sorting, "_copies"))).alias("_l"))
    text = F.array_join(F.flatten(F.transform("_l", lambda s: F.array_repeat(s["_t"], s["_copies"]))), " ")
    return lists.select(key, "part", text.alias(name))


def _running_before(df: DataFrame, key: str, position: str, amount: str, block: int = 100_000) -> DataFrame:
    """Running total of ``amount`` before each row, in blocks of positions so that no window holds a whole hot key."""
    from pyspark.sql import Window as W

    cut = df.withColumn("_block", F.floor((F.col(position) - 1) / block))
    inside = W.partitionBy(key, "_block").orderBy(position).rowsBetween(W.unboundedPreceding, -1)
    across = W.partitionBy(key).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    totals = cut.groupBy(key, "_block").agg(F.sum(amount).alias("_sum"))
    totals = totals.select(key, "_block", F.coalesce(F.sum("_sum").over(across), F.lit(0)).alias("_base"))
    return (
        cut.withColumn("_in", F.coalesce(F.sum(amount).over(inside), F.lit(0))).join(totals, [key, "_block"])
        .withColumn("_before", F.col("_in") + F.col("_base")).drop("_in", "_base", "_block")
    )
