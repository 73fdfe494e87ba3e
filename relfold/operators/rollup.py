"""Roll-ups: one or two levels of history folded into one row per key.

All algebraic aggregates of a roll-up, over any number of trailing windows and conditions, share one scan and one
shuffle. Exact medians and distinct counts of ordinary keys are part of it. Windows of keys with many rows can
be sums of disjoint bands (see bands). For hot keys distinct counts first de-duplicate by key and value, medians use value
refinement, each for all columns at once, and everything else combines on the map side, so a hot key costs one buffer
per map task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relfold.functions.aggregates import DISTINCT, HOLISTIC, aggregate_text
from relfold.operators.bands import Bands, Window, common_time
from relfold.operators.hotkeys import as_list, drop_null_keys, hot_keys, split_hot
from relfold.operators.quantile import exact_quantiles

Spec = Mapping[str, Sequence[str]]


@dataclass(frozen=True)
class Item:
    """One output column: an aggregate of a source column, possibly under a condition. Of an item over a trailing window, ``cond`` is the whole condition."""

    fn: str
    source: str
    name: str
    cond: Column | str | None = None
    window: Window | None = None

    @property
    def base(self) -> Column | str | None:
        """The condition without the window."""
        if self.window is None:
            return self.cond
        return None if self.cond == self.window.text else self.cond.removesuffix(f") AND {self.window.text}").removeprefix("(")


def spec_items(spec: Spec, prefix: str = "", suffix: str = "", cond: Column | str | None = None) -> list[Item]:
    return [Item(fn, c, f"{prefix}{c}_{fn}{suffix}", cond) for c, fns in spec.items() for fn in fns]


def windowed(item: Item, window: Window) -> Item:
    """The item over a trailing window only."""
    return replace(item, cond=f"({item.cond}) AND {window.text}" if item.cond else window.text, window=window)


def window_items(time: str, windows: Sequence[int], spec: Spec, prefix: str = "", unit: str = "",
                 inclusive: bool = False) -> list[Item]:
    """The spec once per trailing window; time counts backwards from 0, so newer than w means time > -w."""
    out = []
    for w in windows:
        out += [windowed(i, Window(time, w, inclusive)) for i in spec_items(spec, prefix, f"_{w}{unit}")]
    return out


def _typed(df: DataFrame, source: str) -> str:
    """A column as a struct of a whole number, a real number and a text, one of them set, so that columns of all types stand below each other."""
    kind = df.schema[source].dataType
    slots = ["CAST(NULL AS BIGINT)", "CAST(NULL AS DOUBLE)", "CAST(NULL AS STRING)"]
    whole, real = isinstance(kind, T.IntegralType), isinstance(kind, (T.DoubleType, T.FloatType))
    slots[0 if whole else 1 if real else 2] = f"CAST({source} AS {'BIGINT' if whole else 'DOUBLE' if real else 'STRING'})"
    return f"{slots[0]} AS _i, {slots[1]} AS _d, {slots[2]} AS _t"


def _distinct_counts(df: DataFrame, keys: list[str], items: Sequence[Item]) -> DataFrame:
    """Distinct values per key of any number of columns under any number of conditions, in one pass.

    The columns stand below each other: one row per (key, column, value) first, flagged by the conditions any of its rows meets; then the flags are counted.
    """
    sources = list(dict.fromkeys(i.source for i in items))
    met = [f"CASE WHEN {i.cond} THEN 1 ELSE 0 END" if i.cond is not None else "1" for i in items]
    rows = df.selectExpr(*keys, *[f"{m} AS _f{k}" for k, m in enumerate(met)],
                         f"explode(array({', '.join(f'struct({n} AS _c, {_typed(df, c)})' for n, c in enumerate(sources))})) AS _s")
    values = fold(rows, [*keys, "_s"], [f"max(_f{k}) AS _f{k}" for k in range(len(items))])
    counts = []
    for k, i in enumerate(items):
        own = f"_s._c = {sources.index(i.source)}"
        count = f"coalesce(sum(_f{k}) FILTER (WHERE {own} AND (_s._i IS NOT NULL OR _s._d IS NOT NULL OR _s._t IS NOT NULL)), 0)"
        counts.append(f"CASE WHEN max(_f{k}) FILTER (WHERE {own}) > 0 THEN {count} END AS {i.name}")
    return fold(values, keys, counts)


def _medians(df: DataFrame, keys: list[str], items: Sequence[Item]) -> DataFrame:
    """Exact medians of any number of columns under any number of conditions: the values stand below each other, so one refinement finds them all."""
    values = ", ".join(f"struct({k} AS _item, CAST({i.source if i.cond is None else f'CASE WHEN {i.cond} THEN {i.source} END'} AS DOUBLE) AS _x)" for k, i in enumerate(items))
    stacked = df.selectExpr(*keys, f"inline(array({values}))")
    found = exact_quantiles(stacked, [*keys, "_item"], "_x")
    return fold(found, keys, [f"max(q0) FILTER (WHERE _item = {k}) AS {i.name}" for k, i in enumerate(items)])


def fold(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One statement: the aggregate columns (SQL text) per key."""
    names = ", ".join(keys)
    return df.sparkSession.sql(f"SELECT {names}, {', '.join(columns)} FROM {{rows}} GROUP BY {names}", rows=df)


def with_text(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add or replace columns given as SQL text, in one projection."""
    old = df.columns
    kept = [f"{columns[c]} AS {c}" if c in columns else c for c in old]
    return df.selectExpr(*kept, *[f"{e} AS {n}" for n, e in columns.items() if n not in old])


def _named_conditions(df: DataFrame, items: Sequence[Item]) -> tuple[DataFrame, list[Item]]:
    """Conditions given as Columns become boolean row columns that the SQL text can name."""
    new = {f"_cond{k}": i.cond for k, i in enumerate(items) if isinstance(i.cond, Column)}
    if not new:
        return df, list(items)
    texts = [replace(i, cond=f"_cond{k}") if f"_cond{k}" in new else i for k, i in enumerate(items)]
    return df.withColumns(new), texts


# With more aggregates than this, one partial buffer is wider than the few rows of a key that meet in one map task.
WIDE = 32


def rollup_items(df: DataFrame, key, items: Sequence[Item], order: Sequence[str] | None = None, extra: Sequence[str] = (),
                 hot_rows: int | None = None, derive: Sequence[Mapping[str, str]] = (), together: Sequence[str] | None = None,
                 bands: bool = False) -> DataFrame:
    """One row per key with every item, plus any extra aggregate columns ("text AS name").

    A narrow roll-up combines on the map side and shuffles buffers. A wide one shuffles the pruned input rows by the
    key and folds them there, because hundreds of partial aggregates per key outweigh the rows they stand for; only
    hot keys keep the map-side combine. ``derive`` adds row columns after that shuffle. ``together`` (some of the
    keys) asks for the shuffle by those, so that a following roll-up by them needs none. ``bands`` folds the trailing
    windows of a wide roll-up by disjoint bands, which pays where keys have many more rows than there are windows; for
    hot keys that is always done.
    """
    keys = as_list(key)
    order = as_list(order) if order else None
    df = drop_null_keys(df, keys)
    wide = len(items) + len(extra) > WIDE
    place = as_list(together or keys)
    holistic = [i for i in items if i.fn in HOLISTIC | DISTINCT]
    hot = hot_keys(df, place, hot_rows) if holistic or wide else None

    def prepare(rows: DataFrame) -> tuple[DataFrame, list[Item]]:
        for stage in derive:
            rows = with_text(rows, stage)
        return _named_conditions(rows, items)

    def columns(of: Sequence[Item]) -> list[str]:
        return [*[f"{aggregate_text(i.fn, i.source, i.cond, order)} AS {i.name}" for i in of], *extra]

    windows = common_time(items) if not extra and all(i.window or not isinstance(i.cond, Column) for i in items) else []

    def folded(rows: DataFrame, of: Sequence[Item], banded: bool) -> DataFrame:
        return Bands(keys, of, windows, order).fold(rows) if banded and len(windows) > 1 else fold(rows, keys, columns(of))

    def by_key(rows: DataFrame) -> DataFrame:
        # no key here has more than HOT_ROWS rows, so exact medians and distinct sets fit one task
        return folded(*prepare(rows.repartition(*place) if wide else rows), bands and wide)

    if hot is None:
        return by_key(df)
    cold, heavy = split_hot(df, place, hot)
    heavy, named = prepare(heavy)
    simple = [i for i in named if i.fn not in HOLISTIC | DISTINCT]
    distinct, medians = ([i for i in named if i.fn in kind] for kind in (DISTINCT, HOLISTIC))
    parts = [folded(heavy, simple, True)] if simple else [fold(heavy, keys, extra)] if extra else []
    parts += [_distinct_counts(heavy, keys, distinct)] if distinct else []
    parts += [_medians(heavy, keys, medians)] if medians else []
    done = parts[0]
    for part in parts[1:]:
        done = done.join(part, keys, "left")
    return by_key(cold).unionByName(done)


def rollup(df: DataFrame, key, spec: Spec, order=None, prefix: str = "", suffix: str = "",
           hot_rows: int | None = None) -> DataFrame:
    """Flat roll-up named ``{prefix}{column}_{function}{suffix}``."""
    return rollup_items(df, key, spec_items(spec, prefix, suffix), order, hot_rows=hot_rows)


def rollup_windows(df: DataFrame, key, time: str, windows: Sequence[int], spec: Spec, order=None, prefix: str = "",
                   unit: str = "", inclusive: bool = False, hot_rows: int | None = None, bands: bool = False) -> DataFrame:
    """The same spec over several trailing windows in one pass; NULL where a key has no row in a window."""
    items = window_items(time, windows, spec, prefix, unit, inclusive)
    widest = max(windows)
    kept = df.where(F.col(time) >= -widest if inclusive else F.col(time) > -widest)
    return rollup_items(kept, key, items, order, hot_rows=hot_rows, bands=bands)


def rollup_two_level(df: DataFrame, entity, child, inner: Spec, outer: Spec, order=None, prefix: str = "",
                     suffix: str = "", cond: Column | str | None = None) -> DataFrame:
    """Per (entity, child) first, then those child values per entity. Outer columns name inner results."""
    per_child = rollup_items(df, [*as_list(entity), *as_list(child)], spec_items(inner, cond=cond), order)
    return rollup(per_child, entity, outer, prefix=prefix, suffix=suffix)


def rollup_two_hop(link: DataFrame, detail: DataFrame, child: str, entity: str, inner: Spec, outer: Spec,
                   order=None, prefix: str = "") -> DataFrame:
    """Detail rows know the child only: roll up per child, bring it to the link table, roll up per entity."""
    per_child = rollup(detail, child, inner, order)
    linked = link.select(entity, child).join(per_child, child, "left")
    return rollup(linked, entity, outer, prefix=prefix)


def left_rollup(entity: DataFrame, agg: DataFrame, key) -> DataFrame:
    """Every entity row, with the roll-up's columns; NULL where the entity has no child."""
    return entity.join(agg, as_list(key), "left")


def group_feature(data: DataFrame, stat: DataFrame, key, value: str, fn: str, name: str | None = None,
                  order=None) -> DataFrame:
    """Aggregate ``stat`` per key and bring the one result column to ``data``."""
    name = name or f"{value}_{fn}"
    return left_rollup(data, rollup_items(stat, key, [Item(fn, value, name)], order), key)


def group_nunique_with_null(df: DataFrame, key, value: str, name: str) -> DataFrame:
    """Distinct values per key, NULL counting as a value."""
    keys = as_list(key)
    rows = drop_null_keys(df, keys).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


# ---------------------------------------------------------------- conditions and statuses


def literal(value) -> str:
    """A category value as SQL text."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(value, str) else str(value)


def status_items(status: str, values: Mapping[str, str], spec: Spec, prefix: str = "") -> list[Item]:
    """The spec once per status value; ``values`` maps the value in the data to its name in the output."""
    out = []
    for value, label in values.items():
        out += spec_items(spec, f"{prefix}{label}_", cond=f"{status} = {literal(value)}")
    return out


def status_rollup(df: DataFrame, key, status: str, values: Mapping[str, str], spec: Spec,
                  zero_filled: Sequence[str] = ("count", "size", "sum")) -> DataFrame:
    """Statistics per status in one pass; the functions in ``zero_filled`` read 0 where no row has the status."""
    items = status_items(status, values, spec)
    out = rollup_items(df, key, items)
    fills = {i.name: F.coalesce(F.col(i.name), F.lit(0)) for i in items if i.fn in zero_filled}
    return out.withColumns(fills) if fills else out


def positive_stats(df: DataFrame, key, value: str, fns: Sequence[str], order=None, suffix: str = "") -> DataFrame:
    """Statistics over the rows where the value is above zero, for every key."""
    return rollup_items(df, key, [Item(fn, value, f"{value}_{fn}{suffix}", F.col(value) > 0) for fn in fns], order)


def worst_row(df: DataFrame, key, level: str, time: str, level_name: str = "worst", time_name: str = "worst_time") -> DataFrame:
    """Highest level per key and the (latest) time it was reached."""
    keys = as_list(key)
    top = F.max(F.when(F.col(level).isNotNull(), F.struct(F.col(level).alias("l"), F.col(time).alias("t"))))
    rows = drop_null_keys(df, keys).groupBy(*keys).agg(top.alias("_w")).where(F.col("_w").isNotNull())
    return rows.select(*keys, F.col("_w.l").alias(level_name), F.col("_w.t").alias(time_name))


def status_span(df: DataFrame, key, status: str, values: Mapping[str, str], time: str) -> DataFrame:
    """Per status: number of rows, earliest and latest time."""
    items = []
    for value, label in values.items():
        cond = f"{status} = {literal(value)}"
        items += [Item("size", time, f"{label}_count", cond), Item("min", time, f"{label}_min", cond),
                  Item("max", time, f"{label}_max", cond)]
    return rollup_items(df, key, items)


# ---------------------------------------------------------------- pivots and shares


def pivot_values(df: DataFrame, category: str, limit: int = 1000) -> list:
    """The distinct values of a category column, sorted; fails above ``limit`` because each becomes a column."""
    rows = df.select(category).where(F.col(category).isNotNull()).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{category} has more than {limit} values; it is not a category")
    return sorted(r[0] for r in rows)


def category_frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, rows, others) of every value of several text columns, NULL included, in one pass; ``others`` are the rows with another value."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    counted = df.select(F.explode(pairs).alias("p")).groupBy(F.col("p.column").alias("column"), F.col("p.value").alias("value")).agg(F.count(F.lit(1)).alias("rows"))
    return counted.withColumn("others", df.select(F.count(F.lit(1))).scalar() - F.col("rows"))


def common_values(df: DataFrame, columns: Sequence[str], min_count: int = 0, limit: int = 1000) -> dict[str, list]:
    """Sorted values of each column, NULL last, that at least ``min_count`` rows have and at least as many have not: those worth a 0/1 column.

    Fails above ``limit`` such values in a column, since each becomes a column.
    """
    if not columns:
        return {}
    kept = category_frequencies(df, columns)
    if min_count:
        kept = kept.where((F.col("rows") >= min_count) & (F.col("others") >= min_count))
    found: dict[str, list] = {c: [] for c in columns}
    for r in kept.select("column", "value").limit((limit + 1) * len(columns) + 1).collect():
        found[r["column"]].append(r["value"])
    if full := [c for c, values in found.items() if len(values) > limit + (None in values)]:
        raise ValueError(f"{full} have more than {limit} values; they are no categories")
    return {c: sorted(values, key=lambda v: (v is None, v or "")) for c, values in found.items()}


def column_label(value) -> str:
    """A category value as part of a column name: lower case, other characters to underscores."""
    text = "".join(ch if ch.isalnum() else "_" for ch in str(value).lower())
    while "__" in text:
        text = text.replace("__", "_")
    return text.strip("_")


def pivot_items(category: str, values: Sequence, spec: Spec | None = None, prefix: str | None = None,
                where: str | None = None) -> list[Item]:
    """Per category value a row count (no spec) or the spec; conditional aggregates, so one shuffle for all."""
    prefix = f"{category}_" if prefix is None else prefix
    out = []
    for v in values:
        cond = f"{category} = {literal(v)}" + (f" AND ({where})" if where else "")
        label = column_label(v)
        if spec is None:
            out.append(Item("size", category, f"{prefix}{label}_count", cond))
        else:
            out += [Item(fn, c, f"{prefix}{label}_{c}_{fn}", cond) for c, fns in spec.items() for fn in fns]
    return out


def pivot_count(df: DataFrame, key, category: str, values: Sequence, prefix: str | None = None) -> DataFrame:
    """Rows per category value as columns, NULL for an absent value; keys without any of the values are left out."""
    return rollup_items(df.where(F.col(category).isin(list(values))), key, pivot_items(category, values, prefix=prefix))


def pivot_stats(df: DataFrame, key, category: str, values: Sequence, spec: Spec, prefix: str | None = None) -> DataFrame:
    return rollup_items(df.where(F.col(category).isin(list(values))), key, pivot_items(category, values, spec, prefix))


def pivot_share(df: DataFrame, key, category: str, values: Sequence, prefix: str | None = None) -> DataFrame:
    """Share of the key's rows that have each category value, NULL for an absent value."""
    counts = rollup_items(df, key, pivot_items(category, values, prefix=prefix), extra=["count(1) AS _rows"])
    names = [i.name for i in pivot_items(category, values, prefix=prefix)]
    return counts.select(*as_list(key), *[F.try_divide(F.col(n).cast("double"), F.col("_rows")).alias(f"{n}_share") for n in names])


def category_items(category: str, values: Sequence, fns: Sequence[str] = ("mean", "sum"), prefix: str = "",
                   null_category: bool = False, cond: Column | None = None, suffix: str = "") -> list[Column]:
    """Mean (share) and sum (count) of the 0/1 column of each value, without building those columns."""
    out = []
    tests = [(column_label(v), F.coalesce(F.col(category) == F.lit(v), F.lit(False))) for v in values]
    if null_category:
        tests.append(("null", F.col(category).isNull()))
    for label, test in tests:
        flag = F.when(test, 1).otherwise(0)
        if cond is not None:
            flag = F.when(cond, flag)
        for fn in fns:
            value = {"mean": F.avg, "sum": F.sum, "min": F.min, "max": F.max}[fn](flag)
            out.append(value.alias(f"{prefix}{category}_{label}_{fn}{suffix}"))
    return out


def category_rollup(df: DataFrame, key, category: str, values: Sequence, fns=("mean", "sum"), null_category: bool = False) -> DataFrame:
    keys = as_list(key)
    return drop_null_keys(df, keys).groupBy(*keys).agg(*category_items(category, values, fns, null_category=null_category))


# ---------------------------------------------------------------- patterns over children


def peak_ratio(df: DataFrame, entity, child, num: str, den: str, name: str = "peak_ratio", cond: Column | None = None) -> DataFrame:
    """Per child max(num) / max(den); per entity the mean of it, and that mean over the number of children."""
    keys = as_list(entity)
    rows = df if cond is None else df.where(cond)
    per_child = drop_null_keys(rows, [*keys, child]).groupBy(*keys, child).agg(
        F.try_divide(F.max(num).cast("double"), F.max(den).cast("double")).alias("_r"))
    return per_child.groupBy(*keys).agg(
        F.avg("_r").alias(name), F.try_divide(F.avg("_r"), F.count(F.lit(1)).cast("double")).alias(f"{name}_per_child"))


def sum_of_max(df: DataFrame, entity, child, value: str, name: str = "sum_of_max") -> DataFrame:
    keys = as_list(entity)
    per_child = drop_null_keys(df, [*keys, child]).groupBy(*keys, child).agg(F.max(value).alias("_m"))
    return per_child.groupBy(*keys).agg(F.coalesce(F.sum("_m"), F.lit(0)).alias(name))


def max_then(df: DataFrame, entity, child, value: str, fns: Sequence[str] = ("min", "mean")) -> DataFrame:
    """Max per child, then statistics of it per entity."""
    per_child = drop_null_keys(df, [*as_list(entity), child]).groupBy(*as_list(entity), child).agg(F.max(value).alias(f"{value}_max"))
    return rollup(per_child, entity, {f"{value}_max": list(fns)})


def changed_terms(df: DataFrame, entity, child, term: str, status: str, completed) -> DataFrame:
    """Children whose term changed (closed early) or not (on time), among all and among completed ones."""
    keys = as_list(entity)
    per_child = drop_null_keys(df, [*keys, child]).groupBy(*keys, child).agg(
        # more than one distinct non-null value
        F.coalesce(F.min(term) < F.max(term), F.lit(False)).cast("int").alias("_changed"),
        F.max(F.when(F.col(status) == F.lit(completed), 1).otherwise(0)).alias("_done"))
    done_changed = F.sum(F.col("_changed") * F.col("_done"))
    out = per_child.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("children"), F.sum("_changed").alias("changed"),
        F.sum("_done").alias("completed"), done_changed.alias("completed_changed"))
    return out.select(
        *keys, "children", "changed", (F.col("children") - F.col("changed")).alias("on_time"),
        F.try_divide((F.col("children") - F.col("changed")).cast("double"), F.col("children")).alias("on_time_share"),
        "completed", "completed_changed", (F.col("completed") - F.col("completed_changed")).alias("completed_on_time"),
        F.try_divide((F.col("completed") - F.col("completed_changed")).cast("double"), F.col("completed")).alias("completed_on_time_share"))


def snapshot_counts(df: DataFrame, entity, child, time: str, at: int, status: str, statuses: Mapping[str, str]) -> DataFrame:
    """Distinct children with a row at time ``at``: all, per status, and those that began then."""
    keys = as_list(entity)
    now = F.col(time) == F.lit(at)
    per_child = drop_null_keys(df, [*keys, child]).groupBy(*keys, child).agg(
        F.max(F.when(now, 1).otherwise(0)).alias("_here"), F.min(time).alias("_begin"),
        *[F.max(F.when(now & (F.col(status) == F.lit(v)), 1).otherwise(0)).alias(f"_is_{label}") for v, label in statuses.items()])
    out = per_child.groupBy(*keys).agg(
        F.sum("_here").alias("snapshot_children"),
        F.sum(F.col("_here") * F.when(F.col("_begin") == F.lit(at), 1).otherwise(0)).alias("snapshot_opened"),
        *[F.sum(f"_is_{label}").alias(f"snapshot_{label}") for label in statuses.values()])
    out = out.where(F.col("snapshot_children") > 0)
    shares = {f"snapshot_{label}_share": F.try_divide(F.col(f"snapshot_{label}").cast("double"), F.col("snapshot_children"))
              for label in statuses.values()}
    return out.withColumns(shares)


def children_with(df: DataFrame, entity, child, conds: Mapping[str, Column]) -> DataFrame:
    """Distinct children having at least one row that meets each condition."""
    keys = as_list(entity)
    per_child = drop_null_keys(df, [*keys, child]).groupBy(*keys, child).agg(
        *[F.max(F.when(c, 1).otherwise(0)).alias(n) for n, c in conds.items()])
    return per_child.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in conds])


def last_status_pivot(df: DataFrame, entity, child, order, status: str, values: Sequence) -> DataFrame:
    """Status of the newest row of each child, counted per entity; share of children as well."""
    keys = as_list(entity)
    newest = F.max_by(status, F.struct(*as_list(order)))
    per_child = drop_null_keys(df, [*keys, child]).groupBy(*keys, child).agg(newest.alias("_last"))
    items = pivot_items("_last", values, prefix="last_")
    out = rollup_items(per_child, entity, items, extra=["count(1) AS _children"])
    return out.select(*keys, *[i.name for i in items], *[
        F.try_divide(F.col(i.name).cast("double"), F.col("_children")).alias(f"{i.name}_share") for i in items])


def last_minus_first(df: DataFrame, key, order, value: str, name: str | None = None) -> DataFrame:
    """Newest minus oldest non-null value."""
    out = rollup(df, key, {value: ["first", "last"]}, order)
    return out.select(*as_list(key), (F.col(f"{value}_last") - F.col(f"{value}_first")).alias(name or f"{value}_last_minus_first"))


def paid_vs_due(df: DataFrame, key, due: str, paid: str, due_day: str, paid_day: str) -> DataFrame:
    """Totals due and paid, the gap, and the shares of late rows and of rows paid in full."""
    keys = as_list(key)
    late = F.coalesce(F.col(paid_day) > F.col(due_day), F.lit(False)).cast("int")
    full = F.coalesce(F.col(paid) >= F.col(due), F.lit(False)).cast("int")
    out = drop_null_keys(df, keys).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(due), F.lit(0)).alias("due_sum"),
        F.coalesce(F.sum(paid), F.lit(0)).alias("paid_sum"), F.avg(late).alias("late_share"), F.avg(full).alias("full_share"))
    return out.withColumn("gap", F.col("due_sum") - F.col("paid_sum"))


