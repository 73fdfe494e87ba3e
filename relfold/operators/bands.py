"""Trailing windows by disjoint bands.

Windows that count back from one time are nested, so their edges cut the rows of a key into bands. Each band is folded once, whatever the number of windows;
a window is then the sum of its bands: counts, sums, extremes and ordered picks add up directly, central moments by the rule for joining two samples, from
the newest band on. The number of aggregates over rows grows with the statistics, not with statistics times windows; only the few bands of a key meet the
windows. Distinct counts need no sets: a value counts in the newest band that has it, so all windows are counted from one mark per (key, value).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Window:
    """The rows of the last ``width`` units of a time that counts backwards from 0."""

    time: str
    width: int
    inclusive: bool = False

    @property
    def text(self) -> str:
        return f"{self.time} {'>=' if self.inclusive else '>'} -{self.width}"


@dataclass
class Columns:
    """Expressions named in the order they are asked for; an expression asked for again keeps its name."""

    prefix: str
    names: dict[str, str] = field(default_factory=dict)

    def add(self, text: str) -> str:
        return self.names.setdefault(text, f"{self.prefix}{len(self.names)}")

    def texts(self) -> list[str]:
        return [f"{text} AS {name}" for text, name in self.names.items()]


def only(*conds: str | None) -> str:
    kept = " AND ".join(f"({c})" for c in conds if c)
    return f" FILTER (WHERE {kept})" if kept else ""


def common_time(items: Sequence) -> list[Window]:
    """The windows of the items, narrowest first, if they all count one time in one way; else nothing."""
    found = {i.window for i in items if i.window}
    return sorted(found, key=lambda w: w.width) if len({(w.time, w.inclusive) for w in found}) == 1 else []


MOMENTS = {"std": 2, "var": 2, "skew": 3, "kurt": 4}


class Bands:
    """The columns of each level for a list of items (``fn``, ``source``, ``base``: the condition without the window, ``window``, ``cond``)."""

    def __init__(self, keys: Sequence[str], items: Sequence, windows: Sequence[Window], order: Sequence[str] | None):
        self.keys, self.items, self.windows, self.order = list(keys), items, list(windows), order
        self.marks, self.rows, self.whole = Columns("_new"), Columns("_p"), Columns("_q")
        # highest moment wanted of each (source, condition)
        self.moments: dict[tuple[str, str | None], int] = {}
        for i in items:
            if i.fn in MOMENTS:
                self.moments[i.source, i.base] = max(MOMENTS[i.fn], self.moments.get((i.source, i.base), 0))
        self.formulas = [f"{self.formula(i)} AS {i.name}" for i in items]

    def band(self) -> str:
        cases = " ".join(f"WHEN {w.text} THEN {k}" for k, w in enumerate(self.windows))
        return f"CASE {cases} ELSE {len(self.windows)} END AS _band"

    def upto(self, item) -> str | None:
        return f"_band <= {self.windows.index(item.window)}" if item.window else None

    def of_bands(self, item, fn: str, partial: str) -> str:
        return self.whole.add(f"{fn}({partial}){only(self.upto(item))}")

    def row_sum(self, item, text: str) -> str:
        """A sum over the window of an aggregate over rows."""
        return self.of_bands(item, "sum", self.rows.add(f"{text}{only(item.base)}"))

    def moment(self, item, k: int) -> str:
        place = list(self.moments).index((item.source, item.base))
        return self.of_bands(item, "sum", f"_m{k}_{place}")

    def formula(self, i) -> str:
        """The value of an item from sums over the bands of its window."""
        x = i.source
        rows = self.row_sum(i, "count(1)") if i.cond is not None else None
        given = lambda text: f"CASE WHEN {rows} > 0 THEN {text} END" if rows else text
        known = lambda: self.row_sum(i, f"count({x})")
        extreme = lambda fn: self.of_bands(i, fn, self.rows.add(f"{fn}({x}){only(i.base)}"))
        if i.fn in ("count", "size"):
            return given(f"coalesce({known() if i.fn == 'count' else self.row_sum(i, 'count(1)')}, 0)")
        if i.fn == "sum":
            return given(f"coalesce({self.row_sum(i, f'sum({x})')}, 0)")
        if i.fn == "mean":
            return f"{self.row_sum(i, f'sum(double({x}))')} / nullif({known()}, 0)"
        if i.fn in ("min", "max"):
            return extreme(i.fn)
        if i.fn == "range":
            return f"{extreme('max')} - {extreme('min')}"
        if i.fn in ("std", "var"):
            var = f"CASE WHEN {known()} > 1 THEN {self.moment(i, 2)} / ({known()} - 1) END"
            return var if i.fn == "var" else f"sqrt({var})"
        if i.fn == "skew":
            n = known()
            plain = f"CASE WHEN {extreme('min')} < {extreme('max')} THEN sqrt(double({n})) * {self.moment(i, 3)} / pow({self.moment(i, 2)}, 1.5D) END"
            return f"CASE WHEN {n} >= 3 THEN coalesce({plain} * sqrt(double({n}) * ({n} - 1)) / nullif({n} - 2, 0), 0D) END"
        if i.fn == "kurt":
            return f"CASE WHEN {extreme('min')} < {extreme('max')} THEN {known()} * {self.moment(i, 4)} / pow({self.moment(i, 2)}, 2) - 3 END"
        if i.fn in ("first", "last"):
            fn = "min" if i.fn == "first" else "max"
            return self.of_bands(i, fn, self.rows.add(f"{fn}(struct({', '.join(self.order)}, {x} AS _v)){only(f'{x} IS NOT NULL', i.base)}")) + "._v"
        if i.fn == "median":
            values = self.whole.add(f"sort_array(flatten(collect_list({self.rows.add(f'collect_list({x}){only(i.base)}')}){only(self.upto(i))}))")
            return f"(double(get({values}, int((size({values}) - 1) / 2))) + double(get({values}, int(size({values}) / 2)))) / 2"
        if i.fn == "nunique":
            meets = f"({x} IS NOT NULL" + (f" AND ({i.base}))" if i.base else ")")
            mark = self.marks.add(f"CASE WHEN {meets} AND row_number() OVER (PARTITION BY {', '.join(self.keys)}, {x}, coalesce({meets}, false) ORDER BY _band) = 1 THEN 1 ELSE 0 END")
            return given(f"coalesce({self.of_bands(i, 'sum', self.rows.add(f'sum({mark})'))}, 0)")
        raise ValueError(f"unknown aggregate function: {i.fn}")

    def with_moments(self, bands: DataFrame) -> DataFrame:
        """Adds what each band adds to the central moments of itself and all newer bands together."""
        if not self.moments:
            return bands
        before = f"OVER (PARTITION BY {', '.join(self.keys)} ORDER BY _band ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        stages: list[list[str]] = [[], [], [], []]
        for g, ((x, base), most) in enumerate(self.moments.items()):
            p = lambda text, x=x, base=base: self.rows.names[f"{text.format(x=x)}{only(base)}"]
            n, mean, var = f"double({p('count({x})')})", p("avg({x})"), p("var_pop({x})")
            stages[0] += [f"{n} AS _n{g}", f"coalesce(sum({n}) {before}, 0D) AS _a{g}", f"coalesce(sum({n} * {mean}) {before}, 0D) AS _s{g}", f"coalesce({var} * {n}, 0D) AS _c2_{g}", f"{mean} AS _u{g}"]
            if most > 2:
                stages[0].append(f"coalesce({p('skewness({x})')} * {var} * sqrt({var}) * {n}, 0D) AS _c3_{g}")
            if most > 3:
                stages[0].append(f"coalesce(({p('kurtosis({x})')} + 3) * {var} * {var} * {n}, 0D) AS _c4_{g}")
            a, b, t, d = f"_a{g}", f"_n{g}", f"(_a{g} + _n{g})", f"(_u{g} - _s{g} / _a{g})"
            joint = lambda own, text, a=a, b=b: f"CASE WHEN {a} > 0 AND {b} > 0 THEN {own} + {text} ELSE {own} END"
            stages[1].append(f"{joint(f'_c2_{g}', f'{d} * {d} * {a} * {b} / {t}')} AS _m2_{g}")
            if most > 2:
                stages[2].append(f"coalesce(sum(_m2_{g}) {before}, 0D) AS _r2_{g}")
                third = f"pow({d}, 3) * {a} * {b} * ({a} - {b}) / ({t} * {t}) + 3 * {d} * ({a} * _c2_{g} - {b} * _r2_{g}) / {t}"
                stages[3].append(f"{joint(f'_c3_{g}', third)} AS _m3_{g}")
        for stage in stages:
            if stage:
                bands = bands.selectExpr("*", *stage)
        fourth: list[str] = []
        for g, most in enumerate(self.moments.values()):
            if most > 3:
                a, b, t, d = f"_a{g}", f"_n{g}", f"(_a{g} + _n{g})", f"(_u{g} - _s{g} / _a{g})"
                bands = bands.selectExpr("*", f"coalesce(sum(_m3_{g}) {before}, 0D) AS _r3_{g}")
                text = (f"pow({d}, 4) * {a} * {b} * ({a} * {a} - {a} * {b} + {b} * {b}) / pow({t}, 3) + 6 * {d} * {d} * ({a} * {a} * _c2_{g} + {b} * {b} * _r2_{g}) / ({t} * {t})"
                        f" + 4 * {d} * ({a} * _c3_{g} - {b} * _r3_{g}) / {t}")
                fourth.append(f"CASE WHEN {a} > 0 AND {b} > 0 THEN _c4_{g} + {text} ELSE _c4_{g} END AS _m4_{g}")
        return bands.selectExpr("*", *fourth) if fourth else bands

    def fold(self, rows: DataFrame) -> DataFrame:
        """One row per key with every item."""
        spark, by = rows.sparkSession, ", ".join(self.keys)
        for (x, base), most in self.moments.items():
            for text in ("count({x})", "avg({x})", "var_pop({x})", "skewness({x})", "kurtosis({x})")[: most + 1]:
                self.rows.add(f"{text.format(x=x)}{only(base)}")
        cut = rows.selectExpr("*", self.band())
        if self.marks.names:
            cut = cut.selectExpr("*", *self.marks.texts())
        bands = spark.sql(f"SELECT {', '.join([by, '_band', *self.rows.texts()])} FROM {{rows}} GROUP BY {by}, _band", rows=cut)
        whole = spark.sql(f"SELECT {', '.join([by, *self.whole.texts()])} FROM {{bands}} GROUP BY {by}", bands=self.with_moments(bands))
        return whole.selectExpr(*self.keys, *self.formulas)
