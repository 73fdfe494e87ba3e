"""Hot groups take another route and give the same rows. One key holds a third of the rows here."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from relfold.operators import encode, hotkeys, ordered, quantile, rollup


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(11)
    data = []
    for i in range(3000):
        key = 0 if i % 3 == 0 else rnd.randint(1, 60)
        data.append((key, rnd.randint(0, 40), i, round(rnd.gauss(0, 300), 2) if rnd.random() > 0.1 else None, rnd.choice("abcdefg"), f"t{rnd.randint(0, 400)}"))
    df = spark.createDataFrame(data, "k int, t int, id int, v double, c string, w string").repartition(7)
    return df.checkpoint() if spark.sparkContext.getCheckpointDir() else df


def same(a, b):
    order = sorted(a.columns)
    left = sorted(map(str, a.select(order).collect()))
    assert left == sorted(map(str, b.select(order).collect())) and left


@pytest.mark.parametrize("hot_rows", [0, 500])
@pytest.mark.parametrize("n", [1, 2, 5, 50])
def test_lag_and_lead(skewed, hot_rows, n):
    same(ordered.lag_value(skewed, "k", ["t", "id"], "v", n), ordered.lag_value(skewed, "k", ["t", "id"], "v", n, hot_rows=hot_rows))
    same(ordered.lead_value(skewed, "k", ["t", "id"], "v", n), ordered.lead_value(skewed, "k", ["t", "id"], "v", n, hot_rows=hot_rows))


@pytest.mark.parametrize("order", [["t", "id"], ["v", "id"], ["w", "id"]])
@pytest.mark.parametrize("descending", [False, True])
def test_position(skewed, order, descending):
    same(ordered.with_position(skewed, "k", order, descending=descending), ordered.with_position(skewed, "k", order, descending=descending, hot_rows=500))


def test_text_order_lag_in_slices(skewed):
    same(ordered.lag_value(skewed, "k", ["w", "id"], "v"), ordered.lag_value(skewed, "k", ["w", "id"], "v", hot_rows=0))


def test_trend(skewed):
    known = skewed.where("v is not null")
    a = {r[0]: r[1] for r in ordered.trend(known, "k", ["t", "id"], "v").collect()}
    b = {r[0]: r[1] for r in ordered.trend(known, "k", ["t", "id"], "v", hot_rows=500).collect()}
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k]) for k in a)


@pytest.mark.parametrize("hot_rows", [0, 500])
def test_quantiles(skewed, hot_rows):
    probs = [0.0, 0.1, 0.5, 0.75, 1.0]
    a = {r[0]: r for r in quantile.group_quantiles(skewed, "k", "v", probs).collect()}
    b = {r[0]: r for r in quantile.group_quantiles(skewed, "k", "v", probs, hot_rows=hot_rows).collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert list(a[k])[1:] == pytest.approx(list(b[k])[1:])


def test_table_quantiles(skewed):
    probs = [i / 10 for i in range(11)]
    plain = quantile.table_quantiles(skewed, "v", probs).first()
    assert list(quantile.table_quantiles(skewed, "v", probs, force_refine=True).first()) == pytest.approx(list(plain))


@pytest.mark.parametrize("value", ["k * 1000000 + i", "1e9 + i / 100", "0.0001 * i / 2000", "timestamp_micros(1700000000000000 + i * 43)", "lpad(cast(k * 5000 + i as string), 9, '0')"])
def test_slices_are_even_for_each_key(spark, value):
    df = spark.range(80000).selectExpr("id % 40 AS k", "id div 40 AS i").selectExpr("k", "i", f"{value} AS x")
    cut = hotkeys.with_slice(df, ["k"], "x")
    per_key = cut.groupBy("k", "_slice").count().groupBy("k").agg(F.count("*").alias("n"), F.max("count").alias("most")).collect()
    assert len(per_key) == 40 and min(r["n"] for r in per_key) > 80 and max(r["most"] for r in per_key) < 60
    rows = [(r["x"], r["_slice"]) for r in cut.where("k = 7").collect()]
    assert [s for _, s in sorted(rows)] == sorted(s for _, s in rows)


def one_day(spark):
    """One key holds a third of the rows; most of those are of one day, many have no day, and the next column ties as well."""
    rnd = random.Random(6)
    rows = []
    for i in range(6000):
        k = 0 if i % 3 == 0 else rnd.randint(1, 40)
        day = rnd.choice([5] * 8 + [None] * 3 + [1, 9, 7]) if k == 0 else rnd.randint(0, 9)
        rows.append((k, day, rnd.choice(["noon", "noon", "dawn", None]), i, float(i % 17) if i % 9 else None))
    return spark.createDataFrame(rows, "k int, day int, hour string, id int, v double").repartition(6)


@pytest.mark.parametrize("descending", [False, True])
def test_ties_are_cut_by_the_next_order_columns(spark, monkeypatch, descending):
    monkeypatch.setattr(hotkeys, "TIED_ROWS", 100)
    df, order = one_day(spark), ["day", "hour", "id"]
    same(ordered.with_position(df, "k", order, descending=descending), ordered.with_position(df, "k", order, descending=descending, hot_rows=500))
    shift = ordered.lead_value if descending else ordered.lag_value
    for n in (1, 3):
        same(shift(df, "k", order, "v", n), shift(df, "k", order, "v", n, hot_rows=500))
    hot = df.where("k = 0")
    cut = hotkeys.with_order_slice(hot, ["k"], order)
    sizes = [r["count"] for r in cut.groupBy("_slice").count().collect()]
    first_only = hotkeys.with_slice(hot, ["k"], "day").groupBy("_slice").count().agg(F.max("count")).first()[0]
    assert first_only > 1000 and len(sizes) > 200 and max(sizes) < 130
    low = lambda x: (x is not None, x if x is not None else 0)
    rows = sorted(((low(r["day"]), (r["hour"] is not None, r["hour"] or ""), r["id"]), r["_slice"]) for r in cut.collect())
    assert [s for _, s in rows] == sorted(s for _, s in rows) and len(rows) == hot.count()


def test_more_hot_keys_than_are_sent(skewed, spark, monkeypatch):
    df, order = one_day(spark), ["day", "hour", "id"]
    plain = ordered.with_position(df, "k", order)
    monkeypatch.setattr(hotkeys, "TIED_ROWS", 100)
    monkeypatch.setattr(hotkeys, "SENT_KEYS", 0)
    found = hotkeys.hot_keys(skewed, ["k"], 40)
    assert sorted(r["k"] for r in found.collect()) == sorted(r["k"] for r in skewed.groupBy("k").count().where("count > 40").collect())
    nulls = skewed.withColumn("k", F.when(F.col("id") % 5 > 0, F.col("k")))
    cold, heavy = hotkeys.split_hot(nulls, ["k"], found)
    assert "BroadcastHashJoin" not in hotkeys_plan(cold, spark) and "BroadcastNestedLoop" not in hotkeys_plan(heavy, spark)
    same(cold, nulls.join(F.broadcast(found), "k", "left_anti").select(*nulls.columns))
    same(heavy, nulls.join(F.broadcast(found), "k", "left_semi").select(*nulls.columns))
    same(plain, ordered.with_position(df, "k", order, hot_rows=500))


def hotkeys_plan(df, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_null_and_absent_order_values_have_a_slice(spark):
    df = spark.createDataFrame([(1, None), (1, 2.0), (2, None)], "k int, x double")
    assert sorted(r["_slice"] for r in hotkeys.with_slice(df, ["k"], "x").collect())[:2] == [-1, -1]
    assert hotkeys.with_slice(df.limit(0), ["k"], "x").count() == 0


def test_statistics_join_spreads_every_key(skewed, spark):
    stats = skewed.groupBy("c").agg(F.avg("v").alias("m"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        nulls = skewed.withColumn("c", F.when(F.col("c") != "a", F.col("c")))
        out = hotkeys.join_spread(nulls, stats, ["c"])
        assert re.search(r"Exchange hashpartitioning\(c#\d+, _salt#\d+L?, ", out._jdf.queryExecution().executedPlan().toString())
        same(out, nulls.join(stats, "c", "left").select(*out.columns))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("hot_rows", [0, 500])
def test_rollup_with_medians_and_distinct_counts(skewed, hot_rows):
    spec = {"v": ["count", "sum", "median", "first", "last", "max"], "c": ["nunique"], "w": ["nunique"]}
    items = [*rollup.spec_items(spec), *rollup.window_items("neg", [30, 10], {"v": ["median", "count"], "w": ["nunique"]}), rollup.Item("size", "v", "big", F.col("v") > 100)]
    df = skewed.withColumn("neg", -F.col("t"))
    a = rollup.rollup_items(df, "k", items, ["t", "id"])
    b = rollup.rollup_items(df, "k", items, ["t", "id"], hot_rows=hot_rows)
    assert a.columns == b.columns
    left, right = ({r[0]: list(r)[1:] for r in x.collect()} for x in (a, b))
    assert left.keys() == right.keys()
    for k in left:
        for name, x, y in zip(a.columns[1:], left[k], right[k]):
            assert x == (pytest.approx(y) if y is not None else None), (k, name)


@pytest.mark.parametrize("share", [None, 4])
def test_affinity_of_common_values(skewed, monkeypatch, share):
    if share:
        monkeypatch.setattr(hotkeys, "SENT_SHARE", share)
    pairs = Counter((r["k"], r["w"]) for r in skewed.collect())
    first, second = Counter(), Counter()
    for (k, w), n in pairs.items():
        first[k] += n
        second[w] += n
    found = {(r["k"], r["w"]): list(r)[2:] for r in encode.pair_affinity(skewed, "k", "w").collect()}
    assert found == {(k, w): [n, first[k], second[w], pytest.approx(n / second[w] / first[k])] for (k, w), n in pairs.items()}


@pytest.mark.parametrize("share", [None, 100])
def test_one_hot_of_very_many_values(spark, monkeypatch, share):
    if share:
        monkeypatch.setattr(hotkeys, "SENT_SHARE", share)
    df = spark.range(90_000).selectExpr("id", "CASE WHEN id % 1000 = 0 THEN NULL WHEN id % 3 = 0 THEN 'hot' ELSE concat('v', id % 70000) END AS c")
    out = encode.one_hot_vector(df, "c")
    values = sorted({r["c"] for r in df.collect()} - {None})
    assert len(values) > 40_000 and out.count() == 90_000
    place = {v: i for i, v in enumerate(values)}
    for r in out.where("id % 97 = 0 OR c IS NULL").collect():
        vector = r["c_onehot"]
        assert vector.size == len(values) and r["c_code"] == place.get(r["c"]) and list(vector.indices) == ([] if r["c"] is None else [place[r["c"]]]) and all(vector.values == 1)


EVERY = ["count", "size", "sum", "mean", "min", "max", "range", "std", "var", "skew", "kurt", "median", "nunique", "first", "last"]


def rows_with_odd_bands(spark):
    """Keys with constant values, single rows, no values, no times, bands without rows, and values far from each other in different bands."""
    rnd = random.Random(4)
    data = [(9, None, 0, 1.0, 5, "a"), (9, None, 1, None, None, None), (10, -3, 2, 7.5, 1, "b"), (11, -1, 3, None, None, None), (11, -90, 4, 2.0, 3, "c")]
    for i in range(900):
        k = rnd.randint(0, 6) if i % 3 else 0
        t = None if rnd.random() < 0.05 else -rnd.choice([0, 1, 2, 3, 6, 6, 7, 12, 13, 28, 30, 55, 56, 200])
        v = 4.25 if k == 5 else None if rnd.random() < 0.1 else round(rnd.gauss(1e6 if t and t < -20 else 0, 30), 2)
        data.append((k, t, 10 + i, v, rnd.choice([None, 1, 2, 3, 50]), rnd.choice("abcde")))
    return spark.createDataFrame(data, "k int, t int, id int, v double, n int, c string").repartition(5)


@pytest.mark.parametrize("inclusive", [False, True])
@pytest.mark.parametrize("hot_rows", [None, 0, 200])
def test_bands_give_what_each_window_gives(spark, inclusive, hot_rows):
    df = rows_with_odd_bands(spark)
    spec = {"v": EVERY, "n": EVERY, "c": ["nunique", "min", "last", "count"]}
    items = rollup.spec_items(spec) + rollup.window_items("t", [28, 3, 12, 55], spec, unit="u", inclusive=inclusive)
    items += [rollup.windowed(i, rollup.Window("t", w, inclusive)) for w in (28, 3, 12, 55) for i in rollup.spec_items({"v": EVERY, "n": ["nunique"]}, suffix=f"_{w}_pos", cond="v > 0 OR n = 2")]
    items += rollup.spec_items({"v": EVERY}, suffix="_ab", cond="c IN ('a', 'b')")
    assert len(rollup.common_time(items)) == 4 and {i.base for i in items} == {None, "v > 0 OR n = 2", "c IN ('a', 'b')"}
    found = {r["k"]: r for r in rollup.rollup_items(df, "k", items, ["t", "id"], hot_rows=hot_rows, bands=True).collect()}
    assert len(found) == 10
    for at in range(0, len(items), 30):
        some = items[at : at + 30]
        for r in rollup.rollup_items(df, "k", some, ["t", "id"]).collect():
            for i in some:
                x, y = r[i.name], found[r["k"]][i.name]
                assert (x is None) == (y is None) and (x == y or x == pytest.approx(y, rel=1e-6, abs=1e-6)), (r["k"], i.name, x, y)


def test_aggregates_over_rows_do_not_grow_with_the_windows(spark):
    df = rows_with_odd_bands(spark)
    sizes = []
    for widths in ([28, 3], [28, 3, 12, 55, 6, 1]):
        items = rollup.spec_items({"v": EVERY, "n": EVERY}) + rollup.window_items("t", widths, {"v": EVERY, "n": EVERY})
        text = rollup.rollup_items(df, "k", items, ["t", "id"], bands=True)._jdf.queryExecution().optimizedPlan().toString()
        lines = [x for x in text.splitlines() if re.search(r"Aggregate \[k#\d+, _band", x)]
        assert len(lines) == 1 and "collect_set" not in text
        sizes.append(lines[0].count(" AS _p"))
        executed = rollup.rollup_items(df, "k", items, ["t", "id"], bands=True)._jdf.queryExecution().executedPlan().toString()
        assert executed.count("Exchange hashpartitioning") == 1
    assert sizes[0] == sizes[1] < 60


def test_medians_of_hot_keys_share_one_refinement(skewed):
    texts = []
    for n in (1, 4):
        items = [rollup.Item("median", "v", f"m{i}", f"id % 5 <> {i}") for i in range(n)] + [rollup.Item("median", "t", "mt")]
        texts.append(rollup._medians(skewed, ["k"], items)._jdf.queryExecution().optimizedPlan().toString())
    reads = [t.count("LogicalRDD") + t.count("Scan ExistingRDD") for t in texts]
    assert reads[0] == reads[1]


def test_wide_rollup_places_rows_once(skewed):
    spec = {"v": ["count", "sum", "mean", "min", "max", "std", "skew", "median", "first", "last", "range"]}
    items = [i for w in (40, 30, 20, 10) for i in rollup.spec_items(spec, suffix=f"_{w}", cond=f"t < {w}")]
    assert len(items) > rollup.WIDE
    narrow = [rollup.rollup_items(skewed, "k", items[i:i + 11], ["t", "id"]) for i in range(0, 44, 11)]
    wide = {r["k"]: r for r in rollup.rollup_items(skewed, "k", items, ["t", "id"], hot_rows=500).collect()}
    for part in narrow:
        for r in part.collect():
            for c in part.columns[1:]:
                assert wide[r["k"]][c] == (pytest.approx(r[c]) if r[c] is not None else None), c


def test_factorize_and_group_median(skewed, monkeypatch):
    a = encode.factorize(skewed, "w", ["id"])
    b_median = encode.group_median(skewed, "c", "v", hot_rows=0)
    same(encode.group_median(skewed, "c", "v").select("id", F.round("v_median", 6).alias("m")), b_median.select("id", F.round("v_median", 6).alias("m")))
    monkeypatch.setattr(hotkeys, "SMALL_BYTES", -1)
    monkeypatch.setattr(hotkeys, "HOT_ROWS", 100)
    same(a, encode.factorize(skewed, "w", ["id"]))


def test_small_inputs_are_not_searched(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    assert hotkeys.is_small(orders) and hotkeys.hot_keys(orders, ["o_custkey"]) is None
    found = hotkeys.hot_keys(orders, ["o_orderstatus"], 10)
    assert {r[0] for r in found.collect()} == {"F", "O", "P"}


@pytest.mark.parametrize("hot_rows", [None, 0, 500])
def test_lag_inside_a_part_of_the_key(skewed, hot_rows):
    plain = ordered.lag_diff(skewed, ["k", "c"], ["t", "id"], "v")
    same(plain, ordered.lag_diff(skewed, ["k", "c"], ["t", "id"], "v", hot_rows=hot_rows, together="k"))


def test_edge_rows_equal_nth_rows(skewed):
    wide = {r["k"]: r for r in ordered.edge_rows(skewed, "k", ["t", "id"], ["v", "id"], 2).collect()}
    for pick, side in ((ordered.nth_from_last, "last"), (ordered.nth_from_first, "first")):
        for i in range(2):
            for r in pick(skewed, "k", ["t", "id"], ["v", "id"], i).collect():
                assert (wide[r["k"]][f"v_{side}_time{i}"], wide[r["k"]][f"id_{side}_time{i}"]) == (r["v"], r["id"])
