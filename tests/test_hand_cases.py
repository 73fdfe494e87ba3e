"""Small cases the driver tables do not show: nulls, ties, constants, zero divisors, empty windows, absent children."""

import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from relfold.functions import rowwise, scalar
from relfold.functions.aggregates import aggregate, unbiased_kurtosis
from relfold.operators import encode, evaluate, interval, ordered
from relfold.operators import relational as rel
from relfold.operators import rollup as fold


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_first_last_sum_count_skip_nulls(spark):
    df = spark.createDataFrame([(1, 1, 10.0), (1, 2, None), (1, 3, 30.0), (2, 1, None), (None, 1, 5.0)], "k int, t int, v double")
    out = fold.rollup(df, "k", {"v": ["first", "last", "sum", "count", "size", "nunique", "median"]}, ["t"])
    assert rows(out, "k") == [(1, 10.0, 30.0, 40.0, 2, 3, 2, 20.0), (2, None, None, 0.0, 0, 1, 0, None)]


def test_constant_and_single_groups(spark):
    df = spark.createDataFrame([(1, 1.0)] * 4 + [(2, 5.0)], "k int, v double")
    out = fold.rollup(df, "k", {"v": ["std", "skew", "kurt", "range"]})
    assert rows(out, "k") == [(1, 0.0, 0.0, None, 0.0), (2, None, None, None, 0.0)]
    z = ordered.group_zscore(df, "k", "v", replace=True).select("k", "v").distinct()
    assert rows(z, "k") == [(1, 0.0), (2, 0.0)]
    m = ordered.group_minmax(df, "k", "v", start=0.5, replace=True).select("k", "v").distinct()
    assert rows(m, "k") == [(1, 0.5), (2, 0.5)]


def test_moments_equal_pandas(spark):
    v = [1.0, 2.0, 4.0, 9.0, 9.5]
    df = spark.createDataFrame([(x,) for x in v], "v double")
    s = pd.Series(v)
    got = df.agg(aggregate("skew", "v"), unbiased_kurtosis(F.col("v")), aggregate("median", "v"), aggregate("std", "v")).first()
    assert got[0] == pytest.approx(s.skew(), rel=1e-12) and got[0] == pytest.approx(0.302108278811626, rel=1e-12)
    assert got[1] == pytest.approx(s.kurt(), rel=1e-12) and got[1] == pytest.approx(-2.920720422658988, rel=1e-12)
    assert got[2] == 4.0 and got[3] == pytest.approx(3.943348830626070, rel=1e-12)


def test_zero_divisor_is_null(spark):
    df = spark.createDataFrame([(5.0, 0.0), (0.0, 0.0), (1.0, None)], "a double, b double")
    assert [r[0] for r in df.select(scalar.ratio("a", "b")).collect()] == [None, None, None]
    assert df.select(scalar.ratio_guarded("a", "b")).first()[0] == 500.0


def test_scalar_helpers(spark):
    df = spark.createDataFrame([(-61, None, "Y", "2020-01-01 10:00:00", "2020-01-02 09:30:30")], "d int, n int, f string, a string, b string")
    got = df.select(
        scalar.floor_bucket("d", 30), scalar.clip_zero("n"), scalar.clip_zero("d"), scalar.indicator(F.col("n") > 0), scalar.recode("f", {"Y": 0, "N": 1}),
        scalar.null_if("d", F.col("d") < 0), scalar.days_between("b", "a"), scalar.minutes_between("a", "b"), scalar.hours_between("a", "b"),
        scalar.add_days("a", 31), scalar.add_hours("a", 15)).first()
    # the difference is floored first, then made positive
    assert tuple(got) == (-3, 0, 0, 0, 0, None, 1, 1411, 24, "2020-02-01", "2020-01-02 01:00:00")


def test_rowwise_skips_nulls(spark):
    df = spark.createDataFrame([(1.0, None, 4.0, 9.0), (None, None, None, 2.0), (3.0, 3.0, 3.0, 3.0)], "a double, b double, c double, d double")
    cols = ["a", "b", "c", "d"]
    got = [tuple(r) for r in df.select(rowwise.row_sum(cols), rowwise.row_mean(cols), rowwise.row_min(cols), rowwise.row_max(cols), rowwise.row_std(cols), rowwise.row_prod(cols), rowwise.row_kurt(cols)).collect()]
    assert got[0][:4] == (14.0, 14 / 3, 1.0, 9.0) and got[0][4] == pytest.approx(pd.Series([1, 4, 9]).std()) and got[0][5:] == (None, None)
    assert got[1] == (2.0, 2.0, 2.0, 2.0, None, None, None)
    assert got[2] == (12.0, 3.0, 3.0, 3.0, 0.0, 81.0, 0.0)
    wide = spark.createDataFrame([(1.0, 2.0, 4.0, 9.5)], "a double, b double, c double, d double")
    assert wide.select(rowwise.row_kurt(cols)).first()[0] == pytest.approx(pd.Series([1, 2, 4, 9.5]).kurt())


def test_interval_occupancy_edges(spark):
    day = lambda m: m * 30
    df = spark.createDataFrame([(1, day(-1), day(2), 6.0), (1, day(3), day(1), 9.0), (2, None, day(5), 1.0), (3, day(90), day(500), -2.0)], "k int, s int, e int, a double")
    got = rows(interval.occupancy(df, "k", "s", "e", "a"), "k", "month")
    assert got[:3] == [(1, 0, 1, 6.0), (1, 1, 1, 6.0), (1, 2, 1, 6.0)] and got[3:] == [(3, m, 0, -2.0) for m in range(91, 97)]
    assert rows(interval.occupancy_summary(df, "k", "s", "e", "a"), "k") == [(1, 3, 1, 6.0), (2, 0, 0, 0.0), (3, 0, 0, 0.0)]
    assert rows(interval.horizon_sums(df, "k", "s", "e", "a", [1, 3, 96]), "k") == [(1, 6.0, 18.0, 18.0), (2, 0.0, 0.0, 0.0), (3, 0.0, 0.0, -10.0)]


def test_occupancy_equals_month_by_month_count(spark):
    import random

    rnd = random.Random(3)
    data = [(k, rnd.randint(-900, 3200), rnd.randint(-900, 3400), rnd.choice([-2.0, 1.5, 7.0, 0.0])) for k in range(6) for _ in range(8)]
    df = spark.createDataFrame(data, "k int, s int, e int, a double")
    peak = {r[0]: tuple(r)[1:] for r in interval.occupancy_summary(df, "k", "s", "e", "a").collect()}
    slope = {r[0]: r[1] for r in interval.horizon_slopes(df, "k", "s", "e", "a", [24]).collect()}
    for k in range(6):
        n, a = [0] * 97, [0.0] * 97
        for _, s, e, x in (d for d in data if d[0] == k):
            for i in range(97):
                if s // 30 < i <= e // 30:
                    n[i] += x > 0
                    a[i] += x
        assert peak[k][:2] == (sum(n), max(n)) and peak[k][2] == pytest.approx(max(a))
        y, xs = a[:24], range(24)
        mean_x, mean_y = sum(xs) / 24, sum(y) / 24
        expected = sum((i - mean_x) * (v - mean_y) for i, v in zip(xs, y)) / sum((i - mean_x) ** 2 for i in xs)
        assert slope[k] == pytest.approx(expected, abs=1e-9)


def test_trend(spark):
    df = spark.createDataFrame([(1, i, float(v)) for i, v in enumerate([1, 2, 4])] + [(2, i, 0.0) for i in range(3)] + [(3, 0, 7.0)] + [(4, 0, None), (4, 1, 2.0)], "k int, t int, v double")
    assert rows(ordered.trend(df, "k", ["t"], "v"), "k") == [(1, 1.5), (2, 0.0), (3, 0.0), (4, None)]


def test_pivot_absent_category_is_null(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, "c")], "k int, t string")
    assert rows(fold.pivot_count(df, "k", "t", ["a b", "c"]), "k") == [(1, 2, None), (2, None, 1)]
    assert fold.pivot_values(df, "t") == ["a b", "c"]
    with pytest.raises(ValueError):
        fold.pivot_values(df, "t", limit=1)


def test_no_child_rows_stay_null_and_empty_window_is_null(spark):
    entity = spark.createDataFrame([(1,), (2,)], "k int")
    child = spark.createDataFrame([(1, -5, 1.0), (1, -50, 2.0)], "k int, d int, v double")
    out = fold.left_rollup(entity, fold.rollup_windows(child, "k", "d", [100, 10, 5], {"v": ["sum", "count", "nunique"]}), "k")
    assert rows(out, "k") == [(1, 3.0, 2, 2, 1.0, 1, 1, None, None, None), (2, *[None] * 9)]
    inclusive = fold.rollup_windows(child, "k", "d", [5], {"v": ["sum"]}, inclusive=True)
    assert rows(inclusive, "k") == [(1, 1.0)]


def test_rare_categories_all_dropped(spark):
    df = spark.createDataFrame([(v,) for v in "aaaaabbbbbxyz"], "c string")
    wide, cols = encode.one_hot(df, null_category=True)
    assert cols == ["c_a", "c_b", "c_x", "c_y", "c_z", "c_null"]
    kept, names = encode.prune_rare(wide, cols, 3)
    assert names == ["c_a", "c_b"] and kept.columns == ["c_a", "c_b"]


def test_factorize_and_target_encode(spark):
    df = spark.createDataFrame([(1, "q", 1), (2, None, 0), (3, "a", None), (4, "q", 0)], "i int, c string, y int")
    assert [r[1] for r in rows(encode.factorize(df, "c", ["i"]).select("i", "c_code"), "i")] == [0, -1, 1, 0]
    got = rows(encode.target_encode(df, "c", "y").select("i", "c_rate"), "i")
    assert got == [(1, 5 / 48), (2, None), (3, 4 / 46), (4, 5 / 48)]
    out = rows(encode.target_encode(df.withColumn("f", F.col("i") % 2), "c", "y", fold_col="f").select("i", "c_rate"), "i")
    assert out[0] == (1, 4 / 47) and out[3] == (4, 5 / 47)


def test_fold_balance_and_partition_sizes(spark):
    df = spark.createDataFrame([(i, int(i < 7)) for i in range(30)], "id int, y int")
    sizes = evaluate.stratified_folds(df, "id", "y", 5, 9).groupBy("y", "fold").count().collect()
    for y in (0, 1):
        counts = [r["count"] for r in sizes if r["y"] == y]
        assert sum(counts) == (7 if y else 23) and max(counts) - min(counts) <= 1
    parts = {r[0]: r[1] for r in evaluate.random_partition(df, "id", 4, 2).groupBy("part").count().collect()}
    assert parts == {0: 7, 1: 7, 2: 7, 3: 9}
    held = evaluate.holdout(df, "id", 0.5, 1)
    assert held.where("part = 'test'").count() == 15
    assert rows(held, "id") == rows(evaluate.holdout(df.repartition(5), "id", 0.5, 1), "id")


def test_auc_properties(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    df = spark.createDataFrame([(i, float((i * 7919) % 13), (i * 31) % 3 % 2) for i in range(300)], "id int, s double, y int")
    a = evaluate.auc(df, "y", "s").first()[0]
    b = evaluate.auc(df.withColumn("s", -F.col("s")), "y", "s").first()[0]
    assert a + b == pytest.approx(1.0)
    ev = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y")
    assert a == pytest.approx(ev.evaluate(df.withColumn("y", F.col("y").cast("double"))), abs=1e-9)
    assert evaluate.auc(df.where("y = 1"), "y", "s").first()[0] is None


def test_bins(spark):
    df = spark.createDataFrame([(float(x), int(x > 5)) for x in (0, 1, 5, 5, 5, 9, 10)], "x double, y int")
    width = rows(evaluate.rate_by_width(df, "x", "y", 5), "bin")
    cut = pd.cut(pd.Series([0, 1, 5, 5, 5, 9, 10.0]), 5).cat.codes.value_counts()
    assert [w[1] for w in width] == [int(cut.get(i, 0)) for i in range(5)]
    # equal edges are merged
    quant = rows(evaluate.rate_by_quantile(df, "x", "y", 4), "bin")
    codes = pd.qcut(pd.Series([0, 1, 5, 5, 5, 9, 10.0]), 4, duplicates="drop").cat.codes.value_counts()
    assert [q[1] for q in quant] == [int(codes.get(i, 0)) for i in range(len(quant))]
    same = spark.createDataFrame([(2.0, 1), (2.0, 0)], "x double, y int")
    assert [r[1] for r in rows(evaluate.rate_by_width(same, "x", "y", 3), "bin")] == [2, 0, 0]


def test_smape_ignores_zero_sums(spark):
    df = spark.createDataFrame([(1.0, 3.0), (0.0, 0.0)], "y double, p double")
    assert evaluate.smape(df, "y", "p").first()[0] == 1.0


def test_narrow_types(spark):
    df = spark.createDataFrame([(1, 300, 70000, 2**40, 1.5, 1e12, None), (-128, -4, 0, 0, -2.0, 0.0, None)], "a bigint, b bigint, c bigint, d bigint, e double, f double, g bigint")
    kinds = {f.name: f.dataType.simpleString() for f in rel.narrow_types(df).schema.fields}
    assert kinds == {"a": "tinyint", "b": "smallint", "c": "int", "d": "bigint", "e": "float", "f": "double", "g": "bigint"}


def test_tokens_in_parts(spark):
    df = spark.createDataFrame([(1, w) for w in "b a b c a b d".split()] + [(2, None), (3, "z")], "k int, w string")
    one = rows(rel.tokens_per(df, "k", "w"), "k", "part")
    assert one == [(1, 0, "a a b b b c d"), (3, 0, "z")]
    parts = rows(rel.tokens_per(df, "k", "w", per_row=3, hot_rows=0), "k", "part")
    assert parts == [(1, 0, "a a b"), (1, 1, "b b c"), (1, 2, "d"), (3, 0, "z")]


def test_one_document_per_id_in_order_of_arrival(spark):
    arrived = [(1, n, w) for n, w in enumerate("b a b c a b d".split())] + [(1, None, "z"), (1, 3, "a"), (2, 0, None), (3, 9, "z"), (None, 1, "y")]
    df = spark.createDataFrame(arrived, "k int, n int, w string")
    want = [(1, 0, "z b a b a c a b d"), (3, 0, "z")]
    assert rows(rel.tokens_per(df, "k", "w", order="n"), "k") == want
    assert rows(rel.tokens_per(df, "k", "w", order="n", hot_rows=0), "k") == want
    assert rows(rel.tokens_per(df, "k", "w", order="n", hot_rows=2), "k") == want
    assert rows(rel.tokens_per(df, "k", "w", hot_rows=0), "k") == [(1, 0, "a a a b b b c d z"), (3, 0, "z")]
    assert rows(rel.tokens_per(df.limit(0), "k", "w", order="n"), "k") == []


def test_document_of_a_hot_id_is_joined_from_segments(spark, monkeypatch):
    monkeypatch.setattr(rel, "SEGMENT", 1000)
    n = 30_000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50 + 100).alias("k"), (F.col("id") * 7919 % n).alias("at"), (F.col("id") % 13).alias("w"))
    plain = {r["k"]: r["tokens"] for r in rel.tokens_per(df, "k", "w", order="at", hot_rows=n).collect()}
    got = rel.tokens_per(df, "k", "w", order="at", hot_rows=5000)
    assert {r["k"]: r["tokens"] for r in got.collect()} == plain and got.count() == len(plain)
    assert plain[7].split() == [str(i % 13) for i in sorted(range(0, n, 3), key=lambda i: i * 7919 % n)]
    # one row holds the whole document: ties of the whole order are counted, not gathered
    one = df.withColumn("at", F.lit(1)).withColumn("w", F.lit("x"))
    assert rel.tokens_per(one, "k", "w", order="at", hot_rows=5000).where("k = 7").first()["tokens"] == " ".join("x" * (n // 3))
    # the last aggregate of the hot id reads segments of at most SEGMENT tokens
    words = df.where("k = 7").select("k", F.col("at").alias("_o0"), F.col("w").cast("string").alias("_t"))
    sizes = [len(r["tokens"].split()) for r in rel._segments(words, "k", ["_o0", "_t"], 1000, "tokens", 5000).collect()]
    assert len(sizes) == 10 and set(sizes) == {1000}


def test_nan_never_appears(spark):
    df = spark.createDataFrame([(1, 0.0), (1, 0.0)], "k int, v double")
    got = fold.rollup(df, "k", {"v": ["mean", "std", "var", "skew", "kurt", "median"]}).first()
    assert not any(isinstance(x, float) and math.isnan(x) for x in got)


def test_closed_and_active_are_compared_whatever_the_order_of_statuses():
    from relfold.plans.blocks import card_step, credit_step

    labels = {"Active": "active", "Bad debt": "bad_debt", "Closed": "closed", "Sold": "sold"}
    named = credit_step(labels, ["Buyer's loan"]).names()
    assert "closed_active_count_ratio" in named and not any("bad_debt" in n and n.endswith("_count_ratio") for n in named)
    windows = [i.name for i in card_step(["Completed", "Active"]).items if i.name.startswith("status_") and i.name[:-1].endswith(tuple("0123456789"))]
    assert windows and all("active" in n for n in windows)


def test_labels_are_one_to_one_and_text_is_escaped(spark):
    from relfold.operators.encode import one_hot
    from relfold.plans.steps import derive, flags

    df = spark.createDataFrame([(1, "A-b"), (2, "a b"), (3, "Buyer's loan"), (4, None)], "id long, c string")
    table, names = one_hot(df, ["c"])
    assert len(names) == len(set(names)) == 4
    assert [sum(r[n] for n in names) for r in table.collect()] == [1, 1, 1, 1]
    assert derive(df, [flags("c", ["Buyer's loan"])]).where("c_buyer_s_loan = 1").count() == 1
    with pytest.raises(ValueError):
        flags("c", ["A-b", "a b"])


def test_quantiles_of_special_numbers_agree_on_both_routes(spark):
    from relfold.operators.quantile import group_quantiles

    sets = [[float("-inf"), -1e300, -1.0, -0.0, 0.0, 1.0, 1e300, float("inf"), float("nan")], [float("inf")] * 3, [-0.0, 0.0], [None, float("nan")], [None], [1.0, None, float("inf")]]
    df = spark.createDataFrame([(k, x) for k, xs in enumerate(sets) for x in xs], "k int, x double")
    probs = [0.0, 0.25, 0.5, 1.0]
    plain, sliced = (sorted(map(str, group_quantiles(df, "k", "x", probs, hot_rows=n).collect())) for n in (100, 0))
    assert [r.replace("-0.0", "0.0") for r in plain] == [r.replace("-0.0", "0.0") for r in sliced]


def test_hash_ranges_of_ids_with_strides(spark):
    from relfold.operators.evaluate import mix

    for bits in (0, 11, 22, 31, 40):
        h = spark.range(20000).select((F.shiftright(mix(F.shiftleft("id", bits), 1), 21)).alias("r"))
        assert h.distinct().count() > 950, bits  # of 1,024 ranges
