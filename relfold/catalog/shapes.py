"""Ordered windows, interval occupancy, encodings, rates, splits and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from relfold.catalog.base import CONTRACT, query, r, ra, sql_spec
from relfold.catalog.rows import hashed
from relfold.operators import encode, evaluate, interval, ordered
from relfold.operators.rollup import category_frequencies, rollup
from relfold.sources import roles
from relfold.sources.tables import driver_table

E = "entity_id"
ORDER = ["start_day", "contract_id"]
W = "(PARTITION BY entity_id ORDER BY start_day, contract_id)"


def shift_query(name, operator, n, column, sql):
    @query(name, f"WITH {CONTRACT} SELECT contract_id, {r(sql)} AS {column} FROM contract")
    def run(spark, sf_dir):
        c = roles.contract(spark, sf_dir).select(E, "contract_id", "start_day", "amount")
        return operator(c, E, ORDER, "amount", n, column).select("contract_id", column)
    return run


shift_query("lag_value", ordered.lag_value, 1, "amount_lag", f"lag(amount, 1) OVER {W}")
shift_query("lag_value_2", ordered.lag_value, 2, "amount_lag", f"lag(amount, 2) OVER {W}")
shift_query("lead_value", ordered.lead_value, 1, "amount_lead", f"lead(amount, 1) OVER {W}")
shift_query("lag_diff", ordered.lag_diff, 1, "amount_diff", f"amount - lag(amount, 1) OVER {W}")


@query("nth_from_last", f"WITH {CONTRACT} SELECT entity_id, {ra('amount')}, kind FROM contract QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY start_day DESC, contract_id DESC) = 3")
def nth_from_last(spark, sf_dir):
    return ordered.nth_from_last(roles.contract(spark, sf_dir), E, ORDER, ["amount", "kind"], 2)


@query("nth_from_first", f"WITH {CONTRACT} SELECT entity_id, {ra('amount')} FROM contract QUALIFY row_number() OVER {W} = 2")
def nth_from_first(spark, sf_dir):
    return ordered.nth_from_first(roles.contract(spark, sf_dir), E, ORDER, "amount", 1)


@query("group_rank", f"WITH {CONTRACT} SELECT contract_id, row_number() OVER (PARTITION BY entity_id, status ORDER BY amount DESC, contract_id DESC) - 1 AS rank FROM contract")
def group_rank(spark, sf_dir):
    c = roles.contract(spark, sf_dir).select(E, "contract_id", "status", "amount")
    return ordered.group_rank(c, [E, "status"], "amount", ascending=False, tie_break=["contract_id"]).select("contract_id", "rank")


@query("group_rank_single_key", f"WITH {CONTRACT} SELECT contract_id, row_number() OVER (PARTITION BY kind ORDER BY amount, contract_id) - 1 AS rank FROM contract")
def group_rank_single_key(spark, sf_dir):
    c = roles.contract(spark, sf_dir).select("contract_id", "kind", "amount")
    return ordered.group_rank(c, "kind", "amount", tie_break=["contract_id"]).select("contract_id", "rank")


@query("group_zscore", f"""SELECT o_orderkey, {r('coalesce((o_totalprice - avg(o_totalprice) OVER w) / nullif(stddev_samp(o_totalprice) OVER w, 0), 0)')} AS o_totalprice_o_orderpriority_standardize
  FROM orders WINDOW w AS (PARTITION BY o_orderpriority)""")
def group_zscore(spark, sf_dir):
    o = driver_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return ordered.group_zscore(o, "o_orderpriority", "o_totalprice").select("o_orderkey", "o_totalprice_o_orderpriority_standardize")


@query("group_minmax", f"""SELECT c_custkey, {r('coalesce((c_acctbal - min(c_acctbal) OVER w) / nullif(max(c_acctbal) OVER w - min(c_acctbal) OVER w, 0), 0)')} AS c_acctbal
  FROM customer WINDOW w AS (PARTITION BY c_nationkey)""")
def group_minmax(spark, sf_dir):
    c = driver_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return ordered.group_minmax(c, "c_nationkey", "c_acctbal", replace=True).select("c_custkey", "c_acctbal")


DIFF = {"amount_diff": ["min", "max", "mean", "sum", "std", "skew", "first", "last"]}


@query("lag_diff_rollup", f"WITH {CONTRACT}, d AS (SELECT *, amount - lag(amount) OVER {W} AS amount_diff FROM contract) SELECT entity_id, {sql_spec(DIFF, order='start_day, contract_id')} FROM d GROUP BY 1")
def lag_diff_rollup(spark, sf_dir):
    c = roles.contract(spark, sf_dir).select(E, "contract_id", "start_day", "amount")
    return rollup(ordered.lag_diff(c, E, ORDER, "amount"), E, DIFF, ORDER)


# ---------------------------------------------------------------- interval occupancy, on an axis from 1998-01-01

SPAN = f"""span AS (SELECT entity_id, amount / nullif(e - s, 0) AS daily, floor(s / 30.0)::BIGINT AS sm, floor(e / 30.0)::BIGINT AS em FROM (
  SELECT o_custkey AS entity_id, o_totalprice AS amount, datediff('day', DATE '1998-01-01', o_orderdate::DATE) AS s,
  CASE WHEN x.e >= datediff('day', DATE '1998-01-01', o_orderdate::DATE) THEN x.e END AS e FROM orders LEFT JOIN
  (SELECT l_orderkey, max(datediff('day', DATE '1998-01-01', l_shipdate::DATE)) AS e FROM lineitem GROUP BY 1) x ON o_orderkey = l_orderkey)),
  axis AS (SELECT unnest(range(97)) AS month), hit AS (SELECT entity_id, month, sum(CASE WHEN daily > 0 THEN 1 ELSE 0 END)::BIGINT AS active, sum(daily) AS amount
  FROM span JOIN axis ON sm < month AND em >= month WHERE daily IS NOT NULL GROUP BY 1, 2),
  full_axis AS (SELECT entity_id, month, coalesce(active, 0) AS active, coalesce(amount, 0) AS amount FROM (SELECT DISTINCT entity_id FROM span) CROSS JOIN axis LEFT JOIN hit USING (entity_id, month))"""
HORIZONS = [1, 3, 6, 12, 24, 48, 96]


def spans(spark, sf_dir):
    """Contracts with start and end on the axis and the amount per day; an end before the start is unknown."""
    shift = 1309  # days from the axis start to the reference day
    c = roles.credit(spark, sf_dir).select(E, "amount", (F.col("start_day") + shift).alias("start"), (F.col("end_day") + shift).alias("end"))
    c = c.withColumn("end", F.when(F.col("end") >= F.col("start"), F.col("end")))
    return c.withColumn("daily", interval.daily_amount("amount", "start", "end"))


@query("interval_occupancy", f"WITH {SPAN} SELECT entity_id, month, active, {ra('amount')} FROM hit")
def interval_occupancy(spark, sf_dir):
    return interval.occupancy(spans(spark, sf_dir), E, "start", "end", "daily")


@query("occupancy_peak", f"WITH {SPAN} SELECT entity_id, sum(active)::BIGINT AS active_months, max(active) AS active_peak, {r('max(amount)')} AS amount_peak FROM full_axis GROUP BY 1")
def occupancy_peak(spark, sf_dir):
    return interval.occupancy_summary(spans(spark, sf_dir), E, "start", "end", "daily")


@query("horizon_totals", f"WITH {SPAN} SELECT entity_id, " + ", ".join(f"{r(f'sum(amount) FILTER (WHERE month < {h})')} AS amount_sum_{h}m" for h in HORIZONS) + " FROM full_axis GROUP BY 1")
def horizon_totals(spark, sf_dir):
    return interval.horizon_sums(spans(spark, sf_dir), E, "start", "end", "daily", HORIZONS)


@query("horizon_trend", f"WITH {SPAN} SELECT entity_id, " + ", ".join(f"{r(f'regr_slope(amount, month) FILTER (WHERE month < {h})')} AS amount_trend_{h}m" for h in HORIZONS if h > 2) + " FROM full_axis GROUP BY 1")
def horizon_trend(spark, sf_dir):
    return interval.horizon_slopes(spans(spark, sf_dir), E, "start", "end", "daily", HORIZONS)


# ---------------------------------------------------------------- encodings


@query("one_hot", "SELECT o_orderkey, " + ", ".join(f"CASE WHEN o_orderstatus = '{s}' THEN 1 ELSE 0 END AS o_orderstatus_{s.lower()}" for s in "FOP") + """,
  CASE WHEN o_orderstatus IS NULL THEN 1 ELSE 0 END AS o_orderstatus_null FROM orders""")
def one_hot(spark, sf_dir):
    return encode.one_hot(driver_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus")[0]


@query("one_hot_codes", "SELECT l_orderkey, l_linenumber, (dense_rank() OVER (ORDER BY l_partkey) - 1)::INT AS l_partkey_code FROM lineitem")
def one_hot_codes(spark, sf_dir):
    """Every part as a category of its own: the place of the 1 in the sparse vector of each line."""
    wide = encode.one_hot_vector(driver_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), "l_partkey")
    return wide.select("l_orderkey", "l_linenumber", "l_partkey_code")


@query("one_hot_pruned", "SELECT l_orderkey, l_partkey, l_linenumber, l_returnflag, " + ", ".join(f"CASE WHEN l_returnflag = '{s}' THEN 1 ELSE 0 END AS l_returnflag_{s.lower()}" for s in "ANR") + " FROM lineitem")
def one_hot_pruned(spark, sf_dir):
    li = driver_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_returnflag")
    wide, cols = encode.one_hot(li, keep_source=True)
    return encode.prune_rare(wide, cols, 100)[0]


@query("category_frequencies", """WITH v AS (SELECT unnest(['o_orderstatus', 'o_orderpriority']) AS "column", unnest([o_orderstatus, o_orderpriority]) AS "value" FROM orders)
  SELECT "column", "value", count(*) AS "rows", (SELECT count(*) FROM orders) - count(*) AS "others" FROM v GROUP BY 1, 2""")
def category_frequencies_query(spark, sf_dir):
    return category_frequencies(driver_table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"])


@query("count_encode", "SELECT p_partkey, p_type, count(*) OVER (PARTITION BY p_type) AS p_type_count FROM part")
def count_encode(spark, sf_dir):
    return encode.count_encode(driver_table(spark, sf_dir, "part").select("p_partkey", "p_type"), "p_type")


@query("factorize", """SELECT p_partkey, p_brand, CASE WHEN p_brand IS NULL THEN -1 ELSE code END::BIGINT AS p_brand_code FROM (SELECT p_partkey, nullif(p_brand, 'Brand#7') AS p_brand FROM part)
  LEFT JOIN (SELECT b AS p_brand, row_number() OVER (ORDER BY f) - 1 AS code FROM (SELECT nullif(p_brand, 'Brand#7') AS b, min(p_partkey) AS f FROM part GROUP BY 1) WHERE b IS NOT NULL) USING (p_brand)""")
def factorize(spark, sf_dir):
    p = driver_table(spark, sf_dir, "part").select("p_partkey", F.nullif("p_brand", F.lit("Brand#7")).alias("p_brand"))
    return encode.factorize(p, "p_brand", ["p_partkey"])


DOCS = "doc AS (SELECT doc_id, lang, source, n_chars, quality FROM documents LEFT JOIN labels USING (doc_id))"


def labelled_docs(spark, sf_dir):
    docs = driver_table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return docs.join(driver_table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")


@query("target_encode", f"""WITH {DOCS} SELECT doc_id, {r('(s + 4) / (n + 46)::DOUBLE')} AS source_rate, {r('(s2 + 4) / (n2 + 46)::DOUBLE')} AS lang_source_rate FROM doc
  LEFT JOIN (SELECT source, coalesce(sum(quality), 0) AS s, count(quality) AS n FROM doc GROUP BY 1) USING (source)
  LEFT JOIN (SELECT lang, source, coalesce(sum(quality), 0) AS s2, count(quality) AS n2 FROM doc GROUP BY 1, 2) USING (lang, source)""")
def target_encode(spark, sf_dir):
    d = labelled_docs(spark, sf_dir)
    d = encode.target_encode(d, "source", "quality")
    return encode.target_encode(d, ["lang", "source"], "quality").select("doc_id", "source_rate", "lang_source_rate")


@query("target_encode_out_of_fold", f"""WITH {DOCS}, f AS (SELECT *, doc_id % 5 AS fold FROM doc) SELECT doc_id,
  {r('(s - coalesce(fs, 0) + 4) / (n - coalesce(fn, 0) + 46)::DOUBLE')} AS source_rate FROM f
  LEFT JOIN (SELECT source, coalesce(sum(quality), 0) AS s, count(quality) AS n FROM f GROUP BY 1) USING (source)
  LEFT JOIN (SELECT source, fold, coalesce(sum(quality), 0) AS fs, count(quality) AS fn FROM f GROUP BY 1, 2) USING (source, fold)""")
def target_encode_out_of_fold(spark, sf_dir):
    d = labelled_docs(spark, sf_dir).withColumn("fold", F.col("doc_id") % 5)
    return encode.target_encode(d, "source", "quality", fold_col="fold").select("doc_id", "source_rate")


@query("group_median_lookup", f"SELECT c_custkey, {r('median(c_acctbal) OVER (PARTITION BY c_mktsegment)')} AS income_by_segment FROM customer")
def group_median_lookup(spark, sf_dir):
    c = driver_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return encode.group_median(c, "c_mktsegment", "c_acctbal", "income_by_segment").select("c_custkey", "income_by_segment")


@query("pair_affinity", f"""SELECT l_partkey, l_suppkey, n AS pair_count, sum(n) OVER (PARTITION BY l_partkey)::BIGINT AS first_count, sum(n) OVER (PARTITION BY l_suppkey)::BIGINT AS second_count,
  {r('n / (sum(n) OVER (PARTITION BY l_suppkey))::DOUBLE / (sum(n) OVER (PARTITION BY l_partkey))::DOUBLE', 10)} AS affinity FROM (SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY 1, 2)""", digits=10)
def pair_affinity(spark, sf_dir):
    return encode.pair_affinity(driver_table(spark, sf_dir, "lineitem"), "l_partkey", "l_suppkey")


# ---------------------------------------------------------------- rates, splits, metrics

RATE = f"count(quality) AS count, sum(quality)::BIGINT AS sum, {r('sum(quality) / count(quality)::DOUBLE')} AS rate"
LABELLED = "lab AS (SELECT doc_id, lang, source, n_chars, quality FROM labels JOIN documents USING (doc_id))"


def labelled(spark, sf_dir):
    return labelled_docs(spark, sf_dir).where(F.col("quality").isNotNull())


@query("rate_by_category", f"WITH {LABELLED} SELECT source, {RATE} FROM lab GROUP BY 1")
def rate_by_category(spark, sf_dir):
    return evaluate.rate_by(labelled(spark, sf_dir), "source", "quality")


BINS = f"SELECT bin, coalesce(count, 0) AS count, coalesce(sum, 0) AS sum, rate FROM (SELECT unnest(range(1, 11)) AS bin) LEFT JOIN (SELECT bin, {RATE} FROM b GROUP BY 1) USING (bin)"


@query("rate_by_equal_width", f"""WITH {LABELLED}, x AS (SELECT quality, n_chars::DOUBLE AS x, min(n_chars) OVER ()::DOUBLE AS lo, max(n_chars) OVER ()::DOUBLE AS hi FROM lab),
  b AS (SELECT quality, least(greatest(ceil((x - lo) * 10 / (hi - lo)), 1), 10)::BIGINT AS bin FROM x) {BINS}""")
def rate_by_equal_width(spark, sf_dir):
    return evaluate.rate_by_width(labelled(spark, sf_dir), "n_chars", "quality")


@query("rate_by_quantile", f"""WITH {LABELLED}, q AS (SELECT quantile_cont(n_chars, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e FROM lab),
  b AS (SELECT quality, 1 + len(list_filter(e, lambda y: y < n_chars)) AS bin FROM lab, q) {BINS}""")
def rate_by_quantile(spark, sf_dir):
    return evaluate.rate_by_quantile(labelled(spark, sf_dir), "n_chars", "quality")


@query("stratified_folds", f"""SELECT doc_id, quality, (row_number() OVER (PARTITION BY quality ORDER BY h, doc_id) - 1) % 10 AS fold FROM {hashed('labels', 'doc_id', 666, ', quality')}""")
def stratified_folds(spark, sf_dir):
    return evaluate.stratified_folds(driver_table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "quality", 10, 666)


@query("random_partition", f"""SELECT o_orderkey, least(floor((row_number() OVER (ORDER BY h, o_orderkey) - 1) / (SELECT floor(count(*) / 7) FROM orders)), 6)::BIGINT AS part FROM {hashed('orders', 'o_orderkey', 5)}""")
def random_partition(spark, sf_dir):
    return evaluate.random_partition(driver_table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 7, 5)


AUC = "sum(p * (below + n / 2.0)) / nullif(sum(p) * sum(n), 0)::DOUBLE"


def auc_sql(by=""):
    key, part = (f"{by}, ", f"PARTITION BY {by} ") if by else ("", "")
    return f"""WITH {LABELLED}, f AS (SELECT *, doc_id % 5 AS fold FROM lab), g AS (SELECT {key}n_chars, sum(quality) AS p, sum(1 - quality) AS n FROM f GROUP BY ALL),
  c AS (SELECT *, coalesce(sum(n) OVER ({part}ORDER BY n_chars ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g)
  SELECT {key}{r(AUC, 8)} AS auc FROM c{f" GROUP BY {by}" if by else ""}"""


@query("auc_score", auc_sql(), digits=8)
def auc_score(spark, sf_dir):
    return evaluate.auc(labelled(spark, sf_dir), "quality", "n_chars")


@query("auc_by_fold", auc_sql("fold"), digits=8)
def auc_by_fold(spark, sf_dir):
    return evaluate.auc(labelled(spark, sf_dir).withColumn("fold", F.col("doc_id") % 5), "quality", "n_chars", ["fold"])


@query("smape_score", f"SELECT {r('2 * avg(abs(l_extendedprice - l_extendedprice * (1 - l_discount)) / (l_extendedprice + l_extendedprice * (1 - l_discount)))', 8)} AS smape FROM lineitem", digits=8)
def smape_score(spark, sf_dir):
    li = driver_table(spark, sf_dir, "lineitem").select(F.col("l_extendedprice").alias("y"), (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("p"))
    return evaluate.smape(li, "y", "p")


@query("fold_average", f"SELECT l_orderkey, {r('avg(l_discount)')} AS score FROM lineitem GROUP BY 1")
def fold_average(spark, sf_dir):
    return evaluate.fold_average(driver_table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_discount").alias("score")), "l_orderkey")


@query("oof_table", f"""SELECT o_orderkey, {r('o_totalprice / 500000')} AS score FROM orders WHERE o_orderstatus <> 'P'
  UNION ALL SELECT l_orderkey, {r('avg(l_discount)')} FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus = 'P' GROUP BY 1""")
def oof_table(spark, sf_dir):
    o = driver_table(spark, sf_dir, "orders")
    valid = o.where(F.col("o_orderstatus") != "P").select("o_orderkey", (F.col("o_totalprice") / 500000).alias("score"))
    li = driver_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_discount").alias("score"))
    held = o.where(F.col("o_orderstatus") == "P").select("o_orderkey")
    return evaluate.oof_table(valid, evaluate.fold_average(li.join(held, "o_orderkey", "left_semi"), "o_orderkey"), "o_orderkey")
