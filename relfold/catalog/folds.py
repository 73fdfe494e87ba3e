"""Joins, aggregate functions and roll-up patterns."""

from __future__ import annotations

from pyspark.sql import functions as F

from relfold.catalog.base import CARD, CONTRACT, CREDIT, CREDIT_MONTH, INSTALMENT, SNAPSHOT, query, r, sql_spec
from relfold.functions.aggregates import nunique_with_null
from relfold.operators import relational as rel
from relfold.operators import rollup as fold
from relfold.operators.evaluate import value_counts as count_values
from relfold.operators.ordered import trend
from relfold.sources import roles
from relfold.sources.tables import driver_table

E = "entity_id"
ORDER = ["start_day", "contract_id"]
ORDER_SQL = "start_day, contract_id"
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]

# ---------------------------------------------------------------- joins


@query("left_join_rollup", f"""SELECT p_partkey, p_brand, n, {r('q')} AS q FROM part LEFT JOIN (SELECT l_partkey, count(*) AS n, sum(l_quantity) AS q
  FROM lineitem WHERE l_discount > 0.09::DOUBLE GROUP BY 1) ON p_partkey = l_partkey""")
def left_join_rollup(spark, sf_dir):
    li = driver_table(spark, sf_dir, "lineitem").where(F.col("l_discount") > 0.09)
    agg = li.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q"))
    return fold.left_rollup(driver_table(spark, sf_dir, "part").select("p_partkey", "p_brand"), agg, "p_partkey")


TWO_HOP_INNER = {"status": ["count"], "month": ["min", "max", "mean"]}
TWO_HOP_OUTER = {"status_count": ["sum", "max"], "month_min": ["min"], "month_max": ["max"], "month_mean": ["mean"]}


@query("two_hop_rollup", f"""WITH {CONTRACT}, {CREDIT_MONTH}, d AS (SELECT contract_id, count(status) AS status_count, min(month) AS month_min,
  max(month) AS month_max, avg(month) AS month_mean FROM credit_month GROUP BY 1) SELECT entity_id, {sql_spec(TWO_HOP_OUTER, whole={'status_count', 'month_min', 'month_max'})}
  FROM contract LEFT JOIN d USING (contract_id) GROUP BY 1""")
def two_hop_rollup(spark, sf_dir):
    return fold.rollup_two_hop(roles.contract(spark, sf_dir), roles.credit_month(spark, sf_dir), "contract_id", E, TWO_HOP_INNER, TWO_HOP_OUTER)


@query("lookup_map", "SELECT s_suppkey, n_name AS nation FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey AND n_regionkey < 3")
def lookup_map(spark, sf_dir):
    nation = driver_table(spark, sf_dir, "nation").where(F.col("n_regionkey") < 3)
    return rel.lookup(driver_table(spark, sf_dir, "supplier"), nation, "s_nationkey", "n_name", "nation", "n_nationkey").select("s_suppkey", "nation")


@query("semi_join", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45)")
def semi_join(spark, sf_dir):
    hit = driver_table(spark, sf_dir, "lineitem").where((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45)).select(F.col("l_orderkey").alias("o_orderkey"))
    return rel.keep_in(driver_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), hit, "o_orderkey")


@query("anti_join", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def anti_join(spark, sf_dir):
    seen = driver_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return rel.drop_in(driver_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), seen, "o_orderkey")


@query("group_feature", f"""SELECT o_orderkey, o_custkey, n, {r('m')} AS m FROM orders LEFT JOIN (SELECT o_custkey, count(o_totalprice) AS n, max(o_totalprice) AS m
  FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) USING (o_custkey)""")
def group_feature(spark, sf_dir):
    o = driver_table(spark, sf_dir, "orders")
    closed = o.where(F.col("o_orderstatus") == "F")
    data = o.select("o_orderkey", "o_custkey")
    data = fold.group_feature(data, closed, "o_custkey", "o_totalprice", "count", "n")
    return fold.group_feature(data, closed, "o_custkey", "o_totalprice", "max", "m")


@query("assemble_blocks", f"""SELECT c_custkey, a.n AS closed_count, {r('b.s')} AS open_sum, v.k AS events FROM customer
  LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) a ON c_custkey = a.o_custkey
  LEFT JOIN (SELECT o_custkey, sum(o_totalprice) AS s FROM orders WHERE o_orderstatus = 'O' GROUP BY 1) b ON c_custkey = b.o_custkey
  LEFT JOIN (SELECT user_id, count(*) AS k FROM events GROUP BY 1) v ON c_custkey = v.user_id""")
def assemble_blocks(spark, sf_dir):
    o = driver_table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    a = o.where(F.col("o_orderstatus") == "F").groupBy("c_custkey").agg(F.count(F.lit(1)).alias("closed_count"))
    b = o.where(F.col("o_orderstatus") == "O").groupBy("c_custkey").agg(F.sum("o_totalprice").alias("open_sum"))
    v = driver_table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("c_custkey")).agg(F.count(F.lit(1)).alias("events"))
    return rel.assemble([driver_table(spark, sf_dir, "customer").select("c_custkey"), a, b, v], "c_custkey")


@query("multi_key_join", f"""SELECT o_orderkey, o_custkey, o_orderstatus, n, {r('s')} AS s FROM orders LEFT JOIN (SELECT o_custkey, o_orderstatus, count(*) AS n,
  sum(o_totalprice) AS s FROM orders WHERE o_totalprice < 300000 GROUP BY 1, 2) USING (o_custkey, o_orderstatus)""")
def multi_key_join(spark, sf_dir):
    o = driver_table(spark, sf_dir, "orders")
    agg = o.where(F.col("o_totalprice") < 300000).groupBy("o_custkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("s"))
    return fold.left_rollup(o.select("o_orderkey", "o_custkey", "o_orderstatus"), agg, ["o_custkey", "o_orderstatus"])


# ---------------------------------------------------------------- aggregate functions


def spec_query(name, spec, role=roles.credit, cte=CREDIT, table="credit", key=E, order=None, order_sql=ORDER_SQL, digits=4):
    sql = f"WITH {cte} SELECT {key}, {sql_spec(spec, order=order_sql, digits=digits)} FROM {table} GROUP BY 1"
    query(name, sql, digits)(lambda spark, sf_dir: fold.rollup(role(spark, sf_dir), key, spec, order))


spec_query("agg_basic", {"debt": ["count", "size", "sum", "mean", "min", "max"], "end_day": ["count", "sum", "mean", "min", "max"]})
spec_query("agg_spread", {"amount": ["std", "var", "range"], "debt": ["std", "range"], "start_day": ["std", "range"]}, digits=1)
spec_query("agg_median", {"amount": ["median"], "debt": ["median"], "start_day": ["median"]})
spec_query("agg_skew", {"amount": ["skew"], "debt": ["skew"], "start_day": ["skew"]})
spec_query("agg_kurtosis", {"amount": ["kurt"], "debt": ["kurt"]})
spec_query("agg_first_last", {"amount": ["first", "last"], "annuity": ["first", "last"], "update_day": ["first", "last"]}, order=ORDER)
spec_query("agg_nunique", {"kind": ["nunique"], "status": ["nunique"], "start_day": ["nunique", "max"]})


@query("agg_nunique_with_null", "SELECT l_suppkey, count(DISTINCT nullif(l_linenumber, 3)) + max(CASE WHEN l_linenumber = 3 THEN 1 ELSE 0 END) AS n FROM lineitem GROUP BY 1")
def agg_nunique_with_null(spark, sf_dir):
    li = driver_table(spark, sf_dir, "lineitem").select("l_suppkey", F.nullif("l_linenumber", F.lit(3)).alias("v"))
    return fold.group_nunique_with_null(li, "l_suppkey", "v", "n")


@query("agg_nunique_with_null_inline", "SELECT count(DISTINCT nullif(l_linenumber, 3)) + max(CASE WHEN l_linenumber = 3 THEN 1 ELSE 0 END) AS n FROM lineitem")
def agg_nunique_with_null_inline(spark, sf_dir):
    return driver_table(spark, sf_dir, "lineitem").agg(nunique_with_null(F.nullif("l_linenumber", F.lit(3))).cast("bigint").alias("n"))


@query("agg_trend", f"""SELECT o_custkey, {r('CASE WHEN count(*) > 1 THEN regr_slope(o_totalprice, p) ELSE 0 END')} AS trend FROM (SELECT o_custkey, o_totalprice,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS p FROM orders) GROUP BY 1""")
def agg_trend(spark, sf_dir):
    return trend(driver_table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice"), "o_custkey", ["o_orderdate", "o_orderkey"], "o_totalprice")


@query("value_counts", "SELECT o_orderpriority, count(*) AS count FROM orders GROUP BY 1 ORDER BY 2 DESC, 1")
def value_counts(spark, sf_dir):
    return count_values(driver_table(spark, sf_dir, "orders"), "o_orderpriority")


# ---------------------------------------------------------------- roll-up patterns

BASE_SPEC = {"amount": ["count", "sum", "mean", "std", "min", "max", "median", "first", "last"], "start_day": ["min", "max", "mean"], "debt": ["sum", "max"]}
spec_query("rollup_spec", BASE_SPEC, order=ORDER)

DAY_SPEC = {"value": ["count", "sum", "mean", "max", "std", "first", "last"], "event_type": ["nunique"]}
DAYS = [20, 10, 5, 2]
EVENTS = "ev AS (SELECT user_id, event_id, event_type, value, datediff('day', DATE '2024-01-31', ts::DATE)::BIGINT AS day FROM events)"


def window_sql(spec, time, windows, unit, order, inclusive=False, prefix=""):
    op = ">=" if inclusive else ">"
    return ",\n ".join(sql_spec(spec, prefix, f"_{w}{unit}", f"{time} {op} -{w}", order) for w in windows)


@query("rollup_windows_days", f"WITH {EVENTS} SELECT user_id, {window_sql(DAY_SPEC, 'day', DAYS, 'd', 'day, event_id')} FROM ev WHERE day > -20 GROUP BY 1")
def rollup_windows_days(spark, sf_dir):
    ev = driver_table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", roles.day_number("ts", "2024-01-31").alias("day"))
    return fold.rollup_windows(ev, "user_id", "day", DAYS, DAY_SPEC, ["day", "event_id"], unit="d")


MONTH_SPEC = {"term": ["std", "median"], "left_terms": ["mean"], "dpd": ["mean", "sum"], "month": ["max", "min", "range"]}
MONTHS = [54, 28, 13, 6, 3]


@query("rollup_windows_months", f"WITH {SNAPSHOT} SELECT entity_id, {window_sql(MONTH_SPEC, 'month', MONTHS, 'm', 'month', True)} FROM snapshot WHERE month >= -54 GROUP BY 1")
def rollup_windows_months(spark, sf_dir):
    return fold.rollup_windows(roles.snapshot(spark, sf_dir), E, "month", MONTHS, MONTH_SPEC, unit="m", inclusive=True)


INNER = {"month": ["min", "max", "range"], "term": ["min", "max"], "dpd": ["max"]}
OUTER = {"month_min": ["mean", "sum", "max"], "month_max": ["min"], "month_range": ["mean"], "term_max": ["mean", "max"], "dpd_max": ["mean", "sum"]}


@query("rollup_two_level", f"""WITH {SNAPSHOT} SELECT entity_id, {sql_spec(OUTER, whole={'month_min', 'month_max', 'month_range', 'dpd_max'})} FROM (SELECT entity_id, loan_id,
  min(month) AS month_min, max(month) AS month_max, max(month) - min(month) AS month_range, min(term) AS term_min, max(term) AS term_max, max(dpd) AS dpd_max
  FROM snapshot GROUP BY 1, 2) GROUP BY 1""")
def rollup_two_level(spark, sf_dir):
    return fold.rollup_two_level(roles.snapshot(spark, sf_dir), E, "loan_id", INNER, OUTER)


STATUSES = {"F": "closed", "O": "active", "P": "sold"}


def _status_sql():
    out = []
    for s, label in STATUSES.items():
        c = f"status = '{s}'"
        out += [f"count(start_day) FILTER (WHERE {c}) AS {label}_start_day_count", f"{r(f'coalesce(sum(amount) FILTER (WHERE {c}), 0)')} AS {label}_amount_sum",
                f"min(end_day) FILTER (WHERE {c}) AS {label}_end_day_min", f"max(end_day) FILTER (WHERE {c}) AS {label}_end_day_max"]
    return ", ".join(out)


@query("status_conditional", f"WITH {CREDIT} SELECT entity_id, {_status_sql()} FROM credit GROUP BY 1")
def status_conditional(spark, sf_dir):
    return fold.status_rollup(roles.credit(spark, sf_dir), E, "status", STATUSES, {"start_day": ["count"], "amount": ["sum"], "end_day": ["min", "max"]})


@query("positive_only_stats", f"""SELECT c_nationkey, CASE WHEN count(*) FILTER (WHERE c_acctbal > 0) > 0 THEN count(c_acctbal) FILTER (WHERE c_acctbal > 0) END AS c_acctbal_count,
  {r('min(c_acctbal) FILTER (WHERE c_acctbal > 0)')} AS c_acctbal_min, {r('avg(c_acctbal) FILTER (WHERE c_acctbal > 0)')} AS c_acctbal_mean,
  {r('stddev_samp(c_acctbal) FILTER (WHERE c_acctbal > 0)')} AS c_acctbal_std, {r('last(c_acctbal ORDER BY c_custkey) FILTER (WHERE c_acctbal > 0)')} AS c_acctbal_last
  FROM customer GROUP BY 1""")
def positive_only_stats(spark, sf_dir):
    return fold.positive_stats(driver_table(spark, sf_dir, "customer"), "c_nationkey", "c_acctbal", ["count", "min", "mean", "std", "last"], ["c_custkey"])


def _pivot_sql(expr, name):
    return ", ".join(expr.replace("{c}", f"kind = '{p}'") + " AS " + name.replace("{v}", fold.column_label(p)) for p in PRIORITIES)


@query("pivot_count", f"WITH {CONTRACT} SELECT entity_id, {_pivot_sql('nullif(count(*) FILTER (WHERE {c}), 0)', 'kind_{v}_count')} FROM contract GROUP BY 1")
def pivot_count(spark, sf_dir):
    return fold.pivot_count(roles.contract(spark, sf_dir), E, "kind", PRIORITIES)


@query("pivot_stats", f"""WITH {CONTRACT} SELECT entity_id, {_pivot_sql('max(start_day) FILTER (WHERE {c})', 'kind_{v}_start_day_max')},
  {_pivot_sql('min(start_day) FILTER (WHERE {c})', 'kind_{v}_start_day_min')}, {_pivot_sql(r('sum(amount) FILTER (WHERE {c})'), 'kind_{v}_amount_sum')},
  {_pivot_sql(r('avg(amount) FILTER (WHERE {c})'), 'kind_{v}_amount_mean')} FROM contract GROUP BY 1""")
def pivot_stats(spark, sf_dir):
    return fold.pivot_stats(roles.contract(spark, sf_dir), E, "kind", PRIORITIES, {"start_day": ["max", "min"], "amount": ["sum", "mean"]})


@query("pivot_share", f"WITH {CONTRACT} SELECT entity_id, {_pivot_sql(r('nullif(count(*) FILTER (WHERE {c}), 0) / count(*)::DOUBLE'), 'kind_{v}_count_share')} FROM contract GROUP BY 1")
def pivot_share(spark, sf_dir):
    return fold.pivot_share(roles.contract(spark, sf_dir), E, "kind", PRIORITIES)


@query("worst_status", f"""WITH {CREDIT_MONTH}, lv AS (SELECT contract_id, month, CASE WHEN status NOT IN ('C', 'X') THEN status::INT END AS level FROM credit_month)
  SELECT contract_id, max(level) AS worst, max(month) FILTER (WHERE level = top) AS worst_time FROM (SELECT *, max(level) OVER (PARTITION BY contract_id) AS top FROM lv)
  WHERE top IS NOT NULL GROUP BY 1""")
def worst_status(spark, sf_dir):
    m = roles.credit_month(spark, sf_dir)
    m = m.withColumn("level", F.when(~F.col("status").isin("C", "X"), F.col("status").try_cast("int")))
    return fold.worst_row(m, "contract_id", "level", "month")


@query("status_span", f"WITH {CREDIT_MONTH} SELECT contract_id, " + ", ".join(
    f"nullif(count(*) FILTER (WHERE status = '{s}'), 0) AS {n}_count, min(month) FILTER (WHERE status = '{s}') AS {n}_min, max(month) FILTER (WHERE status = '{s}') AS {n}_max"
    for s, n in (("C", "c"), ("X", "x"))) + " FROM credit_month GROUP BY 1")
def status_span(spark, sf_dir):
    return fold.status_span(roles.credit_month(spark, sf_dir), "contract_id", "status", {"C": "c", "X": "x"}, "month")


@query("peak_utilization", f"""WITH {CARD} SELECT entity_id, {r('avg(p)')} AS peak, {r('avg(p) / count(*)')} AS peak_per_child FROM (SELECT entity_id, card_id,
  max(balance) / nullif(max(credit_limit), 0) AS p FROM card GROUP BY 1, 2) GROUP BY 1""")
def peak_utilization(spark, sf_dir):
    return fold.peak_ratio(roles.card(spark, sf_dir), E, "card_id", "balance", "credit_limit", "peak")


@query("sum_of_max", f"WITH {CARD} SELECT entity_id, sum(m)::BIGINT AS matured_sum FROM (SELECT entity_id, card_id, max(matured) AS m FROM card GROUP BY 1, 2) GROUP BY 1")
def sum_of_max(spark, sf_dir):
    return fold.sum_of_max(roles.card(spark, sf_dir), E, "card_id", "matured", "matured_sum")


@query("changed_term_loans", f"""WITH {SNAPSHOT}, loan AS (SELECT entity_id, loan_id, CASE WHEN count(DISTINCT version) > 1 THEN 1 ELSE 0 END AS ch,
  max(CASE WHEN status = 'Completed' THEN 1 ELSE 0 END) AS dn FROM (SELECT *, CASE WHEN line_no > 4 THEN 2 ELSE 1 END AS version FROM snapshot) GROUP BY 1, 2),
  t AS (SELECT entity_id, count(*) AS children, sum(ch)::BIGINT AS changed, sum(dn)::BIGINT AS completed, sum(ch * dn)::BIGINT AS completed_changed FROM loan GROUP BY 1)
  SELECT entity_id, children, changed, children - changed AS on_time, {r('(children - changed) / children::DOUBLE')} AS on_time_share, completed, completed_changed,
  completed - completed_changed AS completed_on_time, {r('(completed - completed_changed) / nullif(completed, 0)::DOUBLE')} AS completed_on_time_share FROM t""")
def changed_term_loans(spark, sf_dir):
    s = roles.snapshot(spark, sf_dir).withColumn("version", F.when(F.col("line_no") > 4, 2).otherwise(1))
    return fold.changed_terms(s, E, "loan_id", "version", "status", "Completed")


@query("snapshot_month", f"""WITH {SNAPSHOT}, s AS (SELECT *, min(month) OVER (PARTITION BY entity_id, loan_id) AS opened FROM snapshot),
  t AS (SELECT entity_id, count(DISTINCT loan_id) AS snapshot_children, count(DISTINCT loan_id) FILTER (WHERE opened = -20) AS snapshot_opened,
  count(DISTINCT loan_id) FILTER (WHERE status = 'Active') AS snapshot_active, count(DISTINCT loan_id) FILTER (WHERE status = 'Completed') AS snapshot_completed
  FROM s WHERE month = -20 GROUP BY 1) SELECT *, {r('snapshot_active / snapshot_children::DOUBLE')} AS snapshot_active_share,
  {r('snapshot_completed / snapshot_children::DOUBLE')} AS snapshot_completed_share FROM t""")
def snapshot_month(spark, sf_dir):
    return fold.snapshot_counts(roles.snapshot(spark, sf_dir), E, "loan_id", "month", -20, "status", {"Active": "active", "Completed": "completed"})


@query("children_with_event", f"""WITH {SNAPSHOT} SELECT entity_id, count(DISTINCT loan_id) FILTER (WHERE dpd > 0) AS late, count(DISTINCT loan_id) FILTER (WHERE dpd_tolerated > 0) AS very_late,
  count(DISTINCT loan_id) FILTER (WHERE dpd - dpd_tolerated > 0) AS tolerated FROM snapshot GROUP BY 1""")
def children_with_event(spark, sf_dir):
    return fold.children_with(roles.snapshot(spark, sf_dir), E, "loan_id", {
        "late": F.col("dpd") > 0, "very_late": F.col("dpd_tolerated") > 0, "tolerated": F.col("dpd") - F.col("dpd_tolerated") > 0})


LOAN_STATUS = ["Active", "Completed", "Signed"]


@query("last_status_pivot", f"""WITH {SNAPSHOT}, n AS (SELECT entity_id, loan_id, last(status ORDER BY month, ship_day, loan_id, part_id, line_no) AS st FROM snapshot GROUP BY 1, 2)
  SELECT entity_id, """ + ", ".join(f"nullif(count(*) FILTER (WHERE st = '{s}'), 0) AS last_{s.lower()}_count, {r(f'''nullif(count(*) FILTER (WHERE st = '{s}'), 0) / count(*)::DOUBLE''')} AS last_{s.lower()}_count_share" for s in LOAN_STATUS) + " FROM n GROUP BY 1")
def last_status_pivot(spark, sf_dir):
    return fold.last_status_pivot(roles.snapshot(spark, sf_dir), E, "loan_id", roles.SNAPSHOT_ORDER, "status", LOAN_STATUS)


@query("last_minus_first", f"""WITH {CREDIT} SELECT entity_id, {r(f'last(debt ORDER BY {ORDER_SQL}) FILTER (WHERE debt IS NOT NULL) - first(debt ORDER BY {ORDER_SQL}) FILTER (WHERE debt IS NOT NULL)')} AS debt_last_minus_first FROM credit GROUP BY 1""")
def last_minus_first(spark, sf_dir):
    return fold.last_minus_first(roles.credit(spark, sf_dir), E, ORDER, "debt")


@query("paid_vs_due", f"""WITH {INSTALMENT} SELECT entity_id, count(*) AS rows, {r('sum(due_amount)')} AS due_sum, {r('sum(paid_amount)')} AS paid_sum,
  {r('avg(CASE WHEN paid_day > due_day THEN 1 ELSE 0 END)')} AS late_share, {r('avg(CASE WHEN paid_amount >= due_amount THEN 1 ELSE 0 END)')} AS full_share,
  {r('sum(due_amount) - sum(paid_amount)')} AS gap FROM instalment GROUP BY 1""")
def paid_vs_due(spark, sf_dir):
    return fold.paid_vs_due(roles.instalment(spark, sf_dir), E, "due_amount", "paid_amount", "due_day", "paid_day")


@query("max_then_stats", f"WITH {INSTALMENT} SELECT entity_id, min(m) AS number_max_min, {r('avg(m)')} AS number_max_mean FROM (SELECT entity_id, loan_id, max(number) AS m FROM instalment GROUP BY 1, 2) GROUP BY 1")
def max_then_stats(spark, sf_dir):
    return fold.max_then(roles.instalment(spark, sf_dir), E, "loan_id", "number")


def _onehot_sql(col, values):
    return ", ".join(f"{r(f'''avg(CASE WHEN {col} = '{v}' THEN 1 ELSE 0 END)''')} AS {col}_{fold.column_label(v)}_mean, sum(CASE WHEN {col} = '{v}' THEN 1 ELSE 0 END)::BIGINT AS {col}_{fold.column_label(v)}_sum" for v in values)


@query("onehot_rollup", f"""WITH {CREDIT_MONTH} SELECT contract_id, {_onehot_sql('status', ['C', 'X', '0', '1', '2', '3', '4'])},
  {r('avg(CASE WHEN status IS NULL THEN 1 ELSE 0 END)')} AS status_null_mean, sum(CASE WHEN status IS NULL THEN 1 ELSE 0 END)::BIGINT AS status_null_sum FROM credit_month GROUP BY 1""")
def onehot_rollup(spark, sf_dir):
    return fold.category_rollup(roles.credit_month(spark, sf_dir), "contract_id", "status", ["C", "X", "0", "1", "2", "3", "4"], null_category=True)
