"""Sources, sinks, row sets and row expressions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from relfold.catalog.base import DETAIL, CONTRACT, day, query, r, ra
from relfold.functions import rowwise, scalar
from relfold.operators import evaluate, relational as rel
from relfold.operators.rollup import rollup
from relfold.sources import roles
from relfold.sources.store import materialize, shared_dir
from relfold.sources.tables import driver_table, labelled_union, read_table, save_split, write_csv


def scratch(spark, name):
    return f"{shared_dir(spark)}/relfold-scratch/{name}-{uuid.uuid4().hex}"


# ---------------------------------------------------------------- sources and sinks


@query("csv_roundtrip", f"SELECT c_custkey, c_name, c_nationkey, {ra('c_acctbal')}, c_mktsegment FROM customer")
def csv_roundtrip(spark, sf_dir):
    path = scratch(spark, "customer-csv")
    customer = driver_table(spark, sf_dir, "customer")
    write_csv(customer, path)
    return read_table(spark, path, customer.schema)


@query("rename_columns", f"SELECT c_custkey AS entity_id, {r('c_acctbal')} AS income, c_mktsegment AS segment, c_name, c_nationkey FROM customer")
def rename_columns(spark, sf_dir):
    return rel.rename(driver_table(spark, sf_dir, "customer"), {"c_custkey": "entity_id", "c_acctbal": "income", "c_mktsegment": "segment"})


@query("materialize_block", f"""WITH {CONTRACT} SELECT entity_id, count(amount) AS amount_count, {r('sum(amount)')} AS amount_sum,
  min(start_day) AS start_day_min FROM contract GROUP BY 1""")
def materialize_block(spark, sf_dir):
    block = rollup(roles.contract(spark, sf_dir), "entity_id", {"amount": ["count", "sum"], "start_day": ["min"]})
    return materialize(block, "contracts", uuid.uuid4().hex, params=sf_dir)


# ---------------------------------------------------------------- row sets


@query("project_columns", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def project_columns(spark, sf_dir):
    return driver_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")


@query("filter_compare", f"""SELECT o_orderkey, {ra('o_totalprice')} FROM orders WHERE o_totalprice > 100000 AND o_totalprice <= 400000
  AND o_orderstatus <> 'P' AND o_custkey >= 10 AND {day('o_orderdate')} < -365""")
def filter_compare(spark, sf_dir):
    o = driver_table(spark, sf_dir, "orders")
    keep = (F.col("o_totalprice") > 100000) & (F.col("o_totalprice") <= 400000) & (F.col("o_orderstatus") != "P") & (F.col("o_custkey") >= 10)
    return o.where(keep & (roles.day_number("o_orderdate") < -365)).select("o_orderkey", "o_totalprice")


@query("filter_isin", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW')")
def filter_isin(spark, sf_dir):
    return rel.where_in(driver_table(spark, sf_dir, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH", "5-LOW"]).select("o_orderkey", "o_orderpriority")


@query("filter_not_null", f"SELECT l_orderkey, l_partkey, {r('nullif(l_discount, 0)')} AS discount FROM lineitem WHERE nullif(l_discount, 0) IS NOT NULL")
def filter_not_null(spark, sf_dir):
    li = driver_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", F.nullif("l_discount", F.lit(0.0)).alias("discount"))
    return rel.where_not_null(li, "discount")


@query("null_out_invalid", f"""SELECT o_orderkey, {day('o_orderdate')} AS start_day,
  CASE WHEN e < {day('o_orderdate')} THEN NULL ELSE e END AS end_day, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS label
  FROM orders LEFT JOIN (SELECT l_orderkey, min({day('l_shipdate')}) AS e FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey""")
def null_out_invalid(spark, sf_dir):
    c = roles.credit(spark, sf_dir).select(F.col("contract_id").alias("o_orderkey"), "start_day", F.col("closed_day").alias("end_day"), F.col("kind").alias("label"), "status")
    c = rel.null_out(c, "end_day", F.col("end_day") < F.col("start_day"))
    return rel.null_out(c, "label", F.col("status") == "P").drop("status")


@query("append_by_name", f"""SELECT c_custkey, {r('c_acctbal')} AS income, c_nationkey AS label FROM customer WHERE c_mktsegment = 'BUILDING'
  UNION ALL SELECT c_custkey, {r('c_acctbal')}, NULL FROM customer WHERE c_mktsegment <> 'BUILDING'""")
def append_by_name(spark, sf_dir):
    c = driver_table(spark, sf_dir, "customer").select("c_custkey", F.col("c_acctbal").alias("income"), F.col("c_nationkey").alias("label"), "c_mktsegment")
    train = c.where(F.col("c_mktsegment") == "BUILDING").drop("c_mktsegment")
    test = c.where(F.col("c_mktsegment") != "BUILDING").select("income", "c_custkey")
    return rel.append(train, test)


@query("labelled_union", f"""SELECT doc_id, quality::BIGINT AS label, n_chars FROM labels JOIN documents USING (doc_id)
  UNION ALL SELECT doc_id, NULL, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def labelled_union_query(spark, sf_dir):
    docs, labels = driver_table(spark, sf_dir, "documents").select("doc_id", "n_chars"), driver_table(spark, sf_dir, "labels")
    train = docs.join(labels, "doc_id").select("doc_id", F.col("quality").cast("bigint").alias("label"), "n_chars")
    return labelled_union(train, rel.drop_in(docs, labels, "doc_id"))


@query("id_set_difference", "SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)")
def id_set_difference(spark, sf_dir):
    o = driver_table(spark, sf_dir, "orders")
    return rel.except_ids(o, o.where(F.col("o_totalprice") > 450000), "o_custkey")


@query("drop_columns", "SELECT p_partkey, p_brand, p_type, p_size FROM part")
def drop_columns(spark, sf_dir):
    return driver_table(spark, sf_dir, "part").drop("p_name", "p_retailprice")


@query("tag_columns", f"SELECT c_custkey, c_name AS app_c_name_all, c_nationkey AS app_c_nationkey_all, {r('c_acctbal')} AS app_c_acctbal_all, c_mktsegment FROM customer")
def tag_columns(spark, sf_dir):
    return rel.tag_columns(driver_table(spark, sf_dir, "customer"), "app_", "_all", keep=["c_custkey"], unless="segment")


@query("columns_like", f"SELECT l_orderkey, {ra('l_discount')}, l_shipdate::DATE AS l_shipdate, l_linestatus, l_suppkey FROM lineitem")
def columns_like(spark, sf_dir):
    li = driver_table(spark, sf_dir, "lineitem")
    names = rel.columns_like(li, "s", exclude=["price"])
    return li.select("l_orderkey", *names).withColumn("l_shipdate", F.to_date("l_shipdate"))


@query("distinct_pairs", "SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def distinct_pairs(spark, sf_dir):
    return rel.distinct(driver_table(spark, sf_dir, "orders"), ["o_custkey", "o_orderstatus"])


@query("dedup_keep_last", f"""SELECT o_custkey, o_orderkey, o_orderstatus, {ra('o_totalprice')} FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def dedup_keep_last(spark, sf_dir):
    o = driver_table(spark, sf_dir, "orders")
    return rel.dedup_keep(o, "o_custkey", ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")


@query("dedup_keep_first", f"""SELECT o_custkey, o_orderkey, {ra('o_totalprice')} FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) = 1""")
def dedup_keep_first(spark, sf_dir):
    o = driver_table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return rel.dedup_keep(o, "o_custkey", ["o_totalprice", "o_orderkey"], keep="first")


@query("sort_output", f"SELECT o_orderkey, {ra('o_totalprice')} FROM orders ORDER BY o_orderdate, o_orderkey")
def sort_output(spark, sf_dir):
    return driver_table(spark, sf_dir, "orders").orderBy("o_orderdate", "o_orderkey").select("o_orderkey", "o_totalprice")


# ---------------------------------------------------------------- row expressions

LINE_KEYS = "l_orderkey, l_partkey, l_linenumber"
KEYS = ["l_orderkey", "l_partkey", "l_linenumber"]


def lines(spark, sf_dir):
    return driver_table(spark, sf_dir, "lineitem")


@query("ratio_guarded", f"""SELECT {LINE_KEYS}, {r('l_extendedprice / (l_quantity + 0.01::DOUBLE)')} AS unit_price,
  {r('l_tax / (l_discount + 0.1::DOUBLE)')} AS tax_per_discount, {r('l_quantity / (l_linenumber + 1)')} AS quantity_per_line FROM lineitem""")
def ratio_guarded(spark, sf_dir):
    return lines(spark, sf_dir).select(
        *KEYS, scalar.ratio_guarded("l_extendedprice", "l_quantity").alias("unit_price"),
        scalar.ratio_guarded("l_tax", "l_discount", 0.1).alias("tax_per_discount"),
        scalar.ratio_guarded("l_quantity", "l_linenumber", 1).alias("quantity_per_line"))


@query("ratio_plain", f"SELECT {LINE_KEYS}, {r('l_tax / nullif(l_discount, 0)')} AS tax_per_discount FROM lineitem")
def ratio_plain(spark, sf_dir):
    return lines(spark, sf_dir).select(*KEYS, scalar.ratio("l_tax", "l_discount").alias("tax_per_discount"))


@query("differences", f"""WITH {DETAIL} SELECT loan_id, part_id, line_no, ship_day - order_day AS days_late, {r('price * (1 - discount) - price')} AS paid_gap FROM detail""")
def differences(spark, sf_dir):
    d = roles.detail(spark, sf_dir)
    return d.select("loan_id", "part_id", "line_no", scalar.difference("ship_day", "order_day").alias("days_late"),
                    scalar.difference(F.col("price") * (1 - F.col("discount")), "price").alias("paid_gap"))


@query("log_ratio", f"SELECT {LINE_KEYS}, {r('ln(1 + l_extendedprice) / (l_linenumber + 1)')} AS burden FROM lineitem")
def log_ratio(spark, sf_dir):
    return lines(spark, sf_dir).select(*KEYS, scalar.log_ratio("l_extendedprice", "l_linenumber").alias("burden"))


@query("project_end_day", f"""WITH {DETAIL} SELECT loan_id, part_id, line_no, order_day + line_no * 30 AS return_day, ship_day - (order_day + line_no * 30) AS return_gap FROM detail""")
def project_end_day(spark, sf_dir):
    d = roles.detail(spark, sf_dir).withColumn("return_day", scalar.project_day("order_day", "line_no", 30))
    return d.select("loan_id", "part_id", "line_no", "return_day", scalar.difference("ship_day", "return_day").alias("return_gap"))


@query("flag_invert", "SELECT doc_id, 1 - quality AS quality, 1 - toxic AS toxic FROM labels")
def flag_invert(spark, sf_dir):
    return driver_table(spark, sf_dir, "labels").select("doc_id", scalar.flip("quality").alias("quality"), scalar.flip("toxic").alias("toxic"))


@query("indicator_rates", f"""WITH {DETAIL} SELECT loan_id, part_id, line_no, CASE WHEN ship_day - order_day > 0 THEN 1 ELSE 0 END AS late,
  CASE WHEN nullif(discount, 0) > 0.05::DOUBLE THEN 1 ELSE 0 END AS discounted FROM detail""")
def indicator_rates(spark, sf_dir):
    d = roles.detail(spark, sf_dir)
    return d.select("loan_id", "part_id", "line_no", scalar.indicator(F.col("ship_day") - F.col("order_day") > 0).alias("late"),
                    scalar.indicator(F.nullif("discount", F.lit(0.0)) > 0.05).alias("discounted"))


@query("clip_zero", f"""WITH {DETAIL} SELECT loan_id, part_id, line_no, greatest(ship_day - order_day, 0) AS days_past_due,
  greatest(order_day - ship_day, 0) AS days_before_due FROM detail""")
def clip_zero(spark, sf_dir):
    d = roles.detail(spark, sf_dir)
    return d.select("loan_id", "part_id", "line_no", scalar.clip_zero(F.col("ship_day") - F.col("order_day")).alias("days_past_due"),
                    scalar.clip_zero(F.col("order_day") - F.col("ship_day")).alias("days_before_due"))


@query("recode_literal", "SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'F' THEN 1 END AS code FROM orders")
def recode_literal(spark, sf_dir):
    return driver_table(spark, sf_dir, "orders").select("o_orderkey", scalar.recode("o_orderstatus", {"O": 0, "F": 1}).alias("code"))


@query("floor_bucket", f"SELECT o_orderkey, floor({day('o_orderdate')} / 30.0)::BIGINT AS month FROM orders")
def floor_bucket(spark, sf_dir):
    return driver_table(spark, sf_dir, "orders").select("o_orderkey", scalar.floor_bucket(roles.day_number("o_orderdate"), 30).alias("month"))


SCORE_SQL = "nullif(l_discount, 0) * 10 AS a, nullif(l_tax, 0) * 10 AS b, l_quantity / 50 AS c"


def scored(spark, sf_dir):
    return lines(spark, sf_dir).select(
        *KEYS, (F.nullif("l_discount", F.lit(0.0)) * 10).alias("a"), (F.nullif("l_tax", F.lit(0.0)) * 10).alias("b"), (F.col("l_quantity") / 50).alias("c"))


@query("rowwise_stats", f"""SELECT {LINE_KEYS}, {r('coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0)')} AS score_sum,
  {r('list_avg([a, b, c])')} AS score_mean, {r('least(a, b, c)')} AS score_min, {r('greatest(a, b, c)')} AS score_max,
  {r('list_stddev_samp([a, b, c])')} AS score_std FROM (SELECT {LINE_KEYS}, {SCORE_SQL} FROM lineitem)""")
def rowwise_stats(spark, sf_dir):
    c = ["a", "b", "c"]
    return scored(spark, sf_dir).select(
        *KEYS, rowwise.row_sum(c).alias("score_sum"), rowwise.row_mean(c).alias("score_mean"), rowwise.row_min(c).alias("score_min"),
        rowwise.row_max(c).alias("score_max"), rowwise.row_std(c).alias("score_std"))


@query("rowwise_product", f"SELECT {LINE_KEYS}, {r('a * b * c')} AS product, {r('(1 - a) * (1 - b) * (1 - c)')} AS rest FROM (SELECT {LINE_KEYS}, {SCORE_SQL} FROM lineitem)")
def rowwise_product(spark, sf_dir):
    c = ["a", "b", "c"]
    return scored(spark, sf_dir).select(*KEYS, rowwise.row_prod(c).alias("product"), rowwise.row_prod(c, complement=True).alias("rest"))


@query("rowwise_kurtosis", f"""SELECT {LINE_KEYS}, {r("CASE WHEN list_count(v) >= 4 THEN coalesce(list_aggregate(v, 'kurtosis'), 0) END")} AS kurt
  FROM (SELECT {LINE_KEYS}, [nullif(l_discount, 0) * 100, l_tax * 100, l_quantity, l_linenumber::DOUBLE, (l_orderkey % 7)::DOUBLE] AS v FROM lineitem)""")
def rowwise_kurtosis(spark, sf_dir):
    cols = [F.nullif("l_discount", F.lit(0.0)) * 100, F.col("l_tax") * 100, F.col("l_quantity"), F.col("l_linenumber").cast("double"), (F.col("l_orderkey") % 7).cast("double")]
    return lines(spark, sf_dir).select(*KEYS, rowwise.row_kurt(cols).alias("kurt"))


@query("fill_constant", f"""SELECT o_orderkey, {r('coalesce(d, 0)')} AS discount, coalesce(e, {day('o_orderdate')}) AS end_day
  FROM orders LEFT JOIN (SELECT l_orderkey, sum(l_discount) AS d, max({day('l_shipdate')}) AS e FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey""")
def fill_constant(spark, sf_dir):
    o = driver_table(spark, sf_dir, "orders").select("o_orderkey", roles.day_number("o_orderdate").alias("start_day"))
    agg = lines(spark, sf_dir).groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_discount").alias("d"), F.max(roles.day_number("l_shipdate")).alias("e"))
    return o.join(agg, "o_orderkey", "left").select("o_orderkey", scalar.fill("d", 0.0).alias("discount"), scalar.fill("e", F.col("start_day")).alias("end_day"))


@query("fill_mean", f"SELECT {LINE_KEYS}, {r('coalesce(nullif(l_discount, 0), (SELECT avg(nullif(l_discount, 0)) FROM lineitem))')} AS discount FROM lineitem")
def fill_mean(spark, sf_dir):
    return rel.fill_mean(lines(spark, sf_dir).select(*KEYS, F.nullif("l_discount", F.lit(0.0)).alias("discount")), "discount")


@query("narrow_types", f"SELECT {LINE_KEYS}, {r('l_quantity')} AS l_quantity, l_suppkey FROM lineitem")
def narrow_types(spark, sf_dir):
    narrowed = rel.narrow_types(lines(spark, sf_dir).select(*KEYS, "l_quantity", "l_suppkey"))
    # widened again for the comparison of values; the narrow schema itself is tested in tests/test_rows.py
    return narrowed.select(*[F.col(c).cast({"l_linenumber": "int", "l_quantity": "double"}.get(c, "bigint")).alias(c) for c in narrowed.columns])


@query("date_diffs", f"""SELECT o_orderkey, l_partkey, l_linenumber, datediff('day', o_orderdate::DATE, l_shipdate::DATE)::BIGINT AS days,
  abs(floor((epoch(l_shipdate) - epoch(o_orderdate + INTERVAL 90 SECOND)) / 60.0))::BIGINT AS minutes,
  abs(floor((epoch(l_shipdate) - epoch(o_orderdate + INTERVAL 90 SECOND)) / 3600.0))::BIGINT AS hours FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def date_diffs(spark, sf_dir):
    j = lines(spark, sf_dir).join(driver_table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    j = j.select("o_orderkey", "l_partkey", "l_linenumber", text("l_shipdate").alias("paid"), text(F.col("o_orderdate") + F.expr("INTERVAL 90 SECOND")).alias("due"))
    return j.select("o_orderkey", "l_partkey", "l_linenumber", scalar.days_between("paid", "due").alias("days"),
                    scalar.minutes_between("paid", "due").alias("minutes"), scalar.hours_between("paid", "due").alias("hours"))


@query("date_shift", """SELECT o_orderkey, strftime(o_orderdate + INTERVAL 45 DAY, '%Y-%m-%d') AS plus_days,
  strftime(o_orderdate - INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S') AS minus_hours FROM orders""")
def date_shift(spark, sf_dir):
    o = driver_table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("d"))
    return o.select("o_orderkey", scalar.add_days("d", 45).alias("plus_days"), scalar.add_hours("d", -7).alias("minus_hours"))


@query("tokens_per_entity", """SELECT o_custkey, 0::BIGINT AS part, string_agg(o_orderpriority, ' ' ORDER BY o_orderpriority) AS tokens FROM orders GROUP BY 1""")
def tokens_per_entity(spark, sf_dir):
    return rel.tokens_per(driver_table(spark, sf_dir, "orders"), "o_custkey", "o_orderpriority")


@query("arrival_documents", """SELECT o_custkey, string_agg(o_orderpriority, ' ' ORDER BY o_orderdate, o_orderkey) AS priorities FROM orders GROUP BY 1""")
def arrival_documents(spark, sf_dir):
    o = driver_table(spark, sf_dir, "orders")
    return rel.tokens_per(o, "o_custkey", "o_orderpriority", name="priorities", order=["o_orderdate", "o_orderkey"]).drop("part")


HASH = "((m + (m >> 16)) * 69069 + 1) % 2147483647"


def hashed(table: str, key: str, seed: int, columns: str = "") -> str:
    """Table with the seeded hash h of its id, as SQL."""
    return f"(SELECT *, {HASH} AS h FROM (SELECT {key}{columns}, ({key} % 2147483648 * 1103515245 + ({key} >> 31) * 1220703125 + {seed}) % 2147483647 AS m FROM {table}))"


@query("holdout_split", f"""SELECT c_custkey, CASE WHEN row_number() OVER (ORDER BY h, c_custkey) <= (SELECT round(count(*) * 0.5) FROM customer)
  THEN 'test' ELSE 'train' END AS part FROM {hashed('customer', 'c_custkey', 66)}""")
def holdout_split(spark, sf_dir):
    split = evaluate.holdout(driver_table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey", 0.5, 66)
    return save_split(split, scratch(spark, "split"), "c_custkey")
