"""Roles: neutral column names the feature blocks expect, and their mapping from the star-schema tables.

A role is a plain DataFrame. Days and months are counted back from a reference date (negative = past). Any data set
can be used by producing the same columns; ``from_columns`` renames a table by a mapping.

applicant    one row per entity: amounts, days, scores, flags, categories
credit       entity_id, contract_id, amounts, start / end / closed / update day, status, kind
credit_month contract_id, month, status ('C', 'X', '0'..'5')
snapshot     entity_id, loan_id, month, term, left_terms, dpd, dpd_tolerated, status
application  entity_id, loan_id, requested and granted amounts, decision / due / termination days, flags, categories
card         entity_id, card_id, month, balance, credit_limit, drawings, payments, counters, status
instalment   entity_id, loan_id, version, number, due_day, paid_day, due_amount, paid_amount
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relfold.sources.tables import driver_table

REFERENCE_DAY = "2001-08-02"
SNAPSHOT_DAY = "2001-11-05"
AXIS_DAY = "1998-01-01"


def from_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Role columns from a table whose columns have other names: {source column: role column}."""
    return df.select(*[F.col(a).alias(b) for a, b in mapping.items()])


def day_number(c, reference: str = REFERENCE_DAY) -> Column:
    return F.datediff(F.col(c) if isinstance(c, str) else c, F.lit(reference).cast("date")).cast("bigint")


def month_number(c, reference: str = SNAPSHOT_DAY) -> Column:
    return F.floor(day_number(c, reference) / F.lit(30.0)).cast("bigint")


class Star(NamedTuple):
    """Orders and their lines."""

    orders: DataFrame
    lines: DataFrame


def star(spark: SparkSession, sf_dir: str) -> Star:
    return Star(driver_table(spark, sf_dir, "orders"), driver_table(spark, sf_dir, "lineitem"))


def order_slice(tables: Star, k: int, slices: int) -> Star:
    """The k-th part of the orders by a hash of their key, with all their lines. The parts have every order; those without a key are in one of them."""
    if slices == 1:
        return tables
    here = lambda df, c: df.where(F.pmod(F.xxhash64(c), F.lit(slices)) == k)
    return Star(here(tables.orders, "o_orderkey"), here(tables.lines, "l_orderkey"))


def customers_of_lines(tables: Star) -> DataFrame:
    """o_custkey, once for each line of an order and for each order without lines."""
    o, li = tables.orders.select("o_orderkey", "o_custkey").where("o_custkey IS NOT NULL"), tables.lines.select("l_orderkey")
    return o.join(li, li["l_orderkey"] == o["o_orderkey"], "left").select("o_custkey")


def contract(spark: SparkSession, sf_dir: str, reference: str = REFERENCE_DAY, tables: Star | None = None) -> DataFrame:
    """Orders as contracts of a customer."""
    o = (tables or star(spark, sf_dir)).orders
    return o.select(
        F.col("o_custkey").alias("entity_id"), F.col("o_orderkey").alias("contract_id"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("kind"), F.col("o_totalprice").alias("amount"), day_number("o_orderdate", reference).alias("start_day"))


def detail(spark: SparkSession, sf_dir: str, tables: Star | None = None) -> DataFrame:
    """Order lines with the customer they belong to; (ship_day, loan_id, part_id, line_no) is a total order."""
    o, li = tables or star(spark, sf_dir)
    o = o.select("o_orderkey", F.col("o_custkey").alias("entity_id"), day_number("o_orderdate").alias("order_day"))
    return li.join(o, li["l_orderkey"] == o["o_orderkey"]).select(
        "entity_id", F.col("l_orderkey").alias("loan_id"), F.col("l_partkey").alias("part_id"),
        F.col("l_linenumber").cast("bigint").alias("line_no"), "order_day", day_number("l_shipdate").alias("ship_day"),
        month_number("l_shipdate").alias("month"), F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"), F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("line_status"))


DETAIL_TIES = ["ship_day", "loan_id", "part_id", "line_no"]


def _with_lines(tables: Star, *aggs: Column) -> DataFrame:
    """Orders with their lines, folded to one row per order before they meet the orders."""
    o = tables.orders
    lines = tables.lines.groupBy("l_orderkey").agg(*aggs)
    return o.join(lines, o["o_orderkey"] == lines["l_orderkey"], "left").drop("l_orderkey")


def _if(cond: Column, value) -> Column:
    return F.when(cond, value)


def credit(spark: SparkSession, sf_dir: str, tables: Star | None = None) -> DataFrame:
    price, ship = F.col("l_extendedprice"), F.col("l_shipdate")
    rows = _with_lines(
        tables or star(spark, sf_dir),
        F.max(ship).alias("end"), F.min(ship).alias("closed"), F.max(_if(F.col("l_linestatus") == "F", ship)).alias("update"),
        F.sum(_if(F.col("l_linestatus") == "O", price)).alias("debt"),
        F.sum(_if(F.col("l_returnflag") == "R", price * F.col("l_discount"))).alias("overdue"),
        F.max(price * F.col("l_tax")).alias("max_overdue"), F.sum("l_quantity").alias("credit_limit"),
        F.count(_if(F.col("l_returnflag") == "R", 1)).alias("prolonged"),
        F.min(_if(F.col("l_discount") > 0.05, price)).alias("annuity"))
    end = day_number("end")
    start = day_number("o_orderdate")
    return rows.select(
        F.col("o_custkey").alias("entity_id"), F.col("o_orderkey").alias("contract_id"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("kind"), F.col("o_totalprice").alias("amount"), start.alias("start_day"), end.alias("end_day"),
        day_number("closed").alias("closed_day"), day_number("update").alias("update_day"), "debt", "overdue", "max_overdue",
        "credit_limit", "prolonged", F.greatest(end - start - 1200, F.lit(0)).cast("bigint").alias("overdue_days"), "annuity")


def credit_month(spark: SparkSession, sf_dir: str, tables: Star | None = None) -> DataFrame:
    li = (tables or star(spark, sf_dir)).lines
    level = F.floor(F.col("l_quantity") / 11).cast("int").cast("string")
    status = F.when(F.col("l_returnflag") == "A", "C").when(F.col("l_returnflag") == "N", "X").otherwise(level)
    return li.select(F.col("l_orderkey").alias("contract_id"), month_number("l_shipdate").alias("month"), status.alias("status"))


def _loan_status(flag: str = "flag") -> Column:
    return F.when(F.col(flag) == "A", "Active").when(F.col(flag) == "N", "Completed").otherwise("Signed")


def snapshot(spark: SparkSession, sf_dir: str, details: DataFrame | None = None) -> DataFrame:
    d = detail(spark, sf_dir) if details is None else details
    late = F.col("ship_day") - F.col("order_day")
    return d.select(
        "entity_id", "loan_id", "month", F.col("quantity").alias("term"), F.nullif("line_no", F.lit(7)).cast("bigint").alias("left_terms"),
        F.greatest(late, F.lit(0)).cast("bigint").alias("dpd"), F.greatest(late - 365, F.lit(0)).cast("bigint").alias("dpd_tolerated"),
        _loan_status().alias("status"), "part_id", "line_no", "ship_day")


SNAPSHOT_ORDER = ["month", "ship_day", "loan_id", "part_id", "line_no"]


def application(spark: SparkSession, sf_dir: str, tables: Star | None = None) -> DataFrame:
    price, ship = F.col("l_extendedprice"), F.col("l_shipdate")
    rows = _with_lines(
        tables or star(spark, sf_dir),
        F.sum(price).alias("granted"), F.sum(_if(F.col("l_returnflag") == "R", price * F.col("l_discount"))).alias("down_payment"),
        F.min(price).alias("annuity"), F.max(price).alias("goods_price"), F.max("l_discount").alias("rate_down"), F.max("l_tax").alias("rate_primary"),
        F.min(_if(F.col("l_linestatus") == "O", F.col("l_tax"))).alias("rate_privileged"), F.count(F.lit(1)).alias("payments"),
        F.min(ship).alias("first_due"), F.max(ship).alias("last_due"), F.max(_if(F.col("l_linenumber") == 1, ship)).alias("last_due_first"),
        F.max(_if(F.col("l_linestatus") == "F", ship)).alias("termination"), F.sum("l_quantity").alias("area"))
    return rows.select(
        F.col("o_custkey").alias("entity_id"), F.col("o_orderkey").alias("loan_id"), F.col("o_totalprice").alias("requested"), "granted", "down_payment",
        "annuity", "goods_price", "rate_down", "rate_primary", "rate_privileged", "payments", day_number("o_orderdate").alias("decision_day"),
        day_number("first_due").alias("first_due_day"), day_number("last_due").alias("last_due_day"),
        day_number("last_due_first").alias("last_due_first_day"), day_number("termination").alias("termination_day"),
        (F.dayofmonth("o_orderdate") % 24).cast("bigint").alias("hour"), "area",
        F.when(F.col("o_orderstatus") == "F", "Y").otherwise("N").alias("last_in_contract"),
        F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0).cast("bigint").alias("last_in_day"),
        F.col("o_orderpriority").alias("yield_group"), F.col("o_orderstatus").alias("contract_status"),
        F.when(F.col("o_totalprice") < 250000, "New").otherwise("Repeater").alias("client_type"))


APPLICATION_ORDER = ["decision_day", "loan_id"]


def card(spark: SparkSession, sf_dir: str, details: DataFrame | None = None) -> DataFrame:
    d = detail(spark, sf_dir) if details is None else details
    drawn = F.col("price") * F.col("discount")
    is_a, is_n, is_r = (F.col("flag") == f for f in "ANR")
    return d.select(
        "entity_id", F.col("loan_id").alias("card_id"), "month", F.when(F.col("line_no") < 7, F.col("price")).alias("balance"),
        (F.col("quantity") * 1000.0).alias("credit_limit"), drawn.alias("drawings"), F.when(is_a, drawn).alias("drawings_atm"),
        F.when(is_n, drawn).alias("drawings_pos"), F.when(is_r, drawn).alias("drawings_other"), (F.col("price") * F.col("tax")).alias("min_payment"),
        drawn.alias("payment"), (F.col("price") * (F.col("discount") + F.col("tax"))).alias("payment_total"),
        (F.col("price") * (1 - F.col("tax"))).alias("principal"), (F.col("price") * (1 - F.col("discount"))).alias("receivable"),
        F.col("line_no").alias("n_drawings"), F.when(is_a, F.col("line_no")).alias("n_drawings_atm"),
        F.when(is_n, F.col("line_no")).alias("n_drawings_pos"), F.when(is_r, F.col("line_no")).alias("n_drawings_other"),
        (F.col("line_no") * 2).alias("matured"), _loan_status().alias("status"), "ship_day", "part_id", "line_no")


CARD_ORDER = ["month", "ship_day", "card_id", "part_id", "line_no"]


def instalment(spark: SparkSession, sf_dir: str, details: DataFrame | None = None) -> DataFrame:
    d = detail(spark, sf_dir) if details is None else details
    paid = F.when(F.col("flag") == "N", F.col("price")).otherwise(F.col("price") * (1 - F.col("discount")))
    return d.select(
        "entity_id", "loan_id", F.col("line_no").alias("version"), F.col("quantity").cast("bigint").alias("number"), F.col("order_day").alias("due_day"),
        F.col("ship_day").alias("paid_day"), F.col("price").alias("due_amount"), paid.alias("paid_amount"), "part_id")


INSTALMENT_ORDER = ["due_day", "loan_id", "paid_day", "part_id", "version"]


def applicant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with attributes folded from their orders; about a ninth lack some of them."""
    o = driver_table(spark, sf_dir, "orders").withColumn("day", day_number("o_orderdate"))
    status, kind, n = F.col("o_orderstatus"), F.col("o_orderpriority"), F.count(F.lit(1))
    counted = lambda c: F.count(F.when(c, 1))
    share = lambda s: F.nullif(counted(status == s), F.lit(0)) / n.cast("double")
    folded = o.groupBy("o_custkey").agg(
        F.max_by("o_totalprice", F.struct("day", "o_orderkey")).alias("credit"), F.min("o_totalprice").alias("annuity"),
        F.max("o_totalprice").alias("goods_price"), counted(status == "O").alias("children"), n.alias("family"),
        F.min("day").alias("birth_day"), F.max("day").alias("employed_day"), F.max(F.when(status == "F", F.col("day"))).alias("registration_day"),
        F.max(F.when(status == "P", F.col("day"))).alias("id_day"), F.max(F.when(status == "O", F.col("day"))).alias("phone_day"),
        F.nullif(counted(kind == "1-URGENT"), F.lit(0)).alias("car_age"),
        share("F").alias("score_1"), share("P").alias("score_2"), share("O").alias("score_3"),
        *[F.max(F.when(kind.startswith(str(i)), 1).otherwise(0)).cast("bigint").alias(f"doc_{i}") for i in range(1, 6)],
        *[F.max(F.when(status == s, 1).otherwise(0)).cast("bigint").alias(f"flag_{t}") for s, t in zip("FOP", ("car", "phone", "email"))])
    c = driver_table(spark, sf_dir, "customer")
    return c.join(folded, c["c_custkey"] == folded["o_custkey"], "left").drop("o_custkey").select(
        F.col("c_custkey").alias("entity_id"), F.col("c_acctbal").alias("income"), F.col("c_mktsegment").alias("segment"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("employer"),
        *[x for x in folded.columns if x != "o_custkey"])
