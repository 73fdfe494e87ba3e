"""Registry of queries and the SQL text helpers their twins share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Sums of doubles differ in the last bits with the order of addition. Results are rounded half up with the boundary
# moved slightly, so that exact decimal halves fall on one side in every engine.
NUDGE = 0.50037


def tidy(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every floating column to ``digits`` decimals."""
    scale = f"{10 ** digits}D"
    real = lambda f: isinstance(f.dataType, (T.DoubleType, T.FloatType))
    out = [f"double(floor(double(`{f.name}`) * {scale} + {NUDGE}D)) / {scale} AS `{f.name}`" if real(f) else f"`{f.name}`" for f in df.schema.fields]
    return df.selectExpr(*out)


def r(expr: str, digits: int = 4) -> str:
    """The same rounding as SQL text."""
    scale = f"{10 ** digits}::DOUBLE"
    return f"floor(({expr}) * {scale} + {NUDGE}::DOUBLE) / {scale}"


def ra(*names: str, digits: int = 4) -> str:
    """Rounded columns under their own names."""
    return ", ".join(f"{r(n, digits)} AS {n}" for n in names)


def query(name: str, sql: str | None = None, digits: int = 4):
    """Register a query; its floating columns are rounded, its SQL twin (if any) rounds with ``r``."""
    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return tidy(fn(spark, sf_dir), digits)
        run.__name__ = name
        run.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn
    return add


# ---------------------------------------------------------------- roles as SQL (twin of sources/roles.py)

DAY = "datediff('day', DATE '2001-08-02', {0}::DATE)::BIGINT"
MONTH = "floor(datediff('day', DATE '2001-11-05', {0}::DATE) / 30.0)::BIGINT"


def day(c: str) -> str:
    return DAY.format(c)


def month(c: str) -> str:
    return MONTH.format(c)


CONTRACT = f"""contract AS (SELECT o_custkey AS entity_id, o_orderkey AS contract_id, o_orderstatus AS status,
  o_orderpriority AS kind, o_totalprice AS amount, {day('o_orderdate')} AS start_day FROM orders)"""

DETAIL = f"""detail AS (SELECT o_custkey AS entity_id, l_orderkey AS loan_id, l_partkey AS part_id, l_linenumber::BIGINT AS line_no,
  {day('o_orderdate')} AS order_day, {day('l_shipdate')} AS ship_day, {month('l_shipdate')} AS month, l_quantity AS quantity,
  l_extendedprice AS price, l_discount AS discount, l_tax AS tax, l_returnflag AS flag, l_linestatus AS line_status
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

CREDIT = f"""credit AS (SELECT o_custkey AS entity_id, o_orderkey AS contract_id, o_orderstatus AS status, o_orderpriority AS kind,
  o_totalprice AS amount, {day('o_orderdate')} AS start_day, {day('x.e')} AS end_day, {day('x.c')} AS closed_day, {day('x.u')} AS update_day,
  x.debt, x.overdue, x.max_overdue, x.credit_limit, x.prolonged,
  greatest({day('x.e')} - {day('o_orderdate')} - 1200, 0)::BIGINT AS overdue_days, x.annuity
  FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS e, min(l_shipdate) AS c, max(l_shipdate) FILTER (WHERE l_linestatus = 'F') AS u,
    sum(l_extendedprice) FILTER (WHERE l_linestatus = 'O') AS debt, sum(l_extendedprice * l_discount) FILTER (WHERE l_returnflag = 'R') AS overdue,
    max(l_extendedprice * l_tax) AS max_overdue, sum(l_quantity) AS credit_limit, count(*) FILTER (WHERE l_returnflag = 'R') AS prolonged,
    min(l_extendedprice) FILTER (WHERE l_discount > 0.05::DOUBLE) AS annuity FROM lineitem GROUP BY 1) x ON o_orderkey = x.l_orderkey)"""

CREDIT_MONTH = f"""credit_month AS (SELECT l_orderkey AS contract_id, {month('l_shipdate')} AS month, CASE l_returnflag WHEN 'A' THEN 'C'
  WHEN 'N' THEN 'X' ELSE floor(l_quantity / 11)::INT::VARCHAR END AS status FROM lineitem)"""

STATUS = "CASE flag WHEN 'A' THEN 'Active' WHEN 'N' THEN 'Completed' ELSE 'Signed' END"

SNAPSHOT = f"""{DETAIL}, snapshot AS (SELECT entity_id, loan_id, month, quantity AS term, nullif(line_no, 7) AS left_terms,
  greatest(ship_day - order_day, 0) AS dpd, greatest(ship_day - order_day - 365, 0) AS dpd_tolerated, {STATUS} AS status,
  part_id, line_no, ship_day FROM detail)"""

APPLICATION = f"""application AS (SELECT o_custkey AS entity_id, o_orderkey AS loan_id, o_totalprice AS requested, x.granted, x.down_payment,
  x.annuity, x.goods_price, x.rate_down, x.rate_primary, x.rate_privileged, x.payments, {day('o_orderdate')} AS decision_day,
  {day('x.fd')} AS first_due_day, {day('x.ld')} AS last_due_day, {day('x.lf')} AS last_due_first_day, {day('x.te')} AS termination_day,
  (day(o_orderdate) % 24)::BIGINT AS hour, x.area, CASE WHEN o_orderstatus = 'F' THEN 'Y' ELSE 'N' END AS last_in_contract,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END::BIGINT AS last_in_day, o_orderpriority AS yield_group, o_orderstatus AS contract_status,
  CASE WHEN o_totalprice < 250000 THEN 'New' ELSE 'Repeater' END AS client_type
  FROM orders LEFT JOIN (SELECT l_orderkey, sum(l_extendedprice) AS granted, sum(l_extendedprice * l_discount) FILTER (WHERE l_returnflag = 'R') AS down_payment,
    min(l_extendedprice) AS annuity, max(l_extendedprice) AS goods_price, max(l_discount) AS rate_down, max(l_tax) AS rate_primary,
    min(l_tax) FILTER (WHERE l_linestatus = 'O') AS rate_privileged, count(*) AS payments, min(l_shipdate) AS fd, max(l_shipdate) AS ld,
    max(l_shipdate) FILTER (WHERE l_linenumber = 1) AS lf, max(l_shipdate) FILTER (WHERE l_linestatus = 'F') AS te, sum(l_quantity) AS area
    FROM lineitem GROUP BY 1) x ON o_orderkey = x.l_orderkey)"""

CARD = f"""{DETAIL}, card AS (SELECT entity_id, loan_id AS card_id, month, CASE WHEN line_no < 7 THEN price END AS balance,
  quantity * 1000::DOUBLE AS credit_limit, price * discount AS drawings, CASE WHEN flag = 'A' THEN price * discount END AS drawings_atm,
  CASE WHEN flag = 'N' THEN price * discount END AS drawings_pos, CASE WHEN flag = 'R' THEN price * discount END AS drawings_other,
  price * tax AS min_payment, price * discount AS payment, price * (discount + tax) AS payment_total, price * (1 - tax) AS principal,
  price * (1 - discount) AS receivable, line_no AS n_drawings, CASE WHEN flag = 'A' THEN line_no END AS n_drawings_atm,
  CASE WHEN flag = 'N' THEN line_no END AS n_drawings_pos, CASE WHEN flag = 'R' THEN line_no END AS n_drawings_other, line_no * 2 AS matured,
  {STATUS} AS status, ship_day, part_id, line_no FROM detail)"""

INSTALMENT = f"""{DETAIL}, instalment AS (SELECT entity_id, loan_id, line_no AS version, quantity::BIGINT AS number, order_day AS due_day,
  ship_day AS paid_day, price AS due_amount, CASE WHEN flag = 'N' THEN price ELSE price * (1 - discount) END AS paid_amount, part_id FROM detail)"""

_DOCS = ", ".join(f"max(CASE WHEN o_orderpriority LIKE '{i}%' THEN 1 ELSE 0 END)::BIGINT AS doc_{i}" for i in range(1, 6))
_FLAGS = ", ".join(f"max(CASE WHEN o_orderstatus = '{s}' THEN 1 ELSE 0 END)::BIGINT AS flag_{t}" for s, t in zip("FOP", ("car", "phone", "email")))
_SCORES = ", ".join(f"nullif(count(*) FILTER (WHERE o_orderstatus = '{s}'), 0) / count(*)::DOUBLE AS score_{i}" for i, s in enumerate("FPO", 1))

APPLICANT = f"""applicant AS (SELECT c_custkey AS entity_id, c_acctbal AS income, c_mktsegment AS segment, 'N' || c_nationkey::VARCHAR AS employer,
  f.* EXCLUDE (o_custkey) FROM customer LEFT JOIN (SELECT o_custkey, last(o_totalprice ORDER BY {day('o_orderdate')}, o_orderkey) AS credit,
    min(o_totalprice) AS annuity, max(o_totalprice) AS goods_price, count(*) FILTER (WHERE o_orderstatus = 'O') AS children, count(*) AS family,
    min({day('o_orderdate')}) AS birth_day, max({day('o_orderdate')}) AS employed_day,
    max({day('o_orderdate')}) FILTER (WHERE o_orderstatus = 'F') AS registration_day, max({day('o_orderdate')}) FILTER (WHERE o_orderstatus = 'P') AS id_day,
    max({day('o_orderdate')}) FILTER (WHERE o_orderstatus = 'O') AS phone_day, nullif(count(*) FILTER (WHERE o_orderpriority = '1-URGENT'), 0) AS car_age,
    {_SCORES}, {_DOCS}, {_FLAGS} FROM orders GROUP BY 1) f ON c_custkey = f.o_custkey)"""


# ---------------------------------------------------------------- aggregate specs as SQL

# role columns that hold whole numbers
WHOLE = set("""start_day end_day closed_day update_day prolonged overdue_days month left_terms dpd dpd_tolerated line_no payments decision_day
first_due_day last_due_day last_due_first_day termination_day hour last_in_day n_drawings n_drawings_atm n_drawings_pos n_drawings_other matured
version number due_day paid_day loan_id card_id contract_id part_id order_day ship_day""".split())


def raw_aggregate(fn: str, c: str, cond: str | None = None, order: str | None = None) -> str:
    """One aggregate of a spec as SQL text, not rounded."""
    flt = lambda extra="": (" FILTER (WHERE " + " AND ".join(f"({x})" for x in (cond, extra) if x) + ")") if cond or extra else ""
    rows = f"count(*){flt()}"
    body = {
        "count": f"count({c}){flt()}", "size": rows, "sum": f"coalesce(sum({c}){flt()}, 0)", "mean": f"avg({c}){flt()}",
        "min": f"min({c}){flt()}", "max": f"max({c}){flt()}", "std": f"stddev_samp({c}){flt()}", "var": f"var_samp({c}){flt()}",
        "range": f"max({c}){flt()} - min({c}){flt()}", "median": f"median({c}){flt()}",
        "skew": f"CASE WHEN count({c}){flt()} >= 3 THEN coalesce(skewness({c}){flt()}, 0) END", "kurt": f"kurtosis_pop({c}){flt()}",
        "nunique": f"count(DISTINCT {c}){flt()}",
        "first": f"first({c} ORDER BY {order}){flt(f'{c} IS NOT NULL')}", "last": f"last({c} ORDER BY {order}){flt(f'{c} IS NOT NULL')}",
    }[fn]
    if cond and fn in ("count", "size", "sum", "nunique"):
        body = f"CASE WHEN {rows} > 0 THEN {body} END"
    return body


def sql_aggregate(fn: str, c: str, name: str, cond: str | None = None, order: str | None = None, whole: set[str] = WHOLE, digits: int = 4) -> str:
    """The aggregate under its name, rounded where the result is not a whole number."""
    body = raw_aggregate(fn, c, cond, order)
    if fn in ("count", "size", "nunique"):
        return f"{body} AS {name}"
    if c in whole and fn in ("sum", "min", "max", "range", "first", "last"):
        return f"({body})::BIGINT AS {name}"
    return f"{r(body, digits)} AS {name}"


def sql_spec(spec, prefix: str = "", suffix: str = "", cond: str | None = None, order: str | None = None, whole: set[str] = WHOLE, digits: int = 4) -> str:
    return ",\n  ".join(sql_aggregate(fn, c, f"{prefix}{c}_{fn}{suffix}", cond, order, whole, digits) for c, fns in spec.items() for fn in fns)
