"""Role tables placed by customer: the same rows, and a matrix that shuffles none of them and stores no block."""

import datetime

import pytest

from relfold.catalog import QUERIES, blocks
from relfold.operators import hotkeys
from relfold.sources import roles

E = "entity_id"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def star_dir(spark, tmp_path_factory):
    """Orders whose key or customer is NULL, one order key of two customers, an order twice, an order without lines, lines without an order."""
    at = str(tmp_path_factory.mktemp("star"))
    day = datetime.datetime(1995, 1, 1)
    later = lambda n: day + datetime.timedelta(days=n)
    orders = [(k, k % 40 + 1, "FOP"[k % 3], 1000.0 + k, later(7 * k), ["1-URGENT", "2-HIGH", "5-LOW"][k % 3]) for k in range(160)]
    orders += [orders[7], (9, 33, "F", 77.0, later(3), "2-HIGH"), (None, 5, "O", 5.0, later(1), "5-LOW"), (500, None, "P", 6.0, later(2), "5-LOW"), (501, 6, "P", 8.0, later(2), "5-LOW")]
    lines = [(k, k % 11, n, 1.0 + (5 * k + n) % 50, 100.0 + k + n, 0.01 * (k % 9), 0.02 * (n % 3), "ANR"[(k + n) % 3], "OF"[n % 2], later(7 * k + 30 * n)) for k in range(160) for n in range(1, 5)]
    lines += [(900, 1, 1, 2.0, 3.0, 0.1, 0.0, "A", "O", day), (None, 1, 1, 2.0, 3.0, 0.1, 0.0, "A", "O", day), (500, 1, 1, 2.0, 3.0, 0.1, 0.0, "A", "O", day)]
    customers = [(c, f"C{c}", c % 25, 10.0 * c, ["BUILDING", "MACHINERY"][c % 2]) for c in range(1, 45)]
    for name, rows, schema in (
        ("orders", orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
        ("lineitem", lines, "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
        ("customer", customers, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
    ):
        spark.createDataFrame(rows, schema).write.parquet(f"{at}/{name}.parquet")
    return at


def rows_of(df):
    return sorted(str([round(v, 9) if isinstance(v, float) else v for v in r]) for r in df.collect())


def test_placed_rows_are_the_rows_of_the_roles(spark, star_dir, monkeypatch):
    monkeypatch.setattr(hotkeys, "SMALL_BYTES", 0)
    monkeypatch.setattr(blocks, "PLACE_SLICES", 3)
    placed = blocks.by_customer(spark, star_dir)
    tables = roles.star(spark, star_dir)
    for name, make in blocks.PLACED.items():
        plain = make(spark, star_dir, tables).where(f"{E} IS NOT NULL")
        assert placed[name].columns == plain.columns
        assert rows_of(placed[name]) == rows_of(plain), name


def test_blocks_of_placed_rows_move_only_customers(spark, star_dir):
    placed = blocks.by_customer(spark, star_dir)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("credit", "snapshot", "application", "card", "instalment"):
            # the ids of the customers are dealt out, no row of a role table is
            assert plan(getattr(blocks, f"{name}_block")(spark, star_dir, placed)).count("Exchange") == 1, name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_matrix_stores_blocks_only_where_a_customer_is_hot(spark, star_dir, monkeypatch):
    assert blocks.by_customer(spark, star_dir, hot_rows=10) is None
    asked = []
    monkeypatch.setattr(blocks, "feature_matrix", lambda builders, key, *store, **params: asked.append(bool(store)) or blocks.ids(spark, star_dir))
    QUERIES["feature_matrix"](spark, star_dir)
    monkeypatch.setattr(blocks, "by_customer", lambda spark, sf_dir: None)
    QUERIES["feature_matrix"](spark, star_dir)
    assert asked == [False, True]
