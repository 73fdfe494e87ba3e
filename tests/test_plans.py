"""The physical plans are the ones meant: scans, shuffles, pruning, no Python rows, no cross joins."""

import re

import pytest
from pyspark.sql import functions as F

from relfold.catalog import QUERIES
from relfold.operators import ordered
from relfold.operators import rollup as fold
from relfold.plans import blocks
from relfold.plans.matrix import feature_matrix
from relfold.plans.steps import run
from relfold.sources import roles

# these train a model or build vectors when they are called
LEARNING = {"train_boosted", "score_boosted", "feature_importance", "cross_validated_scores", "topic_mixture", "nonneg_factors", "svd_factors", "entity_embedding", "train_and_submit",
            "score_boosted_facts", "feature_importance_facts", "cross_validated_facts", "topic_mixture_facts", "svd_leading_axis", "entity_embedding_facts"}
STORED = {"feature_matrix", "materialize_block", "csv_roundtrip", "holdout_split"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition", text))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - LEARNING - STORED))
def test_native_plans_without_cross_joins(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert bad not in text, bad


def test_trailing_windows_share_one_scan_and_one_shuffle(spark, sf_dir):
    text = plan(fold.rollup_windows(roles.contract(spark, sf_dir), "entity_id", "start_day", [1462, 730, 365, 183], {"amount": ["sum", "mean", "median"]}))
    assert text.count("FileScan") == 1 and exchanges(text) == 1 and "Join" not in text


def test_columns_and_filters_reach_the_scan(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").where(F.col("o_totalprice") > 1000)
    text = plan(fold.rollup(orders, "o_custkey", {"o_totalprice": ["mean"]}))
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in text
    assert "GreaterThan(o_totalprice,1000.0)" in text and "IsNotNull(o_custkey)" in text


def test_lag_and_rollup_share_the_shuffle(spark, sf_dir):
    c = roles.contract(spark, sf_dir)
    changed = ordered.lag_diff(c, "entity_id", ["start_day", "contract_id"], "amount")
    assert exchanges(plan(fold.rollup(changed, "entity_id", {"amount_diff": ["mean", "std"]}))) == 1
    # also in a wide roll-up, which asks for rows placed by the key
    spec = {c: ["min", "max", "mean", "sum", "std", "count", "range", "var", "size", "skew", "kurt"] for c in ("amount", "amount_diff", "start_day", "contract_id")}
    assert exchanges(plan(fold.rollup(changed, "entity_id", spec))) == 1


def test_nth_row_is_limited_before_the_shuffle(spark, sf_dir):
    text = plan(ordered.nth_from_last(roles.contract(spark, sf_dir), "entity_id", ["start_day", "contract_id"], "amount", 2))
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text


def test_loan_then_entity_needs_one_shuffle_after_the_join(spark, sf_dir):
    loans = run(roles.snapshot(spark, sf_dir), blocks.loan_step(-1))
    text = plan(run(loans, blocks.loan_entity_step(-1, ["Active", "Completed", "Signed"])))
    assert len(re.findall(r"Exchange hashpartitioning\(entity_id", text)) == 1


def test_stored_blocks_join_without_shuffle_and_are_reused(spark, sf_dir):
    c = roles.contract(spark, sf_dir)
    built = []

    def block(name, spec):
        def build():
            built.append(name)
            return fold.rollup(c, "entity_id", spec, prefix=f"{name}_")
        return build

    parts = {"a": block("a", {"amount": ["sum"]}), "b": block("b", {"start_day": ["min"]})}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        matrix = feature_matrix(parts, "entity_id", "plan-test", hook=lambda df: df.withColumn("twice", F.col("a_amount_sum") * 2))
        assert exchanges(plan(matrix)) == 0 and matrix.columns == ["entity_id", "a_amount_sum", "b_start_day_min", "twice"]
        again = feature_matrix(parts, "entity_id", "plan-test")
        assert sorted(again.inputFiles()) == sorted(matrix.inputFiles()) and again.count() == matrix.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    direct = feature_matrix(parts, "entity_id")
    assert direct.count() == again.count()


def test_result_does_not_depend_on_partitioning(spark, sf_dir):
    c = roles.credit(spark, sf_dir).select("entity_id", "contract_id", "start_day", "amount", "debt", "kind")
    spec = {"amount": ["first", "last", "median", "count"], "debt": ["first", "last", "max"], "kind": ["nunique"]}
    order = ["start_day", "contract_id"]
    results = []
    for n in (1, 8, 23):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        results.append(sorted(map(tuple, fold.rollup(c.repartition(n, "contract_id"), "entity_id", spec, order).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1] == results[2]
