"""Plan shapes of the registered queries that do not write files."""

import pytest

from ledgerlake.checks.queries import REGISTRY

SF_DIR = "/root/testdata/sf0.001"
IN_MEMORY = [
    "q1_currency_agg", "q1_row_by_row", "silver_detail", "reject_reasons", "unknown_currency",
    "quality_counts", "two_sided_conversion", "mask_pii", "long_form", "fx_fallback", "backfill_agg",
    "salted_agg", "salted_join", "gold_detail", "gold_rejects", "cdc_latest", "ods_merge",
    "ods_merge_shuffled", "scd2_history", "scd2_incremental", "fact_load", "fact_load_shuffled",
    "reconcile",
]
NO_SHUFFLE = ["silver_detail", "reject_reasons", "two_sided_conversion", "mask_pii", "long_form"]


def physical(spark, name):
    return REGISTRY[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", IN_MEMORY)
def test_no_pairs_and_no_python(spark, name):
    plan = physical(spark, name)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "SinglePartition, REPARTITION"):
        assert node not in plan


@pytest.mark.parametrize("name", NO_SHUFFLE)
def test_row_wise_queries_do_not_shuffle(spark, name):
    assert "Exchange hashpartitioning" not in physical(spark, name)


def test_only_needed_columns_are_read(spark):
    plan = physical(spark, "q1_currency_agg")
    read = plan.split("FileScan parquet [")[1].split("]")[0]
    assert {c.split("#")[0] for c in read.split(",")} == {
        "l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag"
    }


def test_dates_of_the_change_feed_reach_the_scan(spark):
    plan = physical(spark, "fact_load")
    assert "GreaterThanOrEqual(ts,2024-01-01" in plan and "LessThan(ts,2024-02-01" in plan
