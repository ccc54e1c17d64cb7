"""Physical plans: joins, shuffles and scans that the operators are meant to have."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as driver
from dimkeeper.operators import diff, merge, scd
from dimkeeper.plans.daily_snapshots import D1, D2, ORDER_KEYS, orders_days
from dimkeeper.plans.layers import stamp_source
from dimkeeper.sources.scratch import materialise

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def no_broadcast(spark):
    """Plan as for tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def sides(spark):
    (_, old), (_, new) = orders_days(spark, SF_DIR)
    return materialise(old), materialise(new)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(plan):
    return len(re.findall(r"Exchange (?:hash|range)partitioning", plan))


@pytest.mark.parametrize(
    "operator, join",
    [
        (diff.snapshot_diff, "FullOuter"),
        (diff.upsert_rows, "RightOuter"),
        (diff.changed_rows, "LeftOuter"),
        (diff.unchanged_rows, "LeftOuter"),
        (diff.attribute_changes, "Inner"),
        (diff.new_keys, "LeftAnti"),
        (diff.deleted_rows, "LeftAnti"),
    ],
)
def test_comparisons_shuffle_each_side_once(sides, operator, join):
    plan = plan_of(operator(*sides, ORDER_KEYS))
    assert len(re.findall(r"\w+Join ", plan)) == 1 and join in plan
    assert shuffles(plan) == 2
    assert "BatchEvalPython" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


def dimension(old, *technical):
    return materialise(old.selectExpr("*", *technical))


def test_scd_shuffles_each_side_once(sides):
    old, new = sides
    stamped = materialise(stamp_source(old, D1))
    versions = dimension(
        old, f"DATE'{D1}' AS start_date", "DATE'2099-12-31' AS end_date", f"DATE'{D1}' AS etl_date"
    )
    previous = dimension(old, "o_orderstatus AS pre_status", f"DATE'{D1}' AS etl_date")
    soft = dimension(old, "'1' AS is_active", f"DATE'{D1}' AS etl_date")
    for df in (
        scd.scd2(versions, new, ORDER_KEYS, D2),
        scd.scd3(previous, new, ORDER_KEYS, D2, {"o_orderstatus": "pre_status"}),
        scd.scd4_parts(stamped, new, ORDER_KEYS, D2),
        merge.merge_soft_delete(soft, new, ORDER_KEYS, D2),
        merge.soft_delete_changes(soft, new, ORDER_KEYS, D2),
    ):
        plan = plan_of(df)
        assert plan.count("SortMergeJoin") == 1 and shuffles(plan) == 2


def test_scd2_closed_versions_are_not_shuffled(sides):
    old, new = sides
    versions = dimension(
        old, f"DATE'{D1}' AS start_date", "DATE'2099-12-31' AS end_date", f"DATE'{D1}' AS etl_date"
    )
    plan = plan_of(scd.scd2(versions, new, ORDER_KEYS, D2))
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    closed = [line for line in scans if "Not(EqualNullSafe(end_date" in line]
    assert len(scans) == 3 and len(closed) == 1
    assert any("PushedFilters: [In(end_date, [" in line for line in scans)
    after = plan[plan.index(closed[0]) :]
    before = plan[: plan.index(closed[0])].rstrip().splitlines()[-1]
    assert "Exchange" not in after and "Exchange" not in before


def test_scd1_does_not_shuffle_the_source_rows(spark, sides):
    old, new = sides
    result = scd.scd1(materialise(stamp_source(old, D1)), new, ORDER_KEYS, D2)
    result.collect()
    plan = plan_of(result)
    final = plan.split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final or final.count("partial_count") == 1
    keys_only = [line for line in plan.splitlines() if "FileScan" in line and "ReadSchema: struct<o_orderkey:bigint>" in line]
    assert keys_only


def test_small_change_sets_are_broadcast_by_size(spark, sides):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    old, new = sides
    changes = materialise(new.where("o_orderstatus = 'P'"))
    merged = merge.merge_upsert(old, changes, ORDER_KEYS)
    merged.collect()
    final = plan_of(merged).split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" in final and "SortMergeJoin" not in final


def test_facts_are_aggregated_before_they_meet_the_dimension(spark):
    plan = plan_of(driver.queries()["cur_customer_metrics"](spark, SF_DIR))
    top_join = plan.index("SortMergeJoin")
    assert plan.index("HashAggregate") > top_join
    assert plan.count("partial_sum") >= 2
    assert "l_tax" not in plan and "o_orderpriority" not in plan
