from __future__ import annotations

import pytest

from dimkeeper.operators.diff import (
    attribute_changes,
    changed_rows,
    deleted_rows,
    diff_counts,
    new_keys,
    snapshot_diff,
    unchanged_rows,
    upsert_rows,
)
from dimkeeper.operators.merge import apply_changes, merge_soft_delete, merge_upsert, soft_delete_changes
from dimkeeper.operators.scd import scd4
from tests.scenario import DAY1, DAY2, DAY3, KEYS, by_key, day1, day2, dimension, rows


def ids(df):
    return sorted(r["customer_id"] for r in df.collect())


def test_diff_scenario(spark):
    diff = snapshot_diff(day1(spark), day2(spark), KEYS)
    assert {(r["op"], r["customer_id"]) for r in diff.collect()} == {
        ("I", 11), ("U", 1), ("U", 2), ("U", 3), ("D", 4),
    }
    assert {(r["op"], r["n"]) for r in diff_counts(day1(spark), day2(spark), KEYS).collect()} == {
        ("I", 1), ("U", 3), ("D", 1),
    }


def test_row_classes_scenario(spark):
    old, new = day1(spark), day2(spark)
    assert ids(upsert_rows(old, new, KEYS)) == [1, 2, 3, 11]
    assert ids(changed_rows(old, new, KEYS)) == [1, 2, 3, 4]
    assert ids(unchanged_rows(old, new, KEYS)) == [5, 6, 7, 8, 9, 10]
    assert ids(unchanged_rows(old, new, KEYS, include_deleted=True)) == [4, 5, 6, 7, 8, 9, 10]
    assert ids(new_keys(old, new, KEYS)) == [11]
    assert ids(deleted_rows(old, new, KEYS)) == [4]


def test_upserts_equal_spark_set_difference(spark):
    old, new = day1(spark), day2(spark)
    assert rows(upsert_rows(old, new, KEYS)) == rows(new.subtract(old))
    assert rows(changed_rows(old, new, KEYS)) == rows(old.subtract(new))


def test_attribute_changes_scenario(spark):
    got = {tuple(r) for r in attribute_changes(day1(spark), day2(spark), KEYS).collect()}
    assert got == {
        (1, "hometown", "Town 1", "New Town"),
        (1, "gender", "Nam", "Khac"),
        (2, "phone_number", "0900000002", "0899999999"),
        (2, "gender", "Nu", "Khac"),
        (3, "date_of_birth", "1990-01-03", "2000-02-02"),
    }


def test_feed_reproduces_the_new_snapshot(spark):
    feed = snapshot_diff(day1(spark), day2(spark), KEYS)
    assert rows(apply_changes(day1(spark), feed, KEYS)) == rows(day2(spark))


def test_empty_sides(spark):
    nothing = day1(spark).where("false")
    assert snapshot_diff(nothing, nothing, KEYS).count() == 0
    assert {r["op"] for r in snapshot_diff(nothing, day1(spark), KEYS).collect()} == {"I"}
    assert {r["op"] for r in snapshot_diff(day1(spark), nothing, KEYS).collect()} == {"D"}


def test_merge_upsert(spark):
    merged = by_key(merge_upsert(day1(spark), day2(spark), KEYS))
    assert set(merged) == set(range(1, 12))
    assert (merged[1]["hometown"], merged[4]["hometown"]) == ("New Town", "Town 4")


def test_merge_refuses_repeated_source_keys(spark):
    twice = day2(spark).union(day2(spark).where("customer_id = 7"))
    with pytest.raises(Exception, match="repeated key"):
        merge_upsert(day1(spark), twice, KEYS).collect()
    with pytest.raises(Exception, match="repeated key"):
        apply_changes(day1(spark), twice.selectExpr("'U' AS op", "*"), KEYS).collect()
    with pytest.raises(Exception, match="repeated key"):
        snapshot_diff(day1(spark), twice, KEYS).collect()


def test_null_keys_are_refused_by_key_joins(spark):
    null = day1(spark).selectExpr("nullif(customer_id, 7) AS customer_id", *day1(spark).columns[1:])
    with pytest.raises(Exception, match="NULL in key"):
        new_keys(day1(spark), null, KEYS).collect()
    with pytest.raises(Exception, match="NULL in key"):
        deleted_rows(null, day1(spark), KEYS).collect()


def soft_state(spark, *days):
    state = dimension(spark, "is_active string", "etl_date date")
    for day, snapshot in days:
        state = merge_soft_delete(state, snapshot, KEYS, day)
    return state


def test_soft_delete_scenario(spark):
    got = by_key(soft_state(spark, (DAY1, day1(spark)), (DAY2, day2(spark))))
    assert len(got) == 11
    assert [k for k, r in got.items() if r["is_active"] == "0"] == [4]
    assert got[4]["etl_date"] == DAY2 and got[4]["hometown"] == "Town 4"
    assert {k for k, r in got.items() if r["etl_date"] == DAY1} == {5, 6, 7, 8, 9, 10}


def test_soft_delete_is_settled_after_one_run(spark):
    state = soft_state(spark, (DAY1, day1(spark)), (DAY2, day2(spark)))
    assert soft_delete_changes(state, day2(spark), KEYS, DAY3).count() == 0


def test_returning_key_is_active_again(spark):
    got = by_key(soft_state(spark, (DAY1, day1(spark)), (DAY2, day2(spark)), (DAY3, day1(spark))))
    assert (got[4]["is_active"], got[4]["etl_date"]) == ("1", DAY3)
    assert got[11]["is_active"] == "0"


def test_changes_merged_by_key_equal_the_one_join_form(spark):
    state = soft_state(spark, (DAY1, day1(spark)))
    changes = soft_delete_changes(state, day2(spark), KEYS, DAY2)
    assert rows(merge_upsert(state, changes, KEYS)) == rows(merge_soft_delete(state, day2(spark), KEYS, DAY2))


@pytest.mark.parametrize("op", [None, "d", "X", ""])
def test_unknown_ops_are_refused(spark, op):
    feed = day2(spark).where("customer_id = 1").selectExpr("*", f"{'NULL' if op is None else repr(op)} AS op")
    with pytest.raises(Exception, match="unknown op"):
        apply_changes(day1(spark), feed, KEYS).collect()


def test_clashing_names_are_refused(spark):
    clash = day1(spark).selectExpr("*", "1 AS op", "date'2025-01-01' AS start_date", "date'2025-01-01' AS etl_date")
    with pytest.raises(ValueError, match="op exist"):
        snapshot_diff(clash, clash, KEYS)
    assert "change" in snapshot_diff(clash, clash, KEYS, op_col="change").columns
    with pytest.raises(ValueError, match="start_date exist"):
        scd4(clash, clash, KEYS, DAY1)
    assert scd4(clash, clash, KEYS, DAY1, start_col="valid_from")[1].columns[-2:] == ["valid_from", "end_date"]
