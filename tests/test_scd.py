from __future__ import annotations

import datetime as dt

import pytest

from dimkeeper.functions import OPEN_END
from dimkeeper.operators.scd import open_versions, scd1, scd2, scd3, scd4, scd4_parts
from tests.scenario import DAY1, DAY2, DAY3, KEYS, PREVIOUS, by_key, day1, day2, dimension, rows

SCD2_DATES = ("start_date date", "end_date date", "etl_date date")


def scd2_days(spark, *days):
    state = dimension(spark, *SCD2_DATES)
    for run_date, snapshot in days:
        state = scd2(state, snapshot, KEYS, run_date)
    return state


def scd3_dimension(spark):
    return dimension(spark, "pre_hometown string", "pre_phone_number string", "etl_date date")


# --- scenario ---------------------------------------------------------------------------------


def test_scd1_scenario(spark):
    state = scd1(dimension(spark, "etl_date date"), day1(spark), KEYS, DAY1)
    state = scd1(state, day2(spark), KEYS, DAY2)
    got = by_key(state)
    assert set(got) == set(range(1, 12))
    assert (got[1]["hometown"], got[2]["phone_number"]) == ("New Town", "0899999999")
    assert got[3]["date_of_birth"] == dt.date(2000, 2, 2)
    assert got[4]["hometown"] == "Town 4"
    assert {r["etl_date"] for r in got.values()} == {DAY2}


def test_scd1_can_drop_deleted_keys(spark):
    state = scd1(dimension(spark, "etl_date date"), day1(spark), KEYS, DAY1)
    assert 4 not in by_key(scd1(state, day2(spark), KEYS, DAY2, on_delete="drop"))


def test_scd2_scenario(spark):
    state = scd2_days(spark, (DAY1, day1(spark)), (DAY2, day2(spark)))
    spans = sorted((r["customer_id"], r["start_date"], r["end_date"]) for r in state.collect())
    closed = [(k, DAY1, DAY2) for k in (1, 2, 3, 4)]
    opened = [(k, DAY2, OPEN_END) for k in (1, 2, 3, 11)] + [(k, DAY1, OPEN_END) for k in range(5, 11)]
    assert spans == sorted(closed + opened)
    assert len(spans) == 14


def test_scd3_scenario(spark):
    state = scd3(scd3_dimension(spark), day1(spark), KEYS, DAY1, PREVIOUS)
    got = by_key(scd3(state, day2(spark), KEYS, DAY2, PREVIOUS))
    assert len(got) == 11
    assert (got[1]["hometown"], got[1]["pre_hometown"], got[1]["pre_phone_number"]) == ("New Town", "Town 1", None)
    assert (got[2]["pre_hometown"], got[2]["pre_phone_number"]) == (None, "0900000002")
    assert got[3]["pre_hometown"] is None and got[3]["date_of_birth"] == dt.date(2000, 2, 2)
    assert got[4]["hometown"] == "Town 4"
    assert (got[11]["pre_hometown"], got[11]["pre_phone_number"]) == (None, None)


def test_scd4_scenario(spark):
    first, nothing = scd4(dimension(spark, "etl_date date"), day1(spark), KEYS, DAY1)
    assert nothing.count() == 0
    current, archive = scd4(first, day2(spark), KEYS, DAY2)
    now = by_key(current)
    assert len(now) == 11
    assert {k for k, r in now.items() if r["etl_date"] == DAY2} == {1, 2, 3, 11}
    old = by_key(archive)
    assert set(old) == {1, 2, 3}
    assert {(r["start_date"], r["end_date"]) for r in old.values()} == {(DAY1, DAY2)}
    assert old[1]["hometown"] == "Town 1"


@pytest.mark.parametrize("on_delete", ["keep", "drop"])
def test_scd4_parts_equal_the_two_results(spark, on_delete):
    first, _ = scd4(dimension(spark, "etl_date date"), day1(spark), KEYS, DAY1)
    current, archive = scd4(first, day2(spark), KEYS, DAY2, on_delete=on_delete)
    assert (4 in by_key(current)) == (on_delete == "keep")
    assert (4 in by_key(archive)) == (on_delete == "drop")
    parts = scd4_parts(first, day2(spark), KEYS, DAY2, on_delete=on_delete)
    assert rows(parts.where("scd__part = 'current'").select(*current.columns)) == rows(current)
    assert rows(parts.where("scd__part = 'archive'").select(*archive.columns)) == rows(archive)


# --- repeated runs ----------------------------------------------------------------------------------


def test_same_date_again_changes_nothing(spark):
    one = scd1(scd1(dimension(spark, "etl_date date"), day1(spark), KEYS, DAY1), day2(spark), KEYS, DAY2)
    assert rows(scd1(one, day2(spark), KEYS, DAY2)) == rows(one)

    two = scd2_days(spark, (DAY1, day1(spark)), (DAY2, day2(spark)))
    assert rows(scd2(two, day2(spark), KEYS, DAY2)) == rows(two)

    three = scd3(scd3_dimension(spark), day1(spark), KEYS, DAY1, PREVIOUS)
    three = scd3(three, day2(spark), KEYS, DAY2, PREVIOUS)
    assert rows(scd3(three, day2(spark), KEYS, DAY2, PREVIOUS)) == rows(three)

    four, _ = scd4(dimension(spark, "etl_date date"), day1(spark), KEYS, DAY1)
    four, _ = scd4(four, day2(spark), KEYS, DAY2)
    again, archive = scd4(four, day2(spark), KEYS, DAY2)
    assert rows(again) == rows(four) and archive.count() == 0


def test_scd2_closed_versions_stay_as_they_are(spark):
    two = scd2_days(spark, (DAY1, day1(spark)), (DAY2, day2(spark)))
    three = scd2(two, day2(spark), KEYS, DAY3)
    assert rows(three) == rows(two)


def test_scd2_value_that_comes_back_opens_a_version(spark):
    state = scd2_days(spark, (DAY1, day1(spark)), (DAY2, day2(spark)), (DAY3, day1(spark)))
    spans = sorted((r["start_date"], r["end_date"], r["hometown"]) for r in state.where("customer_id = 1").collect())
    assert spans == [(DAY1, DAY2, "Town 1"), (DAY2, DAY3, "New Town"), (DAY3, OPEN_END, "Town 1")]
    spans = sorted((r["start_date"], r["end_date"]) for r in state.where("customer_id = 4").collect())
    assert spans == [(DAY1, DAY2), (DAY3, OPEN_END)]


def test_scd2_corrected_snapshot_of_the_same_date(spark):
    state = scd2_days(spark, (DAY1, day1(spark)), (DAY2, day2(spark)), (DAY2, day1(spark)))
    assert state.where("start_date >= end_date").count() == 0
    assert rows(open_versions(state).select(*day1(spark).columns)) == rows(day1(spark))
    assert state.where("customer_id = 11").count() == 0
    assert rows(state) == rows(scd2_days(spark, (DAY1, day1(spark))))


def test_scd4_corrected_and_late_days(spark):
    empty = dimension(spark, "etl_date date")
    first, nothing = scd4(empty, day1(spark), KEYS, DAY1)
    current, archive = scd4(first, day2(spark), KEYS, DAY2, archived=nothing)
    again, archive = scd4(current, day2(spark), KEYS, DAY2, archived=archive)
    assert rows(again) == rows(current) and archive.count() == 3
    back, archive = scd4(again, day1(spark), KEYS, DAY2, archived=archive)
    assert rows(back) == rows(first) and archive.count() == 0
    with pytest.raises(Exception, match="lies before the date"):
        scd4(current, day1(spark), KEYS, DAY1)[0].collect()


def test_scd2_refuses_a_run_date_before_an_open_version(spark):
    state = scd2_days(spark, (DAY2, day1(spark)))
    with pytest.raises(Exception, match="lies before the start"):
        scd2(state, day2(spark), KEYS, DAY1).collect()


def test_scd2_without_audit_column(spark):
    state = scd2(dimension(spark, "start_date date", "end_date date"), day1(spark), KEYS, DAY1, date_col=None)
    state = scd2(state, day2(spark), KEYS, DAY2, date_col=None)
    assert state.count() == 14 and "etl_date" not in state.columns


def test_scd2_tracks_only_the_columns_asked_for(spark):
    cut = dimension(spark, *SCD2_DATES).select("customer_id", "hometown", "start_date", "end_date", "etl_date")
    state = scd2(cut, day1(spark), KEYS, DAY1)
    state = scd2(state, day2(spark), KEYS, DAY2)
    assert state.where(f"end_date = DATE'{DAY2}'").count() == 2  # keys 1 and 4


# --- NULL and combined changes -------------------------------------------------------------------------


def test_changes_to_and_from_null(spark):
    schema = "customer_id int, a string, b string"
    old = spark.createDataFrame([(1, None, "x"), (2, "p", "x"), (3, None, None)], schema)
    new = spark.createDataFrame([(1, "q", "x"), (2, None, "y"), (3, None, None)], schema)

    state = scd3(
        spark.createDataFrame([], schema + ", pre_a string, pre_b string, etl_date date"),
        old, KEYS, DAY1, {"a": "pre_a", "b": "pre_b"},
    )
    got = by_key(scd3(state, new, KEYS, DAY2, {"a": "pre_a", "b": "pre_b"}))
    assert (got[1]["a"], got[1]["pre_a"]) == ("q", None)
    assert (got[2]["a"], got[2]["pre_a"], got[2]["b"], got[2]["pre_b"]) == (None, "p", "y", "x")
    assert (got[3]["pre_a"], got[3]["pre_b"]) == (None, None)

    versions = scd2(spark.createDataFrame([], schema + ", start_date date, end_date date, etl_date date"), old, KEYS, DAY1)
    counts = {r["customer_id"]: r["count"] for r in scd2(versions, new, KEYS, DAY2).groupBy("customer_id").count().collect()}
    assert counts == {1: 2, 2: 2, 3: 1}


def test_several_key_columns_and_a_wider_source_key(spark):
    schema = "region string, id int, v double, start_date date, end_date date, etl_date date"
    target = spark.createDataFrame([], schema)
    old = spark.createDataFrame([("a", 1, 1.5), ("b", 1, float("nan"))], "region string, id bigint, v double")
    new = spark.createDataFrame([("a", 1, 2.5), ("b", 1, float("nan"))], "region string, id bigint, v double")
    state = scd2(scd2(target, old, ["region", "id"], DAY1), new, ["region", "id"], DAY2)
    assert state.schema["id"].dataType == target.schema["id"].dataType
    assert {(r["region"], r["v"]) for r in open_versions(state).where("region = 'a'").collect()} == {("a", 2.5)}
    assert state.where("region = 'b'").count() == 1
    assert state.count() == 3


# --- wrong input ----------------------------------------------------------------------------------------


def test_repeated_and_null_keys_are_refused(spark):
    twice = day1(spark).union(day1(spark).where("customer_id = 7"))
    null = day1(spark).selectExpr("nullif(customer_id, 7) AS customer_id", *day1(spark).columns[1:])
    for bad, message in ((twice, "repeated key"), (null, "NULL")):
        with pytest.raises(Exception, match=message):
            scd1(dimension(spark, "etl_date date"), bad, KEYS, DAY1).collect()
        with pytest.raises(Exception, match=message):
            scd2(dimension(spark, *SCD2_DATES), bad, KEYS, DAY1).collect()
        with pytest.raises(Exception, match=message):
            scd3(scd3_dimension(spark), bad, KEYS, DAY1, PREVIOUS).collect()
        with pytest.raises(Exception, match=message):
            scd4(dimension(spark, "etl_date date"), bad, KEYS, DAY1)[0].collect()


def test_map_columns_are_refused(spark):
    old = spark.createDataFrame([(1, {"a": 1})], "customer_id int, m map<string,int>")
    target = spark.createDataFrame([], "customer_id int, m map<string,int>, start_date date, end_date date, etl_date date")
    with pytest.raises(TypeError, match="map"):
        scd2(target, old, KEYS, DAY1)


def test_missing_column_is_named(spark):
    with pytest.raises(ValueError, match="hometown"):
        scd1(dimension(spark, "etl_date date"), day1(spark).drop("hometown"), KEYS, DAY1)
    with pytest.raises(ValueError, match="on_delete"):
        scd1(dimension(spark, "etl_date date"), day1(spark), KEYS, DAY1, on_delete="erase")


def test_column_names_that_need_quoting(spark):
    schema = "`the key` int, version string, part string, `it's` struct<`a b`:int>"
    old = spark.createDataFrame([(1, "v", "p", (1,)), (2, "v", "p", (1,))], schema)
    new = spark.createDataFrame([(1, "v", "q", (2,)), (2, "v", "p", (1,))], schema)
    keys = ["the key", "version"]
    dates = ", start_date date, end_date date, etl_date date"
    state = scd2(scd2(spark.createDataFrame([], schema + dates), old, keys, DAY1), new, keys, DAY2)
    assert state.count() == 3
    one = scd1(spark.createDataFrame([], schema + ", etl_date date"), old, keys, DAY1)
    assert rows(scd1(one, new, keys, DAY2).drop("etl_date")) == rows(new)
    current, archive = scd4(one, new, keys, DAY2)
    parts = scd4_parts(one, new, keys, DAY2)
    assert (current.count(), archive.count(), parts.count()) == (2, 1, 3)
    with pytest.raises(Exception, match="repeated key"):
        scd1(one, new.union(new), keys, DAY2).collect()
