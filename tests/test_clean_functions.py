from __future__ import annotations

import datetime as dt

import pytest

from dimkeeper.functions import email_org, parse_run_date, tracked_columns
from dimkeeper.operators.clean import clean_nulls, dedup_latest, normalise_types, union_parts
from dimkeeper.plans.marts import add_metrics, sales_by_attributes
from pyspark.sql import functions as F


@pytest.mark.parametrize(
    "email, org",
    [("a@gmail.com", "gmail"), ("a@work.vn", "work"), ("abc", "abc"), ("a.b", "a"), ("a@", ""), ("a@b@c.d", "c"), (None, None)],
)
def test_email_org(spark, email, org):
    df = spark.createDataFrame([(email,)], "email string")
    assert df.select(email_org("email")).first()[0] == org
    assert df.select(email_org(F.col("email"))).first()[0] == org


def test_run_dates():
    day = dt.date(2025, 11, 30)
    assert parse_run_date(20251130) == parse_run_date("20251130") == parse_run_date(day) == day
    assert parse_run_date(dt.datetime(2025, 11, 30, 5)) == day
    assert parse_run_date() == dt.date.today()
    with pytest.raises(ValueError):
        parse_run_date(20251340)


def test_technical_columns_are_excluded_by_name_not_by_substring(spark):
    df = spark.createDataFrame([], "date int, etl_date date, etl int")
    assert tracked_columns(df, ["etl_date"]) == ["date", "etl"]


def test_clean_nulls(spark):
    df = spark.createDataFrame([(1, None, None), (2, "x", 5)], "id int, a string, n int")
    got = clean_nulls(df, {"a": "none", "n": 0}).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, "none", 0), (2, "x", 5)]


def test_dedup_latest_settles_ties_by_content(spark):
    data = [(1, 10, "a"), (1, 10, "b"), (1, 9, "z"), (2, None, "n"), (2, 1, "o")]
    df = spark.createDataFrame(data, "k int, t int, v string")
    for n in (1, 3, 7):
        got = sorted(tuple(r) for r in dedup_latest(df.repartition(n), ["k"], ["t"]).collect())
        assert got == [(1, 10, "b"), (2, 1, "o")]


def test_dedup_latest_of_a_hot_key_limits_rows_before_the_shuffle(spark):
    df = spark.range(0, 60000, numPartitions=6).selectExpr("IF(id % 3 = 0, 0, id) AS k", "id AS t")
    got = dedup_latest(df, ["k"], ["t"])
    assert got.count() == df.select("k").distinct().count()
    assert got.where("k = 0").first()["t"] == 59997
    plan = got._jdf.queryExecution().executedPlan().toString()
    below_shuffle = plan[plan.rindex("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below_shuffle


def test_normalise_types(spark):
    df = spark.createDataFrame(
        [(" 7 ", "20251130", " x", "1.5"), ("7a", "2025-11-30", None, "")], "i string, d string, s string, n string"
    )
    got = normalise_types(df, {"i": "int", "d": ("date", "yyyyMMdd"), "s": "string", "n": "decimal(5,2)"}).collect()
    assert (got[0]["i"], got[0]["d"], got[0]["s"], float(got[0]["n"])) == (7, dt.date(2025, 11, 30), "x", 1.5)
    assert tuple(got[1]) == (None, None, None, None)
    with pytest.raises(ValueError):
        normalise_types(df, {"d": ("int", "x")})


def test_union_parts_goes_by_name(spark):
    a = spark.createDataFrame([(1, "a")], "x int, y string")
    b = spark.createDataFrame([("b", 2)], "y string, x int")
    c = spark.createDataFrame([(3,)], "x int")
    assert sorted(tuple(r) for r in union_parts([a, b, c]).collect()) == [(1, "a"), (2, "b"), (3, None)]


def test_metrics_keep_every_dimension_row_and_every_fact(spark):
    dim = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k int, seg string")
    facts = spark.createDataFrame([(1, 10), (1, 5), (2, 1), (9, 7), (None, 2)], "k int, v int")
    got = {r["k"]: (r["n"], r["top"]) for r in add_metrics(
        dim, facts, ["k"], {"n": F.count(F.lit(1)), "top": F.max("v")}, zero=["n"]).collect()}
    assert got == {1: (2, 10), 2: (1, 1), 3: (0, None)}

    fact = sales_by_attributes(facts, dim, "k", {"big": F.col("v") > 5}, ["seg"], {"v": F.col("v"), "n": F.lit(1)})
    assert {(r["big"], r["seg"]): (r["v"], r["n"]) for r in fact.collect()} == {
        (True, "a"): (10, 1), (False, "a"): (5, 1), (False, "UNKNOWN"): (3, 2), (True, "UNKNOWN"): (7, 1),
    }


def test_dedup_keeps_a_users_rank_column(spark):
    df = spark.createDataFrame([(1, 5, 7), (1, 6, 8)], "k int, row__rank int, v int")
    assert [tuple(r) for r in dedup_latest(df, ["k"], ["v"]).collect()] == [(1, 6, 8)]


def test_marts_refuse_repeated_dimension_keys(spark):
    facts = spark.createDataFrame([(1, 10)], "k int, amount int")
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "k int, name string")
    total = F.col("amount")
    with pytest.raises(Exception, match="repeated key"):
        sales_by_attributes(facts, twice, "k", {}, ["name"], {"total": total}).collect()
    with pytest.raises(Exception, match="repeated key"):
        add_metrics(twice, facts, ["k"], {"total": F.sum("amount")}).collect()
