"""Facts by date, backfilled and late snapshots, ordered feeds, deltas, rejects, splits, sketches."""

from __future__ import annotations

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from dimkeeper.operators.asof import facts_as_of
from dimkeeper.operators.backfill import scd2_backdated, scd2_backfill
from dimkeeper.operators.clean import accepted_rows, normalise_checked, normalise_types, rejected_rows
from dimkeeper.operators.deltas import aggregate, apply_deltas, change_images, delta_sums
from dimkeeper.operators.feed import apply_ordered, feed_state, live_rows, net_changes
from dimkeeper.operators.scd import scd2
from dimkeeper.operators.sketches import daily_sketches, distinct_estimate, error_bound
from dimkeeper.plans.layers import load_checked
from dimkeeper.sources.scratch import materialise
from dimkeeper.sources.splits import plan_splits, read_branches, split_predicates
from tests.scenario import rows

DAYS = [dt.date(2025, 1, d) for d in range(1, 8)]
SCHEMA = "id int, town string, n int"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def histories(spark, seed, keys=60, days=len(DAYS)):
    """Random snapshots: keys come and go, change, and fall back; NULLs among the values; one day is empty."""
    rng = random.Random(seed)
    out, state = [], {}
    for day in DAYS[:days]:
        for k in range(keys):
            what = rng.random()
            if what < 0.25:
                state[k] = (rng.choice(["a", "b", None]), rng.choice([1, 2, None]))
            elif what < 0.35:
                state.pop(k, None)
        here = [] if day == DAYS[3] else [(k, *v) for k, v in state.items()]
        out.append((day, spark.createDataFrame(here, SCHEMA)))
    return out


def day_by_day(spark, days):
    state = spark.createDataFrame([], f"{SCHEMA}, start_date date, end_date date, etl_date date")
    for day, snapshot in days:
        state = materialise(scd2(state, snapshot, ["id"], day))
    return state


# --- facts as of a date ---------------------------------------------------------------------------------------


def asof_plainly(facts, versions):
    out = []
    for f in facts:
        found = [v for v in versions if v[0] == f[0] and f[1] is not None and v[0] is not None and v[3] <= f[1] < v[4]]
        out.append((*f, found[0][1] if found else None, found[0][2] if found else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot", [5_000_000, 20, 1], ids=["no hot key", "some hot keys", "every key hot"])
def test_facts_take_the_version_of_their_date(spark, hot):
    dimension = day_by_day(spark, histories(spark, 4))
    rng = random.Random(8)
    dates = [DAYS[0] - dt.timedelta(1), *DAYS, DAYS[-1] + dt.timedelta(400), None]
    facts = [(rng.choice([*range(70), None, 3, 3, 3, 3, 3]), rng.choice(dates), k // 2) for k in range(900)]
    facts += [(5, DAYS[2], 1)] * 150  # one day holds most facts of a key, and rows are repeated
    frame = spark.createDataFrame(facts, "id int, sold date, line int").repartition(5)
    found = facts_as_of(frame, dimension, ["id"], "sold", ["town", "n"], hot=hot)
    versions = [(r["id"], r["town"], r["n"], r["start_date"], r["end_date"]) for r in dimension.collect()]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == asof_plainly(facts, versions)


def test_a_hot_key_is_dealt_to_several_groups_and_carries_its_version(spark):
    """Nine tenths of the facts are of one key; no group of the window has more than about the limit."""
    dimension = spark.createDataFrame([(1, "a", DAYS[0], DAYS[3]), (1, "b", DAYS[3], dt.date(2099, 12, 31)), (2, "c", DAYS[0], DAYS[1])], "id int, town string, start_date date, end_date date")
    facts = spark.range(10_000).selectExpr("IF(id % 10 = 0, 2, 1) AS id", "date_add(DATE'2025-01-01', CAST(id % 7 AS int)) AS sold", "id AS line")
    found = facts_as_of(facts, dimension, ["id"], "sold", hot=500)
    counted = {(r["id"], r["town"]): r["count"] for r in found.groupBy("id", "town").count().collect()}
    plain = facts.selectExpr("id", "CASE WHEN id = 1 THEN IF(sold < DATE'2025-01-04', 'a', 'b') WHEN sold < DATE'2025-01-02' THEN 'c' END AS town")
    assert counted == {(r["id"], r["town"]): r["count"] for r in plain.groupBy("id", "town").count().collect()}
    assert "CartesianProduct" not in plan_of(found) and "NestedLoop" not in plan_of(found)


def test_facts_as_of_edges(spark):
    dimension = spark.createDataFrame([(1, "a", DAYS[0], DAYS[0]), (1, "b", DAYS[1], DAYS[2])], "id int, town string, start_date date, end_date date")
    facts = spark.createDataFrame([(1, DAYS[0]), (1, DAYS[1]), (1, DAYS[2])], "id int, sold date")
    assert rows(facts_as_of(facts, dimension, ["id"], "sold")) == sorted([(1, DAYS[0], None), (1, DAYS[1], "b"), (1, DAYS[2], None)], key=repr)
    assert facts_as_of(facts.where("false"), dimension, ["id"], "sold").collect() == []
    assert {r["town"] for r in facts_as_of(facts, dimension.where("false"), ["id"], "sold").collect()} == {None}
    with pytest.raises(ValueError, match="exist already"):
        facts_as_of(facts.withColumn("town", F.lit("x")), dimension, ["id"], "sold")


# --- many snapshots at once, and late ones ----------------------------------------------------------------------


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_backfill_equals_day_by_day(spark, seed):
    days = histories(spark, seed)
    dated = None
    for day, snapshot in days:
        part = snapshot.withColumn("d", F.lit(day))
        dated = part if dated is None else dated.unionByName(part)
    found = scd2_backfill(dated, ["id"], "d", [day for day, _ in days])
    assert rows(found) == rows(day_by_day(spark, days))
    without_empty = [(day, s) for day, s in days if day != DAYS[3]]
    assert rows(scd2_backfill(dated, ["id"], "d")) == rows(day_by_day(spark, without_empty))


def test_backfill_refuses_bad_rows_and_shuffles_once(spark):
    dated = spark.createDataFrame([(1, "a", 1, DAYS[0]), (1, "a", 1, DAYS[1])], f"{SCHEMA}, d date")
    for bad in [(1, "b", 1, DAYS[0]), (None, "b", 1, DAYS[0]), (2, "b", 1, None), (2, "b", 1, DAYS[5])]:
        with pytest.raises(Exception, match="snapshots|NULL in key"):
            scd2_backfill(dated.unionByName(spark.createDataFrame([bad], dated.schema)), ["id"], "d", DAYS[:2]).collect()
    assert scd2_backfill(dated.where("false"), ["id"], "d").collect() == []
    found = scd2_backfill(dated, ["id"], "d", DAYS[:2])
    assert rows(found) == [(dt.date(2099, 12, 31), DAYS[0], 1, 1, DAYS[0], "a")]
    keyed = [x for x in plan_of(found).split("\n") if "Exchange hashpartitioning(id" in x]
    assert len(keyed) == 1


@pytest.mark.parametrize("order", list(itertools.permutations(range(4)))[::5])
def test_any_order_of_the_same_snapshots_gives_the_same_dimension(spark, order):
    days = histories(spark, 7, keys=25, days=5)[1:]
    state, seen = spark.createDataFrame([], f"{SCHEMA}, start_date date, end_date date, etl_date date"), set()
    for k in order:
        day, snapshot = days[k]
        later = min((d for d in seen if d > day), default=None)
        state = materialise(scd2_backdated(state, snapshot, ["id"], day, until=later))
        seen.add(day)
    assert rows(state) == rows(day_by_day(spark, days))
    # An earlier day that is applied once more, with other rows, is replaced.
    wrong = materialise(scd2_backdated(state, days[0][1].limit(3).withColumn("town", F.lit("x")), ["id"], days[1][0], until=days[2][0]))
    assert rows(wrong) != rows(state)
    assert rows(scd2_backdated(wrong, days[1][1], ["id"], days[1][0], until=days[2][0])) == rows(state)


def test_a_late_day_checks_its_dates_and_keys(spark):
    state = spark.createDataFrame([], f"{SCHEMA}, start_date date, end_date date, etl_date date")
    one = spark.createDataFrame([(1, "a", 1)], SCHEMA)
    with pytest.raises(ValueError):
        scd2_backdated(state, one, ["id"], DAYS[1], until=DAYS[1])
    with pytest.raises(Exception, match="repeated key"):
        scd2_backdated(state, one.unionByName(one), ["id"], DAYS[1]).collect()


# --- ordered feeds ------------------------------------------------------------------------------------------------


def test_any_split_and_order_of_a_feed_gives_one_state(spark):
    rng = random.Random(3)
    changes, seq = [], 0
    for k in list(range(15)) * 6:
        seq += rng.randrange(1, 3)
        changes.append((k, rng.choice(["a", None]), rng.randrange(9), seq, rng.choice("IUUD")))
    start = spark.createDataFrame([(k, "old", 0) for k in range(0, 30, 2)], SCHEMA)
    expected = {k: ("old", 0) for k in range(0, 30, 2)}
    for k, town, n, _, op in sorted(changes, key=lambda c: c[3]):
        expected[k] = (town, n)
        if op == "D":
            del expected[k]
    schema = f"{SCHEMA}, seq long, op string"
    states = []
    for attempt in range(3):
        shuffled = changes + rng.sample(changes, 20)  # some arrive twice
        rng.shuffle(shuffled)
        size = [len(shuffled), 40, 17][attempt]
        state = feed_state(start)
        for at in range(0, len(shuffled), size):
            state = materialise(apply_ordered(state, spark.createDataFrame(shuffled[at : at + size], schema), ["id"]))
        states.append(rows(state))
        assert rows(live_rows(state)) == sorted(((k, n, town) for k, (town, n) in expected.items()), key=repr)
    assert states[0] == states[1] == states[2]


def test_a_tombstone_refuses_older_changes(spark):
    schema = f"{SCHEMA}, seq long, op string"
    state = feed_state(spark.createDataFrame([(1, "a", 1)], SCHEMA), 5)
    apply = lambda *changes: apply_ordered(state, spark.createDataFrame(changes, schema), ["id"])
    state = materialise(apply((1, "a", 1, 9, "D")))
    assert live_rows(state).collect() == []
    state = materialise(apply((1, "late", 1, 8, "U")))
    assert live_rows(state).collect() == []
    assert [r["town"] for r in live_rows(apply((1, "back", 1, 10, "I"))).collect()] == ["back"]
    assert rows(apply_ordered(state, spark.createDataFrame([], schema), ["id"])) == rows(state)
    for bad, message in [((1, "a", 1, 11, "X"), "unknown op"), ((None, "a", 1, 11, "U"), "NULL in key"), ((1, "a", 1, None, "U"), "no sequence")]:
        with pytest.raises(Exception, match=message):
            apply(bad).collect()


def test_of_a_hot_key_each_task_sends_one_change(spark):
    feed = spark.range(0, 40_000, 1, 8).selectExpr("1 AS id", "concat('t', id) AS town", "1 AS n", "id AS seq", "'U' AS op")
    net = net_changes(feed, ["id"])
    assert [tuple(r) for r in net.collect()] == [(1, "t39999", 1, 39_999, "U")]
    assert "partial_max" in plan_of(net)


# --- deltas -------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("seed", [1, 2])
def test_deltas_equal_the_full_rebuild(spark, seed):
    rng = random.Random(seed)
    schema = "id int, grp string, day date, amount decimal(18,2)"
    row = lambda k: (k, rng.choice(["a", "b", "c", None]), rng.choice([*DAYS[:2], None]), rng.choice([None, rng.randrange(500)]))
    old = [row(k) for k in range(80)]
    new = [r if rng.random() < 0.6 else row(r[0]) for r in old if rng.random() < 0.8 and r[1] != "c"] + [row(k) for k in range(100, 120)]
    before, after = (spark.createDataFrame(x, schema).withColumn("amount", F.col("amount").cast("decimal(18,2)")) for x in (prepared(old), prepared(new)))
    grain, sums = {"grp": F.col("grp"), "day": F.col("day")}, {"total": F.col("amount")}
    stored = materialise(aggregate(before, grain, sums))
    deltas = delta_sums(change_images(before, after, ["id"]), grain, sums)
    assert rows(apply_deltas(stored, deltas, list(grain), list(sums))) == rows(aggregate(after, grain, sums))
    assert delta_sums(change_images(before, before, ["id"]), grain, sums).collect() == []


def prepared(values):
    from decimal import Decimal

    return [(k, g, d, None if a is None else Decimal(a)) for k, g, d, a in values]


def test_applying_deltas_does_not_read_the_facts(spark, tmp_path):
    facts = spark.createDataFrame([(k, "a", k) for k in range(20)], "id int, grp string, amount int")
    facts.write.parquet(f"{tmp_path}/facts")
    grain, sums = {"grp": F.col("grp")}, {"total": F.col("amount")}
    stored = materialise(aggregate(spark.read.parquet(f"{tmp_path}/facts"), grain, sums))
    images = change_images(facts.where("id = 3"), facts.where("id = 3").withColumn("amount", F.lit(100)), ["id"])
    found = apply_deltas(stored, materialise(delta_sums(images, grain, sums)), ["grp"], ["total"])
    assert f"{tmp_path}/facts" not in found._jdf.queryExecution().toString()
    assert [tuple(r) for r in found.collect()] == [("a", 20, sum(range(20)) + 97)]


def test_deltas_that_do_not_belong_to_the_aggregate_fail(spark):
    facts = spark.createDataFrame([(1, "a", 5), (2, "a", 6)], "id int, grp string, amount int")
    grain, sums = {"grp": F.col("grp")}, {"total": F.col("amount")}
    deltas = delta_sums(change_images(facts, facts.where("false"), ["id"]), grain, sums)
    with pytest.raises(Exception, match="more facts"):
        apply_deltas(aggregate(facts.where("id = 1"), grain, sums), deltas, ["grp"], ["total"]).collect()
    with pytest.raises(TypeError, match="decimal"):
        aggregate(facts, grain, {"total": F.col("amount").cast("double")})


# --- rejects --------------------------------------------------------------------------------------------------------

TYPES = {"id": "int", "town": "string", "born": ("date", "yyyyMMdd"), "n": "double"}
TEXT = [(" 1 ", " a", "20250101", "1.5"), ("x", "b", "2025-01-01", "y"), (None, None, None, None), ("", " ", "  ", ""), ("1", "c", "20250101", "abc"), ("1", "c", "20250101", "abc")]


def test_accepted_and_rejected_rows_are_all_rows(spark):
    text = spark.createDataFrame(TEXT, "id string, town string, born string, n string")
    checked = normalise_checked(text, TYPES)
    accepted, rejected = accepted_rows(checked), rejected_rows(checked)
    assert accepted.count() + rejected.count() == text.count()
    reasons = sorted((r["id"], [tuple(x) for x in r["rejects"]]) for r in rejected.collect())
    bad_n = [("n", "abc", "not a value of type double")]
    assert reasons == [("1", bad_n), ("1", bad_n), ("x", [("id", "x", "not a value of type int"), ("born", "2025-01-01", "not a value of type date yyyyMMdd"), ("n", "y", "not a value of type double")])]
    assert rows(accepted) == rows(normalise_types(text.where("n IS NULL OR n NOT IN ('abc', 'y')"), TYPES))
    assert rejected_rows(normalise_checked(text, TYPES, empty_is_null=False)).where("id = ''").count() == 1
    assert accepted_rows(normalise_checked(text, {"town": "string"})).count() == 6


def test_a_checked_load_counts_on_the_way(spark, database):
    text = spark.createDataFrame(TEXT, "id string, town string, born string, n string")
    counts = load_checked(spark, text, f"{database}.good", f"{database}.bad", TYPES, DAYS[0])
    assert counts == {"rows": 6, "accepted": 3, "rejected": 3, "rejected by id": 1, "rejected by born": 1, "rejected by n": 3}
    assert spark.table(f"{database}.good").count() == 3 and spark.table(f"{database}.bad").where("etl_date = DATE'2025-01-01'").count() == 3
    nothing = load_checked(spark, text.where("false"), f"{database}.good", f"{database}.bad", TYPES, DAYS[1])
    assert nothing["rows"] == 0 and spark.table(f"{database}.good").count() == 0 and spark.table(f"{database}.bad").count() == 0


# --- splits ---------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("kind", ["bigint", "int", "decimal(12,2)", "date"])
def test_each_row_is_in_exactly_one_branch_and_branches_are_of_like_size(spark, kind):
    value = "CASE WHEN id % 4 = 0 THEN 5 WHEN id % 17 = 0 THEN NULL ELSE id * id % 9973 - 3000 END"
    column = f"date_add(DATE'2020-01-01', CAST({value} AS int))" if kind == "date" else f"CAST({value} AS {kind})"
    frame = spark.range(8000).selectExpr("id", f"{column} AS c")
    predicates = plan_splits(frame, "c", 8)
    read = read_branches(frame, predicates)
    assert read.count() == 8000 and read.select("id").distinct().count() == 8000
    sizes = {r["branch"]: r["count"] for r in read.groupBy("branch").count().collect()}
    ranges = [sizes.get(n, 0) for n, p in enumerate(predicates) if "<" in p or ">" in p]
    alone = [n for n, p in enumerate(predicates) if " = " in p]
    assert len(alone) == 1 and sizes[alone[0]] >= 2000
    assert max(ranges) <= 2 * 1000


def test_predicates_are_disjoint_and_complete_for_any_borders(spark):
    rng = random.Random(2)
    frame = spark.range(-3, 25).selectExpr("IF(id = -3, NULL, id) AS c")
    for _ in range(12):
        borders = sorted(rng.choices(range(20), k=rng.randrange(0, 9)))
        hits = frame.select("c", *[F.expr(f"IF({p}, 1, 0)").alias(f"p{n}") for n, p in enumerate(split_predicates("c", borders))])
        assert {sum(r[1:]) for r in hits.collect()} == {1}


def test_splits_of_empty_and_constant_columns(spark):
    frame = spark.createDataFrame([(1, None), (2, None)], "id int, c int")
    assert read_branches(frame, plan_splits(frame, "c", 4)).count() == 2
    assert read_branches(frame.where("false"), plan_splits(frame.where("false"), "c", 4)).count() == 0
    same = spark.range(50).selectExpr("id", "7 AS c")
    predicates = plan_splits(same, "c", 4)
    assert read_branches(same, predicates).count() == 50 and "c = 7" in predicates
    assert plan_splits(same, "c", 1) == ["c IS NOT NULL", "c IS NULL"]
    with pytest.raises(TypeError):
        plan_splits(same.withColumn("c", F.lit(1.5)), "c", 4)
    with pytest.raises(ValueError):
        plan_splits(same, "c", 0)


# --- sketches ---------------------------------------------------------------------------------------------------------


def test_sketches_of_any_range_of_days_come_near_the_exact_count(spark):
    events = spark.range(60_000).selectExpr("date_add(DATE'2025-01-01', CAST(id % 30 AS int)) AS day", "IF(id % 3 = 0, 'x', 'y') AS kind", "IF(id % 50 = 0, NULL, id * id % 20011) AS user")
    stored = materialise(daily_sketches(events, {"day": F.col("day"), "kind": F.col("kind")}, F.col("user")))
    assert stored.count() == 30  # a day has one kind here
    for low, high in [(1, 30), (5, 5), (10, 24)]:
        some = F.col("day").between(dt.date(2025, 1, low), dt.date(2025, 1, high))
        exact = {r["kind"]: r["n"] for r in events.where(some).groupBy("kind").agg(F.countDistinct("user").alias("n")).collect()}
        near = {r["kind"]: r["n_distinct"] for r in distinct_estimate(stored.where(some), ["kind"]).collect()}
        assert near.keys() == exact.keys()
        assert all(abs(near[k] - n) <= error_bound() * n + 1 for k, n in exact.items())
    assert distinct_estimate(stored.where("false"), ["kind"]).collect() == []


# --- stored dimensions, feeds and marts ---------------------------------------------------------------------------------


def test_a_stored_dimension_takes_days_in_any_order_and_again(spark, database):
    from dimkeeper.plans.dimension_jobs import run_scd2_any_day

    days = histories(spark, 12, keys=20, days=5)
    name = f"{database}.dim"
    for k in (2, 4, 0, 3, 1, 3, 4):
        run_scd2_any_day(spark, days[k][1] if k != 1 else days[1][1].limit(2), name, ["id"], days[k][0])
    run_scd2_any_day(spark, days[1][1], name, ["id"], days[1][0])  # corrected
    assert rows(spark.table(name)) == rows(day_by_day(spark, days))
    assert sorted(r["day"] for r in spark.table(f"{name}__days").collect()) == [d for d, _ in days]


def test_a_feed_rewrites_the_parts_it_touches(spark, database):
    from dimkeeper.plans.dimension_jobs import run_feed
    from dimkeeper.sources.parts import ensure_parted_table, fill_parts, stored_rows

    name = f"{database}.state"
    state = feed_state(spark.createDataFrame([(k, "a", k) for k in range(100)], SCHEMA))
    ensure_parted_table(spark, name, state.schema, ["id"], 32)
    fill_parts(spark, state, name, ["id"])
    schema = f"{SCHEMA}, seq long, op string"
    late, now = (7, "late", 0, 1, "U"), (7, "x", 1, 3, "U")
    assert len(run_feed(spark, spark.createDataFrame([now, (8, "gone", 0, 2, "D"), now], schema), name, ["id"])) <= 2
    run_feed(spark, spark.createDataFrame([late, (8, "back", 0, 1, "I")], schema), name, ["id"])
    live = {r["id"]: r["town"] for r in live_rows(stored_rows(spark, name)).collect()}
    assert live[7] == "x" and 8 not in live and len(live) == 99
    with pytest.raises(ValueError, match="lacks feed column"):
        run_feed(spark, spark.createDataFrame([(*now, 1)], f"{schema}, more int"), name, ["id"])


def test_sales_by_the_attributes_of_their_date_equal_the_facts_in_sum(spark):
    from dimkeeper.plans.marts import sales_as_of

    dimension = day_by_day(spark, histories(spark, 5))
    facts = spark.range(4000).selectExpr("IF(id % 3 = 0, 1, CAST(id % 70 AS int)) AS id", "IF(id % 41 = 0, NULL, date_add(DATE'2024-12-30', CAST(id % 12 AS int))) AS sold", "CAST(id % 9 AS decimal(9,2)) AS amount")
    fact = sales_as_of(facts, dimension, "id", F.col("sold"), {}, ["town"], {"n_sold": F.lit(1), "total": F.col("amount")})
    plain = facts_as_of(facts, dimension.select("id", "town", "start_date", "end_date"), ["id"], "sold").groupBy(F.coalesce("town", F.lit("UNKNOWN")).alias("town"))
    assert rows(fact) == rows(plain.agg(F.count(F.lit(1)).alias("n_sold"), F.sum("amount").alias("total")))
    assert fact.agg(F.sum("n_sold")).first()[0] == 4000


def test_a_jdbc_source_gets_planned_predicates(spark, monkeypatch):
    from dimkeeper.sources import splits
    from dimkeeper.sources.read import JdbcSource

    monkeypatch.setattr(splits, "read_source", lambda spark, source, columns: spark.range(100).selectExpr("id AS account"))
    source = splits.split_source(spark, JdbcSource("jdbc:x", "t", column="old", lower=1, upper=2, partitions=2), "account", 4)
    assert source.column is None and len(source.predicates) == 5 and source.predicates[-1] == "account IS NULL"
