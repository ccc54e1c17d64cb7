"""Tables in parts, diffs by fingerprint, the run ledger, and jobs that are run again on one day."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from dimkeeper.operators.diff import snapshot_diff
from dimkeeper.operators.merge import apply_changes
from dimkeeper.operators.scd import scd2
from dimkeeper.plans.dimension_jobs import run_scd2
from dimkeeper.plans.fingerprints import diff_by_fingerprint, differing_parts, save_with_fingerprints
from dimkeeper.plans.layers import Layers, Mart, active_rows, load_curated, run_layers
from dimkeeper.plans.ledger import Ledger, content_version
from dimkeeper.sources.parts import PART, ensure_parted_table, fill_parts, merge_touched_parts, parts_of, stored_rows
from dimkeeper.sources.scratch import scratch_dir
from tests.scenario import rows

D1, D2, D3 = dt.date(2025, 11, 30), dt.date(2025, 12, 1), dt.date(2025, 12, 2)


def table_of(spark, n, change=lambda k: f"v{k}"):
    return spark.createDataFrame([(k, change(k), None if k % 5 == 0 else float(k)) for k in range(n)], "id int, name string, amount double")


def files(spark, name):
    location = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()["data_type"].removeprefix("file:")
    return {d.rpartition("=")[2]: sorted(f for f in names if f.startswith("part-")) for d, _, names in os.walk(location) if f"{PART}=" in d}


# --- parts ----------------------------------------------------------------------------------------------


def test_a_merge_rewrites_the_touched_parts_only(spark, database):
    name = f"{database}.t"
    old = table_of(spark, 300)
    ensure_parted_table(spark, name, old.schema, ["id"], 32)
    fill_parts(spark, old, name, ["id"])
    before = files(spark, name)
    assert len(before) == 32 and all(len(f) == 1 for f in before.values())
    changes = spark.createDataFrame([(3, "new", None), (7, None, 1.0), (1000, "more", 2.0)], old.schema)
    touched = merge_touched_parts(spark, changes, name, ["id"])
    after = files(spark, name)
    assert 1 <= len(touched) <= 3
    assert {p for p in after if after[p] != before[p]} == {str(p) for p in touched}
    assert rows(stored_rows(spark, name)) == rows(old.where("id NOT IN (3, 7)").unionByName(changes))
    plan = spark.table(name).where(F.col(PART).isin(touched))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and PART in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_a_feed_may_empty_a_part_and_no_change_touches_none(spark, database):
    name = f"{database}.t"
    old = table_of(spark, 12)
    ensure_parted_table(spark, name, old.schema, ["id"], 64)
    fill_parts(spark, old, name, ["id"])
    feed = old.where("id = 5").withColumn("op", F.lit("D"))
    assert len(merge_touched_parts(spark, feed, name, ["id"], apply_changes)) == 1
    assert rows(stored_rows(spark, name)) == rows(old.where("id <> 5"))
    before = files(spark, name)
    assert merge_touched_parts(spark, old.where("false"), name, ["id"]) == []
    assert files(spark, name) == before
    # A bigint key would hash apart from the stored int; it is cast first.
    merge_touched_parts(spark, spark.createDataFrame([(3, "wide", 0.0)], "id long, name string, amount double"), name, ["id"])
    assert [r["name"] for r in stored_rows(spark, name).where("id = 3").collect()] == ["wide"]


def test_tables_without_parts_are_refused(spark, database):
    old = table_of(spark, 3)
    old.write.saveAsTable(f"{database}.plain")
    with pytest.raises(ValueError, match="not divided"):
        merge_touched_parts(spark, old, f"{database}.plain", ["id"])
    with pytest.raises(ValueError, match="not divided"):
        ensure_parted_table(spark, f"{database}.plain", old.schema, ["id"], 4)
    with pytest.raises(ValueError, match="exist already"):
        ensure_parted_table(spark, f"{database}.x", old.withColumn(PART, F.lit(1)).schema, ["id"], 4)
    assert parts_of(spark, f"{database}.plain") is None


def test_a_curated_table_in_parts_equals_one_without(spark, database):
    days = [(D1, table_of(spark, 60)), (D2, table_of(spark, 58, lambda k: "x" if k == 9 else f"v{k}")), (D3, table_of(spark, 60))]
    seen = []
    for day, snapshot in days:
        processed = snapshot.selectExpr("*", "'1' AS is_active", f"DATE'{day}' AS etl_date")
        n = load_curated(spark, processed, f"{database}.plain", ["id"], day)
        assert n == load_curated(spark, processed, f"{database}.parted", ["id"], day, publish=seen.append, parts=16)
    assert rows(stored_rows(spark, f"{database}.parted")) == rows(spark.table(f"{database}.plain"))
    assert len(seen) == 3 and PART not in seen[0].columns


# --- fingerprints -------------------------------------------------------------------------------------------


def test_diff_by_fingerprint_reads_the_parts_that_differ(spark, database):
    name = f"{database}.t"
    old = table_of(spark, 400)
    ensure_parted_table(spark, name, old.schema, ["id"], 64)
    save_with_fingerprints(spark, old, name, ["id"])
    assert differing_parts(spark, name, table_of(spark, 400), ["id"]) == []
    assert diff_by_fingerprint(spark, name, table_of(spark, 400), ["id"]).isEmpty()
    new = table_of(spark, 401, lambda k: None if k == 11 else f"v{k}").where("id <> 40")
    read = differing_parts(spark, name, new, ["id"])
    assert 1 <= len(read) <= 3
    assert rows(diff_by_fingerprint(spark, name, new, ["id"])) == rows(snapshot_diff(old, new, ["id"]))
    spark.sql(f"DROP TABLE {name}__sums")
    assert len(differing_parts(spark, name, new, ["id"])) == 64
    assert rows(diff_by_fingerprint(spark, name, old.where("false"), ["id"])) == rows(snapshot_diff(old, old.where("false"), ["id"]))


def test_versions_follow_from_the_rows(spark):
    frame = spark.createDataFrame([(1, None, [1, None]), (2, "a", None)], "a int, b string, c array<int>")
    assert content_version(frame) == content_version(frame.repartition(3).orderBy(F.desc("a")))
    others = [
        spark.createDataFrame([(1, None, [None, 1]), (2, "a", None)], frame.schema),
        spark.createDataFrame([(1, "a", [1, None]), (2, None, None)], frame.schema),
        spark.createDataFrame([(1, None, [1, None])] * 2 + [(2, "a", None)], frame.schema),
        frame.where("false"),
    ]
    assert len({content_version(x) for x in [frame, *others]}) == 5
    shifted = spark.createDataFrame([(None, 1), (2, None)], "a int, b int"), spark.createDataFrame([(1, None), (None, 2)], "a int, b int")
    assert content_version(shifted[0]) != content_version(shifted[1])


# --- ledger -------------------------------------------------------------------------------------------------


def test_a_step_runs_unless_its_last_record_is_the_same(spark, database):
    done = []

    def ledger(code="1"):
        return Ledger(spark, f"{database}.ledger", code)

    first = ledger().step("a", D1, {"x": 1}, lambda: done.append("a"))
    again = ledger()
    assert again.step("a", D1, {"x": 1}, lambda: done.append("a")) == first and again.skipped == ["a"]
    assert again.step("a", D1, {"x": 1}, lambda: done.append("b")) == first
    assert done == ["a"]
    changed = ledger().step("a", D1, {"x": 2}, lambda: done.append("c"))
    assert changed != first
    assert ledger().step("a", D1, {"x": 3}, lambda: False) == changed  # it changed nothing
    assert ledger("2").step("a", D1, {"x": 3}, lambda: done.append("d")) != changed  # other code
    assert done == ["a", "c", "d"]


def test_a_step_that_broke_off_runs_again_even_on_the_inputs_it_was_done_on_before(spark, database):
    name, done = f"{database}.ledger", []
    kept = Ledger(spark, name).step("a", D1, {"x": 1}, lambda: done.append(1))
    with pytest.raises(ZeroDivisionError):
        Ledger(spark, name).step("a", D2, {"x": 2}, lambda: 1 / 0)
    assert Ledger(spark, name).version("a") is None
    assert Ledger(spark, name).step("a", D1, {"x": 1}, lambda: False) != kept
    assert Ledger(spark, name).skipped == []


def test_layers_resume_at_the_step_that_failed(spark, database):
    layers = Layers(*(f"{database}_{x}" for x in ("stg", "prc", "cur", "dmt")), location=scratch_dir(spark))
    columns = {"id": F.col("id"), "name": F.col("name")}
    facts = [spark.createDataFrame(x, "id int, amount int") for x in ([(1, 10), (2, 20)], [(1, 10), (2, 25)])]
    log, broken = [], [True]
    layers.create(spark)

    def run(snapshot, day, fact, **more):
        def build(curated):
            if more.get("fails") and broken.pop():
                raise RuntimeError("breaks off")
            log.append("facts")
            return active_rows(curated).join(fact, "id").groupBy("name").agg(F.sum("amount").alias("amount"))

        def plain(curated):
            log.append("plain")
            return curated.select("id")

        ledger = Ledger(spark, f"{layers.cur}.ledger")
        run_layers(spark, snapshot, day, layers, ["id"], columns, "x", marts={"sales": Mart(build, {"facts": fact}), "ids": plain}, ledger=ledger)
        return ledger

    one, two = table_of(spark, 4), table_of(spark, 4, lambda k: "new" if k == 1 else f"v{k}")
    assert run(one, D1, facts[0]).skipped == []
    with pytest.raises(RuntimeError):
        run(two, D2, facts[0], fails=True)
    ledger = run(two, D2, facts[0])
    assert ledger.skipped == ["stg.x", "prc.x", "cur.x", "dmt.x_dim"] and ledger.ran == ["dmt.sales", "dmt.ids"]
    assert rows(spark.table(f"{layers.dmt}.sales")) == [(10, "new"), (20, "v2")]
    log.clear()
    ledger = run(two, D2, facts[1])  # only the facts have changed
    assert ledger.ran == ["dmt.sales", "dmt.ids"] and log == ["facts", "plain"]
    assert rows(spark.table(f"{layers.dmt}.sales")) == [(10, "new"), (25, "v2")]
    ledger = run(two, D3, facts[1])  # a day without changes: the curated table keeps its version
    assert ledger.ran == ["stg.x", "prc.x", "cur.x", "dmt.ids"] and ledger.skipped == ["dmt.x_dim", "dmt.sales"]


def test_without_a_ledger_a_failed_mart_is_built_by_the_next_run(spark, database):
    layers = Layers(*(f"{database}_{x}" for x in ("s", "p", "c", "d")), location=scratch_dir(spark))
    columns, broken = {"id": F.col("id"), "name": F.col("name")}, [True, False]

    def names(curated):
        if broken and broken.pop():
            raise RuntimeError("breaks off")
        return curated.select("name")

    for fails, snapshot, day in [(False, table_of(spark, 2), D1), (True, table_of(spark, 2, lambda k: "new"), D2), (False, table_of(spark, 2, lambda k: "new"), D2)]:
        if fails:
            with pytest.raises(RuntimeError):
                run_layers(spark, snapshot, day, layers, ["id"], columns, "x", marts={"names": names})
        else:
            run_layers(spark, snapshot, day, layers, ["id"], columns, "x", marts={"names": names})
    assert rows(spark.table(f"{layers.dmt}.names")) == [("new",), ("new",)]


# --- a day that is run again ----------------------------------------------------------------------------------


@pytest.mark.parametrize("wrong", [[1, 2], [], [2], [1]], ids=["insert only", "empty", "replaced", "unchanged"])
@pytest.mark.parametrize("right", [[1], [], [1, 2], [3]], ids=["as before", "empty", "more", "other"])
def test_a_corrected_day_leaves_no_trace_in_the_stored_dimension(spark, database, wrong, right):
    def snapshot(ids):
        return spark.createDataFrame([(k, f"v{k}") for k in ids], "id int, name string")

    name = f"{database}.dim"
    for day, ids in [(D1, [1]), (D2, wrong), (D2, right)]:
        run_scd2(spark, snapshot(ids), name, ["id"], day)
    state = spark.createDataFrame([], "id int, name string, start_date date, etl_date date, end_date date")
    for day, ids in [(D1, [1]), (D2, right)]:
        state = scd2(state, snapshot(ids), ["id"], day)
    assert rows(spark.table(name)) == rows(state)


def test_unchanged_days_publish_nothing_and_jobs_leave_nothing_behind(spark, database):
    from dimkeeper.plans.dimension_jobs import run_scd1
    from dimkeeper.plans.layers import load_dimension
    from dimkeeper.sources import scratch

    snapshot = table_of(spark, 6).selectExpr("*", "'1' AS is_active", "DATE'2025-11-30' AS etl_date")
    before = len(scratch._made.get(spark.sparkContext.applicationId, []))
    for kind in ("scd2", "scd4"):
        seen = []
        assert load_dimension(spark, snapshot, f"{database}.{kind}", ["id"], D1, kind, publish=seen.append) is None
        assert load_dimension(spark, snapshot, f"{database}.{kind}", ["id"], D2, kind, publish=seen.append) == 0
        assert len(seen) == 1
    run_scd1(spark, snapshot.drop("is_active", "etl_date"), f"{database}.one", ["id"], D1)
    assert len(scratch._made.get(spark.sparkContext.applicationId, [])) == before
