"""Tables, jobs and layers: contents, repeated runs and runs that broke off."""

from __future__ import annotations

import os
from functools import reduce

import pytest
from pyspark.errors import AnalysisException, UnsupportedOperationException
from pyspark.sql import functions as F

from dimkeeper.functions import OPEN_END
from dimkeeper.operators.clean import clean_nulls, dedup_latest
from dimkeeper.operators.merge import merge_upsert
from dimkeeper.operators.scd import scd2, scd4_parts
from dimkeeper.plans.daily_snapshots import CUSTOMER_KEYS, ORDER_KEYS, customer_days, orders_days
from dimkeeper.plans.dimension_jobs import run_scd1, run_scd2, run_scd3, run_scd4
from dimkeeper.plans.layers import Layers, conform, customer_columns, load_curated, run_layers
from dimkeeper.sources import tables
from dimkeeper.sources.read import JdbcSource, jdbc_write_options, read_source
from dimkeeper.sources.scratch import materialise, release, scratch_dir
from dimkeeper.sources.tables import (
    append_missing,
    bucket_spec,
    drop_table,
    ensure_table,
    find_staging,
    finish_replace,
    mark_staged,
    merge_into,
    new_staging_name,
    save_table,
    staged_replace,
)
from tests.scenario import DAY1, DAY2, DAY3, KEYS, PREVIOUS, by_key, day1, day2, rows


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- tables ----------------------------------------------------------------------------------------


def test_a_file_table_cannot_overwrite_itself_but_can_through_staging(spark, database):
    name = f"{database}.customer"
    save_table(spark, day1(spark), name)
    merged = merge_upsert(spark.table(name), day2(spark), KEYS)
    expected = rows(merged)
    with pytest.raises(AnalysisException):
        merged.write.mode("overwrite").saveAsTable(name)
    staged_replace(spark, merged, name)
    assert rows(spark.table(name)) == expected
    assert find_staging(spark, name) is None


def test_columns_go_by_name(spark, database):
    name = f"{database}.t"
    ensure_table(spark, name, day1(spark).schema)
    staged_replace(spark, day1(spark).select(*reversed(day1(spark).columns)), name)
    assert rows(spark.table(name)) == rows(day1(spark))


def test_replace_is_completed_after_a_break(spark, database, monkeypatch):
    name = f"{database}.customer"
    save_table(spark, day1(spark), name)
    with monkeypatch.context() as m:
        m.setattr(tables, "finish_replace", lambda *a: (_ for _ in ()).throw(RuntimeError("executor lost")))
        with pytest.raises(RuntimeError):
            staged_replace(spark, day2(spark), name)
    assert rows(spark.table(name)) == rows(day1(spark))
    assert finish_replace(spark, name)
    assert rows(spark.table(name)) == rows(day2(spark))
    assert not finish_replace(spark, name)


def test_files_of_a_killed_run_are_in_nobodys_way(spark, database, tmp_path):
    name = f"{database}.customer"
    save_table(spark, day1(spark), name)
    for leftover in ("customer__staging", "customer__staging_0", "customer/_temporary"):
        day1(spark).write.parquet(f"{tmp_path}/db/{leftover}/0/part")
    staged_replace(spark, merge_upsert(spark.table(name), day2(spark), KEYS), name)
    assert spark.table(name).count() == 11
    save_table(spark, day2(spark), name)
    assert rows(spark.table(name)) == rows(day2(spark))


def test_two_staged_states_are_not_guessed_between(spark, database):
    name = f"{database}.customer"
    save_table(spark, day1(spark), name)
    own = [f"{name}__staging_area", new_staging_name(name), new_staging_name(f"{database}.customer_his")]
    for n in own:  # a user's tables, whatever they are called
        save_table(spark, day2(spark), n)
    assert find_staging(spark, name) is None and not finish_replace(spark, name)
    staged_replace(spark, day1(spark), name)
    assert all(rows(spark.table(n)) == rows(day2(spark)) for n in own)
    for _ in range(2):
        staging = new_staging_name(name)
        day2(spark).write.saveAsTable(staging)
        mark_staged(spark, staging, name)
    with pytest.raises(RuntimeError, match="several runs"):
        finish_replace(spark, name)


def test_save_table_follows_changed_columns(spark, database):
    name = f"{database}.customer"
    save_table(spark, day1(spark), name)
    with pytest.raises(ValueError, match="other columns"):
        save_table(spark, day1(spark).drop("gender"), name)
    save_table(spark, day1(spark).drop("gender"), name, new_columns=True)
    assert spark.table(name).columns == day1(spark).columns[:-1]


@pytest.mark.parametrize("new_columns", [False, True])
def test_a_write_that_fails_changes_nothing(spark, database, new_columns):
    name = f"{database}.customer"
    save_table(spark, day1(spark), name)
    bad = day2(spark).withColumn("gender", F.expr("IF(customer_id = 3, raise_error('bad row'), gender)"))
    bad = bad.withColumn("more", F.lit(1)) if new_columns else bad
    with pytest.raises(Exception, match="bad row"):
        save_table(spark, bad, name, new_columns)
    assert rows(spark.table(name)) == rows(day1(spark))


def test_save_table_keeps_the_layout(spark, database):
    name = f"{database}.t"
    ensure_table(spark, name, day1(spark).schema, partition_by=["gender"], bucket_by=KEYS, buckets=4)
    save_table(spark, day1(spark), name)
    save_table(spark, day2(spark), name)
    assert bucket_spec(spark, name) == (4, KEYS)
    assert [c.name for c in spark.catalog.listColumns(name) if c.isPartition] == ["gender"]
    assert rows(spark.table(name).select(*day2(spark).columns)) == rows(day2(spark))


def test_partition_values_stay_typed(spark, database):
    name = f"{database}.t"
    values = ["a:b", "a'b", "a%b", "a/b", "a b", "", None, "c"]
    old = spark.createDataFrame([(k, v) for k, v in enumerate([*values, "stays"])], "k int, p string")
    ensure_table(spark, name, old.schema, partition_by=["p"])
    staged_replace(spark, old, name, "p")
    new = old.where("coalesce(p, '') <> 'stays'").selectExpr("k + 100 AS k", "p")
    staged_replace(spark, new, name, "p", always=["c", "a'b"])
    want = {(100 + k, v or None) for k, v in enumerate(values)} | {(len(values), "stays")}
    assert {(r["k"], r["p"]) for r in spark.table(name).collect()} == want
    staged_replace(spark, new.where("k = 100"), name, "p", always=["a'b"])
    assert spark.table(name).where("p = \"a'b\"").count() == 0 and spark.table(name).count() == len(want) - 1


def test_an_unpartitioned_table_takes_over_the_staged_files(spark, database, monkeypatch):
    name = f"{database}.t"
    save_table(spark, day1(spark), name)
    with monkeypatch.context() as m:
        m.setattr(tables, "finish_replace", lambda *a: False)
        staged_replace(spark, day2(spark), name)
    staged = {f.rsplit("/", 1)[1] for f in spark.table(find_staging(spark, name)).inputFiles()}
    old = spark.table(name).inputFiles()
    with monkeypatch.context() as m:
        m.setattr(tables, "drop_table", lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
        with pytest.raises(RuntimeError):
            finish_replace(spark, name)
    assert rows(spark.table(name)) == rows(day2(spark))
    assert finish_replace(spark, name)
    assert {f.rsplit("/", 1)[1] for f in spark.table(name).inputFiles()} == staged
    assert rows(spark.table(name)) == rows(day2(spark))
    assert not any(os.path.exists(f.removeprefix("file:")) for f in old)


def test_append_twice_adds_once(spark, database):
    name = f"{database}.h"
    ensure_table(spark, name, day1(spark).schema)
    append_missing(spark, day1(spark), name, KEYS)
    append_missing(spark, day1(spark), name, KEYS)
    append_missing(spark, day2(spark), name, KEYS)
    assert spark.table(name).count() == 11


def test_row_level_merge_is_left_to_the_catalog(spark, database):
    name = f"{database}.customer"
    save_table(spark, day1(spark), name)
    with pytest.raises(UnsupportedOperationException, match="MERGE INTO"):
        merge_into(spark, day2(spark), name, KEYS)


def test_ensure_and_drop(spark, database):
    name = f"{database}.t"
    ensure_table(spark, name, day1(spark).schema, partition_by=["gender"], bucket_by=KEYS, buckets=4)
    ensure_table(spark, name, day1(spark).schema)
    assert bucket_spec(spark, name) == (4, KEYS)
    drop_table(spark, name)
    drop_table(spark, name)
    assert not spark.catalog.tableExists(name)


# --- jobs ------------------------------------------------------------------------------------------------


def test_scd1_job(spark, database):
    name = f"{database}.dim"
    for day, snapshot in ((20251130, day1(spark)), (20251201, day2(spark)), (20251201, day2(spark))):
        run_scd1(spark, snapshot, name, KEYS, day)
    assert len(by_key(spark.table(name))) == spark.table(name).count() == 11


def test_scd3_job_places_previous_columns(spark, database):
    name = f"{database}.dim"
    for day, snapshot in ((DAY1, day1(spark)), (DAY2, day2(spark)), (DAY2, day2(spark))):
        run_scd3(spark, snapshot, name, KEYS, PREVIOUS, day)
    assert spark.table(name).columns == [
        "customer_id", "full_name", "date_of_birth", "hometown", "pre_hometown",
        "phone_number", "pre_phone_number", "email", "gender", "etl_date",
    ]
    assert by_key(spark.table(name))[1]["pre_hometown"] == "Town 1"


@pytest.mark.parametrize("buckets", [0, 8])
def test_scd2_job_equals_the_operator(spark, database, buckets):
    name = f"{database}.dim"
    days = [(DAY1, day1(spark)), (DAY2, day2(spark)), (DAY2, day2(spark)), (DAY3, day1(spark))]
    state = None
    for day, snapshot in days:
        run_scd2(spark, snapshot, name, KEYS, day, buckets=buckets)
        if state is None:
            state = spark.table(name).where("false")
        state = scd2(state, snapshot, KEYS, day)
    assert rows(spark.table(name)) == rows(state.select(*spark.table(name).columns))


def test_scd2_job_empties_the_open_partition_when_all_keys_are_gone(spark, database):
    name = f"{database}.dim"
    run_scd2(spark, day1(spark), name, KEYS, DAY1)
    run_scd2(spark, day1(spark).where("false"), name, KEYS, DAY2)
    assert {(r["start_date"], r["end_date"]) for r in spark.table(name).collect()} == {(DAY1, DAY2)}
    assert spark.table(name).count() == 10


def test_scd2_job_completes_a_run_that_broke_off(spark, database):
    name = f"{database}.dim"
    run_scd2(spark, day1(spark), name, KEYS, DAY1)
    expected = rows(scd2(spark.table(name), day2(spark), KEYS, DAY2))
    staged = scd2(spark.table(name), day2(spark), KEYS, DAY2)
    staging = new_staging_name(name)
    staged.write.partitionBy("end_date").saveAsTable(staging)
    mark_staged(spark, staging, name, partition="end_date", always=f"DATE'{OPEN_END}'")
    # Only the open partition got its new content; the versions closed on day 2 are still missing.
    columns = ", ".join(c for c in spark.table(name).columns if c != "end_date")
    spark.sql(
        f"INSERT OVERWRITE TABLE {name} PARTITION (end_date = '{OPEN_END}') BY NAME "
        f"SELECT {columns} FROM {staging} WHERE end_date = DATE'{OPEN_END}'"
    )
    run_scd2(spark, day2(spark), name, KEYS, DAY2)
    assert rows(spark.table(name)) == expected


def test_scd2_job_reads_two_partitions_and_leaves_the_others(spark, database):
    name = f"{database}.dim"
    for day, snapshot in ((DAY1, day1(spark)), (DAY2, day2(spark)), (DAY3, day1(spark))):
        run_scd2(spark, snapshot, name, KEYS, day)
    files = set(spark.table(name).where(f"end_date = DATE'{DAY2}'").inputFiles())
    stored = spark.table(name).where(f"end_date IN (DATE'{OPEN_END}', DATE'{DAY3}')")
    assert "PartitionFilters: [end_date" in plan_of(stored)
    run_scd2(spark, day2(spark), name, KEYS, DAY3)
    assert set(spark.table(name).where(f"end_date = DATE'{DAY2}'").inputFiles()) == files


def test_bucketed_dimension_is_not_shuffled(spark, database):
    name = f"{database}.dim"
    run_scd2(spark, day1(spark), name, KEYS, DAY1, buckets=8)
    stored = spark.table(name).where(f"end_date = DATE'{OPEN_END}'")
    result = scd2(stored, day2(spark), KEYS, DAY2)
    plan = plan_of(result)
    join = plan[plan.index("SortMergeJoin"):plan.rindex("Bucketed: true")]
    assert "FullOuter" in plan and join.count("Exchange hashpartitioning") <= 1
    left = plan[plan.index("SortMergeJoin"):plan.index("Bucketed: true")]
    assert "Exchange" not in left


def test_bucketed_tables_get_one_file_per_bucket(spark, database):
    many = spark.range(4000).selectExpr("id AS customer_id", "id % 7 AS v")
    name = f"{database}.dim"
    run_scd2(spark, many, name, KEYS, DAY1, buckets=8)
    changed = many.selectExpr("customer_id", "IF(customer_id % 5 = 0, -1, v) AS v")
    run_scd2(spark, changed, name, KEYS, DAY2, buckets=8)
    for end, n in ((OPEN_END, 4000), (DAY2, 800)):
        part = spark.table(name).where(f"end_date = DATE'{end}'")
        assert part.count() == n and len(part.inputFiles()) <= 8

    plain = f"{database}.plain"
    ensure_table(spark, plain, many.schema, bucket_by=KEYS, buckets=8)
    staged_replace(spark, many.repartition(16), plain)
    assert spark.table(plain).count() == 4000 and len(spark.table(plain).inputFiles()) <= 8


def test_scd4_job(spark, database):
    current, history = f"{database}.dim", f"{database}.dim_his"
    for day, snapshot in ((DAY1, day1(spark)), (DAY2, day2(spark)), (DAY2, day2(spark)), (DAY3, day1(spark))):
        run_scd4(spark, snapshot, current, history, KEYS, day)
    assert spark.table(current).count() == 11
    spans = sorted((r["customer_id"], r["start_date"], r["end_date"]) for r in spark.table(history).collect())
    assert spans == sorted([(k, DAY1, DAY2) for k in (1, 2, 3)] + [(k, DAY2, DAY3) for k in (1, 2, 3)])


def test_scd4_job_completes_a_run_that_broke_off(spark, database):
    current, history = f"{database}.dim", f"{database}.dim_his"
    run_scd4(spark, day1(spark), current, history, KEYS, DAY1)
    parts = scd4_parts(spark.table(current), day2(spark), KEYS, DAY2)
    staging = new_staging_name(current)
    parts.write.partitionBy("scd__part").saveAsTable(staging)
    mark_staged(spark, staging, current, day=DAY2.isoformat())
    archive = spark.table(staging).where("scd__part = 'archive'")
    append_missing(spark, archive, history, [*KEYS, "start_date"])  # and then the run broke off
    run_scd4(spark, day2(spark), current, history, KEYS, DAY2)
    assert spark.table(history).count() == 3
    assert by_key(spark.table(current))[1]["hometown"] == "New Town"


def test_a_day_without_changes_leaves_the_files(spark, database):
    two, four, history = f"{database}.two", f"{database}.four", f"{database}.four_his"
    for day, snapshot in ((DAY1, day1(spark)), (DAY2, day2(spark))):
        run_scd2(spark, snapshot, two, KEYS, day)
        run_scd4(spark, snapshot, four, history, KEYS, day)
    before = [set(spark.table(t).inputFiles()) for t in (two, four, history)]
    state = [rows(spark.table(t)) for t in (two, four, history)]
    run_scd2(spark, day2(spark), two, KEYS, DAY3)
    run_scd4(spark, day2(spark), four, history, KEYS, DAY3)
    assert [set(spark.table(t).inputFiles()) for t in (two, four, history)] == before
    # A day of changes, corrected back: what it closed is open again, in the jobs as well.
    for day, snapshot in ((DAY3, day1(spark)), (DAY3, day2(spark))):
        run_scd2(spark, snapshot, two, KEYS, day)
        run_scd4(spark, snapshot, four, history, KEYS, day)
    assert [rows(spark.table(t)) for t in (two, four, history)] == state


def test_a_job_refuses_columns_that_its_table_lacks(spark, database):
    name = f"{database}.dim"
    run_scd1(spark, day1(spark), name, KEYS, DAY1)
    with pytest.raises(ValueError, match="lacks source column"):
        run_scd1(spark, day2(spark).withColumn("more", F.lit(1)), name, KEYS, DAY2)


# --- layers ------------------------------------------------------------------------------------------------


def test_layers(spark, tmp_path):
    layers = Layers("l_stg", "l_prc", "l_cur", "l_dmt", str(tmp_path))
    run_layers(spark, day1(spark), DAY1, layers)
    mart = run_layers(spark, day2(spark), DAY2, layers)
    assert spark.table("l_stg.customer").columns == [*day1(spark).columns, "etl_date"]
    assert mart.columns == [
        "customer_id", "customer_name", "customer_birth", "customer_hometown", "customer_phone_num",
        "customer_email", "customer_source", "customer_gender", "is_active", "etl_date",
    ]
    assert set(by_key(mart)) == {1, 2, 3, 5, 6, 7, 8, 9, 10, 11}
    assert by_key(mart)[1]["customer_source"] == "mail1"
    curated = by_key(spark.table("l_cur.customer"))
    assert curated[4]["is_active"] == "0" and len(curated) == 11
    files = set(spark.table("l_dmt.customer_dim").inputFiles())
    run_layers(spark, day2(spark), DAY3, layers)
    assert set(spark.table("l_dmt.customer_dim").inputFiles()) == files
    for name in ("l_stg", "l_prc", "l_cur", "l_dmt"):
        spark.sql(f"DROP DATABASE {name} CASCADE")


def test_curated_load_writes_and_publishes_changes_only(spark, database):
    name, published = f"{database}.customer", []

    def load(snapshot, day):
        return load_curated(
            spark, conform(snapshot, customer_columns(), day), name, KEYS, day, lambda df: published.append(df.count())
        )

    assert load(day1(spark), DAY1) == 10
    files = set(spark.table(name).inputFiles())
    assert load(day1(spark), DAY2) == 0
    assert set(spark.table(name).inputFiles()) == files
    assert load(day2(spark), DAY3) == 5
    assert published == [10, 11]


def test_curated_load_publishes_after_a_run_that_broke_off(spark, database):
    name = f"{database}.customer"

    def load(publish):
        return load_curated(spark, conform(day1(spark), customer_columns(), DAY1), name, KEYS, DAY1, publish)

    def broken(df):
        raise RuntimeError("serving database away")

    with pytest.raises(RuntimeError):
        load(broken)
    published = []
    assert load(lambda df: published.append(df.count())) == 0
    assert published == [10]


# --- sources -------------------------------------------------------------------------------------------------


def test_read_source(spark, database, tmp_path):
    path = str(tmp_path / "files")
    day1(spark).write.parquet(path)
    save_table(spark, day1(spark), f"{database}.customer")
    for source in (path, f"{database}.customer"):
        assert read_source(spark, source, ["customer_id", "email"]).columns == ["customer_id", "email"]
    typed = read_source(spark, path, schema=day1(spark).schema)
    assert rows(typed) == rows(day1(spark))
    pruned = plan_of(read_source(spark, path, ["customer_id", "email"]).where("customer_id = 3"))
    assert "ReadSchema: struct<customer_id:int,email:string>" in pruned
    assert "EqualTo(customer_id,3)" in pruned


def test_jdbc_options():
    plain = JdbcSource("jdbc:x:y", "(SELECT * FROM t) a", {"user": "u"})
    assert plain.options() == {"user": "u", "url": "jdbc:x:y", "dbtable": "(SELECT * FROM t) a", "fetchsize": "10000"}
    split = JdbcSource("jdbc:x:y", "t", column="id", lower=0, upper=1000, partitions=8)
    assert {k: split.options()[k] for k in ("partitionColumn", "lowerBound", "upperBound", "numPartitions")} == {
        "partitionColumn": "id", "lowerBound": "0", "upperBound": "1000", "numPartitions": "8",
    }
    with pytest.raises(ValueError):
        JdbcSource("jdbc:x:y", "t", column="id").options()
    assert jdbc_write_options("jdbc:x:y", "t", {"user": "u"}, 4) == {
        "batchsize": "10000", "user": "u", "url": "jdbc:x:y", "dbtable": "t", "truncate": "true", "numPartitions": "4",
    }


def test_scratch_is_in_the_folder_the_session_names(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark).startswith(base)
    stored = materialise(day1(spark))
    assert rows(stored) == rows(day1(spark))
    assert all(base in f for f in stored.inputFiles())


def test_jobs_start_from_and_return_to_empty_snapshots(spark, database):
    nothing = day1(spark).where("false")
    for day, snapshot in ((DAY1, nothing), (DAY2, day1(spark)), (DAY3, nothing)):
        run_scd1(spark, snapshot, f"{database}.s1", KEYS, day, on_delete="drop")
        run_scd2(spark, snapshot, f"{database}.s2", KEYS, day)
        run_scd3(spark, snapshot, f"{database}.s3", KEYS, PREVIOUS, day, on_delete="drop")
        run_scd4(spark, snapshot, f"{database}.s4", f"{database}.s4_his", KEYS, day, on_delete="drop")
        load_curated(spark, conform(snapshot, customer_columns(), day), f"{database}.cur", KEYS, day)
    for name, n in (("s1", 0), ("s3", 0), ("s4", 0), ("s4_his", 10)):
        assert spark.table(f"{database}.{name}").count() == n
    assert {(r["start_date"], r["end_date"]) for r in spark.table(f"{database}.s2").collect()} == {(DAY2, DAY3)}
    assert {r["is_active"] for r in spark.table(f"{database}.cur").collect()} == {"0"}


def test_jdbc_splits_are_checked():
    split = {"predicates": ["k < 5", "k >= 5 OR k IS NULL"]}
    source = JdbcSource("jdbc:x:y", "t", {"user": "u"}, **split)
    assert source.connection() == {"fetchsize": "10000", "user": "u"}
    with pytest.raises(ValueError, match="not by both"):
        JdbcSource("jdbc:x:y", "t", column="k", lower=0, upper=9, partitions=2, **split)
    with pytest.raises(ValueError, match="IS NULL"):
        JdbcSource("jdbc:x:y", "t", predicates=["k < 5", "k >= 5"])


def test_scratch_folders_are_released(spark):
    folder = materialise(day1(spark)).inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
    assert os.path.isdir(folder)
    release(spark)
    assert not os.path.isdir(folder)


def test_every_key_is_in_the_daily_snapshots(spark):
    sf_dir = "/root/testdata/sf0.01"
    for days, keys, table in ((customer_days, CUSTOMER_KEYS, "customer"), (orders_days, ORDER_KEYS, "orders")):
        seen = reduce(lambda a, b: a.union(b), [s.select(*keys) for _, s in days(spark, sf_dir)]).distinct()
        assert seen.count() == spark.read.parquet(f"{sf_dir}/{table}.parquet").count()


def test_layers_with_cleaning_parts_kinds_and_marts(spark, tmp_path):
    layers = Layers("m_stg", "m_prc", "m_cur", "m_dmt", str(tmp_path))
    columns = {"id": F.col("id"), "name": F.col("name")}
    published = []

    def run(day, shops, people):
        parts = {n: spark.createDataFrame(r, "id int, name string") for n, r in (("shop", shops), ("person", people))}
        return run_layers(
            spark, parts, day, layers, ["id"], {"shop": columns, "person": columns}, "party",
            cleaning=[lambda df: dedup_latest(clean_nulls(df, {"name": "?"}), ["id"], ["name"])],
            kind="scd2", marts={"names": lambda df: df.groupBy("name").count()}, publish=lambda df: published.append(df.count()),
        )

    run(DAY1, [(1, "a"), (1, "b"), (2, None)], [(10, "p")])
    mart = run(DAY2, [(1, "b")], [(10, "q"), (10, "p")])
    got = sorted((r["id"], r["name"], r["start_date"], r["end_date"]) for r in mart.collect())
    assert got == [(1, "b", DAY1, OPEN_END), (2, "?", DAY1, DAY2), (10, "p", DAY1, DAY2), (10, "q", DAY2, OPEN_END)]
    assert {tuple(r) for r in spark.table("m_dmt.names").collect()} == {("b", 1), ("?", 1), ("p", 1), ("q", 1)}
    assert published == [3, 4]
    for name in ("m_stg", "m_prc", "m_cur", "m_dmt"):
        spark.sql(f"DROP DATABASE {name} CASCADE")
