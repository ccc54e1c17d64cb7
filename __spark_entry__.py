"""

Each query takes ``(spark, sf_dir)``, reads the whole tables it needs below ``sf_dir`` and returns
a DataFrame. Queries that write use new databases below the session's shared scratch folder.
"""

from __future__ import annotations

import importlib
import importlib.util
import os
import sys
import uuid
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from dimkeeper.functions import email_org  # noqa: E402
from dimkeeper.operators.asof import facts_as_of  # noqa: E402
from dimkeeper.operators.backfill import scd2_backdated, scd2_backfill  # noqa: E402
from dimkeeper.operators.clean import clean_nulls, dedup_latest, normalise_types, union_parts  # noqa: E402
from dimkeeper.operators.deltas import aggregate, apply_deltas, change_images, delta_sums  # noqa: E402
from dimkeeper.operators.diff import (  # noqa: E402
    attribute_changes,
    changed_rows,
    deleted_rows,
    diff_counts,
    new_keys,
    snapshot_diff,
    unchanged_rows,
    upsert_rows,
)
from dimkeeper.operators.feed import apply_ordered, feed_state, live_rows  # noqa: E402
from dimkeeper.operators.merge import apply_changes, merge_soft_delete, merge_upsert, soft_delete_changes  # noqa: E402
from dimkeeper.operators.scd import open_versions, scd1, scd2, scd3, scd4_parts  # noqa: E402
from dimkeeper.operators.sketches import daily_sketches, distinct_estimate, error_bound  # noqa: E402
from dimkeeper.plans.daily_snapshots import (  # noqa: E402
    CUSTOMER_KEYS,
    D1,
    D2,
    D3,
    ORDER_KEYS,
    customer_base,
    customer_days,
    orders_days,
    table,
)
from dimkeeper.plans.dimension_jobs import run_feed, run_scd1, run_scd2, run_scd2_any_day, run_scd3, run_scd4  # noqa: E402
from dimkeeper.plans.fingerprints import diff_by_fingerprint, save_with_fingerprints  # noqa: E402
from dimkeeper.plans.layers import (  # noqa: E402
    Layers,
    Mart,
    active_rows,
    conform,
    customer_columns,
    load_checked,
    load_curated,
    load_mart,
    load_staging,
    run_layers,
    stamp_source,
)
from dimkeeper.plans.ledger import Ledger  # noqa: E402
from dimkeeper.plans.marts import add_metrics, sales_as_of, sales_by_attributes  # noqa: E402
from dimkeeper.sources.parts import ensure_parted_table, fill_parts, merge_touched_parts, stored_rows  # noqa: E402
from dimkeeper.sources.read import read_source  # noqa: E402
from dimkeeper.sources.scratch import materialise, scratch_dir  # noqa: E402
from dimkeeper.sources.splits import plan_splits, read_branches  # noqa: E402
from dimkeeper.sources.tables import ensure_database, ensure_table, save_table, staged_replace  # noqa: E402
from oracle_queries import ORACLE_SQL  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]

PREVIOUS = {"hometown": "pre_hometown", "phone_number": "pre_phone_number"}
ORDER_PREVIOUS = {"o_orderstatus": "pre_orderstatus", "o_orderpriority": "pre_orderpriority"}


def _empty(like: DataFrame, *dates: str, text: tuple[str, ...] = ()) -> DataFrame:
    """An empty dimension: the columns of ``like`` and the given technical ones."""
    technical = [f"CAST(NULL AS string) AS {c}" for c in text] + [f"CAST(NULL AS date) AS {c}" for c in dates]
    return like.selectExpr("*", *technical).where("false")


def _new_database(spark: SparkSession) -> str:
    name = f"dk_{uuid.uuid4().hex[:12]}"
    ensure_database(spark, name, f"{scratch_dir(spark)}/{name}")
    return name


# --- comparing two snapshots ------------------------------------------------------------------


def _days_1_2(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    (_, first), (_, second), _ = customer_days(spark, sf_dir)
    return first, second


def _day_3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_days(spark, sf_dir)[-1][1]


def q_source_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_source(spark, f"{sf_dir}/customer.parquet", ["c_custkey", "c_name", "c_mktsegment"])


def q_attribute_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attribute_changes(*_days_1_2(spark, sf_dir), CUSTOMER_KEYS)


def q_changed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _days_1_2(spark, sf_dir)
    return changed_rows(stamp_source(old, D1), new, CUSTOMER_KEYS, carry=["etl_date"])


def q_snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot_diff(*_days_1_2(spark, sf_dir), CUSTOMER_KEYS)


def q_diff_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diff_counts(*_days_1_2(spark, sf_dir), CUSTOMER_KEYS)


def q_upsert_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert_rows(*_days_1_2(spark, sf_dir), CUSTOMER_KEYS)


def q_unchanged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unchanged_rows(*_days_1_2(spark, sf_dir), CUSTOMER_KEYS)


def q_new_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return new_keys(*_days_1_2(spark, sf_dir), CUSTOMER_KEYS)


def q_deleted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deleted_rows(*_days_1_2(spark, sf_dir), CUSTOMER_KEYS)


# --- slowly changing dimensions, state after the three days ---------------------------------------


def q_scd1(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = customer_days(spark, sf_dir)
    state = _empty(days[0][1], "etl_date")
    for n, (day, snapshot) in enumerate(days):
        state = scd1(materialise(state) if n else state, snapshot, CUSTOMER_KEYS, day)
    return state


def _scd2_after(days: list, keys: list[str]) -> DataFrame:
    """Apply the days in turn. Each state is read twice by the next day (open and closed versions),
    so it is stored in between, as a dimension table would be."""
    state = _empty(days[0][1], "start_date", "end_date", "etl_date")
    for n, (day, snapshot) in enumerate(days):
        state = scd2(materialise(state) if n > 1 else state, snapshot, keys, day)
    return state


def q_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scd2_after(customer_days(spark, sf_dir), CUSTOMER_KEYS)


def q_scd2_day2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scd2_after(customer_days(spark, sf_dir)[:2], CUSTOMER_KEYS)


def q_scd2_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return open_versions(q_scd2(spark, sf_dir))


def _with_previous(like: DataFrame, previous: dict[str, str]) -> DataFrame:
    cols: list[str] = []
    for c in like.columns:
        cols.append(c)
        if c in previous:
            cols.append(f"{c} AS {previous[c]}")
    return like.selectExpr(*cols)


def q_scd3(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = customer_days(spark, sf_dir)
    state = _empty(_with_previous(days[0][1], PREVIOUS), "etl_date")
    for day, snapshot in days:
        state = scd3(state, snapshot, CUSTOMER_KEYS, day, PREVIOUS)
    return state


def _scd4_after(days: list, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Apply the days in turn; each is stored with both its parts, so the next one starts from files."""
    state = _empty(days[0][1], "etl_date")
    columns = state.columns
    history = _empty(days[0][1], "start_date", "end_date")
    for day, snapshot in days:
        today = history.where(F.col("end_date") == F.lit(day))
        parts = materialise(scd4_parts(state, snapshot, keys, day, archived=today))
        state = parts.where("scd__part = 'current'").select(*columns)
        archive = parts.where("scd__part = 'archive'").select(*history.columns)
        history = history.where(F.col("end_date") != F.lit(day)).unionByName(archive)
    return state, history


def q_scd4_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scd4_after(customer_days(spark, sf_dir), CUSTOMER_KEYS)[0]


def q_scd4_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scd4_after(customer_days(spark, sf_dir), CUSTOMER_KEYS)[1]


def q_top_dim_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q_scd1(spark, sf_dir).orderBy(F.col("customer_id").asc()).limit(10)


def q_latest_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = q_scd4_history(spark, sf_dir)
    return history.orderBy(F.col("start_date").desc(), F.col("customer_id").asc()).limit(5)


# --- the same dimensions kept in tables by the jobs -------------------------------------------------


def q_scd1_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{_new_database(spark)}.customer_dim_scd1"
    for day, snapshot in customer_days(spark, sf_dir):
        run_scd1(spark, snapshot, name, CUSTOMER_KEYS, day)
    return spark.table(name)


def q_scd2_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{_new_database(spark)}.customer_dim_scd2"
    for day, snapshot in customer_days(spark, sf_dir):
        run_scd2(spark, snapshot, name, CUSTOMER_KEYS, day)
    return spark.table(name)


def q_scd3_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{_new_database(spark)}.customer_dim_scd3"
    for day, snapshot in customer_days(spark, sf_dir):
        run_scd3(spark, snapshot, name, CUSTOMER_KEYS, PREVIOUS, day)
    return spark.table(name)


def _scd4_tables(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    db = _new_database(spark)
    current, history = f"{db}.customer_dim_scd4", f"{db}.customer_dim_his_scd4"
    for day, snapshot in customer_days(spark, sf_dir):
        run_scd4(spark, snapshot, current, history, CUSTOMER_KEYS, day)
    return current, history


def q_scd4_job_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(_scd4_tables(spark, sf_dir)[0])


def q_scd4_job_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(_scd4_tables(spark, sf_dir)[1])


# --- merge and change feed --------------------------------------------------------------------------


def q_merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_upsert(*_days_1_2(spark, sf_dir), CUSTOMER_KEYS)


def _soft_delete_after(days: list, keys: list[str]) -> DataFrame:
    state = _empty(days[0][1], "etl_date", text=("is_active",))
    for day, snapshot in days:
        state = merge_soft_delete(state, snapshot, keys, day)
    return state


def q_merge_soft_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _soft_delete_after(customer_days(spark, sf_dir), CUSTOMER_KEYS)


def q_merge_noop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows a merge has to write, and how many when it is applied once more."""
    days = customer_days(spark, sf_dir)[:2]
    before = materialise(_soft_delete_after(days[:1], CUSTOMER_KEYS))
    first = soft_delete_changes(before, days[1][1], CUSTOMER_KEYS, D2)
    again = soft_delete_changes(materialise(_soft_delete_after(days, CUSTOMER_KEYS)), days[1][1], CUSTOMER_KEYS, D2)
    count = F.count(F.lit(1))
    return first.agg(count.alias("n_first")).crossJoin(again.agg(count.alias("n")))


def q_staged_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _days_1_2(spark, sf_dir)
    name = f"{_new_database(spark)}.customer"
    save_table(spark, first, name)
    staged_replace(spark, merge_upsert(spark.table(name), second, CUSTOMER_KEYS), name)
    return spark.table(name)


def q_staged_replace_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by priority; day 2 brings NULL priorities, and leaves out those of one priority."""
    (_, first), (_, second) = orders_days(spark, sf_dir)
    name = f"{_new_database(spark)}.orders"
    ensure_table(spark, name, first.schema, partition_by=["o_orderpriority"])
    save_table(spark, first, name)
    staged_replace(spark, second.where("NOT (o_orderpriority <=> '1-URGENT')"), name, "o_orderpriority")
    return spark.table(name)


def _feeds(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    days = customer_days(spark, sf_dir)
    return [
        snapshot_diff(old, new, CUSTOMER_KEYS).withColumn("change_date", F.lit(day))
        for (_, old), (day, new) in zip(days, days[1:])
    ]


def q_cdc_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_parts(_feeds(spark, sf_dir))


def q_cdc_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day 1 plus the stored change feed of the two following days gives day 3."""
    feed = materialise(q_cdc_feed(spark, sf_dir))
    state, _ = _days_1_2(spark, sf_dir)
    for day in (D2, D3):
        state = apply_changes(state, feed.where(F.col("change_date") == F.lit(day)), CUSTOMER_KEYS)
    return state


# --- layered load -------------------------------------------------------------------------------------


def q_stg_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{_new_database(spark)}.customer"
    for day, snapshot in customer_days(spark, sf_dir):
        load_staging(spark, snapshot, name, day)
    return spark.table(name)


def q_prc_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(stamp_source(_day_3(spark, sf_dir), D3), customer_columns(), D3)


def _curated(spark: SparkSession, sf_dir: str) -> str:
    name = f"{_new_database(spark)}.customer"
    for day, snapshot in customer_days(spark, sf_dir):
        load_curated(spark, conform(snapshot, customer_columns(), day), name, CUSTOMER_KEYS, day)
    return name


def q_cur_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(_curated(spark, sf_dir))


def q_dmt_customer_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    curated = _curated(spark, sf_dir)
    mart = f"{_new_database(spark)}.customer_dim"
    load_mart(spark, curated, mart)
    return spark.table(mart)


def q_layered_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    tag = uuid.uuid4().hex[:12]
    layers = Layers(f"stg_{tag}", f"prc_{tag}", f"cur_{tag}", f"dmt_{tag}", scratch_dir(spark))
    for day, snapshot in customer_days(spark, sf_dir):
        mart = run_layers(spark, snapshot, day, layers)
    return mart


def q_layered_run_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and suppliers as one dimension, from staging rows with repeats and malformed values, and
    the sales fact as a mart table; parties and sales by hometown after two days."""
    tag = uuid.uuid4().hex[:12]
    layers = Layers(f"stg_{tag}", f"prc_{tag}", f"cur_{tag}", f"dmt_{tag}", scratch_dir(spark))
    sales = table(spark, sf_dir, "orders").selectExpr("o_custkey AS party_id", "CAST(o_totalprice AS decimal(18, 2)) AS amount")
    suppliers = table(spark, sf_dir, "supplier").selectExpr(
        "-1 - s_suppkey AS customer_id", "s_name AS full_name", "concat('N', s_nationkey) AS hometown", "'1' AS version"
    )

    def delivered(snapshot: DataFrame) -> DataFrame:
        now = snapshot.selectExpr("customer_id", "full_name", "concat('  ', hometown, ' ') AS hometown", "' 12' AS version")
        old, bad = (
            snapshot.selectExpr("customer_id", "full_name", f"'{town}' AS hometown", f"'{version}' AS version")
            for town, version in (("OLD", "9"), ("BAD", "1o"))
        )
        return union_parts([bad, now, old])

    columns = {"party_id": F.col("customer_id"), "name": F.col("full_name"), "hometown": F.col("hometown")}
    for day, snapshot in customer_days(spark, sf_dir)[:2]:
        mart = run_layers(
            spark,
            {"customer": delivered(snapshot), "supplier": suppliers},
            day,
            layers,
            ["party_id"],
            {"customer": columns, "supplier": columns},
            "party",
            cleaning=[
                lambda df: normalise_types(df, {"hometown": "string", "version": "int"}),
                lambda df: dedup_latest(df, ["customer_id"], ["version"]),
                lambda df: clean_nulls(df, {"hometown": "unknown"}),
            ],
            marts={
                "sales": lambda df: sales_by_attributes(
                    sales, active_rows(df), "party_id", {}, ["hometown"], {"n_orders": F.lit(1), "total": F.col("amount")}
                )
            },
        )
    parties = mart.groupBy("hometown").agg(F.count(F.lit(1)).alias("n_parties"))
    both = parties.join(spark.table(f"{layers.dmt}.sales"), "hometown", "full_outer")
    return both.select("hometown", "n_parties", "n_orders", F.col("total").cast("double").alias("total"))


def q_email_org(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_base(spark, sf_dir).select("customer_id", "email", email_org("email").alias("customer_source"))


# --- cleaning, union of parts, metrics -----------------------------------------------------------------


def q_clean_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_nulls(customer_base(spark, sf_dir), {"hometown": "UNKNOWN", "email": "none"})


def q_dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    copies = union_parts([stamp_source(snapshot, day) for day, snapshot in customer_days(spark, sf_dir)])
    return dedup_latest(copies, CUSTOMER_KEYS, ["etl_date"])


def q_dedup_latest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_latest(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"])


def _raw_customers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict]:
    """Customers as raw text, padded and partly malformed, and the types they should have."""
    text = table(spark, sf_dir, "customer").selectExpr(
        "concat(' ', c_custkey, '  ') AS customer_id",
        "concat(c_name, ' ') AS full_name",
        """IF(c_nationkey = 0, 'unknown',
              date_format(date_add(DATE'1970-01-01', CAST(c_custkey % 10000 AS int)), 'yyyyMMdd')) AS date_of_birth""",
        "IF(c_acctbal < 0, 'n/a', concat(' ', CAST(c_acctbal AS decimal(12, 2)))) AS balance",
    )
    types = {
        "customer_id": "bigint",
        "full_name": "string",
        "date_of_birth": ("date", "yyyyMMdd"),
        "balance": "double",
    }
    return text, types


def q_normalise_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as raw text turned into typed columns."""
    return normalise_types(*_raw_customers(spark, sf_dir))


def q_union_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two entities processed apart, brought together, then kept as one dimension."""
    customers = table(spark, sf_dir, "customer").selectExpr(
        "concat('C', c_custkey) AS party_id",
        "c_name AS party_name",
        "c_nationkey AS nation_id",
        "c_mktsegment AS segment",
    )
    suppliers = table(spark, sf_dir, "supplier").selectExpr(
        "concat('S', s_suppkey) AS party_id", "s_name AS party_name", "s_nationkey AS nation_id"
    )
    state = scd1(_empty(customers, "etl_date"), customers, ["party_id"], D1)
    return scd1(state, union_parts([customers, suppliers]), ["party_id"], D2)


def _orders_with_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the exact (decimal) revenue of their lines."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS o_orderkey",
        "CAST(l_extendedprice AS decimal(18, 2)) * (1 - CAST(l_discount AS decimal(4, 2))) AS amount",
    )
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_custkey AS customer_id", "CAST(o_orderdate AS date) AS order_date"
    )
    return add_metrics(orders, lines, ["o_orderkey"], {"revenue": F.sum("amount")}, zero=["revenue"])


def q_cur_customer_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = conform(_day_3(spark, sf_dir), customer_columns(), D3)
    metrics = {
        "n_orders": F.count(F.lit(1)),
        "revenue": F.sum("revenue").cast("double"),
        "last_order_date": F.max("order_date"),
    }
    dimension = customers.select("customer_id", "customer_name", "customer_source")
    return add_metrics(
        dimension, _orders_with_revenue(spark, sf_dir), CUSTOMER_KEYS, metrics, zero=["n_orders", "revenue"]
    )


def q_dmt_sales_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = _soft_delete_after(customer_days(spark, sf_dir), CUSTOMER_KEYS)
    dimension = active_rows(state).select("customer_id", email_org("email").alias("customer_source"), "gender")
    fact = sales_by_attributes(
        _orders_with_revenue(spark, sf_dir),
        dimension,
        "customer_id",
        {"order_month": F.trunc("order_date", "month")},
        ["customer_source", "gender"],
        {"n_orders": F.lit(1), "revenue": F.col("revenue")},
    )
    return fact.withColumn("revenue", F.col("revenue").cast("double"))


# --- the same operators on the larger orders table -------------------------------------------------------


def q_orders_snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    (_, first), (_, second) = orders_days(spark, sf_dir)
    return snapshot_diff(first, second, ORDER_KEYS)


def q_orders_scd1(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = orders_days(spark, sf_dir)
    state = _empty(days[0][1], "etl_date")
    for day, snapshot in days:
        state = scd1(state, snapshot, ORDER_KEYS, day)
    return state


def q_orders_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scd2_after(orders_days(spark, sf_dir), ORDER_KEYS)


def q_orders_scd3(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = orders_days(spark, sf_dir)
    state = _empty(_with_previous(days[0][1], ORDER_PREVIOUS), "etl_date")
    for day, snapshot in days:
        state = scd3(state, snapshot, ORDER_KEYS, day, ORDER_PREVIOUS)
    return state


def q_orders_scd4_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scd4_after(orders_days(spark, sf_dir), ORDER_KEYS)[0]


def q_orders_scd4_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scd4_after(orders_days(spark, sf_dir), ORDER_KEYS)[1]


def q_orders_merge_soft_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _soft_delete_after(orders_days(spark, sf_dir), ORDER_KEYS)


def _corrected_days(spark: SparkSession, sf_dir: str) -> list[tuple]:
    """Day 2 comes twice; the second time half of the keys have day 1's rows again."""
    (day1, first), (day2, second) = orders_days(spark, sf_dir)
    corrected = first.where("o_orderkey % 2 = 0").unionByName(second.where("o_orderkey % 2 <> 0"))
    return [(day1, first), (day2, second), (day2, corrected)]


def q_scd2_corrected_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scd2_after(_corrected_days(spark, sf_dir), ORDER_KEYS)


def q_scd4_corrected_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scd4_after(_corrected_days(spark, sf_dir), ORDER_KEYS)[1]


# --- tables in parts, dated facts, runs that are resumed -----------------------------------------------


def q_merge_touched_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of day 1 in 16 parts; the changes are the orders whose priority day 2 has taken back, and deleted ones."""
    (_, first), (_, second) = orders_days(spark, sf_dir)
    name = f"{_new_database(spark)}.orders"
    ensure_parted_table(spark, name, first.schema, ORDER_KEYS, 16)
    fill_parts(spark, first, name, ORDER_KEYS)
    feed = snapshot_diff(first, second, ORDER_KEYS).where("op = 'D' OR (op = 'U' AND o_orderpriority IS NULL)")
    merge_touched_parts(spark, feed, name, ORDER_KEYS, apply_changes)
    return stored_rows(spark, name)


def _dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order dated from two days before the first snapshot to one day after the last; some without customer or date."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "IF(o_orderkey % 97 = 0, NULL, o_custkey) AS customer_id",
        f"IF(o_orderkey % 89 = 0, NULL, date_add(DATE'{D1}', CAST(o_orderkey % 6 AS int) - 2)) AS sold_on",
    )


def q_fact_asof_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order with its customer's hometown and gender as of the order's date."""
    dimension = materialise(_scd2_after(customer_days(spark, sf_dir), CUSTOMER_KEYS))
    return facts_as_of(_dated_orders(spark, sf_dir), dimension, CUSTOMER_KEYS, "sold_on", ["hometown", "gender"])


def q_sales_asof_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by month and by the customer's hometown and gender as of the order's date."""
    dimension = materialise(_scd2_after(customer_days(spark, sf_dir), CUSTOMER_KEYS))
    facts = _dated_orders(spark, sf_dir).join(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey")
    sums = {"n_orders": F.lit(1), "total": F.col("o_totalprice").cast("decimal(18, 2)")}
    grain = {"month": F.trunc("sold_on", "month")}
    fact = sales_as_of(facts, dimension, "customer_id", F.col("sold_on"), grain, ["hometown", "gender"], sums)
    return fact.withColumn("total", F.col("total").cast("double"))


def q_layered_run_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day 2 breaks off in its second mart and is resumed; then the facts change and day 2 is run once more.

    The sales by hometown at the end, and how often each step was done.
    """
    tag = uuid.uuid4().hex[:12]
    layers = Layers(f"stg_{tag}", f"prc_{tag}", f"cur_{tag}", f"dmt_{tag}", scratch_dir(spark))
    layers.create(spark)
    ledger_table = f"{layers.cur}.run_ledger"
    (_, old_orders), (_, new_orders) = orders_days(spark, sf_dir)
    columns = {"customer_id": F.col("customer_id"), "hometown": F.col("hometown")}

    def run(day, snapshot: DataFrame, orders: DataFrame, fails: bool = False) -> None:
        sales = orders.selectExpr("o_custkey AS customer_id", "CAST(o_totalprice AS decimal(18, 2)) AS amount")

        def build(curated: DataFrame) -> DataFrame:
            if fails:
                raise RuntimeError("the mart step breaks off")
            sums = {"n_orders": F.lit(1), "total": F.col("amount")}
            return sales_by_attributes(sales, active_rows(curated), "customer_id", {}, ["hometown"], sums)

        marts = {"sales": Mart(build, {"sales": sales})}
        run_layers(spark, snapshot, day, layers, CUSTOMER_KEYS, columns, marts=marts, ledger=Ledger(spark, ledger_table, "1"))

    (day1, first), (day2, second), _ = customer_days(spark, sf_dir)
    run(day1, first, old_orders)
    try:
        run(day2, second, old_orders, fails=True)
    except RuntimeError:
        run(day2, second, old_orders)
    run(day2, second, new_orders)
    done = spark.table(ledger_table).where("state = 'done'").groupBy().pivot("step", ["stg.customer", "cur.customer", "dmt.customer_dim", "dmt.sales"])
    done = done.count().toDF("n_stg", "n_cur", "n_dim", "n_sales")
    sales = spark.table(f"{layers.dmt}.sales").withColumn("total", F.col("total").cast("double"))
    return sales.crossJoin(done)  # one row


def q_scd2_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three days' snapshots in one pass; the result is that of applying them one by one."""
    dated = union_parts([snapshot.withColumn("snapshot_date", F.lit(day)) for day, snapshot in customer_days(spark, sf_dir)])
    return scd2_backfill(dated, CUSTOMER_KEYS, "snapshot_date")


def q_scd2_late_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days 1 and 3 are applied, then day 2 comes late."""
    first, second, third = customer_days(spark, sf_dir)
    state = materialise(_scd2_after([first, third], CUSTOMER_KEYS))
    return scd2_backdated(state, second[1], CUSTOMER_KEYS, second[0], until=third[0])


def q_scd2_job_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day 2 is first run with a snapshot that only adds rows to day 1, then with day 1's own, then with its right one."""
    (day1, first), (day2, second), (day3, third) = customer_days(spark, sf_dir)
    name = f"{_new_database(spark)}.customer_dim_scd2"
    more = first.unionByName(second.join(first, CUSTOMER_KEYS, "left_anti"))
    for day, snapshot in [(day1, first), (day2, more), (day2, first), (day2, second), (day3, third)]:
        run_scd2(spark, snapshot, name, CUSTOMER_KEYS, day)
    return spark.table(name)


def q_scd2_job_late_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored dimension from days 3 and 1, then day 2 with a wrong snapshot, then with its own."""
    first, second, third = customer_days(spark, sf_dir)
    name = f"{_new_database(spark)}.customer_dim_scd2"
    for day, snapshot in [third, first, (second[0], first[1]), second]:
        run_scd2_any_day(spark, snapshot, name, CUSTOMER_KEYS, day)
    return spark.table(name)


def q_cdc_feed_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of day 1 in 16 parts, brought to day 2 by an ordered feed in two batches that overlap and come late."""
    (_, first), (_, second) = orders_days(spark, sf_dir)
    name = f"{_new_database(spark)}.orders"
    state = feed_state(first)
    ensure_parted_table(spark, name, state.schema, ORDER_KEYS, 16)
    fill_parts(spark, state, name, ORDER_KEYS)
    last = snapshot_diff(first, second, ORDER_KEYS).withColumn("seq", F.lit(2))
    passing = last.withColumn("o_orderstatus", F.lit("X")).withColumn("op", F.lit("U")).withColumn("seq", F.lit(1))
    feed = materialise(union_parts([passing, last]))
    for batch in (feed.where("seq = 2 OR o_orderstatus = 'X'"), feed.where("seq = 1")):
        run_feed(spark, batch, name, ORDER_KEYS)
    return live_rows(stored_rows(spark, name))


def q_cdc_apply_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changes of days 2 and 3 with sequence numbers: the later ones come first, the earlier ones late, some twice."""
    days = customer_days(spark, sf_dir)
    feed2, feed3 = (feed.withColumn("seq", F.lit(10 * n)).drop("change_date") for n, feed in enumerate(_feeds(spark, sf_dir), 1))
    state = feed_state(days[0][1])
    for batch in (feed3, union_parts([feed2, feed3]), feed2):
        state = materialise(apply_ordered(state, batch, CUSTOMER_KEYS))
    return live_rows(state)


def q_sales_fact_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by status and priority: day 1's aggregate, brought to day 2 by the changes alone."""
    (_, first), (_, second) = orders_days(spark, sf_dir)
    grain = {"status": F.col("o_orderstatus"), "priority": F.col("o_orderpriority")}
    sums = {"total": F.col("o_totalprice").cast("decimal(18, 2)")}
    stored = materialise(aggregate(first, grain, sums))
    deltas = delta_sums(change_images(first, second, ORDER_KEYS), grain, sums)
    fact = apply_deltas(stored, materialise(deltas), list(grain), list(sums))
    return fact.withColumn("total", F.col("total").cast("double"))


def q_diff_by_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of day 1 with their fingerprints against those of day 2."""
    (_, first), (_, second) = orders_days(spark, sf_dir)
    name = f"{_new_database(spark)}.orders"
    ensure_parted_table(spark, name, first.schema, ORDER_KEYS, 16)
    save_with_fingerprints(spark, first, name, ORDER_KEYS)
    return diff_by_fingerprint(spark, name, second, ORDER_KEYS)


def q_normalise_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each text that does not convert, with the numbers of accepted and rejected rows."""
    db = _new_database(spark)
    text, types = _raw_customers(spark, sf_dir)
    counts = load_checked(spark, text, f"{db}.customer", f"{db}.customer_rejects", types, D1)
    rejects = spark.table(f"{db}.customer_rejects").selectExpr("customer_id AS raw_id", "inline(rejects)")
    stored = spark.table(f"{db}.customer").agg(F.count(F.lit(1)).alias("n_stored"))
    numbers = [F.lit(counts[c]).cast("long").alias(f"n_{c}") for c in ("rows", "accepted", "rejected")]
    return rejects.select("raw_id", "column", "text", "reason", *numbers).crossJoin(stored)  # one row


def q_source_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines read by about eight branches of a skewed column that has NULLs: each line in how many branches."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        """CASE WHEN l_orderkey % 3 = 0 THEN 7 WHEN l_orderkey % 11 = 0 THEN NULL
                ELSE CAST(l_orderkey AS int) - 50 * CAST(l_linenumber AS int) END AS account""",
    )
    read = read_branches(lines, plan_splits(lines, "account", 8))
    return read.groupBy("l_orderkey", "l_linenumber", "account").agg(F.count(F.lit(1)).alias("n_branches"))


def q_metrics_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct users by kind of event over the later half of the days: exact, and whether the stored sketches come near."""
    events = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    stored = materialise(daily_sketches(events, {"day": F.col("day"), "event_type": F.col("event_type")}, F.col("user_id")))
    middle = events.agg(F.min("day").alias("first"), F.max("day").alias("last")).selectExpr("date_add(first, CAST(datediff(last, first) div 2 AS int)) AS middle")
    late = [df.join(middle, F.col("day") >= F.col("middle")) for df in (stored, events)]
    exact = late[1].groupBy("event_type").agg(F.countDistinct("user_id").alias("n_users"))
    near = F.abs(F.col("n_estimate") - F.col("n_users")) <= F.greatest(F.lit(1.0), error_bound() * F.col("n_users"))
    both = exact.join(distinct_estimate(late[0], ["event_type"], "n_estimate"), "event_type", "full_outer")
    return both.select("event_type", "n_users", near.alias("near"))


# --- contract -----------------------------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the four layers over three days; returns the mart's customer dimension."""
    return q_layered_run(spark, "/root/testdata/sf0.001")


def library_queries() -> dict[str, Query]:
    """The queries of this module; each has a statement in ``oracle_queries.py``."""
    return {name[2:]: fn for name, fn in globals().items() if name.startswith("q_")}


def _extras() -> list:
    """The modules with further queries, as far as they are part of this copy of the library."""
    there = importlib.util.find_spec
    names = ["dimkeeper.llm.queries"] if there("dimkeeper.llm") and there("dimkeeper.llm.queries") else []
    names += ["corpus_pipeline"] if names and there("corpus_pipeline") else []
    return [importlib.import_module(name) for name in names]


def queries() -> dict[str, Query]:
    return library_queries() | {name: fn for module in _extras() for name, fn in module.queries().items()}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL) | {name: sql for module in _extras() for name, sql in module.oracle_sql().items()}
