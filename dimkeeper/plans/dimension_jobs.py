"""Dimension jobs: read the stored dimension, apply today's snapshot, put the result in place.

Every job may be repeated for the same date, and first completes a run that broke off between
staging its result and putting it in place. Jobs raise on failure and never stop the session.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimkeeper.functions import OPEN_END, parse_run_date
from dimkeeper.operators.backfill import scd2_backdated
from dimkeeper.operators.feed import apply_ordered
from dimkeeper.operators.scd import scd1, scd2, scd3, scd4_parts
from dimkeeper.sources.parts import merge_touched_parts
from dimkeeper.sources.scratch import materialised
from dimkeeper.sources.tables import (
    drop_table,
    ensure_table,
    find_staging,
    finish_replace,
    mark_staged,
    new_staging_name,
    overwrite_from,
    overwrite_partitions,
    staged_property,
    staged_replace,
)


def _with_dates(schema: T.StructType, *names: str) -> T.StructType:
    return T.StructType([*schema.fields, *[T.StructField(n, T.DateType()) for n in names]])


def _require_known(spark: SparkSession, source: DataFrame, table: str) -> None:
    """A column that the table lacks would be lost without a word."""
    have = {c.lower() for c in spark.table(table).columns}
    if more := [c for c in source.columns if c.lower() not in have]:
        raise ValueError(f"{table} lacks source column(s) {', '.join(more)}; add them to the table or leave them out")


def run_scd1(
    spark: SparkSession,
    source: DataFrame,
    table: str,
    keys: Sequence[str],
    run_date: dt.date | int | None = None,
    on_delete: str = "keep",
) -> None:
    """The source is stored first: it is read for its rows and for its keys, and a live one may change between."""
    day = parse_run_date(run_date)
    ensure_table(spark, table, _with_dates(source.schema, "etl_date"))
    finish_replace(spark, table)
    _require_known(spark, source, table)
    with materialised(source) as source:
        staged_replace(spark, scd1(spark.table(table), source, keys, day, on_delete=on_delete), table)


def run_scd2(
    spark: SparkSession,
    source: DataFrame,
    table: str,
    keys: Sequence[str],
    run_date: dt.date | int | None = None,
    open_end: dt.date = OPEN_END,
    buckets: int = 0,
) -> bool:
    """The table is partitioned by ``end_date``. Says whether its files were replaced.

    A run reads and replaces two partitions only, the open versions and those closed on the run
    date, so its cost follows the size of the current dimension and not that of the history. With
    ``buckets`` (at least the number of shuffle partitions) the stored side is never shuffled. A day
    without changes leaves all files as they are.
    """
    day = parse_run_date(run_date)
    ensure_table(
        spark,
        table,
        _with_dates(source.schema, "start_date", "etl_date", "end_date"),
        partition_by=["end_date"],
        bucket_by=list(keys) if buckets else [],
        buckets=buckets,
    )
    finish_replace(spark, table)
    _require_known(spark, source, table)
    stored = spark.table(table).where(F.col("end_date").isin(open_end, day))
    result = scd2(stored, source, keys, day, open_end=open_end)
    # Run before on this day: it closed versions, began some, or left its mark on open ones.
    again = not stored.where(F.lit(day).isin(F.col("end_date"), F.col("start_date"), F.col("etl_date"))).isEmpty()

    def changes(staged: DataFrame) -> bool:
        return again or not staged.where(F.col("etl_date") == F.lit(day)).isEmpty()

    return staged_replace(spark, result, table, "end_date", [open_end, day] if again else [open_end], clustered=True, only_if=changes)


def run_scd2_any_day(
    spark: SparkSession,
    source: DataFrame,
    table: str,
    keys: Sequence[str],
    run_date: dt.date | int | None = None,
    open_end: dt.date = OPEN_END,
    buckets: int = 0,
) -> bool:
    """Type 2 from snapshots that may come in any order, or again: the result is that of their order by date.

    The days whose snapshots the dimension has seen are kept in ``<table>__days``, as a day without changes leaves
    no trace in the dimension; so a table must be kept by this job from its first day. The latest day is applied
    as by ``run_scd2``. An earlier one is spliced in up to the next known day; only partitions that end
    on it or later are read and replaced. Says whether the table's files were replaced.
    """
    day = parse_run_date(run_date)
    days = f"{table}__days"
    ensure_table(spark, days, T.StructType([T.StructField("day", T.DateType())]))
    seen = sorted(r["day"] for r in spark.table(days).distinct().collect())  # one row for each snapshot
    later = [d for d in seen if d > day]
    if day not in seen:
        # Before the dimension: a run that breaks off in between is repeated, and finds its day known already.
        spark.createDataFrame([(day,)], "day date").write.insertInto(days)
    if not later:
        return run_scd2(spark, source, table, keys, day, open_end, buckets)
    finish_replace(spark, table)
    _require_known(spark, source, table)
    stored = spark.table(table).where(F.col("end_date") >= F.lit(day))
    ends = {r["end_date"] for r in stored.select("end_date").distinct().collect()}
    with materialised(source) as snapshot:
        result = scd2_backdated(stored, snapshot, keys, day, later[0], open_end)
        return staged_replace(spark, result, table, "end_date", sorted({*ends, day, later[0]}))


def run_feed(spark: SparkSession, feed: DataFrame, table: str, keys: Sequence[str], seq_col: str = "seq", op_col: str = "op") -> list[int]:
    """Apply an ordered change feed to a table in parts (see ``sources.parts``) that holds a feed's state.

    Batches may overlap, repeat and come in any order. Only the parts that the feed touches are read and
    rewritten; returns their numbers.
    """
    finish_replace(spark, table)
    known = {c.lower() for c in spark.table(table).columns}
    if more := [c for c in feed.columns if c.lower() not in {*known, seq_col.lower(), op_col.lower()}]:
        raise ValueError(f"{table} lacks feed column(s) {', '.join(more)}")
    return merge_touched_parts(spark, feed, table, keys, lambda state, changes, k: apply_ordered(state, changes, k, seq_col, op_col))


def run_scd3(
    spark: SparkSession,
    source: DataFrame,
    table: str,
    keys: Sequence[str],
    previous: Mapping[str, str],
    run_date: dt.date | int | None = None,
    on_delete: str = "keep",
) -> None:
    """A ``previous`` column stands right behind the column whose earlier value it holds."""
    day = parse_run_date(run_date)
    fields: list[T.StructField] = []
    for f in source.schema.fields:
        fields.append(f)
        if f.name in previous:
            fields.append(T.StructField(previous[f.name], f.dataType))
    ensure_table(spark, table, _with_dates(T.StructType(fields), "etl_date"))
    finish_replace(spark, table)
    _require_known(spark, source, table)
    result = scd3(spark.table(table), source, keys, day, previous, on_delete=on_delete)
    staged_replace(spark, result, table)


def run_scd4(
    spark: SparkSession,
    source: DataFrame,
    table: str,
    history: str,
    keys: Sequence[str],
    run_date: dt.date | int | None = None,
    on_delete: str = "keep",
) -> bool:
    """Current rows go to ``table``, superseded ones to the run date's partition of ``history``; says whether either changed.

    Both come from one evaluation, staged together. The history is partitioned by ``end_date``; a day
    that is run again reads its partition and replaces it. One without changes leaves all files as they are.
    """
    day = parse_run_date(run_date)
    ensure_table(spark, table, _with_dates(source.schema, "etl_date"))
    ensure_table(spark, history, _with_dates(source.schema, "start_date", "end_date"), partition_by=["end_date"])
    _land_scd4(spark, table, history)
    _require_known(spark, source, table)
    archived = spark.table(history).where(F.col("end_date") == F.lit(day))
    parts = scd4_parts(spark.table(table), source, keys, day, on_delete=on_delete, archived=archived)
    staging = new_staging_name(table)
    parts.write.partitionBy("scd__part").saveAsTable(staging)
    today = F.col("etl_date") == F.lit(day)
    new = spark.table(staging).where(today | (F.col("scd__part") == "archive"))
    if new.isEmpty() and archived.isEmpty() and spark.table(table).where(today).isEmpty():
        drop_table(spark, staging)
        return False
    mark_staged(spark, staging, table, day=day.isoformat())
    _land_scd4(spark, table, history)
    return True


def _land_scd4(spark: SparkSession, table: str, history: str) -> None:
    staging = find_staging(spark, table)
    if staging is None:
        return
    parts = spark.table(staging)
    day = dt.date.fromisoformat(staged_property(spark, staging, "day"))
    overwrite_partitions(spark, parts.where(F.col("scd__part") == "archive"), history, "end_date", [day])
    overwrite_from(spark, parts.where(F.col("scd__part") == "current"), table)
    drop_table(spark, staging)
