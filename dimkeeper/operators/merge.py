"""Keyed merge, with and without soft delete, and applying a change feed.

On tables that offer no row-level MERGE the next state is computed as a frame and put in place
by ``sources.tables.staged_replace``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame

from dimkeeper.functions import (
    align_to,
    counted_keys,
    date_literal,
    key_violations,
    quoted,
    require_columns,
    tracked_columns,
    without_null_keys,
)
from dimkeeper.operators.diff import Match, match_snapshots

# The activity flag.
ACTIVE = "1"
INACTIVE = "0"


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], check_keys: bool = True) -> DataFrame:
    """Rows of ``source`` replace the target rows of the same key; new keys are added.

    Whole rows are replaced, so the target only loses the source's keys (anti-join) and gains its
    rows (union). Where the source is a small change set, AQE turns the anti-join into a broadcast
    once it has seen the size, and the target is not shuffled.
    """
    keys = list(keys)
    require_columns(source, target.columns, "source")
    incoming = source.selectExpr(*align_to(source, target, target.columns))
    written = counted_keys(incoming, keys) if check_keys else incoming.select(*keys)
    kept = target.join(written, keys, "left_anti").select(*target.columns)
    result = kept.unionByName(without_null_keys(incoming, keys, "source") if check_keys else incoming)
    if check_keys:
        result = result.unionByName(key_violations(written, keys, "source", result))
    return result


def apply_changes(
    target: DataFrame, feed: DataFrame, keys: Sequence[str], op_col: str = "op", check_keys: bool = True
) -> DataFrame:
    """Apply a change feed (one row per key; op I, U or D) to a snapshot; any other op is an error."""
    keys = list(keys)
    require_columns(feed, [op_col, *target.columns], "change feed")
    incoming = feed.selectExpr(*align_to(feed, target, target.columns), quoted(op_col))
    named = counted_keys(incoming, keys) if check_keys else incoming.select(*keys)
    kept = target.join(named, keys, "left_anti").select(*target.columns)
    if check_keys:
        incoming = without_null_keys(incoming, keys, "change feed")
    op = quoted(op_col)
    unknown = f"raise_error(concat('change feed, unknown op: ', coalesce(CAST({op} AS string), 'NULL')))"
    written = f"CASE {op} WHEN 'D' THEN false WHEN 'I' THEN true WHEN 'U' THEN true ELSE CAST({unknown} AS boolean) END"
    result = kept.unionByName(incoming.where(written).select(*target.columns))
    if check_keys:
        result = result.unionByName(key_violations(named, keys, "change feed", result))
    return result


def _soft_delete_match(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    active_col: str,
    date_col: str,
    check_keys: bool,
) -> tuple[Match, str, str]:
    """The match, and which of its rows become active anew or inactive."""
    tracked = tracked_columns(target, [*keys, active_col, date_col])
    m = match_snapshots(target, source, keys, tracked, [active_col, date_col], check_keys, check_old=False)
    was_active = f"({m.old(active_col)} <=> '{ACTIVE}')"
    written = f"({m.in_new} AND ({m.only_new} OR NOT {was_active} OR NOT {m.same}))"
    retired = f"({m.only_old} AND {was_active})"
    return m, written, retired


def soft_delete_changes(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    run_date: dt.date,
    active_col: str = "is_active",
    date_col: str = "etl_date",
    check_keys: bool = True,
) -> DataFrame:
    """The rows a soft-delete merge has to write, in the target's columns.

    New, changed and returning keys come as active; active keys that the source lacks come as
    inactive with their last values. Keys that are inactive already are not touched again.
    """
    m, written, retired = _soft_delete_match(target, source, keys, active_col, date_col, check_keys)
    changes = m.rows.where(f"{written} OR {retired}").selectExpr(
        *m.newest_columns(),
        f"IF({m.in_new}, '{ACTIVE}', '{INACTIVE}') AS {quoted(active_col)}",
        f"{date_literal(run_date)} AS {quoted(date_col)}",
    )
    return changes.select(*target.columns)


def merge_soft_delete(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    run_date: dt.date,
    active_col: str = "is_active",
    date_col: str = "etl_date",
    check_keys: bool = True,
) -> DataFrame:
    """The target after applying ``soft_delete_changes``, in one join."""
    m, written, retired = _soft_delete_match(target, source, keys, active_col, date_col, check_keys)
    flag = f"CASE WHEN {m.in_new} THEN '{ACTIVE}' WHEN {retired} THEN '{INACTIVE}' ELSE {m.old(active_col)} END"
    merged = m.rows.selectExpr(
        *m.newest_columns(),
        f"{flag} AS {quoted(active_col)}",
        f"IF({written} OR {retired}, {date_literal(run_date)}, {m.old(date_col)}) AS {quoted(date_col)}",
    )
    return merged.select(*target.columns)
