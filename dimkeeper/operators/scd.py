"""Slowly changing dimensions, types 1 to 4.

Each function takes the stored dimension and today's full snapshot of the entity and returns
the dimension's next state. Applying the same snapshot again for the same date changes nothing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from dimkeeper.functions import (
    OPEN_END,
    align_to,
    counted_keys,
    date_literal,
    key_violations,
    quoted,
    require_columns,
    require_free,
    tracked_columns,
    without_null_keys,
)
from dimkeeper.operators.diff import Match, match_snapshots


def _check_on_delete(on_delete: str) -> None:
    if on_delete not in ("keep", "drop"):
        raise ValueError(f"on_delete must be 'keep' or 'drop', not {on_delete!r}")


def scd1(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    run_date: dt.date,
    date_col: str = "etl_date",
    on_delete: str = "keep",
    check_keys: bool = True,
) -> DataFrame:
    """Type 1: values overwritten in place, every row stamped with the run date.

    Every source row is in the result whether it changed or not, so nothing is compared: the
    source passes through without a shuffle, and only its keys meet the target, in an anti-join
    that finds the keys the source no longer has. The source is read once in full and once for its
    keys; hand in a stored snapshot, not a live view.
    """
    _check_on_delete(on_delete)
    keys = list(keys)
    cols = tracked_columns(target, [date_col])
    require_columns(target, [*keys, date_col], "target")
    require_columns(source, cols, "source")
    stamp = f"{date_literal(run_date)} AS {quoted(date_col)}"

    incoming = source.selectExpr(*align_to(source, target, cols), stamp)
    live = counted_keys(incoming, keys)
    result = without_null_keys(incoming, keys, "source") if check_keys else incoming
    if on_delete == "keep":
        gone = target.join(live, keys, "left_anti")
        result = result.unionByName(gone.selectExpr(*[quoted(c) for c in cols], stamp))
    if check_keys:
        result = result.unionByName(key_violations(live, keys, "source", result))
    return result.select(*target.columns)


def scd2(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    run_date: dt.date,
    tracked: Sequence[str] | None = None,
    open_end: dt.date = OPEN_END,
    start_col: str = "start_date",
    end_col: str = "end_date",
    date_col: str | None = "etl_date",
    check_keys: bool = True,
) -> DataFrame:
    """Type 2: one row per version, valid for ``start <= day < end``.

    A changed or vanished key has its open version closed at the run date; a changed, new or
    returning key gets a version open until ``open_end``. Only open versions enter the join, so
    the cost does not grow with the history and a key with very many closed versions makes no
    partition hot. ``date_col`` (None where the table has none) tells which run last wrote a row.

    A day that is run again is done anew from the state before it: versions begun on the run date
    are dropped, and those closed on it count as open. So a corrected snapshot leaves no trace of
    the wrong one, and a value corrected back to the former one is one version.
    """
    keys = list(keys)
    technical = [start_col, end_col] + ([date_col] if date_col else [])
    if tracked is None:
        tracked = tracked_columns(target, [*keys, *technical])
    require_columns(target, [*keys, *tracked, *technical], "target")

    today, forever = date_literal(run_date), date_literal(open_end)
    start, end = quoted(start_col), quoted(end_col)
    is_open, ended_today = f"{end} <=> {forever}", f"{end} <=> {today}"
    late = f"raise_error('run date {run_date} lies before the start of an open version')"
    standing = (
        f"CASE WHEN {is_open} AND {start} > {today} THEN CAST({late} AS boolean) "
        f"WHEN {start} = {today} THEN false ELSE {is_open} OR {ended_today} END"
    )
    carry = [start_col, end_col] + ([date_col] if date_col else [])
    near = target.where(f"{end} IN ({forever}, {today})")  # a filter of its own, as a scan can use it
    m = match_snapshots(near.where(standing), source, keys, tracked, carry, check_keys, check_old=False)

    # One input row becomes one or two versions; the exploded arrays are constants.
    versions = m.rows.selectExpr(
        "*",
        f"""explode(CASE WHEN {m.both} AND {m.same} THEN array('kept')
                         WHEN {m.both} THEN array('ended', 'begun')
                         WHEN {m.in_old} THEN array('ended')
                         ELSE array('begun') END) AS scd__version""",
    )
    columns = [
        *m.columns_where("scd__version = 'begun'", [*keys, *m.tracked]),
        f"IF(scd__version = 'begun', {today}, {m.old(start_col)}) AS {start}",
        f"IF(scd__version = 'ended', {today}, {forever}) AS {end}",
    ]
    if date_col:
        # A version that is open again is as the run that began it left it.
        kept = f"IF({m.old(end_col)} <=> {today}, {m.old(start_col)}, {m.old(date_col)})"
        columns.append(f"IF(scd__version = 'kept', {kept}, {today}) AS {quoted(date_col)}")
    current = versions.selectExpr(*columns)
    closed = target.where(f"NOT ({is_open}) AND NOT ({ended_today})")
    return current.select(*target.columns).unionByName(closed)


def open_versions(dimension: DataFrame, open_end: dt.date = OPEN_END, end_col: str = "end_date") -> DataFrame:
    """The current rows of a type 2 dimension."""
    return dimension.where(f"{quoted(end_col)} = {date_literal(open_end)}")


def scd3(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    run_date: dt.date,
    previous: Mapping[str, str],
    date_col: str = "etl_date",
    on_delete: str = "keep",
    check_keys: bool = True,
) -> DataFrame:
    """Type 3: ``previous`` maps a column to the column that holds its value before the last change.

    Each mapped column shifts on its own, and a change to or from NULL counts. All other columns
    are overwritten; every row is stamped with the run date.
    """
    _check_on_delete(on_delete)
    keys = list(keys)
    cols = tracked_columns(target, [*keys, *previous.values(), date_col])
    require_columns(target, [*previous.keys(), *previous.values(), date_col], "target")
    m = match_snapshots(target, source, keys, cols, list(previous.values()), check_keys, check_old=False)

    def shifted(col: str, pre: str) -> str:
        moved = f"{m.both} AND NOT ({m.old(col)} <=> {m.new(col)})"
        return f"IF({moved}, {m.old(col)}, {m.old(pre)}) AS {quoted(pre)}"

    rows = m.rows if on_delete == "keep" else m.rows.where(m.in_new)
    return rows.selectExpr(
        *m.newest_columns(),
        *[shifted(col, pre) for col, pre in previous.items()],
        f"{date_literal(run_date)} AS {quoted(date_col)}",
    ).select(*target.columns)


def _scd4_match(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    run_date: dt.date,
    date_col: str,
    check_keys: bool,
    archived: DataFrame | None,
    start_col: str,
    end_col: str,
) -> Match:
    tracked = tracked_columns(target, [*keys, date_col])
    require_free([start_col, end_col], [*keys, *tracked, date_col], "type 4 history")
    today, date = date_literal(run_date), quoted(date_col)
    late = f"raise_error('run date {run_date} lies before the date of a current row')"
    again = "true" if archived is None else "false"
    target = target.where(f"CASE WHEN {date} > {today} THEN CAST({late} AS boolean) WHEN {date} = {today} THEN {again} ELSE true END")
    if archived is not None:
        back = archived.where(f"{quoted(end_col)} <=> {today}")
        values = [quoted(c) if c != date_col else f"{quoted(start_col)} AS {date}" for c in target.columns]
        target = target.unionByName(back.selectExpr(*values))
    return match_snapshots(target, source, keys, tracked, [date_col], check_keys, check_old=False)


def _scd4_stamp(m: Match, run_date: dt.date, date_col: str) -> str:
    """Run date for new and changed rows; rows that stay keep the date their version began."""
    return f"IF({m.only_old} OR ({m.both} AND {m.same}), {m.old(date_col)}, {date_literal(run_date)})"


def _superseded(m: Match, run_date: dt.date, date_col: str, on_delete: str) -> str:
    """Rows that leave the current table: changed ones and, with 'drop', deleted ones.

    A row that began on this very date was valid for no day and is not one of them.
    """
    leaves = f"({m.both} AND NOT {m.same})"
    if on_delete == "drop":
        leaves = f"({leaves} OR {m.only_old})"
    return f"({leaves} AND NOT ({m.old(date_col)} <=> {date_literal(run_date)}))"


def scd4(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    run_date: dt.date,
    date_col: str = "etl_date",
    on_delete: str = "keep",
    check_keys: bool = True,
    archived: DataFrame | None = None,
    start_col: str = "start_date",
    end_col: str = "end_date",
) -> tuple[DataFrame, DataFrame]:
    """Type 4: the current rows, and the superseded rows for the history table.

    History rows carry ``start_col`` (when the version began) and ``end_col`` (the run date).
    Deleted keys stay current, or with ``on_delete='drop'`` go to the history. The two frames share
    one plan; to write both from one evaluation use ``scd4_parts``.

    With ``archived``, the history (or its part of the run date), a day that is run again is done
    anew from the state before it, and the second frame *replaces* the history's rows of that date.
    Without, it is appended, and rows that began on the run date are not archived.
    """
    _check_on_delete(on_delete)
    m = _scd4_match(target, source, keys, run_date, date_col, check_keys, archived, start_col, end_col)
    rows = m.rows if on_delete == "keep" else m.rows.where(m.in_new)
    current = rows.selectExpr(
        *m.newest_columns(), f"{_scd4_stamp(m, run_date, date_col)} AS {quoted(date_col)}"
    ).select(*target.columns)
    archive = m.rows.where(_superseded(m, run_date, date_col, on_delete)).selectExpr(
        *m.old_columns([*m.keys, *m.tracked]),
        f"{m.old(date_col)} AS {quoted(start_col)}",
        f"{date_literal(run_date)} AS {quoted(end_col)}",
    )
    return current, archive


def scd4_parts(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    run_date: dt.date,
    date_col: str = "etl_date",
    on_delete: str = "keep",
    check_keys: bool = True,
    archived: DataFrame | None = None,
    start_col: str = "start_date",
    end_col: str = "end_date",
) -> DataFrame:
    """Both results of ``scd4`` in one frame, told apart by ``scd__part`` ('current' or 'archive').

    Current rows have NULL ``start_col`` and ``end_col``, archive rows a NULL ``date_col``.
    """
    _check_on_delete(on_delete)
    m = _scd4_match(target, source, keys, run_date, date_col, check_keys, archived, start_col, end_col)
    superseded = _superseded(m, run_date, date_col, on_delete)
    stays = "true" if on_delete == "keep" else m.in_new
    rows = m.rows.where(f"{stays} OR {superseded}").selectExpr(
        "*",
        f"""explode(CASE WHEN NOT {stays} THEN array('archive')
                         WHEN {superseded} THEN array('current', 'archive')
                         ELSE array('current') END) AS scd__part""",
    )
    return rows.selectExpr(
        *m.columns_where(f"{m.in_new} AND scd__part = 'current'", [*m.keys, *m.tracked]),
        f"IF(scd__part = 'current', {_scd4_stamp(m, run_date, date_col)}, NULL) AS {quoted(date_col)}",
        f"IF(scd__part = 'archive', {m.old(date_col)}, NULL) AS {quoted(start_col)}",
        f"IF(scd__part = 'archive', {date_literal(run_date)}, NULL) AS {quoted(end_col)}",
        "scd__part",
    )
