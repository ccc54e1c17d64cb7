"""Type 2 dimensions from many dated snapshots at once, and from snapshots that come late.

Both give what applying the same snapshots day by day, in order, would give: ``etl_date`` is the start
of an open version and the end of a closed one.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimkeeper.functions import (
    OPEN_END,
    align_to,
    date_literal,
    free_name,
    quoted,
    require_columns,
    require_comparable,
    require_free,
    tracked_columns,
    with_unique_keys,
    without_null_keys,
)


def _written(open_end: dt.date, start: str, end: str) -> str:
    return f"IF({end} = {date_literal(open_end)}, {start}, {end})"


def scd2_backfill(
    snapshots: DataFrame,
    keys: Sequence[str],
    day_col: str,
    days: DataFrame | Sequence[dt.date] | None = None,
    open_end: dt.date = OPEN_END,
    start_col: str = "start_date",
    end_col: str = "end_date",
    date_col: str | None = "etl_date",
) -> DataFrame:
    """The versions that a union of dated full snapshots amounts to: gaps and islands, one shuffle on the key.

    ``days`` are the dates of the snapshots, if some may be empty; by default those that occur. A key that
    a snapshot lacks is away from that day on; it and any change, also to or from NULL, end a version.
    A NULL or repeated key within a day, a NULL date or one that ``days`` lacks is an error.
    """
    keys = list(keys)
    tracked = tracked_columns(snapshots, [*keys, day_col])
    technical = [start_col, end_col] + ([date_col] if date_col else [])
    require_free(technical, [*keys, *tracked], "versions")
    require_comparable(snapshots, [*keys, *tracked])
    if days is None:
        days = snapshots.select(F.col(quoted(day_col)).alias("day"))
    elif not isinstance(days, DataFrame):
        days = snapshots.sparkSession.createDataFrame([(d,) for d in days], "day date")
    # One row for each day: the only window without a key.
    numbered = days.toDF("fill__day").where("fill__day IS NOT NULL").distinct().selectExpr(
        "fill__day",
        "row_number() OVER (ORDER BY fill__day) AS fill__no",
        f"lead(fill__day, 1, {date_literal(open_end)}) OVER (ORDER BY fill__day) AS fill__next",
    )
    rows = without_null_keys(snapshots, [*keys], "snapshots")
    dated = rows.join(numbered, F.col(quoted(day_col)).eqNullSafe(F.col("fill__day")), "left")
    unknown = "CAST(raise_error('snapshots: a date that is NULL or not among the days') AS int)"
    dated = dated.withColumn("fill__no", F.expr(f"coalesce(fill__no, {unknown})"))

    by_key = ", ".join(quoted(k) for k in keys)
    over = f"OVER (PARTITION BY {by_key} ORDER BY fill__no)"
    values = "struct(" + ", ".join(quoted(c) for c in tracked) + ")" if tracked else "true"
    repeated = "CAST(raise_error('snapshots: a key is repeated within a day') AS boolean)"
    flagged = dated.selectExpr("*", f"lag(fill__no) {over} AS fill__before", f"lag({values}) {over} AS fill__was")
    same = f"CASE WHEN fill__before = fill__no THEN {repeated} ELSE fill__before = fill__no - 1 AND fill__was <=> {values} END"
    islands = flagged.selectExpr("*", f"IF(coalesce({same}, false), 0, 1) AS fill__new").selectExpr("*", f"sum(fill__new) {over} AS fill__island")
    # Grouped by key and island the rows need no further shuffle: they lie together by key.
    versions = islands.groupBy(*keys, "fill__island").agg(
        *[F.first(F.col(quoted(c))).alias(c) for c in tracked],
        F.min("fill__day").alias(start_col),
        F.max("fill__next").alias(end_col),
    )
    columns = [quoted(c) for c in snapshots.columns if c != day_col] + [quoted(start_col), quoted(end_col)]
    if date_col:
        columns.append(f"{_written(open_end, quoted(start_col), quoted(end_col))} AS {quoted(date_col)}")
    return versions.selectExpr(*columns)


def scd2_backdated(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    run_date: dt.date,
    until: dt.date | None = None,
    open_end: dt.date = OPEN_END,
    start_col: str = "start_date",
    end_col: str = "end_date",
    date_col: str | None = "etl_date",
) -> DataFrame:
    """The dimension with the snapshot of an earlier day spliced in, which holds up to the day ``until``.

    ``until`` is the next day after ``run_date`` whose snapshot the dimension has seen (None: there is
    none, the snapshot is the latest). From ``run_date`` up to it every key gets the snapshot's values, or is
    away if the snapshot lacks it: versions that reach into this time are split, and neighbours that are
    then equal are rejoined. A day that was applied before is replaced. Any order of the same snapshots
    gives the same dimension. Versions that end before the day are not touched.
    """
    keys = list(keys)
    technical = [start_col, end_col] + ([date_col] if date_col else [])
    tracked = tracked_columns(target, [*keys, *technical])
    require_columns(target, technical, "target")
    require_columns(source, [*keys, *tracked], "source")
    require_comparable(source, [*keys, *tracked])
    stop = until or open_end
    if not run_date < stop <= open_end:
        raise ValueError(f"the snapshot of {run_date} cannot hold up to {stop}")
    start, end, today, later = quoted(start_col), quoted(end_col), date_literal(run_date), date_literal(stop)
    values = [quoted(c) for c in [*keys, *tracked]]

    near = target.where(f"{end} >= {today} AND {start} <= {later}")  # a range on the partition column, which prunes files
    far = target.where(f"NOT ({end} >= {today} AND {start} <= {later})")
    piece = free_name(target, "splice__piece")
    pieces = near.selectExpr(
        *values,
        f"explode(array(struct({start} AS a, least({end}, {today}) AS b), struct(greatest({start}, {later}) AS a, {end} AS b))) AS {piece}",
    ).where(f"{piece}.a < {piece}.b")
    fresh = with_unique_keys(source.selectExpr(*align_to(source, target, [*keys, *tracked])), keys, "source")
    fresh = fresh.selectExpr(*values, f"struct({today} AS a, {later} AS b) AS {piece}")

    over = f"OVER (PARTITION BY {', '.join(quoted(k) for k in keys)} ORDER BY {piece}.a)"
    held = "struct(" + ", ".join(quoted(c) for c in tracked) + ")" if tracked else "true"
    flagged = pieces.unionByName(fresh).selectExpr("*", f"lag({piece}.b) {over} AS splice__b", f"lag({held}) {over} AS splice__was")
    joins = f"coalesce(splice__b = {piece}.a AND splice__was <=> {held}, false)"
    islands = flagged.selectExpr("*", f"IF({joins}, 0, 1) AS splice__new").selectExpr("*", f"sum(splice__new) {over} AS splice__island")
    joined = islands.groupBy(*keys, "splice__island").agg(
        *[F.first(F.col(quoted(c))).alias(c) for c in tracked], F.min(f"{piece}.a").alias(start_col), F.max(f"{piece}.b").alias(end_col)
    )
    if date_col:
        joined = joined.selectExpr("*", f"{_written(open_end, start, end)} AS {quoted(date_col)}")
    return joined.select(*target.columns).unionByName(far)
