"""Comparing two snapshots of one table.

All classification is derived from one full-outer join on the key. Operators that need only
part of the result filter on the presence markers, and Catalyst then narrows the join to the
outer or inner form that is enough for it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimkeeper.functions import (
    align_to,
    quoted,
    require_columns,
    require_comparable,
    require_free,
    same_values,
    text_literal,
    tracked_columns,
    with_unique_keys,
    without_null_keys,
)


@dataclass(frozen=True)
class Match:
    """Two snapshots joined by key. All members but ``rows`` give SQL text over its columns."""

    rows: DataFrame
    keys: tuple[str, ...]
    tracked: tuple[str, ...]

    in_old = "(in__old IS NOT NULL)"
    in_new = "(in__new IS NOT NULL)"
    both = "(in__old IS NOT NULL AND in__new IS NOT NULL)"
    # Tracked values equal, NULL equal to NULL. Meaningful where ``both`` holds.
    same = "same__values"
    only_old = "(in__old IS NOT NULL AND in__new IS NULL)"
    only_new = "(in__old IS NULL AND in__new IS NOT NULL)"

    def old(self, name: str) -> str:
        return quoted(name if name in self.keys else f"old__{name}")

    def new(self, name: str) -> str:
        return quoted(name if name in self.keys else f"new__{name}")

    def old_columns(self, cols: Sequence[str]) -> list[str]:
        return [f"{self.old(c)} AS {quoted(c)}" for c in cols]

    def new_columns(self, cols: Sequence[str]) -> list[str]:
        return [f"{self.new(c)} AS {quoted(c)}" for c in cols]

    def columns_where(self, new_if: str, cols: Sequence[str]) -> list[str]:
        """The new side's values where the condition holds, else the old side's."""
        return [
            quoted(c) if c in self.keys else f"IF({new_if}, {self.new(c)}, {self.old(c)}) AS {quoted(c)}"
            for c in cols
        ]

    def newest_columns(self) -> list[str]:
        """Key and tracked columns, from the new side where the key is there."""
        return self.columns_where(self.in_new, [*self.keys, *self.tracked])


def match_snapshots(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str] | None = None,
    carry: Sequence[str] = (),
    check_keys: bool = True,
    check_old: bool = True,
) -> Match:
    """Join two snapshots on ``keys``.

    ``tracked`` are the compared columns (default: all that both sides have), ``carry`` further
    columns of the old side to keep. Each side is shuffled once, on the key; a side stored
    bucketed by the key is not shuffled at all. Keys are unique, so no key can make a partition
    hot. ``check_keys=False`` leaves out the checks where the store guarantees unique keys;
    ``check_old=False`` checks the old side for NULL keys only, as is enough for a table that is
    itself kept by these operators.
    """
    keys = list(keys)
    if tracked is None:
        tracked = [c for c in tracked_columns(old, [*keys, *carry]) if c in new.columns]
    tracked = list(tracked)
    require_free(["in__old", "in__new", "same__values"], keys, "match")
    require_free([f"{side}__{c}" for c in [*tracked, *carry] for side in ("old", "new")], keys, "match")
    require_columns(old, [*keys, *tracked, *carry], "old snapshot")
    require_columns(new, [*keys, *tracked], "new snapshot")
    require_comparable(old, [*keys, *tracked])
    require_comparable(new, [*keys, *tracked])

    left = old.selectExpr(
        *[quoted(k) for k in keys],
        *[f"{quoted(c)} AS {quoted(f'old__{c}')}" for c in dict.fromkeys([*tracked, *carry])],
        "true AS in__old",
    )
    right = new.selectExpr(*align_to(new, old, [*keys, *tracked])).selectExpr(
        *[quoted(k) for k in keys],
        *[f"{quoted(c)} AS {quoted(f'new__{c}')}" for c in tracked],
        "true AS in__new",
    )
    if check_keys:
        left = (with_unique_keys if check_old else without_null_keys)(left, keys, "old snapshot")
        right = with_unique_keys(right, keys, "new snapshot")
    same = same_values([quoted(f"old__{c}") for c in tracked], [quoted(f"new__{c}") for c in tracked])
    joined = left.join(right, keys, "full_outer").selectExpr("*", f"{same} AS same__values")
    return Match(joined, tuple(keys), tuple(tracked))


def snapshot_diff(
    old: DataFrame, new: DataFrame, keys: Sequence[str], tracked: Sequence[str] | None = None, op_col: str = "op"
) -> DataFrame:
    """Change rows ``op, keys, tracked``: I and U carry the new values, D the last ones."""
    m = match_snapshots(old, new, keys, tracked)
    require_free([op_col], [*m.keys, *m.tracked], "snapshot diff")
    op = f"CASE WHEN {m.only_new} THEN 'I' WHEN {m.only_old} THEN 'D' ELSE 'U' END AS {quoted(op_col)}"
    return m.rows.where(f"NOT ({m.both} AND {m.same})").selectExpr(op, *m.newest_columns())


def diff_counts(
    old: DataFrame, new: DataFrame, keys: Sequence[str], tracked: Sequence[str] | None = None, op_col: str = "op"
) -> DataFrame:
    """Number of change rows per op code."""
    return snapshot_diff(old, new, keys, tracked, op_col).groupBy(op_col).agg(F.count(F.lit(1)).alias("n"))


def upsert_rows(
    old: DataFrame, new: DataFrame, keys: Sequence[str], tracked: Sequence[str] | None = None
) -> DataFrame:
    """New-side rows whose key is new or whose values differ."""
    m = match_snapshots(old, new, keys, tracked)
    rows = m.rows.where(f"{m.in_new} AND ({m.only_new} OR NOT {m.same})")
    return rows.selectExpr(*m.new_columns([*m.keys, *m.tracked]))


def changed_rows(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str] | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Old-side rows that are gone or differ, with ``carry`` columns (such as their dates)."""
    m = match_snapshots(old, new, keys, tracked, carry)
    rows = m.rows.where(f"{m.in_old} AND ({m.only_old} OR NOT {m.same})")
    return rows.selectExpr(*m.old_columns([*m.keys, *m.tracked, *carry]))


def unchanged_rows(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str] | None = None,
    include_deleted: bool = False,
) -> DataFrame:
    """Old-side rows that the new side does not overwrite."""
    m = match_snapshots(old, new, keys, tracked)
    # A plain "both AND same" would make every compared column a join key, and Spark would shuffle
    # once more by all of them. As one CASE the comparison stays a filter behind the join.
    absent = "true" if include_deleted else "false"
    kept = f"CASE WHEN {m.only_old} THEN {absent} WHEN {m.same} THEN true ELSE false END"
    return m.rows.where(f"{m.in_old} AND {kept}").selectExpr(*m.old_columns([*m.keys, *m.tracked]))


def new_keys(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """New-side rows whose key the old side lacks."""
    return without_null_keys(new, keys, "new snapshot").join(old.select(*keys), list(keys), "left_anti")


def deleted_rows(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Old-side rows whose key the new side lacks."""
    return without_null_keys(old, keys, "old snapshot").join(new.select(*keys), list(keys), "left_anti")


def attribute_changes(
    old: DataFrame, new: DataFrame, keys: Sequence[str], tracked: Sequence[str] | None = None
) -> DataFrame:
    """One row per key and changed column: ``keys, attribute, old_value, new_value`` (text)."""
    m = match_snapshots(old, new, keys, tracked)
    each = ", ".join(
        f"named_struct('attribute', {text_literal(c)}, 'old_value', CAST({m.old(c)} AS string), "
        f"'new_value', CAST({m.new(c)} AS string), 'same', {m.old(c)} <=> {m.new(c)})"
        for c in m.tracked
    )
    names = [quoted(k) for k in m.keys]
    return (
        m.rows.where(f"{m.both} AND NOT {m.same}")
        .selectExpr(*names, f"inline(array({each}))")
        .where("NOT same")
        .selectExpr(*names, "attribute", "old_value", "new_value")
    )
