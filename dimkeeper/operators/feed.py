"""A change feed with sequence numbers, applied in any order of arrival.

The state is a table of the entity's columns, the last sequence number of each key, and whether the
key is deleted: a tombstone keeps its number, so that an older change cannot bring the key back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimkeeper.functions import align_to, quoted, require_columns, require_comparable, require_free, tracked_columns, without_null_keys

# Technical columns of the state.
LAST_SEQ, DELETED = "last_seq", "is_deleted"


def feed_state(snapshot: DataFrame, seq: int = 0) -> DataFrame:
    """A snapshot as state: every key is there as of the sequence number ``seq``."""
    require_free([LAST_SEQ, DELETED], snapshot.columns, "state of a feed")
    return snapshot.selectExpr("*", f"CAST({seq} AS long) AS {LAST_SEQ}", f"false AS {DELETED}")


def live_rows(state: DataFrame) -> DataFrame:
    """The entity's rows."""
    return state.where(f"NOT {DELETED}").drop(LAST_SEQ, DELETED)


def net_changes(feed: DataFrame, keys: Sequence[str], seq_col: str = "seq", op_col: str = "op") -> DataFrame:
    """The last change of each key. Partial maxima go ahead of the shuffle, so of a key with very many changes
    each task sends one. Several changes with one number are settled by op and values, in that order."""
    keys = list(keys)
    rest = tracked_columns(feed, [*keys, seq_col, op_col])
    require_comparable(feed, rest)
    change = F.struct(quoted(seq_col), quoted(op_col), *[F.col(quoted(c)) for c in rest])
    last = without_null_keys(feed, keys, "change feed").groupBy(*[F.col(quoted(k)) for k in keys]).agg(F.max(change).alias("net__change"))
    return last.selectExpr(*[quoted(k) for k in keys], "net__change.*").select(*feed.columns)


def apply_ordered(state: DataFrame, feed: DataFrame, keys: Sequence[str], seq_col: str = "seq", op_col: str = "op") -> DataFrame:
    """The state after a feed (op I, U or D, several changes for a key, in any order).

    Of each key the change with the highest number counts, and only if that is above the key's last one: changes
    that come twice or late leave nothing behind. So any split of a feed into batches, applied in any order, gives one
    state. Every change carries the whole row; a D row's values are kept with the tombstone. A NULL key or number
    or another op is an error. The feed is folded before it meets the state; where it is small AQE broadcasts its
    keys, and the state is not shuffled.
    """
    keys = list(keys)
    columns = [c for c in state.columns if c not in (LAST_SEQ, DELETED)]
    require_columns(state, [*keys, LAST_SEQ, DELETED], "state of a feed")
    require_columns(feed, [*columns, seq_col, op_col], "change feed")
    op, seq = quoted(op_col), quoted(seq_col)
    unknown = f"raise_error(concat('change feed, unknown op: ', coalesce(CAST({op} AS string), 'NULL')))"
    missing = "raise_error('change feed: a change has no sequence number')"
    # Checked ahead of the fold: the error must not depend on which change of a key is the last.
    checked = feed.selectExpr(
        *align_to(feed, state, columns),
        f"coalesce(CAST({seq} AS long), CAST({missing} AS long)) AS {LAST_SEQ}",
        f"CASE {op} WHEN 'D' THEN true WHEN 'I' THEN false WHEN 'U' THEN false ELSE CAST({unknown} AS boolean) END AS {DELETED}",
    )
    net = net_changes(checked, keys, LAST_SEQ, DELETED)
    known = state.selectExpr(*[quoted(k) for k in keys], f"{LAST_SEQ} AS feed__known")
    newer = net.join(known, keys, "left").where(f"feed__known IS NULL OR {LAST_SEQ} > feed__known").select(*state.columns)
    return state.join(newer.select(*keys), keys, "left_anti").select(*state.columns).unionByName(newer)
