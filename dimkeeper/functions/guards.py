"""Key checks that are part of the plan: the job fails instead of writing wrong rows.

A NULL key matches nothing and a repeated key multiplies rows, so both are errors. The checks
differ in cost:

``with_unique_keys``   finds both. It adds no shuffle when a join on the same keys follows, because
                       window and join need the same distribution and sort order.
``without_null_keys``  finds NULLs and adds a filter only.
``key_violations``     finds repeated keys, for results whose rows are not shuffled by key. The key
                       columns alone are counted (``counted_keys``), with map-side partial sums, so
                       a key repeated very often stays cheap. The counted keys serve an anti-join
                       as well; both uses share one scan and one shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimkeeper.functions.columns import free_name, quoted, text_literal


def _fail(message: str, keys: Sequence[str]) -> str:
    shown = ", ".join(f"coalesce(CAST({quoted(k)} AS string), 'NULL')" for k in keys)
    start = text_literal(f"{message}: ({', '.join(keys)}) = (")
    return f"raise_error(concat({start}, concat_ws(', ', {shown}), ')'))"


def _any_null(keys: Sequence[str]) -> str:
    return "(" + " OR ".join(f"{quoted(k)} IS NULL" for k in keys) + ")"


def with_unique_keys(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """``df`` unchanged; fails at run time on a NULL or repeated key."""
    names = ", ".join(quoted(k) for k in keys)
    rank = free_name(df, "key__rank")
    return (
        without_null_keys(df, keys, what)  # in front of the shuffle, which would bring all NULLs together
        .selectExpr("*", f"row_number() OVER (PARTITION BY {names} ORDER BY {names}) AS {rank}")
        .where(f"CASE WHEN {rank} > 1 THEN CAST({_fail(what + ', repeated key', keys)} AS boolean) ELSE true END")
        .select(*df.columns)
    )


def without_null_keys(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """``df`` unchanged; fails at run time on a NULL key."""
    return df.where(
        f"CASE WHEN {_any_null(keys)} THEN CAST({_fail(what + ', NULL in key', keys)} AS boolean) ELSE true END"
    )


def counted_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys of ``df`` without NULLs, each once, with ``key__copies``."""
    # The two filters make all uses of the result one and the same subtree, which Spark then computes
    # once: an anti-join would add the first by itself, and the second, always true, keeps the count
    # in the plan where only the keys are wanted.
    present = " AND ".join(f"{quoted(k)} IS NOT NULL" for k in keys)
    return df.where(present).groupBy(*keys).agg(F.count(F.lit(1)).alias("key__copies")).where("key__copies > 0")


def key_violations(counted: DataFrame, keys: Sequence[str], what: str, like: DataFrame) -> DataFrame:
    """A branch to union: no rows, in the columns of ``like``; fails on a repeated key."""
    # One condition, as a separate error condition on the keys alone would be pushed below the count.
    bad = counted.where(
        f"CASE WHEN key__copies > 1 THEN CAST({_fail(what + ', repeated key', keys)} AS boolean) ELSE false END"
    )
    return bad.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in like.schema.fields])
