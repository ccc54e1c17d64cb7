"""Tables in parts by key, of which a change set rewrites only those it touches.

A part is a partition: ``pmod(xxhash64(keys), n)``. The change set names its parts (at most n
numbers), these limit the scan of the table and the dynamic overwrite that follows, and all other
files stay as they are. The number of parts is a property of the table; choose it so that a part
is a few hundred MB, and more than a day's changes touch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimkeeper.functions import align_to, quoted, require_free
from dimkeeper.operators.merge import merge_upsert
from dimkeeper.sources.scratch import materialised
from dimkeeper.sources.tables import ensure_table, set_table_property, staged_replace, table_property

#: The partition column.
PART = "part__no"
_PARTS = "parts"  # the table property that says how many


def part_number(keys: Sequence[str], parts: int) -> Column:
    """The part that a key belongs to. Keys must have the stored types: an int and a bigint hash apart."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(parts)).cast("int")


def ensure_parted_table(spark: SparkSession, table: str, schema: T.StructType, keys: Sequence[str], parts: int) -> None:
    """Create the table in ``parts`` parts by ``keys`` if it is absent; its number of parts never changes."""
    require_free([PART], schema.names, "table in parts")
    ensure_table(spark, table, T.StructType([*schema.fields, T.StructField(PART, T.IntegerType())]), partition_by=[PART])
    if PART not in spark.table(table).columns:
        raise ValueError(f"{table} exists already and is not divided into parts")
    if parts_of(spark, table) is None:
        set_table_property(spark, table, _PARTS, str(parts))


def parts_of(spark: SparkSession, table: str) -> int | None:
    """Into how many parts a table is divided; None for one that is not."""
    found = table_property(spark, table, _PARTS)
    return int(found) if found else None


def stored_rows(spark: SparkSession, table: str) -> DataFrame:
    """The rows of a table, without the part number if it is divided into parts."""
    return spark.table(table).drop(PART)


def in_parts(df: DataFrame, keys: Sequence[str], parts: int) -> DataFrame:
    """Rows with their part number, those of a part together, so that each part is one file."""
    return df.withColumn(PART, part_number(keys, parts)).repartition(PART)


def fill_parts(spark: SparkSession, df: DataFrame, table: str, keys: Sequence[str]) -> None:
    """Replace the whole content."""
    rows = df.selectExpr(*align_to(df, stored_rows(spark, table), df.columns))
    every = list(range(parts_of(spark, table)))
    staged_replace(spark, in_parts(rows, keys, len(every)), table, PART, always=every)


def merge_touched_parts(
    spark: SparkSession,
    changes: DataFrame,
    table: str,
    keys: Sequence[str],
    apply: Callable[[DataFrame, DataFrame, Sequence[str]], DataFrame] = merge_upsert,
) -> list[int]:
    """Bring ``changes`` into the table, rewriting the parts they touch; returns these.

    ``apply(part of the table, changes, keys)`` gives the new content: by default changed rows replace
    stored ones, ``operators.merge.apply_changes`` takes a change feed, and may empty a part. A run that
    broke off is completed by ``sources.tables.finish_replace``. The driver sees the part numbers only.
    """
    n = parts_of(spark, table)
    if n is None:
        raise ValueError(f"{table} is not divided into parts; see ensure_parted_table")
    stored = spark.table(table)
    known = [c for c in changes.columns if c in stored.columns]
    extra = [c for c in changes.columns if c not in known]
    numbered = changes.selectExpr(*align_to(changes, stored, known), *[quoted(c) for c in extra]).withColumn(PART, part_number(keys, n))
    with materialised(numbered) as rows:
        touched = sorted(r[0] for r in rows.select(PART).distinct().collect())
        if touched:
            target = stored.where(F.col(PART).isin(touched)).drop(PART)
            merged = apply(target, rows.drop(PART), list(keys))
            staged_replace(spark, in_parts(merged, keys, n), table, PART, always=touched)
    return touched
