"""Comparing snapshots by stored fingerprints, so that only parts that differ are read and joined.

A table in parts (``sources.parts``) has beside it a small table with, for each part, the number of rows
and the sums of two hashes of them. A new snapshot is summed up the same way, in one pass without
moving its rows; only the parts whose sums differ are then read from the table and compared row by
row, value by value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimkeeper.functions import align_to, tracked_columns
from dimkeeper.functions.hashes import hash_sums
from dimkeeper.operators.diff import snapshot_diff
from dimkeeper.sources.parts import PART, fill_parts, part_number, parts_of, stored_rows
from dimkeeper.sources.tables import save_table


def fingerprints(df: DataFrame) -> DataFrame:
    """(part, n_rows, h1, h2) of rows with a part number; partial sums go ahead of the shuffle."""
    return df.groupBy(PART).agg(*[F.expr(x) for x in hash_sums(df)])


def _numbered(spark: SparkSession, df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    like = stored_rows(spark, table)
    rows = df.selectExpr(*align_to(df, like, like.columns))
    return rows.withColumn(PART, part_number(keys, parts_of(spark, table)))


def save_with_fingerprints(spark: SparkSession, df: DataFrame, table: str, keys: Sequence[str]) -> None:
    """Fill a table in parts, and write its fingerprints to ``<table>__sums``.

    The old fingerprints go first: a run that breaks off leaves none, and a diff then reads everything.
    """
    spark.sql(f"DROP TABLE IF EXISTS {table}__sums")
    fill_parts(spark, df, table, keys)
    save_table(spark, fingerprints(spark.table(table)), f"{table}__sums")


def differing_parts(spark: SparkSession, table: str, new: DataFrame, keys: Sequence[str]) -> list[int]:
    """Parts whose rows in the table and in the snapshot differ. The driver sees their numbers only."""
    now = fingerprints(_numbered(spark, new, table, keys))
    if not spark.catalog.tableExists(f"{table}__sums"):
        return list(range(parts_of(spark, table)))
    then = spark.table(f"{table}__sums")
    both = now.withColumnRenamed("n_rows", "n").join(then.toDF(PART, "n_rows", "o1", "o2"), PART, "full_outer")
    return sorted(r[0] for r in both.where("NOT (n <=> n_rows AND h1 <=> o1 AND h2 <=> o2)").select(PART).collect())


def diff_by_fingerprint(spark: SparkSession, table: str, new: DataFrame, keys: Sequence[str], op_col: str = "op") -> DataFrame:
    """``snapshot_diff`` of the stored table and ``new``, reading only the parts that differ.

    Key checks see these parts only; rows of equal parts are equal to stored ones, whose keys are unique.
    """
    parts = differing_parts(spark, table, new, keys)
    numbered = _numbered(spark, new, table, keys)
    old, fresh = (df.where(F.col(PART).isin(parts)).drop(PART) for df in (spark.table(table), numbered))
    return snapshot_diff(old, fresh, keys, tracked_columns(old, keys), op_col)
