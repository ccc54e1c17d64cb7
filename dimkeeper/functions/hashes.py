"""Hashes of whole rows, and sums of them that tell multisets of rows apart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from dimkeeper.functions.columns import quoted


def row_hashes(df: DataFrame) -> list[str]:
    """Two independent hashes of all columns, as SQL text. NULL counts by its place, nested values as text."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    values = []
    for f in df.schema.fields:
        value = f"CAST({quoted(f.name)} AS string)" if isinstance(f.dataType, nested) else quoted(f.name)
        values += [value, f"{quoted(f.name)} IS NULL"]
    args = ", ".join(values)
    return [f"xxhash64({seed}, {args})" for seed in (11, 12)]


def hash_sums(df: DataFrame) -> list[str]:
    """Aggregates that tell two multisets of rows apart: their number and the sums of both hashes."""
    sums = [f"coalesce(sum(CAST({h} AS decimal(38, 0))), 0) AS h{n}" for n, h in enumerate(row_hashes(df), 1)]
    return ["count(1) AS n_rows", *sums]
