"""Cleaning steps of the processing layer."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from dimkeeper.functions import free_name, require_free


def clean_nulls(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace NULL by a default, per column; other columns pass through."""
    return df.select(
        *[F.coalesce(F.col(c), F.lit(defaults[c])).alias(c) if c in defaults else F.col(c) for c in df.columns]
    )


def dedup_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the one latest by ``order_by``.

    Ties are settled by the remaining columns, so the result does not depend on row order. Spark
    puts a per-key limit of one row in front of the shuffle (WindowGroupLimit), so of a key with
    very many copies each input partition sends on one row only.
    """
    rest = [c for c in df.columns if c not in {*keys, *order_by}]
    order = [F.col(c).desc_nulls_last() for c in [*order_by, *rest]]
    rank = F.row_number().over(W.Window.partitionBy(*keys).orderBy(*order))
    name = free_name(df, "row__rank")
    return df.withColumn(name, rank).where(F.col(name) == 1).drop(name)


def _converted(name: str, want: str | tuple[str, str]) -> Column:
    """A text column trimmed and converted; NULL where it does not convert."""
    text = F.trim(F.col(name))
    if isinstance(want, tuple):
        kind, pattern = want
        if kind != "date":
            raise ValueError(f"a pattern is for dates only, not {kind!r}")
        return F.try_to_timestamp(text, F.lit(pattern)).cast("date")
    return text if want == "string" else text.try_cast(want)


def normalise_types(df: DataFrame, types: Mapping[str, str | tuple[str, str]]) -> DataFrame:
    """Trim text columns and convert them; text that does not convert becomes NULL.

    ``types`` maps a column to a Spark type name, or to ``("date", pattern)``. To keep the rows whose text
    does not convert apart, and to count them, see ``normalise_checked``.
    """
    return df.select(*[_converted(c, types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


# Columns of checked and of rejected rows.
RAW, REJECTS = "raw", "rejects"


def normalise_checked(df: DataFrame, types: Mapping[str, str | tuple[str, str]], empty_is_null: bool = True) -> DataFrame:
    """The same, with ``raw``, the row as it came, and ``rejects``: (column, text, reason) of each text that did not convert.

    NULL stays NULL and is no reject, nor is blank text with ``empty_is_null``. A row is accepted if ``rejects`` is empty.
    """
    require_free([RAW, REJECTS], df.columns, "checked rows")

    def reject(name: str) -> Column:
        text = F.col(name).cast("string")
        blank = (F.trim(text) == "") if empty_is_null else F.lit(False)
        failed = text.isNotNull() & ~blank & _converted(name, types[name]).isNull()
        wanted = " ".join(types[name]) if isinstance(types[name], tuple) else types[name]
        entry = F.struct(F.lit(name).alias("column"), text.alias("text"), F.lit(f"not a value of type {wanted}").alias("reason"))
        return F.when(failed, entry)

    checks = [reject(c) for c in df.columns if c in types and types[c] != "string"]
    none = F.expr("CAST(array() AS array<struct<column: string, text: string, reason: string>>)")
    rejects = F.filter(F.array(*checks), lambda x: x.isNotNull()) if checks else none
    typed = [_converted(c, types[c]).alias(c) if c in types else F.col(c) for c in df.columns]
    return df.select(*typed, F.struct(*[F.col(c) for c in df.columns]).alias(RAW), rejects.alias(REJECTS))


def accepted_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.size(REJECTS) == 0).drop(RAW, REJECTS)


def rejected_rows(checked: DataFrame) -> DataFrame:
    """The rows as they came, with ``rejects``."""
    return checked.where(F.size(REJECTS) > 0).select(f"{RAW}.*", REJECTS)


def union_parts(parts: Sequence[DataFrame]) -> DataFrame:
    """Union of separately processed parts, by name; a column a part lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
