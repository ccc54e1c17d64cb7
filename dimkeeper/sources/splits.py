"""Splits of a source into predicates of like size, from one small aggregate.

For a database that reads one partition through each connection (``JdbcSource(predicates=...)``), and
for any other reader that takes predicates. Borders are quantiles of the split column; a value that
takes up a whole share has a branch of its own, and so do NULLs.
"""

from __future__ import annotations

import datetime as dt
import decimal
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimkeeper.sources.read import JdbcSource, read_source

_KINDS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.DateType)


def quantile_borders(df: DataFrame, column: str, branches: int, accuracy: int = 10_000) -> list:
    """The values at 1 / branches, 2 / branches, ... of the rows, NULLs left out; one pass, one row to the driver.

    Each is off by at most rows / ``accuracy`` places. Integers, decimals and dates only: types whose order every
    database shares. A database can give the same list by its own ``percentile_disc``.
    """
    kind = df.schema[column].dataType
    if not isinstance(kind, _KINDS):
        raise TypeError(f"{column}: a split needs whole numbers, decimals or dates, not {kind.simpleString()}")
    at = [n / branches for n in range(1, branches)]
    if not at:
        return []
    if isinstance(kind, T.DateType):
        days = F.percentile_approx(F.unix_date(F.col(column)), at, accuracy)
        found = df.select(days).first()[0] or []
        return [dt.date(1970, 1, 1) + dt.timedelta(days=d) for d in found]
    return df.select(F.percentile_approx(F.col(column), at, accuracy)).first()[0] or []


def _text(value: object) -> str:
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, (int, decimal.Decimal)):
        return format(value, "f") if isinstance(value, decimal.Decimal) else str(value)
    raise TypeError(f"no literal for {value!r}")


def split_predicates(column: str, borders: Sequence) -> list[str]:
    """Predicates of which exactly one holds for each row, whatever its value.

    A border that occurs twice or more among the quantiles takes up a share by itself and becomes
    ``column = value``; between neighbouring borders lie ranges that leave such values out; the first and
    last ranges are open; the last predicate is ``column IS NULL``.
    """
    values = sorted(set(borders))
    alone = {v for v in values if list(borders).count(v) > 1}
    out: list[str] = []
    low: tuple[str, str] | None = None  # where the next range begins: operator and literal
    for v in values:
        text = _text(v)
        upto = f"{column} < {text}" if v in alone else f"{column} <= {text}"
        out.append(f"{column} {low[0]} {low[1]} AND {upto}" if low else upto)
        if v in alone:
            out.append(f"{column} = {text}")
        low = (">", text)
    out.append(f"{column} {low[0]} {low[1]}" if low else f"{column} IS NOT NULL")
    return [*out, f"{column} IS NULL"]


def plan_splits(df: DataFrame, column: str, branches: int) -> list[str]:
    """About ``branches`` predicates of like numbers of rows; see ``split_predicates``."""
    if branches < 1:
        raise ValueError("a split has one branch at least")
    return split_predicates(column, quantile_borders(df, column, branches))


def split_source(spark: SparkSession, source: JdbcSource, column: str, branches: int) -> JdbcSource:
    """A JDBC source with planned predicates in the place of a split that the caller would have to know.

    The planning reads the one column over one connection; a source that reads from a sample or an index is as good.
    """
    plain = replace(source, column=None, lower=None, upper=None, partitions=1, predicates=None)
    return replace(plain, predicates=plan_splits(read_source(spark, plain, [column]), column, branches))


def read_branches(df: DataFrame, predicates: Sequence[str], number: str = "branch") -> DataFrame:
    """The rows of all branches, with the branch they were read by."""
    parts = [df.where(p).withColumn(number, F.lit(n)) for n, p in enumerate(predicates)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
