"""Numbers of distinct values over any range of days, from stored sketches that merge."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Binary logarithm of a sketch's registers: 4,096 of them, a relative standard error of 1.04 / 64.
LOG_REGISTERS = 12


def error_bound(log_registers: int = LOG_REGISTERS, deviations: float = 4) -> float:
    """Relative error that an estimate exceeds in about one of 16,000 cases (four standard deviations)."""
    return deviations * 1.04 / 2 ** (log_registers / 2)


def daily_sketches(df: DataFrame, grain: Mapping[str, Column], value: Column, log_registers: int = LOG_REGISTERS) -> DataFrame:
    """One sketch of the distinct values for each group (such as day and key). NULL values do not count.

    A sketch has at most about 2**``log_registers`` bytes however many values it has seen; tasks send
    sketches, not values, so no group can make a partition hot. New days are appended, a corrected day replaced.
    """
    rows = df.select(*[col.alias(n) for n, col in grain.items()], value.alias("sketch__value"))
    return rows.groupBy(*grain).agg(F.hll_sketch_agg("sketch__value", log_registers).alias("sketch"))


def distinct_estimate(sketches: DataFrame, by: Sequence[str] = (), name: str = "n_distinct") -> DataFrame:
    """Estimated distinct values of the rows' union, by the columns ``by``; filter the days before."""
    union = F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name)
    return sketches.groupBy(*by).agg(union)
