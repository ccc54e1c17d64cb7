"""Metrics joined to a dimension, and facts aggregated by dimension attributes.

Facts are aggregated by key before they meet the dimension. Partial sums are built on the map
side, so a key that holds a large share of all facts arrives as one row per task, and the join is
between rows unique by key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimkeeper.functions import require_free, with_unique_keys
from dimkeeper.operators.asof import facts_as_of


def add_metrics(
    dimension: DataFrame, facts: DataFrame, keys: Sequence[str], metrics: Mapping[str, Column], zero: Sequence[str] = ()
) -> DataFrame:
    """Dimension rows with metrics of their facts; metrics in ``zero`` are 0 where there are none.

    A dimension with a repeated or NULL key is an error.
    """
    per_key = facts.groupBy(*keys).agg(*[col.alias(name) for name, col in metrics.items()])
    require_free(metrics, dimension.columns, "metrics")
    joined = with_unique_keys(dimension, keys, "dimension").join(per_key, list(keys), "left")
    return joined.select(
        *dimension.columns,
        *[F.coalesce(F.col(m), F.lit(0)).alias(m) if m in zero else F.col(m) for m in metrics],
    )


def sales_by_attributes(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    grain: Mapping[str, Column],
    attributes: Sequence[str],
    sums: Mapping[str, Column],
    unknown: str = "UNKNOWN",
) -> DataFrame:
    """Sums of the facts by grain columns and dimension attributes.

    Facts without a dimension row, and NULL attributes, are counted under ``unknown``, so the sums
    over the result equal those over the facts. A dimension with a repeated or NULL key is an error.
    """
    per_key = facts.groupBy(F.col(key), *[col.alias(name) for name, col in grain.items()]).agg(
        *[F.sum(col).alias(name) for name, col in sums.items()]
    )
    known = with_unique_keys(dimension.select(key, *attributes), [key], "dimension")
    return (
        per_key.join(known, key, "left")
        .groupBy(*grain, *[F.coalesce(F.col(a), F.lit(unknown)).alias(a) for a in attributes])
        .agg(*[F.sum(name).alias(name) for name in sums])
    )


def sales_as_of(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    date: Column,
    grain: Mapping[str, Column],
    attributes: Sequence[str],
    sums: Mapping[str, Column],
    unknown: str = "UNKNOWN",
    start_col: str = "start_date",
    end_col: str = "end_date",
) -> DataFrame:
    """Sums of the facts by grain columns and by the attributes as they were on each fact's date.

    ``dimension`` is of type 2. Facts are first summed by key, date and grain, so a key with a large
    share of all facts comes to as many rows as it has dates, and these take the version of their date.
    Facts before, between and after the versions, without a known key or date, and NULL attributes
    count under ``unknown``; the sums over the result equal those over the facts.
    """
    require_free(["sale__date"], [key, *grain, *sums, *attributes], "facts")
    daily = facts.groupBy(F.col(key), date.alias("sale__date"), *[col.alias(name) for name, col in grain.items()]).agg(
        *[F.sum(col).alias(name) for name, col in sums.items()]
    )
    versions = dimension.select(key, start_col, end_col, *attributes)
    dated = facts_as_of(daily, versions, [key], "sale__date", attributes, start_col, end_col)
    return dated.groupBy(*grain, *[F.coalesce(F.col(a), F.lit(unknown)).alias(a) for a in attributes]).agg(
        *[F.sum(name).alias(name) for name in sums]
    )
