"""Daily snapshots derived from the given tables, as input for the registered queries.

The given tables show one state only. A change script in the form of column expressions turns a
whole table into its states on consecutive days: each remainder test says which keys a day adds,
removes or changes, so that all kinds of change occur (insert, delete, one or several attributes,
to and from NULL, back to an earlier value, return after a delete). The remainders are the change
script itself and not a sample of the table: every snapshot holds about nine tenths of all keys,
and every key of the table is in one of the first two.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

# The three run dates.
D1, D2, D3 = dt.date(2025, 11, 30), dt.date(2025, 12, 1), dt.date(2025, 12, 2)

CUSTOMER_KEYS = ["customer_id"]
ORDER_KEYS = ["o_orderkey"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def customer_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer table in the columns of the dimension's source."""
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS customer_id",
        "c_name AS full_name",
        "date_add(DATE'1970-01-01', CAST(c_custkey % 10000 AS int)) AS date_of_birth",
        "CASE WHEN c_custkey % 29 <> 0 THEN concat('N', c_nationkey) END AS hometown",
        "concat('09', lpad(c_custkey, 8, '0')) AS phone_number",
        """CASE WHEN c_custkey % 31 <> 0
                THEN concat('c', c_custkey, '@', lower(c_mktsegment), '.example.org') END AS email""",
        "CASE c_custkey % 3 WHEN 0 THEN 'Nam' WHEN 1 THEN 'Nu' ELSE 'Khac' END AS gender",
    )


def _day1(base: DataFrame) -> DataFrame:
    return base.where("customer_id % 10 <> 9")


def _day2(base: DataFrame) -> DataFrame:
    return base.where("NOT (customer_id % 11 = 4 AND customer_id % 10 <> 9)").selectExpr(
        "customer_id",
        "full_name",
        "IF(customer_id % 7 = 4, date_add(date_of_birth, 1), date_of_birth) AS date_of_birth",
        """CASE WHEN customer_id % 7 IN (1, 3) THEN 'MOVED'
                WHEN customer_id % 58 = 0 THEN 'FILLED' ELSE hometown END AS hometown""",
        "IF(customer_id % 7 IN (2, 3), concat('08', substr(phone_number, 3)), phone_number) AS phone_number",
        "email",
        "IF(customer_id % 7 = 1, 'Khac', gender) AS gender",
    )


def _day3(base: DataFrame) -> DataFrame:
    """Some keys return to their first day's values, some deleted keys come back."""
    reverts = "(customer_id % 14 = 1 OR customer_id % 22 = 4)"
    return _day1(base).where(reverts).unionByName(_day2(base).where(f"NOT {reverts}"))


def customer_days(spark: SparkSession, sf_dir: str) -> list[tuple[dt.date, DataFrame]]:
    base = customer_base(spark, sf_dir)
    return [(D1, _day1(base)), (D2, _day2(base)), (D3, _day3(base))]


def orders_days(spark: SparkSession, sf_dir: str) -> list[tuple[dt.date, DataFrame]]:
    orders = table(spark, sf_dir, "orders")
    first = orders.where("o_orderkey % 10 <> 9")
    second = orders.where("NOT (o_orderkey % 11 = 4 AND o_orderkey % 10 <> 9)").selectExpr(
        "o_orderkey",
        "o_custkey",
        "IF(o_orderkey % 7 = 1, 'F', o_orderstatus) AS o_orderstatus",
        "o_totalprice",
        "o_orderdate",
        "IF(o_orderkey % 13 = 0, NULL, o_orderpriority) AS o_orderpriority",
    )
    return [(D1, first), (D2, second)]
