"""Every query of the library itself against its DuckDB oracle: columns, row count and exact values."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as driver

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def oracle_rows(sf_dir, sql):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return columns, result.fetchall()


@pytest.mark.parametrize("name", sorted(driver.library_queries()))
def test_query_equals_oracle(spark, name):
    sf_dir = "/root/testdata/sf0.01" if name.startswith("orders") else "/root/testdata/sf0.001"
    df = driver.library_queries()[name](spark, sf_dir)
    columns, rows = oracle_rows(sf_dir, driver.ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(columns)
    assert normalised(df.columns, [tuple(r) for r in df.collect()]) == normalised(columns, rows)


def test_every_query_has_an_oracle():
    assert set(driver.library_queries()) == set(driver.ORACLE_SQL)
