"""Ten customers on day 1; on day 2 one insert, three updates and one delete."""

from __future__ import annotations

import datetime as dt

DAY1, DAY2, DAY3 = dt.date(2025, 11, 30), dt.date(2025, 12, 1), dt.date(2025, 12, 2)
KEYS = ["customer_id"]
SCHEMA = (
    "customer_id int, full_name string, date_of_birth date, hometown string, "
    "phone_number string, email string, gender string"
)
PREVIOUS = {"hometown": "pre_hometown", "phone_number": "pre_phone_number"}


def _row(key: int, **changes):
    row = {
        "customer_id": key,
        "full_name": f"Person {key}",
        "date_of_birth": dt.date(1990, 1, key),
        "hometown": f"Town {key}",
        "phone_number": f"0900{key:06d}",
        "email": f"p{key}@mail{key}.example",
        "gender": "Nam" if key % 2 else "Nu",
    }
    return {**row, **changes}


def day1(spark):
    return spark.createDataFrame([_row(k) for k in range(1, 11)], SCHEMA)


def day2_rows():
    changed = {
        1: {"hometown": "New Town", "gender": "Khac"},
        2: {"phone_number": "0899999999", "gender": "Khac"},
        3: {"date_of_birth": dt.date(2000, 2, 2)},
    }
    return [_row(k, **changed.get(k, {})) for k in range(1, 12) if k != 4]


def day2(spark):
    return spark.createDataFrame(day2_rows(), SCHEMA)


def dimension(spark, *technical):
    """An empty dimension with the source columns and the given extra columns."""
    return spark.createDataFrame([], ", ".join([SCHEMA, *technical]))


def rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def by_key(df):
    return {r["customer_id"]: r for r in df.collect()}
