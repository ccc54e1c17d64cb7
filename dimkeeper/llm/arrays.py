"""Array expressions whose work grows in proportion to the array, built-in functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where lambdas use it for each element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(values: Column, neutral: int, join: Callable[[Column, Column], Column]) -> Column:
    """``join`` over all values up to each place of an array of int, by doubling the reach: 1, 2, 4, ... places."""
    none = F.lit(neutral).cast("int")

    def step(acc: Column, reach: Column) -> Column:
        earlier = F.concat(F.array_repeat(none, reach), F.slice(acc, 1, F.size(acc) - reach))
        return F.zip_with(acc, earlier, lambda a, b: F.coalesce(join(a, b), none))

    def doubled(held: Column) -> Column:
        n = F.size(held)
        return F.aggregate(F.filter(F.array(*(F.lit(1 << k) for k in range(31))), lambda reach: reach < n), held, step)

    return let(F.transform(values, lambda v: F.coalesce(v.cast("int"), none)), doubled)


def before(sums: Column, neutral: int) -> Column:
    """What ran up to the place before."""
    none = F.array(F.lit(neutral).cast("int"))
    return let(sums, lambda r: F.concat(none, F.slice(r, 1, F.greatest(F.size(r) - 1, F.lit(0)))))
