"""Facts joined to the version of a dimension that was valid on their date.

Versions and facts are brought together by one union and one shuffle on the key; sorted by date,
each fact takes the last version begun before or on its date (``last_value``), and drops it if that
version had ended by then. No range condition is joined on. A key with very many facts is dealt to
several slices of time; the versions in force in a slice are carried into it from before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimkeeper.functions import quoted, require_columns, require_free, tracked_columns


def _slices(facts: DataFrame, keys: Sequence[str], date: str, limit: int) -> DataFrame:
    """(keys, slices): for keys with more than ``limit`` facts, where each slice of time begins and
    over how many shares its facts are dealt. Slices follow the numbers of facts by day, so there are
    about facts / limit rows and borders in all, however the facts are spread."""
    names = [F.col(k) for k in keys]
    hot = facts.groupBy(*names).agg(F.count(F.lit(1)).alias("asof__n")).where(F.col("asof__n") > limit).select(*names)
    days = facts.join(hot, list(keys), "left_semi").groupBy(*names, F.col(date).alias("asof__day")).agg(F.count(F.lit(1)).alias("asof__n"))
    by_key = ", ".join(quoted(k) for k in keys)
    # A day belongs to the slice that its first fact falls into; one of more than ``limit`` facts gets several shares.
    upto = f"sum(asof__n) OVER (PARTITION BY {by_key} ORDER BY asof__day) - asof__n"
    slices = days.selectExpr("*", f"({upto}) div {limit} AS asof__slice").groupBy(*names, "asof__slice")
    slices = slices.agg(F.min("asof__day").alias("begins"), F.ceil(F.sum("asof__n") / F.lit(limit)).cast("int").alias("shares"))
    return slices.groupBy(*names).agg(F.array_sort(F.collect_list(F.struct("begins", "shares"))).alias("asof__slices"))


def facts_as_of(
    facts: DataFrame,
    dimension: DataFrame,
    keys: Sequence[str],
    date: str,
    attributes: Sequence[str] | None = None,
    start_col: str = "start_date",
    end_col: str = "end_date",
    hot: int = 5_000_000,
) -> DataFrame:
    """``facts`` with the ``attributes`` (default: all but keys and dates) of the version valid on ``date``.

    A version is valid for ``start <= date < end``; versions of a key do not overlap, as type 2 keeps
    them. Facts before the first version, in a gap or after the last one, with an unknown or NULL key
    or without a date get NULL attributes; no fact is lost or repeated. Versions that hold for no day are
    ignored. A key with more than ``hot`` facts is dealt by time, a day of more than ``hot`` facts also at random.
    """
    keys, names = list(keys), [quoted(k) for k in keys]
    if attributes is None:
        attributes = tracked_columns(dimension, [*keys, start_col, end_col])
    require_columns(facts, [*keys, date], "facts")
    require_columns(dimension, [*keys, *attributes, start_col, end_col], "dimension")
    require_free(attributes, facts.columns, "facts with attributes")
    fact, version = F.struct(*[F.col(quoted(c)) for c in facts.columns]), F.struct(*[F.col(quoted(c)) for c in [*attributes, end_col]])

    known = " AND ".join(f"{quoted(c)} IS NOT NULL" for c in [*keys, date])
    whole = facts.where(known)
    slices = _slices(whole.select(*names, quoted(date)), keys, date, hot)
    # Where no key is hot ``slices`` is empty, and adaptive execution drops both joins.
    dealt = whole.select(*[F.col(n) for n in names], F.col(quoted(date)).alias("asof__at"), fact.alias("asof__fact")).join(slices, keys, "left")
    begun = "filter(asof__slices, s -> s.begins <= asof__at)"
    share = "pmod(xxhash64(asof__fact), element_at(asof__slices, asof__slice).shares)"
    dealt = dealt.withColumn("asof__slice", F.expr(f"coalesce(size({begun}), 0)")).withColumn("asof__share", F.expr(f"IF(asof__slice > 0, {share}, 0)").cast("int"))

    valid = dimension.where(F.col(quoted(start_col)) < F.col(quoted(end_col)))
    valid = valid.select(*[F.col(n) for n in names], F.col(quoted(start_col)).alias("asof__at"), F.col(quoted(end_col)).alias("asof__until"), version.alias("asof__version"))
    # The slices that a version reaches into: from the one it begins in to the last that begins before its end.
    first = f"greatest(1, size({begun}))"
    last = "size(filter(asof__slices, s -> s.begins < asof__until))"
    reach = f"IF(asof__slices IS NULL, array(0), IF({last} < {first}, array(), sequence({first}, {last})))"
    shares = "IF(asof__slice = 0, array(0), sequence(0, element_at(asof__slices, IF(asof__slice = 0, 1, asof__slice)).shares - 1))"
    spread = valid.join(slices, keys, "left").withColumn("asof__slice", F.explode(F.expr(reach))).withColumn("asof__share", F.explode(F.expr(shares)))

    columns = [*[F.col(n) for n in names], "asof__slice", "asof__share", "asof__at"]
    both = dealt.select(*columns, F.lit(1).alias("asof__kind"), "asof__fact").unionByName(
        spread.select(*columns, F.lit(0).alias("asof__kind"), "asof__version"), allowMissingColumns=True
    )
    group = ", ".join([*names, "asof__slice", "asof__share"])
    in_force = f"last_value(asof__version) IGNORE NULLS OVER (PARTITION BY {group} ORDER BY asof__at, asof__kind ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    found = both.selectExpr("asof__kind", "asof__at", "asof__fact", f"{in_force} AS asof__found").where("asof__kind = 1")
    holds = f"asof__at < asof__found.{quoted(end_col)}"
    result = found.selectExpr("asof__fact.*", *[f"IF({holds}, asof__found.{quoted(a)}, NULL) AS {quoted(a)}" for a in attributes])
    kinds = {f.name: f.dataType.simpleString() for f in dimension.schema.fields}
    rest = facts.where(f"NOT ({known})").selectExpr("*", *[f"CAST(NULL AS {kinds[a]}) AS {quoted(a)}" for a in attributes])
    return result.unionByName(rest)
