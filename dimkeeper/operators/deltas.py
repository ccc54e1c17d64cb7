"""Stored aggregates kept up by changes, without reading the facts again."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimkeeper.functions import quoted, require_columns, require_free
from dimkeeper.operators.diff import match_snapshots


def change_images(old: DataFrame, new: DataFrame, keys: Sequence[str], tracked: Sequence[str] | None = None) -> DataFrame:
    """Changed rows as ``op, keys, before, after``; the images are structs of the other columns, NULL where there is none."""
    m = match_snapshots(old, new, keys, tracked)
    require_free(["op", "before", "after"], m.keys, "change images")
    image = lambda side: "struct(" + ", ".join(f"{side(c)} AS {quoted(c)}" for c in m.tracked) + ")"
    op = f"CASE WHEN {m.only_new} THEN 'I' WHEN {m.only_old} THEN 'D' ELSE 'U' END AS op"
    before, after = f"IF({m.in_old}, {image(m.old)}, NULL) AS before", f"IF({m.in_new}, {image(m.new)}, NULL) AS after"
    return m.rows.where(f"NOT ({m.both} AND {m.same})").selectExpr(op, *[quoted(k) for k in m.keys], before, after)


def _exact(sums: Mapping[str, Column], df: DataFrame) -> None:
    for f in df.schema.fields:
        if f.name in sums and f.dataType.typeName() in ("double", "float"):
            raise TypeError(f"{f.name}: sums of {f.dataType.typeName()} drift when rows are taken out again; use a decimal")


def aggregate(facts: DataFrame, grain: Mapping[str, Column], sums: Mapping[str, Column], count_col: str = "n_facts") -> DataFrame:
    """Sums by grain with the number of facts, as ``apply_deltas`` keeps them; a NULL measure counts as 0."""
    rows = facts.select(*[col.alias(n) for n, col in grain.items()], *[F.coalesce(col, F.lit(0)).alias(n) for n, col in sums.items()])
    _exact(sums, rows)
    return rows.groupBy(*grain).agg(F.count(F.lit(1)).alias(count_col), *[F.sum(n).alias(n) for n in sums])


def delta_sums(changes: DataFrame, grain: Mapping[str, Column], sums: Mapping[str, Column], count_col: str = "n_facts") -> DataFrame:
    """What changes (see ``change_images``) add to each group: after images count plus, before images minus.

    ``grain`` and ``sums`` are over the image's columns. Groups that come out even are left out.
    """
    signed = changes.selectExpr("explode(array(struct(-1 AS sign, before AS image), struct(1 AS sign, after AS image))) AS delta")
    rows = signed.where("delta.image IS NOT NULL").selectExpr("delta.sign AS delta__sign", "delta.image.*")
    measures = [F.coalesce(col, F.lit(0)).alias(n) for n, col in sums.items()]
    rows = rows.select("delta__sign", *[col.alias(n) for n, col in grain.items()], *measures)
    _exact(sums, rows)
    each = [F.sum(F.when(F.col("delta__sign") > 0, F.col(n)).otherwise(-F.col(n))).alias(n) for n in sums]
    out = rows.groupBy(*grain).agg(F.sum("delta__sign").alias(count_col), *each)
    return out.where(" OR ".join(f"{quoted(n)} <> 0" for n in [count_col, *sums]))


def apply_deltas(stored: DataFrame, deltas: DataFrame, grain: Sequence[str], sums: Sequence[str], count_col: str = "n_facts") -> DataFrame:
    """The stored aggregate after the deltas; a group whose number of facts reaches 0 goes, a new one comes.

    NULL is a group like any other. Only groups that a delta names are recomputed; where they are few AQE
    broadcasts them, and the stored aggregate is not shuffled. A number of facts below 0 is an error: the deltas
    are not those of the stored aggregate.
    """
    grain, sums = list(grain), list(sums)
    require_columns(stored, [*grain, count_col, *sums], "stored aggregate")
    require_columns(deltas, [*grain, count_col, *sums], "deltas")
    columns = [*grain, count_col, *sums]
    plus = deltas.selectExpr(*[quoted(g) for g in grain], *[f"{quoted(c)} AS {quoted(f'delta__{c}')}" for c in [count_col, *sums]])
    on = [stored[g].eqNullSafe(plus[g]) for g in grain]
    kept = stored.join(plus, on, "left_anti").select(*columns)
    kinds = {f.name: f.dataType.simpleString() for f in stored.schema.fields}
    old = stored.selectExpr(*[quoted(g) for g in grain], *[f"{quoted(c)} AS {quoted(f'old__{c}')}" for c in [count_col, *sums]])
    met = plus.join(old, [plus[g].eqNullSafe(old[g]) for g in grain], "left")
    totals = [
        (F.coalesce(F.col(f"old__{c}"), F.lit(0)) + F.col(f"delta__{c}")).cast(kinds[c]).alias(c) for c in [count_col, *sums]
    ]
    changed = met.select(*[plus[g] for g in grain], *totals)
    below = "raise_error('deltas take out more facts than the stored aggregate has')"
    n = quoted(count_col)
    return kept.unionByName(changed.where(f"CASE WHEN {n} < 0 THEN CAST({below} AS boolean) ELSE {n} > 0 END"))
