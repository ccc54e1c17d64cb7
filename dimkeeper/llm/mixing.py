"""Mixing sources to target weights: iterative proportional fitting, then a calibrated draw of documents."""

from __future__ import annotations

import warnings
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimkeeper.sources.scratch import materialise

MARGINS = ("source", "lang", "topic")

#: Rounds between two looks at the margins; one plan.
_ROUNDS_AT_ONCE = 4

NEW = ("topic", "n_tokens", "factor", "copies")


def n_tokens(text: Column) -> Column:
    """Words without ASCII white space; null or empty text has none."""
    body = F.trim(F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), "[\\x09-\\x0D\\x20]+", " "))
    return F.when(body == "", 0).otherwise(F.size(F.split(body, " "))).cast("long")


def form_topic(text: Column) -> Column:
    """A coarse topic where no column names one: what kind of text the first marks of the whole text tell."""
    body = F.coalesce(text.cast("string"), F.lit(""))
    n = F.greatest(F.length(body), F.lit(1))
    of = lambda chars: F.length(F.regexp_replace(body, f"[^{chars}]+", "")) / n
    return (
        F.when(body.contains(" | "), "table")
        .when(of("0-9") > 0.05, "numeric")
        .when(of("!#$%&*") > 0.05, "noisy")
        .when(F.length(body) < 400, "note")
        .when(F.length(body) < 4000, "article")
        .otherwise("book")
    )


def tempered(cells: DataFrame, margin: str, power: float) -> DataFrame:
    """(margin, target): shares in proportion to the ``power``-th power of the tokens."""
    sums = cells.groupBy(margin).agg(F.sum("tokens").alias("n"))
    return sums.select(margin, F.pow("n", F.lit(power)).alias("target"))


def margin_gaps(fitted: DataFrame, margins: list[str], total: float) -> dict[str, float]:
    """Of each margin the largest relative gap between a value's weight and its target."""
    gaps = {}
    for margin in margins:
        sums = fitted.groupBy(margin).agg(F.sum("weight").alias("have"), F.first(f"__{margin}").alias("share")).where("share > 0")
        gaps[margin] = sums.agg(F.max(F.abs(F.col("have") / (F.col("share") * F.lit(total)) - 1))).first()[0] or 0.0
    return gaps


def fit(cells: DataFrame, targets: Mapping[str, DataFrame], rounds: int = 200, tolerance: float = 1e-3, strict: bool = False) -> DataFrame:
    """Rake the cells' tokens to the target shares of each margin.

    ``cells`` has one row for each combination of the margins, with its tokens; ``targets`` gives
    (margin, target), in any scale. A value without a target gets none of the weight; a target
    without tokens cannot be met and the others keep their proportions. Each round scales the
    weights to one margin after the other. Adds weight, of which the sum is that of the tokens.

    Rounds go on until no value's weight is off its target by more than ``tolerance`` of it. Targets that
    cannot be met together (the gap no longer shrinks, or ``rounds`` are over) are an error with ``strict``;
    else a warning names the margins and how far they are off, and the margin raked last is met.
    """
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    table = cells.where("tokens > 0").withColumn("weight", F.col("tokens").cast("double"))
    shares = []
    for margin, target in targets.items():
        met = target.join(table.select(margin).distinct(), target[margin].eqNullSafe(table[margin]), "left_semi")
        whole = met.agg(F.sum("target")).first()[0] or 1.0
        share = met.select(F.col(margin).alias("__value"), (F.col("target") / F.lit(float(whole))).alias(f"__{margin}"))
        table = table.join(share, table[margin].eqNullSafe(share["__value"]), "left").drop("__value").fillna(0.0, [f"__{margin}"])
        shares.append(margin)
    table = materialise(table)
    last = float("inf")
    for done in range(0, rounds, _ROUNDS_AT_ONCE):
        for _ in range(_ROUNDS_AT_ONCE):
            for margin in shares:
                have = F.sum("weight").over(Window.partitionBy(margin))
                table = table.withColumn("weight", F.when(have > 0, F.col("weight") * F.lit(float(total)) * F.col(f"__{margin}") / have).otherwise(0.0))
        table = materialise(table)
        gaps = margin_gaps(table, shares, float(total)) if total else {}
        gap = max(gaps.values(), default=0.0)
        if gap <= tolerance:
            break
        if gap > 0.99 * last or done + _ROUNDS_AT_ONCE >= rounds:
            off = ", ".join(f"{m} by {g:.3%}" for m, g in gaps.items() if g > tolerance)
            message = f"the targets cannot be met together: after {done + _ROUNDS_AT_ONCE} rounds a value is off its target in {off}"
            if strict:
                raise ValueError(message)
            warnings.warn(message, stacklevel=2)
            break
        last = gap
    return table.drop(*(f"__{m}" for m in shares))


def mix_sources(
    docs: DataFrame,
    targets: Mapping[str, Mapping[str, float]] | None = None,
    power: float = 0.7,
    budget: float = 1.0,
    rounds: int = 200,
    tolerance: float = 1e-3,
    strict: bool = False,
    seed: int = 1,
    source: str = "source",
    lang: str = "lang",
    topic: str | None = None,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """Weights and a calibrated draw of documents to target shares of source, language and topic.

    Tokens are summed by cell (source, lang, topic), the cells' weights are raked to the targets, and a
    document of a cell is drawn ``weight / tokens * budget`` times on average: so often for sure as
    that has whole parts, and once more with the rest as probability, decided by a hash of its id. The
    expected tokens of every margin's value thus meet its target within ``tolerance``; where the targets contradict
    each other, ``fit`` warns, or with ``strict`` fails.

    ``targets`` maps source, lang or topic to shares by value; without it a margin's target is the
    ``power``-th power of its tokens. ``topic`` names a column; without it the form of the text counts.
    The rows of ``docs`` with topic, n_tokens, factor and copies.

    * null or empty text: no tokens, factor 1 if nothing else of its cell has tokens
    * null source, lang or topic: a value of its own
    * repeated rows: drawn alike, as the draw follows the id; a null id counts as one more id
    * values without a target: factor 0, never drawn
    * a column of ``docs`` with the name of a new one is replaced
    """
    kind = F.col(topic).cast("string") if topic else form_topic(F.col(text))
    names = {"source": F.col(source), "lang": F.col(lang), "topic": kind}
    keyed = docs.select(*(c.alias(f"__{m}") for m, c in names.items()), n_tokens(F.col(text)).alias("tokens"))
    cells = materialise(keyed.groupBy(*(F.col(f"__{m}").alias(m) for m in MARGINS)).agg(F.sum("tokens").alias("tokens")))
    spark = docs.sparkSession
    wanted = {}
    for margin in MARGINS:
        if targets and margin in targets:
            wanted[margin] = spark.createDataFrame([(v, float(x)) for v, x in targets[margin].items()], f"{margin} string, target double")
        else:
            wanted[margin] = tempered(cells, margin, power)
    fitted = fit(cells, wanted, rounds, tolerance, strict).select(*(F.col(m).alias(f"__cell_{m}") for m in MARGINS), (F.col("weight") / F.col("tokens")).alias("__factor"))
    rows = docs.select(*(c for c in docs.columns if c not in NEW), *(c.alias(f"__{m}") for m, c in names.items()), n_tokens(F.col(text)).alias("n_tokens"))
    same = [F.col(f"__{m}").eqNullSafe(F.col(f"__cell_{m}")) for m in MARGINS]
    mixed = rows.join(fitted, same[0] & same[1] & same[2], "left").withColumn("factor", F.coalesce("__factor", F.lit(1.0)))
    draw = F.pmod(F.xxhash64(doc_id, F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    often = F.col("factor") * budget
    copies = (F.floor(often) + F.when(draw < often - F.floor(often), 1).otherwise(0)).cast("long")
    return mixed.select(*(c for c in docs.columns if c not in NEW), F.col("__topic").alias("topic"), "n_tokens", "factor", copies.alias("copies"))
