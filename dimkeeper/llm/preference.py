"""Preference formatting: chosen and rejected conversations with their common prompt, and loss masks.

Built-in expressions only.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimkeeper.llm.arrays import running

TURNS = "array<struct<turn:bigint,role:string,text:string>>"


def conversations(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order; ties go by role, then text. Null role and text are empty.

    Turns with a null conv_id belong to no known conversation and to no row.
    """
    one = F.struct(
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    named = turns.select(F.col(conv_id).alias("conv_id"), one.alias("one")).where("conv_id IS NOT NULL")
    return named.groupBy("conv_id").agg(F.array_sort(F.collect_list("one")).alias("turns"))


def rendered(turn: Column, begin: str, middle: str, end: str) -> Column:
    return F.concat(F.lit(begin), turn["role"], F.lit(middle), turn["text"], F.lit(end))


def escaped(text: Column, marks: tuple[str, ...]) -> Column:
    """Text in which no mark occurs: a backslash goes behind a mark's first character, or one more behind those there.

    So different texts stay different, and taking one backslash out of each such place gives the text back.
    """
    for mark in marks:
        pattern = f"{re.escape(mark[0])}(\\\\*){re.escape(mark[1:])}"
        text = F.regexp_replace(text, pattern, re.sub(r"([\\\\$])", r"\\\1", mark[0]) + "$1\\\\" + re.sub(r"([\\\\$])", r"\\\1", mark[1:]))
    return text


def _completion(turns: Column, role: str, begin: str, middle: str, end: str) -> tuple[Column, Column]:
    """The rendered turns, and the places (start, end) of what is trained on: text and end mark of the role's turns."""
    whole = F.array_join(F.transform(turns, lambda t: rendered(t, begin, middle, end)), "")
    marks = len(begin) + len(middle) + len(end)
    ends = running(F.transform(turns, lambda t: F.length(t["role"]) + F.length(t["text"]) + marks), 0, lambda a, b: a + b)
    said = F.filter(F.arrays_zip(turns.alias("said"), ends.alias("stop")), lambda x: x["said"]["role"] == role)
    spans = F.transform(said, lambda x: F.struct((x["stop"] - len(end) - F.length(x["said"]["text"])).alias("start"), x["stop"].alias("end")))
    return whole, spans


def common_turns(a: Column, b: Column) -> Column:
    """Number of turns, from the first on, that agree in role and text."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce((x["role"] == y["role"]) & (x["text"] == y["text"]), F.lit(False)))
    return F.coalesce(F.nullif(F.array_position(same, False), F.lit(0)) - 1, F.size(same).cast("long"))


def format_preferences(
    pairs: DataFrame, begin: str = "<|", middle: str = "|>\n", end: str = "<|end|>\n", role: str = "assistant", marks: tuple[str, ...] = ("<|",)
) -> DataFrame:
    """Render pairs of conversations: the longest common turn prefix once, then each side's own turns.

    ``pairs`` has chosen and rejected, arrays of (turn, role, text) in order; its other columns stay.
    Adds n_common, prompt, chosen_text, rejected_text and chosen_mask, rejected_mask: places (code
    points, end exclusive) in the completions that are trained on, the text and end mark of each turn
    of ``role``.

    What a role or a text has of ``marks`` (two characters or more each) is escaped by a backslash, so no text
    can look like the begin or end of a turn; the masks are over the escaped text.

    * equal conversations: all turns are the prompt, the completions are empty
    * a null side is an empty conversation; two of them give an empty prompt
    * no common turn: an empty prompt
    """
    empty = F.array().cast(TURNS)
    clean = lambda t: F.struct(t["turn"].alias("turn"), escaped(t["role"], marks).alias("role"), escaped(t["text"], marks).alias("text"))
    sides = {s: F.transform(F.coalesce(F.col(s), empty), clean) for s in ("chosen", "rejected")}
    with_prefix = pairs.withColumns(sides).withColumn("n_common", common_turns(F.col("chosen"), F.col("rejected")))
    n = F.col("n_common").cast("int")
    prompt = F.array_join(F.transform(F.slice("chosen", F.lit(1), n), lambda t: rendered(t, begin, middle, end)), "")
    out = with_prefix.withColumn("prompt", prompt)
    for side in sides:
        rest = F.slice(F.col(side), n + 1, F.greatest(F.size(side) - n, F.lit(0)))
        whole, spans = _completion(rest, role, begin, middle, end)
        out = out.withColumn(f"{side}_text", whole).withColumn(f"{side}_mask", spans)
    return out.drop("chosen", "rejected")


def last_place(turns: Column, role: str) -> Column:
    """Place, from 1 on, of the last turn of ``role``; null without one."""
    return F.array_max(F.filter(F.transform(turns, lambda t, i: F.when(t["role"] == role, i + 1)), lambda i: i.isNotNull()))


def pair_by_opening(talks: DataFrame, role: str = "assistant") -> DataFrame:
    """(conv_id, chosen_id, chosen, rejected) from (conv_id, turns).

    Conversations with one first turn answer the same opening. The chosen one has most characters in
    turns of ``role``, among equals the smallest id; every other one is rejected against it, so a group
    of n gives n - 1 pairs. A conversation without a counterpart is chosen against what precedes its
    last turn of ``role`` (all of it, without such a turn): one conv_id is in each row, that of the
    rejected conversation or of the one alone.

    Only ids and sizes meet in the group of an opening, and they are summed before the shuffle; turns
    join by the id of their conversation, those of the chosen in a join that Spark splits where one opening is frequent.
    """
    said = F.aggregate(F.filter("turns", lambda t: t["role"] == role), F.lit(0), lambda n, t: n + F.length(t["text"]))
    first = F.element_at("turns", 1)
    keyed = talks.select("conv_id", F.sha2(F.concat(first["role"], F.lit("\x1f"), first["text"]), 256).alias("opening"), said.alias("said"))
    best = keyed.groupBy("opening").agg(F.min(F.struct((-F.col("said")).alias("less"), F.col("conv_id").alias("id"))).alias("best"), F.count(F.lit(1)).alias("n"))
    ids = keyed.join(best.select("opening", F.col("best.id").alias("chosen_id"), "n"), "opening").select("conv_id", "chosen_id", "n")
    ranked = talks.select("conv_id", "turns").join(ids, "conv_id")
    several = ranked.where("n > 1 AND conv_id <> chosen_id").select("conv_id", "chosen_id", F.col("turns").alias("rejected"))
    chosen = talks.select(F.col("conv_id").alias("chosen_id"), F.col("turns").alias("chosen"))
    pairs = several.join(chosen, "chosen_id").select("conv_id", "chosen_id", "chosen", "rejected")
    last = F.coalesce(last_place(F.col("turns"), role) - 1, F.size("turns"))
    alone = ranked.where("n = 1").select("conv_id", F.col("conv_id").alias("chosen_id"), F.col("turns").alias("chosen"), F.slice("turns", F.lit(1), last).alias("rejected"))
    return pairs.unionByName(alone)


def other_replies(talks: DataFrame, role: str = "assistant", ring: int = 1024) -> DataFrame:
    """(reply_key, drawn): for each different last reply of ``role`` another one, the next in a ring of about ``ring``.

    Rings are dealt by a hash and ordered by another, so a reply's next one is of any conversation. Empty
    replies are not drawn. Where no other reply exists, there is no row.
    """
    said = talks.select(F.element_at("turns", last_place(F.col("turns"), role))["text"].alias("reply")).where("reply <> ''").distinct()
    rings = said.agg(F.expr(f"count(1) div {ring} + 1").alias("rings"))
    keyed = said.crossJoin(rings).select("reply", F.sha2("reply", 256).alias("reply_key"), F.pmod(F.xxhash64("reply"), F.col("rings")).alias("ring"))
    around = Window.partitionBy("ring").orderBy("reply_key")
    drawn = F.coalesce(F.lead("reply").over(around), F.first("reply").over(around))
    return keyed.select("reply_key", "reply", drawn.alias("drawn")).where("drawn <> reply").drop("reply")


def pair_replies(talks: DataFrame, role: str = "assistant") -> DataFrame:
    """(conv_id, chosen_id, chosen, rejected): ``pair_by_opening``, with a reply on both sides of each pair.

    Where a side of such a pair has no turn of ``role`` after the common ones (a conversation without a
    counterpart, equal ones, one that goes on where the other ends), the conversation of conv_id itself is
    chosen, and rejected are its turns before its last turn of ``role`` with a reply from elsewhere in that
    turn's place. So the prompt ends before that turn, and both completions are trained on.

    * no turn of ``role``, an empty last one, or no other reply in the table: the pair of ``pair_by_opening``
    * equal replies are drawn for alike; a drawn one always differs from the reply it is set against
    """
    pairs = pair_by_opening(talks, role)
    n = common_turns(F.col("chosen"), F.col("rejected")).cast("int")
    answers = [F.exists(F.slice(s, n + 1, F.greatest(F.size(s) - n, F.lit(0))), lambda t: t["role"] == role) for s in ("chosen", "rejected")]
    own = F.when(F.col("conv_id") == F.col("chosen_id"), F.col("chosen")).otherwise(F.col("rejected"))
    cases = pairs.withColumn("turns", F.when(~(answers[0] & answers[1]), own)).withColumn("place", last_place(F.col("turns"), role))
    # Pairs that stay have keys of their own, so that they do not meet in one task.
    key = F.coalesce(F.sha2(F.element_at("turns", F.col("place"))["text"], 256), F.concat(F.lit("-"), F.col("conv_id").cast("string")))
    met = cases.withColumn("reply_key", key).join(other_replies(talks, role), "reply_key", "left")
    replaced = F.col("drawn").isNotNull()
    there = F.element_at("turns", F.col("place"))
    other = F.array(F.struct(there["turn"].alias("turn"), there["role"].alias("role"), F.col("drawn").alias("text")))
    return met.select(
        "conv_id",
        F.when(replaced, F.col("conv_id")).otherwise(F.col("chosen_id")).alias("chosen_id"),
        F.when(replaced, F.col("turns")).otherwise(F.col("chosen")).alias("chosen"),
        F.when(replaced, F.concat(F.slice("turns", F.lit(1), F.col("place") - 1), other)).otherwise(F.col("rejected")).alias("rejected"),
    )
