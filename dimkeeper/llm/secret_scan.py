"""Secret scans: fixed patterns, and random-looking strings by the likelihood ratio of Markov models.

Built-in expressions only. Places come from splitting a text at the matches of a pattern: lengths of
the pieces between and of the matches add up to code-point offsets. Sums and maxima over the spans of
a text are taken by doubling, and pieces of a text are cut from blocks of it, so that the work grows in
proportion to the length of a text (times the logarithm of the number of its spans).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimkeeper.llm.arrays import before, let, running

# The base patterns, their kinds in the order in which they are listed, least lengths.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
KINDS = ("assign", "access", "hex", "markov")
ASSIGN_LENGTH, ACCESS_LENGTH, HEX_LENGTH = 12, 18, 16

#: Characters of strings that the models judge; any other character ends a string.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
STRING = "[A-Za-z0-9+/_=-]"

SPANS = "array<struct<start:int,kind:int,end:int>>"


#: Characters of a block that pieces of a text are cut from; a place in a string is found by counting from its start.
BLOCK = 512

STRUCT = "struct<start:int,kind:int,end:int>"


def _matches(text: Column, pattern: str, kind: int, group: int, least: int) -> Column:
    """Matches of which the group has a least length, as (span, hit: the matched text)."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    valued = hits if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))

    def found(p: Column) -> Column:
        span = F.struct((p["end"] - F.length(p["hit"])).alias("start"), F.lit(kind).alias("kind"), p["end"].alias("end"))
        return F.struct(span.cast(STRUCT).alias("span"), p["hit"].alias("hit"))

    def located(m: Column) -> Column:
        lengths = F.zip_with(m["hits"], m["gaps"], lambda hit, gap: F.length(hit) + F.length(gap))  # a last gap without a hit: null
        parts = F.arrays_zip(m["hits"].alias("hit"), m["values"].alias("value"), running(lengths, 0, lambda a, b: a + b).alias("end"))
        return F.transform(F.filter(parts, lambda p: F.length(p["value"]) >= least), found)

    return let(F.struct(hits.alias("hits"), valued.alias("values"), F.split(text, pattern, -1).alias("gaps")), located)


def _places(text: Column, pattern: str, kind: int, group: int, least: int) -> Column:
    """The spans (start, kind, end) alone."""
    return F.transform(_matches(text, pattern, kind, group, least), lambda m: m["span"])


def _blocks(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def _piece(blocks: Column, start: Column, end: Column) -> Column:
    """The text from one code point to another, from its blocks."""
    first = F.floor(start / BLOCK).cast("int")
    last = F.floor((end - 1) / BLOCK).cast("int")
    near = F.array_join(F.slice(blocks, first + 1, F.greatest(last - first + 1, F.lit(0))), "")
    return F.when(end > start, F.substring(near, start - first * BLOCK + 1, end - start)).otherwise("")


def _none() -> Column:
    return F.array().cast(SPANS)


def base_spans(text: Column) -> dict[str, Column]:
    """Arrays of (start, kind, end) by kind; a cheap test spares most texts the costly pattern."""
    low = F.lower(text)
    named = F.lit(False)
    for word in ("password", "passwd", "secret", "token", "api_key", "apikey"):
        named = named | low.contains(word)
    return {
        "assign": F.when(named, _places(text, ASSIGN, 0, 2, ASSIGN_LENGTH)).otherwise(_none()),
        "access": F.when(text.contains("AKIA"), _places(text, ACCESS, 1, 0, ACCESS_LENGTH)).otherwise(_none()),
        # A run is matched whole, so that a shorter one can be left out of the pattern at once.
        "hex": F.when(text.rlike(f"[0-9a-f]{{{HEX_LENGTH}}}"), _places(text, f"[0-9a-f]{{{HEX_LENGTH},}}", 2, 0, HEX_LENGTH)).otherwise(_none()),
    }


def with_base(docs: DataFrame, text: str) -> DataFrame:
    found = base_spans(F.col(text))
    return docs.select(*docs.columns, *(column.alias(f"{kind}_spans") for kind, column in found.items()))


def samples(found: DataFrame, text: str) -> DataFrame:
    """(string, label): values of base matches as random strings, 1, and the other long strings of the same texts, 0."""
    hits = found.where("size(assign_spans) + size(access_spans) + size(hex_spans) > 0")
    spans = F.concat("assign_spans", "access_spans", "hex_spans")
    body = F.col(text)
    cut = let(_blocks(body), lambda blocks: F.transform(spans, lambda s: _piece(blocks, s["start"], s["end"])))
    value = F.transform(cut, lambda c: F.regexp_extract(c, f"({STRING}+)$", 1))
    secret = hits.select(F.explode(value).alias("string"), F.lit(1).alias("label"))
    words = F.regexp_extract_all(body, F.lit(f"{STRING}{{6,}}"), F.lit(0))
    ordinary = hits.select(F.explode(F.array_except(words, value)).alias("string"), F.lit(0).alias("label"))
    return secret.where("length(string) >= 12").unionByName(ordinary)


def train(labelled: DataFrame, smoothing: float = 0.5, backoff: float = 5.0) -> list[float]:
    """Log-likelihood ratios of all character pairs, from labelled strings.

    P(b | a) is the share of b after a, drawn towards the share of b in all pairs by ``backoff``
    pairs. Counts are summed in Spark; what comes to the driver is bounded by the square of the
    alphabet. Without strings of both labels all ratios are 0.
    """
    n = len(ALPHABET)
    chars = F.split("string", "")
    pair = F.zip_with(chars, F.slice(chars, 2, F.length("string")), lambda x, y: F.concat(x, y))
    pairs = labelled.where("length(string) >= 2").select("label", F.explode(pair).alias("pair")).where("length(pair) = 2")
    first, second = (F.instr(F.lit(ALPHABET), F.substring("pair", k, 1)) for k in (1, 2))
    counts = pairs.select("label", first.alias("a"), second.alias("b")).where("a > 0 AND b > 0").groupBy("label", "a", "b").count().collect()
    table = [[[0.0] * n for _ in range(n)] for _ in (0, 1)]
    single = [[smoothing] * n for _ in (0, 1)]
    for label, a, b, k in counts:
        table[label][a - 1][b - 1] += k
        single[label][b - 1] += k
    if {r["label"] for r in counts} != {0, 1}:
        return [0.0] * (n * n)

    def log_p(label: int, a: int, b: int) -> float:
        share = single[label][b] / sum(single[label])
        return math.log((table[label][a][b] + backoff * share) / (sum(table[label][a]) + backoff))

    return [log_p(1, a, b) - log_p(0, a, b) for a in range(n) for b in range(n)]


def likelihood_ratio(string: Column, ratios: list[float]) -> Column:
    """log P(string | random) - log P(string | ordinary), over its character pairs."""
    weights = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")

    def step(acc: Column, char: Column) -> Column:
        code = F.instr(F.lit(ALPHABET), char)
        known = (acc["last"] > 0) & (code > 0) & (F.length(char) > 0)
        gain = F.when(known, F.element_at(weights, (acc["last"] - 1) * len(ALPHABET) + code)).otherwise(0.0)
        return F.struct(F.when(F.length(char) > 0, code).otherwise(0).alias("last"), (acc["sum"] + gain).alias("sum"))

    start = F.struct(F.lit(0).alias("last"), F.lit(0.0).alias("sum"))
    return F.aggregate(F.split(string, ""), start, step, lambda acc: acc["sum"])


def _markov(text: Column, base: Column, ratios: list[float], least: int, threshold: float) -> Column:
    """Long strings with a letter and a digit that look random and touch no (sorted) base span."""

    def random(match: Column) -> Column:
        string = match["hit"]
        mixed = string.rlike("[0-9]") & string.rlike("[A-Za-z]")
        return mixed & F.coalesce(likelihood_ratio(string, ratios) > threshold, F.lit(False))

    found = F.transform(F.filter(_matches(text, f"{STRING}{{{least},}}", 3, 0, least), random), lambda m: m["span"])
    most = (1 << 31) - 1

    def apart(every: Column) -> Column:
        # A string is apart if the base spans before it end by its start, and the next one begins after it.
        ended = before(running(F.transform(every, lambda s: F.when(s["kind"] < 3, s["end"]).otherwise(0)), 0, F.greatest), 0)
        begins = F.transform(F.reverse(every), lambda s: F.when(s["kind"] < 3, s["start"]).otherwise(most))
        following = F.reverse(before(running(begins, most, F.least), most))
        beside = F.arrays_zip(every.alias("span"), ended.alias("ended"), following.alias("next"))
        free = F.filter(beside, lambda x: (x["span"]["kind"] == 3) & (x["ended"] <= x["span"]["start"]) & (x["next"] >= x["span"]["end"]))
        return F.transform(free, lambda x: x["span"])

    return F.when(text.rlike(f"{STRING}{{{least}}}"), let(F.array_sort(F.concat(base, found)), apart)).otherwise(_none())


def joined(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"], s["end"])), ",")


def find_secrets(docs: DataFrame, text: str = "text", labelled: DataFrame | None = None, least: int = 20, threshold: float = 10.0) -> DataFrame:
    """``docs`` with the columns base_spans and secret_spans: arrays of (start, kind, end), sorted.

    ``kind`` is a place in ``KINDS``; places are code points, the end exclusive. Base spans are the
    matches of the fixed patterns. To these the models add strings of ``least`` or more characters
    with letters and digits whose log-likelihood ratio is above ``threshold``. ``labelled`` holds
    the samples (string, label: 1 random, 0 ordinary); by default the base matches of ``docs`` and
    the other strings of the same texts.

    * null or empty text: no spans; repeated rows: each has its result
    * no labelled samples of one kind: base spans only
    * other columns of ``docs`` stay; one with the name of a new column is replaced
    """
    kept = [c for c in docs.columns if c not in ("base_spans", "secret_spans")]
    body = docs.select(F.struct(*kept).alias("doc"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("__body"))
    found = with_base(body, "__body")
    ratios = train(samples(with_base(body.select("__body"), "__body"), "__body") if labelled is None else labelled)
    base = found.withColumn("base_spans", F.array_sort(F.concat("assign_spans", "access_spans", "hex_spans")))
    more = _markov(F.col("__body"), F.col("base_spans"), ratios, least, threshold)
    both = base.withColumn("secret_spans", F.array_sort(F.concat("base_spans", more)))
    return both.select("doc.*", "base_spans", "secret_spans")


def redacted(text: Column, spans: Column, label: str = "[SECRET]") -> Column:
    """The text with each stretch of sorted spans, where they overlap their union, replaced by a label."""
    ends = running(F.transform(spans, lambda s: s["end"]), 0, F.greatest)

    def cut(x: Column) -> Column:
        beside = F.arrays_zip(spans.alias("span"), before(x["ends"], 0).alias("ended"))
        first = F.filter(beside, lambda s: s["span"]["start"] >= s["ended"])  # of each union
        pieces = F.transform(first, lambda s: F.concat(_piece(x["blocks"], s["ended"], s["span"]["start"]), F.lit(label)))
        return F.concat(F.array_join(pieces, ""), _piece(x["blocks"], F.element_at(x["ends"], -1), F.length(text)))

    return F.when(F.size(spans) > 0, let(F.struct(_blocks(text).alias("blocks"), ends.alias("ends")), cut)).otherwise(text)
