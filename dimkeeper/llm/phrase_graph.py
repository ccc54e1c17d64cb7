"""Collocations from a weighted de Bruijn graph of words.

Nodes are stretches of three words, edges are stretches of four that lead from their first three to
their last three. Only edges are counted in the texts, and what a piece of text ends with: its last
three, two and one words, which no edge starts with. All shorter counts follow from the flow: a
stretch of k words occurs as often as all stretches of k + 1 words that start with it, and once more
for each piece that ends with it. So the texts' words are shuffled once, as counted edges.

Where all that enters a node comes by one edge and all that leaves it goes by one edge, the two have
one count; such unary paths are compacted into one fixed expression.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimkeeper.llm import shuffle as sh
from dimkeeper.llm import text as tx
from dimkeeper.llm.periodic_runs import ranges
from dimkeeper.llm.ship import ship
from dimkeeper.sources.scratch import materialise

#: Words of an edge.
EDGE = 4
#: Words that a task counts before it sends them.
FLUSH = 1_000_000
#: Shares in which the phrases of a language are ranked before they are ranked together.
_SHARES = 64

#: Pieces end at ``[.,;:!?\x0A-\x0D]``; their words are ``[^\x20\x09]+``.
_BREAKS = ~tx.separators((0x0A, 0x0D), *((ord(c), ord(c)) for c in ".,;:!?"))
_WORDS = tx.separators((0x20, 0x20), (0x09, 0x0D), *((ord(c), ord(c)) for c in ".,;:!?"))

_PACKED = [("lang", pa.string()), ("bucket", pa.int32()), *((n, pa.binary()) for n in ("places", "sizes", "body", "counts"))]
_COUNTED = [("phrase", pa.string()), ("words", pa.int32()), ("f", pa.int64())]
PACKED = "lang string, bucket int, places binary, sizes binary, body binary, counts binary"
COUNTED = PACKED + ", phrase string, words int, f long"


@dataclass
class Grams:
    """Counted stretches of up to ``EDGE`` words of one language."""

    words: np.ndarray  # numbers in the vocabulary; -1 beyond the last word
    counts: np.ndarray
    vocabulary: pa.Array

    def pick(self, which: np.ndarray) -> Grams:
        return Grams(self.words[which], self.counts[which], self.vocabulary)

    def of_words(self, low: int, high: int) -> Grams:
        n = (self.words >= 0).sum(axis=1)
        return self.pick(np.flatnonzero((n >= low) & (n <= high)))

    def prefixes(self, k: int) -> Grams:
        words = self.words.copy()
        words[:, k:] = -1
        return Grams(words, self.counts, self.vocabulary)

    def joined(self, other: Grams) -> Grams:
        """``other`` has the same vocabulary."""
        return Grams(np.concatenate([self.words, other.words]), np.concatenate([self.counts, other.counts]), self.vocabulary)

    def summed(self) -> Grams:
        """Each stretch once, with the sum of its counts; equal beginnings stand together."""
        if not len(self.counts):
            return self
        base = np.int64(len(self.vocabulary) + 1)
        first, second, third, fourth = (self.words[:, k].astype(np.int64) + 1 for k in range(EDGE))
        # Numbers of pairs keep the key within 64 bits: vocabulary squared times rows, or rows squared.
        tail = pa.array(third * base + fourth).dictionary_encode()
        head = first * base + second
        if int(base) ** 2 * len(tail.dictionary) >= 1 << 62:
            head = pa.array(head).dictionary_encode().indices.to_numpy().astype(np.int64)
        key = head * np.int64(len(tail.dictionary)) + tail.indices.to_numpy()
        order = np.argsort(key)
        at = tx.groups(key[order])[:-1]
        return Grams(self.words[order[at]], np.add.reduceat(self.counts[order], at), self.vocabulary)

    def phrases(self) -> list[str]:
        vocabulary = self.vocabulary.take(pa.array(np.unique(self.words[self.words >= 0]))).to_pylist()
        name = dict(zip(np.unique(self.words[self.words >= 0]).tolist(), vocabulary, strict=True))
        return [b" ".join(name[w] for w in row if w >= 0).decode() for row in self.words.tolist()]


def _hashes(vocabulary: pa.Array) -> np.ndarray:
    """A hash of each word, alike in all tasks; it only deals words to buckets."""
    offsets = np.frombuffer(vocabulary.buffers()[1], np.int64)[vocabulary.offset : vocabulary.offset + len(vocabulary) + 1]
    data = np.frombuffer(vocabulary.buffers()[2], np.uint8)[: offsets[-1]] if vocabulary.buffers()[2] is not None else np.zeros(0, np.uint8)
    return tx.mix(tx.Prefix.of(tx.byte_values(data)).stretch(offsets[:-1], offsets[1:]))


def _body(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The sizes of the words of a column, and their bytes."""
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return np.diff(offsets), data[offsets[0] : offsets[-1]]


def _words_of(sizes: np.ndarray, body: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(body))])


def _packed(grams: Grams, lang: str, lead: int, n_buckets: int) -> dict[str, list]:
    """One row for each bucket; a bucket has all stretches with the same first ``lead`` words."""
    out: dict[str, list] = {n: [] for n, _ in _PACKED}
    if not len(grams.counts):
        return out
    hashes = np.append(_hashes(grams.vocabulary), np.uint64(0))
    key = np.zeros(len(grams.counts), np.uint64)
    for k in range(lead):
        key = tx.mix(key + hashes[grams.words[:, k]] + np.uint64(1))
    bucket = ((key >> np.uint64(16)) % np.uint64(n_buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    at = tx.groups(bucket[order])
    ordered = grams.pick(order)
    flat = ordered.words.ravel()
    sizes, body = _body(grams.vocabulary.take(pa.array(flat[flat >= 0])))
    places = (ordered.words >= 0).sum(axis=1)
    word = np.concatenate([[0], np.cumsum(places)])[at]  # where the words of a bucket begin, and their bytes
    byte = np.concatenate([[0], np.cumsum(sizes)])[word]
    sizes, places = sizes.astype(np.int32), places.astype(np.uint8)
    for k, number in enumerate(bucket[order[at[:-1]]].tolist()):
        grams_of, words_of, bytes_of = (slice(x[k], x[k + 1]) for x in (at, word, byte))
        columns = {"places": places[grams_of], "sizes": sizes[words_of], "body": body[bytes_of], "counts": ordered.counts[grams_of]}
        out["lang"].append(lang)
        out["bucket"].append(number)
        for name, values in columns.items():
            out[name].append(sh.squeezed(values, random=False))
    return out


def _unpacked(table: pa.Table) -> Grams:
    places = sh.released(table, "places", np.uint8).astype(np.int64)
    column = _words_of(sh.released(table, "sizes", np.int32), sh.released(table, "body", np.uint8))
    coded = column.dictionary_encode()
    words = np.full((len(places), EDGE), -1, np.int32)
    words[np.repeat(np.arange(len(places)), places), ranges(np.zeros(len(places), np.int64), places)] = coded.indices.to_numpy()
    return Grams(words, sh.released(table, "counts", np.int64), coded.dictionary)


class _Pieces:
    """Words of one language: their bytes, and how many words of the piece are left from each on."""

    def __init__(self) -> None:
        self.sizes: list[np.ndarray] = []
        self.bodies: list[np.ndarray] = []
        self.left: list[np.ndarray] = []
        self.n = 0

    def add(self, sizes: np.ndarray, body: np.ndarray, left: np.ndarray) -> None:
        self.sizes.append(sizes)
        self.bodies.append(body)
        self.left.append(left)
        self.n += len(sizes)

    def grams(self) -> Grams:
        """At each word the edge that starts there, or what is left of its piece."""
        coded = _words_of(np.concatenate(self.sizes), np.concatenate(self.bodies)).dictionary_encode()
        names, left = coded.indices.to_numpy(), np.concatenate(self.left)
        words = np.full((len(names), EDGE), -1, np.int32)
        for k in range(min(EDGE, len(names))):
            upto = len(names) - k
            words[:upto, k] = np.where(left[:upto] > k, names[k:], -1)
        return Grams(words, np.ones(len(names), np.int64), coded.dictionary).summed()


def _edges(n_buckets: int) -> Callable:
    """Counted edges and piece ends of a task's texts, dealt by their first three words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, _Pieces] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, pieces in held.items():
                yield pa.RecordBatch.from_pydict(_packed(pieces.grams(), lang, EDGE - 1, n_buckets), pa.schema(_PACKED))
            held.clear()

        for batch in batches:
            langs, texts = sh.columns_of(batch, "lang", "text")
            coded = langs.dictionary_encode()
            code, names = coded.indices.to_numpy(), coded.dictionary.to_pylist()
            for chunk in tx.chunks(texts):
                data = tx.lowered(chunk.data)
                found = tx.words(tx.Chunk(chunk.first, chunk.offsets, data), _WORDS)
                if not len(found.start):
                    continue
                piece = np.cumsum(_BREAKS[data])[found.start]
                border = tx.groups(found.row, piece)
                left = np.minimum(EDGE, np.repeat(border[1:], np.diff(border)) - np.arange(len(found.start)))
                of_word = code[chunk.first + found.row]
                for c in np.unique(of_word):
                    mine = np.flatnonzero(of_word == c)
                    size = found.end[mine] - found.start[mine]
                    held.setdefault(names[c], _Pieces()).add(size, data[ranges(found.start[mine], size)], left[mine])
                if sum(p.n for p in held.values()) >= FLUSH:
                    yield from flush()
        yield from flush()

    return run


def _flow(levels: list[int], least: int, n_buckets: int) -> Callable:
    """Counts of all stretches of ``levels`` words in a bucket, from the longest down.

    Returns those that occur ``least`` times or more, and, dealt by their own words, what the next
    shorter ones get from here. Below one word there is the number of all words, ``words`` = 0.
    """

    def run(key: tuple, table: pa.Table) -> pa.Table:
        lang = key[0].as_py()
        grams = _unpacked(table)
        counted: dict[str, list] = {"phrase": [], "words": [], "f": []}
        for k in levels:
            here = grams.of_words(k, k).summed()
            frequent = here.pick(np.flatnonzero(here.counts >= least))
            counted["phrase"] += frequent.phrases()
            counted["words"] += [k] * len(frequent.counts)
            counted["f"] += frequent.counts.tolist()
            grams = grams.of_words(1, k - 1).joined(here.prefixes(k - 1))
        if levels[-1] == 1:
            counted["phrase"].append("")
            counted["words"].append(0)
            counted["f"].append(int(grams.counts.sum()))
        packed = _packed(grams.summed(), lang, levels[-1] - 1, n_buckets) if levels[-1] > 1 else {n: [] for n, _ in _PACKED}
        n, m = len(packed["lang"]), len(counted["f"])
        packed["lang"] += [lang] * m
        rows = {name: pa.array(packed[name] + ([None] * m if name != "lang" else []), kind) for name, kind in _PACKED}
        rows |= {name: pa.array([None] * n + counted[name], kind) for name, kind in _COUNTED}
        return pa.table(rows)

    return run


def phrase_counts(docs: DataFrame, least: int, text: str, lang: str) -> DataFrame:
    """(lang, phrase, words, f): stretches of 1 to 4 words with ``least`` occurrences; words = 0 counts all words."""
    spark = docs.sparkSession
    ship(spark)
    # One bucket for each partition: what goes from one level to the next is a row for each pair of buckets.
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    level, parts = rows.mapInArrow(_edges(n), PACKED), []
    for levels in ([4, 3], [2], [1]):
        done = materialise(level.groupBy("lang", "bucket").applyInArrow(_flow(levels, least, n), COUNTED))
        parts.append(done.where("f IS NOT NULL").select("lang", "phrase", "words", "f"))
        level = done.where("bucket IS NOT NULL").drop("phrase", "words", "f")
    totals = parts[-1].where("words = 0").groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2].where("words > 0")).unionByName(totals)


def _slice(start: int, n: int) -> Column:
    return F.array_join(F.slice("ws", start, n), " ")


def unary_paths(counted: DataFrame) -> DataFrame:
    """(lang, phrase, path): edges that lie on a unary path of two edges or more, and its words.

    The flow of a node equals that of an edge only if all of it takes that edge, so a node with one
    such edge on each side is passed by one path. Pointers to the edge before are doubled, so a path
    of n edges takes about log n rounds; each is stored.
    """
    edges = counted.where(f"words = {EDGE}").withColumn("ws", F.split("phrase", " "))
    edges = edges.select("lang", "phrase", "f", _slice(1, EDGE - 1).alias("start"), _slice(2, EDGE - 1).alias("end"))
    nodes = counted.where(f"words = {EDGE - 1}").select("lang", F.col("phrase").alias("node"), F.col("f").alias("flow"))
    enter = edges.select("lang", F.col("end").alias("node"), F.col("phrase").alias("before"), F.col("f").alias("f_in"))
    leave = edges.select("lang", F.col("start").alias("node"), F.col("phrase").alias("after"), F.col("f").alias("f_out"))
    through = nodes.join(enter, ["lang", "node"]).where("f_in = flow").join(leave, ["lang", "node"]).where("f_out = flow AND before <> after")
    through = materialise(through.select("lang", "before", "after"))
    on_path = through.select("lang", F.col("before").alias("phrase")).unionByName(through.select("lang", F.col("after").alias("phrase"))).distinct()
    before = through.select("lang", F.col("after").alias("phrase"), F.col("before").alias("head"))
    state = on_path.join(before, ["lang", "phrase"], "left")
    state = materialise(state.select("lang", "phrase", F.coalesce("head", "phrase").alias("head"), F.when(F.col("head").isNull(), 0).otherwise(1).cast("long").alias("steps")))
    while True:
        further = state.select("lang", F.col("phrase").alias("head"), F.col("head").alias("next"), F.col("steps").alias("more"))
        after = state.join(further, ["lang", "head"]).select("lang", "phrase", F.col("next").alias("head"), (F.col("steps") + F.col("more")).alias("steps"), "more")
        after = materialise(after)
        state = after.drop("more")
        if after.where("more > 0").isEmpty():
            break
    last = F.struct("steps", F.substring_index("phrase", " ", -1).alias("word"))
    paths = state.groupBy("lang", "head").agg(F.array_sort(F.collect_list(last)).alias("all"))
    words = F.array_join(F.transform(F.filter("all", lambda x: x["steps"] > 0), lambda x: x["word"]), " ")
    paths = paths.select("lang", "head", F.concat_ws(" ", "head", words).alias("path"))
    return state.join(paths, ["lang", "head"]).select("lang", "phrase", "path")


def _decimal(name: str) -> Column:
    return F.col(name).cast("decimal(20,0)")


def mine_phrases(docs: DataFrame, least: int = 30, top: int = 2000, covered: int = 80, text: str = "text", lang: str = "lang") -> DataFrame:
    """The ``top`` best scoring phrases of 2 to 4 words of each language.

    A-Z count as a-z. A phrase must occur ``least`` times within pieces of text; with a its count and
    l, r the counts of the two parts of a cut, its score is the least floor(2000000 * a / (l + r)) of
    its cuts (among equals the shortest first part). A phrase that lies in a longer candidate with
    ``covered`` per cent of its count or more is left out, whether that one is itself left out or not.
    Returns lang, rank (by score, count, then phrase in byte order), phrase, a, l, r, n (all words of
    the language), score, path (of a four-word phrase: the unary path it lies on, else the phrase).

    * null lang: ``und``, as if it were so named; null or empty text: no words
    * repeated rows and ids count each time; an empty table gives no rows
    * products and sums are exact (decimals of 38 digits)
    * other columns are ignored, whatever their names
    """
    counted = materialise(phrase_counts(docs, least, text, lang))
    candidates = counted.where("words >= 2").withColumn("ws", F.split("phrase", " "))
    inner = [_slice(s, n) for n in (2, 3) for s in range(1, EDGE)]  # of fewer words beyond the end; such are no proper part
    parts = candidates.select("lang", "words", "f", F.explode(F.array_distinct(F.array(*inner))).alias("phrase"))
    parts = parts.where("size(split(phrase, ' ')) BETWEEN 2 AND words - 1").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    free = candidates.join(parts, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * _decimal("longer") < covered * _decimal("f")))

    cuts = free.select("lang", "phrase", "ws", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.withColumn("first", F.expr("array_join(slice(ws, 1, k), ' ')")).withColumn("rest", F.expr("array_join(slice(ws, k + 1, size(ws) - k), ' ')"))
    sizes = counted.where(f"words BETWEEN 1 AND {EDGE - 1}")
    cuts = cuts.join(sizes.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(sizes.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    score = F.expr("(CAST(2000000 AS decimal(7,0)) * CAST(a AS decimal(20,0))) div (CAST(l AS decimal(20,0)) + CAST(r AS decimal(20,0)))")
    least_cut = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    scored = cuts.groupBy("lang", "phrase", "a").agg(least_cut).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    # The best of each share of a language first, so that no task ranks a whole language.
    order = "ORDER BY score DESC, a DESC, phrase ASC"
    shares = scored.withColumn("place", F.expr(f"row_number() OVER (PARTITION BY lang, pmod(hash(phrase), {_SHARES}) {order})"))
    rank = F.expr(f"CAST(row_number() OVER (PARTITION BY lang {order}) AS long)")
    best = shares.where(F.col("place") <= top).withColumn("rank", rank).where(F.col("rank") <= top)
    totals = counted.where("words = 0").select("lang", F.col("f").alias("n"))
    best = best.join(totals, "lang").join(unary_paths(counted), ["lang", "phrase"], "left")
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score", F.coalesce("path", "phrase").alias("path"))
