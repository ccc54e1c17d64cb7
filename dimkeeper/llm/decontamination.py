"""Benchmark decontamination: an FM-index over each shard of documents, searched for test phrases."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimkeeper.llm import shuffle as sh
from dimkeeper.llm import text as tx
from dimkeeper.llm.fm_index import FMIndex
from dimkeeper.llm.repeats import ranges
from dimkeeper.sources.scratch import materialise

#: Words are stretches of 0-9, a-z (A-Z lowered) and of all that is not ASCII.
WORDS = tx.separators((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))

SPAN = "array<struct<start:int,end:int>>"
RESULT = f"doc_id long, mark long, n_words long, n_hit long, spans {SPAN}, items array<string>"

#: Bytes of documents that one index covers.
SHARD = 4 << 20

#: Bytes of different test texts that are searched for in one pass; the driver makes a table of 13 numbers for each of their words.
BLOCK = 4 << 20


@dataclass
class Phrases:
    """Distinct windows of a block of test texts, over a vocabulary of word hashes."""

    vocabulary: np.ndarray  # sorted
    likely: np.ndarray  # by the low 16 bits of a hash, whether the vocabulary has such a word
    patterns: np.ndarray  # a row for each window: numbers of words, from 1, padded in front
    sizes: np.ndarray
    owner_first: np.ndarray  # of each window, its first owner; one more at the end
    owners: np.ndarray  # numbers of texts
    items: list[list[str]]  # ids of the items that have a text


def phrases(rows: list[tuple[list[str], str | None]], window: int) -> Phrases:
    chunk = next(tx.chunks(pa.array([text for _, text in rows], pa.string()), 1 << 62))
    data = tx.lowered(chunk.data)
    found = tx.words(tx.Chunk(0, chunk.offsets, data), WORDS)
    hashes = found.hashes(data)
    vocabulary = np.unique(hashes)
    numbers = np.searchsorted(vocabulary, hashes) + 1
    likely = np.zeros(1 << 16, bool)
    likely[(vocabulary & np.uint64(0xFFFF)).astype(np.int64)] = True
    counts = found.counts()
    n_windows = np.where(counts > 0, np.maximum(counts - window + 1, 1), 0)
    item = np.repeat(np.arange(len(rows)), n_windows)
    begin = ranges(found.first[:-1], n_windows)
    size = np.minimum(counts[item], window)
    place = np.arange(window) - (window - size)[:, None]
    table = np.where(place >= 0, numbers[np.minimum(begin[:, None] + np.maximum(place, 0), max(0, len(numbers) - 1))] if len(numbers) else 0, 0)
    patterns, which = np.unique(table, axis=0, return_inverse=True) if len(table) else (table, np.zeros(0, np.int64))
    pairs = np.unique(np.stack([which.ravel(), item], axis=1), axis=0)
    first = np.searchsorted(pairs[:, 0], np.arange(len(patterns) + 1))
    return Phrases(vocabulary, likely, patterns, (patterns > 0).sum(axis=1), first, pairs[:, 1], [i for i, _ in rows])


@dataclass
class Hits:
    n_words: np.ndarray
    row: np.ndarray
    start: np.ndarray  # by word, within its row
    end: np.ndarray
    phrase: np.ndarray


def search(chunk: tx.Chunk, wanted: Phrases) -> Hits:
    """All occurrences of the phrases in one shard."""
    data = tx.lowered(chunk.data)
    found = tx.words(tx.Chunk(0, chunk.offsets, data), WORDS)
    none = np.zeros(0, np.int64)
    if not len(wanted.patterns) or not len(found.start):
        return Hits(found.counts(), none, none, none, none)
    hashes = found.hashes(data)
    number = np.zeros(len(hashes), np.int64)
    maybe = np.flatnonzero(wanted.likely[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
    at = np.minimum(np.searchsorted(wanted.vocabulary, hashes[maybe]), len(wanted.vocabulary) - 1)
    number[maybe] = np.where(wanted.vocabulary[at] == hashes[maybe], at + 1, 0)
    # A phrase lies within a run of the tests' words; shorter runs than any phrase cannot hold one.
    inside = np.flatnonzero(number)
    border = tx.groups(found.row[inside], inside - np.arange(len(inside)))
    size = np.diff(border)
    long_enough = size >= wanted.sizes.min()
    first, size = inside[border[:-1][long_enough]], size[long_enough]
    if not len(first):
        return Hits(found.counts(), none, none, none, none)
    begin = np.cumsum(size + 1) - (size + 1)
    seq, origin = np.zeros(int((size + 1).sum()), np.int64), np.zeros(int((size + 1).sum()), np.int64)
    there, here = ranges(begin, size), ranges(first, size)
    seq[there], origin[there] = number[here], here
    # Dense numbers: 0 ends the sequence, 1 separates its runs, words follow.
    used, seq = np.unique(seq, return_inverse=True)
    new = np.zeros(len(wanted.vocabulary) + 1, np.int64)
    new[used] = np.arange(len(used)) + 1
    possible = np.flatnonzero(((new[wanted.patterns] > 1) | (wanted.patterns == 0)).all(axis=1))
    index = FMIndex(np.append(seq + 1, 0), len(used) + 1)
    low, high = index.search(new[wanted.patterns[possible]], wanted.sizes[possible])
    phrase = np.repeat(possible, high - low)
    word = origin[index.locate(ranges(low, high - low))]
    row = found.row[word]
    start = word - found.first[row]
    return Hits(found.counts(), row, start, start + wanted.sizes[phrase], phrase)


def _merged(start: np.ndarray, end: np.ndarray) -> list[dict]:
    """Union of intervals."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.flatnonzero(np.concatenate([[True], start[1:] > end[:-1]]))
    return [{"start": int(start[a]), "end": int(end[b - 1])} for a, b in zip(new, np.append(new[1:], len(start)), strict=True)]


def _scan(wanted: Callable[[], Phrases]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = wanted()
        for batch in batches:
            ids, marks, texts = sh.columns_of(batch, "doc_id", "mark", "text")
            n_words, spans, items = np.zeros(len(ids), np.int64), [[]] * len(ids), [[]] * len(ids)
            for chunk in tx.chunks(texts, SHARD):
                hits = search(chunk, block)
                n_words[chunk.first : chunk.first + chunk.rows] = hits.n_words
                order = np.argsort(hits.row, kind="stable")
                border = tx.groups(hits.row[order])
                for a, b in zip(border[:-1], border[1:], strict=True):
                    mine = order[a:b]
                    row = chunk.first + int(hits.row[mine[0]])
                    spans[row] = _merged(hits.start[mine], hits.end[mine])
                    owners = {int(o) for p in np.unique(hits.phrase[mine]) for o in block.owners[block.owner_first[p] : block.owner_first[p + 1]]}
                    items[row] = sorted({item for o in owners for item in block.items[o]})
            yield _rows(ids, marks, n_words, spans, items)

    return run


def _rows(ids: pa.Array, marks: pa.Array, n_words: object, spans: list, items: list) -> pa.RecordBatch:
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    n_hit = [sum(s["end"] - s["start"] for s in x) for x in spans]
    return pa.RecordBatch.from_arrays(
        [ids, marks, pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(spans, span), pa.array(items, pa.list_(pa.string()))],
        names=["doc_id", "mark", "n_words", "n_hit", "spans", "items"],
    )


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, marks, n_words, spans, items = sh.columns_of(batch, "doc_id", "mark", "n_words", "spans", "items")
        spans = [_merged(*np.array([(s["start"], s["end"]) for s in x], np.int64).T) if x else [] for x in spans.to_pylist()]
        yield _rows(ids, marks, n_words, spans, items)


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = 13, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", block: int = BLOCK
) -> DataFrame:
    """Where the documents hold phrases of the benchmark.

    A phrase is ``window`` consecutive words of an item, or all words of a shorter item. One row for
    each row of ``docs``: doc_id, mark (hash of the text), n_words, n_hit (words within a phrase),
    spans (merged removal spans, by word, end exclusive) and items (ids of items with a phrase
    there, as strings in order).

    Every shard of documents gets an FM-index over its runs of benchmark words; backward search over
    wavelet-tree ranks finds the phrases, sampled suffix places locate them. The benchmark is the
    stated query set: its different texts go to the tasks in blocks of about ``block`` bytes (of one text at
    least), each in its own pass over ``docs``, of which the result is stored before the next block is made.

    * null or empty text: no words, no hit; null doc_id: a row like any other
    * an empty benchmark, or one without words: no hit
    * an item without id: its words are hit, but it is not listed; repeated items count once
    * repeated rows of ``docs``: each has its result; other columns are ignored, whatever their names
    """
    spark = docs.sparkSession
    rows = sh.with_mark(docs, doc_id, text)
    tests = benchmark.select(F.col(item_id).cast("string").alias("item_id"), F.col(item_text).cast("string").alias("text")).where("text IS NOT NULL")
    # Each different text once, whatever the number of items that have it.
    texts = tests.groupBy("text").agg(F.array_sort(F.collect_set("item_id")).alias("ids"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-total // block))
    if n_blocks > 1:
        texts = materialise(texts)
    passes = []
    for number in range(n_blocks):
        part = texts.where(F.pmod(F.xxhash64("text"), F.lit(n_blocks)) == number).select("ids", "text").collect()
        wanted = spark.sparkContext.broadcast(phrases([tuple(r) for r in part] or [([], "")], window))
        found = rows.mapInArrow(_scan(lambda b=wanted: b.value), RESULT)
        if n_blocks == 1:
            return found
        passes.append(materialise(found))  # so that one block at a time is held
        wanted.destroy()
    every = passes[0]
    for one in passes[1:]:
        every = every.unionByName(one)
    united = every.groupBy("doc_id", "mark").agg(
        F.max("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.expr(f"sequence(1, count(1) div {n_blocks})").alias("copies"),
    )
    return united.withColumn("copy", F.explode("copies")).select("doc_id", "mark", "n_words", "spans", "items").mapInArrow(_united, RESULT)


def contaminated() -> Column:
    """At least one word in twenty is hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
