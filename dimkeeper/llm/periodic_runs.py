"""Periodic runs of words, found by recursive frequency splitting and a scan of the lags.

A run of period q has at least 2 * q words, so each of its words occurs twice within it. A word that
occurs only once in a segment of text can thus be in no run of that segment and splits it; the parts
are judged anew until none splits further. In what survives every lag is scanned at its checkpoints
0, q, 2 * q, ...: a run agrees with itself at distance q in q places on end or more, so one of them
is a checkpoint. From there the agreement is followed both ways by the names of blocks of 1, 2, 4, ...
words, which are equal where the words are (nothing is decided by a hash). That takes n log n
checkpoints for n words, however many lags there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimkeeper.llm import shuffle as sh
from dimkeeper.llm import text as tx
from dimkeeper.llm.ship import ship

RUN = "struct<start:bigint,length:bigint,period:bigint>"
RESULT = f"doc_id long, n_words long, runs array<{RUN}>, kept string"
_RUN_ARROW = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

#: Rounds over all segments at once; what still splits then is split one by one from its ends.
_ROUNDS = 6
#: Checkpoints that are looked at together.
_PAIRS = 2_000_000


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of all ranges, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def names_of(words: tx.Words, data: np.ndarray) -> np.ndarray:
    """A number for each word, equal for equal words."""
    size = words.end - words.start
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    body = np.ascontiguousarray(data[ranges(words.start, size)])
    column = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(body)])
    return column.dictionary_encode().indices.to_numpy().astype(np.int64)


def neighbours(names: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each word the places of its occurrences before and after in the same row; -1 and n: none."""
    n = len(names)
    order = np.lexsort((names, row))  # stable: places rise among equals
    same = (names[order][1:] == names[order][:-1]) & (row[order][1:] == row[order][:-1])
    before, after = np.full(n, -1, np.int64), np.full(n, n, np.int64)
    before[order[1:][same]] = order[:-1][same]
    after[order[:-1][same]] = order[1:][same]
    return before, after


def _split_from_ends(low: int, high: int, before: np.ndarray, after: np.ndarray, shortest: int) -> list[tuple[int, int]]:
    """The stable parts of one segment. Looking from both ends costs no more than the smaller part of each split."""
    stable, todo = [], [(low, high)]
    while todo:
        low, high = todo.pop()
        if high - low < shortest:
            continue
        done, width, at = 0, 64, -1
        while at < 0 and 2 * done < high - low:
            for a, b in ((low + done, min(high, low + done + width)), (max(low, high - done - width), high - done)):
                alone = np.flatnonzero((before[a:b] < low) & (after[a:b] >= high))
                if len(alone):
                    at = a + int(alone[0])
                    break
            done, width = done + width, 2 * width
        if at < 0:
            stable.append((low, high))
        else:
            todo += [(low, at), (at + 1, high)]
    return stable


def stable_segments(first: np.ndarray, before: np.ndarray, after: np.ndarray, shortest: int) -> list[tuple[int, int]]:
    """Stretches of at least ``shortest`` words of one row in which every word occurs twice or more."""
    low, high = first[:-1], first[1:]
    stable: list[tuple[int, int]] = []
    for _ in range(_ROUNDS):
        long = high - low >= shortest
        low, high = low[long], high[long]
        size = high - low
        place, part = ranges(low, size), np.repeat(np.arange(len(low)), size)
        alone = (before[place] < low[part]) & (after[place] >= high[part])
        splits = np.zeros(len(low), bool)
        splits[part[alone]] = True
        stable += zip(low[~splits].tolist(), high[~splits].tolist(), strict=True)
        left = place[splits[part] & ~alone]
        if not len(left):
            return stable
        owner = part[splits[part] & ~alone]
        border = tx.groups(owner, left - np.arange(len(left)))
        low, high = left[border[:-1]], left[border[1:] - 1] + 1
    for a, b in zip(low.tolist(), high.tolist(), strict=True):
        stable += _split_from_ends(a, b, before, after, shortest)
    return stable


def _blocks(names: np.ndarray) -> list[np.ndarray]:
    """Names of the blocks of 1, 2, 4, ... words at each place, as far as blocks repeat."""
    levels = [names]
    while (half := 1 << (len(levels) - 1)) * 2 < len(names):
        last = levels[-1]
        pair = last[:-half] * np.int64(len(names) + 1) + last[half:]
        coded = pa.array(pair).dictionary_encode()
        if len(coded.dictionary) == len(pair):
            break
        levels.append(coded.indices.to_numpy().astype(np.int64))
    return levels


def _agreement(levels: list[np.ndarray], at: np.ndarray, lag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How far the words from ``at`` on, and those before it, equal the ones ``lag`` further on."""
    on, back = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        level, size = levels[k], 1 << k
        a = at + on
        fits = np.flatnonzero(a + lag < len(level))
        on[fits[level[a[fits]] == level[a[fits] + lag[fits]]]] += size
        a = at - back - size
        fits = np.flatnonzero(a >= 0)
        back[fits[level[a[fits]] == level[a[fits] + lag[fits]]]] += size
    return on, back


def lag_scan(names: np.ndarray, shortest: int) -> np.ndarray:
    """Rows (start, length, period) of the runs of one segment: maximal, of smallest period, by start."""
    n = len(names)
    names = pa.array(names).dictionary_encode().indices.to_numpy().astype(np.int64)
    levels = _blocks(names)
    lags = np.arange(1, n // 2 + 1, dtype=np.int64)
    checks = (n - 1) // lags
    upto = np.cumsum(checks)
    found = [np.zeros((0, 3), np.int64)]
    begin = 0
    while begin < len(lags):
        end = max(begin + 1, int(np.searchsorted(upto, (upto[begin - 1] if begin else 0) + _PAIRS, "right")))
        lag = np.repeat(lags[begin:end], checks[begin:end])
        at = lag * ranges(np.zeros(end - begin, np.int64), checks[begin:end])
        begin = end
        hit = names[at] == names[at + lag]
        at, lag = at[hit], lag[hit]
        on, back = _agreement(levels, at, lag)
        enough = on + back >= np.maximum(lag, shortest - lag)
        at, lag, on, back = at[enough], lag[enough], on[enough], back[enough]
        found.append(np.unique(np.stack([at - back, on + back + lag, lag], axis=1), axis=0))
    runs = np.unique(np.concatenate(found), axis=0)
    # A stretch with the periods p and q, both at most half of it, has their common divisor as period too.
    least = np.ones(len(runs), bool)
    least[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[least]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _joined(data: np.ndarray, words: tx.Words, keep: np.ndarray, rows: int) -> pa.Array:
    """The kept words of each row, joined by one space."""
    which = np.flatnonzero(keep)
    row = words.row[which]
    more = np.zeros(len(which), bool)  # whether another word of the row follows
    more[:-1] = row[1:] == row[:-1]
    size = words.end[which] - words.start[which] + more
    place = ranges(words.start[which], size)
    body = data[np.minimum(place, max(len(data) - 1, 0))]
    body[(np.cumsum(size) - 1)[more]] = 0x20
    ends = np.concatenate([[0], np.cumsum(size)])
    offsets = ends[np.searchsorted(row, np.arange(rows + 1))].astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), rows, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(body))])


def _runs_of(shortest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = sh.columns_of(batch, "doc_id", "text")
            for chunk in tx.chunks(texts):
                words = tx.words(chunk)
                names = names_of(words, chunk.data)
                parts = stable_segments(words.first, *neighbours(names, words.row), shortest)
                parts.sort()
                scanned = [lag_scan(names[a:b], shortest) + np.array([a, 0, 0]) for a, b in parts]
                runs = np.concatenate(scanned or [np.zeros((0, 3), np.int64)])
                row = words.row[runs[:, 0]] if len(runs) else np.zeros(0, np.int64)
                gone = tx.covered(runs[:, 0] + runs[:, 2], runs[:, 0] + runs[:, 1], len(names))
                columns = [runs[:, 0] - words.first[row], runs[:, 1], runs[:, 2]]
                found = pa.StructArray.from_arrays([pa.array(c) for c in columns], fields=list(_RUN_ARROW))
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(chunk.rows + 1)), pa.int32()), found)
                kept = _joined(chunk.data, words, ~gone, chunk.rows).cast(pa.string())
                mine = ids.slice(chunk.first, chunk.rows)
                yield pa.RecordBatch.from_arrays([mine, pa.array(words.counts(), pa.int64()), lists, kept], names=["doc_id", "n_words", "runs", "kept"])

    return run


def find_runs(docs: DataFrame, shortest: int = 12, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The periodic runs of each whole text, and the text with each run reduced to its first period.

    Words are stretches without ASCII white space. A run is a stretch with smallest period q and at
    least max(``shortest``, 2 * q) words that neither neighbouring word extends. One row for each row
    of ``docs``: doc_id, n_words, runs (start and length in words, period; by start, then period) and
    kept (the words that are in no run, or in the first period of each run they are in, joined by one
    space). Nothing is shuffled.

    * null or empty text: no words, no runs, kept is empty
    * null or repeated ids, repeated rows: each row is a text of its own
    * other columns of ``docs`` are ignored, whatever their names
    """
    if shortest < 2:
        raise ValueError("a run has two words at least")
    ship(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_runs_of(shortest), RESULT)
