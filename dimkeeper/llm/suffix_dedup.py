"""Removal of repeated byte strings by a suffix sort that compares by hash."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from dimkeeper.llm import repeats as rp
from dimkeeper.llm import shuffle as sh
from dimkeeper.llm import text as tx

RESULT = "doc_id long, n_bytes long, n_removed long, spans array<struct<start:int,end:int>>, kept binary"

#: Bytes of segments that one sort takes; a group of equal anchors stays together.
AT_ONCE = 1 << 20


class Suffixes:
    """Suffixes of ``data``, each seen up to ``depth`` bytes, compared by prefix hashes."""

    def __init__(self, data: np.ndarray, depth: int) -> None:
        self.data, self.depth = data, depth
        self.hash = tx.Prefix.of(tx.byte_values(data))

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix, by binary search over the hashes of prefixes."""
        low, high = np.zeros(len(a), np.int64), np.full(len(a), self.depth, np.int64)
        while (low < high).any():
            middle = (low + high + 1) >> 1
            same = self.hash.stretch(a, a + middle) == self.hash.stretch(b, b + middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether suffix a is before b; False for equals."""
        n = self.common(a, b)
        last = np.minimum(n, self.depth - 1)
        return (n < self.depth) & (self.data[a + last] < self.data[b + last])

    def sort(self, at: np.ndarray, border: np.ndarray) -> np.ndarray:
        """Merge sort of each group ``at[border[i]:border[i + 1]]``, of all groups at once.

        Runs of 1, 2, 4, ... suffixes are merged in pairs: a suffix's place in the merged run is its
        own rank plus the number of suffixes of the other run before it, found by binary search.
        """
        group = np.repeat(np.arange(len(border) - 1), np.diff(border))
        first, end = border[group], border[group + 1]
        place = np.arange(len(at))
        width, most = 1, int(np.diff(border).max(initial=0))
        while width < most:
            run = (place - first) // width
            left = run % 2 == 0
            mine = first + run * width
            other = np.where(left, mine + width, mine - width)
            low = np.minimum(other, end)
            stop = np.minimum(other + width, end)
            size = stop - low
            lo, hi = low.copy(), stop.copy()
            for _ in range(int(width).bit_length()):
                open_ = np.flatnonzero(lo < hi)
                if not len(open_):
                    break
                middle = (lo[open_] + hi[open_]) >> 1
                there, here = at[middle], at[open_]
                of_left = left[open_]
                # A left suffix goes before its equals of the right run.
                less = self.before(np.where(of_left, there, here), np.where(of_left, here, there))
                ahead = np.where(of_left, less, ~less)
                lo[open_] = np.where(ahead, middle + 1, lo[open_])
                hi[open_] = np.where(ahead, hi[open_], middle)
            target = np.minimum(mine, np.where(size > 0, low, mine)) + (place - mine) + (lo - low)
            merged = np.empty_like(at)
            merged[target] = at
            at = merged
            width *= 2
        return at

    def equal_next(self, at: np.ndarray) -> np.ndarray:
        """Whether each suffix but the last equals the next one; hashes decide, bytes confirm."""
        same = self.common(at[:-1], at[1:]) == self.depth
        for part in np.array_split(np.flatnonzero(same), max(1, int(same.sum()) // 20_000)):
            span = np.arange(self.depth)
            ok = (self.data[at[part][:, None] + span] == self.data[at[part + 1][:, None] + span]).all(axis=1)
            if not ok.all():
                raise CollisionError
        return same


class CollisionError(Exception):
    """Two different strings had the same hash; the group is then sorted by its bytes."""


def _classes(data: np.ndarray, at: np.ndarray, border: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted suffixes, and for each the number of its class of equals."""
    group = np.repeat(np.arange(len(border) - 1), np.diff(border))
    suffixes = Suffixes(data, depth)
    try:
        at = suffixes.sort(at, border)
        same = suffixes.equal_next(at) & (group[1:] == group[:-1])
    except CollisionError:
        raw = data.tobytes()
        keys = [(int(g), raw[i : i + depth], int(i)) for g, i in zip(group, at, strict=True)]
        keys.sort()
        at = np.array([k[2] for k in keys], np.int64)
        same = np.array([a[:2] == b[:2] for a, b in zip(keys, keys[1:], strict=False)], bool)
    return at, np.concatenate([[0], np.cumsum(~same)])


def _decide_with(unit: rp.Unit) -> rp.Decide:
    def part(s: rp.Segments) -> np.ndarray:
        sizes = s.size + unit.window - 1
        data = s.payload[rp.ranges(s.begin, sizes)]
        begin = np.cumsum(sizes) - sizes
        owner, offset = np.repeat(np.arange(len(s.size)), s.size), rp.ranges(np.zeros(len(s.size), np.int64), s.size)
        at = begin[owner] + offset
        # Equal windows have their anchor at the same distance, so only those are compared.
        grams = tx.Prefix.of(tx.byte_values(data)).windows(unit.gram)
        whose = np.repeat(np.arange(len(s.size)), sizes)[: len(grams)]
        hits = np.flatnonzero(grams == s.anchor[whose])
        distance = hits[np.searchsorted(hits, at)] - at
        order = np.lexsort((distance, s.anchor[owner]))
        border = tx.groups(s.anchor[owner][order], distance[order])
        window_at = np.full(len(data), -1, np.int64)
        window_at[at] = np.arange(len(at))
        placed, class_of = _classes(data, at[order], border, unit.window)
        which = window_at[placed]
        ids, marks, starts = s.doc_id[owner[which]], s.mark[owner[which]], s.start[owner[which]] + offset[which]
        again = np.lexsort((starts, marks, ids, class_of))
        c, i, m, st = class_of[again], ids[again], marks[again], starts[again]
        edge = tx.groups(c)
        later = i > np.repeat(i[edge[:-1]], np.diff(edge))
        later[1:] |= (c[1:] == c[:-1]) & (i[1:] == i[:-1]) & (m[1:] == m[:-1]) & (st[1:] > st[:-1])
        flags = np.zeros(len(at), bool)
        flags[which[again]] = later
        return flags

    def decide(s: rp.Segments) -> np.ndarray:
        flags = []
        border = tx.groups(s.anchor)
        weight = np.concatenate([[0], np.cumsum(s.size + unit.window - 1)])
        a = 0
        while a < len(s.size):
            ahead = border[np.searchsorted(border, a, "right") :]
            fits = ahead[weight[ahead] - weight[a] <= AT_ONCE]
            b = int(fits[-1]) if len(fits) else int(ahead[0])
            flags.append(part(s.pick(np.arange(a, b))))
            a = b
        return np.concatenate(flags)

    return decide


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts, spans = sh.columns_of(batch, "doc_id", "text", "spans")
        out: list[tuple] = []
        for text, packed in zip(texts.cast(pa.large_binary()), spans, strict=True):
            raw = text.as_py() or b""
            places = sh.numbers(packed, np.int32).reshape(-1, 2)
            if not len(places):
                out.append((len(raw), 0, [], raw))
                continue
            gone = tx.covered(places[:, 0], places[:, 1], len(raw))
            a, b = tx.runs(gone)
            kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
            out.append((len(raw), int(gone.sum()), [{"start": int(x), "end": int(y)} for x, y in zip(a, b, strict=True)], kept))
        n, removed, where, kept = zip(*out, strict=True) if out else ((), (), (), ())
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(where, span), pa.array(kept, pa.binary())],
            names=["doc_id", "n_bytes", "n_removed", "spans", "kept"],
        )


def remove_repeated_bytes(docs: DataFrame, length: int = 100, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Remove each byte covered by a ``length``-byte string that also starts earlier.

    Earlier is a smaller doc_id, or the same document before. Suffixes are sorted within groups of
    equal anchor; two suffixes are compared by the length of their common prefix, found by binary
    search over polynomial prefix hashes. Neighbours that agree in ``length`` bytes are equal
    windows; their bytes are compared, and a group with a colliding hash is sorted by its bytes.

    One row for each row of ``docs``: doc_id, n_bytes, n_removed, spans (maximal removed runs, end
    exclusive) and kept (the bytes that are left, which need not be valid UTF-8).

    * null or empty text: no bytes, nothing is removed
    * rows with one id and different texts remove nothing from each other; a repeated row has the
      result of the row it repeats
    * null id: nothing is removed there, and it removes nothing
    * other columns of ``docs`` are ignored, whatever their names
    """
    unit = rp.Unit(words=False, window=length, gram=max(1, length // 3), within=True)
    rows, rest = rp.rows_of(docs, doc_id, text)
    found = rp.repeats(rows, unit, np.uint8, 1, _decide_with(unit))
    return found.unionByName(rest).select("doc_id", "text", "spans").mapInArrow(_kept, RESULT)
