"""What the two repeat removers share: anchors, segments, and the two passes over the documents.

A window (50 words, 100 bytes) holds an anchor: the least hash of its shorter grams, the leftmost
one among equals. Equal windows have equal anchors at the same place. So a window can repeat only
if its anchor occurs twice; anchors, a few per cent of all positions, are counted first, and only
windows with a repeated anchor go on. No window that repeats is lost on the way.

Consecutive windows with the same anchor occurrence are a segment. Of equal segments that one task
meets only the first goes to the shuffle, the others are decided where they are. So a passage that
a third of all documents share costs each task one segment.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimkeeper.llm import shuffle as sh
from dimkeeper.llm import text as tx

ANCHORS = "bucket int, anchor binary, doc_id binary, mark binary"
SEGMENTS = "bucket int, anchor binary, doc_id binary, mark binary, start binary, size binary, twin binary, payload binary, done binary"
SPANS = "doc_id long, mark long, spans binary"


@dataclass(frozen=True)
class Unit:
    """Windows of ``window`` words or bytes, with anchors among grams of ``gram`` of them."""

    words: bool
    window: int
    gram: int
    within: bool  # whether an earlier place of the same document counts too


@dataclass
class Scan:
    """A chunk's windows: for each valid one its place, row and anchor occurrence."""

    sequence: np.ndarray  # a hash of each word or byte
    second: np.ndarray  # another one
    first: np.ndarray  # of each row, its first place; one more at the end
    at: np.ndarray
    row: np.ndarray
    anchor_at: np.ndarray
    anchor: np.ndarray


def scan(chunk: tx.Chunk, unit: Unit) -> Scan:
    if unit.words:
        found = tx.words(chunk)
        sequence, second = found.hashes(chunk.data), found.hashes(chunk.data, 1)
        first, row = found.first, found.row
    else:
        sequence, second = tx.byte_values(chunk.data), tx.byte_values(chunk.data, 1)
        first, row = chunk.offsets, np.repeat(np.arange(chunk.rows), np.diff(chunk.offsets))
    n = max(0, len(sequence) - unit.window + 1)
    at = np.flatnonzero(np.arange(n) + unit.window <= first[row[:n] + 1])
    grams = tx.Prefix.of(sequence).windows(unit.gram)
    low = np.uint64((1 << 32) - 1)  # the same bits decide in every chunk, or equal windows would differ in their anchors
    keys = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    best = (tx.sliding_min(keys, unit.window - unit.gram + 1)[at] & low).astype(np.int64)
    return Scan(sequence, second, first, at, row[at], best, grams[best])


def _segments(s: Scan) -> tuple[np.ndarray, np.ndarray]:
    """First and last (exclusive) of the stretches of consecutive windows with one anchor occurrence."""
    border = tx.groups(s.anchor_at, s.row, s.at - np.arange(len(s.at)))
    return border[:-1], border[1:]


def _anchors(unit: Unit, n_buckets: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = sh.Gather("anchor", "doc_id", "mark")
        for batch in batches:
            ids, marks, texts = sh.columns_of(batch, "doc_id", "mark", "text")
            ids, marks = ids.to_numpy(), marks.to_numpy()
            for chunk in tx.chunks(texts):
                s = scan(chunk, unit)
                first, _ = _segments(s)
                rows = chunk.first + s.row[first]
                have.add(anchor=s.anchor[first], doc_id=ids[rows], mark=marks[rows])
                if have.full():
                    out = have.take()
                    yield sh.packed(out["anchor"], out, n_buckets)
        if have.size:
            out = have.take()
            yield sh.packed(out["anchor"], out, n_buckets)

    return run


def _repeated(unit: Unit) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        anchor, ids, marks = sh.unpacked(table, "anchor", np.uint64), sh.unpacked(table, "doc_id", np.int64), sh.unpacked(table, "mark", np.int64)
        order = np.argsort(anchor)
        anchor, ids, marks = anchor[order], ids[order], marks[order]
        at = tx.groups(anchor)
        size = np.diff(at)
        if unit.within:
            shared = size >= 2
        else:
            shared = np.minimum.reduceat(ids, at[:-1]) != np.maximum.reduceat(ids, at[:-1])
        keep = np.repeat(shared, size)
        return sh.by_document(ids[keep], marks[keep], anchor[keep], "anchors")

    return run


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of all ranges, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def _member(rows: np.ndarray, values: np.ndarray, asked: np.ndarray, asked_rows: np.ndarray) -> np.ndarray:
    """Whether the pair (row, value) is among the asked ones."""
    if not len(asked):
        return np.zeros(len(rows), bool)
    key = lambda r, v: tx.mix(v ^ tx.mix(r.astype(np.uint64)))
    known = np.sort(key(asked_rows, asked))
    mine = key(rows, values)
    return known[np.minimum(np.searchsorted(known, mine), len(known) - 1)] == mine


def _like_first(order: np.ndarray, at: np.ndarray, payload: np.ndarray, begin: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Of segments in groups ``order[at[i]:at[i + 1]]``, which have the content of their group's first one."""
    first = np.repeat(order[at[:-1]], np.diff(at))
    out = weight[order] == weight[first]
    other = np.flatnonzero(out & (order != first))
    # In small pieces: the places of all bytes at once would take many times the payload's memory.
    for part in np.array_split(other, 1 + (int(weight[order[other]].sum()) >> 18)):
        if not len(part):
            continue
        mine, size = order[part], weight[order[part]]
        differ = payload[ranges(begin[mine], size)] != payload[ranges(begin[first[part]], size)]
        differ = differ.any(axis=1) if differ.ndim > 1 else differ
        out[part] = np.add.reduceat(differ, np.cumsum(size) - size) == 0
    return out


def same_segments(
    twin: np.ndarray, ids: np.ndarray, marks: np.ndarray, starts: np.ndarray, unit: Unit, payload: np.ndarray, begin: np.ndarray, weight: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Among equal segments: those that an earlier one covers wholly, and those to be looked at further.

    Hashes bring equal segments together, their content decides; one that only shares the hashes is looked at further.
    """
    order = np.lexsort((starts, marks, ids, twin[:, 1], twin[:, 0]))
    t, i, m = twin[order], ids[order], marks[order]
    at = tx.groups(t[:, 0], t[:, 1])
    done = i > np.repeat(i[at[:-1]], np.diff(at))
    if unit.within:
        done[1:] |= (t[1:] == t[:-1]).all(axis=1) & (i[1:] == i[:-1]) & (m[1:] == m[:-1]) & (starts[order][1:] > starts[order][:-1])
    if len(order):
        like = _like_first(order, at, payload, begin, weight)
        like[1:] &= like[:-1] | (order[1:] == np.repeat(order[at[:-1]], np.diff(at))[1:]) | (i[1:] > np.repeat(i[at[:-1]], np.diff(at))[1:])
        done &= like
    out = np.zeros(len(order), bool)
    out[order] = done
    return out, ~out


def _found(unit: Unit, n_buckets: int, dtype: type, width: int) -> Callable:
    """Segments with repeated anchors, with what is needed to compare their windows."""

    def flush(have: sh.Gather, payloads: list[np.ndarray]) -> pa.RecordBatch:
        out = have.take()
        payload = np.concatenate(payloads)
        payloads.clear()
        begin = np.cumsum(out["weight"]) - out["weight"]
        done, left = same_segments(out["twin"], out["doc_id"], out["mark"], out["start"], unit, payload, begin, out["weight"])
        bucket = sh.bucket_of(out["anchor"], n_buckets)
        rows: dict[str, list] = {n: [] for n in ("bucket", "anchor", "doc_id", "mark", "start", "size", "twin", "payload", "done")}
        order = np.lexsort((out["anchor"], bucket))  # like beside like, for the shuffle's compression
        at = tx.groups(bucket[order])
        for a, b in zip(at[:-1], at[1:], strict=True):
            mine = order[a:b]
            sent, local = mine[left[mine]], mine[done[mine]]
            rows["bucket"].append(int(bucket[order[a]]))
            for name in ("anchor", "doc_id", "mark", "start", "size", "twin"):
                rows[name].append(out[name][sent].tobytes())
            rows["payload"].append(sh.squeezed(payload[ranges(begin[sent], out["weight"][sent])], unit.words))
            rows["done"].append(np.stack([out["doc_id"][local], out["mark"][local], out["start"][local], out["start"][local] + out["size"][local] + unit.window - 1], axis=1).tobytes())
        return pa.RecordBatch.from_pydict({n: pa.array(v, pa.int32() if n == "bucket" else pa.binary()) for n, v in rows.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = sh.Gather("anchor", "doc_id", "mark", "start", "size", "twin", "weight")
        payloads: list[np.ndarray] = []
        weight = 0
        for batch in batches:
            ids, marks, texts, asked = sh.columns_of(batch, "doc_id", "mark", "text", "anchors")
            ids, marks = ids.to_numpy(), marks.to_numpy()
            for chunk in tx.chunks(texts):
                s = scan(chunk, unit)
                wanted = [sh.numbers(asked[chunk.first + r], np.uint64) for r in range(chunk.rows)]
                wanted_rows = np.repeat(np.arange(chunk.rows), [len(x) for x in wanted])
                first, last = _segments(s)
                keep = _member(s.row[first], s.anchor[first], np.concatenate(wanted), wanted_rows)
                first, last = first[keep], last[keep]
                if not len(first):
                    continue
                start, size = s.at[first], last - first
                end = start + size + unit.window - 1
                both = [tx.Prefix.of(x) for x in (s.sequence, s.second)]
                twin = np.stack([tx.mix(p.stretch(start, end)) + size.astype(np.uint64) for p in both], axis=1)
                rows = chunk.first + s.row[first]
                if unit.words:
                    w = [p.windows(unit.window) for p in both]
                    at = ranges(start, size)
                    payload, weights = np.stack([w[0][at], w[1][at]], axis=1).astype(dtype), size
                else:
                    payload, weights = chunk.data[ranges(start, end - start)], end - start
                have.add(anchor=s.anchor[first], doc_id=ids[rows], mark=marks[rows], start=start - s.first[s.row[first]], size=size, twin=twin, weight=weights)
                payloads.append(payload)
                weight += int(weights.sum())
                if weight * payload.dtype.itemsize * width >= 24 << 20:
                    yield flush(have, payloads)
                    weight = 0
        if have.size:
            yield flush(have, payloads)

    return run


@dataclass
class Segments:
    """The segments of one bucket, sorted by anchor."""

    anchor: np.ndarray
    doc_id: np.ndarray
    mark: np.ndarray
    start: np.ndarray
    size: np.ndarray
    payload: np.ndarray
    begin: np.ndarray  # of each segment, in the payload

    def pick(self, which: np.ndarray) -> Segments:
        return Segments(self.anchor[which], self.doc_id[which], self.mark[which], self.start[which], self.size[which], self.payload, self.begin[which])


Decide = Callable[[Segments], np.ndarray]


def _decided(unit: Unit, dtype: type, width: int, decide: Decide) -> Callable:
    """Removal spans by document, from a bucket's segments; ``decide`` flags windows of unequal ones."""

    def run(table: pa.Table) -> pa.Table:
        names = {"anchor": np.uint64, "doc_id": np.int64, "mark": np.int64, "start": np.int64, "size": np.int64}
        all_ = Segments(*(sh.unpacked(table, n, t) for n, t in names.items()), sh.released(table, "payload", dtype, width), np.zeros(0, np.int64))
        weight = all_.size if unit.words else all_.size + unit.window - 1
        all_.begin = np.cumsum(weight) - weight
        spans = [sh.unpacked(table, "done", np.int64, 4).reshape(-1, 4)]
        twin = sh.unpacked(table, "twin", np.uint64, 2).reshape(-1, 2)
        done, left = same_segments(twin, all_.doc_id, all_.mark, all_.start, unit, all_.payload, all_.begin, weight)
        spans.append(np.stack([all_.doc_id, all_.mark, all_.start, all_.start + all_.size + unit.window - 1], axis=1)[done])
        rest = np.flatnonzero(left)
        rest = rest[np.argsort(all_.anchor[rest], kind="stable")]
        at = tx.groups(all_.anchor[rest])
        some = all_.pick(rest[np.repeat(np.diff(at) > 1, np.diff(at))])
        if len(some.size):
            flags = decide(some)
            owner = np.repeat(np.arange(len(some.size)), some.size)
            offset = ranges(np.zeros(len(some.size), np.int64), some.size)
            hit = np.flatnonzero(flags)
            if len(hit):
                border = tx.groups(owner[hit], offset[hit] - np.arange(len(hit)))
                a, b = hit[border[:-1]], hit[border[1:] - 1]
                o = owner[a]
                spans.append(np.stack([some.doc_id[o], some.mark[o], some.start[o] + offset[a], some.start[o] + offset[b] + unit.window], axis=1))
        s = np.concatenate(spans)
        return sh.by_document(s[:, 0], s[:, 1], s[:, 2:].astype(np.int32), "spans")

    return run


def repeats(rows: DataFrame, unit: Unit, dtype: type, width: int, decide: Decide) -> DataFrame:
    """(doc_id, mark, text, spans) of all rows: the spans of repeated windows, packed, not merged.

    ``rows`` has no null doc_id (see ``shuffle.with_mark``).
    """
    n = sh.buckets(rows.sparkSession)
    anchors = rows.mapInArrow(_anchors(unit, n), ANCHORS)
    asked = anchors.groupBy("bucket").applyInArrow(_repeated(unit), "doc_id long, mark long, anchors binary")
    some = rows.join(sh.gathered(asked, "anchors"), ["doc_id", "mark"])
    segments = some.mapInArrow(_found(unit, n, dtype, width), SEGMENTS)
    spans = segments.groupBy("bucket").applyInArrow(_decided(unit, dtype, width, decide), SPANS)
    return rows.join(sh.gathered(spans, "spans"), ["doc_id", "mark"], "left")


def rows_of(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Rows with an id, and rows without one: these take no part."""
    rows = sh.with_mark(docs, doc_id, text)
    return rows.where("doc_id IS NOT NULL"), rows.where("doc_id IS NULL").withColumn("spans", F.lit(None).cast("array<binary>"))
