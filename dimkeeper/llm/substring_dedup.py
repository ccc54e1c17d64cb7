"""Removal of repeated word windows by Rabin-Karp hashes, counted in Spark."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from dimkeeper.llm import repeats as rp
from dimkeeper.llm import shuffle as sh
from dimkeeper.llm import text as tx

RESULT = "doc_id long, n_words long, n_removed long, spans array<struct<start:int,end:int>>, kept string"


def _decide(s: rp.Segments) -> np.ndarray:
    """Windows whose hash a document with a smaller id has too."""
    hashes = s.payload[rp.ranges(s.begin, s.size)]
    ids = np.repeat(s.doc_id, s.size)
    order = np.lexsort((ids, hashes[:, 1], hashes[:, 0]))
    at = tx.groups(hashes[order, 0], hashes[order, 1])
    later = ids[order] > np.repeat(ids[order][at[:-1]], np.diff(at))
    flags = np.zeros(len(order), bool)
    flags[order] = later
    return flags


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts, spans = sh.columns_of(batch, "doc_id", "text", "spans")
        out: list[tuple] = []
        for text, packed in zip(texts.cast(pa.large_binary()), spans, strict=True):
            words = (text.as_py() or b"").split()
            places = sh.numbers(packed, np.int32).reshape(-1, 2)
            if not len(places):
                out.append((len(words), 0, [], b" ".join(words)))
                continue
            gone = tx.covered(places[:, 0], places[:, 1], len(words))
            a, b = tx.runs(gone)
            kept = b" ".join([words[i] for i in np.flatnonzero(~gone)])
            out.append((len(words), int(gone.sum()), [{"start": int(x), "end": int(y)} for x, y in zip(a, b, strict=True)], kept))
        n, removed, where, kept = zip(*out, strict=True) if out else ((), (), (), ())
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(where, span), pa.array(kept, pa.binary()).cast(pa.string())],
            names=["doc_id", "n_words", "n_removed", "spans", "kept"],
        )


def remove_repeated_words(docs: DataFrame, window: int = 50, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Remove each word that lies in a window which also starts in a document with a smaller id.

    Words are stretches without ASCII white space. Every window of ``window`` words is hashed by a
    rolling polynomial; equal windows meet by their 128-bit hash. One row for each row of ``docs``:
    doc_id, n_words, n_removed, spans (maximal removed runs, by word, end exclusive) and kept (the
    other words joined by one space).

    * null or empty text: no words, kept is empty
    * fewer words than a window: nothing is removed
    * rows with one id, same text or not, remove nothing from each other
    * null id: nothing is removed there, and it removes nothing
    * other columns of ``docs`` are ignored, whatever their names
    """
    unit = rp.Unit(words=True, window=window, gram=max(1, window // 3), within=False)
    rows, rest = rp.rows_of(docs, doc_id, text)
    found = rp.repeats(rows, unit, np.uint64, 2, _decide)
    return found.unionByName(rest).select("doc_id", "text", "spans").mapInArrow(_kept, RESULT)
