"""Quality classifier by importance resampling: hashed n-gram models of target and raw text, Gumbel top-k."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimkeeper.llm import shuffle as sh
from dimkeeper.llm import text as tx
from dimkeeper.sources.scratch import materialise

#: Buckets of the hashed n-grams: the first half for words, the second for pairs of words.
BUCKETS = 1 << 20

#: Rows in which a task sends its counts.
SLICES = 128

WEIGHED = "doc_id long, mark long, n_features long, log_ratio double, weight double"
SCORED = WEIGHED + ", key double"

#: Rows that the search for the k-th largest key sorts in the end.
FEW = 10_000

#: Words without the punctuation around them: 0-9, a-z (A-Z lowered) and all that is not ASCII.
BARE = tx.separators((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))


def features(chunk: tx.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of each word, as it stands and bare of punctuation, and of each pair of neighbouring words, A-Z lowered."""
    data = tx.lowered(chunk.data)
    whole = tx.Chunk(0, chunk.offsets, data)
    found, bare = tx.words(whole), tx.words(whole, BARE)
    words = found.hashes(data)
    pairs = tx.Prefix.of(words).windows(2)
    same = found.row[: len(pairs)] == found.row[1 : len(pairs) + 1]
    half = np.uint64(BUCKETS // 2)
    values = np.concatenate([words % half, tx.mix(bare.hashes(data) + np.uint64(7)) % half, pairs[same] % half + half])
    return values.astype(np.int64), np.concatenate([found.row, bare.row, found.row[: len(pairs)][same]])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, salt = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        (texts,) = sh.columns_of(batch, "text")
        salt = (salt + batch.nbytes) % 61
        for chunk in tx.chunks(texts):
            total += np.bincount(features(chunk)[0], minlength=BUCKETS)
    if total.any():
        parts = total.reshape(SLICES, -1)
        yield pa.RecordBatch.from_pydict({"salt": pa.array([salt] * SLICES, pa.int32()), "slice": pa.array(range(SLICES), pa.int32()), "counts": pa.array([sh.squeezed(p, random=False) for p in parts], pa.binary())})


def _summed(table: pa.Table) -> pa.Table:
    total = sh.released(table, "counts", np.int64, BUCKETS // SLICES).reshape(-1, BUCKETS // SLICES).sum(axis=0)
    first = table.slice(0, 1)
    return pa.table({"salt": first.column("salt"), "slice": first.column("slice"), "counts": pa.array([sh.squeezed(total, random=False)], pa.binary())})


def model(texts: DataFrame) -> np.ndarray:
    """N-gram counts by bucket, over all rows. Each task sums its own; the driver gets ``BUCKETS`` numbers."""
    form = "salt int, slice int, counts binary"
    sums = texts.mapInArrow(_counts, form).groupBy("salt", "slice").applyInArrow(_summed, form).groupBy("slice").applyInArrow(_summed, form)
    total = np.zeros((SLICES, BUCKETS // SLICES), np.int64)
    for row in sums.select("slice", "counts").toLocalIterator():
        total[row["slice"]] = sh.released(pa.table({"counts": [bytes(row["counts"])]}), "counts", np.int64)
    return total.ravel()


def log_ratios(target: np.ndarray, raw: np.ndarray, smoothing: float = 2.0) -> np.ndarray:
    """log P(bucket | target) - log P(bucket | raw); 0 without target text.

    ``smoothing`` is added to a bucket's count in the target and to the count to be expected there from the raw
    text, so that a rare n-gram, which the target may lack by chance, has a ratio near 1.
    """
    if not target.sum() or not raw.sum():
        return np.zeros(len(raw))
    return np.log((target + smoothing) / (raw * (target.sum() / raw.sum()) + smoothing)).astype(np.float32)


def gumbel(ids: np.ndarray, seed: int) -> np.ndarray:
    u = (tx.mix(tx.mix(ids.astype(np.int64).view(np.uint64)) ^ np.uint64(seed)) >> np.uint64(11)).astype(np.float64)
    return -np.log(-np.log((u + 0.5) / 2**53))


def _scores(ratios: np.ndarray, against: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted = np.where(ratios < against, ratios, 0)
        for batch in batches:
            ids, marks, texts = sh.columns_of(batch, "doc_id", "mark", "text")
            n, sums, tails = np.zeros(len(ids), np.int64), np.zeros(len(ids)), np.zeros(len(ids))
            for chunk in tx.chunks(texts):
                bucket, row = features(chunk)
                part = slice(chunk.first, chunk.first + chunk.rows)
                n[part] = np.bincount(row, minlength=chunk.rows)
                sums[part] = np.bincount(row, ratios[bucket], minlength=chunk.rows)
                tails[part] = np.bincount(row, counted[bucket], minlength=chunk.rows)
            empty = n == 0
            weight = tails / np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays(
                [ids, marks, pa.array(n), pa.array(sums, mask=empty), pa.array(weight, mask=empty)], names=["doc_id", "mark", "n_features", "log_ratio", "weight"]
            )

    return run


def _keys(scale: float, seed: int) -> Callable:
    """The draw's key: the weight in units of ``scale``, and Gumbel noise from the id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, weight = sh.columns_of(batch, "doc_id", "weight")
            key = weight.fill_null(0).to_numpy() / scale + gumbel(ids.fill_null(0).to_numpy(), seed)
            yield batch.append_column("key", pa.array(key, mask=weight.is_null().to_numpy(zero_copy_only=False)))

    return run


def kth_largest(scored: DataFrame, k: int) -> float:
    """The k-th largest key, by counts in ever narrower bins; the driver never has more than ``FEW`` keys."""
    low, high, n = scored.agg(F.min("key"), F.max("key"), F.count("key")).first()
    if not n or k >= n:
        return -math.inf
    if k <= 0:
        return math.inf
    above, inside = 0, scored.where("key IS NOT NULL").select("key")
    while n > FEW and low < high:
        width = (high - low) / 1000
        if low + width == low:
            break
        bins = inside.select(F.least(F.floor((F.col("key") - low) / width), F.lit(999)).alias("bin"), "key")
        rows = bins.groupBy("bin").agg(F.count("key").alias("n"), F.min("key").alias("low"), F.max("key").alias("high")).orderBy(F.desc("bin")).collect()
        for row in rows:
            if above + row["n"] >= k:
                break
            above += row["n"]
        low, high, n = row["low"], row["high"], row["n"]
        inside = inside.where(F.col("key").between(low, high))
    if low == high or n > FEW:
        return low
    return inside.orderBy(F.desc("key")).limit(k - above).agg(F.min("key")).first()[0]


def resample(
    docs: DataFrame,
    labels: DataFrame,
    keep: float | None = None,
    lose: float = 0.025,
    against: float = -0.8,
    temperature: float = 0.05,
    seed: int = 1,
    sample: int = 20_000,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Importance weights of all documents, and which of them a Gumbel top-k draw selects.

    The target model counts hashed words and word pairs of documents labelled ``quality = 1`` and not
    toxic (a sample of at most ``sample`` labelled rows: those with the least hashes of their ids); the
    raw model counts those of all documents. A document's importance is the ratio of both models,
    ``log_ratio`` its logarithm. That sum follows the length of a text more than its kind, so the draw's
    weight is the evidence against the target alone: the n-grams' log-ratios below ``against``, summed and
    divided by the number of n-grams. Its key is the weight, in units of ``temperature`` times the cut's
    size, plus Gumbel noise from the id, and the documents with the k largest keys are selected.

    k is the number of documents, of all, with a weight at or above a cut: that below which lies the share
    ``lose`` of the target rows that were held out from the model (a fifth). ``keep`` gives k as a share instead.

    One row for each row of ``docs``: doc_id, mark (hash of the text), n_features, log_ratio, weight, key, selected.

    * null or empty text: no weight, never selected; null doc_id: noise as for id 0
    * rows with the key of the last selected one are selected too; so repeated rows fare alike
    * no labels, or none of the target: all weights are 0 and every document with words is selected; with
      fewer than 20 target rows held out nothing is known of the cut, and none is made
    * other columns are ignored, whatever their names
    """
    rows = sh.with_mark(docs, doc_id, text)
    good = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic").where("doc_id IS NOT NULL AND quality IS NOT NULL")
    target = good.where("quality = 1 AND coalesce(toxic, 0) = 0").select("doc_id").distinct()
    some = target.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    held_out = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(5)) == 0
    ratios = log_ratios(model(rows.join(F.broadcast(some.where(~held_out)), "doc_id", "left_semi").select("text")), model(rows.select("text")))
    weighed = materialise(rows.mapInArrow(_scores(ratios, against), WEIGHED))

    tested = weighed.join(F.broadcast(some.where(held_out)), "doc_id", "left_semi").where("weight IS NOT NULL")
    n, cut = tested.agg(F.count(F.lit(1)), F.percentile("weight", F.lit(lose))).first()
    if not ratios.any() or n < 20:
        cut = None
    scale = temperature * abs(cut) if cut else temperature * abs(against)
    scored = materialise(weighed.mapInArrow(_keys(scale, seed), SCORED))
    total, above = scored.agg(F.count(F.lit(1)), F.count_if(F.col("weight") >= (-math.inf if cut is None else cut))).first()
    k = above if keep is None else math.ceil(keep * total)
    limit = kth_largest(scored, k) if ratios.any() else -math.inf
    return scored.withColumn("selected", F.coalesce(F.col("key") >= F.lit(limit), F.lit(False)))
