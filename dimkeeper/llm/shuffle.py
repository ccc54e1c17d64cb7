"""Packing arrays by bucket, so that Spark shuffles a few large rows instead of one row for each number."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimkeeper.llm import text as tx
from dimkeeper.llm.ship import ship

#: Values that a task gathers before it sends them.
FLUSH = 2_000_000


def buckets(spark: SparkSession) -> int:
    """A few buckets for each shuffle partition: a bucket is what one Python call has in memory."""
    return 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucket_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """Small numbers where they do, as those sort faster."""
    return ((hashes >> np.uint64(32)) % np.uint64(n)).astype(np.uint16 if n <= 1 << 16 else np.int32)


def packed(hashes: np.ndarray, columns: dict[str, np.ndarray], n: int) -> pa.RecordBatch:
    """One row for each bucket: the bucket and, of each column, the bytes of its values there."""
    bucket = bucket_of(hashes, n)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    at = tx.groups(bucket)
    out = {"bucket": pa.array(bucket[at[:-1]].astype(np.int32))}
    out |= {name: tx.binaries(values[order], at) for name, values in columns.items()}
    return pa.RecordBatch.from_pydict(out)


def packed_runs(hashes: np.ndarray, owners: dict[str, np.ndarray], values: dict[str, np.ndarray], n: int) -> pa.RecordBatch:
    """The same, with the owners' columns once for each run of values of one owner, and ``run``, the runs' lengths.

    The first column of ``owners`` tells them apart; the values of one owner are together.
    """
    bucket = bucket_of(hashes, n)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    key = next(iter(owners.values()))[order]
    runs = tx.groups(bucket, key)
    first = order[runs[:-1]]
    at, of_runs = tx.groups(bucket), tx.groups(bucket[runs[:-1]])
    out = {"bucket": pa.array(bucket[at[:-1]].astype(np.int32)), "run": tx.binaries(np.diff(runs).astype(np.int32), of_runs)}
    out |= {name: tx.binaries(v[first], of_runs) for name, v in owners.items()}
    out |= {name: tx.binaries(v[order], at) for name, v in values.items()}
    return pa.RecordBatch.from_pydict(out)


def packed_table(ids: np.ndarray, columns: dict[str, np.ndarray], n: int) -> pa.Table:
    """The same by the hash of an id."""
    return pa.Table.from_batches([packed(tx.mix(ids.view(np.uint64)), columns, n)])


def unpacked(table: pa.Table, name: str, dtype: type, width: int = 1) -> np.ndarray:
    """All values of a packed column."""
    parts = [np.frombuffer(x.as_buffer(), dtype) for x in table.column(name) if x.is_valid]
    values = np.concatenate(parts) if parts else np.zeros(0, dtype)
    return values.reshape(-1, width) if width > 1 else values


def squeezed(values: np.ndarray, random: bool) -> bytes:
    """The bytes of an array, behind their number; compressed if they are not random."""
    body = values.tobytes()
    return len(body).to_bytes(8, "little", signed=True) + body if random else (-len(body)).to_bytes(8, "little", signed=True) + pa.compress(body, "zstd", asbytes=True)


def released(table: pa.Table, name: str, dtype: type, width: int = 1) -> np.ndarray:
    """All values of a column of ``squeezed`` arrays."""
    parts = []
    for x in table.column(name):
        raw = x.as_py()
        size = int.from_bytes(raw[:8], "little", signed=True)
        parts.append(np.frombuffer(raw[8:] if size >= 0 else pa.decompress(raw[8:], -size, "zstd", asbytes=True), dtype) if size else np.zeros(0, dtype))
    values = np.concatenate(parts) if parts else np.zeros(0, dtype)
    return values.reshape(-1, width) if width > 1 else values


def by_document(ids: np.ndarray, marks: np.ndarray, values: np.ndarray, name: str) -> pa.Table:
    """Rows (doc_id, mark, bytes of the values), one for each document."""
    order = np.lexsort((marks, ids))
    ids, marks, values = ids[order], marks[order], values[order]
    at = tx.groups(ids, marks)
    first = at[:-1]
    return pa.table({"doc_id": ids[first], "mark": marks[first], name: tx.binaries(values, at)})


class Gather:
    """Collects equal-length arrays and gives them back together."""

    def __init__(self, *names: str) -> None:
        self.parts: dict[str, list[np.ndarray]] = {n: [] for n in names}
        self.size = 0

    def add(self, **arrays: np.ndarray) -> None:
        for name, values in arrays.items():
            self.parts[name].append(values)
        self.size += len(values)

    def full(self) -> bool:
        return self.size >= FLUSH

    def take(self) -> dict[str, np.ndarray]:
        out = {n: np.concatenate(v) for n, v in self.parts.items()}
        self.parts, self.size = {n: [] for n in self.parts}, 0
        return out


def with_mark(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, mark, text): id and a hash of the text name a row, also where an id is repeated."""
    ship(docs.sparkSession)
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    # A needless alias would hide from Spark that two uses of these rows share an exchange.
    plain = doc_id == "doc_id" and dict(docs.dtypes)[doc_id] == "bigint"
    own = F.col(doc_id) if plain else F.col(doc_id).cast("long").alias("doc_id")
    return docs.select(own, F.xxhash64(body).alias("mark"), body.alias("text"))


def gathered(replies: DataFrame, column: str) -> DataFrame:
    """One row for each document, with all its replies in an array."""
    return replies.groupBy("doc_id", "mark").agg(F.collect_list(column).alias(column))


def numbers(scalar: pa.Scalar, dtype: type) -> np.ndarray:
    """The values of an array of packed bytes."""
    if not scalar.is_valid:
        return np.zeros(0, dtype)
    return np.frombuffer(b"".join(x.as_py() for x in scalar.values), dtype)


def columns_of(batch: pa.RecordBatch, *names: str) -> Iterator[pa.Array]:
    return (batch.column(batch.schema.get_field_index(n)) for n in names)
