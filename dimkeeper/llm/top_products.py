"""Exact top-k by inner product: norm buckets, pruned by length or by coordinates, products verified.

Candidates lie in buckets of like length, longest first. Where a query holds k products already, the
least of them over |q| times the bucket's greatest length is the cosine that a vector must reach
there. Above 1 the bucket is skipped. A high cosine prunes by coordinates: the angle of a vector to
an axis differs from the query's by at most the angle between the two, so the query's greatest
coordinates leave a window for the vector's. A low one prunes by length alone. What is left is
verified by its integer product. Nothing is approximate: bounds only ever discard what cannot win.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimkeeper.llm import shuffle as sh
from dimkeeper.llm import text as tx
from dimkeeper.llm.ship import ship
from dimkeeper.sources.scratch import materialise

VECTORS = "tag long, vec_id long, asks boolean, size int, norm double, vector binary"
QUERIES = VECTORS + ", least long"
BUCKETS = "part int, size int, longest double, norms binary, tags binary, ids binary, named binary, matrix binary"
BLOCKS = "block long, size int, need double, norms binary, tags binary, ids binary, named binary, matrix binary, least binary, parts array<int>"
FOUND = "tag long, query_id long, vec_id long, score long"

#: Bytes of the vectors of a bucket; rows of a group of buckets at most and at least, of a slab of queries, of a block of queries.
BUCKET_BYTES, GROUP_ROWS, LEAST_ROWS, SLAB_ROWS, BLOCK_ROWS = 1 << 20, 131_072, 4096, 65_536, 1024
#: Local cosine from which coordinates prune, and how many of them are looked at.
COSINE, COORDINATES = 0.6, 4
#: What rounding may add to a bound.
SLACK = 1e-9

_NONE = np.iinfo(np.int64).min


def _integers(scale: float) -> Callable:
    """Whole vectors as integers; those with a null or non-finite component are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tags, ids, asks, lists = sh.columns_of(batch, "tag", "vec_id", "asks", "vector")
            lists = lists.cast(pa.large_list(pa.float64()))
            flat = lists.flatten()
            values = pc.fill_null(flat, math.nan).to_numpy(zero_copy_only=False)
            size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
            ends = np.cumsum(size)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
            use = np.flatnonzero(lists.is_valid().to_numpy(zero_copy_only=False) & (bad[ends] == bad[ends - size]))
            with np.errstate(all="ignore"):
                whole = np.floor(scale * values)
            out: dict[str, list] = {n: [] for n in ("norm", "vector")}
            for k in use:
                vector = whole[ends[k] - size[k] : ends[k]]
                if len(vector) and np.abs(vector).max() >= 2.0**62:
                    raise ValueError("a component is too great for products of 64 bits")
                out["norm"].append(float(np.sqrt((vector * vector).sum())))
                out["vector"].append(vector.astype(np.int64).tobytes())
            columns = [x.take(pa.array(use)) for x in (tags, ids, asks)]
            columns += [pa.array(size[use], pa.int32()), pa.array(out["norm"], pa.float64()), pa.array(out["vector"], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["tag", "vec_id", "asks", "size", "norm", "vector"])

    return run


@dataclass
class Vectors:
    """Vectors of one number of components."""

    size: int
    norms: np.ndarray
    tags: np.ndarray
    ids: np.ndarray
    named: np.ndarray  # whether the id is not null
    matrix: np.ndarray

    @classmethod
    def unpacked(cls, row: dict) -> Vectors:
        norms = np.frombuffer(row["norms"], np.float64)
        tags, ids, matrix = (np.frombuffer(row[n], np.int64) for n in ("tags", "ids", "matrix"))
        return cls(row["size"], norms, tags, ids, np.frombuffer(row["named"], bool), matrix.reshape(len(norms), row["size"]))

    def packed(self) -> dict:
        return {"size": self.size, "matrix": self.matrix.tobytes()} | {n: getattr(self, n).tobytes() for n in ("norms", "tags", "ids", "named")}


def _pieces(batches: Iterator[pa.RecordBatch], rows_of: Callable[[int], int]) -> Iterator[tuple[Vectors, pa.Table]]:
    """Stretches of rows with one number of components, at most ``rows_of(components)`` each."""
    held: pa.Table | None = None

    def cut(table: pa.Table) -> tuple[Vectors, pa.Table]:
        size = table.column("size")[0].as_py()
        ids = table.column("vec_id")
        matrix = np.frombuffer(b"".join(table.column("vector").to_pylist()), np.int64).reshape(table.num_rows, size)
        named = ids.is_valid().to_numpy()
        return Vectors(size, table.column("norm").to_numpy(), table.column("tag").to_numpy(), pc.fill_null(ids, 0).to_numpy(), named, matrix), table

    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]) if held is not None else table
        while table.num_rows:
            sizes = table.column("size").to_numpy()
            most = min(rows_of(int(sizes[0])), int(tx.groups(sizes)[1]))
            if most == table.num_rows and most < rows_of(int(sizes[0])):
                break  # more of them may follow
            yield cut(table.slice(0, most))
            table = table.slice(most)
        held = table
    if held is not None and held.num_rows:
        yield cut(held)


def _rows_in_bucket(size: int) -> int:
    return max(16, BUCKET_BYTES // (8 * max(size, 1)))


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    schema = pa.schema([("part", pa.int32()), ("size", pa.int32()), ("longest", pa.float64()), *((n, pa.binary()) for n in ("norms", "tags", "ids", "named", "matrix"))])
    for vectors, _ in _pieces(batches, _rows_in_bucket):
        yield pa.RecordBatch.from_pylist([vectors.packed() | {"part": part, "longest": float(vectors.norms.max())}], schema)


def _need(least: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """The length below which no vector can reach the product ``least``."""
    with np.errstate(all="ignore"):
        need = least / norms * (1 - SLACK)
    return np.where((least > 0) & (norms > 0), need, -1.0)


def _blocks(longest: np.ndarray) -> Callable:
    """``longest``: of each part of the candidates, its greatest length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        schema = pa.schema(
            [("block", pa.int64()), ("size", pa.int32()), ("need", pa.float64()), *((n, pa.binary()) for n in ("norms", "tags", "ids", "named", "matrix", "least")), ("parts", pa.list_(pa.int32()))]
        )
        for vectors, table in _pieces(batches, lambda _: BLOCK_ROWS):
            least = table.column("least").to_numpy()
            need = float(_need(least, vectors.norms).min())
            row = vectors.packed() | {"block": block, "need": need, "least": least.tobytes(), "parts": np.flatnonzero(longest >= need).tolist()}
            yield pa.RecordBatch.from_pylist([row], schema)
            block += 1

    return run


def _products(matrix: np.ndarray, other: np.ndarray, bound: float) -> np.ndarray:
    """Exact integer products of rows; ``bound``: the greatest product of two lengths."""
    if bound < 2.0**52:
        return (matrix.astype(np.float64) @ other.astype(np.float64).T).astype(np.int64)
    if bound < 2.0**62:
        return matrix @ other.T
    raise ValueError("a product may pass 64 bits")


class Best:
    """The k best products of each query of a block, ties to the smaller id, null ids last."""

    def __init__(self, k: int, least: np.ndarray) -> None:
        self.k, self.least = k, least.copy()
        self.query, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.named = np.zeros(0, bool)

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray, named: np.ndarray) -> None:
        query, score = np.concatenate([self.query, query]), np.concatenate([self.score, score])
        ids, named = np.concatenate([self.id, ids]), np.concatenate([self.named, named])
        order = np.lexsort((ids, ~named, -score, query))
        at = tx.groups(query[order])
        place = np.arange(len(order)) - np.repeat(at[:-1], np.diff(at))
        kept = order[place < self.k]
        self.query, self.score, self.id, self.named = query[kept], score[kept], ids[kept], named[kept]
        last = order[place == self.k - 1]
        self.least[query[last]] = np.maximum(self.least[query[last]], score[last])


def _in_windows(unit: np.ndarray, query: np.ndarray, cosine: float) -> np.ndarray:
    """Columns of ``unit`` that may lie within the angle of ``cosine`` to the unit vector ``query``."""
    angle = math.acos(min(1.0, cosine)) + 1e-7
    left = None
    for f in np.argsort(-np.abs(query), kind="stable")[:COORDINATES]:
        own = math.acos(max(-1.0, min(1.0, float(query[f]))))
        low = math.cos(min(math.pi, own + angle)) - SLACK
        high = math.cos(max(0.0, own - angle)) + SLACK
        value = unit[f] if left is None else unit[f, left]
        inside = np.flatnonzero((value >= low) & (value <= high))
        left = inside if left is None else left[inside]
    return np.arange(unit.shape[1]) if left is None else left


def _search(queries: Vectors, bucket: Vectors, unit: np.ndarray | None, best: Best) -> None:
    """Adds the products of a block of queries with a bucket (by falling length) to the best ones."""
    longest = float(bucket.norms[0])
    need = _need(best.least, queries.norms)
    active = np.flatnonzero(need <= longest)
    if not len(active):
        return
    bound = float(queries.norms.max()) * longest
    cosine = need[active] / longest if longest > 0 else np.full(len(active), -1.0)
    narrow = (cosine >= COSINE) if unit is not None else np.zeros(len(active), bool)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # query, place in the bucket, score

    by_length = active[~narrow]
    if len(by_length):
        reach = int(np.searchsorted(-bucket.norms, -max(0.0, float(need[by_length].min())), "right"))
        scores = _products(queries.matrix[by_length], bucket.matrix[:reach], bound)
        if scores.shape[1] > best.k:  # the k-th best here is a bound too; a query's own row may be among them
            kth = np.partition(scores, -(best.k + 1), axis=1)[:, -(best.k + 1)]
            floor = np.maximum(best.least[by_length], kth)
        else:
            floor = best.least[by_length]
        q, c = np.nonzero(scores >= floor[:, None])
        found.append((by_length[q], c, scores[q, c]))
    for k in np.flatnonzero(narrow):
        q = active[k]
        places = _in_windows(unit, queries.matrix[q] / queries.norms[q], float(cosine[k]))
        scores = _products(queries.matrix[q : q + 1], bucket.matrix[places], bound)[0]
        keep = scores >= best.least[q]
        found.append((np.full(int(keep.sum()), q), places[keep], scores[keep]))

    query, place, score = (np.concatenate(x) for x in zip(*found, strict=True))
    other = bucket.tags[place] != queries.tags[query]
    query, place, score = query[other], place[other], score[other]
    best.add(query, score, bucket.ids[place], bucket.named[place])


def _unit(bucket: Vectors) -> np.ndarray | None:
    """Components by axis, of unit length; None where a vector has no length."""
    if not bucket.size or not bucket.norms[-1]:
        return None
    return np.ascontiguousarray((bucket.matrix / bucket.norms[:, None]).T)


def _cell(k: int) -> Callable:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {n: [] for n in ("tag", "query_id", "vec_id", "score")}
        if left.num_rows and right.num_rows:
            buckets = sorted((Vectors.unpacked(r) for r in left.to_pylist()), key=lambda b: -b.norms[0])
            units = [_unit(b) for b in buckets]
            for row in right.to_pylist():
                queries = Vectors.unpacked(row)
                best = Best(k, np.frombuffer(row["least"], np.int64))
                for bucket, unit in zip(buckets, units, strict=True):
                    if bucket.size == queries.size:
                        _search(queries, bucket, unit, best)
                out["tag"].append(pa.array(queries.tags[best.query]))
                out["query_id"].append(pa.array(queries.ids[best.query], mask=~queries.named[best.query]))
                out["vec_id"].append(pa.array(best.id, mask=~best.named))
                out["score"].append(pa.array(best.score))
        return pa.table({n: pa.chunked_array(v, pa.int64()) for n, v in out.items()})

    return run


def _first_bounds(k: int, heads: list[Vectors]) -> Callable:
    """Adds ``least``: a product that a query's k-th best reaches at least, from the longest vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least = np.full(batch.num_rows, _NONE)
            places = pa.table({"place": np.arange(batch.num_rows), "size": batch.column("size")}).sort_by("size").column("place").to_numpy()
            at = 0
            for queries, _ in _pieces(iter([batch.take(pa.array(places))]), lambda _: BLOCK_ROWS):
                best = Best(k, np.full(len(queries.tags), _NONE))
                for head in heads:
                    if head.size == queries.size:
                        _search(queries, head, None, best)
                least[places[at : at + len(queries.tags)]] = best.least
                at += len(queries.tags)
            yield batch.append_column("least", pa.array(least))

    return run


def top_products(vectors: DataFrame, is_query: Column, k: int = 10, scale: float = 1024, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """The ``k`` greatest inner products of each query row with all other rows.

    Components are taken as floor(``scale`` * x), x as double, so products are whole and exact.
    Returns query_id, rank (from 1), vec_id, score; ties go to the smaller vec_id, a null one last.

    * a null vector, or one with a null or non-finite component, takes no part
    * fewer than ``k`` other vectors: all of them; vectors of another length than the query's are not compared
    * repeated ids or rows: each row is a vector of its own, the query's own row alone is left out; a
      repeated query has its rows once for each repetition
    * null id: a candidate like any other; never a query unless ``is_query`` says so
    * products that may pass 64 bits are an error
    * other columns are ignored, whatever their names

    The driver sees the number of vectors, one greatest length for each group of candidates, one bound for each block
    of queries, and the longest bucket (1 MiB) of each of the four most frequent numbers of components.
    """
    spark = vectors.sparkSession
    ship(spark)
    numbered = vectors.select(
        F.monotonically_increasing_id().alias("tag"),
        F.col(vec_id).cast("long").alias("vec_id"),
        F.col(embedding).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    # Written once: the row numbers name the rows from here on.
    stored = materialise(numbered)
    whole = materialise(stored.mapInArrow(_integers(scale), VECTORS))

    n = whole.count()
    # Each part sends on the k best of each query, so small parts do not pay.
    parts = max(1, -(-n // GROUP_ROWS), min(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), n // LEAST_ROWS))
    order = [F.col("size"), F.col("norm").desc(), F.col("tag")]
    dealt = whole.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    buckets = materialise(dealt.mapInArrow(_buckets, BUCKETS))
    by_part = {row["part"]: row["longest"] for row in buckets.groupBy("part").agg(F.max("longest").alias("longest")).collect()}
    longest = np.array([by_part.get(p, -np.inf) for p in range(max(by_part, default=-1) + 1)])
    best = F.max_by(F.struct("part", "longest"), "longest").alias("best")
    sizes = buckets.groupBy("size").agg(F.count("*").alias("n"), best).orderBy(F.desc("n"), "size").limit(4).collect()
    heads = []
    for row in sizes:
        here = (F.col("part") == row["best"]["part"]) & (F.col("size") == row["size"]) & (F.col("longest") == row["best"]["longest"])
        heads.append(Vectors.unpacked(buckets.where(here).first().asDict()))

    bounded = materialise(whole.where("asks").mapInArrow(_first_bounds(k, heads), QUERIES))
    need = F.when((F.col("least") > 0) & (F.col("norm") > 0), F.col("least") / F.col("norm")).otherwise(-1.0)
    by_need = bounded.repartitionByRange(need.desc(), "tag").sortWithinPartitions("size", need.desc(), "tag")
    blocks = materialise(by_need.mapInArrow(_blocks(longest), BLOCKS))

    # Blocks of like need make a slab; a group of candidates meets a slab at a time.
    slab_of, needs, held = [], [], SLAB_ROWS
    for row in blocks.select("block", "need", F.expr("length(norms) div 8 AS n")).orderBy(F.desc("need"), "block").collect():
        if held + row["n"] > SLAB_ROWS:
            needs.append(row["need"])
            held = 0
        held, needs[-1] = held + row["n"], row["need"]
        slab_of.append((row["block"], len(needs) - 1))
    blocks = blocks.join(spark.createDataFrame(slab_of, "block long, slab int"), "block")
    known = F.array(*[F.struct(F.lit(s).alias("slab"), F.lit(float(need)).alias("need")) for s, need in enumerate(needs)])
    none = F.expr("CAST(array() AS array<struct<slab: int, need: double>>)")
    reached = F.filter(known if needs else none, lambda s: s["need"] <= F.col("longest"))
    left = buckets.withColumn("slab", F.explode(F.transform(reached, lambda s: s["slab"])))
    right = blocks.withColumn("part", F.explode("parts"))
    found = left.groupBy("part", "slab").cogroup(right.groupBy("part", "slab")).applyInArrow(_cell(k), FOUND)
    rank = F.expr("row_number() OVER (PARTITION BY tag ORDER BY score DESC, vec_id ASC NULLS LAST)")
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
