"""N-gram Jaccard join: a blocked product of the document by n-gram incidence matrix with itself.

Rows of the matrix are distinct n-gram sets (documents with the same set are one row), columns are
n-grams. The size of a set bounds the overlap that a partner must have, and everything below such a
bound is dropped as early as it shows:

1. *Column blocks over prefixes.* With one order of n-grams for all, two linked sets share a number
   of n-grams within the first part of either. Sets without enough n-grams that any other set has
   there have no partner.
2. *Column blocks over the sets that are left.* An n-gram that only one set has adds to no overlap;
   a set with fewer other n-grams than its bound has no partner.
3. *Row blocks.* Sets are put in blocks of bounded size beside the sets they share rare n-grams
   with. The overlaps within a block are accumulated over slices of columns, and pairs below the
   bound are dropped there; a block gives a spanning forest of its links, never all its pairs.
4. Pairs of blocks are multiplied only for sets that share a prefix n-gram and are not yet known to
   be connected.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimkeeper.llm import shuffle as sh
from dimkeeper.llm import text as tx
from dimkeeper.llm.components import components, least_ids, node_name
from dimkeeper.llm.repeats import ranges
from dimkeeper.sources.scratch import materialise

#: Sets in a row block.
BLOCK = 512

#: Columns that are multiplied at once.
COLUMNS = 4096

U64 = np.uint64


def needed(sizes: np.ndarray, percent: int) -> np.ndarray:
    """The overlap that a set of this size needs at least with any partner."""
    return -(-sizes * percent // 100)


def linked(overlap: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    return (overlap > 0) & (100 * overlap >= percent * (a + b - overlap))


def shared_part(sizes: np.ndarray, percent: int) -> np.ndarray:
    """How many n-grams of their prefixes linked sets share at least (of the smaller set's number)."""
    return sizes * (100 - percent) // 200 + 1


def prefix(sizes: np.ndarray, percent: int) -> np.ndarray:
    """Length of the prefix that holds them: the k-th common n-gram is at most the (n - t + k)-th."""
    return np.minimum(sizes, sizes - needed(sizes, percent) + shared_part(sizes, percent))


def shingles(chunk: tx.Chunk, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of each row, sorted within it, and the first of each row."""
    data = tx.lowered(chunk.data)
    found = tx.words(tx.Chunk(0, chunk.offsets, data))
    hashes, counts = found.hashes(data), found.counts()
    grams = tx.Prefix.of(hashes).windows(n)
    row = found.row[: len(grams)]
    whole = found.first[row + 1] - np.arange(len(grams)) >= n
    short = np.flatnonzero((counts > 0) & (counts < n))
    few = tx.mix(tx.Prefix.of(hashes).stretch(found.first[short], found.first[short + 1]) + counts[short].astype(U64))
    values, rows = np.concatenate([grams[whole], few]), np.concatenate([row[whole], short])
    order = np.lexsort((values, rows))
    values, rows = values[order], rows[order]
    at = tx.groups(rows, values)[:-1]
    return values[at], np.searchsorted(rows[at], np.arange(chunk.rows + 1))


def _profiles(n: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks, texts = sh.columns_of(batch, "doc_id", "mark", "text")
            sizes, names = [], []
            for chunk in tx.chunks(texts):
                values, first = shingles(chunk, n)
                sizes.append(np.diff(first))
                # Two sums of mixed hashes name a set.
                sums = [np.concatenate([[U64(0)], np.cumsum(tx.mix(values * U64(m)))]) for m in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)]
                names.append(np.stack([s[first[1:]] - s[first[:-1]] for s in sums], axis=1))
            name = np.concatenate(names) if names else np.zeros((0, 2), U64)
            yield pa.RecordBatch.from_arrays(
                [ids, marks, pa.array(np.concatenate(sizes) if sizes else [], pa.int64()), tx.binaries(name, np.arange(len(name) + 1))],
                names=["doc_id", "mark", "n_shingles", "name"],
            )

    return run


def _prefix_columns(n: int, percent: int, n_buckets: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = sh.Gather("gram", "doc_id", "mark")
        for batch in batches:
            ids, marks, texts = sh.columns_of(batch, "doc_id", "mark", "text")
            ids, marks = ids.to_numpy(), marks.to_numpy()
            for chunk in tx.chunks(texts):
                values, first = shingles(chunk, n)
                take = prefix(np.diff(first), percent)
                rows = chunk.first + np.repeat(np.arange(chunk.rows), take)
                have.add(gram=values[ranges(first[:-1], take)], doc_id=ids[rows], mark=marks[rows])
                if have.full():
                    out = have.take()
                    yield sh.packed(tx.mix(out["gram"]), out, n_buckets)
        if have.size:
            out = have.take()
            yield sh.packed(tx.mix(out["gram"]), out, n_buckets)

    return run


def _shared_counts(n_buckets: int) -> Callable:
    """Of each row, how many of its n-grams in this block of columns another row has."""

    def run(table: pa.Table) -> pa.Table:
        gram, ids, marks = sh.unpacked(table, "gram", U64), sh.unpacked(table, "doc_id", np.int64), sh.unpacked(table, "mark", np.int64)
        order = np.argsort(gram)
        size = np.diff(tx.groups(gram[order]))
        keep = order[np.repeat(size > 1, size)]
        keep = keep[np.lexsort((marks[keep], ids[keep]))]
        at = tx.groups(ids[keep], marks[keep])
        first = keep[at[:-1]]
        return sh.packed_table(ids[first], {"doc_id": ids[first], "mark": marks[first], "n": np.diff(at)}, n_buckets)

    return run


def _summed_counts(table: pa.Table) -> pa.Table:
    ids, marks, n = (sh.unpacked(table, c, np.int64) for c in ("doc_id", "mark", "n"))
    order = np.lexsort((marks, ids))
    at = tx.groups(ids[order], marks[order])
    first = order[at[:-1]]
    return pa.table({"doc_id": ids[first], "mark": marks[first], "shared": np.add.reduceat(n[order], at[:-1]) if len(first) else n[:0]})


def _sets(n: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, texts = sh.columns_of(batch, "row", "text")
            for chunk in tx.chunks(texts):
                values, first = shingles(chunk, n)
                yield pa.RecordBatch.from_arrays(
                    [rows.slice(chunk.first, chunk.rows), pa.array(np.diff(first), pa.int64()), tx.binaries(values, first)], names=["row", "n", "grams"]
                )

    return run


COLUMNS_FORM = "bucket int, run binary, row binary, n binary, gram binary"


def _columns(n_buckets: int) -> Callable:
    def flush(have: sh.Gather) -> pa.RecordBatch:
        out = have.take()
        return sh.packed_runs(tx.mix(out["gram"]), {"row": out["row"], "n": out["n"]}, {"gram": out["gram"]}, n_buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = sh.Gather("gram", "row", "n")
        for batch in batches:
            rows, grams = sh.columns_of(batch, "row", "grams")
            for row, packed in zip(rows.to_numpy(), grams, strict=True):
                values = np.frombuffer(packed.as_buffer(), U64)
                have.add(gram=values, row=np.full(len(values), row), n=np.full(len(values), len(values), np.int32))
                if have.full():
                    yield flush(have)
        if have.size:
            yield flush(have)

    return run


def _by_row(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    run = sh.unpacked(table, "run", np.int32)
    return np.repeat(sh.unpacked(table, "row", np.int64), run), np.repeat(sh.unpacked(table, "n", np.int32), run)


def _column_sizes(n_buckets: int) -> Callable:
    """N-grams that several rows have, with the number of rows (up to 65,535 it tells the rarer one)."""

    def run(table: pa.Table) -> pa.Table:
        gram, (rows, n) = sh.unpacked(table, "gram", U64), _by_row(table)
        order = np.argsort(gram)
        size = np.diff(tx.groups(gram[order]))
        size = np.repeat(size, size)
        keep, size = order[size > 1], np.minimum(size[size > 1], 65_535).astype(np.uint16)
        again = np.argsort(rows[keep], kind="stable")
        keep, size = keep[again], size[again]
        key = tx.mix(rows[keep].view(U64))
        return pa.Table.from_batches([sh.packed_runs(key, {"row": rows[keep], "n": n[keep]}, {"gram": gram[keep], "size": size}, n_buckets)])

    return run


def _rare(percent: int) -> Callable:
    """The rarest n-grams of each row, as many as make sure to hold one that a partner has too."""

    def run(table: pa.Table) -> pa.Table:
        gram, size, (rows, n) = sh.unpacked(table, "gram", U64), sh.unpacked(table, "size", np.uint16), _by_row(table)
        order = np.lexsort((gram, size, rows))
        at = tx.groups(rows[order])
        have = np.diff(at)
        sizes = n[order][at[:-1]].astype(np.int64)
        # N-grams that only this row has come first in the order; then the rarest.
        bound = needed(sizes, percent)
        take = np.where(have >= bound, have - bound + 1, 0)
        best = order[ranges(at[:-1], take)]
        return pa.table({"row": rows[best], "gram": gram[best].view(np.int64)})

    return run


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections within a block, accumulated over slices of shared columns."""
    sizes = np.array([len(s) for s in sets])
    rows = np.repeat(np.arange(len(sets)), sizes)
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    at = tx.groups(values[order])
    count = np.diff(at)
    column = np.repeat(np.cumsum(count > 1) - 1, count)
    keep = np.repeat(count > 1, count)
    rows, column = rows[order][keep], column[keep]
    total = np.zeros((len(sets), len(sets)), np.float32)
    edges = np.searchsorted(column, np.arange(0, (column[-1] if len(column) else -1) + 1 + COLUMNS, COLUMNS))
    for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        part = np.zeros((len(sets), COLUMNS), np.float32)
        part[rows[a:b], column[a:b] - k * COLUMNS] = 1
        total += part @ part.T
    return total.astype(np.int64)


def forest(a: np.ndarray, b: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Links that connect what all the given links connect."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = root(x), root(y)
        if p != q:
            parent[p] = q
            out.append((x, y))
    return out


def _product(percent: int) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        rows = table.column("row").to_numpy()
        _, unique = np.unique(rows, return_index=True)
        rows, sizes = rows[unique], table.column("n").to_numpy()[unique]
        grams = table.column("grams")
        sets = [np.frombuffer(grams[int(i)].as_buffer(), U64) for i in unique]
        total = overlaps(sets)
        a, b = np.nonzero(np.triu(linked(total, sizes[:, None], sizes[None, :], percent), 1))
        links = forest(a, b, len(rows))
        x, y = (np.array(v, np.int64) for v in zip(*links, strict=True)) if links else (np.zeros(0, np.int64),) * 2
        return pa.table({"a": rows[x], "b": rows[y]})

    return run


def ngram_components(docs: DataFrame, n: int = 3, percent: int = 90, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Groups of documents linked by the Jaccard similarity of their word n-gram sets.

    Words are stretches without ASCII white space, A-Z lowered; fewer than ``n`` words are one
    n-gram. Two documents link at ``percent`` per cent or more. One row for each row of ``docs``:
    doc_id, mark (hash of the text), n_shingles and component_id, the smallest doc_id that links
    reach. No link between different texts is lost.

    * no words, null or empty text: an empty set, alone in its component
    * repeated rows: linked with each other, each has its row
    * null doc_id: n_shingles is counted, component_id is null, and nothing links through that row
    * other columns of ``docs`` are ignored, whatever their names
    """
    spark = docs.sparkSession
    rows = sh.with_mark(docs, doc_id, text)
    buckets = sh.buckets(spark)
    parts = max(1, buckets // 4)
    profiles = materialise(rows.mapInArrow(_profiles(n), "doc_id long, mark long, n_shingles long, name binary"))
    known = rows.where("doc_id IS NOT NULL")
    # A set's row goes by its least id, or by a name of its own where that id has another set too.
    classes = profiles.where("doc_id IS NOT NULL AND n_shingles > 0").groupBy("name", "n_shingles").agg(F.min(F.struct("doc_id", "mark")).alias("one"))
    classes = materialise(classes.select("name", "n_shingles", "one.doc_id", "one.mark").withColumn("row", node_name("doc_id", ["mark"])))

    counts = (
        known.mapInArrow(_prefix_columns(n, percent, buckets), "bucket int, gram binary, doc_id binary, mark binary")
        .groupBy("bucket")
        .applyInArrow(_shared_counts(parts), "bucket int, doc_id binary, mark binary, n binary")
        .groupBy("bucket")
        .applyInArrow(_summed_counts, "doc_id long, mark long, shared long")
    )
    # A partner may be smaller, and then only its number is sure to be shared.
    least = F.expr(f"(n_shingles * {percent} + 99) div 100 * {100 - percent} div 200 + 1")
    left = classes.join(counts, ["doc_id", "mark"]).where(F.col("shared") >= least)
    texts = known.join(left.select("doc_id", "mark", "row"), ["doc_id", "mark"]).dropDuplicates(["doc_id", "mark"])
    sets = materialise(texts.select("row", "text").mapInArrow(_sets(n), "row long, n long, grams binary"))

    rare = materialise(
        sets.mapInArrow(_columns(buckets), COLUMNS_FORM)
        .groupBy("bucket")
        .applyInArrow(_column_sizes(parts), f"{COLUMNS_FORM}, size binary")
        .groupBy("bucket")
        .applyInArrow(_rare(percent), "row long, gram long")
    )

    # Each row goes beside the first row (by number) that it shares the most rare n-grams with.
    heads = rare.groupBy("gram").agg(F.min("row").alias("head"), F.count(F.lit(1)).alias("k")).where("k > 1").drop("k")
    votes = rare.join(heads, "gram").groupBy("row", "head").count()
    beside = votes.groupBy("row").agg(F.max_by("head", F.struct("count", -F.col("head"))).alias("head"))
    sizes = beside.groupBy("head").agg(F.expr(f"count(1) div {BLOCK} + 1").alias("parts"))
    placed = materialise(beside.join(sizes, "head").select("row", "head", F.expr("pmod(xxhash64(row), parts)").alias("part"), "parts"))
    everywhere = placed.where("row = head OR parts > 1").select("head", "parts").distinct()
    with_head = everywhere.select(F.col("head").alias("row"), "head", F.explode(F.expr("sequence(0L, parts - 1)")).alias("part"))
    block = F.xxhash64("head", "part").alias("block")
    first = placed.select("row", block).unionByName(with_head.select("row", block)).distinct()
    product = _product(percent)
    inner = materialise(first.join(sets, "row").groupBy("block").applyInArrow(product, "a long, b long"))

    known_so_far = components(inner)
    named = placed.select("row", block).join(known_so_far.withColumnRenamed("node", "row"), "row", "left")
    spread = rare.join(named, "row").select("gram", "row", "block", F.coalesce("component", "row").alias("component"))
    # Of each n-gram its blocks, and whether a block has several components or only one.
    held = spread.groupBy("gram", "block").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    holders = held.groupBy("gram").agg(F.collect_list(F.struct("block", "low", "high")).alias("blocks"), F.min("low").alias("low"), F.max("high").alias("high"))
    several = holders.where("low <> high AND size(blocks) > 1").select("gram", "blocks")
    away = F.expr("transform(filter(blocks, b -> b.block <> block AND NOT (b.low = component AND b.high = component)), b -> b.block)")
    met = spread.join(several, "gram").select("row", "block", away.alias("away")).where("size(away) > 0")
    others = met.groupBy("row", "block").agg(F.array_distinct(F.flatten(F.collect_set("away"))).alias("away"))
    outer = others.select("row", "block", F.explode("away").alias("other")).select("row", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"))
    across = outer.join(sets, "row").groupBy("x", "y").applyInArrow(product, "a long, b long")

    groups = components(inner.unionByName(materialise(across)))
    found = classes.select("name", "doc_id", "row").join(groups.withColumnRenamed("node", "row"), "row", "left")
    found = least_ids(found, "doc_id").select("name", F.coalesce("component", "doc_id").alias("found"))
    result = profiles.join(found, "name", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("found", "doc_id")).alias("component_id")
    return result.select("doc_id", "mark", "n_shingles", own)
