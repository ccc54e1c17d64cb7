"""Embedding near-duplicates by NN-descent: a neighbour graph, refined through neighbours of neighbours.

Vectors are compared within their label. Equal vectors are one node. The first neighbours come from
random projections: a node is compared with the nodes that fall on the same sides. Each round then
brings a node's neighbours and the nodes that name it together at that node, where all of them are
compared; every node keeps the best it has met. A node whose whole list passes the threshold is
saturated: its list hides further links, so it is enlarged by the best neighbours outside of its
component, again and again while such links are found, and by all of its component, which is
compared in blocks. An audit compares a stated share of the nodes with all others, in blocks; more
rounds follow while its recall is too low, and after the last one a comparison of all nodes of a label.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimkeeper.llm import text as tx
from dimkeeper.llm.components import components, least_ids, node_name
from dimkeeper.llm.ngram_join import forest
from dimkeeper.llm.ship import ship
from dimkeeper.sources.scratch import materialise

#: Nodes that are compared with each other at once.
BLOCK = 512

LISTS = "node long, ids array<bigint>, sims array<float>"
LINKS = "node long, links long, other long"


def _matrix(column: pa.ChunkedArray | pa.Array, which: np.ndarray) -> np.ndarray:
    """The vectors of some rows, as a matrix of doubles."""
    return np.stack([np.frombuffer(column[int(i)].as_buffer(), np.float64) for i in which])


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x @ y.T) / np.outer(np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1))


def usable(vector: Column) -> Column:
    """Not null, not zero, all components finite."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))


def _packed(batches):  # noqa: ANN001, ANN202
    for batch in batches:
        arrays = batch.column(1)
        values, offsets = arrays.values.to_numpy(), arrays.offsets.to_numpy()
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), tx.binaries(values, offsets)], names=["node", "space", "vector"])


def _codes(trees: int, seed: int, bits: int = 24) -> Callable:
    """For each tree the sides of random planes that a vector is on, as many as its label's size asks for."""

    def run(batches):  # noqa: ANN001, ANN202
        for batch in batches:
            table = pa.Table.from_batches([batch])
            nodes, spaces, wanted = table.column("node"), table.column("space"), table.column("bits").to_numpy()
            by_width: dict[int, list[int]] = {}
            for k, v in enumerate(table.column("vector")):
                by_width.setdefault(len(v.as_buffer()), []).append(k)
            for rows in by_width.values():
                which = np.array(rows)
                x = _matrix(table.column("vector"), which)
                for tree in range(trees):
                    planes = np.random.default_rng([seed, tree, x.shape[1]]).standard_normal((x.shape[1], bits))
                    on = (x @ planes > 0) & (np.arange(bits) < wanted[which][:, None])
                    yield pa.RecordBatch.from_pydict(
                        {"node": nodes.take(which).combine_chunks(), "space": spaces.take(which).combine_chunks(), "tree": pa.array([tree] * len(which), pa.int32()), "code": pa.array(on @ (1 << np.arange(bits)), pa.int64())}
                    )

    return run


def _best(n_best: int) -> Callable:
    """Within each block, every node's best others; nodes of one group are not compared."""

    def run(table: pa.Table) -> pa.Table:
        key, nodes, group = (table.column(c).to_numpy() for c in ("block", "node", "group"))
        order = np.lexsort((nodes, key))
        at = tx.groups(key[order])
        out: list[tuple] = []
        for a, b in zip(at[:-1], at[1:], strict=True):
            mine = order[a:b]
            mine = mine[np.unique(nodes[mine], return_index=True)[1]]
            g = group[mine]
            if len(mine) < 2 or (g == g[0]).all():
                continue
            x = _matrix(table.column("vector"), mine)
            sims = cosines(x, x)
            sims[g[:, None] == g[None, :]] = -np.inf
            k = min(n_best, len(mine) - 1)
            top = np.argpartition(-sims, k - 1, axis=1)[:, :k]
            best = np.take_along_axis(sims, top, axis=1)
            known = best > -np.inf
            out.append((nodes[mine], known.sum(axis=1), nodes[mine][top][known], best[known].astype(np.float32)))
        flat = lambda k, kind: np.concatenate([o[k] for o in out]) if out else np.zeros(0, kind)
        node, size, ids, sims = flat(0, np.int64), flat(1, np.int64), flat(2, np.int64), flat(3, np.float32)
        offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
        return pa.table({"node": node, "ids": pa.ListArray.from_arrays(offsets, ids), "sims": pa.ListArray.from_arrays(offsets, sims)})

    return run


def _merged(n_best: int) -> Callable:
    def run(batches):  # noqa: ANN001, ANN202
        for batch in batches:
            nodes, all_ids, all_sims = (batch.column(k) for k in range(3))
            ids_out, sims_out = [], []
            for ids, sims in zip(all_ids, all_sims, strict=True):
                i = np.concatenate([v.values.to_numpy() for v in ids.values])
                s = np.concatenate([v.values.to_numpy() for v in sims.values])
                i, first = np.unique(i, return_index=True)
                best = np.argsort(-s[first], kind="stable")[:n_best]
                ids_out.append(i[best])
                sims_out.append(s[first][best])
            yield pa.RecordBatch.from_arrays(
                [nodes, pa.array(ids_out, pa.list_(pa.int64())), pa.array(sims_out, pa.list_(pa.float32()))], names=["node", "ids", "sims"]
            )

    return run


def _linked(threshold: float) -> Callable:
    """Links within each block, or between its two parts: counts by node, and a spanning forest."""

    def run(table: pa.Table) -> pa.Table:
        block, nodes, part = (table.column(c).to_numpy() for c in ("block", "node", "part"))
        copies, two = table.column("copies").to_numpy(), table.column("two").to_numpy(zero_copy_only=False)
        order = np.lexsort((part, block))
        at = tx.groups(block[order])
        out_node, out_links, out_other = [], [], []
        for a, b in zip(at[:-1], at[1:], strict=True):
            mine = order[a:b]
            x = _matrix(table.column("vector"), mine)
            link = cosines(x, x) >= threshold
            np.fill_diagonal(link, False)
            if two[mine[0]]:
                link &= part[mine][:, None] != part[mine][None, :]
            counts = link @ copies[mine]
            some = np.flatnonzero(counts)
            out_node.append(nodes[mine][some])
            out_links.append(counts[some])
            out_other.append(np.full(len(some), -1))
            i, j = np.nonzero(np.triu(link, 1))
            for p, q in forest(i, j, len(mine)):
                out_node.append(nodes[mine[[p]]])
                out_links.append(np.zeros(1, np.int64))
                out_other.append(nodes[mine[[q]]])
        cat = lambda v: np.concatenate(v).astype(np.int64) if v else np.zeros(0, np.int64)
        node, links, other = cat(out_node), cat(out_links), cat(out_other)
        return pa.table({"node": node, "links": links, "other": pa.array(other, mask=links > 0)})

    return run


class Graph:
    """Nodes and their current neighbour lists."""

    def __init__(self, vectors: DataFrame, threshold: float, n_best: int, trees: int, seed: int) -> None:
        self.threshold, self.n_best, self.seed = threshold, n_best, seed
        self.spark = vectors.sparkSession
        self.buckets = 4 * int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        # A vector's node goes by its least id, or by a name of its own where that id has another vector too.
        good = vectors.where("usable").groupBy("space", "vector").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"))
        self.members = materialise(good.withColumn("node", node_name("first", ["space", "vector"])))
        packed = self.members.select("node", "vector", "space").mapInArrow(_packed, "node long, space string, vector binary")
        self.nodes = materialise(packed)
        sizes = self.nodes.groupBy("space").agg(F.expr("CAST(greatest(0, least(24, ceil(log2(count(1) / 64.0)))) AS int)").alias("bits"))
        codes = self.nodes.join(sizes, "space").mapInArrow(_codes(trees, seed), "node long, space string, tree int, code long")
        self.cells = materialise(self._split(codes, "space", "tree", "code"))
        self.lists = self._improved(self.cells)

    def _split(self, rows: DataFrame, *key: str) -> DataFrame:
        """(block, node): each key's nodes, in parts of bounded size where there are many."""
        rows = materialise(rows)
        sizes = rows.groupBy(*key).agg(F.expr(f"count(1) div {BLOCK} + 1").alias("parts"))
        many = sizes.where("parts > 1")
        part = F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("node", *key), F.col("parts")))
        return rows.join(many, list(key), "left").select(F.xxhash64(*key, part).alias("block"), "node")

    def _improved(self, blocks: DataFrame, lists: DataFrame | None = None, apart: DataFrame | None = None) -> DataFrame:
        """The best that nodes have met in blocks and lists. With ``apart`` (node, group) only its nodes meet,
        and those of one group do not count."""
        rows = blocks.join(self.nodes.select("node", "vector"), "node")
        rows = rows.withColumn("group", F.col("node")) if apart is None else rows.join(apart, "node")
        found = rows.withColumn("batch", F.pmod("block", F.lit(self.buckets))).groupBy("batch").applyInArrow(_best(self.n_best), LISTS)
        if lists is not None:
            found = found.unionByName(lists)
        gathered = found.where(F.size("ids") > 0).groupBy("node").agg(F.collect_list("ids").alias("ids"), F.collect_list("sims").alias("sims"))
        return materialise(gathered.mapInArrow(_merged(self.n_best), LISTS))

    def _met(self, lists: DataFrame) -> DataFrame:
        """All that meet at a node: itself, its neighbours and those that name it."""
        pairs = lists.select("node", F.explode("ids").alias("other"))
        meet = pairs.select(F.col("node").alias("centre"), F.col("other").alias("node")).unionByName(
            pairs.select(F.col("other").alias("centre"), "node")
        )
        return self._split(meet.unionByName(lists.select(F.col("node").alias("centre"), "node")).distinct(), "centre")

    def descend(self) -> None:
        """One round: all that meet at a node are compared."""
        self.lists = self._improved(self._met(self.lists), self.lists)

    def _near(self, lists: DataFrame) -> DataFrame:
        """(a, b): a list's entries that may pass the threshold."""
        near = F.expr(f"filter(arrays_zip(ids, sims), x -> x.sims >= {self.threshold - 1e-4})")
        return lists.select(F.col("node").alias("a"), F.explode(near).alias("e")).select("a", F.col("e.ids").alias("b"))

    def links(self, rounds: int = 1) -> tuple[DataFrame, DataFrame]:
        """(node, links) and (node, component), by the graph's threshold edges.

        A link that the lists lack has two saturated ends, as far as the lists are right otherwise: a list
        with a worse one at its end has room for every link. So the lists of saturated nodes are enlarged by
        their best neighbours outside the component that fills them, found by NN-descent in the same way.
        Links found there join components, which the next lists then leave out, until none is found. Then a
        component's nodes are compared with each other, in blocks and in double precision.
        """
        edges = materialise(self._near(self.lists))
        full = materialise(self.lists.where((F.size("ids") >= self.n_best) & (F.array_min("sims") >= self.threshold - 1e-4)).select("node"))
        found = components(edges)
        while not full.isEmpty():
            apart = materialise(found.join(full, "node", "left_semi").withColumnRenamed("component", "group"))
            beyond = self._improved(self.cells, apart=apart)
            for _ in range(rounds):
                beyond = self._improved(self._met(beyond), beyond, apart)
            new = materialise(self._near(beyond))
            if new.isEmpty():
                break
            edges = edges.unionByName(new)
            found = components(edges)
        return self._counted(self._compared(found))

    def all_links(self) -> tuple[DataFrame, DataFrame]:
        """What ``links`` returns, by a comparison of all nodes of a label, without the lists."""
        return self._counted(self._compared(self.nodes.select("node", F.xxhash64("space").alias("component"))))

    def _compared(self, found: DataFrame) -> DataFrame:
        """Links between the nodes of each component, in blocks that hold two parts of it."""
        found = materialise(found)
        sizes = found.groupBy("component").agg(F.expr(f"count(1) div {BLOCK} + 1").alias("parts"))
        rows = found.join(sizes, "component").withColumn("part", F.expr("pmod(xxhash64(node), parts)"))
        rows = rows.withColumn("with", F.explode(F.expr("sequence(0L, parts - 1)")))
        x, y = F.least("part", "with"), F.greatest("part", "with")
        block = F.xxhash64("component", x, y).alias("block")
        rows = rows.select("node", "part", (x != y).alias("two"), block)
        rows = rows.join(self.nodes.select("node", "vector"), "node").join(self.members.select("node", "copies"), "node")
        return materialise(rows.withColumn("batch", F.pmod("block", F.lit(self.buckets))).groupBy("batch").applyInArrow(_linked(self.threshold), LINKS))

    @staticmethod
    def _spanning(both: DataFrame) -> DataFrame:
        return both.where("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b"))

    def _counted(self, both: DataFrame) -> tuple[DataFrame, DataFrame]:
        counts = both.where("other IS NULL").groupBy("node").agg(F.sum("links").alias("links"))
        return counts, components(self._spanning(both))

    def recall(self, counts: DataFrame, queries: int) -> float:
        """Share of the true links of some nodes (those with the least hashes) that the graph has."""
        asked = self.nodes.orderBy(F.xxhash64("node", F.lit(self.seed)), "node").limit(queries)
        rows = asked.select("node", "space", "vector").collect()
        if not rows:
            return 1.0
        spaces: dict[str, tuple[list, np.ndarray]] = {}
        for r in rows:
            spaces.setdefault(r["space"], ([], []))[0].append((r["node"], np.frombuffer(r["vector"], np.float64)))
        held = self.spark.sparkContext.broadcast({s: (np.array([n for n, _ in v[0]]), np.stack([x for _, x in v[0]])) for s, v in spaces.items()})
        threshold = self.threshold

        def count(batches):  # noqa: ANN001, ANN202
            sums: dict[int, int] = {}
            for batch in batches:
                table = pa.Table.from_batches([batch])
                kinds, nodes, copies = np.array(table.column("space").to_pylist(), object), table.column("node").to_numpy(), table.column("copies").to_numpy()
                for space, (ids, x) in held.value.items():
                    mine = np.flatnonzero(kinds == space)
                    if not len(mine):
                        continue
                    link = (cosines(x, _matrix(table.column("vector"), mine)) >= threshold) & (ids[:, None] != nodes[mine][None, :])
                    for node, n in zip(ids.tolist(), (link @ copies[mine]).tolist(), strict=True):
                        sums[node] = sums.get(node, 0) + int(n)
            yield pa.RecordBatch.from_pydict({"node": pa.array(list(sums), pa.int64()), "n": pa.array(list(sums.values()), pa.int64())})

        every = self.nodes.join(self.members.select("node", "copies"), "node")
        true = every.mapInArrow(count, "node long, n long").groupBy("node").agg(F.sum("n").alias("n"))
        both = true.join(counts, "node", "left").agg(F.sum("n"), F.sum(F.least("n", F.coalesce("links", F.lit(0))))).first()
        return 1.0 if not both[0] else both[1] / both[0]


def near_duplicates(
    vectors: DataFrame,
    threshold: float = 0.93,
    n_best: int = 8,
    trees: int = 4,
    rounds: int = 2,
    wanted: float = 0.95,
    most_rounds: int = 8,
    queries: int = 1000,
    seed: int = 1,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """Links between vectors of one label with a cosine of ``threshold`` or more.

    One row for each row of ``vectors``: vec_id, n_links (other vectors linked directly),
    component_id (smallest vec_id that links reach) and kept (vec_id = component_id). No pair below
    the threshold is linked; ``rounds`` of NN-descent and more, up to ``most_rounds``, follow until the
    audited recall of ``queries`` nodes is at least ``wanted``. Where it is not even then, all vectors of
    a label are compared, which takes time with the square of their number.

    * null, zero or not finite vectors, and null labels: no links, alone
    * vectors of different lengths are not compared; equal vectors are linked with each other
    * rows with one id: each is a vector of its own in the counts; a null id has no links
    * other columns are ignored, whatever their names
    """
    ship(vectors.sparkSession)
    double = F.col(vector).cast("array<double>")
    good = F.col(vec_id).isNotNull() & F.col(label).isNotNull() & usable(double)
    space = F.concat_ws(":", F.size(double), F.col(label).cast("string"))
    rows = materialise(vectors.select(F.col(vec_id).cast("long").alias("vec_id"), double.alias("vector"), space.alias("space"), good.alias("usable")))
    graph = Graph(rows, threshold, n_best, trees, seed)
    done = 0
    while True:
        for _ in range(rounds if not done else 1):
            graph.descend()
            done += 1
        counts, found = graph.links()
        if graph.recall(counts, queries) >= wanted:
            break
        if done >= most_rounds:
            counts, found = graph.all_links()
            break
    members = least_ids(graph.members.join(found, "node", "left"), "first")
    of_node = members.join(counts, "node", "left").select(
        "space", "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component", "first").alias("c")
    )
    keyed = rows.withColumn("usable", F.coalesce("usable", F.lit(False)))
    joined = keyed.where("usable").join(of_node, ["space", "vector"]).select("vec_id", F.col("n").alias("n_links"), F.col("c").alias("component_id"))
    alone = keyed.where("NOT usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    every = joined.unionByName(alone)
    return every.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
