"""Nearest vectors by a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample, by k-means under every node down to leaves that will hold
about LEAF_ROWS vectors, and every vector is then filed in a leaf. A query keeps a priority queue of
branches, nearest centre first: it takes the best one, descends from it to a leaf and queues the branches
passed by. How many leaves are visited is widened until calibration queries, whose true
neighbours are found by comparing them with all vectors, reach the wanted recall.

Vectors lie in blocks of bounded size by leaf. Queries lie in packs, neighbours in the tree together; a pack reads
the blocks of every leaf that one of its queries visits, the best bins first. The task keeps each query's nearest
so far, and later blocks add only what beats the last of them, so the rows that leave a task follow the queries and
not the leaves they visit.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from asfalto.llm.vectors import cosines, matrix, numbered, sample, unit
from asfalto.operators.layout import stage

NEIGHBOURS = 5
SAMPLE_ROWS = 20_000
BRANCHES = 8
LEAF_ROWS = 256
RECALL = 0.95
CALIBRATION_QUERIES = 128
BLOCK_ROWS = 512
PACK_ROWS = 256
PARTS = 4  # tasks that share a pack's blocks


_NO_ID = np.iinfo(np.int64).max  # stands for a null id, which comes last among equals
_FILED = "leaf long, node long, vec_id long, vector binary"


@dataclass
class Tree:
    """Centres of all nodes; node 0 is the root, a node without children is a leaf."""

    centres: list[np.ndarray] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)

    def add(self, centre: np.ndarray) -> int:
        self.centres.append(centre)
        self.children.append([])
        return len(self.centres) - 1

    def leaves(self) -> list[int]:
        """All leaves, those of one subtree together."""
        found, waiting = [], [0]
        while waiting:
            node = waiting.pop()
            waiting += self.children[node]
            if not self.children[node]:
                found.append(node)
        return found

    def assign(self, rows: np.ndarray) -> np.ndarray:
        """Leaf of every unit vector: at each node the nearest branch."""
        at = np.zeros(len(rows), np.int64)
        waiting = [(0, np.arange(len(rows)))]
        while waiting:
            node, who = waiting.pop()
            below = self.children[node]
            if not below or not len(who):
                at[who] = node
                continue
            nearest = (rows[who] @ np.array([self.centres[c] for c in below]).T).argmax(axis=1)
            waiting += [(c, who[nearest == n]) for n, c in enumerate(below)]
        return at

    def visits(self, row: np.ndarray, most: int) -> list[int]:
        """The first `most` leaves that a best-bin-first search comes to."""
        found: list[int] = []
        queue = [(0.0, 0)]
        while queue and len(found) < most:
            _, node = heapq.heappop(queue)
            while below := self.children[node]:
                near = row @ self._stacked(node)
                best = int(near.argmax())
                for n, child in enumerate(below):
                    if n != best:
                        heapq.heappush(queue, (-float(near[n]), child))
                node = below[best]
            found.append(node)
        return found

    def _stacked(self, node: int) -> np.ndarray:
        cached = self.__dict__.setdefault("_cache", {})
        if node not in cached:
            cached[node] = np.array([self.centres[c] for c in self.children[node]]).T
        return cached[node]


def _k_means(rows: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Centres of unit length, by largest cosine, and the centre of each row."""
    centres = rows[rng.choice(len(rows), k, replace=False)]
    for _ in range(rounds):
        own = (rows @ centres.T).argmax(axis=1)
        for n in range(k):
            total = rows[own == n].sum(axis=0)
            length = np.sqrt(total @ total)
            if length > 0:
                centres[n] = total / length
    return centres, (rows @ centres.T).argmax(axis=1)


def fit(rows: np.ndarray, all_rows: int, leaf_rows: int = LEAF_ROWS, branches: int = BRANCHES, seed: int = 0) -> Tree:
    """A tree over a sample of `all_rows` unit vectors, with leaves of about `leaf_rows` of them."""
    tree, rng = Tree(), np.random.default_rng(seed)
    least = max(1.0, leaf_rows * len(rows) / max(1, all_rows))
    waiting = [(tree.add(rows.mean(axis=0) if len(rows) else np.zeros(1)), rows)]
    while waiting:
        node, own = waiting.pop()
        if len(own) <= least or len(own) < 2:
            continue
        centres, nearest = _k_means(own.copy(), min(branches, len(own)), rng)
        kept = [n for n in range(len(centres)) if (nearest == n).any()]
        if len(kept) < 2:  # copies of one vector
            continue
        for n in kept:
            child = tree.add(centres[n])
            tree.children[node].append(child)
            waiting.append((child, own[nearest == n]))
    return tree


def _blocks(rows: DataFrame, block_rows: int) -> DataFrame:
    """(leaf, ids, data): rows (leaf, node, vec_id, vector) packed by leaf, `block_rows` at most in each.

    A large leaf is dealt over several tasks by its size, which is counted first.
    """
    sizes = rows.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / (4 * block_rows)).alias("_parts"))
    dealt = rows.join(sizes, "leaf").withColumn("_part", F.pmod(F.xxhash64("node"), F.col("_parts")))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaf, held = None, []

        def block() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([leaf], pa.int64()),
                    pa.array([[h[0] for h in held]], pa.list_(pa.int64())),
                    pa.array([[h[1] for h in held]], pa.list_(pa.int64())),
                    pa.array([b"".join(h[2] for h in held)], pa.binary()),
                ],
                names=["leaf", "nodes", "ids", "data"],
            )
            held.clear()
            return out

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("leaf", "node", "vec_id", "vector")]
            for own, *row in zip(*columns):
                if held and (own != leaf or len(held) == block_rows):
                    yield block()
                leaf = own
                held.append(row)
        if held:
            yield block()

    ordered = dealt.repartition("leaf", "_part").sortWithinPartitions("leaf", "node")
    return ordered.select("leaf", "node", "vec_id", "vector").mapInArrow(
        pack, "leaf long, nodes array<bigint>, ids array<bigint>, data binary"
    )


def _nearest(queries, q_nodes, rows, nodes, ids, count: int, floors=None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of the query, place of the row, cosine): each query's best, ties to smaller ids.

    With `floors`, only those that reach their query's.
    """
    near = unit(queries) @ unit(rows).T
    near[q_nodes[:, None] == nodes[None, :]] = -np.inf  # a query's own row
    # rounding of the product must not decide: keep all that could be among the best, then rescore
    keep = min(count, near.shape[1])
    border = np.partition(near, near.shape[1] - keep, axis=1)[:, near.shape[1] - keep]
    if floors is not None:
        border = np.maximum(border, floors)
    q, r = np.nonzero((near >= border[:, None] - 1e-9) & np.isfinite(near))
    scores = cosines(queries[q], rows[r])
    order = np.lexsort((ids[r], -scores, q))
    q, r, scores = q[order], r[order], scores[order]
    best = np.arange(len(q)) - np.searchsorted(q, q) < count
    return q[best], r[best], scores[best]


def _matched(pairs: DataFrame, count: int) -> DataFrame:
    """Each query's nearest of each block; rows hold a block of queries and one of vectors."""

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q_nodes, nodes = np.array(row["q_nodes"]), np.array(row["nodes"])
                queries = np.frombuffer(row["q_data"], np.float64).reshape(len(q_nodes), -1)
                rows = np.frombuffer(row["data"], np.float64).reshape(len(nodes), -1)
                ids = np.array([_NO_ID if i is None else i for i in row["ids"]])
                q, r, scores = _nearest(queries, q_nodes, rows, nodes, ids, count)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q_nodes[q]), pa.array([row["ids"][n] for n in r], pa.int64()), pa.array(scores),
                     pa.array(np.full(len(q), row["leaf"]))],
                    names=["q_node", "vec_id", "score", "leaf"],
                )

    return pairs.mapInArrow(match, "q_node long, vec_id long, score double, leaf long")


class _Found:
    """The nearest `count` rows so far of every query of a pack."""

    def __init__(self, head: dict, count: int):
        self.nodes, self.query_ids, self.count = np.array(head["nodes"], np.int64), head["ids"], count
        self.rows = np.frombuffer(head["data"], np.float64).reshape(len(self.nodes), -1)
        self.floors = np.full(len(self.nodes), -np.inf)
        self.places, self.scores = np.zeros((2, 0), np.int64), np.zeros(0)  # places: query, vec_id

    def meet(self, block: dict) -> None:
        nodes = np.array(block["nodes"], np.int64)
        ids = np.array([_NO_ID if i is None else i for i in block["ids"]], np.int64)
        rows = np.frombuffer(block["data"], np.float64).reshape(len(nodes), -1)
        q, r, scores = _nearest(self.rows, self.nodes, rows, nodes, ids, self.count, self.floors)
        places = np.concatenate([self.places, np.stack([q, ids[r]])], axis=1)
        scores = np.concatenate([self.scores, scores])
        order = np.lexsort((places[1], -scores, places[0]))
        places, scores = places[:, order], scores[order]
        rank = np.arange(len(scores)) - np.searchsorted(places[0], places[0])
        last = rank == self.count - 1
        self.floors[places[0, last]] = scores[last]
        self.places, self.scores = places[:, rank < self.count], scores[rank < self.count]

    def batch(self) -> pa.RecordBatch:
        q, ids = self.places
        return pa.RecordBatch.from_arrays(
            [pa.array(self.nodes[q]), pa.array([self.query_ids[n] for n in q], pa.int64()),
             pa.array(ids, mask=ids == _NO_ID), pa.array(self.scores)],
            names=["q_node", "query_id", "vec_id", "score"])


def _packs(tree: Tree, queries: DataFrame) -> DataFrame:
    """(pack, nodes, ids, data): queries, filed in leaves, in packs of leaves that are neighbours in the tree."""
    # a row per leaf, and leaves are bounded by the sample that the tree was fitted on
    sizes = dict(queries.groupBy("leaf").count().toLocalIterator())
    group_of, held = {}, 0
    for leaf in tree.leaves():
        group_of[leaf] = held // PACK_ROWS
        held += sizes.get(leaf, 0)

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group = pa.array([group_of[n] for n in batch.column("leaf").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([group, *batch.columns[1:]], names=batch.schema.names)

    together = queries.select("leaf", "node", "vec_id", "vector").mapInArrow(grouped, _FILED)
    packs = _blocks(together, PACK_ROWS).select(F.monotonically_increasing_id().alias("pack"), "nodes", "ids", "data")
    return stage(packs, "packs")


def _read(tree: Tree, packs: DataFrame, blocks: DataFrame, count: int, most: int) -> DataFrame:
    """(q_node, query_id, vec_id, score): the nearest in the first `most` leaves of every query, by task."""

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pack, count, data in zip(*(batch.column(c).to_pylist() for c in ("pack", "size", "data"))):
                place: dict[int, int] = {}
                for row in unit(np.frombuffer(data, np.float64).reshape(count, -1)):
                    for n, leaf in enumerate(tree.visits(row, most)):
                        place[leaf] = min(n, place.get(leaf, n))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([pack] * len(place), pa.int64()), pa.array(list(place), pa.int64()),
                     pa.array(list(place.values()), pa.int32())], names=["pack", "leaf", "place"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = None
        for batch in batches:
            for n in range(batch.num_rows):
                row = batch.slice(n, 1).to_pylist()[0]
                if row["place"] is None:  # a pack begins
                    if found is not None:
                        yield found.batch()
                    found = _Found(row, count)
                else:
                    found.meet(row)
        if found is not None:
            yield found.batch()

    visits = packs.select("pack", F.size("nodes").alias("size"), "data").mapInArrow(
        visit, "pack long, leaf long, place int")
    heads = packs.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PARTS - 1).cast("long"))))
    met = visits.join(blocks, "leaf").withColumn("part", F.pmod(F.xxhash64("leaf", F.col("nodes")[0]), F.lit(PARTS)))
    both = heads.unionByName(met.drop("leaf"), allowMissingColumns=True)
    dealt = both.repartition("pack", "part").sortWithinPartitions("pack", "part", F.asc_nulls_first("place"))
    return dealt.mapInArrow(search, "q_node long, query_id long, vec_id long, score double")


def _ranked(found: DataFrame, count: int) -> DataFrame:
    order = Window.partitionBy("q_node").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def _as_queries(blocks: DataFrame) -> DataFrame:
    return blocks.withColumnsRenamed({"nodes": "q_nodes", "ids": "q_ids", "data": "q_data"})


def calibrate(
    tree: Tree, queries: DataFrame, blocks: DataFrame, count: int, recall: float, most_queries: int
) -> int:
    """Leaves to visit so that true neighbours of calibration queries are found in that share."""
    chosen = queries.orderBy(F.xxhash64("node", F.lit(2))).limit(most_queries)
    own = _as_queries(_blocks(chosen.withColumn("leaf", F.lit(0).cast("long")), most_queries)).drop("leaf")
    # a stated, bounded set of queries against all rows, block by block
    truth = _ranked(_matched(blocks.join(F.broadcast(own)), count), count)
    leaves = truth.groupBy("q_node").agg(F.collect_list("leaf").alias("leaves"))
    known = chosen.join(F.broadcast(leaves), F.col("node") == F.col("q_node")).select("vector", "leaves").collect()
    needed = []
    for row in known:
        vector = unit(np.frombuffer(bytes(row["vector"]), np.float64).reshape(1, -1))[0]
        place = {leaf: n for n, leaf in enumerate(tree.visits(vector, len(tree.centres)), 1)}
        needed += [place[leaf] for leaf in row["leaves"]]
    if not needed:
        return 1
    needed.sort()
    return needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)]


def nearest(
    embeddings: DataFrame,
    is_query: Column,
    count: int = NEIGHBOURS,
    recall: float = RECALL,
    sample_rows: int = SAMPLE_ROWS,
    id_column: str = "vec_id",
    column: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score of the nearest found; `is_query` is a condition on vec_id.

    Vectors that take no part (see `vectors.numbered`) are neither queries nor found. Rows
    that repeat a vec_id are searched and found one by one.
    """
    vectors = numbered(embeddings, id_column, column).where("vector is not null")
    tree = fit(sample(vectors, sample_rows, seed=6), vectors.count())

    def file_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = tree.assign(unit(matrix(batch.column("vector"))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaf), *batch.columns], names=["leaf", *batch.schema.names]
                )

    filed = stage(vectors.mapInArrow(file_rows, _FILED), "filed")
    blocks = stage(_blocks(filed, BLOCK_ROWS), "leaf-blocks")
    queries = filed.where(is_query)
    most = calibrate(tree, queries, blocks, count, recall, CALIBRATION_QUERIES)
    found = _read(tree, _packs(tree, queries), blocks, count, most)
    return _ranked(found, count).select("query_id", "rank", "vec_id", "score")
