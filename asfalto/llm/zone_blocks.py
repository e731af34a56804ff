"""Hard negatives by blocks of candidates with zone maps.

Vectors become integers, floor(256 * x), so every score is exact. Rows are ordered by label and, within one, by
their place on a Hilbert curve over the widest dimensions, and stored as Parquet rows of BLOCK_ROWS vectors.
Each block has a zone map: the least and greatest value of every dimension. Interval arithmetic on it bounds
the score that any row of the block can have with an anchor, from below and above.

An anchor asks for its best rows within windows of scores. Anchors lie in packs, ordered in the same way. A pack
first reads the few blocks of the highest bounds; the last of its best rows so far then raises the windows' floors,
and only blocks whose interval still meets a window are read. Within a task a pack meets its blocks from the
highest bound down and keeps `count` rows a window, so rows out follow the answers, not the blocks.

Rows take no part if their label, vector or a component is null, a component is not finite, the vector has another
length than the commonest, or its integers' squared length reaches 2^56 (hundredths of a score must fit in 64 bits). Zero vectors
take part. Rows that repeat a vec_id or a vector are rows of their own. A null vec_id is no anchor and comes last
among equal scores. Other columns are not read. No rows, or no anchors, give no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from asfalto.operators.layout import stage

SCALE = 256
BLOCK_ROWS = 512
PACK_ROWS = 256
PAGE_ZONES = 256
FIRST_BLOCKS = 4
PARTS = 8  # tasks that share a pack's blocks
SAMPLE_ROWS = 20_000  # for the curve's grid; it decides the order of rows and nothing else
CURVE_DIMENSIONS, CURVE_BITS = 12, 4
MOST_SQUARED = 2.0**56

_LEAST, _MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
_ROWS = "node long, vec_id long, label long, vector binary"
_BLOCK = (
    "block long, label_lo long, label_hi long, lo binary, hi binary, "
    "nodes array<bigint>, ids array<bigint>, labels array<bigint>, data binary"
)
_LONGS = pa.list_(pa.int64())
_BLOCK_TYPES = [pa.int64()] * 3 + [pa.binary()] * 2 + [_LONGS] * 3 + [pa.binary()]
_BLOCK_NAMES = [c.split()[0] for c in _BLOCK.split(", ")]


def _ints(data: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(data, "<i4").reshape(rows, -1).astype(np.int64)


def quantised(embeddings: DataFrame, label: Column, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(node, vec_id, label, vector) of the rows that take part, stored; `vector` holds int32 bytes."""
    chosen = embeddings.select(
        F.col(id_column).cast("long").alias("vec_id"), label.cast("long").alias("label"),
        F.col(column).cast("array<double>").alias("v"),
    ).where("v is not null and label is not null")
    commonest = chosen.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    size = commonest["n"] if commonest else 0

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v")
            batch = batch.filter(pc.equal(pc.list_value_length(lists), size))
            rows = batch.column("v").flatten().to_numpy(False).astype(np.float64).reshape(batch.num_rows, size)
            with np.errstate(over="ignore", invalid="ignore"):
                whole = np.floor(SCALE * rows)
                # a null component has become nan
                good = np.isfinite(rows).all(axis=1) & (np.einsum("ij,ij->i", whole, whole) < MOST_SQUARED)
            vectors = [r.tobytes() for r in whole[good].astype("<i4")]
            kept = batch.select(["node", "vec_id", "label"]).filter(pa.array(good))
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(vectors, pa.binary())], names=["node", "vec_id", "label", "vector"])

    numbered = chosen.withColumn("node", F.monotonically_increasing_id()).select("node", "vec_id", "label", "v")
    return stage(numbered.mapInArrow(convert, _ROWS), "integers")


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the curve of each row of `cells`, whose values are under 2**bits; dimensions * bits is 62 at most."""
    axes = list(cells.T.astype(np.int64))
    bit = 1 << (bits - 1)
    while bit > 1:
        low = bit - 1
        for n in range(len(axes)):
            # turn the corner of the cell, or swap two axes, so that the next smaller curve joins on
            turned = (axes[n] & bit) != 0
            swap = np.where(turned, 0, (axes[0] ^ axes[n]) & low)
            axes[n] = axes[n] ^ swap
            axes[0] = axes[0] ^ np.where(turned, low, swap if n else 0)
        bit >>= 1
    for n in range(1, len(axes)):
        axes[n] = axes[n] ^ axes[n - 1]
    flips, bit = np.zeros(len(cells), np.int64), 1 << (bits - 1)
    while bit > 1:
        flips ^= np.where((axes[-1] & bit) != 0, bit - 1, 0)
        bit >>= 1
    place = np.zeros(len(cells), np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in axes:
            place = (place << 1) | (((axis ^ flips) >> level) & 1)
    return place


def _grid(rows: DataFrame, sample_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The widest dimensions and the bounds that cut each into 2**CURVE_BITS cells, of a bounded sample."""
    share = min(1.0, 1.2 * sample_rows / max(1, rows.count()))
    some = rows.where(F.pmod(F.xxhash64("node"), F.lit(1_000_000)) < share * 1_000_000)
    picked = some.select("vector").limit(sample_rows).collect()
    if not picked:
        return np.zeros(0, np.int64), np.zeros((0, 0))
    data = _ints(b"".join(bytes(r["vector"]) for r in picked), len(picked))
    widest = np.argsort(-data.std(axis=0), kind="stable")[:CURVE_DIMENSIONS]
    shares = np.arange(1, 1 << CURVE_BITS) / (1 << CURVE_BITS)
    return widest, np.quantile(data[:, widest], shares, axis=0).T


def _ordered(rows: DataFrame, widest: np.ndarray, bounds: np.ndarray) -> DataFrame:
    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = np.zeros(batch.num_rows, np.int64)
            if batch.num_rows and len(widest):
                data = _ints(b"".join(batch.column("vector").to_pylist()), batch.num_rows)[:, widest]
                cells = np.stack([np.searchsorted(b, column, "right") for b, column in zip(bounds, data.T)], axis=1)
                place = hilbert(cells, CURVE_BITS)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place)], names=[*batch.schema.names, "place"])

    return rows.mapInArrow(placed, f"{_ROWS}, place long")


def blocks_of(ordered: DataFrame, block_rows: int, label: str) -> DataFrame:
    """Rows cut into blocks in order of label and curve, stored; a half-full block also ends with its label."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 32, []

        def block() -> pa.RecordBatch:
            nodes, ids, labels, vectors = map(list, zip(*held))
            data = b"".join(vectors)
            rows = _ints(data, len(nodes)).astype("<i4")
            values = [number, labels[0], labels[-1], rows.min(axis=0).tobytes(), rows.max(axis=0).tobytes(),
                      nodes, ids, labels, data]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(values, _BLOCK_TYPES)], names=_BLOCK_NAMES)

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("node", "vec_id", "label", "vector"))):
                full = len(held) == block_rows or len(held) * 2 >= block_rows and row[2] != held[-1][2]
                if full:
                    yield block()
                    number, held = number + 1, []
                held.append(row)
        if held:
            yield block()

    keys = ("label", "place", "node")
    dealt = ordered.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("place")
    return stage(dealt.mapInArrow(pack, _BLOCK), label)


def zone_pages(blocks: DataFrame) -> DataFrame:
    """(zones, first_labels, last_labels, lows, highs): zone maps, PAGE_ZONES to a row, stored."""

    def page(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, PAGE_ZONES):
                part = batch.slice(first, PAGE_ZONES)
                block, label_lo, label_hi, lo, hi = (c.to_pylist() for c in part.columns)
                values = [block, label_lo, label_hi, b"".join(lo), b"".join(hi)]
                types = [_LONGS] * 3 + [pa.binary()] * 2
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], t) for v, t in zip(values, types)],
                    names=["zones", "first_labels", "last_labels", "lows", "highs"])

    return stage(blocks.select("block", "label_lo", "label_hi", "lo", "hi").mapInArrow(
        page, "zones array<bigint>, first_labels array<bigint>, last_labels array<bigint>, lows binary, highs binary"
    ), "zone-maps")


def intervals(anchors: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score that a row within each zone can have with each anchor, rounded outwards."""
    a, lows, highs = (x.astype(np.float64) for x in (anchors, lows, highs))
    above, below = np.maximum(a, 0), np.minimum(a, 0)
    slack = 1e-9 * (np.abs(a) @ np.maximum(np.abs(lows), np.abs(highs)).T)
    return above @ lows.T + below @ highs.T - slack, above @ highs.T + below @ lows.T + slack


def _needed(row: dict, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Zones of a page that some anchor of a pack must read, and for each the highest score it may give."""
    count, zones = len(row["nodes"]), len(row["zones"])
    least, greatest = intervals(
        _ints(row["data"], count), _ints(row["lows"], zones), _ints(row["highs"], zones))
    labels = np.array(row["labels"])[:, None]
    first, last = np.array(row["first_labels"])[None, :], np.array(row["last_labels"])[None, :]
    allowed = (first <= labels) & (labels <= last) if same else (first != labels) | (last != labels)
    best = np.full(zones, -np.inf)
    floors, ceilings = (np.array(row[n], np.int64).reshape(count, -1) for n in ("floors", "ceilings"))
    for floor, ceiling in zip(floors.T[:, :, None], ceilings.T[:, :, None]):
        meets = allowed & (floor <= ceiling) & (greatest >= floor) & (least <= ceiling)
        best = np.maximum(best, np.where(meets, np.minimum(greatest, ceiling), -np.inf).max(axis=0, initial=-np.inf))
    return np.flatnonzero(best > -np.inf), best


def chosen_blocks(packs: DataFrame, pages: DataFrame, same: bool, most: int | None = None) -> DataFrame:
    """(pack, block, bound): blocks that the windows of a pack meet; of each pack the `most` of highest bound."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                zones, best = _needed(row, same)
                if most is not None:
                    zones = zones[np.argsort(-best[zones], kind="stable")[:most]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["pack"]] * len(zones), pa.int64()),
                     pa.array(np.array(row["zones"], np.int64)[zones]), pa.array(best[zones])],
                    names=["pack", "block", "bound"])

    # a stated set of queries against zone maps only, both in bundles
    pairs = packs.select("pack", "nodes", "labels", "data", "floors", "ceilings").crossJoin(pages)
    found = pairs.mapInArrow(choose, "pack long, block long, bound double")
    if most is None:
        return found
    order = Window.partitionBy("pack").orderBy(F.desc("bound"), "block")
    return found.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= most).drop("_n")


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of integer rows, exactly."""
    longest = [np.sqrt(np.einsum("ij,ij->i", x, x, dtype=np.float64).max(initial=0)) for x in (a, b)]
    if longest[0] * longest[1] < 2.0**52:  # then no partial sum leaves the integers of a double
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


class _Best:
    """The best `count` rows so far of every window of a pack's anchors."""

    def __init__(self, head: dict, count: int, same: bool):
        self.nodes, self.labels = (np.array(head[n], np.int64) for n in ("nodes", "labels"))
        self.rows = _ints(head["data"], len(self.nodes))
        self.floors, self.ceilings = (
            np.array(head[n], np.int64).reshape(len(self.nodes), -1) for n in ("floors", "ceilings"))
        self.count, self.same, self.pack = count, same, head["pack"]
        # place (anchor and window), score, id, whether the id is null, node
        self.found = np.zeros((5, 0), np.int64)

    def meet(self, block: dict) -> None:
        nodes, labels = np.array(block["nodes"], np.int64), np.array(block["labels"], np.int64)
        ids = np.array([_MOST if i is None else i for i in block["ids"]], np.int64)
        none = np.array([i is None for i in block["ids"]], np.int64)
        scores = products(self.rows, _ints(block["data"], len(nodes)))
        alike = self.labels[:, None] == labels[None, :]
        allowed = (alike if self.same else ~alike) & (self.nodes[:, None] != nodes[None, :])
        windows = self.floors.shape[1]
        new = []
        for w in range(windows):
            a, r = np.nonzero(allowed & (scores >= self.floors[:, w, None]) & (scores <= self.ceilings[:, w, None]))
            new.append(np.stack([a * windows + w, scores[a, r], ids[r], none[r], nodes[r]]))
        self.found = np.concatenate([self.found, *new], axis=1)
        place, score, vec_id, null, node = self.found
        order = np.lexsort((node, vec_id, null, -score, place))
        self.found = self.found[:, order]
        place = self.found[0]
        rank = np.arange(len(place)) - np.searchsorted(place, place)
        # a window that is full takes nothing below its last row
        last = rank == self.count - 1
        floors = self.floors.reshape(-1)
        floors[place[last]] = np.maximum(floors[place[last]], self.found[1, last])
        self.found = self.found[:, rank < self.count]

    def batch(self) -> pa.RecordBatch:
        place, score, vec_id, null, node = self.found
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(place), self.pack)), pa.array(place), pa.array(score),
             pa.array(vec_id, mask=null.astype(bool)), pa.array(node)],
            names=["pack", "place", "score", "vec_id", "node"])


def _read(packs: DataFrame, chosen: DataFrame, blocks: DataFrame, count: int, same: bool) -> DataFrame:
    """(pack, place, score, vec_id, node): the best rows of the chosen blocks, `count` a window and task."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None
        for batch in batches:
            for n in range(batch.num_rows):
                row = batch.slice(n, 1).to_pylist()[0]
                if row["bound"] is None:  # a pack begins
                    if best is not None and best.found.shape[1]:
                        yield best.batch()
                    best = _Best(row, count, same)
                else:
                    best.meet(row)
        if best is not None and best.found.shape[1]:
            yield best.batch()

    columns = ("nodes", "ids", "labels", "data")
    heads = packs.select(
        "pack", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"), *columns, "floors", "ceilings")
    met = chosen.join(blocks.select("block", *columns), "block").select(
        "pack", F.pmod(F.xxhash64("block"), F.lit(PARTS)).cast("int").alias("part"), *columns, "bound")
    both = heads.unionByName(met, allowMissingColumns=True)
    dealt = both.repartition("pack", "part").sortWithinPartitions(
        "pack", "part", F.desc_nulls_first("bound"))
    return dealt.mapInArrow(search, "pack long, place long, score long, vec_id long, node long")


def _ranked(found: DataFrame, count: int) -> DataFrame:
    order = Window.partitionBy("pack", "place").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "node")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def _rewindowed(packs: DataFrame, entries: DataFrame, change) -> DataFrame:
    """Packs with new windows, stored: `change(floors, ceilings, places, ranks, scores)` of a pack's entries."""
    lists = entries.groupBy("pack").agg(F.collect_list(F.struct("place", "rank", "score")).alias("entries"))

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                entries = row["entries"] or []
                values = (np.array([e[k] for e in entries], np.int64) for k in ("place", "rank", "score"))
                row["floors"], row["ceilings"] = change(np.array(row["floors"]), np.array(row["ceilings"]), *values)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["pack"] for r in rows], pa.int64()),
                 *(pa.array([r[k] for r in rows], _LONGS) for k in ("nodes", "ids", "labels")),
                 pa.array([r["data"] for r in rows], pa.binary()),
                 *(pa.array([r[k] for r in rows], _LONGS) for k in ("floors", "ceilings"))],
                names=["pack", "nodes", "ids", "labels", "data", "floors", "ceilings"])

    return stage(packs.join(lists, "pack", "left").mapInArrow(
        rewrite, "pack long, nodes array<bigint>, ids array<bigint>, labels array<bigint>, data binary, "
        "floors array<bigint>, ceilings array<bigint>"), "packs")


def _raised(count: int):
    """Floors raised to the score of the last row of each full window."""
    def change(floors, ceilings, places, ranks, scores):
        last = ranks == count
        floors[places[last]] = np.maximum(floors[places[last]], scores[last])
        return floors, ceilings

    return change


def best_rows(
    packs: DataFrame, blocks: DataFrame, pages: DataFrame, count: int, same: bool, first_blocks: int = FIRST_BLOCKS
) -> DataFrame:
    """(pack, place, score, vec_id, node, rank): each window's first `count` rows of the same, or of other, labels."""
    first = stage(chosen_blocks(packs, pages, same, first_blocks), "first-blocks")
    begun = stage(_ranked(_read(packs, first, blocks, count, same), count), "first-rows")
    raised = _rewindowed(packs, begun, _raised(count))
    rest = chosen_blocks(raised, pages, same).join(first.select("pack", "block"), ["pack", "block"], "left_anti")
    more = _read(raised, rest, blocks, count, same)
    return stage(_ranked(begun.drop("rank").unionByName(more), count), "best-rows")


def _score_windows(low: int, high: int, count: int):
    """A window from low to high hundredths of each positive's score."""
    def change(floors, ceilings, places, ranks, scores):
        floors, ceilings = np.full(len(floors) * count, _MOST), np.full(len(floors) * count, _LEAST)
        at = places * count + ranks - 1
        floors[at], ceilings[at] = -((-low * scores) // 100), (high * scores) // 100
        return floors, ceilings

    return change


def mine(
    embeddings: DataFrame,
    is_anchor: Column,
    label: Column,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    block_rows: int = BLOCK_ROWS,
    pack_rows: int = PACK_ROWS,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `is_anchor` is a condition on vec_id. A positive is one of an anchor's first `positives` other rows of its label;
    its negatives are the first `negatives` rows of other labels that score from `low` to `high` hundredths
    of what it scores. Higher scores come first, ties by vec_id, then by the row's number.
    """
    rows = quantised(embeddings, label)
    ordered = _ordered(rows, *_grid(rows, sample_rows))
    blocks = blocks_of(ordered, block_rows, "blocks")
    pages = zone_pages(blocks)
    anchors = blocks_of(ordered.where(is_anchor), pack_rows, "anchors").select(
        F.col("block").alias("pack"), "nodes", "ids", "labels", "data",
        F.transform("nodes", lambda n: F.lit(_LEAST)).alias("floors"),
        F.transform("nodes", lambda n: F.lit(_MOST)).alias("ceilings"),
    )
    near = best_rows(anchors, blocks, pages, positives, same=True)
    windows = _rewindowed(anchors, near, _score_windows(low, high, positives))
    far = best_rows(windows, blocks, pages, negatives, same=False)
    named = anchors.select("pack", F.posexplode("ids").alias("anchor", "anchor_id"))
    pairs = near.select(
        "pack", F.col("place").alias("anchor"), (F.col("place") * positives + F.col("rank") - 1).alias("place"),
        F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
    ).join(named, ["pack", "anchor"])
    return pairs.join(
        far.select("pack", "place", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")),
        ["pack", "place"],
    ).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
