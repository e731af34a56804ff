"""Packing pieces of documents into sequences: best fit, then swap-based local search.

Documents longer than a sequence are cut; full pieces fill a sequence of their own. All other
pieces are dealt at random, by a hash, to groups of bounded size, and each group is packed on its
own: best fit by falling length first, then local search over underfull bins. A move or an exchange
(one for one, two for one) is made if it raises the sum of squared fills, which drains the
emptier bin of a pair until some bins are empty and go.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asfalto.llm.batches import text_parts, texts_of
from asfalto.llm.wordpiece import ended, word_codec
from asfalto.operators.layout import stage_counted

GROUP_PIECES = 4_000
ROUNDS = 4


def pieces_of(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    capacity: int,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Encode every text, append `end_id`, cut what is longer than `capacity`; one row per piece.

    A null or empty text is a piece with the end id alone. Repeated rows stay separate.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = word_codec(tokenizer)
        for part in text_parts(batches, keep=tokenizer):
            ids, offsets = ended(*codec.encode(texts_of(part)), end_id)
            sizes = np.diff(offsets)
            counts = -(-sizes // capacity)
            document = np.repeat(np.arange(part.num_rows), counts)
            number = np.arange(len(document)) - np.repeat(np.cumsum(counts) - counts, counts)
            start = number * capacity
            length = np.minimum(capacity, sizes[document] - start)
            data, first = memoryview(ids.astype("<u4")).cast("B"), offsets[document] + start
            crc = [zlib.crc32(data[4 * a : 4 * (a + n)]) for a, n in zip(first, length)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").take(pa.array(document)),
                    pa.array(number, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    ).mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Each item, longest first, into the fullest bin that has room; bins as lists of places."""
    bins: list[list[int]] = []
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by room left
    rooms: list[int] = []  # sorted, those with open bins
    for item in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[item])
        at = bisect_left(rooms, size)
        if at == len(rooms):
            room, number = capacity, len(bins)
            bins.append([])
        else:
            room = rooms[at]
            number = open_bins[room].pop()
            if not open_bins[room]:
                del rooms[at]
        bins[number].append(item)
        room -= size
        if room:
            if not open_bins[room]:
                rooms.insert(bisect_left(rooms, room), room)
            open_bins[room].append(number)
    return bins


class _Search:
    """Local search over the underfull bins of one group."""

    def __init__(self, bins: list[list[int]], lengths: list[int], capacity: int):
        self.bins, self.lengths, self.capacity = bins, lengths, capacity
        self.fill = [sum(lengths[i] for i in b) for b in bins]

    def underfull(self) -> list[int]:
        places = [b for b, f in enumerate(self.fill) if 0 < f < self.capacity]
        return sorted(places, key=self.fill.__getitem__)

    def _exchange(self, giver: int, taker: int, out: tuple[int, ...], back: tuple[int, ...]) -> None:
        for items, source, target in ((out, giver, taker), (back, taker, giver)):
            for item in items:
                self.bins[source].remove(item)
                self.bins[target].append(item)
                self.fill[source] -= self.lengths[item]
                self.fill[target] += self.lengths[item]

    def improve(self, giver: int, taker: int) -> bool:
        """Make the change from `giver` to the fuller `taker` that fills it most, if there is one.

        With x tokens carried over net, squared fill rises by 2x(taker - giver + x) > 0.
        """
        room, lengths = self.capacity - self.fill[taker], self.lengths
        given = sorted((lengths[i], (i,)) for i in self.bins[giver])
        singles = self.bins[giver]
        pairs = sorted(
            (lengths[a] + lengths[b], (a, b)) for n, a in enumerate(singles) for b in singles[:n]
        )
        best, gain = None, 0
        returns = [(0, ())] + [(lengths[i], (i,)) for i in self.bins[taker]]
        for back_size, back in returns:
            for options in (given, pairs) if back else (given,):
                # the largest that fits once `back` has left
                at = bisect_left(options, (room + back_size + 1,)) - 1
                if at >= 0 and options[at][0] - back_size > gain:
                    gain, best = options[at][0] - back_size, (options[at][1], back)
        if best is None:
            return False
        self._exchange(giver, taker, *best)
        return True

    def run(self, rounds: int, partners: int = 40) -> None:
        """Drain the emptiest bins into others; stop when a round changes nothing.

        Each bin is tried against the `partners` bins with most room and as many with least, so a
        round costs in proportion to the number of bins.
        """
        for _ in range(rounds):
            order, changed = self.underfull(), False
            for giver in order:
                takers = order[-partners:] + order[:partners]
                for taker in takers:
                    if not self.bins[giver]:
                        break
                    if taker == giver or not self.fill[giver] <= self.fill[taker] < self.capacity:
                        continue
                    while self.bins[giver] and self.improve(giver, taker):
                        changed = True
            if not changed:
                return


def pack_group(lengths: np.ndarray, capacity: int, rounds: int = ROUNDS) -> list[list[int]]:
    """Bins, as lists of places in `lengths`, none over `capacity`."""
    search = _Search(best_fit(lengths, capacity), lengths.tolist(), capacity)
    search.run(rounds)
    return [b for b in search.bins if b]


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    capacity: int = 2048,
    id_column: str = "doc_id",
    text_column: str = "text",
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """All documents as pieces in sequences: a sequence_id and a gapless offset for each piece.

    Sequence numbers are unique, not consecutive. An empty table gives no rows.
    """
    pieces, rows = stage_counted(
        pieces_of(docs, tokenizer, end_id, capacity, id_column, text_column), "pieces"
    )
    groups = max(1, -(-rows // group_pieces))
    # equal rows get numbers of their own by their place, so no group of copies stays together
    dealt = pieces.withColumn("_n", F.monotonically_increasing_id()).withColumn(
        "_group", F.pmod(F.xxhash64("doc_id", "piece", "_n"), F.lit(groups)).cast("int")
    )
    alone = dealt.where(F.col("length") == capacity).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (-F.col("_n") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )

    def pack(group: pa.Table) -> pa.Table:
        lengths = group["length"].to_numpy()
        bins = pack_group(lengths, capacity)
        order = np.fromiter((i for b in bins for i in b), np.int64, len(lengths))
        sizes = np.array([len(b) for b in bins])
        number = np.repeat(np.arange(len(bins)), sizes)
        before = np.cumsum(lengths[order]) - lengths[order]
        first = before[np.cumsum(sizes) - sizes]
        sequence = group["_group"][0].as_py() * (1 << 32) + number
        # ids stay in Arrow: a null among them would make numpy turn the others into doubles
        packed = group.drop_columns(["_group"]).take(order)
        return packed.append_column("sequence_id", pa.array(sequence)).append_column(
            "offset", pa.array(before - first[number]))

    schema = (
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
    rest = dealt.where(F.col("length") < capacity).drop("_n")
    return alone.unionByName(rest.groupBy("_group").applyInArrow(pack, schema))
