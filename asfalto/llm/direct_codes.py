"""Token ids as directly addressable codes in files.

An id is cut into chunks of eight bits, lowest first. Level k holds the k-th chunk of every id that
has one, and a bitmap that says which of them go on in level k + 1; the place there is the
number of set bits before, found through a directory of counts per 512 bits. So any token of a
segment is read with a few look-ups, without decoding what stands before it.

Files are Parquet with one segment of whole documents per row, in ascending document order over
files and rows. Repeated document ids stay separate rows, ordered by their texts; null ids come
first; null texts are empty, and a document without tokens holds its end id alone.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from asfalto.llm.batches import text_parts, texts_of
from asfalto.llm.wordpiece import ended, word_codec

SEGMENT_TOKENS = 1 << 18
_BLOCK = 512
_MAGIC = b"DAC1"
_SET_BITS = np.array([bin(i).count("1") for i in range(256)], np.uint8)

_SCHEMA = (
    "shard int, segment int, start long, n_tokens long, doc_ids array<bigint>, "
    "lengths array<bigint>, codes binary"
)


def pack(ids: np.ndarray) -> bytes:
    """The codes of a row of ids, any unsigned 32-bit numbers."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        chunk = (rest & 0xFF).astype(np.uint8)
        more = rest > 0xFF
        padded = np.zeros(-(-len(rest) // _BLOCK) * (_BLOCK // 8), np.uint8)
        bits = np.packbits(more, bitorder="little")
        padded[: len(bits)] = bits
        counts = _SET_BITS[padded].reshape(-1, _BLOCK // 8).sum(axis=1, dtype=np.uint32)
        ranks = (np.cumsum(counts, dtype=np.uint32) - counts).astype("<u4")
        levels.append((len(rest), chunk.tobytes(), padded.tobytes(), ranks.tobytes()))
        rest = rest[more] >> 8
        if not len(rest):
            break
    head = struct.pack("<4sB", _MAGIC, len(levels)) + b"".join(
        struct.pack("<I", n) for n, *_ in levels
    )
    return head + b"".join(part for _, *parts in levels for part in parts)


class DirectCodes:
    """Reads packed ids: one by place, or all."""

    def __init__(self, codes: bytes):
        magic, count = struct.unpack_from("<4sB", codes)
        if magic != _MAGIC:
            raise ValueError("not directly addressable codes")
        sizes = struct.unpack_from(f"<{count}I", codes, 5)
        at, self._levels = 5 + 4 * count, []
        for n in sizes:
            blocks = -(-n // _BLOCK)
            chunk = np.frombuffer(codes, np.uint8, n, at)
            bits = np.frombuffer(codes, np.uint8, blocks * (_BLOCK // 8), at + n)
            ranks = np.frombuffer(codes, "<u4", blocks, at + n + len(bits))
            at += n + len(bits) + 4 * blocks
            self._levels.append((chunk, bits, ranks))

    def __len__(self) -> int:
        return len(self._levels[0][0])

    def __getitem__(self, place: int) -> int:
        if not 0 <= place < len(self):
            raise IndexError(place)
        value = 0
        for level, (chunk, bits, ranks) in enumerate(self._levels):
            value |= int(chunk[place]) << (8 * level)
            if not bits[place >> 3] >> (place & 7) & 1:
                break
            block = place // _BLOCK
            first = block * (_BLOCK // 8)
            before = int(_SET_BITS[bits[first : place >> 3]].sum())
            before += bin(int(bits[place >> 3]) & ((1 << (place & 7)) - 1)).count("1")
            place = int(ranks[block]) + before
        return value

    def all(self) -> np.ndarray:
        chunk, bits, _ = self._levels[0]
        ids = chunk.astype(np.uint32)
        where = np.flatnonzero(np.unpackbits(bits, count=len(chunk), bitorder="little"))
        for level, (chunk, bits, _) in enumerate(self._levels[1:], 1):
            ids[where] |= chunk.astype(np.uint32) << np.uint32(8 * level)
            go_on = np.unpackbits(bits, count=len(chunk), bitorder="little").astype(bool)
            where = where[go_on]
        return ids


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    id_column: str = "doc_id",
    text_column: str = "text",
    segment_tokens: int = SEGMENT_TOKENS,
) -> None:
    """Encode every text, append `end_id`, and write the codes to `path` by ascending id."""

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, shard = word_codec(tokenizer), TaskContext.get().partitionId()
        held: list[tuple[list, np.ndarray, np.ndarray]] = []
        number = start = waiting = 0

        def segment() -> pa.RecordBatch:
            nonlocal number, start, waiting
            lengths = np.concatenate([n for _, n, _ in held])
            row = pa.RecordBatch.from_arrays(
                [
                    pa.array([shard], pa.int32()),
                    pa.array([number], pa.int32()),
                    pa.array([start], pa.int64()),
                    pa.array([waiting], pa.int64()),
                    pa.array([[i for d, _, _ in held for i in d]], pa.list_(pa.int64())),
                    pa.array([lengths], pa.list_(pa.int64())),
                    pa.array([pack(np.concatenate([x for _, _, x in held]))], pa.binary()),
                ],
                names=["shard", "segment", "start", "n_tokens", "doc_ids", "lengths", "codes"],
            )
            number, start, waiting = number + 1, start + waiting, 0
            held.clear()
            return row

        for part in text_parts(batches, keep=tokenizer):
            ids, offsets = ended(*codec.encode(texts_of(part)), end_id)
            names, first = part.column("doc_id").to_pylist(), 0
            while first < part.num_rows:
                room = offsets[first] + max(1, segment_tokens - waiting)
                last = int(np.searchsorted(offsets, room, side="right")) - 1
                if last <= first:  # the next document does not fit
                    if held:
                        yield segment()
                        continue
                    last = first + 1
                part_ids = ids[offsets[first] : offsets[last]]
                held.append((names[first:last], np.diff(offsets[first : last + 1]), part_ids))
                waiting += len(part_ids)
                first = last
                if waiting >= segment_tokens:
                    yield segment()
        if held:
            yield segment()

    chosen = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    ).withColumn("_tie", F.xxhash64("text"))
    # the tie value also cuts rows of one repeated id over several ranges
    ordered = chosen.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie", "text")
    (
        ordered.select("doc_id", "text")
        .mapInArrow(segments, _SCHEMA)
        .write.option("compression", "none")
        .parquet(path)
    )


def _segments_of(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_SCHEMA).parquet(path)


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """Ids before each shard; one row per written file, so one task can add them up."""
    totals = _segments_of(spark, path).groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.orderBy("shard")) - F.col("n")
    return totals.select("shard", before.alias("shard_start"))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document: doc_id, start, n_tokens and the crc32 of its ids, all taken from the files."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = memoryview(DirectCodes(row["codes"]).all().astype("<u4")).cast("B")
                ends = np.cumsum(row["lengths"])
                starts = ends - np.array(row["lengths"], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(starts + row["start"] + row["shard_start"], pa.int64()),
                        pa.array(row["lengths"], pa.int64()),
                        pa.array(
                            [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(starts, ends)], pa.int64()
                        ),
                        pa.array([row["shard"]] * len(starts), pa.int32()),
                        pa.array([row["segment"]] * len(starts), pa.int32()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32", "shard", "segment"],
                )

    placed = _segments_of(spark, path).join(F.broadcast(shard_starts(spark, path)), "shard")
    return placed.mapInArrow(
        digests,
        "doc_id long, start long, n_tokens long, ids_crc32 long, shard int, segment int",
    )


def token_at(spark: SparkSession, path: str, shard: int, place: int) -> int:
    """The token at a place of a shard: one row group is found by its statistics, one id is read."""
    row = (
        _segments_of(spark, path)
        .where((F.col("shard") == shard) & (F.col("start") <= place))
        .where(F.col("start") + F.col("n_tokens") > place)
        .select("start", "codes")
        .first()
    )
    if row is None:
        raise IndexError(place)
    return DirectCodes(bytes(row["codes"]))[place - row["start"]]
