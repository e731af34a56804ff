"""Arrow batches of bounded size, and words of whole texts as arrays."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Hashable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PART_BYTES = 4 << 20
# What Spark hands to a Python worker at once; by default 10,000 whole texts of any size.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(PART_BYTES),
}


def bound_batches(spark) -> None:
    """Bound the Arrow batches of this session, whose tasks hold them in the JVM and in Python."""
    for name, value in BATCHES.items():
        spark.conf.set(name, value)


_held: dict[Hashable, object] = {}


def held(key: Hashable, make: Callable[[], object]) -> object:
    """What `make` gives, kept by this Python worker until an operator comes that does not want it.

    Spark uses a worker for one operator after another; without this it would keep the vocabularies of them all.
    """
    if key not in _held:
        let_go()
        _held[key] = make()
    return _held[key]


def let_go(keep: Hashable = None) -> None:
    """Forget what is held but `keep`, and give free memory back: pools keep what their largest part took."""
    for key in [k for k in _held if k != keep]:
        del _held[key]
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def text_parts(
    batches: Iterator[pa.RecordBatch], column: str = "text", most: int = PART_BYTES, keep: Hashable = None
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a part holds about `most` bytes of `column`; a longer text stays whole.

    `keep` is the key of what the operator holds while it works.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(False)
        ends = np.cumsum(sizes, dtype=np.int64)
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(first, last - first)
            first = last
        let_go(keep)


def texts_of(part: pa.RecordBatch, column: str = "text") -> pa.Array:
    """The texts of a part; null counts as empty."""
    return pc.fill_null(part.column(column), "")


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Words between ASCII white space: (place in the dictionary of each word, dictionary, offsets).

    Words of text i are those from offsets[i] to offsets[i + 1].
    """
    lists = pc.ascii_split_whitespace(texts)
    encoded = lists.values.dictionary_encode()
    words, places = encoded.dictionary, encoded.indices.to_numpy(False)
    offsets = lists.offsets.to_numpy(False).astype(np.int64)
    empty = pc.index(words, "").as_py()
    if empty >= 0:
        keep = places != empty
        offsets = np.concatenate([[0], np.cumsum(keep, dtype=np.int64)])[offsets]
        places = places[keep]
    return places, words, offsets


def crc32_mod(column, divisor: int):
    """crc32 of the value as text, modulo `divisor`; null counts as the empty text."""
    from pyspark.sql import functions as F

    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % divisor


def free_name(wanted: str, taken: list[str]) -> str:
    """`wanted`, with underscores before it until no column has that name, whatever its case."""
    lower = {c.lower() for c in taken}
    while wanted.lower() in lower:
        wanted = f"_{wanted}"
    return wanted
