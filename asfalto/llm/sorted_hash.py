"""Counts by 64-bit hash: gathered over a shuffle, kept as sorted arrays in files, memory-mapped.

A task adds up its own counts and cuts them by hash into one packed row per shard; Spark deals
the rows out by shard, and one task per shard merges them. A key's share of a shard is at most one
entry per packed row, however often it occurs, so no key makes a shard large. Shards cover equal
ranges of the hash; their number grows with the input.

Shard files are NumPy arrays under a name that only a finished task gives them, so a task that runs
again replaces its file by the same file.
"""

from __future__ import annotations

import os
import re
import struct
import tempfile
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs

FLUSH_KEYS = 2_000_000
ROWS = "kind string, shard int, packed binary"

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_I1, _I2 = (np.uint64(pow(int(m), -1, 1 << 64)) for m in (_M1, _M2))
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = x ^ (x >> _U(30))
    x *= _M1
    x ^= x >> _U(27)
    x *= _M2
    x ^= x >> _U(31)
    return x


def unmix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U(31)) ^ (x >> _U(62))
    x *= _I2
    x ^= (x >> _U(27)) ^ (x >> _U(54))
    x *= _I1
    x ^= (x >> _U(30)) ^ (x >> _U(60))
    return x


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """Place of the key's range; larger keys never have a smaller one."""
    return ((keys >> _U(32)) * _U(shards) >> _U(32)).astype(np.int64)


def added_up(keys: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys, ascending, with the sums of their columns."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[len(keys) > 0], keys[1:] != keys[:-1]])[: len(keys)])
    return keys[first], *(
        np.add.reduceat(c[order].astype(np.int64), first) if len(first) else c[:0] for c in columns
    )


def _narrow(values: np.ndarray) -> tuple[int, bytes]:
    """Unsigned numbers in as few bytes each as the largest needs."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    return width, np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _widen(data: bytes, at: int, count: int, width: int) -> np.ndarray:
    wide = np.zeros((count, 8), np.uint8)
    wide[:, :width] = np.frombuffer(data, np.uint8, count * width, at).reshape(count, width)
    return wide.view("<u8").reshape(-1)


def pack(keys: np.ndarray, *columns: np.ndarray) -> bytes:
    """Ascending keys as differences, and their columns, in as few bytes as each needs."""
    steps = keys.copy()
    steps[1:] -= keys[:-1]
    out, head = [], [struct.pack("<IB", len(keys), len(columns))]
    for values in (steps[1:], *columns):
        width, data = _narrow(values)
        head.append(struct.pack("<B", width))
        out.append(data)
    return b"".join([*head, struct.pack("<Q", int(keys[0]) if len(keys) else 0), *out])


def unpack(data: bytes) -> tuple[np.ndarray, ...]:
    count, n = struct.unpack_from("<IB", data)
    widths, at = struct.unpack_from(f"<{n + 1}B", data, 5), 6 + n
    steps = np.empty(count, np.uint64)
    if count:
        steps[0] = struct.unpack_from("<Q", data, at)[0]
        steps[1:] = _widen(data, at + 8, count - 1, widths[0])
    at += 8 + max(0, count - 1) * widths[0]
    columns = []
    for width in widths[1:]:
        columns.append(_widen(data, at, count, width).astype(np.int64))
        at += count * width
    return np.cumsum(steps, dtype=np.uint64), *columns


def packed_rows(kind: str, shards: int, keys: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    """One row for every shard that has some of these ascending keys."""
    places = shard_of(keys, shards)
    cuts = np.flatnonzero(np.diff(places, prepend=-1))
    ends = np.append(cuts[1:], len(keys))
    return rows_of(
        kind, [int(places[a]) for a in cuts],
        [pack(keys[a:b], *(c[a:b] for c in columns)) for a, b in zip(cuts, ends)],
    )


def rows_of(kind: str, shards: list[int], packed: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([kind] * len(shards), pa.string()), pa.array(shards, pa.int32()), pa.array(packed, pa.binary())],
        names=["kind", "shard", "packed"],
    )


class Counter:
    """Gathers keys of a task and gives packed rows when many have come together."""

    def __init__(self, kind: str, shards: int):
        self._kind, self._shards = kind, shards
        self._held: list[tuple[np.ndarray, np.ndarray]] = []
        self._size = 0

    def add(self, keys: np.ndarray, counts: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
        self._held.append((keys, np.ones(len(keys), np.uint32) if counts is None else counts))
        self._size += len(keys)
        if self._size >= FLUSH_KEYS:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self._held:
            keys, counts = (np.concatenate(c) for c in zip(*self._held))
            self._held, self._size = [], 0
            if len(keys):
                yield packed_rows(self._kind, self._shards, *added_up(keys, counts))


def merged(packed: list[bytes]) -> tuple[np.ndarray, ...]:
    """Packed rows of one shard added up."""
    parts = [unpack(p) for p in packed]
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return added_up(*(np.concatenate(c) for c in zip(*parts)))


# --- files -------------------------------------------------------------------------------


def _place(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder)


def write_shard(folder: str, shard: int, **columns: np.ndarray) -> None:
    files, path = _place(folder)
    files.create_dir(path, recursive=True)
    for name, values in columns.items():
        begun = f"{path}/.{name}-{uuid.uuid4().hex}"
        with files.open_output_stream(begun) as out:
            np.lib.format.write_array(out, np.ascontiguousarray(values))
        files.move(begun, f"{path}/{shard:08d}.{name}.npy")


def _mapped(files: pafs.FileSystem, path: str) -> np.ndarray:
    """The array, memory-mapped; from a remote store by way of a copy that goes with the process."""
    if isinstance(files, pafs.LocalFileSystem):
        return np.load(path, mmap_mode="r")
    handle, copy = tempfile.mkstemp(suffix=".npy")
    try:
        with files.open_input_stream(path) as source, os.fdopen(handle, "wb") as out:
            while chunk := source.read(1 << 22):
                out.write(chunk)
        return np.load(copy, mmap_mode="r")
    finally:
        os.unlink(copy)  # the mapping keeps the data


class SortedHashes:
    """Columns of all shards, found by key."""

    def __init__(self, folder: str, shards: int):
        files, path = _place(folder)
        self.shards = shards
        self._arrays: list[dict[str, np.ndarray]] = [{} for _ in range(shards)]
        for found in files.get_file_info(pafs.FileSelector(path, allow_not_found=True)):
            if named := re.fullmatch(r"(\d+)\.(\w+)\.npy", found.base_name):
                self._arrays[int(named[1])][named[2]] = _mapped(files, f"{path}/{found.base_name}")

    def find(self, keys: np.ndarray, *names: str, bases: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
        """(place or -1, then each named column, 0 where the key is missing) for every key.

        Places count within a shard, or over all with the number of keys before each as `bases`.
        """
        order = np.argsort(keys)
        wanted = keys[order]
        cuts = np.searchsorted(shard_of(wanted, self.shards), np.arange(self.shards + 1))
        place = np.full(len(keys), -1, np.int64)
        out = [np.zeros(len(keys), np.int64) for _ in names]
        for shard in range(self.shards):
            own, arrays = wanted[cuts[shard] : cuts[shard + 1]], self._arrays[shard]
            table = arrays.get("keys")
            if not len(own) or table is None or not len(table):
                continue
            at = np.minimum(np.searchsorted(table, own), len(table) - 1)
            hit = table[at] == own
            where = order[cuts[shard] : cuts[shard + 1]][hit]
            at = at[hit]
            place[where] = at + (0 if bases is None else bases[shard])
            for values, name in zip(out, names):
                values[where] = arrays[name][at]
        return place, *out


@lru_cache(maxsize=6)
def opened(folder: str, shards: int, state: str = "") -> SortedHashes:
    """One mapping per Python worker and `state`: another one where columns have come since."""
    return SortedHashes(folder, shards)
