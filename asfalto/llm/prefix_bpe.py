"""Byte-level BPE by prefix dynamic programming.

Every prefix of a byte string has exactly one token that can end its encoding. With those last
tokens stored, the encoding of any prefix is read off backwards, bytes can be appended without
encoding anew, and after an edit only the neighbourhood is computed again.

A token may follow another if merging their bytes, lowest rank first, never joins across the
border: undo the merges of both from the highest down, and see whether a pair that meets at the
border would have merged before the merge undone there.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asfalto.llm.batches import held, text_parts

MOST_PIECES = 600_000
MOST_PAIRS = 1_000_000
_NEVER = 1 << 40


class Vocabulary:
    """Ranks of byte strings, with the two parts that each token was merged from."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self._parts: dict[int, tuple[int, int] | None] = {}
        for token, rank in ranks.items():
            if len(token) > 1:
                merged = self._merge(token, rank)
                # None: no encoding arrives at this token
                self._parts[rank] = (merged[0], merged[1]) if len(merged) == 2 else None
        self._pairs: dict[tuple[int, int], bool] = {}
        self._suffixes = ahocorasick.Automaton()
        for token, rank in ranks.items():
            if self.reachable(rank):
                self._suffixes.add_word(token.decode("latin-1"), (rank, len(token)))
        self._suffixes.make_automaton()

    @classmethod
    def from_file(cls, path: str) -> Vocabulary:
        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines if line.strip())
            return cls({base64.b64decode(token): int(rank) for token, rank in pairs})

    def _merge(self, data: bytes, below: int) -> list[int]:
        """Plain merging of pairs with ranks under `below`."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min(
                (self.ranks.get(parts[i] + parts[i + 1], _NEVER), i) for i in range(len(parts) - 1)
            )
            if rank >= below:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def reachable(self, token: int) -> bool:
        return self._parts.get(token, ()) is not None

    def may_follow(self, left: int, right: int) -> bool:
        known = self._pairs.get((left, right))
        if known is None:
            if len(self._pairs) >= MOST_PAIRS:
                self._pairs.clear()
            known = self._pairs[left, right] = self._border_holds(left, right)
        return known

    def _border_holds(self, left: int, right: int) -> bool:
        # `limit`: merges at the border under it happen before the merge last undone. On the right
        # side of the border an equal rank would lose to it, as the leftmost pair goes first.
        limit, tokens = _NEVER, self.tokens
        while True:
            joined = self.ranks.get(tokens[left] + tokens[right])
            if joined is not None and joined < limit:
                return False
            left_parts, right_parts = self._parts.get(left), self._parts.get(right)
            if left_parts and (not right_parts or left > right):
                limit, left = left, left_parts[1]
            elif right_parts:
                limit, right = right + 1, right_parts[0]
            else:
                return True

    def last_tokens(self, data: bytes, last: list[int]) -> list[int]:
        """`last` carried on to every prefix of `data`; it holds those of the first prefixes."""
        known, pairs = len(last), self._pairs
        last = last + [-1] * (len(data) + 1 - known)
        window = max(0, known - self.longest)
        # all tokens that end at a byte, byte by byte
        for at, (token, length) in self._suffixes.iter(data[window:].decode("latin-1")):
            end = window + at + 1
            if last[end] >= 0 or length > end:
                continue
            if end > length:
                before = last[end - length]
                holds = pairs.get((before, token))
                if holds is None:
                    holds = self.may_follow(before, token)
                if not holds:
                    continue
            last[end] = token
        if -1 in last[1:]:
            raise ValueError("the vocabulary lacks a byte")
        return last

    def encode(self, data: bytes) -> list[int]:
        return backwards(self, self.last_tokens(data, [-1]), len(data))


def backwards(vocabulary: Vocabulary, last: list[int], at: int) -> list[int]:
    """The encoding of a prefix, from its last token to its first, in reading order."""
    found = []
    while at > 0:
        found.append(last[at])
        at -= len(vocabulary.tokens[found[-1]])
    return found[::-1]


class PrefixTable:
    """The last token of every prefix of a byte string, kept through appends and edits."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self._vocabulary, self.data, self._last = vocabulary, b"", [-1]
        self.append(data)

    def append(self, data: bytes) -> None:
        self.data += data
        self._last = self._vocabulary.last_tokens(self.data, self._last)

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put `new` in place of data[start:stop]; returns how many last tokens were computed.

        A last token depends on no more bytes than the longest token has, so once that many in a
        row agree with those before the edit, all later ones do.
        """
        old, tail, vocabulary = self._last, len(self.data) - stop, self._vocabulary
        self.data = self.data[:start] + new + self.data[stop:]
        self._last, agreeing = old[: start + 1], 0
        edited, moved = start + len(new), stop - start - len(new)
        for end in range(start + 1, edited + tail + 1):
            self._last = vocabulary.last_tokens(self.data[:end], self._last)
            if end > edited:
                agreeing = agreeing + 1 if self._last[end] == old[end + moved] else 0
                if agreeing == vocabulary.longest:
                    self._last += old[end + moved + 1 :]
                    return end - start
        return edited + tail - start

    def tokens(self, end: int | None = None) -> list[int]:
        """Encoding of the first `end` bytes, all by default."""
        return backwards(self._vocabulary, self._last, len(self.data) if end is None else end)


class _Pieces(dict):
    """Ids of pieces as little-endian bytes; a piece met first is encoded."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self._vocabulary = vocabulary

    def __missing__(self, piece: str) -> bytes:
        data = piece.encode()
        whole = self._vocabulary.ranks.get(data)
        ids = [whole] if whole is not None else self._vocabulary.encode(data)
        found = np.array(ids, "<u4").tobytes()
        if len(self) >= MOST_PIECES:
            self.clear()
        self[piece] = found
        return found


class TextCodec:
    """Whole texts: each match of the pattern is encoded on its own."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.vocabulary = Vocabulary.from_file(path)
        self._split = regex.compile(pattern).findall
        self._pieces = _Pieces(self.vocabulary)
        self._bytes = [self.vocabulary.tokens[i] for i in range(len(self.vocabulary.tokens))]

    def encode(self, text: str) -> bytes:
        return b"".join(map(self._pieces.__getitem__, self._split(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self._bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def text_codec(path: str, pattern: str) -> TextCodec:
    """One codec per Python worker; the arguments are its key in `batches.held`."""
    return held((path, pattern), lambda: TextCodec(path, pattern))


def encode_digests(
    docs: DataFrame, ranks_path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per row: number of ids, sha256 of the ids and of the bytes decoded from them.

    A null text is empty: no ids, digests of nothing. Rows with equal ids stay separate.
    """

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = text_codec(ranks_path, pattern)
        for part in text_parts(batches, keep=(ranks_path, pattern)):
            counts, hashed, decoded = [], [], []
            for text in part.column("text"):
                ids = codec.encode(text.as_py() or "")
                counts.append(len(ids) // 4)
                hashed.append(hashlib.sha256(ids).hexdigest())
                decoded.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(hashed), pa.array(decoded)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    ).mapInArrow(digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
