"""Interpolated modified Kneser-Ney language model of word pairs, counted in Spark.

Tokens are the words between ASCII white space, A-Z in lower case, and one end per text. The model is
kept as sorted hash arrays (`sorted_hash`), which the workers that score map into memory:
one row per word with its count, the number of words it follows, and what follows it (total,
and how many words once, twice, more often), and one row per pair with its count. A pair's
hash scrambles the places of its two words one-to-one, so pairs never collide.

    p(w | v) = (c(v w) - D(c)) / c(v .) + g(v) p1(w)
    p1(w) = (n(. w) - D'(n)) / n(. .) + g' / (V + 1)

with three discounts per order from the counts of counts; V + 1 leaves room for an unknown word.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asfalto.llm import sorted_hash as H
from asfalto.llm.batches import crc32_mod, split_words, text_parts, texts_of
from asfalto.operators.layout import stage
from asfalto.session import new_folder

SHARD_BYTES = 24 << 20  # of training text for one shard of the arrays

# Outside all words, which hold no space.
_END, _START = (np.uint64(xxhash.xxh3_64_intdigest(s)) for s in (" end", " start"))
_STATS = ("follows", "total", "once", "twice", "more")


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every token, each text closed by an end; offsets of the texts)."""
    places, words, offsets = split_words(pc.ascii_lower(texts))
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words.to_pylist()), np.uint64, len(words))
    tokens = np.insert(hashes[places], offsets[1:], _END)
    return tokens, offsets + np.arange(len(offsets))


def _contexts(values: np.ndarray, offsets: np.ndarray, start) -> np.ndarray:
    """The token before each token, `start` before the first of a text."""
    before = np.empty_like(values)
    before[1:] = values[:-1]
    before[offsets[:-1]] = start
    return before


def _pair_keys(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    return H.mix((before.astype(np.uint64) << np.uint64(32)) | words.astype(np.uint64))


def discounts(counts: list[int]) -> tuple[float, float, float]:
    """Discounts for counts of 1, 2 and more, from the number of entries with counts 1 to 4.

    Where a count of counts is missing (small corpora), its discount is half of the count.
    """
    n1, n2, n3, n4 = counts
    y = n1 / (n1 + 2 * n2) if n1 and n2 else 0.0
    found = []
    for k, (here, above) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1):
        d = k - (k + 1) * y * above / here if y and here and above else k / 2
        found.append(min(max(d, 0.05), k))
    return tuple(found)


def _discounted(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return counts - np.array([0.0, *d])[np.minimum(counts, 3)]


@dataclass(frozen=True)
class PairModel:
    """Where the arrays are, and the numbers that belong to all of them."""

    folder: str
    shards: int
    bases: tuple[int, ...]  # words before each shard
    tokens: int
    words: int
    pairs: int
    pair_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    word_rest: float  # share of p1 that is spread evenly

    def _words(self) -> H.SortedHashes:
        return H.opened(f"{self.folder}/words", self.shards, "whole")

    def _lookup(self, tokens: np.ndarray):
        """Per distinct token: place, count and statistics."""
        distinct, back = np.unique(tokens, return_inverse=True)
        return back, self._words().find(
            np.append(distinct, _START), "count", *_STATS, bases=np.array(self.bases)
        )

    def log10_probabilities(self, tokens: np.ndarray, offsets: np.ndarray):
        """(log10 p of each token after the one before it, its count in training)."""
        back, (place, count, follows, total, *ways) = self._lookup(tokens)
        ids = place[:-1][back]
        before = _contexts(ids, offsets, place[-1])
        before_at = _contexts(back, offsets, len(place) - 1)
        evenly = self.word_rest / (self.words + 1)
        p1 = np.maximum(0.0, _discounted(follows, self.word_discounts)) / max(1, self.pairs) + evenly
        if not self.pairs:
            p1 = np.full(len(place), 1.0)
        held = sum(d * n for d, n in zip(self.pair_discounts, ways))
        rest = np.where(total > 0, held / np.maximum(1, total), 1.0)
        p = rest[before_at] * p1[:-1][back]
        seen = np.flatnonzero((ids >= 0) & (before >= 0) & (total[before_at] > 0))
        pairs = H.opened(f"{self.folder}/pairs", self.shards)
        _, c = pairs.find(_pair_keys(before[seen], ids[seen]), "count")
        p[seen] += np.where(c > 0, _discounted(c, self.pair_discounts), 0.0) / total[before_at[seen]]
        return np.log10(p), count[:-1][back]


def _write_words(shards: int, folder: str):
    """Merge counts of words per shard; gives each shard's number of words and of tokens."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, rows = None, []
        for batch in batches:
            for row in batch.to_pylist():
                shard = row["shard"]
                rows.append(row["packed"])
        if shard is not None:
            keys, counts = H.merged(rows)
            H.write_shard(folder, shard, keys=keys, count=counts)
            yield H.rows_of("words", [shard], [struct.pack("<2q", len(keys), int(counts.sum()))])

    return write


def train(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> PairModel:
    """Count all texts of `docs`; null texts are empty. An empty table gives p = 1 for any token."""
    spark = docs.sparkSession
    texts = docs.select(F.col("text").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))
    folder = new_folder(spark, "pair-model")

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = H.Counter("words", shards)
        for part in text_parts(batches):
            tokens, _ = _tokens(texts_of(part))
            yield from counter.add(*H.added_up(tokens, np.ones(len(tokens), np.uint32)))
            # a row for the start, which is no token
            yield from counter.add(np.array([_START]), np.zeros(1, np.uint32))
        yield from counter.flush()

    dealt = texts.mapInArrow(count_words, H.ROWS).repartitionById(shards, F.col("shard"))
    sums = dealt.mapInArrow(_write_words(shards, f"{folder}/words"), H.ROWS).collect()  # one row per shard
    sizes = np.zeros(shards, np.int64)
    tokens = 0
    for row in sums:
        sizes[row["shard"]], n = struct.unpack("<2q", row["packed"])
        tokens += n
    bases = np.cumsum(sizes) - sizes
    words = max(0, int(sizes.sum()) - 1)

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, known = H.Counter("pairs", shards), H.opened(f"{folder}/words", shards, "counts")
        for part in text_parts(batches):
            tokens, offsets = _tokens(texts_of(part))
            distinct, back = np.unique(tokens, return_inverse=True)
            (ids,) = known.find(np.append(distinct, _START), bases=bases)
            found = ids[:-1][back]
            yield from counter.add(_pair_keys(_contexts(found, offsets, ids[-1]), found))
        yield from counter.flush()

    def write_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, rows = None, []
        for batch in batches:
            for row in batch.to_pylist():
                shard = row["shard"]
                rows.append(row["packed"])
        if shard is None:
            return
        keys, counts = H.merged(rows)
        H.write_shard(f"{folder}/pairs", shard, keys=keys, count=counts.astype(np.uint32))
        yield H.rows_of("pairs", [shard], [
            struct.pack("<5q", len(keys), *(int((counts == k).sum()) for k in (1, 2, 3, 4)))
        ])
        pairs = H.unmix(keys)
        before, after = pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)
        nothing = np.zeros(len(keys), np.int64)
        # both words of a pair get their part of the statistics, sent to the shards of the words
        of_before = H.added_up(
            before, nothing, counts, *((counts == k).astype(np.int64) for k in (1, 2)),
            (counts > 2).astype(np.int64),
        )
        of_after = H.added_up(after, nothing + 1)
        for ids, columns in ((of_before[0], of_before[1:]), (of_after[0], of_after[1:])):
            owner = np.searchsorted(bases, ids, side="right") - 1
            cuts = np.flatnonzero(np.diff(owner, prepend=-1))
            ends = np.append(cuts[1:], len(ids))
            yield H.rows_of("stats", [int(owner[a]) for a in cuts], [
                H.pack(ids[a:b], *(c[a:b] for c in columns)) for a, b in zip(cuts, ends)
            ])

    dealt = texts.mapInArrow(count_pairs, H.ROWS).repartitionById(shards, F.col("shard"))
    parts = stage(dealt.mapInArrow(write_pairs, H.ROWS), "pair-stats")

    def write_stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, stats = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if stats is None:
                    shard = row["shard"]
                    stats = np.zeros((len(_STATS), sizes[shard]), np.int64)
                ids, *columns = H.unpack(row["packed"])
                at = (ids - np.uint64(bases[shard])).astype(np.int64)
                for place, values in enumerate(columns):
                    stats[place, at] += values  # ids are distinct within a row
        if stats is None:
            return
        H.write_shard(f"{folder}/words", shard, **dict(zip(_STATS, stats)))
        yield H.rows_of("follows", [shard], [
            struct.pack("<4q", *(int((stats[0] == k).sum()) for k in (1, 2, 3, 4)))
        ])

    dealt = parts.where(F.col("kind") == "stats").repartitionById(shards, F.col("shard"))
    by_word = dealt.mapInArrow(write_stats, H.ROWS).collect()  # one row per shard
    by_pair = parts.where(F.col("kind") == "pairs").collect()
    pair_sums = np.sum([struct.unpack("<5q", r["packed"]) for r in by_pair] or [[0] * 5], axis=0).tolist()
    word_sums = np.sum([struct.unpack("<4q", r["packed"]) for r in by_word] or [[0] * 4], axis=0).tolist()
    pairs, word_discounts = int(pair_sums[0]), discounts(word_sums)
    n1, n2 = word_sums[:2]
    held = word_discounts[0] * n1 + word_discounts[1] * n2 + word_discounts[2] * max(0, words - n1 - n2)
    return PairModel(
        folder, shards, tuple(bases.tolist()), tokens, words, pairs,
        discounts(pair_sums[1:]), word_discounts, held / pairs if pairs else 1.0,
    )


def score(docs: DataFrame, model: PairModel) -> DataFrame:
    """Scores of every row of `docs`; a null text is empty and has the end as its only token.

    Columns are doc_id, n_tokens, n_known, train_tokens, base_score, score.
    """

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_parts(batches, most=4 << 20):
            tokens, offsets = _tokens(texts_of(part))
            logs, counts = model.log10_probabilities(tokens, offsets)
            base = np.log10((counts + 1) / (model.tokens + model.words + 1))
            first = offsets[:-1]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(np.diff(offsets), pa.int64()),
                    pa.array(np.add.reduceat((counts > 0).astype(np.int64), first), pa.int64()),
                    pa.array(np.full(len(first), model.tokens), pa.int64()),
                    pa.array(np.add.reduceat(base, first), pa.float64()),
                    pa.array(np.add.reduceat(logs, first), pa.float64()),
                ],
                names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")
    ).mapInArrow(
        scored,
        "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )


def held_out(doc_id):
    return crc32_mod(doc_id, 7) == 2
