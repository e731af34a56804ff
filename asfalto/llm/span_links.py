"""Alignment of two tokenizers over the same bytes: which tokens overlap, and where both end together.

Tokens of side A and side B are laid on the bytes of a space and the text, one text after another. Within a
batch, pandas merge_asof takes the start of each token to the other side's token that covers it; the union of
both directions is every overlapping pair, for an overlap begins where one of its tokens does. Ends that both
sides share cut the text into groups.

Where both sides have a token end at every single space, groups and links of a text are those of its words in a
row. So a worker aligns a word when it first meets it and keeps what it found, up to a bound. Texts with other
runs of white space are aligned whole.

How often two ids overlap is counted over the whole corpus without moving links. A task numbers the distinct
pairs of a run of documents (a chunk, of bounded size) and stores, per document, those numbers and how
often each occurs. Chunk counts are added up per pair, each chunk's pairs are joined to the sums, and the
sums come back to the chunk's documents. So a pair crosses the network once a chunk, however common it is.

Texts that are null or empty, and those whose token bytes on either side are not the space and the text (white
space or characters that a tokenizer rewrites), have no tokens: zeros and ''. Each row of a repeated doc_id
counts; other columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asfalto.llm.batches import held, text_parts, texts_of
from asfalto.operators.layout import stage

PART_BYTES = 2 << 20  # text aligned at once
MOST_WORDS = 400_000
WORDS_AT_ONCE = 64
# White space beside white space or an end, or the mark that stands for a space inside one tokenizer. Generous: such a
# text is only encoded the longer way.
_SPACE = r"[\s\x0B\x1C-\x1F\x{85}\pZ]"
_ODD_SPACE = f"{_SPACE}{_SPACE}|^{_SPACE}|{_SPACE}\\z|▁"
# A chunk ends past so many distinct pairs, or so many distinct pairs of its documents added up.
CHUNK_PAIRS = 1 << 19
CHUNK_LINKS = 1 << 22

# Aligned words or whole texts: whether both sides have the text's bytes (nothing follows if not), numbers of tokens
# and of groups, the groups with `;` after each, and an entry per overlapping pair of tokens: see Sides.pair.
UNITS = pa.schema([
    ("good", pa.bool_()), ("n_a", pa.int32()), ("n_b", pa.int32()), ("n_groups", pa.int32()),
    ("groups", pa.large_binary()), ("links", pa.large_list(pa.int64())),
])

# A chunk is a row of place -1 that holds its documents, and a row per distinct pair. Lists have an entry per
# document: `sizes` says how many of the numbers packed in `places` and `repeats` are its own.
DOCUMENTS = (
    "doc_ids array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, "
    "hashes array<string>, sizes array<bigint>, places binary, repeats binary"
)
CHUNK = f"chunk long, place int, pair long, count long, {DOCUMENTS}"
RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
    "groups_sha256 string"
)
_LONGS = pa.list_(pa.int64())
_DOCUMENTS = pa.schema([
    ("doc_ids", _LONGS), ("n_a", _LONGS), ("n_b", _LONGS), ("n_groups", _LONGS), ("hashes", pa.list_(pa.string())),
    ("sizes", _LONGS), ("places", pa.binary()), ("repeats", pa.binary()),
])
_CHUNK = pa.schema([("chunk", pa.int64()), ("place", pa.int32()), ("pair", pa.int64()), ("count", pa.int64()),
                    *_DOCUMENTS])


def byte_level() -> dict[str, int]:
    """Byte of each character in a byte-level vocabulary: printable ones are themselves, the others follow from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


Tokens = tuple[np.ndarray, np.ndarray]  # ids of all texts in a row, offsets of each text


def _offsets(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


class Side:
    """One tokenizer: ids of texts, and the bytes of each id."""

    def __init__(self, words: list[bytes], encode: Callable[[list[str]], list[list[int]]], whole_words: bool):
        self.encode, self.whole_words = encode, whole_words
        self.sizes = np.array([len(w) for w in words], np.int64)
        self._data = np.frombuffer(b"".join(words), np.uint8)
        self._starts = np.cumsum(self.sizes) - self.sizes
        decimal = np.array([str(n).encode() for n in range(len(words))])
        self.digits = decimal.view(np.uint8).reshape(len(words), -1)  # of each id, zero bytes after them

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        return self._data[np.repeat(self._starts[ids] - ends + sizes, sizes) + np.arange(ends[-1] if len(ids) else 0)]

    def encode_words(self, words: list[str]) -> Tokens:
        """Words of which none is empty and which single spaces may part: many at once, cut at their bytes."""
        texts = [" ".join(words[n : n + WORDS_AT_ONCE]) for n in range(0, len(words), WORDS_AT_ONCE)]
        ids = _flat(self.encode(texts) if texts else [])
        ends = np.cumsum(self.sizes[ids])
        wanted = np.cumsum(pc.binary_length(pa.array(words, pa.string())).to_numpy(False) + np.int64(1))
        at = np.searchsorted(ends, wanted)
        if len(wanted) and (ends[-1:] != wanted[-1] or (ends[at] != wanted).any()):
            found = self.encode(words)  # a word's tokens have other bytes than the word
            return _flat(found), _offsets([len(f) for f in found])
        return ids, np.concatenate([[0], at + 1])


def _flat(found: list[list[int]]) -> np.ndarray:
    return np.fromiter(itertools.chain.from_iterable(found), np.int64, sum(map(len, found)))


def byte_side(path: str) -> Side:
    """A byte-level vocabulary of the tokenizers library; a space comes before the text."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their strings are ordinary text
    table = byte_level()
    size = tokenizer.get_vocab_size(with_added_tokens=True)
    words = [bytes(table[c] for c in tokenizer.id_to_token(n)) for n in range(size)]

    def encode(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast([f" {t}" for t in texts], add_special_tokens=False)]

    # its pattern puts a single space at the start of a piece, and merges stay within pieces
    return Side(words, encode, whole_words=True)


def piece_side(path: str) -> Side:
    """A sentencepiece model, which puts a space before the text itself."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(n) for n in range(model.get_piece_size())]
    words = [
        bytes([int(p[3:5], 16)]) if model.is_byte(n) else p.replace("▁", " ").encode() for n, p in enumerate(pieces)
    ]
    # where no piece has a space past its start, merges cannot join words
    whole_words = all("▁" not in p.lstrip("▁") for p in pieces)
    return Side(words, lambda texts: model.encode(texts, num_threads=1), whole_words)


class Sides:
    """Both tokenizers over arrays of texts; words that were aligned are kept, up to a bound.

    Neither side joins what a single space parts, so a text without other runs of white space is its words' ids in
    a row. Other texts are encoded whole.
    """

    def __init__(self, a: Side, b: Side):
        self.a, self.b = a, b
        self._forget()

    def _forget(self) -> None:
        self._places: dict[str, int] = {}
        self.known = pa.RecordBatch.from_pylist([], UNITS)

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """A number for an id of each side."""
        return a * len(self.b.sizes) + b

    def odd(self, texts: pa.Array) -> np.ndarray:
        """Which texts are to be taken whole."""
        if not (self.a.whole_words and self.b.whole_words):
            return pc.greater(pc.binary_length(texts), 0).to_numpy(False)
        return pc.match_substring_regex(texts, _ODD_SPACE).to_numpy(False)

    def split(self, texts: pa.Array, odd: np.ndarray) -> tuple[np.ndarray, list[str], np.ndarray]:
        """(place of each word among the distinct ones, these, offsets of texts); an odd text is one empty word."""
        lists = pc.split_pattern(pc.if_else(pa.array(odd), "", texts), " ")
        encoded = lists.values.dictionary_encode()
        return encoded.indices.to_numpy(False), encoded.dictionary.to_pylist(), lists.offsets.to_numpy(False)

    def encode(self, texts: pa.Array) -> tuple[Tokens, Tokens]:
        odd = self.odd(texts)
        at, words, offsets = self.split(texts, odd)
        filled = np.fromiter(map(bool, words), bool, len(words))
        rest = np.flatnonzero(odd).tolist()
        whole = [texts[i].as_py() for i in rest]
        found = []
        for side in (self.a, self.b):
            ids, ends = side.encode_words([w for w in words if w])
            sizes = np.zeros(len(words), np.int64)
            sizes[filled] = np.diff(ends)
            total = _offsets(sizes[at])
            where = np.repeat((np.cumsum(sizes) - sizes)[at] - total[:-1], sizes[at]) + np.arange(total[-1])
            found.append(_with_whole((ids[where], total[offsets]), rest, side.encode(whole) if whole else []))
        return tuple(found)

    def places(self, words: list[str]) -> np.ndarray:
        """Where distinct words are in `known`, the new ones aligned."""
        if len(self._places) > MOST_WORDS:
            self._forget()
        new = [w for w in words if w not in self._places]
        if new:
            first = len(self._places)
            self.known = pa.concat_batches([self.known, units(pa.array(new, pa.string()), self)])
            self._places.update(zip(new, range(first, first + len(new))))
        return np.fromiter(map(self._places.__getitem__, words), np.int64, len(words))


def _with_whole(tokens: Tokens, places: list[int], found: list[list[int]]) -> Tokens:
    """Tokens with those of some texts, which had none, put in."""
    if not places:
        return tokens
    (ids, offsets), parts, last, sizes = tokens, [], 0, np.diff(tokens[1])
    for n, own in zip(places, found):
        parts += [ids[offsets[last] : offsets[n]], np.array(own, np.int64)]
        last, sizes[n] = n, len(own)
    return np.concatenate([*parts, ids[offsets[last] :]]), np.concatenate([[0], np.cumsum(sizes)])


def _cut(side: Side, tokens: Tokens, texts: pa.Array) -> np.ndarray:
    """Which texts' tokens have the bytes of a space and the text; an empty text has none."""
    ids, offsets = tokens
    wanted = pc.binary_length(texts).to_numpy(False) + np.int64(1)
    good = (np.diff(_offsets(side.sizes[ids])[offsets]) == wanted) & (wanted > 1)
    data = side.bytes_of(ids[np.repeat(good, np.diff(offsets))])
    large = pa.large_string()
    spaced = pc.binary_join_element_wise(
        pa.scalar("", large), texts.filter(pa.array(good)).cast(large), pa.scalar(" ", large))
    other = np.flatnonzero(data != np.frombuffer(spaced.buffers()[2] or b"", np.uint8, len(data)))
    good[np.flatnonzero(good)[np.searchsorted(np.cumsum(wanted[good]), other, side="right")]] = False
    return good


def _side_frame(side: Side, tokens: Tokens, good: np.ndarray, at: str) -> pd.DataFrame:
    """A row per token: text, id, first byte and the byte after the last, counted over all texts."""
    ids, offsets = tokens
    text = np.repeat(np.arange(len(good)), np.diff(offsets))
    kept = good[text]
    text, ids = text[kept], ids[kept]
    sizes = side.sizes[ids]
    ends = np.cumsum(sizes)
    return pd.DataFrame({"text": text, at: ids, "start": ends - sizes, "end": ends}, copy=False)


def _shared_ends(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Which tokens of each side end where one of the other side does."""
    ends = a["end"].to_numpy(), b["end"].to_numpy()
    marks = np.zeros((2, int(ends[0][-1]) + 1 if len(a) else 0), bool)
    for own, side in zip(marks, ends):
        own[side] = True
    return marks[1][ends[0]], marks[0][ends[1]]


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """(text, a, b) of every pair of tokens whose bytes overlap, one row a pair of occurrences, text by text.

    Both sides have the same bytes, so the last token to start before a byte is one of the same text.
    """
    forth = pd.merge_asof(a[["start", "text", "a"]], b[["start", "b"]], on="start")
    # where both begin, the pair is already there; a token begins where the one before it ends
    shared = np.concatenate([[True], _shared_ends(a, b)[1][:-1]]) if len(b) else np.zeros(0, bool)
    back = pd.merge_asof(b.loc[~shared, ["start", "text", "b"]], a[["start", "a"]], on="start")
    found = pd.concat([forth, back], ignore_index=True)[["text", "a", "b"]]
    return found.iloc[np.argsort(found["text"].to_numpy(), kind="stable")]


def group_texts(
    a_side: Side, b_side: Side, a: pd.DataFrame, b: pd.DataFrame, count: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of groups of each text; their ids as `a1,a2|b1;a3|b2,b3;`, all texts in a row; bytes of each."""
    last_a, last_b = _shared_ends(a, b)
    at_a, at_b = np.flatnonzero(last_a), np.flatnonzero(last_b)
    # before a token stand those of its side, and the other side's of the groups before it, or as well of its own
    place_a = np.arange(len(a)) + np.concatenate([[0], at_b + 1])[np.cumsum(last_a) - last_a]
    place_b = np.arange(len(b)) + (at_a + 1)[np.cumsum(last_b) - last_b]
    widths = [side.digits.shape[1] for side in (a_side, b_side)]
    cells = np.zeros((len(a) + len(b), max(widths) + 1), np.uint8)
    cells[place_a, : widths[0]], cells[place_b, : widths[1]] = a_side.digits[a["a"]], b_side.digits[b["b"]]
    cells[place_a, -1] = np.where(last_a, ord("|"), ord(","))
    cells[place_b, -1] = np.where(last_b, ord(";"), ord(","))
    filled = cells != 0
    ends = _offsets(filled.sum(axis=1))
    tokens = np.bincount(np.concatenate([a["text"], b["text"]]), minlength=count)
    groups = np.bincount(a["text"].to_numpy()[at_a], minlength=count)
    return groups, cells[filled], np.diff(ends[_offsets(tokens)])


def units(texts: pa.Array, sides: Sides) -> pa.RecordBatch:
    """Each text aligned by itself: see UNITS."""
    a_tokens, b_tokens = sides.encode(texts)
    good = _cut(sides.a, a_tokens, texts) & _cut(sides.b, b_tokens, texts)
    a, b = _side_frame(sides.a, a_tokens, good, "a"), _side_frame(sides.b, b_tokens, good, "b")
    n_groups, groups, sizes = group_texts(sides.a, sides.b, a, b, len(texts))
    links = overlaps(a, b)
    pairs = sides.pair(links["a"].to_numpy(np.int64), links["b"].to_numpy(np.int64))
    n_links = np.bincount(links["text"], minlength=len(texts))
    return pa.RecordBatch.from_arrays([
        pa.array(good),
        *(pa.array(np.where(good, np.diff(t[1]), 0), pa.int32()) for t in (a_tokens, b_tokens)),
        pa.array(n_groups, pa.int32()),
        pa.Array.from_buffers(
            pa.large_binary(), len(texts), [None, pa.py_buffer(_offsets(sizes)), pa.py_buffer(groups)]),
        pa.LargeListArray.from_arrays(pa.array(_offsets(n_links)), pa.array(pairs)),
    ], schema=UNITS)


@dataclass
class Part:
    """Aligned documents: a value per document, and their distinct pairs with repeats, document by document."""

    doc_ids: list[int | None]
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    hashes: list[str]
    sizes: np.ndarray
    pairs: np.ndarray
    repeats: np.ndarray


def align(doc_ids: list[int | None], texts: pa.Array, sides: Sides) -> Part:
    count, odd = len(texts), sides.odd(texts)
    at, words, offsets = sides.split(texts, odd)
    at, known = sides.places(words)[at], sides.known
    if odd.any():
        at[offsets[:-1][odd]] = len(known) + np.arange(odd.sum())
        known = pa.concat_batches([known, units(texts.filter(pa.array(odd)), sides)])
    lost = _offsets(~known["good"].to_numpy(False)[at])[offsets]
    sizes = np.diff(offsets)
    good = np.diff(lost) == 0
    found = known.take(pa.array(at[np.repeat(good, sizes)]))
    offsets = _offsets(np.where(good, sizes, 0))
    n_a, n_b, n_groups = (np.diff(_offsets(found[n].to_numpy(False))[offsets]) for n in ("n_a", "n_b", "n_groups"))
    grouped = memoryview(found["groups"].buffers()[2] or b"")
    ends = _offsets(pc.binary_length(found["groups"]).to_numpy(False))[offsets]
    links = np.diff(_offsets(pc.list_value_length(found["links"]).to_numpy(False))[offsets])
    most = max(1, len(sides.a.sizes) * len(sides.b.sizes))
    own, repeats = np.unique(
        np.repeat(np.arange(count) * most, links) + found["links"].flatten().to_numpy(False), return_counts=True)
    owner, pairs = np.divmod(own, most)
    a, b = np.divmod(pairs, len(sides.b.sizes))
    return Part(
        doc_ids, n_a, n_b, n_groups,
        # without the last `;`
        [hashlib.sha256(grouped[x : y - 1]).hexdigest() if x < y else "" for x, y in zip(ends[:-1], ends[1:])],
        np.bincount(owner, minlength=count), (a << 32) | b, repeats,
    )


def _packed(numbers: np.ndarray) -> bytes:
    numbers = numbers.astype("<i4")
    return len(numbers).to_bytes(8, "little") + pa.Codec("zstd").compress(numbers.tobytes(), asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    count = int.from_bytes(data[:8], "little")
    return np.frombuffer(pa.Codec("zstd").decompress(data[8:], 4 * count, asbytes=True), "<i4").astype(np.int64)


def _chunk_rows(number: int, parts: list[Part], pairs: np.ndarray) -> Iterator[pa.RecordBatch]:
    places = np.concatenate([np.searchsorted(pairs, p.pairs) for p in parts])
    repeats = np.concatenate([p.repeats for p in parts])
    counts = np.zeros(len(pairs), np.int64)
    np.add.at(counts, places, repeats)
    documents = [
        sum((p.doc_ids for p in parts), []),
        *(np.concatenate([getattr(p, name) for p in parts]) for name in ("n_a", "n_b", "n_groups")),
        sum((p.hashes for p in parts), []),
        np.concatenate([p.sizes for p in parts]),
        # a document's places ascend, so their steps are small and pack well
        _packed(np.diff(places, prepend=0)), _packed(repeats),
    ]
    first = [pa.array([v], t) for v, t in zip([number, -1, None, None, *documents], _CHUNK.types)]
    yield pa.RecordBatch.from_arrays(first, schema=_CHUNK)
    rows = [
        pa.array(np.full(len(pairs), number)), pa.array(np.arange(len(pairs)), pa.int32()), pa.array(pairs),
        pa.array(counts), *(pa.nulls(len(pairs), t) for t in _DOCUMENTS.types),
    ]
    yield pa.RecordBatch.from_arrays(rows, schema=_CHUNK)


def chunks(
    docs: DataFrame, a_path: str, b_path: str, chunk_pairs: int = CHUNK_PAIRS, chunk_links: int = CHUNK_LINKS
) -> DataFrame:
    """Documents aligned, in chunks: see CHUNK."""

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = held((a_path, b_path), lambda: Sides(byte_side(a_path), piece_side(b_path)))
        number, parts, pairs, links = TaskContext.get().partitionId() << 32, [], np.zeros(0, np.int64), 0
        for batch in text_parts(batches, most=PART_BYTES, keep=(a_path, b_path)):
            part = align(batch.column("doc_id").to_pylist(), texts_of(batch), sides)
            parts.append(part)
            pairs = np.union1d(pairs, part.pairs)
            links += len(part.pairs)
            if len(pairs) > chunk_pairs or links > chunk_links:
                yield from _chunk_rows(number, parts, pairs)
                number, parts, pairs, links = number + 1, [], np.zeros(0, np.int64), 0
        if parts:
            yield from _chunk_rows(number, parts, pairs)

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return chosen.mapInArrow(aligned, CHUNK)


def pair_counts(found: DataFrame) -> DataFrame:
    """(pair, total, best): links of each pair of ids over all chunks; whether no pair of its B id has more."""
    totals = stage(found.groupBy("pair").agg(F.sum("count").alias("total")), "pair-counts")
    b = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).alias("b")
    most = totals.groupBy(b).agg(F.max("total").alias("most"))
    return totals.withColumn("b", b).join(most, "b").select(
        "pair", "total", (F.col("total") == F.col("most")).alias("best"))


def _document_rows(head: dict, total: np.ndarray, best: np.ndarray) -> pa.RecordBatch:
    places, repeats = np.cumsum(_unpacked(head["places"])), _unpacked(head["repeats"])
    sizes = np.array(head["sizes"], np.int64)
    ends = np.cumsum(sizes)

    def summed(values: np.ndarray) -> pa.Array:
        sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return pa.array(sums[ends] - sums[ends - sizes])

    return pa.RecordBatch.from_arrays(
        [pa.array(head["doc_ids"], pa.int64()), *(pa.array(head[n], pa.int64()) for n in ("n_a", "n_b", "n_groups")),
         summed(repeats), summed(repeats * best[places]), summed(repeats * total[places]),
         pa.array(head["hashes"], pa.string())],
        names=[c.split()[0] for c in RESULT.split(", ")],
    )


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by chunk and place, each chunk's documents first: a row per document."""
    head, totals, bests = None, [], []
    for batch in batches:
        total, best = (batch.column(n).to_numpy(False) for n in ("total", "best"))
        starts = np.flatnonzero(batch.column("place").to_numpy(False) < 0)
        last = 0
        for start in [*starts.tolist(), batch.num_rows]:
            totals.append(total[last:start])
            bests.append(best[last:start])
            if start < batch.num_rows:
                if head is not None:
                    yield _document_rows(head, np.concatenate(totals), np.concatenate(bests))
                head, totals, bests = batch.slice(start, 1).to_pylist()[0], [], []
            last = start + 1
    if head is not None:
        yield _document_rows(head, np.concatenate(totals), np.concatenate(bests))


def aligned(docs: DataFrame, a_path: str, b_path: str, **bounds: int) -> DataFrame:
    """A row per document: tokens, groups, links, and how its links stand in the whole corpus; see RESULT.

    `n_best`: links whose pair of ids no pair of the same B id outnumbers. `count_sum`: the counts of its links'
    pairs, added up. `groups_sha256`: of its groups as text.
    """
    stored = stage(chunks(docs, a_path, b_path, **bounds), "aligned")
    found = stored.where("place >= 0").select("chunk", "place", "pair", "count")
    lists = [c.split()[0] for c in DOCUMENTS.split(", ")]
    answers = found.join(pair_counts(found), "pair").select("chunk", "place", "total", F.col("best").cast("long"))
    heads = stored.where("place < 0").select(
        "chunk", "place", F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("best"), *lists)
    both = heads.unionByName(answers, allowMissingColumns=True)
    return both.repartition("chunk").sortWithinPartitions("chunk", "place").drop("chunk").mapInArrow(_finished, RESULT)
