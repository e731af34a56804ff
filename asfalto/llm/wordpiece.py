"""Token ids by the tokenizers library, each distinct word of a text encoded once.

The vocabulary's normalizer (NFC, white space, lower case) and its pre-tokenizer never join
characters across ASCII white space, so the ids of a text are those of its words in order.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from asfalto.llm.batches import held, split_words

# The vocabulary's own split pattern, for lower-case printable ASCII without white space.
_ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
# The same for words whose other characters are Latin-1, none of which NFC changes or composes with its neighbours.
_LATIN_WORD = re.compile(r"[!-~\u00a1-\u00ff]+")
_LETTERS, _DIGITS = "a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u00ff", "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
_LATIN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_DIGITS}]|[^{_LETTERS}{_DIGITS}]+")
MOST_WORDS = 500_000
MOST_PIECES = 75_000  # of each of two generations


def _byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


_BYTE_LEVEL = dict(enumerate(_byte_characters()))


class WordCodec:
    """Encodes arrays of texts; keeps words met before, up to a bound."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        added = self._tokenizer.get_added_tokens_decoder().values()
        self._special = [t.content for t in added if t.special]
        # kept: a fetched component is a handle of its own
        self._model = self._tokenizer.model
        self._normalizer = self._tokenizer.normalizer
        self._pre = self._tokenizer.pre_tokenizer
        # by text, in printable characters up to Latin-1; older ones go when the newer are as many
        self._pieces: dict[str, tuple[int, ...]] = {}
        self._older: dict[str, tuple[int, ...]] = {}
        self._forget()

    def _forget(self) -> None:
        self._words: dict[str, int] = {}
        self._starts = np.zeros(1 << 16, np.int32)
        self._lengths = np.zeros(1 << 16, np.int32)
        self._uses = np.zeros(1 << 16, np.int32)
        self._ids = np.zeros(1 << 18, np.uint32)
        self._filled = 0

    def _forget_rare(self) -> None:
        """Keep words met in several calls, if that leaves room for as many new ones."""
        uses = self._uses[: len(self._words)]
        keep = np.flatnonzero(uses > 1)
        if len(keep) > MOST_WORDS // 2:
            keep = np.sort(np.argpartition(-uses, MOST_WORDS // 2)[: MOST_WORDS // 2])
        names = list(self._words)
        words = [names[n] for n in keep.tolist()]
        lengths, ids = self._lengths[keep], self._ids
        places = _runs(self._starts[keep], lengths)
        self._forget()
        self._insert(words, lengths.astype(np.int64), ids[places])

    def _tokens(self, piece: str) -> tuple[int, ...]:
        return tuple([t.id for t in self._model.tokenize(piece)])

    def _piece_ids(self, piece: str) -> tuple[int, ...]:
        known = self._older.get(piece)
        if known is None:
            level = piece if piece.isascii() else piece.encode().decode("latin-1").translate(_BYTE_LEVEL)
            known = self._tokens(level)
        if len(self._pieces) >= MOST_PIECES:
            self._older, self._pieces = self._pieces, {}
        self._pieces[piece] = known
        return known

    def _word_ids(self, word: str) -> tuple[int, ...]:
        if word.isascii() and word.isprintable():
            pieces = _ASCII.findall(word)
        elif _LATIN_WORD.fullmatch(word):
            pieces = _LATIN.findall(word.lower())
        else:
            cut = self._pre.pre_tokenize_str(self._normalizer.normalize_str(word))
            return tuple([i for p, _ in cut for i in self._tokens(p)])
        ids: tuple[int, ...] = ()
        for piece in pieces:
            known = self._pieces.get(piece)
            ids += self._piece_ids(piece) if known is None else known
        return ids

    def _add(self, words: list[str]) -> None:
        found = [self._word_ids(w) for w in words]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        self._insert(words, lengths, np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum())))

    def _insert(self, words: list[str], lengths: np.ndarray, ids: np.ndarray) -> None:
        first = len(self._words)
        self._starts = _grown(self._starts, first + len(words))
        self._lengths = _grown(self._lengths, first + len(words))
        self._uses = _grown(self._uses, first + len(words))
        self._ids = _grown(self._ids, self._filled + len(ids))
        self._starts[first : first + len(words)] = self._filled + np.cumsum(lengths) - lengths
        self._lengths[first : first + len(words)] = lengths
        self._ids[self._filled : self._filled + len(ids)] = ids
        self._filled += len(ids)
        self._words.update(zip(words, range(first, first + len(words))))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, offsets): text i has ids[offsets[i]:offsets[i + 1]].

        Texts that hold the string of a special token go to the library whole, which cuts them at it.
        """
        marked = np.zeros(len(texts), bool)
        for string in self._special:
            marked |= pc.match_substring(texts, string).to_numpy(False)
        if not marked.any():
            return self._encode_words(texts)
        ids, offsets = self._encode_words(pc.if_else(pa.array(marked), "", texts))
        parts, last, sizes = [], 0, np.diff(offsets)
        for n in np.flatnonzero(marked).tolist():
            own = self._tokenizer.encode(texts[n].as_py(), add_special_tokens=False).ids
            parts += [ids[offsets[last] : offsets[n]], np.array(own, np.uint32)]
            last, sizes[n] = n, len(own)
        return np.concatenate([*parts, ids[offsets[last] :]]), np.concatenate([[0], np.cumsum(sizes)])

    def _encode_words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        places, dictionary, offsets = split_words(pc.ascii_lower(texts))
        words = dictionary.to_pylist()
        if len(self._words) > MOST_WORDS:
            self._forget_rare()
        found = list(map(self._words.get, words))
        new = [n for n, at in enumerate(found) if at is None]
        if new:
            first = len(self._words)
            self._add([words[n] for n in new])
            for at, n in enumerate(new, first):
                found[n] = at
        at = np.array(found, np.int64)
        self._uses[at] += 1
        at = at[places]
        lengths = self._lengths[at].astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(lengths)])
        if not len(at):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        return self._ids[_runs(self._starts[at], lengths)], ends[offsets]


def _runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of runs that begin at `starts`, one run after the other."""
    ends = np.cumsum(lengths, dtype=np.int64)
    places = np.repeat(starts - (ends - lengths), lengths)
    places += np.arange(len(places))
    return places


def _grown(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    larger = np.zeros(max(size, 2 * len(array)), array.dtype)
    larger[: len(array)] = array
    return larger


def word_codec(path: str) -> WordCodec:
    """One codec per Python worker and vocabulary; `path` is its key in `batches.held`."""
    return held(path, lambda: WordCodec(path))


def ended(ids: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with `end_id` after each text, and the offsets that go with them."""
    return np.insert(ids, offsets[1:], end_id), offsets + np.arange(len(offsets))
