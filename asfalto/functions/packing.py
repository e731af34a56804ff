"""Integers in fewer bytes, for rows on their way through a shuffle, and back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = 62  # bits of a long in use: it stays positive, and the codes of a range do not overflow


def _joined(parts: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def _bits(word: Column, at: int, width: int) -> Column:
    return F.shiftright(word, at).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def pack_ranges(
    ranges: Mapping[str, tuple[int | None, int | None, str]], label: str
) -> tuple[dict[str, Column], dict[str, Column]]:
    """Columns of known (least, greatest, type) as few longs, by name, and each column again out of these.

    Within its bits a column is its distance from the least value, plus one; 0 is NULL. Columns whose range leaves
    no room in a long are in neither answer.
    """
    packed: dict[str, list[Column]] = {}
    unpacked: dict[str, Column] = {}
    used, word = WORD, ""
    for column, (least, greatest, kind) in ranges.items():
        if least is None:
            unpacked[column] = F.lit(None).cast(kind)
            continue
        width = (greatest - least + 1).bit_length()
        if width > WORD:
            continue
        if used + width > WORD:
            used, word = 0, f"{label}{len(packed)}"
            packed[word] = []
        code = F.coalesce(F.col(column).cast("long") - F.lit(least) + 1, F.lit(0))
        packed[word].append(F.shiftleft(code, used))
        code = _bits(F.col(word), used, width)
        unpacked[column] = F.when(code > 0, code - 1 + F.lit(least)).cast(kind)
        used += width
    return {name: _joined(parts) for name, parts in packed.items()}, unpacked


def pack_small(columns: Sequence[str], width: int) -> tuple[Column, Column]:
    """Integers that are mostly small: one long with `width` bits of each and NULL, or, where one does not fit,
    NULL and an array of all."""
    blank = (1 << width) - 1
    fits = reduce(lambda a, b: a & b, [F.coalesce(F.col(c).between(0, blank - 1), F.lit(True)) for c in columns])
    codes = [F.shiftleft(F.coalesce(F.col(c), F.lit(blank)).cast("long"), n * width) for n, c in enumerate(columns)]
    return F.when(fits, _joined(codes)), F.when(~fits, F.array(*columns))


def unpack_small(word: Column, rest: Column, columns: Sequence[str], width: int) -> dict[str, Column]:
    blank = (1 << width) - 1
    codes = {c: _bits(word, n * width, width).cast("int") for n, c in enumerate(columns)}
    return {
        c: F.when(word.isNull(), F.get(rest, F.lit(n))).when(code != blank, code)
        for n, (c, code) in enumerate(codes.items())
    }
