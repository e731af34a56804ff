"""Position of a row on a Z-order curve over several columns."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

CELLS_PER_FILE = 64  # so that ranges of the curve can be cut evenly, and row groups differ within a file
MOST_COMPARED = 64  # bounds of a column that are compared one by one


def bits_for(files: int, columns: int) -> int:
    """Bits per column that give every file of a copy at least CELLS_PER_FILE positions of the curve."""
    wanted = math.ceil(math.log2(max(1, files) * CELLS_PER_FILE) / columns)
    return min(wanted, 62 // columns)


def bucket_of(value: Column, bounds: list) -> Column:
    """How many of the ascending bounds lie at or below the value, found by halving them.

    A few bounds are a tree of comparisons, which Spark compiles; many are one constant array, walked by a lambda,
    which it does not. NULL compares as unknown with every bound and so lands in the first bucket.
    """
    if len(bounds) <= MOST_COMPARED:
        return _compared(value, bounds, 0)
    table = F.array(*[F.lit(b) for b in bounds])
    steps = [1 << n for n in reversed(range(len(bounds).bit_length()))]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda at, step: F.when(value >= F.get(table, at + step - 1), at + step).otherwise(at),
    )


def _compared(value: Column, bounds: list, before: int) -> Column:
    if not bounds:
        return F.lit(before)
    half = len(bounds) // 2
    above = _compared(value, bounds[half + 1 :], before + half + 1)
    return F.when(value >= bounds[half], above).otherwise(_compared(value, bounds[:half], before))


def interleave(buckets: list[Column], bits: int) -> Column:
    """Bit i of bucket j becomes bit i * len(buckets) + j of the result."""
    width = len(buckets)
    placed = [
        F.shiftleft(F.shiftright(bucket, i).bitwiseAND(F.lit(1)).cast("long"), i * width + j)
        for j, bucket in enumerate(buckets)
        for i in range(bits)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), placed)
