"""Dense surrogate keys and key lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from asfalto.operators.layout import stage

_POSITION, _BLOCK = "_position", "_block"
_BLOCK_SHIFT = 33  # monotonically_increasing_id keeps the partition above its low 33 bits


def surrogate_key(members: DataFrame, order: list[str], name: str) -> DataFrame:
    """Number distinct members 1..n in key order, from range partitions sorted side by side.

    Each row stores its partition and its place in it; a partition starts after the rows of
    the partitions before it. Storing them first matters: a range partitioning that is
    computed again may cut elsewhere.
    """
    # written first, so that sampling the ranges does not derive the members again
    stored = stage(members.select(*order), f"members-{name}")
    placed = stage(
        stored.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(*order, F.monotonically_increasing_id().alias(_POSITION)),
        f"blocks-{name}",
    ).withColumn(_BLOCK, F.shiftright(_POSITION, _BLOCK_SHIFT))
    before = Window.orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition of the write above
    starts = (
        placed.groupBy(_BLOCK)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(_BLOCK, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    in_block = F.col(_POSITION).bitwiseAND(F.lit((1 << _BLOCK_SHIFT) - 1))
    return placed.join(F.broadcast(starts), _BLOCK).select(
        (F.col("_start") + in_block + 1).cast("int").alias(name), *order
    )


def resolve_key(df: DataFrame, dimension: DataFrame, on: list[str], key: str) -> DataFrame:
    """Left join for one surrogate key; NULL or unknown members give a NULL key.

    No hint: dimensions are read from written tables, so the planner knows their size, and
    broadcasts those under spark.sql.autoBroadcastJoinThreshold. Past it the join shuffles,
    and adaptive execution splits a hot member's rows.
    """
    return df.join(dimension.select(*on, key), on, "left")
