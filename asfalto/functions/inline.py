"""Small fixed relations."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def relation(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """Enumerated rows as a local relation.

    Handed over as an Arrow table, the rows are part of the plan and their size is known to
    the planner, which then broadcasts them by itself; a plain list of tuples would become an
    RDD of unknown size, joined by a shuffle.
    """
    if not rows:
        return spark.createDataFrame([], schema)
    columns = dict(zip(schema.names, zip(*rows)))
    return spark.createDataFrame(pa.table({k: list(v) for k, v in columns.items()}), schema)
