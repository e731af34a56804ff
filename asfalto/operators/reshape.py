"""Wide count columns to long (type, quantity) rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

QUANTITY = "quantidade"


def positive(rows: DataFrame) -> DataFrame:
    """Long rows with a quantity over zero; an unknown quantity is none."""
    return rows.filter(F.col(QUANTITY) > 0)


def unpivot_counts(df: DataFrame, ids: list[str], counts: list[str], label: str) -> DataFrame:
    """One row per count column whose value is positive.

    Rows without any positive count are dropped before they are multiplied; the second filter
    runs in the same generated code as the expansion.
    """
    some = F.greatest(*[F.coalesce(F.col(c), F.lit(0)) for c in counts]) > 0
    return positive(df.filter(some).unpivot(ids, counts, label, QUANTITY))
