"""The three facts over silver and the dimensions.

None of them shuffles rows: the key lookups join to small stored dimensions and the unpivot
works row by row. Each fact scans silver for its own columns only, which costs less than
keeping the joined rows of all three.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asfalto import schemas as S
from asfalto.functions import calendar, rows
from asfalto.operators.keys import resolve_key
from asfalto.operators.reshape import unpivot_counts

Dims = Mapping[str, DataFrame]

# Foreign keys that every fact carries: dimension -> (natural key, surrogate key).
SHARED_KEYS = {
    "gold_dim_data": (["data"], "id_data"),
    "gold_dim_concessionaria": (["concessionaria"], "id_concessionaria"),
    "gold_dim_rodovia": (["rodovia", "uf"], "id_rodovia"),
}
TYPE_KEY = {"gold_dim_tipo_acidente": (["tipo_de_acidente"], "id_tipo_acidente")}
_IDS = ["id_acidente", "id_data", "ano", "id_concessionaria", "id_rodovia"]


def star_lookup(silver: DataFrame, dims: Dims, keys: dict | None = None) -> DataFrame:
    """Silver with the accident id, the foreign keys and the year taken from the date key."""
    base = silver.drop("ano").withColumn("id_acidente", rows.accident_id())
    for dimension, (on, key) in (keys or {**SHARED_KEYS, **TYPE_KEY}).items():
        base = resolve_key(base, dims[dimension], on, key)
    return base.withColumn("ano", calendar.year_of_key(F.col("id_data")))


def fato_acidente(silver: DataFrame, dims: Dims) -> DataFrame:
    return star_lookup(silver, dims).select(*S.FATO_ACIDENTE.names)


def _long_fact(
    silver: DataFrame, dims: Dims, counts: list[str], dimension: str, label: str, key: str
) -> DataFrame:
    base = star_lookup(silver, dims, SHARED_KEYS).select(*_IDS, *counts)
    long_rows = unpivot_counts(base, _IDS, counts, label)
    return resolve_key(long_rows, dims[dimension], [label], key).select(*_IDS, key, "quantidade")


def fato_veiculo_acidente(silver: DataFrame, dims: Dims) -> DataFrame:
    """One row per accident and vehicle type that took part."""
    return _long_fact(silver, dims, S.VEHICLES, "gold_dim_veiculo", "tipo_veiculo", "id_veiculo")


def fato_vitima_acidente(silver: DataFrame, dims: Dims) -> DataFrame:
    """One row per accident and victim class that occurred."""
    return _long_fact(
        silver, dims, S.VICTIMS, "gold_dim_tipo_vitima", "tipo_vitima", "id_tipo_vitima"
    )
