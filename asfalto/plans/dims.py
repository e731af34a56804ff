"""The six dimensions. Each builder takes the silver frame, except the two enumerated ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asfalto import schemas as S
from asfalto.functions import calendar
from asfalto.functions.inline import relation
from asfalto.operators.keys import surrogate_key


def members(silver: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct natural keys without NULL parts."""
    known = silver.select(*columns)
    for column in columns:
        known = known.filter(F.col(column).isNotNull())
    return known.distinct()


def dim_data(silver: DataFrame) -> DataFrame:
    """One row per accident date; the key is computed, so no numbering is needed."""
    day = F.col("data")
    return members(silver, ["data"]).select(
        calendar.date_key(day).alias("id_data"), day, *calendar.attributes(day)
    )


def dim_concessionaria(silver: DataFrame) -> DataFrame:
    return surrogate_key(
        members(silver, ["concessionaria"]), ["concessionaria"], "id_concessionaria"
    )


def dim_rodovia(silver: DataFrame) -> DataFrame:
    """Numbered by state, then road."""
    numbered = surrogate_key(members(silver, ["uf", "rodovia"]), ["uf", "rodovia"], "id_rodovia")
    return numbered.select(*S.DIM_RODOVIA.names)


def dim_tipo_acidente(silver: DataFrame) -> DataFrame:
    return surrogate_key(
        members(silver, ["tipo_de_acidente"]), ["tipo_de_acidente"], "id_tipo_acidente"
    )


def _enumerated(spark: SparkSession, names: list[str], schema) -> DataFrame:
    return relation(spark, list(enumerate(sorted(names), start=1)), schema)


def dim_veiculo(spark: SparkSession) -> DataFrame:
    return _enumerated(spark, S.VEHICLES, S.DIM_VEICULO)


def dim_tipo_vitima(spark: SparkSession) -> DataFrame:
    return _enumerated(spark, S.VICTIMS, S.DIM_TIPO_VITIMA)
