"""Accident-shaped raw rows, one per `lineitem` row, every column a string.

The rules only use arithmetic, list lookup and zero padding, so that any SQL engine gives
the same rows; they plant the faults the cleaning rules must survive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from asfalto import schemas as S
from asfalto.session import prepare

FOLDER = "Files/bronze/acidentes/"
FILE_KEYS = [*S.OPERATOR_NAMES, "novanova"]
DIRECTIONS = [
    "NORTE", "N", "PISTA NORTE", "CRESCENTE", "SUL", "S", "PISTA SUL", "DECRESCENTE",
    "  norte  ", "LESTE",
]
OCCURRENCES = [
    "sem vitima", "s/vitima", "ac01", "ac02", "com vitima", "c/vitima", "atropelamento",
    "ac03", "colisao frontal",
]
STATES = ["SP", "MG", "RJ", "PR", "SC", "RS", "BA", "GO", "ES"]
ACCIDENT_TYPES = [
    "Colisao frontal", "Colisao traseira", "Colisao lateral", "Capotamento", "Tombamento",
    "Saida de pista", "Atropelamento", "Engavetamento", "Choque", "Incendio",
    "Queda de moto", "Outros",
]
UNREADABLE = "n/d"  # a count that is no number
VICTIM_CYCLES = [5, 8, 12, 20, 50]

_TEXT = "string"


def _pick(values: list[str], position: Column) -> Column:
    return F.get(F.array([F.lit(v) for v in values]), position.cast("int"))


def _two_digits(number: Column) -> Column:
    return F.lpad(number.cast(_TEXT), 2, "0")


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    part, supplier, line = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    quantity = F.col("l_quantity").cast("int")
    day = F.col("l_shipdate").cast("date")

    def vehicle(i: int) -> Column:
        count = F.greatest(F.lit(0), (part * (i + 1) + line) % 7 - 4)
        return F.when((part + i) % 61 == 0, F.lit(None)).when((part + i) % 109 == 0, UNREADABLE).otherwise(
            count.cast(_TEXT))

    def victim(j: int) -> Column:
        cycle = VICTIM_CYCLES[j]
        count = F.greatest(F.lit(0), (part * (j + 2) + line * 3) % cycle - (cycle - 3))
        return F.when((part + j) % 67 == 0, F.lit(None)).when((part + j) % 127 == 0, UNREADABLE).otherwise(
            count.cast(_TEXT))

    written_day = F.concat_ws(
        "/", _two_digits(F.dayofmonth(day)), _two_digits(F.month(day)), F.year(day).cast(_TEXT)
    )
    stretch = F.concat(
        F.lit(" BR-"), (supplier % 40 + 100).cast(_TEXT), F.lit(" / "), _pick(STATES, supplier % 9),
        F.lit(" "),
    )
    columns = {
        "data": F.when(part % 97 == 0, "99/99/9999").when(part % 89 == 0, F.lit(None)).otherwise(written_day),
        "horario": F.concat(F.when(part % 103 == 0, "--").otherwise(_two_digits(part % 24)), F.lit(":30:00")),
        "km": F.when(part % 53 == 0, F.lit(None))
        .when(part % 59 == 0, "1.234,5")
        .otherwise(F.concat_ws(",", (part % 900).cast(_TEXT), (quantity % 10).cast(_TEXT))),
        "trecho": F.when(part % 83 == 0, "BR-999").otherwise(stretch),
        "sentido": _pick(DIRECTIONS, quantity % 10),
        "tipo_de_ocorrencia": _pick(OCCURRENCES, part % 9),
        "tipo_de_acidente": F.when(part % 101 == 0, F.lit(None)).otherwise(
            _pick(ACCIDENT_TYPES, (part + supplier) % 12)
        ),
        **{name: vehicle(i) for i, name in enumerate(S.VEHICLES)},
        **{name: victim(j) for j, name in enumerate(S.VICTIMS)},
        S.FILE_COLUMN: F.concat(
            F.lit(FOLDER + "demostrativo_acidentes_"), _pick(FILE_KEYS, supplier % 36), F.lit(".csv")
        ),
    }
    return lines.select(*[rule.alias(name) for name, rule in columns.items()])
