"""Calendar attributes of a date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: Column) -> Column:
    """yyyyMMdd as an integer, by arithmetic: no formatting and parsing of text."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def attributes(day: Column) -> list[Column]:
    weekday = F.dayofweek(day)
    return [
        F.year(day).alias("ano"),
        F.month(day).alias("mes"),
        F.dayofmonth(day).alias("dia"),
        F.quarter(day).alias("trimestre"),
        weekday.alias("dia_semana"),
        F.date_format(day, "MMMM").alias("nome_mes"),
        weekday.isin(1, 7).alias("fim_de_semana"),
    ]


def year_of_key(key: Column) -> Column:
    return F.floor(key / 10000).cast("int")
