"""Data-quality profile: counts, distributions, and a verdict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asfalto import schemas as S
from asfalto.plans.silver import REJECTS

OK, WARN, FAIL = "OK", "ALERTA", "ERRO"
_TOTAL = "linhas"


def null_profile(df: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """(campo, nulos) for every field, counted in one pass."""
    fields = fields or S.CRITICAL_FIELDS
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in fields])
    return counted.unpivot([], fields, "campo", "nulos")


def distribution(df: DataFrame, column: str, name: str = "registros") -> DataFrame:
    """Rows per value, most frequent first; equal counts in value order."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), column)


def date_range(df: DataFrame) -> DataFrame:
    return df.agg(F.min("data").alias("data_min"), F.max("data").alias("data_max"))


def unknown_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count_if(F.col("concessionaria") == S.UNKNOWN_OPERATOR).alias("desconhecidas"))


def gate_metrics() -> dict[str, Column]:
    """Aggregates over an audited silver frame; also fit for `write_table(metrics=...)`."""
    nulls = {f"nulos_{c}": F.count_if(F.col(c).isNull()) for c in S.CRITICAL_FIELDS}
    rejects = {
        f"rejeitos_{c.removeprefix('_rej_')}": F.coalesce(F.sum(c), F.lit(0)) for c in REJECTS
    }
    unknown = F.count_if(F.col("concessionaria") == S.UNKNOWN_OPERATOR)
    return {
        _TOTAL: F.count(F.lit(1)),
        **nulls,
        **rejects,
        "desconhecidas": unknown,
        "datas_validas": F.count("data"),
    }


def verdict(metrics: dict[str, int]) -> str:
    """ERRO: nothing to use. ALERTA: some rows need a look. OK: none do."""
    if not metrics[_TOTAL] or not metrics["datas_validas"]:
        return FAIL
    suspect = [v for k, v in metrics.items() if k not in (_TOTAL, "datas_validas")]
    return WARN if any(suspect) else OK


def dq_gate(audited: DataFrame) -> DataFrame:
    """One row per check: (verificacao, valor, veredito). One pass over the audited frame."""
    metrics = gate_metrics()
    row = audited.agg(*[value.alias(name) for name, value in metrics.items()])
    checks = row.unpivot([], list(metrics), "verificacao", "valor")
    volume = F.col("verificacao").isin(_TOTAL, "datas_validas")
    judged = (
        F.when(volume, F.when(F.col("valor") == 0, FAIL).otherwise(OK))
        .when(F.col("valor") > 0, WARN)
        .otherwise(OK)
    )
    return checks.select("verificacao", "valor", judged.alias("veredito"))


def profile(df: DataFrame) -> DataFrame:
    """NULLs per critical field and rows per direction and severity: (grupo, item, registros).

    One scan: all of it follows from the counts per (sentido, severidade), a few rows.
    """
    small = df.groupBy("sentido", "severidade").agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in S.CRITICAL_FIELDS],
    )

    def entry(group: str, item: Column, count: str) -> Column:
        return F.struct(F.lit(group).alias("grupo"), item.alias("item"), F.col(count).alias("registros"))

    entries = [entry("nulos", F.lit(c), f"_null_{c}") for c in S.CRITICAL_FIELDS]
    entries += [entry(c, F.col(c), "_rows") for c in ("sentido", "severidade")]
    return (
        small.select(F.inline(F.array(*entries)))
        .groupBy("grupo", "item")
        .agg(F.sum("registros").alias("registros"))
    )


def column_fill(df: DataFrame) -> DataFrame:
    """(coluna, tipo, preenchidos): the schema with the number of non-NULL values."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    counted = df.agg(*[F.count(c).alias(c) for c in kinds])
    entries = [F.struct(F.lit(c).alias("coluna"), F.lit(k).alias("tipo"), F.col(c).alias("preenchidos"))
               for c, k in kinds.items()]
    return counted.select(F.inline(F.array(*entries)))
