"""The report pages: each visual is measures x grouping, under slicers shared by the page."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from asfalto import schemas as S
from asfalto.functions.rows import safe_ratio
from asfalto.plans.star import Filters, ask

Star = Mapping[str, DataFrame]
SHARE = "participacao"
SLICERS = ["ano", "concessionaria", "uf", "severidade"]
KPIS = ["total_acidentes", "total_mortos", "taxa_mortalidade", "acidentes_fatais", "total_vitimas"]

# Visual -> (measures, grouping, grouping whose total is the 100 % of a share, rows kept).
VISUALS: dict[str, tuple[list[str], list[str], list[str] | None, int | None]] = {
    "v_kpis": (KPIS, [], None, None),
    "v_tendencia_anual": (["total_acidentes", "total_mortos"], ["ano"], None, None),
    "v_por_ocorrencia": (["total_acidentes"], ["tipo_de_ocorrencia"], [], None),
    "v_por_severidade": (["total_acidentes"], ["severidade"], None, None),
    "v_por_sentido": (["total_acidentes"], ["sentido"], None, None),
    "v_por_mes": (["total_acidentes"], ["mes"], None, None),
    "v_por_dia_semana": (["total_acidentes"], ["dia_semana"], None, None),
    "v_fim_de_semana": (["total_acidentes"], ["fim_de_semana"], [], None),
    "v_por_hora": (["total_acidentes"], ["hora"], None, None),
    "v_por_uf": (["total_acidentes"], ["uf"], None, None),
    "v_top15_rodovias": (["total_acidentes"], ["rodovia"], None, 15),
    "v_por_concessionaria": (["total_acidentes", "total_mortos"], ["concessionaria"], None, None),
    "v_veiculos": (["total_veiculos"], ["tipo_veiculo"], None, None),
    "v_vitimas": (["vitimas_detalhado"], ["tipo_vitima"], None, None),
    "v_severidade_por_tipo": (
        ["total_acidentes"], ["tipo_de_acidente", "severidade"], ["tipo_de_acidente"], None,
    ),
}


def share(answer: DataFrame, measure: str, within: Sequence[str]) -> DataFrame:
    """Part of each row in the total of its `within` group; the rows are already aggregated."""
    total = F.sum(measure).over(Window.partitionBy(*within))
    return answer.withColumn(SHARE, safe_ratio(F.col(measure), total))


def top(answer: DataFrame, measure: str, rows: int, tie: str) -> DataFrame:
    return answer.orderBy(F.desc(measure), F.asc(tie)).limit(rows)


def visual(star: Star, name: str, slicers: Filters | None = None) -> DataFrame:
    measures, by, within, rows = VISUALS[name]
    answer = ask(star, measures, by, slicers)
    if within is not None:
        answer = share(answer, measures[0], within)
    return top(answer, measures[0], rows, by[0]) if rows else answer


def severity_columns(star: Star, slicers: Filters | None = None) -> DataFrame:
    """`v_severidade_por_tipo` with one share column per severity."""
    levels = [*S.SEVERITY_LABELS.values(), S.NO_VICTIMS]
    shares = visual(star, "v_severidade_por_tipo", slicers)
    return shares.groupBy("tipo_de_acidente").pivot("severidade", levels).agg(F.first(SHARE))


def counts_report(star: Star, fact: str, dimension: str, key: str, label: str) -> DataFrame:
    """Total quantity per type, largest first; rows without a type are left out."""
    sums = star[fact].groupBy(key).agg(F.sum("quantidade").alias("total"))
    named = sums.join(star[dimension], key).groupBy(label).agg(F.sum("total").alias("total"))
    return named.orderBy(F.desc("total"), label)
