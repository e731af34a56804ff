"""Raw rows to the silver table: one projection over the scan and one 35-row lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from asfalto import schemas as S
from asfalto.functions import rows
from asfalto.functions.inline import relation
from asfalto.functions.packing import pack_small, unpack_small
from asfalto.operators.layout import spread
from asfalto.session import prepare

_KEY = S.OPERATOR_LOOKUP.names[0]
# Columns that silver(audit=True) adds: casts of non-empty text that gave NULL.
REJECTS = ["_rej_data", "_rej_hora", "_rej_km", "_rej_contagens"]
# Columns with one of a few labels that the row rules give.
_LABELS = {
    "sentido": [S.NORTH, S.SOUTH, S.UNDEFINED],
    "tipo_de_ocorrencia": [S.UNHURT, S.HURT, S.UNDEFINED],
}
# Numbers that share a long on their way to the writing tasks, and the bits of each.
_PACKED = {"_contagens": (S.COUNTS, 4), "_demais": (["hora", *_LABELS, *REJECTS], 6)}


def _array(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def operator_names(spark: SparkSession) -> DataFrame:
    return relation(spark, list(S.OPERATOR_NAMES.items()), S.OPERATOR_LOOKUP)


def lookup_default(df: DataFrame, lookup: DataFrame, key: str, value: str, default: str) -> DataFrame:
    """Left join to a lookup relation; rows it does not know get `default`.

    No hint: the planner broadcasts a lookup whose known size is under the session's
    threshold - as the enumerated operator names always are - and shuffles a larger one.
    """
    found = F.coalesce(F.col(value), F.lit(default)).alias(value)
    return df.join(lookup, key, "left").select(
        *[c for c in df.columns], found
    )


def map_operator(raw: DataFrame) -> DataFrame:
    """Name the highway operator of each row after its file; the helper columns are dropped."""
    keyed = raw.withColumn(_KEY, rows.file_key(F.col(S.FILE_COLUMN)))
    named = lookup_default(
        keyed, operator_names(raw.sparkSession), _KEY, "concessionaria", S.UNKNOWN_OPERATOR
    )
    return named.drop(_KEY, S.FILE_COLUMN)


def typed(named: DataFrame, audit: bool = False) -> DataFrame:
    """Rows that already carry `concessionaria`, typed and normalised; what follows from that is left to `enriched`."""
    prepare(named.sparkSession)
    counts = {c: rows.parse_count(F.col(c)) for c in S.COUNTS}
    day, hour, km = (
        rows.parse_date(F.col("data")),
        rows.parse_hour(F.col("horario")),
        rows.parse_km(F.col("km")),
    )
    columns = {
        "data": day,
        "hora": hour,
        "km": km,
        "concessionaria": F.col("concessionaria"),
        "tipo_de_acidente": F.col("tipo_de_acidente"),
        "sentido": rows.direction(F.col("sentido")),
        "tipo_de_ocorrencia": rows.occurrence(F.col("tipo_de_ocorrencia")),
        "rodovia": rows.road(F.col("trecho")),
        "uf": rows.state(F.col("trecho")),
        **counts,
        "ano": F.year(day),
    }
    if audit:
        rejected = [(F.col(c).isNotNull() & counts[c].isNull()).cast("int") for c in S.COUNTS]
        columns |= {
            "_rej_data": (F.col("data").isNotNull() & day.isNull()).cast("int"),
            "_rej_hora": (F.col("horario").isNotNull() & hour.isNull()).cast("int"),
            "_rej_km": (F.col("km").isNotNull() & km.isNull()).cast("int"),
            "_rej_contagens": rows.row_total(rejected),
        }
    return named.select(*[rule.alias(name) for name, rule in columns.items()])


def enriched(base: DataFrame, audit: bool = False) -> DataFrame:
    """Typed rows with totals, severity and month, in the order of the silver table."""
    counts = {c: F.col(c) for c in S.COUNTS}
    added = {
        "total_veiculos": rows.row_total([counts[c] for c in S.VEHICLES]),
        "total_vitimas": rows.row_total([counts[c] for c in S.VICTIMS]),
        "severidade": rows.severity({c: counts[c] for c in S.VICTIMS}),
        "mes": F.month("data"),
    }
    names = [*S.SILVER.names, *(REJECTS if audit else [])]
    return base.select(*[added[c].alias(c) if c in added else c for c in names])


def clean(named: DataFrame, audit: bool = False) -> DataFrame:
    """Type, normalise and enrich rows that already carry `concessionaria`."""
    return enriched(typed(named, audit), audit)


def silver(raw: DataFrame, audit: bool = False) -> DataFrame:
    return clean(map_operator(raw), audit)


def gathered(raw: DataFrame) -> DataFrame:
    """`silver` with its quality columns, rows of an output directory brought together.

    What goes through the shuffle is narrow: nothing that follows from other columns, labels of the rules as numbers,
    and numbers packed, which are mostly small. It is unpacked and enriched in the tasks that write.
    """
    base = typed(map_operator(raw), audit=True)
    numbered = base.withColumns({c: F.array_position(_array(v), F.col(c)).cast("int") for c, v in _LABELS.items()})
    words = {}
    for label, (columns, width) in _PACKED.items():
        words |= zip((label, f"{label}_rest"), pack_small(columns, width))
    small = [c for columns, _ in _PACKED.values() for c in columns]
    sent = spread(numbered.withColumns(words).drop(*small), S.TABLES["silver_acidentes"][1])
    unpacked = {}
    for label, (columns, width) in _PACKED.items():
        unpacked |= unpack_small(F.col(label), F.col(f"{label}_rest"), columns, width)
    back = sent.withColumns(unpacked).drop(*words)
    return enriched(back.withColumns({c: F.get(_array(v), F.col(c) - 1) for c, v in _LABELS.items()}), audit=True)
