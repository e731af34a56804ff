"""Names, fixed values and one schema per table layer."""

from __future__ import annotations

from pyspark.sql import types as T

# File key -> name of the highway operator.
OPERATOR_NAMES = {
    "aco": "RODOVIA DO AÇO",
    "af": "AUTOPISTA FLUMINENSE",
    "afd": "AUTOPISTA FERNÃO DIAS",
    "als": "AUTOPISTA LITORAL SUL",
    "aps": "AUTOPISTA PLANALTO SUL",
    "arb": "AUTOPISTA REGIS BITTENCOURT",
    "concebra": "CONCEBRA",
    "concer": "CONCER",
    "cro": "CRO",
    "eco050": "ECO050",
    "eco101": "ECO101",
    "ecoponte": "ECOPONTE",
    "ecoriominas": "ECORIOMINAS",
    "ecosul": "ECOSUL",
    "ecoviasaraguaia": "ECOVIAS DO ARAGUAIA",
    "ecoviascapixaba": "ECOVIAS CAPIXABA",
    "ecoviasdocerrado": "ECOVIAS DO CERRADO",
    "elovias": "ELOVIAS",
    "epr_iguacu": "EPR IGUACU",
    "epr_litoral_pioneiro": "EPR LITORAL PIONEIRO",
    "nova_381": "NOVA 381",
    "pantanal": "PANTANAL",
    "prvias": "PRVIAS",
    "riosp": "RIOSP",
    "rota-verde-goias": "ROTA VERDE GOIÁS",
    "trans": "TRANSBRASILIANA",
    "via040": "VIA040",
    "viaaraucaria": "VIA ARAUCARIA",
    "viabahia": "VIABAHIA",
    "viabrasil": "VIABRASIL",
    "viacosteira": "VIACOSTEIRA",
    "viacristais": "VIACRISTAIS",
    "viamineira": "VIA MINEIRA",
    "viasul": "VIASUL",
    "way_262": "WAY 262",
}

# Label of a file whose key is not listed above, and the file-name pattern.
UNKNOWN_OPERATOR = "DESCONHECIDA"
FILE_KEY_PATTERN = r"demostrativo_acidentes_([^/\\.]+)\.csv"
FILE_NAME_PATTERN = r"(demostrativo_acidentes_[^/\\.]+\.csv)"

# Count columns of the raw files.
VEHICLES = [
    "automovel", "bicicleta", "caminhao", "moto", "onibus",
    "outros", "tracao_animal", "transporte_de_cargas_especiais",
    "trator_maquinas", "utilitarios",
]
VICTIMS = [
    "ilesos", "levemente_feridos", "moderadamente_feridos",
    "gravemente_feridos", "mortos",
]
COUNTS = VEHICLES + VICTIMS

# Labels of the normalised categories, and what maps to them.
NORTH_WORDS = ["NORTE", "N", "PISTA NORTE", "CRESCENTE"]
SOUTH_WORDS = ["SUL", "S", "PISTA SUL", "DECRESCENTE"]
UNHURT_PATTERN = r"sem|s.vitima|ac01|ac02"
HURT_PATTERN = r"com|c.vitima|atropel|ac03"
NORTH, SOUTH, UNDEFINED = "Norte", "Sul", "Indefinido"
UNHURT, HURT = "Sem Vítima", "Com Vítima"
FATAL = "Fatal"
SEVERITY_LABELS = {
    "mortos": FATAL,
    "gravemente_feridos": "Grave",
    "moderadamente_feridos": "Moderado",
    "levemente_feridos": "Leve",
}
NO_VICTIMS = "Sem Vítimas"

# Columns whose NULLs are profiled.
CRITICAL_FIELDS = ["data", "km", "concessionaria", "rodovia", "uf", "tipo_de_acidente"]

RAW_TEXT = [
    "data", "horario", "km", "trecho", "sentido", "tipo_de_ocorrencia", "tipo_de_acidente",
]
RAW_COLUMNS = RAW_TEXT + COUNTS
FILE_COLUMN = "_filename"


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_INT, _TEXT = T.IntegerType(), T.StringType()

OPERATOR_LOOKUP = _struct(("_file_key", _TEXT), ("concessionaria", _TEXT))
CATALOGUE = _struct(("filename", _TEXT), ("concessionaria", _TEXT))
RAW = _struct(*[(c, _TEXT) for c in RAW_COLUMNS])

SILVER = _struct(
    ("data", T.DateType()),
    ("hora", _INT),
    ("km", T.DoubleType()),
    ("concessionaria", _TEXT),
    ("tipo_de_acidente", _TEXT),
    ("sentido", _TEXT),
    ("tipo_de_ocorrencia", _TEXT),
    ("rodovia", _TEXT),
    ("uf", _TEXT),
    *[(c, _INT) for c in COUNTS],
    ("total_veiculos", _INT),
    ("total_vitimas", _INT),
    ("severidade", _TEXT),
    ("ano", _INT),
    ("mes", _INT),
)

DIM_DATA = _struct(
    ("id_data", _INT),
    ("data", T.DateType()),
    ("ano", _INT),
    ("mes", _INT),
    ("dia", _INT),
    ("trimestre", _INT),
    ("dia_semana", _INT),
    ("nome_mes", _TEXT),
    ("fim_de_semana", T.BooleanType()),
)
DIM_CONCESSIONARIA = _struct(("id_concessionaria", _INT), ("concessionaria", _TEXT))
DIM_RODOVIA = _struct(("id_rodovia", _INT), ("rodovia", _TEXT), ("uf", _TEXT))
DIM_TIPO_ACIDENTE = _struct(("id_tipo_acidente", _INT), ("tipo_de_acidente", _TEXT))
DIM_VEICULO = _struct(("id_veiculo", _INT), ("tipo_veiculo", _TEXT))
DIM_TIPO_VITIMA = _struct(("id_tipo_vitima", _INT), ("tipo_vitima", _TEXT))

_FACT_KEYS = [
    ("id_acidente", T.LongType()),
    ("id_data", _INT),
    ("ano", _INT),
    ("id_concessionaria", _INT),
    ("id_rodovia", _INT),
]

FATO_ACIDENTE = _struct(
    *_FACT_KEYS,
    ("id_tipo_acidente", _INT),
    ("km", T.DoubleType()),
    ("hora", _INT),
    ("sentido", _TEXT),
    ("tipo_de_ocorrencia", _TEXT),
    ("severidade", _TEXT),
    ("total_veiculos", _INT),
    ("total_vitimas", _INT),
    ("mortos", _INT),
    ("gravemente_feridos", _INT),
    ("moderadamente_feridos", _INT),
    ("levemente_feridos", _INT),
    ("ilesos", _INT),
)
FATO_VEICULO = _struct(*_FACT_KEYS, ("id_veiculo", _INT), ("quantidade", _INT))
FATO_VITIMA = _struct(*_FACT_KEYS, ("id_tipo_vitima", _INT), ("quantidade", _INT))

# Table name -> (schema, partition columns), in build order.
TABLES = {
    "silver_acidentes": (SILVER, ["ano", "concessionaria"]),
    "gold_dim_data": (DIM_DATA, []),
    "gold_dim_concessionaria": (DIM_CONCESSIONARIA, []),
    "gold_dim_rodovia": (DIM_RODOVIA, []),
    "gold_dim_tipo_acidente": (DIM_TIPO_ACIDENTE, []),
    "gold_dim_veiculo": (DIM_VEICULO, []),
    "gold_dim_tipo_vitima": (DIM_TIPO_VITIMA, []),
    "gold_fato_acidente": (FATO_ACIDENTE, ["ano"]),
    "gold_fato_veiculo_acidente": (FATO_VEICULO, ["ano"]),
    "gold_fato_vitima_acidente": (FATO_VITIMA, ["ano"]),
}
