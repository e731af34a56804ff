"""Row-level rules, each checked on one frame that holds all of its cases."""

from datetime import date

import pytest

from asfalto import schemas as S
from asfalto.plans.silver import map_operator, silver

FOLDER = "Files/bronze/acidentes/demostrativo_acidentes_"
DEFAULTS = {
    "data": "15/03/2022", "horario": "14:30:00", "km": "123,5", "trecho": "BR-116/SP",
    "sentido": "Norte", "tipo_de_ocorrencia": "Sem Vitima", "tipo_de_acidente": "Choque",
    **{c: "0" for c in S.COUNTS}, "automovel": "2", "caminhao": "1", "ilesos": "2",
    S.FILE_COLUMN: FOLDER + "af.csv",
}
NO_VEHICLES = {c: None for c in S.VEHICLES}
NO_VICTIMS = {c: None for c in S.VICTIMS}



def one(column, expected, **raw):
    return raw, column, expected


CASES = [
    one("data", date(2022, 3, 15), data="15/03/2022"),
    one("ano", 2019, data="07/11/2019"),
    one("mes", 11, data="07/11/2019"),
    one("data", None, data="99/99/9999"),
    one("data", None, data="5/3/2022"),
    one("data", None, data="15/03/2022 "),
    one("data", date(2024, 2, 29), data="29/02/2024"),
    one("data", None, data="29/02/2023"),
    one("data", None, data=None),
    one("hora", 14, horario="14:30:00"),
    one("hora", 0, horario="00:00:00"),
    one("hora", None, horario="meio-dia"),
    one("hora", None, horario=None),
    one("km", 123.5, km="123,5"),
    one("km", 456.0, km="456"),
    one("km", 0.0, km="0,0"),
    one("km", None, km="1.234,5"),
    one("km", None, km="12d"),
    one("km", None, km="NaN"),
    one("km", 7.25, km=" 7.25 "),
    one("mortos", None, mortos="1.5"),
    one("mortos", 3, mortos=" 3 "),
    one("mortos", None, mortos="NA"),
    *[one("sentido", "Norte", sentido=v) for v in ("NORTE", "N", "PISTA NORTE", "CRESCENTE", "  norte  ")],
    *[one("sentido", "Sul", sentido=v) for v in ("SUL", "S", "PISTA SUL", "DECRESCENTE")],
    one("sentido", "Indefinido", sentido="LESTE"),
    one("sentido", "Indefinido", sentido=None),
    *[one("tipo_de_ocorrencia", "Sem Vítima", tipo_de_ocorrencia=v)
      for v in ("sem vitima", "sem vitimas", "s/vitima", "ac01", "ac02", "SEM e COM vitima")],
    *[one("tipo_de_ocorrencia", "Com Vítima", tipo_de_ocorrencia=v)
      for v in ("com vitima", "c/vitima", "atropelamento", "ac03")],
    *[one("tipo_de_ocorrencia", "Indefinido", tipo_de_ocorrencia=v)
      for v in ("colisao frontal", "s/vítima", None)],
    one("rodovia", "BR-116", trecho="BR-116/SP"),
    one("uf", "SP", trecho="BR-116/SP"),
    one("rodovia", "BR-040", trecho="BR-040/MG"),
    one("uf", "MG", trecho="BR-040/MG"),
    one("rodovia", "BR-101", trecho=" BR-101 / RJ "),
    one("uf", "RJ", trecho=" BR-101 / RJ "),
    one("rodovia", "BR-999", trecho="BR-999"),
    one("uf", None, trecho="BR-999"),
    one("uf", None, trecho=None),
    one("severidade", "Fatal", mortos="1"),
    one("severidade", "Grave", gravemente_feridos="1"),
    one("severidade", "Moderado", moderadamente_feridos="1"),
    one("severidade", "Leve", levemente_feridos="1"),
    one("severidade", "Sem Vítimas"),
    one("severidade", "Fatal", mortos="1", gravemente_feridos="2", levemente_feridos="3"),
    one("severidade", "Leve", mortos=None, gravemente_feridos="x", levemente_feridos="1"),
    one("total_veiculos", 6, automovel="3", caminhao="2", moto="1"),
    one("total_vitimas", 8, ilesos="5", levemente_feridos="2", mortos="1"),
    one("total_veiculos", 0, **NO_VEHICLES),
    one("total_vitimas", 0, **NO_VICTIMS),
    one("mortos", None, **NO_VICTIMS),
    one("concessionaria", "AUTOPISTA FLUMINENSE", _filename=FOLDER + "af.csv"),
    one("concessionaria", "EPR LITORAL PIONEIRO", _filename=FOLDER + "epr_litoral_pioneiro.csv"),
    one("concessionaria", "ROTA VERDE GOIÁS", _filename=FOLDER + "rota-verde-goias.csv"),
    one("concessionaria", "ROTA VERDE GOIÁS", _filename="C:\\pasta\\demostrativo_acidentes_rota-verde-goias.csv"),
    one("concessionaria", "DESCONHECIDA", _filename=FOLDER + "novanova.csv"),
    one("concessionaria", "DESCONHECIDA", _filename="outro.csv"),
]


@pytest.fixture(scope="module")
def cleaned(spark):
    names = [*DEFAULTS, "ordem"]
    rows = [(*{**DEFAULTS, **raw}.values(), i) for i, (raw, _, _) in enumerate(CASES)]
    schema = ", ".join(f"`{c}` string" for c in DEFAULTS) + ", ordem int"
    raw = spark.createDataFrame(rows, schema)
    assert raw.columns == names
    # the position is carried in a text column that silver passes through
    tagged = raw.withColumn("tipo_de_acidente", raw["ordem"].cast("string")).drop("ordem")
    return {int(r["tipo_de_acidente"]): r for r in silver(tagged).collect()}


@pytest.mark.parametrize("position", range(len(CASES)), ids=lambda i: f"{CASES[i][1]}-{i}")
def test_rule(cleaned, position):
    _, column, expected = CASES[position]
    assert cleaned[position][column] == expected


def test_silver_schema(spark):
    raw = spark.createDataFrame([tuple(DEFAULTS.values())], ", ".join(f"`{c}` string" for c in DEFAULTS))
    assert [(f.name, f.dataType) for f in silver(raw).schema] == [(f.name, f.dataType) for f in S.SILVER]


def test_every_listed_operator_is_named(spark):
    rows = [(f"{FOLDER}{key}.csv",) for key in S.OPERATOR_NAMES]
    named = map_operator(spark.createDataFrame(rows, f"{S.FILE_COLUMN} string"))
    assert named.columns == ["concessionaria"]
    assert sorted(r[0] for r in named.collect()) == sorted(S.OPERATOR_NAMES.values())


def test_cleaning_does_not_depend_on_ansi(spark):
    raw = spark.createDataFrame(
        [tuple({**DEFAULTS, "data": "99/99/9999", "trecho": "BR-1", "mortos": "x", "km": "a"}.values())],
        ", ".join(f"`{c}` string" for c in DEFAULTS),
    )
    before = spark.conf.get("spark.sql.ansi.enabled")
    seen = []
    try:
        for mode in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", mode)
            seen.append(silver(raw).collect())
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert seen[0] == seen[1]


def test_words_do_not_reach_the_cast_of_counts(spark):
    from pyspark.sql import functions as F

    from asfalto.functions import rows

    cells = ["0", "12", " 7 ", "+3", "-4", "\t5", "\x7f6", "1.5", "", " ", "n/d", "x9", "٣", "2147483648", ":", "/", None]
    frame = spark.createDataFrame([(c,) for c in cells], "c string").repartition(2)
    same = rows.parse_count(F.col("c")).eqNullSafe(F.col("c").try_cast("int"))
    assert frame.where(same).count() == len(cells)
    plan = frame.select(rows.parse_count(F.col("c")))._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN" in plan  # a failed cast is an exception
