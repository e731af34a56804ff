"""The registered queries: name -> callable(spark, sf_dir) giving a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asfalto import schemas as S
from asfalto.functions import calendar, rows
from asfalto.operators import keys, layout, quality, reshape
from asfalto.plans import catalogue, dashboard, dims, facts, medallion, pages, star
from asfalto.plans import silver as cleaning
from asfalto.registry.lakes import dims_lake, gold_lake, silver_lake
from asfalto.session import new_folder
from asfalto.sources import csv_files, landing
from asfalto.sources.accidents import raw_rows
from asfalto.streaming.landing_stream import QUARANTINE, landed, take_new_files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
_SILVER = "silver_acidentes"
_FACT = "gold_fato_acidente"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.silver(raw_rows(spark, sf_dir))


def _without_id(fact: DataFrame) -> DataFrame:
    """The hash differs between engines; all other columns can be compared."""
    return fact.drop("id_acidente")


# --- sources ---------------------------------------------------------------------------


def _landed_csv(spark: SparkSession, sf_dir: str) -> str:
    folder = new_folder(spark, "csv")
    csv_files.write_folder(raw_rows(spark, sf_dir), folder)
    return folder


def _named_by_file(raw: DataFrame) -> DataFrame:
    return raw.withColumn("arquivo", rows.file_name(F.col(S.FILE_COLUMN))).drop(S.FILE_COLUMN)


@query
def bronze_scan(spark, sf_dir):
    scanned = csv_files.scan(spark, _landed_csv(spark, sf_dir) + "/*")
    return _named_by_file(csv_files.fitting(scanned))


@query
def file_provenance(spark, sf_dir):
    scanned = csv_files.read_folder(spark, _landed_csv(spark, sf_dir))
    return _named_by_file(scanned).groupBy("arquivo").agg(F.count("*").alias("linhas"))


@query
def bronze_union(spark, sf_dir):
    """Files of two groups of operators: opposite column orders, and headers in another case."""
    folder, raw = new_folder(spark, "csv-two-orders"), raw_rows(spark, sf_dir)
    early = F.col(S.FILE_COLUMN) < "Files/bronze/acidentes/demostrativo_acidentes_n"
    csv_files.write_folder(raw.filter(early), folder)
    turned = [c.capitalize() for c in S.RAW_COLUMNS[::-1]]
    renamed = raw.filter(~early).withColumnsRenamed({c.lower(): c for c in turned})
    csv_files.write_folder(renamed, folder, columns=turned)
    return _named_by_file(csv_files.fitting(csv_files.read_folder(spark, folder)))


def _faulty_csv(spark: SparkSession, sf_dir: str) -> str:
    """Files by operator where rows of hour 05 have a field too many and rows of hour 07 are cut short."""
    folder, raw = new_folder(spark, "csv-faulty"), raw_rows(spark, sf_dir)
    fields = [F.coalesce(F.col(c), F.lit("")) for c in S.RAW_COLUMNS]
    whole, short = F.concat_ws(";", *fields), F.concat_ws(";", *fields[:-3])
    hour = F.col("horario")
    line = (
        F.when(hour.startswith("05"), F.concat(whole, F.lit(";x")))
        .when(hour.startswith("07"), short)
        .otherwise(whole)
    )
    csv_files.write_lines(raw.select(line.alias("value"), S.FILE_COLUMN), folder)
    return folder


@query
def quarantine(spark, sf_dir):
    """What `build_silver` takes and what it sets apart, of files with long and short records."""
    lake = medallion.Lake(spark, new_folder(spark, "lake-faulty"))
    medallion.build_silver(lake, csv_files.read_folder(spark, _faulty_csv(spark, sf_dir)))
    taken = lake[_SILVER].agg(
        F.lit("aceita").alias("classe"), F.count("*").alias("linhas"),
        F.count("ilesos").alias("com_ilesos"), F.count("mortos").alias("com_mortos"),
    )
    records = spark.read.parquet(lake.path(medallion.QUARANTINE))
    apart = csv_files.parsed(records).agg(
        F.lit("excedente").alias("classe"), F.count(csv_files.RECORD).alias("linhas"),
        F.count("ilesos").alias("com_ilesos"), F.count("mortos").alias("com_mortos"),
    )
    return taken.unionByName(apart)


@query
def quarantine_replay(spark, sf_dir):
    """Silver of faulty files after all records set apart were mended and read again."""
    lake = medallion.Lake(spark, new_folder(spark, "lake-faulty"))
    medallion.build_silver(lake, csv_files.read_folder(spark, _faulty_csv(spark, sf_dir)))
    record = F.col(csv_files.RECORD)
    mended = spark.read.parquet(lake.path(medallion.QUARANTINE)).withColumns(
        {"_original": record, csv_files.RECORD: F.regexp_replace(record, ";x$", "")})
    medallion.replay(lake, mended)
    left = spark.read.parquet(lake.path(medallion.QUARANTINE)).count()
    return lake[_SILVER].withColumn("em_quarentena", F.lit(left).cast("long"))


@query
def replace_operators(spark, sf_dir):
    """Silver after the files of some operators, first landed with other dates and rows, were landed again."""
    lake, raw = medallion.Lake(spark, new_folder(spark, "lake-replaced")), raw_rows(spark, sf_dir)
    again = F.col(S.FILE_COLUMN) < "Files/bronze/acidentes/demostrativo_acidentes_e"
    early = raw.filter(again).withColumn("data", F.regexp_replace("data", r"/19(\d\d)$", "/18$1"))
    medallion.build_silver(lake, raw.filter(~again).unionByName(early.unionByName(early.limit(100))))
    medallion.replace_operators(lake, raw.filter(again))
    return lake[_SILVER]


@query
def table_scan(spark, sf_dir):
    return silver_lake(spark, sf_dir)[_SILVER]


def _named_lake(spark: SparkSession, sf_dir: str) -> catalogue.NamedLake:
    """The gold lake's files under names of the catalogue."""
    lake = gold_lake(spark, sf_dir)
    named = catalogue.NamedLake(spark, lake.root, f"asfalto_{abs(hash(lake.root))}")
    named.register_all()
    return named


@query
def tables_by_name(spark, sf_dir):
    return catalogue.fatal_by_road(_named_lake(spark, sf_dir))


@query
def catalogue_listing(spark, sf_dir):
    """Columns and rows of every table, as the catalogue's statistics tell them."""
    return _named_lake(spark, sf_dir).listing()


@query
def static_relation(spark, sf_dir):
    """The operator lookup with the raw rows that each entry names."""
    lookup = cleaning.operator_names(spark)
    seen = raw_rows(spark, sf_dir).groupBy(
        rows.file_key(F.col(S.FILE_COLUMN)).alias("_file_key")
    ).agg(F.count("*").alias("linhas"))
    return lookup.join(seen, "_file_key", "left").select(
        F.col("_file_key").alias("chave"),
        "concessionaria",
        F.coalesce("linhas", F.lit(0)).alias("linhas"),
    )


def _part_faulty_csv(spark: SparkSession, sf_dir: str) -> str:
    """Files of all operators, those from r on without their last column."""
    folder, raw = new_folder(spark, "csv-manifest"), raw_rows(spark, sf_dir)
    late = F.col(S.FILE_COLUMN) >= "Files/bronze/acidentes/demostrativo_acidentes_r"
    csv_files.write_folder(raw.filter(~late), folder)
    csv_files.write_folder(raw.filter(late), folder, columns=S.RAW_COLUMNS[:-1])
    return folder


@query
def landing_manifest(spark, sf_dir):
    folder = _part_faulty_csv(spark, sf_dir)
    found, faulty = landing.landed(spark, folder), landing.unreadable(spark, folder)
    return landing.manifest(landing.catalogue(spark), found, faulty)


@query
def landing_report(spark, sf_dir):
    """Counts by status of the landed files; their sizes depend on the CSV writer and are left out."""
    folder = _part_faulty_csv(spark, sf_dir)
    found, faulty = landing.landed(spark, folder), landing.unreadable(spark, folder)
    return landing.report(landing.catalogue(spark), found, faulty).drop("total_mb")


@query
def landing_manifest_stream(spark, sf_dir):
    """Two runs of the stream form, the second after more files came, in another column order and with long rows."""
    folder, target = new_folder(spark, "csv-stream"), new_folder(spark, "stream-table")
    checkpoint, raw = new_folder(spark, "stream-checkpoint"), raw_rows(spark, sf_dir)
    early = F.col(S.FILE_COLUMN) < "Files/bronze/acidentes/demostrativo_acidentes_n"
    csv_files.write_folder(raw.filter(early), folder)
    take_new_files(spark, folder, target, checkpoint)
    turned = [*S.RAW_COLUMNS[:0:-1], S.RAW_COLUMNS[0]]
    fields = [F.coalesce(F.col(c), F.lit("")) for c in turned]
    long_row = F.when(F.col("horario").startswith("05"), F.lit(";x")).otherwise(F.lit(""))
    lines = raw.filter(~early).select(F.concat(F.concat_ws(";", *fields), long_row).alias("value"), S.FILE_COLUMN)
    csv_files.write_lines(lines, folder, turned)
    for _ in range(2):
        take_new_files(spark, folder, target, checkpoint)
    counts = [F.count("*").alias("linhas"), F.count("data").alias("com_data"), F.count("mortos").alias("com_mortos")]
    taken = _named_by_file(landed(spark, target)).groupBy("arquivo").agg(F.lit("aceita").alias("classe"), *counts)
    apart = _named_by_file(csv_files.parsed(landed(spark, target, QUARANTINE))).groupBy("arquivo").agg(
        F.lit("excedente").alias("classe"), *counts)
    return taken.unionByName(apart)


# --- sinks and layout ------------------------------------------------------------------


def _written(spark, df: DataFrame, table: str, **options) -> tuple[DataFrame, layout.Written]:
    schema, partitions = S.TABLES[table]
    path = new_folder(spark, table)
    options = {"gather": table not in medallion.FACTS, **options}
    done = layout.write_table(df, path, partitions=partitions, **options)
    return layout.read_table(spark, path, schema), done


@query
def write_silver(spark, sf_dir):
    return _written(spark, _silver(spark, sf_dir), _SILVER)[0]


@query
def write_dim(spark, sf_dir):
    lake = silver_lake(spark, sf_dir)
    return _written(spark, dims.dim_rodovia(lake[_SILVER]), "gold_dim_rodovia")[0]


@query
def write_fact(spark, sf_dir):
    lake = dims_lake(spark, sf_dir)
    return _without_id(_written(spark, facts.fato_acidente(lake[_SILVER], lake), _FACT)[0])


@query
def append_mode(spark, sf_dir):
    """Silver written in two appends, mornings and the rest."""
    rows_, path = _silver(spark, sf_dir), new_folder(spark, "append")
    morning = F.coalesce(F.col("hora") < 12, F.lit(False))
    for half in (rows_.filter(morning), rows_.filter(~morning)):
        layout.write_table(half, path, mode="append", partitions=["ano", "concessionaria"])
    return layout.read_table(spark, path, S.SILVER)


@query
def overwrite_schema(spark, sf_dir):
    """An overwrite by rows of another shape leaves only the new shape."""
    rows_, path = _silver(spark, sf_dir), new_folder(spark, "reshaped")
    layout.write_table(rows_.select("data", "hora", "uf"), path)
    layout.write_table(rows_.select("rodovia", "uf", "km", "severidade"), path)
    return layout.read_table(spark, path)


@query
def write_verify(spark, sf_dir):
    """Rows that went into each fact table against rows read back."""
    lake = dims_lake(spark, sf_dir)
    done = {
        table: _written(spark, build(lake[_SILVER], lake), table)[1]
        for table, build in medallion.FACTS.items()
    }
    return spark.createDataFrame(
        [(t, w.written, w.read_back, w.complete) for t, w in done.items()],
        "tabela string, escritas long, lidas long, confere boolean",
    )


SMALL_FILES = 8 << 20  # bytes that go to a task which leaves small files


def _crowding(spark: SparkSession, table: str, least: int) -> int:
    """Tasks among which a stored table is dealt to leave many small files: more of them for a larger table."""
    return max(least, layout.file_stats(spark, table)[1] // SMALL_FILES)


@query
def compact(spark, sf_dir):
    """A fact left in many small files by appends, rewritten in few."""
    lake = gold_lake(spark, sf_dir, _FACT)
    small, target = new_folder(spark, "small-files"), new_folder(spark, "compacted")
    # by columns: dealing rows in turn would sort them first, all rows of a task
    many = lake[_FACT].repartition(_crowding(spark, lake.path(_FACT), 32), "id_acidente", "km")
    many.write.partitionBy("ano").parquet(small)
    layout.compact(spark, small, target, partitions=["ano"], schema=S.FATO_ACIDENTE)
    return _without_id(layout.read_table(spark, target, S.FATO_ACIDENTE))


@query
def compact_partitions(spark, sf_dir):
    """A fact of which some years lie in many small files, merged year by year."""
    lake, path = gold_lake(spark, sf_dir, _FACT), new_folder(spark, "crowded")
    tasks = _crowding(spark, lake.path(_FACT), 9)
    for many in (False, True):
        some = lake[_FACT].filter(F.coalesce(F.col("ano") % 2 == int(many), F.lit(not many)))
        parts = some.repartition(tasks, "km", "id_acidente") if many else layout.spread(some, ["ano"])
        parts.write.mode("append").partitionBy("ano").parquet(path)
    layout.compact_partitions(spark, path, ["ano"], schema=S.FATO_ACIDENTE)
    return _without_id(layout.read_table(spark, path, S.FATO_ACIDENTE))


@query
def clustered_slicers(spark, sf_dir):
    """Measures under year, operator and road slicers, from the files of clustered copies that may hold their rows."""
    lake, root = gold_lake(spark, sf_dir), new_folder(spark, "clustered")
    medallion.optimize(lake, root, target_bytes=1 << 17)
    return star.ask(medallion.ClusteredLake(lake, root), SLICED_MEASURES, ["ano"], CLUSTERED_SLICE)


@query
def zorder(spark, sf_dir):
    lake, target = gold_lake(spark, sf_dir, _FACT), new_folder(spark, "zorder")
    layout.zorder(
        spark, lake.path(_FACT), target, medallion.CLUSTERING[_FACT], ["ano"], ["id_acidente"],
        schema=S.FATO_ACIDENTE,
    )
    return _without_id(layout.read_table(spark, target, S.FATO_ACIDENTE))


@query
def repoint_view(spark, sf_dir):
    """SQL over a view that reads the stored silver, not the raw rows."""
    silver_lake(spark, sf_dir)[_SILVER].createOrReplaceTempView("silver_guardada")
    return spark.sql(
        "SELECT concessionaria, ano, count(*) AS linhas, sum(mortos) AS mortos "
        "FROM silver_guardada GROUP BY concessionaria, ano"
    )


@query
def cache_reuse(spark, sf_dir):
    """Two aggregates over one cached frame; released as soon as both are known."""
    cached = _silver(spark, sf_dir).select("data", "concessionaria").persist()
    try:
        span = quality.date_range(cached).first()
        unknown = quality.unknown_count(cached).first()
        return spark.createDataFrame(
            [(*span, *unknown)], "data_min date, data_max date, desconhecidas long"
        )
    finally:
        cached.unpersist()


# --- row-level rules -------------------------------------------------------------------


def _counted(raw: DataFrame, inputs: list[str], **outputs) -> DataFrame:
    """Distinct inputs with what the rules make of them, and how often each occurs."""
    derived = raw.select(
        *[F.col(c).alias(f"{c}_bruto") for c in inputs], *[v.alias(k) for k, v in outputs.items()]
    )
    return derived.groupBy(*derived.columns).agg(F.count("*").alias("linhas"))


@query
def parse_date(spark, sf_dir):
    return _counted(raw_rows(spark, sf_dir), ["data"], data=rows.parse_date(F.col("data")))


@query
def parse_hour(spark, sf_dir):
    return _counted(raw_rows(spark, sf_dir), ["horario"], hora=rows.parse_hour(F.col("horario")))


@query
def parse_km(spark, sf_dir):
    return _counted(raw_rows(spark, sf_dir), ["km"], km=rows.parse_km(F.col("km")))


@query
def cast_counts(spark, sf_dir):
    raw = raw_rows(spark, sf_dir)
    parsed = raw.select(*[rows.parse_count(F.col(c)).alias(c) for c in S.COUNTS])
    return parsed.groupBy(*S.COUNTS).agg(F.count("*").alias("linhas"))


@query
def norm_sentido(spark, sf_dir):
    return _counted(raw_rows(spark, sf_dir), ["sentido"], sentido=rows.direction(F.col("sentido")))


@query
def norm_ocorrencia(spark, sf_dir):
    name = "tipo_de_ocorrencia"
    return _counted(raw_rows(spark, sf_dir), [name], **{name: rows.occurrence(F.col(name))})


@query
def split_trecho(spark, sf_dir):
    stretch = F.col("trecho")
    return _counted(
        raw_rows(spark, sf_dir), ["trecho"], rodovia=rows.road(stretch), uf=rows.state(stretch)
    )


@query
def row_totals(spark, sf_dir):
    return _silver(spark, sf_dir).groupBy("total_veiculos", "total_vitimas").agg(
        F.count("*").alias("linhas")
    )


@query
def severity(spark, sf_dir):
    harmed = S.VICTIMS[1:]
    return _silver(spark, sf_dir).groupBy(*harmed, "severidade").agg(F.count("*").alias("linhas"))


@query
def year_month(spark, sf_dir):
    return _silver(spark, sf_dir).groupBy("data", "ano", "mes").agg(F.count("*").alias("linhas"))


@query
def file_key(spark, sf_dir):
    return _counted(
        raw_rows(spark, sf_dir), [S.FILE_COLUMN], chave=rows.file_key(F.col(S.FILE_COLUMN))
    )


@query
def map_concession(spark, sf_dir):
    named = cleaning.map_operator(
        raw_rows(spark, sf_dir).withColumn("chave", rows.file_key(F.col(S.FILE_COLUMN)))
    )
    return named.groupBy("chave", "concessionaria").agg(F.count("*").alias("linhas"))


@query
def drop_internal(spark, sf_dir):
    return cleaning.map_operator(raw_rows(spark, sf_dir))


@query
def prune_columns(spark, sf_dir):
    return _without_id(gold_lake(spark, sf_dir, _FACT)[_FACT]).select(
        "id_data", "ano", "id_rodovia", "km", "severidade", "mortos"
    )


@query
def filter_not_null(spark, sf_dir):
    return _silver(spark, sf_dir).filter(
        F.col("rodovia").isNotNull() & F.col("uf").isNotNull()
    ).groupBy("rodovia", "uf").agg(F.count("*").alias("linhas"))


@query
def filter_positive(spark, sf_dir):
    """Counts by value once zeros and unknown counts, most of all cells, are filtered out."""
    cells = _silver(spark, sf_dir).select(*S.VEHICLES).unpivot([], S.VEHICLES, "tipo_veiculo", "quantidade")
    return reshape.positive(cells).groupBy("quantidade").agg(F.count("*").alias("linhas"))


MEETING_ROWS = 250_000  # accidents that a task compares by their ids


@query
def accident_id(spark, sf_dir):
    """What must hold of the id: equal tuples share it, and the long facts know no other."""
    parts = ["data", "concessionaria", "km", "hora", "tipo_de_acidente"]
    lake = gold_lake(spark, sf_dir)
    # all sides meet by id, in parts of a bounded number of rows: nothing is combined before, where no two rows agree
    meet = [max(1, -(-lake[_SILVER].count() // MEETING_ROWS)), "id_acidente"]
    tuples = lake[_SILVER].select(*parts, rows.accident_id().alias("id_acidente")).repartition(*meet).groupBy(
        "id_acidente", *parts
    ).agg(F.count("*").alias("linhas"))
    per_id = tuples.groupBy("id_acidente").agg(
        F.count("*").alias("tuplas"), F.sum("linhas").alias("linhas")
    )
    from_fact = lake[_FACT].select("id_acidente").repartition(*meet).groupBy("id_acidente").agg(
        F.count("*").alias("no_fato"))
    children = reshape_union(lake).repartition(*meet).distinct().withColumn("filho", F.lit(1))
    joined = per_id.join(from_fact, "id_acidente", "full_outer").join(
        children, "id_acidente", "full_outer"
    )
    return joined.agg(
        F.sum("linhas").alias("linhas"),
        F.sum("tuplas").alias("tuplas"),
        F.count("tuplas").alias("ids"),
        F.count_if(~F.col("linhas").eqNullSafe(F.col("no_fato"))).alias("ids_divergentes"),
        F.count_if(F.col("filho").isNotNull() & F.col("tuplas").isNull()).alias("filhos_orfaos"),
    )


def reshape_union(lake) -> DataFrame:
    longs = ("gold_fato_veiculo_acidente", "gold_fato_vitima_acidente")
    first, second = (lake[t].select("id_acidente") for t in longs)
    return first.unionByName(second)


@query
def silver(spark, sf_dir):
    return _silver(spark, sf_dir)


# --- scalar functions ------------------------------------------------------------------


@query
def scalar_text(spark, sf_dir):
    stretch, name = F.col("trecho"), F.col(S.FILE_COLUMN)
    derived = raw_rows(spark, sf_dir).select(
        F.upper(F.trim("sentido")).alias("maiusculas"),
        F.lower("tipo_de_ocorrencia").alias("minusculas"),
        F.split_part(stretch, F.lit("/"), F.lit(1)).alias("parte"),
        F.replace("km", F.lit(","), F.lit(".")).alias("trocado"),
        F.regexp_extract(name, "_([a-z]+)[^/]*$", 1).alias("extraido"),
        F.concat_ws("|", F.coalesce("data", F.lit("")), "horario").alias("unido"),
    )
    return derived.groupBy(*derived.columns).agg(F.count("*").alias("linhas"))


@query
def scalar_date(spark, sf_dir):
    day = F.col("data")
    return _silver(spark, sf_dir).filter(day.isNotNull()).groupBy("data").agg(
        F.count("*").alias("linhas")
    ).select(
        "data",
        calendar.date_key(day).alias("chave"),
        F.date_format(day, "yyyyMMdd").alias("texto"),
        *calendar.attributes(day),
        "linhas",
    )


@query
def scalar_ratio(spark, sf_dir):
    """Conditional, arithmetic and safe division; a group without deaths divides by zero."""
    sums = _silver(spark, sf_dir).groupBy("data", "sentido").agg(
        F.sum(F.coalesce("total_veiculos", F.lit(0))).alias("veiculos"),
        F.sum(F.coalesce("mortos", F.lit(0))).alias("mortos"),
    )
    return sums.select(
        "data", "sentido",
        rows.safe_ratio(F.col("veiculos"), F.col("mortos")).alias("veiculos_por_morto"),
        F.when(F.col("mortos") > 0, "com mortos").otherwise("sem mortos").alias("classe"),
    )


# --- dimensions ------------------------------------------------------------------------


@query
def dim_data(spark, sf_dir):
    return dims.dim_data(silver_lake(spark, sf_dir)[_SILVER])


@query
def dim_concessionaria(spark, sf_dir):
    return dims.dim_concessionaria(silver_lake(spark, sf_dir)[_SILVER])


@query
def dim_rodovia(spark, sf_dir):
    return dims.dim_rodovia(silver_lake(spark, sf_dir)[_SILVER])


@query
def dim_tipo_acidente(spark, sf_dir):
    return dims.dim_tipo_acidente(silver_lake(spark, sf_dir)[_SILVER])


def _used(spark, sf_dir, fact: str, dimension: DataFrame, key: str) -> DataFrame:
    """An enumerated dimension, with the fact rows that refer to each member."""
    refs = gold_lake(spark, sf_dir)[fact].groupBy(key).agg(F.count("*").alias("linhas"))
    return dimension.join(refs, key, "left").withColumn("linhas", F.coalesce("linhas", F.lit(0)))


@query
def dim_veiculo(spark, sf_dir):
    return _used(spark, sf_dir, star.VEHICLES, dims.dim_veiculo(spark), "id_veiculo")


@query
def dim_tipo_vitima(spark, sf_dir):
    return _used(spark, sf_dir, star.VICTIMS, dims.dim_tipo_vitima(spark), "id_tipo_vitima")


@query
def surrogate_key(spark, sf_dir):
    """Two sort keys, numbered by range partitions rather than in one sorted task."""
    stretches = dims.members(silver_lake(spark, sf_dir)[_SILVER], ["data", "rodovia"])
    return keys.surrogate_key(stretches, ["rodovia", "data"], "id_trecho_dia")


# --- joins -----------------------------------------------------------------------------


def _one_key(spark, sf_dir, dimension: str) -> DataFrame:
    lake = dims_lake(spark, sf_dir)
    on, key = {**facts.SHARED_KEYS, **facts.TYPE_KEY}[dimension]
    resolved = keys.resolve_key(lake[_SILVER].select(*on), lake[dimension], on, key)
    return resolved.groupBy(*on, key).agg(F.count("*").alias("linhas"))


@query
def fk_data(spark, sf_dir):
    return _one_key(spark, sf_dir, "gold_dim_data")


@query
def fk_concessionaria(spark, sf_dir):
    return _one_key(spark, sf_dir, "gold_dim_concessionaria")


@query
def fk_rodovia(spark, sf_dir):
    return _one_key(spark, sf_dir, "gold_dim_rodovia")


@query
def fk_tipo_acidente(spark, sf_dir):
    return _one_key(spark, sf_dir, "gold_dim_tipo_acidente")


@query
def fk_unpivoted(spark, sf_dir):
    lake = dims_lake(spark, sf_dir)
    wide = lake[_SILVER].select("concessionaria", *S.VICTIMS)
    long_rows = reshape.unpivot_counts(wide, ["concessionaria"], S.VICTIMS, "tipo_vitima")
    keyed = keys.resolve_key(long_rows, lake["gold_dim_tipo_vitima"], ["tipo_vitima"], "id_tipo_vitima")
    return keyed.groupBy("concessionaria", "id_tipo_vitima").agg(
        F.sum("quantidade").alias("quantidade")
    )


@query
def star_lookup(spark, sf_dir):
    lake = dims_lake(spark, sf_dir)
    return facts.star_lookup(lake[_SILVER], lake).drop("id_acidente", "mes")


@query
def lookup_default(spark, sf_dir):
    raw = raw_rows(spark, sf_dir).select(
        rows.file_key(F.col(S.FILE_COLUMN)).alias("_file_key"), "horario"
    )
    named = cleaning.lookup_default(
        raw, cleaning.operator_names(spark), "_file_key", "concessionaria", S.UNKNOWN_OPERATOR
    )
    return named.groupBy("concessionaria", "horario").agg(F.count("*").alias("linhas"))


@query
def fact_dim_inner(spark, sf_dir):
    lake = gold_lake(spark, sf_dir)
    return lake[star.VEHICLES].join(lake["gold_dim_veiculo"], "id_veiculo").groupBy(
        "tipo_veiculo", "id_concessionaria"
    ).agg(F.sum("quantidade").alias("total"))


@query
def relationship_filter(spark, sf_dir):
    """A state filter on the road dimension reaches each of the three facts."""
    lake = gold_lake(spark, sf_dir)
    counted = [
        star.restrict(lake, fact, {"uf": ["SP", "MG"]})
        .groupBy("ano").agg(F.count("*").alias("linhas"))
        .select(F.lit(fact).alias("fato"), "ano", "linhas")
        for fact in (star.ACCIDENTS, star.VEHICLES, star.VICTIMS)
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


@query
def drill_through(spark, sf_dir):
    """All fatal accidents followed into the three facts: rows and quantities found."""
    lake = gold_lake(spark, sf_dir)
    fatal = lake[_FACT].filter(F.col("severidade") == S.FATAL)
    found = star.drill_through(lake, fatal)
    sums = {star.ACCIDENTS: "total_vitimas", star.VEHICLES: "quantidade", star.VICTIMS: "quantidade"}
    parts = [
        frame.agg(
            F.lit(fact).alias("fato"), F.count("*").alias("linhas"), F.sum(sums[fact]).alias("soma")
        )
        for fact, frame in found.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def accident_cards(spark, sf_dir):
    """Every accident's card, its nested rows counted and added up."""
    cards = star.accident_cards(gold_lake(spark, sf_dir))
    total = lambda rows, field: F.aggregate(rows, F.lit(0).cast("long"), lambda n, r: n + r[field])
    return cards.select(
        "data", "concessionaria", "km", "hora", "tipo_de_acidente", F.size("acidentes").cast("long").alias("acidentes"),
        total("veiculos", "quantidade").alias("veiculos"), total("vitimas", "quantidade").alias("vitimas"),
        F.size("veiculos").alias("tipos_veiculo"), F.size("vitimas").alias("tipos_vitima"),
    )


@query
def drill_across(spark, sf_dir):
    return star.ask(
        gold_lake(spark, sf_dir),
        ["total_acidentes", "total_veiculos", "vitimas_detalhado", "acidentes_fatais", "media_veiculos"],
        ["uf", "ano"],
    )


# --- aggregations ----------------------------------------------------------------------


@query
def count_rows(spark, sf_dir):
    return _silver(spark, sf_dir).agg(F.count("*").alias("linhas"))


@query
def distinct_1(spark, sf_dir):
    return _silver(spark, sf_dir).select("data").distinct()


@query
def distinct_2(spark, sf_dir):
    return _silver(spark, sf_dir).select("rodovia", "uf").distinct()


@query
def dist_sentido(spark, sf_dir):
    return quality.distribution(_silver(spark, sf_dir), "sentido")


@query
def dist_severidade(spark, sf_dir):
    return quality.distribution(_silver(spark, sf_dir), "severidade")


@query
def dist_concessionaria(spark, sf_dir):
    return quality.distribution(silver_lake(spark, sf_dir)[_SILVER], "concessionaria")


@query
def dist_severidade_fact(spark, sf_dir):
    return quality.distribution(gold_lake(spark, sf_dir, _FACT)[_FACT], "severidade", "acidentes")


@query
def sum_veiculo(spark, sf_dir):
    return dashboard.counts_report(
        gold_lake(spark, sf_dir), star.VEHICLES, "gold_dim_veiculo", "id_veiculo", "tipo_veiculo"
    )


@query
def sum_vitima(spark, sf_dir):
    return dashboard.counts_report(
        gold_lake(spark, sf_dir), star.VICTIMS, "gold_dim_tipo_vitima", "id_tipo_vitima", "tipo_vitima"
    )


@query
def null_profile(spark, sf_dir):
    return quality.null_profile(_silver(spark, sf_dir))


@query
def date_range(spark, sf_dir):
    return quality.date_range(_silver(spark, sf_dir))


@query
def unknown_count(spark, sf_dir):
    return quality.unknown_count(_silver(spark, sf_dir))


@query
def quality_profile(spark, sf_dir):
    return quality.profile(_silver(spark, sf_dir))


@query
def dq_gate(spark, sf_dir):
    return quality.dq_gate(cleaning.silver(raw_rows(spark, sf_dir), audit=True))


# --- sorts, limits, reshape ------------------------------------------------------------


@query
def order_desc(spark, sf_dir):
    return quality.distribution(_silver(spark, sf_dir), "tipo_de_acidente")


@query
def order_by_date(spark, sf_dir):
    """The dates, each with its place in the order."""
    dates = dims_lake(spark, sf_dir)["gold_dim_data"]
    return dates.join(keys.surrogate_key(dates.select("data"), ["data"], "posicao"), "data").orderBy("data")


@query
def top_n_rodovias(spark, sf_dir):
    counted = _silver(spark, sf_dir).groupBy("rodovia").agg(F.count("*").alias("total_acidentes"))
    return dashboard.top(counted, "total_acidentes", 15, "rodovia")


@query
def preview(spark, sf_dir):
    """First thousand rows of the victim fact's daily totals, in date order."""
    daily = gold_lake(spark, sf_dir)[star.VICTIMS].groupBy("id_data", "id_tipo_vitima").agg(
        F.sum("quantidade").alias("quantidade")
    )
    return daily.orderBy("id_data", "id_tipo_vitima").limit(1000)


@query
def describe_table(spark, sf_dir):
    return quality.column_fill(silver_lake(spark, sf_dir)[_SILVER])


@query
def unpivot_veiculo(spark, sf_dir):
    wide = _silver(spark, sf_dir).select("concessionaria", "ano", *S.VEHICLES)
    long_rows = reshape.unpivot_counts(wide, ["concessionaria", "ano"], S.VEHICLES, "tipo_veiculo")
    return long_rows.groupBy("concessionaria", "ano", "tipo_veiculo").agg(
        F.sum("quantidade").alias("quantidade"), F.count("*").alias("linhas")
    )


@query
def unpivot_vitima(spark, sf_dir):
    wide = _silver(spark, sf_dir).select("concessionaria", "data", "hora", "km", *S.VICTIMS)
    return reshape.unpivot_counts(
        wide, ["concessionaria", "data", "hora", "km"], S.VICTIMS, "tipo_vitima"
    )


# --- facts -----------------------------------------------------------------------------


@query
def fato_acidente(spark, sf_dir):
    lake = dims_lake(spark, sf_dir)
    return _without_id(facts.fato_acidente(lake[_SILVER], lake))


@query
def fato_veiculo_acidente(spark, sf_dir):
    lake = dims_lake(spark, sf_dir)
    return _without_id(facts.fato_veiculo_acidente(lake[_SILVER], lake))


@query
def fato_vitima_acidente(spark, sf_dir):
    lake = dims_lake(spark, sf_dir)
    return _without_id(facts.fato_vitima_acidente(lake[_SILVER], lake))


# --- measures, visuals, slicers --------------------------------------------------------

# Registered measure -> grouping it is shown under.
MEASURE_GROUPS = {
    "total_acidentes": ["ano", "concessionaria"],
    "total_mortos": ["ano", "uf"],
    "total_vitimas": ["mes", "tipo_de_acidente"],
    "acidentes_fatais": ["ano", "severidade"],
    "taxa_mortalidade": ["uf", "tipo_de_acidente"],
    "media_veiculos": ["rodovia"],
    "total_veiculos": ["concessionaria", "tipo_veiculo"],
    "vitimas_detalhado": ["ano", "tipo_vitima"],
}
# Registered slicer -> the values it selects; the last one combines all four.
SLICES = {
    "slicer_ano": {"ano": [1997, 1998]},
    "slicer_concessionaria": {"concessionaria": ["AUTOPISTA FLUMINENSE", "VIA040", S.UNKNOWN_OPERATOR]},
    "slicer_uf": {"uf": ["SP", None]},
    "slicer_severidade": {"severidade": ["Fatal", "Grave"]},
    "slicers_combined": {
        "ano": [1996, 1997, 1998, 1999],
        "concessionaria": list(S.OPERATOR_NAMES.values())[:30],
        "uf": ["SP", "MG", "RJ", "PR", "SC"],
        "severidade": ["Grave", "Leve", "Sem Vítimas"],
    },
}
# of one year, two operators and a few roads
CLUSTERED_SLICE = {
    "ano": [1997], "concessionaria": ["VIA040", "AUTOPISTA FLUMINENSE"], "rodovia": ["BR-101", "BR-116", "BR-125"],
}
SLICED_MEASURES = [
    "total_acidentes", "total_mortos", "acidentes_fatais", "taxa_mortalidade", "total_veiculos",
    "vitimas_detalhado",
]


# Registered answer with subtotals -> (measures, grouping, slicers).
TOTALS = {
    "m_taxa_mortalidade_totais": (["taxa_mortalidade"], ["uf", "ano"], {}),
    "m_media_veiculos_totais": (["media_veiculos", "total_acidentes"], ["ano", "uf"], {}),
    "fatos_com_totais": (
        ["total_acidentes", "total_veiculos", "vitimas_detalhado", "acidentes_fatais", "taxa_mortalidade"],
        ["concessionaria", "ano"], SLICES["slicer_uf"],
    ),
}


def _register(name: str, function: Query) -> None:
    QUERIES[name] = function


for _name, _by in MEASURE_GROUPS.items():
    _register(
        f"m_{_name}",
        lambda spark, sf_dir, name=_name, by=_by: star.ask(gold_lake(spark, sf_dir), [name], by),
    )
for _name in dashboard.VISUALS:
    _register(
        _name,
        lambda spark, sf_dir, name=_name: dashboard.visual(gold_lake(spark, sf_dir), name),
    )
for _name, _where in SLICES.items():
    _register(
        _name,
        lambda spark, sf_dir, where=_where: star.ask(
            gold_lake(spark, sf_dir), SLICED_MEASURES, ["ano"], where
        ),
    )
for _name, (_wanted, _by, _where) in TOTALS.items():
    _register(
        _name,
        lambda spark, sf_dir, wanted=_wanted, by=_by, where=_where: star.ask(
            gold_lake(spark, sf_dir), wanted, by, where, totals=True
        ),
    )
# every page under all four slicers
for _name in pages.PAGES:
    _register(
        _name,
        lambda spark, sf_dir, name=_name: pages.report(
            gold_lake(spark, sf_dir), name, SLICES["slicers_combined"]
        ),
    )


@query
def v_severidade_por_tipo_pivot(spark, sf_dir):
    return dashboard.severity_columns(gold_lake(spark, sf_dir))
