"""Which catalogued source files have landed, and a report on a landing run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asfalto import schemas as S
from asfalto.functions.inline import relation
from asfalto.functions.rows import file_name
from asfalto.sources.csv_files import describe_files, faults

LANDED, PENDING, FAILED = "skip", "pendente", "erro"


def catalogue(spark: SparkSession) -> DataFrame:
    """The known sources: (filename, concessionaria)."""
    files = [(f"demostrativo_acidentes_{key}.csv", name) for key, name in S.OPERATOR_NAMES.items()]
    return relation(spark, files, S.CATALOGUE)


def landed(spark: SparkSession, path: str) -> DataFrame:
    """(filename, bytes) of what lies below a folder, from the listing: no file is opened."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.csv")
        .load(path)
        .groupBy(file_name(F.col("path")).alias("filename"))
        .agg(F.sum("length").alias("bytes"))
    )


def unreadable(spark: SparkSession, path: str) -> DataFrame:
    """(filename, motivo) of landed files whose header lacks a column."""
    found = faults(describe_files(spark, path))
    return found.groupBy(file_name(F.col("file")).alias("filename")).agg(F.min("reason").alias("motivo"))


def manifest(
    catalogued: DataFrame, found: DataFrame, faulty: DataFrame | None = None, force: bool = False
) -> DataFrame:
    """Status per catalogued file: landed ones are skipped, `force` re-takes all, those in `faulty` have failed.

    Spark lists no empty files, so one that broke off before its first byte is still pending.
    """
    files = catalogued.join(found, "filename", "left")
    files = files.withColumn("motivo", F.lit(None).cast("string")) if faulty is None else files.join(
        faulty, "filename", "left")
    status = (
        F.when(F.col("bytes").isNull(), PENDING).when(F.col("motivo").isNotNull(), FAILED).otherwise(LANDED)
    )
    if force:
        status = F.lit(PENDING)
    return files.select("filename", "concessionaria", status.alias("status"), "motivo")


def report(catalogued: DataFrame, found: DataFrame, faulty: DataFrame | None = None) -> DataFrame:
    """Files and MB per status, from the listing; a landed file that no source is known for is an error.

    So is one in `faulty`. Such files are listed by name, with the reason where there is one, for somebody to read.
    """
    known = catalogued.select("filename", "concessionaria").join(found, "filename", "full_outer")
    if faulty is None:
        known = known.withColumn("motivo", F.lit(None).cast("string"))
    else:
        known = known.join(faulty, "filename", "left")
    status = (
        F.when(F.col("concessionaria").isNull() | F.col("motivo").isNotNull(), FAILED)
        .when(F.col("bytes").isNull(), PENDING).otherwise(LANDED)
    )
    named = F.concat_ws(": ", "filename", "motivo")
    return known.withColumn("status", status).groupBy("status").agg(
        F.count(F.lit(1)).alias("arquivos"),
        F.round(F.coalesce(F.sum("bytes"), F.lit(0)) / 1024**2, 1).alias("total_mb"),
        F.concat_ws(
            ", ", F.sort_array(F.collect_list(F.when(F.col("status") == FAILED, named)))
        ).alias("com_erro"),
    )


def sizes(found: DataFrame) -> DataFrame:
    """Size per landed file in KB, by name."""
    kb = F.round(F.col("bytes") / 1024, 1)
    return found.select("filename", kb.alias("kb")).orderBy("filename")
