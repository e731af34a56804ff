"""The lake's tables under names of the session catalogue, with statistics for the planner.

A name points at the same files as the path does; the catalogue adds the partitions it knows, so that a filter on
one lists no directories, and row and column statistics, so that join order and broadcast choices rest on counts
rather than on file sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asfalto import schemas as S
from asfalto.functions.inline import relation
from asfalto.operators.layout import Written
from asfalto.plans.medallion import Lake

# Row counts reach the plan, and joins are put in order by them.
STATISTICS = {"spark.sql.cbo.enabled": "true", "spark.sql.cbo.planStats.enabled": "true"}
_LISTED = T.StructType([
    T.StructField("tabela", T.StringType()), T.StructField("colunas", T.LongType()), T.StructField("linhas", T.LongType()),
])


class NamedLake(Lake):
    """A lake that is read and written by table name within one database."""

    def __init__(self, spark: SparkSession, root: str, database: str):
        super().__init__(spark, root)
        self.database = database
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{self.root}'")

    def name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def __getitem__(self, table: str) -> DataFrame:
        # the catalogue puts partition columns last
        return self.spark.table(self.name(table)).select(*S.TABLES[table][0].names)

    def save(self, table: str, df: DataFrame, **options) -> Written:
        written = super().save(table, df, **options)
        self.register(table)
        return written

    def register(self, table: str) -> None:
        """Give stored files their name, and take statistics: rows, and for keys also values and nulls."""
        schema, partitions = S.TABLES[table]
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        by = f"PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")
        self.spark.sql(f"CREATE TABLE {self.name(table)} ({columns}) USING parquet {by} LOCATION '{self.path(table)}'")
        if partitions:
            self.spark.catalog.recoverPartitions(self.name(table))
        keys = ", ".join(c for c in schema.names if c.startswith("id_") or c in partitions)
        wanted = f"FOR COLUMNS {keys}" if keys else ""
        self.spark.sql(f"ANALYZE TABLE {self.name(table)} COMPUTE STATISTICS {wanted}")

    def register_all(self) -> None:
        for table in self:
            self.register(table)

    def listing(self) -> DataFrame:
        """(tabela, colunas, linhas) of every table, from the catalogue alone: no file is opened."""
        rows = []
        for table in self:
            told = {r["col_name"]: r["data_type"] for r in self.spark.sql(f"DESCRIBE EXTENDED {self.name(table)}").collect()}
            count = int(told["Statistics"].split(",")[1].split()[0])
            rows.append((table, len(self.spark.catalog.listColumns(self.name(table))), count))
        return relation(self.spark, rows, _LISTED)


def with_statistics(spark: SparkSession) -> SparkSession:
    """A session of its own, sharing tables and cache, whose planner uses the statistics."""
    own = spark.newSession()
    for name, value in STATISTICS.items():
        own.conf.set(name, value)
    return own


def fatal_by_road(lake: NamedLake) -> DataFrame:
    """Fatal accidents per state and operator, in SQL over the names."""
    names = {t: lake.name(t) for t in lake}
    return lake.spark.sql(f"""
        SELECT r.uf, c.concessionaria, count(*) AS acidentes, sum(f.mortos) AS mortos
        FROM {names["gold_fato_acidente"]} f
        JOIN {names["gold_dim_rodovia"]} r ON f.id_rodovia = r.id_rodovia
        JOIN {names["gold_dim_concessionaria"]} c ON f.id_concessionaria = c.id_concessionaria
        WHERE f.severidade = '{S.FATAL}' GROUP BY r.uf, c.concessionaria""").withColumn(
        "mortos", F.col("mortos").cast("long"))
