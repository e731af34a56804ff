"""Bronze to gold as a sequence of table writes under one folder."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from asfalto import schemas as S
from asfalto.operators.layout import (
    TARGET_FILE_BYTES, Written, files_with, has_data, partition_folders, read_files, read_table, remove_folders, stage,
    write_partitions, write_table, zorder,
)
from asfalto.operators.quality import gate_metrics, verdict
from asfalto.plans import dims as D
from asfalto.plans import facts
from asfalto.plans.silver import REJECTS, gathered, silver
from asfalto.sources.csv_files import RECORD, fitting, parsed, surplus

SILVER = "silver_acidentes"
QUARANTINE = "bronze_quarentena"
DIMENSIONS = [t for t in S.TABLES if "_dim_" in t]
FACTS = {
    "gold_fato_acidente": facts.fato_acidente,
    "gold_fato_veiculo_acidente": facts.fato_veiculo_acidente,
    "gold_fato_vitima_acidente": facts.fato_vitima_acidente,
}
# Columns that reports filter on most, per fact.
CLUSTERING = {
    "gold_fato_acidente": ["id_data", "id_concessionaria", "id_rodovia"],
    "gold_fato_veiculo_acidente": ["id_data", "id_concessionaria", "id_veiculo"],
    "gold_fato_vitima_acidente": ["id_data", "id_concessionaria", "id_tipo_vitima"],
}


class Lake(Mapping[str, DataFrame]):
    """The stored tables under one folder, by name, as lazy scans.

    A table's files are listed once, not on every access: a silver table is one directory per
    year and operator. `save` replaces the scan; `refresh` forgets what others may have changed.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._scans: dict[str, DataFrame] = {}

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self._scans:
            self._scans[table] = read_table(self.spark, self.path(table), S.TABLES[table][0])
        return self._scans[table]

    def refresh(self) -> None:
        self._scans.clear()

    def __iter__(self):
        return iter(S.TABLES)

    def __len__(self) -> int:
        return len(S.TABLES)

    def save(self, table: str, df: DataFrame, **options) -> Written:
        schema, partitions = S.TABLES[table]
        kept = [c for c in df.columns if c in options.get("drop", ())]
        done = write_table(
            df.select(*schema.names, *kept), self.path(table), partitions=partitions, **options
        )
        self._scans[table] = done.frame
        return done

    def publish(self) -> None:
        """Make every table available to SQL under its name, read from the stored copy."""
        for table in self:
            self[table].createOrReplaceTempView(table)


def _together(jobs: Mapping[str, Callable[[], Written]]) -> dict[str, Written]:
    """Submit independent writes side by side, so that one's last tasks overlap the next."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = {name: pool.submit(job) for name, job in jobs.items()}
        return {name: job.result() for name, job in running.items()}


def build_silver(lake: Lake, raw: DataFrame, mode: str = "overwrite") -> Written:
    """Clean and write in one pass, with the quality metrics taken on the way.

    Records that a scan marks as too long go to the quarantine table whole. They are counted in
    the same pass, and only if there are any is the scan repeated to store them.
    """
    marked, seen = RECORD in raw.columns, Observation()
    fit = raw
    if marked:
        too_long = F.count_if(F.col(RECORD).isNotNull()).alias("excedentes")
        fit = fitting(raw.observe(seen, too_long))
    written = lake.save(SILVER, gathered(fit), mode=mode, metrics=gate_metrics(), drop=REJECTS, gather=False)
    if marked and seen.get["excedentes"]:
        kept_out = write_table(surplus(raw), lake.path(QUARANTINE), mode=mode)
        written.metrics["excedentes"] = kept_out.written
    elif marked and mode == "overwrite" and has_data(lake.spark, lake.path(QUARANTINE)):
        # rows that an earlier run set apart are not this run's
        write_table(surplus(raw).limit(0), lake.path(QUARANTINE), mode=mode)
    written.metrics["veredito"] = verdict(written.metrics)
    return written


def replay(lake: Lake, mended: DataFrame) -> Written:
    """Add quarantined records that somebody mended to silver; those that still do not fit stay in quarantine.

    `mended` has the rows of the quarantine table, or some of them, with RECORD changed where need be. Records of
    the table that it leaves out stay as they are: a record is told by its file and text, so `mended` says in
    `_original` what a changed one was.
    """
    held = lake.spark.read.parquet(lake.path(QUARANTINE))
    key = [S.FILE_COLUMN, "_original"]
    # the quarantine table is written over below, so what is read of it must be stored first
    rows = stage(parsed(mended), "mended")
    left = held.withColumn("_original", F.col(RECORD)).join(mended.select(*key).distinct(), key, "left_anti")
    rest = stage(left.select(*held.columns).unionByName(surplus(rows)), "quarantine")
    written = lake.save(
        SILVER, gathered(fitting(rows)), mode="append", metrics=gate_metrics(), drop=REJECTS, gather=False)
    written.metrics["excedentes"] = write_table(rest, lake.path(QUARANTINE)).written
    written.metrics["veredito"] = verdict(written.metrics)
    return written


def replace_operators(lake: Lake, raw: DataFrame) -> Written:
    """Put the rows of `raw` in place of all that silver holds of their operators.

    Only partitions of these operators are written, year by year, and years of theirs that no longer occur are
    removed; files of other operators are not touched. A reader between the two steps may still see a stale year.
    """
    spark = lake.spark
    rows = stage(silver(fitting(raw) if RECORD in raw.columns else raw), "replacement")
    schema, partitions = S.TABLES[SILVER]
    # operators are enumerated; years of one operator are a few dozen
    new = {(r["concessionaria"], r["ano"]) for r in rows.select("concessionaria", "ano").distinct().collect()}
    stale = [
        folder for folder, operator, year in partition_folders(spark, lake.path(SILVER), ["concessionaria", "ano"])
        if operator in {o for o, _ in new} and (operator, year) not in new
    ]
    written = write_partitions(rows.select(*schema.names), lake.path(SILVER), partitions)
    remove_folders(spark, stale)
    lake.refresh()
    return written


def build_dims(lake: Lake) -> dict[str, Written]:
    rows, spark = lake[SILVER], lake.spark
    builders = {
        "gold_dim_data": lambda: D.dim_data(rows),
        "gold_dim_concessionaria": lambda: D.dim_concessionaria(rows),
        "gold_dim_rodovia": lambda: D.dim_rodovia(rows),
        "gold_dim_tipo_acidente": lambda: D.dim_tipo_acidente(rows),
        "gold_dim_veiculo": lambda: D.dim_veiculo(spark),
        "gold_dim_tipo_vitima": lambda: D.dim_tipo_vitima(spark),
    }
    return _together({t: lambda t=t: lake.save(t, builders[t]()) for t in DIMENSIONS})


def build_facts(lake: Lake, only: str | None = None) -> dict[str, Written]:
    """Surrogate keys are numbered anew on every run, so facts always follow the dimensions."""
    chosen = {only: FACTS[only]} if only else FACTS
    return _together(
        # by year only, so tasks write straight to the few directories
        {t: lambda t=t: lake.save(t, chosen[t](lake[SILVER], lake), gather=False) for t in chosen}
    )


def run(lake: Lake, raw: DataFrame) -> dict[str, Written]:
    return {SILVER: build_silver(lake, raw), **build_dims(lake), **build_facts(lake)}


class ClusteredLake(Lake):
    """A lake whose facts are clustered copies in another folder, with an index of their files.

    `narrowed` is what a report asks for a fact under filters: only files that may hold a row are listed and scanned.
    """

    def __init__(self, lake: Lake, root: str):
        super().__init__(lake.spark, lake.root)
        self.copies = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.copies}/{table}" if table in FACTS else super().path(table)

    def narrowed(self, fact: str, keys: Mapping[str, DataFrame], own: Mapping[str, Column]) -> DataFrame:
        """Rows of the files that may meet the wanted keys and the conditions on the fact's own columns."""
        partitions = {c: condition for c, condition in own.items() if c in S.TABLES[fact][1]}
        files = files_with(self.spark, self.path(fact), keys, partitions)
        return read_files(self.spark, self.path(fact), files, S.TABLES[fact][0])


def optimize(lake: Lake, root: str, target_bytes: int = TARGET_FILE_BYTES) -> dict[str, Written]:
    """Cluster the facts into a new folder; the old one stays readable meanwhile."""
    return _together(
        {
            table: lambda table=table: zorder(
                lake.spark, lake.path(table), f"{root}/{table}", CLUSTERING[table],
                partitions=["ano"], tie_break=["id_acidente"], schema=S.TABLES[table][0], target_bytes=target_bytes,
            )
            for table in FACTS
        }
    )
