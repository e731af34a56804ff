"""The tables that queries over silver and gold read, built once per application and input."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from asfalto.plans import medallion as M
from asfalto.session import new_folder
from asfalto.sources.accidents import raw_rows

_built: dict[tuple, M.Lake] = {}
_with_dims: set[str] = set()
_facts: set[tuple[str, str]] = set()


def _state_of(spark: SparkSession, sf_dir: str) -> tuple:
    """Identity of the input files, from their listing; new or changed files give a new lake."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(f"{sf_dir}/lineitem.parquet")
    )
    row = files.agg(F.count(F.lit(1)), F.sum("length"), F.max("modificationTime")).first()
    return (spark.sparkContext.applicationId, sf_dir, *row)


def silver_lake(spark: SparkSession, sf_dir: str) -> M.Lake:
    """A lake whose silver table is written."""
    state = _state_of(spark, sf_dir)
    if state not in _built:
        lake = M.Lake(spark, new_folder(spark, "lake"))
        M.build_silver(lake, raw_rows(spark, sf_dir))
        _built[state] = lake
    return _built[state]


def dims_lake(spark: SparkSession, sf_dir: str) -> M.Lake:
    """A lake with silver and the six dimensions written: all that a fact is built from."""
    lake = silver_lake(spark, sf_dir)
    if lake.root not in _with_dims:
        M.build_dims(lake)
        _with_dims.add(lake.root)
    return lake


def gold_lake(spark: SparkSession, sf_dir: str, only: str | None = None) -> M.Lake:
    """A lake with all ten tables written; of the facts, for a query that reads one, at least this."""
    lake = dims_lake(spark, sf_dir)
    missing = [t for t in ([only] if only else M.FACTS) if (lake.root, t) not in _facts]
    if missing == list(M.FACTS):
        M.build_facts(lake)
    else:
        for table in missing:
            M.build_facts(lake, table)
    _facts.update((lake.root, t) for t in missing)
    return lake
