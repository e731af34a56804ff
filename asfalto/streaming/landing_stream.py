"""Landing as a stream: each run takes the files it has not seen and stops."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from asfalto import schemas as S
from asfalto.functions.inline import relation
from asfalto.operators.layout import has_data, read_table
from asfalto.sources.csv_files import COLUMNS, REASON, RECORD, fitting, read_files, surplus

BATCH = "_lote"
MOST_FILES = 1000  # of a batch; their names come to the driver
ROWS, QUARANTINE, REFUSED = "linhas", "quarentena", "recusados"
_TEXT = T.StringType()
_LISTING = "path string, modificationTime timestamp, length long, content binary"
SCHEMAS = {
    ROWS: S.RAW.add(S.FILE_COLUMN, _TEXT),
    QUARANTINE: T.StructType([T.StructField(c, _TEXT) for c in (RECORD, REASON, COLUMNS, S.FILE_COLUMN)]),
    REFUSED: T.StructType([T.StructField(c, _TEXT) for c in (S.FILE_COLUMN, REASON)]),
}


def land_batch(spark: SparkSession, files: list[str], number: int, target: str) -> None:
    """Rows, quarantined records and refused files of one batch, each in a directory of the batch's number.

    Columns are aligned by name, file group by file group. A batch that runs again overwrites what it wrote.
    """
    rows, refused = read_files(spark, files) if files else (None, {})
    parts = {REFUSED: relation(spark, sorted(refused.items()), SCHEMAS[REFUSED])}
    if rows is not None:
        parts |= {ROWS: fitting(rows), QUARANTINE: surplus(rows)}
    for name, part in parts.items():
        part.select(*SCHEMAS[name].names).write.mode("overwrite").parquet(f"{target}/{name}/{BATCH}={number}")


def take_new_files(
    spark: SparkSession, source: str, target: str, checkpoint: str, most_files: int = MOST_FILES
) -> None:
    """Land the new CSV files below `source` in the tables of the folder `target`.

    The stream carries file names only; its checkpoint remembers the files taken and the batch each belongs
    to, and there is no other state. The rows of a batch are read by `land_batch` with the rules of any other read.
    """
    listing = (
        spark.readStream.schema(_LISTING)
        .format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.csv")
        .option("maxFilesPerTrigger", most_files)
        .load(source)
        .select("path")
    )

    def land(batch: DataFrame, number: int) -> None:
        land_batch(batch.sparkSession, sorted(r["path"] for r in batch.collect()), number, target)

    (
        listing.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def landed(spark: SparkSession, target: str, table: str = ROWS) -> DataFrame:
    """A table of all batches so far; empty before the first."""
    path, schema = f"{target}/{table}", SCHEMAS[table]
    return read_table(spark, path, schema) if has_data(spark, path) else relation(spark, [], schema)
