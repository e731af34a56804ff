"""Writing tables, checking what was written, and rearranging files."""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone
from functools import reduce
from itertools import accumulate
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asfalto.functions.inline import relation
from asfalto.functions.packing import pack_ranges
from asfalto.functions.zcurve import bits_for, bucket_of, interleave
from asfalto.session import new_folder, prepare

TARGET_FILE_BYTES = 128 * 1024 * 1024
TASK_BYTES = 16 * 1024 * 1024  # stored bytes that a task reads, or sorts, without a spill
LEAST_CUTS = 8  # files that a task must have to write for its rows to be cut, rather than shuffled, into them
CLOCK_SKEW = timedelta(minutes=10)  # by which clocks of writers and of the store may differ
JOB_IN_NAME = r"part-\d+-([0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})"  # Spark names files after the write job
_Z = "_z"


@dataclass(frozen=True)
class Written:
    path: str
    written: int
    read_back: int
    metrics: dict = field(default_factory=dict)
    frame: DataFrame | None = None  # scan of the stored table, its files already listed

    @property
    def complete(self) -> bool:
        return self.written == self.read_back


def stage(df: DataFrame, label: str) -> DataFrame:
    """Store an intermediate result in the shared folder and read it from there.

    Cuts the lineage; the copy survives the loss of executors, and the planner knows its size.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return read_table(df.sparkSession, path, df.schema)


def stage_counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """`stage`, with the number of rows written; for frames whose last step follows a shuffle."""
    seen = Observation()
    stored = stage(df.observe(seen, F.count(F.lit(1)).alias("rows")), label)
    return stored, seen.get["rows"]


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Scan a stored table. A given schema also fixes the type of the partition columns."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    frame = reader.parquet(path)
    return frame if schema is None else frame.select(*schema.names)


def spread(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Bring rows of one output directory together, splitting directories that are too large.

    A plain repartition on the partition columns would send a hot value to one task; under
    the rebalance hint adaptive execution cuts it into parts of the advisory size, and merges
    small ones.
    """
    return df.hint("rebalance", *partitions) if partitions else df


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partitions: Sequence[str] = (),
    metrics: dict[str, Column] | None = None,
    drop: Sequence[str] = (),
    gather: bool = True,
) -> Written:
    """Write a table and compare the rows that went in with the rows that can be read.

    With `gather` a shuffle brings the rows of a directory together first. Without it each task writes a file to every
    directory that it has rows for, which is right for few directories: nothing is shuffled, sorted or spilled.

    `metrics` are aggregates taken in the same pass, over columns that `drop` may then leave
    out. They are observed after the shuffle, in the tasks that write: a map task that
    is run again after a lost executor would be counted twice.
    """
    spark = df.sparkSession
    prepare(spark)
    since = datetime.now(timezone.utc) - CLOCK_SKEW
    before = _recent_jobs(spark, path, since) if mode == "append" else None
    seen = Observation()
    observed = (spread(df, partitions) if gather else df).observe(
        seen,
        F.count(F.lit(1)).alias("_rows"),
        *[value.alias(name) for name, value in (metrics or {}).items()],
    )
    kept = observed.drop(*drop)
    kept.write.mode(mode).partitionBy(*partitions).parquet(path)
    taken = dict(seen.get)
    stored, rows = read_table(spark, path, kept.schema), taken.pop("_rows")
    read_back = stored.count() if before is None else _appended(spark, path, kept.schema, since, before, rows)
    return Written(path, rows, read_back, taken, stored)


def _recent(reader: DataFrameReader, since: datetime) -> DataFrameReader:
    """Only data files changed since then, in whatever directory."""
    return (
        reader.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .option("modifiedAfter", since.strftime("%Y-%m-%dT%H:%M:%S"))
        .option("timeZone", "UTC")
    )


def _recent_jobs(spark: SparkSession, path: str, since: datetime) -> set[str]:
    """Write jobs that have put files below a path since then, from the listing alone."""
    if not has_data(spark, path):
        return set()
    files = _recent(spark.read.format("binaryFile"), since).load(path)
    return {r["job"] for r in files.select(F.regexp_extract("path", JOB_IN_NAME, 1).alias("job")).distinct().collect()}


def _appended(
    spark: SparkSession, path: str, schema: T.StructType, since: datetime, before: set[str], written: int
) -> int:
    """Rows of the files that one append has just added, from their footers.

    Other writers may have added files meanwhile, each with a job of its own in their names: of the new jobs this
    append is the one with as many rows as were written. If there is none, the fullest is told, and they differ.
    """
    # no column is read, so Parquet answers from footers
    rows = _recent(spark.read.schema(schema), since).parquet(path)
    counts = rows.groupBy(F.regexp_extract("_metadata.file_name", JOB_IN_NAME, 1).alias("job")).count().collect()
    new = [r["count"] for r in counts if r["job"] not in before]
    return written if written in new else max(new, default=0)


def write_partitions(df: DataFrame, path: str, partitions: Sequence[str]) -> Written:
    """Overwrite those directories of a partitioned table that `df` has rows for, and leave the others alone."""
    seen = Observation()
    prepare(df.sparkSession)
    observed = spread(df, partitions).observe(seen, F.count(F.lit(1)).alias("_rows"))
    observed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)
    stored = read_table(df.sparkSession, path, df.schema)
    own = df.select(*partitions).distinct()
    same = reduce(lambda a, b: a & b, [stored[c].eqNullSafe(own[c]) for c in partitions])
    return Written(path, seen.get["_rows"], stored.join(own, same, "left_semi").count(), frame=stored)


def partition_folders(spark: SparkSession, path: str, columns: Sequence[str]) -> list[tuple]:
    """(folder, value of each column) of every directory of a partitioned table, from the listing alone."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    folder = F.regexp_replace("path", "/[^/]*$", "")
    return [tuple(r) for r in files.select(folder, *columns).distinct().collect()]


def remove_folders(spark: SparkSession, folders: Sequence[str]) -> None:
    """Delete directories with all they hold, wherever the session's file systems reach."""
    jvm, settings = spark._jvm, spark._jsc.hadoopConfiguration()
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(settings).delete(path, True)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(path)
        .select("path", "length")
    )


def has_data(spark: SparkSession, path: str) -> bool:
    try:
        return bool(_files(spark, path).take(1))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def file_stats(spark: SparkSession, path: str) -> tuple[int, int]:
    """Number of data files and their bytes, from the listing alone."""
    row = _files(spark, path).agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")
    ).first()
    return row["files"], row["bytes"]


def compact(
    spark: SparkSession,
    source: str,
    target: str,
    partitions: Sequence[str] = (),
    target_bytes: int = TARGET_FILE_BYTES,
    schema: T.StructType | None = None,
) -> Written:
    """Copy a table to a new path in files of about `target_bytes`."""
    own = spark.newSession()  # settings below must not leak into the caller's session
    own.conf.set("spark.sql.adaptive.enabled", "true")
    own.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_bytes))
    own.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    own.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", str(target_bytes // 4))
    frame = read_table(own, source, schema)
    spreading = frame if partitions else frame.hint("rebalance")
    return write_table(spreading, target, partitions=partitions)


def compact_partitions(
    spark: SparkSession,
    path: str,
    partitions: Sequence[str],
    target_bytes: int = TARGET_FILE_BYTES,
    schema: T.StructType | None = None,
) -> list[str]:
    """Merge small files of a partitioned table in place, directory by directory; gives the directories rewritten.

    The listing says which directories could do with fewer files: their stored bytes over the target, rounded up, is
    how many they get. All others are left alone. A directory is swapped when its new files are complete.
    """
    prepare(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    wanted = F.ceil(F.sum("length") / target_bytes).cast("int")
    crowded = (
        files.groupBy(F.regexp_replace("path", "/[^/]*$", "").alias("_folder"), *partitions)
        .agg(F.count(F.lit(1)).alias("_files"), wanted.alias("_wanted"))
        .where(F.col("_files") > F.col("_wanted"))
    )
    # a row per directory that changes: the list of directories a scan needs anyway
    found = crowded.collect()
    if not found:
        return []
    folders = [r["_folder"] for r in found]
    reader = spark.read.option("basePath", path)
    rows = (reader.schema(schema) if schema else reader).parquet(*folders)
    names = schema.names if schema else rows.columns
    total = sum(r["_wanted"] for r in found)
    first = accumulate((r["_wanted"] for r in found), initial=0)
    sizes = T.StructType([*[rows.schema[c] for c in partitions],
                          *[T.StructField(c, T.IntegerType()) for c in ("_wanted", "_first")]])
    share = relation(spark, [(*[r[c] for c in partitions], r["_wanted"], n) for r, n in zip(found, first)], sizes)
    same = reduce(lambda a, b: a & b, [rows[c].eqNullSafe(share[c]) for c in partitions])
    part = F.pmod(F.xxhash64(*[F.col(f"r.`{c}`") for c in rows.columns]), F.col("s._wanted")) + F.col("s._first")
    dealt = rows.alias("r").join(share.alias("s"), same).select(
        *[F.col(f"r.`{c}`") for c in names], part.cast("int").alias("_part"))
    # rows that are equal in every column cannot be told apart, and go to one file of the several
    (
        dealt.repartitionById(total, F.col("_part")).drop("_part")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)
    )
    return folders


def quantile_bounds(df: DataFrame, columns: Sequence[str], buckets: int, *also: Column) -> tuple[dict[str, list], Row]:
    """Distinct bounds that cut each column into about equal shares, and other aggregates; one pass, one row back."""
    shares = [i / buckets for i in range(1, buckets)]
    accuracy = max(10_000, 10 * buckets)
    row = df.agg(*[F.percentile_approx(c, shares, accuracy).alias(c) for c in columns], *also).first()
    return {c: sorted(set(row[c] or [])) for c in columns}, row


def z_position(bounds: Mapping[str, list], bits: int) -> Column:
    """Curve position of a row, over buckets of about equal share.

    A column with few values has few buckets: they are moved up to its high bits, or it
    would only count after every other column.
    """
    buckets = [F.shiftleft(bucket_of(F.col(c), cut), bits - len(cut).bit_length()) for c, cut in bounds.items()]
    return interleave(buckets, bits)


# --- which files of a clustered copy a filter needs -----------------------------------------


def index_path(path: str) -> str:
    return f"{path.rstrip('/')}_arquivos"


def write_file_index(table: DataFrame, path: str, columns: Sequence[str], partitions: Sequence[str] = ()) -> None:
    """Store, beside a table, a row per file: its partition, and the least and greatest value of some columns."""
    bounds = [f(c).alias(f"{name}_{c}") for c in columns for name, f in (("lo", F.min), ("hi", F.max))]
    table.groupBy(F.col("_metadata.file_path").alias("file"), *partitions).agg(*bounds).coalesce(1).write.mode(
        "overwrite").parquet(index_path(path))


def files_with(
    spark: SparkSession, path: str, keys: Mapping[str, DataFrame], partitions: Mapping[str, Column]
) -> list[str]:
    """Files of an indexed table that may hold a row whose columns all have one of the wanted keys.

    `keys` gives a one-column frame per indexed column, and `partitions` a condition per partition column.
    """
    index = spark.read.parquet(index_path(path))
    for condition in partitions.values():
        index = index.where(condition)
    for column, wanted in keys.items():
        if f"lo_{column}" in index.columns:
            key = wanted.toDF("_key")
            index = index.join(
                key, F.col("_key").between(F.col(f"lo_{column}"), F.col(f"hi_{column}")), "left_semi")
    # what is left is the list of files that the scan below needs on the driver anyway
    return [unquote(r["file"]) for r in index.select("file").collect()]


def read_files(spark: SparkSession, path: str, files: Sequence[str], schema: T.StructType) -> DataFrame:
    """Some files of a partitioned table."""
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*files).select(*schema.names)


def zorder(
    spark: SparkSession,
    source: str,
    target: str,
    columns: Sequence[str],
    partitions: Sequence[str] = (),
    tie_break: Sequence[str] = (),
    target_bytes: int = TARGET_FILE_BYTES,
    schema: T.StructType | None = None,
) -> Written:
    """Copy a table to a new path with rows clustered along a Z-order curve.

    The range partitioning samples the curve, so dense stretches get more files. Rows that
    share one curve position cannot be cut by it: `tie_break` columns split them further. An index of the
    copy's files is stored beside it, for readers that know which keys they want.

    Rows are shuffled once, to a file each or, where files are small, to tasks that cut their sorted rows into many:
    blocks of few rows hardly compress. On the way integers of known range share longs.
    """
    own = spark.newSession()  # settings below must not leak into the caller's session
    prepare(own)
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    own.conf.set("spark.sql.files.maxPartitionBytes", str(TASK_BYTES))
    _, stored = file_stats(spark, source)
    files = max(1, math.ceil(stored / target_bytes))
    tasks = max(math.ceil(stored / TASK_BYTES), 2 * spark.sparkContext.defaultParallelism)
    many = files >= LEAST_CUTS * tasks
    frame, bits = read_table(own, source, schema), bits_for(files, len(columns))
    whole = [f.name for f in frame.schema if isinstance(f.dataType, T.IntegralType)]
    ends = [f(c).alias(f"_{name}_{c}") for c in whole for name, f in (("lo", F.min), ("hi", F.max))]
    bounds, row = quantile_bounds(frame, columns, 1 << bits, F.count(F.lit(1)).alias("_rows"), *ends)
    ranges = {c: (row[f"_lo_{c}"], row[f"_hi_{c}"], frame.schema[c].dataType.simpleString()) for c in whole}
    words, unpacked = pack_ranges({**ranges, _Z: (0, (1 << bits * len(columns)) - 1, "long")}, "_w")
    placed = frame.withColumn(_Z, z_position(bounds, bits))
    sent = placed.select(*[word.alias(name) for name, word in words.items()], *[c for c in placed.columns if c not in unpacked])
    order = [unpacked.get(c, F.col(c)) for c in (*partitions, _Z, *tie_break)]
    dealt = sent.repartitionByRange(tasks if many else files, *order)
    back = dealt.select(*[unpacked.get(c, F.col(c)).alias(c) for c in placed.columns])
    seen = Observation()
    writer = (
        back.sortWithinPartitions(*partitions, _Z, *tie_break)
        .observe(seen, F.count(F.lit(1)).alias("_rows"))
        .drop(_Z)
        .write.partitionBy(*partitions)
    )
    if many:
        writer = writer.option("maxRecordsPerFile", math.ceil(row["_rows"] / files))
    writer.parquet(target)
    stored = read_table(spark, target, frame.schema)
    write_file_index(stored, target, columns, partitions)
    return Written(target, seen.get["_rows"], stored.count(), frame=stored)
