"""Raw CSV files: what each looks like, how to scan them whole, and records that do not fit.

A record with more fields than its file has columns is set apart whole, as it stands in the file, so it can be
mended by hand and read again (`parsed`). A short record is filled with NULL.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asfalto import schemas as S
from asfalto.session import prepare

SEPARATOR, QUOTE, CHARSET = ";", '"', "windows-1252"
# Of a record that is set apart: its text, why, and the columns of its file in their order.
RECORD, REASON, COLUMNS = "_registro", "_motivo", "_colunas"
TOO_LONG, NO_COLUMN = "campos a mais", "sem coluna"
MOST_SURPLUS = 64  # surplus fields looked at; a record whose only surplus fields are empty fits
_TEXT = T.StringType()
_MALFORMED = "_malformado"


def _text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, _TEXT) for c in columns])


def scan(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str] = S.RAW_COLUMNS,
    header: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """Rows of files that share one column order, all text, plus the file each came from.

    RECORD is the text of a record with surplus fields, else NULL. A file with quoted line breaks needs
    `multi_line` and is then read by one task; any other is split.
    """
    prepare(spark)
    rows = (
        spark.read.schema(_text_schema([*columns, _MALFORMED]))
        .option("delimiter", SEPARATOR)
        .option("header", header)
        .option("encoding", CHARSET)
        .option("quote", QUOTE)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _MALFORMED)
        .option("columnPruning", False)
        .csv(paths if isinstance(paths, str) else list(paths))
    )
    # Spark marks short records too, and answers no query that needs the mark alone: hence the first column
    text = F.coalesce(F.col(_MALFORMED), F.col(f"`{columns[0]}`"))
    record = F.when(F.col(_MALFORMED).isNotNull() & _surplus(text, len(columns)), F.col(_MALFORMED))
    return rows.select(
        *[F.col(f"`{c}`") for c in columns], record.alias(RECORD),
        F.lit(SEPARATOR.join(columns)).alias(COLUMNS), F.col("_metadata.file_path").alias(S.FILE_COLUMN),
    )


def _fields(record: Column, count: int) -> Column:
    """Struct of the first `count` fields of a record's text: f0, f1, ..."""
    schema = ", ".join(f"f{n} string" for n in range(count))
    return F.from_csv(record, schema, {"sep": SEPARATOR, "quote": QUOTE, "multiLine": "true"})


def _plain(record: Column) -> Column:
    """Whether each separator of a record ends a field, so that it can be split without a CSV parser.

    The parser throws, and catches, an exception for every record that has not exactly the fields it is told of.
    """
    return ~record.rlike(f"[{QUOTE}\\r\\n]")


def _surplus(record: Column, columns: int) -> Column:
    """Whether a record has anything in fields past the columns of its file."""
    beyond = lambda r: F.coalesce(*[r[f"f{n}"] for n in range(columns, columns + MOST_SURPLUS)])
    rest = F.slice(F.split(record, SEPARATOR), columns + 1, MOST_SURPLUS)
    return F.when(_plain(record), F.array_join(rest, "") != "").otherwise(
        F.exists(F.array(_fields(record, columns + MOST_SURPLUS)), lambda r: beyond(r).isNotNull()))


def fitting(scanned: DataFrame) -> DataFrame:
    """Rows without surplus fields."""
    return scanned.filter(F.col(RECORD).isNull()).drop(RECORD, COLUMNS)


def surplus(scanned: DataFrame) -> DataFrame:
    """Records with more fields than the file has columns, for a quarantine table."""
    return scanned.filter(F.col(RECORD).isNotNull()).select(
        RECORD, F.lit(TOO_LONG).alias(REASON), COLUMNS, S.FILE_COLUMN)


def parsed(records: DataFrame) -> DataFrame:
    """Records (RECORD, COLUMNS, FILE_COLUMN) as rows of a scan: by name, and set apart again where still too long."""
    names = F.split(F.col(COLUMNS), SEPARATOR)
    most = len(S.RAW_COLUMNS) + MOST_SURPLUS
    plain = F.transform(F.slice(F.split(F.col(RECORD), SEPARATOR), 1, most), lambda f: F.nullif(f, F.lit("")))
    fields = F.when(F.col("_f").isNull(), plain).otherwise(F.array(*[F.col(f"_f.f{n}") for n in range(most)]))
    split = records.withColumn("_f", F.when(~_plain(F.col(RECORD)), _fields(F.col(RECORD), most))).select(
        fields.alias("_fields"), names.alias("_names"), RECORD, COLUMNS, S.FILE_COLUMN)
    beyond = F.exists(F.slice("_fields", F.size("_names") + 1, MOST_SURPLUS), lambda f: f.isNotNull())
    return split.select(
        *[F.get("_fields", (F.array_position("_names", c) - 1).cast("int")).alias(c) for c in S.RAW_COLUMNS],
        F.when(beyond, F.col(RECORD)).alias(RECORD), COLUMNS, S.FILE_COLUMN,
    )


def _odd_quotes(line: Column) -> Column:
    """Whether a quoted field is still open, or was closed, at the end of this line."""
    quotes = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(QUOTE), F.lit("")))
    return line.contains(QUOTE) & (quotes % 2 == 1)


def _lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Lines with their file, the block of it they lie in, and an order within the block."""
    return (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.csv")
        .text(paths if isinstance(paths, str) else list(paths))
        .select(
            F.col("value"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("place"),
        )
    )


def describe_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(file, header, multi_line) per file, from one pass over the lines as text.

    A quoted line break leaves its line with an odd number of quotes. The header is the first
    line of the block that starts a file: a block's lines are read in order by one task.
    """
    first_line = F.when(F.col("block") == 0, F.struct("place", "value"))
    return _lines(spark, paths).groupBy("file").agg(
        F.min(first_line)["value"].alias("header"),
        F.bool_or(_odd_quotes(F.col("value"))).alias("multi_line"),
    )


def _names(header: str) -> tuple[str, ...]:
    """Column names as the rules know them: trimmed, in lower case."""
    return tuple(
        name.strip().strip(QUOTE).strip().lower() for name in header.strip("\r\ufeff").split(SEPARATOR)
    )


def _missing(names: Sequence[str]) -> str | None:
    absent = [c for c in S.RAW_COLUMNS if c not in names]
    return f"{NO_COLUMN} {', '.join(absent)}" if absent else None


def faults(described: DataFrame) -> DataFrame:
    """(file, reason) of files that cannot be read, because their header lacks a column."""
    names = F.transform(
        F.split(F.lower(F.regexp_replace(F.coalesce("header", F.lit("")), "[\\r\ufeff]", "")), SEPARATOR),
        lambda n: F.trim(F.replace(n, F.lit(QUOTE), F.lit(""))),
    )
    absent = F.array_except(F.array(*map(F.lit, S.RAW_COLUMNS)), names)
    reason = F.concat(F.lit(f"{NO_COLUMN} "), F.array_join(absent, ", "))
    return described.where(F.size(absent) > 0).select("file", reason.alias("reason"))


def read_files(spark: SparkSession, paths: str | Sequence[str]) -> tuple[DataFrame | None, dict[str, str]]:
    """Every CSV file below a folder or in a list, columns aligned by name whatever their case; and files refused.

    Files are grouped by header and by content: those without quoted line breaks are split by Spark,
    the others are read whole, at any size. What comes to the driver is the file list, which any scan
    needs there anyway. A file that lacks a column is refused, with the reason; no rows at all give None.
    """
    groups: dict[tuple, list[str]] = {}
    refused: dict[str, str] = {}
    for row in describe_files(spark, paths).toLocalIterator():
        names, file = _names(row["header"] or ""), unquote(row["file"])
        if reason := _missing(names):
            refused[file] = reason
        else:
            groups.setdefault((names, row["multi_line"]), []).append(file)
    scans = [
        scan(spark, sorted(files), names, multi_line=multi_line).select(
            *S.RAW_COLUMNS, RECORD, COLUMNS, S.FILE_COLUMN)
        for (names, multi_line), files in sorted(groups.items())
    ]
    return (reduce(DataFrame.unionByName, scans) if scans else None), refused


def read_folder(spark: SparkSession, path: str) -> DataFrame:
    """Every CSV file below a folder (see `read_files`); a file that lacks a column is an error."""
    rows, refused = read_files(spark, path)
    for file, reason in sorted(refused.items()):
        raise ValueError(f"{file}: {reason}")
    if rows is None:
        raise FileNotFoundError(f"no CSV file below {path}")
    return rows


def write_folder(raw: DataFrame, path: str, columns: Sequence[str] = S.RAW_COLUMNS) -> None:
    """Write raw rows as CSV, in one directory per source file name.

    The directory carries the name the rows came from, so a large source may be many files.
    """
    prepare(raw.sparkSession)
    (
        raw.select(*columns, F.substring_index(S.FILE_COLUMN, "/", -1).alias("arquivo"))
        .hint("rebalance", "arquivo")
        .write.mode("append")
        .partitionBy("arquivo")
        .option("header", True)
        .option("delimiter", SEPARATOR)
        .option("encoding", CHARSET)
        .option("quote", QUOTE)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_lines(lines: DataFrame, path: str, columns: Sequence[str] = S.RAW_COLUMNS) -> None:
    """Write records given as text (value, FILE_COLUMN) as they are, laid out as by `write_folder`.

    Each file begins with a header, so files can hold records that no CSV writer would give.
    """
    prepare(lines.sparkSession)
    named = lines.select("value", F.substring_index(S.FILE_COLUMN, "/", -1).alias("arquivo"))
    # one column and no quoting: Spark's writer then puts out the text itself, under the header it is given
    (
        named.withColumnRenamed("value", SEPARATOR.join(columns))
        .hint("rebalance", "arquivo")
        .write.mode("append")
        .partitionBy("arquivo")
        .option("header", True)
        .option("delimiter", "\x01")
        .option("encoding", CHARSET)
        .option("quote", "\x00")
        .option("escape", "\x00")
        .option("escapeQuotes", False)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
