"""Session settings, and the shared folder that written intermediate results go to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # a report page is dozens of generated classes; evicted ones are compiled and warmed up again
    "spark.sql.codegen.cache.maxEntries": "2000",
}
# What the work below needs of any session, also one that somebody else opened.
NEEDED = {
    # the raw files are Windows-1252, which is outside the short list Spark 4 reads by default
    "spark.sql.legacy.javaCharsets": "true",
    # HotSpot never compiles methods above 8,000 bytes of bytecode; the projections over some
    # forty text columns would be one such method and run interpreted, several times slower.
    # Past the limit Spark generates the same projection as many small methods instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A task that writes a few partition directories keeps a file open for each, up to this many, instead of sorting
    # its rows by directory first: the sort holds all rows of a task and spills. Past it the rest is sorted.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}

_local_roots: dict[str, str] = {}


def session(master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName("asfalto")
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **NEEDED, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> None:
    for name, value in NEEDED.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)


def shared_root(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir.

    Every executor must be able to read it, so only a local session, where driver and
    executors are one machine, may fall back on a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="asfalto-")
    return _local_roots[context.applicationId]


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_root(spark)}/asfalto/{spark.sparkContext.applicationId}"


def remove_staged(spark: SparkSession) -> None:
    """Delete everything this application has stored in the shared folder; for when its results are written elsewhere."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def new_folder(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing has used yet."""
    return f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"
