"""Durable intermediate tables, so that a lost executor never changes a result."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dir: str | None = None
#: Applications and the folders that were found to be shared in them.
_shared: set[tuple[str, str]] = set()
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a temporary one only on local masters.

    On a cluster whose default file system is the machines' own, a path without a scheme may be a mount that
    all of them share or a folder of each: it is tried once a session, and refused if rows get lost there.
    """
    global _local_dir
    context = spark.sparkContext
    named = (
        spark.conf.get("spark.checkpoint.dir", None)
        or context.getConf().get("spark.checkpoint.dir")
        or context.getCheckpointDir()
    )
    local = re.match(r"local(\[|$)", context.master)
    if named:
        if not local and ":" not in named and _default_scheme(spark) == "file" and (context.applicationId, named) not in _shared:
            if not _keeps_rows(spark, named):
                raise RuntimeError(f"{named} is a folder of one machine: name a folder in spark.checkpoint.dir that all executors share")
            _shared.add((context.applicationId, named))
        return named
    if not local:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="cauce-scratch-")
    return _local_dir


def _default_scheme(spark: SparkSession) -> str:
    hadoop = spark._jsparkSession.sessionState().newHadoopConf()
    return spark._jvm.org.apache.hadoop.fs.FileSystem.getDefaultUri(hadoop).getScheme()


def _keeps_rows(spark: SparkSession, folder: str) -> bool:
    """Whether rows that tasks write there are found again; a write to folders of several machines ends well and loses them."""
    path = f"{folder}/probe-{uuid.uuid4().hex}"
    tasks = 2 * spark.sparkContext.defaultParallelism
    spark.range(0, tasks, 1, tasks).write.parquet(path)
    kept = spark.read.schema("id long").parquet(path).count()
    remove(spark, path)
    return kept == tasks


def new_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def _without_leftovers(spark: SparkSession):
    """Let a finished write drop its shuffle files at once: its rows are in the shared folder."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def materialise(df: DataFrame, label: str = "table") -> DataFrame:
    """Write the rows once as Parquet in the shared folder and read them back."""
    spark = df.sparkSession
    path = new_path(spark, label)
    with _without_leftovers(spark):
        df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._scratch_path = path
    return table


def release(table: DataFrame) -> None:
    """Remove a table of ``materialise`` once nothing reads it any more; other tables are left alone."""
    path = getattr(table, "_scratch_path", None)
    if path is None:
        return
    remove(table.sparkSession, path)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that ``new_path`` named."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)
