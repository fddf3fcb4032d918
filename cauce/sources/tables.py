"""Table reads, writes, layouts and catalogue facts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cauce.sources.publish import replace_folder


def _filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def path_exists(spark: SparkSession, path: str) -> bool:
    filesystem, location = _filesystem(spark, path)
    return filesystem.exists(location)


def extract_full(spark: SparkSession, path: str) -> DataFrame:
    """Every row and column of a source table, column names lower-cased."""
    df = spark.read.parquet(path)
    return df.toDF(*[c.strip().lower() for c in df.columns])


def load_idempotent(df: DataFrame, path: str) -> None:
    """Replace the whole target; loading the same batch twice leaves one copy, and a failed load the old one.

    The batch may be read from the target itself.
    """
    replace_folder(df, path)


def append_load(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def create_empty_like(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """An empty table with the schema of ``df``."""
    writer = df.limit(0).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_mart(df: DataFrame, name: str, path: str | None = None) -> None:
    """Create or replace a catalogue table."""
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def define_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def export_csv(df: DataFrame, path: str) -> None:
    """Headed CSV with doubled quotes, as other readers expect it."""
    df.write.mode("overwrite").options(header="true", quote='"', escape='"').csv(path)


def export_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_partitioned(df: DataFrame, path: str, by: str, cluster: Sequence[str] = (),
                      files: int | None = None, block_bytes: int | None = None) -> None:
    """Partition folders by one column, rows clustered inside the files.

    Rows are range-partitioned by partition value, cluster columns and a row hash, so one hot
    day or zone spreads over several tasks and every file covers a narrow cluster range.
    """
    order = [F.col(by), *[F.col(c) for c in cluster]]
    spread = [*order, F.xxhash64(*df.columns)]
    ranged = df.repartitionByRange(files, *spread) if files else df.repartitionByRange(*spread)
    writer = ranged.sortWithinPartitions(*order).write.mode("overwrite").partitionBy(by)
    if block_bytes:
        writer = writer.option("parquet.block.size", block_bytes)
    writer.parquet(path)


def _place(value: Column, edges: Sequence) -> Column:
    """How many sorted edges are at most ``value``, by halving; NULL comes after all edges."""
    def among(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value < F.lit(edges[middle]), among(low, middle)).otherwise(among(middle + 1, high))

    return among(0, len(edges))


def interleaved_key(df: DataFrame, cluster: Sequence[str], bits: int = 6) -> Column:
    """Bits of the columns' quantile ranks in turn, so that rows near in the key are near in every column.

    Columns are numbers, dates or times. ``2 ** bits`` ranks of each come from one pass of approximate
    quantiles, so a column of uneven values is cut into even parts; a value that holds many rows has
    one rank. NULL has the last rank.
    """
    marks = F.lit([i / 2 ** bits for i in range(1, 2 ** bits)])
    found = df.agg(*[F.percentile_approx(c, marks, 20 << bits).alias(f"e{i}") for i, c in enumerate(cluster)]).first()
    ranks = [_place(F.col(c), sorted(set(edges or ()))) for c, edges in zip(cluster, found)]
    parts = [F.shiftleft(F.shiftright(rank, b).bitwiseAND(F.lit(1)).cast("long"), b * len(cluster) + i)
             for i, rank in enumerate(reversed(ranks)) for b in range(bits)]
    return reduce(lambda x, y: x.bitwiseOR(y), parts)


def write_clustered(df: DataFrame, path: str, cluster: Sequence[str], by: str | None = None, files: int | None = None,
                    block_bytes: int | None = None, bits: int = 6) -> None:
    """Rows clustered by several columns alike, within partition folders if ``by`` is given.

    Sorting by one column after the other lets statistics skip row groups for the first column only;
    here a filter on any of them skips most. A row hash spreads a hot cell over several files.
    """
    key = "_cluster_key"
    keyed = df.withColumn(key, interleaved_key(df, cluster, bits))
    order = [*([by] if by else []), key]
    spread = [*order, F.xxhash64(*df.columns)]
    ranged = keyed.repartitionByRange(files, *spread) if files else keyed.repartitionByRange(*spread)
    writer = ranged.sortWithinPartitions(*order).drop(key).write.mode("overwrite")
    if by:
        writer = writer.partitionBy(by)
    if block_bytes:
        writer = writer.option("parquet.block.size", block_bytes)
    writer.parquet(path)


def schema_table(df: DataFrame) -> DataFrame:
    """Position, name, type and nullability of every column."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable)
            for i, f in enumerate(df.schema.fields, start=1)]
    return df.sparkSession.createDataFrame(
        rows, "position int, column string, data_type string, is_nullable boolean")


def table_volume(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """Rows, bytes and GB of each table, with first and last file times."""
    parts = []
    for name, path in tables.items():
        per_file = (
            spark.read.parquet(path)
            .groupBy(F.col("_metadata.file_path").alias("file"))
            .agg(F.count(F.lit(1)).alias("n"),
                 F.max("_metadata.file_size").alias("size"),
                 F.max("_metadata.file_modification_time").alias("changed"))
        )
        parts.append(per_file.agg(
            F.lit(name).alias("table_name"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
            F.coalesce(F.sum("size"), F.lit(0)).alias("n_bytes"),
            F.round(F.coalesce(F.sum("size"), F.lit(0)) / F.lit(1024.0 ** 3), 2).alias("gb"),
            F.min("changed").alias("first_written"),
            F.max("changed").alias("last_written"),
        ))
    return reduce(DataFrame.unionByName, parts)


def partition_inventory(df: DataFrame, column: str) -> DataFrame:
    """Number of partitions, first and last one."""
    return df.agg(F.countDistinct(column).alias("n_partitions"),
                  F.min(column).alias("first_partition"),
                  F.max(column).alias("last_partition"))


def preview(df: DataFrame, columns: Sequence[str], n: int) -> DataFrame:
    """A few rows of a few columns."""
    return df.select(*columns).limit(n)


def inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table."""
    counts = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
              for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def ingest_freshness(tables: Mapping[str, DataFrame], audit: str = "_extracted_at") -> DataFrame:
    """Rows and latest load time per raw table, in table order."""
    parts = [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
               F.max(audit).alias("last_extracted"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts).orderBy("table_name")
