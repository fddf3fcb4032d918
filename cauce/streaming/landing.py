"""The file landing of ``cauce.sources.files`` over a folder that keeps receiving files."""

from __future__ import annotations

from pyspark.sql import SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from cauce.sources.files import CSV_OPTIONS, FileSpec, land_csv, text_schema


def land_arriving(spark: SparkSession, folder: str, spec: FileSpec, target: str, checkpoint: str) -> StreamingQuery:
    """Land the files that came since the last run, each exactly once, then stop.

    ``spec.columns`` must name the columns, since a stream does not look into its files first.
    """
    if spec.columns is None:
        raise ValueError("a streamed file needs its column names")
    arriving = spark.readStream.schema(text_schema(spec.columns)).options(
        **CSV_OPTIONS, multiLine="true", enforceSchema="false").csv(folder)
    landed = land_csv(arriving, spec.date_cols).withColumn("_extracted_at", F.current_timestamp())
    return (
        landed.writeStream.format("parquet").outputMode("append")
        .option("path", target).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
