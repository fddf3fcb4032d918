"""Delimited files in, cleaned landing tables out."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from cauce.functions.text import blank_to_null, strip_all
from cauce.sources.tables import load_idempotent, path_exists

log = logging.getLogger(__name__)

# Spellings of a missing value in landed text.
NULL_TOKENS = ("nan", "None", "")
DELIMITERS = (",", ";", "\t", "|")


#: CSV as other tools write it: quotes inside quotes are doubled, and quoted text may hold line breaks.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"'}


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
             sep: str = ",", multiline: bool = True) -> DataFrame:
    """Headed CSV as text columns only; typing is a later, explicit projection.

    ``columns`` are found by name, whatever their order in the file; one that the header lacks is an
    error, and so is a file whose header differs from the first one's. With ``multiline`` quoted text
    may hold line breaks, for which a file is read by one task: turn it off for huge files without.
    """
    def reader():
        return spark.read.options(**CSV_OPTIONS, sep=sep, multiLine=str(multiline).lower())

    found = reader().csv(path)
    if not found.columns and columns is not None:
        return spark.createDataFrame([], text_schema(columns))
    missing = [c for c in columns or () if c not in found.columns]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in {path}")
    whole = reader().option("enforceSchema", False).schema(text_schema(found.columns)).csv(path)
    return whole if columns is None else whole.select(*[F.col(f"`{c}`") for c in columns])


def sniff_delimiter(spark: SparkSession, path: str) -> str:
    """The candidate that occurs most often in the header line."""
    counts = [
        (F.length("value") - F.length(F.replace("value", F.lit(d)))).alias(f"d{i}")
        for i, d in enumerate(DELIMITERS)
    ]
    header = spark.read.text(path).limit(1).select(*counts).first()
    if header is None:
        return DELIMITERS[0]
    return DELIMITERS[max(range(len(DELIMITERS)), key=lambda i: (header[i], -i))]


def read_csv_sniffed(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    return read_csv(spark, path, columns, sep=sniff_delimiter(spark, path))


def with_file_order(df: DataFrame, name: str = "_file_order") -> DataFrame:
    """Column that sorts like the input: file, then block, then line within the block."""
    return df.withColumn(name, F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    ))


def clean_column_name(name: str) -> str:
    return name.strip().lower().replace(" ", "_")


#: Dates of landed text besides ISO, tried in turn; of two readings the month comes first.
DATE_FORMATS = ("M/d/yyyy", "d/M/yyyy", "M-d-yyyy", "d-M-yyyy", "yyyy/M/d", "MMM d yyyy", "MMM d, yyyy", "d MMM yyyy", "MMMM d, yyyy")


def parse_landed_date(text: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """The first form that reads the text as a date, else NULL."""
    read = [F.try_to_timestamp(text, F.lit(f)).cast("date") for f in formats]
    return F.coalesce(text.try_cast("date"), *read)


def land_csv(df: DataFrame, date_cols: Sequence[str] = (), date_formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """Clean column names, stripped text with missing tokens as NULL, dates or NULL."""
    df = df.toDF(*[clean_column_name(c) for c in df.columns])
    cleaned = []
    for field_ in df.schema.fields:
        column = F.col(f"`{field_.name}`")
        if isinstance(field_.dataType, T.StringType):
            column = blank_to_null(strip_all(column), NULL_TOKENS)
        if field_.name in date_cols:
            column = (parse_landed_date(column, date_formats) if isinstance(field_.dataType, T.StringType)
                      else column.try_cast("date"))
        cleaned.append(column.alias(field_.name))
    return df.select(*cleaned)


def with_audit(df: DataFrame, extracted_at: datetime, name: str = "_extracted_at") -> DataFrame:
    """One constant load time for the whole batch."""
    return df.withColumn(name, F.lit(extracted_at).cast("timestamp"))


@dataclass(frozen=True)
class FileSpec:
    """One landed file: its target table, its date columns, and whether a failure stops the load."""

    table: str
    date_cols: tuple[str, ...] = ()
    required: bool = True
    columns: tuple[str, ...] | None = field(default=None)


def land_file(spark: SparkSession, path: str, spec: FileSpec, extracted_at: datetime,
              sep: str = ",") -> DataFrame:
    raw = read_csv(spark, path, spec.columns, sep)
    return with_audit(land_csv(raw, spec.date_cols), extracted_at)


def load_file_map(spark: SparkSession, folder: str, specs: Mapping[str, FileSpec], target: str,
                  extracted_at: datetime) -> dict[str, str]:
    """Land every listed file under ``target``; a missing file is skipped with a warning.

    A missing folder is an error. A file that fails to load is an error too, unless its spec
    says it is not required. Returns table name -> written path.
    """
    if not path_exists(spark, folder):
        raise FileNotFoundError(f"data folder does not exist: {folder}")
    written = {}
    for filename, spec in specs.items():
        path = f"{folder.rstrip('/')}/{filename}"
        if not path_exists(spark, path):
            log.warning("file not found, skipped: %s", path)
            continue
        destination = f"{target.rstrip('/')}/{spec.table}"
        try:
            load_idempotent(land_file(spark, path, spec, extracted_at), destination)
        except Exception:
            if spec.required:
                raise
            log.exception("optional file could not be loaded: %s", path)
            continue
        written[spec.table] = destination
    return written
