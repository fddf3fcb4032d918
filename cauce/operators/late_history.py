"""A history-keeping dimension for rows that arrive in any order, of which a batch rewrites only what it touches.

A row says what a key looked like at a time. All rows are kept, also those that change nothing, since a
late row between two equal ones makes a change of the second. Keys are hashed into buckets; a batch reads
and writes the buckets of its keys, and one pointer switch publishes them together.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

from cauce.sources.publish import publications, publish, published, read_text, replace_text
from cauce.sources.scratch import materialise, release

_BUCKET = "history_bucket"


def versions(rows: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """``rows`` with ``opens, version, valid_to``: which of them start a version, its number, and its end.

    ``(key, at)`` is unique. Rows are cut into slices by key and time, so that a key of any number of
    rows is spread: what a slice needs of the others (the value before it, the versions before it, the
    next change after it) is a window over one row per key and slice. NULL is a key and a value like others.
    """
    sliced = materialise(rows.repartitionByRange(key, at).withColumn("_slice", F.spark_partition_id()), "slices")
    group = lambda df, side: (df["_slice"] == side["_at_slice"]) & df[key].eqNullSafe(side["_at_key"])
    same = [F.col("_slice").alias("_at_slice"), F.col(key).alias("_at_key")]
    inside, across = Window.partitionBy("_slice", key).orderBy(at), Window.partitionBy("_at_key").orderBy("_at_slice")
    ahead = (1, Window.unboundedFollowing)

    last = sliced.groupBy(*same).agg(F.max_by(F.struct(value), at).alias("_last"))
    before = last.select("_at_slice", "_at_key", F.lag("_last").over(across).alias("_before"))
    joined = sliced.join(before, group(sliced, before))
    previous = F.when(F.row_number().over(inside) == 1, F.col("_before")).otherwise(F.lag(F.struct(value)).over(inside))
    opened = materialise(joined.withColumn("_previous", previous).withColumn(
        "opens", F.col("_previous").isNull() | ~F.col(f"_previous.{value}").eqNullSafe(F.col(value))).select(*rows.columns, "_slice", "opens"), "opened")

    starts = F.when(F.col("opens"), F.col(at))
    counted = opened.groupBy(*same).agg(F.count_if("opens").alias("_n"), F.min(starts).alias("_first"))
    around = counted.select(
        "_at_slice", "_at_key",
        F.coalesce(F.sum("_n").over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_earlier"),
        F.min("_first").over(across.rowsBetween(*ahead)).alias("_next"))
    number = F.col("_earlier") + F.count_if("opens").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    end = F.coalesce(F.min(starts).over(inside.rowsBetween(*ahead)), F.col("_next"))
    out = opened.join(around, group(opened, around)).select(*rows.columns, "opens", number.cast("int").alias("version"), end.alias("valid_to"))
    out._slices = (sliced, opened)
    return out


class LateHistory:
    """The dimension under ``root``: ``apply`` batches in any order, read it as ``dimension``.

    Of two rows of one key and time that of the later batch stands, in one batch the greater
    one by its attributes. Rows without a time are refused. A batch that fails leaves the published
    dimension, and may be applied again; one that is applied twice changes nothing. One writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str, key: str, attributes: Sequence[str], at: str, buckets: int = 64):
        self.spark, self.root, self.key, self.at = spark, root.rstrip("/"), key, at
        self.attributes, self.buckets = list(attributes), buckets
        facts = json.dumps([key, self.attributes, at, buckets])
        held = read_text(spark, f"{self.root}/_history.json")
        if held is None:
            replace_text(spark, f"{self.root}/_history.json", facts)
        elif held != facts:
            raise ValueError(f"the history at {root} is of {held}")

    def _observed(self, buckets: Sequence[int] | None = None) -> DataFrame | None:
        """All rows of the given buckets with the versions that they open; None before any batch."""
        paths = published(self.spark, self.root)
        chosen = [path for name, path in paths.items() if buckets is None or int(name.removeprefix("bucket-")) in buckets]
        return self.spark.read.schema(StructType.fromJson(json.loads(read_text(self.spark, f"{self.root}/_schema.json")))).parquet(*chosen) if chosen else None

    def apply(self, batch: DataFrame) -> list[int]:
        """Take a batch in; gives the buckets that were rewritten."""
        number = publications(self.spark, self.root) + 1
        new = batch.select(F.col(self.key), F.col(self.at), F.struct(*self.attributes).alias("value"), F.lit(number).cast("long").alias("batch"))
        new = materialise(new.groupBy(self.key, self.at).agg(F.max("batch").alias("batch"), F.max("value").alias("value")), "batch")
        if new.where(F.col(self.at).isNull()).limit(1).count():
            raise ValueError(f"rows without {self.at}")
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")
        touched = sorted(r[0] for r in new.select(bucket).distinct().collect())  # at most the number of buckets
        if not touched:
            return []
        held = self._observed(touched)
        rows = new.select(self.key, self.at, "batch", "value")
        if held is not None:
            both = held.select(self.key, self.at, "batch", "value").unionByName(rows)
            rows = both.groupBy(self.key, self.at).agg(F.max(F.struct("batch", "value")).alias("_r")).select(self.key, self.at, "_r.*")
        numbered = versions(rows, self.key, self.at, "value")
        path = f"{self.root}/history/{uuid.uuid4().hex}"
        placed = numbered.withColumn(_BUCKET, bucket).repartitionByRange(_BUCKET, F.xxhash64(self.key), self.at)
        placed.sortWithinPartitions(_BUCKET).write.partitionBy(_BUCKET).parquet(path)
        for table in (new, *numbered._slices):
            release(table)
        kept = StructType([StructField(self.key, numbered.schema[self.key].dataType), StructField(self.at, numbered.schema[self.at].dataType),
                           StructField("batch", LongType()), StructField("value", numbered.schema["value"].dataType), StructField("opens", BooleanType()),
                           StructField("version", IntegerType()), StructField("valid_to", numbered.schema[self.at].dataType)])
        replace_text(self.spark, f"{self.root}/_schema.json", json.dumps(kept.jsonValue()))
        publish(self.spark, self.root, {f"bucket-{b}": f"{path}/{_BUCKET}={b}" for b in touched})
        return touched

    def dimension(self) -> DataFrame | None:
        """``key``, attributes, ``version, valid_from, valid_to, is_current``; None before any batch."""
        rows = self._observed()
        return rows if rows is None else rows.where("opens").select(
            self.key, *[F.col("value")[a].alias(a) for a in self.attributes], "version", F.col(self.at).alias("valid_from"),
            "valid_to", F.col("valid_to").isNull().alias("is_current"))
