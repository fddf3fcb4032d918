"""History-keeping (type 2) dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from cauce.operators.joins import changed
from cauce.operators.order import number_rows
from cauce.operators.rows import keep_first
from cauce.sources.scratch import materialise


@dataclass(frozen=True)
class HistoryColumns:
    """Names of the bookkeeping columns."""

    surrogate: str = "pasajero_key"
    version: str = "version"
    valid_from: str = "fecha_inicio_validez"
    valid_to: str = "fecha_fin_validez"
    current: str = "es_actual"


@dataclass(frozen=True)
class HistoryMerge:
    """The rewritten dimension, and what the batch did to it."""

    dimension: DataFrame
    counts: DataFrame


def _opened(rows: DataFrame, key: str, attributes: Sequence[str], load_ts: datetime, version: Column,
            start, order: Sequence[str], names: HistoryColumns) -> DataFrame:
    """Numbered current versions that begin at the load time."""
    opened = rows.withColumns({
        names.version: version.cast("int"),
        names.valid_from: F.lit(load_ts).cast("timestamp"),
        names.valid_to: F.lit(None).cast("timestamp"),
        names.current: F.lit(True),
    })
    numbered = number_rows(opened, list(order), names.surrogate, start=start)
    return numbered.select(names.surrogate, key, *attributes, names.version, names.valid_from,
                           names.valid_to, names.current)


def merge_history(dimension: DataFrame | None, batch: DataFrame, key: str, attributes: Sequence[str],
                  load_ts: datetime, order: Sequence[str] = (),
                  names: HistoryColumns = HistoryColumns()) -> HistoryMerge:
    """New keys open version 1, changed keys close and open the next version, equal keys stay.

    The first row per key (by ``order``) stands for the batch. NULL attributes compare as equal
    to each other. The result is a whole new dimension: write it to a new place, never over the
    table it was read from.
    """
    incoming = keep_first(batch.select(key, *attributes, *[c for c in order if c != key]),
                          [key], list(order))
    number_order = [*order, key] if order else [key]
    if dimension is None:
        opened = _opened(incoming, key, attributes, load_ts, F.lit(1), 0, number_order, names)
        counts = incoming.agg(F.count(F.lit(1)).alias("inserted"), F.lit(0).cast("long").alias("changed"),
                              F.lit(0).cast("long").alias("unchanged"))
        return HistoryMerge(opened, counts)

    now = dimension.where(F.col(names.current)).select(
        F.col(key).alias("_key"), F.col(names.surrogate).alias("_surrogate"),
        F.col(names.version).alias("_version"),
        *[F.col(a).alias(f"_old_{a}") for a in attributes])
    differs = changed([(F.col(f"_old_{a}"), F.col(a)) for a in attributes])
    action = (F.when(F.col("_key").isNull(), "insert").when(differs, "change").otherwise("keep"))
    compared = materialise(
        incoming.join(now, F.col(key) == F.col("_key"), "left").withColumn("_action", action),
        "compared")

    to_open = compared.where("_action <> 'keep'")
    top = dimension.agg(F.coalesce(F.max(names.surrogate), F.lit(0))).scalar()
    opened = _opened(to_open, key, attributes, load_ts, F.coalesce(F.col("_version") + 1, F.lit(1)),
                     top, number_order, names)
    closing = compared.where("_action = 'change'").select(
        F.col("_surrogate").alias(names.surrogate), F.lit(True).alias("_closing"))
    closes = F.col("_closing").isNotNull()
    kept = dimension.join(closing, names.surrogate, "left").withColumns({
        names.valid_to: F.when(closes, F.lit(load_ts).cast("timestamp")).otherwise(F.col(names.valid_to)),
        names.current: F.when(closes, F.lit(False)).otherwise(F.col(names.current)),
    }).select(opened.columns)
    counts = compared.agg(
        F.count_if(F.col("_action") == "insert").alias("inserted"),
        F.count_if(F.col("_action") == "change").alias("changed"),
        F.count_if(F.col("_action") == "keep").alias("unchanged"))
    return HistoryMerge(kept.unionByName(opened), counts)


def current_versions(dimension: DataFrame, current: str = "es_actual") -> DataFrame:
    return dimension.where(F.col(current))


def versions_per_key(dimension: DataFrame, key: str, out: str = "versiones_historicas") -> DataFrame:
    """Keys with more than one version, most versions first."""
    counts = dimension.groupBy(key).agg(F.count(F.lit(1)).alias(out))
    return counts.where(F.col(out) > 1).orderBy(F.desc(out), key)
