"""Dimension tables with dense surrogate keys that stay fixed across loads."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from cauce.functions.casts import safe_int
from cauce.functions.dates import date_key, day_name_es, iso_weekday, month_name_es
from cauce.operators.order import number_rows, running_total
from cauce.operators.rows import keep_first, stacked_distinct
from cauce.sources.scratch import materialise


def _add_new(rows: DataFrame, key: str, surrogate: str, existing: DataFrame | None) -> DataFrame:
    """Existing rows plus numbered new ones; ``rows`` holds one row per business key."""
    columns = [surrogate, *rows.columns]
    if existing is None:
        return number_rows(rows, [key], surrogate).select(columns)
    unseen = rows.join(existing.select(key), key, "left_anti")
    top = existing.agg(F.coalesce(F.max(surrogate), F.lit(0))).scalar()
    added = number_rows(unseen, [key], surrogate, start=top).select(columns)
    return existing.select(columns).unionByName(added)


def build_simple_dim(values: DataFrame, column: str, surrogate: str,
                     existing: DataFrame | None = None, business: str | None = None) -> DataFrame:
    """Distinct non-null values of a column; unseen ones are numbered in sorted order."""
    business = business or column
    found = values.select(F.col(column).alias(business)).where(F.col(business).isNotNull()).distinct()
    return _add_new(found, business, surrogate, existing)


@dataclass(frozen=True)
class ValueDim:
    """A dimension of the distinct values of one or more columns of the same meaning."""

    columns: tuple[str, ...]
    business: str
    surrogate: str


def build_value_dims(df: DataFrame, specs: Mapping[str, ValueDim],
                     existing: Mapping[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Many value dimensions from a single scan of the source.

    All values are stacked as (dimension, value), made distinct, and those not yet known are
    numbered per dimension in the order of the typed values, after the highest known key.
    """
    known = {name: dim for name, dim in (existing or {}).items() if name in specs}
    def place(c: str) -> Column:
        """Where a value stands among the others: numbers by size, all else by its text."""
        number = isinstance(df.schema[c].dataType, T.NumericType)
        return (F.col(c).try_cast("decimal(38,9)") if number else F.lit(None).cast("decimal(38,9)")).alias("_place")

    cells = [F.struct(F.lit(name).alias("_dim"), F.col(c).cast("string").alias("_value"), place(c))
             for name, spec in specs.items() for c in spec.columns]
    values = df.select(F.explode(F.array(*cells)).alias("_c")).select("_c.*").where(
        F.col("_value").isNotNull()).distinct()
    for name, dim in known.items():
        seen = dim.select(F.lit(name).alias("_dim"), F.col(specs[name].business).cast("string").alias("_value"))
        values = values.join(seen, ["_dim", "_value"], "left_anti")
    numbered = materialise(running_total(values.withColumn("_one", F.lit(1).cast("long")), ["_place", "_value"],
                                         "_one", "_number", ["_dim"]), "dimensions")
    built = {}
    for name, spec in specs.items():
        columns = [spec.surrogate, spec.business]
        kind = df.schema[spec.columns[0]].dataType
        new = numbered.where(F.col("_dim") == name).select(
            F.col("_number").alias(spec.surrogate), F.col("_value").cast(kind).alias(spec.business))
        if name in known:
            top = known[name].agg(F.coalesce(F.max(spec.surrogate), F.lit(0))).scalar()
            shifted = new.withColumn(spec.surrogate, F.col(spec.surrogate) + top)
            new = known[name].select(columns).unionByName(shifted)
        built[name] = new
    return built


def build_pair_dim(df: DataFrame, code: str, name: str, surrogate: str,
                   existing: DataFrame | None = None, order: Sequence[str] = ()) -> DataFrame:
    """Code and name, one row per code; ``order`` says which row's name counts."""
    pairs = df.where(F.col(code).isNotNull()).select(code, name, *order)
    chosen = keep_first(pairs, [code], list(order)).select(code, name)
    return _add_new(chosen, code, surrogate, existing)


def build_role_dim(df: DataFrame, columns: Sequence[str], business: str, surrogate: str,
                   existing: DataFrame | None = None) -> DataFrame:
    """One dimension from several role columns, such as origin and destination."""
    return build_simple_dim(stacked_distinct(df, columns, business), business, surrogate, existing)


def calendar_attributes(days: DataFrame, day: str = "fecha") -> DataFrame:
    d = F.col(day)
    return days.select(
        date_key(d).alias("fecha_key"), d.alias("fecha"),
        F.year(d).alias("anio"), F.month(d).alias("mes"), month_name_es(d).alias("nombre_mes"),
        F.quarter(d).alias("trimestre"), F.dayofmonth(d).alias("dia"),
        iso_weekday(d).alias("dia_semana"), day_name_es(d).alias("nombre_dia_semana"),
        (iso_weekday(d) >= 6).alias("es_fin_semana"),
    )


def build_calendar(df: DataFrame, ts: str, existing: DataFrame | None = None) -> DataFrame:
    """Every day from the first to the last one seen; known days are kept as they are."""
    day = F.col(ts).cast("date")
    span = df.agg(F.min(day).alias("a"), F.max(day).alias("b")).where("a IS NOT NULL")
    calendar = calendar_attributes(span.select(F.explode(F.sequence("a", "b")).alias("fecha")))
    if existing is None:
        return calendar
    return existing.unionByName(calendar.join(existing.select("fecha_key"), "fecha_key", "left_anti"))


def build_observed_dates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only the days that occur in the given columns, with English day names."""
    days = stacked_distinct(df.select(*[F.col(c).cast("date").alias(c) for c in columns]),
                            columns, "Fecha")
    d = F.col("Fecha")
    return days.select(
        date_key(d).alias("Tiempo_SK"), d, F.year(d).alias("Anio"), F.month(d).alias("Mes"),
        F.dayofmonth(d).alias("Dia"), F.quarter(d).alias("Trimestre"),
        F.date_format(d, "EEEE").alias("DiaSemana"),
    )


def build_zone_dim(zones: DataFrame, zone_id: str = "zone_id", name: str = "zone_name",
                   borough: str = "borough") -> DataFrame:
    """Zone catalogue with integer ids; repeated ids stay and fan out where they are joined."""
    return zones.select(safe_int(F.col(zone_id)).alias("location_id"),
                        F.col(name).alias("zone"), F.col(borough).alias("borough"))
