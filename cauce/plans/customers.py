"""Dirty customer list: cleaning and before/after tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from cauce.functions.casts import parse_decimal
from cauce.functions.dates import parse_mixed_date
from cauce.functions.text import blank_to_null, normalize_code, normalize_name, strip_all, title_case
from cauce.operators.aggregates import pivot_table
from cauce.operators.joins import small_side
from cauce.operators.quantiles import exact_median
from cauce.operators.rows import distinct_rows
from cauce.sources.scratch import materialise

# Accepted codes and the words for a missing one.
GENDERS = ("M", "F")
GENDER_UNKNOWN = "No especificado"
CITY_UNKNOWN = "Sin Dato"
CATEGORIES = ("Education", "Food", "Retail", "Services")


def impute_by_group(df: DataFrame, value: str, group: str) -> DataFrame:
    """NULL values become their group's median, then the median of what is filled by then.

    Rows without a group lose their value first, as a grouped transform in pandas does, and so
    take the overall median. The input is written once, as it is read three times.
    """
    df = materialise(df, "unfilled")
    medians = exact_median(df, value, "_median", [group])
    grouped = df.join(small_side(medians), group, "left").withColumn(
        value, F.when(F.col(group).isNotNull(), F.coalesce(value, "_median"))).drop("_median")
    overall = exact_median(grouped, value, "_overall").scalar()
    return grouped.withColumn(value, F.coalesce(F.col(value), overall)).select(df.columns)


def standardize_customers(raw: DataFrame) -> DataFrame:
    """Distinct rows with normal names, codes, dates and numbers; missing amounts stay NULL."""
    gender = normalize_code(F.col("genero"))
    return distinct_rows(raw).withColumns({
        "nombre": normalize_name(F.col("nombre")),
        "genero": F.when(gender.isin(*GENDERS), gender).otherwise(F.lit(GENDER_UNKNOWN)),
        "ciudad": F.coalesce(blank_to_null(normalize_name(F.col("ciudad"))), F.lit(CITY_UNKNOWN)),
        "categoria": title_case(strip_all(F.col("categoria"))),
        "fecha_registro": parse_mixed_date(F.col("fecha_registro")),
        "gasto_q": parse_decimal(F.col("gasto_q")),
    })


def clean_customers(raw: DataFrame, digits: int = 2) -> DataFrame:
    """The whole cleaning: standardise, fill missing amounts by category, round."""
    filled = impute_by_group(standardize_customers(raw), "gasto_q", "categoria")
    return filled.withColumn("gasto_q", F.bround("gasto_q", digits))


def pivot_categories(df: DataFrame, known: Sequence[str] = CATEGORIES, most: int = 1000) -> list[str]:
    """The usual categories and whatever others the data hold; more than ``most`` are refused."""
    found = [r[0] for r in df.where(F.col("categoria").isNotNull()).select("categoria").distinct().limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"a pivot over more than {most} categories")
    return [*known, *sorted(set(found) - set(known))]


def count_pivot(df: DataFrame, categories: Sequence[str] | None = None) -> DataFrame:
    return pivot_table(df, "ciudad", "categoria", categories or pivot_categories(df), F.count("id_cliente"))


def spend_pivot(df: DataFrame, categories: Sequence[str] | None = None) -> DataFrame:
    return pivot_table(df, "ciudad", "categoria", categories or pivot_categories(df), F.round(F.avg("gasto_q"), 2), 0.0)
