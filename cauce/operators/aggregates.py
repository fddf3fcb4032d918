"""Profiles, distributions, pivots and chart tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cauce.functions.casts import steady_round
from cauce.operators.order import with_slice_facts
from cauce.operators.quantiles import exact_quantiles, ordered_values, pick_quantiles
from cauce.sources.scratch import materialise


def rounded_avg(column: str | Column, digits: int) -> Column:
    return steady_round(F.avg(column), digits)


def rounded_sum(column: str | Column, digits: int) -> Column:
    return steady_round(F.sum(column), digits)


def decimal_mean(column: Column, kind: str, digits: int = 2) -> Column:
    """Mean of exact numbers as a decimal, rounded once (a decimal ``avg`` would round twice)."""
    return F.round(F.sum(column).cast("double") / F.count(column), digits).cast(kind)


def rate_pct(condition: Column, digits: int = 2) -> Column:
    """Percentage of all rows for which the condition is true."""
    return F.round(100 * F.count_if(condition) / F.count(F.lit(1)), digits)


def share_of_total(df: DataFrame, value: str, out: str, digits: int = 2) -> DataFrame:
    """Percentage of the column total; the rows are written once, as they are read twice."""
    df = materialise(df, "shares")
    total = df.agg(F.sum(value)).scalar()
    return df.withColumn(out, steady_round(100 * F.col(value) / total, digits))


def distribution(df: DataFrame, key: str | Column, name: str, measures: Mapping[str, Column] | None = None,
                 n: str = "n", pct: str | None = "pct", null_label: str | None = None) -> DataFrame:
    """Row count per key with its share and further measures."""
    column = F.col(key) if isinstance(key, str) else key
    if null_label is not None:
        column = F.coalesce(column.cast("string"), F.lit(null_label))
    extra = [m.alias(out) for out, m in (measures or {}).items()]
    counts = df.groupBy(column.alias(name)).agg(F.count(F.lit(1)).alias(n), *extra)
    if pct is None:
        return counts
    counts = materialise(counts, "counts")  # the counts hold the total: the input is read once
    total = counts.agg(F.sum(n)).scalar()
    return counts.withColumn(pct, F.round(100 * F.col(n) / total, 2))


def value_counts(df: DataFrame, column: str, n: str = "n") -> DataFrame:
    """Frequency of each non-null value, most frequent first."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(n))
    return counts.orderBy(F.desc(n), column)


def mean_by(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Mean per non-null key, highest first."""
    means = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.avg(value).alias(out))
    return means.orderBy(F.desc(out), key)


def weighted_mean(df: DataFrame, by: Sequence[str], value: str, weight: str, out: str,
                  total: str, digits: int = 2) -> DataFrame:
    return df.groupBy(*by).agg(
        F.sum(weight).alias(total),
        steady_round(F.sum(F.col(weight) * F.col(value)) / F.sum(weight), digits).alias(out),
    )


def pivot_table(df: DataFrame, index: str, columns: str, categories: Sequence[str],
                measure: Column, fill=0) -> DataFrame:
    """One row per index value, one column per category; NULL keys are dropped, gaps filled."""
    kept = df.where(F.col(index).isNotNull() & F.col(columns).isNotNull())
    return kept.groupBy(index).pivot(columns, list(categories)).agg(measure).na.fill(fill)


def variant_table(df: DataFrame, key: str, variant: str, variants: Mapping[str, str],
                  measures: Sequence[str]) -> DataFrame:
    """Largest value of each measure per variant, side by side: ``<measure>_<suffix>``."""
    cells = [
        F.max(F.when(F.col(variant) == label, F.col(m))).alias(f"{m}_{suffix}")
        for m in measures for label, suffix in variants.items()
    ]
    return df.groupBy(key).agg(*cells)


def reduction_pct(before: Column, after: Column, digits: int = 2) -> Column:
    return F.round(100 * (1 - F.try_divide(after, before)), digits)


def _long(df: DataFrame, columns: Sequence[str], name: str, value: str, as_type: str) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast(as_type).alias(value))
                      for c in columns])
    return df.select(F.explode(cells).alias("_cell")).select("_cell.*")


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max of each column, one row per column."""
    cells = _long(df, columns, "variable", "v", "double")
    basics = cells.groupBy("variable").agg(
        F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev("v").alias("std"),
        F.min("v").alias("min"), F.max("v").alias("max"))
    quartiles = exact_quantiles(cells, "v", {"p25": 0.25, "p50": 0.5, "p75": 0.75}, ["variable"])
    return basics.join(quartiles, "variable", "left")


def null_profile(df: DataFrame, columns: Sequence[str] | None = None, only_positive: bool = True) -> DataFrame:
    """NULLs per column, counted in one pass."""
    names = list(columns or df.columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    profile = counts.unpivot([], names, "variable", "n_null")
    return profile.where("n_null > 0") if only_positive else profile


def domain_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-null values of each column in long form, with their counts."""
    cells = _long(df, columns, "variable", "value", "string").where(F.col("value").isNotNull())
    return cells.groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n"))


def duplicate_profile(df: DataFrame, key: str) -> DataFrame:
    """Rows, repeated whole rows, repeated keys (as pandas ``duplicated().sum()``) and distinct keys."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    by_key = groups.groupBy(key).agg(F.sum("_n").alias("_rows"), F.count(F.lit(1)).alias("_kinds"))
    return by_key.agg(
        F.sum("_rows").alias("n_rows"),
        (F.sum("_rows") - F.sum("_kinds")).alias("duplicate_rows"),
        (F.sum("_rows") - F.count(F.lit(1))).alias("duplicate_keys"),
        F.count(key).alias("distinct_keys"),
    )


def histogram(df: DataFrame, value: str, bins: int = 30) -> DataFrame:
    """Equal-width bins over the column's range, the last one closed; empty bins show 0."""
    v = F.col(value).cast("double")
    edges = df.agg(F.struct(F.min(v).alias("lo"), F.max(v).alias("hi"))).scalar()
    lo, hi = edges["lo"], edges["hi"]
    bounded = df.where(v.isNotNull()).select(v.alias("v"), edges.alias("_edges")).select(
        "v", F.col("_edges.lo").alias("_lo"), F.col("_edges.hi").alias("_hi"))
    position = F.when(F.col("_hi") > F.col("_lo"),
                      F.width_bucket("v", "_lo", "_hi", F.lit(bins))).otherwise(F.lit(1))
    counts = bounded.groupBy(F.least(position, F.lit(bins)).cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("_n"))
    frame = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    width = (hi - lo) / bins
    return frame.join(counts, "bin", "left").select(
        "bin",
        (lo + (F.col("bin") - 1) * width).alias("bin_from"),
        (lo + F.col("bin") * width).alias("bin_to"),
        F.coalesce("_n", F.lit(0)).alias("n"),
    )


def box_plot(df: DataFrame, by: str, value: str) -> DataFrame:
    """Quartiles, whiskers within 1.5 interquartile ranges, and the number of outliers."""
    ordered = materialise(ordered_values(df, value, [by]), "ordered-values")
    quartiles = materialise(pick_quantiles(ordered, {"q1": 0.25, "median": 0.5, "q3": 0.75}, [by]), "quartiles")
    fences = quartiles.withColumns({
        "_low": F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")),
        "_high": F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")),
    })
    # fences go to each slice of a group, and its values meet them there
    by_slice = ordered.select("_slice", by).distinct().join(fences.select(by, "_low", "_high"), by)
    v = F.col("_v")
    inside = v.between(F.col("_low"), F.col("_high"))
    spread = with_slice_facts(ordered, by_slice, [by]).groupBy(by).agg(
        F.min(F.when(inside, v)).alias("whisker_low"),
        F.max(F.when(inside, v)).alias("whisker_high"),
        F.sum(F.when(inside, F.lit(0)).otherwise(F.col("_n"))).alias("n_outliers"))
    return quartiles.join(spread, by)


def weekly_counts(df: DataFrame, day: str, out: str = "n") -> DataFrame:
    """Rows per week ending on Sunday; weeks without rows count 0."""
    week = F.date_add(F.trunc(F.col(day).cast("date"), "week"), 6)
    counts = df.where(F.col(day).isNotNull()).groupBy(week.alias("week")).agg(
        F.count(F.lit(1)).alias("_n"))
    span = counts.agg(F.min("week").alias("a"), F.max("week").alias("b")).where("a IS NOT NULL")
    weeks = span.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 7 DAYS"))).alias("week"))
    return weeks.join(counts, "week", "left").select("week", F.coalesce("_n", F.lit(0)).alias(out))


def coverage(df: DataFrame, ts: str) -> DataFrame:
    """First and last moment, days and months with rows, rows per day."""
    per_day = df.groupBy(F.to_date(ts).alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.min(ts).alias("first"), F.max(ts).alias("last"))
    return per_day.agg(
        F.min("first").alias("first_ts"), F.max("last").alias("last_ts"),
        F.count("day").alias("n_days"),
        F.countDistinct(F.month("day")).alias("n_months"),
        F.round(F.try_divide(F.sum("n"), F.count("day")), 0).alias("rows_per_day"),
    )


def union_aligned(parts: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by name; a column some part lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def error_metrics(prefix: str, actual: Column, predicted: Column, digits: int = 4) -> list[Column]:
    """RMSE, MAE and MAPE (in percent; rows with actual 0 carry no percentage)."""
    error = predicted - actual
    relative = F.try_divide(error, F.nullif(actual, F.lit(0)))
    return [
        steady_round(F.sqrt(F.avg(error * error)), digits).alias(f"rmse{prefix}"),
        steady_round(F.avg(F.abs(error)), digits).alias(f"mae{prefix}"),
        steady_round(100 * F.avg(F.abs(relative)), 2).alias(f"mape_pct{prefix}"),
    ]


def coverage_pct(actual: Column, low: Column, high: Column) -> Column:
    """Share of known actuals that lie within the interval, in percent."""
    return F.round(F.try_divide(100 * F.count_if(actual.between(low, high)), F.count(actual)), 2)
