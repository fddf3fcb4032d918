"""Exact quantiles, overall or per group, for groups of any size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from cauce.operators.order import in_slices


def ordered_values(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Distinct values ``_v`` of each group with their count ``_n``, the rows up to them ``_upto``,
    the group's rows ``_size``, and the ``_slice`` they lie in; NULL values and groups are left out."""
    kept = df.select(*by, F.col(value).cast("double").alias("_v")).na.drop()
    counted = kept.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_n"))
    return in_slices(counted, ["_v"], "_n", "_upto", by, "_size")


def pick_quantiles(ordered: DataFrame, probabilities: Mapping[str, float], by: Sequence[str] = ()) -> DataFrame:
    """Linear-interpolated quantiles from ``ordered_values``, by one combining aggregate."""
    picks = []
    for i, p in enumerate(probabilities.values()):
        position = (F.col("_size") - 1) * F.lit(float(p))
        for side, at in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            picks.append(F.min(F.when(F.col("_upto") > at, F.col("_v"))).alias(f"_{side}{i}"))
        picks.append(F.max(position - F.floor(position)).alias(f"_part{i}"))
    return ordered.groupBy(*by).agg(*picks).select(*by, *[
        (F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_part{i}")).alias(name)
        for i, name in enumerate(probabilities)
    ])


def exact_quantiles(df: DataFrame, value: str, probabilities: Mapping[str, float],
                    by: Sequence[str] = ()) -> DataFrame:
    """Linear-interpolated quantiles; NULL values and NULL group keys are left out.

    Equal values are counted before anything is ordered. Sizes and shifts are joined by slice and
    group, and the picks combine before their shuffle, so a hot group never lands in one task.
    """
    return pick_quantiles(ordered_values(df, value, by), probabilities, list(by))


def exact_median(df: DataFrame, value: str, out: str, by: Sequence[str] = ()) -> DataFrame:
    return exact_quantiles(df, value, {out: 0.5}, by)
