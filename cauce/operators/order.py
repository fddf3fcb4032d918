"""Ordered work over whole tables without a single-task window: running totals, ranks, keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cauce.sources.scratch import materialise


def in_slices(df: DataFrame, order: Sequence[str], weight: str, out: str, by: Sequence[str] = (),
              total: str | None = None) -> DataFrame:
    """``running_total`` that keeps ``_slice``, and adds the group's whole sum as ``total`` if named.

    A group of any size lies in many slices, so a join on the slice and the group never brings a
    group together.
    """
    ranged = (
        df.repartitionByRange(*by, *order)
        .sortWithinPartitions(*by, *order)
        .withColumn("_slice", F.spark_partition_id())
    )
    fixed = materialise(ranged, "ordered")
    within = Window.partitionBy("_slice", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    group = Window.partitionBy(*(by or [F.lit(0)]))
    earlier = group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        fixed.groupBy("_slice", *by).agg(F.sum(weight).alias("_sum"))
        .withColumn("_shift", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
        .withColumn("_whole", F.sum("_sum").over(group)).drop("_sum")
    )
    extra = [F.col("_whole").alias(total)] if total else []
    return with_slice_facts(fixed.withColumn("_within", F.sum(weight).over(within)), shifts, by).select(
        *df.columns, "_slice", (F.col("_within") + F.col("_shift")).alias(out), *extra)


def with_slice_facts(sliced: DataFrame, facts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Join facts of each slice and group to its rows; NULL groups meet each other."""
    named = facts.select(*[F.col(c).alias(f"_fact_{c}") if c in ("_slice", *by) else c for c in facts.columns])
    same = F.lit(True)
    for c in ("_slice", *by):
        same = same & F.col(c).eqNullSafe(F.col(f"_fact_{c}"))
    return sliced.join(named, same).drop(*[f"_fact_{c}" for c in ("_slice", *by)])


def running_total(df: DataFrame, order: Sequence[str], weight: str, out: str,
                  by: Sequence[str] = ()) -> DataFrame:
    """Exact inclusive running sum of ``weight`` in ``order``, restarting for each ``by`` value.

    ``(by, order)`` must be unique. Rows are range-partitioned, so a group of any size spreads
    over many tasks; each slice is summed on its own and shifted by the total of the slices
    before it. The slices are written once, since partition bounds come from sampling and must
    not move between the two passes.
    """
    return in_slices(df, order, weight, out, by).drop("_slice")


def number_rows(df: DataFrame, order: Sequence[str], out: str, start: int | Column = 0) -> DataFrame:
    """Dense whole numbers ``start + 1, start + 2, ...`` in the given (unique) order."""
    base = start if isinstance(start, Column) else F.lit(start)
    numbered = running_total(df.withColumn("_one", F.lit(1).cast("long")), order, "_one", "_number")
    return numbered.withColumn(out, (base + F.col("_number")).cast("long")).drop("_one", "_number")


def rank_descending(df: DataFrame, value: str, out: str) -> DataFrame:
    """``RANK() OVER (ORDER BY value DESC)`` over rows of any number.

    The rows are written once; the order is worked out over their distinct values with row
    counts, then joined back.
    """
    df = materialise(df, "unranked")
    distinct = (
        df.groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_asc", F.struct(F.col(value).isNull().cast("int").alias("nulls"),
                                     (-F.col(value)).alias("v")))
    )
    ranked = running_total(distinct, ["_asc"], "_n", "_upto").select(
        F.col(value).alias("_value"), (F.col("_upto") - F.col("_n") + 1).alias(out))
    return df.join(ranked, F.col(value).eqNullSafe(F.col("_value")), "left").drop("_value")
