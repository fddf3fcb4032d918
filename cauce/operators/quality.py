"""Quality checks. Each gives rows of (table, check, column, failures); one pass per table where possible."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def _line(table: str, check: str, column: str, failures: Column) -> list[Column]:
    return [F.lit(table).alias("table_name"), F.lit(check).alias("check_name"),
            F.lit(column).alias("column_name"), failures.cast("long").alias("failures")]


def check_unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """Number of non-null values that occur more than once."""
    repeated = (df.where(F.col(column).isNotNull()).groupBy(column)
                .agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"))
    return repeated.agg(F.count(F.lit(1)).alias("_f")).select(*_line(table, "unique", column, F.col("_f")))


def check_table(df: DataFrame, table: str, not_null: Sequence[str] = (),
                rules: Mapping[str, Column] | None = None) -> DataFrame:
    """NULLs of the given columns and rows that break each rule, all in one aggregate.

    An unknown rule outcome is no failure.
    """
    broken = {("not_null", c): F.col(c).isNull() for c in not_null}
    broken.update({("rule", name): condition for name, condition in (rules or {}).items()})
    counts = df.agg(*[F.count_if(condition).alias(f"_{i}") for i, condition in enumerate(broken.values())])
    lines = F.array(*[F.struct(*_line(table, check, column, F.col(f"_{i}")))
                      for i, (check, column) in enumerate(broken)])
    return counts.select(F.explode(lines).alias("_l")).select("_l.*")


def check_not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    return check_table(df, table, not_null=columns)


def check_rules(df: DataFrame, table: str, rules: Mapping[str, Column]) -> DataFrame:
    return check_table(df, table, rules=rules)


def check_relationship(child: DataFrame, table: str, column: str, parent: DataFrame,
                      parent_key: str) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    keys = (child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_key"))
            .agg(F.count(F.lit(1)).alias("_n")))
    parents = parent.select(F.col(parent_key).alias("_parent")).distinct()
    lost = keys.join(parents, F.col("_key") == F.col("_parent"), "left_anti")
    return lost.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_f")).select(
        *_line(table, "relationship", column, F.col("_f")))


def any_negative(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c) < 0 for c in columns])


def off_balance(gross: str, discount: str, net: str, tolerance: float = 0.05) -> Column:
    difference = F.abs(F.col(gross) - F.col(discount) - F.col(net))
    return difference > F.lit(tolerance).cast("decimal(10,4)")


def duplicate_keys(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows minus distinct keys, per table."""
    parts = [
        df.agg(F.lit(name).alias("table_name"),
               (F.count(F.lit(1)) - F.countDistinct(key)).alias("duplicate_keys"))
        for name, (df, key) in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def rule_profile(df: DataFrame, rules: Mapping[str, Column], total: str = "total_filas",
                 percentages: Mapping[str, Column] | None = None) -> DataFrame:
    """One row: how many rows meet each rule, and the share of some conditions, in one pass."""
    counts = [F.count_if(rule).alias(name) for name, rule in rules.items()]
    shares = [F.round(100 * F.count_if(c) / F.count(F.lit(1)), 2).alias(name)
              for name, c in (percentages or {}).items()]
    return df.agg(F.count(F.lit(1)).alias(total), *counts, *shares)


def retention(clean: DataFrame, raw: DataFrame) -> DataFrame:
    """Rows kept, rows before, rows dropped and percentage kept."""
    counts = clean.agg(F.count(F.lit(1)).alias("filas_limpias")).withColumn(
        "filas_publicas", raw.agg(F.count(F.lit(1))).scalar())
    kept, before = F.col("filas_limpias"), F.col("filas_publicas")
    return counts.select(kept, before, (before - kept).alias("filas_descartadas"),
                         F.round(100 * F.try_divide(kept, before), 2).alias("pct_conservado"))


def split_overlap(df: DataFrame, ts: str, split: str, out: str = "timestamps_en_dos_splits") -> DataFrame:
    """Moments that occur in more than one split; must be 0.

    A moment is in two splits when its least and greatest split differ, which needs no distinct
    aggregate and combines before the shuffle.
    """
    per_moment = df.groupBy(ts).agg(F.min(split).alias("_a"), F.max(split).alias("_b"))
    return per_moment.agg(F.count_if(F.col("_a") != F.col("_b")).alias(out))


def dq_report(checks: Sequence[DataFrame]) -> DataFrame:
    """All check lines with a pass mark."""
    lines = reduce(DataFrame.unionByName, checks)
    return lines.withColumn("passed", F.col("failures") == 0)
