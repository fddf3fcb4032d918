"""Lookups, role-playing dimensions, key resolution and orphan counts.

No join here carries a broadcast hint: Spark broadcasts a side whose size estimate is under
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, splitting skewed keys at run time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from cauce.sources.scratch import materialise


#: A side of at most so many rows is sent to every task instead of being shuffled.
SMALL_SIDE = 100_000


def small_side(df: DataFrame, most: int = SMALL_SIDE) -> DataFrame:
    """Write an aggregated side once and count it: broadcast if it is small, else a plain side.

    A side made by an aggregate carries the estimate of its input, so Spark would shuffle the big
    side by the few keys of the small one.
    """
    side = materialise(df, "side")
    return F.broadcast(side) if side.count() <= most else side


def lookup_label(df: DataFrame, dim: DataFrame, on: str, dim_key: str, label: str, out: str,
                 default: str | None = None) -> DataFrame:
    """Left lookup of one label, with a default where the dimension has no row or no label."""
    side = dim.select(F.col(dim_key).alias("_key"), F.col(label).alias("_label"))
    found = F.col("_label") if default is None else F.coalesce("_label", F.lit(default))
    return (
        df.join(side, F.col(on) == F.col("_key"), "left")
        .withColumn(out, found).drop("_key", "_label")
    )


def role_play(df: DataFrame, dim: DataFrame, dim_key: str, roles: Mapping[str, Mapping[str, str]],
              how: str = "left") -> DataFrame:
    """Join one dimension once per role.

    ``roles`` maps a fact column to ``{dimension column: output column}``.
    """
    for column, outputs in roles.items():
        side = dim.select(F.col(dim_key).alias("_key"),
                          *[F.col(c).alias(o) for c, o in outputs.items()])
        df = df.join(side, F.col(column) == F.col("_key"), how).drop("_key")
    return df


@dataclass(frozen=True)
class KeyLookup:
    """Where one surrogate key of a fact comes from."""

    column: str
    dim: DataFrame
    business_key: str
    surrogate: str
    out: str


def resolve_keys(df: DataFrame, lookups: Sequence[KeyLookup], on_missing: str = "null") -> DataFrame:
    """Add the surrogate key of every lookup.

    With ``on_missing="error"`` a value without a dimension row fails the job that meets it.
    """
    if on_missing not in ("null", "error"):
        raise ValueError(f"on_missing must be 'null' or 'error', not {on_missing!r}")
    for item in lookups:
        side = item.dim.select(F.col(item.business_key).alias("_key"),
                               F.col(item.surrogate).alias("_surrogate"))
        df = df.join(side, F.col(item.column) == F.col("_key"), "left")
        key = F.col("_surrogate")
        if on_missing == "error":
            message = F.concat(F.lit(f"{item.out}: no dimension row for "),
                               F.coalesce(F.col(item.column).cast("string"), F.lit("NULL")))
            key = F.when(key.isNotNull(), key).otherwise(F.raise_error(message).cast("long"))
        df = df.withColumn(item.out, key).drop("_key", "_surrogate")
    return df


def count_orphans(child: DataFrame, parent: DataFrame, column: str, parent_key: str,
                  out: str) -> DataFrame:
    """Child rows without a parent; a NULL key counts as an orphan.

    Keys are counted before the join, so a key that many rows share crosses the network once.
    """
    keys = child.groupBy(F.col(column).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    parents = parent.select(F.col(parent_key).alias("_parent")).distinct()
    lost = keys.join(parents, F.col("_key") == F.col("_parent"), "left_anti")
    return lost.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias(out))


def attach_scalars(df: DataFrame, values: Mapping[str, DataFrame]) -> DataFrame:
    """Add one column per one-cell DataFrame, as scalar subqueries."""
    return df.withColumns({name: one.scalar() for name, one in values.items()})


def one_row(spark, values: Mapping[str, DataFrame]) -> DataFrame:
    """A single row made of one-cell DataFrames."""
    return spark.range(1).select(*[one.scalar().alias(name) for name, one in values.items()])


def changed(pairs: Sequence[tuple[Column, Column]]) -> Column:
    """True where any pair differs; two NULLs are equal."""
    result = F.lit(False)
    for old, new in pairs:
        result = result | ~old.eqNullSafe(new)
    return result


def join_null_safe(df: DataFrame, side: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which NULL meets NULL; the side's key columns are left out."""
    named = side.select(*[F.col(c).alias(f"_same_{c}") if c in keys else F.col(c) for c in side.columns])
    same = F.lit(True)
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"_same_{c}"))
    return df.join(named, same, how).drop(*[f"_same_{c}" for c in keys])
