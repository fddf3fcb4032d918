"""Business measures under a filter context, KPI against a goal, drill-down and rankings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def apply_slicers(df: DataFrame, slicers: Mapping[str, Sequence] | None) -> DataFrame:
    """Keep rows whose columns hold one of the selected values."""
    for column, values in (slicers or {}).items():
        df = df.where(F.col(column).isin(*values))
    return df


def measures(df: DataFrame, definitions: Mapping[str, Column], by: Sequence[str] = (),
             slicers: Mapping[str, Sequence] | None = None) -> DataFrame:
    """Every measure recomputed for the selected rows, per group if asked."""
    columns = [m.alias(name) for name, m in definitions.items()]
    chosen = apply_slicers(df, slicers)
    return chosen.groupBy(*by).agg(*columns) if by else chosen.agg(*columns)


def flight_measures(revenue: str = "ticket_price_usd", delay: str = "delay_min") -> dict[str, Column]:
    """Flights, revenue and mean delay; cancelled flights have no delay and do not count in it."""
    return {
        "total_vuelos": F.count(F.lit(1)),
        "ingresos_totales_usd": F.sum(revenue),
        "promedio_retraso_min": F.avg(delay),
    }


def kpi_status(df: DataFrame, value: str, goal: float = 15.0) -> DataFrame:
    """Traffic light where low is good, and the distance to the goal in percent of it."""
    v = F.col(value)
    return df.withColumns({
        "meta": F.lit(float(goal)),
        "estado_kpi": F.when(v <= goal, "verde").when(v > goal, "rojo"),
        "variacion_pct": F.round(100 * (F.lit(float(goal)) - v) / F.lit(float(goal)), 2),
    })


def drill_down(df: DataFrame, levels: Sequence[str], definitions: Mapping[str, Column],
               keep: Column | None = None) -> DataFrame:
    """Subtotals along a hierarchy; ``nivel`` counts how many levels a row is drilled into."""
    rows = df if keep is None else df.where(keep)
    depth = F.lit(0)
    for level in levels:
        depth = depth + (1 - F.grouping(level).cast("int"))
    return rows.rollup(*levels).agg(
        depth.alias("nivel"), *[m.alias(name) for name, m in definitions.items()])


def ranking(df: DataFrame, by: Sequence[str], measure: Column, out: str, n: int | None = None) -> DataFrame:
    """Groups by falling measure; ties go by group name."""
    ranked = df.groupBy(*by).agg(measure.alias(out)).orderBy(F.desc(out), *by)
    return ranked.limit(n) if n else ranked
