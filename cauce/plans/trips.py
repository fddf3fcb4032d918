"""Taxi trips: profile, clean, aggregate, rank."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cauce.functions.casts import code_between, safe_divide, safe_int, steady_round
from cauce.functions.dates import elapsed_minutes
from cauce.functions.maps import flag, label_codes
from cauce.operators.aggregates import (coverage, distribution, rate_pct, rounded_avg, rounded_sum,
                                        share_of_total, weighted_mean)
from cauce.operators.joins import attach_scalars, role_play
from cauce.operators.order import rank_descending
from cauce.operators.quality import rule_profile

# Payment codes and their labels.
PAYMENT_LABELS = {1: "Tarjeta de credito", 2: "Efectivo", 3: "Sin cargo", 4: "Disputa",
                  5: "Desconocido", 6: "Viaje anulado"}
PAYMENT_OTHER = "Otro"


@dataclass(frozen=True)
class TripRules:
    """Limits of the cleaning rules; every bound is inclusive."""

    minutes: tuple[int, int] = (1, 240)
    miles: tuple[float, float] = (0.1, 100)
    passengers: tuple[int, int] = (1, 9)
    fare: tuple[float, float] = (2.5, 500)
    total: tuple[float, float] = (2.5, 1000)
    zones: tuple[int, int] = (1, 265)
    codes: tuple[int, int] = (1, 6)
    years: tuple[int, int] = (2022, 2022)


def _minutes() -> Column:
    return elapsed_minutes(F.col("pickup_datetime"), F.col("dropoff_datetime"))


def _code(name: str) -> Column:
    return safe_int(F.col(name))


def cleaning_rules(rules: TripRules = TripRules()) -> dict[str, Column]:
    """What a usable trip must meet, by rule name; plain comparisons come first, text codes last."""
    col = F.col
    zones = [code_between(col(c), *rules.zones) for c in ("pickup_location_id", "dropoff_location_id")]
    codes = [code_between(col(c), *rules.codes) for c in ("rate_code", "payment_type")]
    return {
        "L2": col("trip_distance").between(*rules.miles),
        "L3": col("passenger_count").between(*rules.passengers),
        "L4": col("fare_amount").between(*rules.fare) & col("total_amount").between(*rules.total),
        "L5": (col("total_amount") >= col("fare_amount")) & (col("tip_amount") >= 0),
        "L7": F.year("pickup_datetime").between(*rules.years),
        "L1": (col("dropoff_datetime") > col("pickup_datetime")) & _minutes().between(*rules.minutes),
        "L6": reduce(lambda a, b: a & b, [*codes, *zones]),
    }


def typed_trips() -> list[Column]:
    """The 17 typed columns of a clean trip."""
    amounts = {n: F.col(n).cast("double")
               for n in ("trip_distance", "fare_amount", "extra", "tip_amount", "tolls_amount", "total_amount")}
    codes = {n: _code(n) for n in ("vendor_id", "rate_code", "payment_type",
                                   "pickup_location_id", "dropoff_location_id")}
    derived = {
        "pickup_date": F.to_date("pickup_datetime"),
        "trip_duration_minutes": _minutes(),
        "tip_ratio": safe_divide(amounts["tip_amount"], amounts["fare_amount"]),
    }
    kept = {n: F.col(n) for n in ("pickup_datetime", "dropoff_datetime", "passenger_count")}
    expressions = {**amounts, **codes, **derived, **kept}
    order = ("vendor_id", "pickup_datetime", "dropoff_datetime", "pickup_date", "passenger_count",
             "trip_distance", "rate_code", "payment_type", "fare_amount", "extra", "tip_amount",
             "tolls_amount", "total_amount", "pickup_location_id", "dropoff_location_id",
             "trip_duration_minutes", "tip_ratio")
    return [expressions[n].alias(n) for n in order]


def clean_trips(raw: DataFrame, rules: TripRules = TripRules()) -> DataFrame:
    """Typed trips that meet all rules; a rule that cannot be decided drops the row."""
    usable = reduce(lambda a, b: a & b, cleaning_rules(rules).values())
    return raw.where(usable).select(*typed_trips())


def quality_profile(raw: DataFrame, rules: TripRules = TripRules()) -> DataFrame:
    """All candidate rules counted in one scan, and three percentages."""
    col = F.col
    return rule_profile(raw, {
        "nulos_pickup": col("pickup_datetime").isNull(),
        "nulos_dropoff": col("dropoff_datetime").isNull(),
        "nulos_distancia": col("trip_distance").isNull(),
        "nulos_tarifa": col("fare_amount").isNull(),
        "nulos_total": col("total_amount").isNull(),
        "duracion_cero_o_negativa": col("dropoff_datetime") <= col("pickup_datetime"),
        "viajes_mas_de_4_horas": _minutes() > rules.minutes[1],
        "distancia_cero_o_negativa": col("trip_distance") <= 0,
        "distancia_mayor_100_mi": col("trip_distance") > rules.miles[1],
        "pasajeros_invalidos": (col("passenger_count") <= 0) | col("passenger_count").isNull(),
        "pasajeros_mayor_9": col("passenger_count") > rules.passengers[1],
        "tarifa_bajo_minimo_legal": col("fare_amount") < rules.fare[0],
        "tarifa_mayor_500": col("fare_amount") > rules.fare[1],
        "total_negativo": col("total_amount") < 0,
        "total_mayor_1000": col("total_amount") > rules.total[1],
        "propina_negativa": col("tip_amount") < 0,
        "rate_code_ilegible": _code("rate_code").isNull(),
        "rate_code_fuera_catalogo": ~_code("rate_code").between(*rules.codes),
        "payment_type_ilegible": _code("payment_type").isNull(),
        "payment_type_fuera_catalogo": ~_code("payment_type").between(*rules.codes),
        "nulos_zona_origen": col("pickup_location_id").isNull(),
        "nulos_zona_destino": col("dropoff_location_id").isNull(),
    }, percentages={
        "pct_pago_efectivo": _code("payment_type") == 2,
        "pct_tarifa_no_estandar": _code("rate_code") != 1,
        "pct_store_and_fwd": col("store_and_fwd_flag") == "Y",
    })


def rate_distribution(raw: DataFrame) -> DataFrame:
    return distribution(raw, "rate_code", "rate_code", {
        "tarifa_promedio": rounded_avg("fare_amount", 2),
        "distancia_promedio": rounded_avg("trip_distance", 2),
    }, n="viajes", null_label="NULL").orderBy(F.desc("viajes"), "rate_code")


def payment_distribution(raw: DataFrame) -> DataFrame:
    return distribution(raw, "payment_type", "payment_type", {
        "propina_promedio": rounded_avg("tip_amount", 3),
        "pct_con_propina": rate_pct(F.col("tip_amount") > 0),
    }, n="viajes", null_label="NULL").orderBy(F.desc("viajes"), "payment_type")


def trip_coverage(raw: DataFrame) -> DataFrame:
    return coverage(raw, "pickup_datetime").toDF(
        "primer_viaje", "ultimo_viaje", "dias_con_datos", "meses_cubiertos", "viajes_por_dia")


def monthly_share(raw: DataFrame) -> DataFrame:
    return distribution(raw, F.month("pickup_datetime"), "mes", n="viajes", pct="pct_del_anio").orderBy("mes")


def cast_integrity(trips: DataFrame) -> DataFrame:
    nulls = {"vendor_nulos": "vendor_id", "rate_code_nulos": "rate_code",
             "payment_type_nulos": "payment_type", "zona_origen_nulas": "pickup_location_id",
             "zona_destino_nulas": "dropoff_location_id"}
    codes = {"rate_codes_distintos": "rate_code", "payment_types_distintos": "payment_type"}
    return trips.agg(
        *[F.count_if(F.col(c).isNull()).alias(out) for out, c in nulls.items()],
        *[F.countDistinct(c).alias(out) for out, c in codes.items()],
        F.min("pickup_date").alias("desde"), F.max("pickup_date").alias("hasta"))


def _mph() -> Column:
    return safe_divide(F.col("trip_distance"), F.col("trip_duration_minutes") / 60)


def global_metrics(trips: DataFrame, accuracy: int = 10000) -> DataFrame:
    """Means, deviation and approximate percentiles of the clean table, in one pass."""
    means = {
        "fare_promedio": (F.col("fare_amount"), 2), "distancia_promedio_mi": (F.col("trip_distance"), 2),
        "duracion_promedio_min": (F.col("trip_duration_minutes"), 2),
        "velocidad_promedio_mph": (_mph(), 2), "tip_ratio_promedio": (F.col("tip_ratio"), 4),
        "pasajeros_promedio": (F.col("passenger_count"), 2), "total_promedio": (F.col("total_amount"), 2),
    }
    percentiles = {
        "fare_p50": ("fare_amount", 0.5), "fare_p90": ("fare_amount", 0.9), "fare_p99": ("fare_amount", 0.99),
        "distancia_p50": ("trip_distance", 0.5), "distancia_p95": ("trip_distance", 0.95),
        "duracion_p95": ("trip_duration_minutes", 0.95),
    }
    return trips.agg(
        F.count(F.lit(1)).alias("n_viajes"),
        steady_round(F.stddev("fare_amount"), 2).alias("fare_desviacion"),
        *[rounded_avg(c, d).alias(out) for out, (c, d) in means.items()],
        *[F.percentile_approx(c, p, accuracy).alias(out) for out, (c, p) in percentiles.items()])


def agg_daily(trips: DataFrame) -> DataFrame:
    """One row per day: volume, revenue, averages, active pick-up zones."""
    weekday = F.dayofweek("pickup_datetime")
    return trips.groupBy("pickup_date", weekday.alias("dow"),
                         flag(weekday.isin(1, 7)).alias("is_weekend")).agg(
        F.count(F.lit(1)).alias("trip_count"),
        rounded_sum("fare_amount", 2).alias("revenue_fare"),
        rounded_sum("total_amount", 2).alias("revenue_total"),
        rounded_sum("tip_amount", 2).alias("revenue_tips"),
        rounded_avg("trip_distance", 2).alias("distancia_promedio"),
        rounded_avg("trip_duration_minutes", 2).alias("duracion_promedio"),
        F.countDistinct("pickup_location_id").alias("zonas_activas"))


def agg_hourly_profile(trips: DataFrame) -> DataFrame:
    """Weekday by hour matrix of volume, averages and speed."""
    return trips.groupBy(
        F.dayofweek("pickup_datetime").alias("pickup_dow"),
        F.date_format("pickup_datetime", "EEE").alias("nombre_dia"),
        F.hour("pickup_datetime").alias("pickup_hour"),
    ).agg(
        F.count(F.lit(1)).alias("n_viajes"),
        rounded_avg("fare_amount", 2).alias("fare_promedio"),
        rounded_avg("trip_distance", 2).alias("distancia_promedio"),
        rounded_avg("trip_duration_minutes", 2).alias("duracion_promedio"),
        rounded_avg(_mph(), 2).alias("velocidad_mph"),
        rounded_avg("tip_ratio", 4).alias("tip_ratio_promedio"))


PAIR_MEASURES = ("trip_distance", "fare_amount", "trip_duration_minutes", "tip_ratio")


def zone_pairs(trips: DataFrame) -> DataFrame:
    """Row count, sums and value counts per pair of zones: one scan that zones and routes share."""
    parts = [f(c).alias(f"_{kind}_{c}") for c in PAIR_MEASURES for kind, f in (("sum", F.sum), ("cnt", F.count))]
    return trips.groupBy("pickup_location_id", "dropoff_location_id").agg(F.count(F.lit(1)).alias("_n"), *parts)


def _pair_mean(column: str, digits: int) -> Column:
    return steady_round(F.try_divide(F.sum(f"_sum_{column}"), F.sum(f"_cnt_{column}")), digits)


def agg_zones(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips out of and into each zone, averages, and the rank by trips out.

    The rank is taken after the zone join, and the labels come from the catalogue: zones it
    lacks have NULL labels, ids it repeats appear once per entry.
    """
    pairs = zone_pairs(trips)
    out_of = pairs.groupBy(F.col("pickup_location_id").alias("_zone")).agg(
        F.sum("_n").alias("viajes_origen"),
        _pair_mean("fare_amount", 2).alias("fare_promedio"),
        _pair_mean("trip_distance", 2).alias("distancia_promedio"),
        _pair_mean("tip_ratio", 4).alias("tip_ratio_promedio"))
    into = pairs.groupBy(F.col("dropoff_location_id").alias("_zone")).agg(F.sum("_n").alias("viajes_destino"))
    totals = out_of.join(into, "_zone", "left")
    labelled = totals.join(zones, F.col("_zone") == F.col("location_id"), "left")
    return rank_descending(labelled, "viajes_origen", "rank_origen").select(
        "location_id", "zone", "borough", "viajes_origen", "viajes_destino", "fare_promedio",
        "distancia_promedio", "tip_ratio_promedio", "rank_origen")


def agg_payment(trips: DataFrame) -> DataFrame:
    method = label_codes(F.col("payment_type"), PAYMENT_LABELS, PAYMENT_OTHER)
    return trips.groupBy(method.alias("metodo_pago")).agg(
        F.count(F.lit(1)).alias("n_viajes"),
        rounded_avg("fare_amount", 2).alias("fare_promedio"),
        rounded_avg("tip_amount", 3).alias("propina_promedio"),
        rounded_avg("tip_ratio", 4).alias("tip_ratio_promedio"),
        rate_pct(F.col("tip_amount") > 0).alias("pct_con_propina"))


def agg_routes(trips: DataFrame, zones: DataFrame, n: int = 25) -> DataFrame:
    """Most frequent zone-to-zone routes; the label joins see zone pairs, not trips."""
    named = role_play(zone_pairs(trips), zones, "location_id", {
        "pickup_location_id": {"zone": "zona_origen", "borough": "borough_origen"},
        "dropoff_location_id": {"zone": "zona_destino", "borough": "borough_destino"},
    })
    keys = ["zona_origen", "zona_destino", "borough_origen", "borough_destino"]
    return named.groupBy(*keys).agg(
        F.sum("_n").alias("n_viajes"),
        _pair_mean("trip_distance", 2).alias("distancia_promedio"),
        _pair_mean("fare_amount", 2).alias("fare_promedio"),
        _pair_mean("trip_duration_minutes", 2).alias("duracion_promedio"),
    ).orderBy(F.desc("n_viajes"), *keys).limit(n)


def hourly_speed(profile: DataFrame) -> DataFrame:
    """Trips per hour and speed weighted by trips."""
    return weighted_mean(profile, ["pickup_hour"], "velocidad_mph", "n_viajes",
                         "velocidad_mph_ponderada", "viajes").orderBy(F.desc("viajes"))


def top_zones(zones: DataFrame, n: int = 5) -> DataFrame:
    """First zones by rank with their share of all departures."""
    shares = share_of_total(zones, "viajes_origen", "pct_origenes")
    return shares.orderBy("rank_origen", "location_id").limit(n).select(
        "zone", "borough", "viajes_origen", "pct_origenes")


def kpi_row(daily: DataFrame, profile: DataFrame, zones: DataFrame) -> DataFrame:
    """Headline figures of the dashboard: totals, busiest hour, busiest zone."""
    label = F.concat(F.col("pickup_hour").cast("string"), F.lit(":00 - "), F.col("nombre_dia"))
    busiest = F.max_by(label, F.struct("n_viajes", -F.col("pickup_dow"), -F.col("pickup_hour")))
    totals = daily.agg(
        F.sum("trip_count").alias("total_viajes"),
        rounded_sum("revenue_fare", 2).alias("revenue_fare_usd"),
        rounded_sum("revenue_tips", 2).alias("revenue_tips_usd"),
        steady_round(F.sum("revenue_fare") / F.sum("trip_count"), 2).alias("fare_promedio_usd"))
    return attach_scalars(totals, {
        "pico_demanda": profile.agg(busiest),
        "zona_top_origen": zones.where("rank_origen = 1").agg(F.min("zone")),
    })


def monthly_mart(daily: DataFrame) -> DataFrame:
    return daily.groupBy(F.month("pickup_date").alias("mes"),
                         F.date_format("pickup_date", "MMM").alias("nombre_mes")).agg(
        F.sum("trip_count").alias("viajes"),
        rounded_sum("revenue_fare", 2).alias("revenue_fare"),
        rounded_sum("revenue_tips", 2).alias("revenue_tips"),
        steady_round(F.sum("revenue_fare") / F.sum("trip_count"), 2).alias("fare_promedio"),
    ).orderBy("mes")


def dash_zones_top(zones: DataFrame, n: int = 15) -> DataFrame:
    return zones.where(F.col("rank_origen") <= n)


def fare_by_distance(predictions: DataFrame) -> DataFrame:
    """Real and predicted mean fare per half mile."""
    return predictions.groupBy(
        F.round(F.floor(F.col("trip_distance") * 2) / 2, 1).alias("distancia_bucket_mi")
    ).agg(F.count(F.lit(1)).alias("n_viajes"),
          rounded_avg("fare_real", 2).alias("fare_real_prom"),
          rounded_avg("fare_predicho", 2).alias("fare_pred_prom")).orderBy("distancia_bucket_mi")


def fare_by_distance_check(buckets: DataFrame) -> DataFrame:
    gap = F.col("fare_real_prom") - F.col("fare_pred_prom")
    return buckets.agg(steady_round(F.sqrt(F.avg(gap * gap)), 3).alias("rmse_entre_promedios"),
                       F.max("n_viajes").alias("viajes_en_bucket_mayor"))
