"""D: aggregations."""

from __future__ import annotations

from cauce.operators import aggregates as agg, evaluate
from cauce.plans import customers, flights, layout, retail, trips as trip_plans
from cauce.sources.scratch import materialise
from pyspark.sql import functions as F
from workload import data
from workload.data import once, table
from workload.joins import AGG_ZONES_SQL, agg_zones, star
from workload.registry import query, rnd, rnd_row

_MPH = "trip_distance / NULLIF(trip_duration_minutes / 60, 0)"
_MEANS = {"fare_promedio": ("fare_amount", 2), "distancia_promedio_mi": ("trip_distance", 2),
          "duracion_promedio_min": ("trip_duration_minutes", 2), "velocidad_promedio_mph": (_MPH, 2),
          "tip_ratio_promedio": ("tip_ratio", 4), "pasajeros_promedio": ("passenger_count", 2),
          "total_promedio": ("total_amount", 2)}
_PERCENTILES = {"fare_p50": ("fare_amount", 0.5), "fare_p90": ("fare_amount", 0.9), "fare_p99": ("fare_amount", 0.99),
                "distancia_p50": ("trip_distance", 0.5), "distancia_p95": ("trip_distance", 0.95),
                "duracion_p95": ("trip_duration_minutes", 0.95)}


@query("d01_global_metrics", f"WITH {data.TRIPS_SQL} SELECT count(*) AS n_viajes, "
       f"{rnd('stddev(fare_amount)', 2)} AS fare_desviacion, "
       + ", ".join(f"{rnd(f'avg({c})', d)} AS {n}" for n, (c, d) in _MEANS.items()) + " FROM trips")
def d01(spark, sf):
    """The exact part; the sketched percentiles are their own query."""
    return trip_plans.global_metrics(data.trips(spark, sf)).drop(*_PERCENTILES)


@query("d01_global_percentiles")
def d01p(spark, sf):
    return trip_plans.global_metrics(data.trips(spark, sf)).select(*_PERCENTILES)


@query("d02_cast_integrity", f"""WITH {data.TRIPS_SQL} SELECT
    count(*) FILTER (WHERE vendor_id IS NULL) AS vendor_nulos, count(*) FILTER (WHERE rate_code IS NULL) AS rate_code_nulos,
    count(*) FILTER (WHERE payment_type IS NULL) AS payment_type_nulos,
    count(*) FILTER (WHERE pickup_location_id IS NULL) AS zona_origen_nulas,
    count(*) FILTER (WHERE dropoff_location_id IS NULL) AS zona_destino_nulas,
    count(DISTINCT rate_code) AS rate_codes_distintos, count(DISTINCT payment_type) AS payment_types_distintos,
    min(pickup_date) AS desde, max(pickup_date) AS hasta FROM trips""")
def d02(spark, sf):
    return trip_plans.cast_integrity(data.trips(spark, sf))


@query("d03_coverage", f"""WITH {data.RAW_TRIPS_SQL} SELECT min(pickup_datetime) AS primer_viaje,
    max(pickup_datetime) AS ultimo_viaje, count(DISTINCT CAST(pickup_datetime AS DATE)) AS dias_con_datos,
    count(DISTINCT month(pickup_datetime)) AS meses_cubiertos,
    {rnd('count(*) / count(DISTINCT CAST(pickup_datetime AS DATE))', 0)} AS viajes_por_dia FROM raw_trips""")
def d03(spark, sf):
    return trip_plans.trip_coverage(data.raw_trips(spark, sf))


@query("d04_distribution", f"""WITH {data.RAW_TRIPS_SQL} SELECT coalesce(rate_code, 'NULL') AS rate_code, count(*) AS viajes,
    {rnd('100.0 * count(*) / sum(count(*)) OVER ()', 2)} AS pct, {rnd('avg(fare_amount)', 2)} AS tarifa_promedio,
    {rnd('avg(CAST(trip_distance AS DOUBLE))', 2)} AS distancia_promedio FROM raw_trips GROUP BY 1""")
def d04(spark, sf):
    rates = trip_plans.rate_distribution(data.raw_trips(spark, sf))
    return rates.withColumn("distancia_promedio", F.col("distancia_promedio").cast("double"))


@query("d04_payment_distribution", f"""WITH {data.RAW_TRIPS_SQL} SELECT coalesce(payment_type, 'NULL') AS payment_type,
    count(*) AS viajes, {rnd('100.0 * count(*) / sum(count(*)) OVER ()', 2)} AS pct,
    {rnd('avg(tip_amount)', 3)} AS propina_promedio,
    {rnd('100.0 * count(*) FILTER (WHERE tip_amount > 0) / count(*)', 2)} AS pct_con_propina FROM raw_trips GROUP BY 1""")
def d04p(spark, sf):
    return trip_plans.payment_distribution(data.raw_trips(spark, sf))


@query("d05_monthly_share", f"""WITH {data.RAW_TRIPS_SQL} SELECT month(pickup_datetime) AS mes, count(*) AS viajes,
    {rnd('100.0 * count(*) / sum(count(*)) OVER ()', 2)} AS pct_del_anio FROM raw_trips GROUP BY 1""")
def d05(spark, sf):
    return trip_plans.monthly_share(data.raw_trips(spark, sf))


DAILY_SQL = f"""agg_daily AS (SELECT pickup_date, dayofweek(pickup_date) + 1 AS dow,
    CASE WHEN dayofweek(pickup_date) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend, count(*) AS trip_count,
    {rnd('sum(fare_amount)', 2)} AS revenue_fare, {rnd('sum(total_amount)', 2)} AS revenue_total,
    {rnd('sum(tip_amount)', 2)} AS revenue_tips, {rnd('avg(trip_distance)', 2)} AS distancia_promedio,
    {rnd('avg(trip_duration_minutes)', 2)} AS duracion_promedio, count(DISTINCT pickup_location_id) AS zonas_activas
    FROM trips GROUP BY pickup_date)"""


def daily(spark, sf):
    return trip_plans.agg_daily(data.trips(spark, sf))


@query("d06_agg_daily", f"WITH {data.TRIPS_SQL}, {DAILY_SQL} SELECT * FROM agg_daily")
def d06(spark, sf):
    return daily(spark, sf)


PROFILE_SQL = f"""profile AS (SELECT dayofweek(pickup_datetime) + 1 AS pickup_dow, strftime(pickup_datetime, '%a') AS nombre_dia,
    hour(pickup_datetime) AS pickup_hour, count(*) AS n_viajes, {rnd('avg(fare_amount)', 2)} AS fare_promedio,
    {rnd('avg(trip_distance)', 2)} AS distancia_promedio, {rnd('avg(trip_duration_minutes)', 2)} AS duracion_promedio,
    {rnd(f'avg({_MPH})', 2)} AS velocidad_mph, {rnd('avg(tip_ratio)', 4)} AS tip_ratio_promedio FROM trips GROUP BY 1, 2, 3)"""


def profile(spark, sf):
    return trip_plans.agg_hourly_profile(data.trips(spark, sf))


@query("d07_hourly_profile", f"WITH {data.TRIPS_SQL}, {PROFILE_SQL} SELECT * FROM profile")
def d07(spark, sf):
    return profile(spark, sf)


@query("d08_zone_aggregate", f"""WITH {data.TRIPS_SQL}, {data.ZONES_SQL}, {AGG_ZONES_SQL}
    SELECT zone, borough, viajes_origen, viajes_destino, fare_promedio FROM agg_zones""")
def d08(spark, sf):
    return agg_zones(spark, sf).select("zone", "borough", "viajes_origen", "viajes_destino", "fare_promedio")


@query("d08_top_zones", f"""WITH {data.TRIPS_SQL}, {data.ZONES_SQL}, {AGG_ZONES_SQL}, ranked AS (SELECT *,
    rank() OVER (ORDER BY viajes_origen DESC) AS r, sum(viajes_origen) OVER () AS whole FROM agg_zones)
    SELECT zone, borough, viajes_origen, {rnd('100.0 * viajes_origen / whole', 2)} AS pct_origenes FROM ranked ORDER BY r, location_id LIMIT 5""")
def d08_top(spark, sf):
    return trip_plans.top_zones(agg_zones(spark, sf))


@query("d09_payment_comparison", f"""WITH {data.TRIPS_SQL} SELECT CASE payment_type WHEN 1 THEN 'Tarjeta de credito'
    WHEN 2 THEN 'Efectivo' WHEN 3 THEN 'Sin cargo' WHEN 4 THEN 'Disputa' WHEN 5 THEN 'Desconocido'
    WHEN 6 THEN 'Viaje anulado' ELSE 'Otro' END AS metodo_pago, count(*) AS n_viajes,
    {rnd('avg(fare_amount)', 2)} AS fare_promedio, {rnd('avg(tip_amount)', 3)} AS propina_promedio,
    {rnd('avg(tip_ratio)', 4)} AS tip_ratio_promedio,
    {rnd('100.0 * count(*) FILTER (WHERE tip_amount > 0) / count(*)', 2)} AS pct_con_propina FROM trips GROUP BY 1""")
def d09(spark, sf):
    return trip_plans.agg_payment(data.trips(spark, sf))


ROUTES_SQL = f"""routes AS (SELECT zp.zone AS zona_origen, zd.zone AS zona_destino, zp.borough AS borough_origen,
    zd.borough AS borough_destino, count(*) AS n_viajes, {rnd('avg(trip_distance)', 2)} AS distancia_promedio,
    {rnd('avg(fare_amount)', 2)} AS fare_promedio, {rnd('avg(trip_duration_minutes)', 2)} AS duracion_promedio
    FROM trips LEFT JOIN zones zp ON zp.location_id = pickup_location_id
    LEFT JOIN zones zd ON zd.location_id = dropoff_location_id GROUP BY 1, 2, 3, 4
    ORDER BY n_viajes DESC, 1 NULLS FIRST, 2 NULLS FIRST, 3 NULLS FIRST, 4 NULLS FIRST LIMIT 25)"""


@query("d10_top_routes", f"WITH {data.TRIPS_SQL}, {data.ZONES_SQL}, {ROUTES_SQL} SELECT * FROM routes")
def d10(spark, sf):
    return trip_plans.agg_routes(data.trips(spark, sf), data.zones(spark, sf))


@query("d11_weighted_average", f"""WITH {data.TRIPS_SQL}, {PROFILE_SQL} SELECT pickup_hour, CAST(sum(n_viajes) AS BIGINT) AS viajes,
    {rnd('sum(n_viajes * velocidad_mph) / sum(n_viajes)', 2)} AS velocidad_mph_ponderada FROM profile GROUP BY 1""")
def d11(spark, sf):
    return trip_plans.hourly_speed(profile(spark, sf))


@query("d12_kpi_row", f"""WITH {data.TRIPS_SQL}, {data.ZONES_SQL}, {DAILY_SQL}, {PROFILE_SQL}, {AGG_ZONES_SQL}
    SELECT (SELECT CAST(sum(trip_count) AS BIGINT) FROM agg_daily) AS total_viajes,
    (SELECT {rnd('sum(revenue_fare)', 2)} FROM agg_daily) AS revenue_fare_usd,
    (SELECT {rnd('sum(revenue_tips)', 2)} FROM agg_daily) AS revenue_tips_usd,
    (SELECT {rnd('sum(revenue_fare) / sum(trip_count)', 2)} FROM agg_daily) AS fare_promedio_usd,
    (SELECT concat(pickup_hour, ':00 - ', nombre_dia) FROM profile ORDER BY n_viajes DESC, pickup_dow, pickup_hour LIMIT 1)
      AS pico_demanda, (SELECT min(zone) FROM agg_zones WHERE rank_origen = 1) AS zona_top_origen""")
def d12(spark, sf):
    return trip_plans.kpi_row(daily(spark, sf), profile(spark, sf), agg_zones(spark, sf))


@query("d13_monthly_mart", f"""WITH {data.TRIPS_SQL}, {DAILY_SQL} SELECT month(pickup_date) AS mes,
    strftime(pickup_date, '%b') AS nombre_mes, CAST(sum(trip_count) AS BIGINT) AS viajes, {rnd('sum(revenue_fare)', 2)} AS revenue_fare,
    {rnd('sum(revenue_tips)', 2)} AS revenue_tips, {rnd('sum(revenue_fare) / sum(trip_count)', 2)} AS fare_promedio
    FROM agg_daily GROUP BY 1, 2""")
def d13(spark, sf):
    return trip_plans.monthly_mart(daily(spark, sf))


# predictions by formula, so that both engines score alike
FORMULA = "2.5 + trip_distance * 0.5 + tolls_amount"


def formula_predictions(spark, sf):
    real, predicted = F.col("fare_amount"), 2.5 + F.col("trip_distance") * 0.5 + F.col("tolls_amount")
    return data.trips(spark, sf).select(
        "pickup_date", "trip_distance", "trip_duration_minutes", real.alias("fare_real"), predicted.alias("fare_predicho"),
        F.round(predicted - real, 4).alias("error_usd"), F.round((predicted - real) / real, 4).alias("error_pct"))


PRED_SQL = f"""pred AS (SELECT pickup_date, trip_distance, fare_amount AS fare_real, {FORMULA} AS fare_predicho,
    {rnd_row(f'{FORMULA} - fare_amount', 4)} AS error_usd, {rnd_row(f'({FORMULA} - fare_amount) / fare_amount', 4)} AS error_pct
    FROM trips)"""
BUCKETS_SQL = f"""buckets AS (SELECT floor(trip_distance * 2) / 2 AS distancia_bucket_mi, count(*) AS n_viajes,
    {rnd('avg(fare_real)', 2)} AS fare_real_prom, {rnd('avg(fare_predicho)', 2)} AS fare_pred_prom FROM pred GROUP BY 1)"""


@query("d14_bucket_aggregate", f"WITH {data.TRIPS_SQL}, {PRED_SQL}, {BUCKETS_SQL} SELECT * FROM buckets")
def d14(spark, sf):
    return trip_plans.fare_by_distance(formula_predictions(spark, sf))


@query("d15_calibration", f"""WITH s AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y,
    CASE WHEN l_linenumber < 7 THEN CAST(l_partkey % 1000 AS DOUBLE) / 1000 END AS p FROM lineitem)
    SELECT floor(p * 10) / 10 AS bucket_probabilidad, count(*) AS n_viajes, {rnd('avg(y)', 4)} AS tasa_real_high_tip,
    {rnd('avg(p)', 4)} AS probabilidad_promedio FROM s WHERE p IS NOT NULL GROUP BY 1""")
def d15(spark, sf):
    scored = table(spark, sf, "lineitem").select(
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("y"),
        F.when(F.col("l_linenumber") < 7, F.col("l_partkey") % 1000 / 1000).alias("p"))
    return evaluate.calibration(scored, "y", "p")


@query("d16_having", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderstatus) > 1")
def d16(spark, sf):
    groups = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("o_orderstatus").alias("kinds"))
    return groups.where("kinds > 1").drop("kinds")


_JOINED = """fact JOIN dim_estado_vuelo USING (estado_key)"""


@query("d17_counts_by_status", f"""WITH {data.STAR_SQL} SELECT status, count(*) AS total_vuelos FROM {_JOINED} GROUP BY 1""")
def d17a(spark, sf):
    s = star(spark, sf)
    return flights.count_by(s.fact, s.dims["dim_estado_vuelo"], "estado_key", "status", "status")


@query("d17_top_destinations", f"""WITH {data.STAR_SQL} SELECT codigo_iata AS destino, count(*) AS total_vuelos FROM fact
    JOIN dim_aeropuerto ON aeropuerto_key = destino_key GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""")
def d17b(spark, sf):
    s = star(spark, sf)
    return flights.count_by(s.fact, s.dims["dim_aeropuerto"], "aeropuerto_key", "codigo_iata", "destino",
                            fact_key="destino_key", top=5)


@query("d17_top_flight_routes", f"""WITH {data.STAR_SQL} SELECT o.codigo_iata AS origen, d.codigo_iata AS destino,
    count(*) AS total_vuelos FROM fact JOIN dim_aeropuerto o ON o.aeropuerto_key = origen_key
    JOIN dim_aeropuerto d ON d.aeropuerto_key = destino_key GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 5""")
def d17c(spark, sf):
    s = star(spark, sf)
    return flights.top_routes(s.fact, s.dims["dim_aeropuerto"])


@query("d17_passenger_gender", f"""WITH {data.STAR_SQL} SELECT genero, count(*) AS total_pasajeros,
    {rnd('100.0 * count(*) / sum(count(*)) OVER ()', 2)} AS porcentaje FROM fact JOIN dim_pasajero USING (pasajero_key) GROUP BY 1""")
def d17d(spark, sf):
    s = star(spark, sf)
    shares = flights.passengers_by_gender(s.fact, s.dims["dim_pasajero"])
    return shares.withColumn("porcentaje", F.col("porcentaje").cast("double"))


@query("d17_top_nationalities", f"""WITH {data.STAR_SQL} SELECT nacionalidad, count(*) AS total_pasajeros FROM fact
    JOIN dim_pasajero USING (pasajero_key) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def d17e(spark, sf):
    s = star(spark, sf)
    return flights.count_by(s.fact, s.dims["dim_pasajero"], "pasajero_key", "nacionalidad", "nacionalidad",
                            "total_pasajeros", top=10)


@query("d18_delayed_by_airline", f"""WITH {data.STAR_SQL} SELECT airline_name, count(*) AS vuelos_retrasados,
    avg(CAST(delay_min AS DOUBLE)) AS retraso_promedio_min FROM {_JOINED} JOIN dim_aerolinea USING (aerolinea_key)
    WHERE status = 'DELAYED' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""")
def d18(spark, sf):
    s = star(spark, sf)
    return flights.delayed_by_airline(s.fact, s.dims["dim_aerolinea"], s.dims["dim_estado_vuelo"])


_PRICE = "CAST(ticket_price_usd AS DECIMAL(12,2))"


def _doubles(df, *columns):
    """Decimals as doubles, for comparison with the oracle."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


@query("d19_revenue_by_class", f"""WITH {data.STAR_SQL} SELECT cabin_class, count(*) AS total_boletos,
    CAST(sum({_PRICE}) AS DOUBLE) AS ingreso_total_usd, {rnd(f'sum({_PRICE}) / count(*)', 2)} AS ticket_promedio_usd
    FROM fact JOIN dim_clase_cabina USING (clase_key) GROUP BY 1""")
def d19(spark, sf):
    s = star(spark, sf)
    return _doubles(flights.revenue_by_class(s.fact, s.dims["dim_clase_cabina"]), "ingreso_total_usd", "ticket_promedio_usd")


@query("d20_month_trend", f"""WITH {data.STAR_SQL} SELECT year(fecha_hora_salida) AS anio, month(fecha_hora_salida) AS mes,
    (['Enero','Febrero','Marzo','Abril','Mayo','Junio','Julio','Agosto','Septiembre','Octubre','Noviembre','Diciembre'])
      [month(fecha_hora_salida)] AS nombre_mes, count(*) AS total_vuelos,
    {rnd(f'sum({_PRICE}) / count(*)', 2)} AS ticket_promedio_usd FROM fact GROUP BY 1, 2, 3""")
def d20(spark, sf):
    s = star(spark, sf)
    return _doubles(flights.monthly_trend(s.fact, s.dims["dim_fecha"]), "ticket_promedio_usd")


@query("d21_cross_tab", f"""WITH {data.STAR_SQL} SELECT sales_channel, payment_method, count(*) AS total FROM fact
    JOIN dim_canal_venta USING (canal_key) JOIN dim_metodo_pago USING (metodo_pago_key) GROUP BY 1, 2""")
def d21(spark, sf):
    s = star(spark, sf)
    return flights.channel_by_payment(s.fact, s.dims["dim_canal_venta"], s.dims["dim_metodo_pago"])


@query("d22_baggage_averages", f"""WITH {data.STAR_SQL} SELECT airline_name, {rnd('avg(bags_total)', 2)} AS maletas_promedio,
    {rnd('avg(bags_checked)', 2)} AS maletas_facturadas_promedio FROM fact JOIN dim_aerolinea USING (aerolinea_key) GROUP BY 1""")
def d22(spark, sf):
    s = star(spark, sf)
    return _doubles(flights.baggage_by_airline(s.fact, s.dims["dim_aerolinea"]), "maletas_promedio",
                    "maletas_facturadas_promedio")


def marts(spark, sf):
    """The retail marts, written once."""
    return once(spark, sf, "marts", lambda: {
        name: materialise(mart, name)
        for name, mart in retail.build_marts(retail.stage_all(data.raw_retail(spark, sf))).items()})


@query("d23_sales_by_category", f"""WITH {data.MARTS_SQL} SELECT categoria, count(id_detalle) AS total_lineas_vendidas,
    CAST(sum(cantidad) AS BIGINT) AS unidades_vendidas, CAST(sum(monto_bruto) AS DOUBLE) AS total_venta_bruta,
    CAST(sum(monto_descuento) AS DOUBLE) AS total_descuentos, CAST(sum(monto_neto) AS DOUBLE) AS total_venta_neta,
    {rnd('100 * CAST(sum(porcentaje_descuento) AS DOUBLE) / count(porcentaje_descuento)', 2)} AS pct_descuento_promedio
    FROM fct_ventas JOIN dim_productos USING (id_producto) GROUP BY 1""")
def d23(spark, sf):
    m = marts(spark, sf)
    return _doubles(retail.sales_by_category(m["fct_ventas"], m["dim_productos"]), "total_venta_bruta", "total_descuentos",
                    "total_venta_neta", "pct_descuento_promedio")


@query("d24_sales_by_branch", f"""WITH {data.MARTS_SQL} SELECT nombre_sucursal, departamento,
    count(DISTINCT id_venta) AS total_transacciones, CAST(sum(monto_neto) AS DOUBLE) AS facturacion_total_neta,
    {rnd('CAST(sum(monto_neto) AS DOUBLE) / count(monto_neto)', 2)} AS ticket_promedio_linea
    FROM fct_ventas JOIN dim_sucursales USING (id_sucursal) GROUP BY 1, 2""")
def d24(spark, sf):
    m = marts(spark, sf)
    return _doubles(retail.sales_by_branch(m["fct_ventas"], m["dim_sucursales"]), "facturacion_total_neta",
                    "ticket_promedio_linea")


@query("d25_top_customers", f"""WITH {data.MARTS_SQL} SELECT id_cliente, nombre_cliente, tipo_cliente, municipio,
    count(DISTINCT id_venta) AS total_ordenes, CAST(sum(monto_neto) AS DOUBLE) AS gasto_acumulado_neto
    FROM fct_ventas JOIN dim_clientes USING (id_cliente) GROUP BY 1, 2, 3, 4 ORDER BY 6 DESC, 1 LIMIT 10""")
def d25(spark, sf):
    m = marts(spark, sf)
    return _doubles(retail.top_customers(m["fct_ventas"], m["dim_clientes"]), "gasto_acumulado_neto")


def clean_customers(spark, sf):
    return customers.clean_customers(data.raw_customers(spark, sf))


_CATS = customers.CATEGORIES


@query("d26_pivot_count", f"WITH {data.CUSTOMERS_SQL} SELECT ciudad, " + ", ".join(
    f"""count(*) FILTER (WHERE categoria = '{c}') AS "{c}" """ for c in _CATS)
    + "FROM clean WHERE categoria IS NOT NULL GROUP BY 1")
def d26(spark, sf):
    return customers.count_pivot(clean_customers(spark, sf))


@query("d26_pivot_mean", f"WITH {data.CUSTOMERS_SQL} SELECT ciudad, " + ", ".join(
    f"""coalesce({rnd(f"avg(CAST(gasto_q AS DECIMAL(12,2))) FILTER (WHERE categoria = '{c}')", 2)}, 0) AS "{c}" """ for c in _CATS)
    + "FROM clean WHERE categoria IS NOT NULL GROUP BY 1")
def d26m(spark, sf):
    exact = clean_customers(spark, sf).withColumn("gasto_q", F.col("gasto_q").cast("decimal(12,2)"))
    return _doubles(customers.spend_pivot(exact), *_CATS)


@query("d27_conditional_max_pivot", f"""WITH s AS (SELECT l_linestatus AS prueba, max(CASE WHEN l_returnflag = 'A' THEN l_orderkey END) AS bytes_std,
    max(CASE WHEN l_returnflag = 'N' THEN l_partkey END) AS bytes_opt FROM lineitem GROUP BY 1)
    SELECT prueba, bytes_std, bytes_opt, {rnd('100 * (1 - bytes_opt / bytes_std)', 2)} AS reduccion_pct FROM s""")
def d27(spark, sf):
    log = table(spark, sf, "lineitem").select(
        F.col("l_linestatus").alias("prueba"),
        F.when(F.col("l_returnflag") == "A", "STD").when(F.col("l_returnflag") == "N", "OPT").alias("variante"),
        F.when(F.col("l_returnflag") == "A", F.col("l_orderkey")).otherwise(F.col("l_partkey")).alias("bytes"),
        F.lit(0).cast("bigint").alias("elapsed_ms"))
    return layout.compare_runs(log).select("prueba", "bytes_std", "bytes_opt", "reduccion_pct")


@query("d28_value_counts", f"WITH {data.CUSTOMERS_SQL} SELECT genero, count(*) AS n FROM clean GROUP BY 1")
def d28(spark, sf):
    return agg.value_counts(clean_customers(spark, sf), "genero")


_DESCRIBED = ("l_quantity", "l_linenumber", "l_partkey")


@query("d29_describe", " UNION ALL ".join(
    f"""SELECT '{c}' AS variable, count({c}) AS count, {rnd(f'avg({c})', 4)} AS mean, {rnd(f'stddev({c})', 4)} AS std,
    CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, quantile_cont(CAST({c} AS DOUBLE), 0.25) AS p25,
    quantile_cont(CAST({c} AS DOUBLE), 0.5) AS p50, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS p75 FROM lineitem"""
    for c in _DESCRIBED))
def d29(spark, sf):
    described = agg.describe_numeric(table(spark, sf, "lineitem"), list(_DESCRIBED))
    return described.withColumns({"mean": F.round("mean", 4), "std": F.round("std", 4)})


@query("d30_null_profile", f"""WITH {data.RAW_FLIGHTS_SQL}, p AS (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS variable, count(*) - count({c}) AS n_null FROM raw_flights"
    for c in ("record_id", "arrival_datetime", "duration_min", "delay_min", "passenger_age", "passenger_nationality",
              "sales_channel", "seat", "status")) + ") SELECT * FROM p WHERE n_null > 0")
def d30(spark, sf):
    return agg.null_profile(data.raw_flights(spark, sf))


@query("d31_domain_values", f"""WITH {data.RAW_CUSTOMERS_SQL} SELECT variable, value, count(*) AS n FROM (
    SELECT 'genero' AS variable, genero AS value FROM raw_customers UNION ALL SELECT 'ciudad', ciudad FROM raw_customers
    UNION ALL SELECT 'categoria', categoria FROM raw_customers) WHERE value IS NOT NULL GROUP BY 1, 2""")
def d31(spark, sf):
    return agg.domain_values(data.raw_customers(spark, sf), ["genero", "ciudad", "categoria"])


@query("d31_duplicate_profile", f"""WITH {data.RAW_CUSTOMERS_SQL} SELECT count(*) AS n_rows,
    count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw_customers)) AS duplicate_rows,
    count(*) - count(DISTINCT id_cliente) AS duplicate_keys, count(DISTINCT id_cliente) AS distinct_keys FROM raw_customers""")
def d31d(spark, sf):
    return agg.duplicate_profile(data.raw_customers(spark, sf), "id_cliente")


@query("d32_exact_median", """SELECT l_returnflag, l_linestatus, median(l_extendedprice) AS median_price FROM lineitem GROUP BY ALL""")
def d32(spark, sf):
    return agg.exact_quantiles(table(spark, sf, "lineitem"), "l_extendedprice", {"median_price": 0.5},
                               ["l_returnflag", "l_linestatus"])


@query("d33_mean_by_key", f"""SELECT c_nationkey, {rnd('CAST(sum(CAST(c_acctbal AS DECIMAL(12,2))) AS DOUBLE) / count(*)', 6)} AS mean_balance
    FROM customer GROUP BY 1""")
def d33(spark, sf):
    exact = table(spark, sf, "customer").select("c_nationkey", F.col("c_acctbal").cast("decimal(12,2)").alias("b"))
    return _doubles(agg.mean_by(exact, "c_nationkey", "b", "mean_balance"), "mean_balance")


@query("d34_histogram", """WITH b AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
    c AS (SELECT least(CAST(floor((l_extendedprice - lo) * 30 / (hi - lo)) AS INTEGER) + 1, 30) AS bin, count(*) AS n
      FROM lineitem, b GROUP BY 1)
    SELECT CAST(i AS INTEGER) AS bin, round(lo + (i - 1) * ((hi - lo) / 30), 6) AS bin_from, round(lo + i * ((hi - lo) / 30), 6) AS bin_to,
    coalesce(n, 0) AS n FROM range(1, 31) r(i) CROSS JOIN b LEFT JOIN c ON bin = i""")
def d34(spark, sf):
    bins = agg.histogram(table(spark, sf, "lineitem"), "l_extendedprice", 30)
    return bins.withColumns({"bin_from": F.round("bin_from", 6), "bin_to": F.round("bin_to", 6)})


@query("d35_box_plot", """WITH q AS (SELECT o_orderstatus, quantile_cont(o_totalprice, 0.25) AS q1, median(o_totalprice) AS "median",
    quantile_cont(o_totalprice, 0.75) AS q3 FROM orders GROUP BY 1)
    SELECT o_orderstatus, q1, "median", q3,
    min(o_totalprice) FILTER (WHERE o_totalprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
    max(o_totalprice) FILTER (WHERE o_totalprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
    count(*) FILTER (WHERE o_totalprice NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS n_outliers
    FROM orders JOIN q USING (o_orderstatus) GROUP BY 1, 2, 3, 4""")
def d35(spark, sf):
    return agg.box_plot(table(spark, sf, "orders"), "o_orderstatus", "o_totalprice")


@query("d36_weekly_resample", f"""WITH {data.CUSTOMERS_SQL}, w AS (
    SELECT CAST(date_trunc('week', fecha_registro) AS DATE) + 6 AS week, count(*) AS n FROM clean
    WHERE fecha_registro IS NOT NULL GROUP BY 1)
    SELECT CAST(s AS DATE) AS week, coalesce(n, 0) AS n FROM (SELECT unnest(generate_series(min(week)::TIMESTAMP, max(week)::TIMESTAMP,
      INTERVAL 7 DAY)) AS s FROM w) LEFT JOIN w ON week = CAST(s AS DATE)""")
def d36(spark, sf):
    return agg.weekly_counts(clean_customers(spark, sf), "fecha_registro")


@query("d37_error_metrics", f"""WITH {data.TRIPS_SQL}, {PRED_SQL} SELECT {rnd('sqrt(avg(pow(fare_predicho - fare_real, 2)))', 4)} AS rmse,
    {rnd('avg(abs(fare_predicho - fare_real))', 4)} AS mae,
    {rnd('100 * avg(abs((fare_predicho - fare_real) / NULLIF(fare_real, 0)))', 2)} AS mape_pct FROM pred""")
def d37(spark, sf):
    return formula_predictions(spark, sf).agg(*agg.error_metrics("", F.col("fare_real"), F.col("fare_predicho")))


@query("d38_interval_coverage", f"""SELECT o_orderpriority, {rnd('''100.0 * count(*) FILTER (WHERE o_totalprice
    BETWEEN 100 * o_custkey AND 200000 + 100 * o_custkey) / count(o_totalprice)''', 2)} AS coverage FROM orders GROUP BY 1""")
def d38(spark, sf):
    low = 100 * F.col("o_custkey")
    return table(spark, sf, "orders").groupBy("o_orderpriority").agg(
        agg.coverage_pct(F.col("o_totalprice"), low, 200000 + low).alias("coverage"))
