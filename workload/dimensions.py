"""I: dimensional loads; J: data quality; K: business measures."""

from __future__ import annotations

from cauce.operators import dims, measures, quality
from cauce.operators.history import current_versions, merge_history, versions_per_key
from cauce.operators.late_history import LateHistory
from cauce.plans import customers, flights, retail
from cauce.sources.scratch import materialise, new_path
from pyspark.sql import functions as F
from workload import data
from workload.aggregates import marts
from workload.data import once, table
from workload.joins import clean_flights, star
from workload.registry import query, rnd


@query("i01_build_simple_dim", """WITH old AS (SELECT p_name, row_number() OVER (ORDER BY p_name) AS part_key
      FROM (SELECT DISTINCT p_name FROM part WHERE p_size <= 3)),
    new AS (SELECT DISTINCT p_name FROM part WHERE p_name NOT IN (SELECT p_name FROM old))
    SELECT part_key, p_name FROM old UNION ALL
    SELECT (SELECT coalesce(max(part_key), 0) FROM old) + row_number() OVER (ORDER BY p_name), p_name FROM new""")
def i01(spark, sf):
    parts = table(spark, sf, "part")
    first = dims.build_simple_dim(parts.where("p_size <= 3"), "p_name", "part_key")
    return dims.build_simple_dim(parts, "p_name", "part_key", existing=materialise(first))


@query("i02_build_pair_dim", """SELECT row_number() OVER (ORDER BY p_brand) AS brand_key, p_brand, name AS p_type FROM (
    SELECT p_brand, arg_min(p_type, p_partkey) AS name FROM part GROUP BY 1)""")
def i02(spark, sf):
    return dims.build_pair_dim(table(spark, sf, "part"), "p_brand", "p_type", "brand_key", order=["p_partkey"])


@query("i03_build_role_dim", f"WITH {data.STAR_SQL} SELECT * FROM dim_aeropuerto")
def i03(spark, sf):
    spec = flights.VALUE_DIMS["dim_aeropuerto"]
    return dims.build_role_dim(clean_flights(spark, sf), spec.columns, spec.business, spec.surrogate)


_CALENDAR = """CAST(strftime(d, '%Y%m%d') AS INTEGER) AS fecha_key, d AS fecha, year(d) AS anio, month(d) AS mes,
    (['Enero','Febrero','Marzo','Abril','Mayo','Junio','Julio','Agosto','Septiembre','Octubre','Noviembre','Diciembre'])
      [month(d)] AS nombre_mes, quarter(d) AS trimestre, day(d) AS dia, isodow(d) AS dia_semana,
    (['Lunes','Martes','Miercoles','Jueves','Viernes','Sabado','Domingo'])[isodow(d)] AS nombre_dia_semana,
    isodow(d) >= 6 AS es_fin_semana"""


@query("i04_build_calendar", f"""SELECT {_CALENDAR} FROM (SELECT CAST(unnest(generate_series(
    CAST(min(o_orderdate) AS DATE)::TIMESTAMP, CAST(max(o_orderdate) AS DATE)::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS d FROM orders)""")
def i04(spark, sf):
    orders = table(spark, sf, "orders")
    known = dims.build_calendar(orders.where("o_orderstatus = 'F'"), "o_orderdate")
    return dims.build_calendar(orders, "o_orderdate", existing=known)


@query("i05_build_observed_dates", """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS "Tiempo_SK", d AS "Fecha", year(d) AS "Anio",
    month(d) AS "Mes", day(d) AS "Dia", quarter(d) AS "Trimestre", dayname(d) AS "DiaSemana" FROM (
    SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem)""")
def i05(spark, sf):
    both = table(spark, sf, "orders").select(F.col("o_orderdate").alias("a")).unionByName(
        table(spark, sf, "lineitem").select(F.col("l_shipdate").alias("b")), allowMissingColumns=True)
    return dims.build_observed_dates(both, ["a", "b"])


_ATTRIBUTES = ("c_mktsegment", "c_nationkey")


def customer_history(spark, sf):
    """A first load without one market segment, then a batch with all of them, another segment moved."""
    def load():
        people = table(spark, sf, "customer").select("c_custkey", *_ATTRIBUTES)
        first = merge_history(None, people.where("c_mktsegment <> 'MACHINERY'"), "c_custkey", _ATTRIBUTES, data.LOAD_TS)
        moved = people.withColumn("c_nationkey", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_nationkey")))
        return merge_history(materialise(first.dimension), moved, "c_custkey", _ATTRIBUTES, data.NEXT_TS)
    return once(spark, sf, "history", load)


HISTORY_SQL = """v1 AS (SELECT row_number() OVER (ORDER BY c_custkey) AS pasajero_key, c_custkey, c_mktsegment, c_nationkey
      FROM customer WHERE c_mktsegment <> 'MACHINERY'),
    batch AS (SELECT c_custkey, c_mktsegment, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_nationkey END AS c_nationkey FROM customer),
    opened AS (SELECT b.*, CASE WHEN v.c_custkey IS NULL THEN 1 ELSE 2 END AS version FROM batch b LEFT JOIN v1 v USING (c_custkey)
      WHERE v.c_custkey IS NULL OR b.c_nationkey IS DISTINCT FROM v.c_nationkey),
    dim AS (SELECT v.pasajero_key, v.c_custkey, v.c_mktsegment, v.c_nationkey, 1 AS version,
      TIMESTAMP '2026-01-01 06:00:00' AS fecha_inicio_validez,
      CASE WHEN o.version = 2 THEN TIMESTAMP '2026-02-01 06:00:00' END AS fecha_fin_validez, o.version IS NULL AS es_actual
      FROM v1 v LEFT JOIN opened o ON o.c_custkey = v.c_custkey AND o.version = 2
      UNION ALL SELECT (SELECT max(pasajero_key) FROM v1) + row_number() OVER (ORDER BY c_custkey), c_custkey, c_mktsegment,
      c_nationkey, version, TIMESTAMP '2026-02-01 06:00:00', NULL, true FROM opened)"""


@query("i06_scd2_merge", f"WITH {HISTORY_SQL} SELECT * FROM dim")
def i06(spark, sf):
    return customer_history(spark, sf).dimension


@query("i06_scd2_counts", f"""WITH {HISTORY_SQL} SELECT count(*) FILTER (WHERE version = 1) AS inserted,
    count(*) FILTER (WHERE version = 2) AS changed, (SELECT count(*) FROM batch) - count(*) AS unchanged FROM opened""")
def i06c(spark, sf):
    return customer_history(spark, sf).counts


@query("i06_late_history", """WITH o AS (SELECT o_custkey, CAST(o_orderdate AS TIMESTAMP) AS ts, o_orderpriority, o_orderkey % 3 AS b FROM orders),
    seen AS (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY o_custkey, ts ORDER BY b DESC, o_orderpriority DESC) = 1),
    was AS (SELECT *, lag(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY ts) AS p FROM seen)
    SELECT o_custkey, o_orderpriority, row_number() OVER w AS version, ts AS valid_from, lead(ts) OVER w AS valid_to,
    lead(ts) OVER w IS NULL AS is_current FROM was WHERE p IS DISTINCT FROM o_orderpriority WINDOW w AS (PARTITION BY o_custkey ORDER BY ts)""")
def i06l(spark, sf):
    """The priority each customer orders with, from three batches whose orders are not in the order of their dates."""
    def load():
        store = LateHistory(spark, new_path(spark, "late-history"), "o_custkey", ["o_orderpriority"], "ts", buckets=8)
        orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", F.col("o_orderdate").cast("timestamp").alias("ts"))
        for b in range(3):
            store.apply(orders.where(F.col("o_orderkey") % 3 == b))
        return store
    return once(spark, sf, "late-history", load).dimension()


@query("i07_scd2_history_check", f"""WITH {HISTORY_SQL} SELECT c_custkey, count(*) AS versiones_historicas FROM dim
    GROUP BY 1 HAVING count(*) > 1""")
def i07(spark, sf):
    return versions_per_key(customer_history(spark, sf).dimension, "c_custkey")


@query("i08_build_fact", f"""WITH {data.STAR_SQL} SELECT status, count(*) AS n, count(DISTINCT record_id) AS n_records,
    count(fecha_hora_llegada) AS arrived, count(delay_min) AS measured, CAST(sum(duration_min) AS BIGINT) AS minutes,
    CAST(sum(CAST(ticket_price_usd AS DECIMAL(14,2))) AS DOUBLE) AS revenue
    FROM fact JOIN dim_estado_vuelo USING (estado_key) GROUP BY 1""")
def i08(spark, sf):
    s = star(spark, sf)
    return s.fact.join(s.dims["dim_estado_vuelo"], "estado_key").groupBy("status").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("record_id").alias("n_records"),
        F.count("fecha_hora_llegada").alias("arrived"), F.count("delay_min").alias("measured"),
        F.sum("duration_min").alias("minutes"),
        F.sum(F.col("ticket_price_usd").cast("decimal(14,2)")).cast("double").alias("revenue"))


_VARIANT_TS = {c: data.mixed_ts_sql(f"{c}_datetime") for c in ("departure", "arrival")}


@query("i08_build_fact_variant", f"""WITH {data.RAW_FLIGHTS_SQL}, f AS (SELECT *, upper(origin_airport) AS o,
      upper(destination_airport) AS d, {_VARIANT_TS['departure']} AS dep, {_VARIANT_TS['arrival']} AS arr FROM raw_flights),
    air AS (SELECT code, row_number() OVER (ORDER BY code) AS k FROM (SELECT o AS code FROM f UNION SELECT d FROM f)),
    vue AS (SELECT flight_number AS n, row_number() OVER (ORDER BY flight_number) AS k FROM (SELECT DISTINCT flight_number FROM f)),
    aer AS (SELECT airline_code AS n, row_number() OVER (ORDER BY airline_code) AS k FROM (SELECT DISTINCT airline_code FROM f)),
    pas AS (SELECT passenger_id AS n, row_number() OVER (ORDER BY passenger_id) AS k FROM (SELECT DISTINCT passenger_id FROM f)),
    est AS (SELECT status AS n, row_number() OVER (ORDER BY status) AS k FROM (SELECT DISTINCT status FROM f)),
    can AS (SELECT sales_channel AS n, row_number() OVER (ORDER BY sales_channel) AS k FROM (SELECT DISTINCT sales_channel FROM f
      WHERE sales_channel IS NOT NULL)),
    pag AS (SELECT payment_method AS n, row_number() OVER (ORDER BY payment_method) AS k FROM (SELECT DISTINCT payment_method FROM f))
    SELECT record_id AS "Record_ID", vue.k AS "Vuelo_SK", aer.k AS "Aerolinea_SK", ao.k AS "Origen_Aeropuerto_SK",
    ad.k AS "Destino_Aeropuerto_SK", CAST(strftime(dep, '%Y%m%d') AS INTEGER) AS "Salida_Tiempo_SK",
    CASE WHEN status <> 'CANCELLED' THEN CAST(strftime(arr, '%Y%m%d') AS INTEGER) END AS "Llegada_Tiempo_SK",
    pas.k AS "Pasajero_SK", est.k AS "Estado_Vuelo_SK", can.k AS "Canal_Venta_SK", pag.k AS "Metodo_Pago_SK",
    CASE WHEN status <> 'CANCELLED' THEN TRY_CAST(duration_min AS DOUBLE) END AS "Duration_Min",
    CASE WHEN status = 'CANCELLED' THEN NULL WHEN status = 'ON_TIME' THEN coalesce(TRY_CAST(delay_min AS DOUBLE), 0)
      ELSE TRY_CAST(delay_min AS DOUBLE) END AS "Delay_Min", ticket_price_usd_est AS "Ticket_Price_USD_Est",
    bags_total AS "Bags_Total", bags_checked AS "Bags_Checked"
    FROM f JOIN vue ON vue.n = flight_number JOIN aer ON aer.n = airline_code JOIN air ao ON ao.code = o JOIN air ad ON ad.code = d
    JOIN pas ON pas.n = passenger_id JOIN est ON est.n = status LEFT JOIN can ON can.n = sales_channel
    JOIN pag ON pag.n = payment_method""")
def i08v(spark, sf):
    tidy = flights.transform_flights_variant(data.raw_flights(spark, sf))
    return flights.load_star_variant(tidy, ["file_order"]).fact


@query("i09_transform_flights", f"WITH {data.FLIGHTS_SQL} SELECT * FROM flights")
def i09(spark, sf):
    return clean_flights(spark, sf).drop("ticket_price_usd_est")


@query("i10_clean_customers", f"WITH {data.CUSTOMERS_SQL} SELECT * FROM clean")
def i10(spark, sf):
    return customers.clean_customers(data.raw_customers(spark, sf))


_DETAIL = ("id_detalle", "id_venta", "cantidad", "monto_bruto", "monto_descuento", "monto_neto")


def _as_double(df, *columns):
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


@query("i11_sales_detail", f"""WITH {data.MARTS_SQL} SELECT id_detalle, id_venta, cantidad, CAST(monto_bruto AS DOUBLE) AS monto_bruto,
    CAST(monto_descuento AS DOUBLE) AS monto_descuento, CAST(monto_neto AS DOUBLE) AS monto_neto FROM fct_ventas""")
def i11(spark, sf):
    return _as_double(marts(spark, sf)["fct_ventas"].select(*_DETAIL), *_DETAIL[3:])


@query("i12_enriched_products", f"""WITH {data.MARTS_SQL} SELECT * EXCLUDE (costo_base, precio_lista, margen_unitario_teorico),
    CAST(costo_base AS DOUBLE) AS costo_base, CAST(precio_lista AS DOUBLE) AS precio_lista,
    CAST(margen_unitario_teorico AS DOUBLE) AS margen_unitario_teorico FROM dim_productos""")
def i12(spark, sf):
    return _as_double(marts(spark, sf)["dim_productos"], "costo_base", "precio_lista", "margen_unitario_teorico")


@query("i13_marts", f"""WITH {data.MARTS_SQL} SELECT 'dim_clientes' AS table_name, count(*) AS n_rows FROM dim_clientes UNION ALL
    SELECT 'dim_productos', count(*) FROM dim_productos UNION ALL SELECT 'dim_sucursales', count(*) FROM dim_sucursales
    UNION ALL SELECT 'fct_ventas', count(*) FROM fct_ventas""")
def i13(spark, sf):
    from cauce.sources.tables import inventory
    return inventory(marts(spark, sf))


@query("i13_dim_customers", f"WITH {data.MARTS_SQL} SELECT * FROM dim_clientes")
def i13c(spark, sf):
    return marts(spark, sf)["dim_clientes"]


_NOT_NULL = [(t, c) for t, columns in retail.NOT_NULL.items() for c in columns]
_UNIQUE = [(t, c) for t, columns in retail.UNIQUE.items() for c in columns]
UNIQUE_SQL = " UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, 'unique' AS check_name, '{c}' AS column_name, (SELECT count(*) FROM (
    SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)) AS failures""" for t, c in _UNIQUE)
NOT_NULL_SQL = " UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, 'not_null' AS check_name, '{c}' AS column_name,
    (SELECT count(*) FROM {t} WHERE {c} IS NULL) AS failures""" for t, c in _NOT_NULL)
RELATION_SQL = " UNION ALL ".join(
    f"""SELECT 'fct_ventas' AS table_name, 'relationship' AS check_name, '{c}' AS column_name, (SELECT count(*) FROM fct_ventas f
    WHERE f.{c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {d} p WHERE p.{c} = f.{c})) AS failures""" for c, d in retail.RELATIONS)
RULE_SQL = """SELECT 'fct_ventas' AS table_name, 'rule' AS check_name, 'lineas_monto_negativo' AS column_name, (SELECT count(*)
    FROM fct_ventas WHERE monto_bruto < 0 OR monto_neto < 0 OR monto_descuento < 0) AS failures
    UNION ALL SELECT 'fct_ventas', 'rule', 'lineas_inconsistencia_calculo', (SELECT count(*) FROM fct_ventas
    WHERE abs(monto_bruto - monto_descuento - monto_neto) > 0.05)"""


def _written_marts(spark, sf):
    """The whole retail run, marts and report written, without stopping at the failed checks."""
    return once(spark, sf, "layers", lambda: retail.run_layers(
        spark, data.raw_retail(spark, sf), new_path(spark, "layers"), strict=False))


@query("i14_run_layers", f"""WITH {data.MARTS_SQL}, report AS ({UNIQUE_SQL} UNION ALL {NOT_NULL_SQL} UNION ALL {RELATION_SQL}
    UNION ALL {RULE_SQL}) SELECT *, failures = 0 AS passed FROM report""")
def i14(spark, sf):
    return _written_marts(spark, sf).report


@query("i15_build_zone_dim", f"WITH {data.ZONES_SQL} SELECT * FROM zones")
def i15(spark, sf):
    return data.zones(spark, sf)


# ---------------------------------------------------------------- J
def _checks(spark, sf, make):
    from functools import reduce
    m = marts(spark, sf)
    return reduce(lambda a, b: a.unionByName(b), make(m))


@query("j01_unique", f"WITH {data.MARTS_SQL} {UNIQUE_SQL}")
def j01(spark, sf):
    return _checks(spark, sf, lambda m: [quality.check_unique(m[t], t, c) for t, c in _UNIQUE])


@query("j02_not_null", f"WITH {data.MARTS_SQL} {NOT_NULL_SQL}")
def j02(spark, sf):
    return _checks(spark, sf, lambda m: [quality.check_not_null(m[t], t, c) for t, c in retail.NOT_NULL.items()])


@query("j03_relationship", f"WITH {data.MARTS_SQL} {RELATION_SQL}")
def j03(spark, sf):
    return _checks(spark, sf, lambda m: [quality.check_relationship(m["fct_ventas"], "fct_ventas", c, m[d], c)
                                         for c, d in retail.RELATIONS])


@query("j04_negative_amounts", """SELECT 'customer' AS table_name, 'rule' AS check_name, 'negative_balance' AS column_name,
    count(*) FILTER (WHERE c_acctbal - 2000 < 0 OR c_custkey - 5 < 0) AS failures FROM customer""")
def j04(spark, sf):
    shifted = table(spark, sf, "customer").select((F.col("c_acctbal") - 2000).alias("a"), (F.col("c_custkey") - 5).alias("b"))
    return quality.check_rules(shifted, "customer", {"negative_balance": quality.any_negative(["a", "b"])})


@query("j05_arithmetic_consistency", f"""WITH {data.MARTS_SQL} SELECT count(*) AS failures FROM fct_ventas
    WHERE abs(monto_bruto - monto_descuento - monto_neto) > 0.05""")
def j05(spark, sf):
    return quality.check_rules(marts(spark, sf)["fct_ventas"], "fct_ventas", {
        "balance": quality.off_balance("monto_bruto", "monto_descuento", "monto_neto")}).select("failures")


@query("j06_duplicate_keys", f"WITH {data.MARTS_SQL} " + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) - count(DISTINCT {c}) AS duplicate_keys FROM {t}"
    for t, c in (("dim_clientes", "id_cliente"), ("dim_productos", "id_producto"), ("dim_sucursales", "id_sucursal"),
                 ("fct_ventas", "id_detalle"))))
def j06(spark, sf):
    m = marts(spark, sf)
    return quality.duplicate_keys({t: (m[t], retail.UNIQUE[t][0]) for t in retail.UNIQUE})


_CASES = [
    ("cliente", "rule", "id_nulo", "SELECT count(*) FROM raw_cliente WHERE id_cliente IS NULL"),
    ("producto", "rule", "precio_negativo", "SELECT count(*) FROM raw_producto WHERE precio_lista < 0"),
    ("venta", "relationship", "id_cliente", "SELECT count(*) FROM raw_venta WHERE id_cliente NOT IN (SELECT id_cliente FROM raw_cliente)"),
    ("venta_detalle", "rule", "cantidad_cero", "SELECT count(*) FROM raw_venta_detalle WHERE cantidad <= 0"),
    ("venta_detalle", "rule", "descuento_mayor_100", "SELECT count(*) FROM raw_venta_detalle WHERE descuento > 1"),
    ("inventario_bodega", "rule", "stock_negativo", "SELECT count(*) FROM raw_inventario_bodega WHERE stock_disponible < 0"),
    ("inventario_bodega", "rule", "vencido_al_corte",
     "SELECT count(*) FROM raw_inventario_bodega WHERE fecha_vencimiento < fecha_corte"),
    ("proveedores_precios", "rule", "costo_nulo", "SELECT count(*) FROM raw_proveedores_precios WHERE costo_proveedor IS NULL"),
    ("metas_ventas", "rule", "meta_cero", "SELECT count(*) FROM raw_metas_ventas WHERE meta_ventas <= 0"),
    ("devoluciones", "rule", "devolucion_mayor_venta", """SELECT count(*) FROM (SELECT id_venta, id_producto, sum(cantidad) AS r
      FROM raw_devoluciones GROUP BY 1, 2) JOIN (SELECT id_venta, id_producto, sum(cantidad) AS s FROM raw_venta_detalle
      GROUP BY 1, 2) USING (id_venta, id_producto) WHERE r > s"""),
]


@query("j07_quality_cases", f"WITH {data.RAW_RETAIL_SQL} " + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{k}' AS check_name, '{c}' AS column_name, ({q}) AS failures" for t, k, c, q in _CASES))
def j07(spark, sf):
    from functools import reduce
    return reduce(lambda a, b: a.unionByName(b), retail.quality_cases(data.raw_retail(spark, sf)))


@query("j08_split_overlap", """SELECT count(*) AS timestamps_en_dos_splits FROM (SELECT o_orderdate FROM orders GROUP BY 1
    HAVING count(DISTINCT o_orderstatus) > 1)""")
def j08(spark, sf):
    return quality.split_overlap(table(spark, sf, "orders"), "o_orderdate", "o_orderstatus")


@query("j09_dq_report", f"""WITH {data.MARTS_SQL}, report AS ({UNIQUE_SQL} UNION ALL {NOT_NULL_SQL} UNION ALL {RELATION_SQL}
    UNION ALL {RULE_SQL}) SELECT check_name, count(*) AS checks, count(*) FILTER (WHERE failures = 0) AS passed,
    CAST(sum(failures) AS BIGINT) AS failures FROM report GROUP BY 1""")
def j09(spark, sf):
    report = quality.dq_report(retail.mart_checks(marts(spark, sf)))
    return report.groupBy("check_name").agg(F.count(F.lit(1)).alias("checks"), F.count_if("passed").alias("passed"),
                                            F.sum("failures").alias("failures"))


# ---------------------------------------------------------------- K
_FLIGHT_MEASURES = """count(*) AS total_vuelos, CAST(sum(CAST(ticket_price_usd AS DECIMAL(14,2))) AS DOUBLE) AS ingresos_totales_usd,
    {delay} AS promedio_retraso_min""".format(delay=rnd("avg(delay_min)", 6))


def exact_measures():
    """The flight measures with the revenue summed as a decimal, so that row order cannot matter."""
    made = measures.flight_measures()
    return {**made, "ingresos_totales_usd": F.sum(F.col("ticket_price_usd").cast("decimal(14,2)")).cast("double"),
            "promedio_retraso_min": F.round(made["promedio_retraso_min"], 6)}


@query("k01_base_measures", f"WITH {data.FLIGHTS_SQL} SELECT status, {_FLIGHT_MEASURES} FROM flights GROUP BY 1")
def k01(spark, sf):
    return measures.measures(clean_flights(spark, sf), exact_measures(), by=["status"])


@query("k02_kpi_status", f"""WITH {data.FLIGHTS_SQL}, m AS (SELECT month(departure_datetime) AS mes,
    {rnd('avg(delay_min)', 6)} AS promedio_retraso_min FROM flights GROUP BY 1)
    SELECT *, CAST(15 AS DOUBLE) AS meta, CASE WHEN promedio_retraso_min <= 15 THEN 'verde' WHEN promedio_retraso_min > 15 THEN 'rojo' END
      AS estado_kpi, {rnd('100 * (15 - promedio_retraso_min) / 15', 2)} AS variacion_pct FROM m""")
def k02(spark, sf):
    monthly = clean_flights(spark, sf).groupBy(F.month("departure_datetime").alias("mes")).agg(
        F.round(F.avg("delay_min"), 6).alias("promedio_retraso_min"))
    return measures.kpi_status(monthly, "promedio_retraso_min", 15)


@query("k03_slicers", f"""WITH {data.FLIGHTS_SQL} SELECT airline_name, {_FLIGHT_MEASURES} FROM flights
    WHERE passenger_gender = 'Femenino' AND status IN ('DELAYED', 'ON_TIME') GROUP BY 1""")
def k03(spark, sf):
    return measures.measures(clean_flights(spark, sf), exact_measures(), ["airline_name"],
                             {"passenger_gender": ["Femenino"], "status": ["DELAYED", "ON_TIME"]})


@query("k04_drill_down", f"""WITH {data.FLIGHTS_SQL}, d AS (SELECT *, year(arrival_datetime) AS anio, quarter(arrival_datetime) AS trimestre,
    month(arrival_datetime) AS mes, day(arrival_datetime) AS dia FROM flights WHERE arrival_datetime IS NOT NULL)
    SELECT anio, trimestre, mes, dia, 4 - grouping(anio) - grouping(trimestre) - grouping(mes) - grouping(dia) AS nivel, {_FLIGHT_MEASURES}
    FROM d GROUP BY ROLLUP (anio, trimestre, mes, dia)""")
def k04(spark, sf):
    arrived = F.col("arrival_datetime")
    leveled = clean_flights(spark, sf).withColumns({
        "anio": F.year(arrived), "trimestre": F.quarter(arrived), "mes": F.month(arrived), "dia": F.dayofmonth(arrived)})
    return measures.drill_down(leveled, ["anio", "trimestre", "mes", "dia"], exact_measures(), keep=arrived.isNotNull())


@query("k05_ranking", f"""WITH {data.FLIGHTS_SQL} SELECT destination_airport, count(*) AS vuelos FROM flights
    WHERE status = 'DELAYED' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""")
def k05(spark, sf):
    late = measures.apply_slicers(clean_flights(spark, sf), {"status": ["DELAYED"]})
    return measures.ranking(late, ["destination_airport"], F.count(F.lit(1)), "vuelos", 5)


@query("k05_ranking_airline", f"""WITH {data.FLIGHTS_SQL} SELECT airline_name, count(*) AS vuelos FROM flights
    WHERE status = 'DELAYED' GROUP BY 1""")
def k05_airline(spark, sf):
    late = measures.apply_slicers(clean_flights(spark, sf), {"status": ["DELAYED"]})
    return measures.ranking(late, ["airline_name"], F.count(F.lit(1)), "vuelos")


@query("k05_daily_line", f"""WITH {data.FLIGHTS_SQL} SELECT CAST(departure_datetime AS DATE) AS dia, count(*) AS vuelos FROM flights
    WHERE status = 'DELAYED' GROUP BY 1""")
def k05_daily(spark, sf):
    late = measures.apply_slicers(clean_flights(spark, sf), {"status": ["DELAYED"]}).withColumn("dia", F.to_date("departure_datetime"))
    return measures.ranking(late, ["dia"], F.count(F.lit(1)), "vuelos").orderBy("dia")


@query("k06_current_versions", f"WITH {HISTORY_SQL} SELECT c_custkey, version, c_nationkey FROM dim WHERE es_actual")
def k06(spark, sf):
    return current_versions(customer_history(spark, sf).dimension).select("c_custkey", "version", "c_nationkey")
