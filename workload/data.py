"""Inputs in the shape the flows expect, derived from the supplied tables in Spark and in SQL alike."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from cauce.operators.dims import build_zone_dim
from cauce.operators.features import FeatureConfig
from cauce.plans.trips import TripRules, clean_trips
from cauce.sources.scratch import materialise

_memo: dict[tuple, object] = {}


def once(spark: SparkSession, sf: str, name: str, make: Callable[[], object]):
    """Build a shared input once per session and data folder."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _memo:
        _memo[key] = make()
    return _memo[key]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


LOAD_TS = datetime(2026, 1, 1, 6, 0, 0)
NEXT_TS = datetime(2026, 2, 1, 6, 0, 0)

# ---------------------------------------------------------------- trips
RULES = TripRules(years=(1996, 2000))
CONFIG = FeatureConfig(
    train_until=date(1999, 1, 1), eval_until=date(2000, 1, 1),
    holidays=tuple(date(y, m, d) for y in range(1996, 2001) for m, d in ((1, 1), (7, 4), (12, 25))))


def raw_trips(spark: SparkSession, sf: str) -> DataFrame:
    """The raw trip table, written once.

    The supplied line items are one row group, which only one task can read, so the rows are spread
    before the table is written, over as many parts as Spark finds right for their size.
    """
    return once(spark, sf, "raw-trips", lambda: materialise(
        _derived_trips(spark, sf).hint("rebalance"), "raw-trips"))


def _derived_trips(spark: SparkSession, sf: str) -> DataFrame:
    timed = table(spark, sf, "lineitem").withColumn("pickup_datetime", F.timestamp_add(
        "SECOND", (F.col("l_orderkey") * 37 + F.col("l_linenumber") * 1171) % 86400, F.col("l_shipdate")))
    seconds = F.col("l_quantity").cast("bigint") * 300 + F.col("l_partkey") % 97 * 7 - 400
    fare = "floor(l_extendedprice / 200) * 0.25D"
    tip = "CASE WHEN l_partkey % 31 = 0 THEN -0.5D ELSE round(l_discount * 100) * 0.5D END"
    return timed.withColumn("dropoff_datetime", F.timestamp_add("SECOND", seconds, F.col("pickup_datetime"))).selectExpr(
        "concat(l_linenumber % 2 + 1, '.0') AS vendor_id", "pickup_datetime", "dropoff_datetime",
        "CASE WHEN l_linenumber = 7 AND l_suppkey % 5 = 0 THEN NULL "
        "ELSE cast((l_linenumber + l_suppkey) % 11 AS int) END AS passenger_count",
        "cast((l_partkey % 480) * 0.25D AS decimal(12,2)) AS trip_distance",
        "CASE WHEN l_suppkey % 23 = 0 THEN NULL WHEN l_suppkey % 29 = 0 THEN '99.0' "
        "ELSE concat(l_suppkey % 6 + 1, '.0') END AS rate_code",
        "CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag",
        "concat(l_orderkey % 7, '.0') AS payment_type",
        f"{fare} AS fare_amount", "l_linenumber % 3 * 0.5D AS extra", "0.5D AS mta_tax", f"{tip} AS tip_amount",
        "round(l_tax * 100) * 0.25D AS tolls_amount", "0.3D AS improvement_surcharge",
        f"CASE WHEN l_suppkey % 41 = 0 THEN {fare} - 1 ELSE {fare} + l_linenumber % 3 * 0.5D + {tip} "
        "+ round(l_tax * 100) * 0.25D END AS total_amount", "0.0D AS airport_fee",
        "cast((l_partkey * 7 + l_suppkey) % 268 AS string) AS pickup_location_id",
        "cast((l_partkey + l_orderkey) % 268 AS string) AS dropoff_location_id")


_FARE = "floor(l_extendedprice / 200) * 0.25"
_TIP = "CASE WHEN l_partkey % 31 = 0 THEN -0.5 ELSE round(l_discount * 100) * 0.5 END"
RAW_TRIPS_SQL = f"""raw_trips AS (
  SELECT CAST(l_linenumber % 2 + 1 AS VARCHAR) || '.0' AS vendor_id, pickup_datetime,
    pickup_datetime + to_seconds(CAST(l_quantity AS BIGINT) * 300 + l_partkey % 97 * 7 - 400) AS dropoff_datetime,
    CASE WHEN l_linenumber = 7 AND l_suppkey % 5 = 0 THEN NULL
         ELSE CAST((l_linenumber + l_suppkey) % 11 AS INTEGER) END AS passenger_count,
    CAST((l_partkey % 480) * 0.25 AS DECIMAL(12,2)) AS trip_distance,
    CASE WHEN l_suppkey % 23 = 0 THEN NULL WHEN l_suppkey % 29 = 0 THEN '99.0'
         ELSE CAST(l_suppkey % 6 + 1 AS VARCHAR) || '.0' END AS rate_code,
    CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
    CAST(l_orderkey % 7 AS VARCHAR) || '.0' AS payment_type,
    CAST({_FARE} AS DOUBLE) AS fare_amount, CAST(l_linenumber % 3 * 0.5 AS DOUBLE) AS extra,
    CAST({_TIP} AS DOUBLE) AS tip_amount, CAST(round(l_tax * 100) * 0.25 AS DOUBLE) AS tolls_amount,
    CAST(CASE WHEN l_suppkey % 41 = 0 THEN {_FARE} - 1
         ELSE {_FARE} + l_linenumber % 3 * 0.5 + {_TIP} + round(l_tax * 100) * 0.25 END AS DOUBLE) AS total_amount,
    CAST((l_partkey * 7 + l_suppkey) % 268 AS VARCHAR) AS pickup_location_id,
    CAST((l_partkey + l_orderkey) % 268 AS VARCHAR) AS dropoff_location_id
  FROM (SELECT *, l_shipdate + to_seconds((l_orderkey * 37 + l_linenumber * 1171) % 86400) AS pickup_datetime
        FROM lineitem))"""


def _int(text: str) -> str:
    return f"TRY_CAST(round(TRY_CAST({text} AS DOUBLE)) AS INTEGER)"


RULES_SQL = f"""dropoff_datetime > pickup_datetime
    AND date_sub('minute', pickup_datetime, dropoff_datetime) BETWEEN 1 AND 240
    AND trip_distance BETWEEN 0.1 AND 100 AND passenger_count BETWEEN 1 AND 9
    AND fare_amount BETWEEN 2.5 AND 500 AND total_amount BETWEEN 2.5 AND 1000
    AND total_amount >= fare_amount AND tip_amount >= 0
    AND {_int('pickup_location_id')} BETWEEN 1 AND 265 AND {_int('dropoff_location_id')} BETWEEN 1 AND 265
    AND {_int('rate_code')} BETWEEN 1 AND 6 AND {_int('payment_type')} BETWEEN 1 AND 6
    AND year(pickup_datetime) BETWEEN 1996 AND 2000"""
TRIPS_SQL = f"""{RAW_TRIPS_SQL}, trips AS (
  SELECT {_int('vendor_id')} AS vendor_id, pickup_datetime, dropoff_datetime,
    CAST(pickup_datetime AS DATE) AS pickup_date, passenger_count, CAST(trip_distance AS DOUBLE) AS trip_distance,
    {_int('rate_code')} AS rate_code, {_int('payment_type')} AS payment_type, fare_amount, extra, tip_amount,
    tolls_amount, total_amount, {_int('pickup_location_id')} AS pickup_location_id,
    {_int('dropoff_location_id')} AS dropoff_location_id,
    date_sub('minute', pickup_datetime, dropoff_datetime) AS trip_duration_minutes,
    tip_amount / NULLIF(fare_amount, 0) AS tip_ratio
  FROM raw_trips WHERE {RULES_SQL})"""
ZONES_SQL = """zones AS (
  SELECT TRY_CAST(zone_id AS INTEGER) AS location_id, zone_name AS zone, borough FROM (
    SELECT CAST(p_partkey % 268 AS VARCHAR) AS zone_id, min(p_name) AS zone_name, arg_max(p_type, p_partkey) AS borough
    FROM part GROUP BY 1))"""


def trips(spark: SparkSession, sf: str) -> DataFrame:
    return clean_trips(raw_trips(spark, sf), RULES)


def zones(spark: SparkSession, sf: str) -> DataFrame:
    catalogue = table(spark, sf, "part").groupBy((F.col("p_partkey") % 268).cast("string").alias("zone_id")).agg(
        F.min("p_name").alias("zone_name"), F.max_by("p_type", "p_partkey").alias("borough"))
    return once(spark, sf, "zones", lambda: materialise(build_zone_dim(catalogue), "zones"))


# ---------------------------------------------------------------- flights
_CODES = "['FR','AV','IB','DL','WN','AA','AM','B6','BA','CM','LA','UA','ZZ','YY']"
_AIRPORTS = "['GUA','BOG','CUN','LIM','JFK','MAD','MIA','PTY','SAL','SJO','MEX','LAX','EZE','GRU','SCL']"
_GENDERS = "['M','m','Masculino','F','f','Femenino','X','x','NoBinario',' masculino ','?']"
_CRAFT = "['A320','A350','B737','E190']"
_CLASSES = "['BUSINESS','ECONOMY','FIRST','PREMIUM_ECONOMY']"
_CHANNELS = "['AEROPUERTO','AGENCIA','APP','WEB']"
_PAYMENTS = "['CRYPTO','EFECTIVO','PAYPAL','TARJETA_CREDITO','TARJETA_DEBITO']"
# Both engines read the texts below; {pick} indexes a list from 1 and {mins} adds minutes.
_FLIGHT_BASE = """
  o_orderkey - CASE WHEN o_orderkey % 10 = 9 THEN 1 ELSE 0 END AS record_id,
  o_orderkey AS file_order,
  'FL' || lpad(CAST(o_custkey % 400 AS {text}), 4, '0') AS flight_number,
  {code} AS code, o_orderkey % 14 AS code_no, o_custkey, o_orderkey, o_totalprice, {origin} AS origin_code,
  {destination} AS destination_code, {craft} AS aircraft_type, {cabin} AS cabin_class, {gender} AS passenger_gender,
  CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE {channel} END AS sales_channel, {payment} AS payment_method,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'CANCELLED' WHEN '2-HIGH' THEN 'DELAYED'
    WHEN '3-MEDIUM' THEN 'DIVERTED' ELSE 'ON_TIME' END AS status,
  {departure} AS departure"""
_FLIGHT_COLUMNS = """
  record_id, file_order, flight_number,
  CASE WHEN o_orderkey % 5 = 0 THEN lower(code) WHEN o_orderkey % 7 = 0 THEN ' ' || code || ' ' ELSE code END AS airline_code,
  CASE WHEN code_no = 12 THEN 'zz o''brien air' ELSE 'YY LINEAS-AEREAS ' || CAST(code_no AS {text}) END AS airline_name,
  CASE WHEN o_orderkey % 4 = 0 THEN lower(origin_code) ELSE origin_code END AS origin_airport,
  CASE WHEN o_orderkey % 6 = 0 THEN lower(destination_code) ELSE destination_code END AS destination_airport,
  aircraft_type, cabin_class, passenger_gender, sales_channel, payment_method, status,
  {fmt_departure} AS departure_datetime,
  CASE WHEN status = 'CANCELLED' THEN NULL ELSE {fmt_arrival} END AS arrival_datetime,
  {fmt_booking} AS booking_datetime,
  CASE WHEN status = 'CANCELLED' THEN NULL ELSE CAST(60 + o_custkey % 600 AS {text}) || '.0' END AS duration_min,
  CASE WHEN status = 'CANCELLED' OR (status = 'ON_TIME' AND o_orderkey % 3 = 0) THEN NULL
    WHEN status = 'DELAYED' THEN CAST(o_orderkey % 240 + 1 AS {text}) || '.0' ELSE '0.0' END AS delay_min,
  'P' || lpad(CAST(o_custkey AS {text}), 8, '0') AS passenger_id,
  CASE WHEN o_custkey % 13 = 0 THEN NULL ELSE CAST(18 + o_custkey % 60 AS {text}) || '.0' END AS passenger_age,
  CASE WHEN o_custkey % 17 = 0 THEN NULL ELSE 'N' || CAST(o_custkey % 25 AS {text}) END AS passenger_nationality,
  CASE WHEN o_orderkey % 2 = 0 THEN replace(CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS {text}), '.', ',')
    ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS {text}) END AS ticket_price,
  o_totalprice / 5 AS ticket_price_usd_est,
  CAST(o_custkey % 4 AS {text}) AS bags_total, CAST(least(o_custkey % 4, o_orderkey % 3) AS {text}) AS bags_checked,
  CASE WHEN status = 'CANCELLED' THEN NULL ELSE CAST(o_orderkey % 40 + 1 AS {text}) || 'A' END AS seat"""


def _flight_select(dialect: str, source: str) -> str:
    spark = dialect == "spark"

    def pick(items: str, index: str) -> str:
        values = items.strip("[]")
        return f"element_at(array({values}), cast({index} as int) + 1)" if spark else f"({items})[{index} + 1]"

    def moment(base: str, minutes: str) -> str:
        return (f"timestampadd(MINUTE, {minutes}, {base})" if spark else f"{base} + to_minutes({minutes})")

    def rendered(ts: str, even: str) -> str:
        if spark:
            return (f"CASE WHEN {even} THEN date_format({ts}, 'dd/MM/yyyy HH:mm') "
                    f"ELSE date_format({ts}, 'MM-dd-yyyy hh:mm a') END")
        return (f"CASE WHEN {even} THEN strftime({ts}, '%d/%m/%Y %H:%M') "
                f"ELSE strftime({ts}, '%m-%d-%Y %I:%M %p') END")

    text = "string" if spark else "VARCHAR"
    base = _FLIGHT_BASE.format(
        text=text, code=pick(_CODES, "o_orderkey % 14"), origin=pick(_AIRPORTS, "o_custkey % 15"),
        destination=pick(_AIRPORTS, "(o_orderkey * 7 + 3) % 15"), craft=pick(_CRAFT, "o_custkey % 4"),
        cabin=pick(_CLASSES, "o_orderkey % 4"), gender=pick(_GENDERS, "o_custkey % 11"),
        channel=pick(_CHANNELS, "o_orderkey % 4"), payment=pick(_PAYMENTS, "o_orderkey % 5"),
        departure=moment("o_orderdate", "o_orderkey * 37 % 1440"))
    columns = _FLIGHT_COLUMNS.format(
        text=text, fmt_departure=rendered("departure", "o_orderkey % 2 = 0"),
        fmt_arrival=rendered(moment("departure", "60 + o_custkey % 600"), "o_orderkey % 2 = 1"),
        fmt_booking=rendered(moment("departure", "-1440 * (o_custkey % 90)"), "o_orderkey % 3 = 0"))
    return f"SELECT {columns} FROM (SELECT {base} FROM {source})"


def raw_flights(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(_flight_select("spark", "{orders}"), orders=table(spark, sf, "orders"))


def mixed_ts_sql(column: str) -> str:
    bare = f"trim({column})"
    return (f"CASE WHEN {bare} LIKE '%-%' THEN try_strptime({bare}, '%m-%d-%Y %I:%M %p') "
            f"ELSE try_strptime({bare}, '%d/%m/%Y %H:%M') END")


def title_sql(text: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all({text}, '[A-Za-z]+|[^A-Za-z]+'), "
            "lambda s: upper(s[1]) || lower(s[2:])), '')")


RAW_FLIGHTS_SQL = f"raw_flights AS ({_flight_select('duckdb', 'orders')})"
_AIRLINE_SQL = """CASE upper(trim(airline_code)) WHEN 'FR' THEN 'Ryanair' WHEN 'AV' THEN 'Avianca' WHEN 'IB' THEN 'Iberia'
  WHEN 'DL' THEN 'Delta' WHEN 'WN' THEN 'Southwest' WHEN 'AA' THEN 'American Airlines' WHEN 'AM' THEN 'Aeromexico'
  WHEN 'B6' THEN 'JetBlue' WHEN 'BA' THEN 'British Airways' WHEN 'CM' THEN 'Copa Airlines' WHEN 'LA' THEN 'LATAM'
  WHEN 'UA' THEN 'United'"""
GENDER_SQL = """CASE upper(trim(passenger_gender)) WHEN 'M' THEN 'Masculino' WHEN 'MASCULINO' THEN 'Masculino'
  WHEN 'F' THEN 'Femenino' WHEN 'FEMENINO' THEN 'Femenino' WHEN 'X' THEN 'Otro / Prefiere no decir'
  WHEN 'NOBINARIO' THEN 'No binario' ELSE 'Desconocido' END"""
FLIGHTS_SQL = f"""{RAW_FLIGHTS_SQL}, first_rows AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY file_order) AS rn FROM raw_flights)
  WHERE rn = 1), flights AS (
  SELECT record_id, file_order, flight_number, upper(trim(airline_code)) AS airline_code,
    {_AIRLINE_SQL} ELSE {title_sql('airline_name')} END AS airline_name,
    upper(trim(origin_airport)) AS origin_airport, upper(trim(destination_airport)) AS destination_airport,
    aircraft_type, cabin_class, {GENDER_SQL} AS passenger_gender,
    coalesce(sales_channel, 'DESCONOCIDO') AS sales_channel, payment_method, status,
    {mixed_ts_sql('departure_datetime')} AS departure_datetime, {mixed_ts_sql('arrival_datetime')} AS arrival_datetime,
    {mixed_ts_sql('booking_datetime')} AS booking_datetime, TRY_CAST(duration_min AS DOUBLE) AS duration_min,
    TRY_CAST(delay_min AS DOUBLE) AS delay_min, passenger_id,
    CAST(trunc(coalesce(TRY_CAST(passenger_age AS DOUBLE),
      (SELECT median(TRY_CAST(passenger_age AS DOUBLE)) FROM first_rows))) AS INTEGER) AS passenger_age,
    coalesce(passenger_nationality, 'XX') AS passenger_nationality,
    TRY_CAST(replace(ticket_price, ',', '.') AS DOUBLE) AS ticket_price,
    round_even(ticket_price_usd_est, 2) AS ticket_price_usd, CAST(bags_total AS INTEGER) AS bags_total,
    CAST(bags_checked AS INTEGER) AS bags_checked, seat
  FROM first_rows)"""


def _dim_sql(name: str, column: str, key: str) -> str:
    return (f"{name} AS (SELECT {column}, row_number() OVER (ORDER BY {column}) AS {key} "
            f"FROM (SELECT DISTINCT {column} FROM flights WHERE {column} IS NOT NULL))")


STAR_SQL = ", ".join([
    FLIGHTS_SQL,
    _dim_sql("dim_aeronave", "aircraft_type", "aeronave_key"), _dim_sql("dim_clase_cabina", "cabin_class", "clase_key"),
    _dim_sql("dim_canal_venta", "sales_channel", "canal_key"),
    _dim_sql("dim_metodo_pago", "payment_method", "metodo_pago_key"), _dim_sql("dim_estado_vuelo", "status", "estado_key"),
    """dim_aeropuerto AS (SELECT codigo_iata, row_number() OVER (ORDER BY codigo_iata) AS aeropuerto_key FROM (
         SELECT origin_airport AS codigo_iata FROM flights UNION SELECT destination_airport FROM flights))""",
    """dim_aerolinea AS (SELECT airline_code, airline_name, row_number() OVER (ORDER BY airline_code) AS aerolinea_key
         FROM (SELECT airline_code, arg_min(airline_name, file_order) AS airline_name FROM flights GROUP BY 1))""",
    """first_passengers AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY passenger_id ORDER BY file_order) AS pn
         FROM flights) WHERE pn = 1)""",
    """dim_pasajero AS (SELECT row_number() OVER (ORDER BY file_order) AS pasajero_key, passenger_id,
         passenger_gender AS genero, passenger_age AS edad, passenger_nationality AS nacionalidad, 1 AS version
         FROM first_passengers)""",
    """fact AS (SELECT f.record_id, f.flight_number,
         CAST(strftime(f.departure_datetime, '%Y%m%d') AS INTEGER) AS fecha_salida_key, al.aerolinea_key,
         o.aeropuerto_key AS origen_key, d.aeropuerto_key AS destino_key, an.aeronave_key, cc.clase_key, cv.canal_key,
         mp.metodo_pago_key, ev.estado_key, p.pasajero_key, f.departure_datetime AS fecha_hora_salida,
         f.arrival_datetime AS fecha_hora_llegada, f.booking_datetime AS fecha_hora_reserva, f.seat,
         CAST(f.duration_min AS INTEGER) AS duration_min, CAST(f.delay_min AS INTEGER) AS delay_min,
         f.ticket_price_usd, f.bags_total, f.bags_checked
       FROM flights f JOIN dim_aerolinea al USING (airline_code) JOIN dim_aeropuerto o ON o.codigo_iata = f.origin_airport
       JOIN dim_aeropuerto d ON d.codigo_iata = f.destination_airport JOIN dim_aeronave an USING (aircraft_type)
       JOIN dim_clase_cabina cc USING (cabin_class) JOIN dim_canal_venta cv USING (sales_channel)
       JOIN dim_metodo_pago mp USING (payment_method) JOIN dim_estado_vuelo ev USING (status)
       JOIN dim_pasajero p USING (passenger_id))""",
])

# ---------------------------------------------------------------- customers
_CUSTOMER_COLUMNS = """c_custkey AS id_cliente,
  CASE c_custkey % 3 WHEN 0 THEN '  o''NEIL   mary-ann ' || CAST(c_custkey AS {text}) || ' '
    WHEN 1 THEN lower(c_name) ELSE ' ' || c_name || ' del  VALLE' END AS nombre,
  CASE c_custkey % 7 WHEN 0 THEN 'M' WHEN 1 THEN 'm ' WHEN 2 THEN ' f' WHEN 3 THEN 'F' WHEN 4 THEN '' WHEN 5 THEN 'otro'
    ELSE NULL END AS genero,
  CASE c_custkey % 5 WHEN 0 THEN 'ciudad  ' || CAST(c_nationkey % 7 AS {text})
    WHEN 1 THEN '  CIUDAD ' || CAST(c_nationkey % 7 AS {text}) || ' '
    WHEN 2 THEN 'Ciudad ' || CAST(c_nationkey % 7 AS {text}) WHEN 3 THEN ' ' ELSE NULL END AS ciudad,
  CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE CASE c_custkey % 4 WHEN 0 THEN lower({category}) WHEN 1 THEN upper({category})
    WHEN 2 THEN '  ' || lower({category}) || ' ' ELSE {category} END END AS categoria,
  CASE WHEN c_custkey % 37 = 0 THEN '31/02/2020' WHEN c_custkey % 2 = 0 THEN {dmy} ELSE {ymd} END AS fecha_registro,
  CASE WHEN c_custkey % 10 = 3 THEN NULL
    WHEN c_custkey % 2 = 0 THEN replace(CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS {text}), '.', ',')
    ELSE CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS {text}) END AS gasto_q"""
_CATEGORY = """CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Education' WHEN 'BUILDING' THEN 'Food'
  WHEN 'FURNITURE' THEN 'Retail' ELSE 'Services' END"""


def _customer_select(dialect: str, source: str) -> str:
    if dialect == "spark":
        day = "date_add(DATE'2020-01-01', cast(c_custkey % 1000 as int))"
        parts = {"text": "string", "dmy": f"date_format({day}, 'dd/MM/yyyy')", "ymd": f"date_format({day}, 'yyyy-MM-dd')"}
    else:
        day = "(DATE '2020-01-01' + CAST(c_custkey % 1000 AS INTEGER))"
        parts = {"text": "VARCHAR", "dmy": f"strftime({day}, '%d/%m/%Y')", "ymd": f"strftime({day}, '%Y-%m-%d')"}
    once_ = f"SELECT {_CUSTOMER_COLUMNS.format(category=_CATEGORY, **parts)} FROM {source}"
    return f"{once_} UNION ALL {once_} WHERE c_acctbal > 9000"


def raw_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Every customer once, and some delivered twice."""
    return spark.sql(_customer_select("spark", "{customer}"), customer=table(spark, sf, "customer"))


RAW_CUSTOMERS_SQL = f"raw_customers AS ({_customer_select('duckdb', 'customer')})"


def name_sql(text: str) -> str:
    return f"regexp_replace({title_sql(f'trim({text})')}, '\\s+', ' ', 'g')"


STANDARD_CUSTOMERS_SQL = f"""{RAW_CUSTOMERS_SQL}, standard AS (
  SELECT id_cliente, {name_sql('nombre')} AS nombre,
    CASE WHEN upper(trim(genero)) IN ('M', 'F') THEN upper(trim(genero)) ELSE 'No especificado' END AS genero,
    coalesce(nullif({name_sql('ciudad')}, ''), 'Sin Dato') AS ciudad, {title_sql('trim(categoria)')} AS categoria,
    CAST(CASE WHEN fecha_registro LIKE '%/%' THEN try_strptime(fecha_registro, '%d/%m/%Y')
         ELSE try_strptime(fecha_registro, '%Y-%m-%d') END AS DATE) AS fecha_registro,
    TRY_CAST(replace(gasto_q, ',', '.') AS DOUBLE) AS gasto_q
  FROM (SELECT DISTINCT * FROM raw_customers))"""
CUSTOMERS_SQL = f"""{STANDARD_CUSTOMERS_SQL}, by_group AS (
  SELECT categoria AS g, median(gasto_q) AS m FROM standard WHERE categoria IS NOT NULL GROUP BY 1), grouped AS (
  SELECT s.* EXCLUDE (gasto_q), CASE WHEN categoria IS NOT NULL THEN coalesce(gasto_q, m) END AS gasto_q
  FROM standard s LEFT JOIN by_group ON g = categoria), clean AS (
  SELECT * EXCLUDE (gasto_q), round_even(coalesce(gasto_q, (SELECT median(gasto_q) FROM grouped)), 2) AS gasto_q
  FROM grouped)"""

# ---------------------------------------------------------------- retail
_RETAIL = {
    "venta": ("orders", """CAST(o_orderkey AS {long}) AS id_venta, CAST(o_orderdate AS {text}) AS fecha,
        o_custkey AS id_cliente, o_custkey % 25 AS id_sucursal, ' ' || o_orderpriority || ' ' AS canal,
        'PAGO ' || o_orderstatus AS metodo_pago,
        CASE o_orderstatus WHEN 'F' THEN ' COMPLETADA' WHEN 'O' THEN 'ANULADA' ELSE 'PENDIENTE' END AS estado"""),
    "venta_detalle": ("lineitem", """l_orderkey * 8 + l_linenumber AS id_detalle, l_orderkey AS id_venta,
        l_partkey AS id_producto, CAST(l_quantity AS {int}) AS cantidad,
        CAST(l_extendedprice AS DECIMAL(12,2)) AS precio_unitario, CAST(l_discount AS DECIMAL(5,4)) AS descuento,
        CAST(CAST(l_quantity AS {int}) * CAST(l_extendedprice AS DECIMAL(12,2))
          - round(CAST(l_quantity AS {int}) * CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(5,4)), 2)
          + CASE WHEN l_linenumber = 7 THEN 0.10 ELSE 0.00 END AS DECIMAL(14,2)) AS subtotal"""),
    "producto": ("part", """p_partkey AS id_producto, 'SKU-' || CAST(p_partkey AS {text}) AS sku, p_name || ' ' AS nombre,
        p_size % 8 AS id_categoria, CASE WHEN p_size % 9 = 0 THEN NULL ELSE p_size % 12 END AS id_marca,
        'unidad' AS unidad_medida, CAST(p_retailprice AS DECIMAL(12,2)) * CAST(0.5 AS DECIMAL(2,1)) AS costo_base,
        CAST(p_retailprice AS DECIMAL(12,2)) AS precio_lista,
        CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_size % 2 = 0 END AS activo"""),
    "cliente": ("customer", """c_custkey AS id_cliente, 'NIT' || CAST(c_custkey AS {text}) AS nit, ' ' || c_name AS nombre,
        c_mktsegment AS tipo_cliente, CAST(c_nationkey AS {text}) AS municipio,
        'DEPTO ' || CAST(c_nationkey % 5 AS {text}) AS departamento, '2020-01-15' AS fecha_alta"""),
    "sucursal": ("nation", """n_nationkey AS id_sucursal, n_name || '  ' AS nombre, 'C' || CAST(n_nationkey AS {text}) AS ciudad,
        'R' || CAST(n_regionkey AS {text}) AS departamento"""),
    "categoria": ("region", "r_regionkey AS id_categoria, ' ' || r_name AS nombre"),
    "marca": ("nation", "n_nationkey AS id_marca, n_name AS nombre"),
    "devoluciones": ("lineitem", """l_orderkey AS id_venta, l_partkey AS id_producto,
        CAST(l_quantity AS {int}) + CASE WHEN l_suppkey % 7 = 0 THEN 1 ELSE -1 END AS cantidad"""),
    "inventario_bodega": ("part", """p_partkey AS id_producto, p_size - 3 AS stock_disponible, CAST('2026-01-31' AS DATE) AS fecha_corte,
        CASE WHEN p_size % 6 = 0 THEN CAST('2025-12-31' AS DATE) ELSE CAST('2026-12-31' AS DATE) END AS fecha_vencimiento"""),
    "proveedores_precios": ("supplier", """s_suppkey AS id_proveedor,
        CASE WHEN s_suppkey % 10 = 0 THEN NULL ELSE CAST(s_acctbal AS DECIMAL(12,2)) END AS costo_proveedor"""),
    "metas_ventas": ("nation", """n_nationkey AS id_sucursal,
        CASE WHEN n_nationkey = 7 THEN 0 ELSE 1000 * n_nationkey + 1 END AS meta_ventas"""),
}


def raw_retail(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    types = {"long": "bigint", "int": "int", "text": "string"}
    return {
        name: spark.sql(f"SELECT {columns.format(**types)}, TIMESTAMP'2026-01-01 06:00:00' AS _extracted_at FROM {{src}}",
                        src=table(spark, sf, source))
        for name, (source, columns) in _RETAIL.items()
    }


RAW_RETAIL_SQL = ", ".join(
    f"raw_{name} AS (SELECT {columns.format(long='BIGINT', int='INTEGER', text='VARCHAR')} FROM {source})"
    for name, (source, columns) in _RETAIL.items())
MARTS_SQL = f"""{RAW_RETAIL_SQL},
  stg_ventas AS (SELECT CAST(id_venta AS BIGINT) AS id_venta, CAST(CAST(fecha AS TIMESTAMP) AS DATE) AS fecha_venta,
    CAST(id_cliente AS INTEGER) AS id_cliente, CAST(id_sucursal AS INTEGER) AS id_sucursal, trim(canal) AS canal_venta,
    trim(metodo_pago) AS metodo_pago, trim(estado) AS estado_venta FROM raw_venta WHERE id_venta IS NOT NULL),
  fct_ventas AS (SELECT d.id_detalle, v.id_venta, v.id_cliente, CAST(d.id_producto AS INTEGER) AS id_producto, v.id_sucursal,
    v.fecha_venta, v.canal_venta, v.metodo_pago, v.estado_venta, d.cantidad, d.precio_unitario,
    d.descuento AS porcentaje_descuento, CAST(d.cantidad * d.precio_unitario AS DECIMAL(14,2)) AS monto_bruto,
    CAST(round(d.cantidad * d.precio_unitario * d.descuento, 2) AS DECIMAL(14,2)) AS monto_descuento,
    d.subtotal AS monto_neto FROM raw_venta_detalle d JOIN stg_ventas v USING (id_venta)),
  dim_productos AS (SELECT CAST(p.id_producto AS INTEGER) AS id_producto, trim(p.sku) AS sku, trim(p.nombre) AS nombre_producto,
    p.id_categoria, coalesce(trim(c.nombre), 'Sin Categoría') AS categoria, p.id_marca,
    coalesce(trim(m.nombre), 'Sin Marca') AS marca, p.unidad_medida, CAST(p.costo_base AS DECIMAL(12,2)) AS costo_base,
    p.precio_lista, CAST(p.precio_lista - CAST(p.costo_base AS DECIMAL(12,2)) AS DECIMAL(12,2)) AS margen_unitario_teorico,
    coalesce(p.activo, true) AS es_activo
    FROM raw_producto p LEFT JOIN raw_categoria c USING (id_categoria) LEFT JOIN raw_marca m USING (id_marca)),
  dim_clientes AS (SELECT CAST(id_cliente AS INTEGER) AS id_cliente, nit, trim(nombre) AS nombre_cliente, tipo_cliente,
    municipio, departamento, CAST(fecha_alta AS DATE) AS fecha_alta FROM raw_cliente),
  dim_sucursales AS (SELECT CAST(id_sucursal AS INTEGER) AS id_sucursal, trim(nombre) AS nombre_sucursal, ciudad,
    departamento FROM raw_sucursal)"""
