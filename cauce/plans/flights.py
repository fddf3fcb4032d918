"""Flight bookings: cleaning, star schema with a history-keeping passenger, business queries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from cauce.functions.casts import parse_decimal, safe_int
from cauce.functions.dates import date_key, parse_mixed_timestamp
from cauce.functions.maps import canonical_name, map_or_keep, map_value
from cauce.functions.text import normalize_code, title_case
from cauce.operators import dims
from cauce.operators.aggregates import decimal_mean, share_of_total
from cauce.operators.history import HistoryMerge, current_versions, merge_history
from cauce.operators.joins import KeyLookup, resolve_keys
from cauce.operators.order import number_rows
from cauce.operators.quantiles import exact_median
from cauce.operators.rows import default_where, keep_first, null_where
from cauce.sources.scratch import materialise

# Airline codes and official names.
AIRLINES = {
    "FR": "Ryanair", "AV": "Avianca", "IB": "Iberia", "DL": "Delta",
    "WN": "Southwest", "AA": "American Airlines", "AM": "Aeromexico",
    "B6": "JetBlue", "BA": "British Airways", "CM": "Copa Airlines",
    "LA": "LATAM", "UA": "United",
}
# Gender spellings and their classes.
GENDERS = {
    "M": "Masculino", "m": "Masculino", "MASCULINO": "Masculino",
    "F": "Femenino", "f": "Femenino", "FEMENINO": "Femenino",
    "X": "Otro / Prefiere no decir", "x": "Otro / Prefiere no decir",
    "NOBINARIO": "No binario",
}
GENDER_UNKNOWN = "Desconocido"
# Gender spellings and codes of the second variant.
GENDER_CODES = {
    "m": "M", "masculino": "M", "Masculino": "M", "M": "M",
    "f": "F", "femenino": "F", "Femenino": "F", "F": "F",
    "x": "X", "nobinario": "X", "NoBinario": "X", "X": "X",
}
# Fill-ins for missing attributes.
NATIONALITY_UNKNOWN = "XX"
CHANNEL_UNKNOWN = "DESCONOCIDO"

TIMES = ("departure_datetime", "arrival_datetime", "booking_datetime")
PASSENGER_ATTRIBUTES = ("genero", "edad", "nacionalidad")


def impute_age(df: DataFrame, column: str = "passenger_age") -> DataFrame:
    """Missing ages take the exact median; every age is then cut to whole years."""
    median = exact_median(df, column, "_median").scalar()
    return df.withColumn(column, F.coalesce(F.col(column).cast("double"), median).cast("int"))


def transform_flights(raw: DataFrame, order: Sequence[str] = (), genders: Mapping[str, str] = GENDERS) -> DataFrame:
    """One row per record with normal codes, names, genders, times, prices and filled attributes.

    The tidy rows are written once; the median is taken from that table's age column and filled in
    as it is read back.
    """
    first = keep_first(raw, ["record_id"], order)
    airline = normalize_code(F.col("airline_code"))
    numbers = {c: F.col(c).try_cast("double") for c in ("passenger_age", "duration_min", "delay_min")}
    tidy = first.withColumns({
        "origin_airport": normalize_code(F.col("origin_airport")),
        "destination_airport": normalize_code(F.col("destination_airport")),
        "airline_code": airline,
        "airline_name": canonical_name(airline, F.col("airline_name"), AIRLINES),
        "passenger_gender": map_value(F.col("passenger_gender"), genders, GENDER_UNKNOWN),
        "passenger_nationality": F.coalesce("passenger_nationality", F.lit(NATIONALITY_UNKNOWN)),
        "sales_channel": F.coalesce("sales_channel", F.lit(CHANNEL_UNKNOWN)),
        "ticket_price": parse_decimal(F.col("ticket_price")),
        "ticket_price_usd": F.bround(F.col("ticket_price_usd_est").try_cast("double"), 2),
        "bags_total": safe_int(F.col("bags_total")),
        "bags_checked": safe_int(F.col("bags_checked")),
        **{c: parse_mixed_timestamp(F.col(c)) for c in TIMES},
        **numbers,
    })
    return impute_age(materialise(tidy, "flights"))


def transform_flights_variant(raw: DataFrame) -> DataFrame:
    """The second cleaning: gender codes, cancelled flights without times, on-time without delay = 0."""
    tidy = raw.withColumns({
        "origin_airport": F.upper("origin_airport"),
        "destination_airport": F.upper("destination_airport"),
        "airline_name": title_case(F.col("airline_name")),
        "passenger_gender": map_or_keep(F.col("passenger_gender"), GENDER_CODES),
        "ticket_price": parse_decimal(F.col("ticket_price")),
        **{c: parse_mixed_timestamp(F.col(c)) for c in TIMES},
        **{c: F.col(c).try_cast("double") for c in ("duration_min", "delay_min")},
    })
    cancelled = F.col("status") == "CANCELLED"
    cleared = null_where(tidy, cancelled, ["arrival_datetime", "delay_min", "duration_min"])
    return default_where(cleared, F.col("status") == "ON_TIME", "delay_min", 0.0)


@dataclass(frozen=True)
class FlightStar:
    """Dimensions by name, the fact, and what the batch did to the passenger history, if one is kept."""

    dims: dict[str, DataFrame]
    fact: DataFrame
    passengers: HistoryMerge | None = None


# Source columns, business column and surrogate of the value dimensions.
VALUE_DIMS = {
    "dim_aeropuerto": dims.ValueDim(("origin_airport", "destination_airport"), "codigo_iata", "aeropuerto_key"),
    "dim_aeronave": dims.ValueDim(("aircraft_type",), "aircraft_type", "aeronave_key"),
    "dim_clase_cabina": dims.ValueDim(("cabin_class",), "cabin_class", "clase_key"),
    "dim_canal_venta": dims.ValueDim(("sales_channel",), "sales_channel", "canal_key"),
    "dim_metodo_pago": dims.ValueDim(("payment_method",), "payment_method", "metodo_pago_key"),
    "dim_estado_vuelo": dims.ValueDim(("status",), "status", "estado_key"),
}
# The same for the second star.
VARIANT_DIMS = {
    "Dim_Aeropuerto": dims.ValueDim(("origin_airport", "destination_airport"), "Airport_Code", "Aeropuerto_SK"),
    "Dim_Estado_Vuelo": dims.ValueDim(("status",), "Status_Name", "Estado_Vuelo_SK"),
    "Dim_Canal_Venta": dims.ValueDim(("sales_channel",), "Channel_Name", "Canal_Venta_SK"),
    "Dim_Metodo_Pago": dims.ValueDim(("payment_method",), "Payment_Name", "Metodo_Pago_SK"),
    "Dim_Vuelo": dims.ValueDim(("flight_number",), "Flight_Number", "Vuelo_SK"),
}


def _passengers(flights: DataFrame, order: Sequence[str]) -> DataFrame:
    return flights.select("passenger_id", F.col("passenger_gender").alias("genero"),
                          F.col("passenger_age").alias("edad"),
                          F.col("passenger_nationality").alias("nacionalidad"), *order)


def build_fact(flights: DataFrame, star: Mapping[str, DataFrame], on_missing: str = "error") -> DataFrame:
    """One row per flight record: ten keys, three times, five measures; cancelled NULLs stay."""
    airports = star["dim_aeropuerto"]
    single = {name: spec for name, spec in VALUE_DIMS.items() if name != "dim_aeropuerto"}
    keyed = resolve_keys(flights, [
        KeyLookup("airline_code", star["dim_aerolinea"], "airline_code", "aerolinea_key", "aerolinea_key"),
        KeyLookup("origin_airport", airports, "codigo_iata", "aeropuerto_key", "origen_key"),
        KeyLookup("destination_airport", airports, "codigo_iata", "aeropuerto_key", "destino_key"),
        *[KeyLookup(spec.columns[0], star[name], spec.business, spec.surrogate, spec.surrogate)
          for name, spec in single.items()],
        KeyLookup("passenger_id", current_versions(star["dim_pasajero"]), "passenger_id", "pasajero_key",
                  "pasajero_key"),
    ], on_missing)
    return keyed.select(
        F.col("record_id").cast("long").alias("record_id"), "flight_number",
        date_key(F.col("departure_datetime")).alias("fecha_salida_key"),
        "aerolinea_key", "origen_key", "destino_key",
        *[spec.surrogate for spec in single.values()], "pasajero_key",
        F.col("departure_datetime").alias("fecha_hora_salida"),
        F.col("arrival_datetime").alias("fecha_hora_llegada"),
        F.col("booking_datetime").alias("fecha_hora_reserva"),
        "seat", F.col("duration_min").cast("int").alias("duration_min"),
        F.col("delay_min").cast("int").alias("delay_min"),
        "ticket_price_usd", "bags_total", "bags_checked")


def load_star(flights: DataFrame, load_ts: datetime, existing: Mapping[str, DataFrame] | None = None,
              order: Sequence[str] = (), on_missing: str = "error") -> FlightStar:
    """All dimensions grown by the batch, and the batch's fact rows.

    Every dimension and the fact read ``flights``: hand in a written table, such as
    ``transform_flights`` gives.
    """
    known = existing or {}
    star = dims.build_value_dims(flights, VALUE_DIMS, known)
    star["dim_aerolinea"] = dims.build_pair_dim(
        flights, "airline_code", "airline_name", "aerolinea_key", known.get("dim_aerolinea"), order)
    star["dim_fecha"] = dims.build_calendar(flights, "departure_datetime", known.get("dim_fecha"))
    merged = merge_history(known.get("dim_pasajero"), _passengers(flights, order), "passenger_id",
                           PASSENGER_ATTRIBUTES, load_ts, order)
    star["dim_pasajero"] = merged.dimension
    return FlightStar(star, build_fact(flights, star, on_missing), merged)


def build_fact_variant(flights: DataFrame, star: Mapping[str, DataFrame]) -> DataFrame:
    """The second fact: eight dimensions by left lookup, two day keys, unknown members as NULL."""
    airports = star["Dim_Aeropuerto"]
    keyed = resolve_keys(flights, [
        KeyLookup("flight_number", star["Dim_Vuelo"], "Flight_Number", "Vuelo_SK", "Vuelo_SK"),
        KeyLookup("airline_code", star["Dim_Aerolinea"], "Airline_Code", "Aerolinea_SK", "Aerolinea_SK"),
        KeyLookup("origin_airport", airports, "Airport_Code", "Aeropuerto_SK", "Origen_Aeropuerto_SK"),
        KeyLookup("destination_airport", airports, "Airport_Code", "Aeropuerto_SK", "Destino_Aeropuerto_SK"),
        KeyLookup("passenger_id", star["Dim_Pasajero"], "Passenger_ID", "Pasajero_SK", "Pasajero_SK"),
        KeyLookup("status", star["Dim_Estado_Vuelo"], "Status_Name", "Estado_Vuelo_SK", "Estado_Vuelo_SK"),
        KeyLookup("sales_channel", star["Dim_Canal_Venta"], "Channel_Name", "Canal_Venta_SK", "Canal_Venta_SK"),
        KeyLookup("payment_method", star["Dim_Metodo_Pago"], "Payment_Name", "Metodo_Pago_SK", "Metodo_Pago_SK"),
    ])
    return keyed.select(
        F.col("record_id").alias("Record_ID"), "Vuelo_SK", "Aerolinea_SK", "Origen_Aeropuerto_SK",
        "Destino_Aeropuerto_SK",
        F.coalesce(date_key(F.col("departure_datetime")), F.lit(0)).alias("Salida_Tiempo_SK"),
        date_key(F.col("arrival_datetime")).alias("Llegada_Tiempo_SK"),
        "Pasajero_SK", "Estado_Vuelo_SK", "Canal_Venta_SK", "Metodo_Pago_SK",
        F.col("duration_min").alias("Duration_Min"), F.col("delay_min").alias("Delay_Min"),
        F.col("ticket_price_usd_est").alias("Ticket_Price_USD_Est"),
        F.col("bags_total").alias("Bags_Total"), F.col("bags_checked").alias("Bags_Checked"))


def load_star_variant(flights: DataFrame, order: Sequence[str] = ()) -> FlightStar:
    """The second star: plain first-row dimensions, observed days only."""
    batch = materialise(flights, "flights")
    passengers = keep_first(
        batch.select(F.col("passenger_id").alias("Passenger_ID"),
                     F.col("passenger_gender").alias("Gender"), F.col("passenger_age").alias("Age"),
                     F.col("passenger_nationality").alias("Nationality"), *order),
        ["Passenger_ID"], order).drop(*order)
    airlines = dims.build_pair_dim(batch, "airline_code", "airline_name", "Aerolinea_SK", order=order)
    star = {
        **dims.build_value_dims(batch, VARIANT_DIMS),
        "Dim_Aerolinea": airlines.withColumnsRenamed(
            {"airline_code": "Airline_Code", "airline_name": "Airline_Name"}),
        "Dim_Tiempo": dims.build_observed_dates(batch, ["departure_datetime", "arrival_datetime"]),
        "Dim_Pasajero": number_rows(passengers, ["Passenger_ID"], "Pasajero_SK"),
    }
    return FlightStar(star, build_fact_variant(batch, star))


def _star(fact: DataFrame, dim: DataFrame, key: str, fact_key: str | None = None) -> DataFrame:
    side = dim.withColumnRenamed(key, "_key")
    return fact.join(side, F.col(fact_key or key) == F.col("_key")).drop("_key")


def count_by(fact: DataFrame, dim: DataFrame, key: str, label: str, out: str, n: str = "total_vuelos",
             fact_key: str | None = None, top: int | None = None) -> DataFrame:
    """Fact rows per dimension label, most first.

    Rows are counted per key before the join, so the dimension meets keys and not facts.
    """
    per_key = fact.groupBy(F.col(fact_key or key).alias("_fact_key")).agg(F.count(F.lit(1)).alias("_n"))
    named = _star(per_key, dim.select(key, F.col(label).alias(out)), key, "_fact_key")
    counts = named.groupBy(out).agg(F.sum("_n").alias(n)).orderBy(F.desc(n), out)
    return counts.limit(top) if top else counts


def top_routes(fact: DataFrame, airports: DataFrame, top: int = 5) -> DataFrame:
    pairs = fact.groupBy("origen_key", "destino_key").agg(F.count(F.lit(1)).alias("_n"))
    codes = airports.select("aeropuerto_key", "codigo_iata")
    named = _star(pairs, codes.withColumnRenamed("codigo_iata", "origen"), "aeropuerto_key", "origen_key")
    named = _star(named, codes.withColumnRenamed("codigo_iata", "destino"), "aeropuerto_key", "destino_key")
    return named.groupBy("origen", "destino").agg(F.sum("_n").alias("total_vuelos")).orderBy(
        F.desc("total_vuelos"), "origen", "destino").limit(top)


def passengers_by_gender(fact: DataFrame, passengers: DataFrame) -> DataFrame:
    counts = count_by(fact, passengers, "pasajero_key", "genero", "genero", "total_pasajeros")
    shares = share_of_total(counts, "total_pasajeros", "porcentaje")
    return shares.withColumn("porcentaje", F.col("porcentaje").cast("decimal(5,2)"))


def delayed_by_airline(fact: DataFrame, airlines: DataFrame, statuses: DataFrame, top: int = 5) -> DataFrame:
    late = _star(fact, statuses.where("status = 'DELAYED'").select("estado_key"), "estado_key")
    named = _star(late, airlines.select("aerolinea_key", "airline_name"), "aerolinea_key")
    return named.groupBy("airline_name").agg(
        F.count(F.lit(1)).alias("vuelos_retrasados"),
        F.avg(F.col("delay_min").cast("double")).alias("retraso_promedio_min"),
    ).orderBy(F.desc("vuelos_retrasados"), "airline_name").limit(top)


def revenue_by_class(fact: DataFrame, classes: DataFrame) -> DataFrame:
    named = _star(fact, classes.select("clase_key", "cabin_class"), "clase_key")
    price = F.col("ticket_price_usd").cast("decimal(12,2)")
    return named.groupBy("cabin_class").agg(
        F.count(F.lit(1)).alias("total_boletos"),
        F.sum(price).alias("ingreso_total_usd"),
        decimal_mean(price, "decimal(10,2)").alias("ticket_promedio_usd"),
    ).orderBy(F.desc("ingreso_total_usd"), "cabin_class")


def monthly_trend(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    days = calendar.select("fecha_key", "anio", "mes", "nombre_mes")
    price = F.col("ticket_price_usd").cast("decimal(12,2)")
    return _star(fact, days, "fecha_key", "fecha_salida_key").groupBy("anio", "mes", "nombre_mes").agg(
        F.count(F.lit(1)).alias("total_vuelos"),
        decimal_mean(price, "decimal(10,2)").alias("ticket_promedio_usd"),
    ).orderBy("anio", "mes")


def channel_by_payment(fact: DataFrame, channels: DataFrame, methods: DataFrame) -> DataFrame:
    pairs = fact.groupBy("canal_key", "metodo_pago_key").agg(F.count(F.lit(1)).alias("_n"))
    named = _star(pairs, channels.select("canal_key", "sales_channel"), "canal_key")
    named = _star(named, methods.select("metodo_pago_key", "payment_method"), "metodo_pago_key")
    return named.groupBy("sales_channel", "payment_method").agg(F.sum("_n").alias("total")).orderBy(
        "sales_channel", F.desc("total"), "payment_method")


def baggage_by_airline(fact: DataFrame, airlines: DataFrame) -> DataFrame:
    named = _star(fact, airlines.select("aerolinea_key", "airline_name"), "aerolinea_key")
    return named.groupBy("airline_name").agg(
        decimal_mean(F.col("bags_total"), "decimal(5,2)").alias("maletas_promedio"),
        decimal_mean(F.col("bags_checked"), "decimal(5,2)").alias("maletas_facturadas_promedio"),
    ).orderBy(F.desc("maletas_promedio"), "airline_name")
