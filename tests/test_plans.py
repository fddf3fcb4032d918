import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from cauce.operators import quality
from cauce.plans import customers, flights, retail, trips
from cauce.sources import publish
from cauce.sources.scratch import materialise
from cauce.sources.tables import load_idempotent

GOOD = dict(vendor_id="1.0", pickup_datetime="2022-05-05 10:00:00", dropoff_datetime="2022-05-05 10:10:00",
            passenger_count=1, trip_distance=2.0, rate_code="1.0", payment_type="1.0", fare_amount=10.0, extra=0.0,
            tip_amount=2.0, tolls_amount=0.0, total_amount=12.0, pickup_location_id="10", dropoff_location_id="20.0",
            store_and_fwd_flag="N")
SCHEMA = ("vendor_id string, pickup_datetime string, dropoff_datetime string, passenger_count int, trip_distance double, "
          "rate_code string, payment_type string, fare_amount double, extra double, tip_amount double, "
          "tolls_amount double, total_amount double, pickup_location_id string, dropoff_location_id string, "
          "store_and_fwd_flag string")


def raw_trips(spark, *changes):
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    rows = [tuple({**GOOD, **change}[n] for n in names) for change in changes]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({c: F.col(c).cast("timestamp") for c in ("pickup_datetime", "dropoff_datetime")})


BAD = [
    dict(dropoff_datetime="2022-05-05 10:00:00"), dict(dropoff_datetime="2022-05-05 09:00:00"),
    dict(dropoff_datetime="2022-05-05 14:01:00"), dict(dropoff_datetime="2022-05-05 10:00:59"),
    dict(trip_distance=0.0), dict(trip_distance=100.1), dict(passenger_count=0), dict(passenger_count=None),
    dict(passenger_count=10), dict(fare_amount=2.49), dict(fare_amount=500.5, total_amount=600.0),
    dict(total_amount=1000.01), dict(total_amount=9.0), dict(tip_amount=-1.0), dict(pickup_location_id="266"),
    dict(dropoff_location_id="0"), dict(rate_code="99.0"), dict(rate_code=None), dict(payment_type="0"),
    dict(payment_type="cash"), dict(pickup_datetime="2001-05-05 10:00:00", dropoff_datetime="2001-05-05 10:10:00"),
    dict(pickup_datetime=None),
]
EDGE = [
    dict(), dict(dropoff_datetime="2022-05-05 10:01:00"), dict(dropoff_datetime="2022-05-05 14:00:59"),
    dict(trip_distance=0.1), dict(trip_distance=100.0), dict(fare_amount=2.5), dict(fare_amount=500.0, total_amount=500.0),
    dict(total_amount=1000.0), dict(passenger_count=9), dict(tip_amount=0.0), dict(pickup_location_id="265"),
    dict(rate_code="6.0"),
]


def test_every_rule_drops_its_row(spark):
    assert trips.clean_trips(raw_trips(spark, *BAD)).count() == 0


def test_every_bound_is_kept_and_typed(spark):
    clean = trips.clean_trips(raw_trips(spark, *EDGE))
    assert clean.count() == len(EDGE) and len(clean.columns) == 17
    first = clean.where("trip_duration_minutes = 10").first()
    assert (first.vendor_id, first.dropoff_location_id, first.tip_ratio) == (1, 20, 0.2)


def test_profile_counts_at_least_the_dropped_rows(spark):
    raw = raw_trips(spark, *BAD, *EDGE)
    profile = trips.quality_profile(raw).first()
    assert profile.rate_code_ilegible == 1 and profile.rate_code_fuera_catalogo == 1
    assert profile.pasajeros_invalidos == 2 and profile.pasajeros_mayor_9 == 1
    kept = quality.retention(trips.clean_trips(raw), raw).first()
    assert (kept.filas_limpias, kept.filas_descartadas) == (len(EDGE), len(BAD))


def test_zone_rank_counts_duplicate_catalogue_rows(spark):
    raw = raw_trips(spark, *[dict(pickup_location_id=z) for z in ("1", "1", "2", "3")])
    zones = spark.createDataFrame([(1, "A", "x"), (1, "B", "x"), (2, "C", "y")], "location_id int, zone string, borough string")
    got = trips.agg_zones(trips.clean_trips(raw), zones).collect()
    assert sorted((r.zone or "-", r.viajes_origen, r.rank_origen) for r in got) == [
        ("-", 1, 3), ("A", 2, 1), ("B", 2, 1), ("C", 1, 3)]


def test_cleaning_reads_each_pushed_bound(spark, tmp_path):
    raw_trips(spark, *EDGE).write.parquet(str(tmp_path / "raw"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = trips.clean_trips(spark.read.parquet(str(tmp_path / "raw")))._jdf.queryExecution().toString()
    for pushed in ("GreaterThanOrEqual(trip_distance,0.1)", "LessThanOrEqual(fare_amount,500.0)", "GreaterThanOrEqual(tip_amount,0.0)"):
        assert pushed in plan


CUSTOMER = ("id_cliente int, nombre string, genero string, ciudad string, categoria string, fecha_registro string, "
            "gasto_q string")


def test_customer_cleaning(spark):
    raw = spark.createDataFrame([
        (1, "  ana  o'neil ", "f ", " nueva   YORK", "retail", "2024-01-02", "10,0"),
        (1, "  ana  o'neil ", "f ", " nueva   YORK", "retail", "2024-01-02", "10,0"),
        (2, "B", "q", "", " RETAIL ", "03/02/2024", "20.0"), (3, "C", None, None, "Retail", "31/02/2024", None),
        (4, "D", "M", "x", "food", "bad", "100"), (5, "E", "m", "x", None, "2024-01-01", "7000"),
    ], CUSTOMER)
    got = {r.id_cliente: r for r in customers.clean_customers(raw).collect()}
    assert len(got) == 5
    assert (got[1].nombre, got[1].genero, got[1].ciudad, got[1].gasto_q) == ("Ana O'Neil", "F", "Nueva York", 10.0)
    assert (got[2].genero, got[2].ciudad, got[2].fecha_registro) == ("No especificado", "Sin Dato", date(2024, 2, 3))
    assert got[3].gasto_q == 15.0 and got[3].fecha_registro is None
    # without a category the amount is lost first and replaced by the median of what is filled by then
    assert got[5].gasto_q == 17.5


FLIGHT = dict(record_id="1", file_order=1, flight_number="X1", airline_code=" av", airline_name="whatever", origin_airport="gua ",
              destination_airport="mia", aircraft_type="A320", cabin_class="ECONOMY", passenger_gender="m",
              sales_channel=None, payment_method="CASH", status="ON_TIME", departure_datetime="05/01/2024 10:30",
              arrival_datetime="01-05-2024 01:30 PM", booking_datetime="01/01/2024 00:00", duration_min="180.0",
              delay_min=None, passenger_id="P1", passenger_age=None, passenger_nationality=None, ticket_price="10,5",
              ticket_price_usd_est="99.999", bags_total="2", bags_checked="1", seat="1A")


def raw_flights(spark, *changes):
    rows = [tuple({**FLIGHT, **c}.values()) for c in changes]
    kinds = ", ".join(f"{n} {'int' if n == 'file_order' else 'string'}" for n in FLIGHT)
    return spark.createDataFrame(rows, kinds)


def test_flight_cleaning_keeps_the_first_row_and_fills(spark):
    raw = raw_flights(spark, dict(file_order=2, seat="late"), dict(passenger_age="31.0"),
                      dict(record_id="2", file_order=3, passenger_age="36.0", status="CANCELLED", arrival_datetime=None),
                      dict(record_id="3", file_order=4, airline_code="qq", airline_name="air o'x", passenger_gender="nobinario"))
    got = {r.record_id: r for r in flights.transform_flights(raw, ["file_order"]).collect()}
    assert got["1"].seat == "1A" and got["1"].passenger_age == 31
    assert got["3"].passenger_age == 33  # the median 33.5, cut
    assert (got["1"].airline_name, got["3"].airline_name, got["3"].passenger_gender) == ("Avianca", "Air O'X", "No binario")
    assert got["1"].arrival_datetime == datetime(2024, 1, 5, 13, 30) and got["2"].arrival_datetime is None
    assert (got["1"].sales_channel, got["1"].passenger_nationality, got["1"].ticket_price_usd) == ("DESCONOCIDO", "XX", 100.0)


def test_second_batch_grows_the_star(spark):
    first = flights.load_star(flights.transform_flights(raw_flights(spark, {}), ["file_order"]), datetime(2026, 1, 1), order=["file_order"])
    known = {name: materialise(dim) for name, dim in first.dims.items()}
    batch = flights.transform_flights(raw_flights(
        spark, dict(record_id="9", origin_airport="AAA", passenger_gender="f", departure_datetime="07/01/2024 10:30"),
        dict(record_id="10", passenger_id="P2")), ["file_order"])
    second = flights.load_star(batch, datetime(2026, 2, 1), known, ["file_order"])
    airports = {r.codigo_iata: r.aeropuerto_key for r in second.dims["dim_aeropuerto"].collect()}
    assert airports == {"GUA": 1, "MIA": 2, "AAA": 3}
    assert second.dims["dim_fecha"].count() == 3
    versions = {(r.passenger_id, r.version, r.es_actual) for r in second.dims["dim_pasajero"].collect()}
    assert versions == {("P1", 1, False), ("P1", 2, True), ("P2", 1, True)}
    fact = {r.record_id: r for r in second.fact.collect()}
    assert fact[9].origen_key == 3 and fact[9].pasajero_key == 2 and fact[9].delay_min is None
    late = flights.count_by(second.fact, second.dims["dim_estado_vuelo"], "estado_key", "status", "status").collect()
    assert [(r.status, r.total_vuelos) for r in late] == [("ON_TIME", 2)]


def test_revenue_of_a_class_may_exceed_ten_billions(spark):
    fact = spark.createDataFrame([(1, 90_000_000.25), (1, 90_000_000.25), (2, 10.25)], "clase_key long, ticket_price_usd double").crossJoin(spark.range(200))
    classes = spark.createDataFrame([(1, "FIRST"), (2, "ECONOMY")], "clase_key long, cabin_class string")
    got = [(r.cabin_class, r.total_boletos, float(r.ingreso_total_usd)) for r in flights.revenue_by_class(fact, classes).collect()]
    assert got == [("FIRST", 400, 36_000_000_100.0), ("ECONOMY", 200, 2050.0)]


def test_flight_variant_clears_cancelled_and_zeroes_on_time(spark):
    raw = raw_flights(spark, {}, dict(record_id="2", status="CANCELLED", delay_min="5", passenger_gender=" zz "),
                      dict(record_id="3", status="DELAYED"))
    got = {r.record_id: r for r in flights.transform_flights_variant(raw).collect()}
    assert (got["1"].delay_min, got["2"].delay_min, got["3"].delay_min) == (0.0, None, None)
    assert got["2"].arrival_datetime is None and got["2"].duration_min is None and got["2"].passenger_gender == " zz "


def retail_raw(spark, **bad):
    at = "TIMESTAMP'2026-01-01 00:00:00' AS _extracted_at"
    tables = {
        "venta": f"SELECT 1 AS id_venta, '2024-01-01' AS fecha, 1 AS id_cliente, 1 AS id_sucursal, ' Web ' AS canal, 'x' AS metodo_pago, 'COMPLETADA' AS estado, {at}",
        "venta_detalle": f"SELECT 1 AS id_detalle, 1 AS id_venta, 1 AS id_producto, 3 AS cantidad, 10.005BD AS precio_unitario, 0.1BD AS descuento, {bad.get('net', '27.02')}BD AS subtotal, {at}",
        "producto": f"SELECT 1 AS id_producto, ' S ' AS sku, 'n' AS nombre, 1 AS id_categoria, 7 AS id_marca, 'u' AS unidad_medida, 1.5BD AS costo_base, 2BD AS precio_lista, cast(NULL AS boolean) AS activo, {at}",
        "cliente": f"SELECT {bad.get('customer', '1')} AS id_cliente, 'n' AS nit, 'a' AS nombre, 't' AS tipo_cliente, 'm' AS municipio, 'd' AS departamento, '2020-01-01' AS fecha_alta, {at}",
        "sucursal": f"SELECT 1 AS id_sucursal, 'S' AS nombre, 'c' AS ciudad, 'd' AS departamento, {at}",
        "categoria": f"SELECT 1 AS id_categoria, 'Cat ' AS nombre, {at}",
        "marca": f"SELECT 1 AS id_marca, 'M' AS nombre, {at}",
    }
    return {name: spark.sql(sql) for name, sql in tables.items()}


def test_retail_layers(spark, tmp_path):
    run = retail.run_layers(spark, retail_raw(spark), str(tmp_path))
    product = spark.read.parquet(run.marts["dim_productos"]).first()
    assert (product.sku, product.categoria, product.marca, product.es_activo) == ("S", "Cat", "Sin Marca", True)
    assert float(product.margen_unitario_teorico) == 0.5
    line = spark.read.parquet(run.marts["fct_ventas"]).first()
    assert (line.canal_venta, float(line.monto_bruto), float(line.monto_descuento)) == ("Web", 30.03, 3.0)


@pytest.mark.parametrize("bad", [dict(net="20.00"), dict(customer="2")])
def test_retail_run_stops_on_failed_checks(spark, tmp_path, bad):
    with pytest.raises(retail.LayerFailure):
        retail.run_layers(spark, retail_raw(spark, **bad), str(tmp_path))


def test_run_over_written_marts_again(spark, tmp_path):
    for _ in range(2):
        run = retail.run_layers(spark, retail_raw(spark), str(tmp_path))
    assert spark.read.parquet(run.marts["fct_ventas"]).count() == 1


def test_a_failed_run_leaves_the_old_marts_published(spark, tmp_path):
    first = retail.run_layers(spark, retail_raw(spark), str(tmp_path))
    with pytest.raises(retail.LayerFailure):
        retail.run_layers(spark, retail_raw(spark, net="20.00"), str(tmp_path))
    held = publish.published(spark, str(tmp_path))
    assert {k: held[k] for k in first.marts} == first.marts
    assert float(publish.read_published(spark, str(tmp_path), "fct_ventas").first().monto_bruto) == 30.03


def test_a_rerun_goes_on_at_the_first_unfinished_step(spark, tmp_path, monkeypatch):
    def lost(_):
        raise RuntimeError("executors lost")
    with monkeypatch.context() as broken:
        broken.setattr(retail, "mart_checks", lost)
        with pytest.raises(RuntimeError, match="lost"):
            retail.run_layers(spark, retail_raw(spark), str(tmp_path), name="nightly")
    assert publish.published(spark, str(tmp_path)) == {}
    run = retail.run_layers(spark, retail_raw(spark), str(tmp_path), name="nightly")
    assert set(run.skipped) == set(run.marts) and spark.read.parquet(run.marts["fct_ventas"]).count() == 1
    again = retail.run_layers(spark, retail_raw(spark), str(tmp_path), name="nightly")
    assert again.skipped == () and again.marts != run.marts


def test_publications_switch_together_and_old_versions_are_removed(spark, tmp_path):
    root = str(tmp_path)
    for k in range(5):
        run = publish.Run(spark, root)
        for name in ("a", "b"):
            run.step(name, lambda: spark.range(k + 1))
        before = publish.published(spark, root)
        run.publish()
        assert set(publish.published(spark, root)) == {"a", "b"} and publish.published(spark, root) != before
    half = publish.Run(spark, root, "open")
    half.step("a", lambda: spark.range(9))
    assert publish.vacuum(spark, root, ["a", "b"]) == 4
    assert publish.read_published(spark, root, "b").count() == 5 and half.step("a", lambda: 1 / 0).count() == 9


def test_a_failed_load_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    load_idempotent(spark.range(3), path)
    with pytest.raises(Exception):
        load_idempotent(spark.range(5).select(F.raise_error(F.lit("no")).cast("long").alias("id")), path)
    assert spark.read.parquet(path).count() == 3
    load_idempotent(spark.read.parquet(path).where("id > 0"), path)
    assert spark.read.parquet(path).count() == 2


def test_unlisted_categories_stay_in_the_pivot(spark):
    from cauce.plans.customers import count_pivot
    df = spark.createDataFrame([(1, "X", "Food"), (2, "X", "Travel")], "id_cliente int, ciudad string, categoria string")
    row = count_pivot(df).first().asDict()
    assert row["Food"] == 1 and row["Travel"] == 1 and row["Retail"] == 0


def test_no_join_of_grouped_quantiles_is_on_the_bare_group(spark, many_slices):
    from cauce.operators.aggregates import box_plot
    from cauce.operators.quantiles import exact_quantiles
    settings = {"spark.sql.shuffle.partitions": "50", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = spark.range(20_000).selectExpr("id % 3 AS g", "cast(id % 5000 AS double) AS v")
        joins = []
        for result in (exact_quantiles(df, "v", {"m": 0.5}, ["g"]), box_plot(df, "g", "v")):
            result.collect()
            plan = result._jdf.queryExecution().executedPlan().toString()
            joins.append(re.findall(r"SortMergeJoin(?:\(skew=true\))? \[([^]]*)\]", plan))
        assert joins[0] and all("_slice" in keys for keys in joins[0])
        assert any("_slice" in keys for keys in joins[1])  # the others join one row per group
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
