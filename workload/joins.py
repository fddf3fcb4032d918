"""C: joins; E: windows; F: sort and top rows; G: set operations."""

from __future__ import annotations

from cauce.operators import joins, order, rows
from cauce.operators.aggregates import distribution, share_of_total, union_aligned
from cauce.operators.quantiles import exact_median
from cauce.plans import flights, retail, trips as trip_plans
from cauce.sources.scratch import materialise
from pyspark.sql import functions as F
from workload import data
from workload.data import once, table
from workload.registry import query, rnd


@query("c01_header_detail_join", f"WITH {data.MARTS_SQL} SELECT * FROM fct_ventas")
def c01(spark, sf):
    staged = retail.stage_all(data.raw_retail(spark, sf))
    return retail.sales_detail(staged["stg_ventas"], staged["stg_ventas_detalle"])


@query("c02_lookup_with_default", f"WITH {data.MARTS_SQL} SELECT id_producto, categoria, marca FROM dim_productos")
def c02(spark, sf):
    staged = retail.stage_all(data.raw_retail(spark, sf))
    named = joins.lookup_label(staged["stg_productos"], staged["stg_categorias"], "id_categoria", "id_categoria",
                               "nombre_categoria", "categoria", retail.NO_CATEGORY)
    named = joins.lookup_label(named, staged["stg_marcas"], "id_marca", "id_marca", "nombre_marca", "marca",
                               retail.NO_BRAND)
    return named.select("id_producto", "categoria", "marca")


@query("c03_role_playing_join", f"""WITH {data.TRIPS_SQL}, {data.ZONES_SQL} SELECT zp.borough AS origin_borough,
    zd.borough AS destination_borough, count(*) AS n FROM trips LEFT JOIN zones zp ON zp.location_id = pickup_location_id
    LEFT JOIN zones zd ON zd.location_id = dropoff_location_id GROUP BY ALL""")
def c03(spark, sf):
    placed = joins.role_play(data.trips(spark, sf), data.zones(spark, sf), "location_id", {
        "pickup_location_id": {"borough": "origin_borough"},
        "dropoff_location_id": {"borough": "destination_borough"}})
    return placed.groupBy("origin_borough", "destination_borough").agg(F.count(F.lit(1)).alias("n"))


@query("c04_star_join", """SELECT n_name, c_mktsegment, count(*) AS n,
    CAST(sum(CAST(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) AS revenue FROM orders JOIN customer ON c_custkey = o_custkey
    JOIN nation ON n_nationkey = c_nationkey GROUP BY ALL""")
def c04(spark, sf):
    per_customer = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.col("o_totalprice").cast("decimal(14,2)")).alias("_revenue"))
    named = (per_customer.join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
             .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")))
    return named.groupBy("n_name", "c_mktsegment").agg(
        F.sum("_n").alias("n"), F.sum("_revenue").cast("double").alias("revenue"))


AGG_ZONES_SQL = f"""origen AS (SELECT pickup_location_id AS location_id, count(*) AS viajes_origen, avg(fare_amount) AS f,
    avg(trip_distance) AS d, avg(tip_ratio) AS t FROM trips GROUP BY 1),
  destino AS (SELECT dropoff_location_id AS location_id, count(*) AS viajes_destino FROM trips GROUP BY 1),
  agg_zones AS (SELECT z.location_id, z.zone, z.borough, viajes_origen, viajes_destino, {rnd('f', 2)} AS fare_promedio,
    {rnd('d', 2)} AS distancia_promedio, {rnd('t', 4)} AS tip_ratio_promedio,
    rank() OVER (ORDER BY viajes_origen DESC) AS rank_origen
    FROM origen o LEFT JOIN destino e USING (location_id) LEFT JOIN zones z ON z.location_id = o.location_id)"""


def agg_zones(spark, sf):
    return once(spark, sf, "agg_zones", lambda: trip_plans.agg_zones(data.trips(spark, sf), data.zones(spark, sf)))


@query("c05_left_join_using", f"WITH {data.TRIPS_SQL}, {data.ZONES_SQL}, {AGG_ZONES_SQL} SELECT * FROM agg_zones")
def c05(spark, sf):
    return agg_zones(spark, sf)


_PARENTS = "c_nationkey <> 3"


@query("c06_orphans", f"""SELECT (SELECT count(*) FROM orders WHERE o_custkey NOT IN
    (SELECT c_custkey FROM customer WHERE {_PARENTS})) AS orphan_customers,
    (SELECT count(*) FROM lineitem l LEFT JOIN part ON l_partkey = p_partkey WHERE p_partkey IS NULL) AS orphan_parts""")
def c06(spark, sf):
    parents = table(spark, sf, "customer").where(_PARENTS)
    return joins.one_row(spark, {
        "orphan_customers": joins.count_orphans(table(spark, sf, "orders"), parents, "o_custkey", "c_custkey", "n"),
        "orphan_parts": joins.count_orphans(table(spark, sf, "lineitem"), table(spark, sf, "part"), "l_partkey",
                                            "p_partkey", "n")})


@query("c07_date_join", """WITH e AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1),
    f AS (SELECT day + 7 AS day, n AS expected FROM e) SELECT f.day, expected, e.n AS actual, e.n - expected AS error
    FROM f LEFT JOIN e USING (day)""")
def c07(spark, sf):
    daily = table(spark, sf, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    ahead = daily.select(F.date_add("day", 7).alias("day"), F.col("n").alias("expected"))
    return ahead.join(daily.withColumnRenamed("n", "actual"), "day", "left").withColumn(
        "error", F.col("actual") - F.col("expected"))


@query("c08_key_resolution", f"WITH {data.STAR_SQL} SELECT * FROM fact")
def c08(spark, sf):
    return star(spark, sf).fact


def star(spark, sf):
    """The flights star of the supplied orders, loaded into tables once."""
    def load():
        made = flights.load_star(clean_flights(spark, sf), data.LOAD_TS, order=["file_order"])
        dims = {name: materialise(dim, name) for name, dim in made.dims.items()}
        return flights.FlightStar(dims, materialise(flights.build_fact(clean_flights(spark, sf), dims), "fact"))
    return once(spark, sf, "star", load)


def clean_flights(spark, sf):
    return once(spark, sf, "flights", lambda: flights.transform_flights(data.raw_flights(spark, sf), ["file_order"]))


@query("c09_scalar_subqueries", """SELECT (SELECT count(*) FROM orders) AS n_orders, (SELECT count(*) FROM lineitem) AS n_lines,
    (SELECT max(o_orderdate) FROM orders) AS last_order""")
def c09(spark, sf):
    orders = table(spark, sf, "orders")
    return joins.one_row(spark, {
        "n_orders": orders.agg(F.count(F.lit(1))), "n_lines": table(spark, sf, "lineitem").agg(F.count(F.lit(1))),
        "last_order": orders.agg(F.max("o_orderdate"))})


@query("c10_change_detection", """SELECT c_custkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'insert'
    WHEN c_custkey % 7 = 0 OR c_custkey % 5 = 0 THEN 'change' ELSE 'keep' END AS action FROM customer""")
def c10(spark, sf):
    now = table(spark, sf, "customer").select("c_custkey", "c_mktsegment",
                                              F.when(F.col("c_custkey") % 5 != 0, F.col("c_acctbal")).alias("balance"))
    known = table(spark, sf, "customer").where("c_mktsegment <> 'MACHINERY'").select(
        F.col("c_custkey").alias("k"),
        F.when(F.col("c_custkey") % 7 == 0, "OTHER").otherwise(F.col("c_mktsegment")).alias("old_segment"),
        F.col("c_acctbal").alias("old_balance"))
    differs = joins.changed([(F.col("old_segment"), F.col("c_mktsegment")), (F.col("old_balance"), F.col("balance"))])
    return now.join(known, F.col("c_custkey") == F.col("k"), "left").select(
        "c_custkey", F.when(F.col("k").isNull(), "insert").when(differs, "change").otherwise("keep").alias("action"))


# ---------------------------------------------------------------- E
@query("e01_rank_after_join", """WITH n AS (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1)
    SELECT n_name, n, rank() OVER (ORDER BY n DESC) AS position FROM n JOIN nation ON n_nationkey = c_nationkey""")
def e01(spark, sf):
    counts = table(spark, sf, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    named = counts.join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("n_name", "n")
    return order.rank_descending(named, "n", "position")


@query("e02_share_of_total", f"""SELECT s_suppkey, s_acctbal, {rnd('100 * s_acctbal / sum(s_acctbal) OVER ()', 2)} AS pct
    FROM supplier""")
def e02(spark, sf):
    return share_of_total(table(spark, sf, "supplier").select("s_suppkey", "s_acctbal"), "s_acctbal", "pct")


@query("e03_share_over_aggregate", f"""SELECT o_orderstatus AS status, count(*) AS n,
    {rnd('100.0 * count(*) / sum(count(*)) OVER ()', 2)} AS pct FROM orders GROUP BY 1""")
def e03(spark, sf):
    return distribution(table(spark, sf, "orders"), "o_orderstatus", "status")


@query("e04_group_value_to_rows", """SELECT c_custkey, c_acctbal,
    median(c_acctbal) OVER (PARTITION BY c_mktsegment) AS segment_median FROM customer""")
def e04(spark, sf):
    customers = table(spark, sf, "customer")
    medians = exact_median(customers, "c_acctbal", "segment_median", ["c_mktsegment"])
    return customers.join(joins.small_side(medians), "c_mktsegment", "left").select("c_custkey", "c_acctbal", "segment_median")


@query("e05_keep_first", """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax) AS rn FROM lineitem)
    WHERE rn = 1""")
def e05(spark, sf):
    return rows.keep_first(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"],
                           ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax"])


# ---------------------------------------------------------------- F, G
@query("f01_order_by_many", """SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY ALL""")
def f01(spark, sf):
    counts = table(spark, sf, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.abs(F.col("c_nationkey") - 12), F.asc("c_mktsegment"), "c_nationkey")


@query("f02_top_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def f02(spark, sf):
    return rows.top_n(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 10,
                      [F.desc("o_totalprice"), "o_orderkey"])


@query("f03_rank_filter", f"""WITH {data.TRIPS_SQL}, {data.ZONES_SQL}, {AGG_ZONES_SQL}
    SELECT * FROM agg_zones WHERE rank_origen <= 15""")
def f03(spark, sf):
    return trip_plans.dash_zones_top(agg_zones(spark, sf))


@query("f04_argmax", """SELECT o_orderstatus, arg_max(o_orderkey, (o_totalprice, o_orderkey)) AS top_order FROM orders GROUP BY 1""")
def f04(spark, sf):
    return table(spark, sf, "orders").groupBy("o_orderstatus").agg(
        F.max_by("o_orderkey", F.struct("o_totalprice", "o_orderkey")).alias("top_order"))


@query("g01_union_all", """SELECT 'orders' AS source, o_orderstatus AS status, count(*) AS n FROM orders GROUP BY ALL
    UNION ALL SELECT 'lineitem', l_linestatus, count(*) FROM lineitem GROUP BY ALL""")
def g01(spark, sf):
    return union_aligned([
        table(spark, sf, name).groupBy(F.lit(name).alias("source"), F.col(c).alias("status")).agg(F.count(F.lit(1)).alias("n"))
        for name, c in (("orders", "o_orderstatus"), ("lineitem", "l_linestatus"))])


@query("g02_stacked_distinct", """SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier""")
def g02(spark, sf):
    pairs = union_aligned([table(spark, sf, "customer").select(F.col("c_nationkey").alias("a")),
                           table(spark, sf, "supplier").select(F.col("s_nationkey").alias("b"))])
    return rows.stacked_distinct(pairs, ["a", "b"], "nation")


@query("g03_distinct_rows", f"WITH {data.RAW_CUSTOMERS_SQL} SELECT DISTINCT * FROM raw_customers")
def g03(spark, sf):
    return rows.distinct_rows(data.raw_customers(spark, sf))
