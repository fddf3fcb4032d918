"""A: reading, landing, writing, layouts and catalogue."""

from __future__ import annotations

from cauce.sources import files, tables
from cauce.sources.scratch import materialise, new_path
from pyspark.sql import functions as F
from workload.data import LOAD_TS, once, table
from workload.registry import query


def _csv(spark, sf, name, sep=","):
    """A supplied table as a headed text file, written once."""
    def write():
        path = new_path(spark, f"{name}-csv")
        table(spark, sf, name).write.option("header", True).option("sep", sep).csv(path)
        return path
    return once(spark, sf, f"csv-{name}-{sep}", write)


def _typed_customer(text):
    return text.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name",
                       F.col("c_acctbal").cast("double").alias("c_acctbal"), "c_mktsegment")


_CUSTOMER = "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer"


@query("a01_read_csv", _CUSTOMER)
def a01(spark, sf):
    return _typed_customer(files.read_csv(spark, _csv(spark, sf, "customer")))


@query("a02_read_csv_sniffed", _CUSTOMER)
def a02(spark, sf):
    return _typed_customer(files.read_csv_sniffed(spark, _csv(spark, sf, "customer", ";")))


@query("a03_land_csv", """SELECT o_orderkey AS order_key,
    CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS priority,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS order_date FROM orders""")
def a03(spark, sf):
    dirty = table(spark, sf, "orders").selectExpr(
        "o_orderkey AS `Order Key`",
        "CASE o_orderkey % 5 WHEN 0 THEN element_at(array('nan', 'None', '  '), cast(o_orderkey % 3 AS int) + 1) "
        "ELSE concat('\\t', o_orderpriority, ' ') END AS ` Priority `",
        "CASE WHEN o_orderkey % 7 = 0 THEN 'soon' ELSE concat(' ', date_format(o_orderdate, 'yyyy-MM-dd')) END "
        "AS `ORDER DATE`")
    return files.land_csv(dirty, ["order_date"])


@query("a04_extract_full", "SELECT * FROM orders")
def a04(spark, sf):
    return tables.extract_full(spark, f"{sf}/orders.parquet")


@query("a05_with_audit", "SELECT *, TIMESTAMP '2026-01-01 06:00:00' AS _extracted_at FROM supplier")
def a05(spark, sf):
    return files.with_audit(table(spark, sf, "supplier"), LOAD_TS)


@query("a06_load_idempotent", "SELECT count(*) AS n, count(DISTINCT o_orderkey) AS n_keys FROM orders")
def a06(spark, sf):
    path = new_path(spark, "idempotent")
    for _ in range(2):
        tables.load_idempotent(table(spark, sf, "orders"), path)
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("o_orderkey").alias("n_keys"))


def _folder(spark, sf):
    """A folder of delimited files, one of which the load plan does not find."""
    def write():
        folder = new_path(spark, "incoming")
        for name in ("customer", "supplier"):
            table(spark, sf, name).write.option("header", True).csv(f"{folder}/{name}.csv")
        return folder
    return once(spark, sf, "incoming", write)


@query("a07_load_file_map", """SELECT 'customers' AS table_name, count(*) AS n_rows FROM customer
    UNION ALL SELECT 'suppliers', count(*) FROM supplier""")
def a07(spark, sf):
    written = files.load_file_map(
        spark, _folder(spark, sf),
        {"customer.csv": files.FileSpec("customers"), "supplier.csv": files.FileSpec("suppliers"),
         "stock.csv": files.FileSpec("stock", ("cutoff",))},
        new_path(spark, "landed"), LOAD_TS)
    return tables.inventory({name: spark.read.parquet(path) for name, path in written.items()})


@query("a08_load_quality_cases", "SELECT s_suppkey AS id, s_name AS entity FROM supplier")
def a08(spark, sf):
    def write():
        folder = new_path(spark, "cases")
        table(spark, sf, "supplier").select(F.col("s_suppkey").alias("Id"), F.concat(
            F.lit(" "), "s_name").alias("Entity")).write.option("header", True).csv(f"{folder}/cases.csv")
        return folder
    written = files.load_file_map(
        spark, once(spark, sf, "cases", write), {"cases.csv": files.FileSpec("cases", required=False)},
        new_path(spark, "landed"), LOAD_TS)
    return spark.read.parquet(written["cases"]).select(F.col("id").cast("bigint").alias("id"), "entity")


@query("a09_append_load", """SELECT o_orderstatus, 2 * count(*) AS n,
    CAST(2 * sum(CAST(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) AS total FROM orders GROUP BY 1""")
def a09(spark, sf):
    path = new_path(spark, "appended")
    for _ in range(2):
        tables.append_load(table(spark, sf, "orders"), path, ["o_orderstatus"])
    return spark.read.parquet(path).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(14,2)")).cast("double").alias("total"))


@query("a10_create_empty_like", """SELECT column_name AS "column", 0 AS n_rows FROM information_schema.columns
    WHERE table_name = 'lineitem'""")
def a10(spark, sf):
    path = new_path(spark, "empty")
    source = table(spark, sf, "lineitem")
    tables.create_empty_like(source, path)
    back = spark.read.parquet(path)
    n = back.agg(F.count(F.lit(1))).scalar()
    return tables.schema_table(back).select("column", n.alias("n_rows"))


@query("a11_write_mart", """SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1""")
def a11(spark, sf):
    path = new_path(spark, "mart")
    name = "cauce_mart_" + path.rsplit("-", 1)[1]
    tables.write_mart(table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n")),
                      name, path)
    return spark.table(name)


@query("a12_define_view", "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1")
def a12(spark, sf):
    tables.define_view(table(spark, sf, "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n")),
                       "cauce_segments")
    return spark.table("cauce_segments")


@query("a13_export_files", """SELECT f.format, count(*) AS n, CAST(sum(CAST(c_acctbal AS DECIMAL(14,2))) AS DOUBLE) AS total
    FROM customer, (VALUES ('csv'), ('parquet')) f(format) GROUP BY 1""")
def a13(spark, sf):
    base = new_path(spark, "export")
    source = table(spark, sf, "customer")
    tables.export_csv(source, f"{base}/csv")
    tables.export_parquet(source, f"{base}/parquet")
    back = {"csv": files.read_csv(spark, f"{base}/csv"), "parquet": spark.read.parquet(f"{base}/parquet")}
    totals = [df.agg(F.lit(name).alias("format"), F.count(F.lit(1)).alias("n"),
                     F.sum(F.col("c_acctbal").cast("decimal(14,2)")).cast("double").alias("total"))
              for name, df in back.items()]
    return totals[0].unionByName(totals[1])


def monthly_lineitem(spark, sf):
    """Line items partitioned by ship month, clustered by part and supplier."""
    def write():
        path = new_path(spark, "monthly")
        source = table(spark, sf, "lineitem").withColumn("ship_month", F.trunc(F.to_date("l_shipdate"), "month"))
        tables.write_partitioned(source, path, "ship_month", ["l_partkey", "l_suppkey"])
        return path
    return spark.read.parquet(once(spark, sf, "monthly", write))


@query("a14_write_partitioned", """SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS ship_month, count(*) AS n,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(14,2))) AS DOUBLE) AS total FROM lineitem GROUP BY 1""")
def a14(spark, sf):
    return monthly_lineitem(spark, sf).groupBy("ship_month").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_extendedprice").cast("decimal(14,2)")).cast("double").alias("total"))


@query("a15_schema_table", """SELECT ordinal_position AS "position", column_name AS "column",
    CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
      WHEN 'VARCHAR' THEN 'string' ELSE 'timestamp_ntz' END AS data_type, true AS is_nullable
    FROM information_schema.columns WHERE table_name = 'lineitem'""")
def a15(spark, sf):
    return tables.schema_table(table(spark, sf, "lineitem"))


@query("a16_table_volume", """SELECT 'orders' AS table_name, count(*) AS n_rows, true AS has_bytes FROM orders
    UNION ALL SELECT 'lineitem', count(*), true FROM lineitem""")
def a16(spark, sf):
    volume = tables.table_volume(spark, {n: f"{sf}/{n}.parquet" for n in ("orders", "lineitem")})
    return volume.select("table_name", "n_rows", (F.col("n_bytes") > 0).alias("has_bytes"))


@query("a17_partition_inventory", """SELECT count(DISTINCT m) AS n_partitions, min(m) AS first_partition,
    max(m) AS last_partition FROM (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS m FROM lineitem)""")
def a17(spark, sf):
    return tables.partition_inventory(monthly_lineitem(spark, sf), "ship_month")


@query("a18_preview")
def a18(spark, sf):
    return tables.preview(table(spark, sf, "lineitem"), ["l_orderkey", "l_shipdate", "l_extendedprice"], 15)


@query("a18_preview_facts", """SELECT least(count(*), 15) AS n_rows, least(count(*), 15) AS n_found FROM lineitem""")
def a18f(spark, sf):
    """A preview may hold any rows, but so many, and only rows of the table."""
    columns = ["l_orderkey", "l_shipdate", "l_extendedprice"]
    rows = materialise(a18(spark, sf), "preview")
    found = rows.join(table(spark, sf, "lineitem").select(columns), columns, "left_semi")
    return rows.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_found", found.agg(F.count(F.lit(1))).scalar())


_NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@query("a19_inventory", " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {n}" for n in _NAMES))
def a19(spark, sf):
    return tables.inventory({n: table(spark, sf, n) for n in _NAMES})


@query("a20_ingest_freshness", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS n_rows, TIMESTAMP '2026-01-01 06:00:00' AS last_extracted FROM {n}"
    for n in _NAMES))
def a20(spark, sf):
    return tables.ingest_freshness({n: files.with_audit(table(spark, sf, n), LOAD_TS) for n in _NAMES})
