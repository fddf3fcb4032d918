"""Food retail: staging, intermediate and mart layers, their checks and business queries."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cauce.operators import quality
from cauce.operators.aggregates import decimal_mean
from cauce.operators.joins import count_orphans, lookup_label
from cauce.sources.publish import Run
from cauce.sources.tables import load_idempotent

# Labels for products without a known category or brand.
NO_CATEGORY = "Sin Categoría"
NO_BRAND = "Sin Marca"

# Staging projections as {output column: (input column, type)};
# "text" means trimmed text, "flag" means true unless stated.
STAGING = {
    "stg_ventas": ("id_venta", {
        "id_venta": ("id_venta", "bigint"), "fecha_venta": ("fecha", "date"),
        "id_cliente": ("id_cliente", "int"), "id_sucursal": ("id_sucursal", "int"),
        "canal_venta": ("canal", "text"), "metodo_pago": ("metodo_pago", "text"),
        "estado_venta": ("estado", "text"), "extracted_at": ("_extracted_at", "timestamp")}),
    "stg_ventas_detalle": ("id_detalle", {
        "id_detalle": ("id_detalle", "bigint"), "id_venta": ("id_venta", "bigint"),
        "id_producto": ("id_producto", "int"), "cantidad": ("cantidad", "int"),
        "precio_unitario": ("precio_unitario", "decimal(12,2)"),
        "porcentaje_descuento": ("descuento", "decimal(5,4)"),
        "subtotal": ("subtotal", "decimal(14,2)"), "extracted_at": ("_extracted_at", "timestamp")}),
    "stg_productos": ("id_producto", {
        "id_producto": ("id_producto", "int"), "sku": ("sku", "text"),
        "nombre_producto": ("nombre", "text"), "id_categoria": ("id_categoria", "int"),
        "id_marca": ("id_marca", "int"), "unidad_medida": ("unidad_medida", "text"),
        "costo_base": ("costo_base", "decimal(12,2)"), "precio_lista": ("precio_lista", "decimal(12,2)"),
        "es_activo": ("activo", "flag"), "extracted_at": ("_extracted_at", "timestamp")}),
    "stg_clientes": ("id_cliente", {
        "id_cliente": ("id_cliente", "int"), "nit": ("nit", "text"),
        "nombre_cliente": ("nombre", "text"), "tipo_cliente": ("tipo_cliente", "text"),
        "municipio": ("municipio", "text"), "departamento": ("departamento", "text"),
        "fecha_alta": ("fecha_alta", "date"), "extracted_at": ("_extracted_at", "timestamp")}),
    "stg_sucursales": ("id_sucursal", {
        "id_sucursal": ("id_sucursal", "int"), "nombre_sucursal": ("nombre", "text"),
        "ciudad": ("ciudad", "text"), "departamento": ("departamento", "text"),
        "extracted_at": ("_extracted_at", "timestamp")}),
    "stg_categorias": ("id_categoria", {
        "id_categoria": ("id_categoria", "int"), "nombre_categoria": ("nombre", "text"),
        "extracted_at": ("_extracted_at", "timestamp")}),
    "stg_marcas": ("id_marca", {
        "id_marca": ("id_marca", "int"), "nombre_marca": ("nombre", "text"),
        "extracted_at": ("_extracted_at", "timestamp")}),
}
RAW_TABLES = {"stg_ventas": "venta", "stg_ventas_detalle": "venta_detalle", "stg_productos": "producto",
              "stg_clientes": "cliente", "stg_sucursales": "sucursal", "stg_categorias": "categoria",
              "stg_marcas": "marca"}


def _staged(source: str, kind: str) -> Column:
    if kind == "text":
        return F.trim(source)
    if kind == "flag":
        return F.coalesce(F.col(source).cast("boolean"), F.lit(True))
    return F.col(source).cast(kind)


def stage(raw: DataFrame, key: str, columns: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Typed, trimmed and renamed columns of the rows that have a key."""
    return raw.where(F.col(key).isNotNull()).select(
        *[_staged(source, kind).alias(out) for out, (source, kind) in columns.items()])


def stage_all(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: stage(raw[RAW_TABLES[name]], key, columns) for name, (key, columns) in STAGING.items()}


def sales_detail(sales: DataFrame, lines: DataFrame) -> DataFrame:
    """Sale lines with their header and gross, discount and net amounts."""
    header = sales.select("id_venta", "id_cliente", "id_sucursal", "fecha_venta", "canal_venta",
                          "metodo_pago", "estado_venta")
    gross = F.col("cantidad") * F.col("precio_unitario")
    return lines.join(header, "id_venta").select(
        "id_detalle", "id_venta", "id_cliente", "id_producto", "id_sucursal", "fecha_venta", "canal_venta",
        "metodo_pago", "estado_venta", "cantidad", "precio_unitario", "porcentaje_descuento",
        gross.cast("decimal(14,2)").alias("monto_bruto"),
        F.round(gross * F.col("porcentaje_descuento"), 2).cast("decimal(14,2)").alias("monto_descuento"),
        F.col("subtotal").alias("monto_neto"))


def enriched_products(products: DataFrame, categories: DataFrame, brands: DataFrame) -> DataFrame:
    """Products with category and brand names and the theoretical margin."""
    named = lookup_label(products, categories, "id_categoria", "id_categoria", "nombre_categoria",
                         "categoria", NO_CATEGORY)
    named = lookup_label(named, brands, "id_marca", "id_marca", "nombre_marca", "marca", NO_BRAND)
    margin = (F.col("precio_lista") - F.col("costo_base")).cast("decimal(12,2)")
    return named.select("id_producto", "sku", "nombre_producto", "id_categoria", "categoria", "id_marca",
                        "marca", "unidad_medida", "costo_base", "precio_lista",
                        margin.alias("margen_unitario_teorico"), "es_activo")


def build_marts(staged: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    detail = sales_detail(staged["stg_ventas"], staged["stg_ventas_detalle"])
    products = enriched_products(staged["stg_productos"], staged["stg_categorias"], staged["stg_marcas"])
    return {
        "dim_clientes": staged["stg_clientes"].drop("extracted_at"),
        "dim_productos": products,
        "dim_sucursales": staged["stg_sucursales"].drop("extracted_at"),
        "fct_ventas": detail,
    }


# Declared checks of the marts.
UNIQUE = {"dim_clientes": ("id_cliente",), "dim_productos": ("id_producto", "sku"),
          "dim_sucursales": ("id_sucursal",), "fct_ventas": ("id_detalle",)}
NOT_NULL = {
    "dim_clientes": ("id_cliente", "nombre_cliente", "fecha_alta"),
    "dim_productos": ("id_producto", "sku", "nombre_producto", "precio_lista"),
    "dim_sucursales": ("id_sucursal", "nombre_sucursal"),
    "fct_ventas": ("id_detalle", "id_venta", "id_cliente", "id_producto", "id_sucursal", "fecha_venta",
                   "cantidad", "monto_neto"),
}
RELATIONS = (("id_cliente", "dim_clientes"), ("id_producto", "dim_productos"),
             ("id_sucursal", "dim_sucursales"))


def mart_checks(marts: Mapping[str, DataFrame]) -> list[DataFrame]:
    """Declared checks; NULLs and amount rules of a table share one scan."""
    rules = {"fct_ventas": {
        "lineas_monto_negativo": quality.any_negative(["monto_bruto", "monto_neto", "monto_descuento"]),
        "lineas_inconsistencia_calculo": quality.off_balance("monto_bruto", "monto_descuento", "monto_neto"),
    }}
    checks = [quality.check_table(marts[t], t, columns, rules.get(t)) for t, columns in NOT_NULL.items()]
    checks += [quality.check_unique(marts[t], t, c) for t, columns in UNIQUE.items() for c in columns]
    checks += [quality.check_relationship(marts["fct_ventas"], "fct_ventas", key, marts[dim], key)
               for key, dim in RELATIONS]
    return checks


def fact_orphans(marts: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    names = {"id_cliente": "huerfanos_clientes", "id_producto": "huerfanos_productos",
             "id_sucursal": "huerfanas_sucursales"}
    return {names[key]: count_orphans(marts["fct_ventas"], marts[dim], key, key, names[key])
            for key, dim in RELATIONS}


def quality_cases(raw: Mapping[str, DataFrame]) -> list[DataFrame]:
    """The ten catalogued incidents as checks over the raw tables."""
    sold = raw["venta_detalle"].groupBy("id_venta", "id_producto").agg(F.sum("cantidad").alias("_vendido"))
    returned = raw["devoluciones"].groupBy("id_venta", "id_producto").agg(
        F.sum("cantidad").alias("_devuelto"))
    over_returned = returned.join(sold, ["id_venta", "id_producto"], "left").select(
        (F.col("_devuelto") > F.coalesce("_vendido", F.lit(0))).alias("_over"))
    rules = quality.check_rules
    return [
        rules(raw["cliente"], "cliente", {"id_nulo": F.col("id_cliente").isNull()}),
        rules(raw["producto"], "producto", {"precio_negativo": F.col("precio_lista") < 0}),
        quality.check_relationship(raw["venta"], "venta", "id_cliente", raw["cliente"], "id_cliente"),
        rules(raw["venta_detalle"], "venta_detalle", {
            "cantidad_cero": F.col("cantidad") <= 0, "descuento_mayor_100": F.col("descuento") > 1}),
        rules(raw["inventario_bodega"], "inventario_bodega", {
            "stock_negativo": F.col("stock_disponible") < 0,
            "vencido_al_corte": F.col("fecha_vencimiento") < F.col("fecha_corte")}),
        rules(raw["proveedores_precios"], "proveedores_precios",
              {"costo_nulo": F.col("costo_proveedor").isNull()}),
        rules(raw["metas_ventas"], "metas_ventas", {"meta_cero": F.col("meta_ventas") <= 0}),
        rules(over_returned, "devoluciones", {"devolucion_mayor_venta": F.col("_over")}),
    ]


def sales_by_category(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Sums and mean discount per category; lines are summed per product before the join."""
    sums = {"unidades_vendidas": "cantidad", "total_venta_bruta": "monto_bruto",
            "total_descuentos": "monto_descuento", "total_venta_neta": "monto_neto"}
    per_product = fact.groupBy("id_producto").agg(
        F.count("id_detalle").alias("_lines"), *[F.sum(c).alias(out) for out, c in sums.items()],
        F.sum("porcentaje_descuento").alias("_pct_sum"), F.count("porcentaje_descuento").alias("_pct_n"))
    named = per_product.join(products.select("id_producto", "categoria"), "id_producto")
    mean_pct = F.sum("_pct_sum").cast("decimal(38,6)") / F.sum("_pct_n")
    return named.groupBy("categoria").agg(
        F.sum("_lines").alias("total_lineas_vendidas"), *[F.sum(out).alias(out) for out in sums],
        F.round(mean_pct * 100, 2).cast("decimal(10,2)").alias("pct_descuento_promedio"),
    ).orderBy(F.desc("total_venta_neta"), "categoria")


def sales_by_branch(fact: DataFrame, branches: DataFrame) -> DataFrame:
    named = fact.join(branches.select("id_sucursal", "nombre_sucursal", "departamento"), "id_sucursal")
    return named.groupBy("nombre_sucursal", "departamento").agg(
        F.countDistinct("id_venta").alias("total_transacciones"),
        F.sum("monto_neto").alias("facturacion_total_neta"),
        decimal_mean(F.col("monto_neto"), "decimal(14,2)").alias("ticket_promedio_linea"),
    ).orderBy(F.desc("facturacion_total_neta"), "nombre_sucursal", "departamento")


def top_customers(fact: DataFrame, customers: DataFrame, n: int = 10,
                  states: Sequence[str] | None = None) -> DataFrame:
    """Customers who spent most; ``states`` narrows the sales that count (all by default)."""
    chosen = fact if states is None else fact.where(F.col("estado_venta").isin(*states))
    spent = chosen.groupBy("id_cliente").agg(
        F.countDistinct("id_venta").alias("total_ordenes"), F.sum("monto_neto").alias("gasto_acumulado_neto"))
    who = customers.select("id_cliente", "nombre_cliente", "tipo_cliente", "municipio")
    return spent.join(who, "id_cliente").select(
        "id_cliente", "nombre_cliente", "tipo_cliente", "municipio", "total_ordenes", "gasto_acumulado_neto",
    ).orderBy(F.desc("gasto_acumulado_neto"), "id_cliente").limit(n)


class LayerFailure(RuntimeError):
    """Some mart check failed."""


@dataclass(frozen=True)
class LayerRun:
    """What a full run leaves behind: mart paths, the check report, and the steps taken over from an earlier try."""

    marts: dict[str, str]
    report: DataFrame
    skipped: tuple[str, ...] = ()


def run_layers(spark: SparkSession, raw: Mapping[str, DataFrame] | Callable[[], Mapping[str, DataFrame]],
               target: str, strict: bool = True, name: str | None = None) -> LayerRun:
    """Raw to staging to marts to checks, in order; the first failing step stops the run.

    Marts are written beside the published ones and published together, by ``sources.publish``, once
    their checks have passed; until then readers keep the old ones. A rerun under the same ``name``
    goes on at the first unfinished step, also after lost jobs. With failed checks nothing is
    published and the steps are forgotten, since other raw data is needed; with ``strict`` off the
    marts are published nevertheless.
    """
    tables = raw() if callable(raw) else raw
    run = Run(spark, target, name)
    written = {mart: run.step(mart, lambda df=df: df) for mart, df in build_marts(stage_all(tables)).items()}
    report = run.step("dq_report", lambda: quality.dq_report(mart_checks(written)))
    if strict and not report.where(~F.col("passed")).isEmpty():
        run.forget()
        raise LayerFailure(f"mart checks failed, see {run.tables['dq_report']}")
    paths = run.publish()
    return LayerRun({mart: paths[mart] for mart in written}, report, tuple(run.skipped))


def land_raw(spark: SparkSession, sources: Mapping[str, DataFrame], target: str,
             extracted_at: datetime) -> dict[str, DataFrame]:
    """Full copies of the source tables with one load time."""
    landed = {}
    for name, df in sources.items():
        path = f"{target.rstrip('/')}/{name}"
        load_idempotent(df.withColumn("_extracted_at", F.lit(extracted_at).cast("timestamp")), path)
        landed[name] = spark.read.parquet(path)
    return landed
