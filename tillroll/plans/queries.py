"""Registered queries: one per operator group of the survey, each reading the
whole given tables through the bronze adapter."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import cents_to_dollars
from ..operators import kpis, marts, quality
from ..operators.quality import DataTest
from ..operators.staging import order_lines
from ..sources import envelopes
from ..session import scratch_folder
from ..sources.fixtures import land_files, line_values
from ..streaming import QUARANTINED, load_files, read_ledger, read_loaded
from .models import DATA_TESTS, MODELS, Warehouse, analytics_models

AS_OF = "2001-08-02"  # the build date of the test tables: the day after the last order

Query = Callable[[SparkSession, str], DataFrame]


def _wh(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse.from_sf(spark, sf_dir, AS_OF)


def _bronze_frames(w: Warehouse) -> dict[str, DataFrame]:
    return {"customers": w.bronze.customers, "products": w.bronze.products, "orders": w.bronze.carts}


def raw_batch_counts(spark, sf_dir):
    w = _wh(spark, sf_dir)
    frames = _bronze_frames(w)
    out = None
    for entity, df in frames.items():
        b = envelopes.batch_counts(df, entity)
        out = b if out is None else out.unionByName(b)
    return out


def raw_load_totals(spark, sf_dir):
    return envelopes.load_totals(_bronze_frames(_wh(spark, sf_dir)))


def extraction_completeness(spark, sf_dir):
    return envelopes.completeness(_bronze_frames(_wh(spark, sf_dir)))


def q_cents_to_dollars(spark, sf_dir):
    p = _wh(spark, sf_dir).stg_products
    cents = F.round(F.col("price").cast("decimal(18,4)") * 100).cast("bigint")
    return p.select("product_id", cents.alias("price_cents")).select(
        "product_id", "price_cents", cents_to_dollars("price_cents").alias("price_dollars"))


def unnest_order_lines(spark, sf_dir):
    """JSON envelopes of all lines, parsed with the declared schema and exploded twice."""
    # A quarantined row has no cart, so no lines.
    return order_lines(envelopes.explode_lines(envelopes.parse_records(line_values(spark, sf_dir), "orders")))


def _loaded_from_files(spark, sf_dir) -> str:
    """Land the tables as files, load them in two rounds (the second incremental); returns the loaded folder."""
    root = scratch_folder(spark, "landing")
    for fetch, entities in ((1, ("customers", "products")), (2, ("customers", "orders"))):
        land_files(spark, sf_dir, f"{root}/files", fetch)
        for entity in entities:
            load_files(spark, f"{root}/files", entity, f"{root}/bronze")
    return f"{root}/bronze"


def landed_records(spark, sf_dir):
    """Every record that was landed as JSON and read back, loaded or quarantined."""
    folder = _loaded_from_files(spark, sf_dir)
    people, goods = read_loaded(spark, folder, "customers"), read_loaded(spark, folder, "products")
    carts, bad = read_loaded(spark, folder, "orders"), read_loaded(spark, folder, "customers", QUARANTINED)
    row = lambda df, kind, key, detail: df.select(F.lit(kind).alias("kind"), F.expr(key).alias("id"), F.expr(detail).alias("detail"))
    return (row(people, "customer", "user.id", "concat_ws('|', user.firstName, user.lastName, user.email, user.address.city)")
            .unionByName(row(bad, "quarantined", "CAST(substring(get_json_object(_bad, '$.id'), 2) AS BIGINT)",
                             "get_json_object(_bad, '$.username')"))
            .unionByName(row(goods, "product", "product.id", "concat_ws('|', product.title, product.brand, product.stock)"))
            .unionByName(row(envelopes.explode_lines(carts), "line", "cart_id",
                             "concat_ws('|', line.id, line.title, line.quantity, CAST(line.discountedTotal * 10000 AS BIGINT) DIV 10000)")))


def landed_completeness(spark, sf_dir):
    """A21 over the ledger of a load: one row a file is read, no record."""
    folder = _loaded_from_files(spark, sf_dir)
    ledgers = {e: read_ledger(spark, folder, e) for e in ("customers", "products", "orders")}
    found = envelopes.fetch_completeness({e: ledgers[e] for e in ("customers", "products")})
    bad = ledgers["customers"].groupBy(envelopes.fetch_of(F.col("_source")).alias("batch")).agg(F.sum("_quarantined").alias("quarantined"))
    return found.join(bad, "batch", "left").select(
        "entity", F.regexp_extract("batch", r"([^/]+)$", 1).alias("batch"), "landed", "reported_total", "complete",
        F.coalesce("quarantined", F.lit(0)).alias("quarantined"))


# Tests beyond the declared ones, on columns that real landings break.
MORE_TESTS = [
    DataTest("stg_customers", "gender", "accepted_values", values=("automobile", "building", "furniture", "machinery")),
    DataTest("stg_orders", "customer_id", "relationships", to=("stg_customers", "customer_id")),
]


def _data_tests(kinds):
    def q(spark, sf_dir):
        w, tests = _wh(spark, sf_dir), DATA_TESTS + MORE_TESTS
        return quality.run_tests({m: w.model(m) for m in quality.models_needed(tests, kinds)}, tests, kinds)
    return q


def dq_summary(spark, sf_dir):
    w = _wh(spark, sf_dir)
    models = {m: w.model(m) for m in quality.models_needed(DATA_TESTS)}
    return quality.summary(quality.run_tests(models, DATA_TESTS), len(MODELS))


def metrics_churn_rates(spark, sf_dir):
    """Churn rates of the mart that keeps the customers' own order dates."""
    m = _wh(spark, sf_dir).customer_metrics
    status = kpis.churn_rate_by_status(m).withColumnRenamed("churn_rate_pct", "rate")
    dates = kpis.churn_rate_by_date(m, AS_OF).withColumnRenamed("churn_rate_pct", "rate")
    return status.select(F.lit("status").alias("by"), "rate").unionByName(dates.select(F.lit("date").alias("by"), "rate"))


def kpi_row_counts(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return kpis.kpi_row_counts({
        "dim_customer": w.dim_customer,
        "dim_product": w.dim_product,
        "fact_orders": w.fact_orders,
        "analytics_revenue_daily": w.revenue_daily,
        "raw_customers": w.bronze.customers,
        "raw_products": w.bronze.products,
        "raw_orders": w.bronze.carts,
    })


def kpi_report_text(spark, sf_dir):
    w = _wh(spark, sf_dir)
    orders = kpis.report_of_orders(marts.order_figures(w.fact_orders))
    return kpis.kpi_report_text(w.dim_customer, orders, w.customer_metrics, _bronze_frames(w))


def churn_report(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return marts.churn_report(w.dim_customer, w.fact_churn)


def top_customers(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return kpis.top_customers(w.stg_orders, w.dim_customer, w.stg_customers)


def top_customers_text(spark, sf_dir):
    return kpis.top_customers_text(top_customers(spark, sf_dir))


def dashboard(spark, sf_dir):
    w = _wh(spark, sf_dir)
    reports = tuple(analytics_models())
    models = {name: w.model(name) for name in reports} | {"order_lines": order_lines(w.bronze.quantities)}
    return kpis.dashboard(models, AS_OF, reports)


QUERIES: dict[str, Query] = {
    "raw_batch_counts": raw_batch_counts,
    "raw_load_totals": raw_load_totals,
    "extraction_completeness": extraction_completeness,
    "stg_customers": lambda s, d: _wh(s, d).stg_customers,
    "stg_products": lambda s, d: _wh(s, d).stg_products,
    "stg_orders": lambda s, d: _wh(s, d).stg_orders,
    "unnest_order_lines": unnest_order_lines,
    "dim_customer": lambda s, d: _wh(s, d).dim_customer,
    "dim_product": lambda s, d: _wh(s, d).dim_product,
    "fact_orders": lambda s, d: _wh(s, d).fact_orders,
    "customer_metrics": lambda s, d: _wh(s, d).customer_metrics,
    "customer_churn": lambda s, d: _wh(s, d).customer_churn,
    "mtd_revenue": lambda s, d: _wh(s, d).mtd_revenue,
    "revenue_daily": lambda s, d: _wh(s, d).revenue_daily,
    "revenue_metrics": lambda s, d: _wh(s, d).revenue_metrics,
    "revenue_report": lambda s, d: marts.revenue_report(_wh(s, d).fact_sales),
    "churn_report": churn_report,
    "top_products": lambda s, d: kpis.top_products(_wh(s, d).bronze.lines),
    "top_products_by_qty": lambda s, d: kpis.top_products_by_qty(_wh(s, d).bronze.quantities),
    "top_customers": top_customers,
    "kpi_row_counts": kpi_row_counts,
    "kpi_customer_status": lambda s, d: kpis.kpi_customer_status(_wh(s, d).customer_metrics),
    "kpi_total_revenue": lambda s, d: kpis.kpi_total_revenue(_wh(s, d).revenue_daily),
    "kpi_mtd_summary": lambda s, d: kpis.kpi_mtd_summary(_wh(s, d).mtd_revenue),
    "kpi_avg_ltv": lambda s, d: kpis.kpi_avg_ltv(_wh(s, d).customer_metrics),
    "kpi_revenue_summary": lambda s, d: kpis.kpi_revenue_summary(_wh(s, d).revenue_daily),
    "kpi_latest_day": lambda s, d: kpis.kpi_latest_day(_wh(s, d).revenue_daily),
    "churn_rate_by_status": lambda s, d: kpis.churn_rate_by_status(_wh(s, d).customer_churn),
    "churn_rate_by_date": lambda s, d: kpis.churn_rate_by_date(_wh(s, d).customer_churn, AS_OF),
    "cents_to_dollars": q_cents_to_dollars,
    "kpi_report_text": kpi_report_text,
    "top_products_text": lambda s, d: kpis.top_products_text(kpis.top_products(_wh(s, d).bronze.lines)),
    "top_customers_text": top_customers_text,
    "dq_not_null": _data_tests({"not_null"}),
    "dq_unique": _data_tests({"unique"}),
    "dq_accepted_values": _data_tests({"accepted_values"}),
    "dq_relationships": _data_tests({"relationships"}),
    "dq_summary": dq_summary,
    "metrics_churn_rates": metrics_churn_rates,
    "dashboard": dashboard,
    "landed_records": landed_records,
    "landed_completeness": landed_completeness,
}

# These write files and read them back, which is what they show.
WRITING = ("landed_records", "landed_completeness")
