"""End to end: land the sf0.001 tables as JSON, load them, build and materialize
every model, run the 35 data tests, print the report; the report must equal the
one computed straight from the tables."""

import os

from pyspark.sql import functions as F

from conftest import SF0001
from tillroll.operators import kpis, marts
from tillroll.plans.models import Warehouse
from tillroll.plans.pipeline import run_pipeline
from tillroll.plans.queries import AS_OF
from tillroll.sources import envelopes


def landed(spark, root):
    """The bronze records of the tables, landed again as JSON."""
    w = Warehouse.from_sf(spark, SF0001, AS_OF)
    at = "2001-08-02T00:00:00"
    envelopes.land(w.bronze.customers.select("user.*"), root, "customers", at, page_size=30, total=150)
    envelopes.land(w.bronze.products.select("product.*"), root, "products", at, page_size=30, total=200)
    # Test-only nesting of the small fixture's lines back into carts.
    lines = w.bronze.lines.groupBy("cart_id").agg(F.collect_list("line").alias("products"))
    carts = w.bronze.carts.select("cart.*").join(lines, F.col("id") == F.col("cart_id"), "left").drop("cart_id")
    envelopes.land(carts, root, "orders", at, page_size=30)
    return w


def test_pipeline_round_trip(spark, scratch, capsys):
    landing, work = os.path.join(scratch, "landing"), os.path.join(scratch, "work")
    w = landed(spark, landing)
    raw = {"customers": w.bronze.customers, "products": w.bronze.products, "orders": w.bronze.carts}
    counts = {e: df.count() for e, df in raw.items()}

    out = run_pipeline(spark, landing, work, AS_OF)
    assert out["loaded"] == counts and set(out["quarantined"].values()) == {0}
    assert len(out["models_built"]) == 11
    assert len(out["tests"]) == 35 and out["tests_passed"] < 35  # the landings have edges
    one_pass = kpis.report_of_orders(marts.order_figures(w.fact_orders))  # the pipeline reads its built tables
    direct = [r.line for r in kpis.kpi_report_text(w.dim_customer, one_pass, w.customer_metrics, raw)
              .orderBy("line_no").collect()]
    assert len(direct) == 18
    assert out["report"] == direct
    assert spark.catalog.tableExists("raw_orders")  # staging models are views under their alias
    assert spark.catalog.tableExists("fact_orders")

    again = run_pipeline(spark, landing, work, AS_OF, incremental=True)  # nothing new
    assert again["loaded"] == counts and again["report"] == direct

    history = spark.table("data_test_results")  # appended by every run
    assert history.count() == 70 and history.select("run_at").distinct().count() == 2

    from tillroll.__main__ import main

    capsys.readouterr()
    assert main(["dashboard", work, "--as-of", AS_OF]) == 0
    dash = capsys.readouterr().out
    assert "-- Sales Summary --" in dash and "Reports executed: 5" in dash
    assert main(["validate-landing", landing]) == 0
    assert "orders 2001-08-02" in capsys.readouterr().out
    assert main(["inspect", work, "--table", "dim_product", "--table", "nothing"]) == 0
    said = capsys.readouterr().out
    assert "dim_product: 204 rows" in said and "product_key string" in said and "nothing: " in said
    # No database may be started here: only tables that do not exist are
    # asked for, so the command reports them and writes nothing.
    assert main(["copy-jdbc", work, "jdbc:none", "--table", "fact_sales", "--table", "fact_churn"]) == 0
    assert capsys.readouterr().out.split("\n")[:2] == ["fact_sales: missing", "fact_churn: missing"]
    assert main(["pipeline", landing, os.path.join(scratch, "work2"), "--as-of", AS_OF]) == 1  # some tests fail
    assert '"quarantined": {"customers": 0' in capsys.readouterr().out
