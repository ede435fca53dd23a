"""Plan properties the scale design relies on, read from ``explain``."""

import datetime as dt
import re

import pytest
from conftest import SF0001
from pyspark.sql import functions as F

from tillroll.operators import kpis, marts
from tillroll.plans.models import Warehouse
from tillroll.session import apply_runtime_conf
from tillroll.sources.fixtures import Bronze
from test_models import cart, days_before, user, warehouse


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_scans_read_only_used_columns(spark):
    w = Warehouse.from_sf(spark, SF0001)
    p = plan(w.stg_customers)
    assert "c_acctbal" not in p  # pruned at the Parquet scan
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string,c_nationkey:int,c_mktsegment:string>" in p
    lp = plan(kpis.top_products(w.bronze.lines))
    assert "l_shipdate" not in lp and "l_returnflag" not in lp


def test_topk_is_not_a_full_sort(spark):
    w = Warehouse.from_sf(spark, SF0001)
    p = plan(kpis.top_products(w.bronze.lines))
    assert "TakeOrderedAndProject" in p


def test_orders_are_reduced_per_customer_before_the_customer_join(spark):
    w = Warehouse.from_sf(spark, SF0001)
    p = plan(w.customer_metrics)
    # Distinct orders shuffle on (customer, order): a hot customer's orders
    # are spread before they are counted.
    assert re.search(r"hashpartitioning\(customer_id#\d+L, order_id#\d+L", p)


def test_no_broadcast_hints(spark):
    w = Warehouse.from_sf(spark, SF0001)
    for df in (w.fact_orders, w.customer_metrics, kpis.top_customers(w.stg_orders, w.dim_customer,
                                                                     w.stg_customers)):
        assert "broadcast" not in optimized(df).lower()  # size decides at runtime (AQE), not hints


def test_hot_customer_holding_a_third_of_orders(spark):
    """One customer owns a third of all orders; nothing is dropped."""
    users = [user(i) for i in range(1, 21)]
    carts = [cart(1000 + n, 1, 10.0, 9.0 + n / 100, days_before(n % 200)) for n in range(300)]
    carts += [cart(5000 + n, 2 + n % 19, 5.0, 4.5, days_before(n % 120)) for n in range(600)]
    w = warehouse(spark, users, [], carts)
    want = {u[3]: (sum(c[1] == u[0] for c in carts), round(sum(c[3] for c in carts if c[1] == u[0]), 4)) for u in users}
    got = {r["email"]: (r["total_orders"], r["lifetime_value"]) for r in w.customer_metrics.collect()}
    assert got == want
    assert got["u1@x"][0] == 300
    total = w.customer_metrics.agg(F.sum("total_orders")).first()[0]
    assert total == 900
    assert w.mtd_revenue.first()["report_date"] == dt.date(2001, 8, 2)


SKEW = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}


def hot_bronze(spark, n=60_000):
    """Half of all orders, and half of all lines, on one key; no row is a copy of another."""
    i = spark.range(n).withColumn("u", F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 500))
    user = ("named_struct('id', id, 'firstName', 'F', 'lastName', cast(id AS string), 'email', concat(id, '@x'), 'phone', '', "
            "'username', cast(id AS string), 'gender', 'f', 'address', named_struct('city', 'X'))")
    users = spark.range(500).selectExpr("'f' AS _source", "cast(NULL AS bigint) AS _total", f"{user} AS user")
    carts = i.selectExpr("'f' AS _source", "cast(NULL AS bigint) AS _total",
                         "named_struct('id', id, 'userId', u, 'total', 2.0D, 'discountedTotal', 1.0D, 'totalProducts', 1L, "
                         "'totalQuantity', 1L, 'orderDate', date'2001-01-01') AS cart")
    return Bronze.from_frames(users, users.limit(0), carts, None)


@pytest.mark.parametrize("name", ["fact_orders", "top_customers"])
def test_joins_split_a_hot_key(spark, name):
    apply_runtime_conf(spark)
    old = {k: spark.conf.get(k) for k in SKEW}
    try:
        for k, v in SKEW.items():
            spark.conf.set(k, v)
        w = Warehouse(hot_bronze(spark))
        df = w.fact_orders if name == "fact_orders" else kpis.top_customers(w.stg_orders, w.dim_customer, w.stg_customers)
        rows = df.collect()
        final = plan(df)
        assert "skew=true" in final, final
        assert len(rows) == (60_000 if name == "fact_orders" else 5)
        if name == "top_customers":
            assert rows[0]["orders"] == 30_000 + 120
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("name,most", [("dashboard", 5), ("kpi_report_text", 3), ("dq_summary", 9)])
def test_each_mart_is_aggregated_once(spark, name, most):
    """Scans of the order lines per query: one for each model that is tested or shown, not one for each line."""
    import __spark_entry__ as E

    p = E.queries()[name](spark, SF0001)._jdf.queryExecution().optimizedPlan().toString()
    assert p.count("o_custkey") and len(re.findall(r"Relation \[o_orderkey", p)) <= most


def test_marts_agree_with_each_other(spark):
    """Daily revenue sums to the month-to-date net revenue (no month filter,
    quirk Q3)."""
    w = Warehouse.from_sf(spark, SF0001)
    daily = kpis.kpi_total_revenue(w.revenue_daily).first()["total_revenue"]
    mtd = w.mtd_revenue.first()
    assert daily == mtd["net_revenue"]
    assert mtd["total_orders"] == 1500


def test_unused_lookups_are_dropped(spark):
    """Units per product id need no titles, and counting landed orders no
    totals of their lines."""
    import __spark_entry__ as E

    qty = plan(E.queries()["top_products_by_qty"](spark, SF0001))
    assert "part.parquet" not in qty and "Join" not in qty
    totals = plan(E.queries()["raw_load_totals"](spark, SF0001))
    assert "lineitem.parquet" not in totals  # the per-order line totals are never computed


def test_lines_are_parsed_from_json_and_exploded(spark):
    import __spark_entry__ as E

    p = plan(E.queries()["unnest_order_lines"](spark, SF0001))
    assert "Generate explode" in p
    assert p.count("from_json(StructField(id") == 1  # each record is parsed once


def test_distinct_counts_expand_no_rows(spark):
    import __spark_entry__ as E

    for name in ("mtd_revenue", "kpi_mtd_summary"):
        assert "Expand" not in plan(E.queries()[name](spark, SF0001))


def test_completeness_of_a_ledger_reads_no_record(spark, scratch):
    import json
    import os

    from tillroll.plans.pipeline import load_bronze
    from tillroll.sources.envelopes import fetch_completeness
    from tillroll.streaming import read_ledger

    for entity in ("customers", "products", "orders"):
        os.makedirs(os.path.join(scratch, "landing", entity))
    with open(os.path.join(scratch, "landing", "customers", "customers_20200101_000000.json"), "w") as f:
        json.dump({"users": [{"id": 1}, {"id": "x"}, {"id": 3}], "total": 4}, f)
    out = load_bronze(spark, os.path.join(scratch, "landing"), os.path.join(scratch, "bronze"))
    assert out["loaded"]["customers"] == 2 and out["quarantined"]["customers"] == 1
    df = fetch_completeness({"customers": read_ledger(spark, out["folder"], "customers")})
    assert [(r["landed"], r["reported_total"], r["complete"]) for r in df.collect()] == [(2, 4, False)]
    assert "_ledger/customers" in plan(df) and "user" not in plan(df).replace("customers", "")


def test_stored_tables_are_counted_from_footers(spark, scratch):
    from tillroll.sources.catalog import footer_counts

    spark.range(1000).withColumn("x", F.col("id").cast("string")).write.parquet(f"{scratch}/a")
    spark.range(7).write.parquet(f"{scratch}/b")
    df = footer_counts(spark, {"a": f"{scratch}/a", "b": f"{scratch}/b"})
    p = plan(df)
    assert p.count("PushedAggregation: [COUNT(*)]") == 2 and "ReadSchema: struct<>" not in p.replace("count(*)", "")
    assert {r["table_name"]: r["row_count"] for r in df.collect()} == {"a": 1000, "b": 7}
    assert "PushedAggregation" not in plan(spark.read.parquet(f"{scratch}/a").groupBy().count())


def test_queries_write_nothing_while_they_are_built(spark, monkeypatch):
    import __spark_entry__ as E
    from pyspark.sql.readwriter import DataFrameWriter
    from tillroll.plans.queries import QUERIES, WRITING

    monkeypatch.setattr(DataFrameWriter, "parquet", lambda *a, **k: pytest.fail("a query writes"))
    for name in set(QUERIES) - set(WRITING):
        E.queries()[name](spark, SF0001)


def test_best_customers_meet_on_ids(spark):
    import __spark_entry__ as E

    p = optimized(E.queries()["top_customers"](spark, SF0001))
    assert "md5" not in p


def test_report_lines_agree_on_odd_orders(spark):
    """Orders without id, date, amount or known customer, repeated ids, and no order at all."""
    old = [cart(None, 1, 5.0, 4.0, days_before(1)), cart(1, 1, 10.0, 9.0, days_before(2)), cart(1, 2, 10.0, 8.0, days_before(2)),
           cart(2, 99, None, None, None), cart(3, None, 2.5, 2.25, None), cart(4, 2, 1.0, 0.5, days_before(400))]
    for carts in (old, []):
        w = warehouse(spark, [user(1), user(2)], [], carts)
        one = kpis.report_of_orders(marts.order_figures(w.fact_orders))
        many = kpis.report_of_marts(w.fact_orders, w.mtd_revenue, w.revenue_daily)
        assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))
