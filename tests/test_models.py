"""Hand-sized cases for the edges of the models (FIXTURES.md section 5)."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import types as T

from tillroll.operators import dims, kpis, marts, quality, staging
from tillroll.plans.models import DATA_TESTS, Warehouse, analytics_models
from tillroll.schemas import CART_LINE, PRODUCT, USER
from tillroll.sources.envelopes import CART_HEADER
from tillroll.sources.fixtures import Bronze

AS_OF = dt.date(2001, 8, 2)


def _bronze(spark, key, schema, recs, source="f1"):
    s = T.StructType([T.StructField("_source", T.StringType()), T.StructField("_total", T.LongType()),
                      T.StructField(key, schema)])
    return spark.createDataFrame([(source, None, r) for r in recs], s)


def user(i, first="Ann", last="Lee", email=None, city="Oslo"):
    return (i, first, last, email or f"u{i}@x", None, f"u{i}", "f", (city,))


def product(i, title="t", stock=5, price=1.0):
    return (i, title, "d", "c", price, 0.0, 4.0, stock, "b", f"s{i}")


def cart(i, uid, total, net, day):
    return (i, uid, total, net, 1, 1, day)


def warehouse(spark, users, products, carts, lines=()):
    b = Bronze.from_frames(
        _bronze(spark, "user", USER, users),
        _bronze(spark, "product", PRODUCT, products),
        _bronze(spark, "cart", CART_HEADER, carts),
        spark.createDataFrame([(c, l) for c, l in lines],
                              T.StructType([T.StructField("cart_id", T.LongType()),
                                            T.StructField("line", CART_LINE)])),
    )
    return Warehouse(b, AS_OF)


def days_before(n):
    return AS_OF - dt.timedelta(days=n)


@pytest.fixture
def wh(spark):
    users = [user(1), user(2), user(3), user(4), user(5), user(6, last=None)]
    carts = [
        cart(10, 1, 10.0, 9.0, days_before(30)),
        cart(11, 2, 10.0, 9.0, days_before(31)),
        cart(12, 3, 10.0, 9.0, days_before(90)),
        cart(13, 4, 10.0, 9.0, days_before(91)),
        cart(14, 99, 5.0, 5.0, days_before(1)),  # orphan: no such customer
        cart(14, 99, 5.0, 5.0, days_before(1)),  # same record landed twice
    ]
    products = [product(1, stock=0), product(2, stock=1), product(3, stock=10), product(4, stock=11),
                product(5, stock=None)]
    return warehouse(spark, users, products, carts)


def test_status_limits_and_never_purchased(wh):
    got = {r["email"]: r["customer_status"] for r in wh.customer_metrics.collect()}
    assert got == {"u1@x": "Active", "u2@x": "At Risk", "u3@x": "At Risk", "u4@x": "Churned",
                   "u5@x": "Never Purchased", "u6@x": "Never Purchased"}


def test_null_name_part(wh):
    names = {r["customer_id"]: r["name"] for r in wh.stg_customers.collect()}
    assert names[6] is None and names[1] == "Ann Lee"


def test_stock_limits(wh):
    got = {r["product_id"]: r["stock_status"] for r in wh.dim_product.collect()}
    assert got == {1: "Out of Stock", 2: "Low Stock", 3: "Low Stock", 4: "In Stock", 5: "Out of Stock"}


def test_distinct_and_orphan(wh):
    f = {r["order_id"]: r["customer_key"] for r in wh.fact_orders.collect()}
    assert len(f) == 5 and wh.fact_orders.count() == 5  # the repeated record collapses
    assert f[14] is None


def test_data_tests_on_orphan(wh):
    res = {(r["model"], r["column"], r["test"]): r["failing_rows"]
           for r in quality.run_tests(wh.models(), DATA_TESTS).collect()}
    assert len(res) == 35
    assert res[("fact_orders", "customer_key", "not_null")] == 1
    assert res[("fact_orders", "customer_key", "relationships")] == 0  # NULL child passes
    assert sum(res.values()) == 1


def test_churn_quirk_only_two_statuses(wh):
    got = {r["customer_status"] for r in wh.customer_churn.collect()}
    assert got == {"Active", "Never Purchased"}
    assert {r["last_order_date"] for r in wh.customer_churn.collect()} == {AS_OF}


def test_empty_fact(spark):
    w = warehouse(spark, [user(1)], [product(1)], [])
    r = w.mtd_revenue.collect()
    assert len(r) == 1
    assert r[0]["total_orders"] == 0 and r[0]["unique_customers"] == 0
    assert r[0]["net_revenue"] is None and r[0]["avg_order_value"] is None


def test_no_customers(spark):
    w = warehouse(spark, [], [product(1)], [])
    r = kpis.kpi_customer_status(w.customer_metrics).first()
    assert r["churn_rate_pct"] == 0.0 and r["avg_ltv"] == 0.0 and r["total_customers"] == 0


def test_top_products_ties_by_title(spark):
    lines = [(1, (1, "b-title", 2, 10.0)), (2, (2, "a-title", 3, 10.0)), (3, (3, "c-title", 1, 1.0))]
    w = warehouse(spark, [], [], [], lines)
    got = [r["title"] for r in kpis.top_products(w.bronze.lines, k=2).collect()]
    assert got == ["a-title", "b-title"]


def test_failing_data_tests_count_once(spark):
    df = spark.createDataFrame([(1, "Active"), (1, "Active"), (1, "Bogus"), (None, "Bogus"), (2, None)],
                               "customer_key long, customer_status string")
    assert quality.unique(df, "m", "customer_key").first()["failing_rows"] == 1
    assert quality.accepted_values(df, "m", "customer_status", ["Active"]).first()["failing_rows"] == 1
    assert quality.not_null(df, "m", ["customer_key"]).first()["failing_rows"] == 1
    many = {r["column"]: r["failing_rows"]
            for r in quality.unique_many(df, "m", ["customer_key", "customer_status"]).collect()}
    assert many == {"customer_key": 1, "customer_status": 2}


def test_changed_record_and_latest_per_key(spark):
    recs = [(1, 5, "2001-01-01"), (1, 7, "2001-02-01")]
    df = spark.createDataFrame(recs, "id long, stock long, landed string")
    assert df.select("id", "stock").distinct().count() == 2
    latest = staging.latest_per_key(df, ["id"], "landed").collect()
    assert [(r["id"], r["stock"]) for r in latest] == [(1, 7)]


def by_rows(users, carts, value):
    """For every staged customer row, ``value`` of the cart rows that a
    row-by-row join finds: the id's versions (one for the key lookup of the
    order, one for the customer's own lookup) times its carts."""
    users, carts = list(dict.fromkeys(users)), list(dict.fromkeys(carts))
    versions = [u[0] for u in users]
    out = {}
    for u in users:
        n = versions.count(u[0]) if u[0] is not None else 0
        met = [c for c in carts for _ in range(n * n) if u[0] is not None and c[1] == u[0]]
        out.setdefault((u[0], f"{u[1]} {u[2]}", u[3]), []).extend(met)
    return {k: value(v) for k, v in out.items()}


def test_customer_metrics_equals_row_level_join_with_duplicates(spark):
    """The pre-aggregated plan must equal the row-level join, also when a
    changed record leaves two staging rows for one id (fan-out)."""
    users = [user(1), user(1, city="Rome"), user(2, email="same@x"), user(3, email="same@x"),
             (None, "No", "Id", "n@x", None, "n", "f", ("X",))]
    carts = [cart(10, 1, 10.0, 9.5, days_before(3)), cart(11, 1, 20.0, 18.25, days_before(40)),
             cart(12, 2, 7.0, 7.0, days_before(100)), cart(13, 77, 1.0, 1.0, days_before(2)),
             cart(14, None, 2.0, 2.0, days_before(2))]
    w = warehouse(spark, users, [], carts)
    want = by_rows(users, carts, lambda met: (
        len({c[0] for c in met}), min((c[6] for c in met), default=None), max((c[6] for c in met), default=None),
        sum(c[3] for c in met) if met else None))
    key = {hashlib.md5(str(i).encode()).hexdigest(): i for i in range(100)} | {None: None}
    got = {(key[r["customer_key"]], r["name"], r["email"]): (
        r["total_orders"], r["first_order_date"], r["last_order_date"], r["lifetime_value"]) for r in w.customer_metrics.collect()}
    assert got == want
    assert got[1, "Ann Lee", "u1@x"][3] == 8 * (9.5 + 18.25)


def test_churn_report_counts_churned_per_month(wh):
    rows = marts.churn_report(wh.dim_customer, wh.fact_churn).collect()
    assert [(r["churn_month"], r["churned_customers"]) for r in rows] == [(dt.datetime(2001, 8, 1), 1)]


def test_dims_keep_all_staging_rows(wh):
    assert dims.dim_customer(wh.stg_customers).count() == wh.stg_customers.count()


def test_dashboard_sections_follow_present_models(wh):
    full = {"mtd_revenue": wh.mtd_revenue, "customer_churn": wh.customer_churn,
            "analytics_customer_metrics": wh.customer_metrics, "analytics_revenue_daily": wh.revenue_daily}
    reports = tuple(analytics_models())
    assert sorted(reports) == ["analytics_customer_metrics", "analytics_revenue_daily", "customer_churn", "mtd_revenue",
                               "revenue_metrics"]  # by folder or tag
    rows = kpis.dashboard(full, AS_OF, reports).collect()
    assert {r["section"] for r in rows} == {"Sales Summary", "Customer Analytics", "Revenue Analytics", "Summary"}
    assert [r["value"] for r in rows if r["metric"] == "Reports executed"] == ["4"]  # one of the five is absent
    # Without the date column the churn rate falls back to the status; a
    # missing model drops its section.
    part = {"customer_churn": wh.customer_churn.drop("last_order_date")}
    rows = kpis.dashboard(part, AS_OF, reports).collect()
    assert {(r["section"], r["metric"], r["value"]) for r in rows} == {
        ("Customer Analytics", "Churn Rate (calc)", "0.00%"), ("Summary", "Reports executed", "1")}


def test_latest_option_keeps_newest_landed_version(spark):
    older = _bronze(spark, "product", PRODUCT, [product(1, stock=5), product(2, stock=0)],
                    source="products/2026/06/29/a.json")
    newer = _bronze(spark, "product", PRODUCT, [product(1, stock=7)], source="products/2026/06/30/a.json")
    both = older.unionByName(newer)
    assert staging.stg_products(both).count() == 3  # DISTINCT keeps both versions of id 1 (Q4)
    got = {r["product_id"]: r["stock"] for r in staging.stg_products(both, latest=True).collect()}
    assert got == {1: 7, 2: 0}
    res = quality.unique(dims.dim_product(staging.stg_products(both, latest=True)), "dim_product", "product_id")
    assert res.first()["failing_rows"] == 0


def test_mtd_month_filter(spark):
    carts = [cart(1, 1, 10.0, 8.0, dt.date(2001, 8, 1)), cart(2, 1, 10.0, 6.0, dt.date(2001, 7, 31)),
             cart(3, 1, 10.0, 5.0, dt.date(2001, 8, 3))]
    w = warehouse(spark, [user(1)], [], carts)
    assert w.mtd_revenue.first()["net_revenue"] == 19.0  # all orders (quirk Q3)
    r = marts.mtd_revenue(w.fact_orders, AS_OF, month_filter=True).first()
    assert (r["total_orders"], r["net_revenue"], r["month"]) == (1, 8.0, dt.datetime(2001, 8, 1))


def test_top_customers_equals_row_level_join_with_duplicates(spark):
    users = [user(1), user(1, city="Rome"), user(2, first="Bo"), user(3, first="Bo")]
    carts = [cart(10, 1, 10.0, 9.5, days_before(3)), cart(11, 1, 20.0, 18.25, days_before(40)),
             cart(12, 2, 7.0, 7.0, days_before(100)), cart(13, 3, 1.0, 1.5, days_before(2)),
             cart(13, 2, 1.0, 0.5, days_before(2)), cart(14, 77, 2.0, 2.0, days_before(2))]
    w = warehouse(spark, users, [], carts)
    met = {}
    for (_, name, _), found in by_rows(users, carts, list).items():
        met.setdefault(name, []).extend(found)
    want = sorted((name, len({c[0] for c in found}), sum(c[3] for c in found)) for name, found in met.items())
    got = sorted(tuple(r) for r in kpis.top_customers(w.stg_orders, w.dim_customer, w.stg_customers, k=10).collect())
    assert got == want
    assert dict((n, s) for n, _, s in got)["Ann Lee"] == 8 * (9.5 + 18.25)


def test_relationships_counts_orphan_rows(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,), (5,), (5,)], "k long")
    parent = spark.createDataFrame([(1,)], "k long")
    assert quality.relationships(child, "c", "k", parent, "k").first()["failing_rows"] == 3
    assert quality.relationships(child.where("k = 1"), "c", "k", parent, "k").first()["failing_rows"] == 0


def test_dashboard_reads_stored_churn_rate(spark):
    stored = spark.createDataFrame([(0.1234,), (0.1234,)], "churn_rate double")
    rows = kpis.dashboard({"customer_churn": stored}).collect()
    assert [(r["metric"], r["value"]) for r in rows if r["section"] == "Customer Analytics"] == [
        ("Churn Rate (calc)", "12.34%")]


def test_absent_models_are_an_error(wh):
    with pytest.raises(ValueError, match="dim_product"):
        quality.run_tests({"stg_products": wh.stg_products}, [t for t in DATA_TESTS if "product" in t.model])


def test_build_date_is_today_by_default(spark):
    w = Warehouse(Bronze.from_frames(
        _bronze(spark, "user", USER, [user(1)]), _bronze(spark, "product", PRODUCT, []),
        _bronze(spark, "cart", CART_HEADER, [cart(1, 1, 1.0, 1.0, None)]), None))
    today = spark.sql("SELECT current_date() AS d").first()["d"]
    assert w.stg_orders.first()["order_date"] == today and w.mtd_revenue.first()["report_date"] == today


def test_latest_record_is_the_last_landed(spark):
    one_file = _bronze(spark, "product", PRODUCT, [product(1, stock=5), product(1, stock=7)])
    assert staging.stg_products(one_file, latest=True).count() == 1  # a tie inside one file is settled by the record
