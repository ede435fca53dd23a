"""Marts (A1-A7, P8, P9, J2, J3, J5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import day_diff, money_sum, ratio2, surrogate_key, to_double, trunc_ts
from .facts import dimension_rows
from .staging import as_of_col

# Customer lifecycle labels and thresholds (days).
NEVER_PURCHASED, CHURNED, AT_RISK, ACTIVE = "Never Purchased", "Churned", "At Risk", "Active"
STATUSES = [ACTIVE, AT_RISK, CHURNED, NEVER_PURCHASED]
CHURN_DAYS, AT_RISK_DAYS = 90, 30


def customer_status(total_orders: Column, days_since_last: Column) -> Column:
    # A NULL day count falls through to 'Active', as in the original CASE.
    return (
        F.when(total_orders == 0, NEVER_PURCHASED)
        .when(days_since_last > CHURN_DAYS, CHURNED)
        .when(days_since_last > AT_RISK_DAYS, AT_RISK)
        .otherwise(ACTIVE)
    )


def orders_per_customer(stg_orders: DataFrame) -> DataFrame:
    """One row per customer id: distinct orders, first and last date, spend.

    Reduced from the staged orders, which lie by record and not by customer:
    distinct orders shuffle on (customer, order), so a customer holding a
    third of all orders is spread over all tasks, and sums are combined
    map-side."""
    return stg_orders.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.count_distinct("order_id").alias("_orders"),
        F.min("order_date").alias("_first"),
        F.max("order_date").alias("_last"),
        money_sum("discountedTotal").alias("_sum"),
    )


def _customer_orders(stg_customers: DataFrame, dim_customer: DataFrame, stg_orders: DataFrame, as_of=None,
                     own_dates: bool = True) -> DataFrame:
    """customers LEFT JOIN dim ON id LEFT JOIN fact ON key, grouped by
    (key, name, email), computed without joining a single order row.

    The orders are first reduced to one row per customer, the dimension to
    one row per key with its row count.  The result equals the row-level join
    exactly, duplicates included: each staging row meets ``_dims`` dimension
    rows, and each of those meets the fact rows of the id, of which there are
    ``_dims`` for every order.  All sides are customer-sized and join on the
    id.  (The key is md5 of the id, so matching on the key is matching on it.)
    """
    dims = dimension_rows(dim_customer).alias("dm")
    per_customer = orders_per_customer(stg_orders).alias("pf")
    sc = stg_customers.select("customer_id", "name", "email").alias("sc")
    j = sc.join(dims, F.col("sc.customer_id") == F.col("dm.customer_id"), "left").join(
        per_customer, (F.col("sc.customer_id") == F.col("pf.customer_id")) & F.col("dm._dims").isNotNull(), "left")
    d = as_of_col(as_of)
    g = j.groupBy(F.col("dm.customer_id").alias("_id"), F.col("sc.name").alias("name"),
                  F.col("sc.email").alias("email")).agg(
        F.coalesce(F.max("pf._orders"), F.lit(0)).alias("total_orders"),
        (F.min("pf._first") if own_dates else F.min(d)).alias("first_order_date"),
        (F.max("pf._last") if own_dates else F.max(d)).alias("last_order_date"),
        F.sum(F.col("pf._sum") * (F.col("dm._dims") * F.col("dm._dims"))).alias("_ltv"),
    )
    key = F.when(F.col("_id").isNotNull(), surrogate_key("_id"))
    return g.select(
        key.alias("customer_key"), "name", "email", "total_orders", "first_order_date", "last_order_date",
        to_double("_ltv").alias("lifetime_value"),
        customer_status(F.col("total_orders"), day_diff(d, F.col("last_order_date"))).alias("customer_status"),
    )


def customer_metrics(stg_customers: DataFrame, dim_customer: DataFrame, stg_orders: DataFrame, as_of=None) -> DataFrame:
    """Orders, first/last order date, lifetime value and lifecycle status per
    customer (A1, J2, P8)."""
    return _customer_orders(stg_customers, dim_customer, stg_orders, as_of, own_dates=True)


def customer_churn(stg_customers: DataFrame, dim_customer: DataFrame, stg_orders: DataFrame, as_of=None) -> DataFrame:
    """As :func:`customer_metrics`, but both dates are min/max of the build
    date (quirk Q1): only 'Never Purchased' and 'Active' can come out (A2, J3, P9)."""
    return _customer_orders(stg_customers, dim_customer, stg_orders, as_of, own_dates=False)


def _order_sums(fact: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """One row: how often each key occurs, each value once, and the sums of the orders, in one pass.

    Every order gives one narrow row for each key (kind, value), the amounts
    on that of the order; grouped by (kind, value) they give the distinct
    counts.  A count_distinct for each would copy the joined rows (Expand)."""
    amounts = ("total", "discount_amount", "discounted_total")
    pairs = fact.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("k"), i.cast("bigint").alias("i"), F.lit(int(k == "o")).alias("one"),
                 *[(F.col(c) if k == "o" else F.lit(None).cast("double")).alias(c) for c in amounts])
        for k, i in keys.items()])).alias("p")).select("p.*")
    per_id = pairs.groupBy("k", "i").agg(
        F.sum("one").alias("one"), money_sum("total").alias("_gross"), money_sum("discount_amount").alias("_disc"),
        money_sum("discounted_total").alias("_net"))
    return per_id.agg(
        F.count_if((F.col("k") == "o") & F.col("i").isNotNull()).alias("total_orders"),
        F.count_if((F.col("k") == "c") & F.col("i").isNotNull()).alias("unique_customers"),
        F.count_if(F.col("k") == "d").alias("days"),
        F.coalesce(F.sum("one"), F.lit(0)).alias("orders"),
        *[F.sum(c).alias(c) for c in ("_gross", "_disc", "_net")])


def order_figures(fact: DataFrame) -> DataFrame:
    """One row of the report's figures over all orders: rows, sums, average
    order value (each as :func:`mtd_revenue` has it) and the days of
    :func:`revenue_daily` (orders without a date are one day)."""
    g = _order_sums(fact, {"o": F.col("order_id"), "d": F.unix_date(F.col("order_date").cast("date"))})
    return g.select("orders", "days", "_gross", "_net", ratio2("_net", "total_orders").alias("_avg"))


def mtd_revenue(fact: DataFrame, as_of=None, month_filter: bool = False) -> DataFrame:
    """One row of month-to-date figures.  By default over all orders (quirk
    Q3: the original has no month filter); ``month_filter`` restricts to the
    month of ``as_of``."""
    d = as_of_col(as_of)
    f = fact
    if month_filter:
        f = f.where((F.col("order_date") >= F.trunc(d, "month")) & (F.col("order_date") <= d))
    g = _order_sums(f, {"o": F.col("order_id"), "c": F.col("customer_id")})
    return g.select(
        trunc_ts("month", d).alias("month"),
        d.alias("report_date"),
        "total_orders",
        "unique_customers",
        to_double("_gross").alias("gross_revenue"),
        to_double("_disc").alias("total_discounts"),
        to_double("_net").alias("net_revenue"),
        ratio2("_net", "total_orders").alias("avg_order_value"),
    )


def revenue_daily(fact: DataFrame) -> DataFrame:
    """Net revenue per day (A4; ``revenue_metrics`` is the same model, A5)."""
    g = fact.groupBy(trunc_ts("day", "order_date").alias("report_date")).agg(
        money_sum("discounted_total").alias("_rev"))
    return g.select("report_date", to_double("_rev").alias("daily_revenue"))


revenue_metrics = revenue_daily


def revenue_report(fact_sales: DataFrame) -> DataFrame:
    """Revenue by day from a timestamp, ordered by day."""
    g = fact_sales.groupBy(trunc_ts("day", "order_timestamp").alias("revenue_date")).agg(
        money_sum("total_amount").alias("_rev"))
    return g.select("revenue_date", to_double("_rev").alias("daily_revenue")).orderBy(
        F.col("revenue_date").asc_nulls_last())


def fact_churn(metrics: DataFrame) -> DataFrame:
    """Churn events derived from customer metrics: churn date is 90 days
    after the last order; only 'Churned' customers count as churned."""
    return metrics.select(
        "customer_key",
        F.date_add(F.col("last_order_date"), CHURN_DAYS).alias("churn_date"),
        (F.coalesce(F.col("customer_status") == CHURNED, F.lit(False))).alias("is_churn"),
    )


def churn_report(dim_customer: DataFrame, fact_churn_df: DataFrame) -> DataFrame:
    """Churned customers per month."""
    c = dim_customer.select("customer_key", "customer_id").alias("c")
    f = fact_churn_df.where(F.col("is_churn")).select("customer_key", "churn_date").alias("f")
    j = c.join(f, F.col("c.customer_key") == F.col("f.customer_key"), "inner")
    g = j.groupBy(trunc_ts("month", F.col("f.churn_date")).alias("churn_month")).agg(
        F.count_distinct(F.col("c.customer_id")).alias("churned_customers"))
    return g.orderBy(F.col("churn_month").asc_nulls_last())
