"""KPIs and report lines.

Every KPI is one aggregate over its mart (map-side partial aggregation, one
shuffle of partial rows).  Rankings are top-k with a deterministic tie-break
and compile to ``TakeOrderedAndProject`` (no full sort).  Report text is built
with built-in string functions from the small KPI rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import (count_text, day_diff, label_or_unknown, money_sum, money_text,
                         money_text_or_dash, pad_label, pct2, pct_text, plural, ratio2, round2, to_double, whole)
from .facts import dimension_rows
from .marts import ACTIVE, CHURNED, CHURN_DAYS
from .staging import as_of_col

# Into how many parts the orders of a customer are dealt when they meet the customer's names.
PARTS = 4


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def row_count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("table_name"), "row_count")


def kpi_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for each table; one aggregate each."""
    return _union([row_count(df, name) for name, df in tables.items()])


def kpi_customer_status(metrics: DataFrame) -> DataFrame:
    """Filtered counts, total, average value and churn rate in one pass
    (A8, A9).  The rate divides by ``greatest(total, 1)`` so an empty mart
    gives 0, not an error."""
    g = metrics.agg(
        F.count_if(F.col("customer_status") == ACTIVE).alias("active_customers"),
        F.count_if(F.col("customer_status") == CHURNED).alias("churned_customers"),
        F.count(F.lit(1)).alias("total_customers"),
        money_sum("lifetime_value").alias("_ltv_sum"),
        F.count("lifetime_value").alias("_ltv_n"),
    )
    return g.select(
        "active_customers", "churned_customers", "total_customers",
        F.coalesce(ratio2("_ltv_sum", "_ltv_n"), F.lit(0.0)).alias("avg_ltv"),
        pct2("churned_customers", F.greatest(F.col("total_customers"), F.lit(1))).alias("churn_rate_pct"),
    )


def kpi_total_revenue(daily: DataFrame) -> DataFrame:
    """Total of the daily revenue mart, 0 when empty."""
    return daily.agg(money_sum("daily_revenue").alias("_t")).select(
        F.coalesce(to_double("_t"), F.lit(0.0)).alias("total_revenue"))


def kpi_mtd_summary(mtd: DataFrame) -> DataFrame:
    """Four sums over the month-to-date mart."""
    return mtd.agg(
        to_double(money_sum("net_revenue")).alias("net_revenue"),
        to_double(money_sum("gross_revenue")).alias("gross_revenue"),
        F.sum("total_orders").alias("total_orders"),
        F.sum("unique_customers").alias("unique_customers"),
    )


def kpi_avg_ltv(metrics: DataFrame) -> DataFrame:
    """Average lifetime value to the cent, NULLs ignored."""
    return metrics.agg(money_sum("lifetime_value").alias("_s"), F.count("lifetime_value").alias("_n")).select(
        ratio2("_s", "_n").alias("avg_ltv"))


def kpi_revenue_summary(daily: DataFrame) -> DataFrame:
    """Revenue over all days (NULL when there is none) and the day count."""
    return daily.agg(to_double(money_sum("daily_revenue")).alias("total_revenue"),
                     F.count(F.lit(1)).alias("days"))


def kpi_latest_day(daily: DataFrame) -> DataFrame:
    """Latest day and its revenue (A20, O3): top-1."""
    return daily.orderBy(F.col("report_date").desc_nulls_last()).limit(1).select("report_date", "daily_revenue")


def churn_rate_by_status(churn: DataFrame) -> DataFrame:
    """Percent of customers whose status is 'Churned' (A17, P13)."""
    return churn.agg(F.sum(F.when(F.col("customer_status") == CHURNED, 1).otherwise(0)).alias("_c"),
                     F.count(F.lit(1)).alias("_n")).select(pct2("_c", "_n").alias("churn_rate_pct"))


def churn_rate_by_date(churn: DataFrame, as_of=None) -> DataFrame:
    """Percent of customers whose last order is more than 90 days old."""
    late = day_diff(as_of_col(as_of), F.col("last_order_date")) > CHURN_DAYS
    return churn.agg(F.sum(F.when(late, 1).otherwise(0)).alias("_c"),
                     F.count(F.lit(1)).alias("_n")).select(pct2("_c", "_n").alias("churn_rate_pct"))


def top_products(lines: DataFrame, k: int = 5) -> DataFrame:
    """Best sellers by revenue over raw order lines, grouped by title.

    Reads the raw lines without de-duplication, as the original does
    (quirk Q5)."""
    g = lines.groupBy(F.col("line.title").alias("title")).agg(
        F.sum("line.quantity").alias("_units"), money_sum("line.discountedTotal").alias("_rev"))
    return (g.select("title", whole("_units").alias("units"), round2("_rev").alias("revenue"))
            .orderBy(F.col("revenue").desc_nulls_last(), F.col("title").asc_nulls_last()).limit(k))


def top_products_by_qty(lines: DataFrame, k: int = 5) -> DataFrame:
    """Units sold per product id, top k."""
    g = lines.groupBy(F.col("line.id").alias("product_id")).agg(F.sum("line.quantity").alias("qty"))
    return g.orderBy(F.col("qty").desc_nulls_last(), F.col("product_id").asc_nulls_last()).limit(k)


def top_customers(stg_orders: DataFrame, dim_customer: DataFrame, stg_customers: DataFrame, k: int = 5) -> DataFrame:
    """Best customers by spend, grouped by name (A13, J4; namesakes merge and
    orphan orders drop out, quirk Q6).

    fact JOIN dim ON key JOIN staging ON id.  An order of an id with d
    dimension rows has d fact rows, each of which meets d dimension rows and
    every staging row of the id, so it counts d * d times for each of those.
    The weights come from customer-sized frames, joined on the id.  Orders are
    summed per (customer, order) first and meet them on the id and a part
    (order id modulo PARTS), so a hot customer's orders go to several tasks,
    and both sides are plain shuffles that AQE can split further."""
    part = F.coalesce(F.pmod(F.col("order_id"), F.lit(PARTS)), F.lit(0)).cast("int")
    per_order = stg_orders.groupBy("customer_id", "order_id").agg(
        money_sum("discountedTotal").alias("_spend")).withColumn("_part", part).alias("o")
    names = stg_customers.select("customer_id", "name").join(dimension_rows(dim_customer), "customer_id").select(
        "customer_id", "name", (F.col("_dims") * F.col("_dims")).alias("_weight"),
        F.explode(F.array(*[F.lit(i) for i in range(PARTS)])).alias("_part")).alias("n")
    j = per_order.join(names, (F.col("o.customer_id") == F.col("n.customer_id")) & (F.col("o._part") == F.col("n._part")))
    g = j.groupBy(F.col("n.name").alias("name")).agg(
        F.count_distinct(F.col("o.order_id")).alias("_orders"),
        F.sum(F.col("o._spend") * F.col("n._weight")).alias("_spend"))
    return (g.select("name", whole("_orders").alias("orders"), round2("_spend").alias("spend"))
            .orderBy(F.col("spend").desc_nulls_last(), F.col("name").asc_nulls_last()).limit(k))


def _min_width_left(s: Column, w: int) -> Column:
    return F.when(F.length(s) >= w, s).otherwise(F.lpad(s, w, " "))


def _min_width_right(s: Column, w: int) -> Column:
    return F.when(F.length(s) >= w, s).otherwise(F.rpad(s, w, " "))


def _ranked(top: DataFrame, order: list[Column]) -> DataFrame:
    # ``top`` is already cut to k rows, so this window sees k rows only.
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def top_products_text(top: DataFrame) -> DataFrame:
    """Report lines of the best sellers (F17): '1. <title:28> <units:>3> Orders   $x'."""
    r = _ranked(top, [F.col("revenue").desc_nulls_last(), F.col("title").asc_nulls_last()])
    title = _min_width_right(label_or_unknown("title", 28), 28)
    line = F.concat(F.col("rank").cast("string"), F.lit(". "), title, F.lit(" "),
                    _min_width_left(F.col("units").cast("string"), 3), F.lit(" Orders   "), money_text("revenue"))
    return r.select("rank", line.alias("line"))


def top_customers_text(top: DataFrame) -> DataFrame:
    """'1. <name:22> <orders:>2> <Order|Orders:6> <money:>12>'."""
    r = _ranked(top, [F.col("spend").desc_nulls_last(), F.col("name").asc_nulls_last()])
    name = _min_width_right(label_or_unknown("name", 22), 22)
    word = _min_width_right(plural("orders", "Order", "Orders"), 6)
    line = F.concat(F.col("rank").cast("string"), F.lit(". "), name, F.lit(" "),
                    _min_width_left(F.col("orders").cast("string"), 2), F.lit(" "), word, F.lit(" "),
                    _min_width_left(money_text("spend"), 12))
    return r.select("rank", line.alias("line"))


def _report(src: DataFrame, lines: list[tuple[int, str, Column]]) -> DataFrame:
    """Lines (number, fixed label, value) made of one row of figures."""
    return src.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("line_no"), F.concat(pad_label(F.lit(label)), value).alias("line"))
        for n, label, value in lines])).alias("l")).select("l.line_no", "l.line")


def _plain(c: str) -> Column:
    return F.col(c).cast("string")


def report_of_orders(figures: DataFrame) -> DataFrame:
    """Report lines 3 to 8 from ``marts.order_figures``: the orders are read once."""
    # The labels of the report.
    return _report(figures, [
        (3, "Total Orders", _plain("orders")),
        (4, "Gross Revenue", money_text("_gross")), (5, "Net Revenue", money_text("_net")),
        (6, "Average Order Value", money_text("_avg")),
        (7, "Total Revenue", money_text("_net")), (8, "Daily Revenue Rows", _plain("days"))])


def report_of_marts(fact: DataFrame, mtd: DataFrame, daily: DataFrame) -> DataFrame:
    """The same lines from built tables, one aggregate a table."""
    count = F.count(F.lit(1)).alias("n")
    return _union([
        _report(fact.agg(count), [(3, "Total Orders", _plain("n"))]),
        _report(mtd.agg(money_sum("gross_revenue").alias("g"), money_sum("net_revenue").alias("n"),
                        money_sum("avg_order_value").alias("a")),
                [(4, "Gross Revenue", money_text("g")), (5, "Net Revenue", money_text("n")),
                 (6, "Average Order Value", money_text("a"))]),
        _report(daily.agg(money_sum("daily_revenue").alias("t"), count),
                [(7, "Total Revenue", money_text("t")), (8, "Daily Revenue Rows", _plain("n"))]),
    ])


def kpi_report_text(dim_customer: DataFrame, order_lines: DataFrame, metrics: DataFrame,
                    raw: dict[str, DataFrame]) -> DataFrame:
    """The numeric lines of the run report as (line_no, line).

    One aggregate per mart or raw table, stacked to its lines; no frame is
    joined to another, and nothing is collected.  ``order_lines`` come from
    :func:`report_of_orders` or :func:`report_of_marts`.  ``raw`` has the
    bronze frames of customers, products and orders: customers and products
    extracted are the totals the source reports, orders extracted is the
    landed count.  Counts are printed plainly."""
    n = _plain("n")
    rows = F.concat(n, F.lit(" rows"))
    total = _plain("total")
    count = F.count(F.lit(1)).alias("n")
    extracted = (count, F.coalesce(F.max("_total"), F.count(F.lit(1))).alias("total"))
    return _union([
        _report(dim_customer.agg(count), [(1, "Total Customers", n)]),
        order_lines,
        _report(kpi_customer_status(metrics), [
            (9, "Active Customers", _plain("active_customers")), (10, "Churned Customers", _plain("churned_customers")),
            (11, "Customer Churn Rate", pct_text("churn_rate_pct")), (12, "Average Customer LTV", money_text("avg_ltv"))]),
        _report(raw["customers"].agg(*extracted), [(13, "Customers Extracted", total), (16, "Customers Table", rows)]),
        _report(raw["products"].agg(*extracted),
                [(2, "Total Products", total), (14, "Products Extracted", total), (17, "Products Table", rows)]),
        _report(raw["orders"].agg(count), [(15, "Orders Extracted", n), (18, "Orders Table", rows)]),
    ])


def _section(src: DataFrame, rows: list[tuple[int, int, str, Column, Column]]) -> DataFrame:
    """Dashboard rows (section, row, title, metric, value) made of one row of figures."""
    return src.select(F.explode(F.array(*[
        F.struct(F.lit(s).alias("section_no"), F.lit(r).alias("row_no"), F.lit(title).alias("section"),
                 metric.alias("metric"), value.alias("value")) for s, r, title, metric, value in rows])).alias("r")).select("r.*")


def dashboard(models: dict[str, DataFrame], as_of=None, reports: tuple[str, ...] = ()) -> DataFrame:
    """The analytics dashboard as rows ``(section_no, row_no, section,
    metric, value)`` (3.3).  A section runs only when its model is present
    and has the needed column (P14, S17); the last row counts which of the
    discovered analytics models ``reports`` are present.  The product section
    uses exploded order lines (quirk Q9), and the churn rate uses the last
    order date when present, else a stored ``churn_rate`` fraction (A24),
    else the status.  Every mart is aggregated once."""
    # The section titles and metric labels.
    sales, product, customer, revenue = "Sales Summary", "Product Analytics", "Customer Analytics", "Revenue Analytics"
    parts: list[DataFrame] = []
    mtd = models.get("mtd_revenue")
    if mtd is not None:
        shown = [(c, label, fmt) for c, label, fmt in (
            ("net_revenue", "MTD Net Revenue", money_text_or_dash), ("gross_revenue", "MTD Gross Revenue", money_text_or_dash),
            ("total_orders", "Orders MTD", count_text), ("unique_customers", "Customers MTD", count_text)) if c in mtd.columns]
        if shown:
            sums = mtd.agg(*[(money_sum(c) if fmt is money_text_or_dash else F.sum(c)).alias(c) for c, _, fmt in shown])
            parts.append(_section(sums, [(1, i, sales, F.lit(label), fmt(c)) for i, (c, label, fmt) in enumerate(shown)]))
    lines = models.get("order_lines")
    if lines is not None and {"product_id", "quantity"} <= set(lines.columns):
        best = [F.col("qty").desc_nulls_last(), F.col("product_id").asc_nulls_last()]
        top = lines.groupBy("product_id").agg(F.sum("quantity").alias("qty")).orderBy(*best).limit(5)
        parts.append(_ranked(top, best).select(
            F.lit(2).alias("section_no"), F.col("rank").cast("int").alias("row_no"), F.lit(product).alias("section"),
            F.concat(F.lit("Product "), F.col("product_id").cast("string")).alias("metric"),
            F.concat(count_text("qty"), F.lit(" sold")).alias("value")))
    churn = models.get("customer_churn")
    if churn is not None:
        rate = None
        if "last_order_date" in churn.columns:
            rate = churn_rate_by_date(churn, as_of)
        elif "churn_rate" in churn.columns:  # A24: a stored fraction, read back as a percent
            rate = churn.select((F.col("churn_rate").cast("decimal(38,6)") * 100).alias("churn_rate_pct")).limit(1)
        elif "customer_status" in churn.columns:
            rate = churn_rate_by_status(churn)
        if rate is not None:
            parts.append(_section(rate, [(3, 0, customer, F.lit("Churn Rate (calc)"), pct_text("churn_rate_pct"))]))
    metrics = models.get("analytics_customer_metrics")
    if metrics is not None and "lifetime_value" in metrics.columns:
        parts.append(_section(kpi_avg_ltv(metrics), [(3, 1, customer, F.lit("Avg LTV"), money_text_or_dash("avg_ltv"))]))
    daily = models.get("analytics_revenue_daily")
    if daily is not None and "daily_revenue" in daily.columns:
        newest = F.max(F.when(F.col("report_date").isNotNull(), F.struct("report_date", "daily_revenue"))).alias("newest")
        both = daily.agg(money_sum("daily_revenue").alias("total"), newest)
        day = F.concat(F.lit("Latest ("), F.date_format("newest.report_date", "yyyy-MM-dd"), F.lit(")"))
        parts.append(_section(both, [(4, 0, revenue, F.lit("Total Revenue"), money_text_or_dash("total")),
                                     (4, 1, revenue, day, money_text_or_dash(F.col("newest.daily_revenue")))]).where("metric IS NOT NULL"))
    present = sum(1 for name in reports if name in models)
    parts.append(_section(SparkSession.active().range(1), [
        (5, 0, "Summary", F.lit("Reports executed"), F.lit(str(present)))]))
    return _union(parts)
