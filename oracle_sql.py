"""Oracle: DuckDB SQL over the driver's flat tables (customer, nation, part,
orders, lineitem), for every registered query.

Written from the rules of the survey, not from any model text: landed records
first, then the facts of each customer once (orders, dates, spend), and every
mart and KPI from those.  Money is counted in whole units of 1/10000 by the same
rule as in Spark (the amount times 10^4 to the nearest unit, halves away from
zero); a rounded ratio is integer arithmetic on units.
"""

from __future__ import annotations

DAY = "DATE '2001-08-02'"


def units(x: str) -> str:
    v = f"(({x}) * 10000.0::DOUBLE)"
    return f"CAST(sign({v}) * floor(abs({v}) + 0.5::DOUBLE) AS HUGEINT)"


def total(x: str) -> str:
    """Units of all amounts ``x`` of a group."""
    return f"sum({units(x)})"


def amount(u: str) -> str:
    return f"(CAST(({u}) AS DOUBLE) / 10000.0)"


def cents(u: str) -> str:
    """Units, none negative, as a double rounded to cents, halves up."""
    return f"(CAST((CAST(({u}) AS HUGEINT) + 50) // 100 AS DOUBLE) / 100.0)"


def per(u: str, n: str) -> str:
    """Units per ``n``, none negative, rounded to cents exactly; NULL if n = 0."""
    return f"(CAST((CAST(({u}) AS HUGEINT) + 50 * ({n})) // nullif(100 * ({n}), 0) AS DOUBLE) / 100.0)"


def percent(part: str, whole: str) -> str:
    return per(f"CAST(({part}) AS HUGEINT) * 1000000", whole)


def money(u: str) -> str:
    return f"('$' || format('{{:,.2f}}', {cents(f'coalesce({u}, 0)')}))"


def pct(x: str) -> str:
    return f"(CAST(CAST(round(CAST(coalesce({x}, 0) AS DECIMAL(38,4)), 2) AS DECIMAL(38,2)) AS VARCHAR) || '%')"


def plain(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def thousands(x: str) -> str:
    return f"format('{{:,}}', CAST({x} AS BIGINT))"


def least(s: str, width: int, side: str) -> str:
    """``s`` padded to ``width`` on one side, never cut."""
    return f"(CASE WHEN length({s}) >= {width} THEN {s} ELSE {side}({s}, {width}, ' ') END)"


def known(x: str, width: int) -> str:
    return f"(CASE WHEN coalesce({x}, '') = '' THEN 'Unknown' ELSE substr({x}, 1, {width}) END)"


def page(entity: str, key: str) -> str:
    return (f"'{entity}/2001/08/0' || CAST(n + 1 AS VARCHAR) || '/{entity}_2001080' || CAST(n + 1 AS VARCHAR) "
            f"|| '_000000/page-' || CAST({key} // 100 AS VARCHAR)")


NET = "l_extendedprice * (1.0::DOUBLE - l_discount)"

BASE = f"""
WITH
twice AS (SELECT unnest([1, 2]) AS n),
people AS (
  SELECT {page('customers', 'c_custkey')} AS source, c_custkey AS id,
         split_part(c_name, '#', 1) AS first, CASE WHEN c_custkey % 30 <> 9 THEN split_part(c_name, '#', 2) END AS last,
         CASE WHEN c_custkey % 35 <> 4 THEN 'c' || c_custkey || '@example.com' END AS email,
         CASE WHEN n = 2 AND c_custkey % 40 = 5 THEN '555' END AS phone,
         'c' || c_custkey AS username, lower(c_mktsegment) AS gender, n_name AS city
  FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
  JOIN twice ON n = 1 OR (c_custkey // 100) % 4 = 0 OR c_custkey % 40 = 5),
goods AS (
  SELECT {page('products', 'p_partkey')} AS source, p_partkey AS product_id, p_name AS title,
         p_type || ' ' || p_brand AS description, p_type AS category, p_retailprice AS price,
         p_size / 2.0::DOUBLE AS discount_percentage, p_size / 10.0::DOUBLE AS rating,
         CAST(p_size - 1 + CASE WHEN n = 2 AND p_partkey % 50 = 0 THEN 1 ELSE 0 END AS BIGINT) AS stock,
         p_brand AS brand, 'SKU-' || p_partkey AS sku
  FROM part JOIN twice ON n = 1 OR (p_partkey // 100) % 5 = 0 OR p_partkey % 50 = 0),
sums AS (
  SELECT l_orderkey, {total('l_extendedprice')} AS gross, {total(NET)} AS net, count(*) AS items, sum(l_quantity) AS pieces
  FROM lineitem GROUP BY ALL),
baskets AS (
  SELECT 'orders/' || strftime(o_orderdate, '%Y/%m/%d') || '/orders_' || strftime(o_orderdate, '%Y%m%d')
           || CASE n WHEN 1 THEN '_000000' ELSE '_120000' END || '.json' AS source,
         o_orderkey AS order_id,
         CASE WHEN o_orderkey % 97 = 0 THEN -1 - o_custkey WHEN o_orderkey % 101 = 0 THEN NULL
              WHEN o_custkey % 10 = 3 THEN o_custkey - 1 ELSE o_custkey END AS customer_id,
         {amount('coalesce(gross, 0)')} AS total, {amount('coalesce(net, 0)')} AS "discountedTotal",
         CAST(coalesce(items, 0) AS BIGINT) AS "totalProducts", CAST(coalesce(pieces, 0) AS BIGINT) AS "totalQuantity",
         CAST(o_orderdate AS DATE) AS order_date
  FROM orders LEFT JOIN sums ON l_orderkey = o_orderkey JOIN twice ON n = 1 OR o_orderkey % 64 = 0),
items AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_id, p_name AS title, CAST(l_quantity AS BIGINT) AS quantity,
         {amount(units(NET))} AS discounted_total
  FROM lineitem LEFT JOIN part ON p_partkey = l_partkey JOIN twice ON n = 1 OR l_orderkey % 64 = 0),
stg_customers AS (
  SELECT DISTINCT id AS customer_id, first || ' ' || last AS name, email, phone, username, gender, city FROM people),
stg_products AS (SELECT DISTINCT * EXCLUDE (source) FROM goods),
stg_orders AS (SELECT DISTINCT * EXCLUDE (source) FROM baskets),
dim_customer AS (
  SELECT md5(CAST(customer_id AS VARCHAR)) AS customer_key, customer_id, name, email, city, gender FROM stg_customers),
dim_product AS (
  SELECT md5(CAST(product_id AS VARCHAR)) AS product_key, *,
         CASE WHEN stock > 10 THEN 'In Stock' WHEN stock > 0 THEN 'Low Stock' ELSE 'Out of Stock' END AS stock_status
  FROM stg_products),
versions AS (SELECT customer_id, count(*) AS d FROM stg_customers GROUP BY ALL),
fact_orders AS (
  SELECT md5(CAST(order_id AS VARCHAR)) AS order_key, order_id,
         CASE WHEN d IS NOT NULL THEN md5(CAST(customer_id AS VARCHAR)) END AS customer_key, customer_id, total,
         "discountedTotal" AS discounted_total, total - "discountedTotal" AS discount_amount,
         "totalProducts" AS total_products, "totalQuantity" AS total_quantity, order_date
  FROM stg_orders LEFT JOIN versions USING (customer_id), range(coalesce(d, 1))),
bought AS (
  SELECT customer_id, count(DISTINCT order_id) AS n, min(order_date) AS since, max(order_date) AS until,
         {total('"discountedTotal"')} AS spent
  FROM stg_orders GROUP BY ALL),
buyers AS (
  SELECT md5(CAST(customer_id AS VARCHAR)) AS customer_key, name, email, coalesce(max(n), 0) AS total_orders,
         min(since) AS since, max(until) AS until, {amount('sum(spent * d * d)')} AS lifetime_value
  FROM stg_customers JOIN versions USING (customer_id) LEFT JOIN bought USING (customer_id) GROUP BY ALL),
customer_metrics AS (
  SELECT customer_key, name, email, total_orders, since AS first_order_date, until AS last_order_date, lifetime_value,
         CASE WHEN total_orders = 0 THEN 'Never Purchased' WHEN {DAY} - until > 90 THEN 'Churned'
              WHEN {DAY} - until > 30 THEN 'At Risk' ELSE 'Active' END AS customer_status
  FROM buyers),
customer_churn AS (
  SELECT customer_key, name, email, total_orders, {DAY} AS first_order_date, {DAY} AS last_order_date, lifetime_value,
         CASE total_orders WHEN 0 THEN 'Never Purchased' ELSE 'Active' END AS customer_status
  FROM buyers),
mtd_units AS (
  SELECT count(DISTINCT order_id) AS n, count(DISTINCT customer_id) AS c, {total('total')} AS gross,
         {total('discount_amount')} AS off, {total('discounted_total')} AS net
  FROM fact_orders),
mtd_revenue AS (
  SELECT date_trunc('month', {DAY}) AS month, {DAY} AS report_date, n AS total_orders, c AS unique_customers,
         {amount('gross')} AS gross_revenue, {amount('off')} AS total_discounts, {amount('net')} AS net_revenue,
         {per('net', 'n')} AS avg_order_value
  FROM mtd_units),
revenue_daily AS (
  SELECT CAST(order_date AS TIMESTAMP) AS report_date, {amount(total('discounted_total'))} AS daily_revenue
  FROM fact_orders GROUP BY order_date),
analytics_revenue_daily AS (FROM revenue_daily),
analytics_customer_metrics AS (FROM customer_metrics),
revenue_metrics AS (FROM revenue_daily),
best_items AS (
  SELECT title, CAST(sum(quantity) AS BIGINT) AS units, {cents(total('discounted_total'))} AS revenue,
         row_number() OVER (ORDER BY {cents(total('discounted_total'))} DESC, title) AS rank
  FROM items GROUP BY title QUALIFY rank <= 5),
best_buyers AS (
  SELECT s.name, count(DISTINCT o.order_id) AS orders, {cents(f'sum({units(chr(34) + "discountedTotal" + chr(34))} * d * d)')} AS spend,
         row_number() OVER (ORDER BY {cents(f'sum({units(chr(34) + "discountedTotal" + chr(34))} * d * d)')} DESC, s.name) AS rank
  FROM stg_orders o JOIN stg_customers s USING (customer_id) JOIN versions USING (customer_id)
  GROUP BY s.name QUALIFY rank <= 5),
status AS (
  SELECT count(*) FILTER (customer_status = 'Active') AS active_customers,
         count(*) FILTER (customer_status = 'Churned') AS churned_customers, count(*) AS total_customers,
         coalesce({per(total('lifetime_value'), 'count(lifetime_value)')}, 0.0) AS avg_ltv,
         {percent("count(*) FILTER (customer_status = 'Churned')", 'greatest(count(*), 1)')} AS churn_rate_pct
  FROM customer_metrics)
"""


def _union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


LANDED = {"customers": ("people", "(SELECT count(*) FROM customer)"), "products": ("goods", "(SELECT count(*) FROM part)"),
          "orders": ("baskets", "NULL")}
FETCH = r"regexp_extract(source, '^(.*/[^/]*_\d{8}_\d{6})', 1)"


def _null(model: str, *columns: str) -> list[str]:
    return [f"SELECT '{model}' AS model, '{c}' AS \"column\", 'not_null' AS test, "
            f"CAST(count(*) - count({c}) AS BIGINT) AS failing_rows FROM {model}" for c in columns]


def _once(model: str, *columns: str) -> list[str]:
    return [f"SELECT '{model}' AS model, '{c}' AS \"column\", 'unique' AS test, (SELECT count(*) FROM "
            f"(SELECT 1 FROM {model} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)) AS failing_rows" for c in columns]


def _among(model: str, column: str, values: str) -> list[str]:
    return [f"SELECT '{model}' AS model, '{column}' AS \"column\", 'accepted_values' AS test, "
            f"(SELECT count(*) FROM (SELECT DISTINCT {column} FROM {model} WHERE {column} NOT IN ({values}))) AS failing_rows"]


def _parent(model: str, column: str, parent: str, key: str) -> list[str]:
    return [f"SELECT '{model}' AS model, '{column}' AS \"column\", 'relationships' AS test, count(*) AS failing_rows "
            f"FROM {model} WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {key} FROM {parent})"]


STATUSES = "'Active', 'At Risk', 'Churned', 'Never Purchased'"
TESTS = {
    "not_null": [
        *_null("stg_products", "product_id"), *_null("stg_orders", "order_id"), *_null("stg_customers", "customer_id", "email"),
        *_null("dim_product", "product_key", "product_id", "category", "price"),
        *_null("dim_customer", "customer_key", "customer_id", "email"),
        *_null("fact_orders", "order_key", "order_id", "customer_key", "total"),
        *_null("mtd_revenue", "month", "total_orders", "net_revenue"), *_null("customer_churn", "customer_key"),
        *_null("analytics_revenue_daily", "report_date", "daily_revenue"), *_null("analytics_customer_metrics", "customer_key")],
    "unique": [
        *_once("stg_products", "product_id"), *_once("stg_orders", "order_id"), *_once("stg_customers", "customer_id"),
        *_once("dim_product", "product_key", "product_id"), *_once("dim_customer", "customer_key", "customer_id", "email"),
        *_once("fact_orders", "order_key", "order_id")],
    "accepted_values": [
        *_among("customer_churn", "customer_status", STATUSES), *_among("analytics_customer_metrics", "customer_status", STATUSES)],
    "relationships": _parent("fact_orders", "customer_key", "dim_customer", "customer_key"),
}
MORE = {
    "accepted_values": _among("stg_customers", "gender", "'automobile', 'building', 'furniture', 'machinery'"),
    "relationships": _parent("stg_orders", "customer_id", "stg_customers", "customer_id"),
}


def _line(no: int, label: str, value: str, source: str) -> str:
    return f"SELECT {no} AS line_no, rpad('{label}', 22, ' ') || ': ' || {value} AS line FROM {source}"


def _reported(entity: str) -> str:
    rows, said = LANDED[entity]
    return f"(SELECT coalesce({said}, count(*)) AS x FROM {rows})"


def _count(rows: str) -> str:
    return f"(SELECT count(*) AS x FROM {rows})"


REPORT = _union([
    _line(1, "Total Customers", plain("x"), _count("dim_customer")),
    _line(2, "Total Products", plain("x"), _reported("products")),
    _line(3, "Total Orders", plain("x"), _count("fact_orders")),
    _line(4, "Gross Revenue", money("gross"), "mtd_units"),
    _line(5, "Net Revenue", money("net"), "mtd_units"),
    _line(6, "Average Order Value", money(units("avg_order_value")), "mtd_revenue"),
    _line(7, "Total Revenue", money("x"), f"(SELECT {total('daily_revenue')} AS x FROM revenue_daily)"),
    _line(8, "Daily Revenue Rows", plain("x"), _count("revenue_daily")),
    _line(9, "Active Customers", plain("active_customers"), "status"),
    _line(10, "Churned Customers", plain("churned_customers"), "status"),
    _line(11, "Customer Churn Rate", pct("churn_rate_pct"), "status"),
    _line(12, "Average Customer LTV", money(units("avg_ltv")), "status"),
    _line(13, "Customers Extracted", plain("x"), _reported("customers")),
    _line(14, "Products Extracted", plain("x"), _reported("products")),
    _line(15, "Orders Extracted", plain("x"), _count("baskets")),
    _line(16, "Customers Table", plain("x") + " || ' rows'", _count("people")),
    _line(17, "Products Table", plain("x") + " || ' rows'", _count("goods")),
    _line(18, "Orders Table", plain("x") + " || ' rows'", _count("baskets")),
])


def _cell(section: int, row: str, title: str, metric: str, value: str, source: str) -> str:
    return (f"SELECT {section} AS section_no, CAST({row} AS INTEGER) AS row_no, '{title}' AS section, {metric} AS metric, "
            f"{value} AS value FROM {source}")


REPORTS = ("analytics_customer_metrics", "analytics_revenue_daily", "revenue_metrics", "customer_churn", "mtd_revenue")
SOLD = "(SELECT product_id, sum(quantity) AS q FROM items GROUP BY ALL ORDER BY q DESC, product_id LIMIT 5)"
LATE = f"count(*) FILTER ({DAY} - last_order_date > 90)"
CHURNED = "count(*) FILTER (customer_status = 'Churned')"
DASHBOARD = _union([
    _cell(1, "0", "Sales Summary", "'MTD Net Revenue'", money("net"), "mtd_units"),
    _cell(1, "1", "Sales Summary", "'MTD Gross Revenue'", money("gross"), "mtd_units"),
    _cell(1, "2", "Sales Summary", "'Orders MTD'", thousands("n"), "mtd_units"),
    _cell(1, "3", "Sales Summary", "'Customers MTD'", thousands("c"), "mtd_units"),
    _cell(2, "row_number() OVER (ORDER BY q DESC, product_id)", "Product Analytics", "'Product ' || product_id",
          thousands("q") + " || ' sold'", SOLD),
    _cell(3, "0", "Customer Analytics", "'Churn Rate (calc)'", pct("r"),
          f"(SELECT {percent(LATE, 'count(*)')} AS r FROM customer_churn)"),
    _cell(3, "1", "Customer Analytics", "'Avg LTV'", money(units("a")),
          f"(SELECT {per(total('lifetime_value'), 'count(lifetime_value)')} AS a FROM customer_metrics)"),
    _cell(4, "0", "Revenue Analytics", "'Total Revenue'", money("x"), f"(SELECT {total('daily_revenue')} AS x FROM revenue_daily)"),
    _cell(4, "1", "Revenue Analytics", "'Latest (' || strftime(report_date, '%Y-%m-%d') || ')'", money(units("daily_revenue")),
          "(SELECT * FROM revenue_daily ORDER BY report_date DESC LIMIT 1)"),
    _cell(5, "0", "Summary", "'Reports executed'", plain("sum(x)"), "(" + " UNION ALL ".join(
        f"(SELECT CASE WHEN count(*) >= 0 THEN 1 END AS x FROM {m})" for m in REPORTS) + ")"),
])

PRICE_CENTS = "CAST(round(CAST(price AS DECIMAL(18,4)) * 100) AS BIGINT)"
QUERIES = {
    "raw_batch_counts": _union(
        f"SELECT '{e}' AS entity, source, count(*) AS records FROM {r} GROUP BY source" for e, (r, _) in LANDED.items()),
    "raw_load_totals": _union(
        f"SELECT '{e}' AS entity, count(*) AS records, count(DISTINCT source) AS files FROM {r}" for e, (r, _) in LANDED.items()),
    "extraction_completeness": _union(
        f"SELECT '{e}' AS entity, {FETCH} AS batch, count(*) AS landed, coalesce({t}, count(*)) AS reported_total, "
        f"count(*) >= coalesce({t}, count(*)) AS complete FROM {r} GROUP BY 2" for e, (r, t) in LANDED.items()),
    **{m: f"FROM {m}" for m in (
        "stg_customers", "stg_products", "stg_orders", "dim_customer", "dim_product", "fact_orders", "customer_metrics",
        "customer_churn", "mtd_revenue", "revenue_daily", "revenue_metrics")},
    "unnest_order_lines": "FROM items",
    "revenue_report": f"SELECT CAST(order_date AS TIMESTAMP) AS revenue_date, {amount(total('total'))} AS daily_revenue "
                      "FROM fact_orders GROUP BY order_date",
    "churn_report": "SELECT date_trunc('month', last_order_date + 90) AS churn_month, count(DISTINCT customer_key) "
                    "AS churned_customers FROM customer_metrics WHERE customer_status = 'Churned' GROUP BY 1",
    "top_products": "SELECT title, units, revenue FROM best_items",
    "top_products_by_qty": f"SELECT product_id, CAST(q AS BIGINT) AS qty FROM {SOLD}",
    "top_customers": "SELECT name, orders, spend FROM best_buyers",
    "kpi_row_counts": _union(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {t}" for n, t in (
        ("dim_customer", "dim_customer"), ("dim_product", "dim_product"), ("fact_orders", "fact_orders"),
        ("analytics_revenue_daily", "revenue_daily"), ("raw_customers", "people"), ("raw_products", "goods"),
        ("raw_orders", "baskets"))),
    "kpi_customer_status": "FROM status",
    "kpi_total_revenue": f"SELECT coalesce({amount(total('daily_revenue'))}, 0.0) AS total_revenue FROM revenue_daily",
    "kpi_mtd_summary": f"SELECT {amount('net')} AS net_revenue, {amount('gross')} AS gross_revenue, n AS total_orders, "
                       "c AS unique_customers FROM mtd_units",
    "kpi_avg_ltv": f"SELECT {per(total('lifetime_value'), 'count(lifetime_value)')} AS avg_ltv FROM customer_metrics",
    "kpi_revenue_summary": f"SELECT {amount(total('daily_revenue'))} AS total_revenue, count(*) AS days FROM revenue_daily",
    "kpi_latest_day": "SELECT * FROM revenue_daily ORDER BY report_date DESC LIMIT 1",
    "churn_rate_by_status": f"SELECT {percent(CHURNED, 'count(*)')} AS churn_rate_pct FROM customer_churn",
    "churn_rate_by_date": f"SELECT {percent(LATE, 'count(*)')} AS churn_rate_pct FROM customer_churn",
    "metrics_churn_rates": f"SELECT 'status' AS by, {percent(CHURNED, 'count(*)')} AS rate FROM customer_metrics UNION ALL "
                           f"SELECT 'date', {percent(LATE, 'count(*)')} FROM customer_metrics",
    "cents_to_dollars": f"SELECT product_id, {PRICE_CENTS} AS price_cents, CAST({PRICE_CENTS} AS DOUBLE) / 100.0 AS price_dollars "
                        "FROM stg_products",
    "kpi_report_text": REPORT,
    "dashboard": DASHBOARD,
    "top_products_text": f"SELECT CAST(rank AS INTEGER) AS rank, rank || '. ' || {least(known('title', 28), 28, 'rpad')} || ' ' || "
                         f"{least(plain('units'), 3, 'lpad')} || ' Orders   ' || {money(units('revenue'))} AS line FROM best_items",
    "top_customers_text": f"SELECT CAST(rank AS INTEGER) AS rank, rank || '. ' || {least(known('name', 22), 22, 'rpad')} || ' ' || "
                          f"{least(plain('orders'), 2, 'lpad')} || ' ' || rpad(CASE orders WHEN 1 THEN 'Order' ELSE 'Orders' END, 6, ' ') "
                          f"|| ' ' || {least(money(units('spend')), 12, 'lpad')} AS line FROM best_buyers",
    **{f"dq_{k}": _union([*t, *MORE.get(k, [])]) for k, t in TESTS.items()},
    "dq_summary": "SELECT count(*) AS tests_run, count(*) FILTER (failing_rows = 0) AS tests_passed, "
                  "count(*) FILTER (failing_rows > 0) AS tests_failed, CAST(11 AS BIGINT) AS models_built FROM ("
                  + _union(t for tests in TESTS.values() for t in tests) + ")",
}

WRONG = "id % 37 = 0"  # customers whose id is landed as text
FETCH_OF = "'customers_2001080' || CASE WHEN id % 3 = 0 THEN '2' ELSE '1' END || '_000000'"
QUERIES |= {
    "landed_records": _union([
        f"SELECT 'customer' AS kind, id, concat_ws('|', first, last, email, city) AS detail FROM people WHERE NOT ({WRONG})",
        f"SELECT 'quarantined', id, username FROM people WHERE {WRONG}",
        "SELECT 'product', product_id, concat_ws('|', title, brand, stock) FROM goods",
        f"SELECT 'line', order_id, concat_ws('|', product_id, title, quantity, CAST({units(NET)} // 10000 AS BIGINT)) FROM lineitem "
        "LEFT JOIN part ON p_partkey = l_partkey JOIN twice ON n = 1 OR l_orderkey % 64 = 0, "
        "LATERAL (SELECT l_orderkey AS order_id, l_partkey AS product_id, p_name AS title, CAST(l_quantity AS BIGINT) AS quantity)"]),
    "landed_completeness": _union([
        f"SELECT 'customers' AS entity, {FETCH_OF} AS batch, count(*) FILTER (NOT ({WRONG})) AS landed, "
        f"CAST(max(CASE WHEN id % 3 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS reported_total, "
        f"count(*) FILTER (NOT ({WRONG})) >= max(CASE WHEN id % 3 = 0 THEN 2 ELSE 1 END) AS complete, "
        f"count(*) FILTER ({WRONG}) AS quarantined FROM people GROUP BY 2",
        "SELECT 'products', 'products_20010801_000000', count(*), count(*), true, CAST(0 AS BIGINT) FROM goods"]),
}

ORACLE_SQL: dict[str, str] = {name: BASE + body for name, body in QUERIES.items()}
