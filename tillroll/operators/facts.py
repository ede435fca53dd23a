"""Order fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import surrogate_key


def dimension_rows(dim_customer: DataFrame, by: str = "customer_id") -> DataFrame:
    """How many dimension rows carry each customer id or key (more than one
    only when a changed record survived staging, quirk Q4)."""
    return dim_customer.groupBy(by).agg(F.count(F.lit(1)).alias("_dims"))


def fact_orders(stg_orders: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Orders with the customer key looked up on the natural id (left join:
    orphan orders keep a NULL key; an id with k dimension rows gives k rows).

    Both sides meet as plain rows right after their shuffle, the shape in
    which AQE splits a customer that holds a large share of all orders.  No
    broadcast hint: the customer dimension grows with the data.
    """
    so = stg_orders.alias("so")
    dc = dim_customer.select("customer_id", "customer_key").alias("dc")
    j = so.join(dc, F.col("so.customer_id") == F.col("dc.customer_id"), "left")
    return j.select(
        surrogate_key(F.col("so.order_id")).alias("order_key"),
        F.col("so.order_id").alias("order_id"),
        F.col("dc.customer_key").alias("customer_key"),
        F.col("so.customer_id").alias("customer_id"),
        F.col("so.total").alias("total"),
        F.col("so.discountedTotal").alias("discounted_total"),
        (F.col("so.total") - F.col("so.discountedTotal")).alias("discount_amount"),
        F.col("so.totalProducts").alias("total_products"),
        F.col("so.totalQuantity").alias("total_quantity"),
        F.col("so.order_date").alias("order_date"),
    )


def fact_sales(fact: DataFrame) -> DataFrame:
    """Input of the revenue report: one sale per order."""
    return fact.select(
        F.col("order_date").cast("timestamp_ntz").alias("order_timestamp"),
        F.col("total").alias("total_amount"),
    )
