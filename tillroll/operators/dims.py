"""Dimensions (P4, P5, P7): surrogate key plus business attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import surrogate_key

# Stock status labels.
IN_STOCK, LOW_STOCK, OUT_OF_STOCK = "In Stock", "Low Stock", "Out of Stock"


def stock_status(stock) -> F.Column:
    s = F.col(stock) if isinstance(stock, str) else stock
    # NULL stock falls through to 'Out of Stock'.
    return F.when(s > 10, IN_STOCK).when(s > 0, LOW_STOCK).otherwise(OUT_OF_STOCK)


def dim_customer(stg_customers: DataFrame) -> DataFrame:
    return stg_customers.select(
        surrogate_key("customer_id").alias("customer_key"),
        "customer_id", "name", "email", "city", "gender",
    )


def dim_product(stg_products: DataFrame) -> DataFrame:
    return stg_products.select(
        surrogate_key("product_id").alias("product_key"),
        "product_id", "title", "description", "category", "price", "discount_percentage",
        "rating", "stock", "brand", "sku",
        stock_status("stock").alias("stock_status"),
    )
