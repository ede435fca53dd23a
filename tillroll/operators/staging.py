"""Staging models: one row per distinct record.

Inputs are bronze frames (records already exploded from their envelopes).
``SELECT DISTINCT`` is kept exactly: it removes records landed twice unchanged.
A record whose attributes changed survives twice (quirk Q4);
:func:`latest_per_key` is the opt-in fix.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_records(bronze: DataFrame, record: str) -> DataFrame:
    """Quirk Q4 option: keep one version of each record id, the one landed
    last.  Paths sort by landing day and by the time in the file's name; where
    one file holds several versions, the larger record stays."""
    order = F.struct(*[F.col(c) for c in ("_landed", "_source") if c in bronze.columns], F.col(record))
    keyed = bronze.select(F.col(f"{record}.id").alias("_id"), order.alias("_order"), record)
    return latest_per_key(keyed, ["_id"], "_order").drop("_id", "_order")


def stg_customers(customers: DataFrame, latest: bool = False) -> DataFrame:
    if latest:
        customers = latest_records(customers, "user")
    return customers.select(
        F.col("user.id").alias("customer_id"),
        # '||' semantics: NULL when any part is NULL.
        F.concat(F.col("user.firstName"), F.lit(" "), F.col("user.lastName")).alias("name"),
        F.col("user.email").alias("email"),
        F.col("user.phone").alias("phone"),
        F.col("user.username").alias("username"),
        F.col("user.gender").alias("gender"),
        F.col("user.address.city").alias("city"),
    ).distinct()


def stg_products(products: DataFrame, latest: bool = False) -> DataFrame:
    if latest:
        products = latest_records(products, "product")
    return products.select(
        F.col("product.id").alias("product_id"),
        F.col("product.title").alias("title"),
        F.col("product.description").alias("description"),
        F.col("product.category").alias("category"),
        F.col("product.price").alias("price"),
        F.col("product.discountPercentage").alias("discount_percentage"),
        F.col("product.rating").alias("rating"),
        F.col("product.stock").alias("stock"),
        F.col("product.brand").alias("brand"),
        F.col("product.sku").alias("sku"),
    ).distinct()


def as_of_col(as_of: str | _dt.date | Column | None) -> Column:
    """The build date; ``None`` means today (``current_date``)."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("date")


def stg_orders(carts: DataFrame, as_of=None, latest: bool = False) -> DataFrame:
    """``order_date`` is the cart's own date when the source has one, else the
    build date (the original stamps every order with ``current_date``)."""
    if latest:
        carts = latest_records(carts, "cart")
    has_date = "orderDate" in carts.select("cart.*").columns
    order_date = F.coalesce(F.col("cart.orderDate"), as_of_col(as_of)) if has_date else as_of_col(as_of)
    return carts.select(
        F.col("cart.id").alias("order_id"),
        F.col("cart.userId").alias("customer_id"),
        F.col("cart.total").alias("total"),
        F.col("cart.discountedTotal").alias("discountedTotal"),
        F.col("cart.totalProducts").alias("totalProducts"),
        F.col("cart.totalQuantity").alias("totalQuantity"),
        order_date.alias("order_date"),
    ).distinct()


def order_lines(lines: DataFrame) -> DataFrame:
    """Flat order lines (``carts[].products`` after both unnests, U2), with the fields that the lines carry."""
    # Fields of a line and their columns.
    names = {"id": "product_id", "title": "title", "quantity": "quantity", "discountedTotal": "discounted_total"}
    have = lines.schema["line"].dataType.names
    return lines.select(F.col("cart_id").alias("order_id"),
                        *[F.col(f"line.{f}").alias(c) for f, c in names.items() if f in have])


def latest_per_key(df: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """Keep the row with the greatest ``order_col`` per key.

    ``max_by`` is an ordinary aggregate, so it is combined map-side: a key
    holding a third of all rows is reduced in every map task before the
    shuffle instead of being sorted in one task (as ``row_number`` would).
    """
    others = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c) for c in others])
    out = df.groupBy(*keys).agg(F.max_by(packed, F.col(order_col)).alias("_latest"))
    return out.select(*keys, *[F.col(f"_latest.{c}").alias(c) for c in others]).select(*df.columns)
