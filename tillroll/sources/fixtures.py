"""Adapter from the driver's TPC-H-like parquet tables to bronze records.

Bronze holds one row per landed record (the JSON envelope array is exploded
on load, see :mod:`tillroll.sources.envelopes`), plus the envelope metadata
``_source`` (landed file) and ``_total`` (records the fetch reports).
The adapter produces exactly that shape from whole tables, so every model
downstream runs unchanged on real landed data and on the test tables.

No row is dropped, and the edges of real landings are derived by rules of the
ids: records landed again unchanged or changed in a second, incomplete fetch,
missing name parts and mails, orders of unknown or missing customers, and
customers without orders.

Nothing here nests all records of a key into an array: a hot order would become
one huge row.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import MONEY_SCALE, money_units, units_to_double
from ..schemas import TEST_TABLES

PAGE_SIZE = 100  # records per landed page


class Bronze:
    """The four bronze frames, each built on first use (building a frame
    resolves its plan, which is not free; most queries need one or two)."""

    def __init__(self, spark: SparkSession | None = None, sf_dir: str | None = None):
        self.spark, self.sf_dir = spark, sf_dir

    @classmethod
    def from_frames(cls, customers: DataFrame, products: DataFrame, carts: DataFrame, lines: DataFrame) -> "Bronze":
        """Bronze read from storage (the loader's output) instead of the adapter."""
        b = cls()
        b.__dict__.update(customers=customers, products=products, carts=carts, lines=lines)
        return b

    @cached_property
    def customers(self) -> DataFrame:  # _source, _total, user
        return customers(self.spark, self.sf_dir)

    @cached_property
    def products(self) -> DataFrame:  # _source, _total, product
        return products(self.spark, self.sf_dir)

    @cached_property
    def carts(self) -> DataFrame:  # _source, _total, cart (header fields, no products array)
        return carts(self.spark, self.sf_dir)

    @cached_property
    def lines(self) -> DataFrame:  # cart_id, line
        return lines(self.spark, self.sf_dir)

    @cached_property
    def quantities(self) -> DataFrame:  # cart_id, line (id and quantity only)
        """The lines as far as units per product id need them: no titles are looked up."""
        if self.spark is None:
            return self.lines
        return lines(self.spark, self.sf_dir, titles=False)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table with its declared columns (no schema inference)."""
    return spark.read.schema(TEST_TABLES[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _page_source(entity: str, key: str) -> F.Column:
    """File of a landed page; ``_fetch`` 1 or 2 is the landing it belongs to."""
    return F.expr(f"concat('{entity}/2001/08/0', _fetch + 1, '/{entity}_2001080', _fetch + 1, '_000000/page-', "
                  f"cast({key} div {PAGE_SIZE} AS string))")


def _landed(df: DataFrame, again: str) -> DataFrame:
    """Every row once, as fetch 1, and those where ``again`` holds also as fetch 2."""
    return df.withColumn("_fetch", F.expr(f"explode(CASE WHEN {again} THEN array(1, 2) ELSE array(1) END)"))


def _entity_total(df: DataFrame) -> F.Column:
    # Uncorrelated scalar subquery: Spark runs it once and inlines the value,
    # no join with the big side.
    return df.select(F.count(F.lit(1))).scalar()


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = _landed(c.join(n, c.c_nationkey == n.n_nationkey, "left"),
                f"c_custkey div {PAGE_SIZE} % 4 = 0 OR c_custkey % 40 = 5")
    # One SQL expression per record: a single call to build, where a chain
    # of column objects costs one round trip each.
    user = F.expr(
        "named_struct('id', c_custkey, 'firstName', split_part(c_name, '#', 1), "
        "'lastName', CASE WHEN c_custkey % 30 <> 9 THEN split_part(c_name, '#', 2) END, "
        "'email', CASE WHEN c_custkey % 35 <> 4 THEN concat('c', cast(c_custkey AS string), '@example.com') END, "
        "'phone', CASE WHEN _fetch = 2 AND c_custkey % 40 = 5 THEN '555' END, "
        "'username', concat('c', cast(c_custkey AS string)), "
        "'gender', lower(c_mktsegment), 'address', named_struct('city', n_name))")
    return j.select(_page_source("customers", "c_custkey").alias("_source"),
                    _entity_total(c).alias("_total"), user.alias("user"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    product = F.expr(
        "named_struct('id', p_partkey, 'title', p_name, 'description', concat(p_type, ' ', p_brand), "
        "'category', p_type, 'price', p_retailprice, 'discountPercentage', cast(p_size AS double) / 2.0D, "
        "'rating', cast(p_size AS double) / 10.0D, "
        "'stock', cast(p_size - 1 + CASE WHEN _fetch = 2 AND p_partkey % 50 = 0 THEN 1 ELSE 0 END AS bigint), "
        "'brand', p_brand, 'sku', concat('SKU-', cast(p_partkey AS string)))")
    landed = _landed(p, f"p_partkey div {PAGE_SIZE} % 5 = 0 OR p_partkey % 50 = 0")
    return landed.select(_page_source("products", "p_partkey").alias("_source"),
                         _entity_total(p).alias("_total"), product.alias("product"))


def _line_discounted(li: DataFrame) -> F.Column:
    """Discounted line amount in 1/10000 units (exact bigint)."""
    return money_units(li.l_extendedprice * (F.lit(1.0) - li.l_discount))


def carts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = read_table(spark, sf_dir, "lineitem")
    # Partial aggregation runs map-side, so even an order holding a third of
    # all lines shuffles one row per map task.
    # Amounts are summed as bigint units: exact, and per-order totals are far
    # below the bigint range.
    agg = li.groupBy(F.col("l_orderkey")).agg(
        F.sum(money_units("l_extendedprice")).alias("gross"),
        F.sum(_line_discounted(li)).alias("net"),
        F.count(F.col("l_orderkey")).alias("n_lines"),
        F.sum(F.col("l_quantity")).alias("qty"),
    )
    j = _landed(o.join(agg, o.o_orderkey == agg.l_orderkey, "left"), "o_orderkey % 64 = 0")
    # gross/net are sums of 1/10000 units; back to the nearest double here.
    cart = F.expr(
        "named_struct('id', o_orderkey, "
        "'userId', CASE WHEN o_orderkey % 97 = 0 THEN -1 - o_custkey WHEN o_orderkey % 101 = 0 THEN NULL "
        "WHEN o_custkey % 10 = 3 THEN o_custkey - 1 ELSE o_custkey END, "
        "'total', cast(coalesce(gross, 0L) AS double) / {s}D, "
        "'discountedTotal', cast(coalesce(net, 0L) AS double) / {s}D, "
        "'totalProducts', coalesce(n_lines, 0L), 'totalQuantity', cast(coalesce(qty, 0.0D) AS bigint), "
        "'orderDate', cast(o_orderdate AS date))".format(s=float(MONEY_SCALE)))
    src = F.expr("concat('orders/', date_format(o_orderdate, 'yyyy/MM/dd'), '/orders_', "
                 "date_format(o_orderdate, 'yyyyMMdd'), CASE _fetch WHEN 1 THEN '_000000' ELSE '_120000' END, '.json')")
    return j.select(src.alias("_source"), F.lit(None).cast("bigint").alias("_total"), cart.alias("cart"))


def lines(spark: SparkSession, sf_dir: str, titles: bool = True) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity",
                                                     "l_extendedprice", "l_discount")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name")
    # Plain rows on both sides: a hot part is split by AQE.
    j = _landed(li.join(p, li.l_partkey == p.p_partkey, "left") if titles else li, "l_orderkey % 64 = 0")
    line = F.struct(
        F.col("l_partkey").alias("id"),
        *([F.col("p_name").alias("title")] if titles else []),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        *([units_to_double(_line_discounted(li)).alias("discountedTotal")] if titles else []),
    )
    return j.select(F.col("l_orderkey").alias("cart_id"), line.alias("line"))


def line_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order lines as landed JSON: envelopes of one cart with one line, in
    the shape of :func:`envelopes.landed_values`.  No lines are brought together,
    so a hot order makes no large value.  Parsing costs far more than reading, so
    rows are dealt out evenly before (AQE picks the number of partitions)."""
    cart = F.struct(F.col("cart_id").alias("id"), F.array("line").alias("products"))
    envelope = F.struct(F.array(cart).alias("carts"))
    return lines(spark, sf_dir).hint("rebalance").select(F.lit("orders/lines.json").alias("_source"),
                                       F.lit(None).cast("timestamp").alias("_landed"), F.to_json(envelope).alias("text"))


def land_files(spark: SparkSession, sf_dir: str, root: str, fetch: int) -> None:
    """Land the tables as JSON files: customers as a value a line, in two fetches,
    products as pretty-printed files, carts as a value a line in the second fetch.

    Ids of some customers are text, which no loader may take for a number."""
    from .envelopes import land, page_of

    at = f"2001-08-0{fetch}T00:00:00"
    people = customers(spark, sf_dir).where((F.col("user.id") % 3 == 0) == (fetch == 2)).select("user.*")
    wrong = F.expr("CASE WHEN id % 37 = 0 THEN CAST(concat('x', id) AS VARIANT) ELSE CAST(id AS VARIANT) END")
    land(people.withColumn("id", wrong), root, "customers", at, PAGE_SIZE, fetch)
    if fetch == 1:
        land(products(spark, sf_dir).select("product.*"), root, "products", at, 50 * PAGE_SIZE, pretty=True)
    else:
        paged = lines(spark, sf_dir).withColumn("_page", page_of(PAGE_SIZE // 2))
        baskets = paged.groupBy("cart_id", "_page").agg(F.collect_list("line").alias("products"))
        land(baskets.select(F.col("cart_id").alias("id"), "products"), root, "orders", at, PAGE_SIZE)


def bronze(spark: SparkSession, sf_dir: str) -> Bronze:
    return Bronze(spark, sf_dir)
