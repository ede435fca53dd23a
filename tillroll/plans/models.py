"""The model graph: which model is built from which, with tags and
materialization (S10, S16, K3, K4), and the declared data tests (2.10).

:class:`Warehouse` builds each model lazily from bronze frames; a model is a
plain function call, so the call graph is the DAG and Catalyst sees one plan.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..operators import dims, facts, marts, staging
from ..operators.quality import DataTest
from ..sources.fixtures import Bronze, bronze


@dataclass(frozen=True)
class ModelSpec:
    name: str
    tags: tuple[str, ...]
    materialized: str  # "table" | "view"
    folder: str
    alias: str | None = None  # catalog name when it differs from the model name


# Model names, tags, materializations and folders of the original project.
MODELS = [
    ModelSpec("stg_customers", ("staging",), "view", "staging", "raw_customers"),
    ModelSpec("stg_products", ("staging",), "view", "staging", "raw_products"),
    ModelSpec("stg_orders", ("staging",), "view", "staging", "raw_orders"),
    ModelSpec("dim_customer", ("dimension",), "table", "dim"),
    ModelSpec("dim_product", ("dimension",), "table", "dim"),
    ModelSpec("fact_orders", ("fact",), "table", "fact"),
    ModelSpec("analytics_customer_metrics", ("analytics",), "table", "analytics"),
    ModelSpec("analytics_revenue_daily", ("analytics",), "table", "analytics"),
    ModelSpec("revenue_metrics", ("analytics",), "table", "analytics"),
    ModelSpec("customer_churn", ("metrics",), "table", "analytics"),
    ModelSpec("mtd_revenue", ("metrics",), "table", "analytics"),
]


def analytics_models(word: str = "analytics") -> dict[str, str]:
    """Alias -> catalog name of the models whose folder or tags name ``word``."""
    return {m.name: (m.alias or m.name) for m in MODELS if word in m.folder or word in m.tags}


STATUSES = tuple(marts.STATUSES)

# The 35 declared data tests.
DATA_TESTS: list[DataTest] = [
    DataTest("stg_products", "product_id", "not_null"),
    DataTest("stg_products", "product_id", "unique"),
    DataTest("stg_orders", "order_id", "not_null"),
    DataTest("stg_orders", "order_id", "unique"),
    DataTest("stg_customers", "customer_id", "not_null"),
    DataTest("stg_customers", "customer_id", "unique"),
    DataTest("stg_customers", "email", "not_null"),
    DataTest("dim_product", "product_key", "not_null"),
    DataTest("dim_product", "product_key", "unique"),
    DataTest("dim_product", "product_id", "not_null"),
    DataTest("dim_product", "product_id", "unique"),
    DataTest("dim_product", "category", "not_null"),
    DataTest("dim_product", "price", "not_null"),
    DataTest("dim_customer", "customer_key", "not_null"),
    DataTest("dim_customer", "customer_key", "unique"),
    DataTest("dim_customer", "customer_id", "not_null"),
    DataTest("dim_customer", "customer_id", "unique"),
    DataTest("dim_customer", "email", "not_null"),
    DataTest("dim_customer", "email", "unique"),
    DataTest("fact_orders", "order_key", "not_null"),
    DataTest("fact_orders", "order_key", "unique"),
    DataTest("fact_orders", "order_id", "not_null"),
    DataTest("fact_orders", "order_id", "unique"),
    DataTest("fact_orders", "customer_key", "not_null"),
    DataTest("fact_orders", "customer_key", "relationships", to=("dim_customer", "customer_key")),
    DataTest("fact_orders", "total", "not_null"),
    DataTest("mtd_revenue", "month", "not_null"),
    DataTest("mtd_revenue", "total_orders", "not_null"),
    DataTest("mtd_revenue", "net_revenue", "not_null"),
    DataTest("customer_churn", "customer_key", "not_null"),
    DataTest("customer_churn", "customer_status", "accepted_values", values=STATUSES),
    DataTest("analytics_revenue_daily", "report_date", "not_null"),
    DataTest("analytics_revenue_daily", "daily_revenue", "not_null"),
    DataTest("analytics_customer_metrics", "customer_key", "not_null"),
    DataTest("analytics_customer_metrics", "customer_status", "accepted_values", values=STATUSES),
]


class Warehouse:
    """All models over one set of bronze frames, built lazily and once."""

    def __init__(self, bronze_frames: Bronze, as_of=None, latest: bool = False):
        """``latest`` keeps only the latest landed version of each record
        (quirk Q4 option); the default is the original ``SELECT DISTINCT``."""
        self.bronze = bronze_frames
        self.as_of = as_of
        self.latest = latest

    @classmethod
    def from_sf(cls, spark: SparkSession, sf_dir: str, as_of=None) -> "Warehouse":
        return cls(bronze(spark, sf_dir), as_of)

    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.bronze.customers, self.latest)

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stg_products(self.bronze.products, self.latest)

    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.stg_orders(self.bronze.carts, self.as_of, self.latest)

    @cached_property
    def order_lines(self) -> DataFrame:
        return staging.order_lines(self.bronze.lines)

    @cached_property
    def dim_customer(self) -> DataFrame:
        return dims.dim_customer(self.stg_customers)

    @cached_property
    def dim_product(self) -> DataFrame:
        return dims.dim_product(self.stg_products)

    @cached_property
    def fact_orders(self) -> DataFrame:
        return facts.fact_orders(self.stg_orders, self.dim_customer)

    @cached_property
    def customer_metrics(self) -> DataFrame:
        return marts.customer_metrics(self.stg_customers, self.dim_customer, self.stg_orders, self.as_of)

    @cached_property
    def customer_churn(self) -> DataFrame:
        return marts.customer_churn(self.stg_customers, self.dim_customer, self.stg_orders, self.as_of)

    @cached_property
    def mtd_revenue(self) -> DataFrame:
        return marts.mtd_revenue(self.fact_orders, self.as_of)

    @cached_property
    def revenue_daily(self) -> DataFrame:
        return marts.revenue_daily(self.fact_orders)

    @cached_property
    def revenue_metrics(self) -> DataFrame:
        return marts.revenue_metrics(self.fact_orders)

    @cached_property
    def fact_sales(self) -> DataFrame:
        return facts.fact_sales(self.fact_orders)

    @cached_property
    def fact_churn(self) -> DataFrame:
        return marts.fact_churn(self.customer_metrics)

    # Model name -> attribute holding it.
    ATTR = {"analytics_customer_metrics": "customer_metrics", "analytics_revenue_daily": "revenue_daily"}

    def override(self, name: str, df: DataFrame) -> None:
        """Use ``df`` (e.g. the materialized table) for model ``name`` from now on."""
        self.__dict__[self.ATTR.get(name, name)] = df

    def model(self, name: str) -> DataFrame:
        return {
            "stg_customers": lambda: self.stg_customers,
            "stg_products": lambda: self.stg_products,
            "stg_orders": lambda: self.stg_orders,
            "dim_customer": lambda: self.dim_customer,
            "dim_product": lambda: self.dim_product,
            "fact_orders": lambda: self.fact_orders,
            "analytics_customer_metrics": lambda: self.customer_metrics,
            "analytics_revenue_daily": lambda: self.revenue_daily,
            "revenue_metrics": lambda: self.revenue_metrics,
            "customer_churn": lambda: self.customer_churn,
            "mtd_revenue": lambda: self.mtd_revenue,
        }[name]()

    def models(self) -> dict[str, DataFrame]:
        return {m.name: self.model(m.name) for m in MODELS}
