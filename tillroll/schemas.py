"""Declared schemas of the landed JSON envelopes and of the bronze records.

Schemas are declared, never inferred per run (inference reads the data twice
and lets types drift from file to file).
"""

from __future__ import annotations

from pyspark.sql import types as T

L, S, D = T.LongType(), T.StringType(), T.DoubleType()


def _st(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


USER = _st(
    ("id", L), ("firstName", S), ("lastName", S), ("email", S), ("phone", S),
    ("username", S), ("gender", S), ("address", _st(("city", S))),
)

PRODUCT = _st(
    ("id", L), ("title", S), ("description", S), ("category", S), ("price", D),
    ("discountPercentage", D), ("rating", D), ("stock", L), ("brand", S), ("sku", S),
)

CART_LINE = _st(("id", L), ("title", S), ("quantity", L), ("discountedTotal", D))

# ``orderDate`` is not in the original payload (it stamps the build date,
# quirk Q2); when a source carries it, staging uses it.
CART = _st(
    ("id", L), ("userId", L), ("total", D), ("discountedTotal", D),
    ("totalProducts", L), ("totalQuantity", L), ("orderDate", T.DateType()),
    ("products", T.ArrayType(CART_LINE)),
)


# Entity -> (envelope key, record schema, singular column name in bronze).
# Fixed values of the source API: entity names and their JSON array keys.
ENTITIES = {
    "customers": ("users", USER, "user"),
    "products": ("products", PRODUCT, "product"),
    "orders": ("carts", CART, "cart"),
}

def table_name(entity: str) -> str:
    """Raw table of an entity."""
    return f"stg_{entity}"


# Columns of the driver's test tables that the adapter reads, declared so a
# read lists the file but never infers its schema.  Parquet matches columns
# by name, so a declared subset reads only these columns.
_I, _TS = T.IntegerType(), T.TimestampNTZType()
TEST_TABLES = {
    "customer": _st(("c_custkey", L), ("c_name", S), ("c_nationkey", _I), ("c_mktsegment", S)),
    "nation": _st(("n_nationkey", _I), ("n_name", S)),
    "part": _st(("p_partkey", L), ("p_name", S), ("p_brand", S), ("p_type", S), ("p_size", _I),
                ("p_retailprice", D)),
    "orders": _st(("o_orderkey", L), ("o_custkey", L), ("o_orderdate", _TS)),
    "lineitem": _st(("l_orderkey", L), ("l_partkey", L), ("l_linenumber", _I), ("l_quantity", D), ("l_extendedprice", D),
                    ("l_discount", D)),
}
