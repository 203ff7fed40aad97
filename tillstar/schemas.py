"""Declared table contracts. Nothing in the engine infers a schema."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    DecimalType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

# Money is summed as an exact decimal, so that a total does not depend on the
# order in which tasks finish. Results are emitted as double.
MONEY = DecimalType(18, 2)


def _schema(**columns) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in columns.items()])


# Column names, their order and types are the input contract.
CUSTOMERS = _schema(
    customer_id=StringType(),
    first_name=StringType(),
    last_name=StringType(),
    email=StringType(),
    country=StringType(),
)
PRODUCTS = _schema(
    product_id=StringType(),
    product_name=StringType(),
    category=StringType(),
    brand=StringType(),
)
ORDERS = _schema(
    order_id=StringType(),
    customer_id=StringType(),
    order_date=StringType(),  # text on disk, parsed while cleaning
    total_amount=DoubleType(),
    status=StringType(),
)
ORDER_ITEMS = _schema(
    order_item_id=StringType(),
    order_id=StringType(),
    product_id=StringType(),
    quantity=IntegerType(),
    price_per_unit=DoubleType(),
)
TABLE_SCHEMAS = {
    "customers": CUSTOMERS,
    "products": PRODUCTS,
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
}

# CSV as written and read here: quotes are doubled, white space is kept.
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
# Text format of order_date, name and columns of the fact table.
ORDER_DATE_FORMAT = "yyyy-MM-dd HH:mm:ss"
FACT_NAME = "fact_table"
FACT_COLUMNS = [
    "customer_id",
    "product_id",
    "order_id",
    "order_date",
    "total_amount",
    "status",
    "order_year",
    "order_month",
    "order_day_of_week",
    "order_item_id",
    "quantity",
    "price_per_unit",
    "item_total",
    "product_name",
    "category",
    "brand",
    "first_name",
    "last_name",
    "email",
    "country",
]


class Tables(NamedTuple):
    """The four input tables, as lazy DataFrames."""

    customers: DataFrame
    products: DataFrame
    orders: DataFrame
    order_items: DataFrame


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select the contract columns of ``table`` in order; fail if one is absent.

    Types are left as stored (keys may be strings or integers); the cleaning
    operators cast what they need.
    """
    wanted = TABLE_SCHEMAS[table].fieldNames()
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise ValueError(f"table {table!r} lacks columns {missing}; it has {df.columns}")
    return df.select(*wanted)
