"""Typing, filtering and standardising of the four tables.

Each step works on one input table, before any join: filters reach the scans, and
text is standardised once per dimension row rather than once per order item.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tillstar.functions import day_of_week, item_total, parse_order_date, standardize

# Fixed value: the status that takes an order out of all sales.
CANCELLED = "cancelled"


# --- order items -----------------------------------------------------------


def type_items(items: DataFrame) -> DataFrame:
    """quantity as int and price_per_unit as double; null where that fails."""
    return items.withColumns(
        {
            "quantity": F.expr("try_cast(quantity as int)"),
            "price_per_unit": F.expr("try_cast(price_per_unit as double)"),
        }
    )


def drop_null_items(items: DataFrame) -> DataFrame:
    """Drop items without quantity or price. Written as filters, which a columnar
    scan can use to skip data."""
    return items.filter("quantity is not null and price_per_unit is not null")


def add_item_total(items: DataFrame) -> DataFrame:
    """An item whose total is no amount stops the job; the error gives quantity, price,
    order and product, as far as the items have them."""
    where = [F.col(c) for c in ("order_id", "product_id") if c in items.columns]
    total = item_total(F.col("quantity"), F.col("price_per_unit"), *where)
    return items.withColumn("item_total", total)


def clean_items(items: DataFrame) -> DataFrame:
    return add_item_total(drop_null_items(type_items(items)))


# --- orders ----------------------------------------------------------------


def parse_orders(orders: DataFrame) -> DataFrame:
    """Parse order_date when it is text; orders with a bad date stay, with null."""
    if isinstance(orders.schema["order_date"].dataType, StringType):
        return orders.withColumn("order_date", parse_order_date(F.col("order_date")))
    return orders


def add_calendar(orders: DataFrame) -> DataFrame:
    date = F.col("order_date")
    return orders.withColumns(
        {
            "order_year": F.year(date),
            "order_month": F.month(date),
            "order_day_of_week": day_of_week(date),
        }
    )


def drop_cancelled(orders: DataFrame) -> DataFrame:
    """Keep orders whose stored status is known and not exactly ``cancelled``."""
    return orders.filter(F.col("status") != CANCELLED)


def keep_positive_totals(orders: DataFrame) -> DataFrame:
    """Keep orders with a known total above zero."""
    return orders.filter(F.col("total_amount") > 0)


def fill_missing_totals(orders: DataFrame) -> DataFrame:
    """Alternative to dropping orders without a total: treat it as zero."""
    return orders.na.fill(0.0, ["total_amount"])


def qualify_orders(
    orders: DataFrame, normalize_status_first: bool = False, null_totals: str = "keep"
) -> DataFrame:
    """The orders that count as sales, with parsed date and standard status.

    By default the status is compared as stored and standardised afterwards, so
    `` Cancelled `` still counts as a sale; ``normalize_status_first`` swaps the two.
    ``null_totals="zero"`` fills missing totals before the total is tested.
    """
    if null_totals not in ("keep", "zero"):
        raise ValueError(f"null_totals must be 'keep' or 'zero', not {null_totals!r}")
    if null_totals == "zero":
        orders = fill_missing_totals(orders)
    if normalize_status_first:
        orders = standardize(orders, "status")
    orders = keep_positive_totals(drop_cancelled(parse_orders(orders)))
    return orders if normalize_status_first else standardize(orders, "status")


# --- dimensions ------------------------------------------------------------


def standardize_products(products: DataFrame) -> DataFrame:
    return standardize(products, "product_name", "category", "brand")


def standardize_customers(customers: DataFrame) -> DataFrame:
    return standardize(customers, "country")
