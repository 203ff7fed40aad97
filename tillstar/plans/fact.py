"""The denormalised fact table, one row per order item."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillstar.operators.cleaning import (
    add_calendar,
    clean_items,
    qualify_orders,
    standardize_customers,
    standardize_products,
)
from tillstar.operators.joins import join_customers, join_orders_items, join_products
from tillstar.schemas import FACT_COLUMNS, Tables


def build_fact(
    tables: Tables, normalize_status_first: bool = False, null_totals: str = "keep"
) -> DataFrame:
    """Join the cleaned tables. Lazy, no action.

    Customers are joined to the orders, one row per order, and products to the items,
    while these are still narrow: only then do both sides meet by order_id. With the
    orders joined first, the shuffle by product_id would carry names, e-mail and country
    of every item (README has figures).
    Items of cancelled orders pass one shuffle more, so it loses where most are cancelled.
    """
    orders = add_calendar(qualify_orders(tables.orders, normalize_status_first, null_totals))
    orders = join_customers(orders, standardize_customers(tables.customers))
    items = join_products(clean_items(tables.order_items), standardize_products(tables.products))
    return join_orders_items(orders, items).select(*FACT_COLUMNS)
