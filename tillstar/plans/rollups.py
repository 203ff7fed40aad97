"""Sales pre-aggregated to the grain a result needs.

A rollup is a smaller fact: it keeps the fact's column names and carries the exact sum
of ``item_total``. Every result gives the same values on the fact and on a rollup.

``rollup_fact`` reads an existing fact table. The functions below it go straight from
the four tables and aggregate before they join: items are collapsed to one row per
order, or per product, before the wide side of a join is touched. A hot order, product
or customer is therefore combined inside each task and never shuffled row by row, and
names and countries are joined to totals instead of to items. Joins that matter only
because they drop unmatched keys and repeat duplicate ones read just the key column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillstar.operators.aggregates import totals
from tillstar.operators.cleaning import (
    clean_items,
    qualify_orders,
    standardize_customers,
    standardize_products,
)
from tillstar.operators.joins import join_customers, join_orders_items, join_products
from tillstar.schemas import Tables

# Key expressions of each grain, over fact columns.
GRAINS = {
    "day": {"order_date": "to_date(order_date)"},
    "order": {"order_id": "order_id"},
    "customer": {
        "customer_id": "customer_id",
        "first_name": "first_name",
        "last_name": "last_name",
        "country": "country",
    },
    "product": {
        "category": "category",
        "product_id": "product_id",
        "product_name": "product_name",
    },
}


def rollup_fact(fact: DataFrame, grain: str, spread: bool = False) -> DataFrame:
    """Aggregate a fact table (or a finer rollup) to one of the grains; ``spread`` as for
    ``totals``, for the grain "order" of a fact that is not stored."""
    return totals(fact, GRAINS[grain], spread=spread)


def items_per_order(tables: Tables) -> DataFrame:
    """(order_id, item_total): all valid items with a known product, summed by order."""
    items = clean_items(tables.order_items).select("order_id", "product_id", "item_total")
    known = join_products(items, tables.products.select("product_id"))
    return totals(known, {"order_id": "order_id"})


def order_sales(tables: Tables, check_customers: bool = True, **options) -> DataFrame:
    """(order_id, customer_id, order_date, item_total) of the qualifying orders.

    The aggregate is already partitioned by order_id, so the join shuffles only the
    orders; these stand left, as items have one row per order here.
    ``check_customers=False`` leaves customers to the caller.
    """
    orders = qualify_orders(tables.orders, **options).select(
        "order_id", "customer_id", "order_date"
    )
    if check_customers:
        orders = join_customers(orders, tables.customers.select("customer_id"))
    return orders.join(items_per_order(tables), "order_id", "inner")


def customer_sales(tables: Tables, **options) -> DataFrame:
    """(customer_id, first_name, last_name, country, item_total). Summed by customer_id
    before the attributes are joined, so a customer with very many orders stays one row
    per task."""
    by_id = totals(
        order_sales(tables, check_customers=False, **options), {"customer_id": "customer_id"}
    )
    customers = standardize_customers(tables.customers).select(
        "customer_id", "first_name", "last_name", "country"
    )
    return customers.join(by_id, "customer_id", "inner")


def product_sales(tables: Tables, **options) -> DataFrame:
    """(product_id, product_name, category, item_total). Summed by product_id before
    names and categories are joined."""
    orders = join_customers(
        qualify_orders(tables.orders, **options).select("order_id", "customer_id"),
        tables.customers.select("customer_id"),
    ).select("order_id")
    items = clean_items(tables.order_items).select("order_id", "product_id", "item_total")
    by_id = totals(join_orders_items(orders, items), {"product_id": "product_id"})
    products = standardize_products(tables.products).select(
        "product_id", "product_name", "category"
    )
    return products.join(by_id, "product_id", "inner")


# The smaller fact that serves each grain when there is no stored fact table. Sales per
# order serve the calendar results: they carry the date and need no further step.
FROM_TABLES = {
    "day": order_sales,
    "order": order_sales,
    "customer": customer_sales,
    "product": product_sales,
}
