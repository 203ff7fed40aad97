"""The inner equi-joins of the star.

No hints: Spark broadcasts a side only when its measured size is below
``spark.sql.autoBroadcastJoinThreshold`` (statically, or at run time through
adaptive execution) and sort-merges otherwise. Both inputs of each join are plain
shuffles, so adaptive execution can split a hot key on either side.

The side with many rows per key stands left: a sort-merge join streams it and buffers
only the matching rows of the right side.

Rows with null or unmatched keys drop out, and a repeated dimension key repeats its
rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def join_orders_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    return items.join(orders, "order_id", "inner")


def join_products(items: DataFrame, products: DataFrame) -> DataFrame:
    return items.join(products, "product_id", "inner")


def join_customers(orders: DataFrame, customers: DataFrame) -> DataFrame:
    return orders.join(customers, "customer_id", "inner")
