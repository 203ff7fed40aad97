"""Results at a grain that grows with the sales, over ranges of their order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.functions import as_double, percent_change
from tillstar.operators.aggregates import totals
from tillstar.operators.ranges import lag_in_order, running_sum
from tillstar.plans.rollups import order_sales


def running_total_by_order(sales: DataFrame) -> DataFrame:
    """(order_id, order_date, order_total, running_total) in order of date and id.

    ``sales``: order_id, order_date and item_total, a fact table or a rollup of it. The
    same running total as per day, at the finest grain: no task holds all orders.
    """
    keys = {"order_id": "order_id", "order_date": "order_date"}
    by_order = totals(sales, keys, "order_total")
    order = [("order_date", "asc"), ("order_id", "asc")]
    return as_double(running_sum(by_order, order, "order_total", "running_total"), "order_total", "running_total")


def daily_category_change(fact: DataFrame) -> DataFrame:
    """(category, sale_date, daily_sales, prev_sales, change_percent): sales per category
    and day beside those of the category's previous day that has any."""
    keys = {"category": "category", "sale_date": "to_date(order_date)"}
    daily = as_double(totals(fact, keys, "daily_sales"), "daily_sales")
    out = lag_in_order(daily, [("sale_date", "asc")], "daily_sales", "prev_sales", by=["category"])
    change = percent_change(F.col("daily_sales"), F.col("prev_sales"))
    return out.withColumn("change_percent", change)


def running_total_from_tables(tables) -> DataFrame:
    """The running total by order straight from the four tables."""
    return running_total_by_order(order_sales(tables))
