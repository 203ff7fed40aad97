"""The fact table with its cleaning counts, taken in the pass that writes it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tillstar.functions import amount, standardize
from tillstar.operators.audit import STEPS
from tillstar.operators.cleaning import (
    CANCELLED,
    add_calendar,
    add_item_total,
    drop_null_items,
    fill_missing_totals,
    parse_orders,
    standardize_customers,
    standardize_products,
    type_items,
)
from tillstar.operators.joins import join_customers, join_orders_items, join_products
from tillstar.schemas import FACT_COLUMNS, FACT_NAME, Tables

AUDIT = "step string, rows_in long, rows_out long, dropped long"
COUNTS = "table_name string, row_count long"


def _rows() -> Column:
    return F.count(F.lit(1))


class CountedFact:
    """``fact`` equals ``build_fact``; once it has been written, ``audit`` and
    ``row_counts`` say what went into it, without another scan.

    Counts at the grain of ``cleaning_audit`` need the joined rows that the order filters
    drop, so these filters run after the joins here. Counts come from the tasks of the
    first job over the fact; a task that runs again after its shuffle output was lost may
    be counted again, so compare with ``cleaning_audit`` after a run that lost executors.
    """

    def __init__(
        self, tables: Tables, normalize_status_first: bool = False, null_totals: str = "keep"
    ):
        if null_totals not in ("keep", "zero"):
            raise ValueError(f"null_totals must be 'keep' or 'zero', not {null_totals!r}")
        self._spark = tables.orders.sparkSession
        self._seen = {
            name: Observation() for name in ("customers", "products", "orders", "items", "joined")
        }
        quantity, price = F.col("quantity"), F.col("price_per_unit")
        known = quantity.isNotNull() & price.isNotNull()
        items = type_items(tables.order_items).observe(
            self._seen["items"],
            _rows().alias("items"),
            F.count_if(known).alias("known"),
            F.count_if(amount(quantity, price).isNotNull()).alias("amounts"),
        )
        items = add_item_total(drop_null_items(items))
        products = self._counted(tables.products, "products")
        customers = self._counted(tables.customers, "customers")
        orders = self._counted(tables.orders, "orders")
        if null_totals == "zero":
            orders = fill_missing_totals(orders)
        if normalize_status_first:
            orders = standardize(orders, "status")
        status = F.coalesce(F.col("status") != CANCELLED, F.lit(False))
        total = F.coalesce(F.col("total_amount") > 0, F.lit(False))
        orders = parse_orders(orders).withColumns({"__sold": status, "__paid": status & total})
        if not normalize_status_first:
            orders = standardize(orders, "status")
        orders = join_customers(add_calendar(orders), standardize_customers(customers))
        items = join_products(items, standardize_products(products))
        joined = join_orders_items(orders, items).observe(
            self._seen["joined"],
            _rows().alias("joined"),
            F.count_if("__sold").alias("not_cancelled"),
            F.count_if("__paid").alias("positive"),
        )
        self.fact: DataFrame = joined.where("__paid").select(*FACT_COLUMNS)

    def _counted(self, table: DataFrame, name: str) -> DataFrame:
        return table.observe(self._seen[name], _rows().alias("rows"))

    def _count(self, name: str) -> dict[str, int]:
        return self._seen[name].get

    def audit(self) -> DataFrame:
        """(step, rows_in, rows_out, dropped), as ``cleaning_audit``; waits for the job."""
        n = self._count("items") | self._count("joined")
        rows = [(step, n[a], n[b], n[a] - n[b]) for step, a, b in STEPS]
        return self._spark.createDataFrame(rows, AUDIT)

    def row_counts(self) -> DataFrame:
        """(table_name, row_count), as ``profile_row_counts``; waits for the job."""
        rows = [(name, self._count(name)["rows"]) for name in ("customers", "products", "orders")]
        rows.append(("order_items", self._count("items")["items"]))
        rows.append((FACT_NAME, self._count("joined")["positive"]))
        return self._spark.createDataFrame(rows, COUNTS)
