"""Table profiles and the cleaning audit, as result tables instead of printed text."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.functions import amount
from tillstar.operators.cleaning import CANCELLED, type_items
from tillstar.operators.joins import join_customers
from tillstar.schemas import FACT_NAME, Tables


def _stack(one_row: DataFrame, rows: list[str], columns: str) -> DataFrame:
    return one_row.selectExpr(f"stack({len(rows)}, {', '.join(rows)}) as ({columns})")


PROFILE = "table_name string, position int, column_name string, data_type string, nullable boolean"


def profile_schema(tables: Tables) -> DataFrame:
    """(table_name, position, column_name, data_type, nullable) of every column, from the
    schemas alone: no table is read."""
    columns = [
        (name, i, f.name, f.dataType.simpleString(), f.nullable)
        for name, df in tables._asdict().items()
        for i, f in enumerate(df.schema.fields)
    ]
    return tables.orders.sparkSession.createDataFrame(columns, PROFILE)


def profile_columns(tables: Tables) -> DataFrame:
    """The schema profile with the number of non-null rows of each column, in one scan of
    each table."""

    def counts(name: str, df: DataFrame) -> DataFrame:
        one_row = df.agg(*[F.count(F.col(c)).alias(f"n{i}") for i, c in enumerate(df.columns)])
        rows = [f"'{name}', {i}, n{i}" for i in range(len(df.columns))]
        return _stack(one_row, rows, "table_name, position, non_null_rows")

    counted = reduce(DataFrame.unionByName, [counts(n, df) for n, df in tables._asdict().items()])
    return profile_schema(tables).join(counted, ["table_name", "position"])


def profile_row_counts(tables: Tables) -> DataFrame:
    """(table_name, row_count) of the four tables and of the fact table they make."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables._asdict().items()
        if name != "order_items"
    ]
    both = _stack(
        step_counts(tables),
        ["'order_items', items", f"'{FACT_NAME}', positive"],
        "table_name, row_count",
    )
    return reduce(DataFrame.unionByName, [*counts, both])


def sample(df: DataFrame, n: int = 5) -> DataFrame:
    """The first n rows of a frame."""
    return df.limit(n)


def sample_by_hash(df: DataFrame, keys: Sequence[str], n: int = 5, seed: str = "") -> DataFrame:
    """The n rows with the smallest hash of their key, in that order: a random sample that
    is the same on every run, for every partitioning, and of a table's parts put together.

    Every task keeps its n smallest. Null keys count as the text ``null``; of repeated keys
    the rows that are smaller in the frame's columns come first.
    """
    text = F.concat_ws("|", F.lit(seed), *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys])
    return df.orderBy(F.md5(text), *df.columns).limit(n)


def step_counts(tables: Tables) -> DataFrame:
    """One row: how many rows there are after each step, in one scan of the items.

    ``items``, ``known`` (with quantity and price) and ``amounts`` (whose total is an
    amount of money) count order items; ``joined``, ``not_cancelled`` and ``positive``
    rows of the joined table, which is not built: three columns of each item meet the
    counts of its order. A repeated product, order or customer multiplies as it does in
    the joins. Products and orders are counted by structs, of which the joins know
    nothing: sums by the key itself would stand in the way of splitting a hot one. Items
    are not summed by order before: a scanning task meets about as many orders as items,
    and would hold them all.
    """
    quantity, price = F.col("quantity"), F.col("price_per_unit")
    known = quantity.isNotNull() & price.isNotNull()
    products = tables.products.groupBy(F.struct("product_id").alias("__key"))
    products = products.agg(F.count(F.lit(1)).alias("copies")).select("__key.product_id", "copies")
    items = type_items(tables.order_items).join(products, "product_id", "left").select(
        "order_id",
        known.alias("known"),
        amount(quantity, price).isNotNull().alias("amounts"),
        F.when(known, F.col("copies")).alias("rows"),
    )
    orders = join_customers(
        tables.orders.select("order_id", "customer_id", "status", "total_amount"),
        tables.customers.select("customer_id"),
    )
    not_cancelled = F.col("status") != CANCELLED
    orders = orders.groupBy(F.struct("order_id").alias("__key")).agg(
        F.count(F.lit(1)).alias("joined"),
        F.count_if(not_cancelled).alias("not_cancelled"),
        F.count_if(not_cancelled & (F.col("total_amount") > 0)).alias("positive"),
    )
    both = items.join(orders.select("__key.order_id", "joined", "not_cancelled", "positive"), "order_id", "left")

    def total(column):
        return F.coalesce(F.sum(F.col(column) * F.col("rows")), F.lit(0)).alias(column)

    return both.agg(
        F.count(F.lit(1)).alias("items"),
        F.count_if("known").alias("known"),
        F.count_if("amounts").alias("amounts"),
        *[total(c) for c in ("joined", "not_cancelled", "positive")],
    )


# Each cleaning step with the counts before and after it.
STEPS = [
    ("null_items", "items", "known"),
    ("not_an_amount", "known", "amounts"),
    ("cancelled_orders", "joined", "not_cancelled"),
    ("non_positive_totals", "not_cancelled", "positive"),
]


def cleaning_audit(tables: Tables) -> DataFrame:
    """(step, rows_in, rows_out, dropped) of the cleaning filters.

    Null items are counted among the order items, and so are items whose total is no
    amount of money, which are not dropped but stop the job; the other two steps count
    rows of the joined table, where a missing status or total counts as dropped.
    """
    return _stack(
        step_counts(tables),
        [f"'{name}', {a}, {b}, {a} - {b}" for name, a, b in STEPS],
        "step, rows_in, rows_out, dropped",
    )
