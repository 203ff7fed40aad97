"""Queries over the given tables, each with the SQL it must agree with.

``entry`` runs the flagship query, ``queries`` holds one callable per operator or
result, and ``oracle_sql`` the equivalent SQL over the same Parquet tables.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillstar import (
    METRICS,
    build_fact,
    load_tables,
    metric_from_tables,
    refresh_months,
    run_batch,
    run_metrics,
    star_tables,
)
from tillstar.functions import as_double, standardize
from tillstar.operators import audit, cleaning, joins
from tillstar.operators.aggregates import sort_columns, totals
from tillstar.operators.ranges import with_row_index
from tillstar.operators.rejects import all_rejected_cells
from tillstar.plans import daily_category_change, order_sales, running_total_from_tables
from tillstar.schemas import CSV_OPTIONS, ORDER_DATE_FORMAT, Tables
from tillstar.sinks import shared_path, write_bucketed_fact, write_fact, write_result
from tillstar.sources import load_raw_tables

try:
    from corpus_pipeline import ORACLE_SQL as _PIPELINE_SQL
    from corpus_pipeline import run as _pipeline
    from tillstar.llm import queries as _corpus
except ModuleNotFoundError:  # the sales queries work without that subpackage or its libraries
    _corpus = None

ENTRY_DIR = "/root/testdata/sf0.001"
FLAGSHIP = "ranked_products_in_category"
# Deeper than Spark cuts a ranking before it shuffles.
DEEP = 5000


def entry(spark: SparkSession) -> DataFrame:
    """The best products of each category."""
    return metric_from_tables(star_tables(spark, ENTRY_DIR), FLAGSHIP)


# --- queries ---------------------------------------------------------------


def _on_tables(build: Callable[[Tables], DataFrame]):
    return lambda spark, sf_dir: build(star_tables(spark, sf_dir))


def _priced(build: Callable[[Tables], DataFrame]):
    """Emit the exact line totals as double, as the results do."""
    return lambda t: as_double(build(t), "item_total")


def _plain_dates(orders: DataFrame) -> DataFrame:
    return orders.withColumn("order_date", F.col("order_date").cast("timestamp_ntz"))


def _orders_parsed(t: Tables) -> DataFrame:
    # The stored dates are timestamps: write them as text, then parse that text.
    as_text = t.orders.withColumn("order_date", F.date_format("order_date", ORDER_DATE_FORMAT))
    parsed = cleaning.parse_orders(as_text)
    return parsed.withColumn("order_date", F.col("order_date").cast("timestamp_ntz"))


def _standardized_text(t: Tables) -> DataFrame:
    """Every standardised text column in one long table, by owning row."""
    products = cleaning.standardize_products(t.products)
    customers = cleaning.standardize_customers(t.customers)
    orders = standardize(t.orders, "status")

    def long(df: DataFrame, key: str, column: str) -> DataFrame:
        return df.select(F.lit(column).alias("field"), F.col(key).alias("id"), F.col(column).alias("value"))

    return reduce(
        DataFrame.unionByName,
        [
            long(products, "product_id", "product_name"),
            long(products, "product_id", "category"),
            long(products, "product_id", "brand"),
            long(customers, "customer_id", "country"),
            long(orders, "order_id", "status"),
        ],
    )


def dirty(t: Tables) -> Tables:
    """The given tables as untidy text, spoiled by key: every cleaning rule has rows to
    work on. The SQL below spoils the same rows."""

    def text(column):
        return F.col(column).cast("string")

    order, product = F.col("order_id"), F.col("product_id")
    items = t.order_items.withColumns(
        {
            "quantity": F.when(order % 11 == 0, None).when(order % 13 == 0, F.lit("many"))
            .otherwise(text("quantity")),
            "price_per_unit": F.when(product % 17 == 0, None).when(product % 19 == 0, F.lit("n/a"))
            .otherwise(text("price_per_unit")),
        }
    )
    total = F.col("total_amount")
    orders = t.orders.withColumns(
        {
            "order_date": F.when(order % 9 == 0, F.lit("31.12.2020")).otherwise(
                F.date_format("order_date", ORDER_DATE_FORMAT)
            ),
            "total_amount": F.when(order % 7 == 0, None).when(order % 7 == 1, F.lit(0.0))
            .when(order % 7 == 2, -total).otherwise(total),
            "status": F.when(order % 10 == 3, None).when(order % 10 == 4, F.lit(" Cancelled "))
            .when(order % 10 == 5, F.lit("cancelled")).otherwise(F.col("status")),
        }
    )
    customer = F.col("customer_id")
    customers = t.customers.withColumns(
        {
            "first_name": F.when(customer % 5 == 0, F.concat(F.lit('  "'), "first_name", F.lit('", x\t')))
            .otherwise(F.col("first_name")),
            "country": F.when(customer % 3 == 0, F.concat(F.lit("  "), "country", F.lit(" ")))
            .when(customer % 3 == 1, F.concat(F.lit("\t"), "country")).otherwise(F.col("country")),
        }
    )
    padded = {c: F.concat(F.lit(" "), F.upper(c), F.lit(' 6" ')) for c in ("product_name", "category")}
    products = t.products.withColumns(
        {c: F.when(product % 4 == 0, p).otherwise(F.col(c)) for c, p in padded.items()}
    )
    return Tables(customers=customers, products=products, orders=orders, order_items=items)


def _order_totals(t: Tables) -> DataFrame:
    return as_double(totals(order_sales(t), {"order_id": "order_id"}, "order_total"), "order_total")


def _result_with_index(t: Tables) -> DataFrame:
    order = METRICS["sales_by_country"].order
    return with_row_index(metric_from_tables(t, "sales_by_country"), sort_columns(order))


def _read_back(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    reader = spark.read.schema(schema).option("enforceSchema", False)
    return reader.options(**CSV_OPTIONS).csv(path)


def _without_zone(fact: DataFrame) -> DataFrame:
    """As the given dates are, with line totals as double."""
    fact = fact.withColumn("order_date", F.col("order_date").cast("timestamp_ntz"))
    return as_double(fact, "item_total")


def _sink_fact_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = build_fact(star_tables(spark, sf_dir))
    path = write_fact(fact, shared_path(spark, "fact"))
    return as_double(_read_back(spark, path, fact.schema), "item_total")


def _sink_results_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    metric = METRICS[FLAGSHIP]
    result = metric_from_tables(star_tables(spark, sf_dir), FLAGSHIP)
    path = write_result(
        result, FLAGSHIP, shared_path(spark, "result"), order=metric.order, cents=metric.cents
    )
    return _read_back(spark, path, result.schema)


def _sink_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Padded, tabbed and quoted cells, commas, fractions of a second and long fractions."""
    t = star_tables(spark, sf_dir)
    key = F.col("customer_id")
    odd = dirty(t).customers.select(
        "customer_id",
        "first_name",
        "country",
        (key / 7).alias("ratio"),
        F.expr("timestamp_ntz'2020-02-29 10:00:00' + make_dt_interval(0, 0, 0, customer_id / 8)").alias(
            "at"
        ),
    )
    path = write_result(odd, "odd", shared_path(spark, "text"))
    return _read_back(spark, path, odd.schema)


def _csv_copy(spark: SparkSession, tables: Tables, load=load_tables) -> Tables:
    """Store the four tables as CSV and load them from there."""
    root = shared_path(spark, "csv")
    for name, df in tables._asdict().items():
        df = df.withColumns({c: F.col(c).cast("string") for c, k in df.dtypes if "timestamp" in k})
        df.write.options(**CSV_OPTIONS).csv(f"{root}/{name}.csv")
    return load(spark, root)


def _fact_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _without_zone(build_fact(_csv_copy(spark, star_tables(spark, sf_dir))))


def _dirty_fact_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _without_zone(build_fact(_csv_copy(spark, dirty(star_tables(spark, sf_dir)))))


def _rejected_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What cleaning turns into null in the spoiled tables, read from CSV."""
    return all_rejected_cells(_csv_copy(spark, dirty(star_tables(spark, sf_dir)), load_raw_tables))


def _batch_counts(which: str, spoil: bool = False):
    """The audit or the row counts that the batch takes while it writes."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = star_tables(spark, sf_dir)
        tables = dirty(tables) if spoil else tables
        out = run_batch(spark, tables, shared_path(spark, "batch"), fmt="parquet", names=["aov"], counted=True)
        return getattr(out, which)

    return query


def _aov_over_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_metrics(build_fact(star_tables(spark, sf_dir)), ["aov"])["aov"]


def _aov_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "bucketed")
    name = "fact_" + path.rsplit("-", 1)[1]
    tables = star_tables(spark, sf_dir)
    rows = tables.order_items.count()
    fact = write_bucketed_fact(build_fact(tables), name, path, buckets=8, rows=rows)
    return METRICS["aov"](fact)


def _stored_results(fmt: str, refreshed: bool = False, **options):
    """Run the whole batch and read the rows of every stored result back, in long form."""

    def rows(spark: SparkSession, name: str, path: str, schema: StructType) -> DataFrame:
        index = [StructField("row_index", IntegerType())] if options.get("with_index") else []
        schema = StructType(index + schema.fields)
        result = (
            spark.read.parquet(path) if fmt == "parquet" else _read_back(spark, path, schema)
        )
        values = [
            F.coalesce(
                (F.col(c).cast("decimal(38,2)") if kind == "double" else F.col(c)).cast("string"),
                F.lit("null"),
            )
            for c, kind in result.dtypes
            if c != "row_index"
        ]
        position = F.col("row_index") if index else F.lit(None).cast("int")
        return result.select(
            F.lit(name).alias("result_name"),
            position.alias("row_index"),
            F.concat_ws("|", *values).alias("row_values"),
        )

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = star_tables(spark, sf_dir)
        place = shared_path(spark, "batch")
        if refreshed:
            # An earlier run in which the orders of some months were half cancelled.
            months = [tuple(r) for r in tables.orders.where(F.month("order_date") % 3 == 0).select(
                F.year("order_date"), F.month("order_date")).distinct().collect()]
            stale = (F.month("order_date") % 3 == 0) & (F.col("order_id") % 2 == 0)
            status = F.when(stale, F.lit("cancelled")).otherwise(F.col("status"))
            earlier = tables.orders.withColumn("status", status)
            run_batch(spark, tables._replace(orders=earlier), place, fmt=fmt, by_month=True)
            stored = refresh_months(spark, tables, place, months)
        else:
            stored = run_batch(spark, tables, place, fmt=fmt, **options)
        schemas = {n: metric_from_tables(tables, n).schema for n in stored.results}
        parts = [rows(spark, n, p, schemas[n]) for n, p in stored.results.items()]
        return reduce(DataFrame.unionByName, parts)

    return query


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator and result; each takes (spark, sf_dir)."""
    corpus = _corpus.queries() | {"pipeline": _pipeline} if _corpus else {}
    return sales_queries() | corpus


def sales_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    table_queries: dict[str, Callable[[Tables], DataFrame]] = {
        "scan_customers": lambda t: t.customers,
        "scan_products": lambda t: t.products,
        "scan_orders": lambda t: t.orders,
        "scan_order_items": lambda t: t.order_items,
        "profile_schema": audit.profile_columns,
        "profile_row_counts": audit.profile_row_counts,
        "orders_parsed": _orders_parsed,
        "items_typed": lambda t: cleaning.type_items(t.order_items),
        "items_nonnull": lambda t: cleaning.drop_null_items(cleaning.type_items(t.order_items)),
        "item_totals": _priced(lambda t: cleaning.clean_items(t.order_items)),
        "orders_calendar": lambda t: cleaning.add_calendar(cleaning.parse_orders(t.orders)),
        "standardized_text": _standardized_text,
        "orders_not_cancelled": lambda t: cleaning.drop_cancelled(t.orders),
        "orders_positive_total": lambda t: cleaning.keep_positive_totals(t.orders),
        "orders_total_filled": lambda t: cleaning.fill_missing_totals(t.orders),
        "cleaning_audit": audit.cleaning_audit,
        "join_orders_items": _priced(
            lambda t: joins.join_orders_items(t.orders, cleaning.clean_items(t.order_items))
        ),
        "join_products": _priced(
            lambda t: joins.join_products(
                cleaning.clean_items(t.order_items), cleaning.standardize_products(t.products)
            )
        ),
        "join_customers": lambda t: joins.join_customers(
            t.orders, cleaning.standardize_customers(t.customers)
        ),
        "fact_table": _priced(build_fact),
        "order_totals": _order_totals,
        "result_with_index": _result_with_index,
    }
    table_queries |= {
        "running_total_by_order": running_total_from_tables,
        "daily_category_change": lambda t: daily_category_change(build_fact(t)),
        "ranked_products_deep": lambda t: metric_from_tables(t, FLAGSHIP, size=DEEP),
        "sample_by_hash": lambda t: audit.sample_by_hash(t.orders, ["order_id"], 100),
    }
    table_queries["sample_rows"] = lambda t: audit.sample(metric_from_tables(t, "sales_by_country"))
    spoiled: dict[str, Callable[[Tables], DataFrame]] = {
        "dirty_items_typed": lambda t: cleaning.type_items(t.order_items),
        "dirty_items_nonnull": lambda t: cleaning.drop_null_items(cleaning.type_items(t.order_items)),
        "dirty_item_totals": _priced(lambda t: cleaning.clean_items(t.order_items)),
        "dirty_orders_parsed": lambda t: _plain_dates(cleaning.parse_orders(t.orders)),
        "dirty_orders_calendar": lambda t: _plain_dates(
            cleaning.add_calendar(cleaning.parse_orders(t.orders))
        ),
        "dirty_standardized_text": _standardized_text,
        "dirty_orders_not_cancelled": lambda t: cleaning.drop_cancelled(t.orders),
        "dirty_orders_positive_total": lambda t: cleaning.keep_positive_totals(t.orders),
        "dirty_orders_total_filled": lambda t: cleaning.fill_missing_totals(t.orders),
        "dirty_cleaning_audit": audit.cleaning_audit,
        "dirty_row_counts": audit.profile_row_counts,
        "dirty_fact_table": lambda t: _without_zone(build_fact(t)),
        "dirty_fact_status_first": lambda t: _without_zone(
            build_fact(t, normalize_status_first=True)
        ),
        "dirty_ranked_products": lambda t: metric_from_tables(t, FLAGSHIP),
        "dirty_monthly_with_lag": lambda t: metric_from_tables(t, "monthly_sales_with_lag"),
        "dirty_daily_category_change": lambda t: daily_category_change(build_fact(t)),
        "dirty_running_total_by_order": lambda t: _plain_dates(running_total_from_tables(t)),
    }
    for name, build in spoiled.items():
        table_queries[name] = lambda t, build=build: build(dirty(t))
    for name in METRICS:
        table_queries[name] = lambda t, name=name: metric_from_tables(t, name)
    return {name: _on_tables(build) for name, build in table_queries.items()} | {
        "fact_from_csv": _fact_from_csv,
        "sink_fact_roundtrip": _sink_fact_roundtrip,
        "sink_results_roundtrip": _sink_results_roundtrip,
        "sink_text_roundtrip": _sink_text_roundtrip,
        "dirty_fact_from_csv": _dirty_fact_from_csv,
        "rejected_cells": _rejected_cells,
        "batch_audit": _batch_counts("audit"),
        "batch_row_counts": _batch_counts("row_counts"),
        "dirty_batch_audit": _batch_counts("audit", spoil=True),
        "dirty_batch_row_counts": _batch_counts("row_counts", spoil=True),
        "aov_bucketed": _aov_bucketed,
        "aov_over_join": _aov_over_join,
        "stored_results": _stored_results("parquet"),
        "stored_results_by_month": _stored_results("parquet", by_month=True),
        "stored_results_csv": _stored_results("csv", with_index=True),
        "stored_results_refreshed": _stored_results("parquet", refreshed=True),
    }


# --- the same in SQL -------------------------------------------------------

# The contract tables over the given ones, and the fact table over those.
_TABLES_SQL = """
WITH customers AS (
  SELECT c_custkey AS customer_id,
         split_part(c_name, '#', 1) AS first_name,
         split_part(c_name, '#', 2) AS last_name,
         CAST(NULL AS VARCHAR) AS email,
         n_name AS country
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
), products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS brand
  FROM part
), sales_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
         CAST(o_orderdate AS TIMESTAMP) AS order_date, o_totalprice AS total_amount,
         CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending'
                            WHEN 'P' THEN 'cancelled' END AS status
  FROM orders
), order_items AS (
  SELECT CAST(NULL AS VARCHAR) AS order_item_id, l_orderkey AS order_id,
         l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
         l_extendedprice / l_quantity AS price_per_unit
  FROM lineitem
), clean_items AS (
  SELECT *, CAST(round(quantity * price_per_unit, 2) AS DECIMAL(18,2)) AS item_total
  FROM order_items
  WHERE quantity IS NOT NULL AND price_per_unit IS NOT NULL
)"""
# The same tables, spoiled as dirty() does.
_DIRTY_SQL = (
    _TABLES_SQL.split("), clean_items AS (")[0]
    .replace("customers AS", "tidy_customers AS")
    .replace("products AS", "tidy_products AS")
    .replace("sales_orders AS", "tidy_orders AS")
    .replace("order_items AS", "tidy_items AS")
    + """), customers AS (
  SELECT * REPLACE (
    CASE WHEN customer_id % 5 = 0 THEN '  "' || first_name || '", x' || chr(9)
         ELSE first_name END AS first_name,
    CASE customer_id % 3 WHEN 0 THEN '  ' || country || ' ' WHEN 1 THEN chr(9) || country
                         ELSE country END AS country)
  FROM tidy_customers
), products AS (
  SELECT * REPLACE (
    CASE WHEN product_id % 4 = 0 THEN ' ' || upper(product_name) || ' 6" ' ELSE product_name END
      AS product_name,
    CASE WHEN product_id % 4 = 0 THEN ' ' || upper(category) || ' 6" ' ELSE category END
      AS category)
  FROM tidy_products
), sales_orders AS (
  SELECT * REPLACE (
    CASE WHEN order_id % 9 <> 0 THEN order_date END AS order_date,
    CASE order_id % 7 WHEN 0 THEN NULL WHEN 1 THEN 0.0 WHEN 2 THEN -total_amount
                      ELSE total_amount END AS total_amount,
    CASE order_id % 10 WHEN 3 THEN NULL WHEN 4 THEN ' Cancelled ' WHEN 5 THEN 'cancelled'
                       ELSE status END AS status)
  FROM tidy_orders
), order_items AS (
  SELECT * REPLACE (
    CASE WHEN order_id % 11 <> 0 AND order_id % 13 <> 0 THEN quantity END AS quantity,
    CASE WHEN product_id % 17 <> 0 AND product_id % 19 <> 0 THEN price_per_unit END
      AS price_per_unit)
  FROM tidy_items
), clean_items AS (
  SELECT *, CAST(round(quantity * price_per_unit, 2) AS DECIMAL(18,2)) AS item_total
  FROM order_items
  WHERE quantity IS NOT NULL AND price_per_unit IS NOT NULL
)"""
)
_JOINED_SQL = (
    """, joined AS (
  SELECT o.customer_id, i.product_id, o.order_id, o.order_date, o.total_amount, o.status,
         i.order_item_id, i.quantity, i.price_per_unit, i.item_total,
         p.product_name, p.category, p.brand, c.first_name, c.last_name, c.email, c.country
  FROM sales_orders o
  JOIN clean_items i ON i.order_id = o.order_id
  JOIN products p ON p.product_id = i.product_id
  JOIN customers c ON c.customer_id = o.customer_id
), fact AS (
  SELECT customer_id, product_id, order_id, order_date, total_amount,
         lower(trim(status, ' ')) AS status,
         CAST(year(order_date) AS INTEGER) AS order_year,
         CAST(month(order_date) AS INTEGER) AS order_month,
         CAST(dayofweek(order_date) + 1 AS INTEGER) AS order_day_of_week,
         order_item_id, quantity, price_per_unit, item_total,
         lower(trim(product_name, ' ')) AS product_name,
         lower(trim(category, ' ')) AS category,
         lower(trim(brand, ' ')) AS brand,
         first_name, last_name, email,
         lower(trim(country, ' ')) AS country
  FROM joined
  WHERE status <> 'cancelled' AND total_amount > 0
)"""
)


def _table_sql(select: str, dirty: bool = False) -> str:
    return f"{_DIRTY_SQL if dirty else _TABLES_SQL}\n{select}"


def _fact_sql(select: str, dirty: bool = False) -> str:
    return _table_sql(f"{_JOINED_SQL}\n{select}", dirty)


def _total(keys: str, measure: str, groups: str) -> str:
    return f"SELECT {keys}, CAST(sum(item_total) AS DOUBLE) AS {measure} FROM fact GROUP BY {groups}"


_RESULT_SQL = {
    "sales_by_date": _total(
        "CAST(order_date AS DATE) AS sale_date", "daily_total_sales", "1"
    )
    + " ORDER BY sale_date ASC NULLS FIRST",
    "sales_by_category": _total("category", "category_total_sales", "1")
    + " ORDER BY category_total_sales DESC NULLS LAST, category ASC NULLS FIRST",
    "top_n_products": _total("product_id, product_name", "product_total_sales", "1, 2")
    + " ORDER BY product_total_sales DESC NULLS LAST, product_id ASC NULLS FIRST,"
    " product_name ASC NULLS FIRST LIMIT 10",
    "top_n_customers": _total(
        "customer_id, first_name, last_name", "customer_total_spent", "1, 2, 3"
    )
    + " ORDER BY customer_total_spent DESC NULLS LAST, customer_id ASC NULLS FIRST,"
    " first_name ASC NULLS FIRST, last_name ASC NULLS FIRST LIMIT 10",
    "monthly_sales": _total("order_year, order_month", "monthly_sales", "1, 2")
    + " ORDER BY 1 ASC NULLS FIRST, 2 ASC NULLS FIRST",
    "aov": """
SELECT round(CAST(sum(order_total) AS DOUBLE) / count(order_total), 2) AS average_order_value
FROM (SELECT order_id, sum(item_total) AS order_total FROM fact GROUP BY order_id)""",
    "sales_by_country": _total("country", "country_total_sales", "1")
    + " ORDER BY country_total_sales DESC NULLS LAST, country ASC NULLS FIRST",
    "running_total_sales": """
SELECT sale_date, CAST(day_total AS DOUBLE) AS daily_sales,
       CAST(sum(day_total) OVER (ORDER BY sale_date ASC NULLS FIRST
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_total_sales
FROM (SELECT CAST(order_date AS DATE) AS sale_date, sum(item_total) AS day_total
      FROM fact GROUP BY 1)
ORDER BY sale_date ASC NULLS FIRST""",
    "ranked_products_in_category": """
SELECT category, product_id, product_name, CAST(total AS DOUBLE) AS category_product_sales,
       rank_in_category
FROM (SELECT *, CAST(rank() OVER (PARTITION BY category ORDER BY total DESC NULLS LAST)
                     AS INTEGER) AS rank_in_category
      FROM (SELECT category, product_id, product_name, sum(item_total) AS total
            FROM fact GROUP BY 1, 2, 3))
WHERE rank_in_category <= 3
ORDER BY category ASC NULLS FIRST, rank_in_category ASC, product_id ASC NULLS FIRST""",
    "monthly_sales_with_lag": """
SELECT order_year, order_month, monthly_sales, prev_month_sales,
       CAST(round(CAST((monthly_sales - prev_month_sales) / nullif(prev_month_sales, 0) * 100
                       AS DECIMAL(30,12)), 2) AS DOUBLE) AS mom_growth_percent
FROM (SELECT *, lag(monthly_sales, 1) OVER (ORDER BY order_year ASC NULLS FIRST,
                                            order_month ASC NULLS FIRST) AS prev_month_sales
      FROM (SELECT order_year, order_month, CAST(sum(item_total) AS DOUBLE) AS monthly_sales
            FROM fact GROUP BY 1, 2))
ORDER BY order_year ASC NULLS FIRST, order_month ASC NULLS FIRST""",
    "quarterly_sales": _total(
        "order_year, CAST(quarter(order_date) AS INTEGER) AS order_quarter",
        "quarterly_sales",
        "1, 2",
    )
    + " ORDER BY 1 ASC NULLS FIRST, 2 ASC NULLS FIRST",
}

# Columns of each result, for the long form of the stored copy: text as it is, doubles
# with two places.
_RESULT_COLUMNS = {
    "sales_by_date": ("sale_date", "daily_total_sales*"),
    "sales_by_category": ("category", "category_total_sales*"),
    "top_n_products": ("product_id", "product_name", "product_total_sales*"),
    "top_n_customers": ("customer_id", "first_name", "last_name", "customer_total_spent*"),
    "monthly_sales": ("order_year", "order_month", "monthly_sales*"),
    "aov": ("average_order_value*",),
    "sales_by_country": ("country", "country_total_sales*"),
    "running_total_sales": ("sale_date", "daily_sales*", "running_total_sales*"),
    "ranked_products_in_category": (
        "category", "product_id", "product_name", "category_product_sales*", "rank_in_category",
    ),
    "monthly_sales_with_lag": (
        "order_year", "order_month", "monthly_sales*", "prev_month_sales*", "mom_growth_percent*",
    ),
    "quarterly_sales": ("order_year", "order_quarter", "quarterly_sales*"),
}


def _stored_results_sql(with_index: bool = False) -> str:
    parts = []
    for name, select in _RESULT_SQL.items():
        values = [
            f"coalesce(CAST(CAST({c[:-1]} AS DECIMAL(38,2)) AS VARCHAR), 'null')"
            if c.endswith("*")
            else f"coalesce(CAST({c} AS VARCHAR), 'null')"
            for c in _RESULT_COLUMNS[name]
        ]
        order = select.rpartition("ORDER BY")[2].partition("LIMIT")[0] if "ORDER BY" in select else "1"
        index = f"CAST(row_number() OVER (ORDER BY {order}) - 1 AS INTEGER)"
        if order.strip().startswith("1"):
            keys = ", ".join(f"{c} ASC NULLS FIRST" for c in _RESULT_COLUMNS[name][:2] if c[-1] != "*")
            index = f"CAST(row_number() OVER ({'ORDER BY ' + keys if keys else ''}) - 1 AS INTEGER)"
        if not with_index:
            index = "CAST(NULL AS INTEGER)"
        parts.append(
            f"SELECT '{name}' AS result_name, {index} AS row_index,"
            f" concat_ws('|', {', '.join(values)}) AS row_values FROM ({select})"
        )
    return _fact_sql("\nUNION ALL\n".join(parts))


def _profile_schema_sql() -> str:
    integer, text, real, time = "bigint", "string", "double", "timestamp_ntz"
    columns = {
        "customers": [
            ("customer_id", integer),
            ("first_name", text),
            ("last_name", text),
            ("email", text),
            ("country", text),
        ],
        "products": [
            ("product_id", integer),
            ("product_name", text),
            ("category", text),
            ("brand", text),
        ],
        "orders": [
            ("order_id", integer),
            ("customer_id", integer),
            ("order_date", time),
            ("total_amount", real),
            ("status", text),
        ],
        "order_items": [
            ("order_item_id", text),
            ("order_id", integer),
            ("product_id", integer),
            ("quantity", "int"),
            ("price_per_unit", real),
        ],
    }
    source = {"orders": "sales_orders"}
    parts = [
        f"SELECT '{table}' AS table_name, CAST({i} AS INTEGER) AS position,"
        f" '{column}' AS column_name, '{dtype}' AS data_type, true AS nullable,"
        f" count({column}) AS non_null_rows FROM {source.get(table, table)}"
        for table, fields in columns.items()
        for i, (column, dtype) in enumerate(fields)
    ]
    return _table_sql("\nUNION ALL\n".join(parts))


_AUDIT_SQL = """
SELECT 'null_items' AS step, count(*) AS rows_in,
       count(*) FILTER (quantity IS NOT NULL AND price_per_unit IS NOT NULL) AS rows_out,
       count(*) FILTER (quantity IS NULL OR price_per_unit IS NULL) AS dropped
FROM order_items
UNION ALL
SELECT 'not_an_amount', count(*), count(item_total), count(*) - count(item_total) FROM clean_items
UNION ALL
SELECT 'cancelled_orders', count(*), count(*) FILTER (status <> 'cancelled'),
       count(*) - count(*) FILTER (status <> 'cancelled')
FROM joined
UNION ALL
SELECT 'non_positive_totals', count(*), count(*) FILTER (total_amount > 0),
       count(*) - count(*) FILTER (total_amount > 0)
FROM joined WHERE status <> 'cancelled'"""
_COUNTS_SQL = """
SELECT 'customers' AS table_name, count(*) AS row_count FROM customers
UNION ALL SELECT 'products', count(*) FROM products
UNION ALL SELECT 'orders', count(*) FROM sales_orders
UNION ALL SELECT 'order_items', count(*) FROM order_items
UNION ALL SELECT 'fact_table', count(*) FROM fact"""
_TEXT_SQL = """
SELECT 'product_name' AS field, product_id AS id, lower(trim(product_name, ' ')) AS value
FROM products
UNION ALL SELECT 'category', product_id, lower(trim(category, ' ')) FROM products
UNION ALL SELECT 'brand', product_id, lower(trim(brand, ' ')) FROM products
UNION ALL SELECT 'country', customer_id, lower(trim(country, ' ')) FROM customers
UNION ALL SELECT 'status', order_id, lower(trim(status, ' ')) FROM sales_orders"""
_CALENDAR_SQL = """
SELECT *, CAST(year(order_date) AS INTEGER) AS order_year,
       CAST(month(order_date) AS INTEGER) AS order_month,
       CAST(dayofweek(order_date) + 1 AS INTEGER) AS order_day_of_week
FROM sales_orders"""
_KEYS_AS_TEXT = """* REPLACE (CAST(customer_id AS VARCHAR) AS customer_id,
                  CAST(product_id AS VARCHAR) AS product_id,
                  CAST(order_id AS VARCHAR) AS order_id,
                  CAST(item_total AS DOUBLE) AS item_total)"""

_RUNNING_SQL = """
SELECT order_id, order_date, CAST(total AS DOUBLE) AS order_total,
       CAST(sum(total) OVER (ORDER BY order_date ASC NULLS FIRST, order_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_total
FROM (SELECT order_id, order_date, sum(item_total) AS total FROM fact GROUP BY 1, 2)"""
_DAILY_SQL = """
SELECT category, sale_date, daily_sales, prev_sales,
       CAST(round(CAST((daily_sales - prev_sales) / nullif(prev_sales, 0) * 100 AS DECIMAL(30,12)), 2)
            AS DOUBLE) AS change_percent
FROM (SELECT *, lag(daily_sales) OVER (PARTITION BY category ORDER BY sale_date ASC NULLS FIRST)
                AS prev_sales
      FROM (SELECT category, CAST(order_date AS DATE) AS sale_date,
                   CAST(sum(item_total) AS DOUBLE) AS daily_sales
            FROM fact GROUP BY 1, 2))"""
# Text that does not fit its column, written where dirty() spoils it.
_REJECTED_SQL = """
SELECT 'order_items' AS table_name, CAST(order_id AS VARCHAR) AS row_key,
       'quantity' AS column_name, 'many' AS raw_text, 'not_an_integer' AS reason
FROM order_items WHERE order_id % 11 <> 0 AND order_id % 13 = 0
UNION ALL
SELECT 'order_items', CAST(order_id AS VARCHAR), 'price_per_unit', 'n/a', 'not_a_number'
FROM order_items WHERE product_id % 17 <> 0 AND product_id % 19 = 0
UNION ALL
SELECT 'orders', CAST(order_id AS VARCHAR), 'order_date', '31.12.2020', 'not_a_date'
FROM sales_orders WHERE order_id % 9 = 0"""


def _dirty_sql() -> dict[str, str]:
    priced = "* REPLACE (CAST(item_total AS DOUBLE) AS item_total)"
    # The stored dates, written as text: spoiled ones do not parse.
    dates = """* REPLACE (CASE WHEN order_id % 9 = 0 THEN '31.12.2020'
                 ELSE strftime(order_date, '%Y-%m-%d %H:%M:%S') END AS order_date)"""
    status_first = _JOINED_SQL.replace(
        "WHERE status <> 'cancelled'", "WHERE lower(trim(status, ' ')) <> 'cancelled'"
    )
    items = "quantity IS NOT NULL AND price_per_unit IS NOT NULL"
    tables = {
        "dirty_items_typed": "SELECT * FROM order_items",
        "dirty_items_nonnull": f"SELECT * FROM order_items WHERE {items}",
        "dirty_item_totals": f"SELECT {priced} FROM clean_items",
        "dirty_orders_parsed": "SELECT * FROM sales_orders",
        "dirty_orders_calendar": _CALENDAR_SQL,
        "dirty_standardized_text": _TEXT_SQL,
        "dirty_orders_not_cancelled": f"SELECT {dates} FROM sales_orders WHERE status <> 'cancelled'",
        "dirty_orders_positive_total": f"SELECT {dates} FROM sales_orders WHERE total_amount > 0",
        "dirty_orders_total_filled": f"SELECT {dates} FROM (SELECT * REPLACE"
        " (coalesce(total_amount, 0) AS total_amount) FROM sales_orders)",
        "rejected_cells": _REJECTED_SQL,
        "dirty_fact_status_first": f"{status_first}\nSELECT {priced} FROM fact",
        "sink_text_roundtrip": """
SELECT customer_id, first_name, country, customer_id / 7 AS ratio,
       TIMESTAMP '2020-02-29 10:00:00' + to_microseconds(customer_id * 125000) AS at
FROM customers""",
    }
    facts = {
        "dirty_cleaning_audit": _AUDIT_SQL,
        "dirty_row_counts": _COUNTS_SQL,
        "dirty_batch_audit": _AUDIT_SQL,
        "dirty_batch_row_counts": _COUNTS_SQL,
        "dirty_running_total_by_order": _RUNNING_SQL,
        "dirty_daily_category_change": _DAILY_SQL,
        "dirty_fact_table": f"SELECT {priced} FROM fact",
        "dirty_fact_from_csv": f"SELECT {_KEYS_AS_TEXT} FROM fact",
        "dirty_ranked_products": _RESULT_SQL[FLAGSHIP],
        "dirty_monthly_with_lag": _RESULT_SQL["monthly_sales_with_lag"],
    }
    return {n: _table_sql(q, dirty=True) for n, q in tables.items()} | {
        n: _fact_sql(q, dirty=True) for n, q in facts.items()
    }


def oracle_sql() -> dict[str, str]:
    """Equivalent SQL for each query that SQL can express, over the given tables."""
    corpus = _corpus.oracle_sql() if _corpus else {}
    if _corpus and _PIPELINE_SQL:
        corpus["pipeline"] = _PIPELINE_SQL
    return sales_sql() | corpus


def sales_sql() -> dict[str, str]:
    priced = "* REPLACE (CAST(item_total AS DOUBLE) AS item_total)"
    fact = _fact_sql(f"SELECT {priced} FROM fact")
    sql = {
        "scan_customers": _table_sql("SELECT * FROM customers"),
        "scan_products": _table_sql("SELECT * FROM products"),
        "scan_orders": _table_sql("SELECT * FROM sales_orders"),
        "scan_order_items": _table_sql("SELECT * FROM order_items"),
        "profile_schema": _profile_schema_sql(),
        "profile_row_counts": _fact_sql(_COUNTS_SQL),
        "orders_parsed": _table_sql("SELECT * FROM sales_orders"),
        "items_typed": _table_sql("SELECT * FROM order_items"),
        "items_nonnull": _table_sql(
            "SELECT * FROM order_items WHERE quantity IS NOT NULL AND price_per_unit IS NOT NULL"
        ),
        "item_totals": _table_sql(f"SELECT {priced} FROM clean_items"),
        "orders_calendar": _table_sql(_CALENDAR_SQL),
        "standardized_text": _table_sql(_TEXT_SQL),
        "orders_not_cancelled": _table_sql(
            "SELECT * FROM sales_orders WHERE status <> 'cancelled'"
        ),
        "orders_positive_total": _table_sql("SELECT * FROM sales_orders WHERE total_amount > 0"),
        "orders_total_filled": _table_sql(
            "SELECT * REPLACE (coalesce(total_amount, 0) AS total_amount) FROM sales_orders"
        ),
        "cleaning_audit": _fact_sql(_AUDIT_SQL),
        "join_orders_items": _table_sql(
            f"SELECT {priced} FROM sales_orders JOIN clean_items USING (order_id)"
        ),
        "join_products": _table_sql("""
SELECT i.* REPLACE (CAST(item_total AS DOUBLE) AS item_total),
       lower(trim(product_name, ' ')) AS product_name,
       lower(trim(category, ' ')) AS category, lower(trim(brand, ' ')) AS brand
FROM clean_items i JOIN products p ON p.product_id = i.product_id"""),
        "join_customers": _table_sql("""
SELECT o.*, first_name, last_name, email, lower(trim(country, ' ')) AS country
FROM sales_orders o JOIN customers c ON c.customer_id = o.customer_id"""),
        "fact_table": fact,
        "fact_from_csv": _fact_sql(f"SELECT {_KEYS_AS_TEXT} FROM fact"),
        "order_totals": _fact_sql(_total("order_id", "order_total", "1")),
        "result_with_index": _fact_sql(f"""
SELECT CAST(row_number() OVER (ORDER BY country_total_sales DESC NULLS LAST,
                               country ASC NULLS FIRST) - 1 AS INTEGER) AS row_index, *
FROM ({_RESULT_SQL["sales_by_country"]})"""),
        "running_total_by_order": _fact_sql(_RUNNING_SQL),
        "daily_category_change": _fact_sql(_DAILY_SQL),
        "ranked_products_deep": _fact_sql(
            _RESULT_SQL[FLAGSHIP].replace("rank_in_category <= 3", f"rank_in_category <= {DEEP}")
        ),
        "sample_by_hash": _table_sql(
            "SELECT * FROM sales_orders ORDER BY md5('|' || order_id) LIMIT 100"
        ),
        "batch_audit": _fact_sql(_AUDIT_SQL),
        "batch_row_counts": _fact_sql(_COUNTS_SQL),
        "aov_bucketed": _fact_sql(_RESULT_SQL["aov"]),
        "aov_over_join": _fact_sql(_RESULT_SQL["aov"]),
        "sink_fact_roundtrip": fact,
        "sink_results_roundtrip": _fact_sql(_RESULT_SQL[FLAGSHIP]),
        "sample_rows": _fact_sql(f"{_RESULT_SQL['sales_by_country']} LIMIT 5"),
        "stored_results": _stored_results_sql(),
        "stored_results_by_month": _stored_results_sql(),
        "stored_results_csv": _stored_results_sql(with_index=True),
        "stored_results_refreshed": _stored_results_sql(),
    }
    return sql | _dirty_sql() | {name: _fact_sql(select) for name, select in _RESULT_SQL.items()}
