"""Adapter from a customer/part/orders/lineitem star schema to the contract tables.

Only projections and one lookup: every filter and every column choice made later
still reaches the parquet scans. Scans declare the columns they may use, so no job
is spent on reading file footers to infer a schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.schemas import Tables

# The stored columns this adapter reads, and how they map to the contract.
STAR_COLUMNS = {
    "nation": "n_nationkey int, n_name string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
        "o_totalprice double, o_orderdate timestamp_ntz"
    ),
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_quantity double, l_extendedprice double",
}
CUSTOMER_COLUMNS = [
    "c_custkey as customer_id",
    "split_part(c_name, '#', 1) as first_name",
    "split_part(c_name, '#', 2) as last_name",
    "cast(null as string) as email",
    "n_name as country",
]
PRODUCT_COLUMNS = [
    "p_partkey as product_id",
    "p_name as product_name",
    "p_type as category",
    "p_brand as brand",
]
ORDER_COLUMNS = [
    "o_orderkey as order_id",
    "o_custkey as customer_id",
    "o_orderdate as order_date",
    "o_totalprice as total_amount",
    "case o_orderstatus when 'F' then 'completed' when 'O' then 'pending'"
    " when 'P' then 'cancelled' end as status",
]
ORDER_ITEM_COLUMNS = [
    "cast(null as string) as order_item_id",
    "l_orderkey as order_id",
    "l_partkey as product_id",
    "try_cast(l_quantity as int) as quantity",
    "try_divide(l_extendedprice, l_quantity) as price_per_unit",
]


def _scan(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.schema(STAR_COLUMNS[name]).parquet(f"{path.rstrip('/')}/{name}.parquet")


def star_customers(spark: SparkSession, path: str) -> DataFrame:
    """Left join: a customer with an unknown nation stays, without a country. The lookup
    has one row per key by construction, so Spark drops the join where no country is read.
    Of several names for one nation key the smallest counts; customers do not multiply.
    """
    nation = _scan(spark, path, "nation").groupBy(F.col("n_nationkey").alias("c_nationkey"))
    customer = _scan(spark, path, "customer").join(
        nation.agg(F.min("n_name").alias("n_name")), "c_nationkey", "left"
    )
    return customer.selectExpr(*CUSTOMER_COLUMNS)


def star_tables(spark: SparkSession, path: str) -> Tables:
    """The four contract tables, as views over the star schema in ``path``."""
    return Tables(
        customers=star_customers(spark, path),
        products=_scan(spark, path, "part").selectExpr(*PRODUCT_COLUMNS),
        orders=_scan(spark, path, "orders").selectExpr(*ORDER_COLUMNS),
        order_items=_scan(spark, path, "lineitem").selectExpr(*ORDER_ITEM_COLUMNS),
    )
