"""Parquet copies of the four tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillstar.schemas import conform


def read_parquet_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Scan ``<path>/<table>.parquet``; its columns are checked against the contract."""
    return conform(spark.read.parquet(f"{path.rstrip('/')}/{table}.parquet"), table)
