"""Readers that turn stored data into the four contract tables."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tillstar.schemas import TABLE_SCHEMAS, Tables
from tillstar.sources.csv import read_csv_table, read_raw_csv_table
from tillstar.sources.parquet import read_parquet_table
from tillstar.sources.star import star_tables

_READERS = {"csv": read_csv_table, "parquet": read_parquet_table}


def load_tables(spark: SparkSession, path: str, fmt: str = "csv", **options) -> Tables:
    """Load ``<path>/<table>.<fmt>`` for all four tables (file or directory each).

    Options go to the reader of the format."""
    if fmt not in _READERS:
        raise ValueError(f"unknown source format {fmt!r}; use one of {sorted(_READERS)}")
    read = _READERS[fmt]
    return Tables(**{name: read(spark, path, name, **options) for name in TABLE_SCHEMAS})


def load_raw_tables(spark: SparkSession, path: str, **options) -> Tables:
    """The four CSV tables with every cell as text and a column ``_corrupt_record``."""
    return Tables(**{n: read_raw_csv_table(spark, path, n, **options) for n in TABLE_SCHEMAS})


__all__ = [
    "load_raw_tables",
    "load_tables",
    "read_csv_table",
    "read_parquet_table",
    "read_raw_csv_table",
    "star_tables",
]
