"""Retail sales analytics on Spark DataFrames."""

from tillstar.plans import (
    METRICS,
    build_fact,
    metric_from_tables,
    refresh_months,
    run_batch,
    run_metrics,
    write_outputs,
)
from tillstar.schemas import Tables
from tillstar.sources import load_tables, star_tables

__all__ = [
    "METRICS",
    "Tables",
    "build_fact",
    "load_tables",
    "metric_from_tables",
    "refresh_months",
    "run_batch",
    "run_metrics",
    "star_tables",
    "write_outputs",
]
