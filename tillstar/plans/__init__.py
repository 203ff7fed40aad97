"""Whole plans: the fact table, the rollups, the result registry and the batch run."""

from tillstar.plans.batch import BatchOutput, run_batch, write_outputs
from tillstar.plans.counted import CountedFact
from tillstar.plans.fact import build_fact
from tillstar.plans.fine import (
    daily_category_change,
    running_total_by_order,
    running_total_from_tables,
)
from tillstar.plans.metrics import METRICS, metric_from_tables, run_metrics
from tillstar.plans.refresh import refresh_months
from tillstar.plans.rollups import (
    customer_sales,
    order_sales,
    product_sales,
    rollup_fact,
)

__all__ = [
    "BatchOutput",
    "CountedFact",
    "METRICS",
    "build_fact",
    "customer_sales",
    "daily_category_change",
    "metric_from_tables",
    "order_sales",
    "product_sales",
    "refresh_months",
    "rollup_fact",
    "run_batch",
    "run_metrics",
    "running_total_by_order",
    "running_total_from_tables",
    "write_outputs",
]
