"""Column expressions shared by the operators. All run inside generated code."""

from tillstar.functions.calendar import day_of_week, parse_order_date
from tillstar.functions.money import (
    amount,
    as_double,
    item_total,
    mean_to_cents,
    percent_change,
)
from tillstar.functions.text import standardize

__all__ = [
    "amount",
    "as_double",
    "day_of_week",
    "item_total",
    "mean_to_cents",
    "parse_order_date",
    "percent_change",
    "standardize",
]
