"""Sums of item_total, at any grain."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.functions import mean_to_cents


def totals(
    frame: DataFrame, keys: Mapping[str, str], measure: str = "item_total", spread: bool = False
) -> DataFrame:
    """Exact total of ``item_total`` for each combination of the key expressions.

    The result may itself be the input of a coarser total. Spark sums within each
    task before it shuffles, so a key that holds most of the rows arrives at its
    reducer as one row per task.

    A frame that comes out of a join by these keys is summed where the join left it, and a
    hot key of that join then cannot be split, since its rows must stay in one task. With
    ``spread`` the keys are grouped as one struct, which the join knows nothing of: sums
    of each task are shuffled, and adaptive execution may split the join before.
    """
    groups = [F.expr(expression).alias(name) for name, expression in keys.items()]
    total = F.sum("item_total").alias(measure)
    if not spread:
        return frame.groupBy(*groups).agg(total)
    sums = frame.groupBy(F.struct(*groups).alias("__keys")).agg(total)
    return sums.select(*(F.col("__keys")[name].alias(name) for name in keys), measure)


def average_order_value(order_totals: DataFrame) -> DataFrame:
    """Mean of the order totals, as one row (null when there are no orders)."""
    return order_totals.agg(
        mean_to_cents(F.sum("order_total"), F.count("order_total")).alias("average_order_value")
    )


def sort_columns(order):
    """Column objects for ``[(name, "asc" | "desc"), ...]``: nulls first when
    ascending, last when descending."""
    return [
        F.col(name).desc_nulls_last() if way == "desc" else F.col(name).asc_nulls_first()
        for name, way in order
    ]
