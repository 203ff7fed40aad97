"""Window operators over aggregated sales.

The running total and the month-over-month change need all rows in one order, hence
one partition. They run after aggregation to days or months, where the number of rows
is bounded by the calendar and not by the sales volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstar.functions import as_double, percent_change
from tillstar.operators.ranges import ranked_by_counting

_CUT_SETTING = "spark.sql.optimizer.windowGroupLimitThreshold"


def running_total(daily: DataFrame) -> DataFrame:
    """(sale_date, daily_sales) with the sum of all days up to each one."""
    up_to_here = Window.orderBy(F.col("sale_date").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    out = daily.withColumn("running_total_sales", F.sum("daily_sales").over(up_to_here))
    return as_double(out, "daily_sales", "running_total_sales")


def top_per_category(product_sales: DataFrame, depth: int) -> DataFrame:
    """Products ranked by sales within their category, ranks 1..depth with ties.

    The rank filter lets Spark cut each task's rows to the best ``depth`` before the
    shuffle by category, so a category holding most products is not sorted in one task.
    Spark does so up to a depth that is a setting; a larger depth is ranked by counting,
    over ranges of the totals.
    """
    most = int(product_sales.sparkSession.conf.get(_CUT_SETTING, "1000"))
    if depth > most:
        ranked = ranked_by_counting(
            product_sales, ("category",), "category_product_sales", "rank_in_category", depth
        )
        return as_double(ranked, "category_product_sales")
    best_first = Window.partitionBy("category").orderBy(
        F.col("category_product_sales").desc_nulls_last()
    )
    ranked = product_sales.withColumn("rank_in_category", F.rank().over(best_first))
    return as_double(ranked.filter(F.col("rank_in_category") <= depth), "category_product_sales")


def month_over_month(monthly: DataFrame) -> DataFrame:
    """Monthly sales beside those of the previous month that has any, and the change."""
    in_order = Window.orderBy(
        F.col("order_year").asc_nulls_first(), F.col("order_month").asc_nulls_first()
    )
    return (
        as_double(monthly, "monthly_sales")
        .withColumn("prev_month_sales", F.lag("monthly_sales", 1).over(in_order))
        .withColumn(
            "mom_growth_percent",
            percent_change(F.col("monthly_sales"), F.col("prev_month_sales")),
        )
    )
