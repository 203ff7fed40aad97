"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillstar.schemas import ORDER_DATE_FORMAT


def parse_order_date(text: Column) -> Column:
    """Text to timestamp; null where it does not fit the format.

    Strict under Spark's default time parser policy. A caller who wants lenient
    dates sets ``spark.sql.legacy.timeParserPolicy=LEGACY`` on the session."""
    return F.try_to_timestamp(text, F.lit(ORDER_DATE_FORMAT))


def day_of_week(date: Column) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(date)
