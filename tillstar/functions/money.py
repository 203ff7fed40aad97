"""Money expressions.

A line total is rounded half-up to cents once and kept as ``decimal(18,2)``; all
sums above it are exact, so rounding a sum again changes nothing and totals are the
same however the rows are partitioned or pre-aggregated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.schemas import MONEY


def amount(quantity: Column, price: Column) -> Column:
    """quantity x price in cents, null where that is no amount of money."""
    return (quantity * price).try_cast(MONEY)


def item_total(quantity: Column, price: Column, *where: Column) -> Column:
    """quantity x price in cents, null when either is missing.

    The cast rounds half-up on the decimal text of the double, exactly as
    ``round(x, 2)`` does, and saves that second conversion. A product that is no amount
    (NaN, infinite, beyond 18 digits) raises an error that shows the values and the
    columns ``where``: as null it would be left out of every sum unnoticed."""
    shown = [F.coalesce(c.cast("string"), F.lit("null")) for c in (quantity, price, *where)]
    text = F.concat(F.lit("not an amount of money: "), F.concat_ws(", ", *shown))
    known = quantity.isNotNull() & price.isNotNull()
    return F.when(known, F.coalesce(amount(quantity, price), F.raise_error(text)))


def as_double(df: DataFrame, *columns: str) -> DataFrame:
    """Emit exact totals as double."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def mean_to_cents(total: Column, count: Column) -> Column:
    """total / count to two places; null when there is nothing to average.

    Divides as double: a decimal average would first be rounded to six places."""
    return F.round(F.try_divide(total.cast("double"), count), 2)


def percent_change(current: Column, previous: Column) -> Column:
    """Change in percent to two places; null for a missing or zero previous value."""
    return F.round(F.try_divide(current - previous, previous) * 100, 2)
