"""Writers. Executors write the files; no rows pass through the driver.

Every table becomes a directory ``<name>_<format>`` below the destination and replaces
an earlier one, which stays readable until the new one is complete.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from tillstar.operators.aggregates import sort_columns
from tillstar.operators.ranges import with_row_index
from tillstar.schemas import CSV_OPTIONS, FACT_NAME
from tillstar.shared import scratch
from tillstar.sinks.commit import staged

_FORMATS = ("csv", "parquet")


def _as_text(df: DataFrame) -> DataFrame:
    """Timestamps as text, with fractions of a second where there are any: a format of
    the writer would cut or pad them."""
    times = [
        f.name for f in df.schema.fields if isinstance(f.dataType, (TimestampType, TimestampNTZType))
    ]
    return df.withColumns({c: F.col(c).cast("string") for c in times})


def _write(df: DataFrame, destination: str, name: str, fmt: str, partition_by=()) -> str:
    if fmt not in _FORMATS:
        raise ValueError(f"unknown sink format {fmt!r}; use one of {list(_FORMATS)}")
    path = f"{destination.rstrip('/')}/{name}_{fmt}"
    writer = (_as_text(df) if fmt == "csv" else df).write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.options(**CSV_OPTIONS).csv(path)
    else:
        writer.parquet(path)
    return path


def _replace(df: DataFrame, destination: str, write) -> str:
    with staged(df.sparkSession, destination) as place:
        path = write(place)
    return path.replace(place, destination.rstrip("/"), 1)


def write_fact(fact: DataFrame, destination: str, fmt: str = "csv", by_month: bool = False) -> str:
    """Write the fact table in parallel, as many files as it has partitions.

    ``by_month`` lays it out in a directory per year and month. Rows are first brought
    together by month, in partitions that adaptive execution evens out: small months
    share a task and a month that holds most of the sales is split over many.
    """
    return _replace(fact, destination, lambda place: put_fact(fact, place, fmt, by_month))


def put_fact(fact: DataFrame, place: str, fmt: str = "csv", by_month: bool = False) -> str:
    """The same into a folder of its own, which holds no table of that name."""
    layout = ()
    if by_month:
        layout = ("order_year", "order_month")
        fact = fact.hint("rebalance", *[F.col(c) for c in layout])
    return _write(fact, place, FACT_NAME, fmt, layout)


def write_result(
    result: DataFrame,
    name: str,
    destination: str,
    fmt: str = "csv",
    order=(),
    with_index: bool = False,
    cents: Sequence[str] = (),
) -> str:
    """Write one result in the given order ``[(column, way), ...]``.

    Files follow each other in that order. Adaptive execution merges the partitions of a
    small result, which then is one file; a large one is sorted and written in parallel.
    ``with_index`` adds a 0-based first column ``row_index``, counted by ranges of the
    order. ``cents`` names doubles that have two places, such as amounts of money: CSV
    shows them as plain digits. Other values are written as they are.
    """
    options = dict(fmt=fmt, order=order, with_index=with_index, cents=cents)
    return _replace(result, destination, lambda place: put_result(result, name, place, **options))


def put_result(
    result: DataFrame,
    name: str,
    place: str,
    fmt: str = "csv",
    order=(),
    with_index: bool = False,
    cents: Sequence[str] = (),
) -> str:
    """The same into a folder of its own, which holds no table of that name."""
    keys = sort_columns(order)
    with scratch(result.sparkSession):
        if with_index:
            result = with_row_index(result, keys)
            keys = [F.col("row_index")]
        if keys:
            result = result.orderBy(*keys)
        if fmt == "csv":
            result = result.withColumns({c: F.col(c).cast("decimal(38,2)") for c in cents})
        return _write(result, place, name, fmt)
