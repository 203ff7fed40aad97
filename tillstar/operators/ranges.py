"""Window results over one long order, without a task that holds all of it.

Rows are dealt into ranges of the order and stored, so that their ranges are settled. What
a row needs to know of earlier ranges is then a few values per range: how many rows they
have, what these sum up to, which row was the last. Those are carried on over the ranges,
of which there are as many as the job has partitions, and meet the rows of each range.

Each function stores its input in the shared folder, which runs a job when it is called;
``tillstar.shared.scratch`` removes it. Orders are ``[(column, "asc" | "desc"), ...]``,
nulls first when ascending and last when descending.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.operators.aggregates import sort_columns
from tillstar.shared import stored

RANGE = "__range"
_BEFORE = (Window.unboundedPreceding, -1)
_SO_FAR = (Window.unboundedPreceding, Window.currentRow)


def in_ranges(df: DataFrame, keys: Sequence[Column]) -> DataFrame:
    """The stored rows with the number of their range; a higher range holds later rows.

    Rows that tie are told apart by a hash of all their columns, so that very many equal
    keys are no single range. Adaptive execution merges small ranges.
    """
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    ranged = df.repartitionByRange(*keys, tie.asc())
    return stored(ranged.withColumn(RANGE, F.spark_partition_id()), "ranges")


def _meet(rows: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join one row per key to the rows; null keys meet as well."""
    other = other.withColumnsRenamed({k: f"__its_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"__its_{k}")) for k in keys]
    return rows.join(other, same, "left").drop(*[f"__its_{k}" for k in keys])


def with_row_index(result: DataFrame, keys: Sequence[Column], name: str = "row_index") -> DataFrame:
    """Prefix a 0-based position in the given order; without keys, in any order.

    Rows per range are counted and summed up over the ranges; within a range its rows are
    numbered.
    """
    rows = in_ranges(result, keys)
    up_to = Window.orderBy(RANGE).rowsBetween(*_BEFORE)
    counts = rows.groupBy(RANGE).agg(F.count(F.lit(1)).alias("__n"))
    before = counts.select(RANGE, F.coalesce(F.sum("__n").over(up_to), F.lit(0)).alias("__before"))
    inside = Window.partitionBy(RANGE).orderBy(*(keys or [F.lit(0)]))
    numbered = _meet(rows, before, [RANGE])
    position = F.col("__before") + F.row_number().over(inside) - 1
    return numbered.select(position.cast("int").alias(name), *result.columns)


def running_sum(
    df: DataFrame, order, measure: str, into: str, by: Sequence[str] = ()
) -> DataFrame:
    """Add the sum of ``measure`` up to and with each row, within each group ``by``.

    Nulls add nothing; the sum is null before the first value. The order should be of
    unique keys: of rows that tie any may come first.
    """
    keys = sort_columns(order)
    rows = in_ranges(df, [*sort_columns([(c, "asc") for c in by]), *keys])
    sums = rows.groupBy(*by, RANGE).agg(F.sum(measure).alias("__sum"))
    up_to = Window.partitionBy(*by).orderBy(RANGE).rowsBetween(*_BEFORE)
    before = sums.select(*by, RANGE, F.sum("__sum").over(up_to).alias("__before"))
    inside = Window.partitionBy(*by, RANGE).orderBy(*keys).rowsBetween(*_SO_FAR)
    own, earlier = F.sum(measure).over(inside), F.col("__before")
    out = _meet(rows, before, [*by, RANGE]).withColumn(into, F.coalesce(own + earlier, own, earlier))
    return out.select(*[c for c in df.columns if c != into], into)


def lag_in_order(
    df: DataFrame, order, value: str, into: str, by: Sequence[str] = ()
) -> DataFrame:
    """Add the value of the row before, within each group ``by``; null for the first.

    The last row of each range is handed to the next range that has rows of its group.
    """
    keys = sort_columns(order)
    rows = in_ranges(df, [*sort_columns([(c, "asc") for c in by]), *keys])
    inside = Window.partitionBy(*by, RANGE).orderBy(*keys)
    last = rows.withColumn("__more", F.lead(F.lit(True)).over(inside)).where("__more is null")
    over_ranges = Window.partitionBy(*by).orderBy(RANGE)
    carried = last.select(*by, RANGE, F.lag(value).over(over_ranges).alias("__carried"))
    out = _meet(rows, carried, [*by, RANGE])
    first = F.row_number().over(inside) == 1
    before = F.when(first, F.col("__carried")).otherwise(F.lag(value).over(inside))
    return out.withColumn(into, before).select(*[c for c in df.columns if c != into], into)


def ranked_by_counting(
    df: DataFrame, by: Sequence[str], measure: str, into: str, depth: int
) -> DataFrame:
    """Rows ranked by ``measure``, largest first, within each group; ranks 1..depth, ties
    share a rank and are all kept.

    A rank is one more than the number of rows above. Rows are counted per value, which
    takes ties together in the tasks that read them; the counts are summed up over ranges
    of the values, and only values of a sufficient rank meet the rows again.
    """
    df = stored(df, "to-rank")
    keys = [*by, measure]
    values = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    counted = running_sum(values, [(measure, "desc")], "__rows", "__up_to", by)
    rank = (F.col("__up_to") - F.col("__rows") + 1).cast("int")
    ranks = counted.select(*keys, rank.alias(into)).where(F.col(into) <= depth)
    ranks = ranks.withColumnsRenamed({k: f"__its_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"__its_{k}")) for k in keys]
    return df.join(ranks, same).select(*[c for c in df.columns if c != into], into)
