"""Refresh of single months in a stored batch."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.plans.batch import BatchOutput, put_results, stored_rollups
from tillstar.plans.fact import build_fact
from tillstar.plans.metrics import METRICS, run_metrics
from tillstar.schemas import FACT_NAME, Tables
from tillstar.shared import file_system
from tillstar.sinks import finish, put_fact, staged
from tillstar.sinks.commit import PARTS
from tillstar.sources import load_tables

# Fixed value: the folder name of a null partition value.
_NULL = "__HIVE_DEFAULT_PARTITION__"
Month = tuple[int | None, int | None]


def in_months(months: Iterable[Month]) -> Column:
    """Whether a fact row is of one of the months; (None, None) are orders without a date."""
    year, month = F.col("order_year"), F.col("order_month")
    found = F.lit(False)
    for y, m in months:
        found |= year.eqNullSafe(F.lit(y).cast("int")) & month.eqNullSafe(F.lit(m).cast("int"))
    return found


def _folder(month: Month) -> str:
    year, number = (_NULL if part is None else part for part in month)
    return f"order_year={year}/order_month={number}"


def _stored_fact(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    try:
        found = spark.read.parquet(path).columns
    except AnalysisException as error:
        raise ValueError(f"no stored fact to refresh at {path}") from error
    if found[-2:] != ["order_year", "order_month"]:
        raise ValueError(f"the fact at {path} is not laid out by month")
    return spark.read.schema(like.schema).parquet(path)


def refresh_months(
    spark: SparkSession,
    source: str | Tables,
    destination: str,
    months: Iterable[Month],
    source_fmt: str = "csv",
    names: Iterable[str] | None = None,
    sizes: Mapping[str, int] | None = None,
    fmt: str = "parquet",
    with_index: bool = False,
    **options,
) -> BatchOutput:
    """Bring the given months of a stored batch up to date, and all results with them.

    The destination holds a run of ``run_batch(..., fmt="parquet", by_month=True)``. Only
    orders of ``months`` pass the joins. Their folders of the fact table are replaced, those
    of months without rows by empty ones, and the results are derived anew from the stored
    fact, whose other months are read and not joined again. Folders and results take their
    places together: a run that dies before leaves the earlier output as it was. ``fmt``
    is that of the results; the fact is Parquet.

    An order that moved from one month to another needs both. Rows of other months keep
    what products and customers were called when they were written. No months is an
    error, and so is a destination without a fact by month.
    """
    months = list(dict.fromkeys(tuple(month) for month in months))
    if not months:
        raise ValueError("name at least one month")
    tables = load_tables(spark, source, source_fmt) if isinstance(source, str) else source
    names = list(METRICS) if names is None else list(names)
    destination = destination.rstrip("/")
    finish(spark, destination)
    path = f"{destination}/{FACT_NAME}_parquet"
    changed = build_fact(tables, **options).where(in_months(months))
    other = _stored_fact(spark, path, changed).where(~in_months(months))
    with staged(spark, destination) as place:
        new = put_fact(changed, f"{place}/{PARTS}", "parquet", by_month=True)
        for month in months:
            folder, files = file_system(spark, f"{new}/{_folder(month)}")
            files.mkdirs(folder)
        fact = other.unionByName(spark.read.schema(changed.schema).parquet(new))
        with stored_rollups(fact, names, place) as rollups:
            written = put_results(run_metrics(fact, names, rollups, sizes), place, fmt, with_index)
    results = {name: p.replace(place, destination, 1) for name, p in written.items()}
    return BatchOutput(fact=path, staged_fact=path, results=results)
