"""The whole batch: load, clean, join, analyse, store."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from tillstar.plans.counted import CountedFact
from tillstar.plans.fact import build_fact
from tillstar.plans.metrics import METRICS, run_metrics
from tillstar.plans.rollups import rollup_fact
from tillstar.schemas import FACT_NAME, Tables
from tillstar.sinks import put_fact, put_result, remove_path, shared_path, staged
from tillstar.sources import load_tables

# Results written at a time: they are small, so that one alone leaves a cluster idle.
_AT_ONCE = 4
# Below this folder of a run lie the rollups while results are derived from them.
_ROLLUPS = "_rollups"


def put_results(
    results: Mapping[str, DataFrame], place: str, fmt: str = "csv", with_index: bool = False
) -> dict[str, str]:
    """Write each result under its name, in its registered order; returns the paths."""

    def one(name: str) -> str:
        metric = METRICS.get(name)
        return put_result(
            results[name],
            name,
            place,
            fmt,
            order=metric.order if metric else (),
            with_index=with_index,
            cents=metric.cents if metric else (),
        )

    with ThreadPoolExecutor(_AT_ONCE) as pool:
        return dict(zip(results, pool.map(one, results)))


@contextmanager
def stored_rollups(
    fact: DataFrame, names: Iterable[str], place: str
) -> Iterator[dict[str, DataFrame]]:
    """The rollups of a stored fact that several of the results share, by grain. They are
    written once, below a folder of ``place`` that goes at the end of the block: files hold
    as much as a task should read, where a cached rollup keeps every shuffle partition, and
    each result would deal all of these out again."""
    grains = [METRICS[n].grain for n in names if n in METRICS]
    shared = [grain for grain in sorted(set(grains)) if grains.count(grain) > 1]
    spark, folder = fact.sparkSession, f"{place}/{_ROLLUPS}"

    def one(grain: str) -> DataFrame:
        rollup = rollup_fact(fact, grain)
        rollup.write.parquet(f"{folder}/{grain}")
        return spark.read.schema(rollup.schema).parquet(f"{folder}/{grain}")

    try:
        with ThreadPoolExecutor(_AT_ONCE) as pool:
            rollups = dict(zip(shared, pool.map(one, shared)))
        yield rollups
    finally:
        remove_path(spark, folder)


def write_outputs(
    fact: DataFrame,
    results: Mapping[str, DataFrame],
    destination: str,
    fmt: str = "csv",
    with_index: bool = False,
) -> dict[str, str]:
    """Write a fact table and results derived from it; returns the path of each by name.

    The fact is kept while they are written, so that a lazy one is joined once and not
    once per table. All tables take the places of earlier ones together, at the end.
    """
    fact = fact.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        with staged(fact.sparkSession, destination) as place:
            paths = {FACT_NAME: put_fact(fact, place, fmt)}
            paths |= put_results(results, place, fmt, with_index)
    finally:
        fact.unpersist()
    return {name: _final(path, place, destination) for name, path in paths.items()}


def _final(path: str, place: str, destination: str) -> str:
    return path.replace(place, destination.rstrip("/"), 1)


@dataclass(frozen=True)
class BatchOutput:
    """Where a run put its tables. ``staged_fact`` is the columnar fact the results were
    computed from: the sink itself for Parquet, a staged copy for CSV if it was kept.
    ``audit`` and ``row_counts`` are there if the run counted."""

    fact: str
    staged_fact: str | None
    results: dict[str, str]
    audit: DataFrame | None = None
    row_counts: DataFrame | None = None


def run_batch(
    spark: SparkSession,
    source: str | Tables,
    destination: str,
    source_fmt: str = "csv",
    fmt: str = "csv",
    by_month: bool = False,
    names: Iterable[str] | None = None,
    sizes: Mapping[str, int] | None = None,
    with_index: bool = False,
    keep_staged: bool = False,
    counted: bool = False,
    **options,
) -> BatchOutput:
    """Evaluate the join once, store the fact table, and derive every result from it.

    ``names`` chooses results, ``sizes`` sets list lengths and the ranking depth,
    ``with_index`` adds the row index, and further options go to ``build_fact``.

    The fact is written as Parquet first, which ends its lineage: a lost executor costs
    a re-read of stored columns and not a second join. With CSV output that copy lies in
    the shared folder and is removed at the end, unless ``keep_staged``. Results read
    from it only the columns of their grain, through rollups that are computed once and
    stored while the results are written. Errors propagate.

    Tables are written to a hidden folder of the destination and take the places of
    earlier ones together, after the last job: a run that dies before leaves the earlier
    output readable. ``counted`` adds the cleaning audit and the row counts, taken while
    the fact is written; cancelled orders and those without a total then pass the joins
    and are dropped after them.
    """
    tables = load_tables(spark, source, source_fmt) if isinstance(source, str) else source
    names = list(METRICS) if names is None else list(names)
    counts = CountedFact(tables, **options) if counted else None
    joined = counts.fact if counts else build_fact(tables, **options)
    staging, copy = fmt != "parquet", None
    try:
        with staged(spark, destination) as place:
            if staging:
                copy = put_fact(joined, shared_path(spark, "fact"), "parquet")
                fact = spark.read.parquet(copy)
                fact_path = put_fact(fact, place, fmt, by_month)
            else:
                fact_path = put_fact(joined, place, fmt, by_month)
                fact = spark.read.parquet(fact_path)
            with stored_rollups(fact, names, place) as rollups:
                results = run_metrics(fact, names, rollups, sizes)
                paths = put_results(results, place, fmt, with_index)
    finally:
        if copy and not keep_staged:
            remove_path(spark, copy.rsplit("/", 1)[0])
    fact_path = _final(fact_path, place, destination)
    return BatchOutput(
        fact=fact_path,
        staged_fact=(copy if keep_staged else None) if staging else fact_path,
        results={name: _final(path, place, destination) for name, path in paths.items()},
        audit=counts.audit() if counts else None,
        row_counts=counts.row_counts() if counts else None,
    )
