"""The registry of sales results.

A result is data: the grain that carries its columns, its keys, the name of its
measure, its order and, for top lists, its length. The average order value and the
window results add one operator on top of such totals.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tillstar.functions import as_double
from tillstar.operators.aggregates import average_order_value, sort_columns, totals
from tillstar.operators.windows import month_over_month, running_total, top_per_category
from tillstar.plans.rollups import FROM_TABLES
from tillstar.schemas import Tables

# Default lengths of the top lists and of the ranking.
TOP_N = 10
RANK_DEPTH = 3


@dataclass(frozen=True)
class Metric:
    """One result table. ``size`` is the default list length or ranking depth;
    ``finish`` turns the exact totals into the result (default: emit as double)."""

    grain: str
    keys: Mapping[str, str]
    measure: str
    order: tuple[tuple[str, str], ...] = ()
    limit: int | None = None
    depth: int | None = None
    finish: Callable[..., DataFrame] | None = None
    more_cents: tuple[str, ...] = ()

    @property
    def cents(self) -> tuple[str, ...]:
        """The result's doubles: amounts and percents, all with two places."""
        own = () if self.finish is average_order_value else (self.measure,)
        return own + self.more_cents

    def rows(
        self, frame: DataFrame, size: int | None = None, spread: bool = False
    ) -> DataFrame:
        """The result rows, in no particular order unless it is a top list; ``spread`` as
        for ``totals``."""
        sums = totals(frame, self.keys, self.measure, spread)
        if self.depth is not None:
            return self.finish(sums, self.depth if size is None else size)
        if self.finish is not None:
            return self.finish(sums)
        if self.limit is not None:  # by the exact total: doubles tie above 9e13
            n = self.limit if size is None else size
            sums = sums.orderBy(*sort_columns(self.order)).limit(n)
        return as_double(sums, self.measure)

    def __call__(
        self, frame: DataFrame, size: int | None = None, spread: bool = False
    ) -> DataFrame:
        """The result in presentation order, from a fact table or a rollup."""
        out = self.rows(frame, size, spread)
        if self.limit is not None or not self.order:
            return out
        return out.orderBy(*sort_columns(self.order))


_MONTH = {"order_year": "year(order_date)", "order_month": "month(order_date)"}
_PRODUCT = {"product_id": "product_id", "product_name": "product_name"}

# Top lists end their order with ids, so that ties are resolved the same way each run.
METRICS: dict[str, Metric] = {
    "sales_by_date": Metric(
        grain="day",
        keys={"sale_date": "to_date(order_date)"},
        measure="daily_total_sales",
        order=(("sale_date", "asc"),),
    ),
    "sales_by_category": Metric(
        grain="product",
        keys={"category": "category"},
        measure="category_total_sales",
        order=(("category_total_sales", "desc"), ("category", "asc")),
    ),
    "top_n_products": Metric(
        grain="product",
        keys=_PRODUCT,
        measure="product_total_sales",
        order=(("product_total_sales", "desc"), ("product_id", "asc"), ("product_name", "asc")),
        limit=TOP_N,
    ),
    "top_n_customers": Metric(
        grain="customer",
        keys={
            "customer_id": "customer_id",
            "first_name": "first_name",
            "last_name": "last_name",
        },
        measure="customer_total_spent",
        order=(
            ("customer_total_spent", "desc"),
            ("customer_id", "asc"),
            ("first_name", "asc"),
            ("last_name", "asc"),
        ),
        limit=TOP_N,
    ),
    "monthly_sales": Metric(
        grain="day",
        keys=_MONTH,
        measure="monthly_sales",
        order=(("order_year", "asc"), ("order_month", "asc")),
    ),
    "aov": Metric(
        grain="order",
        keys={"order_id": "order_id"},
        measure="order_total",
        finish=average_order_value,
        more_cents=("average_order_value",),
    ),
    "sales_by_country": Metric(
        grain="customer",
        keys={"country": "country"},
        measure="country_total_sales",
        order=(("country_total_sales", "desc"), ("country", "asc")),
    ),
    "running_total_sales": Metric(
        grain="day",
        keys={"sale_date": "to_date(order_date)"},
        measure="daily_sales",
        order=(("sale_date", "asc"),),
        finish=running_total,
        more_cents=("running_total_sales",),
    ),
    "ranked_products_in_category": Metric(
        grain="product",
        keys={"category": "category", **_PRODUCT},
        measure="category_product_sales",
        order=(("category", "asc"), ("rank_in_category", "asc"), ("product_id", "asc")),
        depth=RANK_DEPTH,
        finish=top_per_category,
    ),
    "monthly_sales_with_lag": Metric(
        grain="day",
        keys=_MONTH,
        measure="monthly_sales",
        order=(("order_year", "asc"), ("order_month", "asc")),
        finish=month_over_month,
        more_cents=("prev_month_sales", "mom_growth_percent"),
    ),
    "quarterly_sales": Metric(
        grain="day",
        keys={"order_year": "year(order_date)", "order_quarter": "quarter(order_date)"},
        measure="quarterly_sales",
        order=(("order_year", "asc"), ("order_quarter", "asc")),
    ),
}


def _select(names: Iterable[str] | None) -> list[str]:
    chosen = list(METRICS) if names is None else list(names)
    unknown = [n for n in chosen if n not in METRICS]
    if unknown:
        raise ValueError(f"unknown results {unknown}; known: {list(METRICS)}")
    return chosen


def run_metrics(
    fact: DataFrame,
    names: Iterable[str] | None = None,
    rollups: Mapping[str, DataFrame] | None = None,
    sizes: Mapping[str, int] | None = None,
    by_order: bool = False,
) -> dict[str, DataFrame]:
    """Lazy result tables over a fact table, by name (all of them by default).

    ``rollups`` maps a grain to a ready rollup of the same fact, which the results of
    that grain then share; ``sizes`` overrides list lengths and the ranking depth.

    The fact may be the lazy join itself, whose last step is by order: sums per order are
    spread, so that a hot order, product or customer is split in every join. ``by_order``
    says that the fact is stored by order (``write_bucketed_fact``) and nothing has to be.
    """
    rollups, sizes = rollups or {}, sizes or {}

    def result(name: str) -> DataFrame:
        metric = METRICS[name]
        spread = metric.grain == "order" and "order" not in rollups and not by_order
        return metric(rollups.get(metric.grain, fact), sizes.get(name), spread)

    return {name: result(name) for name in _select(names)}


def metric_from_tables(
    tables: Tables, name: str, size: int | None = None, **options
) -> DataFrame:
    """One result straight from the four tables, through the rollup of its grain."""
    metric = METRICS[_select([name])[0]]
    return metric(FROM_TABLES[metric.grain](tables, **options), size)
