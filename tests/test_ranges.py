"""Window results over ranges against the plain window functions."""

import pytest
from conftest import plan, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillstar.operators.aggregates import sort_columns
from tillstar.operators.ranges import (
    RANGE,
    in_ranges,
    lag_in_order,
    ranked_by_counting,
    running_sum,
    with_row_index,
)
from tillstar.operators.windows import top_per_category


@pytest.fixture
def many_ranges(conf):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false", spark__sql__shuffle__partitions="7")


@pytest.fixture(scope="module")
def sales(spark):
    """Half of the rows in one category, nulls in every column, ties in ``amount``."""
    return spark.range(3000).selectExpr(
        "if(id % 97 = 0, null, id * 7919 % 3001) as k",
        "case when id % 2 = 0 then 'hot' when id % 31 = 0 then null else concat('c', id % 5) end as category",
        "if(id % 41 = 0, null, cast(id % 113 as decimal(18,2))) as amount",
        "id as unique",
    )


ORDER = [("k", "asc"), ("unique", "desc")]


def _same(a, b):
    return sorted(map(repr, rows(a))) == sorted(map(repr, rows(b)))


def test_row_index(spark, sales, many_ranges):
    keys = sort_columns(ORDER)
    got = with_row_index(sales, keys)
    want = sales.select((F.row_number().over(Window.orderBy(*keys)) - 1).alias("row_index"), "*")
    assert got.columns == want.columns and got.dtypes[0] == ("row_index", "int") and _same(got, want)
    any_order = with_row_index(sales.select("category"), [])
    assert sorted(r.row_index for r in any_order.collect()) == list(range(3000))
    assert with_row_index(sales.limit(0), keys).count() == 0


def test_no_task_numbers_the_rows_of_all_ranges(spark, sales, many_ranges):
    text = plan(with_row_index(sales, sort_columns(ORDER)))
    # What meets in one partition are counts per range; the ranges are stored.
    assert text.count("Exchange SinglePartition") == 1 and "rangepartitioning" not in text
    below = text[text.index("Exchange SinglePartition") :].split("\n")[1]
    assert "HashAggregate" in below and "count(1)" in below


def test_equal_keys_are_dealt_over_ranges(spark, many_ranges):
    same = spark.range(7000).selectExpr("1 as k", "id as v")
    sizes = [r["count"] for r in in_ranges(same, [F.col("k").asc()]).groupBy(RANGE).count().collect()]
    assert len(sizes) == 7 and max(sizes) < 2 * 7000 / 7


@pytest.mark.parametrize("by", [(), ("category",)])
def test_running_sum_and_lag(spark, sales, many_ranges, by):
    keys = sort_columns(ORDER)
    inside = Window.partitionBy(*by).orderBy(*keys)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    got = running_sum(sales, ORDER, "amount", "total", by)
    want = sales.withColumn("total", F.sum("amount").over(so_far))
    assert _same(got, want)
    got = lag_in_order(sales, ORDER, "amount", "previous", by)
    assert _same(got, sales.withColumn("previous", F.lag("amount").over(inside)))


def test_lag_over_ranges_without_rows_of_the_group(spark, many_ranges):
    few = spark.createDataFrame([("a", 1, 10.0), ("b", 1, 20.0), ("a", 2, None), ("a", 3, 30.0)], "g string, k int, v double")
    got = lag_in_order(few, [("k", "asc")], "v", "before", ["g"])
    assert sorted(map(repr, rows(got))) == sorted(
        map(repr, [("a", 1, 10.0, None), ("a", 2, None, 10.0), ("a", 3, 30.0, None), ("b", 1, 20.0, None)])
    )


@pytest.mark.parametrize("depth", [1, 100, 2000])
def test_ranking_by_counting_equals_rank(spark, sales, many_ranges, depth):
    got = ranked_by_counting(sales, ["category"], "amount", "place", depth)
    best = Window.partitionBy("category").orderBy(F.col("amount").desc_nulls_last())
    want = sales.withColumn("place", F.rank().over(best)).where(F.col("place") <= depth)
    assert _same(got, want) and got.dtypes[-1] == ("place", "int")


def test_a_deep_ranking_is_dealt_evenly(spark, conf, tmp_path, many_ranges):
    """One category has nine of ten products: no task sorts it."""
    products = spark.range(200_000).selectExpr(
        "if(id % 10 = 0, concat('c', id % 7), 'hot') as category",
        "cast(id as string) as product_id", "concat('n', id) as product_name",
        "cast((id * 7919) % 199999 as decimal(28,2)) as category_product_sales",
    )
    got = top_per_category(products, 5000)
    best = Window.partitionBy("category").orderBy(F.col("category_product_sales").desc_nulls_last())
    want = products.withColumn("rank_in_category", F.rank().over(best)).where("rank_in_category <= 5000")
    want = want.withColumn("category_product_sales", F.col("category_product_sales").cast("double"))
    assert _same(got, want)
    values = products.groupBy("category", "category_product_sales").count()
    dealt = in_ranges(values, sort_columns([("category", "asc"), ("category_product_sales", "desc")]))
    sizes = sorted(r["count"] for r in dealt.groupBy(RANGE).count().collect())
    assert len(sizes) == 7 and sizes[-1] < 2 * sizes[0]
