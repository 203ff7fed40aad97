"""The physical plans: what reaches the scans, what is shuffled, how skew is met."""

import re
from pathlib import Path

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

import __spark_entry__ as registry
from tillstar import (
    METRICS,
    Tables,
    build_fact,
    load_tables,
    metric_from_tables,
    run_metrics,
    star_tables,
)
from tillstar.operators.audit import cleaning_audit, profile_row_counts, step_counts
from tillstar.plans import rollup_fact
from tillstar.schemas import CUSTOMERS, ORDER_ITEMS, ORDERS, PRODUCTS

SF_DIR = "/root/testdata/sf0.001"
LAZY = [n for n in registry.sales_queries() if not n.startswith(("sink_", "stored_", "fact_from_csv", "batch_", "dirty_batch_"))]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Empty Parquet tables with the declared schemas: enough to plan on."""
    root = str(tmp_path_factory.mktemp("tables"))
    for name, schema in {
        "customers": CUSTOMERS,
        "products": PRODUCTS,
        "orders": ORDERS,
        "order_items": ORDER_ITEMS,
    }.items():
        spark.createDataFrame([], schema).write.parquet(f"{root}/{name}.parquet")
    return load_tables(spark, root, "parquet")


def scans(text):
    """{table: (pushed filters, read columns)} of the scans in a plan."""
    out = {}
    for line in text.splitlines():
        if "FileScan parquet" in line:
            table = re.search(r"/(\w+)\.parquet", line).group(1)
            pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", line).group(1)
            columns = set(re.findall(r"(\w+):", line.split("ReadSchema: ")[1]))
            out[table] = (pushed, columns)
    return out


@pytest.fixture
def long_plans(conf):
    conf(spark__sql__maxMetadataStringLength="10000", spark__sql__debug__maxToStringFields="100")


def test_filters_and_columns_reach_the_scans(stored, long_plans):
    found = scans(plan(metric_from_tables(stored, "sales_by_date")))
    items, item_columns = found["order_items"]
    assert "IsNotNull(quantity)" in items and "IsNotNull(price_per_unit)" in items
    assert item_columns == {"order_id", "product_id", "quantity", "price_per_unit"}
    orders, order_columns = found["orders"]
    assert "Not(EqualTo(status,cancelled))" in orders
    assert "GreaterThan(total_amount,0.0)" in orders
    assert order_columns == {"order_id", "customer_id", "order_date", "total_amount", "status"}
    assert found["products"][1] == {"product_id"}
    assert found["customers"][1] == {"customer_id"}


def test_results_read_only_the_dimension_columns_they_show(stored, long_plans):
    found = scans(plan(metric_from_tables(stored, "sales_by_category")))
    assert found["products"][1] == {"product_id", "category"}
    assert found["customers"][1] == {"customer_id"}
    assert "order_date" not in found["orders"][1]
    found = scans(plan(metric_from_tables(stored, "sales_by_country")))
    assert found["customers"][1] == {"customer_id", "country"}
    assert found["products"][1] == {"product_id"}


def test_top_lists_and_rankings_are_cut_before_they_are_moved(stored):
    for name in ("top_n_products", "top_n_customers"):
        assert "TakeOrderedAndProject" in plan(metric_from_tables(stored, name))
    ranked = plan(metric_from_tables(stored, "ranked_products_in_category"))
    assert re.search(r"WindowGroupLimit .*Final[\s\S]*Exchange[\s\S]*WindowGroupLimit .*Partial", ranked)


def test_a_ranking_is_cut_early_or_counted(stored, conf):
    setting = "spark.sql.optimizer.windowGroupLimitThreshold"
    counted = plan(metric_from_tables(stored, "ranked_products_in_category", size=1001))
    assert "rank(" not in counted and "__range" in counted
    conf(**{setting.replace(".", "__"): "1001"})
    ranked = plan(metric_from_tables(stored, "ranked_products_in_category", size=1001))
    assert re.search(r"WindowGroupLimit .*Final[\s\S]*Exchange[\s\S]*WindowGroupLimit .*Partial", ranked)


def test_audit_and_counts_scan_the_items_once(stored):
    for build in (cleaning_audit, profile_row_counts):
        assert plan(build(stored)).count("order_items.parquet") == 1


def exchanges(text, key):
    return len(re.findall(rf"Exchange hashpartitioning\({key}#", text))


def test_aggregates_share_the_partitioning_of_their_joins(stored, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    value = plan(metric_from_tables(stored, "aov"))
    assert exchanges(value, "order_id") == 2  # the orders and the summed items, nothing after
    customers = plan(metric_from_tables(stored, "top_n_customers"))
    assert exchanges(customers, "customer_id") == 2  # summed sales and the customers
    products = plan(metric_from_tables(stored, "top_n_products"))
    assert exchanges(products, "product_id") == 2
    fact = plan(build_fact(stored))
    assert exchanges(fact, "customer_id") == exchanges(fact, "order_id") == 2
    assert exchanges(fact, "product_id") == 2


def test_growth_is_sorted_once(stored):
    text = plan(metric_from_tables(stored, "monthly_sales_with_lag"))
    assert "rangepartitioning" not in text
    assert text.count("Exchange SinglePartition") == 1


@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_no_query_needs_a_cross_join_python_or_a_forced_broadcast(spark, conf, broadcast):
    conf(spark__sql__autoBroadcastJoinThreshold=broadcast)
    for name in LAZY:
        text = plan(registry.sales_queries()[name](spark, SF_DIR))
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
            assert bad not in text, (name, bad)
        if broadcast == "-1":
            assert "BroadcastExchange" not in text, name


def test_no_hints_collects_or_local_checkpoints_in_the_library():
    for path in (Path(registry.__file__).parent / "tillstar").rglob("*.py"):
        if "llm" in path.parts:  # has tests of its own
            continue
        source = path.read_text()
        for word in ("broadcast(", ".collect(", "toPandas", "localCheckpoint", "crossJoin", ".rdd"):
            assert word not in source, (path, word)


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """A third of the items in one order and a third in one product; a third of the
    orders by one customer; a third of the products in one category."""
    n = F.col("id")
    root = str(tmp_path_factory.mktemp("skewed"))

    def hot(bucket, column):
        return F.when(n % 3 == bucket, F.lit(0)).otherwise(column).cast("string")

    tables = Tables(
        customers=spark.range(500).select(
            n.cast("string").alias("customer_id"), F.concat(F.lit("F"), n).alias("first_name"),
            F.lit("L").alias("last_name"), F.lit("e").alias("email"),
            F.concat(F.lit("Land"), n % 7).alias("country"),
        ),
        products=spark.range(400).select(
            n.cast("string").alias("product_id"), F.concat(F.lit("P"), n).alias("product_name"),
            F.when(n % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), n % 5)).alias("category"),
            F.lit("b").alias("brand"),
        ),
        orders=spark.range(20_000).select(
            n.cast("string").alias("order_id"), hot(1, n % 500).alias("customer_id"),
            F.expr("'2023-01-05 10:00:00'").alias("order_date"), F.lit(5.0).alias("total_amount"),
            F.lit("pending").alias("status"),
        ),
        order_items=spark.range(200_000).select(
            n.cast("string").alias("order_item_id"), hot(0, n % 20_000).alias("order_id"),
            hot(1, n % 400).alias("product_id"), (n % 4).cast("int").alias("quantity"),
            ((n % 997) / 100).alias("price_per_unit"),
        ),
    )
    for name, df in tables._asdict().items():
        df.repartition(6).write.parquet(f"{root}/{name}.parquet")
    return load_tables(spark, root, "parquet")


@pytest.fixture
def split_small_partitions(conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="16",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="8k",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    )


def test_hot_keys_of_the_fact_joins_are_split(spark, skewed, split_small_partitions):
    fact = build_fact(skewed)
    fact.cache()
    try:
        assert fact.count() == 200_000
        final = fact._jdf.queryExecution().executedPlan().toString()
        final = final.split("Initial Plan")[0]
        for key in ("product_id", "order_id", "customer_id"):
            assert re.search(rf"SortMergeJoin\(skew=true\) \[{key}#", final), key
    finally:
        fact.unpersist()


@pytest.mark.parametrize("name", METRICS)
def test_hot_keys_are_split_for_every_result_over_the_join(skewed, split_small_partitions, name):
    result = run_metrics(build_fact(skewed), [name])[name].cache()
    try:
        found = rows(result)
        final = result._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        for key in ("product_id", "order_id", "customer_id"):
            assert re.search(rf"SortMergeJoin\(skew=true\) \[{key}#", final), key
        assert found == rows(metric_from_tables(skewed, name))
    finally:
        result.unpersist()


def test_sums_per_order_are_spread_unless_the_fact_is_stored_by_order(stored, skewed, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    fact = build_fact(stored)
    spread = plan(run_metrics(fact, ["aov"])["aov"])
    there = plan(run_metrics(fact, ["aov"], by_order=True)["aov"])
    assert spread.count("Exchange hashpartitioning") == there.count("Exchange hashpartitioning") + 1
    both = [rollup_fact(build_fact(skewed), "order", spread) for spread in (False, True)]
    assert both[0].columns == both[1].columns == ["order_id", "item_total"]
    assert both[0].exceptAll(both[1]).isEmpty() and both[1].exceptAll(both[0]).isEmpty()


def test_a_hot_product_of_the_audit_is_split(skewed, split_small_partitions):
    counts = step_counts(skewed).cache()
    try:
        assert counts.first()["items"] == 200_000
        final = counts._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert re.search(r"SortMergeJoin\(skew=true\) \[product_id#", final)
    finally:
        counts.unpersist()


def test_results_under_skew_equal_those_of_a_plain_sum(skewed, split_small_partitions):
    total = skewed.order_items.selectExpr(
        "sum(cast(quantity * price_per_unit as decimal(18,2)))"
    ).first()[0]
    for name in ("sales_by_category", "sales_by_country"):
        result = metric_from_tables(skewed, name)
        assert result.groupBy().sum(METRICS[name].measure).first()[0] == pytest.approx(float(total))
    assert rows(metric_from_tables(skewed, "sales_by_date"))[0][1] == float(total)
    top = metric_from_tables(skewed, "top_n_products").first()
    assert top.product_id == "0"
    assert rows(cleaning_audit(skewed)) == [
        ("null_items", 200_000, 200_000, 0),
        ("not_an_amount", 200_000, 200_000, 0),
        ("cancelled_orders", 200_000, 200_000, 0),
        ("non_positive_totals", 200_000, 200_000, 0),
    ]


def test_country_lookup_is_read_only_where_it_is_needed(spark, long_plans):
    tables = star_tables(spark, SF_DIR)
    assert "nation" not in scans(plan(metric_from_tables(tables, "sales_by_date")))
    assert "nation" in scans(plan(metric_from_tables(tables, "sales_by_country")))


def test_star_scans_do_not_infer_schemas(spark):
    before = spark.sparkContext.statusTracker().getJobIdsForGroup()
    star_tables(spark, SF_DIR)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup() == before
