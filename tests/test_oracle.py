"""Every registered query against its SQL, on the given tables."""

import os

import pytest
from compare import connect, differences

import __spark_entry__ as registry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(registry.sales_queries()) == set(registry.sales_sql())


@pytest.mark.parametrize("name", list(registry.sales_queries()))
def test_query_agrees_with_sql(spark, con, name):
    df = registry.queries()[name](spark, SF_DIR)
    assert differences(df, con, registry.sales_sql()[name]) == []


def test_flagship(spark):
    assert registry.entry(spark).columns == [
        "category",
        "product_id",
        "product_name",
        "category_product_sales",
        "rank_in_category",
    ]


def test_totals_agree_across_results(spark):
    def total(name, column):
        df = registry.queries()[name](spark, SF_DIR)
        return df.selectExpr(f"sum(cast({column} as decimal(18,2)))").first()[0]

    grand = total("sales_by_date", "daily_total_sales")
    assert grand == total("sales_by_category", "category_total_sales")
    assert grand == total("sales_by_country", "country_total_sales")
    assert grand == total("monthly_sales", "monthly_sales")
    assert grand == total("quarterly_sales", "quarterly_sales")
    assert grand == total("order_totals", "order_total")
    last = registry.queries()["running_total_sales"](spark, SF_DIR).tail(1)[0]
    assert float(grand) == last.running_total_sales
