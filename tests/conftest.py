import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tillstar-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tillstar-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set SQL settings for one test."""
    saved = {}

    def set_conf(**settings):
        for key, value in settings.items():
            key = key.replace("__", ".")
            saved.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield set_conf
    for key, value in saved.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.fixture
def make(spark):
    """Build the contract tables from short literal rows."""
    from tillstar.schemas import CUSTOMERS, ORDER_ITEMS, ORDERS, PRODUCTS, Tables

    def build(orders, items, products=None, customers=None):
        """orders: (id, customer, date, total, status); items: (order, product, qty, price);
        products: (id, name, category); customers: (id, first, last, country)."""
        if products is None:
            ids = sorted({i[1] for i in items if i[1] is not None})
            products = [(p, f"Name {p}", "Cat") for p in ids]
        if customers is None:
            ids = sorted({o[1] for o in orders if o[1] is not None})
            customers = [(c, f"First{c}", f"Last{c}", "Land") for c in ids]
        return Tables(
            customers=spark.createDataFrame(
                [(c, f, n, None, land) for c, f, n, land in customers], CUSTOMERS
            ),
            products=spark.createDataFrame([(p, n, c, "B") for p, n, c in products], PRODUCTS),
            orders=spark.createDataFrame(orders, ORDERS),
            order_items=spark.createDataFrame(
                [(f"i{k}", o, p, q, price) for k, (o, p, q, price) in enumerate(items)],
                ORDER_ITEMS,
            ),
        )

    return build


def rows(df):
    return [tuple(r) for r in df.collect()]


def plan(df) -> str:
    """The physical plan text."""
    import contextlib
    import io

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("extended")
    return out.getvalue().split("== Physical Plan ==")[1]
