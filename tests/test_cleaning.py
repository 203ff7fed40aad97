from datetime import datetime
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tillstar.functions import percent_change
from tillstar.operators import cleaning
from tillstar.schemas import ORDER_ITEMS, ORDERS


def orders(spark, *given):
    return spark.createDataFrame([(f"o{i}", "c", *o) for i, o in enumerate(given)], ORDERS)


def items(spark, *given):
    return spark.createDataFrame([(f"i{i}", "o", "p", *g) for i, g in enumerate(given)], ORDER_ITEMS)


def ids(df):
    return sorted(r[0] for r in df.select("order_id").collect())


D = "2023-01-05 10:00:00"


def test_null_items_are_dropped(spark):
    out = cleaning.drop_null_items(items(spark, (1, 2.0), (None, 2.0), (1, None), (None, None)))
    assert [r.order_item_id for r in out.collect()] == ["i0"]


def test_typing_turns_bad_text_into_null(spark):
    df = spark.createDataFrame([("2", "1.5"), ("x", "y"), (None, None)], "quantity string, price_per_unit string")
    typed = cleaning.type_items(df)
    assert typed.dtypes == [("quantity", "int"), ("price_per_unit", "double")]
    assert rows(typed) == [(2, 1.5), (None, None), (None, None)]


@pytest.mark.parametrize(
    "quantity, price, expected",
    [
        (1, 1.005, "1.01"),  # half-up on the decimal text, not on the binary value
        (1, 0.285, "0.29"),
        (3, 0.335, "1.01"),
        (-1, 1.005, "-1.01"),
        (2, 10.0, "20.00"),
        (0, 5.0, "0.00"),
    ],
)
def test_item_total_rounds_half_up_to_cents(spark, quantity, price, expected):
    out = cleaning.clean_items(items(spark, (quantity, price))).first()
    assert out.item_total == Decimal(expected)


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("price", [1e18, float("nan"), float("inf")])
def test_item_total_that_is_no_amount_fails_loudly(spark, conf, price, ansi):
    conf(spark__sql__ansi__enabled=ansi)
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|not an amount of money"):
        cleaning.clean_items(items(spark, (1, price))).collect()


def test_item_total_of_missing_values_is_missing(spark):
    out = cleaning.add_item_total(items(spark, (None, 1.0), (1, None)))
    assert [r.item_total for r in out.collect()] == [None, None]


def test_item_total_equals_round_then_cast(spark):
    df = spark.range(200_000).select(
        ((F.rand(7) * 1000).cast("decimal(10,3)").cast("double") * (1 + F.col("id") % 9)).alias("x")
    )
    differing = df.filter(F.round("x", 2).cast("decimal(18,2)") != F.col("x").cast("decimal(18,2)"))
    assert differing.count() == 0


def test_missing_status_is_dropped_and_padded_status_is_kept(spark):
    given = orders(spark, (D, 1.0, "completed"), (D, 1.0, None), (D, 1.0, "cancelled"), (D, 1.0, " Cancelled "))
    kept = cleaning.qualify_orders(given)
    assert [(r.order_id, r.status) for r in kept.collect()] == [("o0", "completed"), ("o3", "cancelled")]
    strict = cleaning.qualify_orders(given, normalize_status_first=True)
    assert ids(strict) == ["o0"]


def test_only_positive_totals_stay(spark):
    given = orders(spark, (D, 1.0, "a"), (D, 0.0, "a"), (D, -1.0, "a"), (D, None, "a"), (D, 0.01, "a"))
    assert ids(cleaning.keep_positive_totals(given)) == ["o0", "o4"]


def test_totals_can_be_filled(spark):
    filled = cleaning.fill_missing_totals(orders(spark, (D, None, "a"), (D, 2.0, "a")))
    assert [r.total_amount for r in filled.collect()] == [0.0, 2.0]
    with pytest.raises(ValueError):
        cleaning.qualify_orders(filled, null_totals="drop")


def test_bad_dates_become_null_and_rows_stay(spark):
    texts = [D, "2023-13-05 10:00:00", "junk", "2023-01-05", "2023-1-5 1:0:0", None]
    parsed = cleaning.parse_orders(orders(spark, *[(t, 1.0, "a") for t in texts]))
    assert parsed.schema["order_date"].dataType.typeName() == "timestamp"
    assert [r.order_date for r in parsed.collect()] == [datetime(2023, 1, 5, 10)] + [None] * 5


def test_lenient_dates_are_the_callers_choice(spark, conf):
    conf(spark__sql__legacy__timeParserPolicy="LEGACY")
    parsed = cleaning.parse_orders(orders(spark, ("2023-1-5 1:0:0", 1.0, "a")))
    assert parsed.first().order_date == datetime(2023, 1, 5, 1)


def test_calendar_columns_and_sunday_is_one(spark):
    out = cleaning.add_calendar(cleaning.parse_orders(orders(spark, ("2023-01-01 00:00:00", 1.0, "a"), ("2024-02-03 23:59:59", 1.0, "a"))))
    assert rows(out.select("order_year", "order_month", "order_day_of_week")) == [(2023, 1, 1), (2024, 2, 7)]


def test_only_spaces_are_trimmed(spark):
    df = spark.createDataFrame([("p", "  Big TOY ", "\tToys ", None)], "product_id string, product_name string, category string, brand string")
    assert rows(cleaning.standardize_products(df)) == [("p", "big toy", "\ttoys", None)]


def test_percent_change_of_zero_or_missing_is_null(spark):
    df = spark.createDataFrame([(5.0, 0.0), (5.0, None), (110.0, 100.0), (1.0, 3.0)], "c double, p double")
    out = df.select(percent_change(F.col("c"), F.col("p")))
    assert [r[0] for r in out.collect()] == [None, None, 10.0, -66.67]
