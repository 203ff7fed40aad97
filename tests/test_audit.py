import pytest
from conftest import plan, rows

from tillstar import build_fact
from tillstar.operators.audit import (
    cleaning_audit,
    profile_columns,
    profile_row_counts,
    profile_schema,
    sample,
)

D = "2023-01-05 10:00:00"


def tables(make):
    return make(
        [
            ("o1", "c1", D, 9.0, "completed"),
            ("o2", "c1", D, 9.0, "cancelled"),
            ("o3", "c1", D, 9.0, None),
            ("o4", "c1", D, 0.0, "pending"),
            ("o5", "c1", D, None, "pending"),
            ("o6", "ghost", D, 9.0, "pending"),
        ],
        [(f"o{i}", "p", 1, 1.0) for i in range(1, 7)]
        + [("o1", "q", 2, 1.0), ("o1", "p", None, 1.0), ("o1", "none", 1, 1.0)],
        products=[("p", "P", "x"), ("q", "Q", "x"), ("q", "Q2", "x")],
        customers=[("c1", "F", "L", "here")],
    )


def test_audit_counts_at_the_grain_of_each_step(make):
    assert rows(cleaning_audit(tables(make))) == [
        ("null_items", 9, 8, 1),
        ("not_an_amount", 8, 8, 0),
        ("cancelled_orders", 7, 5, 2),  # q repeats twice; the unknown customer is gone
        ("non_positive_totals", 5, 3, 2),
    ]


def test_audit_of_nothing(make):
    assert rows(cleaning_audit(make([("o", "c", D, 1.0, "a")], []))) == [
        ("null_items", 0, 0, 0),
        ("not_an_amount", 0, 0, 0),
        ("cancelled_orders", 0, 0, 0),
        ("non_positive_totals", 0, 0, 0),
    ]


def test_items_that_are_no_amounts_are_counted_and_named(make):
    odd = [("o1", "nan", 1, float("nan")), ("o1", "inf", 2, float("inf")), ("o1", "big", 1, 1e18)]
    t = make([("o1", "c", D, 9.0, "pending")], [("o1", "p", 1, 1.0), *odd])
    assert rows(cleaning_audit(t))[1] == ("not_an_amount", 4, 1, 3)
    for product, shown in (("nan", "1, NaN"), ("inf", "2, Infinity"), ("big", "1, 1.0E18")):
        only = t._replace(order_items=t.order_items.where(f"product_id = '{product}'"))
        with pytest.raises(Exception, match=f"not an amount of money: {shown}, o1, {product}"):
            build_fact(only).collect()


def test_row_counts_match_the_frames(make):
    t = tables(make)
    counts = dict(rows(profile_row_counts(t)))
    assert counts.pop("fact_table") == build_fact(t).count() == 3
    assert counts == {name: df.count() for name, df in t._asdict().items()}


def test_schema_profile(make):
    t = tables(make)
    schema = rows(profile_schema(t).filter("table_name = 'orders'").orderBy("position"))
    assert schema[3:] == [
        ("orders", 3, "total_amount", "double", True),
        ("orders", 4, "status", "string", True),
    ]
    counted = rows(profile_columns(t).filter("table_name = 'orders'").orderBy("position"))
    assert [(r[2], r[5]) for r in counted][3:] == [("total_amount", 5), ("status", 5)]
    assert profile_columns(t).count() == profile_schema(t).count() == 19


def test_sample(make):
    assert sample(tables(make).orders, 2).count() == 2
    orders = tables(make).orders
    assert sample(orders).count() == 5
    assert [r[0] for r in rows(sample(orders.orderBy("order_id", ascending=False), 2))] == ["o6", "o5"]


def test_counts_taken_while_the_fact_is_written(spark, make, tmp_path):
    from tillstar import build_fact, run_batch

    tables = _awkward(make)
    out = run_batch(spark, tables, str(tmp_path), fmt="parquet", names=["aov"], counted=True)
    assert sorted(rows(out.audit)) == sorted(rows(cleaning_audit(tables)))
    assert sorted(rows(out.row_counts)) == sorted(rows(profile_row_counts(tables)))
    back = spark.read.parquet(out.fact)
    assert sorted(map(repr, rows(back))) == sorted(map(repr, rows(build_fact(tables))))


def _awkward(make):
    """Null and cancelled statuses, missing and negative totals, null items, orphans,
    repeated products, orders and customers."""
    status = ["pending", None, "cancelled", " Cancelled ", "completed"]
    total = [5.0, None, 0.0, -1.0, 7.5, 2.5, 1.0]
    orders = [(f"o{k}", f"c{k % 4}", "2023-01-05 10:00:00", total[k % 7], status[k % 5]) for k in range(40)]
    orders += [orders[0], ("alone", "c1", None, 5.0, "pending"), (None, "c1", None, 5.0, "pending")]
    items = [
        (f"o{k % 45}", f"p{k % 6}", None if k % 11 == 0 else 2, None if k % 13 == 0 else 1.25)
        for k in range(200)
    ]
    products = [(f"p{k}", f"Name {k}", "Cat") for k in (0, 1, 2, 3, 3)]
    customers = [(f"c{k}", "F", "L", "Land") for k in (0, 1, 2, 2)]
    return make(orders, items, products, customers)


@pytest.mark.parametrize("options", [{"normalize_status_first": True}, {"null_totals": "zero"}])
def test_the_counted_fact_follows_the_options(spark, make, tmp_path, options):
    from tillstar import build_fact, run_batch

    tables = _awkward(make)
    out = run_batch(spark, tables, str(tmp_path), fmt="csv", names=["aov"], counted=True, keep_staged=True, **options)
    want = build_fact(tables, **options)
    assert sorted(map(repr, rows(spark.read.parquet(out.staged_fact)))) == sorted(map(repr, rows(want)))
    counts = {r.step: r.rows_out for r in out.audit.collect()}
    assert counts["non_positive_totals"] == want.count()


def test_counting_scans_each_table_once(spark, make):
    from tillstar.plans import CountedFact

    text = plan(CountedFact(_awkward(make)).fact)
    assert text.count("CollectMetrics") == 5 and text.count("Scan ExistingRDD") == 4


def test_no_task_holds_the_orders_of_all_items_it_scans(make, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    text = plan(cleaning_audit(_awkward(make)))
    assert "keys=[order_id" not in text and "SortMergeJoin [order_id" in text


def test_rejected_cells_of_csv_files(spark, tmp_path):
    from tillstar.operators.rejects import all_rejected_cells
    from tillstar.sources import load_raw_tables

    files = {
        "customers": "customer_id,first_name,last_name,email,country\nc1,a,b\nc2,a,b,c,d\n",
        "products": "product_id,product_name,category,brand\np1,a,b,c\np2,a,b,c,d,e\n",
        "orders": "order_id,customer_id,order_date,total_amount,status\n"
        "o1,c1,2023-01-05 10:00:00,5.5,pending\no2,c1,05.01.2023,1e3,x\no3,c1,,,\n"
        ',c1,2023-02-30 10:00:00,"1,5",x\n',
        "order_items": "order_item_id,order_id,product_id,quantity,price_per_unit\n"
        "i1,o1,p1,2,1.5\n,o1,p1,two,n/a\ni3,o1,p1,2.5,NaN\ni4,o1,p1,99999999999,1\n",
    }
    for name, text in files.items():
        (tmp_path / f"{name}.csv").write_text(text)
    got = all_rejected_cells(load_raw_tables(spark, str(tmp_path)))
    assert got.columns == ["table_name", "row_key", "column_name", "raw_text", "reason"]
    assert sorted(rows(got), key=repr) == sorted([
        ("customers", "c1", None, "c1,a,b", "wrong_length"),
        ("products", "p2", None, "p2,a,b,c,d,e", "wrong_length"),
        ("orders", "o2", "order_date", "05.01.2023", "not_a_date"),
        ("orders", None, "order_date", "2023-02-30 10:00:00", "not_a_date"),
        ("orders", None, "total_amount", "1,5", "not_a_number"),
        ("order_items", "o1", "quantity", "two", "not_an_integer"),
        ("order_items", "o1", "price_per_unit", "n/a", "not_a_number"),
        ("order_items", "i3", "quantity", "2.5", "not_an_integer"),
        ("order_items", "i4", "quantity", "99999999999", "not_an_integer"),
    ], key=repr)


def test_sample_by_hash_does_not_depend_on_partitions(spark):
    from tillstar.operators.audit import sample_by_hash

    df = spark.range(500).selectExpr("if(id % 50 = 0, null, id % 400) as k", "id as v")
    one = rows(sample_by_hash(df.coalesce(1), ["k"], 40))
    assert one == rows(sample_by_hash(df.repartition(9), ["k"], 40)) and len(one) == 40
    assert one != rows(sample_by_hash(df, ["k"], 40, seed="other"))
    parts = df.where("v < 200"), df.where("v >= 200")
    merged = sample_by_hash(parts[0], ["k"], 40).union(sample_by_hash(parts[1], ["k"], 40))
    assert one == rows(sample_by_hash(merged, ["k"], 40))


def test_order_value_on_the_bucketed_fact_needs_no_exchange_by_order(spark, make, tmp_path, conf):
    from tillstar import METRICS, build_fact
    from tillstar.sinks import write_bucketed_fact

    tables = _awkward(make)
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    fact = write_bucketed_fact(build_fact(tables), "fact_by_order", f"{tmp_path}/bucketed", buckets=4)
    assert sorted(map(repr, rows(fact))) == sorted(map(repr, rows(build_fact(tables))))
    assert rows(METRICS["aov"](fact)) == rows(METRICS["aov"](build_fact(tables)))
    assert "hashpartitioning" not in plan(METRICS["aov"](fact))
    spark.sql("DROP TABLE fact_by_order")


def test_a_larger_bucketed_fact_has_more_buckets(spark, make, tmp_path, monkeypatch):
    from tillstar import METRICS, build_fact
    from tillstar.sinks import bucketed

    monkeypatch.setattr(bucketed, "BUCKET_ROWS", 10)
    tables, want = _awkward(make), {}
    for rows_, buckets in ((None, 4), (40, 4), (41, 5), (200, 20)):
        name, path = f"fact_of_{rows_}", f"{tmp_path}/{rows_}"
        fact = bucketed.write_bucketed_fact(build_fact(tables), name, path, buckets=4, rows=rows_)
        want[rows_] = sorted(map(repr, rows(fact))), rows(METRICS["aov"](fact))
        described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
        assert described["Num Buckets"] == str(buckets)
        spark.sql(f"DROP TABLE {name}")
    assert all(found == want[None] for found in want.values())
