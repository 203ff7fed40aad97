import glob
import inspect

import pytest
from conftest import plan, rows

import tillstar.plans.batch
import tillstar.sinks.writers
from tillstar import METRICS, build_fact, load_tables, run_batch, run_metrics, write_outputs
from tillstar.__main__ import main
from tillstar.schemas import CSV_OPTIONS
from tillstar.sinks import shared_path, write_fact, write_result

D = "2023-01-05 10:00:00"


@pytest.fixture
def tables(make):
    orders = [(f"o{i}", f"c{i % 3}", f"2023-0{1 + i % 4}-0{1 + i % 7} 08:30:00", 5.0, "pending") for i in range(20)]
    orders.append(("bad", "c1", "junk", 5.0, "pending"))
    items = [(o[0], f"p{k}", 1 + k, 10000000.0 if k == 3 else 1.25) for o in orders for k in range(4)]
    return make(orders, items)


def text(path):
    (file,) = glob.glob(f"{path}/*.csv")
    return open(file).read().splitlines()


def test_result_is_one_ordered_file_with_plain_money(spark, tables, tmp_path):
    metric = METRICS["sales_by_date"]
    path = write_result(
        metric(build_fact(tables)), "sales_by_date", str(tmp_path), order=metric.order, cents=metric.cents
    )
    lines = text(path)
    assert lines[0] == "sale_date,daily_total_sales"
    assert lines[1] == ",40000007.50"  # the unparsed date comes first
    assert lines[2:] == sorted(lines[2:]) and "E" not in "".join(lines[1:])


def test_small_results_are_one_file_each_and_large_ones_are_not(spark, conf, tmp_path):
    df = spark.range(0, 400_000, 1, 8).selectExpr("id as k", "cast(id % 1000 as double) as v")
    small = write_result(
        df.filter("k < 500"), "small", str(tmp_path), order=(("k", "desc"),), cents=["v"]
    )
    assert text(small)[1:] == [f"{k},{k}.00" for k in range(499, -1, -1)]
    conf(spark__sql__adaptive__advisoryPartitionSizeInBytes="1m")
    large = write_result(df, "large", str(tmp_path), order=(("k", "asc"),))
    files = sorted(glob.glob(f"{large}/*.csv"))
    keys = [int(line.split(",")[0]) for f in files for line in open(f).read().splitlines()[1:]]
    assert len(files) > 1 and keys == list(range(400_000))


def test_index_column(spark, tables, tmp_path):
    metric = METRICS["sales_by_country"]
    path = write_result(metric(build_fact(tables)), "r", str(tmp_path), order=metric.order, with_index=True, cents=metric.cents)
    assert text(path) == ["row_index,country,country_total_sales", "0,land,840000157.50"]


def test_outputs_replace_earlier_ones_and_read_back(spark, tables, tmp_path):
    fact = build_fact(tables)
    results = run_metrics(fact, ["aov", "monthly_sales"])
    for _ in range(2):
        paths = write_outputs(fact, results, str(tmp_path))
    assert sorted(paths) == ["aov", "fact_table", "monthly_sales"]
    back = spark.read.schema(fact.schema).option("header", True).csv(paths["fact_table"])
    assert sorted(map(repr, rows(back))) == sorted(map(repr, rows(fact)))
    monthly = spark.read.schema(results["monthly_sales"].schema).option("header", True).csv(paths["monthly_sales"])
    assert rows(monthly) == rows(results["monthly_sales"])


def test_fact_by_month(spark, tables, tmp_path):
    fact = build_fact(tables)
    path = write_fact(fact, str(tmp_path), "parquet", by_month=True)
    assert glob.glob(f"{path}/order_year=2023/order_month=2/*.parquet")
    back = spark.read.parquet(path).select(*fact.columns)
    assert sorted(map(repr, rows(back))) == sorted(map(repr, rows(fact)))
    pruned = back.filter("order_year = 2023 and order_month = 2")
    assert pruned.count() == fact.filter("order_year = 2023 and order_month = 2").count() > 0


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_batch_stores_every_result(spark, tables, tmp_path, fmt):
    out = run_batch(spark, tables, str(tmp_path / "out"), fmt=fmt)
    expected = run_metrics(build_fact(tables))
    assert list(out.results) == list(METRICS)
    for name, path in out.results.items():
        reader = spark.read.schema(expected[name].schema)
        stored = reader.parquet(path) if fmt == "parquet" else reader.option("header", True).csv(path)
        assert rows(stored) == rows(expected[name]), name
    assert out.staged_fact == (out.fact if fmt == "parquet" else None)


def test_batch_by_month(spark, tables, tmp_path):
    out = run_batch(spark, tables, str(tmp_path), fmt="parquet", by_month=True)
    assert glob.glob(f"{out.fact}/order_year=2023/order_month=*/*.parquet")
    expected = run_metrics(build_fact(tables), ["monthly_sales"])["monthly_sales"]
    assert rows(spark.read.parquet(out.results["monthly_sales"])) == rows(expected)


def test_batch_from_csv_files_by_command(spark, tables, tmp_path):
    for name, df in tables._asdict().items():
        df.write.option("header", True).csv(str(tmp_path / "in" / f"{name}.csv"))
    out = main([str(tmp_path / "in"), str(tmp_path / "out")], spark)
    assert out.fact == str(tmp_path / "out" / "fact_table_csv")
    expected = run_metrics(build_fact(tables), ["aov"])["aov"].first()[0]
    assert float(text(out.results["aov"])[1]) == expected


def test_every_cell_is_stored_as_it_is(spark, tmp_path):
    """Spark and pandas both read back what was written."""
    import datetime

    import pandas as pd

    cells = ["  Ann ", "Lee\t", "\ttoys", 'say "hi", x', '6" pan, "large"', "a,b", "\\", "\\\"", "é"]
    at = datetime.datetime(2023, 1, 5, 10, 0, 0)
    given = [
        (k, c, 0.12345 * k, at.replace(microsecond=k * 1001)) for k, c in enumerate(cells)
    ]
    df = spark.createDataFrame(given, "k int, name string, ratio double, at timestamp_ntz")
    path = write_result(df, "odd", str(tmp_path), order=(("k", "asc"),))
    back = spark.read.schema(df.schema).options(**CSV_OPTIONS).csv(path)
    assert rows(back.orderBy("k")) == given
    (file,) = glob.glob(f"{path}/*.csv")
    frame = pd.read_csv(file)
    assert list(frame["name"]) == cells and list(frame["ratio"]) == [g[2] for g in given]
    times = pd.to_datetime(frame["at"], format="ISO8601")
    assert [t.to_pydatetime() for t in times] == [g[3] for g in given]


def test_files_of_other_writers_are_read(spark, tables, tmp_path):
    for name, df in tables._asdict().items():
        df.toPandas().to_csv(tmp_path / f"{name}.csv", index=False)
    odd = '6" pan, "large"'
    frame = tables.products.toPandas().assign(category=odd, product_name="two\nlines")
    frame.to_csv(tmp_path / "products.csv", index=False)
    products = load_tables(spark, str(tmp_path), multi_line=True).products.collect()
    assert {(r.category, r.product_name) for r in products} == {(odd, "two\nlines")}
    assert len(products) == len(frame) < load_tables(spark, str(tmp_path)).products.count()


def test_a_csv_batch_leaves_nothing_behind(spark, tables, tmp_path):
    import os

    root = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(root))
    out = run_batch(spark, tables, str(tmp_path / "out"), names=["aov"])
    assert out.staged_fact is None and set(os.listdir(root)) == before
    kept = run_batch(spark, tables, str(tmp_path / "out"), names=["aov"], keep_staged=True)
    assert spark.read.parquet(kept.staged_fact).count() == build_fact(tables).count()


def test_outputs_of_a_lazy_fact_join_once(spark, tables, tmp_path):
    fact = build_fact(tables)
    results = run_metrics(fact, ["aov", "sales_by_date", "top_n_products"])
    fact.persist()
    try:
        for name, df in results.items():
            assert "InMemoryTableScan" in plan(df), name
    finally:
        fact.unpersist()
    write_outputs(build_fact(tables), run_metrics(build_fact(tables), ["aov"]), str(tmp_path))
    assert not build_fact(tables).storageLevel.useMemory


def test_batch_parameters(spark, tables, tmp_path):
    names = ["top_n_products", "ranked_products_in_category", "sales_by_country"]
    out = run_batch(
        spark, tables, str(tmp_path), names=names, sizes={"top_n_products": 2}, with_index=True,
        normalize_status_first=True, null_totals="zero",
    )
    assert list(out.results) == names
    for name, path in out.results.items():
        lines = text(path)
        assert lines[0].startswith("row_index,")
        assert [int(x.split(",")[0]) for x in lines[1:]] == list(range(len(lines) - 1))
    assert len(text(out.results["top_n_products"])) == 3


def test_the_command_line_takes_the_same_parameters(spark, tables, tmp_path, capsys):
    for name, df in tables._asdict().items():
        df.write.option("header", True).csv(str(tmp_path / "in" / f"{name}.csv"))
    out = main(
        [
            str(tmp_path / "in"), str(tmp_path / "out"), "--results", "top_n_products", "aov",
            "--size", "top_n_products=1", "--index", "--keep-staged", "--null-totals", "zero",
        ],
        spark,
    )
    assert list(out.results) == ["top_n_products", "aov"]
    assert len(text(out.results["top_n_products"])) == 2
    assert capsys.readouterr().out.split() == [out.fact, out.staged_fact, *out.results.values()]


def test_only_a_local_session_may_do_without_a_shared_folder(spark, monkeypatch):
    class Session:
        def __init__(self, master):
            self.conf = {"spark.master": master}

    assert shared_path(Session("local[4]"), "x") and shared_path(Session("local"), "x")
    for master in ("local-cluster[2,1,1024]", "yarn", "spark://h:7077", ""):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_path(Session(master), "x")


def test_shared_path_is_fresh_and_below_the_named_folder(spark):
    one, two = shared_path(spark, "x"), shared_path(spark, "x")
    assert one != two and one.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_unknown_format(tables, tmp_path):
    with pytest.raises(ValueError, match="unknown sink format"):
        write_fact(build_fact(tables), str(tmp_path), "xml")


def test_nothing_is_collected_on_the_driver():
    for module in (tillstar.sinks.writers, tillstar.plans.batch):
        source = inspect.getsource(module)
        for action in ("toPandas", "collect(", "toLocalIterator", "localCheckpoint", ".take("):
            assert action not in source
