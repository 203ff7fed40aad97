"""Months of a stored batch are brought up to date together with the results."""

import os

import pytest
from conftest import plan, rows

import tillstar.plans.refresh as refresh
import tillstar.sinks.commit as commit
from tillstar import METRICS, build_fact, refresh_months, run_batch
from tillstar.__main__ import main
from tillstar.plans.refresh import in_months
from tillstar.schemas import CSV_OPTIONS
from tillstar.sinks import finish

_DATES = ["2023-01-05 10:00:00", "2023-02-05 10:00:00", "2023-12-31 23:59:59", "2024-02-01 00:00:00", "bad"]


def _tables(make, prices, dates=_DATES):
    orders = [(f"o{k}", f"c{k % 2}", d, 5.0, "pending") for k, d in enumerate(dates)]
    return make(orders, [(o[0], f"p{k % 2}", k + 1, p) for k, (o, p) in enumerate(zip(orders, prices))])


def _stored(spark, out, fact):
    stored = spark.read.schema(fact.schema).parquet(out.fact)
    return sorted(rows(stored.select(fact.columns)), key=repr)


def _same(spark, out, tables):
    """The stored batch equals one made anew from the tables."""
    fact = build_fact(tables)
    assert _stored(spark, out, fact) == sorted(rows(fact), key=repr)
    for name, path in out.results.items():
        assert sorted(rows(spark.read.parquet(path)), key=repr) == sorted(rows(METRICS[name](fact)), key=repr)


@pytest.fixture
def earlier(spark, make, tmp_path):
    out = run_batch(spark, _tables(make, [1.0] * 5), str(tmp_path / "out"), fmt="parquet", by_month=True)
    return out, str(tmp_path / "out")


def _files(path):
    return {
        os.path.join(at, f) for at, _, names in os.walk(path) for f in names if f.endswith(".parquet")
    }


def test_only_the_months_change(spark, make, earlier):
    out, place = earlier
    before = _files(out.fact)
    new = _tables(make, [1.0, 7.0, 1.0, 9.0, 1.0])
    again = refresh_months(spark, new, place, [(2023, 2), (2024, 2)])
    assert again.results == out.results
    _same(spark, again, new)
    stayed = before & _files(out.fact)
    assert len(stayed) == 3 and not any("order_month=2/" in f for f in stayed)
    assert [n for n in os.listdir(place) if n.startswith("_")] == []


def test_months_that_are_new_empty_or_without_a_date(spark, make, earlier):
    _, place = earlier
    dates = ["2023-01-05 10:00:00", "2025-07-01 00:00:00", None, "2024-02-01 00:00:00", "worse"]
    new = _tables(make, [1.0, 2.0, 3.0, 1.0, 5.0], dates)
    months = [(2023, 2), (2023, 12), (2025, 7), (None, None), (2030, 1)]
    out = refresh_months(spark, new, place, months * 2)
    _same(spark, out, new)
    emptied = make([], [("o1", "p1", 1, 1.0)])
    everything = [*months, (2023, 1), (2024, 2)]
    _same(spark, refresh_months(spark, emptied, place, everything), emptied)


def test_a_failed_refresh_changes_nothing(spark, make, earlier, monkeypatch):
    out, place = earlier
    before, old = _files(place), _tables(make, [1.0] * 5)

    def fails(*_, **__):
        raise KeyboardInterrupt

    monkeypatch.setattr(refresh, "put_results", fails)
    with pytest.raises(KeyboardInterrupt):
        refresh_months(spark, _tables(make, [2.0] * 5), place, [(2023, 1)])
    assert _files(place) == before
    _same(spark, out, old)


@pytest.mark.parametrize("moves", [1, 3, 6, 8])
def test_a_refresh_that_dies_between_renames_is_finished(spark, make, earlier, monkeypatch, moves):
    out, place = earlier
    new = _tables(make, [2.0, 3.0, 1.0, 1.0, 1.0])
    real, count = commit._rename, [0]

    def dies(*args):
        count[0] += 1
        if count[0] > moves:
            raise KeyboardInterrupt
        real(*args)

    monkeypatch.setattr(commit, "_rename", dies)
    with pytest.raises(KeyboardInterrupt):
        refresh_months(spark, new, place, [(2023, 1), (2023, 2)], names=["aov", "monthly_sales"])
    monkeypatch.undo()
    assert len(finish(spark, place)) == 1
    fact = build_fact(new)
    assert _stored(spark, out, fact) == sorted(rows(fact), key=repr)
    for name in ("aov", "monthly_sales"):
        assert rows(spark.read.parquet(out.results[name])) == rows(METRICS[name](fact))


def test_what_cannot_be_refreshed(spark, make, tmp_path):
    tables = _tables(make, [1.0] * 5)
    with pytest.raises(ValueError, match="at least one"):
        refresh_months(spark, tables, str(tmp_path), [])
    with pytest.raises(ValueError, match="no stored fact"):
        refresh_months(spark, tables, str(tmp_path), [(2023, 1)])
    run_batch(spark, tables, str(tmp_path), fmt="parquet", names=["aov"])
    with pytest.raises(ValueError, match="not laid out"):
        refresh_months(spark, tables, str(tmp_path), [(2023, 1)])


def test_other_orders_are_dropped_before_the_joins(spark, make):
    lines = plan(build_fact(_tables(make, [1.0] * 5)).where(in_months([(2023, 2)]))).splitlines()
    depth = {kind: [line.index(kind) for line in lines if kind in line] for kind in ("Join", "Filter")}
    dated = [line.index("Filter") for line in lines if "Filter" in line and "year(" in line]
    assert dated and min(dated) > max(depth["Join"][:2])


def test_from_the_command_line(spark, make, earlier, tmp_path):
    _, place = earlier
    new = _tables(make, [1.0, 7.0, 1.0, 1.0, 1.0])
    for name, df in new._asdict().items():
        df.write.options(**CSV_OPTIONS).csv(f"{tmp_path}/in/{name}.csv")
    out = main([f"{tmp_path}/in", place, "--format", "parquet", "--refresh", "2023-02"], spark)
    _same(spark, out, new)


def test_results_share_rollups_of_few_files(spark, make, tmp_path, conf, monkeypatch):
    import tillstar.plans.batch as batch

    conf(spark__sql__shuffle__partitions="40")
    seen = []

    def watched(fact, names, rollups, sizes):
        seen.append({grain: r.rdd.getNumPartitions() for grain, r in rollups.items()})
        return run_metrics(fact, names, rollups, sizes)

    run_metrics = batch.run_metrics
    monkeypatch.setattr(batch, "run_metrics", watched)
    monkeypatch.setattr(refresh, "run_metrics", watched)
    place, tables = str(tmp_path / "out"), _tables(make, [1.0, 7.0, 1.0, 9.0, 1.0])
    run_batch(spark, _tables(make, [1.0] * 5), place, fmt="parquet", by_month=True)
    out = refresh_months(spark, tables, place, [(2023, 2), (2024, 2)])
    _same(spark, out, tables)
    assert [sorted(s) for s in seen] == [["customer", "day", "product"]] * 2
    assert max(n for s in seen for n in s.values()) < 10
    assert not [f for f in _files(place) if "/_rollups/" in f]
