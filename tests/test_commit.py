"""Output tables are replaced together, and only by complete ones."""

import os
import subprocess
import sys
import textwrap

import pytest
from conftest import rows

import tillstar.plans.batch
import tillstar.sinks.commit as commit
from tillstar import run_batch
from tillstar.schemas import CSV_OPTIONS
from tillstar.shared import scratch, shared_path
from tillstar.sinks import discard, finish, staged, write_result


def _tables(make, price):
    orders = [(f"o{k}", f"c{k % 2}", "2023-01-05 10:00:00", 5.0, "pending") for k in range(4)]
    return make(orders, [(o[0], "p1", 1, price) for o in orders])


def _aov(spark, path):
    return rows(spark.read.parquet(path))


def _hidden(place):
    return [n for n in os.listdir(place) if n.startswith(("_", "."))]


def test_a_failed_batch_leaves_the_earlier_output(spark, make, tmp_path, monkeypatch):
    names = ["aov", "monthly_sales", "sales_by_date"]
    first = run_batch(spark, _tables(make, 1.0), str(tmp_path), fmt="parquet", names=names)
    before = {n: sorted(os.listdir(p)) for n, p in first.results.items()}
    real = tillstar.plans.batch.put_result

    def fails(result, name, *args, **options):
        if name == "monthly_sales":
            raise KeyboardInterrupt
        return real(result, name, *args, **options)

    monkeypatch.setattr(tillstar.plans.batch, "put_result", fails)
    with pytest.raises(KeyboardInterrupt):
        run_batch(spark, _tables(make, 2.0), str(tmp_path), fmt="parquet", names=names)
    assert _aov(spark, first.results["aov"]) == [(1.0,)] and _hidden(tmp_path) == []
    assert {n: sorted(os.listdir(p)) for n, p in first.results.items()} == before
    monkeypatch.undo()
    again = run_batch(spark, _tables(make, 2.0), str(tmp_path), fmt="parquet", names=names)
    assert again.results == first.results and _aov(spark, again.results["aov"]) == [(2.0,)]
    assert spark.read.parquet(again.fact).count() == 4 and _hidden(tmp_path) == []


def test_a_process_killed_between_two_results_leaves_the_earlier_output(spark, make, tmp_path):
    out, source = str(tmp_path / "out"), str(tmp_path / "in")
    names = ["aov", "monthly_sales"]
    first = run_batch(spark, _tables(make, 1.0), out, fmt="csv", names=names)
    for name, df in _tables(make, 2.0)._asdict().items():
        df.write.options(**CSV_OPTIONS).csv(f"{source}/{name}.csv")
    program = f"""
        import os
        from pyspark.sql import SparkSession
        import tillstar.plans.batch as batch
        spark = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
                 .config("spark.checkpoint.dir", {str(tmp_path / "shared")!r})
                 .config("spark.sql.shuffle.partitions", "1").getOrCreate())
        real = batch.put_result
        def killed(result, name, *args, **options):
            real(result, name, *args, **options)
            os._exit(9)
        batch.put_result = killed
        batch.run_batch(spark, {source!r}, {out!r}, fmt="csv", names={names!r})
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run(
        [sys.executable, "-c", textwrap.dedent(program)], env={**os.environ, "PYTHONPATH": root},
        capture_output=True, timeout=300,
    )
    assert done.returncode == 9, done.stderr[-2000:]
    assert rows(spark.read.csv(first.results["aov"], header=True)) == [("1.00",)]
    assert spark.read.csv(first.fact, header=True).count() == 4
    assert len(_hidden(out)) == 1  # what the killed run had written; no reader sees it
    assert discard(spark, out) and _hidden(out) == []


@pytest.mark.parametrize("stop", [1, 2, 3, 4])
def test_a_commit_that_stopped_halfway_is_finished(spark, tmp_path, monkeypatch, stop):
    def write(value):
        with staged(spark, str(tmp_path)) as place:
            for name in "ab":
                spark.range(value, value + 1).write.parquet(f"{place}/{name}")

    write(1)
    real, done = commit._rename, []

    def dies(*args):
        if len(done) == stop:
            raise SystemExit
        done.append(real(*args))

    monkeypatch.setattr(commit, "_rename", dies)
    with pytest.raises(SystemExit):
        write(2)
    monkeypatch.undo()
    assert len(finish(spark, str(tmp_path))) == 1
    assert [rows(spark.read.parquet(f"{tmp_path}/{n}")) for n in "ab"] == [[(2,)], [(2,)]]
    assert sorted(os.listdir(tmp_path)) == ["a", "b"] and finish(spark, str(tmp_path)) == []


def test_the_next_writer_finishes_an_earlier_commit(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commit, "_move_in", lambda *a: (_ for _ in ()).throw(SystemExit))
    with pytest.raises(SystemExit):
        write_result(spark.range(3), "old", str(tmp_path), "parquet")
    monkeypatch.undo()
    write_result(spark.range(5), "new", str(tmp_path), "parquet")
    assert spark.read.parquet(f"{tmp_path}/old_parquet").count() == 3
    assert spark.read.parquet(f"{tmp_path}/new_parquet").count() == 5


def test_nothing_written_and_a_missing_destination(spark, tmp_path):
    with staged(spark, f"{tmp_path}/none/yet"):
        pass
    assert finish(spark, f"{tmp_path}/none/yet") == discard(spark, f"{tmp_path}/none/yet") == []


def test_scratch_removes_what_was_stored_in_it(spark, tmp_path):
    with pytest.raises(KeyError), scratch(spark):
        path = shared_path(spark, "scratch")
        with scratch(spark):
            inner = shared_path(spark, "scratch")
            spark.range(3).write.parquet(inner)
        assert not os.path.exists(inner)
        spark.range(3).write.parquet(path)
        raise KeyError
    assert not os.path.exists(path)
    kept = shared_path(spark, "scratch")
    spark.range(3).write.parquet(kept)
    assert os.path.exists(kept)


def test_results_with_an_index_leave_nothing_in_the_shared_folder(spark, make, tmp_path):
    root = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(root))
    out = run_batch(spark, _tables(make, 1.0), str(tmp_path), fmt="csv", with_index=True)
    assert set(os.listdir(root)) == before and len(out.results) == 11
