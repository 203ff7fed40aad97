import zlib

import pytest
from cases import crowded, documents, rows, words

from tillstar.llm import mixing
from tillstar.llm.mixing import mix, plan_copies, targets
from tillstar.llm.sharding import differencing, shard, write_shards


def water(sizes, weights=(5, 2, 1), most=3):
    """Share by weight, cap, and share the excess again until none is above."""
    names = sorted((s for s in sizes if s is not None), key=str.encode) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, rest, open_ = {}, float(sum(sizes.values())), set(names)
    while open_:
        share = {s: rest * weight[s] / sum(weight[o] for o in open_) for s in open_}
        above = {s for s in open_ if share[s] > most * sizes[s]}
        if not above:
            return target | share
        for s in above:
            target[s] = float(most * sizes[s])
            rest -= target[s]
        open_ -= above
    return target


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 10, "b": 10, "c": 10},
        {"a": 1, "b": 1000, "c": 1, "d": 5},
        {"a": 1, "b": 1, "c": 1000, None: 3, "é": 7, "Z": 0},
        {"a": 0},
        {None: 4},
    ],
)
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in targets(df).collect()}
    assert got == pytest.approx(water(sizes))


def test_copies_follow_the_targets(spark):
    given = [
        (k, "w " * (k % 50 + 1), None, f"s{min(k % 10, 6)}", None) for k in range(3000)
    ]
    docs = documents(spark, given)
    out = plan_copies(docs, per_split=100).collect()
    sizes = {r.doc_id: len(words(g[1])) for r, g in zip(sorted(out, key=lambda r: r.doc_id), given)}
    by = {}
    for r in out:
        assert r["size"] == sizes[r.doc_id] and 0 <= r.copies <= 3
        taken = by.setdefault(r.source, [0, r.target, r.source_size])
        taken[0] += r.copies * r["size"]
    assert {s: t[1] for s, t in by.items()} == pytest.approx(water({s: t[2] for s, t in by.items()}))
    for taken, target, _ in by.values():
        assert abs(taken - target) < 0.03 * target
    assert sorted(out) == sorted(plan_copies(docs.repartition(7), per_split=100).collect())


def test_awkward_rows_and_columns(spark):
    docs = crowded(documents(spark))
    planned = plan_copies(docs)
    assert planned.count() == len(rows())
    assert {r["size"] for r in planned.where("text is null").collect()} == {0}
    mixed = mix(docs)
    assert mixed.columns == docs.columns
    assert {r["size"] for r in mixed.collect()} == {"own size"}
    copies = planned.agg({"copies": "sum"}).first()[0]
    assert mixed.count() == copies
    assert plan_copies(documents(spark, [])).count() == mix(documents(spark, [])).count() == 0


def test_differencing():
    # The classic example: 8 7 6 5 4 in two parts differ by 2.
    parts = differencing(dict(enumerate([8, 7, 6, 5, 4])), 2)
    sums = [sum([8, 7, 6, 5, 4][k] for k in parts if parts[k] == s) for s in (0, 1)]
    assert sorted(sums) == [14, 16]
    assert differencing({}, 4) == {} and differencing({7: 3}, 4) == {7: 0}


@pytest.mark.parametrize("lot", [20_000, 4])
def test_shards(spark, lot):
    given = rows() + [(k, f"text {k} " * (k % 40), None, None, None) for k in range(100, 700)]
    got = shard(crowded(documents(spark, given)), per_lot=lot).collect()
    raw = [(r[0], (r[1] or "").encode()) for r in given]
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in got), key=repr) == sorted(
        ((i, len(b) + 1, zlib.crc32(b)) for i, b in raw), key=repr
    )
    slots = {}
    group = {}
    total = [0] * 16
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
        group.setdefault((r.text_crc32, r["size"]), set()).add(r.shard)
        total[r.shard] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in group.values())
    # One document is longer than a shard's share; the others even out.
    assert sorted(total)[-2] - min(total) < 0.05 * sorted(total)[-2]


def test_no_documents_and_files(spark, tmp_path):
    assert shard(documents(spark, [])).count() == 0
    write_shards(documents(spark), str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == len(rows())


def test_rows_without_an_id_are_dealt_evenly(spark):
    """Null and repeated ids with different texts, most of them in one class of sizes."""
    docs = spark.range(4000).selectExpr(
        "if(id % 3 = 0, null, 7L) AS doc_id", "concat('word', id) AS text",
        "if(id % 2 = 0, null, 'one') AS source",
    )
    planned = mixing._planned(docs, ["doc_id"], (5, 2, 1), 3, 7, 200)
    text = planned._jdf.queryExecution().optimizedPlan().toString()
    assert "text#" not in text.split("Window")[0]  # nothing after the parts carries texts
    numbered = plan_copies(docs, per_split=200, keep=["doc_id"])
    assert numbered.count() == 4000 and numbered.columns[0] == "doc_id"
    for shuffled in (docs, docs.repartition(5)):
        copies = plan_copies(shuffled, per_split=200)
        taken = {r.text: r.copies for r in copies.collect()}
        assert taken == {r.text: r.copies for r in plan_copies(docs, per_split=200).collect()}
    spots = docs.select(mixing._drawn(mixing.F.concat_ws(":", mixing.F.lit(""), mixing.F.md5("text"))).alias("s"))
    sizes = [r["count"] for r in spots.selectExpr("s % 20 AS part").groupBy("part").count().collect()]
    assert len(sizes) == 20 and max(sizes) < 2 * 200


def test_lots_of_rows_without_an_id_are_even(spark):
    docs = spark.range(4000).selectExpr("cast(null as long) AS doc_id", "concat('t', id) AS text")
    out = shard(docs, per_lot=100)
    slots = {}
    for r in out.collect():
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    lots = docs.selectExpr("pmod(xxhash64(doc_id, crc32(cast(text as binary)), cast(length(text) + 1 as long)), 40) AS lot")
    sizes = [r["count"] for r in lots.groupBy("lot").count().collect()]
    assert len(sizes) == 40 and max(sizes) < 2 * 100


def _plain_differencing(sizes, shards):
    """Partial partitions as plain lists, the two of largest spread combined again and
    again; returns the sums in descending order."""
    partial = [sorted([size] + [0] * (shards - 1), reverse=True) for size in sizes]
    while len(partial) > 1:
        partial.sort(key=lambda p: p[0] - p[-1])
        one, two = partial.pop(), partial.pop()
        partial.append(sorted((a + b for a, b in zip(one, reversed(two))), reverse=True))
    return partial[0]


@pytest.mark.parametrize("shards", [2, 3, 16])
def test_differencing_equals_a_plain_version(shards):
    import random

    draw = random.Random(shards)
    for n in (1, 5, 40, 300):
        # Different spreads at every step, so that no tie has two outcomes.
        sizes = {k: draw.randrange(1, 1 << 40) for k in range(n)}
        where = differencing(sizes, shards)
        sums = [0] * shards
        for bundle, part in where.items():
            sums[part] += sizes[bundle]
        assert set(where) == set(sizes)
        assert sorted(sums, reverse=True) == _plain_differencing(list(sizes.values()), shards)
