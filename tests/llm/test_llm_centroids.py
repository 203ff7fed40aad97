"""Centroid clustering against a plain version and SQL."""

import hashlib
import math
import os
import random

import pytest
from compare import connect, differences

from tillstar.llm import centroids
from tillstar.llm.queries import oracle_sql, op12_centroids

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SCHEMA = "vec_id long, embedding array<double>, label int"


def _vectors(n=300, seed=1):
    draw = random.Random(seed)
    rows = [
        (k, [draw.choice([-1, 0, 1]) + draw.gauss(0, 0.3) for _ in range(64)], k % 4) for k in range(n)
    ]
    rows += [rows[5], (7, rows[9][1], None), (None, rows[3][1], 1), (None, [0.0] * 64, None)]
    odd = [None, [], [1.0] * 63, [1.0] * 65, [math.nan] + [0.0] * 63, [None] + [1.0] * 63]
    odd += [[math.inf] * 64, [-math.inf] + [0.0] * 63]
    return rows + [(1000 + k, v, None) for k, v in enumerate(odd)]


def _plain(rows, k=8, rounds=10):
    kept = [
        (i, [math.floor(1024 * x) for x in v], v)
        for i, v, _ in rows
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = sorted(
        kept, key=lambda r: ("~" if r[0] is None else hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[2])
    )
    centre = [v for _, v, _ in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centre))

    for _ in range(rounds):
        members = {}
        for _, v, _ in kept:
            members.setdefault(nearest(v)[1], []).append(v)
        centre = [
            [sum(x) // len(members[n]) for x in zip(*members[n])] if n in members else c
            for n, c in enumerate(centre)
        ]
    found = [(i, *reversed(nearest(v))) for i, v, _ in kept]
    total = {}
    for _, c, d in found:
        total[c] = total.get(c, 0) + d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centre]
    return sorted(
        [(i, c, d, total[c], sum(total.values()), digest[c]) for i, c, d in found], key=repr
    )


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_clusters_agree_with_a_plain_version(spark):
    given = _vectors()
    df = spark.createDataFrame(given, SCHEMA)
    want = _plain(given)
    assert _rows(centroids.cluster(df)) == want
    crowd = df.repartition(7).selectExpr("*", "'own' AS cluster", "'own' AS distance", "0 AS id", "1 AS vector")
    assert _rows(centroids.cluster(crowd)) == want


@pytest.mark.parametrize("size", [1e9, 3e38])
def test_very_large_components_stay_exact(spark, size):
    draw = random.Random(2)
    given = [(k, [draw.uniform(-size, size) for _ in range(64)], 0) for k in range(30)]
    got = _rows(centroids.cluster(spark.createDataFrame(given, SCHEMA), rounds=3))
    want = _plain(given, rounds=3)
    most = (1 << 63) - 1
    assert got == [
        tuple(None if isinstance(x, int) and x > most else x for x in r) for r in want
    ]


def test_fewer_vectors_than_centroids_equal_ones_and_none(spark):
    same = [(k, [0.5] * 64, 0) for k in range(20)]
    for given in (_vectors(10)[:3], same, [(1, None, 0)], []):
        df = spark.createDataFrame(given, SCHEMA)
        assert _rows(centroids.cluster(df)) == _plain(given)


def test_ties_go_to_the_smaller_number():
    import numpy as np

    tournament = centroids.Tournament([[4, 0], [0, 0], [2, 2], [2, -2]])
    x = np.array([[2.0, 0.0], [0.0, 0.0], [2.0, 1.0], [3.0, 1.0], [1.0, 1.0]])
    for rows in (x, np.array([[int(v) for v in r] for r in x], object)):
        winner, distance = tournament.assign(rows)
        assert winner.tolist() == [0, 1, 2, 0, 1] and list(distance) == [4, 0, 1, 2, 2]


def test_limbs_add_up():
    for v in (0, 1, -1, 2**32, -(2**70) - 5, 2**100 + 7):
        assert sum(limb[0] << (32 * k) for k, limb in enumerate(centroids._limbs([v]))) == v


def test_query_agrees_with_sql(spark):
    con = connect(SF_DIR)
    assert differences(op12_centroids(spark, SF_DIR), con, oracle_sql()["op12_centroids"]) == []


def test_awkward_vectors_agree_with_sql(spark, tmp_path):
    spark.createDataFrame(_vectors(60), SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = connect(SF_DIR)
    con.execute(
        f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')"
    )
    assert differences(op12_centroids(spark, str(tmp_path)), con, oracle_sql()["op12_centroids"]) == []
