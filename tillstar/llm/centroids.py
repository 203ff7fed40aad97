"""Centroid clustering with bisector tournaments, exact in integers.

Vectors become integers and centroids stay integers, so that the same vectors give the
same clusters however they are dealt to tasks. Between two centroids lies a bisector: the
sign of ``normal . x - threshold`` says which of them is nearer. Normals and thresholds of
all pairs are made once a round; a vector's nearest centroid then is the winner of k - 1
sign tests, each of which eliminates a loser, and only the winner's distance is computed.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import column_of, stored

CENTROIDS, ROUNDS, WIDTH, SCALE = 8, 10, 64, 1024
SEED = "3"
_LIMB = 32
_LONG = (1 << 63) - 1


def kept_rows(column: pa.Array, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, components as double) of the vectors with exactly ``width``
    components of which none is null, NaN or infinite."""
    lengths = pc.list_value_length(column).fill_null(-1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(lengths == width)
    values = column.take(pa.array(rows)).flatten().cast(pa.float64())
    x = values.to_numpy(zero_copy_only=False).reshape(-1, width)  # null becomes NaN
    fine = np.isfinite(x).all(axis=1)
    return rows[fine], x[fine]


def integers(x: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x): doubles that hold integers, or Python integers where doubles
    would not stay exact in what follows."""
    with np.errstate(over="ignore"):
        out = np.floor(x * scale)
    if not len(out) or np.abs(out).max() < 1 << 40:
        return out
    whole = [int(v) * scale if abs(v) >= 1 << 53 else math.floor(v * scale) for v in x.flat]
    return np.array([*whole, None], object)[:-1].reshape(x.shape)


class Tournament:
    """Normals and thresholds of all pairs of centroids."""

    def __init__(self, centroids: Sequence[Sequence[int]]):
        self.centroids = [list(c) for c in centroids]
        self.most = max((abs(v) for c in self.centroids for v in c), default=0)
        self.tests = {}
        for j, high in enumerate(self.centroids):
            for i, low in enumerate(self.centroids[:j]):
                normal = [2 * (b - a) for a, b in zip(low, high)]
                threshold = sum(b * b for b in high) - sum(a * a for a in low)
                self.tests[i, j] = (np.array(normal, object), threshold)

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, squared distance) of the nearest centroid of every row; of equally
        near ones the smallest number. Sums stay exact: in doubles while they are below
        2^53, in Python integers beyond."""
        winner = np.zeros(len(x), np.int64)
        if not len(x):
            return winner, np.zeros(0, np.int64)
        exact = x.dtype != object
        if exact:
            most = max(int(np.abs(x).max()), self.most)
            exact = 4 * x.shape[1] * most * most < 1 << 53
        kind = np.float64 if exact else object
        if not exact and x.dtype != object:
            x = np.array([*map(int, x.flat), None], object)[:-1].reshape(x.shape)
        for j in range(1, len(self.centroids)):
            champions = [np.flatnonzero(winner == i) for i in range(j)]
            for i, rows in enumerate(champions):
                if len(rows):
                    normal, threshold = self.tests[i, j]
                    side = x[rows] @ normal.astype(kind) - threshold
                    winner[rows[side > 0]] = j  # zero: equally near, the smaller number stays
        centre = np.array(self.centroids, object).astype(kind)
        apart = x - centre[winner]
        distance = (apart * apart).sum(axis=1)
        return winner, distance.astype(np.int64) if exact else distance


@dataclass(frozen=True)
class Centroids:
    """What a fit leaves: the centroids as integers, and how vectors become integers."""

    values: tuple[tuple[int, ...], ...]
    width: int
    scale: int

    def digest(self, number: int) -> str:
        """SHA-256 of a centroid's components in decimal, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.values[number])).encode()).hexdigest()


def _first(vectors: DataFrame, k: int, seed: str, width: int, scale: int) -> Centroids:
    """The k vectors with the smallest hash of their id. Every task hands on its k
    smallest; ties go by the components, null ids come last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list = []
        for batch in batches:
            rows, x = kept_rows(column_of(batch, "vector"), width)
            ids = column_of(batch, "id").take(pa.array(rows)).to_pylist()
            for number, vec_id in enumerate(ids):
                text = f"{seed}:{vec_id}".encode()
                digest = "~" if vec_id is None else hashlib.sha256(text).hexdigest()
                if len(best) < k or digest <= best[-1][0]:
                    best = sorted([*best, (digest, x[number].tolist())])[:k]
        yield pa.RecordBatch.from_arrays(
            [pa.array([b[0] for b in best], pa.string()),
             pa.array([b[1] for b in best], pa.list_(pa.float64()))],
            names=["digest", "vector"],
        )

    found = vectors.mapInArrow(run, "digest string, vector array<double>")
    found = found.orderBy("digest", "vector").limit(k).collect()  # k rows
    start = integers(np.array([r.vector for r in found], float).reshape(-1, width), scale)
    return Centroids(tuple(tuple(map(int, row)) for row in start), width, scale)


def _limbs(sums: list[int]) -> list[list[int]]:
    """Numbers in base 2^32, each limb with the number's sign, lowest first."""
    out = []
    while not out or any(sums):
        out.append([(abs(v) & ((1 << _LIMB) - 1)) * (1 if v >= 0 else -1) for v in sums])
        sums = [(abs(v) >> _LIMB) * (1 if v >= 0 else -1) for v in sums]
    return out


def _round(vectors: DataFrame, model: Centroids) -> Centroids:
    """The centroids' exact means, rounded down. Every task sums up its vectors by
    centroid; one row per centroid and limb comes to the driver."""
    width, scale = model.width, model.scale

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tournament = Tournament(model.values)
        count: dict[int, int] = {}
        total: dict[int, list[int]] = {}
        for batch in batches:
            x = integers(kept_rows(column_of(batch, "vector"), width)[1], scale)
            winner, _ = tournament.assign(x)
            for number in np.unique(winner).tolist():
                own = x[winner == number]
                count[number] = count.get(number, 0) + len(own)
                # Doubles are integers below 2^40 here: sums of a batch stay exact as 64-bit ones.
                part = (own if own.dtype == object else own.astype(np.int64)).sum(axis=0)
                total[number] = [
                    a + int(b) for a, b in zip(total.get(number, [0] * width), part)
                ]
        rows = [
            (number, limb, count[number] if limb == 0 else 0, values)
            for number in total
            for limb, values in enumerate(_limbs(total[number]))
        ]
        columns = list(zip(*rows)) or [[]] * 4
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds)], names=["cluster", "limb", "n", "sums"]
        )

    parts = vectors.select("vector").mapInArrow(
        run, "cluster int, limb int, n long, sums array<long>"
    )
    sums = F.array(*[F.sum(F.col("sums")[i]) for i in range(width)])
    parts = parts.groupBy("cluster", "limb").agg(F.sum("n").alias("n"), sums.alias("sums"))
    count, total = {}, {}
    for r in parts.collect():
        count[r.cluster] = count.get(r.cluster, 0) + r.n
        before = total.get(r.cluster, [0] * width)
        total[r.cluster] = [a + (b << (_LIMB * r.limb)) for a, b in zip(before, r.sums)]
    moved = tuple(
        tuple(v // count[number] for v in total[number]) if number in total else old
        for number, old in enumerate(model.values)
    )
    return Centroids(moved, width, scale)


def _columns(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    return vectors.select(F.col(vec_id).alias("id"), F.col(vector).alias("vector"))


def fit(
    vectors: DataFrame,
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    seed: str = SEED,
    width: int = WIDTH,
    scale: int = SCALE,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> Centroids:
    """Centroids after ``rounds`` rounds over the table.

    They start as the k kept vectors with the smallest SHA-256 of ``seed:id``; each round
    assigns every vector to the nearest one and moves every centroid that has vectors to
    their mean, rounded down per component. Fewer than k kept vectors give fewer
    centroids, none give none. Each round reads the table once, so pass a stored one;
    what a task holds is one batch and one sum per centroid, however many vectors or
    copies of one a centroid has.
    """
    vectors = _columns(vectors, vec_id, vector)
    model = _first(vectors, k, seed, width, scale)
    for _ in range(rounds if model.values else 0):
        before, model = model, _round(vectors, model)
        if model == before:  # nothing moves any more
            break
    return model


def assign(
    vectors: DataFrame, model: Centroids, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(vec_id, cluster, distance) of every kept vector.

    Kept are vectors with exactly as many components as the centroids have, none of them
    null, NaN or infinite; the others have no row. Null and repeated ids have rows of their
    own. A squared distance beyond 63 bits is null. Other columns are not read.
    """
    rows = _columns(vectors, vec_id, vector)
    ids = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tournament = Tournament(model.values)
        for batch in batches if model.values else ():
            kept, x = kept_rows(column_of(batch, "vector"), model.width)
            winner, distance = tournament.assign(integers(x, model.scale))
            far = [d if d <= _LONG else None for d in distance] if distance.dtype == object else distance
            yield pa.RecordBatch.from_arrays(
                [column_of(batch, "id").take(pa.array(kept)), pa.array(winner.astype(np.int32)),
                 pa.array(far, pa.int64())],
                names=[vec_id, "cluster", "distance"],
            )

    return rows.mapInArrow(run, f"`{vec_id}` {ids}, cluster int, distance long")


def cluster(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", **options) -> DataFrame:
    """Fit and assign: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Inertias are sums of squared distances, over the cluster and over all; one beyond 63
    bits is null. The assignment is stored, so that the inertias take one more read of
    three columns; one row per centroid comes to the driver.
    """
    model = fit(vectors, vec_id=vec_id, vector=vector, **options)
    rows = stored(assign(vectors, model, vec_id, vector), "assigned")
    far = F.sum(F.col("distance").cast("decimal(38,0)"))
    sums = {r.cluster: r.inertia for r in rows.groupBy("cluster").agg(far.alias("inertia")).collect()}

    def long(value) -> int | None:
        return None if value is None or value > _LONG else int(value)

    everything = None if None in sums.values() else long(sum(sums.values()))
    named = [(c, long(v), everything, model.digest(c)) for c, v in sorted(sums.items())]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    # At most one row per centroid.
    return rows.join(F.broadcast(rows.sparkSession.createDataFrame(named, schema)), "cluster").select(
        vec_id, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
