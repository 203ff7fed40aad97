"""Sharding by Karmarkar-Karp differencing.

Copies of a text form a group that stays together. Groups are hashed into a fixed number
of bundles, so that what the driver balances does not grow with the data. Each bundle
starts as a partial partition: its bytes in one shard, nothing in the others. The two
partial partitions with the largest spread are combined, the largest part of one with
the smallest of the other, until one partition is left.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm.common import stored, text_or_empty

SHARDS = 16
BUNDLES = 1 << 14
PER_LOT = 20_000


def differencing(sizes: dict[int, int], shards: int) -> dict[int, int]:
    """The shard of each bundle. Ties go by bundle number, so reruns agree."""
    # (-spread, lowest bundle, sums in descending order, members of each part)
    heap = []
    for bundle, size in sorted(sizes.items()):
        sums = [size] + [0] * (shards - 1)
        parts: list = [[bundle]] + [[] for _ in range(shards - 1)]
        heap.append((-(sums[0] - sums[-1]), bundle, sums, parts))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, one, a, first = heapq.heappop(heap)
        _, two, b, second = heapq.heappop(heap)
        sums = [x + y for x, y in zip(a, reversed(b))]
        parts = []
        for x, y in zip(first, reversed(second)):
            small, large = (x, y) if len(x) < len(y) else (y, x)
            large.extend(small)
            parts.append(large)
        order = sorted(range(shards), key=lambda k: -sums[k])
        sums = [sums[k] for k in order]
        heapq.heappush(
            heap, (sums[-1] - sums[0], min(one, two), sums, [parts[k] for k in order])
        )
    return {bundle: k for k, part in enumerate(heap[0][3]) for bundle in part} if heap else {}


def shard(
    docs: DataFrame, shards: int = SHARDS, bundles: int = BUNDLES, per_lot: int = PER_LOT
) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot.

    ``size`` is the bytes of the text plus one; a null text counts as an empty one and
    falls in its group. Sizes of shards are as near as bundles allow: a group larger than
    a shard's share keeps its shard above it. Slots number the rows of a shard from 0
    without gaps; they are counted in lots of about ``per_lot`` rows dealt by id and text, so
    that no shard, large group or rows without an id are numbered in one task; rows that
    agree in both fall in one lot. Repeated rows and null ids have slots of their own.
    """
    spark = docs.sparkSession
    text = text_or_empty()
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.pmod(F.xxhash64(text), F.lit(bundles)).cast("int").alias("bundle"),
    )
    rows = stored(rows, "sizes")
    # At most ``bundles`` rows come to the driver.
    weights = rows.groupBy("bundle").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    weights = weights.toArrow().to_pydict()
    shard_of = differencing(dict(zip(weights["bundle"], weights["size"])), shards)
    places = spark.createDataFrame(sorted(shard_of.items()), "bundle int, shard int")
    lots = max(1, -(-sum(weights["n"]) // per_lot))
    rows = rows.join(F.broadcast(places), "bundle").withColumn(
        "lot", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(lots)).cast("int")
    )
    counts = rows.groupBy("shard", "lot").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("lot").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        "shard", "lot", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    inside = Window.partitionBy("shard", "lot").orderBy("doc_id", "text_crc32", "size")
    slot = F.col("before") + F.row_number().over(inside) - 1
    return rows.join(stored(counts, "lots"), ["shard", "lot"]).select(
        "doc_id", "size", "text_crc32", "shard", slot.alias("slot")
    )


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """Store documents in a directory per shard; of repeated ids all rows go along."""
    places = shard(docs, **options).select(
        F.col("doc_id").alias("__doc_id"), F.col("text_crc32").alias("__crc"), "shard"
    )
    rows = docs.withColumn("__text_crc", F.crc32(text_or_empty().cast("binary")))
    rows = rows.drop("shard").join(
        places.distinct(),
        F.col("doc_id").eqNullSafe(F.col("__doc_id")) & (F.col("__text_crc") == F.col("__crc")),
    )
    rows.drop("__doc_id", "__crc", "__text_crc").write.partitionBy("shard").parquet(path)
