"""Classes of near-duplicate texts: bands of MinHash signatures, Jaccard verified."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from tillstar.llm.common import column_of, small_batches, stored, text_or_empty
from tillstar.llm.components import components
from tillstar.llm.minhash import _BASE, _CHUNK, WORDS, Hasher, _mix

BANDS, BAND_ROWS = 25, 5
SIMILAR = 0.8
# Members that one task compares with a hub; hubs of a bucket at first, and their growth.
PER_HUB = 4_096
FIRST_HUBS, MORE_HUBS = 8, 8


def _hashed(docs: DataFrame) -> DataFrame:
    text = text_or_empty()
    return docs.select("doc_id", F.xxhash64(text).alias("text_hash"), text.alias("text"))


def band_keys(docs: DataFrame, words: int, bands: int, band_rows: int) -> DataFrame:
    """(doc_id, text_hash, keys): a hash of each band of the signature and its number."""
    rows = _hashed(docs)
    schema = rows.drop("text").schema.add("keys", ArrayType(LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(words, bands * band_rows)
        for batch in small_batches(batches, most=_CHUNK):
            signatures = hasher.signatures(column_of(batch, "text")).astype(np.uint64)
            keys = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(signatures), 1))
            for k in range(band_rows):
                keys = _mix(keys * np.uint64(_BASE) + signatures[:, k::band_rows] + np.uint64(1))
            found = pa.array(list(keys.view(np.int64)), pa.list_(pa.int64()))
            columns = [column_of(batch, "doc_id"), column_of(batch, "text_hash"), found]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_hash", "keys"])

    return rows.mapInArrow(run, schema)


def _similarity(a: np.ndarray, b: np.ndarray) -> float:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared) if len(a) or len(b) else 1.0


def jaccard(docs: DataFrame, first: DataFrame, pairs: DataFrame, words: int) -> DataFrame:
    """(a, b, similarity) of pairs of text hashes, exact, from whole texts.

    ``first`` (text_hash, doc_id) says which row holds a text. Only texts of pairs are
    shuffled, to the task of their hub a; a hub of many pairs is copied to several tasks.
    """
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / PER_HUB).cast("int").alias("parts"))
    parts = stored(parts, "hub-parts")
    chunk = F.pmod(F.xxhash64("b"), F.col("parts")).cast("int")
    members = pairs.join(parts, "a").select("a", chunk.alias("chunk"), F.col("b").alias("node"))
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    hubs = parts.select("a", every.alias("chunk"), F.col("a").alias("node"))
    wanted = members.union(hubs).join(first.withColumnRenamed("text_hash", "node"), "node")
    wanted = stored(wanted.withColumnRenamed("doc_id", "its_id"), "wanted")
    here = (F.col("text_hash") == F.col("node")) & F.col("doc_id").eqNullSafe(F.col("its_id"))
    rows = _hashed(docs).join(wanted, here).select(
        "a", "chunk", "node", (F.col("node") != F.col("a")).alias("member"), "text"
    )
    rows = rows.repartition("a", "chunk").sortWithinPartitions("a", "chunk", "member", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(words)
        hub, hub_set, last = None, None, None
        for batch in small_batches(batches, most=_CHUNK):
            a, nodes = column_of(batch, "a").to_pylist(), column_of(batch, "node").to_pylist()
            hashed, n = hasher.shingles(column_of(batch, "text"))
            found = []
            for k, values in enumerate(np.split(hashed, np.cumsum(n)[:-1])):
                if (a[k], nodes[k]) == last:  # a repeated row
                    continue
                last = (a[k], nodes[k])
                if nodes[k] == a[k]:
                    hub, hub_set = a[k], np.unique(values)
                elif hub == a[k]:
                    found.append((hub, nodes[k], _similarity(hub_set, np.unique(values))))
            columns = list(zip(*found)) or [[], [], []]
            types = (pa.int64(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=["a", "b", "similarity"]
            )

    return rows.mapInArrow(run, "a long, b long, similarity double")


def _open(buckets: DataFrame, roots: DataFrame) -> DataFrame:
    """(key, node, root) of the buckets whose nodes are not all connected yet."""
    rooted = buckets.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = stored(rooted.select("key", "node", "root"), "rooted")
    apart = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    apart = stored(apart.where("low < high").select("key"), "apart")
    return stored(rooted.join(apart, "key", "left_semi"), "open")


def connect(members: DataFrame, verify: Callable[[DataFrame], DataFrame], similar: float) -> DataFrame:
    """(node, root) of all nodes that verified links connect.

    ``members`` (key, a, b) holds each node b of a bucket beside its lowest one, a. That
    hub is verified with all others first. A bucket whose nodes are connected by then, in
    whatever bucket, is done. In others, more of the lowest nodes become hubs, eight times
    as many each time, and are verified with the higher nodes of other classes, until all
    is connected or every node was a hub. So no link between classes is lost; nodes of a
    large group of copies are compared once. The price: many nodes that share a bucket
    without being alike are compared in pairs, which grows with the square of the bucket.
    """
    tried = stored(verify(stored(members.select("a", "b").distinct(), "pairs")), "tried")
    each = F.explode(F.array("a", "b")).alias("node")
    buckets = stored(members.select("key", each).distinct(), "buckets")
    count = FIRST_HUBS
    while True:
        roots = components(tried.where(F.col("similarity") >= similar).select(
            F.col("b").alias("a"), F.col("a").alias("b")
        ))
        roots = stored(roots, "roots")
        left = _open(buckets, roots)
        most = left.groupBy("key").count().agg(F.max("count")).first()[0]
        if most is None:
            return roots
        rank = F.row_number().over(Window.partitionBy("key").orderBy("node"))
        hubs = left.withColumn("rank", rank).where(F.col("rank") <= count).select(
            "key", F.col("node").alias("a"), F.col("root").alias("hub_root")
        )
        pairs = left.join(stored(hubs, "hubs"), "key").where("a < node and hub_root <> root")
        pairs = pairs.select("a", F.col("node").alias("b")).distinct()
        pairs = stored(pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        if not pairs.isEmpty():
            tried = stored(tried.union(verify(pairs)), "tried")
        elif count >= most:
            return roots
        # Buckets that are done stay out: their nodes are connected for good.
        buckets = left.select("key", "node")
        count *= MORE_HUBS


def text_classes(
    docs: DataFrame,
    similar: float = SIMILAR,
    words: int = WORDS,
    bands: int = BANDS,
    band_rows: int = BAND_ROWS,
) -> DataFrame:
    """(doc_id, text_hash, component_id): a row per document with its class.

    Equal texts are one node. Nodes meet where a band of their signatures agrees, which
    at similarity 0.8 at least one band does with a probability of 0.99995, and link if
    the exact Jaccard similarity of their shingle sets is at least ``similar``.
    ``component_id`` is the smallest doc_id in reach; null ids are never the smallest, and a
    class of nothing else has a null id. A null text counts as empty; texts without words
    are alike. Columns besides doc_id and text are not read. An empty table has no rows.
    """
    docs = docs.select("doc_id", "text")
    prints = stored(band_keys(docs, words, bands, band_rows), "signatures")
    first = prints.groupBy("text_hash").agg(F.min("doc_id").alias("doc_id"))
    first = stored(first, "texts")
    keyed = prints.select("text_hash", F.explode("keys").alias("key"))
    low, high = F.min("text_hash").alias("a"), F.max("text_hash").alias("high")
    hubs = keyed.groupBy("key").agg(low, high).where("a < high").drop("high")
    members = keyed.join(stored(hubs, "hubs"), "key").where("a <> text_hash")
    members = members.select("key", "a", F.col("text_hash").alias("b")).distinct()
    roots = connect(
        stored(members, "members"), lambda pairs: jaccard(docs, first, pairs, words), similar
    )
    known = first.join(roots.withColumnRenamed("node", "text_hash"), "text_hash", "left")
    known = stored(known.withColumn("root", F.coalesce("root", "text_hash")), "rooted-texts")
    lowest = stored(known.groupBy("root").agg(F.min("doc_id").alias("component_id")), "lowest")
    label = stored(known.join(lowest, "root").select("text_hash", "component_id"), "labels")
    return prints.select("doc_id", "text_hash").join(label, "text_hash").select(
        "doc_id", "text_hash", "component_id"
    )


def near_duplicates(docs: DataFrame, similar: float = SIMILAR, words: int = WORDS) -> DataFrame:
    """(doc_id, component_id) of every row, by ``text_classes``."""
    return text_classes(docs, similar, words).drop("text_hash")
