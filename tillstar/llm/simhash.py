"""SimHash near-duplicates with pivot distance tables.

Fingerprints link when few bits differ. Two tables cut the comparisons:

- Keys. Bits are cut into blocks. If at most d of them differ, all but d blocks are
  equal, so fingerprints that link share the key of at least one choice of blocks. Only
  fingerprints under one key are compared, and no link is lost.
- Pivots. The distances of every fingerprint to fixed reference fingerprints are
  computed once. By the triangle inequality, a pair whose distances to some reference
  differ by more than d cannot link. Only pairs that pass all references are verified
  bit by bit.

Distances to references alone would need every pair: for 64 bits they hardly spread
(deviation 4), so no range of them is both narrow and complete.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import column_of, small_batches, stored, word_chunks
from tillstar.llm.components import components

WORDS = 4
MAX_BITS = 4
PIVOTS = 32
# Fingerprints under one key that are compared in one task.
CHUNK = 4096
_SEED = 42
_FEW = 8


def _hashes(tokens: list[bytes], size: int) -> np.ndarray:
    line = b" ".join(tokens)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(tokens) - size + 1].tolist()
    hashed = xxhash.xxh64_intdigest
    return np.array(
        [hashed(line[a:b], _SEED) for a, b in zip(starts, ends[size - 1 :].tolist())], "<u8"
    )


def _bit_counts(values: np.ndarray) -> np.ndarray:
    """How often each bit is set. Sums of 255 rows fit a byte."""
    bits = np.zeros((-(-len(values) // 255) * 255, 64), np.uint8)
    view = values.view(np.uint8).reshape(len(values), 8)
    bits[: len(values)] = np.unpackbits(view, axis=1, bitorder="little")
    return bits.reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)


def fingerprint_of(raw: bytes, words: int = WORDS) -> int:
    """The unsigned 64-bit SimHash of a UTF-8 text; 0 if it has no word."""
    counts, n, tokens = np.zeros(64, np.int64), 0, []
    for more in word_chunks(raw.lower()):  # of bytes: folds A-Z only
        tokens = tokens + more
        if len(tokens) >= words:
            values = _hashes(tokens, words)
            counts += _bit_counts(values)
            n += len(values)
            tokens = tokens[len(tokens) - words + 1 :]
    if not n and tokens:
        counts, n = _bit_counts(_hashes(tokens, len(tokens))), 1
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, text_hash, fingerprint) of every row; the fingerprint as a signed long."""
    docs = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    schema = docs.drop("text").withColumn("fingerprint", F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            raw = column_of(batch, "text").cast(pa.binary())
            values = [fingerprint_of(x.as_py() or b"", words) for x in raw]
            yield pa.RecordBatch.from_arrays(
                [
                    column_of(batch, "doc_id"),
                    column_of(batch, "text_hash"),
                    pa.array(np.array(values, np.uint64).view(np.int64)),
                ],
                names=["doc_id", "text_hash", "fingerprint"],
            )

    return docs.mapInArrow(run, schema)


def _block_masks(blocks: int) -> list[int]:
    edges = [64 * k // blocks for k in range(blocks + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]


def key_masks(rows: int, max_bits: int = MAX_BITS) -> list[int]:
    """Masks of the key tables: every choice of all but ``max_bits`` blocks.

    More blocks make longer keys and more tables; the fewest are taken that leave about
    one chance neighbour per key. The links found do not depend on it.
    """
    blocks = max_bits + 2
    while rows > 2 ** (64 * (blocks - max_bits) // blocks) and blocks < max_bits + 8:
        blocks += 1
    choices = itertools.combinations(_block_masks(blocks), blocks - max_bits)
    return [sum(choice) for choice in choices]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def references(pivots: int) -> np.ndarray:
    return np.random.default_rng(_SEED).integers(0, 1 << 64, pivots, np.uint64)


def pivot_table(values: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.bitwise_count(values[:, None] ^ pivots[None, :]).astype(np.int8)


def _links(values, table, i, j, max_bits):
    """Which pairs (i, j) link: by the pivot table first, then bit by bit."""
    near = np.flatnonzero(np.abs(table[i] - table[j]).max(axis=1) <= max_bits)
    linked = np.bitwise_count(values[i[near]] ^ values[j[near]]) <= max_bits
    return near[linked]


def _groups(values: np.ndarray, table: np.ndarray, max_bits: int) -> np.ndarray:
    """Component number of each fingerprint under one key: what a fingerprint reaches is
    taken out, so that a dense group costs few comparisons."""
    number = np.zeros(len(values), np.int64)
    left = np.arange(len(values))
    count = 0
    while len(left):
        count += 1
        todo, left = [left[0]], left[1:]
        number[todo[0]] = count
        while todo and len(left):
            x = todo.pop()
            hit = _links(values, table, np.full(len(left), x), left, max_bits)
            number[left[hit]] = count
            todo += left[hit].tolist()
            left = np.delete(left, hit)
    return number


def _linker(max_bits: int, pivots: np.ndarray):
    """Of rows sorted by key and chunk: links as (a, b), a > b; and, where a key has a
    hub, what has an open fingerprint in it and does not reach the hub, as (a, null) with
    the key."""
    names = ["a", "b", "mask", "key"]

    def segment(values, is_open, mask, key, hub):
        values, at = np.unique(values, return_inverse=True)
        open_ = np.zeros(len(values), bool)
        np.logical_or.at(open_, at, is_open)
        number = _groups(values, pivot_table(values, pivots), max_bits)
        order = np.argsort(number, kind="stable")
        cuts = np.flatnonzero(np.diff(number[order], prepend=0))
        rests, lows, away = [], [], []
        for rows in np.split(order, cuts[1:]):
            members = values[rows].view(np.int64)
            low = members.min()
            rests.append(members[members != low])
            lows.append(np.full(len(members) - 1, low))
            if hub is not None and open_[rows].any() and hub not in members:
                away.append(members)
        rest = np.concatenate(rests)
        yield rest, np.concatenate(lows), np.zeros(len(rest), bool), mask, key
        if away:
            others = np.concatenate(away)
            yield others, others, np.ones(len(others), bool), mask, key

    def block(df):
        """Whole segments."""
        mask, key, chunk, fp, is_open, hub = df
        new = np.ones(len(fp), bool)
        new[1:] = (mask[1:] != mask[:-1]) | (key[1:] != key[:-1]) | (chunk[1:] != chunk[:-1])
        starts = np.append(np.flatnonzero(new), len(fp))
        sizes = np.diff(starts)
        of = np.cumsum(new) - 1
        values = fp.view(np.uint64)
        # Small segments all at once: each row with the row d places on.
        few = (sizes <= _FEW) & (sizes > 1)
        few &= ~hub[1][starts[:-1]]
        i = np.flatnonzero(few[of])
        table = pivot_table(values, pivots) if len(i) else None
        for d in range(1, _FEW):
            i = i[i + d < len(fp)]
            i = i[of[i] == of[i + d]]
            if not len(i):
                break
            hit = i[_links(values, table, i, i + d, max_bits)]
            pair = np.sort(np.stack([fp[hit], fp[hit + d]]), axis=0)
            yield pair[1], pair[0], np.zeros(len(hit), bool), None, None
        for k in np.flatnonzero((sizes > 1) & ~few):
            rows = slice(starts[k], starts[k + 1])
            at = starts[k]
            its_hub = hub[0][at] if hub[1][at] else None
            yield from segment(values[rows], is_open[rows], mask[at], key[at], its_hub)

    def arrays(batch):
        hub = column_of(batch, "hub")
        return [
            *(column_of(batch, n).to_numpy() for n in ("mask", "key", "chunk", "fingerprint")),
            column_of(batch, "open").to_numpy(zero_copy_only=False),
            (hub.fill_null(0).to_numpy(), hub.is_valid().to_numpy(zero_copy_only=False)),
        ]

    def cut(df, a, b):
        return [(x[0][a:b], x[1][a:b]) if isinstance(x, tuple) else x[a:b] for x in df]

    def join(one, two):
        return [
            (np.concatenate([x[0], y[0]]), np.concatenate([x[1], y[1]]))
            if isinstance(x, tuple)
            else np.concatenate([x, y])
            for x, y in zip(one, two)
        ]

    def out(parts):
        for a, b, alone, mask, key in parts:
            if len(a):
                where = [pa.nulls(len(a), pa.int64())] * 2
                if mask is not None:
                    where = [pa.array(np.full(len(a), x, np.int64)) for x in (mask, key)]
                columns = [pa.array(a), pa.array(b, mask=alone), *where]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            df = arrays(batch) if rest is None else join(rest, arrays(batch))
            mask, key, chunk = df[:3]
            last = (mask == mask[-1]) & (key == key[-1]) & (chunk == chunk[-1])
            end = int(np.argmax(last))
            yield from out(block(cut(df, 0, end))) if end else ()
            rest = cut(df, end, len(key))
        if rest is not None:
            yield from out(block(rest))

    return run


_KEY = ["mask", "key"]


def _compared(rows: DataFrame, max_bits: int, pivots: np.ndarray) -> DataFrame:
    place = [*_KEY, "chunk"]
    rows = rows.select(*place, "fingerprint", "open", "hub").repartition(*place)
    return rows.sortWithinPartitions(*place, "fingerprint").mapInArrow(
        _linker(max_bits, pivots), "a long, b long, mask long, key long"
    )


def _keyed(distinct: DataFrame, masks: list[int]) -> DataFrame:
    mask = F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask")
    rows = distinct.select("fingerprint", F.lit(True).alias("open"), mask)
    return rows.withColumn("key", F.col("fingerprint").bitwiseAND(F.col("mask")))


def finer_masks(mask: int, max_bits: int, more: int = 2) -> list[int]:
    """Masks that hold a mask and all but ``max_bits`` of max_bits + more blocks of the bits
    it leaves free: what differs in no more bits shares the key of at least one of them."""
    free = [b for b in range(64) if not mask >> b & 1]
    count = min(max_bits + more, len(free))
    more = count - max_bits
    if more < 1:  # whatever shares the key is near
        return [mask]
    edges = [len(free) * k // count for k in range(count + 1)]
    blocks = [sum(1 << b for b in free[a:e]) for a, e in zip(edges, edges[1:])]
    return sorted({mask | sum(choice) for choice in itertools.combinations(blocks, more)})


def _finer(rows: DataFrame, away: DataFrame, max_bits: int) -> DataFrame:
    """The keys' rows under finer keys, open where they did not reach the hub. Finer keys
    without an open row are left out."""
    spark = rows.sparkSession
    # As many rows as there are masks, whatever the data.
    masks = [r.mask for r in away.select("mask").distinct().toLocalIterator()]
    pairs = [(m, _signed(f)) for m in masks for f in finer_masks(m & (1 << 64) - 1, max_bits)]
    finer = F.broadcast(spark.createDataFrame(pairs, "mask long, finer long"))

    def under(df: DataFrame) -> DataFrame:
        key = F.col("fingerprint").bitwiseAND(F.col("finer")).alias("key")
        return df.join(finer, "mask").select(F.col("finer").alias("mask"), key, "fingerprint").distinct()

    opened = stored(under(away.withColumnRenamed("a", "fingerprint")), "open")
    hot = away.select(*_KEY).distinct()
    every = under(rows.join(hot, _KEY, "left_semi"))
    every = every.join(opened.select(*_KEY).distinct(), _KEY, "left_semi")
    flags = opened.withColumn("open", F.lit(True))
    every = every.join(flags, [*_KEY, "fingerprint"], "left")
    return every.withColumn("open", F.coalesce("open", F.lit(False)))


def links(distinct: DataFrame, max_bits: int = MAX_BITS, pivots: int = PIVOTS, chunk: int = CHUNK):
    """Links (a, b) that connect all fingerprints at most ``max_bits`` apart.

    A key with more than ``chunk`` fingerprints is split over tasks. Its lowest
    fingerprint, the hub, joins every part; whatever reaches the hub is connected
    through it. Where others remain, the key's fingerprints go under finer keys, which
    again lose no link, and only finer keys with one of the others in them are compared.
    That ends: each time a third of the bits that a key leaves free is fixed, and a key
    that leaves b bits free has at most 2^b fingerprints.
    """
    refs = references(pivots)
    rows = _keyed(distinct, key_masks(distinct.count(), max_bits))
    n = F.count("*")
    out = None
    while True:
        hot = rows.groupBy(*_KEY).agg(
            F.ceil(n / chunk).cast("int").alias("parts"), F.min("fingerprint").alias("hub")
        )
        hot = stored(hot.where("parts > 1"), "hot-keys")
        part = F.when(F.col("parts").isNull(), F.lit(0)).otherwise(
            F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int")
        )
        dealt = rows.join(hot, _KEY, "left").withColumn("chunk", part)
        every = hot.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        hubs = every.withColumns({"fingerprint": F.col("hub"), "open": F.lit(False)})
        columns = [*_KEY, "chunk", "fingerprint", "open", "hub"]
        dealt = dealt.select(columns).union(hubs.select(columns))
        found = stored(_compared(dealt, max_bits, refs), "compared")
        linked = found.where("b is not null").select("a", "b")
        out = linked if out is None else out.union(linked)
        away = found.where("b is null")
        if hot.isEmpty() or away.isEmpty():
            return out
        rows = stored(_finer(rows, away, max_bits), "finer")


def _first() -> Column:
    """The smallest doc_id, null last; then the smallest text hash."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))


def near_duplicates(docs: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: doc_id, text_hash, fingerprint, component_id, first.

    ``component_id`` is the smallest doc_id that can be reached over links of at most
    ``max_bits`` differing bits, ``first`` the row (doc_id, text_hash) that has it. Null
    texts count as empty and, like any text without words, have fingerprint zero. Null
    ids are never the smallest: a group of nothing else has a null id. Repeated rows are
    members of one group. Columns besides doc_id and text are not read.
    """
    prints = stored(fingerprints(docs, words), "fingerprints")
    distinct = prints.groupBy("fingerprint").agg(_first().alias("first"))
    distinct = stored(distinct, "distinct")
    roots = components(links(distinct.select("fingerprint"), max_bits))
    member = distinct.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    member = stored(
        member.withColumn("root", F.coalesce("root", "fingerprint")), "members"
    )
    firsts = stored(member.groupBy("root").agg(F.min("first").alias("first")), "firsts")
    label = member.drop("first").join(firsts, "root").select("fingerprint", "first")
    return prints.join(stored(label, "labels"), "fingerprint").select(
        "doc_id",
        "text_hash",
        "fingerprint",
        F.col("first.doc_id").alias("component_id"),
        F.struct("first.doc_id", "first.text_hash").alias("first"),
    )


def keep_one(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """The documents without near-duplicates: of each group its first row.

    Of rows that agree in doc_id and text, but not in other columns, the one with the
    smallest hash of all columns stays, whatever the partitions.
    """
    first = groups.select(
        F.col("first.doc_id").alias("__doc_id"), F.col("first.text_hash").alias("__text_hash")
    ).distinct()
    rows = docs.select(
        F.struct("*").alias("__row"), "doc_id", F.xxhash64("text").alias("text_hash")
    )
    rows = rows.join(
        first,
        F.col("doc_id").eqNullSafe(F.col("__doc_id"))
        & F.col("text_hash").eqNullSafe(F.col("__text_hash")),
        "left_semi",
    )
    # Repeated rows share both columns: one of them stays.
    one = F.min_by("__row", F.xxhash64("__row")).alias("__row")
    return rows.groupBy("doc_id", "text_hash").agg(one).select("__row.*")
