"""MinHash fingerprints and their comparison; ``minhash_classes`` groups texts with them.

A text's words, A-Z in lower case, make overlapping shingles of five. Each of many
universal hash functions permutes the shingles; the smallest value of each is a component
of the signature. The share of equal components estimates the Jaccard similarity of two
texts. Everything per word and per shingle is numpy over whole batches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm.common import column_of, small_batches, stored, text_buffer, text_or_empty

WORDS = 5
COMPONENTS = 128
# Documents in a range of ids, and how many ranges there are at most.
PER_PART, MOST_PARTS = 2_000, 10_000
_SEED = 42
_CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_IS_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_LOWER = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class Hasher:
    """The hash functions of a signature."""

    def __init__(self, words: int = WORDS, count: int = COMPONENTS):
        self.words, self.count = words, count
        random = np.random.default_rng(_SEED)
        self.times = random.integers(0, 1 << 64, count, np.uint64) | np.uint64(1)
        self.plus = random.integers(0, 1 << 64, count, np.uint64)
        self.up = self.down = np.zeros(0, np.uint64)

    def _words(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and hash of every word of a piece of text that cuts no word in two."""
        if len(data) > len(self.up):
            self.up = _powers(_BASE, len(data))
            self.down = _powers(pow(_BASE, -1, 1 << 64), len(data))
        space = _IS_SPACE[data]
        edge = np.flatnonzero(np.diff(space, prepend=True, append=True))
        start, end = edge[::2], edge[1::2]
        # The sum of byte * base^place over a word, brought back to place 0.
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((_LOWER[data] + 1).astype(np.uint64) * self.up[: len(data)], out=sums[1:])
        hashed = (sums[end] - sums[start]) * self.down[start] if len(start) else sums[:0]
        return start, _mix(hashed + (end - start).astype(np.uint64))

    def word_hashes(self, data: np.ndarray, begin: int, end: int):
        starts, hashes, at = [], [], begin
        while at < end:
            stop = min(at + _CHUNK, end)
            while stop < end and not _IS_SPACE[data[stop - 1]]:
                later = np.flatnonzero(_IS_SPACE[data[stop : stop + _CHUNK]])
                stop = min(stop + (int(later[0]) + 1 if len(later) else _CHUNK), end)
            start, hashed = self._words(data[at:stop])
            starts.append(start + at)
            hashes.append(hashed)
            at = stop
        if not starts:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        return np.concatenate(starts), np.concatenate(hashes)

    def shingles(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(hash of every shingle, 64 bits; how many each row has).

        A text of fewer words is one shingle, one without words has none.
        """
        # Texts touch in the buffer: a line break after each keeps their words apart.
        column = pa.array([t + "\n" if t else "\n" for t in column.to_pylist()], pa.large_string())
        data, offsets = text_buffer(column)
        starts, words = self.word_hashes(data, int(offsets[0]), int(offsets[-1]))
        bounds = np.searchsorted(starts, offsets)
        n_words = np.diff(bounds)
        n = np.where(n_words >= self.words, n_words - self.words + 1, np.minimum(n_words, 1))
        row = np.repeat(np.arange(len(n)), n)
        first = bounds[:-1][row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        size = np.minimum(n_words, self.words)[row]
        out = size.astype(np.uint64)
        for k in range(self.words):
            word = words[np.minimum(first + k, max(len(words) - 1, 0))] if len(row) else out
            out = np.where(k < size, _mix(out * np.uint64(_BASE) + word), out)
        return out, n

    def signatures(self, column: pa.Array) -> np.ndarray:
        """One row of 16-bit components per text; all ones for a text without words."""
        hashed, n = self.shingles(column)
        out = np.full((len(n), self.count), 0xFFFF, np.uint16)
        some = np.flatnonzero(n)
        if len(some):
            begin = (np.cumsum(n) - n)[some]
            x = hashed >> np.uint64(32)
            t = np.empty_like(x)
            for k in range(self.count):
                np.multiply(x, self.times[k], out=t)
                np.add(t, self.plus[k], out=t)
                low = np.minimum.reduceat(t, begin)
                out[some, k] = (low >> np.uint64(32)).astype(np.uint16)
        return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(axis=1)


def _hex(signatures: np.ndarray) -> list[str]:
    return [x.astype(">u2").tobytes().hex() for x in signatures]


def fingerprints(docs: DataFrame, words: int = WORDS, count: int = COMPONENTS) -> DataFrame:
    """(doc_id, fingerprint) of every row: the signature as hex digits, four a component.

    A null text counts as empty; a text without words has a signature of ones only.
    """
    docs = docs.select("doc_id", "text")
    schema = docs.drop("text").withColumn("fingerprint", F.lit("")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(words, count)
        for batch in small_batches(batches, most=_CHUNK):
            found = _hex(hasher.signatures(column_of(batch, "text")))
            yield pa.RecordBatch.from_arrays(
                [column_of(batch, "doc_id"), pa.array(found)], names=["doc_id", "fingerprint"]
            )

    return docs.mapInArrow(run, schema)


# --- every document against its edited text and the next document --------------------


def _part(bounds: list[int]) -> Column:
    """How many of the ascending bounds are below doc_id, looked up in two steps."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[k : k + step] for k in range(0, len(bounds), step)]

    def below(values: Column) -> Column:
        return F.size(F.filter(values, lambda b: b < F.col("doc_id")))

    def literal(values: list[int]) -> Column:
        return F.array(*[F.lit(v).cast("long") for v in values])

    group = below(literal([g[0] for g in groups]))
    inside = F.element_at(F.array(*map(literal, groups)), F.greatest(group, F.lit(1)))
    part = F.when(group == 0, F.lit(0)).otherwise((group - 1) * step + below(inside))
    return F.coalesce(part, F.lit(0)).cast("int")


def _in_order(docs: DataFrame, per_part: int) -> DataFrame:
    """Documents dealt by ranges of doc_id, each range followed by the next one's first.

    The bounds are fixed before anything is dealt, one for ``per_part`` documents but at
    most MOST_PARTS, so that bounds and first rows stay small; a range is sorted on disk
    and streamed, however long it is. The first document of a range is found by its id,
    so no text waits for another task.
    """
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    parts = min(max(1, -(-docs.count() // per_part)), MOST_PARTS)
    bounds = []
    if parts > 1:
        shares = [k / parts for k in range(1, parts)]
        accuracy = 20 * parts
        found = rows.agg(F.percentile_approx("doc_id", shares, accuracy)).first()[0]
        bounds = sorted({int(b) for b in found or []})
    rows = rows.withColumn("part", _part(bounds)).withColumn("tie", F.xxhash64("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie")]
    # One row per range, each with the range before it that has rows.
    known = F.col("doc_id").isNotNull().alias("known")
    first = rows.groupBy("part").agg(F.min(F.struct(known, "doc_id", "tie")).alias("f"))
    first = stored(first.select("part", "f.doc_id", "f.tie"), "firsts")
    by_part = Window.orderBy("part")
    last = F.max("part").over(Window.partitionBy())
    first = first.select(
        F.col("doc_id").alias("its_id"),
        F.col("tie").alias("its_tie"),
        F.coalesce(F.lag("part").over(by_part), last).alias("before"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("its_id")) & (F.col("tie") == F.col("its_tie"))
    # At most MOST_PARTS rows.
    heads = rows.join(F.broadcast(first), same).groupBy("before").agg(
        F.first("doc_id").alias("doc_id"), F.first("text").alias("text"), F.first("tie").alias("tie")
    )
    heads = heads.select("doc_id", "text", F.col("before").alias("part"), "tie", F.lit(1).alias("head"))
    rows = rows.withColumn("head", F.lit(0)).unionByName(heads)
    return rows.repartition(parts, "part").sortWithinPartitions("part", "head", *order)


def compare_with_next(
    docs: DataFrame, words: int = WORDS, count: int = COMPONENTS, per_part: int = PER_PART
) -> DataFrame:
    """Fingerprints of every text, of its edited text, and how alike they are.

    The edited text ends, instead of in the last quarter of the code points, in the first
    as many of the next document by doc_id (all, if it has fewer); the first follows the
    last. Null ids come first and ties go by a hash of the text. A null text counts as
    empty. Repeated rows follow each other.
    """
    ids = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {ids}, n_chars long, edited_sha256 string, fingerprint string,"
        " edited_fingerprint string, near_edited double, near_next double"
    )
    names = [f.split()[0] for f in schema.split(", ")]

    def out(hasher, doc_ids, texts, following):
        edited = []
        for text, after in zip(texts, following):
            k = len(text) // 4
            edited.append(text[: len(text) - k] + after[:k])
        own = hasher.signatures(pa.array([*texts, following[-1]], pa.large_string()))
        changed = hasher.signatures(pa.array(edited, pa.large_string()))
        digests = [hashlib.sha256(t.encode("utf-8")).hexdigest() for t in edited]
        return pa.RecordBatch.from_arrays(
            [
                doc_ids,
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array(digests),
                pa.array(_hex(own[:-1])),
                pa.array(_hex(changed)),
                pa.array(likeness(own[:-1], changed)),
                pa.array(likeness(own[:-1], own[1:])),
            ],
            names=names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(words, count)
        waiting = None  # the last row so far: its successor is in the next batch
        for batch in small_batches(batches, most=_CHUNK):
            doc_ids, texts = column_of(batch, "doc_id"), column_of(batch, "text").to_pylist()
            heads = column_of(batch, "head").to_pylist()
            if waiting is not None:
                doc_ids = pa.concat_arrays([waiting[0], doc_ids])
                texts, heads = [waiting[1], *texts], [waiting[2], *heads]
            # Runs of documents, each with the row after it; a head has no successor.
            start = 0
            for stop in [*np.flatnonzero(heads).tolist(), len(texts) - 1]:
                if stop > start:
                    yield out(
                        hasher, doc_ids.slice(start, stop - start),
                        texts[start:stop], texts[start + 1 : stop + 1],
                    )
                start = stop + 1 if heads[stop] else stop
            ended = bool(heads[-1])
            waiting = None if ended else (doc_ids.slice(len(texts) - 1), texts[-1], 0)

    return _in_order(docs, per_part).mapInArrow(run, schema)
