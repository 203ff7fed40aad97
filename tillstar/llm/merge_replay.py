"""Byte-level BPE by replaying the merges over many words at once.

The words that a batch of texts brings anew lie behind each other as one row of symbols.
An inverted index lists, for every pair of neighbours that merges, the positions at which
it begins. Merges are applied in rank order, each to all its positions; a merge touches
only its two neighbours, whose new pairs go to the index. So the work grows with the
merges that are made, not with words times merges.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import column_of, parts_of, small_batches, worker_cache

# Parts of texts of which a worker remembers the ids, about 200 bytes each; twice as many
# for a while.
KNOWN_PARTS = 300_000
_SHIFT = 20
_GONE = -2


def read_ranks(path: str) -> dict[bytes, int]:
    """A file of ``base64 rank`` lines."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class MergeReplay:
    """Token ids of words, by ranks that hold every single byte."""

    def __init__(self, ranks: dict[bytes, int]):
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        # Every two tokens that are a token together.
        self.pairs = {
            ranks[token[:k]] << _SHIFT | ranks[token[k:]]: rank
            for token, rank in ranks.items()
            for k in range(1, len(token))
            if token[:k] in ranks and token[k:] in ranks
        }
        keys = np.array(list(self.pairs), np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.merged = np.array(list(self.pairs.values()), np.int32)[order]

    def _index(self, symbols: np.ndarray, ends: np.ndarray) -> dict[int, array]:
        """Ascending positions of the pairs that merge, by the rank of the merge."""
        key = symbols[:-1].astype(np.int64) << _SHIFT | symbols[1:]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        merges = self.keys[at] == key
        merges[ends[:-1] - 1] = False  # no pair reaches over the end of a word
        position = np.flatnonzero(merges)
        rank = self.merged[at[position]]
        order = np.argsort(rank, kind="stable")
        position, rank = position[order].astype(np.int32), rank[order]
        starts = np.flatnonzero(np.diff(rank, prepend=-1))
        return {
            int(rank[a]): array("i", part.tobytes())
            for a, part in zip(starts, np.split(position, starts[1:]))
        }

    def replay(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as bytes of 32-bit numbers; empty ones have none.

        Within a word the lowest rank goes first, of equal ones the leftmost. One sweep
        over a rank does the same for all words as long as it brings up no lower rank. A
        word where it does is done again by itself.
        """
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths)
        filled = ends[lengths > 0]
        data = np.frombuffer(b"".join(words), np.uint8)
        if not len(data):
            return [b"" for _ in words]
        start = self.single[data]
        after = np.arange(1, len(data) + 1, dtype=np.int32)
        after[filled - 1] = -1
        before = np.arange(-1, len(data) - 1, dtype=np.int32)
        before[np.append(0, filled[:-1])] = -1
        index = self._index(start, filled)
        symbol, after, before = (array("i", a.tobytes()) for a in (start, after, before))
        heap = list(index)
        heapq.heapify(heap)
        merged_to, again = self.pairs.get, []
        while heap:
            rank = heapq.heappop(heap)
            todo = np.sort(np.frombuffer(index.pop(rank), np.int32))
            for part in range(0, len(todo), 1 << 16):
                for left in todo[part : part + (1 << 16)].tolist():
                    right = after[left]
                    if right < 0 or merged_to(symbol[left] << _SHIFT | symbol[right]) != rank:
                        continue  # one of the two has merged otherwise
                    symbol[left] = rank
                    following = after[left] = after[right]
                    after[right] = _GONE
                    previous = before[left]
                    touched = []
                    if following >= 0:
                        before[following] = left
                        touched.append((merged_to(rank << _SHIFT | symbol[following]), left))
                    if previous >= 0:
                        touched.append((merged_to(symbol[previous] << _SHIFT | rank), previous))
                    for new, position in touched:
                        if new is None:
                            continue
                        if new in index:
                            index[new].append(position)
                        else:
                            index[new] = array("i", [position])
                            heapq.heappush(heap, new)
                        if new < rank:
                            again.append(left)
        alive = np.frombuffer(after, np.int32) != _GONE
        ids = np.frombuffer(symbol, np.int32)[alive].tobytes()
        cuts = (4 * np.concatenate([[0], np.cumsum(alive)])[np.concatenate([[0], ends])]).tolist()
        out = [ids[a:b] for a, b in zip(cuts, cuts[1:])]
        for word in np.unique(np.searchsorted(ends, again, side="right")).tolist():
            out[word] = self._alone(words[word])
        return out

    def _alone(self, word: bytes) -> bytes:
        """One word, merge by merge."""
        symbol: list = self.single[np.frombuffer(word, np.uint8)].tolist()
        after, before = list(range(1, len(word) + 1)), list(range(-1, len(word) - 1))
        heap: list = []

        def note(left: int) -> None:
            if left >= 0 and after[left] < len(word):
                rank = self.pairs.get(symbol[left] << _SHIFT | symbol[after[left]])
                if rank is not None:
                    heapq.heappush(heap, (rank, left))

        for k in range(len(word)):
            note(k)
        while heap:
            rank, left = heapq.heappop(heap)
            right = after[left]
            if symbol[left] is None or right >= len(word):
                continue
            if self.pairs.get(symbol[left] << _SHIFT | symbol[right]) != rank:
                continue
            symbol[left], symbol[right] = rank, None
            after[left] = after[right]
            if after[left] < len(word):
                before[after[left]] = left
            note(left)
            note(before[left])
        return np.array([s for s in symbol if s is not None], np.int32).tobytes()


def newer_characters() -> set[str]:
    """Characters that are letters or numbers here, but not yet in tiktoken's edition of
    Unicode."""
    import tiktoken

    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    unassigned = "".join(regex.findall(r"[\p{L}\p{N}]", every))
    unassigned = "".join(c for c in unassigned if unicodedata.category(c) == "Cn")
    single = {bytes([b]): b for b in range(256)}
    out: set[str] = set()
    for kind in (r"\p{L}", r"\p{N}"):
        theirs = tiktoken.Encoding("kind", pat_str=kind, mergeable_ranks=single, special_tokens={})
        known = theirs.decode(theirs.encode_ordinary(unassigned))
        out |= set(regex.findall(kind, unassigned)).difference(known)
    return out


class Coder:
    """Texts to ids. The ids of parts met before are remembered."""

    def __init__(self, path: str, pattern: str, most: int):
        self.replay = MergeReplay(read_ranks(path))
        self.match = regex.compile(pattern)
        self.newer = newer_characters()
        # A character that no edition has.
        self.unknown = dict.fromkeys(map(ord, self.newer), "\uffff")
        self.most = most
        self.known: dict[str, bytes] = {}
        self.earlier: dict[str, bytes] = {}

    def words(self, part: str) -> list[str]:
        """The matches of the pattern, letters and numbers as tiktoken knows them."""
        if part.isascii() or self.newer.isdisjoint(part):
            return self.match.findall(part)
        return [part[m.start() : m.end()] for m in self.match.finditer(part.translate(self.unknown))]

    def _learn(self, parts: set[str]) -> None:
        known, earlier = self.known, self.earlier
        for part in parts.intersection(earlier):
            known[part] = earlier[part]
        parts = parts.difference(earlier)
        words = {p: self.words(p) for p in parts}
        own = list(set().union(*words.values()))
        ids = dict(zip(own, self.replay.replay([w.encode() for w in own])))
        for part, its in words.items():
            known[part] = ids[its[0]] if len(its) == 1 else b"".join([ids[w] for w in its])

    def encode(self, parts: list[list[str]]) -> list[bytes]:
        """32-bit ids of lists of parts."""
        if len(self.known) > self.most:  # what is not used again goes the next time
            self.earlier, self.known = self.known, {}
        self._learn(set().union(*parts).difference(self.known))
        ids = self.known.__getitem__
        return [b"".join(map(ids, its)) for its in parts]


def _lists(rows: list[bytes]) -> pa.Array:
    """Bytes of 32-bit numbers as lists of them."""
    ends = np.cumsum([0, *map(len, rows)]) // 4
    values = pa.array(np.frombuffer(b"".join(rows), np.int32))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def encode(
    docs: DataFrame,
    ranks: str,
    pattern: str,
    text: str = "text",
    into: str = "ids",
    known_parts: int = KNOWN_PARTS,
) -> DataFrame:
    """Add the token ids of every whole text, as a list of integers.

    ``ranks`` is the path of a ranks file, which executors read. Every match of
    ``pattern`` is encoded by itself; names of special tokens are text like any other.
    Its matches must not reach over the places at which ``parts_of`` cuts. A null or empty text has no ids. Each row is
    encoded by itself, so repeated rows and null ids need no care; other columns pass
    through, one called ``into`` is replaced. A worker holds a few megabytes of text, or
    the longest one, its ids and the parts that it remembers.
    """
    docs = docs.drop(into).withColumn(into, F.lit(None).cast("array<int>"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = worker_cache(
            f"merge replay {ranks} {pattern} {known_parts}",
            lambda: Coder(ranks, pattern, known_parts),
        )
        for batch in small_batches(batches, text, most=4 << 20):
            rows: list[list[bytes]] = [[] for _ in range(batch.num_rows)]
            parts, of, size = [], [], 0
            for row, whole in enumerate(column_of(batch, text)):
                for some in parts_of(whole.as_py() or ""):
                    parts.append(some)
                    of.append(row)
                    size += len(some)
                    if size > 1 << 20:  # of a long text, a piece at a time
                        for k, its in zip(of, coder.encode(parts)):
                            rows[k].append(its)
                        parts, of, size = [], [], 0
            for k, its in zip(of, coder.encode(parts)):
                rows[k].append(its)
            at = batch.schema.get_field_index(into)
            found = _lists([b"".join(its) for its in rows])
            yield batch.set_column(at, batch.schema.field(at), found)

    return docs.mapInArrow(run, docs.schema)


def decode(docs: DataFrame, ranks: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """Add the bytes that token ids stand for; no ids, or null, stand for none.

    An id without a token fails. Other columns pass through, one called ``into`` is
    replaced.
    """
    docs = docs.drop(into).withColumn(into, F.lit(None).cast("binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def make() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """The bytes of all tokens, where each begins, how long it is (-1: no token)."""
            token_of = {rank: token for token, rank in read_ranks(ranks).items()}
            tokens = [token_of.get(rank) for rank in range(max(token_of) + 1)]
            length = np.array([-1 if t is None else len(t) for t in tokens])
            start = np.cumsum(np.maximum(length, 0)) - np.maximum(length, 0)
            return np.frombuffer(b"".join(t or b"" for t in tokens), np.uint8), start, length

        data, start, length = worker_cache(f"tokens {ranks}", make)
        for batch in batches:
            row = 0
            while row < batch.num_rows:  # about a million ids at a time, or one row
                column = column_of(batch, ids).slice(row)
                size = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False)
                n = max(1, int(np.searchsorted(np.cumsum(size), 1 << 20, side="right")))
                values = column.slice(0, n).flatten().to_numpy(zero_copy_only=False)
                of = length[values]
                if len(of) and of.min() < 0:
                    raise ValueError(f"no token has the id {values[of.argmin()]}")
                ends = np.cumsum(of)
                raw = data[np.repeat(start[values] - ends + of, of) + np.arange(of.sum())]
                cuts = np.append(0, ends)[np.append(0, np.cumsum(size[:n]))]
                found = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), n, [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(raw)]
                )
                part = batch.slice(row, n)
                at = part.schema.get_field_index(into)
                yield part.set_column(at, part.schema.field(at), found.cast(pa.binary()))
                row += n

    return docs.mapInArrow(run, docs.schema)
