"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

The places where a token ends, counted in bytes, are dictionaries from end to index, one
per tokenizer. Ends that both have, a hash-set intersection, cut the two id lists into
groups; within a group, tokens whose bytes overlap are linked. Texts are taken apart where
both tokenizers begin a token, so that a part met before need not be aligned again, and a block of documents is a list of its different parts and, for every
document, their numbers. How many documents hold a pair of ids linked is summed up per
block before anything is shuffled.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import (
    LETTERS,
    MARKS,
    column_of,
    parts_of,
    small_batches,
    stored,
    worker_cache,
)

# Text of a block of documents; a longer document is a block of its own.
BLOCK = 8 << 20
# Parts of which a worker remembers the alignment from one block to the next, about 250
# bytes each.
KNOWN_PARTS = 120_000
_PIECE = 1 << 20
_BYTE = re.compile("<0x([0-9A-F]{2})>")
_WORD, _BARE = re.compile(r" \S+"), re.compile(r"\S+")
_B_BITS = (1 << 32) - 1


def byte_level_tokens(vocabulary: dict[str, int]) -> list[bytes]:
    """The bytes of a byte-level vocabulary's entries. Printable Latin-1 stands for itself,
    the other bytes, in order, for the characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in plain}
    byte_of |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    out = [b""] * (max(vocabulary.values()) + 1)
    for entry, number in vocabulary.items():
        known = all(c in byte_of for c in entry)
        out[number] = bytes(byte_of[c] for c in entry) if known else entry.encode()
    return out


def piece_bytes(piece: str) -> bytes:
    """A piece in UTF-8, U+2581 as a blank, <0xHH> as that byte."""
    byte = _BYTE.fullmatch(piece)
    return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()


def common_ends(a_ends: list[int], b_ends: list[int]) -> tuple[list[int], list[int]]:
    """Up to where each group reaches in both id lists."""
    a_at = dict(zip(a_ends, range(1, len(a_ends) + 1)))
    b_at = dict(zip(b_ends, range(1, len(b_ends) + 1)))
    common = sorted(a_at.keys() & b_at.keys())
    return [a_at[end] for end in common], [b_at[end] for end in common]


def links(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of all tokens whose bytes overlap, ascending: what token i reaches over in
    the other list, which lies within its group."""
    if not len(a_ends):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low = np.searchsorted(b_ends, np.append(0, a_ends[:-1]), side="right")
    n = np.searchsorted(b_ends, a_ends) - low + 1
    i = np.repeat(np.arange(len(n)), n)
    return i, np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())


class _Growing:
    """A numpy array that rows are added to."""

    def __init__(self, kind: type, width: tuple[int, ...] = ()):
        self._all, self._n = np.empty((1024, *width), kind), 0

    @property
    def rows(self) -> np.ndarray:
        return self._all[: self._n]

    def extend(self, more: np.ndarray) -> None:
        n = self._n + len(more)
        if n > len(self._all):
            wider = np.empty((max(n, 2 * len(self._all)), *self._all.shape[1:]), self._all.dtype)
            wider[: self._n] = self.rows
            self._all = wider
        self._all[self._n : n] = more
        self._n = n


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its size says, one after the other."""
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


class Aligner:
    """Alignments of parts of texts, by the number that ``number`` gives a part: ``counts``
    (A's tokens, B's, groups; -1 if a tokenizer does not give the part's bytes back),
    ``texts`` (the groups), ``ends`` and ``pairs`` (linked id pairs as 64-bit numbers, and up
    to where they are of which part). Parts met before are remembered."""

    def __init__(self, a_path: str, b_path: str, most: int):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True  # their strings are text like any other
        self.b = SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.a_tokens = byte_level_tokens(self.a.get_vocab())
        self.b_tokens = [piece_bytes(p) for p in pieces]
        self.a_size = np.array([len(t) for t in self.a_tokens])
        self.b_size = np.array([len(t) for t in self.b_tokens])
        # Ids as text, with what follows one: another of its list, B's list, the next group
        # or part.
        n_a, n_b = len(self.a_size), len(self.b_size)
        self.most_ids = max(n_a, n_b)
        kinds = ((self.most_ids, ","), (n_a, "|"), (n_b, ";"), (n_b, "\n"))
        self.text = [f"{k}{mark}" for n, mark in kinds for k in range(n)]
        self.bar, self.semicolon = self.most_ids, self.most_ids + n_a
        self.line = self.semicolon + n_b
        # A part without a blank is encoded after a line break, which no piece holds, and
        # the blank that the model puts before that.
        self.lead = self.b.encode("\n")
        # Texts are not cut where a piece may reach over. Control pieces are no text.
        two = re.compile(f"[{LETTERS}][{MARKS}]|[{MARKS}][{LETTERS}]|\n|[^▁]▁")
        self.whole_only = any(
            two.search(piece)
            for k, piece in enumerate(pieces)
            if not (self.b.is_control(k) or self.b.is_unknown(k) or self.b.is_byte(k))
        )
        self.most = most
        self._clear()

    def _clear(self) -> None:
        self.number: dict[object, int] = {}  # in ascending order
        self.texts: list[str] = []
        self._counts, self._ends = _Growing(np.int32, (3,)), _Growing(np.int64)
        self._pairs, self._used = _Growing(np.int64), _Growing(np.int64)

    @property
    def counts(self) -> np.ndarray:
        return self._counts.rows

    def links_of(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of links of each part, and the linked pairs of one after the other."""
        ends = self._ends.rows
        starts = np.append(0, ends)[parts]
        sizes = ends[parts] - starts
        return sizes, self._pairs.rows[_spans(starts, sizes)]

    def use(self, parts: np.ndarray, times: np.ndarray) -> None:
        self._used.rows[parts] += times

    def forget(self) -> None:
        """Keep at most ``most`` parts, those used most often, of late above all. Numbers
        change: not to be called while some are in use."""
        if len(self.number) <= self.most:
            return
        used, counts, texts = self._used.rows, self.counts, self.texts
        kept = np.sort(np.argpartition(-used, self.most)[: self.most])
        wanted = np.zeros(len(used), bool)
        wanted[kept] = True
        parts = list(compress(self.number, wanted.tolist()))
        sizes, pairs = self.links_of(kept)
        self._clear()
        self._add(parts, counts[kept], [texts[k] for k in kept.tolist()], sizes, pairs)
        self._used.rows[:] = used[kept] // 2

    def _add(self, parts: list, counts, texts: list[str], sizes, pairs) -> None:
        begin = len(self.texts)
        self.number.update(zip(parts, range(begin, begin + len(parts))))
        self.texts += texts
        self._counts.extend(counts)
        self._ends.extend(np.cumsum(sizes) + len(self._pairs.rows))
        self._pairs.extend(pairs)
        self._used.extend(np.zeros(len(parts), np.int64))

    def _align(self, parts: list[str]) -> tuple | None:
        """Counts, groups, numbers of links and linked pairs of parts that follow each
        other, the first with the blank before a text or within it: None if a tokenizer
        does not give the bytes back or a token does not end with a part."""
        text = "".join(parts)
        raw = text.encode()
        a = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids
        if text[0] == " ":
            b = self.b.encode(text[1:])
        else:
            b = self.b.encode("\n" + text)[len(self.lead) :]
        back = [b"".join(map(t.__getitem__, ids)) for t, ids in ((self.a_tokens, a), (self.b_tokens, b))]
        if back[0] != raw or back[1] != raw:
            return None
        a, b = np.array(a), np.array(b)
        a_ends, b_ends = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        cuts = np.cumsum([len(p.encode()) for p in parts])
        in_a, in_b = np.searchsorted(a_ends, cuts), np.searchsorted(b_ends, cuts)
        if (a_ends[in_a] != cuts).any() or (b_ends[in_b] != cuts).any():
            return None
        i, j = links(a_ends, b_ends)
        a_to, b_to = map(np.array, common_ends(a_ends.tolist(), b_ends.tolist()))
        # Of each group A's ids, then B's; the last of each list has its own mark behind it.
        a_text, b_text = a.copy(), b.copy()
        a_text[a_to - 1] += self.bar
        b_text[b_to - 1] += self.semicolon
        b_text[in_b] += self.line - self.semicolon
        a_size, b_size = np.diff(a_to, prepend=0), np.diff(b_to, prepend=0)
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + np.repeat(b_to - b_size, a_size)] = a_text
        order[np.arange(len(b)) + np.repeat(a_to, b_size)] = b_text
        texts = "".join(map(self.text.__getitem__, order.tolist())).split("\n")[:-1]
        group = np.searchsorted(a_to, in_a + 1) + 1
        counts = np.diff(np.column_stack([in_a + 1, in_b + 1, group]), prepend=[[0, 0, 0]], axis=0)
        sizes = np.diff(np.searchsorted(i, in_a, side="right"), prepend=0)
        return counts, texts, sizes, a[i] << 32 | b[j]

    def learn(self, parts: set[str]) -> None:
        new = parts.difference(self.number)
        # What holds no white space but a blank before it makes a text together, in which
        # these are parts; what has no blank either is kept apart by line breaks.
        words = [p for p in new if _WORD.fullmatch(p)]
        rest = new.difference(words)
        bare = [p for p in rest if _BARE.fullmatch(p)]
        rest = list(rest.difference(bare))
        for some, lead in ((words, []), (bare, ["\n"])):
            for at in range(0, len(some), 2000):
                run = some[at : at + 2000]
                found = self._align([p for part in run for p in (*lead, part)])
                if found is None:
                    rest += run
                    continue
                counts, texts, sizes, pairs = found
                own = np.arange(len(lead), len(texts), 1 + len(lead))
                if lead:
                    pairs = pairs[_spans((np.cumsum(sizes) - sizes)[own], sizes[own])]
                self._add(run, counts[own], texts[len(lead) :: 1 + len(lead)], sizes[own], pairs)
        for part in rest:
            found = self._align([part])
            none = (np.full((1, 3), -1), [""], np.zeros(1, np.int64), np.zeros(0, np.int64))
            self._add([part], *(none if found is None else found))

    def whole(self, text: str) -> np.ndarray:
        """The number of a text that is one part, for as long as ``forget`` is not called;
        none if a tokenizer does not give it back."""
        found = self._align([text])
        if found is None:
            return np.zeros(0, np.int32)
        self._add([object()], *found)
        return np.array([len(self.texts) - 1], np.int32)


class Block:
    """The documents of one block, as numbers of the different parts they are made of."""

    def __init__(self, aligner: Aligner, texts: list[str | None]):
        aligner.forget()
        self.aligner = aligner
        found: list[list[np.ndarray]] = [[] for _ in texts]
        broken: set[int] = set()
        waiting, size = [], 0
        for row, text in enumerate(texts):
            if text and aligner.whole_only:
                broken.add(row)
                continue
            for parts in parts_of(" " + text) if text else ():
                waiting.append((row, parts))
                size += len(parts)
                if size > _PIECE // 4:  # of a long text, a piece at a time
                    self._take(waiting, found, broken)
                    waiting, size = [], 0
        self._take(waiting, found, broken)
        for row in broken:  # a part does not come back: neither does the text, or as a whole
            found[row] = [aligner.whole(" " + texts[row])]
        self.rows = [np.concatenate([np.zeros(0, np.int32), *f]) for f in found]

    def _take(self, waiting: list[tuple[int, list[str]]], found: list, broken: set[int]) -> None:
        aligner = self.aligner
        aligner.learn(set().union(*[parts for _, parts in waiting]))
        lost = (aligner.counts[:, 0] < 0).any()
        for row, parts in waiting:
            numbers = np.fromiter(map(aligner.number.__getitem__, parts), np.int32, len(parts))
            if lost and (aligner.counts[numbers, 0] < 0).any():
                broken.add(row)
            found[row].append(numbers)

    def groups(self, begin: int, end: int) -> list[str]:
        """The groups of the documents from ``begin`` to ``end``, as text."""
        text_of = self.aligner.texts.__getitem__
        return [";".join(map(text_of, row.tolist())) for row in self.rows[begin:end]]

    def columns(self) -> dict[str, list]:
        """Counts and part numbers per document; and in the first row the block's id pairs,
        how many documents hold each, and the pairs of every part. The parts are numbered
        anew, those of the block only."""
        aligner = self.aligner
        times = np.bincount(np.concatenate(self.rows), minlength=len(aligner.texts))
        used = np.flatnonzero(times)
        aligner.use(used, times[used])
        own_number = np.empty(len(times), np.int32)
        own_number[used] = np.arange(len(used))
        rows = [own_number[row] for row in self.rows]
        counts = aligner.counts[used].astype(np.int64)
        sizes, linked = aligner.links_of(used)
        ends = np.append(0, np.cumsum(sizes))
        different, place = np.unique(linked, return_inverse=True)
        # (document, pair) once each, however often a document holds the pair: the one that
        # was written to its place last.
        holders, last = np.zeros(len(different), np.int64), np.empty(len(different), np.int64)
        seen = np.empty(len(used), np.int64)
        for row in rows:
            seen[row] = np.arange(len(row))
            own = row[seen[row] == np.arange(len(row))]
            at = place[_spans(ends[own], sizes[own])]
            last[at] = np.arange(len(at))
            holders[at[last[at] == np.arange(len(at))]] += 1
        sums = np.array([counts[row].sum(axis=0) for row in rows]).reshape(-1, 3)
        rest = [None] * (len(rows) - 1)
        return {
            "n_a": sums[:, 0].tolist(),
            "n_b": sums[:, 1].tolist(),
            "n_groups": sums[:, 2].tolist(),
            "n_links": [int(sizes[row].sum()) for row in rows],
            "parts": [row.tobytes() for row in rows],
            "pairs": [different, *rest],
            "holders": [holders, *rest],
            "part_pairs": [place.astype(np.int32).tobytes(), *rest],
            "part_ends": [ends.astype(np.int64).tobytes(), *rest],
        }


_COLUMNS = {
    "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(),
    "groups": pa.string(), "parts": pa.binary(), "pairs": pa.list_(pa.int64()),
    "holders": pa.list_(pa.int64()), "part_pairs": pa.binary(), "part_ends": pa.binary(),
}
_SCHEMA = (
    "lot long, n_a long, n_b long, n_groups long, n_links long, groups string, parts binary,"
    " pairs array<long>, holders array<long>, part_pairs binary, part_ends binary"
)
_OF_BLOCK = ("pairs", "holders", "part_pairs", "part_ends")


def align(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    block: int = BLOCK,
    known_parts: int = KNOWN_PARTS,
) -> DataFrame:
    """One row per document: doc_id, lot, n_a, n_b, n_groups, n_links, groups, and the
    columns that ``count_links`` reads.

    ``a_path`` is a byte-level tokenizer file that encodes a blank and the text, ``b_path``
    a piece model that puts the blank there itself; executors read both. No special tokens
    are added, and their names are text like any other. ``groups`` is ``a1,a2|b1;a3|b2``
    in decimal ids. A null or empty text, or one whose bytes a tokenizer does not give
    back, has no tokens: zeros and an empty text. Every row is a document of its own, also
    if it or its id occurs again. ``lot`` numbers the blocks of documents that a task read
    together; the first row of each also carries what the block has in common.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    ids = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = worker_cache(
            f"aligner {a_path} {b_path} {known_parts}",
            lambda: Aligner(a_path, b_path, known_parts),
        )
        lot = TaskContext.get().partitionId() << 36
        for batch in small_batches(batches, most=block):
            documents = Block(aligner, column_of(batch, "text").to_pylist())
            found = documents.columns()
            columns = {name: pa.array(found[name], _COLUMNS[name]) for name in found}
            columns["doc_id"] = column_of(batch, "doc_id")
            columns["lot"] = pa.array(np.full(batch.num_rows, lot))
            del found
            lot += 1
            step = -(-batch.num_rows // 16)  # the groups' text is several times the documents'
            for row in range(0, batch.num_rows, step):
                some = {name: column.slice(row, step) for name, column in columns.items()}
                groups = documents.groups(row, row + step)
                some["groups"] = pa.array(groups, _COLUMNS["groups"])
                names = ["doc_id", "lot", *_COLUMNS]
                yield pa.RecordBatch.from_arrays([some[name] for name in names], names=names)

    return rows.mapInArrow(run, f"doc_id {ids}, {_SCHEMA}")


def _of_blocks(aligned: DataFrame) -> DataFrame:
    """(lot, place, pair, holders): the different id pairs of every block."""
    both = F.arrays_zip("pairs", "holders")
    entries = aligned.where("pairs is not null").select("lot", F.posexplode(both).alias("place", "p"))
    return entries.select("lot", "place", F.col("p.pairs").alias("pair"), "p.holders")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, a_id, b_id, n, best): how many documents hold two ids linked, and whether no
    other partner of the first id is held by more. At most one row per pair of ids."""
    a_id, b_id = F.shiftright("pair", 32), F.col("pair").bitwiseAND(F.lit(_B_BITS))
    totals = _of_blocks(aligned).groupBy("pair").agg(F.sum("holders").alias("n"))
    totals = stored(
        totals.select("pair", a_id.cast("int").alias("a_id"), b_id.cast("int").alias("b_id"), "n"),
        "pairs",
    )
    top = totals.groupBy("a_id").agg(F.max("n").alias("top"))
    return totals.join(top, "a_id").select(
        "pair", "a_id", "b_id", "n", (F.col("n") == F.col("top")).alias("best")
    )


def count_links(aligned: DataFrame) -> DataFrame:
    """Add n_best (links whose pair no other partner of the first id beats) and count_sum
    (the pairs' document counts over all links) to a stored result of ``align``.

    Counts come back per block and pair, not per link, and meet the block's documents; a
    group is one block, whose size is bounded by ``align``. Columns that only serve this
    are dropped.
    """
    kept = [c for c in aligned.columns if c not in ("lot", "parts", *_OF_BLOCK)]
    wide = aligned.select(*kept, "lot", "parts", "part_pairs", "part_ends")
    types = ", ".join(f"`{c}` {aligned.schema[c].dataType.simpleString()}" for c in kept)
    counts = _of_blocks(aligned).join(stored(pair_counts(aligned), "counts"), "pair")
    counts = counts.select(F.col("lot").alias("its_lot"), "place", "n", "best")

    def run(docs: pa.Table, counts: pa.Table) -> pa.Table:
        order = np.argsort(counts["place"].to_numpy())
        n = counts["n"].to_numpy()[order]
        best = counts["best"].to_numpy()[order].astype(np.int64)
        place = np.frombuffer(docs["part_pairs"].drop_null()[0].as_py(), np.int32)
        ends = np.frombuffer(docs["part_ends"].drop_null()[0].as_py(), np.int64)

        def per_part(values: np.ndarray) -> np.ndarray:
            return np.diff(np.concatenate([[0], np.cumsum(values[place])])[ends])

        part_n, part_best = per_part(n), per_part(best)
        found = [np.frombuffer(p.as_py(), np.int32) for p in docs["parts"]]
        out = docs.select(kept)
        out = out.append_column("n_best", pa.array([int(part_best[p].sum()) for p in found], pa.int64()))
        return out.append_column(
            "count_sum", pa.array([int(part_n[p].sum()) for p in found], pa.int64())
        )

    return (
        wide.groupBy("lot")
        .cogroup(counts.groupBy("its_lot"))
        .applyInArrow(run, f"{types}, n_best long, count_sum long")
    )
