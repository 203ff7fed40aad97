"""Packing token sequences by sums of squares.

Documents become token ids, cut where they are longer than a sequence. Each piece goes
where the sum over all gaps of (open sequences with that gap)^2 becomes smallest, so that
no gap piles up that later pieces seldom fill.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.alignment import byte_level_tokens
from tillstar.llm.common import LETTERS, column_of, small_batches, worker_cache

CAPACITY = 2048
# Pieces that one task packs. A task ends with a few sequences not full.
PER_TASK = 50_000
# Words of which a worker remembers the ids, about 150 bytes each; twice as many for a
# while. Fewer take less memory and more time.
KNOWN_WORDS = 300_000


# Letters that the tokenizer only brings into lower case, one by one. The capital I with a
# dot becomes two characters.
_LATIN = re.compile(rf"(?!.*İ)[{LETTERS}]+")
# What the tokenizer takes apart before it merges, for ASCII text in lower case.
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+", re.ASCII)
_ENDS = ".,;:!?()*$%&#|"

_TO_SPACES = bytes.maketrans(b"\n\t\r", b"   ")
# a: ASCII letters and digits; full stop: itself and the comma; blank; !: all else.
_CLASSES = bytes(
    ord("a") if chr(c).isalnum() and c < 128 else ord(".") if c in b".," else 32 if c == 32 else ord("!")
    for c in range(256)
)


def _apart(text: bytes) -> bytes:
    """Full stops and commas between a letter and a blank as words of their own; the text
    as it is if some follow other marks, with which they would be one piece."""
    classes = text.translate(_CLASSES)
    if b".. " in classes or b"!. " in classes:
        return text
    return text.replace(b". ", b" . ").replace(b", ", b" , ")


def id_type(largest: int) -> np.dtype:
    return np.dtype("<u2" if largest < 1 << 16 else "<u4")


def _entries(path: str) -> tuple[dict[str, bytes], dict[str, int], list[tuple[str, str]]]:
    """The entries of a tokenizer file, as the bytes they stand for and a line break where a
    word ends, and as numbers; its merges in order."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    numbers = model["vocab"]
    ending = {t for t in numbers if t.endswith("</w>")}
    inside = byte_level_tokens({t: k for t, k in numbers.items() if t not in ending})
    at_end = byte_level_tokens({t.removesuffix("</w>"): numbers[t] for t in ending} or {"": 0})
    bytes_of = {t: at_end[k] + b"\n" if t in ending else inside[k] for t, k in numbers.items()}
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    return bytes_of, numbers, merges


def _ranks(bytes_of: dict[str, bytes], merges: list[tuple[str, str]]) -> dict[bytes, int]:
    """The order of merging: bytes, bytes with the end of a word, then the merges."""
    single = [bytes([b]) for b in range(256)]
    made = (bytes_of[left] + bytes_of[right] for left, right in merges)
    return {token: rank for rank, token in enumerate([*single, *(b + b"\n" for b in single), *made])}


@lru_cache
def merges_by_entry(path: str) -> bool:
    """Whether two parts may be merged whenever an entry is what they make together.

    So it is if each entry has one merge, and its bytes, by the merges before that one,
    become the two parts of that merge: what lies within an entry's bytes, and was not
    merged with what lies outside, is merged as if it were alone.
    """
    bytes_of, _, merges = _entries(path)
    ranks = _ranks(bytes_of, merges)
    # As many as there are numbers: no two are the same.
    if len(ranks) < 512 + len(merges) or set(ranks) - {b"\n"} - set(bytes_of.values()):
        return False
    for rank, (left, right) in enumerate(merges, 512):
        token = bytes_of[left] + bytes_of[right]
        if token != bytes_of.get(left + right) or b"\n" in token[:-1]:
            return False
        parts = [token[k : k + 1] for k in range(len(token))]
        while len(parts) > 1:
            made = [ranks.get(x + y, rank) for x, y in zip(parts, parts[1:])]
            k = min(range(len(made)), key=made.__getitem__)
            if made[k] >= rank:
                break
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        if parts != [bytes_of[left], bytes_of[right]]:
            return False
    return True


class WordIds:
    """Token ids of a text as bytes of little-endian numbers, word by word: 16 bits wide,
    or 32 if the vocabulary has more than 65,536 entries (``dtype``).

    The tokenizer folds case, drops white space and never joins across it, so a text's ids
    are those of its words, and a word met before need not be tokenized again. New words
    are taken apart into the pieces that are merged by themselves. Pieces of Latin letters
    or ASCII marks are merged together in one call by a faster library, each with a line
    break at its end, if ``by_entry`` says that entries tell how to (``merges_by_entry``).
    Other letters are tokenized together and told apart by the tokens that end a piece.
    What does not come apart that simply is tokenized as it is.
    """

    def __init__(self, path: str, most: int, by_entry: bool):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.dtype = id_type(max(vocabulary.values()))
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, number in vocabulary.items():
            self.ends[number] = token.endswith("</w>")
        self.merger = None
        if by_entry:
            bytes_of, numbers, merges = _entries(path)
            ranks = _ranks(bytes_of, merges)
            number_of = {bytes_of[t]: k for t, k in numbers.items()}
            self.numbers = np.array([number_of.get(token, 0) for token in ranks])
            self.merger = tiktoken.Encoding(
                "pieces", pat_str=r"[^\n]+\n", mergeable_ranks=ranks, special_tokens={}
            )
        self.most = most
        self.known: dict[str, bytes] = {}
        self.earlier: dict[str, bytes] = {}

    def _pieces(self, word: str) -> list[str]:
        if "<|" in word:  # may be a special token
            return [word]
        if word.isascii():
            return _PIECE.findall(word)
        core = word.rstrip(_ENDS)
        # A letter that ends in a mark in lower case would join what follows.
        apart = core.isalpha() and core[-1].lower()[-1].isalpha() and len(core) < len(word)
        return [core, word[len(core) :]] if apart else [word]

    def _keep(self, pieces: list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        cuts = [0, *((ends + 1) * self.dtype.itemsize).tolist()]
        ids = ids.astype(self.dtype).tobytes()
        self.known.update(zip(pieces, map(ids.__getitem__, map(slice, cuts, cuts[1:]))))

    def _merge_together(self, pieces: list[str]) -> None:
        """Merge pieces of Latin letters or ASCII marks."""
        text = "\n".join([*pieces, ""]).lower()
        ids = self.numbers[self.merger.encode_to_numpy(text, disallowed_special=())]
        self._keep(pieces, ids, np.flatnonzero(self.ends[ids]))

    def _learn_together(self, pieces: list[str]) -> list[str]:
        """Tokenize pieces that each end with one ending token; returns those left over."""
        left = []
        for at in range(0, len(pieces), 1000):
            part = pieces[at : at + 1000]
            ids = self.tokenizer.encode(" ".join(part), add_special_tokens=False).ids
            ends = np.flatnonzero(self.ends[ids])
            if len(ends) != len(part) or not len(ids) or ends[-1] + 1 != len(ids):
                left += part
                continue
            self._keep(part, np.array(ids), ends)
        return left

    def _learn(self, words: set[str]) -> None:
        known, earlier = self.known, self.earlier
        for word in words.intersection(earlier):
            known[word] = earlier[word]
        words = words.difference(earlier)
        # Letters only are one piece; the rest is taken apart first.
        pieces = {w for w in words if w.isalpha()}
        apart = {w: self._pieces(w) for w in words.difference(pieces)}
        pieces.update(p for its in apart.values() for p in its if p not in known)
        simple = []
        if self.merger:
            simple = [p for p in pieces if ("<|" not in p if p.isascii() else _LATIN.fullmatch(p))]
            self._merge_together(simple)
        pieces.difference_update(simple)
        letters = [p for p in pieces if p.isalpha()]
        rest = [*pieces.difference(letters), *self._learn_together(letters)]
        for at in range(0, len(rest), 10_000):
            part = rest[at : at + 10_000]
            encoded = self.tokenizer.encode_batch_fast(part, add_special_tokens=False)
            for word, its in zip(part, encoded):
                known[word] = np.array(its.ids, self.dtype).tobytes()
        for word, its in apart.items():
            if word not in known:
                known[word] = b"".join([known[p] for p in its])

    def encode(self, texts: list[bytes]) -> list[bytes]:
        split = [_apart(t.lower().translate(_TO_SPACES)).decode().split(" ") for t in texts]
        if len(self.known) > self.most:  # what is not used again goes the next time
            self.earlier, self.known = self.known, {}
        self._learn(set().union(*split).difference(self.known))
        ids = self.known.__getitem__
        return [b"".join(map(ids, words)) for words in split]


def _mixed(values: np.ndarray) -> np.ndarray:
    """Different numbers stay different and come out in no order."""
    values = values.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (values ^ (values >> np.uint64(32))).view(np.int64)


def _checksum(ids: bytes, dtype: np.dtype) -> int:
    return zlib.crc32(np.frombuffer(ids, dtype).astype("<u4"))


def tokenize(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end_id: int = 0,
    keep: tuple[str, ...] = ("doc_id",),
    known_words: int = KNOWN_WORDS,
) -> DataFrame:
    """One row per piece: the kept columns, lot, piece, start, length, ids, ids_crc32.

    A document is its token ids, then ``end_id``; every ``capacity`` tokens make a piece,
    and the last one may be shorter. A null or empty text is the end id alone. Every row
    is a document of its own, also if it or its id occurs again; ``lot`` is a number of
    its own. ``tokenizer`` is the path of a tokenizer file, which executors read. Ids are
    bytes of little-endian 16-bit numbers, of 32-bit ones if the vocabulary needs them;
    the checksum is that of the 32-bit form in either case.
    """
    types = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join(f"`{c}` {types[c]}" for c in keep)
    names = [*keep, "lot", "piece", "start", "length", "ids", "ids_crc32"]
    schema += ", lot long, piece int, start long, length long, ids binary, ids_crc32 long"
    by_entry = merges_by_entry(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"word ids {tokenizer} {known_words}"
        coder = worker_cache(name, lambda: WordIds(tokenizer, known_words, by_entry))
        end, wide = np.array([end_id], coder.dtype).tobytes(), coder.dtype.itemsize
        place, step = TaskContext.get().partitionId() << 36, wide * capacity
        for batch in small_batches(batches, most=4 << 20):
            texts = [t or b"" for t in column_of(batch, "text").cast(pa.binary()).to_pylist()]
            all_ids = [ids + end for ids in coder.encode(texts)]
            pieces = np.array([-(-len(ids) // step) for ids in all_ids])
            row = np.repeat(np.arange(len(pieces)), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            cut = [all_ids[r][p * step : (p + 1) * step] for r, p in zip(row, piece)]
            lot = _mixed(np.arange(place, place + len(pieces)))
            place += len(pieces)
            yield pa.RecordBatch.from_arrays(
                [
                    *(column_of(batch, c).take(pa.array(row)) for c in keep),
                    pa.array(lot[row]),
                    pa.array(piece.astype(np.int32)),
                    pa.array(piece * capacity),
                    pa.array([len(x) // wide for x in cut], pa.int64()),
                    pa.array(cut, pa.binary()),
                    pa.array([_checksum(x, coder.dtype) for x in cut], pa.int64()),
                ],
                names=names,
            )

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, schema)


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece, in the given order.

    Taking a sequence from gap g to g - s changes the sum of squares by
    2 * (open[g - s] - open[g] + 1); filling it up by 1 - 2 * open[g]; a new sequence by
    2 * open[capacity - s] + 1. The smallest gap wins a tie, an open sequence over a new one.
    """
    open_ = np.zeros(capacity + 1, np.int64)
    by_gap: dict[int, list[int]] = {}
    sequence = np.zeros(len(lengths), np.int64)
    offset = np.zeros(len(lengths), np.int64)
    count, never = 0, np.int64(1 << 62)
    for k, s in enumerate(lengths.tolist()):
        gap = capacity
        if s < capacity:
            there = open_[s:capacity]
            change = 2 * (open_[: capacity - s] - there + 1)
            change[0] = 1 - 2 * there[0]
            change[there == 0] = never
            best = int(change.argmin())
            if change[best] <= 2 * open_[capacity - s] + 1:
                gap = s + best
        if gap == capacity:
            number, count = count, count + 1
        else:
            number = by_gap[gap].pop()
            open_[gap] -= 1
        sequence[k], offset[k] = number, capacity - gap
        if gap > s:
            open_[gap - s] += 1
            by_gap.setdefault(gap - s, []).append(number)
    return sequence, offset


def pack(pieces: DataFrame, capacity: int = CAPACITY, per_task: int = PER_TASK) -> DataFrame:
    """Add sequence_id and offset to pieces with the columns lot and length.

    Pieces are dealt at random to as many tasks as ``per_task`` asks for, whatever
    document they come from. Within a sequence pieces follow each other without gaps. The
    table is counted first, so pass a stored one. Other columns pass through.
    """
    tasks = max(1, -(-pieces.count() // per_task))
    # A document's pieces spread too.
    block = F.pmod(F.xxhash64("lot", "start"), F.lit(tasks)).cast("int")
    schema = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields
    ) + ", sequence_id long, offset long"
    names = [*pieces.columns, "sequence_id", "offset"]

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([("lot", "ascending"), ("start", "ascending")])
        lot, length = table["lot"].to_numpy(), table["length"].to_numpy()
        order = np.argsort(-length, kind="stable")  # the small ones fill what is still open
        sequence, offset = np.zeros(len(lot), np.int64), np.zeros(len(lot), np.int64)
        sequence[order], offset[order] = place(length[order], capacity)
        sequence += int(table["__block"][0].as_py()) << 32
        table = table.drop_columns(["__block"])
        table = table.append_column("sequence_id", pa.array(sequence))
        return table.append_column("offset", pa.array(offset)).select(names)

    return pieces.withColumn("__block", block).groupBy("__block").applyInArrow(run, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids): the pieces of each sequence put together by offset, for
    packed pieces that kept their ids. A group holds one sequence, at most its capacity."""
    parts = F.transform(
        F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("ids")))), lambda p: p.ids
    )
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"), F.unhex(F.array_join(parts, "")).alias("ids")
    )
