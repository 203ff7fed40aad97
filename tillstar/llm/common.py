"""What several operators share: stored intermediates and text out of Arrow batches."""

from __future__ import annotations

import re
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.sinks import shared_path

# A word, everywhere in this package: a run of anything but ASCII white space.
WORD = "[^\\x20\\x09-\\x0D]+"
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the folder the cluster shares and read it from there.

    This ends the lineage: a lost executor costs a re-read, rows keep the values they
    were written with, and Spark knows the size of the table when it plans joins.
    """
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the offset at which each row begins."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), offsets


def small_batches(
    batches: Iterator[pa.RecordBatch], text: str = "text", most: int = 8 << 20
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``most`` bytes of text, or a single row.

    This bounds a worker's memory by ``most`` and the longest text.
    """
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        _, offsets = text_buffer(column)
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + most, side="right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def word_chunks(raw: bytes, most: int = 4 << 20) -> Iterator[list[bytes]]:
    """The words of a UTF-8 text, in lists from about ``most`` bytes each; no word is cut."""
    at = 0
    while at < len(raw):
        end = at + most
        blank = _SPACE.search(raw, end) if end < len(raw) else None
        end = blank.start() if blank else len(raw)
        yield raw[at:end].split()  # of bytes: at ASCII white space only
        at = end


# Letters and marks whose kind no edition of Unicode changes.
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
MARKS = "!#$%&()*+,\\-./:;<=>?@\\[\\]\\\\^_{|}~\"`"
_LONE_BLANK = re.compile(r"(?<=\S) (?=\S)")
_PART = re.compile(
    rf" ?[{LETTERS}]++(?=[{MARKS}\n]| \S|\Z)| ?[{MARKS}]++(?=[{LETTERS}\n]| \S|\Z)"
    rf"|\n(?=[{LETTERS}{MARKS}])|.+?(?=(?<=\S) \S|\Z)",
    re.DOTALL,
)


def parts_of(text: str, most: int = 1 << 20) -> Iterator[list[str]]:
    """A text taken apart, in lists from about ``most`` characters each.

    A cut lies before a blank between two characters that are no white space; between
    letters, marks and a line break where two of these kinds meet, Latin letters and ASCII
    marks without the apostrophe only. What else there is stays together up to the next
    such blank. Tokens that hold no two kinds, and a blank only at their beginning or
    after other white space, do not reach over a cut.
    """
    at = 0
    while at < len(text):
        cut = _LONE_BLANK.search(text, at + most)
        end = cut.start() if cut else len(text)
        yield _PART.findall(text[at:end])
        at = end


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def worker_cache(name: str, make):
    """A value that a Python worker makes once and keeps for its later tasks."""
    kept = sys.modules.setdefault("_tillstar_worker", types.ModuleType("_tillstar_worker")).__dict__
    if name not in kept:
        kept[name] = make()
    return kept[name]
