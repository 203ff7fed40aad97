"""Secret scans with a trigram inverted index.

Every task indexes its documents batch by batch: postings list, for each trigram that
some rule asks for, the rows that hold it. A rule's Boolean trigram query is answered by
intersecting and uniting postings, and only the rows left are searched with the regex.
A rule that needs no trigram, such as a run of hex digits, searches every row. Each
index segment lives with the rows it describes, so that no text and no posting is
shuffled, a frequent trigram makes no long list, and a lost task is simply run again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import column_of, small_batches, text_buffer
from tillstar.llm.trigrams import ALWAYS, trigram_query


@dataclass(frozen=True)
class Rule:
    """Matches are leftmost and do not overlap; one whose group is shorter than
    ``least`` characters is dropped afterwards. A match begins at the start of the text or
    after a character that is not among ``not_after``."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    not_after: str = ""

    def compiled(self) -> re.Pattern:
        behind = f"(?<![{self.not_after}])" if self.not_after else ""
        return re.compile(behind + self.pattern, re.ASCII)


BASE_RULES = (
    Rule(
        "assign",
        r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        group=2,
        least=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]+", least=24),
)
# A PEM key up to its END line. Without one: header lines, the base64 lines that follow
# (16 characters at least, or words would count) and the base64 after the last. A line may
# also end in a written \\n, as in JSON. What is repeated gives nothing back (*+, ++), so
# time is linear and no place to return to is kept.
_KEY = r"PRIVATE KEY-----"
_BETWEEN = r"(?:[\x20\t\r\n\"'>]|\\[nr])[\x20\t\r\n\"'>]*+(?:\\[nr][\x20\t\r\n\"'>]*+)*+"
_HEADER = r"(?:\r?\n|(?:\\r)?\\n)[A-Z][A-Za-z-]*+:\x20[^\r\n\\]*+"
_BASE64 = r"[A-Za-z0-9+/]"
_TO_END = r"[^-]*+(?:-[^-]++)*+-----END (?:[A-Z]+ )?" + _KEY
_LINES = (
    f"(?:{_HEADER})*+(?:{_BETWEEN}{_BASE64}{{16,}}+={{0,2}}+)++(?:{_BETWEEN}{_BASE64}++={{0,2}}+)?+"
)
# Published formats of well-known credentials.
MORE_RULES = (
    Rule("private_key", f"-----BEGIN (?:[A-Z]+ )?{_KEY}(?:{_TO_END}|{_LINES})?"),
    Rule("github", r"gh[opsu]_[A-Za-z0-9]{36}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule(
        "jwt",
        r"eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]++",
        not_after="A-Za-z0-9_-",
    ),
)
RULES = BASE_RULES + MORE_RULES
SPANS = "array<struct<kind:string,start:int,end:int>>"

_CHUNK = 2 << 20


class Segment:
    """Postings of one batch for the trigrams of a vocabulary."""

    def __init__(self, column: pa.Array, numbers: dict[bytes, int], table: np.ndarray):
        data, offsets = text_buffer(column)
        self.numbers, self.rows = numbers, np.arange(len(column))
        found = []
        for at in range(int(offsets[0]), int(offsets[-1]), _CHUNK):
            part = data[at : min(at + _CHUNK + 2, int(offsets[-1]))]
            if len(part) < 3:
                continue
            lower = (part + ((part >= 65) & (part <= 90)) * np.uint8(32)).astype(np.uint32)
            number = table[(lower[:-2] << 16) | (lower[1:-1] << 8) | lower[2:]]
            hit = np.flatnonzero(number)
            row = np.searchsorted(offsets, hit + at, side="right") - 1
            inside = hit + at + 3 <= offsets[row + 1]
            found.append(np.unique(number[hit[inside]].astype(np.int64) << 32 | row[inside]))
        pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        starts = np.searchsorted(pairs, np.arange(1, len(numbers) + 2, dtype=np.int64) << 32)
        self.postings = np.split(pairs & 0xFFFFFFFF, starts)[1:-1]

    def candidates(self, query: frozenset) -> np.ndarray:
        if query == ALWAYS:
            return self.rows
        out = np.zeros(0, np.int64)
        for needed in query:
            lists = sorted((self.postings[self.numbers[t] - 1] for t in needed), key=len)
            rows = lists[0]
            for more in lists[1:]:
                rows = np.intersect1d(rows, more, assume_unique=True)
            out = np.union1d(out, rows)
        return out


class Scanner:
    """Compiled rules with their trigram queries."""

    def __init__(self, rules: Sequence[Rule]):
        self.rules = [(r, r.compiled()) for r in rules]
        self.queries = [trigram_query(re.compile(r.pattern, re.ASCII)) for r in rules]
        vocabulary = sorted({t for q in self.queries for needed in q for t in needed})
        self.numbers = {t: k for k, t in enumerate(vocabulary, 1)}
        self.table = np.zeros(1 << 24, np.uint16)
        for t, k in self.numbers.items():
            self.table[int.from_bytes(t, "big")] = k

    def scan(self, column: pa.Array) -> dict[int, list[tuple[int, int, int]]]:
        """By row: (start, number of the rule, end) in code points, in that order."""
        segment = Segment(column, self.numbers, self.table)
        texts: dict[int, str] = {}
        found: dict[int, list] = {}
        for k, ((rule, compiled), query) in enumerate(zip(self.rules, self.queries)):
            for row in segment.candidates(query).tolist():
                if row not in texts:
                    texts[row] = column[row].as_py() or ""
                for m in compiled.finditer(texts[row]):
                    if m.end(rule.group) - m.start(rule.group) >= rule.least:
                        found.setdefault(row, []).append((m.start(), k, m.end()))
        return {row: sorted(spans) for row, spans in found.items()}


def _masked(text: str, spans, rules: Sequence[Rule]) -> str:
    """Replace spans by the kind in brackets; spans that overlap become one."""
    out, last, stop = [], 0, -1
    for start, k, end in spans:
        if start >= stop:
            out += [text[last:start], f"[{rules[k].kind}]"]
        last = stop = max(stop, end)
    return "".join([*out, text[last:]])


def _replace(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    at = batch.schema.get_field_index(name)
    return batch.set_column(at, batch.schema.field(at), values)


def scan_secrets(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    text: str = "text",
    into: str = "spans",
    mask: bool = False,
) -> DataFrame:
    """Add the spans of secrets, ordered by start, then by the order of the rules.

    A span is (kind, start, end) in code points of the whole text, end exclusive. Null
    and empty texts have no spans; each row is judged by itself, so repeated rows and
    null ids need no care; other columns pass through, but one called ``into`` is
    replaced. ``mask`` also replaces each span in the text by its kind in brackets
    (overlapping spans by the first one's); a null text stays null.
    """
    docs = docs.drop(into).withColumn(into, F.lit(None).cast(SPANS))
    kinds = [r.kind for r in rules]
    spans_type = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for batch in small_batches(batches, text):
            column = column_of(batch, text)
            found = scanner.scan(column)
            spans = [
                [{"kind": kinds[k], "start": s, "end": e} for s, k, e in found.get(row, ())]
                for row in range(batch.num_rows)
            ]
            batch = _replace(batch, into, pa.array(spans, spans_type))
            if mask and found:
                texts = column.to_pylist()
                for row, its in found.items():
                    texts[row] = _masked(texts[row], its, rules)
                batch = _replace(batch, text, pa.array(texts, column.type))
            yield batch

    return docs.mapInArrow(run, docs.schema)


def span_digests(scanned: DataFrame, base: Sequence[Rule] = BASE_RULES) -> DataFrame:
    """Per document: counts of each base kind, a hash of the base spans, all spans."""
    kinds = [r.kind for r in base]

    def joined(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ","
        )

    def only(wanted):
        return F.filter("spans", lambda s: s.kind.isin(wanted))

    return scanned.select(
        "doc_id",
        *[F.size(only([k])).cast("long").alias(f"n_{k}") for k in kinds],
        F.sha2(joined(only(kinds)), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
