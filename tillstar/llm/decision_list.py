"""Quality rules as a learned decision list.

Statistics of labelled documents are covered one rule after the other. A rule is a
conjunction of thresholds: conditions are added while they gain information on one part
of the rows, then dropped from the end while that makes the rule more precise on the
other part. The rows it catches are set aside and the next rule is grown. The list
becomes one conditional expression that Spark evaluates over stored statistics.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import column_of, small_batches, word_chunks

# Labelled documents that a list is learned from, at most.
LEARN_ROWS = 20_000
MOST_RULES, MOST_CONDITIONS, THRESHOLDS = 12, 4, 64
# A rule must catch so many rows of the part it is pruned on, this purely.
LEAST_CAUGHT, LEAST_PRECISION = 3, 0.95
SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\v\f\r"
_STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_MORE = ("n_chars", "n_upper", "n_twice", "n_lines")


def _again(numbers: np.ndarray) -> np.ndarray:
    """Which values occur more than once."""
    _, at, count = np.unique(numbers, return_inverse=True, return_counts=True)
    return count[at] > 1


def repeated_words(raw: bytes, most: int = 1 << 20) -> tuple[int, int, int]:
    """(words, words in windows of three that occur again, words equal to the one before).

    Windows of a text up to ``most`` bytes are kept as they are, those of a longer one as
    numbers, which take a tenth of the memory.
    """
    if len(raw) <= most:
        words = raw.split()
        twice = sum(map(bytes.__eq__, words, words[1:]))
        windows = list(zip(words, words[1:], words[2:]))
        if len(set(windows)) == len(windows):
            return len(words), 0, twice
        number: dict = {}
        again = _again(np.array([number.setdefault(w, len(number)) for w in windows]))
    else:
        number = {}
        parts = [
            np.array([number.setdefault(w, len(number)) for w in words], np.int64)
            for words in word_chunks(raw, most)
        ]
        words = np.concatenate(parts)
        twice = int((words[1:] == words[:-1]).sum())
        _, pairs = np.unique(words[:-1] * len(number) + words[1:], return_inverse=True)
        again = _again(pairs[:-1] * len(number) + words[2:]) if len(words) > 2 else words[:0] > 0
    inside = np.zeros(len(words), bool)
    for k in range(3):
        inside[k : k + len(again)] |= again
    return len(words), int(inside.sum()), twice


def statistics_of(text: str) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, then code points,
    capitals A-Z, words equal to the one before, and lines with a word."""
    words, repeated, twice = repeated_words(text.encode("utf-8", "surrogatepass"))
    lines = [x for x in text.split("\n") if x.strip(_SPACES)]
    return (
        words,
        len(text) - sum(map(text.count, _SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated,
        len(text),
        sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")),
        twice,
        len(lines),
    )


def text_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of every text; a null text has no words."""
    names = [*_STATISTICS, *_MORE]
    docs = docs.select("doc_id", "text")
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, "
    schema += ", ".join(f"{n} long" for n in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts = column_of(batch, "text").to_pylist()
            values = np.array([statistics_of(t or "") for t in texts], np.int64)
            columns = [pa.array(values[:, k]) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays(
                [column_of(batch, "doc_id"), *columns], names=["doc_id", *names]
            )

    return docs.mapInArrow(run, schema)


def features() -> dict[str, Column]:
    """What thresholds are learned on: shares, so that they hold for any length."""

    def share(part: str, of: str) -> Column:
        return F.col(part) / F.greatest(F.col(of), F.lit(1))

    return {
        "symbols_per_word": share("n_symbols", "n_words"),
        "capitals_per_char": share("n_upper", "n_chars"),
        "repeated_words": share("n_repeat_words", "n_words"),
        "words_said_twice": share("n_twice", "n_words"),
        "duplicate_lines": share("n_dup_lines", "n_lines"),
        "chars_per_word": share("word_chars", "n_words"),
        "words": F.col("n_words").cast("double"),
    }


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # else at most
    threshold: float

    def holds(self, columns: dict[str, np.ndarray]) -> np.ndarray:
        over = columns[self.feature] > self.threshold
        return over if self.above else ~over

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _caught(rule: Sequence[Condition], columns: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for condition in rule:
        out &= condition.holds(columns)
    return out


def _best(columns, bad: np.ndarray, inside: np.ndarray) -> Condition | None:
    """The condition with the largest information gain over the rows inside."""
    p0, n0 = int(bad[inside].sum()), int((~bad[inside]).sum())
    if not p0 or not n0:
        return None
    before, best, gain = np.log2(p0 / (p0 + n0)), None, 1e-9
    for name, column in columns.items():
        values = column[inside]
        cuts = np.unique(np.quantile(values, np.linspace(0, 1, THRESHOLDS + 1)[1:-1]))
        order = np.argsort(values, kind="stable")
        bads = np.append(0, np.cumsum(bad[inside][order]))
        at = np.searchsorted(values[order], cuts, side="right")
        for above in (True, False):
            p = p0 - bads[at] if above else bads[at]
            n = (len(values) - at if above else at) - p
            with np.errstate(divide="ignore", invalid="ignore"):
                gains = np.where(p > 0, p * (np.log2(p / (p + n)) - before), 0.0)
            if len(gains) and gains.max() > gain:
                k = int(gains.argmax())
                # Half-way to the next value, so that rows a little off are not caught.
                below, beyond = values[values <= cuts[k]].max(), values[values > cuts[k]]
                middle = (below + beyond.min()) / 2 if len(beyond) else below
                best, gain = Condition(name, above, float(middle)), float(gains[k])
    return best


def _grow(columns, bad, inside) -> list[Condition]:
    rule: list[Condition] = []
    while len(rule) < MOST_CONDITIONS and (found := _best(columns, bad, inside)):
        rule.append(found)
        inside = inside & found.holds(columns)
    return rule


def _prune(rule: list[Condition], columns, bad, inside) -> list[Condition]:
    """The beginning of the rule that separates the other part best; the shorter of equals."""

    def worth(length: int) -> float:
        caught = inside & _caught(rule[:length], columns, len(bad))
        p, n = int((bad & caught).sum()), int((~bad & caught).sum())
        return (p - n) / (p + n) if p + n else -1.0

    best = max(range(1, len(rule) + 1), key=lambda k: (worth(k), -k))
    return rule[:best]


def learn(columns: dict[str, np.ndarray], bad: np.ndarray, seed: int = 7) -> list[Rule]:
    """Rules that catch bad rows, in order. None are found without rows of both kinds."""
    left = np.ones(len(bad), bool)
    random = np.random.default_rng(seed)
    rules: list[Rule] = []
    while len(rules) < MOST_RULES:
        growing = random.random(len(bad)) < 2 / 3
        rule = _grow(columns, bad, left & growing)
        if not rule:
            break
        rule = _prune(rule, columns, bad, left & ~growing)
        caught = left & _caught(rule, columns, len(bad))
        p = int((bad & caught & ~growing).sum())
        n = int((~bad & caught & ~growing).sum())
        if p < LEAST_CAUGHT or p < LEAST_PRECISION * (p + n):
            break
        rules.append(tuple(rule))
        left &= ~caught
    return rules


def verdict(rules: Sequence[Rule]) -> Column:
    """True where a document stays: ordered branches, the first rule that holds decides."""
    named = features()
    out = F.lit(True)
    for rule in reversed(rules):
        holds = F.lit(True)
        for c in rule:
            over = named[c.feature] > F.lit(c.threshold)
            holds = holds & (over if c.above else ~over)
        out = F.when(holds, F.lit(False)).otherwise(out)
    return out


def learn_rules(statistics: DataFrame, labels: DataFrame, most: int = LEARN_ROWS) -> list[Rule]:
    """Learn from the labelled rows with the smallest hashes of their ids, at most ``most``.

    Of several labels for one id the worst counts; ids without a document are left out.
    Rows that fail the base rules are left out too: they need no learned rule.
    """
    labels = (
        labels.where("quality is not null").groupBy("doc_id").agg(F.min("quality").alias("good"))
    )
    rows = statistics.where(~base_failed()).join(labels, "doc_id")
    named = features()
    sample = (
        rows.orderBy(F.xxhash64("doc_id"), *statistics.columns)
        .limit(most)
        .select(*[c.alias(n) for n, c in named.items()], "good")
        .toArrow()
    )
    columns = {n: sample[n].to_numpy() for n in named}
    return learn(columns, sample["good"].to_numpy() == 0)


def filter_quality(statistics: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add base_failed and kept. Every row is judged by itself, repeated ids and null ids
    like any other."""
    failed = base_failed()
    return statistics.withColumns({"base_failed": failed, "kept": ~failed & verdict(rules)})
