"""Mixing sources to target weights by systematic sampling.

Every document expects as many copies as its source's target has words for each word of
the source. Along the documents of a source these expectations are summed up, one random
offset is added, and a document is taken once for each whole number its share crosses.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm.common import WORD, stored

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
PER_SPLIT = 20_000
_ALL = (Window.unboundedPreceding, Window.unboundedFollowing)


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES
) -> DataFrame:
    """Add the target of each source to (source, source_size), one row per source.

    Sources in order of code points, null last, get the weights in turn and share the sum
    of all sizes. No target exceeds ``most`` times its source's size; what is above goes
    to the others by weight, again and again. That ends with the sources of smallest cap
    per weight capped, and the rest sharing what is left, which running sums find at
    once. One task holds one row per source.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    nth = ((turn - 1) % len(weights) + 1).cast("int")
    multiple = math.lcm(*weights)
    sources = sizes.withColumns(
        {
            "cap": F.col("source_size") * most,
            "weight": F.element_at(F.array(*[F.lit(w) for w in weights]), nth).cast("long"),
            "inverse": F.element_at(F.array(*[F.lit(multiple // w) for w in weights]), nth),
        }
    )
    by_cap = Window.orderBy(F.col("cap") * F.col("inverse"), F.col("source").asc_nulls_last())
    onward = by_cap.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy("at").rowsBetween(*_ALL)
    onto = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(by_cap.rowsBetween(*_ALL))
    sources = sources.withColumns(
        {
            "at": F.row_number().over(by_cap),
            "rest": total - F.coalesce(F.sum("cap").over(onto), F.lit(0)),
            "rest_weight": F.sum("weight").over(onward),
        }
    )
    fits = F.col("rest") * F.col("weight") <= F.col("cap") * F.col("rest_weight")
    sources = sources.withColumn("first", F.min(F.when(fits, F.col("at"))).over(everything))
    level = {
        c: F.max(F.when(F.col("at") == F.col("first"), F.col(c))).over(everything)
        for c in ("rest", "rest_weight")
    }
    share = F.col("rest").cast("double") * F.col("weight") / F.col("rest_weight")
    target = F.when(F.col("at") < F.col("first"), F.col("cap").cast("double")).otherwise(share)
    return sources.withColumns(level).select("source", "source_size", target.alias("target"))


def _drawn(text: Column) -> Column:
    """A number below 2^32 that looks random, the same in every run."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def _meet(rows: DataFrame, other: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join one row per key; null keys meet as well."""
    other = other.withColumnsRenamed({k: f"__its_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"__its_{k}")) for k in keys]
    return rows.join(other, same, how).drop(*[f"__its_{k}" for k in keys])


def _planned(docs: DataFrame, keep, weights, most: int, seed: int, per_split: int) -> DataFrame:
    """The kept columns as ``__row``, with size, source_size, target and copies."""
    source = F.col("source") if "source" in docs.columns else F.lit(None).cast("string")
    # Rows without an id, or with the same, are told apart by their text.
    name = F.concat_ws(
        ":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce(F.md5("text"), F.lit(""))
    )
    rows = docs.select(
        F.struct(*keep).alias("__row"),
        "doc_id",
        source.alias("source"),
        word_count().alias("size"),
        _drawn(name).alias("spot"),
    )
    # Sizes that differ by a few hundredths share a class: the five digits after the
    # leading one, in binary.
    shift = F.greatest(F.length(F.bin("size")) - 6, F.lit(0))
    rows = rows.withColumn("shift", shift).withColumn(
        "class", F.expr("shift * 32 + shiftright(size, shift)").cast("int")
    )
    by_class = ["source", "class"]
    classes = rows.groupBy(*by_class).agg(F.count("*").alias("n"), F.sum("size").alias("w"))
    classes = stored(
        classes.withColumn("splits", F.ceil(F.col("n") / per_split).cast("long")), "classes"
    )
    onto = (Window.unboundedPreceding, -1)
    in_source = Window.partitionBy("source").orderBy("class").rowsBetween(*onto)
    smaller = F.coalesce(F.sum("n").over(in_source), F.lit(0)).alias("smaller")
    sizes = targets(classes.groupBy("source").agg(F.sum("w").alias("source_size")), weights, most)
    places = classes.select(*by_class, "splits", smaller)
    places = stored(_meet(places, sizes, ["source"]), "places")
    rows = _meet(rows, places, by_class).withColumn("split", F.pmod("spot", "splits").cast("int"))
    # Only the parts of a class that is split need to be counted one by one.
    counts = rows.where("splits > 1").groupBy(*by_class, "split").agg(F.count("*").alias("n"))
    in_class = Window.partitionBy(*by_class).orderBy("split").rowsBetween(*onto)
    earlier = F.coalesce(F.sum("n").over(in_class), F.lit(0)).alias("earlier")
    parts = stored(counts.select(*by_class, "split", earlier), "parts")
    rows = _meet(rows, parts, [*by_class, "split"], "left")
    before = F.col("smaller") + F.coalesce(F.col("earlier"), F.lit(0))
    inside = Window.partitionBy(*by_class, "split").orderBy("size", "spot", "doc_id")
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    label = F.coalesce(F.col("source"), F.lit(""))
    offset = _drawn(F.concat(F.lit(f"{seed}:"), label)) / F.lit(float(1 << 32))

    def crossed(place):
        return F.floor(offset + share * place)

    rows = rows.withColumn("rank", before + F.row_number().over(inside))
    copies = crossed(F.col("rank")) - crossed(F.col("rank") - 1)
    return rows.select("__row", "size", "source_size", "target", copies.alias("copies"))


def plan_copies(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST_COPIES,
    seed: int = 7,
    per_split: int = PER_SPLIT,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add size, source_size, target and copies to every document.

    Within a source documents go by classes of nearly equal size, so that short and long
    ones get their share, and by a hash of id and text within a class. A class is split by
    that hash, one part for ``per_split`` documents that it has; parts are numbered through
    by running sums of their counts, first within a class, then over the classes of a
    source. No task sees more than such a part, however large a source, a group of copies
    or the number of rows without an id is; rows that agree in id and text fall in one
    part. The same documents give the same copies.

    ``keep`` names the columns to keep, all by default: only these are shuffled. Null texts
    have size 0, a null source is a source of its own, a source of size 0 has no copies.
    Repeated rows are documents of their own. The documents are read three times. Columns
    of these names are replaced.
    """
    made = ["size", "source_size", "target", "copies"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in made]
    planned = _planned(docs, keep or ["doc_id"], weights, most, seed, per_split)
    return planned.select(*[F.col("__row")[c].alias(c) for c in keep], *made)


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST_COPIES,
    seed: int = 7,
    per_split: int = PER_SPLIT,
) -> DataFrame:
    """The documents, each as often as the mix takes it, with their own columns."""
    planned = _planned(docs, docs.columns, weights, most, seed, per_split).where("copies > 0")
    repeated = F.explode(F.array_repeat(F.lit(True), F.col("copies").cast("int")))
    return planned.select("__row", repeated).select("__row.*")
