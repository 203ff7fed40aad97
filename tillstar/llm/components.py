"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import stored


def _pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.select(F.col(a).alias("a"), F.col(b).alias("b"))


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def _lowest(links: DataFrame, node: str, value) -> DataFrame:
    """One row per node. Stored, so that the join with it is planned on plain tables and
    adaptive execution can split a node that has very many links."""
    return stored(links.groupBy(node).agg(value.alias("low")), "star")


def _round(links: DataFrame) -> DataFrame:
    # Every node hands its lowest neighbour (or itself) to its higher neighbours.
    ways = _pairs(links, "a", "b").union(_pairs(links, "b", "a"))
    low = _lowest(ways, "a", F.least(F.min("b"), F.col("a")))
    large = ways.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    large = stored(large.distinct(), "large")
    # Every node links itself and its other lower neighbours to the lowest one.
    low = _lowest(large, "a", F.min("b"))
    joined = large.join(low, "a")
    small = _pairs(low, "a", "low").union(_pairs(joined.where("b > low"), "b", "low"))
    return stored(small.distinct(), "small")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b), a > b; root is the lowest node.

    Rounds of large and small stars go on until nothing changes, which takes about as
    many as the logarithm of the longest path. Each sums up by node before it joins, so
    that no node's links meet in one task. An empty table has no nodes.
    """
    links = stored(links.distinct(), "links")
    state = _state(links)
    while state[0]:
        links = _round(links)
        before, state = state, _state(links)
        if state == before:
            break
    roots = links.select("b").distinct()
    return (
        _pairs(links, "a", "b").union(_pairs(roots, "b", "b")).toDF("node", "root")
    )
