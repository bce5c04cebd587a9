"""Connected components of links, by alternating large-star and small-star steps.

Each step groups links by one end with partial aggregation and joins the minimum back; links are
stored between steps, so lineage stays short and a lost executor costs a reread. The number of rounds
grows with the logarithm of a component's size. Nothing is collected but a count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.tables import materialise


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1_000_003)).first())


def components(links: DataFrame) -> DataFrame:
    """links: a, b (whole numbers, any order, repeats allowed). Result: node, component (its smallest
    node), for every node that isn't the smallest of its component."""
    links = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = materialise(links, "links")
    before = _state(links)
    while before[0]:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = materialise(both.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low")), "lowest")
        large = both.join(lowest, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        large = materialise(large, "large-star")
        lowest = materialise(large.groupBy("a").agg(F.min("b").alias("low")), "lowest")
        rest = large.join(lowest, "a").filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        links = materialise(rest.union(lowest.select("a", F.col("low").alias("b"))).distinct(), "small-star")
        after = _state(links)
        if after == before:
            break
        before = after
    return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
