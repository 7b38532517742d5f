"""Connected components by alternating stars over a table of links; nothing is gathered on the driver but a checksum."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.tables import materialise


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for each node that has a link to another one: root is the smallest node that links reach.

    Large stars hang the larger neighbours of each node on its smallest one, small stars its smaller neighbours;
    rounds end when nothing changes, after a number that grows with the logarithm of the longest path. Minima are taken by a grouped aggregate and joined back, so a node with very many
    links is a skewed join, which adaptive execution splits, and never one task. Null ends and links of a node to
    itself are left out; no links give an empty table.
    """
    edges = materialise(
        links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("hi") != F.col("lo")))
        .distinct()
    )
    seen = _checksum(edges)
    while seen[0]:
        both = edges.select("hi", "lo").union(edges.select(F.col("lo"), F.col("hi")))
        least = both.groupBy("hi").agg(F.min("lo").alias("m")).select("hi", F.least("hi", "m").alias("m"))
        large = both.where("lo > hi").join(least, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        large = large.distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").select(
            F.when(F.col("lo") == F.col("m"), F.col("hi")).otherwise(F.col("lo")).alias("hi"), F.col("m").alias("lo")
        )
        edges = materialise(small.distinct())
        now = _checksum(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
