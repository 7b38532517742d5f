"""Hashes of rows, and running totals over a global order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.sources.shared import materialise

def row_hash(df: DataFrame) -> Column:
    """A hash of all columns of a row; of columns that Spark can't hash, of their text."""
    plain = lambda t: not any(x in t for x in ("map<", "variant"))
    return F.xxhash64(*(F.col(f"`{c}`") if plain(t) else F.col(f"`{c}`").cast("string") for c, t in df.dtypes))


def running_totals(df: DataFrame, order: Sequence[Column], sums: Mapping[str, Column]) -> DataFrame:
    """Add `position` (from 0) and, for each of `sums`, the total over all rows before the row in the global order.

    Rows are dealt to ranges of the order, each range is totalled, and the few range totals (one row for each
    partition, so their number is bounded by the partition count) are summed up and broadcast back as offsets. Rows
    that tie on `order` are told apart by a row number, so that ranges can cut between them: no key makes a range
    larger than the others.
    """
    numbered = df.select("*", F.monotonically_increasing_id().alias("_tie"))
    by = [*order, F.col("_tie").asc()]
    ranged = materialise(numbered.repartitionByRange(*by).select("*", F.spark_partition_id().alias("_range")))
    totals = ranged.groupBy("_range").agg(
        F.count(F.lit(1)).alias("_rows"), *(F.sum(c).alias(f"_sum_{n}") for n, c in sums.items())
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_range",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows"),
        *(F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_sum_{n}") for n in sums),
    )
    inside = Window.partitionBy("_range").orderBy(*by)
    ahead = inside.rowsBetween(Window.unboundedPreceding, -1)
    out = ranged.select(
        "*",
        (F.row_number().over(inside) - 1).alias("_at"),
        *(F.coalesce(F.sum(c).over(ahead), F.lit(0)).alias(f"_in_{n}") for n, c in sums.items()),
    ).join(F.broadcast(offsets), "_range")
    return out.select(
        *df.columns,
        (F.col("_at") + F.col("_rows")).cast("long").alias("position"),
        *((F.col(f"_in_{n}") + F.col(f"_sum_{n}")).alias(n) for n in sums),
    )
