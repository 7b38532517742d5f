"""Contiguous shards of near-equal bytes from global prefix sums. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.tables import materialise, running_totals

#: What each document costs besides its text.
FRAME_BYTES = 8


def shard_by_bytes(docs: DataFrame, shards: int = 24, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Cut all documents, in one global order, at equal byte targets.

    The order is (MD5 of the text, doc_id), so equal texts lie side by side and a group of copies is split only
    where a cut falls into it. A document belongs to the shard in which its first byte lies: shard
    floor(bytes before it * shards / all bytes). So each shard is a contiguous run and is within one document of the
    target. The text itself is read once and never shuffled; very long texts are rows like others.

    Returns doc_id, size, text_crc32, law ('bytes'), shard, slot, grown_shard (null: this law has none).
    Null texts count as empty; null and repeated keys are rows like others (nulls first in the order); repeated rows
    take neighbouring slots; an empty table gives no rows; other columns are ignored.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    narrow = docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(body) + FRAME_BYTES).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.md5(body.cast("binary")).alias("_text"),
    )
    rows = materialise(narrow)
    placed = running_totals(rows, [F.col("_text").asc(), F.col("doc_id").asc_nulls_first()], {"start": F.col("size")})
    total = rows.agg(F.sum("size")).first()[0] or 1
    cut = placed.withColumn("shard", F.expr(f"cast(cast(start as decimal(38,0)) * {shards} div {total} as int)"))
    firsts = cut.groupBy("shard").agg(F.min("position").alias("_first"))  # a row for each shard
    return cut.join(F.broadcast(firsts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("position") - F.col("_first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "position",
    )
