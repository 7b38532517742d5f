"""Token counts from an exact histogram of encoded lengths."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.bpe import _spec, codec
from lodestar.llm.tables import materialise, running_totals


def length_histogram(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """(length, docs): how many rows have so many tokens in the vocabulary at `path`. Each task counts its own rows
    first, so only one row for each of its lengths is shuffled."""
    spec = docs.sparkSession.sparkContext.broadcast(_spec(path))  # a public file of a few MB

    def batches(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, counts = codec(spec.value), Counter()
        for batch in it:
            counts.update(len(code.encode(t.as_py() or "")) for t in batch.column(0))
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())], names=["length", "docs"])

    return docs.select(F.col(text).alias("text")).mapInArrow(batches, "length long, docs long").groupBy("length").agg(F.sum("docs").alias("docs"))


def token_counts(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """For each encoded length that occurs, as a context limit: docs of this length, docs_from (this long or longer),
    tokens_from (their tokens), truncated_tokens (all documents cut at this limit), share_within (documents that fit:
    the length is the quantile of every level up to it and above the one before), total_docs and total_tokens.

    Null and empty texts have length 0; repeated rows count as often; an empty table gives no rows; other columns are
    ignored. Suffix sums come from prefix sums over ranges of lengths, so no task holds all lengths.
    """
    table = materialise(length_histogram(docs, path, text))
    n, tokens = table.agg(F.sum("docs"), F.sum(F.col("docs") * F.col("length"))).first()
    sums = running_totals(table, [F.col("length").asc()], {"below": F.col("docs"), "tokens_below": F.col("docs") * F.col("length")})
    n, tokens = n or 0, tokens or 0
    return sums.select(
        "length",
        "docs",
        (F.lit(n) - F.col("below")).alias("docs_from"),
        (F.lit(tokens) - F.col("tokens_below")).alias("tokens_from"),
        (F.col("tokens_below") + F.col("length") * (F.lit(n) - F.col("below"))).alias("truncated_tokens"),
        ((F.col("below") + F.col("docs")) / F.lit(max(n, 1))).alias("share_within"),
        F.lit(n).cast("long").alias("total_docs"),
        F.lit(tokens).cast("long").alias("total_tokens"),
    )


def answers(counts: DataFrame, limits: Sequence[int] = (), levels: Sequence[float] = ()) -> tuple[dict[int, int], dict[float, int]]:
    """Truncated totals of any context limits, and quantiles of any levels in (0, 1]: for each, one aggregate over the
    table of `token_counts`. A limit between two lengths cuts the documents of the next length and those longer."""
    limits, levels = list(limits), list(levels)
    ask = [F.max("total_tokens").alias("all")]
    ask += [F.min(F.when(F.col("length") >= x, F.struct("length", "docs_from", "tokens_from"))).alias(f"limit{i}") for i, x in enumerate(limits)]
    ask += [F.min(F.when(F.col("share_within") >= x - 1e-12, F.col("length"))).alias(f"level{i}") for i, x in enumerate(levels)]
    row = counts.agg(*ask).first()
    total = row["all"] or 0
    cut = {x: total if (r := row[f"limit{i}"]) is None else total - r.tokens_from + x * r.docs_from for i, x in enumerate(limits)}
    return cut, {x: row[f"level{i}"] for i, x in enumerate(levels)}

