"""Importance resampling towards a target: hashed n-grams of words, read from Arrow's UTF-8 buffers by a vectorised automaton."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.tables import materialise, running_totals
from lodestar.llm.words import FOLDED

#: Bytes that are classified at a time, and how many bytes of a word are read with all others.
CHUNK, STEPS = 1 << 21, 48
#: The class of each byte: the byte that a word has there, or 0 between words.
CLASS = np.frombuffer(FOLDED, np.uint8).copy()
CLASS[CLASS == 32] = 0


def _crc_table() -> np.ndarray:
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, out >> 1 ^ np.uint32(0xEDB88320), out >> 1)
    return out


CRC = _crc_table()


def _advance(state: np.ndarray, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Registers of a CRC-32 after `length` bytes from each `start`: one byte of all words at a time, the longest words first, so
    that those still read are a prefix. What long words have beyond STEPS bytes is read word by word."""
    order = np.argsort(-np.minimum(length, 30_000).astype(np.int16), kind="stable")  # 16 bits: by radix
    at, left, reg = start[order], length[order], state[order]
    alive = len(reg)
    for step in range(STEPS):
        alive = int(np.searchsorted(-left[:alive], -step)) if alive and left[alive - 1] <= step else alive
        if not alive:
            break
        r = reg[:alive]
        reg[:alive] = CRC[(r ^ data[at[:alive] + step]) & 255] ^ (r >> 8)
    else:
        for i in np.flatnonzero(left > STEPS):
            rest = data[at[i] + STEPS : at[i] + left[i]].tobytes()
            reg[i] = zlib.crc32(rest, int(reg[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    out = np.empty_like(reg)
    out[order] = reg
    return out


def _runs(data: np.ndarray, ends: np.ndarray, most: int, old: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(texts, CRC-32s, n) of the runs of n words, for n up to `most`, of classified bytes that hold texts ending at `ends`.
    Runs that end within the first `old` words are left out."""
    inside = data != 0
    edge = np.zeros(len(data) + 1, bool)
    edge[1:-1] = inside[1:] != inside[:-1]
    edge[0], edge[-1] = inside[:1].any(), inside[-1:].any()
    cut = np.unique(ends[:-1])
    cut = cut[(cut > 0) & (cut < len(data))]
    both = cut[inside[cut] & inside[cut - 1]]  # a word ends and another begins where two texts meet
    marks = np.flatnonzero(edge)
    if len(both):
        marks = np.sort(np.concatenate([marks, both, both]))
    start, stop = marks[::2], marks[1::2]
    text = np.searchsorted(ends, start, side="right")
    state = np.full(len(start), 0xFFFFFFFF, np.uint32)
    for n in range(1, most + 1):
        if n > 1:
            state = state[:-1]
            state = CRC[(state ^ 32) & 255] ^ (state >> 8)
        if len(state) == 0:
            return
        state = _advance(state, data, start[n - 1 :], (stop - start)[n - 1 :])
        whole = text[: len(state)] == text[n - 1 :]
        whole[: max(0, old - n + 1)] = False
        yield text[: len(state)][whole], state[whole] ^ np.uint32(0xFFFFFFFF), n


def features(texts: pa.Array, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(row, CRC-32, n) of all runs of n words of a column of texts, chunk by chunk of its buffer. A text longer than a chunk
    is cut between words; the last words before a cut are read again, for the runs that cross it."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    if data is None or not len(texts):
        return
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(at, at[row] + CHUNK, side="right")) - 1)
        low, high = int(at[row]), int(at[end])
        if high - low <= CHUNK:
            for text, crc, n in _runs(CLASS[data[low:high]], at[row + 1 : end + 1] - low, most):
                yield text + row, crc, n
        else:
            for part, old in _parts(data[low:high], most):
                for text, crc, n in _runs(part, np.array([len(part)]), most, old):
                    yield text + row, crc, n
        row = end


def _parts(data: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, int]]:
    """A long text classified in parts that end between words, each with the last most - 1 words before it and their number."""
    tail, at, old = np.zeros(0, np.uint8), 0, 0
    while at < len(data):
        end = min(len(data), at + CHUNK)
        new = CLASS[data[at:end]]
        while end < len(data) and new[-1]:
            gaps = np.flatnonzero(new == 0)
            if len(gaps):
                end -= len(new) - int(gaps[-1]) - 1
                new = new[: gaps[-1] + 1]
            else:
                more = CLASS[data[end : end + CHUNK]]
                gaps = np.flatnonzero(more == 0)
                more = more[: gaps[0] + 1] if len(gaps) else more
                new, end = np.concatenate([new, more]), end + len(more)
        part = np.concatenate([tail, new])
        yield part, old
        if most > 1:
            starts = np.flatnonzero((part != 0) & np.concatenate([[True], part[:-1] == 0]))
            old = min(most - 1, len(starts))
            tail = part[starts[-old] :].copy() if old else np.zeros(0, np.uint8)
            tail = np.append(tail, np.uint8(0))
        at = end


def bucket_counts(texts: DataFrame, most: int = 1, buckets: int = 10_000) -> DataFrame:
    """(bucket, n): how many features of the column `text` fall into each bucket. A task sends one row for each of its buckets."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, crc, _ in features(batch["text"], most):
                total += np.bincount(crc % buckets, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": used.astype(np.int32), "n": total[used]})

    return texts.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """What a feature of each bucket adds to a weight: the floor of 1000 times the log ratio of the smoothed shares of the
    bucket in `target` and `raw` (bucket, n). As many values as there are buckets."""
    s, t = (np.zeros(buckets), np.zeros(buckets))
    for counts, df in ((s, raw), (t, target)):
        for r in df.collect():  # at most one row a bucket
            counts[r.bucket] = r.n
    S, T = float(s.sum()) + buckets, float(t.sum()) + buckets
    return np.array([math.floor(1000 * math.log((b + 1) * S / ((a + 1) * T))) for a, b in zip(s.tolist(), t.tolist())], np.int64)


def _luck(seed: int, key: int | None) -> int:
    """A Gumbel draw in thousandths that only seed and key decide. No key is an empty one."""
    h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weights(docs: DataFrame, gain: np.ndarray, most: int = 1, seed: int = 2024) -> DataFrame:
    """doc_id, n_words, n_features, weight (floored mean gain of the features, 0 without any) and score (weight and luck)."""
    schema = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_words", "n_features", "weight", "score"))])

    def weigh(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            n_words, n, total = (np.zeros(rows, np.int64) for _ in range(3))
            for row, crc, size in features(batch["text"], most):
                counted = np.bincount(row, minlength=rows)
                n += counted
                n_words += counted if size == 1 else 0
                total += np.bincount(row, weights=gain[crc % len(gain)], minlength=rows).astype(np.int64)  # whole numbers
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            luck = np.array([_luck(seed, key) for key in batch["doc_id"].to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *map(pa.array, (n_words, n, weight, weight + luck))], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long, score long")


def resample(docs: DataFrame, target: DataFrame, most: int = 1, buckets: int = 10_000, seed: int = 2024, least: int = 20, percent: int = 10) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of each row of `docs` (doc_id, text): rank numbers the drawn rows,
    the highest scores first and of equal ones the smaller doc_id; it is null for others. Drawn are floor(percent N / 100)
    rows, N being the rows of at least `least` words; a score is the weight towards the texts of `target` and a Gumbel draw, so
    that rows are drawn without replacement with chances in proportion to exp(weight / 1000).

    Words are letters, digits and what isn't ASCII, with A-Z lower-cased; features are runs of 1 to `most` words joined by
    blanks, in buckets by CRC-32. Null and empty texts have no features: weight 0, never drawn where `least` is above 0.
    A null doc_id draws like an empty one and goes last among equal scores. Repeated rows are rows like others, with the
    same score and neighbouring ranks. Very long texts are read whole, in chunks. Empty tables give no rows; an empty target
    has T = 0. Other columns of both tables are not read.

    Both passes read the texts; between them only the buckets' counts move. Ranks come from range totals, not from one task.
    """
    gain = gains(bucket_counts(docs, most, buckets), bucket_counts(target, most, buckets), buckets)
    scored = materialise(weights(docs, gain, most, seed))
    eligible = F.col("n_words") >= least
    drawn = scored.where(eligible).count() * percent // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("weight")]
    ranked = running_totals(scored.where(eligible), order, {})
    rank = F.when(F.col("position") < drawn, F.col("position") + 1).cast("long").alias("rank")
    return ranked.select(*scored.columns, rank).union(scored.where(~eligible).select("*", F.lit(None).cast("long").alias("rank")))


def drawn(docs: DataFrame, ranked: DataFrame) -> DataFrame:
    """The rows of `docs` whose doc_id (null, too) was drawn, with all their columns."""
    keys = ranked.where("rank is not null").select(F.col("doc_id").alias("_key"))
    return docs.join(keys, docs["doc_id"].eqNullSafe(F.col("_key")), "left_semi")
