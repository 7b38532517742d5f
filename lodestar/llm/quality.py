"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Slots for hashed words; behind them STATS statistics with BINS slots each.
WORDS, STATS, BINS = 1 << 14, 18, 16
SLOTS = WORDS + STATS * BINS
THRESHOLD = 0.7

_KIND = np.zeros(256, dtype=np.int64)  # of bytes: 0 other, 1 lower, 2 upper, 3 digit, 4 white, 5 ASCII sign, 6 beyond ASCII
for _b in range(256):
    _c = chr(_b)
    _KIND[_b] = 6 if _b > 127 else 1 if _c.islower() else 2 if _c.isupper() else 3 if _c.isdigit() else 4 if _c.isspace() else 5 if 32 < _b < 127 else 0


def _share(part: float, whole: float) -> int:
    """A share's bin: finer near 0 and 1."""
    p = part / whole if whole else 0.0
    return min(BINS - 1, int(BINS * (math.asin(math.sqrt(min(1.0, max(0.0, p)))) / (math.pi / 2))))


def _size(n: float) -> int:
    return min(BINS - 1, int(math.log2(1 + n)))


def features(text: bytes, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of one whole text: L2-normalised log counts of its hashed words, and one slot for the bin of
    each statistic. `n_chars` is the metadata column; null is a bin of its own."""
    words = text.split()
    counts = Counter(words)
    kinds = np.bincount(_KIND[np.frombuffer(text, dtype=np.uint8)], minlength=7)
    lines = [x for x in text.split(b"\n") if x]
    ended = Counter(w[-1] for w in words)
    signs = sum(n for c, n in ended.items() if _KIND[c] == 5)
    stops = sum(ended.get(c, 0) for c in b".,")
    begun = Counter(w[0] for w in words)
    short = sum(n for w, n in counts.items() if len(w) < 4)
    loud = sum(n for w, n in counts.items() if w.isupper() and len(w) > 1)
    alone = sum(n for w, n in counts.items() if not w.isalnum() and len(w) == 1)
    letters, n = int(kinds[1] + kinds[2] + kinds[6]), len(words)
    stats = (
        _size(n),
        _size(len(text)),
        min(BINS - 1, int(2 * len(text) / (n + 1) / 2)),
        _share(kinds[2], letters),
        _share(kinds[3], len(text)),
        _share(kinds[4], len(text)),
        _share(kinds[5], len(text)),
        _share(kinds[6], len(text)),
        _share(signs - stops, n),
        _share(stops, n),
        _share(sum(m for c, m in begun.items() if _KIND[c] == 2), n),
        _share(len(counts), n),
        _share(short, n),
        _share(loud, n),
        _share(alone, n),
        _share(len(set(lines)), len(lines)),
        _size(len(lines)),
        BINS - 1 if n_chars is None else min(BINS - 2, _size(max(0, n_chars))),
    )
    crc = zlib.crc32
    hashed = Counter()
    for w, m in counts.items():
        hashed[crc(w) % WORDS] += m
    slots = np.fromiter(hashed.keys(), dtype=np.int64, count=len(hashed))
    values = np.log1p(np.fromiter(hashed.values(), dtype=np.float64, count=len(hashed)))
    if len(values):
        values /= math.sqrt(float(values @ values))
    at = WORDS + np.arange(STATS) * BINS + np.array(stats)
    return np.concatenate([slots, at]), np.concatenate([values, np.full(STATS, 0.5)])


@dataclass
class Machine:
    """w0 + sum w_i x_i + sum over pairs <v_i, v_j> x_i x_j, and its logistic value. A size fixed by SLOTS."""

    bias: float
    weight: np.ndarray
    factor: np.ndarray

    def margin(self, slots: np.ndarray, values: np.ndarray) -> float:
        """Pairs in linear time: half of (the square of sums less the sum of squares), factor by factor."""
        mass = self.factor[slots] * values[:, None]
        total = mass.sum(0)
        return float(self.bias + self.weight[slots] @ values + 0.5 * (total @ total - np.einsum("ij,ij->", mass, mass)))

    def score(self, slots: np.ndarray, values: np.ndarray) -> float:
        return 1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, self.margin(slots, values)))))


def train(
    rows: list[tuple[np.ndarray, np.ndarray, float]], rank: int = 8, epochs: int = 6, rate: float = 0.05, seed: int = 42, batch: int = 64
) -> Machine:
    """Adam on the logistic loss over sparse rows; without rows a machine that gives 0.5 to all."""
    rng = np.random.default_rng(seed)
    params = np.zeros((SLOTS, 1 + rank))
    params[:, 1:] = rng.normal(0, 0.02, (SLOTS, rank))
    bias, first, second = 0.0, np.zeros_like(params), np.zeros_like(params)
    b1, b2, step = np.zeros(1), np.zeros(1), 0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), batch):
            part = [rows[i] for i in order[at : at + batch]]
            lengths = np.array([len(s) for s, _, _ in part])
            slots, values = np.concatenate([s for s, _, _ in part]), np.concatenate([v for _, v, _ in part])
            starts, owner = np.concatenate([[0], np.cumsum(lengths)[:-1]]), np.repeat(np.arange(len(part)), lengths)
            mass = params[slots, 1:] * values[:, None]
            total = np.add.reduceat(mass, starts)
            linear = np.add.reduceat(params[slots, 0] * values, starts)
            margin = bias + linear + 0.5 * ((total**2).sum(1) - np.add.reduceat((mass**2).sum(1), starts))
            loss = (1 / (1 + np.exp(-np.clip(margin, -500, 500))) - np.array([y for _, _, y in part])) / len(part)
            pull = values * loss[owner]
            grads = np.concatenate([pull[:, None], pull[:, None] * (total[owner] - mass)], axis=1)
            grad = np.stack([np.bincount(slots, grads[:, j], SLOTS) for j in range(1 + rank)], axis=1) + 1e-6 * params
            step += 1
            first += 0.1 * (grad - first)
            second += 0.001 * (grad * grad - second)
            scale = math.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            params -= rate * scale * first / (np.sqrt(second) + 1e-8)
            g = float(loss.sum())
            b1 += 0.1 * (g - b1)
            b2 += 0.001 * (g * g - b2)
            bias -= float(rate * scale * b1[0] / (math.sqrt(b2[0]) + 1e-8))
    return Machine(bias, params[:, 0].copy(), params[:, 1:].copy())


def held_out(key: str = "doc_id"):
    """Rows that never teach: CRC-32 of the key's decimal text is 2 modulo 4; a null key counts as no text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def fit(docs: DataFrame, labels: DataFrame, sample: int = 8000, seed: int = 42) -> Machine:
    """Learn from at most about `sample` labelled rows, chosen by a hash of their key among those that aren't held
    out; this bound is on training alone. Rows of a repeated label count as their mean; null labels don't count. Of rows
    that share a doc_id the one of the smallest hash of text and n_chars teaches, however the table is partitioned.
    Null and empty texts teach like others (they have no words), very long ones whole; without labelled rows the
    machine gives 0.5 to all; other columns are ignored."""
    marks = (
        labels.where(~held_out() & F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.avg("quality").alias("quality"))
    )
    n = marks.count()
    chance = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 20)) < int((1 << 20) * min(1.0, sample / max(1, n)))
    chosen = {r.doc_id: r.quality for r in marks.where(chance).collect()}  # about `sample` rows
    known = docs.sparkSession.sparkContext.broadcast(chosen)

    def batches(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            ids, texts, sizes, hashes = (batch.column(i) for i in range(4))
            keep = [i for i, k in enumerate(ids.to_pylist()) if k in known.value]
            out = [(ids[i].as_py(), *features((texts[i].as_py() or "").encode(), sizes[i].as_py()), hashes[i].as_py()) for i in keep]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x[0] for x in out], pa.int64()),
                    pa.array([x[1].astype("<u2").tobytes() for x in out], pa.binary()),
                    pa.array([x[2].astype("<f4").tobytes() for x in out], pa.binary()),
                    pa.array([x[3] for x in out], pa.int64()),
                ],
                names=["doc_id", "slots", "vals", "hash"],
            )

    picked = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"), F.col("n_chars").cast("long").alias("n_chars"), F.xxhash64("text", "n_chars").alias("hash")
    ).where(~held_out() & F.col("doc_id").isNotNull() & chance)
    found = picked.mapInArrow(batches, "doc_id long, slots binary, vals binary, hash long")
    rows = found.groupBy("doc_id").agg(F.min(F.struct("hash", "slots", "vals")).alias("r")).select("doc_id", "r.*").collect()
    known.unpersist()
    rows.sort(key=lambda r: r.doc_id)
    return train(
        [(np.frombuffer(r.slots, "<u2").astype(np.int64), np.frombuffer(r.vals, "<f4").astype(np.float64), chosen[r.doc_id]) for r in rows],
        seed=seed,
    )


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id, held_out, score, predicted for each row, from its whole text and n_chars alone. The machine is
    broadcast; its size is fixed by SLOTS (about 1.2 MB). Null texts count as empty and are scored too; null n_chars
    is a bin of its own; null and repeated keys are rows like others; very long texts are scored whole, one in memory at a
    time besides its Arrow batch; an empty table gives no rows; other columns are ignored."""
    model = docs.sparkSession.sparkContext.broadcast(machine)

    def batches(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            texts, sizes = batch.column(2).cast(pa.large_binary()), batch.column(3).to_pylist()
            out = [model.value.score(*features(t.as_py() or b"", n)) for t, n in zip(texts, sizes)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.float64())], names=["doc_id", "held_out", "score"])

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out().alias("held_out"),
        F.col("text").alias("text"),
        F.col("n_chars").cast("long").alias("n_chars"),
    )
    return rows.mapInArrow(batches, "doc_id long, held_out boolean, score double").withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int")
    )


def keep(docs: DataFrame, machine: Machine) -> DataFrame:
    """The rows of `docs`, with all their columns, that the machine accepts. One pass, no shuffle; only texts and n_chars go to
    Python, and only decisions come back. Each row is decided on
    its own whole text and n_chars, however long: null texts count as empty, null n_chars is a bin of its own, null and
    repeated keys are rows like others; an empty table gives no rows; other columns are carried along."""
    model = docs.sparkSession.sparkContext.broadcast(machine)

    @F.arrow_udf("boolean")
    def accepted(texts: pa.Array, sizes: pa.Array) -> pa.Array:
        each = zip(texts.cast(pa.large_binary()), sizes.to_pylist())
        return pa.array([model.value.score(*features(t.as_py() or b"", n)) >= THRESHOLD for t, n in each], pa.bool_())

    return docs.where(accepted("text", F.col("n_chars").cast("long")))
