"""Language-model scoring with a log-frequency Bloom filter of quantised n-gram counts."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.tables import materialise

#: Words that are broadcast with their counts: the most frequent of at most so many bytes. The others are joined.
HEAD, HEAD_BYTES = 1 << 17, 64
#: Bytes of text that are hashed, and that are split into words, at a time.
CHUNK = 1 << 18
#: Bytes of text whose n-grams are counted and asked for together; longer texts are cut into pieces of that size.
UNIT = 1 << 22
#: Learnt tokens to a segment of the filter, at most, if n-grams spread evenly.
SEGMENT = 1 << 19
ALPHA = 0.1

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_UNBASE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_END = np.uint64(0x243F6A8885A308D3)
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


@lru_cache(2)
def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2 ... modulo 2^64."""
    p = np.full(n + 1, base, np.uint64)
    p[0] = 1
    return np.cumprod(p)


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a lower-cased text, and where they start. A word's hash is a polynomial in its bytes, taken
    from prefix sums modulo 2^64, so no word becomes an object. CHUNK bytes at a time; a word that goes on in the next
    chunk is carried over, so memory doesn't grow with the longest word either."""
    up, down = _powers(int(_BASE), CHUNK), _powers(int(_UNBASE), CHUNK)
    hashes, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    carried, length, began = 0, 0, 0
    for at in range(0, len(text), CHUNK):
        data = np.frombuffer(text, np.uint8, min(CHUNK, len(text) - at), at)
        edges = np.flatnonzero(np.diff(~_WHITE[data], prepend=False, append=False))
        starts, ends = edges[::2], edges[1::2]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)])])
        raw, where = (sums[ends] - sums[starts]) * down[starts], starts + at
        if length and len(starts) and starts[0] == 0:
            raw[0] = np.uint64((carried + pow(int(_BASE), length, 1 << 64) * int(raw[0])) % (1 << 64))
            where[0] = began
        elif length:
            raw, where, length = np.concatenate([[np.uint64(carried)], raw]).astype(np.uint64), np.concatenate([[began], where]), 0
        if len(ends) and ends[-1] == len(data) and at + CHUNK < len(text):
            length = int(ends[-1] - starts[-1]) + (length if starts[-1] == 0 else 0)
            carried, began, raw, where = int(raw[-1]), int(where[-1]), raw[:-1], where[:-1]
        else:
            length = 0
        hashes.append(raw)
        places.append(where)
    return _mixed(np.concatenate(hashes)), np.concatenate(places)


def tokens(texts: list[bytes], last: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of lower-cased texts, with an end behind each text (or each `last` one), and the number of
    tokens of each."""
    last = np.ones(len(texts), dtype=bool) if last is None else last
    hashes, starts = words(b" ".join(texts) + b" ")
    behind = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts]))
    return np.insert(hashes, behind[last], _END), np.diff(np.concatenate([[0], behind])) + last


def _after(first: np.ndarray, sizes: np.ndarray, values: np.ndarray) -> np.ndarray:
    """For each token the value of the one before it; `first` before the first token of each text."""
    before = np.concatenate([values[:1], values[:-1]])
    have = sizes > 0
    before[(np.cumsum(sizes) - sizes)[have]] = first[have]
    return before


def bigrams(toks: np.ndarray, sizes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hashes of each token with the one before it; `first` stands before the texts."""
    return _mixed(_after(first, sizes, toks) * np.uint64(0xD6E8FEB86659FD93) + toks)


@dataclass
class CountFilter:
    """A Bloom filter that holds the pairs (n-gram, level) for each level from 1 to 1 + floor(log2(count)), in
    `segments` (a power of two) of `size` bits (a multiple of 8); an n-gram's bits lie in one segment, that of the
    leading bits of its hash, so sorted hashes are sorted by segment. A count read from it is
    never too low; it is too high with the chance of a false member, which grows with the share of bits that are set."""

    segments: int
    probes: int
    bits: np.ndarray | None = None
    size: int = 1 << 20

    def place(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Segment and name within it."""
        return (grams >> np.uint64(64 - self.segments.bit_length() + 1)).astype(np.int64) if self.segments > 1 else np.zeros(len(grams), np.int64), grams & np.uint64(0xFFFFFFFF)

    def slots(self, names: np.ndarray, level: int) -> Iterator[np.ndarray]:
        h = _mixed((names + np.uint64(1)) * np.uint64(0x9FB21C651E98DF25) + np.uint64(level))
        low, step = h & np.uint64(0xFFFFFFFF), h >> np.uint64(32) | np.uint64(1)
        for i in range(self.probes):
            at = (low + np.uint64(i) * step) & np.uint64(0xFFFFFFFF)
            yield ((at * np.uint64(self.size)) >> np.uint64(32)).astype(np.int64)

    def build(self, names: np.ndarray, counts: np.ndarray) -> bytes:
        """The bits of one segment."""
        bits = np.zeros(self.size, dtype=bool)
        top = tops(counts)
        for level in range(1, int(top.max(initial=0)) + 1):
            for slot in self.slots(names[top >= level], level):
                bits[slot] = True
        return np.packbits(bits, bitorder="little").tobytes()

    def levels(self, grams: np.ndarray) -> np.ndarray:
        """The highest level up to which all memberships hold, by repeated probes."""
        segment, names = self.place(grams)
        return self.read(segment * self.size, names)

    def read(self, offset: np.ndarray, names: np.ndarray) -> np.ndarray:
        """The levels of names in the segments that begin at these bits."""
        out = np.zeros(len(names), dtype=np.int64)
        live = np.arange(len(names))
        for level in range(1, 50):
            for slot in self.slots(names[live], level):
                at = offset[live] + slot
                hit = (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1
                out[live[hit == 0]] = -level
            live = live[out[live] >= 0]
            out[live] = level
            if not len(live):
                break
        return np.where(out < 0, -out - 1, out)


def tops(counts: np.ndarray) -> np.ndarray:
    """The levels of counts of at least 1."""
    return np.floor(np.log2(counts)).astype(np.int64) + 1


def middles(level: np.ndarray) -> np.ndarray:
    """The middle of the counts that a level stands for: 0, 1, then sqrt(2) times its least."""
    return np.where(level > 1, math.sqrt(2) * 2.0 ** (level - 1.0), level.astype(np.float64))


def bits_for(entries: int, false_rate: float, probes: int) -> int:
    """Bits that hold so many entries with this chance of a false member; a multiple of 8."""
    return max(64, math.ceil(entries * probes / -math.log1p(-(false_rate ** (1 / probes))) / 8) * 8)


def log10_probabilities(sizes: np.ndarray, first: np.ndarray, single: np.ndarray, both: np.ndarray, total: int, kinds: int, strength: float) -> np.ndarray:
    """log10 probability of each text under the bigram model with Dirichlet smoothing towards unigrams:
    p(w | h) = (c(hw) + strength * p(w)) / (c(h) + strength). Counts are those of the tokens, of the bigrams that
    they end, and of what stands before the first token of each text."""
    history = _after(first, sizes, single)
    unigram = (single + ALPHA) / (total + ALPHA * (kinds + 1))
    pair = np.minimum(both, np.minimum(history, single))
    p = (pair + strength * np.minimum(unigram, 1.0)) / (history + strength)
    return np.bincount(np.repeat(np.arange(len(sizes)), sizes), weights=np.log10(p), minlength=len(sizes))


def pieces(text: bytes, most: int) -> Iterator[tuple[bytes, bool]]:
    """A text cut behind white space into pieces of up to `most` bytes (more only for a longer word); whether it is the last."""
    at = 0
    while len(text) - at > most:
        end = 1 + max(text.rfind(bytes([c]), at, at + most) for c in np.flatnonzero(_WHITE).tolist())
        if not end:
            found = _SPACE.search(text, at + most)
            end = found.end() if found else len(text)
        if end >= len(text):
            break
        yield text[at:end], False
        at = end
    yield text[at:] if at else text, True


def _units(batch: pa.RecordBatch, column: int) -> Iterator[tuple[list[int], list[bytes], np.ndarray, np.ndarray, int]]:
    """Texts, lower-cased, up to UNIT bytes at a time: their rows, the pieces, the tokens that stand before them, whether
    they are the last of their text, and the number of the first within its text."""
    rows, texts, before, last, size, part = [], [], [], [], 0, 0
    for i, t in enumerate(batch.column(column).cast(pa.large_binary())):
        previous = _END
        for j, (text, ends) in enumerate(pieces((t.as_py() or b"").lower(), UNIT)):
            if rows and size + len(text) > UNIT:
                yield rows, texts, np.array(before, np.uint64), np.array(last, bool), part
                rows, texts, before, last, size = [], [], [], [], 0
            part = part if rows else j
            rows.append(i)
            texts.append(text)
            before.append(previous)
            last.append(ends)
            size += len(text)
            tail = [] if ends else text.rsplit(None, 1)
            if tail:
                previous = words(tail[-1])[0][0]
    if rows:
        yield rows, texts, np.array(before, np.uint64), np.array(last, bool), part


def held_out(key: str = "doc_id"):
    """Texts that never teach: CRC-32 of the key's decimal text is 0 modulo 10; a null key counts as no text, whose
    CRC-32 is 0, so it is held out."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 10 == 0


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over all rows of the one text column; counted in each batch before the shuffle."""

    def batches(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(counts: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(counts.keys()), pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"]
            )

        counts: Counter = Counter()
        for batch in it:
            for t in batch.column(0).cast(pa.large_binary()):
                for part, _ in pieces((t.as_py() or b"").lower(), CHUNK):
                    counts.update(part.split())
                    if len(counts) > 250_000:
                        yield out(counts)
                        counts = Counter()
        yield out(counts)

    return texts.mapInArrow(batches, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _unique(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted different values (hashes) and the place of each value among them. Sorted are the leading bits with the index
    behind them, which takes a fraction of the time of an argsort; where bits that this leaves out tell values apart, all are."""
    low = np.uint64(max(1, len(values)).bit_length())
    mask = (np.uint64(1) << low) - np.uint64(1)
    order = (np.sort(values & ~mask | np.arange(len(values), dtype=np.uint64)) & mask).astype(np.int64)
    ordered = values[order]
    if (ordered[1:] < ordered[:-1]).any():
        return np.unique(values, return_inverse=True)
    fresh = np.ones(len(values), dtype=bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    back = np.empty(len(values), dtype=np.int64)
    back[order] = np.cumsum(fresh) - 1
    return ordered[fresh], back


def _distinct(texts: list[bytes], before: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The number of tokens of each piece, the sorted different n-grams, and the place of each token, then of each
    bigram, then of what stands before each piece."""
    toks, sizes = tokens(texts, last)
    grams, back = _unique(np.concatenate([toks, bigrams(toks, sizes, before), before]))
    return sizes, grams, back


def _packed(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The runs of values between cuts as binary values, without an object for each: their number grows with the number of
    units times that of segments, so with the square of the corpus."""
    offsets = (cuts * values.itemsize).astype("<i4")
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _unpacked(column: pa.ChunkedArray, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """The values of packed rows, one row's behind the other's, and where rows are cut."""
    values, sizes = [np.zeros(0, dtype)], [np.zeros(1, np.int64)]
    for chunk in column.chunks:
        if len(chunk):
            chunk = chunk.cast(pa.large_binary())
            _, offsets, data = chunk.buffers()
            ends = np.frombuffer(offsets, "<i8", len(chunk) + 1, chunk.offset * 8)
            if ends[-1] > ends[0]:
                values.append(np.frombuffer(data, np.uint8, ends[-1] - ends[0], ends[0]).view(dtype))
            sizes.append(np.diff(ends) // np.dtype(dtype).itemsize)
    return np.concatenate(values), np.cumsum(np.concatenate(sizes))


_ASKED = "unit long, part int, segment long, names binary, counts binary, docs binary"


def _asked(rows: DataFrame, segments: int) -> DataFrame:
    """The different n-grams of each UNIT of text in one packed row for each segment, with the times that they are
    learnt (0 for those of held-out texts alone); and one row (segment below 0) that carries the texts on."""
    plain = CountFilter(segments, 1)

    def batches(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for at, texts, before, last, part in _units(batch, 3):
                docs = batch.select(["row", "doc_id", "held_out"]).take(pa.array(at))
                unit = docs.column(0)[0].as_py()
                sizes, grams, back = _distinct(texts, before, last)
                learnt = np.repeat(~docs.column(2).to_numpy(zero_copy_only=False).astype(bool), sizes)
                weights = np.concatenate([learnt, learnt, np.zeros(len(before), bool)])
                counts = np.bincount(back, weights=weights, minlength=len(grams)).astype("<u4")
                cuts = np.searchsorted(plain.place(grams)[0], np.arange(segments + 1))
                names = (grams & np.uint64(0xFFFFFFFF)).astype("<u4")
                have = np.flatnonzero(cuts[:-1] < cuts[1:])
                ends = np.append(cuts[have], len(names))
                for name, column in (("text", pa.array(texts, pa.large_binary())), ("before", pa.array(before)), ("last", pa.array(last))):
                    docs = docs.append_column(name, column)
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, docs.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    out.write_batch(docs)
                spread = -1 - ((unit * 1_000_003 + part) & ((1 << 62) - 1))
                for segment, asked, docs_ in (
                    (have.astype(np.int64), (_packed(names, ends), _packed(counts, ends)), pa.nulls(len(have), pa.binary())),
                    (np.array([spread]), (pa.nulls(1, pa.binary()),) * 2, pa.array([sink.getvalue().to_pybytes()], pa.binary())),
                ):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(segment), unit, np.int64)), pa.array(np.full(len(segment), part, np.int32)), pa.array(segment), *asked, docs_],
                        names=["unit", "part", "segment", "names", "counts", "docs"],
                    )

    return rows.mapInArrow(batches, _ASKED)


def _filled(table: pa.Table, probes: int, false_rate: float, size: int | None) -> tuple[CountFilter, np.ndarray, np.ndarray, np.ndarray, int]:
    """The filter of one segment; the different names that its rows ask for, the place of each asked name among them and where
    rows are cut; and the number of entries."""
    names, cuts = _unpacked(table["names"], "<u4")
    counts, _ = _unpacked(table["counts"], "<u4")
    kinds, back = _unique(names.astype(np.uint64) << np.uint64(32))
    kinds >>= np.uint64(32)
    sums = np.bincount(back, weights=counts, minlength=len(kinds))
    learnt = sums > 0
    entries = int(tops(sums[learnt]).sum())
    held = CountFilter(1, probes, size=size or bits_for(entries, false_rate, probes))
    held.bits = np.frombuffer(held.build(kinds[learnt], sums[learnt]), np.uint8)
    return held, kinds, back, cuts, entries


def _levels(table: pa.Table, probes: int, false_rate: float, size: int | None) -> pa.Array:
    """The levels of the names that each row of a segment asks for, packed. Each different name is read once for all rows."""
    held, kinds, back, cuts, _ = _filled(table, probes, false_rate, size)
    return _packed(held.read(np.zeros(len(kinds), np.int64), kinds).astype(np.uint8)[back], cuts)


def _segments(tokens_: int) -> int:
    return 1 << max(0, math.ceil(math.log2(max(1, tokens_) / SEGMENT)))


def _rows(docs: DataFrame, text: str, key: str) -> DataFrame:
    return docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("doc_id"), held_out(key).alias("held_out"), F.col(text).alias("text")
    )


def fill(docs: DataFrame, text: str = "text", key: str = "doc_id", tokens_: int = SEGMENT, probes: int = 3, false_rate: float = 0.001) -> DataFrame:
    """(segment, entries, bits, ones) of the filter that `score` makes for a corpus of so many learnt tokens."""

    def count(table: pa.Table) -> pa.Table:
        held, *_, entries = _filled(table, probes, false_rate, None)
        ones = int(np.bitwise_count(held.bits).sum())
        return pa.table({"segment": table["segment"][:1], "entries": [entries], "bits": [held.size], "ones": [ones]})

    asked = _asked(_rows(docs, text, key), _segments(tokens_)).where("segment >= 0")
    return asked.groupBy("segment").applyInArrow(count, "segment long, entries long, bits long, ones long")


def score(
    docs: DataFrame, text: str = "text", key: str = "doc_id", megabytes: int | None = None, probes: int = 3, strength: float = 300.0, false_rate: float = 0.001
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row.

    `score` is the log10 probability of the text under the bigram model whose counts a `CountFilter` holds (learnt from
    all rows that aren't held out). `base_score` and `n_known` use exact counts of words: those of the most frequent
    words (at most HEAD, each of at most HEAD_BYTES) are broadcast, a text's other words are joined with the counts.
    The filter has a segment for each SEGMENT tokens, as many bits in it as its counted entries need for `false_rate`
    (or `megabytes` in all, if given), and stays where its segments are built: the n-grams of each UNIT of text come
    there once, to be counted and to be read, and their levels go back to the texts. Nothing of it is broadcast or
    comes to the driver. A text longer than UNIT is cut into pieces that know the token before them, so memory doesn't
    grow with the longest text but for the copy that Arrow hands over.
    Null and empty texts are one end token; null keys are held out; repeated rows are scored (and learnt) as often;
    an empty table gives no rows, and without rows to learn from the base score is 0; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = _rows(docs, text, key)
    train = rows.where(~F.col("held_out"))
    ends = train.select("doc_id").count()
    counts = materialise(word_counts(train.select("text")))
    n, kinds = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    total, kinds = (n or 0) + ends, kinds + (ends > 0)

    short = counts.where(F.octet_length("word") <= HEAD_BYTES).withColumn("step", F.floor(F.log2("n") * 8))
    steps = sorted(short.groupBy("step").count().collect(), reverse=True)  # a few hundred rows
    least, have = 1 << 30, 0
    for r in steps:
        have += r["count"]
        if have > HEAD:
            break
        least = r.step
    top = short.where(F.col("step") >= least).select("word", "n").toArrow()
    head = dict(zip((w.encode() for w in top["word"].to_pylist()), np.log10(top["n"].to_numpy() + ALPHA).tolist()))
    shared = spark.sparkContext.broadcast(head)
    end_value = math.log10(ends + ALPHA)
    segments = _segments(total)
    size = megabytes and max(8, (megabytes << 23) // segments // 8 * 8)

    def probe(table: pa.Table) -> pa.Table:
        if table["segment"][0].as_py() < 0:
            return table.select(["unit", "part", "segment", "docs"]).add_column(3, "levels", pa.nulls(len(table), pa.binary()))
        levels = _levels(table, probes, false_rate, size)
        return table.select(["unit", "part", "segment"]).append_column("levels", levels).append_column("docs", pa.nulls(len(table), pa.binary()))

    def finish(table: pa.Table) -> pa.Table:
        get = shared.value.get
        table = table.sort_by("segment")
        batch = pa.ipc.open_stream(table["docs"][0].as_buffer()).read_next_batch()
        level, _ = _unpacked(table["levels"].slice(1), "u1")
        texts, before = batch.column(3).to_pylist(), batch.column(4).to_numpy()
        last = batch.column(5).to_numpy(zero_copy_only=False).astype(bool)
        parts, _, back = _distinct(texts, before, last)
        n = int(parts.sum())
        read = middles(level.astype(np.int64))[back]
        own = log10_probabilities(parts, read[2 * n :], read[:n], read[n : 2 * n], total, kinds, strength)
        values, sizes, known, words, times = [], [], [], [], []
        for t, ended in zip(texts, last.tolist()):
            all_ = t.split()
            found = [x for x in map(get, all_) if x is not None]
            rare = Counter(w for w in all_ if get(w) is None) if len(found) < len(all_) else {}
            values.append(math.fsum(found) + (end_value if ended else 0.0))
            sizes.append(len(all_) + ended)
            known.append(len(found) + (ended and ends > 0))
            words.append([w.decode() for w in rare])
            times.append(list(rare.values()))
        return pa.table(
            [
                *(batch.column(i) for i in range(3)),
                pa.array(sizes, pa.int64()),
                pa.array(known, pa.int64()),
                pa.array(values, pa.float64()),
                pa.array(own, pa.float64()),
                pa.array(words, pa.list_(pa.string())),
                pa.array(times, pa.list_(pa.int64())),
            ],
            names=["row", "doc_id", "held_out", "n_tokens", "known", "value", "score", "words", "times"],
        )

    scored = materialise(
        _asked(rows, segments)
        .groupBy("segment").applyInArrow(probe, "unit long, part int, segment long, levels binary, docs binary")
        .groupBy("unit", "part").applyInArrow(
            finish,
            "row long, doc_id long, held_out boolean, n_tokens long, known long, value double, score double, words array<string>, times array<long>",
        )
    )
    rare = scored.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select("row", "w.words", "w.times")
    rest = (
        rare.join(counts, F.col("words") == F.col("word"))
        .groupBy("row")
        .agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("n") + ALPHA)).alias("worth"))
    )
    known = F.col("known") + F.coalesce("more", F.lit(0))
    scale = math.log10(total + ALPHA * (kinds + 1))
    whole = scored.groupBy("row", "doc_id", "held_out").agg(*(F.sum(c).alias(c) for c in ("n_tokens", "known", "value", "score")))
    return whole.join(rest, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        known.alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (
            F.col("value")
            + F.coalesce("worth", F.lit(0.0))
            + (F.col("n_tokens") - known - F.lit(int(ends == 0))) * math.log10(ALPHA)
            - F.col("n_tokens") * scale
        ).alias("base_score"),
        "score",
    )
