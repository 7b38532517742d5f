"""SimHash near-duplicates through a byte-position inverted index with count filtering."""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.components import components
from lodestar.llm.tables import materialise, row_hash

BITS, BYTES = 64, 8
_SPACES = re.compile(rb"[\x20\x09-\x0D]+")
#: Differences between pairs held in memory at a time.
BLOCK = 1 << 21
#: Byte positions of a wide fingerprint; how often two texts right at the similarity meet in its index, on average; how many
#: of a text's candidates are compared first.
WIDE, MEETINGS, FIRST = 64, 3.0, 4
#: Bytes of the parities of a set, which bound from below how much two sets differ.
PARITIES = 64
#: One text in so many is asked for frequent shingles, and so many of these at most are told to all. They only put shingles
#: in order.
ASKED, FREQUENT = 16, 1 << 18


def shingles(text: bytes, width: int = 3, seed: int = 42) -> Iterator[np.ndarray]:
    """XXH64 of the shingles of a UTF-8 text, block by block: words are cut at ASCII white space, A-Z lower-cased, and joined
    by blanks. Fewer words than `width` are one shingle; no words give none."""
    text, digest = text.lower(), xxhash.xxh64_intdigest  # of bytes: exactly A-Z
    # split() cuts exactly at 20 and 09-0D, but makes an object of each word, which long texts can't afford.
    joined = b" ".join(text.split()) if len(text) < BLOCK else _SPACES.sub(b" ", text).strip()
    if not joined:
        return
    blanks = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    if len(blanks) < width:
        yield np.array([digest(joined, seed)], dtype="<u8")
        return
    n, step = len(blanks) + 2 - width, BLOCK >> 5
    for at in range(0, n, step):
        end = min(n, at + step)
        starts = [0] * (at == 0) + (blanks[max(0, at - 1) : end - 1] + 1).tolist()
        stops = blanks[at + width - 1 : end + width - 1].tolist() + [len(joined)] * (end == n)
        yield np.array([digest(joined[a:b], seed) for a, b in zip(starts, stops)], dtype="<u8")


def _votes(hashes: np.ndarray, width: int) -> np.ndarray:
    """How many of the hashes (rows of bytes) have each bit."""
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, width), axis=1, bitorder="little").sum(0, dtype=np.int64)


def fingerprint(text: bytes, width: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of a UTF-8 text: bit i is set if it is set in over half the hashes of the shingles, repeats
    included; no words give 0."""
    n, counts = 0, np.zeros(BITS, dtype=np.int64)
    for hashes in shingles(text, width, seed):
        n += len(hashes)
        counts += _votes(hashes, BYTES)
    return int.from_bytes(np.packbits(counts * 2 > n, bitorder="little").tobytes(), "little")


def shingle_set(text: bytes, width: int = 5, seed: int = 42) -> np.ndarray:
    """The different shingles of a text, as sorted hashes."""
    parts = list(shingles(text, width, seed))
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, "<u8")


def wide_fingerprint(kinds: np.ndarray) -> bytes:
    """SimHash of a set of shingle hashes with WIDE bytes: each hash is drawn out to as many bits by the finaliser of
    SplitMix64."""
    counts, steps = np.zeros(8 * WIDE, dtype=np.int64), np.arange(1, WIDE // 8 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for at in range(0, len(kinds), 4096):
        x = kinds[at : at + 4096, None] + steps[None, :]
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        counts += _votes(x ^ (x >> np.uint64(31)), WIDE)
    return np.packbits(counts * 2 > len(kinds), bitorder="little").tobytes()


def parities(kinds: np.ndarray, width: int = PARITIES) -> bytes:
    """For each of 8 * `width` buckets (a power of 2), whether an odd number of a set's shingle hashes is in it. Each bucket in
    which two sets disagree holds a shingle that only one of them has."""
    counts = np.bincount((kinds & np.uint64(8 * width - 1)).astype(np.int64), minlength=8 * width)
    return np.packbits((counts & 1).astype(bool), bitorder="little").tobytes()


def disagree(x: bytes, y: bytes) -> int:
    """In how many buckets the parities differ; the wider ones are folded to the width of the others."""
    x, y = sorted((np.frombuffer(v, np.uint64) for v in (x, y)), key=len)
    return int(np.bitwise_count(x ^ np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)).sum(dtype=np.int64))


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp) for each row; fp is the fingerprint as a signed long. Null texts have no words."""

    def batches(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            fps = [fingerprint(t or b"", width, seed) for t in batch.column(1).cast(pa.large_binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(fps, dtype=np.uint64).view(np.int64))], names=["doc_id", "fp"]
            )

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        batches, "doc_id long, fp long"
    )


def cover(differ: int = 3, size: int = 4) -> list[tuple[int, ...]]:
    """Sets of `size` byte positions of which each set of 8 - `differ` positions contains one, chosen greedily."""
    left = set(combinations(range(BYTES), BYTES - differ))
    chosen = []
    while left:
        best = max(combinations(range(BYTES), size), key=lambda s: sum(set(s) <= set(x) for x in left))
        chosen.append(best)
        left -= {x for x in left if set(best) <= set(x)}
    return chosen


def linked(one: np.ndarray, many: np.ndarray, differ: int) -> np.ndarray:
    """Which of `many` fingerprints are within `differ` bits of any of `one`: pairs are tallied by the bytes that
    they share at the same position; those with at least 8 - differ are verified bit by bit."""
    out = np.zeros(len(many), dtype=bool)
    step = max(1, BLOCK // max(1, len(many)))
    for at in range(0, len(one), step):
        apart = np.bitwise_xor(one[at : at + step, None], many[None, :])
        tally = (apart.view(np.uint8).reshape(*apart.shape, BYTES) == 0).sum(-1, dtype=np.uint8)
        row, col = np.nonzero(tally >= BYTES - differ)
        out[col[np.bitwise_count(apart[row, col]) <= differ]] = True
    return out


def forest(posting: np.ndarray, differ: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that join what is connected within one posting list, at most one for each member: each member is
    compared once with those not reached yet. Memory is a block, whatever the length of the list."""
    rest = posting
    while len(rest) > 1:
        seed, front, rest = rest[:1], rest[:1], rest[1:]
        while len(front) and len(rest):
            hit = linked(front[:256], rest, differ)
            found, rest, front = rest[hit], rest[~hit], front[256:]
            if len(found):
                front = np.concatenate([front, found])
                yield np.repeat(seed, len(found)), found


def fingerprint_links(fps: DataFrame, differ: int = 3) -> DataFrame:
    """(a, b) pairs of different fingerprints within `differ` bits that join all that are connected so.

    Two such fingerprints share at least 8 - differ bytes at the same positions. The index posts each fingerprint
    under the values of four byte positions at a time, for a set of such quadruples of which any five positions
    contain one; single bytes have only 256 values, so their lists would grow with the input and pairs with its
    square. Lists are sorted runs of a shuffled table; each is read as a stream and turned into links on the spot.
    """
    sets = cover(differ)
    masks = [sum(0xFF << (8 * p) for p in s) for s in sets]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    posted = F.explode(
        F.array(*(F.struct(F.lit(i).alias("k"), F.col("fp").bitwiseAND(F.lit(m)).alias("v")) for i, m in enumerate(signed)))
    )
    index = (
        fps.select("fp").distinct().select("fp", posted.alias("p")).select("p.k", "p.v", "fp").repartition("k", "v")
        .sortWithinPartitions("k", "v", "fp")
    )

    def runs(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        kept: list[np.ndarray] = []
        last = None

        def flush(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            for a, b in forest(np.concatenate(parts).view(np.uint64), differ):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], schema=schema)

        for batch in it:
            k, v, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            if not len(k):
                continue
            cuts = np.flatnonzero((k[1:] != k[:-1]) | (v[1:] != v[:-1])) + 1
            edges = np.concatenate([[0], cuts, [len(k)]])
            if (k[0], v[0]) != last and kept:
                yield from flush(kept)
                kept = []
            long = np.flatnonzero(np.diff(edges) > 1)
            for i in sorted({0, *long.tolist(), len(edges) - 2}):
                run = fp[edges[i] : edges[i + 1]]
                if i == len(edges) - 2:  # may go on in the next batch
                    kept, last = ([*kept, run.copy()] if i == 0 else [run.copy()]), (k[-1], v[-1])
                elif i == 0:
                    yield from flush([*kept, run])
                    kept = []
                else:
                    yield from flush([run])
        if kept:
            yield from flush(kept)

    return index.mapInArrow(runs, "a long, b long")


def near_duplicates(
    docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = 3, differ: int = 3, seed: int = 42
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: the smallest key reachable by links of at most `differ`
    differing bits. Exact: no link is missed.

    Copies share a fingerprint and are one node, so a group of copies costs one row in the index. Null texts and texts
    without words have fingerprint 0 and link like others; null keys take part but are never a component's id
    (null if a component has no other); repeated rows come back as often; very long texts count whole; an empty table gives
    no rows; other columns are ignored.
    """
    rows = materialise(fingerprints(docs, text, key, width, seed))
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    joined = components(fingerprint_links(nodes, differ))
    rooted = nodes.join(joined, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    rooted = materialise(rooted)
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = rooted.join(named, "root").select("fp", "component_id")
    return rows.join(classes, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def _tagged(docs: DataFrame, text: str, key: str) -> DataFrame:
    return docs.select(
        F.coalesce(F.col(key).cast("long"), F.lit((1 << 63) - 1)).alias("_id"), row_hash(docs).alias("_row"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_all"), F.col(text).alias("_text")
    )


def _first_rows(tagged: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of `tagged` that `kept` (_id, _row) names, one of those that agree in all columns."""
    return tagged.drop("_text").join(kept, ["_id", "_row"], "left_semi").groupBy("_id", "_row").agg(F.first("_all").alias("_all")).select("_all.*")


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = 3, differ: int = 3, seed: int = 42) -> DataFrame:
    """The rows of `docs` with all their columns, one of each component of `near_duplicates`: the row of the smallest key
    (null keys last), among rows of that key the one of the smallest hash over all columns, and one of rows that agree in
    all columns. Null and empty texts are copies of each other, very long texts count whole; an empty table gives no rows."""
    tagged = _tagged(docs, text, key)

    def batches(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            fps = [fingerprint(t.as_py() or b"", width, seed) for t in batch.column(2).cast(pa.large_binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.array(fps, dtype=np.uint64).view(np.int64))], names=["_id", "_row", "fp"]
            )

    marked = materialise(tagged.select("_id", "_row", "_text").mapInArrow(batches, "_id long, _row long, fp long"))
    nodes = marked.groupBy("fp").agg(F.min(F.struct("_id", "_row")).alias("first"))
    joined = components(fingerprint_links(nodes, differ))
    kept = (
        nodes.join(joined, F.col("fp") == F.col("node"), "left")
        .groupBy(F.coalesce("root", "fp"))
        .agg(F.min("first").alias("first"))
        .select("first._id", "first._row")
    )
    return _first_rows(tagged, kept)


def _apart(similarity: float) -> float:
    """The share of bits in which the SimHashes of two sets of equal size and this Jaccard similarity differ, on average."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def plan(rows: int, similarity: float) -> tuple[int, int, int, int]:
    """(lists, bits, matches, radius) for the index of so many wide fingerprints. A list's key is three byte positions and
    `bits` more bits, so that chance companions stay rare as the table grows; there are as many lists as two texts right at
    the similarity need to meet MEETINGS times on average. Such texts share at least `matches` of the WIDE bytes and differ in
    at most `radius` bits, but for one pair in a thousand."""
    p = _apart(similarity)
    bits = max(0, math.ceil(math.log2(max(1, rows))) - 20)
    lists = math.ceil(MEETINGS / (1 - p) ** (24 + bits))
    same, total, matches = (1 - p) ** 8, 0.0, -1
    while total < 0.001:
        matches += 1
        total += math.comb(WIDE, matches) * same**matches * (1 - same) ** (WIDE - matches)
    return lists, bits, matches, math.ceil(8 * WIDE * p + 3 * math.sqrt(8 * WIDE * p * (1 - p)))


def keys(fps: np.ndarray, lists: int, bits: int, seed: int) -> Iterator[np.ndarray]:
    """The key of each fingerprint (rows of WIDE bytes) in list after list; lists are told apart by the upper bits."""
    rng = np.random.default_rng(seed)
    wide = fps.astype(np.int64)
    for at in range(lists):
        *places, more = rng.choice(WIDE, 4, replace=False)
        value = np.full(len(fps), at, dtype=np.int64)
        for place in places:
            value = value << 8 | wide[:, place]
        yield value << bits | wide[:, more] & ((1 << min(8, bits)) - 1)


def _bytes(column: pa.Array, width: int = WIDE) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def _sets(texts: DataFrame, width: int, seed: int) -> DataFrame:
    """(node, n, odd, kinds) of texts (node, _text): the number of their shingles, 4 to 8 `parities` for each shingle, and the
    sets, packed."""

    def batches(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(it, 1):
            kinds = list(_kinds(batch, 1, width, seed))
            odd = [parities(x, max(PARITIES, 1 << (len(x) // 2).bit_length())) for x in kinds]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) for x in kinds], pa.int32()), pa.array(odd, pa.binary()), pa.array([x.tobytes() for x in kinds], pa.binary())],
                names=["node", "n", "odd", "kinds"],
            )

    return texts.select("node", "_text").mapInArrow(batches, "node long, n int, odd binary, kinds binary")


def _similar(sets: DataFrame, pairs: DataFrame, similarity: float) -> DataFrame:
    """Those of `pairs` (a, b) whose `sets` are so similar: those that their parities don't rule out, compared in full."""

    def bound(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            both = batch.column(2).to_numpy().astype(np.float64) + batch.column(4).to_numpy()
            most = both - 2 * np.ceil(similarity / (1 + similarity) * both - 1e-6)
            apart = [disagree(x.as_buffer(), y.as_buffer()) for x, y in zip(batch.column(3), batch.column(5))]
            yield batch.select([0, 1]).filter(pa.array(np.array(apart, np.int64) <= most))

    def compare(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), "<u8") for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= similarity * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    own = lambda side, *names: sets.select(F.col("node").alias(side), *(F.col(n).alias(f"{n}_{side}") for n in names))
    near = pairs.join(own("a", "n", "odd"), "a").join(own("b", "n", "odd"), "b").select("a", "b", "n_a", "odd_a", "n_b", "odd_b").mapInArrow(bound, "a long, b long")
    return near.join(own("a", "kinds"), "a").join(own("b", "kinds"), "b").select("a", "b", "kinds_a", "kinds_b").mapInArrow(compare, "a long, b long")


def candidates(nodes: DataFrame, similarity: float = 0.8, seed: int = 42) -> DataFrame:
    """(a, b, apart) of pairs of `nodes` (node, fp) that the index brings together, within the radius of `plan`.

    Each fingerprint is posted under byte positions and their values. A list is put in an order of its own by a hash, and
    neighbours are candidates: so a posting gives one pair at most, however long a list is, and a large group is held together
    by other pairs in every list. Candidates are tallied by the bytes that they share at the same positions; those that
    reach the minimum of `plan` are verified bit by bit."""
    lists, bits, matches, radius = plan(nodes.count(), similarity)

    def post(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                for key in keys(_bytes(part.column(1)), lists, bits, seed):
                    yield pa.RecordBatch.from_arrays([pa.array(key), part.column(0)], names=["key", "node"])

    def verify(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            x = _bytes(batch.column(2)) ^ _bytes(batch.column(3))
            apart = np.bitwise_count(x).sum(1, dtype=np.int32)
            near = ((x == 0).sum(1) >= matches) & (apart <= radius)
            yield pa.RecordBatch.from_arrays([*batch.select([0, 1]).columns, pa.array(apart)], names=["a", "b", "apart"]).filter(pa.array(near))

    before = F.lag("node").over(Window.partitionBy("key").orderBy(F.xxhash64("key", "node")))
    posted = nodes.select("node", "fp").mapInArrow(post, "key long, node long").select("node", before.alias("other"))
    pairs = posted.where("other is not null").select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
    known = nodes.select("node", "fp")
    met = pairs.join(known.withColumnsRenamed({"node": "a", "fp": "x"}), "a").join(known.withColumnsRenamed({"node": "b", "fp": "y"}), "b")
    return met.select("a", "b", "x", "y").mapInArrow(verify, "a long, b long, apart int")


def _slices(it: Iterable[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the texts of a column are about BLOCK bytes together, or one text: what is made of them at a time
    is bounded by bytes, not by rows."""
    for batch in it:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BLOCK, "right")))
            yield batch.slice(at, end - at)
            at = end


def _kinds(batch: pa.RecordBatch, column: int, width: int, seed: int) -> Iterator[np.ndarray]:
    for t in batch.column(column).cast(pa.large_binary()):
        yield shingle_set(t.as_py() or b"", width, seed)


def frequent(texts: DataFrame, width: int, seed: int) -> np.ndarray:
    """Frequent shingles of a sample of `texts` (_id, _row, _text), sorted, in a record with their counts; at most FREQUENT."""

    def count(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for at in range(0, batch.num_rows, 1024):
                kinds, n = np.unique(np.concatenate([np.zeros(0, "<u8"), *_kinds(batch.slice(at, 1024), 2, width, seed)]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(kinds.view(np.int64)), pa.array(n.astype(np.int64))], names=["kind", "n"])

    sample = texts.where(F.pmod(F.xxhash64("_id", "_row"), F.lit(ASKED)) == 0).mapInArrow(count, "kind long, n long")
    top = sample.groupBy("kind").agg(F.sum("n").alias("n")).where("n > 2").orderBy(F.desc("n"), "kind").limit(FREQUENT).toArrow()
    out = np.zeros(len(top), [("kind", "<u8"), ("n", "<i8")])
    out["kind"], out["n"] = top["kind"].to_numpy().view("<u8"), top["n"].to_numpy()
    return np.sort(out, order="kind")


def prefix(kinds: np.ndarray, similarity: float, often: np.ndarray) -> np.ndarray:
    """The first shingles of a set in an order that is the same for all sets, those of `often` last. Two sets of this
    similarity have a shingle in common in these."""
    if not len(kinds):
        return kinds
    n = np.zeros(len(kinds), np.int64)
    if len(often):
        at = np.minimum(np.searchsorted(often["kind"], kinds), len(often) - 1)
        n = np.where(often["kind"][at] == kinds, often["n"][at], 0)
    return kinds[np.argsort(n, kind="stable")][: len(kinds) - math.ceil(similarity * len(kinds) - 1e-6) + 1]


_LISTS = "key long, root long, node long, size int, at int"


def _whole_runs(it: Iterable[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The columns of whole runs of a key, of batches in the order of the key; and where the run and the run of its root end."""
    held: list[np.ndarray] = []

    def ends(columns: list[np.ndarray]) -> list[np.ndarray]:
        key, root = columns[:2]
        new = np.ones(len(key) + 1, dtype=bool)
        new[1:-1] = key[1:] != key[:-1]
        runs = np.flatnonzero(new)
        new[1:-1] |= root[1:] != root[:-1]
        groups = np.flatnonzero(new)
        return [*columns, *(e[1:].repeat(np.diff(e)) for e in (runs, groups))]

    for batch in it:
        columns = [_bytes(c, PARITIES).view(np.uint64) if c.type == pa.binary() else c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if len(columns[0]):
            columns = [np.concatenate(c) for c in zip(held, columns)] if held else columns
            cut = int(np.searchsorted(columns[0], columns[0][-1]))
            if cut:
                yield ends([c[:cut] for c in columns])
            held = [c[cut:].copy() for c in columns]
    if held:
        yield ends(held)


def _in_order(lists: DataFrame, *within: Column) -> DataFrame:
    return lists.repartition("key").sortWithinPartitions("key", *within, "root", "node")


def _between(lists: DataFrame, similarity: float, chain: bool) -> DataFrame:
    """(a, b) of texts in different groups that may be so similar, from lists (key, root, node, size, at, odd). A pair is told by
    the list of the first shingle that both have: what it has behind it in either set must do for the similarity, and so must
    what their `parities` leave in common. Both are bounds, so no similar pair is left out, and they are tested in place:
    of the pairs in a list only those that pass become rows, and what a task meets again is told once. With `chain` only
    neighbours in a list are seen, in an order of its own and whichever of their shingles it is, to join most of what is left
    cheaply."""

    def once(held: list[np.ndarray]) -> np.ndarray:
        both = np.concatenate(held, axis=1)
        both = both[:, np.lexsort(both)]
        return both[:, np.concatenate([[True], (both[:, 1:] != both[:, :-1]).any(0)])]

    def told(both: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], names=["a", "b"])

    def pairs(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for _, _, node, size, at, odd, run, group in _whole_runs(it):
            first = np.arange(len(node))
            many = np.where(chain & (group != first + 1), 0, np.minimum(run - group, 1 if chain else len(node)))
            ends = np.cumsum(many)
            done = 0
            while done < len(many):
                base = ends[done - 1] if done else 0
                upto = max(done + 1, int(np.searchsorted(ends, base + (BLOCK >> 6), "right")))
                i = np.repeat(first[done:upto], many[done:upto])
                j = group[i] + np.arange(len(i)) - (ends[i] - many[i] - base)
                done = upto
                x, y = size[i].astype(np.float64), size[j].astype(np.float64)
                least = np.ceil(similarity / (1 + similarity) * (x + y) - 1e-6)
                near = np.minimum(x, y) >= similarity * np.maximum(x, y) - 1e-6
                if not chain:
                    near &= np.minimum(x - at[i], y - at[j]) >= least
                i, j, most = i[near], j[near], (x + y - 2 * least)[near]
                near = np.bitwise_count(odd[i] ^ odd[j]).sum(1, dtype=np.int64) <= most
                a, b = node[i[near]], node[j[near]]
                if len(a):
                    held.append(np.stack([np.minimum(a, b), np.maximum(a, b)]))
                if sum(x.shape[1] for x in held) >= BLOCK >> 4:
                    held = [once(held)]
                    if held[0].shape[1] >= BLOCK >> 5:
                        yield told(held.pop())
        if held:
            yield told(once(held))

    ordered = _in_order(lists, F.xxhash64("key", "root")) if chain else _in_order(lists)
    return ordered.mapInArrow(pairs, "a long, b long").distinct()


def shared_lists(texts: DataFrame, nodes: DataFrame, roots: DataFrame, width: int, similarity: float, seed: int) -> DataFrame:
    """The lists (key, root, node, size, at, odd) of shingles in whose prefixes texts of different groups meet. `nodes` (node, odd,
    _id, _row) are looked up in `texts` (_id, _row, _text); `roots` (node, root) has the groups of more than one."""
    shared = texts.sparkSession.sparkContext.broadcast(frequent(texts, width, seed))

    def post(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(it, 2):
            kinds = list(_kinds(batch, 2, width, seed))
            first = [prefix(x, similarity, shared.value).tobytes() for x in kinds]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(x) for x in kinds], pa.int32()), pa.array(first, pa.binary())], names=["_id", "_row", "size", "first"]
            )

    def deal(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for step in range(0, batch.num_rows, 256):
                part = batch.slice(step, 256)
                keys = [np.frombuffer(x.as_buffer(), "<i8") for x in part.column(3)]
                many = np.array([len(x) for x in keys])
                rest = [part.column(i).to_numpy(zero_copy_only=False).repeat(many) for i in (1, 0, 2)]
                at = np.arange(many.sum()) - (np.cumsum(many) - many).repeat(many)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.concatenate(keys), *rest, at.astype(np.int32))], names=["key", "root", "node", "size", "at"])

    def mixed(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for *columns, run, group in _whole_runs(it):
            several = np.ones(len(run), dtype=bool)
            starts = np.concatenate([[0], np.unique(run)[:-1]])
            several = (group[starts] != run[starts]).repeat(np.diff(np.append(starts, len(run))))
            yield pa.RecordBatch.from_arrays([pa.array(c[several]) for c in columns], names=["key", "root", "node", "size", "at"])

    named = nodes.join(roots, "node", "left").select("_id", "_row", "node", F.coalesce("root", "node").alias("root"))
    prefixes = texts.select("_id", "_row", "_text").mapInArrow(post, "_id long, _row long, size int, first binary").join(named, ["_id", "_row"])
    one = prefixes.groupBy("_id", "_row", "node", "root").agg(F.first("size").alias("size"), F.first("first").alias("first"))
    lists = _in_order(one.select("node", "root", "size", "first").mapInArrow(deal, _LISTS)).mapInArrow(mixed, _LISTS)
    return materialise(lists.join(nodes.select("node", "odd"), "node").select("key", "root", "node", "size", "at", "odd"))


def keep_similar(docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = 5, similarity: float = 0.8, seed: int = 42) -> DataFrame:
    """The rows of `docs` with all their columns, one of each group of near-duplicates: texts whose sets of `width`-word
    shingles have a Jaccard similarity of at least `similarity`, and whatever such links join.

    Every link is verified in full, so no others are joined; candidates come from wide SimHashes of the sets (`candidates`),
    which bring together two texts right at the similarity with a chance of about 0.9 and more similar ones almost surely.
    The FIRST nearest candidates of each text are compared first, then all those whose ends these left in different groups.
    An exact way for the rest follows: of two similar sets, the first shingles in an order common to all have one in common
    (`prefix`), so texts of different groups that meet in the list of such a shingle (`shared_lists`) are compared in full unless
    a bound rules them out (`_between`), first neighbours in a list, then all that are still in different groups. No link between
    groups is left out.
    Which row of a group stays is as in `keep_one`. Null and empty texts are copies of each other, texts of fewer words are
    one shingle, very long texts count whole; an empty table gives no rows.
    """
    tagged = _tagged(docs, text, key)

    def batches(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(it, 2):
            fps, sets, odd = [], [], []
            for kinds in _kinds(batch, 2, width, seed):
                fps.append(wide_fingerprint(kinds))
                sets.append(xxhash.xxh64_intdigest(kinds.tobytes()))
                odd.append(parities(kinds))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(fps, pa.binary()), pa.array(np.array(sets, np.uint64).view(np.int64)), pa.array(odd, pa.binary())],
                names=["_id", "_row", "fp", "set", "odd"],
            )

    marked = materialise(tagged.select("_id", "_row", "_text").mapInArrow(batches, "_id long, _row long, fp binary, set long, odd binary"))
    grouped = marked.groupBy("fp", "set").agg(F.min(F.struct("_id", "_row")).alias("first"), F.first("odd").alias("odd"))
    nodes = materialise(grouped.select(F.monotonically_increasing_id().alias("node"), "fp", "first", "odd"))
    near = materialise(candidates(nodes, similarity, seed))
    ends = near.select("a", "b", "apart").union(near.select("b", "a", "apart"))
    nearest = Window.partitionBy("a").orderBy("apart", F.xxhash64("a", "b"))
    ranked = ends.select("a", "b", F.row_number().over(nearest).alias("at")).where(F.col("at") <= FIRST)
    first = ranked.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def linked_by(pairs: DataFrame) -> DataFrame:
        pairs = materialise(pairs)
        asked = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct().join(nodes.select("node", "first._id", "first._row"), "node")
        texts = tagged.select("_id", "_row", "_text").join(asked, ["_id", "_row"]).groupBy("node").agg(F.first("_text").alias("_text"))
        return materialise(_similar(materialise(_sets(texts, width, seed)), pairs, similarity))

    links = linked_by(first)
    roots = components(links)
    own = lambda side: roots.select(F.col("node").alias(side), F.col("root").alias(f"_{side}"))
    rest = near.join(own("a"), "a", "left").join(own("b"), "b", "left").where(F.coalesce("_a", "a") != F.coalesce("_b", "b"))
    links = links.union(linked_by(rest.select("a", "b").join(first, ["a", "b"], "left_anti")))
    joined = components(links)
    lists = shared_lists(tagged.select("_id", "_row", "_text"), nodes.select("node", "odd", "first._id", "first._row"), joined, width, similarity, seed)
    neighbours = materialise(_between(lists, similarity, True))
    links = links.union(linked_by(neighbours))
    regrouped = lists.drop("root").join(components(links), "node", "left").select("key", F.coalesce("root", "node").alias("root"), "node", "size", "at", "odd")
    links = links.union(linked_by(_between(regrouped, similarity, False).join(neighbours, ["a", "b"], "left_anti")))
    joined = components(links)
    kept = nodes.join(joined, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("first").alias("first")).select("first._id", "first._row")
    return _first_rows(tagged, kept)
