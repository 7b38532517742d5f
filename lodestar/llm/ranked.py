"""Ranked lexical search, a score at a time: postings in groups of equal impact, the highest contributions first."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lodestar.llm.tables import materialise
from lodestar.llm.words import blocks, pieces, words

#: Postings that are indexed at a time; the part of the highest contribution that a round goes down to; how many candidates
#: for each result are completed at most once no other document can enter.
BLOCK, STEP, OPEN = 1 << 20, 0.92, 10
#: A score that no document reaches.
NONE = np.iinfo(np.int64).max


def postings(docs: DataFrame, vocabulary: Mapping[bytes, int]) -> DataFrame:
    """doc_id, n (terms with repeats), terms and tfs (of those in the vocabulary) of each document with terms."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int32()))])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, ends, terms, tfs = [], [], [0], [], []
            for key, text in zip(batch["doc_id"].to_pylist(), batch["text"].cast(pa.binary())):
                n, found = 0, Counter()
                for piece in pieces(text.as_py() or b""):
                    part = piece.split()
                    n += len(part)
                    for word, times in Counter(part).items():
                        if word in vocabulary:
                            found[vocabulary[word]] += times
                if n:
                    ids.append(key)
                    sizes.append(n)
                    terms.extend(found)
                    tfs.extend(found.values())
                    ends.append(len(terms))
            ends = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(x, pa.int32())) for x in (terms, tfs)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), *lists], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(count, "doc_id long, n long, terms array<int>, tfs array<int>")


@dataclass
class Best:
    """The k best results so far of one query: scores, and ids with nulls last, in order."""

    k: int
    scores: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    missing: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))

    def least(self) -> int:
        """What a document needs to enter or to tie with the last."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        s, i, m = (np.concatenate(x) for x in ((self.scores, scores), (self.ids, ids), (self.missing, missing)))
        order = np.lexsort((i, m, -s))[: self.k]
        self.scores, self.ids, self.missing = s[order], i[order], m[order]


class Block:
    """The postings of some documents: by document, and by term in falling order of impact."""

    def __init__(self, ids: np.ndarray, missing: np.ndarray, m: np.ndarray, ends: np.ndarray, terms: np.ndarray, tfs: np.ndarray, n_terms: int):
        self.ids, self.missing, self.ends, self.terms, self.n_terms = ids, missing, ends, terms, n_terms
        doc = np.repeat(np.arange(len(ids), dtype=np.int32), np.diff(ends))
        tf = tfs.astype(np.int64)
        self.impacts = (1_000_000_000 * tf) // (1000 * tf + 12 * m[doc])
        order = np.lexsort((-self.impacts, terms))
        self.doc, self.falling = doc[order], -self.impacts[order]
        self.starts = np.searchsorted(terms[order], np.arange(n_terms + 1))
        self.read = 0

    def search(self, query: Mapping[int, int], best: Best) -> None:
        """Put the documents that belong to the best of a query (term: weight) there.

        Each round reads, of each term, the groups of equal impact whose contribution is not under a falling level. What
        any document can still get is the sum of the terms' next contributions. Rounds end when this is under the k-th
        score that is certain by now, so that only documents already seen can enter, and few of them can; the scores of those are
        then completed from their own postings."""
        lists = [(t, w, int(self.starts[t]), int(self.starts[t + 1])) for t, w in query.items() if w > 0 and self.starts[t] < self.starts[t + 1]]
        if not lists:
            return
        weight = [w for _, w, _, _ in lists]
        at, end = [a for _, _, a, _ in lists], [b for _, _, _, b in lists]
        acc = np.zeros(len(self.ids), np.int64)
        while True:
            heads = [-w * int(self.falling[a]) if a < b else 0 for w, a, b in zip(weight, at, end)]
            rest, top = sum(heads), max(heads)
            need = best.least()
            if best.k <= len(acc):
                need = max(need, int(np.partition(acc, len(acc) - best.k)[len(acc) - best.k]))
            if rest < need or not top:
                able = np.flatnonzero(acc + rest >= need)
                if not top or len(able) <= OPEN * best.k:
                    break
            level = top * STEP
            for i, head in enumerate(heads):
                if head and head >= level:
                    a, b = at[i], end[i]
                    z = a + int(np.searchsorted(self.falling[a:b], -math.ceil(level / weight[i]), side="right"))
                    acc[self.doc[a:z]] -= weight[i] * self.falling[a:z]
                    self.read += z - a
                    at[i] = z
        able = able[acc[able] > 0]
        if len(able):
            scores = self._complete(able, query) if top else acc[able]
            good = scores >= need
            best.add(scores[good], self.ids[able][good], self.missing[able][good])

    def _complete(self, docs: np.ndarray, query: Mapping[int, int]) -> np.ndarray:
        table = np.zeros(self.n_terms, np.int64)
        table[list(query)] = list(query.values())
        return np.array([int(table[self.terms[a:b]] @ self.impacts[a:b]) for a, b in zip(self.ends[docs].tolist(), self.ends[docs + 1].tolist())], np.int64)


def _blocks(batch: pa.RecordBatch, N: int, L: int, n_terms: int, size: int) -> Iterator[Block]:
    """Blocks of about `size` postings of a batch; lengths are normalised in whole numbers of any size."""
    lists = batch["terms"]
    ends = np.asarray(lists.offsets, np.int64)
    terms, tfs = np.asarray(lists.values), np.asarray(batch["tfs"].values)
    tfs = tfs[int(np.asarray(batch["tfs"].offsets)[0]) - int(ends[0]) :] if len(batch["tfs"].offsets) else tfs
    ids, missing = batch["doc_id"].fill_null(0).to_numpy(), batch["doc_id"].is_null().to_numpy(zero_copy_only=False)
    m = np.array([75 + 25 * n * N // L for n in batch["n"].to_pylist()], np.int64)
    low = 0
    while low < batch.num_rows:
        high = max(low + 1, int(np.searchsorted(ends, ends[low] + size, side="right")) - 1)
        a, b = int(ends[low]), int(ends[high])
        yield Block(ids[low:high], missing[low:high], m[low:high], ends[low : high + 1] - a, terms[a:b], tfs[a:b], n_terms)
        low = high


def _one_block(docs: DataFrame, asked: list[Row], items: DataFrame, k: int) -> DataFrame:
    """Results of a block of items: documents are indexed and searched where they are, each task keeps its k best of each
    item, and the best of all tasks are the results."""
    terms = [words(r.text.encode()) for r in asked]
    vocabulary = {w: i for i, w in enumerate(dict.fromkeys(w for t in terms for w in t))}
    held = materialise(postings(docs, vocabulary))
    N, L = held.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = {r.term: r.n for r in held.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n")).collect()}  # a block's terms
    weight = {t: math.floor(1000 * math.log((2 * N + 2) / (2 * n + 1))) for t, n in df.items()}
    queries = [{t: times * weight[t] for t, times in Counter(map(vocabulary.__getitem__, ts)).items() if t in weight} for ts in terms]
    ids, n_terms = [r.item_id for r in asked], len(vocabulary)
    kind = items.schema["item_id"].dataType
    schema = pa.schema([("_item", pa.int32()), ("item_id", to_arrow_type(kind)), ("doc_id", pa.int64()), ("score", pa.int64())])
    sent = docs.sparkSession.sparkContext.broadcast((queries, ids))  # a block of items

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, ids = sent.value
        best = [Best(k) for _ in queries]
        for batch in batches:
            for block in _blocks(batch, N, L, n_terms, BLOCK):
                for query, b in zip(queries, best):
                    block.search(query, b)
        for i, b in enumerate(best):
            n = len(b.scores)
            yield pa.RecordBatch.from_arrays([pa.array([i] * n, pa.int32()), pa.array([ids[i]] * n, schema.field(1).type), pa.array(b.ids, mask=b.missing), pa.array(b.scores)], schema=schema)

    return held.where(F.size("terms") > 0).mapInArrow(search, f"_item int, item_id {kind.simpleString()}, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the k documents (doc_id, text) of the highest scores above 0 for each row of
    `items` (item_id, text), equal scores by doc_id.

    Terms are letters, digits and what isn't ASCII, with A-Z lower-cased, in whole texts. With N documents that have terms and
    L terms in all, a term of df documents weighs w = floor(1000 ln((2N + 2) / (2df + 1))); its impact in a document of n terms, tf times
    this one, is 10^9 tf div (1000 tf + 12 m), m = 75 + 25 n N div L; a score sums w times the impact over the item's terms, repeats
    included. Impacts and scores are whole numbers.

    Null and empty texts have no terms: they are never found and find nothing. Null doc_ids go last among equal scores;
    repeated documents are found as often as they occur; repeated rows of `items` are each answered, so ranks repeat for their id.
    Very long texts are read in pieces. Empty tables give no rows; other columns are ignored. Items are taken in blocks of bounded
    size; for each block the documents are read once, and only its terms are indexed, so work grows with blocks times documents.
    Tasks hold one block of postings and the k best of each item of the block.
    """
    out = None
    for asked in blocks(items):
        found = _one_block(docs, asked, items, k)
        order = Window.partitionBy("_item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        found = found.select("*", F.row_number().over(order).alias("rank")).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
        out = found if out is None else out.union(found)
    return out
