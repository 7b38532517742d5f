"""A full-text index in segments: bucketed postings in blocks with bounds, positions if wanted, appends, deletions, merges."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from lodestar.functions import text as T
from lodestar.sources import files
from lodestar.sources.shared import bucketed, materialise, place, scratch, spread

#: Postings in a block, and documents in a shard: no term has more postings together than a shard has documents.
BLOCK, SHARD = 128, 1 << 20


_COUNTED = StructType([StructField("terms", ArrayType(StringType())), StructField("tfs", ArrayType(IntegerType())), StructField("at", ArrayType(ArrayType(IntegerType())))])


#: Terms that are counted at a time, of whole lists.
COUNTED = 1 << 17


@F.arrow_udf(_COUNTED)
def _counter(terms: pa.Array) -> pa.Array:
    """The different terms of each list, how often each occurs, and where."""
    return _some_at_a_time(terms, _count)


def _some_at_a_time(terms: pa.Array, count: Callable[[pa.Array], pa.Array]) -> pa.Array:
    """Of a batch some lists are counted at a time: what that takes is several times the size of the terms."""
    ends = np.append(0, np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(terms), 0), np.int64)))
    parts, low = [], 0
    while low < len(terms) or not parts:
        high = max(low + 1, int(np.searchsorted(ends, ends[low] + COUNTED, "right")) - 1)
        parts.append(count(terms[low:high]))
        low = high
    return pa.concat_arrays(parts)


def _count(terms: pa.Array) -> pa.Array:
    lists = terms.fill_null([])
    sizes = np.diff(np.asarray(lists.offsets, np.int64))
    doc, coded = np.repeat(np.arange(len(lists)), sizes), lists.flatten().dictionary_encode()
    code = np.asarray(coded.indices, np.int64)
    at = np.arange(len(code)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    both = doc * max(1, len(coded.dictionary)) + code
    order = np.argsort(both, kind="stable")
    first = np.flatnonzero(np.diff(both[order], prepend=-1))
    each = np.append(first, len(code)).astype(np.int32)
    ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(doc[order][first], minlength=len(lists)))]).astype(np.int32))
    places = pa.ListArray.from_arrays(pa.array(each), pa.array(at[order].astype(np.int32)))
    columns = (coded.dictionary.take(pa.array(code[order][first])), pa.array(np.diff(each)), places)
    return pa.StructArray.from_arrays([pa.ListArray.from_arrays(ends, c) for c in columns], ["terms", "tfs", "at"])


@dataclass(frozen=True)
class _Phrases:
    """Phrases, parts joined by blanks, as a tree of their parts: `next` of (node, part) in the order of `steps`, node * parts + part, and of
    each node the phrase that ends there, or -1."""

    phrases: list[str]
    parts: list[str]
    steps: np.ndarray
    next: np.ndarray
    ends: np.ndarray
    longest: int

    @classmethod
    def of(cls, phrases: list[str]) -> _Phrases:
        cut = [p.split(" ") for p in phrases]
        code = {w: i for i, w in enumerate(sorted({w for ws in cut for w in ws}))}
        steps: dict[int, int] = {}
        ends = [-1]
        for i, ws in enumerate(cut):
            node = 0
            for w in ws:
                step = node * len(code) + code[w]
                if step not in steps:
                    steps[step] = len(ends)
                    ends.append(-1)
                node = steps[step]
            ends[node] = i
        order = sorted(steps)
        return cls(phrases, list(code), np.array(order, np.int64), np.array([steps[x] for x in order], np.int64), np.array(ends, np.int64), max(map(len, cut), default=0))

    def placed(self, terms: Column) -> Column:
        """Of the parts of a text those that a phrase has, each with its place."""
        return F.filter(F.transform(terms, lambda t, i: F.struct(t.alias("part"), i.alias("at"))), lambda x: x["part"].isin(self.parts))

    def count(self, placed: pa.Array) -> pa.Array:
        """The phrases of each text and how often each stands there, from `placed`: all starts go on together, part by part, as long
        as the next part stands next to the last one and leads to a phrase."""
        sizes, flat = np.diff(np.asarray(placed.offsets, np.int64)), placed.flatten()
        doc, at = np.repeat(np.arange(len(placed)), sizes), np.asarray(flat.field("at"), np.int64)
        code = np.asarray(pc.index_in(flat.field("part"), pa.array(self.parts, pa.string())), np.int64)
        beside = np.append((np.diff(doc) == 0) & (np.diff(at) == 1), False)[: len(code)]
        here, node, found = np.arange(len(code)), np.zeros(len(code), np.int64), [np.zeros(0, np.int64)]
        for _ in range(self.longest):
            step = node * len(self.parts) + code[here]
            k = np.minimum(np.searchsorted(self.steps, step), len(self.steps) - 1)
            known = self.steps[k] == step
            here, node = here[known], self.next[k[known]]
            end = self.ends[node]
            found.append(doc[here[end >= 0]] * len(self.phrases) + end[end >= 0])
            here, node = here[beside[here]] + 1, node[beside[here]]
        both, n = np.unique(np.concatenate(found), return_counts=True)
        of, phrase = np.divmod(both, max(1, len(self.phrases)))
        ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(placed)))]).astype(np.int32))
        columns = (pa.array(self.phrases, pa.string()).take(pa.array(phrase)), pa.array(n.astype(np.int32)))
        return pa.StructArray.from_arrays([pa.ListArray.from_arrays(ends, c) for c in columns], ["terms", "tfs"])

    def counter(self):
        @F.arrow_udf(StructType(_COUNTED.fields[:2]))
        def counted(placed: pa.Array) -> pa.Array:
            return _some_at_a_time(placed, self.count)

        return counted


def as_phrase(term: Column) -> Column:
    """A term as full-text engines take it: cut at all but letters and digits, its parts joined by blanks."""
    return F.array_join(T.fts_parts(term), " ")


#: So many terms of known queries at most are told to all tasks, which then keep these alone.
KNOWN = 10_000
#: Documents whose postings of known terms are in a bucket, about.
DEALT = 16_384


@dataclass(frozen=True)
class Segment:
    """Documents (result columns and _length) and postings (bucketed by shard and term): a row for each
    block of a term's postings, the most frequent in the shortest documents first, with its size, its highest tf
    and its shortest length. Both bound what a posting of the block can add to a score, whatever the statistics of the index."""

    number: int
    docs: DataFrame
    postings: DataFrame
    shards: int


@dataclass(frozen=True)
class Index:
    """Segments, and deletions (key, before): a document is deleted from the segments with a smaller number."""

    segments: tuple[Segment, ...]
    key: str = "doc_id"
    positional: bool = False
    deletions: DataFrame | None = None
    #: Postings (term, key, tf, length) of known queries alone, which are read once: blocks and bounds wouldn't pay.
    flat: DataFrame | None = None

    def live(self, s: Segment, docs: DataFrame | None = None) -> DataFrame:
        docs = s.docs if docs is None else docs
        if self.deletions is None:
            return docs
        return docs.join(self.deletions.where(F.col("before") > s.number).select(self.key), self.key, "left_anti").select(*docs.columns)

    def _all(self, one) -> DataFrame:
        return reduce(DataFrame.unionByName, map(one, self.segments))

    @property
    def docs(self) -> DataFrame:
        """Documents with their result columns."""
        return self._all(lambda s: self.live(s).drop("_length"))

    @property
    def postings(self) -> DataFrame:
        """(term, key, tf, length), one row each."""
        if self.flat is not None:
            return self.flat
        posting = F.explode(F.arrays_zip("keys", "tfs", "lengths")).alias("p")
        flat = lambda s: s.postings.select("term", posting).select("term", F.col("p.keys").alias(self.key), F.col("p.tfs").alias("tf"), F.col("p.lengths").alias("length"))
        return self._all(lambda s: self.live(s, flat(s)))

    def stats(self) -> DataFrame:
        """n and avg_length (at least 1); documents without terms count too."""
        lengths = self._all(lambda s: self.live(s).select("_length"))
        total = lengths.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("_length"), F.lit(0)).alias("_total"))
        return total.select("n", F.greatest(F.col("_total") / F.greatest("n", F.lit(1)), F.lit(1.0)).alias("avg_length"))

    def removed(self, terms: DataFrame) -> DataFrame | None:
        """(term, gone): in how many deleted documents each of some terms is, which blocks still count."""
        if self.deletions is None:
            return None

        def gone(s):
            keys = s.postings.join(terms, "term", "left_semi").select("term", F.explode("keys").alias(self.key))
            return keys.join(self.deletions.where(F.col("before") > s.number).select(self.key), self.key, "left_semi")

        return self._all(gone).groupBy("term").agg(F.count(F.lit(1)).alias("gone"))


def _table(df: DataFrame, path: str, by: list[str], order: list[str], buckets: int) -> DataFrame:
    """A bucketed table at `path`, one file a bucket."""
    name = f"lodestar_{uuid.uuid4().hex}"
    df.repartition(buckets, *by).write.format("parquet").bucketBy(buckets, *by).sortBy(*order).option("compression", "zstd").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def _reopen(spark: SparkSession, path: str, ddl: str, by: list[str], order: list[str], buckets: int) -> DataFrame:
    name = f"lodestar_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet CLUSTERED BY ({', '.join(by)}) SORTED BY ({', '.join(order)}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


_BY, _ORDER = ["shard", "term"], ["shard", "term", "block"]


def _kept(docs: DataFrame, leave: Sequence[str]) -> list[str]:
    return [c for c in docs.columns if c not in leave]


def _asked(asked: list[str]) -> Column:
    """Of the terms of a document those that are asked for."""
    return F.filter("_all", lambda t: t.isin(asked))


def _counted(docs: DataFrame, terms: Column, positional: bool, asked: list[str] | None = None, leave: Sequence[str] = ()) -> DataFrame:
    """Documents with _length, _terms, _tfs and, if wanted, _at: counted where they are, nothing of a text moves."""
    kept, some = _kept(docs, leave), F.col("_all") if asked is None else _asked(asked)
    own = spread(docs).select("*", F.coalesce(terms, F.array().cast("array<string>")).alias("_all")).select(*kept, F.size("_all").alias("_length"), _counter(some).alias("_c"))
    return own.select(*kept, "_length", *(F.col(f"_c.{c}").alias(f"_{c}") for c in ("terms", "tfs", "at")[: 3 if positional else 2]))


def _segment(staged: DataFrame, path: str, key: str, number: int, buckets: int, keep: bool) -> Segment:
    """From counted documents: postings are dealt by shard and term, sorted, and cut into blocks. `keep`: the documents get a table of
    their own, sorted by key, so that the counted ones may go."""
    own = [c for c in staged.columns if c not in ("_terms", "_tfs", "_at")]
    if keep:
        staged.select(*own).repartitionByRange(key).sortWithinPartitions(key).write.option("compression", "zstd").parquet(f"{path}/documents")
    docs = staged.sparkSession.read.parquet(f"{path}/documents") if keep else staged.select(*own)
    shards = max(1, -(-docs.count() // SHARD))
    more = ["_at"] if "_at" in staged.columns else []
    rows = staged.select(F.col(key).alias("key"), F.col("_length").alias("length"), F.explode(F.arrays_zip("_terms", "_tfs", *more)).alias("p"))
    rows = rows.select(F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int").alias("shard"), F.col("p._terms").alias("term"), "key", F.col("p._tfs").alias("tf"), "length", *(F.col("p._at").alias("at") for _ in more))
    order = Window.partitionBy(*_BY).orderBy(F.col("tf").desc(), "length", "key")
    cut = rows.repartition(buckets, *_BY).withColumn("block", F.floor((F.row_number().over(order) - 1) / BLOCK).cast("int"))
    blocks = cut.groupBy(*_ORDER).agg(F.collect_list(F.struct("key", "tf", "length", *(["at"] if more else []))).alias("p"))
    columns = [F.size("p").alias("n"), F.array_max("p.tf").alias("max_tf"), F.array_min("p.length").alias("min_length"), F.col("p.key").alias("keys"), F.col("p.tf").alias("tfs"), F.col("p.length").alias("lengths")]
    postings = _table(blocks.select(*_ORDER, *columns, *(F.col("p.at").alias("positions") for _ in more)), f"{path}/postings", _BY, _ORDER, buckets)
    return Segment(number, docs, postings, shards)


def _buckets(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def index(docs: DataFrame, terms: Column, key: str = "doc_id", positional: bool = False, only: DataFrame | None = None, blocks: bool = False, leave: Sequence[str] = ()) -> Index:
    """An index in the shared folder, gone with the application or its `scratch` scope. `terms`: of each document, in order.
    `only` (term): for queries with these terms alone and no others, if they are at most KNOWN; statistics are those of all
    terms. Texts are then cut once and of each only what is asked for is kept: postings that are all scored, or with `blocks` such as
    all terms would have, for queries with so many documents that bounds pay. With `positional` they are phrases, as `as_phrase` gives
    them, which are counted in the texts. `leave`: columns that `terms` alone needs; they aren't stored."""
    spark = docs.sparkSession
    if only is not None:
        only = only.select(as_phrase(F.col("term")).alias("term")).where("term <> ''") if positional else only.select("term")
    names = [] if only is None else [r.term for r in only.distinct().limit(KNOWN + 1).collect()]  # bounded
    known = 0 < len(names) <= KNOWN
    if (known or positional and only is not None and not names) and not blocks:
        own, length = spread(docs).select("*", F.coalesce(terms, F.array().cast("array<string>")).alias("_all")), F.size("_all").alias("_length")
        if positional:
            # A text is whole where it is cut, so its phrases are found there; of places nothing is stored.
            phrases = _Phrases.of(names)
            held = materialise(own.select(*_kept(docs, leave), length, phrases.counter()(phrases.placed(F.col("_all"))).alias("_c")))
            counted = held
        else:
            held = materialise(own.select(*_kept(docs, leave), length, _asked(names).alias("_some")))
            counted = held.select(key, "_length", _counter("_some").alias("_c"))
        # Postings lie with their documents, so many to a bucket that what a task sums up stays the same size whatever there is.
        counted = counted.select(key, F.col("_length").alias("length"), F.explode(F.arrays_zip("_c.terms", "_c.tfs")).alias("p"))
        rows = counted.select(F.col("p.terms").alias("term"), key, "length", F.col("p.tfs").cast("long").alias("tf"))
        flat = bucketed(rows, key, max(-(-held.count() // DEALT), _buckets(spark)))
        return Index((Segment(0, held.drop("_some", "_c"), None, 0),), key, positional, flat=flat.groupBy("term", key, "length").agg(F.sum("tf").alias("tf")))
    staged = materialise(_counted(docs, terms, positional, names if known and not positional else None, leave))
    return Index((_segment(staged, place(spark), key, 0, _buckets(spark), False),), key, positional)


def _manifest(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path}/index.json", wholetext=True).first().value)


def _known(s: Segment, buckets: int) -> dict:
    return {"number": s.number, "shards": s.shards, "buckets": buckets, "postings": s.postings._jdf.schema().toDDL()}


def build_index(docs: DataFrame, terms: Column, path: str, key: str = "doc_id", overwrite: bool = False, limit: int | None = None, positional: bool = False) -> None:
    """An index to keep, below `path`, of one segment. `limit`: the first documents by key alone."""
    spark, buckets = docs.sparkSession, _buckets(docs.sparkSession)
    if files.exists(spark, f"{path}/index.json"):
        if not overwrite:
            raise ValueError(f"there is an index at {path}")
        files.remove(spark, path)
    kept = docs if limit is None else docs.orderBy(key).limit(limit)
    with scratch(spark):
        s = _segment(materialise(_counted(kept, terms, positional)), f"{path}/segment-0", key, 0, buckets, True)
    files.write_json(spark, f"{path}/index.json", {"key": key, "positional": positional, "next": 1, "segments": [_known(s, buckets)], "deletions": []}, overwrite)


def open_index(spark: SparkSession, path: str, key: str | None = None) -> Index:
    """The index as it is now; later changes need another opening. `key`: what it must be."""
    m = _manifest(spark, path)
    if key not in (None, m["key"]):
        raise ValueError(f"the index is one of {m['key']}")
    at = lambda s, what: f"{path}/segment-{s['number']}/{what}"
    found = tuple(
        Segment(s["number"], spark.read.parquet(at(s, "documents")), _reopen(spark, at(s, "postings"), s["postings"], _BY, _ORDER, s["buckets"]), s["shards"])
        for s in m["segments"]
    )
    gone = [spark.read.parquet(f"{path}/deletions-{d}") for d in m["deletions"]]
    return Index(found, m["key"], m["positional"], reduce(DataFrame.union, gone) if gone else None)


def append(docs: DataFrame, terms: Column, path: str) -> None:
    """A segment of its own for new documents; nothing that is there is read but the keys. A known key is an error: delete it first."""
    spark, buckets = docs.sparkSession, _buckets(docs.sparkSession)
    m, held = _manifest(spark, path), open_index(spark, path)
    key = m["key"]
    if held.docs.select(key).join(docs.select(key), key, "left_semi").limit(1).count():
        raise ValueError("some documents are in the index already")
    with scratch(spark):
        s = _segment(materialise(_counted(docs, terms, m["positional"])), f"{path}/segment-{m['next']}", key, m["next"], buckets, True)
    files.write_json(spark, f"{path}/index.json", m | {"next": m["next"] + 1, "segments": [*m["segments"], _known(s, buckets)]}, True)


def delete(ids: DataFrame, path: str) -> None:
    """Mark the documents that `ids` (key) names as deleted; unknown ids do nothing. They may be appended again."""
    spark = ids.sparkSession
    m = _manifest(spark, path)
    ids.select(m["key"]).distinct().withColumn("before", F.lit(m["next"])).write.parquet(f"{path}/deletions-{m['next']}")
    files.write_json(spark, f"{path}/index.json", m | {"next": m["next"] + 1, "deletions": [*m["deletions"], m["next"]]}, True)


def optimize(spark: SparkSession, path: str) -> None:
    """One segment out of all, without deleted documents. Postings are dealt anew, the texts aren't needed. The new segment is
    whole before the index refers to it; then the old ones go."""
    m, held, buckets = _manifest(spark, path), open_index(spark, path), _buckets(spark)
    key, columns = held.key, ("tfs", "positions")[: 1 + held.positional]

    def postings(s):
        p = s.postings.select("term", F.explode(F.arrays_zip("keys", *columns)).alias("p"))
        return held.live(s, p.select("term", F.col("p.keys").alias(key), *(F.col(f"p.{c}").alias(c) for c in columns)))

    each = held._all(postings).groupBy(key).agg(F.collect_list(F.struct("term", *columns)).alias("_p"))
    docs = held._all(held.live).join(each, key, "left")
    named = {"_terms": "_p.term", "_tfs": "_p.tfs", "_at": "_p.positions"}
    with scratch(spark):
        staged = materialise(docs.withColumns({n: F.col(c) for n, c in list(named.items())[: 2 + held.positional]}).drop("_p"))
        s = _segment(staged, f"{path}/segment-{m['next']}", key, m["next"], buckets, True)
    files.write_json(spark, f"{path}/index.json", m | {"next": m["next"] + 1, "segments": [_known(s, buckets)], "deletions": []}, True)
    for old in m["segments"]:
        files.remove(spark, f"{path}/segment-{old['number']}")
    for old in m["deletions"]:
        files.remove(spark, f"{path}/deletions-{old}")
