"""BM25 in two flavours, top-k through bounds of blocks, strict-then-loose search with boosts, phrases, nearest vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestar.functions import text as T
from lodestar.operators.fulltext import BLOCK, Index, append, as_phrase, build_index, delete, index, open_index, optimize  # noqa: F401
from lodestar.operators.nearest import nearest
from lodestar.sources.shared import materialise, spread


def document_frequency(docs: DataFrame, terms: Column) -> DataFrame:
    """(term, df): each document gives each of its terms once, so one aggregate suffices."""
    return spread(docs).select(F.explode(F.array_distinct(terms)).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def fetch(docs: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """The documents that `ids` (key) names, each once; unknown ids give nothing."""
    return docs.join(ids.select(key).distinct(), key, "left_semi")


def nothing(spark: SparkSession, key: str = "doc_id") -> DataFrame:
    """The results of a backend that has no documents."""
    return spark.createDataFrame([], f"query_id long, {key} string, score double, lexical_score double, rank int")


def _asked(queries: DataFrame) -> DataFrame:
    return queries.select("query_id", F.explode("terms").alias("term")).groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("times"))


def _formula(flavour: str, n: Column, avg_length: Column, k1: float, b: float):
    """idf of a document frequency, gain of a tf in a document of some length."""
    odds = lambda df: (n - df + 0.5) / (df + 0.5)
    idf = (lambda df: F.log(1 + odds(df))) if flavour == "plus_one" else (lambda df: F.greatest(F.log(odds(df)), F.lit(1e-6)))
    k1 = k1 if flavour == "plus_one" else 1.2
    return idf, lambda tf, length: tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / avg_length))


def bm25(queries: DataFrame, held: Index, k1: float = 1.5, b: float = 0.75, flavour: str = "plus_one") -> DataFrame:
    """(query_id, key, score, matched) for each document that shares a term. `queries` has query_id and terms (array).

    plus_one: idf = ln(1 + (N - df + .5) / (df + .5)), repeated query terms count each time; index: the form of
    full-text engines, ln((N - df + .5) / (df + .5)), at least 1e-6, with k1 = 1.2. All postings of the queries' terms are
    scored; `best` finds the highest scores from a part of them.
    """
    key, asked = held.key, _asked(queries)
    names = asked.select("term").distinct()
    df = held.postings.join(names, "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf, gain = _formula(flavour, F.col("n"), F.col("avg_length"), k1, b)
    # The weights of all queries are few beside the postings: while they are small they are sent to them, so that no term is a hot key.
    weights = asked.join(df, "term").crossJoin(F.broadcast(held.stats()))  # one row
    weights = materialise(weights.select("query_id", "term", "avg_length", (F.col("times") * idf(F.col("df"))).alias("weight")))
    parts = held.postings.join(weights, "term").select("query_id", key, (F.col("weight") * gain(F.col("tf"), F.col("length"))).alias("part"))
    return parts.groupBy("query_id", key).agg(F.sum("part").alias("score"), F.count(F.lit(1)).alias("matched"))


def phrase_postings(phrases: DataFrame, held: Index) -> DataFrame:
    """(term, seg, key, tf, length): how often the phrases (term, parts) stand in documents of a positional index, part by part side
    by side. The documents of a phrase's rarest part come first; of its other parts only the postings of those documents go
    on, each with its positions shifted by the part's place, and what all parts share are the phrase's places."""
    key = held.key
    asked = phrases.select(F.col("term").alias("phrase"), F.size("parts").alias("parts"), F.posexplode("parts").alias("j", "term"))
    sizes = asked.select("term").distinct().join(held._all(lambda s: s.postings.select("term", "n")), "term").groupBy("term").agg(F.sum("n").alias("df"))
    rare = Window.partitionBy("phrase").orderBy("df", "j")
    ordered = asked.join(sizes, "term").withColumn("nth", F.row_number().over(rare))

    def read(s, want):
        p = F.explode(F.arrays_zip("keys", "lengths", "positions")).alias("p")
        rows = s.postings.select("shard", "term", p).join(_each_shard(want, s), ["shard", "term"])
        shifted = F.transform("p.positions", lambda x: x - F.col("j")).alias("at")
        return held.live(s, rows.select("phrase", "parts", F.lit(s.number).alias("seg"), F.col("p.keys").alias(key), F.col("p.lengths").alias("length"), shifted))

    first = materialise(held._all(lambda s: read(s, ordered.where("nth = 1"))))
    others = held._all(lambda s: read(s, ordered.where("nth > 1"))).join(first.select("phrase", key), ["phrase", key], "left_semi")
    both = first.unionByName(others).groupBy("phrase", "seg", key, "parts").agg(F.first("length").alias("length"), F.collect_list("at").alias("ats")).where(F.size("ats") == F.col("parts"))
    places = F.aggregate(F.slice("ats", 2, F.col("parts")), F.col("ats")[0], lambda held, x: F.array_intersect(held, x))
    return both.select(F.col("phrase").alias("term"), "seg", key, F.size(places).alias("tf"), "length").where("tf > 0")


def _each_shard(rows: DataFrame, s) -> DataFrame:
    """Rows of terms for each shard of a segment, to meet postings in their buckets."""
    return rows.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(s.shards - 1))))


def best(queries: DataFrame, held: Index, k: int, all_k: int = 0, k1: float = 1.5, b: float = 0.75, flavour: str = "plus_one", digits: int = 9, extra: DataFrame | None = None) -> DataFrame:
    """(query_id, key, score, matched, n_terms) of documents among which are each query's k best, ties at the last place included: as
    `bm25` gives them, rounded to `digits`. With `all_k`, its all_k best of those that have all terms are among them, and the k best of
    all only where there are fewer of these. `extra`: postings
    (term, seg, key, tf, length) of terms that the index has no blocks of, as of `phrase_postings`.

    1. Each term's first blocks, its most promising postings, name some documents, which are scored in full. The k-th score is one to beat.
    2. A block's bound and the highest bounds of the query's other terms say what its documents can reach at most. Only blocks
       that can reach the score to beat are opened. Terms whose highest bounds together stay under it open none: a document
       that has no other terms can't get there. For documents with all terms the rarest term's blocks suffice.

    An index of known terms alone has no blocks; all its postings are scored.
    Blocks that aren't opened name no documents; those named are scored once for a query, from the postings of the queries'
    terms alone. Postings are never shuffled to find documents: they meet the terms in the buckets in which they lie.
    """
    key, slack = held.key, 10.0**-digits
    if held.flat is not None:
        sizes = queries.select("query_id", F.size(F.array_distinct("terms")).cast("long").alias("n_terms"))
        full = bm25(queries, held, k1, b, flavour).join(sizes, "query_id")
        return full.select("query_id", key, F.round("score", digits).alias("score"), "matched", "n_terms")
    idf, gain = _formula(flavour, F.col("n"), F.col("avg_length"), k1, b)
    asked = _asked(queries)
    names = asked.select("term").distinct()
    stats = F.broadcast(held.stats())  # one row
    size = held._all(lambda s: s.postings.select("shard", "term", F.col("n").alias("df"), "max_tf", "min_length").join(_each_shard(names, s), ["shard", "term"]).drop("shard"))
    if extra is not None:
        size = size.union(extra.select("term", F.lit(1), "tf", "length"))
    df = size.crossJoin(stats).groupBy("term", "n", "avg_length").agg(F.sum("df").alias("df"), F.max(gain(F.col("max_tf"), F.col("min_length"))).alias("most"))
    if (gone := held.removed(names)) is not None:
        df = df.join(gone, "term", "left").withColumn("df", F.col("df") - F.coalesce("gone", F.lit(0))).where("df > 0").drop("gone")
    of_query, rising = Window.partitionBy("query_id"), Window.partitionBy("query_id").orderBy("most", "term")
    terms = asked.withColumn("n_terms", F.count(F.lit(1)).over(of_query)).join(df, "term").withColumn("weight", F.col("times") * idf(F.col("df"))).withColumn("most", F.col("weight") * F.col("most"))
    rarest = (F.row_number().over(Window.partitionBy("query_id").orderBy("df", "term")) == 1) & (F.count(F.lit(1)).over(of_query) == F.col("n_terms"))
    terms = materialise(terms.select("query_id", "term", "n_terms", "weight", "avg_length", (F.sum("most").over(of_query) - F.col("most")).alias("rest"), F.sum("most").over(rising).alias("below"), rarest.alias("rarest")))

    def named(want: DataFrame) -> DataFrame:
        """(query_id, key) of the documents of blocks that reach `least`, up to block `last`, of (query_id, term, weight, avg_length, rest, ...)."""
        reach = lambda most: F.col("weight") * most + F.col("rest") >= F.col("least")

        def one(s):
            blocks = s.postings.select("shard", "term", "block", "max_tf", "min_length", "keys").join(_each_shard(want, s), ["shard", "term"])
            some = blocks.where(reach(gain(F.col("max_tf"), F.col("min_length"))) & (F.col("block") <= F.col("last")))
            return some.select("query_id", F.explode("keys").alias(key))

        found = held._all(one)
        if extra is not None:
            found = found.union(extra.join(want, "term").where(reach(gain(F.col("tf"), F.col("length")))).select("query_id", key))
        return found.distinct()

    def scored(found: DataFrame) -> DataFrame:
        def one(s):
            p = s.postings.select("shard", "term", "keys", "tfs", "lengths").join(_each_shard(names, s), ["shard", "term"]).select("term", F.explode(F.arrays_zip("keys", "tfs", "lengths")).alias("p"))
            return held.live(s, p.select("term", F.col("p.keys").alias(key), F.col("p.tfs").alias("tf"), F.col("p.lengths").alias("length")))

        rows = held._all(one)
        rows = rows if extra is None else rows.union(extra.select("term", key, "tf", "length"))
        # Postings meet the documents that are named, once for all queries; only then do they count for each query that has their term.
        parts = rows.join(found, key).join(terms, ["query_id", "term"]).select("query_id", key, "n_terms", (F.col("weight") * gain(F.col("tf"), F.col("length"))).alias("part"))
        return parts.groupBy("query_id", key).agg(F.round(F.sum("part"), digits).alias("score"), F.count(F.lit(1)).alias("matched"), F.first("n_terms").alias("n_terms"))

    first = -(-2 * max(k, all_k) // BLOCK) - 1
    one = materialise(scored(materialise(named(terms.withColumns({"least": F.lit(0.0), "last": F.lit(first)})))))
    falling = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc()))
    beat = lambda rows, k, name: rows.withColumn("at", falling).where(F.col("at") == k).select("query_id", (F.col("score") - slack).alias(name))
    far = F.lit(float("inf"))
    limits = terms.join(beat(one, k, "some"), "query_id", "left").withColumn("some", F.coalesce("some", F.lit(0.0)))
    least = F.when(F.col("below") >= F.col("some"), F.col("some")).otherwise(far)
    if all_k:
        whole = one.where("matched = n_terms")
        enough = whole.groupBy("query_id").agg(F.count(F.lit(1)).alias("whole"))
        limits = limits.join(beat(whole, all_k, "every"), "query_id", "left").join(enough, "query_id", "left")
        least = F.least(F.when(F.coalesce("whole", F.lit(0)) < all_k, least).otherwise(far), F.when(F.col("rarest"), F.coalesce("every", F.lit(0.0))).otherwise(far))
    # Stored, so that their size is known: while they are few they are sent to the blocks, which are not sorted for them.
    limits = materialise(limits.withColumns({"least": least, "last": F.lit(2**31 - 1)}).where(F.col("least") < far))
    two = named(limits).join(one.select("query_id", key), ["query_id", key], "left_anti")
    return one.union(scored(materialise(two)))


def top_k(scored: DataFrame, k: int, key: str = "doc_id", score: str = "score") -> DataFrame:
    """Best k of each query by (score descending, key), with ranks from 1."""
    order = Window.partitionBy("query_id").orderBy(F.col(score).desc(), F.col(key))
    return scored.select("*", F.row_number().over(order).alias("rank")).where(F.col("rank") <= k)


def _among(codes: Column, kind: str, one: Column) -> Column:
    """Whether a code is the asked one, or among them."""
    return F.coalesce(F.array_contains(codes, one) if kind.startswith("array") else codes == one, F.lit(False))


def parted(queries: DataFrame) -> DataFrame:
    """Queries (query_id, terms, ...) with each term as full-text engines take it: cut at all but letters and digits; one of several parts is
    a phrase, its parts joined by blanks, one without parts is none."""
    each = queries.select("query_id", F.posexplode("terms").alias("at", "term")).select("query_id", "at", as_phrase(F.col("term")).alias("term")).where("term <> ''")
    terms = each.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("at", "term")))["term"].alias("terms"))
    return queries.drop("terms").join(terms, "query_id").select(*queries.columns)


def search(queries: DataFrame, held: Index, limit: int, location_boost: float = 0.35, duty_boost: float = 0.5) -> DataFrame:
    """query_id, key, score, lexical_score, rank: documents with all terms of the query; where they are fewer than `limit`,
    those with any follow. `queries`: query_id, terms, location and duty (a code or a list of codes); the index's documents
    have location and duty too. The pool before boosts holds max(5 limit, 100) of each kind. Scores are rounded, so ranks
    don't hang on the order in which parts were summed. On a positional index terms of several parts are phrases, see `parted`."""
    key, kinds, extra = held.key, dict(queries.dtypes), None
    if held.positional:
        queries = materialise(parted(queries))
    if held.positional and held.flat is None:
        phrases = queries.select(F.explode("terms").alias("term")).where("contains(term, ' ')").distinct()
        extra = materialise(phrase_postings(phrases.withColumn("parts", F.split("term", " ")), held))
    size = max(5 * limit, 100)
    # Others count only where fewer than `limit` documents have all terms: the best of all then hold as many others as are wanted.
    scored = best(queries, held, size + limit, size, flavour="index", extra=extra).join(queries.select("query_id", "location", "duty"), "query_id")
    strict = F.col("matched") == F.col("n_terms")
    pool = Window.partitionBy("query_id", "strict").orderBy(F.col("score").desc(), F.col(key))
    pooled = scored.withColumn("strict", strict).withColumn("at", F.row_number().over(pool)).where(F.col("at") <= size)
    enough = F.sum(F.col("strict").cast("int")).over(Window.partitionBy("query_id"))
    kept = pooled.withColumn("all_match", enough).where(F.col("strict") | (F.col("all_match") < limit))
    near, own = _among(F.col("location"), kinds["location"], F.col("_l")), _among(F.col("duty"), kinds["duty"], F.col("_d"))
    boosted = kept.join(held.docs.select(key, F.col("location").alias("_l"), F.col("duty").alias("_d")), key).select(
        "query_id", key, F.round(F.col("score") + F.when(near, location_boost).otherwise(0.0) + F.when(own, duty_boost).otherwise(0.0), 6).alias("score"), F.col("score").alias("lexical_score")
    )
    return top_k(boosted, limit, key)


def _times(terms: Column, t: Column) -> Column:
    return F.size(F.filter(terms, lambda x: x == t)).cast("double")


def term_cosine(q: Column, d: Column) -> Column:
    """Cosine of the term counts of two arrays; 0 if one is empty."""
    shared = F.aggregate(F.array_intersect(q, d), F.lit(0.0), lambda s, t: s + _times(q, t) * _times(d, t))
    # Equal terms are neighbours once sorted: a run from i to k counts (k - i) squared, in one pass.
    state = "struct<total:double,run:double,last:string>"
    def norm(c):
        start = F.struct(F.lit(0.0).alias("total"), F.lit(0.0).alias("run"), F.lit(None).cast("string").alias("last")).cast(state)
        step = lambda s, t: F.when(s["last"] == t, F.struct((s["total"] + 2 * s["run"] + 1).alias("total"), (s["run"] + 1).alias("run"), t.alias("last"))).otherwise(F.struct((s["total"] + 1).alias("total"), F.lit(1.0).alias("run"), t.alias("last")))
        return F.sqrt(F.aggregate(F.array_sort(c), start, step, lambda s: s["total"]))
    return F.when((F.size(q) > 0) & (F.size(d) > 0), shared / (norm(q) * norm(d))).otherwise(0.0)


def dense_cosine(pairs: DataFrame) -> DataFrame:
    """Cosine of the term counts of `query_terms` and `doc_terms` of each pair (query_id, doc_id)."""
    return pairs.select("query_id", "doc_id", term_cosine(F.col("query_terms"), F.col("doc_terms")).alias("dense"))


def bm25_pairs(pairs: DataFrame, queries: DataFrame, corpus: DataFrame, k1: float = 1.5, b: float = 0.75) -> DataFrame:
    """`pairs` (query_id, query_terms, doc_terms, ...) with bm25, in the form plus_one. Statistics are those of `corpus`
    (doc_terms of all documents). Only the terms that queries (query_id, query_terms) use are counted, and the
    documents of other pairs are never scored."""
    stats = corpus.agg(F.count(F.lit(1)).alias("_n"), F.greatest(F.avg(F.size("doc_terms")), F.lit(1.0)).alias("_avg"))
    asked = queries.select("query_id", F.explode("query_terms").alias("term")).groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("times"))
    had = corpus.select(F.explode(F.array_distinct("doc_terms")).alias("term")).join(asked.select("term").distinct(), "term", "left_semi")
    df = had.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    known = asked.join(df, "term").groupBy("query_id").agg(F.collect_list(F.struct("term", "times", "df")).alias("_known"))
    idf = lambda df: F.log(1 + (F.col("_n") - df + 0.5) / (df + 0.5))
    size = F.size("doc_terms") / F.col("_avg")
    gain = lambda tf: tf * (k1 + 1) / (tf + k1 * (1 - b + b * size))
    total = F.aggregate("_known", F.lit(0.0), lambda s, x: s + x["times"] * idf(x["df"]) * gain(_times(F.col("doc_terms"), x["term"])))
    joined = pairs.join(known, "query_id", "left").crossJoin(F.broadcast(stats))  # one row
    return joined.select(*pairs.columns, F.coalesce(total, F.lit(0.0)).alias("bm25"))


def vector_top_k(queries: DataFrame, table: DataFrame, k: int, block_bytes: int = 4 << 20) -> DataFrame:
    """Best k by cosine of each query vector (query_id, query_vec) among `table` (vec_id, embedding), its own row apart; see
    `nearest`. Scores are rounded to 9 digits; ties go to the smaller vec_id. Null and zero vectors score 0; vectors of the
    table that are of another length than the query's too."""
    asked = queries.select(F.col("query_id").cast("long").alias("query"), F.col("query_vec").alias("v"))
    held = table.select(F.col("vec_id").cast("long").alias("name"), F.col("embedding").alias("v"))
    return nearest(asked, held, k, 9, True, block_bytes).select(F.col("query").alias("query_id"), F.col("name").alias("vec_id"), "score", "rank")
