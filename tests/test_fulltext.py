"""The segmented index: bounds against full scoring, phrases, appends, deletions and merges."""

import random
from collections import Counter

import pyarrow as pa
import pytest
from lodestar.functions import text as T
from lodestar.operators import fulltext
from lodestar.operators import search as S
from pyspark.sql import functions as F

WORDS = [f"w{i}" for i in range(30)]
SCHEMA = "doc_id int, text string, location string, duty string"


def texts(seed, n, first=0):
    """Frequent and rare words, many documents with equal scores, some empty."""
    rng = random.Random(seed)
    return [(first + i, " ".join(rng.choices(WORDS, [1 / (j + 1) for j in range(30)], k=rng.choice((0, 3, 3, 8, 20)))), rng.choice("xy"), "z") for i in range(n)]


QUERIES = [(0, ["w0", "w1"]), (1, ["w0", "w5", "w29"]), (2, ["w29", "w28", "w0", "w0"]), (3, ["nothing", "w3"]), (4, ["w2"]), (5, []), (6, WORDS[:6]), (7, ["nothing"])]


def queries(spark):
    return spark.createDataFrame([(q, t, "x", "z") for q, t in QUERIES], "query_id int, terms array<string>, location string, duty string")


def words(c="text"):
    return F.filter(F.split(c, " "), lambda w: w != "")


def rows(df):
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("block,shard", [(4, 50), (128, 1 << 20)])
@pytest.mark.parametrize("flavour", ["plus_one", "index"])
def test_best_are_those_of_full_scores(spark, monkeypatch, block, shard, flavour):
    monkeypatch.setattr(fulltext, "BLOCK", block)
    monkeypatch.setattr(S, "BLOCK", block)
    monkeypatch.setattr(fulltext, "SHARD", shard)
    docs = spark.createDataFrame(texts(1, 400), SCHEMA)
    held = S.index(docs, words())
    assert held.segments[0].shards == (8 if shard == 50 else 1) and held.stats().first().n == 400
    full = S.bm25(queries(spark), held, flavour=flavour).withColumn("score", F.round("score", 9))
    for k in (1, 5, 60):
        some = S.best(queries(spark), held, k, flavour=flavour)
        want, got = S.top_k(full, k), S.top_k(some.select(*full.columns), k)
        assert rows(got) == rows(want)
    n_terms = {q: len(set(t)) for q, t in QUERIES}
    every = [r for r in full.collect() if r.matched == n_terms[r.query_id]]
    best = S.best(queries(spark), held, 3, 7, flavour=flavour).where("matched = n_terms")
    want = {(q, *x) for q in n_terms for x in sorted((-r.score, r.doc_id) for r in every if r.query_id == q)[:7]}
    assert {(r.query_id, -r.score, r.doc_id) for r in S.top_k(best, 7).collect()} == want


def test_bounds_leave_most_postings_alone(spark):
    """Of the postings of 200 queries on 10,000 documents less than a third is scored for the best ten."""
    from lodestar.plans import fixtures as fx

    q, docs = fx.corpus_queries(spark, "/root/testdata/sf0.1"), fx.table(spark, "/root/testdata/sf0.1", "documents").select("doc_id", "text")
    held = S.index(docs, T.latin_tokens(F.col("text")))
    read, every = (df.agg(F.sum("matched")).first()[0] for df in (S.best(q, held, 10), S.bm25(q, held)))
    assert read < every / 3, (read, every)


def test_known_terms_only(spark):
    docs = spark.createDataFrame(texts(2, 200), SCHEMA)
    whole, some = S.index(docs, words()), S.index(docs, words(), only=queries(spark).select(F.explode("terms").alias("term")))
    assert rows(whole.stats()) == rows(some.stats()) and some.postings.select("term").distinct().count() < 30
    assert rows(S.search(queries(spark), whole, 5)) == rows(S.search(queries(spark), some, 5))


def test_postings_stay_where_they_are(spark):
    held = S.index(spark.createDataFrame(texts(3, 50), SCHEMA), words())
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        s = held.segments[0]
        asked = S._each_shard(spark.createDataFrame([(w,) for w in WORDS], "term string"), s)
        joined = s.postings.join(asked, ["shard", "term"])
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and plan.count("Exchange") == 1 and "Bucketed: true" in plan and joined.count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("positional", [False, True])
def test_segments(spark, tmp_path, positional):
    path, terms = f"{tmp_path}/index", T.fts_parts(F.col("text"))
    one, two, three = texts(4, 60), texts(5, 40, 60), texts(6, 30, 100)
    frame = lambda data: spark.createDataFrame(data, SCHEMA)
    q = queries(spark) if not positional else queries(spark).withColumn("terms", F.concat("terms", F.array(F.lit("w0.w1"), F.lit("w2#"))))

    def same(data):
        held, fresh = S.open_index(spark, path), S.index(frame(data), terms, positional=positional)
        assert rows(held.docs.select("doc_id", "text")) == Counter((d[0], d[1]) for d in data) and rows(held.stats()) == rows(fresh.stats())
        assert rows(held.postings) == rows(fresh.postings.select(*held.postings.columns))
        assert rows(S.search(q, held, 6)) == rows(S.search(q, fresh, 6))
        return len(held.segments)

    S.build_index(frame(one), terms, path, positional=positional)
    with pytest.raises(ValueError):
        S.build_index(frame(one), terms, path, positional=positional)
    S.append(frame(two), terms, path)
    with pytest.raises(ValueError):
        S.append(frame(two[:1]), terms, path)
    S.delete(frame(one[::3] + two[5:9]).select("doc_id").union(spark.createDataFrame([(999,)], "doc_id int")), path)
    S.append(frame(three + one[:1]), terms, path)  # a deleted key may come back
    left = [d for i, d in enumerate(one) if i % 3] + two[:5] + two[9:] + three + one[:1]
    assert same(left) == 3
    S.optimize(spark, path)
    assert same(left) == 1


def test_an_index_is_replaced_only_if_asked(spark, tmp_path):
    path, docs = f"{tmp_path}/index", spark.createDataFrame(texts(4, 10), SCHEMA)
    S.build_index(docs, words(), path)
    S.build_index(docs.limit(4), words(), path, overwrite=True)
    assert S.open_index(spark, path, "doc_id").docs.count() == 4
    with pytest.raises(ValueError):
        S.open_index(spark, path, "job_id")


def test_phrases_by_positions(spark):
    data = [(1, "Node.js and C++ code"), (2, "node js js node"), (3, "js node c"), (4, "a a a b a a"), (5, None), (6, "Café.Node"), (7, "x node.js node.js")]
    held = S.index(spark.createDataFrame([(i, t, "", "") for i, t in data], SCHEMA), T.fts_parts(F.col("text")), positional=True)
    asked = spark.createDataFrame([("node js", ["node", "js"]), ("a a", ["a", "a"]), ("a b a", ["a", "b", "a"]), ("c", ["c"]), ("no way", ["no", "way"])], "term string, parts array<string>")
    got = {(r.term, r.doc_id): (r.tf, r.length) for r in S.phrase_postings(asked, held).collect()}
    assert got == {("node js", 1): (1, 5), ("node js", 2): (1, 4), ("node js", 7): (2, 5), ("a a", 4): (3, 6), ("a b a", 4): (1, 6), ("c", 1): (1, 5), ("c", 3): (1, 3)}
    q = spark.createDataFrame([(0, ["node.js"]), (1, ["c++"]), (2, ["cafe.node", "++"]), (3, ["#"])], "query_id int, terms array<string>").withColumns({"location": F.lit("q"), "duty": F.lit("q")})
    found = S.search(q, held, 5).collect()
    assert {(r.query_id, r.doc_id) for r in found} == {(0, 1), (0, 2), (0, 7), (1, 1), (1, 3), (2, 6)}


def test_known_phrases_are_counted_in_their_texts(spark, sf, monkeypatch):
    """phrase_search: of asked phrases alone there are postings, equal to those of the whole positional index; words aren't dealt out."""
    from lodestar.plans import catalog

    data = [(1, "Node.js and C++ code"), (2, "node js js node"), (3, "js node c"), (4, "a a a b a a"), (5, None), (6, "Café.Node"), (7, "x node.js node.js"), (8, ""), (9, "a b"), (10, "a")]
    docs = spark.createDataFrame([(i, t, "q", "") for i, t in data], SCHEMA).repartition(1)
    asked = [["node.js"], ["c++", "a#a", "a"], ["a.b.a"], ["cafe.node", "++"], ["#"], ["no.way", "js.node"], ["node.js.js", "a.a.a"]]
    q = spark.createDataFrame(list(enumerate(asked)), "query_id int, terms array<string>").withColumns({"location": F.lit("q"), "duty": F.lit("q")})
    terms, only = T.fts_parts(F.coalesce("text", F.lit(""))), q.select(F.explode("terms").alias("term"))
    whole = S.index(docs, terms, positional=True)
    want = rows(S.search(q, whole, 5))
    parts = only.select(S.as_phrase(F.col("term")).alias("term")).where("term <> ''").distinct().withColumn("parts", F.split("term", " "))
    postings = rows(S.phrase_postings(parts, whole).select("term", "doc_id", "length", F.col("tf").cast("long").alias("tf")))

    def segment(*_):
        raise AssertionError("an index of all words")

    monkeypatch.setattr(fulltext, "_segment", segment)
    monkeypatch.setattr(fulltext, "COUNTED", 5)
    held = S.index(docs, terms, positional=True, only=only, leave=("text",))
    assert rows(held.postings) == postings and postings[("a a", 4, 6, 3)] == 1 and held.docs.columns == ["doc_id", "location", "duty"]
    assert rows(S.search(q, held, 5)) == want
    none = S.index(docs, terms, positional=True, only=only.limit(0))
    assert none.postings.count() == 0 and S.search(q, none, 5).count() == 0 and S.index(docs.limit(0), terms, positional=True, only=only).docs.count() == 0
    assert catalog.queries()["phrase_search"](spark, sf).count() > 0


def test_empty_indexes(spark):
    none = spark.createDataFrame([], SCHEMA)
    for positional in (False, True):
        held = S.index(none, words(), positional=positional)
        assert S.search(queries(spark), held, 5).count() == 0 and rows(held.stats()) == Counter([(0, 1.0)])
    held = S.index(spark.createDataFrame(texts(7, 20), SCHEMA), words())
    assert S.search(queries(spark).limit(0), held, 5).count() == 0


def test_terms_are_counted_some_at_a_time(monkeypatch):
    rng = random.Random(7)
    lists = pa.array([[], None, *([rng.choice("abcdef") for _ in range(rng.randrange(12))] for _ in range(60)), list("ab" * 40)], pa.list_(pa.string()))
    counted = lambda x: [sorted(zip(c["terms"], c["tfs"], c["at"])) for c in fulltext._counter.func(x).to_pylist()]
    want, sizes, one = counted(lists), [], fulltext._count
    monkeypatch.setattr(fulltext, "COUNTED", 20)
    monkeypatch.setattr(fulltext, "_count", lambda x: sizes.append(len(x.flatten())) or one(x))
    assert counted(lists) == want and counted(lists[:0]) == []
    assert len(sizes) > 10 and max(sizes) == 80 and sorted(sizes)[-2] <= 20
