"""Work that grows is dealt out by its size, and what is small is sent to what is large."""

import random

from lodestar.functions import text as T
from lodestar.operators import extraction as X
from lodestar.operators import graph as G
from lodestar.operators import hybrid, ltr, statistics
from lodestar.operators import search as S
from lodestar.plans import catalog
from lodestar.plans import fixtures as fx
from lodestar.sources.shared import materialise
from pyspark.sql import functions as F


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_few_pairs_are_sent_to_the_jobs(spark):
    """hybrid_rerank: no text is shuffled to its pairs."""
    draw = random.Random(1)
    day = "2024-01-01 00:00:00"
    jobs = [(i, "job", " ".join(f"w{draw.randrange(10**6)}" for _ in range(40)), "", day, "1", "a", 1.0, 2.0) for i in range(2000)]
    jobs = materialise(spark.createDataFrame(jobs, "job_id long, title string, requirements string, description string, posted_at string, location_code string, occupation_code string, salary_min double, salary_max double"))
    queries = materialise(spark.createDataFrame([(q, f"job w{q}", day, "1", "a") for q in range(20)], "query_id long, query string, query_time string, location_code string, occupation_code string"))
    pairs = materialise(spark.createDataFrame([(q, q * 7, 0, 1) for q in range(20)], "query_id long, job_id long, relevance int, original_rank int"))
    lexical = materialise(pairs.select("query_id", "job_id", F.lit(1.0).alias("score")))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "60k")
    try:
        p = plan(hybrid.pair_features(pairs, queries, jobs, None, lexical))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin [job_id" in p and "Exchange hashpartitioning(job_id" not in p.split("Location")[0]


def test_ablation_makes_no_index(spark, sf, monkeypatch):
    def index(*_, **__):
        raise AssertionError("an index that nothing is asked of")

    monkeypatch.setattr(catalog.S, "index", index)
    assert catalog.queries()["ablation"](spark, sf).count() == 4


def test_ablation_learns_from_all_reached_jobs(spark, sf, monkeypatch):
    """ablation: rankers have all their trees, and of a query all jobs that its anchors reach are labelled, so there is something to learn."""
    asked = []

    def fit(train, features, trees=80):
        asked.append((trees, {r.relevance for r in train.select("relevance").distinct().collect()}, train.groupBy("query_id").count().agg(F.max("count")).first()[0]))
        return ltr.Ranker(features)

    monkeypatch.setattr(ltr, "fit", fit)
    assert catalog.queries()["ablation"](spark, sf).count() == 4
    assert [(t, g) for t, g, _ in asked] == [(80, {0, 1, 2})] * 2 and min(n for *_, n in asked) > 30


def test_edges_come_to_their_jobs_once(spark, sf):
    """retrieve_two_hop: no edge is shuffled by its skill, nor for each query; pairs that lead nowhere aren't made."""
    rows = fx.baskets(spark, sf).select("job_id", "skill")
    near = spark.createDataFrame([("Brand#11",), ("Brand#23",)], "skill string")
    every, some = (sorted(map(tuple, statistics.cooccurrence(rows, 2, -1.0, among).collect())) for among in (None, near))
    assert some == [r for r in every if {"Brand#11", "Brand#23"} & {r[0], r[1]}] and 0 < len(some) < len(every)
    e, anchors = catalog._anchored(spark, sf, 2)
    p = plan(G.best_jobs(e, anchors, 50, 2))
    assert "Exchange hashpartitioning(job#" in p and "Exchange hashpartitioning(skill" not in p and "Exchange hashpartitioning(query_id#" not in p.split("WindowGroupLimit")[-1]


def test_mentions_are_canonicalised_where_they_are(spark):
    rows = spark.createDataFrame([(j, p, raw) for j in range(20) for p, raw in enumerate(("Java", "JAVA", "Node", "js"))], "job_id int, pos int, raw string")
    out = X.canonicalise(rows, spark.createDataFrame([("js", "Node")], "alias string, target string"))
    assert "hashpartitioning(job_id" not in plan(out) and "hashpartitioning(raw" not in plan(out) and out.count() == 80


def test_fields_are_dealt_by_jobs(spark, monkeypatch):
    monkeypatch.setattr(X, "JOBS", 10, raising=False)
    jobs = spark.createDataFrame([(i, "java, c", "x", "Java") for i in range(95)], "job_id int, computer_skills string, certifications string, work_skills string")
    out = X.structured_mentions(jobs)
    p = plan(out)
    assert "REPARTITION_BY_NUM" in p and ", 10), REPARTITION_BY_NUM" in p and "job_id#" in p and "ENSURE_REQUIREMENTS" not in p
    assert out.count() == 95 * 3


def test_known_postings_are_scored_where_they_lie(spark):
    docs = spark.createDataFrame([(i, " ".join(["a"] * (i % 3 + 1) + ["b"] * (i % 2) + ["c"]), "x", "y") for i in range(50)], "doc_id int, text string, location string, duty string")
    q = spark.createDataFrame([(1, ["a", "b"], "x", "-"), (2, ["a"], "-", "-")], "query_id int, terms array<string>, location string, duty string")
    asked, terms = q.select(F.explode("terms").alias("term")), T.latin_tokens(F.col("text"))
    held = S.index(docs, terms, only=asked, leave=("text",))
    assert "text" not in held.docs.columns
    assert "Exchange hashpartitioning(query_id" not in plan(S.bm25(q, held)) and "Exchange hashpartitioning(term" not in plan(held.postings)
    want = sorted(map(tuple, S.search(q, S.index(docs, terms), 10).collect()))
    assert want == sorted(map(tuple, S.search(q, held, 10).collect())) == sorted(map(tuple, S.search(q, S.index(docs, terms, only=asked, blocks=True, leave=("text",)), 10).collect()))


def test_a_constant_in_several_parts_counts_as_it_is(spark):
    from lodestar.operators import ranking

    for n in (98, 147, 196):
        rows = spark.range(0, n, 1, 3).select(F.lit(1).alias("query_id"), F.lit(1.0).alias("a"))
        assert {r.score for r in ranking.zscore_baseline(rows, {"a": 0.2}, by="query_id").collect()} == {0.2}
