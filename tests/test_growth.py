"""What grows with the graph is dealt out by its size: nothing wide is shuffled twice, keys are counted by hash."""

from lodestar.operators import checks as C
from lodestar.operators import graph as G
from lodestar.plans import catalog
from lodestar.plans import fixtures as fx
from pyspark.sql import functions as F

EDGE = "edge_id string, from_id string, to_id string, label string, source_job_id string, evidence string, confidence double, weight double"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_mentions_stay_with_their_jobs(spark, sf, monkeypatch):
    monkeypatch.setattr(G, "MENTIONS", 1000)
    js = fx.stored_baskets(spark, sf)
    assert js.rdd.getNumPartitions() > 1 and sorted(js.collect()) == sorted(fx.baskets(spark, sf).collect())
    e = G.edges(fx.order_jobs(spark, sf), js, dealt=True).where("label = 'REQUIRES'")
    assert "Exchange hashpartitioning(job_id" not in plan(e) and "Exchange hashpartitioning(job_id" in plan(G.edges(fx.order_jobs(spark, sf), fx.baskets(spark, sf)))
    both = [df.drop("created_at") for df in (G.edges(fx.order_jobs(spark, sf), js, dealt=True), G.edges(fx.order_jobs(spark, sf), fx.baskets(spark, sf)))]
    assert sorted(map(str, both[0].collect())) == sorted(map(str, both[1].collect()))


def test_repeated_keys_are_told_by_hash_then_by_key(spark, monkeypatch):
    monkeypatch.setattr(C, "KEYS", 3)
    df = spark.createDataFrame([(k,) for k in ("a", "b", "b", None, None, "c", "d", "d", "d")], "k string")
    found = C._repeated(df, "k")
    assert {(r.k, r.n) for r in found.collect()} == {("b", 2), (None, 2), ("d", 3)}
    monkeypatch.setattr(F, "xxhash64", lambda *c: F.lit(1).cast("long"))  # all hashes collide
    assert {(r.k, r.n) for r in C._repeated(df, "k").collect()} == {("b", 2), (None, 2), ("d", 3)}


def graph(spark, kept=False):
    e = [("1", "j1", "s1", "REQUIRES", "1", "x", 1.0, 1.0), ("2", "j1", None, "REQUIRES", "2", "x", 1.0, 1.0), ("3", None, "s2", "REQUIRES", " ", "x", 1.0, 1.0), (None, "j1", "gone", "REQUIRES", None, "x", 9.0, 1.0), ("5", "j1", "s1", "REQUIRES", "1", "x", 1.0, 1.0), ("5", "j1", "s1", "PREFERS", "1", "x", 1.0, 1.0)]
    n = [("j1", "Job", "1", "train"), ("s1", "Skill", None, None), ("s2", "Skill", None, None), ("s3", "Skill", None, None), (None, "Skill", None, None), ("s1", "Skill", None, None)]
    return C.Graph(spark.createDataFrame(n, "node_id string, label string, job_id string, data_split string"), spark.createDataFrame(e, EDGE), kept=kept)


def test_missing_jobs_and_ends_are_counted_not_sorted(spark):
    g = graph(spark)
    ids = lambda name: sorted(str(r.record_id) for r in C.CHECKS[name][1](g).collect())
    assert ids("source_job_missing") == ["2"] and ids("dangling_edges") == ["2", "3", "None"] and ids("orphan_skill_nodes") == ["None", "s3"]
    assert "SortMergeJoin" not in plan(C.CHECKS["source_job_missing"][1](g)) and "SortMergeJoin" not in plan(C._absent(g.nodes.select("node_id"), g.nodes, "node_id"))


def test_few_ids_are_sent_to_the_rows(spark, monkeypatch):
    rows = []
    for few in (C.FEW, 0):
        monkeypatch.setattr(C, "FEW", few)
        out = C.invalid_edges(graph(spark))
        assert ("BroadcastHashJoin [xxhash64" in plan(out)) == (few > 0)
        rows.append(sorted(map(tuple, out.select("edge_id", "label").collect())))
    assert rows[0] == rows[1] == [("2", "REQUIRES"), ("3", "REQUIRES"), ("5", "PREFERS"), ("5", "REQUIRES")]


def test_invalid_nodes_store_no_edges(spark, sf, monkeypatch):
    seen, keep = [], C.materialise
    monkeypatch.setattr(C, "materialise", lambda df: seen.append(df.columns) or keep(df))
    assert catalog.queries()["validate_invalid_nodes"](spark, sf).count() == 3
    assert seen and not any("edge_id" in c for c in seen)
