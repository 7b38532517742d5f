"""Cycles of aliases against a plain search, and the number of rounds for a long chain."""

import random

import pytest
from lodestar.operators import checks


def plain(edges):
    out = {}
    for a, b in edges:
        out.setdefault(a, set()).add(b)
    live = set(out)
    while True:
        kept = {a for a in live if out[a] & live}
        if kept == live:
            return live
        live = kept


@pytest.mark.parametrize("seed", range(3))
def test_against_a_plain_search(spark, seed):
    rng = random.Random(seed)
    edges = [(f"n{rng.randrange(60)}", f"n{rng.randrange(60)}") for _ in range(55)] + [(f"c{i}", f"c{i + 1}") for i in range(30)] + [(f"c{9 * i}", "n1") for i in range(3)]
    edges += [("s", "s"), ("x", "y"), ("y", "z"), ("z", "x"), ("t", "x"), ("t", "end"), ("x", "y")]
    df = spark.createDataFrame(edges, "from_id string, to_id string")
    assert {r.node_id for r in checks.reaching_cycles(df).collect()} == plain(edges)


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    made = []
    keep = checks.materialise
    monkeypatch.setattr(checks, "materialise", lambda df: made.append(1) or keep(df))
    chain = spark.range(10_000).selectExpr("'a' || id from_id", "'a' || (id + 1) to_id")
    assert checks.reaching_cycles(chain).count() == 0 and len(made) <= 20
    made.clear()
    ring = chain.union(spark.createDataFrame([("a10000", "a5000")], "from_id string, to_id string"))
    assert checks.reaching_cycles(ring).count() == 10_001 and len(made) <= 20
