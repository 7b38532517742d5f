"""The pruned kernel against full products, and the chain of canonicalisation against a plain version."""

import numpy as np
import pyarrow as pa
import pytest
from lodestar.functions import text as T
from lodestar.operators import extraction as X
from lodestar.operators import nearest
from pyspark.sql import functions as F


def unit(x):
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


@pytest.mark.parametrize("step", [7, 1024])
def test_pruned_products(monkeypatch, step):
    monkeypatch.setattr(nearest, "STEP", step)
    rng = np.random.default_rng(1)
    t = unit(np.concatenate([rng.normal(size=(300, 16)), np.repeat(rng.normal(size=(5, 16)), 8, axis=0), np.zeros((2, 16))]))
    q = np.concatenate([t[:40], unit(rng.normal(size=(20, 16))), np.zeros((1, 16))])
    own = np.concatenate([np.arange(40), np.full(21, -1)])
    full = np.round(q @ t.T, 9) + 0.0
    full[np.arange(40), np.arange(40)] = -np.inf
    want = np.argsort(-full, axis=1, kind="stable")[:, :6]
    scores, rows, _ = nearest.best_of(q, t, 6, 9, own)
    assert np.array_equal(rows, want) and np.array_equal(scores, np.take_along_axis(full, want, axis=1))
    few, rows, _ = nearest.best_of(q, t[:3], 6, 9)
    assert (np.isfinite(few).sum(1) == 3).all()


def test_most_pairs_of_names_are_ruled_out(spark):
    """Of names that have near ones, four pairs in five are never multiplied out."""
    p = spark.read.parquet("/root/testdata/sf0.1/part.parquet")
    vectors = lambda c: unit(np.array([r.v for r in p.select(c).distinct().orderBy(c).limit(4000).select(T.hash_embedding(F.lower(c)).alias("v")).collect()]))
    q = vectors("p_name")
    _, _, done = nearest.best_of(q[:500], q, 5, 8)
    assert done < 500 * len(q) * 0.6, done / (500 * len(q))


def test_chain_of_names(spark):
    aliases = spark.createDataFrame([("ReactJS", "React")], "alias string, target string")
    skills = spark.createDataFrame([("Go",), ("go",), ("data science",), ("java",), (None,)], "skill string")
    rows = [(1, 0, "reactjs"), (1, 1, "GO"), (2, 0, "data science!"), (2, 1, "unheard of"), (2, 2, None), (3, 0, "reactjs"), (3, 0, "reactjs"), (3, 1, "JavaScript")]
    m = spark.createDataFrame(rows, "job_id int, pos int, raw string")
    verifier = lambda a, b: ("same_skill", 0.95) if a.strip("!") == b else ("same_skill", 0.95) if b == "java" and a == "JavaScript" else ("ambiguous", 0.5)
    got = [(r.job_id, r.pos, r.selected, r.rule, r.decision) for r in X.canonicalise_full(m, aliases, skills, verifier).collect()]
    alias, exact, near, none = "high_precision_alias_dictionary", "exact_normalized_match", "embedding_plus_binary_verifier", "unresolved"
    assert sorted(got, key=str) == sorted(
        [(1, 0, "React", alias, "same_skill"), (1, 1, "Go", exact, "same_skill"), (2, 0, "data science", near, "same_skill"), (2, 1, None, none, "ambiguous"), (2, 2, None, none, None)]
        + [(3, 0, "React", alias, "same_skill")] * 2 + [(3, 1, None, none, "ambiguous")], key=str  # Java and JavaScript are a protected pair
    )
    plain = {(r.raw, r.rule) for r in X.canonicalise_full(m, aliases, skills).collect()}
    assert plain == {("reactjs", alias), ("GO", exact), *((n, none) for n in ("data science!", "unheard of", None, "JavaScript"))}
    assert X.canonicalise_full(m.limit(0), aliases, skills, verifier).count() == 0


def test_memory_does_not_grow_with_the_block():
    import tracemalloc

    rng = np.random.default_rng(4)
    t = rng.normal(size=(2048, 8))
    peaks, got = [], []
    for n in (1024, 4096):
        q = np.resize(rng.normal(size=(1024, 8)), (n, 8))
        tracemalloc.start()
        got.append(nearest.best_of(q, t, 5, 9))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 1.5 * peaks[0]
    assert len(got[1][0]) == 4096


def test_vectors_that_lack_something_are_zero():
    column = pa.chunked_array([pa.array([[3.0, 4.0], None, [1.0], [None, 2.0]], pa.list_(pa.float64())), pa.array([[0.0, 0.0], [0.0, 2.0]], pa.list_(pa.float64()))])
    assert nearest._unit(column, 2).tolist() == [[0.6, 0.8], [0.0, 0.0], [0.0, 0.0], [0.0, 0.0], [0.0, 0.0], [0.0, 1.0]]
