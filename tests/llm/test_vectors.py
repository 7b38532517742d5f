import numpy as np
import pytest
from lodestar.llm import hnsw, queries, vector_dedup

VECTORS = "vec_id long, embedding array<float>, label int, node long, links long, root string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, 1, "x") for i, v in rows], VECTORS)


def cloud(seed=3, n=260, dim=16):
    """Singles, pairs, chains and a dense group, some vectors several times."""
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n, dim))
    near = [base[i] + 0.06 * rng.standard_normal(dim) for i in range(0, 60)]
    dense = [base[0] + 0.03 * rng.standard_normal(dim) for _ in range(90)]
    far = [3.0 * base[i] for i in range(100, 110)]
    rows = [*base, *near, *dense, *far, *base[200:215], *[base[250]] * 40]
    order = rng.permutation(len(rows))
    return [(int(i), [float(x) for x in np.float32(rows[j])]) for i, j in enumerate(order)]


AWKWARD = [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [None] * 16), (904, [float("inf")] * 16), (905, []), (906, [1.0, 2.0])]


def brute_links(rows, threshold=0.95):
    good = [(i, np.array(v, dtype=np.float64)) for i, v in rows if i not in range(900, 907)]
    x = np.stack([v / np.linalg.norm(v) for _, v in good])
    near = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    ids, root = [i for i, _ in good], {}
    for at in np.argsort(ids):
        if ids[at] in root:
            continue
        stack = [at]
        while stack:
            j = stack.pop()
            if ids[j] not in root:
                root[ids[j]] = ids[at]
                stack += np.flatnonzero(near[j]).tolist()
    return {ids[j]: (int(near[j].sum()), root[ids[j]]) for j in range(len(ids))}


@pytest.mark.parametrize("small", [False, True])
def test_vector_dedup_matches_brute_force(spark, monkeypatch, small):
    if small:  # many blocks and pieces even here
        monkeypatch.setattr(vector_dedup, "BLOCK", 64)
        monkeypatch.setattr(vector_dedup, "NEIGHBOURS", 4)
        monkeypatch.setattr(vector_dedup, "PIECE_BYTES", 64 * 16 * 8)
    rows = cloud()
    got = {r.vec_id: r for r in vector_dedup.near_duplicates(table(spark, rows + AWKWARD)).collect()}
    want = brute_links(rows)
    assert len(got) == len(rows) + len(AWKWARD)
    assert {i: (r.n_links, r.component_id) for i, r in got.items() if i < 900} == want
    assert all((r.n_links, r.component_id, r.kept) == (0, i, True) for i, r in got.items() if i >= 900)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_lonely_pairs_are_found_and_lost_ones_are_an_error(spark, monkeypatch):
    """Pairs without other neighbours beside a dense group that holds most of all links."""
    monkeypatch.setattr(vector_dedup, "BLOCK", 64)
    rng = np.random.default_rng(6)
    base = rng.standard_normal((1000, 24))
    rows = [*base, *(base[:300] + 0.2 * rng.standard_normal((300, 24))), *(base[999] + 0.05 * rng.standard_normal((200, 24)))]
    rows = [(2000 + i, [float(x) for x in np.float32(v)]) for i, v in enumerate(rows)]
    frame, want = table(spark, rows), {i: n for i, (n, _) in brute_links(rows).items()}
    got = {r.vec_id: r.n_links for r in vector_dedup.near_duplicates(frame).collect()}
    pairs = [i for i in got if 0 < want[i] < 5]
    assert len(pairs) > 300 and sum(got[i] == want[i] for i in pairs) >= 0.98 * len(pairs)
    assert all(got[i] <= want[i] for i in got)
    monkeypatch.setattr(vector_dedup, "MOST_ROUNDS", 1)
    monkeypatch.setattr(vector_dedup, "PROMISED", 0.3)
    with pytest.raises(RuntimeError):
        vector_dedup.near_duplicates(frame)


def test_long_chains_are_counted_from_kept_edges(spark, monkeypatch):
    """A component larger than a block whose lists aren't full: a walk with a link at every step, and copies on it."""
    monkeypatch.setattr(vector_dedup, "BLOCK", 64)
    rng = np.random.default_rng(12)
    x, walk = np.eye(40)[0], []
    for _ in range(300):
        step = rng.standard_normal(40)
        step -= (step @ x) * x
        x = np.cos(0.25) * x + np.sin(0.25) * step / np.linalg.norm(step)
        walk.append(x)
    rows = [(2000 + i, [float(v) for v in np.float32(w)]) for i, w in enumerate([*walk, *walk[:20], walk[5]])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in vector_dedup.near_duplicates(table(spark, rows)).collect()}
    want = brute_links(rows)
    assert max(n for n, _ in want.values()) < 16 and {c for _, c in want.values()} == {2000}
    assert got == want


def test_vector_dedup_takes_awkward_tables(spark):
    assert vector_dedup.near_duplicates(table(spark, [])).collect() == []
    got = vector_dedup.near_duplicates(table(spark, [(None, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0])])).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.kept) for r in got) == [(0, 0, False), (1, 1, True), (1, 1, True)]


def brute_nearest(rows, k=20):
    good = [(i, np.array(v, dtype=np.float64)) for i, v in rows if v is not None and i < 900]
    out = {}
    for q, a in good:
        if q % 20 == 0:
            out[q] = sorted(((-float(a @ b), i) for i, b in good if i != q))[:k]
    return out


def test_nearest_recall_ties_and_scores(spark, sf):
    for rows in (cloud(), [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]):
        frame = hnsw.search(table(spark, rows + [a for a in AWKWARD if a[0] != 906]))
        got, want, vectors = {}, brute_nearest(rows), {i: np.array(v, dtype=np.float64) for i, v in rows}
        for r in sorted(frame.collect(), key=lambda r: (r.query_id, r.rank)):
            got.setdefault(r.query_id, []).append((-r.score, r.vec_id))
            assert r.score == pytest.approx(float(vectors[r.query_id] @ vectors[r.vec_id]), rel=1e-12)
        assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
        assert all(v == sorted(v) for v in got.values())
        hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
        assert hits >= 0.97 * 20 * len(want)


def test_a_walk_of_a_graph_larger_than_its_beam(spark, monkeypatch):
    """Isotropic vectors, the hard case: one shard of 5,000; the audit widens a beam that is too narrow."""
    monkeypatch.setattr(hnsw, "LEAST_SHARDS", 1)
    x = np.random.default_rng(8).standard_normal((5000, 32)).astype(np.float32)
    want = {}
    for q in range(0, 5000, 20):
        scores = x.astype(np.float64) @ x[q].astype(np.float64)
        scores[q] = -np.inf
        want[q] = set(np.argsort(-scores, kind="stable")[:20].tolist())
    frame = table(spark, [(i, v) for i, v in enumerate(x.tolist())])

    def recall(**options):
        hits = sum(r.vec_id in want[r.query_id] for r in hnsw.search(frame, **options).collect())
        return hits / (20 * len(want))

    assert recall(beam=21, recall=0.0) < 0.9 <= 0.94 < recall(beam=21)


def test_nearest_takes_awkward_tables(spark):
    assert hnsw.search(table(spark, [])).collect() == []
    assert hnsw.search(table(spark, [(20, [1.0, 0.0])])).collect() == []
    got = hnsw.search(table(spark, [(20, [1.0, 0.0]), (3, [1.0, 0.0]), (2, [1.0, 0.0]), (5, None), (None, [1.0, 1.0])])).collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"])] == [(20, 1, 2, 1.0), (20, 2, 3, 1.0)]


def test_queries_cover_their_tables(spark, sf):
    n = spark.read.parquet(f"{sf}/embeddings.parquet").count()
    assert queries.op10_vector_dedup(spark, sf).count() == n
