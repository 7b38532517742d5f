"""The histogram ranker against a plain version that splits sorted rows, one leaf at a time."""

import math
import random
import time

import numpy as np
import pytest
from lodestar.operators import ltr


def plain_gradients(rows, score):
    """rows: (query, job, grade, ...), in any order."""
    lam, weight, gain = np.zeros(len(rows)), np.zeros(len(rows)), (0.0, 1.0, 3.0)
    for q in {r[0] for r in rows}:
        mine = sorted((i for i, r in enumerate(rows) if r[0] == q), key=lambda i: (-score[i], rows[i][1]))
        ideal = sum(gain[g] / math.log2(i + 2) for i, g in enumerate(sorted((rows[i][2] for i in mine), reverse=True)))
        for a, i in enumerate(mine):
            for b, j in enumerate(mine):
                if rows[i][2] > rows[j][2]:
                    delta = abs((gain[rows[i][2]] - gain[rows[j][2]]) * (1 / math.log2(a + 2) - 1 / math.log2(b + 2))) / ideal
                    rho = 1 / (1 + math.exp(score[i] - score[j]))
                    lam[i], lam[j] = lam[i] + rho * delta, lam[j] - rho * delta
                    weight[i], weight[j] = weight[i] + rho * (1 - rho) * delta, weight[j] + rho * (1 - rho) * delta
    return lam, weight


def plain_split(x, lam, weight, mine, min_rows):
    best, total = (0.0, 0, 0.0), (lam[mine].sum(), weight[mine].sum())
    for f in range(x.shape[1]):
        for limit in np.unique(np.where(np.isnan(x[:, f]), -np.inf, x[:, f])):
            left = [i for i in mine if math.isnan(x[i, f]) or x[i, f] <= limit]
            right = [i for i in mine if i not in set(left)]
            if min(len(left), len(right)) >= min_rows and min(weight[left].sum(), weight[right].sum()) >= 1e-3:
                gain = round(sum(lam[s].sum() ** 2 / weight[s].sum() for s in (left, right)) - total[0] ** 2 / total[1], 9)
                if gain > best[0]:
                    best = (gain, f, limit)
    return best


def plain_fit(rows, x, trees, rate, leaves, min_rows):
    score = np.zeros(len(rows))
    for _ in range(trees):
        lam, weight = plain_gradients(rows, score)
        groups = [list(range(len(rows)))]
        splits = [plain_split(x, lam, weight, groups[0], min_rows)]
        while len(groups) < leaves and max(s[0] for s in splits) > 0:
            k = max(range(len(groups)), key=lambda i: splits[i][0])
            mine, (_, f, limit) = groups.pop(k), splits.pop(k)
            left = [i for i in mine if math.isnan(x[i, f]) or x[i, f] <= limit]
            for s in (left, [i for i in mine if i not in set(left)]):
                groups.append(s)
                splits.append(plain_split(x, lam, weight, s, min_rows))
        for s in groups:
            score[s] += rate * lam[s].sum() / weight[s].sum() if weight[s].sum() > 0 else 0.0
    return score


def data(seed, queries, size, missing=True):
    rng = random.Random(seed)
    rows, x = [], []
    for q in range(queries):
        for j in range(rng.randrange(1, size)):
            grade = rng.choice((0, 0, 1, 2))
            rows.append((q, j, grade))
            x.append([grade + rng.randrange(6), rng.randrange(40) / 4, float("nan") if missing and rng.random() < 0.2 else float(rng.randrange(5))])
    return rows, np.array(x, float)


def frame(spark, rows, x):
    return spark.createDataFrame([(*r, *map(float, v)) for r, v in zip(rows, x)], "query_id int, job_id int, relevance int, a double, b double, c double")


@pytest.mark.parametrize("chunk", [20, 1 << 16])
def test_trees_equal_a_plain_version(spark, monkeypatch, chunk):
    monkeypatch.setattr(ltr, "CHUNK", chunk)
    rows, x = data(3, 14, 18)
    df = frame(spark, rows, x).repartition(3)
    model = ltr.fit(df, ["a", "b", "c"], trees=4, rate=0.2, leaves=6, min_rows=4)
    want = dict(zip(((r[0], r[1]) for r in rows), plain_fit(rows, x, 4, 0.2, 6, 4)))
    got = {(r.query_id, r.job_id): r.score for r in model.score(df).collect()}
    assert got.keys() == want.keys() and max(abs(got[k] - want[k]) for k in want) < 1e-6
    assert all(sum(f < 0 for f in t.feature) <= 6 for t in model.trees) and any(sum(f < 0 for f in t.feature) == 6 for t in model.trees)


def test_gradients_in_blocks(monkeypatch):
    rows, _ = data(5, 9, 30)
    score = np.random.default_rng(0).normal(size=len(rows)).round(1)
    sizes = np.unique([r[0] for r in rows], return_counts=True)[1]
    want = plain_gradients(rows, score)
    for pairs in (10, 1 << 20):
        monkeypatch.setattr(ltr, "PAIRS", pairs)
        assert np.allclose(ltr.gradients(score, np.array([r[2] for r in rows]), sizes), want)


def test_a_ranker_without_anything_to_learn(spark):
    rows, x = data(6, 4, 6, False)
    flat = frame(spark, [(q, j, 1) for q, j, _ in rows], x)
    assert {r.score for r in ltr.fit(flat, ["a", "b"], trees=2).score(flat).collect()} == {0.0}
    assert ltr.fit(flat.limit(0), ["a"], trees=1).score(flat).count() == len(rows)
    assert {r.score for r in ltr.Ranker(["a"]).score(flat).collect()} == {0.0}


@pytest.mark.parametrize("spread", [0.0, 0.1, 3.0, 12.0])
def test_pairs_of_a_long_query_are_never_made(monkeypatch, spread):
    rng = np.random.default_rng(1)
    n = 1500
    score, grade = np.round(rng.normal(size=n) * spread, 3), rng.choice(3, n, p=(0.6, 0.3, 0.1))
    sizes = np.array([n - 3, 3])
    monkeypatch.setattr(ltr, "LONG", 1 << 30)
    want = ltr.gradients(score, grade, sizes)
    monkeypatch.setattr(ltr, "LONG", 512)
    for pairs in (1 << 14, 1 << 20):
        monkeypatch.setattr(ltr, "PAIRS", pairs)
        for a, b in zip(ltr.gradients(score, grade, sizes), want):
            assert np.abs(a - b).max() <= 1e-11 * np.abs(b).max()


def test_work_on_a_long_query_is_no_square():
    rng = np.random.default_rng(2)
    n = 200_000  # 4e10 pairs would take minutes
    start = time.process_time()
    lam, weight = ltr.gradients(rng.normal(size=n), rng.choice(3, n), np.array([n]))
    assert time.process_time() - start < 60 and abs(lam.sum()) < 1e-6 and (weight > 0).all()


def test_scores_stored_anew_change_nothing(spark, monkeypatch):
    rows, x = data(4, 10, 12)
    df = frame(spark, rows, x)
    fitted = lambda: ltr.fit(df, ["a", "b", "c"], trees=4, rate=0.2, leaves=4, min_rows=4).trees
    want = fitted()
    monkeypatch.setattr(ltr, "ROUND", 1)
    monkeypatch.setattr(ltr, "FEW", 0)
    assert [(t.feature, t.cut) for t in fitted()] == [(t.feature, t.cut) for t in want]


def test_one_task_learns_what_many_learn(spark, monkeypatch):
    rows, x = data(5, 16, 14, missing=True)
    df = frame(spark, rows, x)
    fitted = lambda: ltr.fit(df, ["a", "b", "c"], trees=5, rate=0.2, leaves=5, min_rows=4)
    one = fitted()
    monkeypatch.setattr(ltr, "CHUNK", 10)
    many = fitted()
    assert [(t.feature, t.cut, t.limit) for t in one.trees] == [(t.feature, t.cut, t.limit) for t in many.trees] and len(one.trees) == 5
    assert all(abs(a - b) < 1e-9 for s, t in zip(one.trees, many.trees) for a, b in zip(s.value, t.value)) and all(abs(a - b) < 1e-6 for a, b in zip(one.gains, many.gains))
