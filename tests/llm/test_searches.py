"""Resampling, ranked search and phrase matches against plain versions."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from lodestar.llm import phrases, ranked, resampling, words
from lodestar.llm.tables import materialise

from tests.llm.fixtures import documents

ITEMS = "item_id int, text string, doc_id string, score string"


def items(spark, rows):
    return spark.createDataFrame([(i, t, "x", "x") for i, t in rows], ITEMS)


def plain_words(text):
    out, word = [], ""
    for c in (text or "") + " ":
        c = c.lower() if "A" <= c <= "Z" else c
        if ord(c) > 127 or "0" <= c <= "9" or "a" <= c <= "z":
            word += c
        elif word:
            out.append(word)
            word = ""
    return out


def random_texts(n, seed, size=60, vocabulary=12):
    rng = random.Random(seed)
    return [" ".join(rng.choice("abcdefghijkl"[:vocabulary]) * rng.choice((1, 1, 2)) for _ in range(rng.randrange(size))) for _ in range(n)]


@pytest.mark.parametrize("size", [1, 3, 7, 1000])
def test_pieces(size):
    for text in ["", "  ", "Abc d-E", "wörter-ÜBER x" * 9, "a" * 40 + " b", "-".join("xyz")]:
        data = text.encode()
        assert [w for p in words.pieces(data, size) for w in p.split()] == words.words(data) == [w.encode() for w in plain_words(text)]


def test_blocks(spark):
    it = items(spark, [(i, "x" * 100) for i in range(50)] + [(None, None)])
    some = list(words.blocks(it, 1000))
    assert len(some) == 6 and sum(map(len, some)) == 51 and [len(b) for b in words.blocks(it)] == [51]
    assert list(words.blocks(it.limit(0))) == [[]]


@pytest.mark.parametrize("chunk", [5, 64, 1 << 21])
@pytest.mark.parametrize("most", [1, 3])
def test_features_by_automaton(monkeypatch, chunk, most):
    monkeypatch.setattr(resampling, "CHUNK", chunk)
    texts = [None, "", "Ab, c", "x", "y", "", "z" * 200 + " ü9", "é" * 60, "a b a b " * 30, "...", "tail"] + random_texts(20, 1)
    want = Counter()
    for row, t in enumerate(texts):
        w = plain_words(t)
        want.update((row, zlib.crc32(" ".join(w[i : i + n]).encode()), n) for n in range(1, most + 1) for i in range(len(w) - n + 1))
    for column in (pa.array(texts), pa.array(["skip", *texts])[1:]):
        got = Counter((int(r), int(c), n) for rows, crcs, n in resampling.features(column, most) for r, c in zip(rows, crcs))
        assert got == want


def plain_resample(docs, target, most, buckets, seed, least, percent):
    grams = lambda t: [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for w in [plain_words(t)] for n in range(1, most + 1) for i in range(len(w) - n + 1)]
    s, t = Counter(b for _, x in docs for b in grams(x)), Counter(b for x in target for b in grams(x))
    S, T = s.total(), t.total()
    out = []
    for key, text in docs:
        g = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in grams(text)]
        weight = sum(g) // len(g) if g else 0
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), len(plain_words(text)) >= least])
    best = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    ranks = {id(r): i + 1 for i, r in enumerate(best[: len(best) * percent // 100])}
    return Counter((*r[:4], ranks.get(id(r))) for r in out)


@pytest.mark.parametrize("most,least,percent", [(1, 20, 10), (2, 0, 60)])
def test_resampling(spark, most, least, percent):
    docs = documents(spark)
    docs = docs.union(documents(spark, [(100 + i, t, "en", "a", 1) for i, t in enumerate(random_texts(80, 2))]))
    target = [None, "", "a b c d aa bb", "the quick brown fox"]
    got = resampling.resample(docs.repartition(5), items(spark, enumerate(target)), most, 97, 5, least, percent)
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    want = plain_resample([(r.doc_id, r.text) for r in docs.collect()], target, most, 97, 5, least, percent)
    assert Counter(map(tuple, got.select(*columns).collect())) == want
    assert dict(got.dtypes) == {c: "bigint" for c in [*columns, "n_words"]}
    assert resampling.drawn(docs, got).count() >= sum(n for k, n in want.items() if k[4])
    assert resampling.resample(docs.limit(0), items(spark, []), most).count() == 0
    assert resampling.resample(docs, items(spark, []), most).count() == docs.count()


def plain_search(docs, asked, k):
    tf = [(key, Counter(plain_words(t))) for key, t in docs]
    tf = [(key, c) for key, c in tf if c]
    N, L = len(tf), sum(c.total() for _, c in tf)
    df = Counter(t for _, c in tf for t in c)
    out = Counter()
    for item, text in asked:
        scores = []
        for key, c in tf:
            m = 75 + 25 * c.total() * N // L
            s = sum(math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in plain_words(text) if c[t])
            if s > 0:
                scores.append((-s, key is None, key or 0, key))
        out.update((item, i + 1, r[3], -r[0]) for i, r in enumerate(sorted(scores)[:k]))
    return out


@pytest.mark.parametrize("block", [40, 1 << 20])
def test_ranked_search(spark, monkeypatch, block):
    monkeypatch.setattr(ranked, "BLOCK", block)
    docs = documents(spark).union(documents(spark, [(100 + i, t, "en", "a", 1) for i, t in enumerate(random_texts(300, 3) * 2)]))
    asked = [(1, "a bb c"), (1, "d d d"), (2, None), (3, ""), (4, "The quick fox"), (5, "unknown"), (6, "aa b c d e f g h i j k l" * 2), (7, "alpha one no"), (None, "key two")]
    got = ranked.search(docs.repartition(7), items(spark, asked), 20)
    want = plain_search([(r.doc_id, r.text) for r in docs.collect()], asked, 20)
    assert got.columns == ["item_id", "rank", "doc_id", "score"] and Counter(map(tuple, got.collect())) == want
    assert ranked.search(docs.limit(0), items(spark, asked)).count() == ranked.search(docs, items(spark, [])).count() == 0


def test_items_in_blocks_give_the_same(spark, monkeypatch):
    docs = documents(spark, [(i, t, "en", "a", 1) for i, t in enumerate(random_texts(50, 4))])
    asked = [(i, t) for i, t in enumerate(random_texts(12, 5, 20))]
    plain = words.blocks
    for module in (ranked, phrases):
        monkeypatch.setattr(module, "blocks", lambda it: plain(it, 200))
    assert Counter(map(tuple, ranked.search(docs, items(spark, asked), 3).collect())) == plain_search([(r.doc_id, r.text) for r in docs.collect()], asked, 3)
    held = materialise(phrases.index(docs))
    got = phrases.contamination(held, items(spark, asked), 3).collect()
    assert {(r.doc_id, r.n_hit, r["items"]) for r in got} == {(k, len(h), ",".join(i)) for k, _, h, i in plain_phrases([(r.doc_id, r.text) for r in docs.collect()], asked, 3)}


def test_rounds_end_early():
    """A score at a time reads a part of the postings, and the best are those of full scores, ties included."""
    rng = np.random.default_rng(0)
    n, n_terms, k = 20_000, 6, 10
    tf = np.where(rng.random((n, n_terms)) < 0.3, rng.geometric(0.5, (n, n_terms)), 0)
    m = 75 + rng.integers(1, 60, n)
    doc, terms = np.nonzero(tf)
    ends = np.concatenate([[0], np.cumsum((tf > 0).sum(1))])
    ids = rng.permutation(n).astype(np.int64)
    block = ranked.Block(ids, np.zeros(n, bool), m, ends, terms.astype(np.int32), tf[doc, terms], n_terms)
    for query, most in (({0: 900}, 0.05), ({0: 900, 1: 5}, 0.05), ({1: 700, 2: 650, 3: 20}, 0.7), ({0: 0, 5: 3}, 0.05), ({t: 100 for t in range(6)}, 1)):
        best, before = ranked.Best(k), block.read
        block.search(query, best)
        full = sum(w * ((10**9 * tf[:, t]) // np.maximum(1000 * tf[:, t] + 12 * m, 1)) for t, w in query.items())
        order = np.lexsort((ids, -full))[:k]
        assert best.scores.tolist() == full[order].tolist() and best.ids.tolist() == ids[order].tolist()
        assert block.read - before <= most * sum((tf[:, t] > 0).sum() for t, w in query.items() if w)


def plain_phrases(docs, asked, width):
    out = []
    for key, text in docs:
        w, hit, found = plain_words(text), set(), set()
        for item, t in asked:
            q = plain_words(t)
            for a in range(max(1, len(q) - width + 1)) if q else ():
                run = q[a : a + width]
                for s in range(len(w) - len(run) + 1):
                    if w[s : s + len(run)] == run:
                        hit.update(range(s, s + len(run)))
                        found.add("" if item is None else str(item))
        out.append((key, len(w), hit, sorted(found)))
    return out


@pytest.mark.parametrize("size,overlap", [(30, 8), (1 << 19, 256)])
def test_phrases(spark, monkeypatch, size, overlap):
    """Also with texts that are cut into many segments."""
    monkeypatch.setattr(phrases, "WORDS", size)
    monkeypatch.setattr(phrases, "OVERLAP", overlap)
    rows = [(1, "the quick brown fox jumps over the lazy dog"), (1, "the quick brown fox jumps over the lazy dog"), (None, "no key here at all"), (3, None), (4, ""), (5, " \t"), (6, "a b c d e " * 300), (7, "Ünïcode wörds don't")]
    rows += [(100 + i, t) for i, t in enumerate(random_texts(120, 6, 90, 4))]
    asked = [(1, "QUICK brown-fox jumps"), (2, "e a b c d e a"), (3, "no key"), (None, "ünïcode"), (4, None), (5, ".."), (6, "wörds don t"), (10, "a b a"), (10, "d d c a b"), (7, "absent words here now"), (8, "x")]
    docs = documents(spark, [(k, t, "en", "a", 1) for k, t in rows]).repartition(3)
    held = materialise(phrases.index(docs))
    got = phrases.contamination(held, items(spark, asked), 4).collect()
    want = Counter((k, n, len(h), len(i), ",".join(i), bool(h)) for k, n, h, i in plain_phrases(rows, asked, 4))
    assert Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, r["items"], r.contaminated) for r in got) == want
    assert phrases.contamination(materialise(phrases.index(docs.limit(0))), items(spark, asked), 4).count() == 0
    assert {r.contaminated for r in phrases.contamination(held, items(spark, []), 4).collect()} == {False}
    with pytest.raises(ValueError):
        phrases.matches(held, items(spark, asked), overlap + 1)

    near = Counter((r.doc_id, r.item_id, r.start, r.end) for r in phrases.matches(held, items(spark, asked[:4] + asked[6:9]), 4, 2).where("kind = 'near'").collect())
    plain = Counter()
    for key, text in rows:
        w = plain_words(text)
        for item, t in asked[:4] + asked[6:9]:
            q = plain_words(t)
            spans = set()
            for run in {tuple(q[a : a + 4]) for a in range(max(1, len(q) - 3))}:
                has = lambda s, e: set(run) <= set(w[s:e])
                spans |= {(s, e) for s in range(len(w)) for e in range(s + 1, min(len(w), s + len(run) + 2) + 1) if has(s, e) and not has(s + 1, e) and not has(s, e - 1)}
            plain.update((key, "" if item is None else str(item), s, e) for s, e in spans)
    assert set(near) == set(plain)
