import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import tokenizers
from lodestar.llm import bpe, lm, quality, queries
from tests.llm.fixtures import documents


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(queries.vocabulary())


def digests(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return len(ids), sha(",".join(map(str, ids)).encode()), sha(library.decode(ids, skip_special_tokens=False).encode())


def test_bpe_equals_the_library(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = {d.doc_id: digests(library, d.text) for d in docs}
    got = queries.op3_bpe(spark, sf).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want


def test_bpe_takes_awkward_rows(spark, library):
    docs = documents(spark)
    want = sorted((d.doc_id or 0, *digests(library, d.text)) for d in docs.collect())
    got = bpe.round_trip(docs, queries.vocabulary()).collect()
    assert sorted((r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want
    assert bpe.round_trip(documents(spark, []), queries.vocabulary()).collect() == []
    back = bpe.decode(bpe.encode(docs, queries.vocabulary()), queries.vocabulary()).collect()
    assert sorted((r.doc_id or 0, r.text) for r in back) == sorted((d.doc_id or 0, d.text or "") for d in docs.collect())


def test_bpe_equals_the_library_on_random_texts(library):
    code, rng = bpe.codec(bpe._spec(queries.vocabulary())), random.Random(5)
    tokens = [t.decode("utf-8", "ignore") for t in code.bytes_of.values()]
    for i in range(8000):
        text = (
            "".join(rng.choice("aaabeéß \t\n\x1c\x85 's'T09²漢\U0001f600​!?|<>\x00") for _ in range(rng.randint(0, 30)))
            if i % 2
            else "".join(rng.choice(tokens) for _ in range(rng.randint(1, 8)))
        )
        ids = library.encode(text, add_special_tokens=False).ids
        assert code.encode(text) == ids and code.decode(ids) == library.decode(ids, skip_special_tokens=False) == text


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    marks = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = queries.op4_quality(spark, sf).collect()
    assert len(rows) == 1000
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    right = [r.predicted == marks[r.doc_id] for r in rows if r.held_out and r.doc_id in marks]
    assert len(right) > 60 and sum(right) >= 0.95 * len(right)


def test_pairs_in_linear_time_equal_pairs(spark):
    rng = np.random.default_rng(1)
    machine = quality.Machine(0.3, rng.standard_normal(quality.SLOTS), rng.standard_normal((quality.SLOTS, 4)))
    slots, x = np.array([5, 9, 700, 16500]), np.array([0.2, -1.0, 0.5, 2.0])
    pairs = sum(machine.factor[slots[i]] @ machine.factor[slots[j]] * x[i] * x[j] for i in range(4) for j in range(i))
    assert machine.margin(slots, x) == pytest.approx(0.3 + machine.weight[slots] @ x + pairs)


def test_quality_takes_awkward_rows(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 0), (5, 0, 0), (None, 1, 0), (6, 1, 0), (6, 0, 0)], "doc_id long, quality int, toxic int")
    for marks in (labels, labels.limit(0)):
        machine = quality.fit(docs, marks)
        scores = quality.score(docs, machine).collect()
        assert len(scores) == 13 and all(0 <= r.score <= 1 for r in scores)
        kept = quality.keep(docs, machine)
        assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in scores)
    assert quality.score(documents(spark, []), machine).collect() == []


def brute_train(rows, rank=8, epochs=6, rate=0.05, seed=42, batch=64):
    """The same steps by hand: one row, one slot and one pair at a time."""
    rng = np.random.default_rng(seed)
    w, v, w0 = np.zeros(quality.SLOTS), rng.normal(0, 0.02, (quality.SLOTS, rank)), 0.0
    theta = np.concatenate([[w0], w, v.ravel()])
    m, s, t = np.zeros_like(theta), np.zeros_like(theta), 0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), batch):
            part, grad = [rows[i] for i in order[at : at + batch]], np.zeros_like(theta)
            w0, w, v = theta[0], theta[1 : 1 + quality.SLOTS], theta[1 + quality.SLOTS :].reshape(quality.SLOTS, rank)
            gw, gv = grad[1 : 1 + quality.SLOTS], grad[1 + quality.SLOTS :].reshape(quality.SLOTS, rank)
            for slots, x, y in part:
                z = w0 + sum(w[i] * a for i, a in zip(slots, x))
                z += sum((v[i] @ v[j]) * a * b for p, (i, a) in enumerate(zip(slots, x)) for j, b in list(zip(slots, x))[:p])
                d = (1 / (1 + math.exp(-z)) - y) / len(part)
                grad[0] += d
                for p, (i, a) in enumerate(zip(slots, x)):
                    gw[i] += d * a
                    gv[i] += d * a * sum((b * v[j] for q, (j, b) in enumerate(zip(slots, x)) if q != p), np.zeros(rank))
            grad[1:] += 1e-6 * theta[1:]
            t += 1
            m, s = 0.9 * m + 0.1 * grad, 0.999 * s + 0.001 * grad**2
            theta = theta - rate * (m / (1 - 0.9**t)) / (np.sqrt(s) + 1e-8) * math.sqrt(1 - 0.999**t)
    return theta


def test_training_equals_brute_force():
    rng = np.random.default_rng(4)
    rows = [(np.sort(rng.choice(40, 5, replace=False)), rng.standard_normal(5), float(rng.integers(2))) for _ in range(30)]
    machine, want = quality.train(rows, rank=2, epochs=2, batch=8), brute_train(rows, rank=2, epochs=2, batch=8)
    assert machine.bias == pytest.approx(want[0]) and np.allclose(machine.weight, want[1 : 1 + quality.SLOTS])
    assert np.allclose(machine.factor.ravel(), want[1 + quality.SLOTS :])


def test_quality_does_not_depend_on_partitions(spark):
    rows = [(i, f"text {i} with some words {j} " * (2 + i % 5), "en", "a", 9) for i in range(60) for j in (0, 1)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    scores = []
    for n in (1, 3):
        docs = documents(spark, rows).repartition(n, "text")
        scores.append(sorted((r.doc_id, r.score) for r in quality.score(docs, quality.fit(docs, labels)).collect()))
    assert scores[0] == scores[1]


def brute_base(docs):
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) + [None]
    out = lambda d: zlib.crc32(str(d.doc_id).encode() if d.doc_id is not None else b"") % 10 == 0
    counts = Counter(w for d in docs if not out(d) for w in words(d.text))
    n, v = sum(counts.values()), len(counts)
    for d in docs:
        ws = words(d.text)
        base = sum(math.log10(counts[w] + 0.1) - math.log10(n + 0.1 * (v + 1)) for w in ws)
        yield (d.doc_id if d.doc_id is not None else -1), out(d), len(ws), sum(counts[w] > 0 for w in ws), n, round(base, 6)


@pytest.mark.parametrize("head", [lm.HEAD, 40])
def test_base_scores_equal_brute_force(spark, sf, monkeypatch, head):
    monkeypatch.setattr(lm, "HEAD", head)
    for docs in (spark.read.parquet(f"{sf}/documents.parquet"), documents(spark), documents(spark, [(10, "a b", None, None, None)])):
        rows = lm.score(docs, megabytes=1).collect()
        got = sorted((r.doc_id if r.doc_id is not None else -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows)
        assert got == sorted(brute_base(docs.collect()))
        assert all(math.isfinite(r.score) and r.score < 0 for r in rows)
    assert lm.score(documents(spark, []), megabytes=1).collect() == []


def test_the_model_beats_the_base_on_held_out_texts(spark):
    rows = [r for r in queries.op9_lm(spark, "/root/testdata/sf0.01").collect() if r.held_out]
    assert len(rows) > 50 and sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_filter_counts_are_never_too_low():
    rng = np.random.default_rng(2)
    grams = np.unique(rng.integers(0, 1 << 63, 30_000).astype(np.uint64) * np.uint64(2))
    counts = rng.geometric(0.2, len(grams)) ** 2
    held = lm.CountFilter(8, 3)
    segment, names = held.place(grams)
    held.bits = np.concatenate([np.frombuffer(held.build(names[segment == i], counts[segment == i]), np.uint8) for i in range(8)])
    levels, true = held.levels(grams), np.floor(np.log2(counts)).astype(int) + 1
    assert (levels >= true).all() and (levels == true).mean() > 0.99
    assert (held.levels(rng.integers(0, 1 << 63, 20_000).astype(np.uint64)) > 0).mean() < 0.02


def test_a_segment_is_read_once_for_all_units(monkeypatch):
    """Units times segments grow with the square of the corpus, so no row may cost a call."""
    rng = np.random.default_rng(5)
    asked = [np.unique(rng.integers(0, 3000, n)).astype("<u4") for n in (1, 400, 7, *[3] * 3000)]
    learnt = [rng.integers(0, 40, len(x)).astype("<u4") for x in asked]
    table = pa.table({"names": pa.array([x.tobytes() for x in asked], pa.binary()), "counts": pa.array([x.tobytes() for x in learnt], pa.binary())})
    table = pa.concat_tables([table.slice(0, 1000), table.slice(1000)])
    calls, read = [], lm.CountFilter.read
    monkeypatch.setattr(lm.CountFilter, "read", lambda *a: calls.append(1) or read(*a))
    got = lm._levels(table, 3, 0.001, None)
    assert len(calls) == 1
    sums = np.bincount(np.concatenate(asked), weights=np.concatenate(learnt), minlength=3000)
    true = np.where(sums > 0, np.floor(np.log2(np.maximum(sums, 1))) + 1, 0)
    read_ = [np.frombuffer(x.as_py(), np.uint8) for x in got]
    assert [len(x) for x in read_] == [len(x) for x in asked] and all((x >= true[a]).all() for x, a in zip(read_, asked))
    assert np.mean(np.concatenate(read_) == true[np.concatenate(asked)]) > 0.99


def test_unique_values_and_packed_rows():
    rng = np.random.default_rng(6)
    for values in (rng.integers(0, 50, 999), rng.integers(0, 1 << 62, 999), np.repeat(rng.integers(0, 1 << 62, 9), 9), np.zeros(0, int)):
        want, got = np.unique(values.astype(np.uint64), return_inverse=True), lm._unique(values.astype(np.uint64))
        assert got[0].tolist() == want[0].tolist() and got[1].tolist() == want[1].tolist()
    values, cuts = np.arange(10, dtype="<u4"), np.array([0, 3, 3, 10])
    packed = lm._packed(values, cuts)
    assert [len(x) for x in packed.to_pylist()] == [12, 0, 28]
    back, at = lm._unpacked(pa.chunked_array([packed.slice(1), packed.slice(0, 1), pa.nulls(1, pa.binary())]), "<u4")
    assert back.tolist() == [*range(3, 10), 0, 1, 2] and at.tolist() == [0, 0, 7, 10, 10]


def test_token_hashes_follow_words():
    a, sizes = lm.tokens([b"one two  one", b"", b"\ttwo\x0bthree"])
    assert sizes.tolist() == [4, 1, 3] and a[0] == a[2] and a[1] == a[5] and a[3] == a[4] == a[7] and len(set(a.tolist())) == 4


def test_long_words_and_texts_are_hashed_in_chunks(monkeypatch):
    text = b"aa " + b"long" * 40 + b"  bb\t" + b"x" * 64 + b" cc " * 9 + b"end" * 30
    want, places = lm.words(text)
    for size in (1, 7, 16, 64):
        monkeypatch.setattr(lm, "CHUNK", size)
        got, at = lm.words(text)
        assert got.tolist() == want.tolist() and at.tolist() == places.tolist()
        cut = list(lm.pieces(text, size))
        assert b"".join(t for t, _ in cut) == text and [last for _, last in cut] == [False] * (len(cut) - 1) + [True]
        assert [w for t, _ in cut for w in t.split()] == text.split()


def test_pieces_of_texts_score_like_whole_texts(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet").union(spark.createDataFrame([(9001, " " * 900 + "a " * 700, "en", "x", 3), (9002, "\t" * 999, "en", "x", 3)], "doc_id long, text string, lang string, source string, n_chars long"))
    want = {r.doc_id: r for r in lm.score(docs).collect()}
    monkeypatch.setattr(lm, "UNIT", 300)
    got = {r.doc_id: r for r in lm.score(docs).collect()}
    assert got.keys() == want.keys()
    for i, r in got.items():
        assert (r.n_tokens, r.n_known, r.train_tokens) == (want[i].n_tokens, want[i].n_known, want[i].train_tokens)
        assert r.base_score == pytest.approx(want[i].base_score) and r.score == pytest.approx(want[i].score, rel=2e-3)


def exact_scores(docs, strength=300.0):
    """The model with the true level of each count instead of the filter's."""
    words = lambda d: [None, *re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in d.text or "")), None]
    out = lambda d: zlib.crc32(str(d.doc_id).encode()) % 10 == 0
    one, two = Counter(), Counter()
    for d in docs:
        if not out(d):
            one.update(words(d)[1:])
            two.update(zip(words(d), words(d)[1:]))
    mid = lambda n: n if n < 2 else math.sqrt(2) * 2 ** math.floor(math.log2(n))
    n, v = sum(one.values()), len(one)
    for d in docs:
        p = 0
        for h, w in zip(words(d), words(d)[1:]):
            a, b = mid(one[h]), mid(one[w])
            p += math.log10((min(mid(two[h, w]), a, b) + strength * min(1, (b + 0.1) / (n + 0.1 * (v + 1)))) / (a + strength))
        yield d.doc_id, p


@pytest.mark.parametrize("segment", [lm.SEGMENT, 5000])
def test_scores_follow_the_exact_model(spark, sf, monkeypatch, segment):
    monkeypatch.setattr(lm, "SEGMENT", segment)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = dict(exact_scores(docs.collect()))
    got = {r.doc_id: r.score for r in lm.score(docs).collect()}
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) <= 0.005 * abs(want[i]) + 0.01 for i in want)


def test_the_filter_grows_with_the_corpus(spark):
    """The share of bits that are set, and so the false rate, is the same at every size."""
    bits = []
    for folder in ("sf0.001", "sf0.01"):
        docs = spark.read.parquet(f"/root/testdata/{folder}/documents.parquet")
        rows = lm.fill(docs, tokens_=1 << 21).collect()
        assert len(rows) == 4 and all(abs(r.ones / r.bits - 0.1) < 0.01 for r in rows)
        bits.append(sum(r.bits for r in rows))
    assert bits[1] > 3 * bits[0]
