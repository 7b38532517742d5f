import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from lodestar.llm import mixing, queries, sharding, simhash
from lodestar.llm.components import components
from tests.llm.fixtures import documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def wanted_targets(sizes):
    """The rule in plain words: deal, stop at twice, deal the excess again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    got, left, live = dict.fromkeys(names, 0.0), 1.5 * sum(sizes.values()), set(names)
    while live and left > 1e-9:
        w = sum(weight[s] for s in live)
        for s in live:
            got[s] += left * weight[s] / w
        left = sum(max(0, got[s] - 2 * sizes[s]) for s in live)
        full = {s for s in live if got[s] >= 2 * sizes[s]}
        for s in full:
            got[s] = 2.0 * sizes[s]
        live -= full
    return got


def check_mix(docs, rows):
    """Each row is taken at most twice, and each source misses its target by less than its longest document."""
    sizes = defaultdict(int)
    for d in docs:
        sizes[d.source] += len(WORD.findall(d.text or ""))
    want, taken, largest = wanted_targets(sizes), defaultdict(int), defaultdict(int)
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in rows) == sorted((d.doc_id is not None, d.doc_id or 0) for d in docs)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken == r.copies * r["size"] and r.taken <= 2 * r["size"]
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] + 1e-6


def test_repeated_rows_meet_their_target(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SPREAD", 8)
    rows = [(100 * s + (i if s % 2 else 0), "w " * (90 + s), "en", f"s{s:02}", 1) for s in range(40) for i in range(20)]
    docs = documents(spark, rows)
    for seed in (42, 1):
        got = mixing.mix(docs, seed=seed).collect()
        check_mix(docs.collect(), got)
    want = Counter()
    for r in got:
        want[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in mixing.mixed(docs, seed=1).collect()) == +want


def test_mix_meets_targets_and_reruns_agree(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for fan_in in (4, 64):
        rows = mixing.mix(docs, fan_in=fan_in).collect()
        check_mix(docs.collect(), rows)
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


def test_mix_is_fair(spark):
    docs = documents(spark, [(i, "w " * (1 + i % 3), "en", "a", 1) for i in range(40)])
    mean = sum(sum(r.copies for r in mixing.mix(docs, share=0.5, seed=s).collect()) for s in range(6)) / 6
    assert 16 < mean < 24


def test_mix_takes_awkward_rows(spark):
    docs = documents(spark)
    check_mix(docs.collect(), mixing.mix(docs).collect())
    assert mixing.mix(documents(spark, [])).collect() == []
    assert {r.taken for r in mixing.mix(documents(spark, [(1, None, None, None, None)])).collect()} == {0}


def check_shards(docs, rows, shards):
    rows = sorted(rows, key=lambda r: r.position)
    assert [r.position for r in rows] == list(range(len(docs)))
    total, start, slots = sum(r["size"] for r in rows), 0, defaultdict(int)
    for r in rows:
        assert r.shard == start * shards // total and r.slot == slots[r.shard] and r.law == "bytes" and r.grown_shard is None
        slots[r.shard] += 1
        start += r["size"]
    want = sorted((len((d.text or "").encode()) + 8, zlib.crc32((d.text or "").encode())) for d in docs)
    assert sorted((r["size"], r.text_crc32) for r in rows) == want


def test_shards(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").repartition(5)
    check_shards(docs.collect(), queries.op5_sharding(spark, sf).collect(), 24)
    check_shards(docs.collect(), sharding.shard_by_bytes(docs, 5).collect(), 5)
    docs = documents(spark)
    check_shards(docs.collect(), sharding.shard_by_bytes(docs, 3).collect(), 3)
    assert sharding.shard_by_bytes(documents(spark, [])).collect() == []


def brute_fingerprint(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(ids, near):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in ids:
        for j in ids:
            if i < j and near(i, j):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in ids}


def test_near_duplicates_match_brute_force(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    fps = {i: brute_fingerprint(t) for i, t in docs.items()}
    want = brute_components(list(docs), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 3)
    got = queries.op8_simhash(spark, sf).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {i: (f"{fps[i]:016x}", want[i]) for i in docs}
    assert any(i != c for i, c in want.items())


def test_fingerprint_links_are_complete(spark):
    import random

    rng = random.Random(7)
    fps = [rng.getrandbits(64) for _ in range(150)]
    for f in fps[:40]:  # chains and dense clouds, up to five bits apart
        for _ in range(8):
            g = f
            for _ in range(rng.randint(1, 5)):
                g ^= 1 << rng.randrange(64)
            fps.append(g)
    fps = sorted({0, *fps})
    ids = {f - (1 << 64) if f >> 63 else f: f for f in fps}
    want = brute_components(sorted(ids), lambda i, j: (ids[i] ^ ids[j]).bit_count() <= 3)
    links = simhash.fingerprint_links(spark.createDataFrame([(i,) for i in ids], "fp long"))
    got = {r.node: r.root for r in components(links).collect()}
    assert {i: got.get(i, i) for i in ids} == want


def shingle_sets(docs, width=5):
    out = {}
    for r in docs:
        words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r.text or ""))
        out[r.doc_id] = {" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else {""}
    return out


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_similar_texts_against_brute_force(spark, size):
    docs = spark.read.parquet(f"/root/testdata/{size}/documents.parquet")
    sets = shingle_sets(docs.collect())
    near = lambda i, j: len(a := sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) if len(sets[i]) >= 0.8 * len(sets[j]) >= 0.64 * len(sets[i]) else False  # noqa: E731, F841
    want = brute_components(sorted(sets), near)
    kept = {r.doc_id for r in simhash.keep_similar(docs).collect()}
    assert kept == set(want.values())  # nothing is joined without a link, and no link is lost


@pytest.mark.parametrize("index", [True, False])
def test_no_link_is_lost_at_the_similarity(spark, monkeypatch, index):
    """Pairs right at 0.8 and just below, a chain, and a passage that most of many texts consist of; with the index of wide
    fingerprints and without its candidates."""
    import random

    rng = random.Random(11)
    new = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    texts, common = [], new(60)
    for i in range(120):
        n = rng.randint(45, 90)
        one = new(n)
        cut = round(n / 9) - 2 + i % 4  # words changed at the end change as many shingles
        texts += [one, one[:-cut] + new(cut)]
    link = new(60)
    for _ in range(12):
        link = link[3:] + new(3)
        texts.append(link)
    texts += [common + new(rng.randint(4, 16)) for _ in range(60)]
    rng.shuffle(texts)
    docs = documents(spark, [(i, " ".join(t), "en", "a", 9) for i, t in enumerate(texts)])
    if not index:
        monkeypatch.setattr(simhash, "candidates", lambda nodes, *_: nodes.where("false").selectExpr("node a", "node b", "0 apart"))
    monkeypatch.setattr(simhash, "ASKED", 2)
    monkeypatch.setattr(simhash, "BLOCK", 1000)
    sets = shingle_sets(docs.collect())
    want = brute_components(sorted(sets), lambda i, j: 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]))
    assert 60 < len(want) - len(set(want.values())) < 250
    assert sorted(r.doc_id for r in simhash.keep_similar(docs).collect()) == sorted(set(want.values()))


def near_copies(rng, n, words, changed):
    """Texts with so many words of one text changed, and a copy of every tenth that is linked to it."""
    new = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    base, out = new(words), []
    for i in range(n):
        one = list(base)
        for at in rng.sample(range(words), changed):
            one[at : at + 1] = new(1)
        out += [one, one[:-1] + new(1)] if i % 10 == 0 else [one]
    return out


def test_rows_of_pairs_do_not_grow_with_the_square_of_a_group(spark, monkeypatch):
    """Near copies that are not quite similar meet in most lists of a prefix, but hardly any of their pairs become rows."""
    import random

    made, real = spark.sparkContext.accumulator(0), type(spark.range(0)).mapInArrow

    def counted(self, f, schema, *more, **named):
        def rows(it):
            for batch in f(it):
                made.add(batch.num_rows)
                yield batch

        return real(self, rows if f.__name__ == "pairs" else f, schema, *more, **named)

    monkeypatch.setattr(type(spark.range(0)), "mapInArrow", counted)
    rng = random.Random(5)
    texts = near_copies(rng, 150, 144, 3) + near_copies(rng, 20, 2500, 60)
    rng.shuffle(texts)
    docs = documents(spark, [(i, " ".join(t), "en", "a", 9) for i, t in enumerate(texts)])
    sets = shingle_sets(docs.collect())
    want = brute_components(sorted(sets), lambda i, j: 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]))
    assert 100 < len(set(want.values())) < len(want) - 10
    assert sorted(r.doc_id for r in simhash.keep_similar(docs).collect()) == sorted(set(want.values()))
    assert 0 < made.value < 10 * len(texts)


def test_parities_never_tell_more_than_sets_differ():
    rng = np.random.default_rng(4)
    for n in [0, 1, 9, 144, 900, 7000] * 20:
        x, y = (np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for _ in range(2))
        y = np.unique(np.concatenate([x[rng.random(len(x)) < 0.9], y[: rng.integers(0, n + 1)]]))
        apart = len(np.setxor1d(x, y))
        wide = [simhash.parities(v, max(simhash.PARITIES, 1 << (len(v) // 2).bit_length())) for v in (x, y)]
        assert simhash.disagree(*wide) <= apart >= simhash.disagree(simhash.parities(x), simhash.parities(y))
        assert apart > n / 2 or simhash.disagree(*wide) >= 0.7 * apart - 3


def test_prefixes_of_similar_sets_meet():
    rng = np.random.default_rng(3)
    often = np.zeros(300, [("kind", "<u8"), ("n", "<i8")])
    often["kind"], often["n"] = np.arange(300), rng.integers(3, 9, 300)
    for _ in range(2000):
        x = np.unique(rng.integers(0, 900, rng.integers(1, 60))).astype("<u8")
        y = np.unique(np.concatenate([x[rng.random(len(x)) < 0.9], rng.integers(0, 900, 2).astype("<u8")]))
        both = len(np.intersect1d(x, y))
        if 5 * both >= 4 * (len(x) + len(y) - both):
            assert len(np.intersect1d(simhash.prefix(x, 0.8, often), simhash.prefix(y, 0.8, often)))


def test_similar_texts_take_awkward_rows(spark):
    docs = documents(spark)
    kept = simhash.keep_similar(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 3, 6, 7, 8, 9, None])
    assert simhash.keep_similar(documents(spark, [])).collect() == []


def test_plans_of_wide_fingerprints():
    lists, bits, matches, radius = simhash.plan(200_000, 0.8)
    assert bits == 0 and 100 < lists < 200 and 5 <= matches < 10 and 90 < radius < 110
    assert simhash.plan(1 << 26, 0.8)[1] == 6


def test_near_duplicates_take_awkward_rows(spark):
    got = simhash.near_duplicates(documents(spark)).collect()
    assert len(got) == 13
    by = defaultdict(set)
    for r in got:
        by[r.doc_id].add((r.fingerprint, r.component_id))
    assert by[1] == by[2] == by[10] and {c for _, c in by[1]} == {1}
    assert by[3] == by[4] == by[5] == {("0" * 16, 3)} and ("0" * 16, 3) in by[None]
    assert simhash.near_duplicates(documents(spark, [])).collect() == []
    alone = simhash.near_duplicates(documents(spark, [(None, "a b", None, None, None)])).collect()
    assert alone[0].component_id is None


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 160)] + [(5, None), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(2, 61)}, **{i: 100 for i in range(101, 160)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
