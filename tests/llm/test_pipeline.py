from collections import Counter, defaultdict

import corpus_pipeline
from lodestar.llm import bpe, mixing, quality, queries, simhash
from tests.llm.fixtures import documents
from tests.llm.test_mixing_sharding_simhash import brute_components, shingle_sets, wanted_targets, WORD
from tests.llm.test_texts import digests, library  # noqa: F401


def test_each_stage_against_a_plain_version(spark, sf, library):  # noqa: F811
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stages = [f for _, f in corpus_pipeline.STAGES]
    accepted = stages[0](spark, docs, sf).persist()
    assert accepted.columns == docs.columns
    machine = quality.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    want = {r.doc_id for r in quality.score(docs, machine).collect() if r.predicted}
    assert {r.doc_id for r in accepted.collect()} == want and len(want) < docs.count()

    kept = stages[1](spark, accepted, sf).persist()
    assert kept.columns == docs.columns
    sets = shingle_sets(accepted.collect())
    roots = brute_components(sorted(sets), lambda i, j: len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]))
    assert {r.doc_id for r in kept.collect()} == set(roots.values())

    mix = stages[2](spark, kept, sf).persist()
    assert mix.columns == docs.columns
    size, source = {}, {}
    for r in kept.collect():
        size[r.doc_id], source[r.doc_id] = len(WORD.findall(r.text)), r.source
    sizes, taken = defaultdict(int), defaultdict(int)
    for i, n in size.items():
        sizes[source[i]] += n
    times = Counter(r.doc_id for r in mix.collect())
    assert max(times.values()) <= 2
    for i, n in times.items():
        taken[source[i]] += n * size[i]
    for s, t in wanted_targets(sizes).items():
        assert abs(taken[s] - t) <= max(size[i] for i in size if source[i] == s)

    got = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in stages[3](spark, mix, sf).collect())
    assert got == Counter((r.doc_id, *digests(library, r.text)) for r in mix.collect())
    assert Counter(map(tuple, corpus_pipeline.run(spark, sf).collect())) == got


def test_the_whole_pipeline_takes_awkward_rows(spark, tmp_path, library):  # noqa: F811
    """Texts of one kind are good, of another bad; among them awkward rows, of which no column is lost on the way."""
    good, bad = "a plain sentence about the river and its old stone bridge number %d. ", "%d $$$ CLICK !!! buy buy NOW ### "
    rows = [(100 + i, (bad if i % 2 else good) % i * 6, "en", "abc"[i % 3], None if i == 7 else 90) for i in range(80)]
    awkward = [r for r in documents(spark).collect()]
    docs = documents(spark, rows + [tuple(r)[:5] for r in awkward])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([(100 + i, 1 - i % 2, 0) for i in range(80)] + [(3, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id for r in got if r.doc_id and r.doc_id >= 100} <= {100 + i for i in range(0, 80, 2)} and len(got) > 20
    assert all((r.n_tokens, r.ids_sha256, r.decoded_sha256) == digests(library, texts[r.doc_id]) for r in got if r.doc_id is not None)
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    labels.limit(0).write.parquet(f"{tmp_path}/none/labels.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").collect() == []


def test_stages_take_awkward_rows(spark):
    docs = documents(spark)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 3, 6, 7, 8, 9, None])
    mix = mixing.mixed(docs)
    assert mix.columns == docs.columns
    want = Counter()
    for r in mixing.mix(docs).collect():
        want[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in mix.collect()) == +want
    empty = documents(spark, [])
    assert simhash.keep_one(empty).collect() == mixing.mixed(empty).collect() == []
    assert bpe.round_trip(mixing.mixed(empty), queries.vocabulary()).collect() == []
