"""Operators against plain Python on small rows."""

import datetime as dt
import hashlib
import json
import math
import random
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from lodestar.functions import text as T
from lodestar.operators import behaviour as B
from lodestar.operators import checks as C
from lodestar.operators import contracts, hybrid, ltr, ranking, statistics
from lodestar.operators import extraction as X
from lodestar.operators import graph as G
from lodestar.operators import search as S
from lodestar.plans import prepare
from lodestar.sources import files, providers
from lodestar.streaming import attribution
from pyspark.sql import functions as F

DAY = dt.datetime(2024, 1, 1)


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "c string").select(f(F.col("c")).alias("o")).first().o


def test_asof_join_equals_brute_force(spark):
    rng = random.Random(4)
    qs = [(rng.randint(0, 5) or None, f"q{i:03}", DAY + dt.timedelta(minutes=rng.randint(0, 6000))) for i in range(200)]
    es = [(rng.randint(0, 5) or None, str(i), DAY + dt.timedelta(minutes=rng.randint(0, 6000))) for i in range(300)]
    q = spark.createDataFrame(qs, "talent_key int, query_id string, query_time timestamp_ntz")
    e = spark.createDataFrame(es, "talent_key int, job_id string, event_time timestamp_ntz")
    got = {r.job_id: r.query_id for r in B.asof_join(e, q, "talent_key", "event_time", "query_time", "query_id").collect()}
    want = {j: max(((t, i) for k, i, t in qs if k == key and t <= at), default=(None, None))[1] for key, j, at in es if key}
    assert got == want


def test_text_functions(spark):
    assert one(spark, " Ｃ＋＋，Straße  x ", T.normalise) == "c++,strasse x"
    assert one(spark, "Go c++ 資料庫x", T.tokens) == ["go", "c++", "x", "資", "料", "庫"]
    assert one(spark, "a go 資料庫", T.search_tokens) == ["go", "資", "料", "庫", "資料", "料庫", "資料庫"]
    assert one(spark, "資料庫 工程", T.query_terms) == ["資料庫", "工程"]
    assert one(spark, "a, b；c\na ,, NULL", lambda c: T.split_values(c, ("null",))) == ["a", "b", "c"]
    assert one(spark, "　NULL　", T.clean) is None
    assert one(spark, '```json\n{"a":[1,2,],}\n``` ok', T.repaired_json) == '{"a":[1,2]}'
    assert len(one(spark, "x y", T.hash_embedding)) == 32 and sum(v * v for v in one(spark, "x y", T.signed_hash_embedding)) == pytest.approx(1)


@settings(max_examples=60, deadline=None)
@given(st.text("ab c漢會Pytho", max_size=40))
def test_phrases_never_overlap_and_keep_borders(text):
    import ahocorasick

    machine = ahocorasick.Automaton()
    for p in ("a", "ab", "ab c", "python", "漢"):
        machine.add_word(p, p)
    machine.make_automaton()
    end, whole = 0, text
    text = " ".join(text.split()).casefold()
    for phrase, start, stop in X.find_phrases(whole, machine):
        assert start >= end and text[start:stop] == phrase
        end = stop
        if re.search("[a-z]", phrase):
            assert not (start and text[start - 1].isalnum()) and not text[stop : stop + 1].isalnum()


def test_canonicalise_equals_a_sequential_pass(spark):
    rng, aliases = random.Random(9), {"js": "JavaScript", "ecma": "Javascript", "py": "Python"}
    words = ["js", "ecma", "py", "Python", "python", "PYTHON", "javascript", "JAVASCRIPT", "Go", "go"]
    rows = [(j, p, rng.choice(words)) for j in range(60) for p in range(4)]
    current, names, want = {}, set(), {}
    for j, p, raw in rows:
        n = raw.casefold()
        if n in aliases:
            name = aliases[n]
        else:
            name = current.get(n, raw)
        if name not in names:
            names.add(name)
            current[name.casefold()] = name
        want[j, p] = name
    got = X.canonicalise(spark.createDataFrame(rows, "job_id int, pos int, raw string"), spark.createDataFrame(list(aliases.items()), "alias string, target string"))
    assert {(r.job_id, r.pos): r.selected for r in got.collect()} == want
    with pytest.raises(ValueError):
        X.assert_protected({"java": "JavaScript", "javascript": "JavaScript"})


def test_metrics_bounds_and_values(spark):
    rows = [("q", "a", 2, 3.0), ("q", "b", 0, 2.0), ("q", "c", 1, 1.0), ("r", "a", 0, 1.0)]
    df = spark.createDataFrame(rows, "query_id string, job_id string, relevance int, score double")
    got = {r.query_id: r for r in ranking.metrics(df, 2).collect()}
    assert got["q"].ndcg == pytest.approx(3 / (3 + 0.6309297535714575)) and got["q"].precision == 0.5 and got["q"].mrr == 1
    assert (got["r"].ndcg, got["r"].mrr, got["r"].hit) == (0, 0, 0)
    with pytest.raises(ValueError):
        ranking.metrics(df, 0)


def test_ranker_learns(spark, tmp_path):
    rng = random.Random(2)
    rows = [(str(q), str(i), (r := rng.choice((0, 0, 1, 2))), r + rng.random(), rng.random()) for q in range(30) for i in range(8)]
    df = spark.createDataFrame(rows, "query_id string, job_id string, relevance int, good double, noise double")
    model = ltr.fit(df, ["good", "noise"], trees=6, rate=0.3)
    mean = lambda d: ranking.mean_metrics(ranking.metrics(d, 5)).first().ndcg
    assert mean(model.score(df)) > mean(df.withColumn("score", F.col("noise"))) + 0.1
    assert list(model.importance())[0] == "good"
    model.save(spark, f"{tmp_path}/ranker")
    again = ltr.Ranker.load(spark, f"{tmp_path}/ranker")
    key = lambda m: sorted((r.query_id, r.job_id, round(r.score, 12)) for r in m.score(df).collect())
    assert again.features == model.features and key(again) == key(model)


def test_lambdas_equal_brute_force(spark):
    rng = random.Random(8)
    rows = [(q, i, rng.choice((0, 1, 2)), rng.random()) for q in range(6) for i in range(7)] + [(9, 0, 0, 0.5), (9, 1, 0, 0.1)]
    df = spark.createDataFrame(rows, "query_id int, job_id int, relevance int, score double")
    want, gain = {}, (0.0, 1.0, 3.0)
    for q in {r[0] for r in rows}:
        docs = sorted((r for r in rows if r[0] == q), key=lambda r: (-r[3], r[1]))
        ideal = sum(gain[g] / math.log2(i + 2) for i, g in enumerate(sorted((r[2] for r in docs), reverse=True)))
        for i, a in enumerate(docs):
            for j, b in enumerate(docs):
                if a[2] > b[2] and ideal:
                    delta = abs((gain[a[2]] - gain[b[2]]) * (1 / math.log2(i + 2) - 1 / math.log2(j + 2))) / ideal
                    rho = 1 / (1 + math.exp(a[3] - b[3]))
                    for doc, sign in ((a, 1), (b, -1)):
                        old = want.get((q, doc[1]), (0.0, 0.0))
                        want[q, doc[1]] = (old[0] + sign * rho * delta, old[1] + rho * (1 - rho) * delta)
    got = {(r.query_id, r.job_id): (r["lambda"], r.weight) for r in ltr.lambdas(df).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_bootstraps_agree(spark):
    rng = random.Random(3)
    rows = [(q, rng.random(), rng.random() + 0.1) for q in range(300)]
    df = spark.createDataFrame(rows, "query_id int, a double, b double")
    one, two = df.select("query_id", F.col("a").alias("ndcg")), df.select("query_id", F.col("b").alias("ndcg"))
    want, got = ranking.paired_bootstrap(one, two, rounds=1000), ranking.bootstrap(one, two, rounds=1000).first()
    assert got.difference == pytest.approx(want["difference"]) and abs(got.ci_low - want["ci_low"]) < 0.01 and abs(got.ci_high - want["ci_high"]) < 0.01
    for f in (ranking.bootstrap, ranking.paired_bootstrap):
        with pytest.raises(ValueError):
            f(one.union(one), two)
    with pytest.raises(ValueError):
        ranking.paired_bootstrap(one, two, most=10)


def test_indexes_and_phrases(spark, tmp_path):
    docs = spark.createDataFrame([(1, "node.js and c++", "x", "y"), (2, "c", "x", "z"), (3, "", None, None)], "doc_id int, text string, location string, duty string")
    S.build_index(docs, T.latin_tokens(F.col("text")), f"{tmp_path}/index")
    held = S.open_index(spark, f"{tmp_path}/index")
    stats = held.stats().first()
    assert (stats.n, stats.avg_length) == (3, pytest.approx(4 / 3))
    queries = spark.createDataFrame([(7, ["c"], ["x"], ["z", "w"])], "query_id int, terms array<string>, location array<string>, duty array<string>")
    got = S.search(queries, held, 5).first()
    assert got.doc_id == 2 and got.score == pytest.approx(got.lexical_score + 0.85, abs=1e-6)
    S.build_index(docs, T.latin_tokens(F.col("text")), f"{tmp_path}/few", limit=2)
    assert S.open_index(spark, f"{tmp_path}/few").docs.count() == 2 and S.nothing(spark).collect() == []
    assert one(spark, "Node.js", T.fts_parts) == ["node", "js"] and one(spark, "Café#", T.fts_parts) == ["cafe"]
    assert one(spark, "x node js y", lambda c: T.has_phrase(F.split(c, " "), F.array(F.lit("node"), F.lit("js")))) and not one(spark, "js node", lambda c: T.has_phrase(F.split(c, " "), F.array(F.lit("node"), F.lit("js"))))
    assert one(spark, "ab", T.display_name) == "ab" and one(spark, "\u3000Ａ ", T.display_name) == "A"


def test_feature_frames(spark):
    from lodestar.plans import catalog

    queries, held, jobs, g = catalog._order_search(spark, "/root/testdata/sf0.001")
    queries, jobs = queries.where("query_id < 3"), jobs.where("job_id < 20")
    labels = queries.select("query_id", F.lit(5).cast("long").alias("job_id"), F.lit(1).alias("relevance"), F.lit(2).alias("original_rank"))
    few = hybrid.labelled_features(labels, queries, jobs, g.nodes, g.edges).collect()
    every = {(r.query_id, r.job_id): r for r in hybrid.all_features(queries, jobs, g.nodes, g.edges, labels).collect()}
    assert len(few) == 3 and len(every) == 3 * jobs.count() and {r.relevance for r in every.values()} == {0, 1}
    assert all(every[r.query_id, r.job_id][c] == pytest.approx(r[c]) for r in few for c in hybrid.PLAIN + hybrid.GRAPH)
    with pytest.raises(ValueError):
        hybrid.all_features(queries, jobs, g.nodes, g.edges, most=10)
    with pytest.raises(ValueError):
        hybrid.labelled_features(labels.withColumn("job_id", F.lit(-1).cast("long")), queries, jobs, g.nodes, g.edges)
    sets = {n: ranking.metrics(labels.withColumn("score", F.lit(float(i)))) for i, n in enumerate("ABCD")}
    assert "| D | ranker | 1.000000 |" in hybrid.ablation_report(sets, ranking.bootstrap(sets["C"], sets["D"], rounds=50))


def test_parse_and_features(spark):
    nodes = spark.createDataFrame([("s1", "Skill", "machine learning"), ("s2", "Skill", "learning"), ("s3", "Skill", "ml"), ("a1", "SkillAlias", "ml"), ("o1", "Occupation", "engineer")], "node_id string, label string, name string")
    edges = spark.createDataFrame([("a1", "s1", "ALIAS_OF")], "from_id string, to_id string, label string")
    queries = spark.createDataFrame([("1", "Machine Learning engineer Taipei", DAY, "100", "b,a"), ("2", "ml", DAY, None, None), ("3", " cooking ", DAY, None, None)], "query_id string, query string, query_time timestamp_ntz, location_code string, occupation_code string")
    parsed = hybrid.parse_queries(queries, hybrid.vocabulary(nodes, edges))
    got = {r.query_id: r for r in parsed.collect()}
    assert (got["1"].skills, got["1"].occupation, got["1"].unresolved) == (["s1"], "o1", []) and got["2"].skills == ["s1"] and got["3"].unresolved == ["cooking"]
    assert {tuple(r) for r in hybrid.occupations(parsed, queries).collect()} == {("1", "occupation:a")}
    jobs = spark.createDataFrame([("j1", "machine engineer", "learning", "", DAY, "100", "a", 100.0), ("j2", None, None, None, None, None, None, None)], "job_id string, title string, requirements string, description string, posted_at timestamp_ntz, location_code string, occupation_code string, salary_min double")
    pairs = spark.createDataFrame([("1", "j1", 1, 2), ("1", "j2", 0, None)], "query_id string, job_id string, relevance int, original_rank int")
    traces = spark.createDataFrame(
        [("1", "job:j1", "s1", ["REQUIRES"], 0.5), ("1", "job:j1", "s2", ["CO_OCCURS_WITH", "PREFERS"], 0.1), ("1", "job:j1", "o1", ["INSTANCE_OF"], 1.0)],
        "query_id string, job string, anchor string, edge_types array<string>, score double",
    )
    rows = {r.job_id: r for r in hybrid.pair_features(pairs, queries, jobs, traces).collect()}
    j1, j2 = rows["j1"], rows["j2"]
    assert (j1.location_match, j1.duty_code_match, j1.freshness_score, j1.title_overlap, j1.description_overlap, j1.original_rank_reciprocal) == (1, 1, 1, 0.5, 0.25, 0.5)
    assert j1.bm25_score == pytest.approx(3 * math.log(1 + 1.5 / 1.5) * 2.5 / (1 + 1.5 * (0.25 + 0.75 * 3 / 1.5))) and j1.dense_score == pytest.approx(3 / math.sqrt(12))
    assert (j1.graph_score, j1.exact_skill_count, j1.one_hop_skill_count, j1.required_match_weight, j1.preferred_match_weight, j1.occupation_match) == (pytest.approx(1.6), 1, 1, 0.5, 0, 1)
    assert j1.best_path_score == 1 and j1.mean_path_score == pytest.approx(1.6 / 3) and j1.salary_min_log == pytest.approx(math.log(101)) and j1.salary_max_log == 0
    assert all(j2[c] == 0 for c in hybrid.PLAIN + hybrid.GRAPH)
    hybrid.require_finite(hybrid.pair_features(pairs, queries, jobs, traces))
    found = pairs.select("query_id", F.concat(F.lit("job:"), "job_id").alias("job"))
    top = hybrid.rerank(pairs.withColumn("lexical_score", F.lit(1.0)), found, queries, jobs, traces, 5).collect()
    assert [r.job_id for r in sorted(top, key=lambda r: r["rank"])] == ["j1", "j2"]


def test_graph_of_mentions(spark):
    rows = [(1, "React", "ReactJS", "Framework", "required"), (2, "react", "react", "Framework", "mentioned"), (2, "Go", "Go", "Language", "preferred")]
    js = spark.createDataFrame(rows, "job_id int, skill string, raw_mention string, skill_type string, requirement string").withColumns({"occupation_code": F.lit(" 7 "), "importance": F.lit(1.0), "confidence": F.lit(0.5)})
    jobs = spark.createDataFrame([(1, " 7 ", "2024-01-02", 't"'), (2, " 7 ", "2024-01-01", None)], "job_id int, occupation_code string, posted_at string, title string")
    js = js.join(jobs.select("job_id", "posted_at"), "job_id")
    n, ids = G.nodes(jobs, js), {}
    for r in n.collect():
        ids[r.label, r.name or r.job_id] = r.node_id
        if r.label == "Skill":
            assert r.first_seen_at == "2024-01-01" and r.train_frequency == (2 if r.name == "React" else 1)
        if r.job_id == "1":
            assert r.source_hash == files.stable_hash({"title": 't"', "requirements": "", "description": ""})
    sha = lambda s, k: hashlib.sha256(s.encode()).hexdigest()[:k]
    react, go = f"skill:{sha('react|Framework', 16)}", f"skill:{sha('go|Language', 16)}"
    assert ids["Skill", "React"] == react and ("Skill", "react") not in ids and ids["SkillAlias", "ReactJS"] == f"alias:{sha('reactjs', 16)}" and ids["SkillCategory", "Framework"] == "category:framework"
    pairs = spark.createDataFrame([(go, react, 0.5)], "skill_a string, skill_b string, npmi double")
    core = spark.createDataFrame([("7", go, 0.5)], "occupation_code string, skill string, core_skill_weight double")
    e = G.edges(jobs, js, pairs, core, "a", "b")
    got = {(r.label, r.from_id, r.to_id): r for r in e.collect()}
    assert got["REQUIRES", "job:1", react].edge_id == sha(f"job:1|REQUIRES|{react}|1:reactjs", 20) and got["CORE_SKILL", "occupation:7", go].weight == 0.5
    assert got["CO_OCCURS_WITH", *sorted((go, react))].edge_id == sha(f"{min(go, react)}|CO_OCCURS_WITH|{max(go, react)}|a|b", 20) and ("ALIAS_OF", ids["SkillAlias", "ReactJS"], react) in got
    t = G.paths(e, spark.createDataFrame([(1, go)], "query_id int, skill_id string"), occupations=spark.createDataFrame([(1, "occupation:7")], "query_id int, occupation string"))
    scores = {r.job: r for r in G.candidates(t).collect()}
    assert scores["job:2"].score == pytest.approx(0.36 + 0.5 * 0.225 * 0.7 + 1) and scores["job:1"].score == pytest.approx(0.5 * 0.5 * 0.7 + 1) and scores["job:2"].anchors == 2
    told = {r.explanation for r in G.explained(t, n).collect()}
    assert "Go matched React; path uses CO_OCCURS_WITH -> REQUIRES" in told and "Occupation constraint matched the job occupation." in told


def test_structured_records(spark):
    jobs = spark.createDataFrame(
        [(1, "Python；python, NULL", "PMP", "sales", " ", "train", "uses  Ｐｙｔｈｏｎ and Sales"), (2, "python", None, None, "7", "train", "PMP pmp"), (3, None, None, None, None, "test", None)],
        "job_id int, computer_skills string, certifications string, work_skills string, occupation_code string, data_split string, text string",
    )
    words = X.field_lexicon(jobs)
    assert {(r.phrase, r.display, r.skill_type) for r in words.collect()} == {("python", "Python", "ProgrammingLanguage")}
    found = X.phrase_evidence(jobs.select("job_id", "text"), spark.createDataFrame([("pmp", "PMP", "Certification"), ("sales", "sales", "BusinessSkill")], "phrase string, display string, skill_type string"))
    got = [(r.job_id, r.raw, r.skill_type, r.importance) for r in X.structured_mentions(jobs, found).orderBy("job_id", "field", "pos").collect()]
    assert got == [(1, "Python", "ProgrammingLanguage", 0.9), (1, "PMP", "Certification", 0.85), (1, "sales", "BusinessSkill", 0.8), (2, "python", "ProgrammingLanguage", 0.9), (2, "PMP", "Certification", 0.7)]
    made = X.records(jobs, X.structured_mentions(jobs, most=1))
    assert [(r.job_id, r.occupation_candidate or "", len(r.skills)) for r in made.orderBy("job_id").collect()] == [("1", " ", 1), ("2", "7", 1), ("3", "", 0)]
    assert X.coverage(made).first().coverage == pytest.approx(2 / 3)


def test_resolve_equals_brute_force(spark):
    raws, known = ["java script", "java", "go lang"], ["JavaScript", "java lang", "script", "golang", "Java"]
    r = spark.createDataFrame([(x,) for x in raws * 2], "raw string")
    got = {x.raw: x for x in X.resolve(r, spark.createDataFrame([(x,) for x in known], "skill string"), lambda a, b: ("same_skill", 0.95) if "lang" in b else ("ambiguous", 0.5), block=2).collect()}

    def embed(s):
        out = [0.0] * 32
        for t in re.findall(r"[\w.+#-]+", s.casefold()):
            out = [a + b / 127.5 - 1 for a, b in zip(out, hashlib.sha256(t.encode()).digest())]
        n = math.sqrt(sum(x * x for x in out))
        return [x / n for x in out]

    for raw in raws:
        want = sorted(known, key=lambda k: (-round(sum(a * b for a, b in zip(embed(raw), embed(k))), 8), k))
        assert got[raw].candidates == want and got[raw].selected == next(w for w in want if "lang" in w)
    assert X.rule_verifier("Java", "javascript") == ("related_but_distinct", 1.0)


def test_guards_and_contracts(spark):
    for target in ("/", "/in", "/in/x", "/"):
        with pytest.raises(ValueError):
            files.guard(target, ["/in"])
    files.guard("/out", ["/in"])
    assert contracts.request("  a ", ["1", "1", " "]) == {"query": "a", "locations": ["1"], "duties": None}
    with pytest.raises(ValueError):
        contracts.check_ranked([(1, "a"), (3, "b")])
    with pytest.raises(ValueError):
        statistics.require_train(spark.createDataFrame([("test",)], "data_split string"))
    with pytest.raises(ValueError):
        prepare.Config("2024-02-01", "2024-01-01")
    cycle = spark.createDataFrame([("a", "b", "ALIAS_OF"), ("b", "c", "ALIAS_OF"), ("c", "a", "ALIAS_OF"), ("d", "a", "ALIAS_OF")], "from_id string, to_id string, label string")
    chain = spark.createDataFrame([(f"x{i}", f"x{i + 1}") for i in range(9)], "from_id string, to_id string").withColumn("label", F.lit("ALIAS_OF"))
    assert {r.node_id for r in C.reaching_cycles(cycle.unionByName(chain)).collect()} == {"a", "b", "c", "d"}
    with pytest.raises(ValueError):
        G.require_one_version(spark.createDataFrame([("a", 1), ("a", 2)], "node_id string, n int"), "node_id")
    assert G.require_one_version(spark.createDataFrame([("a", 1), ("a", 1)], "node_id string, n int"), "node_id").count() == 1
    known = spark.createDataFrame([("1", "train"), ("2", "test")], "job_id string, data_split string")
    G.require_known_jobs(known.select("job_id").limit(1), known.where("job_id = '1'"))
    for mentions, jobs in ((known, known), (known, known.where("job_id = '1'")), (known.limit(0), known.union(known).where("job_id = '1'"))):
        with pytest.raises(ValueError):
            G.require_known_jobs(mentions, jobs)


def test_graph_report(spark):
    from lodestar.plans import fixtures

    g = fixtures.faulty_graph(spark, "/root/testdata/sf0.001")
    out, text = C.report(C.Graph(g.nodes.where("label != 'Job' or node_id in ('late', 'dup')"), g.edges.where("label in ('ALIAS_OF', 'LIKES')"), rules=C.Rules(policies={"super_node": "fail"})), most=5)
    assert out["status"] == "failed" and len(out["findings"]) == 5 and out["finding_counts"]["invalid_edge_labels"] == 2 and "`failed`" in text


def test_providers(spark, tmp_path):
    jobs = spark.createDataFrame([("1", "t", "r", "d"), ("2", "t", "r", "d")], "job_id string, title string, requirements string, description string")
    first = providers.extract(jobs, providers.mock({"1": "one"}), attempts=1).collect()
    assert {r.job_id: (r.body, bool(r.error)) for r in first} == {"1": ("one", False), "2": (None, True)}
    cache = spark.createDataFrame([(r.key, "cached") for r in first], "key string, body string")
    assert {r.body for r in providers.extract(jobs, providers.mock({}), cache).collect()} == {"cached"}
    asked = {r.job_id: r for r in providers.requests(jobs).collect()}
    assert [asked[r.job_id].key for r in first] == [r.key for r in first] and "JOB_ID: 1" in json.loads(asked["1"].body)["messages"][0]["content"]
    record = '{"job_id":"1","skills":[],"extraction_prompt_version":"v"}'
    shapes = {"plain": "plain", record: record, '{"output":{"message":{"content":[{"text":"a"}]}}}': "a", '{"content":[{"text":"b"}]}': "b", '{"body":"c"}': "c", '{"other":1}': None}
    assert {k: one(spark, k, providers.unwrapped) for k in shapes} == shapes
    nodes = spark.createDataFrame([("s", "Skill", "Go", "Language", None, None), ("o", "Occupation", None, None, "7", "7"), ("j", "Job", None, None, None, None)], "node_id string, label string, canonical_name string, skill_type string, name string, occupation_code string").withColumn("description", F.lit(""))
    made = providers.embed(nodes, T.hash_embedding)
    assert {r.node_id: (r.embedding_text, len(r.embedding)) for r in made.collect()} == {"s": ("Go | Language", 32), "o": ("7 | 7", 32)} and providers.embedding_manifest(made).first().row_count == 2
    with pytest.raises(Exception, match="components"):
        providers.embed(nodes, T.hash_embedding, dimension=8).collect()
    providers.dead_letters(spark.createDataFrame(first), f"{tmp_path}/failed")
    assert [r.job_id for r in spark.read.json(f"{tmp_path}/failed").collect()] == ["2"]
    calls = []
    with pytest.raises(KeyError):
        providers.with_retry(lambda t: calls.append(t) or {}["x"], "a", sleep=lambda s: None)
    assert len(calls) == 3


def test_prepare_end_to_end(spark, tmp_path):
    put = lambda name, text: (tmp_path / name).write_text(text, encoding="utf-8") and str(tmp_path / name)
    [
        put("s.csv", '﻿talentNo,ks,c0,d0,search_time,empStr\n7,java,1,2,2024-01-01 10:00:00,"11,12,13"\n0,go,1,2,2024-01-02 10:00:00,"11"\n0,go,1,2,2024-01-02 10:00:00,"11"\n8,,1,2,2024-01-02 10:00:00,"11"\n'),
        put("b.csv", "organNo,employeeNo,dateIn,talentNo\n1,12,2024-01-01 10:30:00,7\n1,11,2024-01-01 11:30:00,7\n"),
        put("a.csv", "LogTitle,empNo,empName,talentNo,datein\nx,13,n,7,2024-01-01 20:00:00\n"),
        put("c.csv", "CodeNo,CodeNameA,CodeNameB,CodeNameC,CodeType,CodeArea,CodeZip\n1,X,,,2,,\n"),
        put("d.csv", "CodeNo,CodeNameA,CodeNameB,CodeNameC,CodeDescript,CodeAlike,CodeDefinition,CodeNameEN\n2,Y,,,,,,\n"),
    ]
    columns = {"job_id": "id", "title": "name", "description": "text", "location_code": "city", "duty_minor": "duty", "last_modified_at": "mod"}
    put("j.csv", "id,name,text,city,duty,mod\n11,A,x,X,Y,2023-01-01\n12,B,,Z,,2023-01-01\n13,C,,X ,NULL,2024-01-01 12:00:00\n14,D,,,,2023-01-01\n15,E,,,,never\n")
    cfg = prepare.Config("2024-02-01", "2024-03-01", "2024-04-01", jobs_scope="exposed", strict=False)
    made = prepare.prepare(spark, str(tmp_path), f"{tmp_path}_out", cfg, columns)
    profile = made["profile"]["canonical"]
    assert (profile["queries"]["row_count"], profile["jobs"]["row_count"], profile["labels"]["relevance_1"], profile["labels"]["relevance_2"]) == (3, 3, 1, 1)
    rows = {r.job_id: r for r in spark.read.parquet(f"{tmp_path}_out/labels.parquet").collect()}
    assert rows["12"].content_available_at_query and not rows["13"].content_available_at_query and rows["13"].data_split == "train"
    jobs = {r.job_id: r for r in spark.read.parquet(f"{tmp_path}_out/jobs.parquet").collect()}
    assert (jobs["11"].location_code, jobs["11"].occupation_code, jobs["13"].location_code, jobs["13"].occupation_code, jobs["12"].location_code) == ("1", "2", "1", "", "Z")
    queries = spark.read.parquet(f"{tmp_path}_out/queries.parquet")
    assert queries.select("query_id").distinct().count() == 3 and queries.columns == list(prepare.QUERIES)
    assert not any("talent" in c for t in made["outputs"].values() for c in spark.read.parquet(t).columns)
    assert (tmp_path.parent / f"{tmp_path.name}_out" / "dataset_profile.json").exists()
    raw = prepare.profile_raw(spark, str(tmp_path), cfg, columns)
    assert raw["search"]["exposure_count"] == 6 and raw["search"]["empty_query"] == 1 and raw["jobs"]["modified_after_behavior_period"] == 0 and raw["files"]["browse"]["header"][0] == "organNo"
    with pytest.raises(Exception, match="(?i)exist"):
        prepare.prepare(spark, str(tmp_path), f"{tmp_path}_out", cfg, columns)


def test_streams(spark, tmp_path):
    q = spark.createDataFrame([(1, "q1", DAY, "5,6")], "talent_key int, query_id string, query_time timestamp, exposed_jobs string")
    e = spark.createDataFrame([(1, "5", DAY + dt.timedelta(minutes=5)), (1, "5", DAY + dt.timedelta(hours=3)), (1, "9", DAY)], "talent_key int, job_id string, event_time timestamp")
    q.write.parquet(f"{tmp_path}/q")
    e.write.parquet(f"{tmp_path}/e")
    read = lambda n, d: spark.readStream.schema(d.schema).parquet(f"{tmp_path}/{n}")
    run = attribution.attribute_stream(read("e", e), read("q", q)).writeStream.format("memory").queryName("matched").option("checkpointLocation", f"{tmp_path}/c").start()
    run.processAllAvailable()
    run.stop()
    assert Counter((r.query_id, r.job_id) for r in spark.table("matched").collect()) == {("q1", "5"): 1}


def test_last_touch_on_a_stream_equals_the_batch(spark, tmp_path):
    """Rows come out of order and in two lots; the stream gives what the batch operator gives for all that the watermark passed."""
    rng = random.Random(5)
    rows = []
    for i in range(300):
        user, at = str(rng.randint(0, 4)), DAY + dt.timedelta(seconds=rng.randint(0, 40_000))
        if i % 3:
            rows.append(("event", user, at, None, None, str(rng.randint(0, 5))))
        else:
            rows.append(("query", user, at, f"q{i:03}", ",".join(str(rng.randint(0, 5)) for _ in range(4)), None))
    rows.append(("query", "9", DAY + dt.timedelta(days=2), "end", "", None))
    log = spark.createDataFrame(rows, attribution.LOG)
    for i, lot in enumerate((rows[:150], rows[150:])):
        spark.createDataFrame(lot, attribution.LOG).coalesce(1).write.parquet(f"{tmp_path}/log/lot{i}")
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/log")
    run = attribution.last_touch_stream(stream, "1 hour", "1 day").writeStream.format("memory").queryName("last").option("checkpointLocation", f"{tmp_path}/c").start()
    run.processAllAvailable()
    run.stop()
    queries = log.where("kind = 'query'").select("talent_key", F.col("at").alias("query_time"), "query_id", "exposed_jobs")
    events = log.where("kind = 'event'").select("talent_key", "job_id", F.col("at").alias("event_time"))
    want = Counter((r.talent_key, r.job_id, r.event_time, r.query_id) for r in B.attribute(events, queries, "1 HOUR").collect())
    assert Counter((r.talent_key, r.job_id, r.event_time, r.query_id) for r in spark.table("last").collect()) == want and len(want) > 20


def test_best_jobs_are_those_of_all_paths(spark):
    rng = random.Random(11)
    edges = [(f"job:{j}", f"s{rng.randrange(6)}", rng.choice(("REQUIRES", "PREFERS", "MENTIONS")), rng.choice((None, 0.5, 0.25))) for j in range(40) for _ in range(3)]
    edges += [(f"s{a}", f"s{b}", "CO_OCCURS_WITH", rng.random()) for a in range(6) for b in range(a)] + [(f"job:{j}", f"o{j % 3}", "INSTANCE_OF", None) for j in range(40)]
    e = spark.createDataFrame(edges, "from_id string, to_id string, label string, weight double")
    anchors = spark.createDataFrame([(1, "s0"), (1, "s3"), (2, "s5"), (2, "s5"), (3, "none")], "query_id int, skill_id string")
    named = spark.createDataFrame([(2, "o1"), (3, "o2")], "query_id int, occupation string")
    rows = lambda df: {(r.query_id, r.job): (round(r.score, 8), r.anchors, round(r.best, 8), r.traces, r["rank"]) for r in df.collect()}
    for hops in (1, 2):
        for of in (None, named):
            found = G.best_jobs(e, anchors, 12, hops, occupations=of)
            every = G.paths(e, anchors, hops, occupations=of)
            assert rows(found) == rows(G.candidates(every, 12))
            some = G.paths(e, anchors, hops, occupations=of, among=found)
            kept = every.join(found.select("job").distinct(), "job", "left_semi")
            assert Counter((r.query_id, r.job, tuple(r.path)) for r in some.collect()) == Counter((r.query_id, r.job, tuple(r.path)) for r in kept.collect())
    with pytest.raises(ValueError):
        G.best_jobs(e, anchors, hops=3)


def test_edges_are_sorted_in_pieces_of_one_size(spark, sf, monkeypatch):
    from lodestar.plans import fixtures as fx

    js, jobs = fx.baskets(spark, sf), fx.order_jobs(spark, sf)
    want = sorted(r.edge_id for r in G.edges(jobs, js).collect())
    monkeypatch.setattr(G, "MENTIONS", 1000)
    e = G.edges(jobs, js)
    plan = e._jdf.queryExecution().executedPlan().toString()
    pieces = -(-js.count() // 1000)
    assert f"{pieces}), REPARTITION_BY_NUM" in plan  # as many tasks as there are mentions
    assert "ArrowEvalPython" not in plan  # names are normalised once, not for each mention
    assert sorted(r.edge_id for r in e.collect()) == want


def test_core_skills_are_told_apart_in_pieces_of_one_size(spark, sf, monkeypatch):
    from lodestar.plans import fixtures as fx

    js = fx.baskets(spark, sf)
    want = sorted(map(tuple, statistics.core_skills(js).collect()))
    monkeypatch.setattr(statistics, "ROWS", 1000)
    out = statistics.core_skills(js)
    assert f"{-(-js.count() // 1000)}), REPARTITION_BY_NUM" in out._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, out.collect())) == want


def test_edges_are_not_dealt_out_by_their_ends(spark):
    n = spark.createDataFrame([("j", "Job"), ("s", "Skill"), ("o", "Occupation")], "node_id string, label string")
    e = spark.createDataFrame(
        [("e1", "j", "s", "REQUIRES"), ("e2", "j", "gone", "REQUIRES"), ("e2", "gone", "gone", "REQUIRES"), ("e3", None, "s", "REQUIRES"), ("e4", "s", "j", "REQUIRES"), ("e5", "j", "o", "LIKES"), ("e6", "j", "o", "IS_A")],
        "edge_id string, from_id string, to_id string, label string",
    )
    g = C.Graph(n, e)
    found = C.CHECKS["dangling_edges"][1](g)
    assert sorted(r.record_id for r in found.collect()) == ["e2", "e2", "e3"]
    assert "hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()
    wrong = C.CHECKS["invalid_edge_endpoints"][1](g).collect()
    assert sorted(map(tuple, wrong)) == [("e4", "REQUIRES expects Job -> Skill, got Skill -> Job"), ("e6", "IS_A expects Skill -> SkillCategory, got Job -> Occupation")]
