"""The offline stages end to end on a few jobs, by the command line, and the service."""

import json
import threading
import urllib.error
import urllib.request

import pytest
from lodestar import cli, service
from lodestar.operators import search as S
from lodestar.plans import stages
from lodestar.sources import shared

JOBS = [
    (f"{i}", "Data engineer" if i % 2 else "Web developer", "Python, SQL" if i % 2 else "React, JavaScript", "We use Python daily" if i % 3 else "A team", f"2024-01-{i + 1:02}", "100" if i < 6 else "200", "7" if i % 2 else "8", "train",
     "Python, SQL" if i % 2 else "React；ReactJS", "", "")
    for i in range(12)
]
COLUMNS = "job_id string, title string, requirements string, description string, posted_at string, location_code string, occupation_code string, data_split string, computer_skills string, certifications string, work_skills string"


def run(spark, capsys, *argv):
    code = cli.main(list(map(str, argv)), spark)
    out = capsys.readouterr()
    return code, (json.loads(out.out) if code == 0 else out.err)


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    out = tmp_path_factory.mktemp("stages")
    spark.createDataFrame(JOBS, COLUMNS).write.parquet(f"{out}/jobs.parquet")
    queries = [(f"q{i}", "python sql" if i % 2 else "reactjs", "2024-02-01 00:00:00", "100", "", "1|2", "test" if i > 3 else "train") for i in range(8)]
    spark.createDataFrame(queries, "query_id string, query string, query_time string, location_code string, occupation_code string, exposed_jobs string, data_split string").write.parquet(f"{out}/queries.parquet")
    labels = [(f"q{i}", f"{j}", 2 if (i + j) % 2 == 0 and j < 6 else 1 if j == 7 else 0, j + 1, "test" if i > 3 else "train") for i in range(8) for j in range(8)]
    spark.createDataFrame(labels, "query_id string, job_id string, relevance int, original_rank int, data_split string").write.parquet(f"{out}/labels.parquet")
    return out


def test_from_jobs_to_an_ablation(spark, made, capsys):
    jobs = f"{made}/jobs.parquet"
    assert run(spark, capsys, "validate-data", "--jobs", jobs, "--queries", f"{made}/queries.parquet", "--labels", f"{made}/labels.parquet")[1]["status"] == "valid"
    assert run(spark, capsys, "prepare-extraction", "--jobs", jobs, "--out", f"{made}/requests")[1]["request_count"] == 12
    told = run(spark, capsys, "extract-structured-skills", "--jobs", jobs, "--out", f"{made}/extracted")[1]
    assert told["coverage"] == 1.0 and told["jobs"] == 12
    records = f"{made}/extracted/records.jsonl"
    # Fields hold names that the texts don't: what comes from elsewhere breaks the contract.
    code, said = run(spark, capsys, "import-extraction", "--input", records, "--jobs", jobs, "--out", f"{made}/none")
    assert code == 2 and "evidence" in said
    full = spark.read.parquet(jobs).replace({"React, JavaScript": "React, ReactJS, JavaScript"}, subset=["requirements"])
    full.write.parquet(f"{made}/full.parquet")
    jobs = f"{made}/full.parquet"
    assert run(spark, capsys, "import-extraction", "--input", records, "--jobs", jobs, "--out", f"{made}/imported")[1]["record_count"] == 12
    named = run(spark, capsys, "canonicalize", "--input", records, "--jobs", jobs, "--out", f"{made}/names")[1]
    assert named["skills"] == 3
    graph = run(spark, capsys, "build-graph", "--jobs", jobs, "--extractions", records, "--out", f"{made}/graph", "--min-npmi", "0")[1]
    assert graph["labels"]["node:Skill"] == 4 and graph["labels"]["edge:ALIAS_OF"] == 1 and graph["labels"]["edge:CO_OCCURS_WITH"] >= 1
    report = run(spark, capsys, "validate-graph", "--graph", f"{made}/graph", "--out", f"{made}/report", "--source-jobs", jobs)[1]
    assert report["status"] in ("valid", "valid_with_findings"), report
    assert (made / "report" / "graph_quality_report.md").read_text().startswith("# Graph Quality Report")
    features = run(spark, capsys, "build-features", "--graph", f"{made}/graph", "--jobs", jobs, "--queries", f"{made}/queries.parquet", "--labels", f"{made}/labels.parquet", "--out", f"{made}/features", "--candidate-only")[1]
    assert features["rows"] == 64
    compared = run(spark, capsys, "evaluate-ablation", "--features", f"{made}/features", "--out", f"{made}/ablation", "--trees", "2")[1]
    assert set(compared["results"]) == set("ABCD") and (made / "ablation" / "ablation_report.md").exists()


def test_search_as_a_service(spark, made, capsys):
    assert run(spark, capsys, "build-search-index", "--jobs", f"{made}/jobs.parquet", "--out", f"{made}/index")[1]["documents"] == 12
    held = S.open_index(spark, f"{made}/index", "job_id")
    lexical = service.Lexical(spark, held)
    assert set(lexical.search("python sql", limit=3)) <= {"1", "3", "5", "7", "9", "11"} and service.Empty().search("x") == []
    both = service.Hybrid(spark, held, stages.open_graph(spark, f"{made}/graph"))
    assert len(both.search("reactjs", ["100"], limit=4)) == 4
    server = service.server(lexical, port=0, limit=2)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_address[1]}"
    assert json.load(urllib.request.urlopen(f"{base}/health"))["backend"] == "Lexical"
    post = lambda body: json.load(urllib.request.urlopen(urllib.request.Request(f"{base}/api/v1/jobs/search", json.dumps(body).encode())))
    assert [r["rank"] for r in post({"query": " python ", "location_code": ["100", "100"]})["result"]] == [1, 2]
    for body in ({"query": ""}, {"query": "x", "more": 1}, {}):
        with pytest.raises(urllib.error.HTTPError):
            post(body)
    server.shutdown()


def test_scratch_tables_go(spark, made):
    import os

    with shared.scratch(spark):
        held = shared.materialise(spark.range(5))
        path = held.inputFiles()[0].removeprefix("file://")
        assert os.path.exists(path)
    assert not os.path.exists(path)


def test_demo_and_errors(spark, tmp_path, capsys):
    told = run(spark, capsys, "demo", "--tables", "/root/testdata/sf0.001", "--out", tmp_path / "demo")[1]
    assert told["graph"]["node_count"] == told["quality"]["node_count"] and told["index"]["documents"] == 1500
    assert run(spark, capsys, "build-search-index", "--jobs", tmp_path / "missing.parquet", "--out", tmp_path / "x")[0] == 2
