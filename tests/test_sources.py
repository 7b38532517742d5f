"""Readers, the request cache, conflicts, and the commands that start from raw files or serve."""

import json
import threading
import urllib.request

import pytest
from lodestar import cli, service
from lodestar.plans import stages
from lodestar.sources import files, providers
from pyspark.sql import functions as F

from tests.test_stages import COLUMNS, JOBS, run


def test_headers_with_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('﻿id,"name, in full", "say ""x""",last\n1,2,3,4\n', encoding="utf-8")
    assert files.header(spark, str(tmp_path / "a.csv")) == ["id", "name, in full", 'say "x"', "last"]
    (tmp_path / "b.csv").write_text("\n")
    with pytest.raises(ValueError):
        files.header(spark, str(tmp_path / "b.csv"))


def test_lines_of_files_in_blocks(spark, tmp_path):
    lines = {f"f{n}.jsonl": [f"{n} line {i} " + "x" * (i % 50) for i in range(1, 700 + n)] for n in range(3)}
    for name, rows in lines.items():
        (tmp_path / name).write_text("\n".join(rows) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = files.numbered_lines(spark, str(tmp_path))
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 8
        got = {(r.file.rsplit("/", 1)[1], r.line): r.value for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == {(name, i): v for name, rows in lines.items() for i, v in enumerate(rows, 1)}


def test_a_broken_record_is_named_by_its_line(spark, tmp_path):
    jobs = spark.createDataFrame([(str(i), "python", "", "") for i in range(400)], "job_id string, title string, requirements string, description string")
    skill = {"raw_mention": "python", "canonical_candidate": "Python", "skill_type": "Library", "requirement": "mentioned", "importance": 0.5, "confidence": 1.0, "evidence": "python"}
    rows = [json.dumps({"job_id": str(i), "extraction_prompt_version": "v", "skills": [skill]}) for i in range(400)]
    path = tmp_path / "records.jsonl"
    path.write_text("\n".join(rows))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        assert stages.load_records(spark, str(path), jobs.withColumns({c: F.lit("") for c in stages.TEXTS if c not in jobs.columns})).count() == 400
        rows[256] = rows[256][:40]
        rows.insert(100, "")
        path.write_text("\n".join(rows))
        with pytest.raises(ValueError, match="records.jsonl line 258,.*not_json"):
            stages.load_records(spark, str(path), jobs.withColumns({c: F.lit("") for c in stages.TEXTS if c not in jobs.columns}))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_equal_requests_are_sent_once_and_kept(spark, tmp_path):
    calls, kept = tmp_path / "calls", str(tmp_path / "cache")

    def call(text):
        with open(calls, "a") as f:
            f.write("x")
        if "JOB_ID: 3" in text:
            raise RuntimeError("no")
        return text[-1:]

    jobs = spark.createDataFrame([("1", "t", "r", "a"), ("1", "t", "r", "a"), ("2", "t", "r", "b"), ("3", "t", "r", "c")], "job_id string, title string, requirements string, description string")
    got = providers.extract(jobs, call, attempts=1, keep=kept)
    rows = sorted((r.job_id, r.body, r.error) for r in got.collect())
    assert rows == [("1", "a", None), ("1", "a", None), ("2", "b", None), ("3", None, "no")] and calls.read_text() == "xxx" and got.count() == 4
    again = providers.extract(jobs, call, spark.read.parquet(kept), attempts=1, keep=kept)
    assert again.where("error is null").count() == 3 and calls.read_text() == "xxxx"
    text = jobs.select(providers.prompt().alias("p")).first().p
    assert providers.PROMPT_VERSION in text and "DomainKnowledge" in text and text.endswith("DESCRIPTION: a")


def test_a_job_with_two_texts_is_an_error(spark):
    jobs = spark.createDataFrame(JOBS[:3], COLUMNS)
    records = spark.createDataFrame([], "job_id string, extraction_prompt_version string, skills array<struct<raw_mention:string,canonical_candidate:string,skill_type:string,requirement:string,importance:double,confidence:double,evidence:string>>")
    n, _, _ = stages.build_graph(jobs.union(jobs), records)
    assert n.where("label = 'Job'").count() == 3
    with pytest.raises(ValueError, match="different properties"):
        stages.build_graph(jobs.union(jobs.limit(1).withColumn("title", F.lit("another"))), records)


def test_small_sources(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    files.register_views(spark, {"some": f"{tmp_path}/a.csv"})
    assert spark.sql("SELECT y FROM raw_some").first().y == "2"
    assert len(files.file_hashes(spark, f"{tmp_path}/a.csv").first().sha256) == 64
    nodes = spark.createDataFrame([("n", "Job", 2)], "node_id string, label string, n int")
    assert files.loader_frame(nodes, "node").columns == ["~id", "~label", "n:Long"]
    assert providers.import_plan("a", "b")["dry_run"]
    with pytest.raises(NotImplementedError):
        providers.import_plan("a", "b", allow=True)


def test_commands_on_raw_files(spark, tmp_path, capsys):
    data = tmp_path / "raw"
    data.mkdir()
    columns = files.JOB_COLUMNS
    job = {"job_id": "11", "title": "A", "last_modified_at": "2023-01-01"}
    texts = {
        "s": 'talentNo,ks,c0,d0,search_time,empStr\n7,java,1,2,2024-01-01 10:00:00,"11,12,13"\n',
        "b": "organNo,employeeNo,dateIn,talentNo\n1,12,2024-01-01 10:30:00,7\n", "a": "LogTitle,empNo,empName,talentNo,datein\nx,11,n,7,2024-01-01 20:00:00\n",
        "c": "CodeNo,CodeNameA,CodeNameB,CodeNameC,CodeType,CodeArea,CodeZip\n1,X,,,2,,\n", "d": "CodeNo,CodeNameA,CodeNameB,CodeNameC,CodeDescript,CodeAlike,CodeDefinition,CodeNameEN\n2,Y,,,,,,\n",
        "j": ",".join(columns.values()) + "\n" + "".join(",".join(({**job, "job_id": i}).get(c, "") for c in columns) + "\n" for i in ("11", "12", "13")),
    }
    for name, text in texts.items():
        (data / f"{name}.csv").write_text(text, encoding="utf-8")
    ends = ("--train-end", "2024-02-01", "--validation-end", "2024-03-01", "--test-end", "2024-04-01")
    code, told = run(spark, capsys, "profile-data", "--dataset", data, "--out", f"{tmp_path}/profile.json", *ends)
    assert code == 0 and told["search"]["exposure_count"] == 3 and (tmp_path / "profile.json").exists()
    code, told = run(spark, capsys, "prepare-data", "--dataset", data, "--out", f"{tmp_path}/made", *ends)
    assert code == 0 and told["profile"]["canonical"]["labels"]["relevance_2"] == 1
    assert run(spark, capsys, "prepare-data", "--dataset", data, "--out", f"{tmp_path}/made", *ends)[0] == 2


def test_commands_that_change_and_serve_an_index(spark, tmp_path, capsys, monkeypatch):
    frame = lambda rows, name: spark.createDataFrame(rows, COLUMNS).write.parquet(f"{tmp_path}/{name}.parquet") or f"{tmp_path}/{name}.parquet"
    first, more = frame(JOBS[:8], "first"), frame([("90", "Node.js developer", "Node.js, C++", *JOBS[0][3:]), JOBS[0]], "more")
    assert run(spark, capsys, "build-search-index", "--jobs", first, "--out", f"{tmp_path}/index")[1]["documents"] == 8
    told = run(spark, capsys, "update-search-index", "--index", f"{tmp_path}/index", "--remove", frame(JOBS[:1], "gone"), "--add", more)[1]
    assert (told["documents"], told["segments"]) == (9, 2)
    told = run(spark, capsys, "update-search-index", "--index", f"{tmp_path}/index", "--optimize")[1]
    assert (told["documents"], told["segments"]) == (9, 1)
    served, made = [], service.server

    def once(*args):
        http = made(*args[:1], "127.0.0.1", 0, *args[3:])
        thread = threading.Thread(target=http.serve_forever, daemon=True)
        thread.start()
        body = json.dumps({"query": "node.js c++"}).encode()
        served.append(json.load(urllib.request.urlopen(urllib.request.Request(f"http://127.0.0.1:{http.server_port}/api/v1/jobs/search", body)))["result"])
        http.shutdown()
        return type("Served", (), {"serve_forever": lambda self: None})()

    monkeypatch.setattr(service, "server", once)
    cli.main(["serve-api", "--index", f"{tmp_path}/index", "--result-limit", "3"], spark)
    assert [r["job_id"] for r in served[0]][:1] == ["90"]
