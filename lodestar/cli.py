"""Commands: each is a call of a stage. `python -m lodestar.cli COMMAND --help`."""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lodestar.operators import contracts
from lodestar.operators import extraction as X
from lodestar.operators import graph as G
from lodestar.operators import search as S
from lodestar.plans import fixtures, prepare, stages
from lodestar.sources import files

COMMANDS: dict[str, tuple[Callable, tuple]] = {}


def _session(threads: str | None, memory: str | None) -> SparkSession:
    """The session of the cluster that runs this, or one of our own with so many threads and so much memory."""
    builder = SparkSession.builder.config("spark.sql.session.timeZone", "UTC")
    builder = builder.master(f"local[{threads}]") if threads else builder
    return (builder.config("spark.driver.memory", memory) if memory else builder).getOrCreate()


def command(name: str, *options):
    def add(f):
        COMMANDS[name] = (f, options)
        return f

    return add


def opt(flag: str, **kind):
    return flag, kind


def need(*flags: str):
    return [opt(f, required=True) for f in flags]


#: Names of commands and options are what users type. Fixed values, here and below.
ENDS = [opt("--train-end", required=True), opt("--validation-end", required=True), opt("--test-end")]
OVER = opt("--overwrite", action="store_true")


def _table(spark: SparkSession, path: str, columns: str | None = None, kind: str = "jobs") -> DataFrame:
    """A table, its columns renamed by the section `kind` of a YAML file if one is given and they need it."""
    df = files.read_table(spark, path)
    if columns and not set(contracts.REQUIRED[kind]) <= set(df.columns):
        text = spark.read.text(columns, wholetext=True).first().value
        mapping = files.load_yaml(text)[kind]
        df = contracts.rename(df, {{"split": "data_split", "query_text": "query"}.get(k, k): v for k, v in mapping.items()})
    return df


@command("profile-data", *need("--dataset"), opt("--out"), *ENDS)
def profile_data(spark, a):
    told = prepare.profile_raw(spark, a.dataset, prepare.Config(a.train_end, a.validation_end, a.test_end))
    if a.out:
        files.write_json(spark, a.out, told)
    return told


@command(
    "prepare-data", *need("--dataset", "--out"), *ENDS, opt("--browse-window-minutes", type=int, default=60), opt("--apply-window-hours", type=int, default=24), opt("--negative-cap", type=int, default=20),
    opt("--sample-queries", type=int), opt("--jobs-scope", choices=("all", "exposed"), default="all"), opt("--include-zero-positive-queries", action="store_true"), opt("--allow-future-content", action="store_true"), OVER,
)
def prepare_data(spark, a):
    cfg = prepare.Config(
        a.train_end, a.validation_end, a.test_end, f"{a.browse_window_minutes} MINUTES", f"{a.apply_window_hours} HOURS", a.negative_cap, not a.include_zero_positive_queries, not a.allow_future_content, a.sample_queries, a.jobs_scope
    )
    return prepare.prepare(spark, a.dataset, a.out, cfg, overwrite=a.overwrite)


@command("build-search-index", *need("--jobs", "--out"), opt("--limit", type=int), OVER)
def build_search_index(spark, a):
    return stages.index_jobs(files.read_table(spark, a.jobs), a.out, a.overwrite, a.limit)


@command("update-search-index", *need("--index"), opt("--add"), opt("--remove"), opt("--optimize", action="store_true"))
def update_search_index(spark, a):
    table = lambda path: files.read_table(spark, path) if path else None
    return stages.change_index(spark, a.index, table(a.add), table(a.remove), a.optimize)


@command("extract-structured-skills", *need("--jobs", "--out"), opt("--split", default="train"), opt("--limit", type=int))
def extract_structured_skills(spark, a):
    return stages.extract_fields(spark, files.read_table(spark, a.jobs), a.out, a.split, a.limit)


@command("serve-api", *need("--index"), opt("--host", default="127.0.0.1"), opt("--port", type=int, default=8000), opt("--result-limit", type=int, default=50), opt("--graph"), opt("--model"))
def serve_api(spark, a):
    from lodestar import service
    from lodestar.operators.ltr import Ranker

    held = S.open_index(spark, a.index)
    model = Ranker.load(spark, a.model) if a.model else None
    backend = service.Hybrid(spark, held, stages.open_graph(spark, a.graph), model) if a.graph else service.Lexical(spark, held)
    service.server(backend, a.host, a.port, a.result_limit).serve_forever()


@command("validate-data", *need("--jobs", "--queries", "--labels"), opt("--columns"), opt("--train-cutoff"), opt("--out"))
def validate_data(spark, a):
    tables = [_table(spark, getattr(a, k), a.columns, k) for k in ("jobs", "queries", "labels")]
    found = contracts.violations(*tables, a.train_cutoff)
    told = {"violations": {r.check: r.n for r in found.groupBy("check").agg({"*": "count"}).toDF("check", "n").collect()}}  # a row for each check
    told["status"] = "invalid" if told["violations"] else "valid"
    if a.out:
        files.write_json(spark, a.out, told)
    if told["violations"]:
        raise ValueError(json.dumps(told))
    return told


@command("prepare-extraction", *need("--jobs", "--out"), opt("--columns"))
def prepare_extraction(spark, a):
    jobs = _table(spark, a.jobs, a.columns)
    stages.statistics.require_train(jobs)
    return stages.prepare_requests(jobs, a.out)


@command("import-extraction", *need("--input", "--jobs", "--out"), opt("--columns"))
def import_extraction(spark, a):
    records = stages.load_records(spark, a.input, _table(spark, a.jobs, a.columns))
    files.write_jsonl(records, a.out)
    return {"status": "valid", "record_count": records.count(), "output": a.out}


@command("canonicalize", *need("--input", "--jobs", "--out"))
def canonicalize(spark, a):
    named = stages.canonical(stages.mentions(stages.load_records(spark, a.input, files.read_table(spark, a.jobs))))
    files.write_csv(named, f"{a.out}/canonicalization_audit.csv")
    names = named.select(named.skill.alias("canonical_name")).distinct().orderBy("canonical_name")
    files.write_csv(names, f"{a.out}/skill_dictionary.csv")
    return {"skills": names.count(), "mentions": named.count(), "output": a.out}


@command("build-graph", *need("--jobs", "--extractions", "--out"), opt("--columns"), opt("--min-cooccurrence", type=int, default=5), opt("--min-npmi", type=float, default=0.1), OVER)
def build_graph(spark, a):
    jobs = _table(spark, a.jobs, a.columns)
    records = stages.load_records(spark, a.extractions, jobs)
    made = stages.build_graph(jobs, records, X.ALIASES, a.min_cooccurrence, a.min_npmi, G.Origin(source_file=a.jobs))
    return stages.save_graph(*made, a.out, a.overwrite)


@command("validate-graph", *need("--graph", "--out"), opt("--source-jobs"), OVER)
def validate_graph(spark, a):
    jobs = files.read_table(spark, a.source_jobs) if a.source_jobs else None
    rules = stages.C.Rules(protected=X.PROTECTED)
    return stages.validate_graph(stages.open_graph(spark, a.graph, jobs, rules), a.out, a.overwrite)


@command("build-features", *need("--graph", "--jobs", "--queries", "--labels", "--out"), opt("--columns"), opt("--candidate-only", action="store_true"), OVER)
def build_features(spark, a):
    jobs, queries, labels = (_table(spark, getattr(a, k), a.columns, k) for k in ("jobs", "queries", "labels"))
    return stages.build_features(stages.open_graph(spark, a.graph), jobs, queries, labels, a.out, a.candidate_only, a.overwrite)


@command("evaluate-ablation", *need("--features", "--out"), opt("--trees", type=int, default=80), OVER)
def evaluate_ablation(spark, a):
    return stages.evaluate_ablation(spark.read.parquet(a.features), a.out, a.trees, a.overwrite)


@command("demo", *need("--tables", "--out"))
def demo(spark, a):
    """A graph of the test tables in `--tables`, checked, and an index over its jobs."""
    js, jobs = fixtures.baskets(spark, a.tables), fixtures.basket_jobs(spark, a.tables)
    told = stages.save_graph(G.nodes(jobs, js), G.edges(jobs, js), js.select("job_id", "pos", "raw_mention", js.skill.alias("selected")), f"{a.out}/graph")
    g = stages.open_graph(spark, f"{a.out}/graph")
    return {"graph": told, "quality": stages.C.quality_metrics(g).first().asDict(), "index": stages.index_jobs(jobs, f"{a.out}/index")}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="lodestar", description=__doc__)
    parser.add_argument("--threads", help="threads of a session of our own")
    parser.add_argument("--memory", help="memory of a session of our own")
    sub = parser.add_subparsers(dest="command", required=True)
    for name, (f, options) in COMMANDS.items():
        one = sub.add_parser(name, help=f.__doc__)
        for flag, kind in options:
            one.add_argument(flag, **kind)
    a = parser.parse_args(argv)
    try:
        told = COMMANDS[a.command][0](spark or _session(a.threads, a.memory), a)
        print(json.dumps(told, ensure_ascii=False, indent=2, default=str))
        return 0
    except Exception as e:
        print(f"error: {e}", file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
