"""The offline stages, from prepared jobs to a checked graph, features and an ablation, with what each writes."""

from __future__ import annotations

import posixpath
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions import text as T
from lodestar.operators import checks as C
from lodestar.operators import extraction as X
from lodestar.operators import graph as G
from lodestar.operators import hybrid, ltr, ranking, statistics
from lodestar.operators import search as S
from lodestar.sources import files, providers
from lodestar.sources.shared import materialise, scratch

TEXTS = ("title", "requirements", "description")


def source_text(jobs: DataFrame):
    return F.concat_ws("\n", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in TEXTS))


def extract_fields(spark: SparkSession, jobs: DataFrame, out: str, split: str = "train", limit: int | None = None) -> dict:
    """Records from the structured fields and texts of the jobs of one split, as JSON lines below `out`, and their coverage."""
    some = jobs.where(F.col("data_split") == split)
    some = some if limit is None else some.orderBy("job_id").limit(limit)
    with scratch(spark):
        lexicon = materialise(X.field_lexicon(some.withColumn("data_split", F.lit("train"))))
        found = X.phrase_evidence(some.select("job_id", source_text(some).alias("text")), lexicon)
        made = materialise(X.records(some, X.structured_mentions(some, found)))
        files.write_jsonl(made, f"{out}/records.jsonl")
        manifest = {**X.coverage(made).first().asDict(), "lexicon": lexicon.count(), "split": split}
    files.write_json(spark, f"{out}/manifest.json", manifest)
    return manifest


def load_records(spark: SparkSession, path: str, jobs: DataFrame) -> DataFrame:
    """Extraction records from JSON lines (blank lines are skipped). A line that is no record, or breaks the contract against
    its job's text, is an error that names the first of them by file and line."""
    lines = files.numbered_lines(spark, path).where("trim(value) != ''").select("file", "line", F.col("value").alias("body"), F.coalesce(F.get_json_object("value", "$.job_id"), F.lit("")).alias("job_id"))
    texts = jobs.select(F.col("job_id").cast("string").alias("job_id"), source_text(jobs).alias("source_text"))
    parsed = materialise(X.parse_records(lines.join(texts, "job_id", "left").na.fill("", ["source_text"])))
    found = X.contract_violations(parsed, "source_text", "file", "line").orderBy("file", "line", "violation").limit(10).collect()
    if found:
        raise ValueError(f"records of {path} break the contract: {[f'{posixpath.basename(r.file)} line {r.line}, job {r.job_id}: {r.violation}' for r in found]}")
    return parsed.select("record.*")


def mentions(records: DataFrame) -> DataFrame:
    rows = records.select("job_id", "extraction_prompt_version", F.posexplode("skills").alias("pos", "s"))
    return rows.select("job_id", "pos", "extraction_prompt_version", "s.raw_mention", F.trim("s.canonical_candidate").alias("candidate"), "s.skill_type", "s.requirement", "s.importance", "s.confidence", "s.evidence")


def canonical(found: DataFrame, aliases: Mapping[str, str] = X.ALIASES, skills: DataFrame | None = None, verifier: Callable[[str, str], tuple[str, float]] | None = None) -> DataFrame:
    """Mentions with `skill` and `rule`: an alias gives its target, other mentions the name that was proposed for them, in the
    spelling that came first. With `skills` (skill) that are known already, what was mentioned is looked up among these first, by form and,
    with a verifier, by embedding; what they have takes their name. Aliases must keep protected pairs apart."""
    X.assert_protected(dict(aliases))
    spark = found.sparkSession
    known = spark.createDataFrame(list(aliases.items()), "alias string, target string")
    norm = known.select(T.normalise(F.col("alias")).alias("_norm"), F.lit(True).alias("_known")).distinct()
    rows = found.withColumn("_norm", T.normalise(F.col("raw_mention"))).join(F.broadcast(norm), "_norm", "left")
    asked = rows.withColumn("raw", F.when(F.col("_known"), F.col("raw_mention")).otherwise(F.col("candidate"))).drop("_norm", "_known")
    audit = X.canonicalise(asked.select("job_id", "pos", "raw"), known).select("job_id", "pos", F.col("selected").alias("skill"), "rule")
    named = asked.drop("raw").join(audit, ["job_id", "pos"])
    if skills is None:
        return named
    full = X.canonicalise_full(found.select("job_id", "pos", F.col("raw_mention").alias("raw")), known, skills, verifier)
    told = full.where("selected is not null and rule <> 'high_precision_alias_dictionary'").select("job_id", "pos", "selected", F.col("rule").alias("_rule"))
    both = named.join(told.distinct(), ["job_id", "pos"], "left")
    return both.withColumns({"skill": F.coalesce("selected", "skill"), "rule": F.coalesce("_rule", "rule")}).drop("selected", "_rule")


def build_graph(jobs: DataFrame, records: DataFrame, aliases: Mapping[str, str] = X.ALIASES, min_count: int = 5, min_npmi: float = 0.1, origin: G.Origin = G.Origin()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nodes, edges and the audit of names, from training jobs and the records of these. A job that comes twice with the same
    properties counts once; with others it is an error, since its node could only have one of them."""
    jobs = G.require_one_version(jobs.withColumn("job_id", F.col("job_id").cast("string")), "job_id")
    named = materialise(canonical(mentions(records), aliases).join(jobs.select("job_id", F.col("posted_at").cast("string").alias("posted_at"), "occupation_code"), "job_id", "left"))
    G.require_known_jobs(named, jobs)
    ids = named.select("job_id", "occupation_code", "requirement", G.skill_id(F.col("skill"), F.col("skill_type")).alias("skill"))
    first, last = jobs.agg(F.min("posted_at"), F.max("posted_at")).first()
    pairs, core = statistics.cooccurrence(ids, min_count, min_npmi), statistics.core_skills(ids)
    return G.nodes(jobs, named, origin), G.edges(jobs, named, pairs, core, str(first), str(last), origin), named.select("job_id", "pos", "raw_mention", F.col("skill").alias("selected"), "rule")


def save_graph(nodes: DataFrame, edges: DataFrame, audit: DataFrame, out: str, overwrite: bool = False) -> dict:
    """Parquet and CSV, plain and with the headers of a bulk loader, the dictionaries, the audit and a manifest. Returns the
    manifest."""
    spark, mode = nodes.sparkSession, "overwrite" if overwrite else "error"
    for name, df in (("nodes", nodes), ("edges", edges)):
        df.write.mode(mode).option("compression", "zstd").parquet(f"{out}/{name}.parquet")
    n, e = (spark.read.parquet(f"{out}/{name}.parquet") for name in ("nodes", "edges"))
    for name, df in {
        "nodes_plain": n, "edges_plain": e, "nodes": files.loader_frame(n, "node"), "edges": files.loader_frame(e, "edge"), "skill_dictionary": G.skill_dictionary(n),
        "alias_dictionary": G.alias_dictionary(n, e), "canonicalization_audit": audit,
    }.items():
        files.write_csv(df, f"{out}/{name}.csv", overwrite)
    counts = {f"{r.kind}:{r.label}": r["rows"] for r in G.manifest(n, e).collect()}  # a row for each label
    manifest = {"node_count": sum(v for k, v in counts.items() if k.startswith("node:")), "edge_count": sum(v for k, v in counts.items() if k.startswith("edge:")), "labels": counts, "contains_test_jd": False}
    files.write_json(spark, f"{out}/graph_manifest.json", manifest, overwrite)
    return manifest


def open_graph(spark: SparkSession, path: str, jobs: DataFrame | None = None, rules: C.Rules = C.Rules()) -> C.Graph:
    audit = spark.read.option("header", True).csv(f"{path}/canonicalization_audit.csv")
    return C.Graph(spark.read.parquet(f"{path}/nodes.parquet"), spark.read.parquet(f"{path}/edges.parquet"), jobs, audit, rules)


def validate_graph(g: C.Graph, out: str, overwrite: bool = False) -> dict:
    """The report as JSON and Markdown and the rows put aside as CSV; a failed graph is an error after these are written."""
    spark = g.nodes.sparkSession
    told, text = C.report(g)
    files.write_json(spark, f"{out}/graph_quality_report.json", told, overwrite)
    files.write_text(spark, f"{out}/graph_quality_report.md", text, overwrite)
    aside = {"invalid_nodes": C.invalid_nodes(g), "invalid_edges": C.invalid_edges(g), "suspicious_aliases": C.suspicious_aliases(g)}
    if g.audit is not None:
        aside["unresolved_skills"] = C.unresolved(g.audit)
    for name, df in aside.items():
        files.write_csv(df, f"{out}/{name}.csv", overwrite)
    if told["status"] == "failed":
        raise ValueError(f"the graph is not valid: see {out}/graph_quality_report.json")
    return told


def job_documents(jobs: DataFrame) -> DataFrame:
    return jobs.select(F.col("job_id").cast("string").alias("job_id"), *(c for c in jobs.columns if c != "job_id"), F.col("location_code").alias("location"), F.col("occupation_code").alias("duty"))


def index_jobs(jobs: DataFrame, out: str, overwrite: bool = False, limit: int | None = None) -> dict:
    docs = job_documents(jobs)
    S.build_index(docs, indexed_terms(), out, "job_id", overwrite, limit, positional=True)
    return index_size(jobs.sparkSession, out)


def indexed_terms() -> Column:
    """What a full-text engine makes of the terms of a job: they are cut again at all but letters and digits, their order stays."""
    return T.fts_parts(F.array_join(T.search_tokens(F.concat_ws(" ", *TEXTS)), " "))


def index_size(spark: SparkSession, path: str) -> dict:
    held = S.open_index(spark, path)
    return {"documents": held.docs.count(), "postings": held.postings.count(), "segments": len(held.segments), "output": path}


def change_index(spark: SparkSession, path: str, jobs: DataFrame | None = None, gone: DataFrame | None = None, merge: bool = False) -> dict:
    """Take jobs out of an index (by job_id), put new ones in, merge its segments: in this order, each if asked for."""
    if gone is not None:
        S.delete(gone.select(F.col("job_id").cast("string").alias("job_id")), path)
    if jobs is not None:
        S.append(job_documents(jobs), indexed_terms(), path)
    if merge:
        S.optimize(spark, path)
    return index_size(spark, path)


def build_features(g: C.Graph, jobs: DataFrame, queries: DataFrame, labels: DataFrame, out: str, observed: bool = True, overwrite: bool = False) -> dict:
    make = hybrid.labelled_features(labels, queries, jobs, g.nodes, g.edges) if observed else hybrid.all_features(queries, jobs, g.nodes, g.edges, labels)
    make.write.mode("overwrite" if overwrite else "error").parquet(out)
    return {"rows": jobs.sparkSession.read.parquet(out).count(), "columns": len(make.columns), "output": out}


def evaluate_ablation(features: DataFrame, out: str, trees: int = 80, overwrite: bool = False) -> dict:
    """Metrics and comparison of the four feature sets, on the test split, with rankers of the training split, which are
    saved too."""
    spark = features.sparkSession
    split = F.lower(F.trim("data_split"))
    train, test = features.where(split == "train"), features.where(split == "test")
    models = {name: ltr.fit(train, list(hybrid.feature_set(name)), trees) for name in "CD"}
    sets, compared = hybrid.ablation(train, test, trees, models=models)
    files.write_text(spark, f"{out}/ablation_report.md", hybrid.ablation_report(sets, compared), overwrite)
    results = {name: ranking.mean_metrics(m).first().asDict() for name, m in sets.items()}
    details = {"results": results, "paired_bootstrap_C_to_D": compared.first().asDict(), "graph_win_loss_tie": ranking.win_loss_tie(sets["C"], sets["D"]).first().asDict(), "importance": {n: m.importance() for n, m in models.items()}}
    files.write_json(spark, f"{out}/ablation_details.json", details, overwrite)
    files.write_csv(G.union([m.withColumn("feature_set", F.lit(n)) for n, m in sets.items()]), f"{out}/per_query_metrics.csv", overwrite)
    for name, model in models.items():
        model.save(spark, f"{out}/ranker_{name}", overwrite)
    return details


def prepare_requests(jobs: DataFrame, out: str) -> dict:
    """What would be asked of a provider, as JSON lines; nothing is sent."""
    files.write_jsonl(providers.requests(jobs).withColumn("dry_run", F.lit(True)), out)
    return {"dry_run": True, "paid_api_calls": 0, "request_count": jobs.count(), "output": out}
