"""Quality of a property graph: 22 checks, the rows that they put aside, ratios, and reports."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.functions.text import normalise
from lodestar.operators import graph as G
from lodestar.sources.shared import materialise


@dataclass(frozen=True)
class Rules:
    """What the checks ask for: properties by label, ends of edges, limits, severities that differ from the defaults, and pairs
    of names that no alias may merge."""

    node_properties: Mapping[str, Sequence[str]] = field(default_factory=lambda: G.NODE_PROPERTIES)
    edge_properties: Sequence[str] = G.EDGE_PROPERTIES
    ends: Mapping[str, tuple[str, str]] = field(default_factory=lambda: G.ENDS)
    max_weight: float = 1.0
    degree: int = 1000
    min_count: int = 5
    min_npmi: float = 0.1
    low_confidence: float = 0.5
    policies: Mapping[str, str] = field(default_factory=dict)
    protected: Sequence[tuple[str, str]] = ()


@dataclass(frozen=True)
class Graph:
    """Nodes and edges as operators.graph makes them (columns that are missing count as null), the jobs that they come from
    (job_id, title, requirements, description) and the audit of canonical names (selected), where there are any."""

    nodes: DataFrame
    edges: DataFrame
    jobs: DataFrame | None = None
    audit: DataFrame | None = None
    rules: Rules = Rules()
    kept: bool = False  # whether nodes and edges are tables that cost nothing to read again

    def stored(self) -> Graph:
        """The same graph from tables in the shared folder: several checks of it then build it once."""
        return replace(self, nodes=materialise(self.nodes), edges=materialise(self.edges), kept=True)

    def slim(self, *columns: str, of: str = "edges") -> DataFrame:
        """Some columns of the edges (or nodes), to be read several times."""
        rows = getattr(self, of).select(*columns)
        return rows if self.kept else materialise(rows)

    def of(self, label: str) -> DataFrame:
        return self.edges.where(F.col("label") == label)

    def job_skills(self) -> DataFrame:
        return self.edges.where(F.col("label").isin(*G.JOB_SKILL))


Check = Callable[[Graph], DataFrame]
#: Checks by name, with their default severities.
CHECKS: dict[str, tuple[str, Check]] = {}


def _check(severity: str = "warn"):
    def add(f: Check) -> Check:
        CHECKS[f.__name__] = (severity, f)
        return f

    return add


def _col(df: DataFrame, name: str, kind: str = "string") -> Column:
    return F.col(name).try_cast(kind) if name in df.columns else F.lit(None).cast(kind)


def _said(frame: DataFrame, record: str | Column | None, message: str | Column) -> DataFrame:
    record = F.lit(None) if record is None else F.col(record) if isinstance(record, str) else record
    return frame.select(record.cast("string").alias("record_id"), (F.lit(message) if isinstance(message, str) else message).alias("message"))


def _fmt(template: str, *columns: str) -> Column:
    return F.format_string(template, *columns)


#: Keys that one task tells apart, about.
KEYS = 1_000_000


def _repeated(stored: DataFrame, key: str) -> DataFrame:
    """Hashes are counted first, dealt out so that a task has the same number of them whatever there is; only rows whose hash repeats are
    compared by the key itself."""
    h = F.xxhash64(key).alias("_h")
    n = max(1, -(-stored.count() // KEYS))
    again = materialise(stored.select(h).repartition(n, "_h").groupBy("_h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_h"))
    some = stored.select(key, h).join(again, "_h", "left_semi")
    return some.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def _absent(asked: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """The distinct keys `asked` that are not `known` (a null never is): counted together, so nothing is sorted."""
    both = asked.select(key, F.lit(0).alias("_known")).union(known.where(F.col(key).isNotNull()).select(key, F.lit(1)))
    return both.groupBy(key).agg(F.max("_known").alias("_known")).where("_known = 0").select(key)


def _labels(n: DataFrame) -> DataFrame:
    return n.groupBy("node_id").agg(F.min("label").alias("node_label"))


def _end_labels(g: Graph, e: DataFrame) -> DataFrame:
    """Edges whose two ends exist, with the labels of these."""
    known = _labels(g.nodes)
    start = known.select(F.col("node_id").alias("from_id"), F.col("node_label").alias("from_label"))
    return e.join(start, "from_id").join(known.select(F.col("node_id").alias("to_id"), F.col("node_label").alias("to_label")), "to_id")


def _touching(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The edges of `rows` with an end among `ids` (node_id, distinct, null too). The ids are stored, so that the optimiser knows their size: as
    long as they are few, edges are not dealt out by their ends, and nodes of many edges are no hot keys."""
    stored = materialise(ids)
    for c in ("from_id", "to_id"):
        rows = rows.join(stored.select(F.col("node_id").alias(f"_{c}"), F.lit(True).alias(f"_at_{c}")), F.col(c).eqNullSafe(F.col(f"_{c}")), "left").drop(f"_{c}")
    return rows.where("_at_from_id or _at_to_id").drop("_at_from_id", "_at_to_id")


@_check("fail")
def duplicate_node_ids(g: Graph) -> DataFrame:
    return _said(_repeated(g.slim("node_id", of="nodes"), "node_id"), "node_id", "Duplicate node ID")


@_check("fail")
def duplicate_edge_ids(g: Graph) -> DataFrame:
    return _said(_repeated(g.slim("edge_id"), "edge_id"), "edge_id", "Duplicate edge ID")


@_check("quarantine")
def dangling_edges(g: Graph) -> DataFrame:
    """Only the distinct ends meet the nodes, see `_touching`."""
    rows = g.slim("edge_id", "from_id", "to_id")
    ends = rows.select(F.explode(F.array("from_id", "to_id")).alias("node_id")).distinct()
    return _said(_touching(rows, _absent(ends, g.nodes, "node_id")), "edge_id", "Edge references a missing node")


@_check()
def orphan_skill_nodes(g: Graph) -> DataFrame:
    """Skills are stored, so that the optimiser knows their size: ends that are none are dropped where the edges are, while skills are few."""
    skills = materialise(g.nodes.where("label = 'Skill'").select("node_id"))
    touched = g.edges.select(F.explode(F.array("from_id", "to_id")).alias("node_id")).join(skills, "node_id", "left_semi").distinct()
    return _said(skills.join(touched, "node_id", "left_anti"), "node_id", "Skill node has no edges")


@_check("fail")
def invalid_node_labels(g: Graph) -> DataFrame:
    return _said(g.nodes.where(~F.coalesce(F.col("label").isin(*g.rules.node_properties), F.lit(False))), "node_id", _fmt("Invalid node label %s", "label"))


@_check("fail")
def invalid_edge_labels(g: Graph) -> DataFrame:
    return _said(g.edges.where(~F.coalesce(F.col("label").isin(*g.rules.ends), F.lit(False))), "edge_id", _fmt("Invalid edge label %s", "label"))


@_check("fail")
def missing_node_property(g: Graph) -> DataFrame:
    """Columns that the nodes lack, for labels that they have."""
    lacking = [(label, p) for label, ps in g.rules.node_properties.items() for p in sorted(set(ps) - set(g.nodes.columns))]
    table = g.nodes.sparkSession.createDataFrame(lacking, "label string, property string")
    found = F.broadcast(table).join(g.nodes.select("label").distinct(), "label", "left_semi")
    return _said(found, "label", _fmt("%s is missing required property column %s", "label", "property"))


@_check("fail")
def missing_edge_property(g: Graph) -> DataFrame:
    lacking = [(p,) for p in sorted(set(g.rules.edge_properties) - set(g.edges.columns))]
    table = g.edges.sparkSession.createDataFrame(lacking, "property string")
    return _said(table, "property", _fmt("All edge types require property column %s", "property"))


@_check("fail")
def invalid_edge_endpoints(g: Graph) -> DataFrame:
    want = F.create_map(*(F.lit(x) for k, (a, b) in g.rules.ends.items() for x in (k, f"{a} -> {b}")))
    seen = F.concat_ws(" -> ", "from_label", "to_label")
    start, end = (F.create_map(*(F.lit(x) for k, ab in g.rules.ends.items() for x in (k, ab[i])))[F.col("label")].alias("wanted") for i in (0, 1))
    rows = g.slim("edge_id", "from_id", "to_id", "label").where(F.col("label").isin(*g.rules.ends))
    asked = rows.select(F.explode(F.array(F.struct(F.col("from_id").alias("node_id"), start), F.struct(F.col("to_id").alias("node_id"), end))).alias("p")).select("p.*").distinct()
    odd = asked.join(_labels(g.nodes), "node_id").where(~F.col("node_label").eqNullSafe(F.col("wanted"))).select("node_id").distinct()
    wrong = _end_labels(g, _touching(rows, odd)).select("edge_id", "label", want[F.col("label")].alias("want"), seen.alias("seen")).where("want != seen")
    return _said(wrong, "edge_id", _fmt("%s expects %s, got %s", "label", "want", "seen"))


@_check("quarantine")
def missing_evidence(g: Graph) -> DataFrame:
    """Without a column for it nothing is found."""
    empty = F.trim(F.coalesce(_col(g.edges, "evidence"), F.lit(""))) == "" if "evidence" in g.edges.columns else F.lit(False)
    return _said(g.edges.where(empty), "edge_id", "Edge evidence is empty")


def _outside(df: DataFrame, c: str, low: float, high: float) -> Column:
    v = _col(df, c, "double")
    return v.isNull() | F.isnan(v) | ~v.between(low, high)


@_check("fail")
def invalid_confidence(g: Graph) -> DataFrame:
    return _said(g.edges.where(_outside(g.edges, "confidence", 0, 1)), "edge_id", "Edge confidence is outside [0,1]")


@_check("fail")
def invalid_weight(g: Graph) -> DataFrame:
    return _said(g.edges.where(_outside(g.edges, "weight", 0, g.rules.max_weight)), "edge_id", f"Edge weight is outside [0,{float(g.rules.max_weight)}]")


def _source_ids(g: Graph) -> DataFrame:
    ids = g.jobs.select("job_id") if g.jobs is not None else g.nodes.where("label = 'Job'").select("job_id")
    return ids.select(F.col("job_id").cast("string").alias("source_job_id")).distinct()


@_check("fail")
def source_job_missing(g: Graph) -> DataFrame:
    """Only the distinct ids meet the jobs; those that are missing are stored, see `_touching`."""
    if "source_job_id" not in g.edges.columns:
        return _said(g.edges.where(F.lit(False)), "edge_id", "")
    named = g.slim("edge_id", "source_job_id").where(F.trim(F.col("source_job_id").cast("string")) != "").withColumn("source_job_id", F.col("source_job_id").cast("string"))
    missing = materialise(_absent(named.select("source_job_id").distinct(), _source_ids(g), "source_job_id"))
    return _said(named.join(missing, "source_job_id", "left_semi"), "edge_id", "source_job_id does not exist")


def _leaked_jobs(g: Graph) -> DataFrame:
    return g.nodes.where((F.col("label") == "Job") & (F.coalesce(F.lower(_col(g.nodes, "data_split")), F.lit("")) != "train"))


@_check("fail")
def test_leakage(g: Graph) -> DataFrame:
    late = g.edges.where(F.lower(_col(g.edges, "data_split")) == "test")
    return _said(_leaked_jobs(g), "node_id", "Non-train Job is present in train graph").union(_said(late, "edge_id", "Test provenance is present on edge"))


@_check("fail")
def alias_multiple_targets(g: Graph) -> DataFrame:
    several = g.of("ALIAS_OF").groupBy("from_id").agg(F.count_distinct("to_id").alias("n")).where("n > 1")
    return _said(several, "from_id", _fmt("Alias points to %s skills", "n"))


def _landings(single: DataFrame) -> DataFrame:
    """(node, at, open) of nodes with one edge each (node, at): where the way from a node leads that only such nodes are on. Each
    round doubles the steps that are taken; `open`: it never ends, so it runs into a cycle of such nodes. While there are ways that end
    and are longer than the steps taken, some of them end in the next round, so a round without any is the last."""
    ways, before = materialise(single.withColumn("open", F.lit(True))), -1
    while (now := ways.where("open").count()) not in (0, before):
        before = now
        on = ways.select(F.col("node").alias("at"), F.col("at").alias("_next"), F.col("open").alias("_open"))
        ways = materialise(ways.join(on, "at", "left").select("node", F.coalesce("_next", "at").alias("at"), (F.col("open") & F.coalesce("_open", F.lit(False))).alias("open")))
    return ways


def reaching_cycles(aliases: DataFrame) -> DataFrame:
    """(node_id) of the nodes from which edges (from_id, to_id) lead into a cycle: what leads only to ends is taken off until all
    that is left has an edge that stays. Chains of nodes with a single edge go at once, by pointer jumping, so a chain takes as many
    rounds as its length has bits, and turns are taken only where ways part. Only counts come to the driver; each round
    is stored, so that plans don't nest."""
    left, before = materialise(aliases.select("from_id", "to_id").distinct()), -1
    while (now := left.count()) not in (0, before):
        before = now
        from_ = left.groupBy(F.col("from_id").alias("node")).agg(F.count(F.lit(1)).alias("n"), F.min("to_id").alias("at"))
        ends = left.select(F.col("to_id").alias("node")).distinct().join(from_, "node", "left_anti")
        ways = _landings(from_.where("n = 1").select("node", "at"))
        gone = materialise(ends.union(ways.where("not open").join(ends.withColumnRenamed("node", "at"), "at", "left_semi").select("node")))
        left = materialise(left.join(gone.withColumnRenamed("node", "to_id"), "to_id", "left_anti").select("from_id", "to_id"))
    return left.select(F.col("from_id").alias("node_id")).distinct()


@_check("fail")
def alias_cycle(g: Graph) -> DataFrame:
    return _said(reaching_cycles(g.of("ALIAS_OF")), "node_id", "Alias cycle detected")


def suspicious_aliases(g: Graph) -> DataFrame:
    """Alias edges that merge a protected pair, with the names at both ends. Only the ends of alias edges are named."""
    shown = F.coalesce(*(F.when(_col(g.nodes, c) != "", _col(g.nodes, c)) for c in ("canonical_name", "alias", "name")), F.lit(""))
    names = g.nodes.select("node_id", shown.alias("shown")).groupBy("node_id").agg(F.min("shown").alias("shown"))
    ends = g.of("ALIAS_OF").join(names.select(F.col("node_id").alias("from_id"), F.col("shown").alias("alias_name")), "from_id", "left").join(
        names.select(F.col("node_id").alias("to_id"), F.col("shown").alias("skill_name")), "to_id", "left"
    ).na.fill("", ["alias_name", "skill_name"])
    a, b = normalise(F.col("alias_name")), normalise(F.col("skill_name"))
    pair = F.array_sort(F.array(a, b))
    guarded = [sorted((x, y)) for x, y in g.rules.protected]
    hit = reduce(lambda p, q: p | q, ((pair[0] == x) & (pair[1] == y) for x, y in guarded), F.lit(False))
    return ends.where(hit)


@_check("fail")
def protected_distinction_violation(g: Graph) -> DataFrame:
    return _said(suspicious_aliases(g), "edge_id", _fmt("Protected distinction merged: %s -> %s", "alias_name", "skill_name"))


@_check()
def super_node(g: Graph) -> DataFrame:
    ends = g.edges.select(F.col("from_id").alias("node_id")).union(g.edges.select("to_id"))
    busy = ends.groupBy("node_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > g.rules.degree)
    return _said(busy, "node_id", _fmt(f"Node degree %s exceeds {g.rules.degree}", "n"))


@_check("quarantine")
def low_support_cooccurrence(g: Graph) -> DataFrame:
    few = (_col(g.edges, "count", "double") < g.rules.min_count) | (_col(g.edges, "npmi", "double") < g.rules.min_npmi)
    return _said(g.of("CO_OCCURS_WITH").where(few), "edge_id", "CO_OCCURS_WITH is below configured threshold")


@_check()
def same_name_different_skill_type(g: Graph) -> DataFrame:
    kinds = g.nodes.where("label = 'Skill'").groupBy("normalized_name").agg(F.count_distinct("skill_type").alias("n")).where("normalized_name is not null and n > 1")
    return _said(kinds, None, _fmt("%s has %s skill types", "normalized_name", "n"))


@_check()
def required_preferred_conflict(g: Graph) -> DataFrame:
    sets = g.job_skills().groupBy("from_id", "to_id").agg(F.sort_array(F.collect_set("label")).alias("ls"))
    both = sets.where(F.array_contains("ls", "REQUIRES") & F.array_contains("ls", "PREFERS"))
    told = F.concat(F.lit("Both REQUIRES and PREFERS: ['"), F.array_join("ls", "', '"), F.lit("']"))
    return _said(both, F.concat_ws("->", "from_id", "to_id"), told)


@_check("fail")
def evidence_not_in_jd(g: Graph) -> DataFrame:
    """Only where the jobs are given; an edge of an unknown job has no text to stand in."""
    cited = g.job_skills().where(_col(g.edges, "evidence") != "")
    if g.jobs is None:
        return _said(cited.where(F.lit(False)), "edge_id", "")
    body = F.concat_ws("\n", *(F.coalesce(_col(g.jobs, c), F.lit("")) for c in ("title", "requirements", "description")))
    texts = g.jobs.select(F.col("job_id").cast("string").alias("source_job_id"), body.alias("_body"))
    wrong = cited.join(texts, "source_job_id", "left").where(~F.contains(F.coalesce("_body", F.lit("")), F.col("evidence")))
    return _said(wrong, "edge_id", "Evidence is not a source JD substring")


def found_by(g: Graph, name: str) -> DataFrame:
    """check, severity, record_id, message of one check."""
    severity, f = CHECKS[name]
    severity = g.rules.policies.get(name, severity)
    return f(g).select(F.lit(name).alias("check"), F.lit(severity).alias("severity"), "record_id", "message")


def findings(g: Graph, names: Sequence[str] = ()) -> DataFrame:
    return G.union([found_by(g, name) for name in names or CHECKS])


def status(found: DataFrame) -> DataFrame:
    """Counts by severity and the overall verdict."""
    return found.agg(*(F.count_if(F.col("severity") == s).alias(s) for s in ("fail", "quarantine", "warn"))).withColumn(
        "status", F.when(F.col("fail") > 0, "failed").when(F.col("quarantine") + F.col("warn") > 0, "valid_with_findings").otherwise("valid")
    )


def check_counts(found: DataFrame) -> DataFrame:
    return found.groupBy("check", "severity").agg(F.count(F.lit(1)).alias("n"))


def quality_metrics(g: Graph) -> DataFrame:
    """One row: sizes, the share of jobs with a skill and of jobs with an occupation, of edges with a low confidence, of names
    that were resolved and that were not, and the number of job-skill edges."""
    at_least = lambda c: F.greatest(F.lit(1), c)
    job = F.col("label") == "Job"
    coded = F.trim(F.coalesce(_col(g.nodes, "occupation_code"), F.lit(""))) != ""
    n = g.nodes.agg(F.count(F.lit(1)).alias("node_count"), F.count_if(job).alias("_jobs"), F.count_if(job & coded).alias("_coded"))
    skilled = F.col("label").isin(*G.JOB_SKILL)
    e = g.edges.agg(
        F.count(F.lit(1)).alias("edge_count"), F.count_if(skilled).alias("skill_edge_count"), F.count_distinct(F.when(skilled, F.col("from_id"))).alias("_with"),
        F.count_if(_col(g.edges, "confidence", "double") < g.rules.low_confidence).alias("_low"),
    )
    one = n.join(e)  # one row each
    if g.audit is not None:
        one = one.join(g.audit.agg(F.count(F.lit(1)).alias("_names"), F.count("selected").alias("_selected")))
    else:
        one = one.withColumns({"_names": F.lit(0), "_selected": F.lit(0)})
    return one.select(
        "node_count", "edge_count", "skill_edge_count", (F.col("_with") / at_least(F.col("_jobs"))).alias("extraction_coverage"), (F.col("_coded") / at_least(F.col("_jobs"))).alias("occupation_coverage"),
        (F.col("_low") / at_least(F.col("edge_count"))).alias("low_confidence_edge_rate"), (F.col("_selected") / at_least(F.col("_names"))).alias("canonicalization_rate"),
        ((F.col("_names") - F.col("_selected")) / at_least(F.col("_names"))).alias("unresolved_skill_rate"),
    )


#: Whose edges are put aside; edges without evidence are found, but stay.
_ASIDE = (
    "duplicate_edge_ids", "dangling_edges", "invalid_edge_labels", "invalid_edge_endpoints", "invalid_confidence", "invalid_weight", "source_job_missing", "low_support_cooccurrence", "evidence_not_in_jd",
)


#: Up to so many hashes of ids are sent to the rows.
FEW = 4_000_000


def _having(rows: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Different rows whose key is among `ids` (record_id). While these are few, their hashes are sent to the rows, so that only those few
    that can be meant are dealt out."""
    ids = materialise(ids.where("record_id is not null").distinct())
    if ids.count() <= FEW:
        rows = rows.join(F.broadcast(ids.select(F.xxhash64("record_id").alias("_h"))), F.xxhash64(key) == F.col("_h"), "left_semi")
    return rows.join(ids, F.col(key) == F.col("record_id"), "left_semi").dropDuplicates()


def invalid_nodes(g: Graph) -> DataFrame:
    """Rows of nodes that repeat, have an unknown label, or are jobs from outside the training split; each once."""
    g = g if g.kept else replace(g, nodes=materialise(g.nodes), kept=True)  # no edges are read
    ids = G.union([CHECKS[c][1](g).select("record_id") for c in ("duplicate_node_ids", "invalid_node_labels")] + [_leaked_jobs(g).select(F.col("node_id").alias("record_id"))])
    return _having(g.nodes, "node_id", ids)


def invalid_edges(g: Graph) -> DataFrame:
    g = g if g.kept else replace(g, nodes=g.nodes.select("node_id", "label", *(c for c in ("job_id",) if c in g.nodes.columns)), edges=g.edges).stored()
    return _having(g.edges, "edge_id", findings(g, _ASIDE).select("record_id"))


def unresolved(audit: DataFrame) -> DataFrame:
    return audit.where("selected is null")


def report(g: Graph, most: int = 1000) -> tuple[dict, str]:
    """The report as a dictionary and as Markdown; of the findings the first `most` by check and record are listed, the
    counts are of all."""
    g = g.stored()
    found = findings(g).persist()
    try:
        sums = status(found).first().asDict()
        out = {
            "status": sums.pop("status"), "severity_counts": sums, "quality_metrics": quality_metrics(g).first().asDict(),
            "finding_counts": {r.check: r.n for r in check_counts(found).orderBy("check").collect()},  # a row for each check
            "findings": [r.asDict() for r in found.orderBy("check", "record_id", "message").limit(most).collect()],
            "auto_deleted_records": 0,
        }
    finally:
        found.unpersist()
    m = out["quality_metrics"]
    lines = [
        "# Graph Quality Report", "", f"- Status: `{out['status']}`", f"- Nodes: {m['node_count']}", f"- Edges: {m['edge_count']}",
        *(f"- {c.replace('_', ' ').capitalize()}: {m[c]:.3f}" for c in ("extraction_coverage", "canonicalization_rate", "unresolved_skill_rate")), "", "## Findings", "",
        *(f"- **{f['severity']}** `{f['check']}` {f['record_id'] or ''}: {f['message']}" for f in out["findings"]),
    ]
    return out, "\n".join(lines) + "\n"
