"""Property graph of jobs, skills, occupations and categories: nodes, edges, bounded traversal. Checks are in checks.py."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestar.functions.text import digest_id, normalise
from lodestar.sources.shared import bucketed, materialise

RELATIONS = {"required": "REQUIRES", "preferred": "PREFERS", "mentioned": "MENTIONS"}
WEIGHTS = {"required": 1.0, "preferred": 0.72, "mentioned": 0.45}
DEFAULT_WEIGHT = {"REQUIRES": 1.0, "PREFERS": 0.72, "MENTIONS": 0.45, "ALIAS_OF": 1.0, "IS_A": 0.25, "CO_OCCURS_WITH": 0.65, "CORE_SKILL": 0.75}
NODE_LABELS = ("Job", "Skill", "Occupation", "SkillCategory", "SkillAlias")
ENDS = {
    "REQUIRES": ("Job", "Skill"), "PREFERS": ("Job", "Skill"), "MENTIONS": ("Job", "Skill"), "INSTANCE_OF": ("Job", "Occupation"),
    "IS_A": ("Skill", "SkillCategory"), "ALIAS_OF": ("SkillAlias", "Skill"), "CO_OCCURS_WITH": ("Skill", "Skill"), "CORE_SKILL": ("Occupation", "Skill"),
}
JOB_SKILL = tuple(RELATIONS.values())
#: Properties of nodes by label, of all edges, and of some edges; their names are fixed values.
JOB_TEXTS = ("title", "description", "requirements", "location_code", "occupation_code", "posted_at")
NODE_PROPERTIES = {
    "Job": ("job_id", *JOB_TEXTS, "data_split", "source_hash"),
    "Occupation": ("occupation_id", "name", "occupation_code"),
    "SkillCategory": ("category_id", "name"),
    "SkillAlias": ("alias_id", "alias", "normalized_alias", "language", "first_seen_at"),
    "Skill": ("skill_id", "canonical_name", "normalized_name", "skill_type", "description", "first_seen_at", "train_frequency", "schema_version"),
}
EDGE_PROPERTIES = ("weight", "confidence", "evidence", "source_job_id", "source_file", "extraction_model", "extraction_prompt_version", "schema_version", "created_at")
PAIR_PROPERTIES = {"count": "long", "support": "double", "pmi": "double", "npmi": "double", "p_b_given_a": "double", "p_a_given_b": "double"}
CORE_PROPERTIES = {"required_rate": "double", "preferred_rate": "double", "mentioned_rate": "double", "job_count": "long"}


@dataclass(frozen=True)
class Origin:
    """Where a graph comes from; each edge says so."""

    source_file: str = ""
    extraction_model: str = "offline-mock-v1"
    schema_version: str = "1"
    created_at: str = "1970-01-01T00:00:00+00:00"


def skill_id(name: Column, kind: Column) -> Column:
    return digest_id("skill:", normalise(name), kind)


def alias_id(alias: Column) -> Column:
    return digest_id("alias:", normalise(alias))


def category_id(name: Column) -> Column:
    return F.concat(F.lit("category:"), normalise(name))


def edge_id(source: Column, label: Column, target: Column, origin: Column) -> Column:
    return digest_id("", source, label, target, origin, width=20)


def _job(c: str = "job_id") -> Column:
    return F.concat(F.lit("job:"), F.col(c).cast("string"))


def _occupation(c: Column) -> Column:
    return F.concat(F.lit("occupation:"), F.trim(c))


def _text(df: DataFrame, c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit("")) if c in df.columns else F.lit("")


def _given(df: DataFrame, c: str, kind: str) -> Column:
    return F.col(c).cast(kind) if c in df.columns else F.lit(None).cast(kind)


def source_hash(title: Column, requirements: Column, description: Column) -> Column:
    """SHA-256 of the compact JSON of the three texts, keys in order."""
    return F.sha2(F.to_json(F.struct(description.alias("description"), requirements.alias("requirements"), title.alias("title"))), 256)


def union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def conflicts(frame: DataFrame, key: str) -> DataFrame:
    """Keys that stand for rows with different properties: an upsert by key would lose one of them. Equal repeats are no
    conflict. Columns: key, versions."""
    rest = [c for c in frame.columns if c != key]
    return frame.groupBy(key).agg(F.count_distinct(F.xxhash64(*rest)).alias("versions")).where("versions > 1")


def require_one_version(frame: DataFrame, key: str) -> DataFrame:
    """`frame` with each key once; it is an error if a key has different properties."""
    bad = [str(r[0]) for r in conflicts(frame, key).select(key).limit(10).collect()]
    if bad:
        raise ValueError(f"rows with one {key} and different properties: {bad}")
    return frame.dropDuplicates([key])


def require_known_jobs(mentions: DataFrame, jobs: DataFrame) -> None:
    """The graph is built from training jobs alone, each of them once, and from mentions of these."""
    splits = F.lower(F.trim(F.coalesce("data_split", F.lit(""))))
    for frame, message in (
        (jobs.where(splits != "train"), "jobs outside the training split"),
        (jobs.groupBy("job_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "jobs that repeat"),
        (mentions.join(jobs.select("job_id"), "job_id", "left_anti"), "mentions of unknown jobs"),
    ):
        bad = [str(r[0]) for r in frame.select("job_id").limit(10).collect()]
        if bad:
            raise ValueError(f"{message}: {bad}")


#: Mentions that one task sorts, about.
MENTIONS = 250_000
_KEYS = ("skill", "skill_type", "raw_mention")


def pieces(mentions: int) -> int:
    return max(1, -(-mentions // MENTIONS))


def job_buckets(spark: SparkSession, mentions: int) -> int:
    """No fewer than a join has parts: it would deal out rows anew that come in fewer."""
    return max(pieces(mentions), int(spark.conf.get("spark.sql.shuffle.partitions")))


def by_job(job_skills: DataFrame, buckets: int) -> DataFrame:
    """`job_skills` stored with their jobs, for `nodes`, `edges` and whatever else groups by job: they then shuffle nothing wide."""
    return bucketed(job_skills, "job_id", buckets)


def _given_texts(job_skills: DataFrame) -> DataFrame:
    return job_skills.withColumns(
        {
            "raw_mention": F.coalesce("raw_mention", "skill") if "raw_mention" in job_skills.columns else F.col("skill"),
            "evidence": _text(job_skills, "evidence"),
            "posted_at": _text(job_skills, "posted_at"),
            "prompt": _text(job_skills, "extraction_prompt_version"),
        }
    )


def names(job_skills: DataFrame) -> DataFrame:
    """The distinct names of `job_skills` (skill, skill_type, raw_mention) with their normalised forms and ids, the first job that has each
    and how many mentions there are, stored: `nodes` and `edges` take it, so that rows are looked through for names only once. A name
    without a skill or a kind is none."""
    rows = _given_texts(job_skills).where("skill is not null and skill_type is not null")
    known = rows.groupBy(*_KEYS).agg(F.min("job_id").alias("_first"), F.count(F.lit(1)).alias("_times"))
    forms = known.select("*", normalise(F.col("skill")).alias("_norm"), normalise(F.col("raw_mention")).alias("_raw"), category_id(F.col("skill_type")).alias("_category"))
    return materialise(forms.select("*", digest_id("skill:", F.col("_norm"), F.col("skill_type")).alias("_skill"), F.when(F.col("_raw") != F.col("_norm"), digest_id("alias:", F.col("_raw"))).alias("_alias")))


def _named(job_skills: DataFrame, known: DataFrame) -> DataFrame:
    """`job_skills` with the ids and normalised forms of its names, which are joined back (the optimiser broadcasts them while they are
    few: then rows stay with their jobs). Rows without a skill or a kind are dropped."""
    return _given_texts(job_skills).join(known.drop("_first", "_times"), list(_KEYS))


def identified(job_skills: DataFrame, known: DataFrame) -> DataFrame:
    """(job_id, skill: its id) of `job_skills`, whose `names` are known: no name is normalised again."""
    return _named(job_skills, known).select("job_id", F.col("_skill").alias("skill"))


def nodes(jobs: DataFrame, job_skills: DataFrame, origin: Origin = Origin(), known: DataFrame | None = None) -> DataFrame:
    """One narrow frame for each label, united: node_id, label, `name` (what a reader calls it; null for jobs) and the
    NODE_PROPERTIES of all labels, null where a label has none.

    `jobs`: job_id and the JOB_TEXTS. `job_skills`: job_id, skill, skill_type, and where known raw_mention and posted_at
    (a text). Spellings that normalise alike are one skill, named as the first job names it; other names are aliases;
    the earliest posted_at, compared as text, is when a skill or alias was first seen. `known`: the `names` of `job_skills`,
    if they are there already."""
    t = {c: _text(jobs, c) for c in JOB_TEXTS}
    job_nodes = jobs.select(
        _job().alias("node_id"), F.lit("Job").alias("label"), F.col("job_id").cast("string").alias("job_id"), *(c.alias(n) for n, c in t.items()), F.lit("train").alias("data_split"),
        source_hash(t["title"], t["requirements"], t["description"]).alias("source_hash"),
    )
    code = F.trim(F.col("occupation_code"))
    occupations = jobs.where("trim(occupation_code) != ''").select(code.alias("name")).distinct().select(
        F.concat(F.lit("occupation:"), F.col("name")).alias("node_id"), F.lit("Occupation").alias("label"), "name", F.col("name").alias("occupation_code")
    ).withColumn("occupation_id", F.col("node_id"))
    known = names(job_skills) if known is None else known
    earliest = _given_texts(job_skills).groupBy(*_KEYS).agg(F.min("posted_at").alias("_seen"))
    dated = known.join(earliest, list(_KEYS)) if "posted_at" in job_skills.columns else known.withColumn("_seen", F.lit(""))
    seen = F.min("_seen").alias("first_seen_at")
    # A job's skills are told apart where the job is; what comes of names alone is taken from the names.
    frequency = _named(job_skills, known).select("job_id", "_skill").where("job_id is not null").distinct().groupBy("_skill").agg(F.count(F.lit(1)).alias("train_frequency"))
    called = dated.groupBy("_skill", "skill_type").agg(F.min(F.struct("_first", "skill"))["skill"].alias("name"), F.first("_norm").alias("normalized_name"), seen)
    skills = called.join(frequency, "_skill", "left").na.fill(0, ["train_frequency"]).withColumnRenamed("_skill", "node_id").withColumns(
        {"label": F.lit("Skill"), "skill_id": F.col("node_id"), "canonical_name": F.col("name"), "description": F.lit(""), "schema_version": F.lit(origin.schema_version)}
    )
    kinds = known.groupBy(F.col("_category").alias("node_id")).agg(F.min("skill_type").alias("name")).withColumns({"label": F.lit("SkillCategory"), "category_id": F.col("node_id")})
    aliases = dated.where("_alias is not null").groupBy(F.col("_alias").alias("node_id")).agg(F.min("raw_mention").alias("name"), F.first("_raw").alias("normalized_alias"), seen).withColumns(
        {"label": F.lit("SkillAlias"), "alias_id": F.col("node_id"), "alias": F.col("name"), "language": F.lit("und")}
    )
    every = union([job_nodes, occupations, skills, kinds, *([aliases] if "raw_mention" in job_skills.columns else [])])
    order = dict.fromkeys(["node_id", "label", "name", *(p for ps in NODE_PROPERTIES.values() for p in ps)])
    return every.select(*(c for c in order if c in every.columns))


def _edge(frame: DataFrame, source: Column, target: Column, label: Column, tell: Column, made: Origin, weight: Column, confidence: Column, evidence: Column, job: Column, prompt: Column, **more: Column) -> DataFrame:
    """`tell` tells edges of the same label between the same nodes apart."""
    named = frame.select(
        source.alias("from_id"), target.alias("to_id"), label.alias("label"), weight.cast("double").alias("weight"), confidence.cast("double").alias("confidence"), evidence.alias("evidence"), job.alias("source_job_id"),
        F.lit(made.source_file).alias("source_file"), F.lit(made.extraction_model).alias("extraction_model"), prompt.alias("extraction_prompt_version"),
        F.lit(made.schema_version).alias("schema_version"), F.lit(made.created_at).alias("created_at"), *(c.alias(n) for n, c in more.items()), tell.alias("_tell"),
    )
    return named.select(edge_id(F.col("from_id"), F.col("label"), F.col("to_id"), F.col("_tell")).alias("edge_id"), "*").drop("_tell")


def edges(
    jobs: DataFrame, job_skills: DataFrame, pairs: DataFrame | None = None, core: DataFrame | None = None, train_start: str | None = None, train_end: str | None = None, origin: Origin = Origin(),
    known: DataFrame | None = None, dealt: bool = False,
) -> DataFrame:
    """edge_id, from_id, to_id, label, EDGE_PROPERTIES and what some labels have besides: job-skill edges (importance,
    requirement, raw_mention; weighted by level, importance and confidence), INSTANCE_OF, IS_A, ALIAS_OF,
    CO_OCCURS_WITH (PAIR_PROPERTIES, train_start, train_end) and CORE_SKILL (CORE_PROPERTIES).

    `jobs`: job_id, occupation_code; `job_skills` as for `nodes`, and requirement, importance, confidence, and where known
    evidence and extraction_prompt_version. Of mentions that give one edge the one of the greatest importance, then
    confidence, then evidence counts. `pairs` has the ids of two skills and the PAIR_PROPERTIES; `core` has
    occupation_code, the skill's id, core_skill_weight and the CORE_PROPERTIES. `known` as for `nodes`. `dealt`: `job_skills` is a table bucketed by job_id
    (`by_job`), so mentions are with their jobs already."""
    known = names(job_skills) if known is None else known
    rows = _named(job_skills, known)
    # Texts are compared by sorting, and Spark would sort what each task has read before it deals it out. So mentions come to their
    # jobs first, so many to a task that what it sorts stays the same size whatever there is.
    if not dealt:
        rows = rows.repartition(pieces(known.agg(F.sum("_times")).first()[0] or 0), "job_id")
    period = F.lit(f"{train_start}|{train_end}")
    level = F.create_map(*(F.lit(x) for kv in WEIGHTS.items() for x in kv))[F.col("requirement")]
    relation = F.create_map(*(F.lit(x) for kv in RELATIONS.items() for x in kv))[F.col("requirement")]
    best = F.max(F.struct("importance", "confidence", "evidence", "raw_mention", "prompt")).alias("m")
    once = rows.groupBy("job_id", "_skill", "requirement", "_raw").agg(best).select("*", "m.*")
    key = F.col("job_id").cast("string")
    named = _edge(
        once, _job(), F.col("_skill"), relation, F.concat_ws(":", "job_id", "_raw"), origin, level * F.col("importance") * F.col("confidence"), F.col("confidence"), F.col("evidence"), key, F.col("prompt"),
        importance=F.col("importance").cast("double"), requirement=F.col("requirement"), raw_mention=F.col("raw_mention"),
    )
    of = jobs.where("trim(occupation_code) != ''").select("job_id", F.trim("occupation_code").alias("o")).distinct()
    instance = _edge(of, _job(), _occupation(F.col("o")), F.lit("INSTANCE_OF"), key, origin, F.lit(1.0), F.lit(1.0), F.col("o"), key, F.lit("deterministic-structure-v1"))
    kinds = known.select("_skill", "_category", "skill_type").distinct()
    is_a = _edge(kinds, F.col("_skill"), F.col("_category"), F.lit("IS_A"), F.col("skill_type"), origin, F.lit(1.0), F.lit(1.0), F.col("skill_type"), F.lit(""), F.lit("deterministic-category-v1"))
    frames = [named, instance, is_a]
    if "raw_mention" in job_skills.columns:
        first = F.min(F.struct("job_id", "confidence", "evidence", "prompt")).alias("m")
        # Only the first job of an alias can give its edge, so the mentions of other jobs are left out before texts are compared.
        of_alias = known.where("_alias is not null").groupBy("_alias", "_skill", "_raw").agg(F.min("_first").alias("_first"))
        told = known.where("_alias is not null").drop("_first", "_times").join(of_alias, ["_alias", "_skill", "_raw"])
        first_rows = _given_texts(job_skills).join(told, list(_KEYS)).where(F.col("job_id").eqNullSafe(F.col("_first")))
        aliases = first_rows.groupBy("_alias", "_skill", "_raw").agg(first).select("*", "m.*")
        frames.append(_edge(aliases, F.col("_alias"), F.col("_skill"), F.lit("ALIAS_OF"), F.col("_raw"), origin, F.lit(1.0), F.col("confidence"), F.col("evidence"), key, F.col("prompt")))
    if pairs is not None:
        given = {c: _given(pairs, c, k) for c, k in PAIR_PROPERTIES.items()}
        frames.append(
            _edge(
                pairs, F.least("skill_a", "skill_b"), F.greatest("skill_a", "skill_b"), F.lit("CO_OCCURS_WITH"), period, origin, F.greatest(F.lit(0.0), F.col("npmi")), F.lit(1.0),
                F.concat(F.lit("train co-occurrence count="), F.coalesce(given["count"].cast("string"), F.lit(""))), F.lit(""), F.lit("deterministic-cooccurrence-v1"),
                **given, train_start=F.lit(train_start).cast("string"), train_end=F.lit(train_end).cast("string"),
            )
        )
    if core is not None:
        given = {c: _given(core, c, k) for c, k in CORE_PROPERTIES.items()}
        frames.append(
            _edge(
                core.where("trim(occupation_code) != ''"), _occupation(F.col("occupation_code")), F.col("skill"), F.lit("CORE_SKILL"), period, origin, F.col("core_skill_weight"), F.lit(1.0),
                F.concat(F.lit("train occupation aggregation over "), F.coalesce(given["job_count"].cast("string"), F.lit("")), F.lit(" jobs")), F.lit(""), F.lit("deterministic-core-skill-v1"), **given,
            )
        )
    return union(frames)


def manifest(n: DataFrame, e: DataFrame) -> DataFrame:
    return n.groupBy("label").agg(F.count(F.lit(1)).alias("rows")).select(F.lit("node").alias("kind"), "label", "rows").union(
        e.groupBy("label").agg(F.count(F.lit(1)).alias("rows")).select(F.lit("edge").alias("kind"), "label", "rows")
    )


def skill_dictionary(n: DataFrame) -> DataFrame:
    return n.where("label = 'Skill'").select("skill_id", "canonical_name", "normalized_name", "skill_type", "description", "first_seen_at", "train_frequency")


def alias_dictionary(n: DataFrame, e: DataFrame) -> DataFrame:
    to = e.where("label = 'ALIAS_OF'").select(F.col("from_id").alias("alias_id"), F.col("to_id").alias("skill_id")).distinct()
    return n.where("label = 'SkillAlias'").select("alias_id", "alias", "normalized_alias", "language", "first_seen_at").join(to, "alias_id")


# --- retrieval ----------------------------------------------------------------------------------------------------


def weight_of(label: str = "label", weight: str = "weight") -> Column:
    """Null weights take the label's default, negative ones 0."""
    default = F.coalesce(F.create_map(*(F.lit(x) for kv in DEFAULT_WEIGHT.items() for x in kv))[F.col(label)], F.lit(1.0))
    return F.greatest(F.coalesce(F.col(weight), default), F.lit(0.0))


def _adjacent(e: DataFrame, among: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Edges to jobs from skills (job, skill, label, w) and from occupations (job, anchor, w), of the jobs `among` (job) alone if
    they are given; and co-occurrences both ways (a, b, wr)."""
    own = lambda df: df if among is None else df.join(among.select("job").distinct(), "job", "left_semi")
    js = own(e.where(F.col("label").isin(*JOB_SKILL)).select(F.col("from_id").alias("job"), F.col("to_id").alias("skill"), "label", weight_of().alias("w")))
    of = own(e.where("label = 'INSTANCE_OF'").select(F.col("from_id").alias("job"), F.col("to_id").alias("anchor"), weight_of().alias("w")))
    co = e.where("label = 'CO_OCCURS_WITH'").select("from_id", "to_id", weight_of().alias("wr"))
    return js, of, co.select(F.col("from_id").alias("a"), F.col("to_id").alias("b"), "wr").union(co.select("to_id", "from_id", "wr"))


def best_jobs(e: DataFrame, anchors: DataFrame, k: int = 50, hops: int = 2, decay: float = 0.7, occupations: DataFrame | None = None) -> DataFrame:
    """The k jobs of each query with the highest sums of the scores of all `paths` (score descending, job): what `candidates` gives of
    these, without a row for each path.

    The paths of a query to one skill differ only in how they get there. So they are summed up there first, to one row for each
    query and reached skill (how many ways, their sum, the best), and what a job gets from a skill is this times the edge. Reached
    skills are few beside edges: they are stored, so that their size is known, and while they are small they are sent to the edges: no edge is
    shuffled by its skill, and a popular skill is no hot key."""
    if hops not in (1, 2):
        raise ValueError("hops is 1 or 2")
    js, of, both = _adjacent(e)
    near = anchors.select("query_id", F.col("skill_id").alias("node"))
    ways = near.select("query_id", "node", F.lit(1.0).alias("u"))
    if hops == 2:
        ways = ways.union(near.join(both, near.node == both.a).select("query_id", "b", F.col("wr") * decay))
    weighed = (F.max("u").alias("most"), F.count(F.lit(1)).alias("n"))
    reached = ways.groupBy("query_id", "node").agg(F.sum("u").alias("total"), *weighed).withColumn("skill", F.lit(True))
    ends = js.select("job", F.col("skill").alias("node"), F.lit(True).alias("skill"), "w")
    if occupations is not None:
        named = occupations.select("query_id", F.col("occupation").alias("node"), F.lit(1.0).alias("u")).groupBy("query_id", "node").agg(F.sum("u").alias("total"), *weighed)
        reached = reached.unionByName(named.withColumn("skill", F.lit(False)))
        ends = ends.unionByName(of.select("job", F.col("anchor").alias("node"), F.lit(False).alias("skill"), "w"))
    reached, where = materialise(reached), ["node", "skill"]
    # An edge comes to its job once, however many queries reach it, and is told apart and summed up there.
    own = ends.join(reached.select(*where).distinct(), where, "left_semi").repartition("job")
    once = own.groupBy("job", *where).agg(F.sum("w").alias("w"), F.max("w").alias("top"), F.count(F.lit(1)).alias("times"))
    sums = once.join(reached, where).groupBy("query_id", "job").agg(
        F.sum(F.col("total") * F.col("w")).alias("score"), F.count_if("skill").alias("anchors"), F.max(F.col("most") * F.col("top")).alias("best"), F.sum(F.col("n") * F.col("times")).alias("traces")
    )
    order = Window.partitionBy("query_id").orderBy(F.round("score", 9).desc(), "job")
    return sums.select("*", F.row_number().over(order).alias("rank")).where(F.col("rank") <= k)


def paths(e: DataFrame, anchors: DataFrame, hops: int = 2, decay: float = 0.7, occupations: DataFrame | None = None, among: DataFrame | None = None) -> DataFrame:
    """Traces from anchor skills (query_id, skill_id) to jobs: directly, and through one co-occurring skill with the
    product of weights times `decay`; and from each query's occupation (query_id, occupation: its node) to its jobs.
    CORE_SKILL edges lead from occupations, never from skill to skill, so they add no path. Columns: query_id, job, term
    (the node that the query names), anchor (the node that the job was reached from), path, edge_types, weights, score.
    `among` (job): paths to these jobs alone; the others' edges aren't walked."""
    if hops not in (1, 2):
        raise ValueError("hops is 1 or 2")
    js, of, both = _adjacent(e, among)
    near = anchors.select("query_id", F.col("skill_id").alias("anchor"))
    one = near.join(js, near.anchor == js.skill).select(
        "query_id", "job", F.col("anchor").alias("term"), "anchor", F.array("anchor", "job").alias("path"), F.array("label").alias("edge_types"), F.array("w").alias("weights"), F.col("w").alias("score")
    )
    if occupations is not None:
        one = one.unionByName(
            occupations.select("query_id", F.col("occupation").alias("anchor")).join(of, "anchor").select(
                "query_id", "job", F.col("anchor").alias("term"), "anchor", F.array("anchor", "job").alias("path"), F.array(F.lit("INSTANCE_OF")).alias("edge_types"), F.array("w").alias("weights"), F.col("w").alias("score")
            )
        )
    if hops == 1:
        return one
    two = near.join(both, near.anchor == both.a).join(js, F.col("b") == js.skill).select(
        "query_id", "job", F.col("anchor").alias("term"), F.col("b").alias("anchor"), F.array("anchor", "b", "job").alias("path"), F.array(F.lit("CO_OCCURS_WITH"), "label").alias("edge_types"), F.array("wr", "w").alias("weights"),
        (F.col("wr") * F.col("w") * decay).alias("score"),
    )
    return one.unionByName(two)


def explained(traces: DataFrame, n: DataFrame) -> DataFrame:
    """Traces with `at`, their place among those of the same query and job, and a sentence that names what matched."""
    names = n.groupBy("node_id").agg(F.min("name").alias("name"))
    named = traces.join(names.select(F.col("node_id").alias("term"), F.col("name").alias("term_name")), "term", "left").join(names.select(F.col("node_id").alias("anchor"), F.col("name").alias("anchor_name")), "anchor", "left")
    # These sentences are output; their wording is fixed.
    skill = F.concat(F.coalesce("term_name", "term"), F.lit(" matched "), F.coalesce("anchor_name", "anchor"), F.lit("; path uses "), F.array_join("edge_types", " -> "))
    text = F.when(F.col("edge_types")[0] == "INSTANCE_OF", "Occupation constraint matched the job occupation.").otherwise(skill)
    order = Window.partitionBy("query_id", "job").orderBy(F.col("score").desc(), "explanation", F.array_join("path", "|"))
    return named.select(*traces.columns, text.alias("explanation")).select("*", F.row_number().over(order).alias("at"))


def candidates(traces: DataFrame, k: int | None = 50) -> DataFrame:
    """Jobs by the sum of their traces' scores; the best k of each query by (score descending, job). None: all, without ranks."""
    sums = traces.groupBy("query_id", "job").agg(F.sum("score").alias("score"), F.count_distinct(F.when(F.col("edge_types")[0] != "INSTANCE_OF", F.col("anchor"))).alias("anchors"), F.max("score").alias("best"), F.count(F.lit(1)).alias("traces"))
    if k is None:
        return sums
    order = Window.partitionBy("query_id").orderBy(F.round("score", 9).desc(), "job")
    return sums.select("*", F.row_number().over(order).alias("rank")).where(F.col("rank") <= k)
