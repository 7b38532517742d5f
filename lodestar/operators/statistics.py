"""Co-occurrence of skills in jobs, and core skills of occupations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.sources.shared import materialise

#: Rows of jobs' skills that one task holds, about.
ROWS = 500_000


def require_train(df: DataFrame, split: str = "data_split") -> None:
    """Raise if a row isn't from the training split."""
    bad = df.where(F.lower(F.trim(F.col(split))) != "train").limit(10).count()
    if bad:
        raise ValueError("rows outside the training split")


def cooccurrence(job_skills: DataFrame, min_count: int = 5, min_npmi: float = 0.1, among: DataFrame | None = None) -> DataFrame:
    """Pairs of skills of the same jobs: count, support, PMI, NPMI and both conditional probabilities.

    Jobs are counted among all rows, those without skills too. Each job's skills are one short array, stored, from which pairs
    are made; pairs are counted before the shuffle. NPMI is 0 for a pair that all jobs have. `among` (skill): pairs that
    have one of these skills alone, with the same figures; the others aren't made.
    """
    given = F.struct("skill", F.lit(True).alias("in"))
    if among is not None:
        job_skills = job_skills.join(among.select("skill", F.lit(True).alias("_in")).distinct(), "skill", "left")
        given = F.struct("skill", F.coalesce("_in", F.lit(False)).alias("in"))
    per_job = materialise(job_skills.groupBy("job_id").agg(F.array_sort(F.collect_set(F.when(F.col("skill").isNotNull(), given))).alias("skills")).where(F.col("job_id").isNotNull()))
    total = per_job.agg(F.count(F.lit(1)).alias("total"))
    freq = per_job.select(F.explode("skills.skill").alias("skill")).groupBy("skill").agg(F.count(F.lit(1)).alias("n"))
    later = lambda s, i: F.filter(F.slice("skills", i + 2, F.size("skills")), lambda t: s["in"] | t["in"])
    rest = F.transform("skills", lambda s, i: F.transform(later(s, i), lambda t: F.struct(s["skill"].alias("a"), t["skill"].alias("b"))))
    pairs = per_job.select(F.explode(F.flatten(rest)).alias("p")).groupBy(F.col("p.a").alias("skill_a"), F.col("p.b").alias("skill_b")).agg(F.count(F.lit(1)).alias("count"))
    joined = (
        pairs.where(F.col("count") >= min_count)
        .join(freq.select(F.col("skill").alias("skill_a"), F.col("n").alias("na")), "skill_a")
        .join(freq.select(F.col("skill").alias("skill_b"), F.col("n").alias("nb")), "skill_b")
        .crossJoin(F.broadcast(total))  # one row
    )
    p = F.col("count") / F.col("total")
    pmi = F.log(F.col("count") * F.col("total") / (F.col("na") * F.col("nb")))
    return joined.select(
        "skill_a", "skill_b", "count", p.alias("support"), pmi.alias("pmi"),
        F.when(p >= 1, 0.0).otherwise(pmi / -F.log(p)).alias("npmi"),
        (F.col("count") / F.col("na")).alias("p_b_given_a"), (F.col("count") / F.col("nb")).alias("p_a_given_b"),
    ).where(F.col("npmi") >= min_npmi)


def core_skills(job_skills: DataFrame) -> DataFrame:
    """For each occupation and skill: the share of the occupation's jobs that name it, and by level;
    `job_count` is the number of the occupation's jobs."""
    rows = job_skills.where("occupation_code is not null and skill is not null").select("occupation_code", "job_id", "skill", "requirement")
    jobs = materialise(job_skills.groupBy("occupation_code").agg(F.count_distinct("job_id").alias("jobs"), F.count(F.lit(1)).alias("_rows")))
    # Rows come to their jobs before they are told apart, so many to a task that what it holds stays the same size whatever there is.
    rows = rows.repartition(max(1, -(-(jobs.agg(F.sum("_rows")).first()[0] or 0) // ROWS)), "job_id")
    level = lambda r: F.max(F.when(F.col("requirement") == r, 1).otherwise(0)).alias(r)
    once = rows.groupBy("occupation_code", "skill", "job_id").agg(*map(level, ("required", "preferred", "mentioned")))
    sums = once.groupBy("occupation_code", "skill").agg(
        F.count(F.lit(1)).alias("n"), *(F.sum(r).alias(r) for r in ("required", "preferred", "mentioned"))
    )
    return sums.join(jobs, "occupation_code").select(
        "occupation_code", "skill", (F.col("n") / F.col("jobs")).alias("core_skill_weight"),
        *((F.col(r) / F.col("jobs")).alias(f"{r}_rate") for r in ("required", "preferred", "mentioned")), F.col("jobs").alias("job_count"),
    )
