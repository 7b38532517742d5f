"""From the six raw tables to canonical jobs, queries and labels, with profiles, as Parquet and JSON."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestar.functions.text import clean, query_id, trimmed
from lodestar.operators import behaviour as B
from lodestar.sources import files
from lodestar.sources.shared import materialise, scratch

#: Columns of the canonical tables, in order.
JOBS = (
    "job_id", "title", "requirements", "description", "posted_at", "location_code", "occupation_code", "data_split", "duty_major", "duty_middle", "duty_minor", "location_name", "job_type", "salary_min", "salary_max",
    "education", "experience", "computer_skills", "certifications", "work_skills", "additional_requirements", "company_id", "industry_major", "industry_middle", "industry_minor",
)
TRAIN_JOBS = JOBS[:8]
QUERIES = ("query_id", "query", "query_time", "session_id", "location_code", "occupation_code", "exposed_jobs", "exposed_ranks", "data_split")
LABELS = ("query_id", "job_id", "relevance", "original_rank", "data_split", "viewed", "applied", "content_available_at_query")
#: What requirements are joined from.
PARTS = ("computer_skills", "certifications", "work_skills", "additional_requirements", "education", "experience")


@dataclass(frozen=True)
class Config:
    train_end: str
    validation_end: str
    test_end: str | None = None
    browse_window: str = "60 MINUTES"
    apply_window: str = "24 HOURS"
    negatives: int = 20
    only_positive: bool = True
    strict: bool = True
    sample: int | None = None
    jobs_scope: str = "all"

    def __post_init__(self):
        ends = [dt.datetime.fromisoformat(e) for e in (self.train_end, self.validation_end, self.test_end) if e is not None]
        if any(a >= b for a, b in zip(ends, ends[1:])):
            raise ValueError("the splits must end one after the other: training, validation, test")
        if self.negatives < 0 or (self.sample is not None and self.sample <= 0):
            raise ValueError("the number of negatives can't be negative, that of sampled queries must be positive")
        for w in (self.browse_window, self.apply_window):
            n, _, unit = w.partition(" ")
            if not n.isdigit() or int(n) <= 0 or not unit.isalpha():
                raise ValueError("a window is a positive number and a unit")
        if self.jobs_scope not in ("all", "exposed"):
            raise ValueError("jobs_scope is all or exposed")


def _text(c: str) -> Column:
    return F.coalesce(trimmed(F.col(c).cast("string")), F.lit(""))


def _cleaned(c: str) -> Column:
    return F.coalesce(clean(F.col(c)), F.lit(""))


def _user(c: str) -> Column:
    t = _text(c)
    return F.when(~t.isin("", "0"), t)


def stage_queries(search: DataFrame, cfg: Config) -> DataFrame:
    """Typed searches with a time and a text. The id hashes what a search holds and its number among equal ones (from 1),
    so repeated searches have ids of their own and no order of rows is needed; searches without a user count as anonymous."""
    rows = search if cfg.sample is None else B.sample_rows(search, cfg.sample)
    typed = rows.select(
        _user("talentNo").alias("talent_key"), _text("ks").alias("query"), _text("c0").alias("location_code"), _text("d0").alias("occupation_code"),
        F.col("search_time").try_cast("timestamp_ntz").alias("query_time"), _text("empStr").alias("exposed_jobs"),
    ).where("query_time is not null and query != ''")
    parts = [F.coalesce("talent_key", F.lit("anonymous")), *(F.col(c).cast("string") for c in ("query_time", "query", "location_code", "occupation_code", "exposed_jobs"))]
    keyed = typed.withColumn("_key", F.md5(F.concat_ws("|", *parts)))
    at = F.row_number().over(Window.partitionBy("_key").orderBy("_key"))
    numbered = keyed.withColumn("_at", at)
    return numbered.select(query_id(F.col("_at").cast("string"), *parts).alias("query_id"), *typed.columns, B.time_split(F.col("query_time"), cfg.train_end, cfg.validation_end).alias("data_split"))


def stage_events(rows: DataFrame, job: str, user: str, time: str) -> DataFrame:
    typed = rows.select(_user(user).alias("talent_key"), _text(job).alias("job_id"), F.col(time).try_cast("timestamp_ntz").alias("event_time"))
    return typed.where("talent_key is not null and job_id != '' and event_time is not null")


def city_codes(cities: DataFrame) -> DataFrame:
    """(name, code): of the codes of one name one of type 2, then the shortest, then the smallest."""
    rows = cities.select(_text("CodeNameA").alias("name"), _text("CodeNo").alias("code"), _text("CodeType").alias("kind")).where("name != ''")
    return B.first_by(rows, ["name"], F.when(F.col("kind") == "2", 0).otherwise(1), F.length("code"), F.col("code")).select("name", "code")


def duty_codes(duties: DataFrame) -> DataFrame:
    """(name, code): of the codes of one name the longest, then the smallest."""
    rows = duties.select(_text("CodeNameA").alias("name"), _text("CodeNo").alias("code")).where("name != ''")
    return B.first_by(rows, ["name"], F.length("code").desc(), F.col("code")).select("name", "code")


def stage_jobs(jobs: DataFrame, columns: Mapping[str, str], cfg: Config, cities: DataFrame | None = None, duties: DataFrame | None = None, shown: DataFrame | None = None) -> DataFrame:
    """Typed jobs with an id and a time of change. `columns`: source columns by logical names; those that lack are empty.

    The names of city and duty are replaced by their codes where `cities` and `duties` have them; requirements joins its
    parts with ' | ', empty ones too; the split follows from the time of change. With `shown` (job_id) only these jobs."""
    raw = jobs.select(*(F.col(f"`{v}`").cast("string").alias(f"_{k}") for k, v in columns.items()))
    if shown is not None:
        raw = raw.join(shown.select(F.col("job_id").alias("_job_id")).distinct(), "_job_id", "left_semi")
    for source, codes, made in (("_location_code", cities, "_city"), ("_duty_minor", duties, "_duty")):
        if codes is not None and source in raw.columns:
            dim = codes.select(F.col("name").alias("_name"), F.col("code").alias(made))
            raw = raw.join(dim, trimmed(F.col(source)) == F.col("_name"), "left").drop("_name")
        else:
            raw = raw.withColumn(made, F.lit(None).cast("string"))
    text = lambda k: _cleaned(f"_{k}") if f"_{k}" in raw.columns else F.lit("")
    money = lambda k: clean(F.col(f"_{k}")).try_cast("double") if f"_{k}" in raw.columns else F.lit(None).cast("double")
    derived = {
        "job_id": F.col("_job_id"), "requirements": trimmed(F.concat_ws(" | ", *(text(p) for p in PARTS))), "posted_at": F.col("last_modified_at").cast("string"),
        "location_code": F.coalesce("_city", text("location_code")), "occupation_code": F.coalesce("_duty", text("duty_minor")), "location_name": text("location_code"),
        "data_split": B.time_split(F.col("last_modified_at"), cfg.train_end, cfg.validation_end), "salary_min": money("salary_min"), "salary_max": money("salary_max"),
    }
    if "_requirements" in raw.columns:
        derived["requirements"] = text("requirements")
    typed = raw.withColumn("last_modified_at", F.col("_last_modified_at").try_cast("timestamp_ntz")).where("_job_id is not null and last_modified_at is not null")
    return typed.select(*(derived.get(c, text(c)).alias(c) for c in JOBS), "last_modified_at")


def exported_queries(queries: DataFrame) -> DataFrame:
    """Queries as they go out: without users, lists joined by bars, times as text."""
    n = F.size(F.split("exposed_jobs", ","))
    return queries.select(
        "query_id", "query", F.col("query_time").cast("string").alias("query_time"), F.col("query_id").alias("session_id"), "location_code", "occupation_code",
        F.replace("exposed_jobs", F.lit(","), F.lit("|")).alias("exposed_jobs"), F.array_join(F.sequence(F.lit(1), n).cast("array<string>"), "|").alias("exposed_ranks"), "data_split",
    )


def labels(queries: DataFrame, jobs: DataFrame, browses: DataFrame, applies: DataFrame, cfg: Config, attributed: DataFrame | None = None) -> DataFrame:
    attributed = attributed if attributed is not None else B.attribute_logs(browses, applies, queries, cfg.browse_window, cfg.apply_window)
    return B.candidate_labels(queries, jobs, B.graded(attributed), cfg.negatives, cfg.strict, cfg.only_positive).select(*LABELS)


# --- profiles: one row each -----------------------------------------------------------------------------------------


def _n() -> Column:
    return F.count(F.lit(1)).alias("row_count")


def _times(c: str, name: str) -> list[Column]:
    t = F.col(c).try_cast("timestamp_ntz")
    return [F.min(t).alias(f"min_{name}"), F.max(t).alias(f"max_{name}")]


def profile_jobs(jobs: DataFrame, columns: Mapping[str, str] = files.JOB_COLUMNS, test_end: str | None = None) -> DataFrame:
    c = columns
    late = F.count_if(F.col(c["last_modified_at"]).try_cast("timestamp_ntz") >= F.lit(test_end).cast("timestamp_ntz")) if test_end else F.lit(None).cast("long")
    return jobs.agg(
        _n(), F.count_distinct(c["job_id"]).alias("distinct_jobs"), F.count_if(_text(c["title"]) == "").alias("empty_title"), F.count_if(_text(c["description"]) == "").alias("empty_description"),
        *_times(c["last_modified_at"], "modified"), late.alias("modified_after_behavior_period"),
    )


def profile_search(search: DataFrame) -> DataFrame:
    shown = F.when(_text("empStr") == "", 0).otherwise(F.size(F.split("empStr", ",")))
    return search.agg(
        _n(), F.count_if(_text("ks") == "").alias("empty_query"), F.count_if(_text("empStr") == "").alias("empty_results"), F.count_if(_user("talentNo").isNull()).alias("anonymous_queries"),
        F.sum(shown).alias("exposure_count"), F.avg(shown).alias("average_results"), F.max(shown).alias("max_results"), *_times("search_time", "time"),
    )


def profile_events(rows: DataFrame, time: str) -> DataFrame:
    return rows.agg(_n(), F.count_if(_user("talentNo").isNull()).alias("anonymous_events"), *_times(time, "time"))


def profile_splits(rows: DataFrame) -> DataFrame:
    return rows.agg(_n(), *(F.count_if(F.col("data_split") == s).alias(s) for s in ("train", "validation", "test")))


def profile_labels(rows: DataFrame) -> DataFrame:
    return rows.agg(_n(), *(F.count_if(F.col("relevance") == r).alias(f"relevance_{r}") for r in (0, 1, 2)), F.count_distinct("query_id").alias("query_count"))


def profile_attribution(browses: DataFrame, applies: DataFrame, attributed: DataFrame) -> DataFrame:
    one = attributed.agg(
        F.count_if(F.col("kind") == "browse").alias("attributed_browse"), F.count_if(F.col("kind") == "apply").alias("attributed_apply"), F.count_distinct("query_id").alias("positive_queries")
    )
    return browses.agg(F.count(F.lit(1)).alias("browse_events")).join(applies.agg(F.count(F.lit(1)).alias("apply_events"))).join(one)  # one row each


def _one(df: DataFrame) -> dict:
    return {k: v.isoformat(" ") if isinstance(v, dt.datetime) else v for k, v in df.first().asDict().items()}


def profile_files(spark: SparkSession, found: Mapping[str, str], sizes: Mapping[str, int]) -> dict:
    """Sizes and headers alone: nothing is scanned."""
    return {name: {"path": path, "size_bytes": sizes.get(path), "header": files.header(spark, path)} for name, path in sorted(found.items())}


def profile_raw(spark: SparkSession, folder: str, cfg: Config, columns: Mapping[str, str] = files.JOB_COLUMNS) -> dict:
    """One pass over each of the six files; shown jobs are counted without being exploded."""
    sizes = dict(files.listed(spark, folder))
    found = files.discover(spark, list(sizes), files.signatures(columns))
    scan = {n: files.scan_csv(spark, p) for n, p in found.items()}
    return {
        "files": profile_files(spark, found, sizes), "jobs": _one(profile_jobs(scan["jobs"], columns, cfg.test_end)), "search": _one(profile_search(scan["search"])),
        "browse": _one(profile_events(scan["browse"], "dateIn")), "apply": _one(profile_events(scan["apply"], "datein")), "dimensions": {n: _one(scan[n].agg(_n())) for n in ("cities", "duties")},
    }


def prepare(spark: SparkSession, folder: str, out: str, cfg: Config, columns: Mapping[str, str] = files.JOB_COLUMNS, overwrite: bool = False) -> dict:
    """Write jobs, train_jobs, queries, labeled_queries, labels, cities and duties (Parquet) and the profile and manifest
    (JSON) below `out`, and return the manifest. Users are used for attribution only: the table that has them is deleted."""
    sizes = dict(files.listed(spark, folder))
    found = files.discover(spark, list(sizes), files.signatures(columns))
    inputs = [folder, *found.values()]
    files.guard(out, inputs)
    scan = {n: files.scan_csv(spark, p) for n, p in found.items()}
    write = lambda df, name, *order: files.write_parquet(df, f"{out}/{name}.parquet", inputs, overwrite, list(order))
    read = lambda name: spark.read.parquet(f"{out}/{name}.parquet")
    with scratch(spark):
        queries = materialise(stage_queries(scan["search"], cfg))
        shown = B.exposures(queries) if cfg.jobs_scope == "exposed" else None
        jobs = materialise(stage_jobs(scan["jobs"], columns, cfg, city_codes(scan["cities"]), duty_codes(scan["duties"]), shown))
        browses = stage_events(scan["browse"], "employeeNo", "talentNo", "dateIn")
        applies = stage_events(scan["apply"], "empNo", "talentNo", "datein")
        attributed = materialise(B.attribute_logs(browses, applies, queries, cfg.browse_window, cfg.apply_window).select("kind", "query_id", "job_id"))
        write(jobs.select(*JOBS), "jobs", "job_id")
        write(jobs.where("data_split = 'train'").select(*TRAIN_JOBS), "train_jobs", "job_id")
        write(exported_queries(queries), "queries", "query_time", "query_id")
        write(labels(queries, jobs, browses, applies, cfg, attributed), "labels", "query_id", "original_rank")
        write(read("queries").join(read("labels").select("query_id").distinct(), "query_id", "left_semi").select(*QUERIES), "labeled_queries", "query_time", "query_id")
        write(scan["cities"], "cities", "CodeNo")
        write(scan["duties"], "duties", "CodeNo")
        profile = {
            "raw": {
                "jobs": _one(scan["jobs"].agg(_n())), "search": _one(profile_search(scan["search"]).select("row_count", "empty_results", "anonymous_queries")),
                "browse": _one(scan["browse"].agg(_n())), "apply": _one(scan["apply"].agg(_n())),
            },
            "canonical": {
                "jobs": _one(profile_splits(read("jobs"))), "queries": _one(profile_splits(read("queries"))), "attribution": _one(profile_attribution(browses, applies, attributed)),
                "labels": _one(profile_labels(read("labels"))),
            },
        }
    manifest = {
        "created_at": dt.datetime.now(dt.UTC).isoformat(), "config": asdict(cfg), "config_hash": files.stable_hash(asdict(cfg)),
        "input_files": {n: {"path": p, "size": sizes.get(p)} for n, p in sorted(found.items())},
        "outputs": {n: f"{out}/{n}.parquet" for n in ("jobs", "train_jobs", "queries", "labeled_queries", "labels", "cities", "duties")},
        "privacy": {"users_exported": False}, "labels": {"browse_relevance": 1, "apply_relevance": 2, "exposure_without_attributed_behavior": 0, "official_ground_truth": False},
        "temporal_content_guard": cfg.strict, "profile": profile,
    }
    files.write_json(spark, f"{out}/dataset_profile.json", profile, overwrite)
    files.write_json(spark, f"{out}/dataset_manifest.json", manifest, overwrite)
    return manifest
