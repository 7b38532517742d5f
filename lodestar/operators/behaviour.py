"""Behaviour logs: as-of attribution of actions to searches, exposures, graded labels, time splits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_join(
    events: DataFrame, queries: DataFrame, key: str, event_time: str, query_time: str, query_id: str, bucket: str = "1 day"
) -> DataFrame:
    """Each event with the latest query of its key at or before its time (ties: the largest query id), or nulls.

    Both sides meet in buckets of time, so a very busy key is spread over many tasks: the last query of each earlier
    bucket is carried forward over one row for each key and bucket. Null keys and times never match.
    """
    fields = [c for c in queries.columns if c != key]
    slot = lambda t: F.window(F.col(t).cast("timestamp"), bucket)["start"]
    q = queries.where(F.col(key).isNotNull() & F.col(query_time).isNotNull()).select(
        F.col(key).alias("_k"), F.struct(query_time, query_id, *(f for f in fields if f not in (query_time, query_id))).alias("_q"), slot(query_time).alias("_b")
    )
    e = events.where(F.col(key).isNotNull() & F.col(event_time).isNotNull()).select(
        F.col(key).alias("_k"), F.struct(*events.columns).alias("_e"), F.col(event_time).alias("_t"), slot(event_time).alias("_b")
    )
    inside = Window.partitionBy("_k", "_b").orderBy("_t", "_side", "_q").rowsBetween(Window.unboundedPreceding, 0)
    both = q.select("_k", "_b", F.col(f"_q.{query_time}").alias("_t"), F.lit(0).alias("_side"), "_q", F.lit(None).cast(e.schema["_e"].dataType).alias("_e")).unionByName(
        e.select("_k", "_b", "_t", F.lit(1).alias("_side"), F.lit(None).cast(q.schema["_q"].dataType).alias("_q"), "_e")
    )
    ends = both.groupBy("_k", "_b").agg(F.max("_q").alias("_end"))  # one row for each key and bucket
    earlier = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("_k", "_b", F.last("_end", ignorenulls=True).over(earlier).alias("_before"))
    near = both.select("_k", "_b", "_side", "_e", F.last("_q", ignorenulls=True).over(inside).alias("_near")).where("_side = 1")
    match = F.coalesce("_near", "_before")
    return near.join(carried, ["_k", "_b"]).select("_e.*", *(match[f].alias(f) for f in fields))


def attribute(events: DataFrame, queries: DataFrame, within: str | dict[str, str]) -> DataFrame:
    """Last-touch attribution: first the latest search of the user, then the window and the exposure are checked; there
    is no second choice. Columns: talent_key, job_id, event_time; talent_key, query_id, query_time, exposed_jobs.
    `within` is one window, or windows by the `kind` of events, so that several logs take one as-of join."""
    joined = asof_join(events, queries, "talent_key", "event_time", "query_time", "query_id")
    inside = lambda w: F.col("event_time") <= F.col("query_time") + F.expr(f"INTERVAL {w}")
    if isinstance(within, str):
        timely = inside(within)
    else:
        timely = reduce(lambda a, b: a | b, ((F.col("kind") == kind) & inside(w) for kind, w in within.items()))
    return joined.where(timely & F.array_contains(F.split("exposed_jobs", ","), F.col("job_id")))


def attribute_logs(browses: DataFrame, applies: DataFrame, queries: DataFrame, browse_window: str, apply_window: str) -> DataFrame:
    """Both logs attributed in one as-of join; `kind` is browse or apply."""
    events = browses.withColumn("kind", F.lit("browse")).unionByName(applies.withColumn("kind", F.lit("apply")))
    return attribute(events, queries, {"browse": browse_window, "apply": apply_window})


def graded(attributed: DataFrame) -> DataFrame:
    """Graded positives of attributed logs: viewed 1, applied 2, the best for each query and job."""
    applied = F.col("kind") == "apply"
    return attributed.groupBy("query_id", "job_id").agg(F.max(F.when(applied, 2).otherwise(1)).alias("relevance"), F.max(~applied).alias("viewed"), F.max(applied).alias("applied"))


def positives(browses: DataFrame, applies: DataFrame) -> DataFrame:
    """Graded positives: viewed 1, applied 2, the best for each query and job."""
    graded = browses.select("query_id", "job_id", F.lit(1).alias("relevance"), F.lit(True).alias("viewed"), F.lit(False).alias("applied")).unionByName(
        applies.select("query_id", "job_id", F.lit(2).alias("relevance"), F.lit(False).alias("viewed"), F.lit(True).alias("applied"))
    )
    return graded.groupBy("query_id", "job_id").agg(*(F.max(c).alias(c) for c in ("relevance", "viewed", "applied")))


def exposures(queries: DataFrame, *more: str) -> DataFrame:
    """One row for each shown job with its place from 1; places count blanks, which then go."""
    shown = queries.select("query_id", "query_time", *more, F.posexplode(F.split("exposed_jobs", ",")).alias("pos", "job"))
    return shown.select("query_id", "query_time", *more, F.trim("job").alias("job_id"), (F.col("pos") + 1).cast("int").alias("original_rank")).where("job_id != ''")


def candidate_labels(queries: DataFrame, jobs: DataFrame, positive: DataFrame, cap: int = 20, strict: bool = True, only_positive: bool = True) -> DataFrame:
    """Shown jobs, graded; at most `cap` negatives for each query, in the shown order. `only_positive`: of queries
    with a positive alone. Jobs changed after the query (strict) and unknown jobs go first; content_available_at_query
    says for each row whether the job's text is not younger than the query. Columns that `queries` has as data_split come along."""
    split = [c for c in ("data_split",) if c in queries.columns]
    shown = exposures(queries, *split)
    if only_positive:
        shown = shown.join(positive.select("query_id").distinct(), "query_id", "left_semi")
    known = shown.join(jobs.select("job_id", "last_modified_at"), "job_id").withColumn("content_available_at_query", F.col("last_modified_at") <= F.col("query_time"))
    if strict:
        known = known.where("content_available_at_query")
    graded_ = known.join(positive, ["query_id", "job_id"], "left").select(
        "query_id", "job_id", F.coalesce("relevance", F.lit(0)).alias("relevance"), "original_rank", *split,
        F.coalesce("viewed", F.lit(False)).alias("viewed"), F.coalesce("applied", F.lit(False)).alias("applied"), "content_available_at_query",
    )
    seen = Window.partitionBy("query_id").orderBy("original_rank", "job_id").rowsBetween(Window.unboundedPreceding, 0)
    negatives = F.sum(F.when(F.col("relevance") == 0, 1).otherwise(0)).over(seen)
    return graded_.withColumn("n", negatives).where((F.col("relevance") > 0) | (F.col("n") <= cap)).drop("n")


def time_split(time: Column, train_end: str, validation_end: str) -> Column:
    """train, validation, or test for all that is later."""
    return F.when(time < F.lit(train_end).cast("timestamp_ntz"), "train").when(time < F.lit(validation_end).cast("timestamp_ntz"), "validation").otherwise("test")


def first_by(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in the order given."""
    return df.select("*", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).alias("_rn")).where("_rn = 1").drop("_rn")


def sample_rows(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """Exactly n rows (or all) that depend on the rows and the seed alone."""
    return df.orderBy(F.xxhash64(F.lit(seed), *df.columns), *df.columns).limit(n)
