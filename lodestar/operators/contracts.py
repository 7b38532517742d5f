"""Contracts of the three input tables and of search requests and answers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REQUIRED = {
    "jobs": ("job_id", "title", "requirements", "description", "posted_at", "location_code", "occupation_code", "data_split"),
    "queries": ("query_id", "query", "query_time", "location_code", "occupation_code", "exposed_jobs", "data_split"),
    "labels": ("query_id", "job_id", "relevance", "original_rank"),
}


def require_columns(df: DataFrame, columns: tuple[str, ...], what: str) -> None:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"{what} has no {', '.join(missing)}")


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Source names by logical names; blank or missing sources are errors."""
    wrong = sorted(k for k, v in mapping.items() if not v or v not in df.columns)
    if wrong:
        raise ValueError(f"no column for {', '.join(wrong)}")
    return df.select(*(F.col(v).alias(k) for k, v in mapping.items()))


def violations(jobs: DataFrame, queries: DataFrame, labels: DataFrame, train_cutoff: str | None = None) -> DataFrame:
    """(check, record_id) of all rows that break a rule."""
    for name, df in (("jobs", jobs), ("queries", queries), ("labels", labels)):
        require_columns(df, REQUIRED[name], name)
    found = lambda name, df, key: df.select(F.lit(name).alias("check"), F.col(key).cast("string").alias("record_id"))
    when = lambda c: F.try_to_timestamp(F.col(c).cast("string"))
    splits = ("train", "validation", "test")
    out = [
        found("duplicate_job", jobs.groupBy("job_id").count().where("count > 1"), "job_id"),
        found("job_time", jobs.where(when("posted_at").isNull()), "job_id"),
        found("query_time", queries.where(when("query_time").isNull()), "query_id"),
        found("relevance", labels.where(F.col("relevance").isNull() | ~F.col("relevance").isin(0, 1, 2)), "job_id"),
        found("split", jobs.where(F.col("data_split").isNull() | ~F.lower(F.trim("data_split")).isin(*splits)), "job_id"),
        found("unknown_query", labels.join(queries.select("query_id").distinct(), "query_id", "left_anti"), "query_id"),
        found("unknown_job", labels.join(jobs.select("job_id").distinct(), "job_id", "left_anti"), "job_id"),
    ]
    spans = queries.groupBy(F.lower(F.trim("data_split")).alias("s")).agg(F.min(when("query_time")).alias("first"), F.max(when("query_time")).alias("last"))
    a, b = spans.alias("a"), spans.alias("b")
    order = F.create_map(*(F.lit(x) for i, s in enumerate(splits) for x in (s, i)))
    crossed = a.join(b, order[F.col("a.s")] + 1 == order[F.col("b.s")]).where("a.last >= b.first").select(F.concat_ws("|", "a.s", "b.s").alias("id"))
    out.append(found("split_order", crossed, "id"))
    if train_cutoff:
        out.append(found("train_cutoff", queries.where((F.lower(F.trim("data_split")) == "train") & (when("query_time") > F.lit(train_cutoff).cast("timestamp"))), "query_id"))
    return reduce(DataFrame.union, out)


def request(query: str, locations: list[str] | None = None, duties: list[str] | None = None) -> dict:
    """A checked search request: 1 to 500 characters after trimming; codes trimmed, distinct, in order."""
    query = query.strip()
    if not 1 <= len(query) <= 500:
        raise ValueError("a query has 1 to 500 characters")
    codes = lambda v: list(dict.fromkeys(x.strip() for x in v if x.strip())) or None if v else None
    return {"query": query, "locations": codes(locations), "duties": codes(duties)}


def check_ranked(rows: list[tuple[int, str]]) -> None:
    """Ranks from 1 without gaps, ids only once."""
    if [r for r, _ in rows] != list(range(1, len(rows) + 1)):
        raise ValueError("ranks have gaps")
    if len({i for _, i in rows}) != len(rows):
        raise ValueError("a job appears twice")
