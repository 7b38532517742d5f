"""Ranking metrics, comparisons of two rankings, the z-score baseline, and pair features."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def metrics(ranked: DataFrame, k: int = 10, score: str = "score") -> DataFrame:
    """Per query: ndcg, precision, top1, mrr (uncut) and hit of `ranked` (query_id, job_id, relevance, score); order by
    score descending, then job_id."""
    if k <= 0:
        raise ValueError("k must be positive")
    own = Window.partitionBy("query_id").orderBy(F.col(score).desc(), "job_id")
    best = Window.partitionBy("query_id").orderBy(F.col("relevance").desc(), "job_id")
    placed = ranked.select("query_id", "relevance", F.row_number().over(own).alias("at"), F.row_number().over(best).alias("ideal"))
    gain = F.pow(F.lit(2.0), F.col("relevance")) - 1
    cut = lambda place: F.sum(F.when(F.col(place) <= k, gain / F.log2(F.col(place) + 1.0)).otherwise(0.0))
    good = F.col("relevance") > 0
    sums = placed.groupBy("query_id").agg(
        cut("at").alias("dcg"), cut("ideal").alias("idcg"),
        (F.sum(F.when(good & (F.col("at") <= k), 1).otherwise(0)) / k).alias("precision"),
        F.max(F.when((F.col("at") == 1) & good, 1.0).otherwise(0.0)).alias("top1"),
        F.min(F.when(good, F.col("at"))).alias("first"),
    )
    return sums.select(
        "query_id", F.when(F.col("idcg") > 0, F.col("dcg") / F.col("idcg")).otherwise(0.0).alias("ndcg"), "precision", "top1",
        F.coalesce(1.0 / F.col("first"), F.lit(0.0)).alias("mrr"), F.when(F.col("first") <= k, 1.0).otherwise(0.0).alias("hit"),
    )


def mean_metrics(per_query: DataFrame) -> DataFrame:
    return per_query.agg(*(F.avg(c).alias(c) for c in ("ndcg", "precision", "top1", "mrr", "hit")), F.count(F.lit(1)).alias("queries"))


def group_sizes(rows: DataFrame) -> DataFrame:
    """(query_id, n): how many rows each query has."""
    return rows.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"))


def win_loss_tie(a: DataFrame, b: DataFrame, metric: str = "ndcg") -> DataFrame:
    """How often b is better, worse or equal, over the queries of both; a query that repeats in one is an error."""
    d = F.col("d")
    return _paired(a, b, metric).agg(
        F.count_if(d > 1e-12).alias("wins"), F.count_if(d < -1e-12).alias("losses"), F.count_if(F.abs(d) <= 1e-12).alias("ties")
    )


def _paired(a: DataFrame, b: DataFrame, metric: str) -> DataFrame:
    """(query_id, d) for the queries of both; a query that repeats in one is an error."""
    for side in (a, b):
        if side.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count():
            raise ValueError("a query has several values")
    both = a.select("query_id", F.col(metric).alias("_a")).join(b.select("query_id", F.col(metric).alias("_b")), "query_id")
    return both.select("query_id", (F.col("_b") - F.col("_a")).alias("d"))


def paired_bootstrap(a: DataFrame, b: DataFrame, metric: str = "ndcg", rounds: int = 2000, seed: int = 42, most: int = 1_000_000) -> dict[str, float]:
    """Mean difference b - a over queries, its 95 % interval and the share of resamples above 0, by drawing queries with
    replacement. One number for each query comes to the driver; beyond `most` queries it is an error: use `bootstrap`."""
    rows = _paired(a, b, metric).orderBy("query_id").select("d").limit(most + 1).collect()
    if not rows:
        raise ValueError("no queries in common")
    if len(rows) > most:
        raise ValueError(f"more than {most} queries")
    diffs = np.array([r.d for r in rows])
    rng = np.random.default_rng(seed)
    means = np.array([diffs[rng.integers(0, len(diffs), len(diffs))].mean() for _ in range(rounds)])
    low, high = np.quantile(means, [0.025, 0.975])
    return {"difference": float(diffs.mean()), "ci_low": float(low), "ci_high": float(high), "p_positive": float((means > 0).mean())}


#: Where a uniform number becomes one more draw of a Poisson variable of mean 1.
POISSON = tuple(float(x) for x in np.cumsum([np.exp(-1.0) / np.prod(np.arange(1, k + 1)) for k in range(12)]))


def bootstrap(a: DataFrame, b: DataFrame, metric: str = "ndcg", rounds: int = 2000, seed: int = 42) -> DataFrame:
    """The same four figures as one row, for any number of queries: in each round a query is drawn as often as a Poisson
    variable of mean 1 says, which follows from a hash of seed, round and query. Rounds are summed where the queries are;
    `rounds` sums come together."""
    diffs = _paired(a, b, metric)
    key = F.concat_ws("|", F.lit(str(seed)), F.col("r").cast("string"), F.col("query_id").cast("string"))
    u = F.conv(F.substring(F.md5(key), 1, 12), 16, 10).cast("double") / float(1 << 48)
    drawn = reduce(lambda x, y: x + y, ((u >= c).cast("int") for c in POISSON))
    sums = diffs.select("query_id", "d", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))).alias("r")).select("r", "d", drawn.alias("w"))
    means = sums.groupBy("r").agg(F.sum(F.col("d") * F.col("w")).alias("s"), F.sum("w").alias("n")).where("n > 0").select((F.col("s") / F.col("n")).alias("m"))
    one = means.agg(F.percentile("m", 0.025).alias("ci_low"), F.percentile("m", 0.975).alias("ci_high"), F.avg((F.col("m") > 0).cast("double")).alias("p_positive"))
    return diffs.agg(F.avg("d").alias("difference")).join(one)  # one row each


def zscore_baseline(features: DataFrame, weights: dict[str, float], out: str = "score", by: str | None = None) -> DataFrame:
    """Sum of weighted z-scores over the whole frame, or over the rows that agree in `by`; a constant column counts as it
    is, infinities and NaN as 0."""
    # Deviations of a constant that is met in several parts may differ from 0 in their last digits.
    spread = lambda c: F.when(F.min(c) == F.max(c), 0.0).otherwise(F.stddev_pop(c))
    shape = [f(c).alias(f"_{n}_{c}") for c in weights for n, f in (("m", F.avg), ("s", spread))]

    def part(c: str, w: float):
        z = F.when(F.col(f"_s_{c}") > 0, (F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}")).otherwise(F.col(c))
        return F.when(F.isnan(z) | z.isNull() | (F.abs(z) == float("inf")), 0.0).otherwise(z) * w

    total = sum((part(c, w) for c, w in weights.items()), F.lit(0.0))
    joined = features.join(features.groupBy(by).agg(*shape), by) if by else features.crossJoin(F.broadcast(features.agg(*shape)))  # one row
    return joined.select(*features.columns, total.alias(out))


def freshness(query_time, posted_at):
    """1 / (1 + age in days / 30), 0 for what is posted later."""
    days = (F.unix_micros(query_time) - F.unix_micros(posted_at)) / 86_400_000_000
    return F.when(days >= 0, 1.0 / (1.0 + days / 30.0)).otherwise(0.0)


def log_salary(c):
    """log(1 + salary); negative, missing and NaN salaries are 0."""
    return F.log1p(F.greatest(F.nanvl(F.coalesce(c, F.lit(0.0)), F.lit(0.0)), F.lit(0.0)))


def reciprocal_rank(c):
    return F.when(c > 0, 1.0 / c).otherwise(0.0)
