"""Nearest vectors by cosine: blocks of queries meet slices of a table, and the first components rule most pairs out."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

#: Vectors of a slice, and of a block of queries, that are compared at a time: what is held of their products doesn't grow with the block.
STEP, ASKED = 1024, 512


def best_of(q: np.ndarray, t: np.ndarray, k: int, digits: int, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, int]:
    """(scores, rows of `t`, pairs computed in full) of the k nearest rows of `t` for each row of `q`; both are of length 1 or 0, and
    equal scores go to the earlier row. `own`: a row of `t` that a query must not get, or -1.

    Components are taken in one order for all, those with most of the table's energy first. What the first half gives, and
    the lengths of what is left, bound a product from above; only pairs that can still enter are multiplied out."""
    if len(q) > ASKED:
        parts = [best_of(q[i : i + ASKED], t, k, digits, None if own is None else own[i : i + ASKED]) for i in range(0, len(q), ASKED)]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), sum(p[2] for p in parts)
    order = np.argsort(-np.einsum("ij,ij->j", t, t), kind="stable")
    q, t, h = q[:, order], t[:, order], max(1, q.shape[1] // 2)
    rest = [np.sqrt(np.einsum("ij,ij->i", x[:, h:], x[:, h:])) for x in (q, t)]
    scores, rows = np.full((len(q), k), -np.inf), np.full((len(q), k), -1, np.int64)
    done, slack = 0, 10.0**-digits
    for low in range(0, len(t), STEP):
        part = t[low : low + STEP]
        s = q[:, :h] @ part[:, :h].T
        may = s + rest[0][:, None] * rest[1][None, low : low + STEP] >= scores[:, -1:] - slack
        n = int(may.sum())
        if n * 4 > may.size:
            s, n = s + q[:, h:] @ part[:, h:].T, may.size
        else:
            i, j = np.nonzero(may)
            more = np.einsum("ij,ij->i", q[i, h:], part[j, h:])
            full = np.full(s.shape, -np.inf)
            full[i, j] = s[i, j] + more
            s = full
        done += n
        s = np.round(np.where(np.isnan(s), 0.0, s), digits) + 0.0
        if own is not None:
            mine = np.flatnonzero((own >= low) & (own < low + len(part)))
            s[mine, own[mine] - low] = -np.inf
        some = np.flatnonzero((s > -np.inf).any(1))
        both, at = np.concatenate([scores[some], s[some]], axis=1), np.concatenate([rows[some], np.broadcast_to(np.arange(low, low + len(part)), (len(some), len(part)))], axis=1)
        keep = np.argsort(-both, axis=1, kind="stable")[:, :k]
        scores[some], rows[some] = np.take_along_axis(both, keep, axis=1), np.take_along_axis(at, keep, axis=1)
    return scores, rows, done


def _unit(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    """Rows of length 1; 0 for null and zero vectors and those of another number of components."""
    x = np.zeros((len(column), dim))
    low = 0
    for lists in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        fit = np.asarray(pc.fill_null(pc.equal(pc.list_value_length(lists), dim), False))
        values = lists.filter(pa.array(fit)).flatten()
        whole = ~np.asarray(values.is_null()).reshape(-1, dim).any(1)
        x[low + np.flatnonzero(fit)] = np.where(whole[:, None], np.asarray(values.fill_null(0.0), np.float64).reshape(-1, dim), 0.0)
        low += len(lists)
    norms = np.sqrt(np.einsum("ij,ij->i", x, x))
    return np.divide(x, norms[:, None], out=np.zeros_like(x), where=norms[:, None] > 0)


def nearest(queries: DataFrame, table: DataFrame, k: int, digits: int = 9, apart: bool = False, block_bytes: int = 4 << 20) -> DataFrame:
    """(query, name, score, rank) of the k rows of `table` (name, v) with the highest cosine for each of `queries` (query, v), equal scores
    by name; `apart`: never the row of the query's own name. Queries are packed into blocks of about `block_bytes`, each block
    meets slices of the table of about the same size, and each slice keeps its own k best before the shuffle; so no key
    holds the whole table. Names are distinct, and so are queries."""
    (n, dim), m = queries.agg(F.count(F.lit(1)), F.max(F.size("v"))).first(), table.count()
    dim = max(1, dim or 1)
    per = max(1, block_bytes // (8 * dim))
    parts, slices = max(1, -(-n // per)), max(1, -(-m // per))
    deal = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = queries.select("query", F.col("v").cast("array<double>").alias("v"), deal("query", parts).alias("block")).select("*", every(slices).alias("slice"))
    held = table.select("name", F.col("v").cast("array<double>").alias("v"), deal("name", slices).alias("slice")).select("*", every(parts).alias("block"))
    kinds = queries.schema["query"].dataType, table.schema["name"].dataType
    schema = pa.schema([("query", to_arrow_type(kinds[0])), ("name", to_arrow_type(kinds[1])), ("score", pa.float64())])

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        names, ids = np.array(right["name"].to_pylist()), np.array(left["query"].to_pylist())
        order = np.argsort(names, kind="stable")
        names, own = names[order], None
        if apart:
            at = np.minimum(np.searchsorted(names, ids), len(names) - 1)
            own = np.where(names[at] == ids, at, -1)
        scores, rows, _ = best_of(_unit(left["v"], dim), _unit(right["v"], dim)[order], k, digits, own)
        i, j = np.nonzero(np.isfinite(scores))
        return pa.table([pa.array(ids[i].tolist(), schema.field(0).type), pa.array(names[rows[i, j]].tolist(), schema.field(1).type), scores[i, j]], schema=schema)

    by = ("block", "slice")
    found = asked.groupBy(*by).cogroup(held.groupBy(*by)).applyInArrow(compare, f"query {kinds[0].simpleString()}, name {kinds[1].simpleString()}, score double")
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), "name")
    return found.select("*", F.row_number().over(best).alias("rank")).where(F.col("rank") <= k)
