"""Approximate nearest neighbours by inner product: a navigable small-world graph for each shard."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.tables import materialise
from lodestar.llm.vectors import matrix, takes_part

SHARD_ROWS, LEAST_SHARDS = 32_768, 8
#: Bytes of query vectors, in double precision, that meet a shard in one task.
BLOCK_BYTES = 32 << 20
#: Links of a node on the upper layers (twice as many on the lowest), and widths of the beams.
LINKS, BUILD_BEAM, BEAM = 16, 64, 160
STEP = 256
#: Nodes that each walk opens at a time; queries in the audit, and the share of their neighbours that must be found.
OPENED, AUDITED, RECALL = 4, 256, 0.95


@dataclass
class Graph:
    """Layers of flat neighbour arrays, -1 where a node has fewer, over points whose Euclidean order is searched."""

    points: np.ndarray
    tops: np.ndarray
    layers: list[np.ndarray]
    entry: int = 0

    def distances(self, queries: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Squared, less the query's own square, of (row, candidate) pairs; infinite for -1."""
        near = self.points[ids]
        out = np.einsum("bkd,bkd->bk", near, near - 2 * queries[:, None, :], optimize=False)
        return np.where(ids < 0, np.inf, out)

    def beam(self, queries: np.ndarray, start: np.ndarray, layer: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest `width` nodes that a best-first walk of one layer meets, for many queries side by side."""
        rows = np.arange(len(queries))
        links = self.layers[layer]
        width = min(width, len(self.points))
        opened = min(OPENED, width)
        seen = np.zeros((len(queries), len(self.points)), dtype=bool)
        ids = np.full((len(queries), width), -1, dtype=np.int32)
        dist = np.full((len(queries), width), np.inf)
        done = np.ones((len(queries), width), dtype=bool)
        ids[:, : start.shape[1]] = start
        dist[:, : start.shape[1]] = self.distances(queries, start)
        done[:, : start.shape[1]] = start < 0
        row, col = np.nonzero(start >= 0)
        seen[row, start[row, col]] = True
        live = rows
        while True:
            gaps = np.where(done[live], np.inf, dist[live])
            first = np.argpartition(gaps, opened - 1, axis=1)[:, :opened] if opened < width else np.tile(np.arange(width), (len(live), 1))
            todo = np.isfinite(np.take_along_axis(gaps, first, axis=1))
            more = todo.any(1)
            live, first, todo = live[more], first[more], todo[more]
            if not len(live):
                break
            done[live[:, None], first] = True
            found = np.where(todo[:, :, None], links[ids[live[:, None], first]], -1).reshape(len(live), -1)
            fresh = (found >= 0) & ~seen[live[:, None], np.maximum(found, 0)]
            found = np.sort(np.where(fresh, found, -1), axis=1)
            found[:, 1:][found[:, 1:] == found[:, :-1]] = -1  # met from several nodes at once
            row, col = np.nonzero(found >= 0)
            deep = int((found >= 0).sum(1).max(initial=0))
            if not deep:
                continue
            close = np.full((len(live), deep), -1, dtype=np.int32)
            close[row, np.concatenate([np.arange(n) for n in np.bincount(row, minlength=len(live))])] = found[row, col]
            seen[live[row], found[row, col]] = True
            all_d = np.concatenate([dist[live], self.distances(queries[live], close)], axis=1)
            all_i = np.concatenate([ids[live], close], axis=1)
            all_x = np.concatenate([done[live], close < 0], axis=1)
            best = np.argpartition(all_d, width - 1, axis=1)[:, :width]
            at = np.arange(len(live))[:, None]
            dist[live], ids[live], done[live] = all_d[at, best], all_i[at, best], all_x[at, best]
        order = np.argsort(dist, axis=1, kind="stable")
        return ids[rows[:, None], order], dist[rows[:, None], order]

    def search(self, queries: np.ndarray, width: int) -> np.ndarray:
        """Nearest nodes, nearest first, -1 behind the last."""
        out = []
        for at in range(0, len(queries), STEP):
            part = queries[at : at + STEP]
            start = np.full((len(part), 1), self.entry, dtype=np.int32)
            for layer in range(len(self.layers) - 1, 0, -1):
                start = self.beam(part, start, layer, 1)[0]
            out.append(self.beam(part, start, 0, width)[0])
        return np.concatenate(out)

    def spread(self, owners: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
        """Of each row's candidates (nearest first) those that are nearer to the owner than to any chosen before, up to
        `most`; the nearest others fill what stays free."""
        near = self.points[ids]
        own = np.where(ids < 0, np.inf, ((near - self.points[owners][:, None, :]) ** 2).sum(-1))
        order = np.argsort(own, axis=1, kind="stable")
        at = np.arange(len(ids))[:, None]
        ids, own, near = ids[at, order], own[at, order], near[at, order]
        norms = (near**2).sum(-1)
        apart = norms[:, :, None] + norms[:, None, :] - 2 * (near @ near.transpose(0, 2, 1))
        chosen = np.zeros(ids.shape, dtype=bool)
        for j in range(ids.shape[1]):
            closest = np.where(chosen, apart[:, j], np.inf).min(axis=1)
            chosen[:, j] = (ids[:, j] >= 0) & (own[:, j] <= closest) & (chosen.sum(1) < most)
        rank = np.argsort(np.where(ids < 0, 2, ~chosen), axis=1, kind="stable")[:, :most]
        out = ids[at, rank]
        return np.pad(out, ((0, 0), (0, max(0, most - out.shape[1]))), constant_values=-1).astype(np.int32)


def build(points: np.ndarray, seed: int) -> Graph:
    """Insert points in growing batches: each searches the graph so far, is linked to a spread of what it finds and of
    its own batch, and its neighbours take it up, keeping a spread of their own when they are full."""
    rng = np.random.default_rng(seed)
    n = len(points)
    tops = np.minimum((-np.log(rng.random(n)) / np.log(LINKS)).astype(np.int64), 8)
    tops[0] = max(int(tops.max(initial=0)), 0)
    graph = Graph(points, tops, [np.full((n, LINKS * (2 if k == 0 else 1)), -1, dtype=np.int32) for k in range(int(tops[0]) + 1)])
    at = 1
    while at < n:
        batch = np.arange(at, min(n, at + min(STEP, at)))
        start = np.zeros((len(batch), 1), dtype=np.int32)
        for layer in range(len(graph.layers) - 1, -1, -1):
            width = LINKS * (2 if layer == 0 else 1)
            here = tops[batch] >= layer
            found, _ = graph.beam(points[batch], start, layer, BUILD_BEAM if here.any() else 1)
            if here.any():
                own = batch[here]
                peers = np.tile(own.astype(np.int32), (len(own), 1))
                gaps = ((points[own] ** 2).sum(1)[None, :] - 2 * points[own] @ points[own].T).astype(np.float64)
                np.fill_diagonal(gaps, np.inf)
                close = np.argsort(gaps, axis=1, kind="stable")[:, : min(LINKS, len(own) - 1)]
                cands = np.concatenate([found[here], peers[np.arange(len(own))[:, None], close]], axis=1)
                links = graph.spread(own, cands, LINKS)
                graph.layers[layer][own, :LINKS] = links
                _take_up(graph, layer, own, links, width)
            start = found[:, :1]
        at += len(batch)
    _reach_all(graph)
    return graph


def _reach_all(graph: Graph) -> None:
    """Nodes that all their neighbours dropped can't be found; give each a link from a node that can, its nearest
    neighbour if possible, in columns of their own."""
    table = graph.layers[0]
    n = len(table)
    reached, extra = np.zeros(n, dtype=bool), []
    front = np.array([graph.entry])
    while n:
        while len(front):
            reached[front] = True
            ids = table[front].ravel()
            ids = np.unique(ids[ids >= 0])
            front = ids[~reached[ids]]
        lost = np.flatnonzero(~reached)
        if not len(lost):
            break
        own = table[lost]
        usable = (own >= 0) & reached[np.maximum(own, 0)]
        some = usable.any(1)
        if some.any():
            hosts, front = own[some, np.argmax(usable[some], axis=1)], lost[some]
        else:
            front, near = lost[:1], np.flatnonzero(reached)
            hosts = near[[np.argmin(((graph.points[near] - graph.points[front[0]]) ** 2).sum(1))]]
        extra.append((hosts, front))
    if extra:
        hosts, guests = (np.concatenate(x) for x in zip(*extra))
        order = np.argsort(hosts, kind="stable")
        hosts, guests = hosts[order], guests[order]
        _, first, count = np.unique(hosts, return_index=True, return_counts=True)
        more = np.full((n, int(count.max())), -1, dtype=np.int32)
        more[hosts, np.arange(len(hosts)) - np.repeat(first, count)] = guests
        graph.layers[0] = np.concatenate([table, more], axis=1)


def _take_up(graph: Graph, layer: int, own: np.ndarray, links: np.ndarray, width: int) -> None:
    table = graph.layers[layer]
    to, by = links.ravel(), np.repeat(own, links.shape[1])
    to, by = to[to >= 0], by[to >= 0]
    order = np.argsort(to, kind="stable")
    to, by = to[order], by[order]
    nodes, first, count = np.unique(to, return_index=True, return_counts=True)
    slot = np.arange(len(to)) - np.repeat(first, count)
    for lo in range(0, len(nodes), STEP):
        some = slice(lo, lo + STEP)
        deep = int(count[some].max())
        new = np.full((len(nodes[some]), deep), -1, dtype=np.int32)
        a, b = first[some][0], first[some][-1] + count[some][-1]
        new[np.searchsorted(nodes[some], to[a:b]), slot[a:b]] = by[a:b]
        new[(new[:, :, None] == table[nodes[some]][:, None, :]).any(-1)] = -1
        table[nodes[some]] = graph.spread(nodes[some], np.concatenate([table[nodes[some]], new], axis=1), width)


def lifted(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Points whose Euclidean order around a query (with a last component of 0) is that of the inner product."""
    rest = np.sqrt(np.maximum(0.0, longest**2 - np.einsum("ij,ij->i", vectors, vectors)))
    return (np.concatenate([vectors, rest[:, None]], axis=1) / longest).astype(np.float32)


def _kth_best(nodes: DataFrame, asked: list[tuple[int, np.ndarray, np.ndarray]], k: int) -> dict[int, tuple[int, float]]:
    """For each of a few queries (dimension, keys, vectors): how many neighbours there are, up to k, and the product of the
    last of them, from a comparison with all nodes in double precision."""
    shared = nodes.sparkSession.sparkContext.broadcast(asked)

    def compare(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, np.ndarray] = {}
        for batch in it:
            dims, sizes = batch.column(0).to_numpy(), pc.list_value_length(batch.column(2)).to_numpy()
            for dim, keys, x in shared.value:
                at = np.flatnonzero(dims == dim)
                if not len(at):
                    continue
                part = batch.take(pa.array(at))
                scores = x @ matrix(part.column(1)).T
                own = np.repeat(np.arange(len(at)), sizes[at])
                ids = part.column(2).flatten().to_numpy()
                for key, row in zip(keys.tolist(), scores):
                    all_ = np.concatenate([best.get(key, np.zeros(0)), row[own][ids != key]])
                    best[key] = np.sort(all_)[::-1][:k]
        rows = [(key, float(v)) for key, values in best.items() for v in values]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.float64())], names=["key", "score"])

    found = nodes.select("dim", "vec", "ids").mapInArrow(compare, "key long, score double")
    best = Window.partitionBy("key").orderBy(F.col("score").desc())
    top = found.select("*", F.row_number().over(best).alias("at")).where(F.col("at") <= k)
    rows = top.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).collect()  # a row for each audited query
    shared.unpersist()
    return {r.key: (r.n, r.least) for r in rows}


def search(
    table: DataFrame, k: int = 20, every: int = 20, vector: str = "embedding", key: str = "vec_id", beam: int = BEAM, seed: int = 42, recall: float = RECALL
) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose key is divisible by `every`, the `k` rows of the largest
    inner product that the graphs find, without the query's own key; ties by the smaller key.

    Equal vectors are one node: of each, the k + 1 smallest keys are kept, which is all that a result can hold. Nodes
    are dealt to shards of about SHARD_ROWS by a hash; each shard's graph is built by one task and written as flat
    arrays. An audit compares AUDITED queries, chosen by a hash, with all nodes: until the graphs find `recall` of their
    neighbours the beam is doubled, at most to the size of a shard, where a walk meets every node. The stated query
    set meets every shard in blocks of BLOCK_BYTES; scores are taken anew in double precision from the vectors as given,
    and the shards' results are merged by a window over each query.
    Rows with a null key, and vectors that are null, zero or hold null or non-finite components, take no part; vectors
    meet only those of the same length; a key that repeats with other vectors counts each of them; no queries or no
    candidates give no rows; other columns are ignored.
    """
    rows = table.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vec")).where(
        F.col("id").isNotNull() & takes_part("vec")
    )
    least = Window.partitionBy("vec").orderBy("id")
    members = rows.distinct().select("*", F.row_number().over(least).alias("at")).where(F.col("at") <= k + 1)
    nodes = materialise(
        members.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))
        .select("vec", "ids", F.size("vec").alias("dim"), F.monotonically_increasing_id().alias("node"))
    )
    n, widest, longest = nodes.agg(
        F.count(F.lit(1)), F.max("dim"), F.max(F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x)))
    ).first()
    shards = max(LEAST_SHARDS, -(-n // SHARD_ROWS))
    longest = longest or 1.0

    def index(group: pa.Table) -> pa.Table:
        group = group.sort_by([("least", "ascending"), ("node", "ascending")])
        vectors = matrix(group["vec"])
        graph = build(lifted(vectors, longest), seed)
        pack = lambda a, t: pa.array([a.astype(t).tobytes()], pa.binary())
        return pa.table(
            {
                "dim": group["dim"][:1],
                "shard": group["shard"][:1],
                "ids": pack(group["node"].to_numpy(), "<i8"),
                "vectors": pack(vectors, "<f8"),
                "tops": pack(graph.tops, "<i1"),
                "layers": pa.array([[x[graph.tops >= i].astype("<i4").tobytes() for i, x in enumerate(graph.layers)]], pa.list_(pa.binary())),
            }
        )

    dealt = nodes.select(
        "dim", F.pmod(F.xxhash64("vec"), F.lit(shards)).cast("int").alias("shard"), "node", F.element_at("ids", 1).alias("least"), "vec"
    )
    indexes = materialise(
        dealt.groupBy("dim", "shard").applyInArrow(
            index, "dim int, shard int, ids binary, vectors binary, tops binary, layers array<binary>"
        )
    )
    asked = rows.where(F.col("id") % every == 0).distinct()
    blocks = max(1, -(-asked.count() * 8 * (widest or 1) // BLOCK_BYTES))
    schema = pa.schema([("query_id", pa.int64()), ("node", pa.int64()), ("score", pa.float64())])

    def look(left: pa.Table, right: pa.Table, width: int) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        ids = np.frombuffer(right["ids"][0].as_py(), "<i8")
        vectors = np.frombuffer(right["vectors"][0].as_py(), "<f8").reshape(len(ids), -1)
        tops = np.frombuffer(right["tops"][0].as_py(), "<i1")
        layers = []
        for i, flat in enumerate(right["layers"][0].as_py()):
            links = np.frombuffer(flat, "<i4").reshape(int((tops >= i).sum()), -1)
            layers.append(np.full((len(ids), links.shape[1]), -1, dtype=np.int32))
            layers[-1][tops >= i] = links
        asked = matrix(left["vec"])
        lengths = np.abs(asked).max(axis=1, keepdims=True)
        points = np.concatenate([asked / lengths, np.zeros((len(asked), 1))], axis=1).astype(np.float32)
        found = Graph(lifted(vectors, longest), tops, layers).search(points, max(width, k + 1))[:, : k + 1]
        row, col = np.nonzero(found >= 0)
        hit = found[row, col]
        return pa.table(
            {
                "query_id": left["id"].to_numpy()[row],
                "node": ids[hit],
                "score": np.einsum("ij,ij->i", asked[row], vectors[hit]),
            },
            schema=schema,
        )

    def answers(asked: DataFrame, blocks: int, width: int) -> DataFrame:
        by = ("dim", "shard", "block")
        queries = asked.select(
            F.size("vec").alias("dim"),
            F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
            F.pmod(F.xxhash64("id", "vec"), F.lit(blocks)).cast("int").alias("block"),
            "id",
            "vec",
        )
        copies = indexes.select("dim", "shard", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "ids", "vectors", "tops", "layers")
        found = queries.groupBy(*by).cogroup(copies.groupBy(*by)).applyInArrow(lambda a, b: look(a, b, width), "query_id long, node long, score double")
        merged = (
            found.join(nodes.select("node", "ids"), "node")
            .select("query_id", F.explode("ids").alias("vec_id"), "score")
            .where(F.col("vec_id") != F.col("query_id"))
        )
        order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
        return merged.select("query_id", F.row_number().over(order).alias("rank"), "vec_id", "score").where(F.col("rank") <= k)

    sample = asked.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.first("vec").alias("vec")).where("n = 1")
    sample = materialise(sample.orderBy(F.xxhash64("id", F.lit(seed)), "id").select("id", "vec").limit(AUDITED))
    held = sample.toArrow()
    lengths = np.array([len(v) for v in held["vec"].to_pylist()], dtype=np.int64)
    few = [(int(d), held["id"].to_numpy()[lengths == d], matrix(held["vec"].take(pa.array(np.flatnonzero(lengths == d))))) for d in np.unique(lengths)]
    want = _kth_best(nodes, few, k) if few else {}
    most = indexes.agg(F.max(F.octet_length("tops"))).first()[0] or 0
    width = max(beam, k + 1)
    while want and width < most:
        hits = Counter(r.query_id for r in answers(sample, 1, width).collect() if r.score >= want[r.query_id][1] - 1e-12 * abs(want[r.query_id][1]))
        if sum(hits.values()) >= recall * sum(n for n, _ in want.values()):
            break
        width *= 2
    return answers(asked, blocks, width)
