"""Embedding near-duplicates by NN-descent on a neighbour graph that is confined to the angles that matter."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.components import components
from lodestar.llm.tables import materialise, running_totals
from lodestar.llm.vectors import matrix, runs, takes_part, units

#: Rows that are compared at a time; neighbours kept at first, and at most; vectors of each kind in the audit.
BLOCK, NEIGHBOURS, WIDEST, AUDITED = 1024, 16, 128, 512
#: Bytes of vectors, in double precision, of a piece of a component.
PIECE_BYTES = 16 << 20
#: The recall that is asked for; that which the orders alone promise a pair right at the threshold; turns until it must hold.
RECALL, PROMISED, MOST_ROUNDS = 0.995, 0.997, 8
_EDGES = "u long, v long, s double, kind int"


def _edges(u: np.ndarray, v: np.ndarray, s: np.ndarray, kind: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(s, pa.float64()), pa.array(np.full(len(u), kind), pa.int32())],
        names=["u", "v", "s", "kind"],
    )


def _nearest(ids: np.ndarray, cosines: np.ndarray, least: float, width: np.ndarray) -> pa.RecordBatch:
    """For each row of a square of cosines its best entries of at least `least`, as many as its list is wide."""
    keep = cosines >= least
    np.fill_diagonal(keep, False)
    rows = np.flatnonzero(keep.any(1))
    if not len(rows):
        return _edges(*[np.zeros(0)] * 3, 0)
    part = np.where(keep[rows], cosines[rows], -2.0)
    most = min(int(width[rows].max()), part.shape[1])
    best = np.argpartition(-part, most - 1, axis=1)[:, :most]
    values = np.take_along_axis(part, best, axis=1)
    order = np.argsort(-values, axis=1, kind="stable")
    best, values = np.take_along_axis(best, order, axis=1), np.take_along_axis(values, order, axis=1)
    r, c = np.nonzero((values > -2.0) & (np.arange(most)[None, :] < width[rows][:, None]))
    return _edges(ids[rows[r]], ids[best[r, c]], values[r, c], 0)


def _joined(ids: np.ndarray, cosines: np.ndarray, least: float) -> pa.RecordBatch:
    """Links, fewer than there are rows, that join what is connected in the square by cosines of at least `least`."""
    near = cosines >= least
    np.fill_diagonal(near, False)
    left = near.any(1)
    seeds, found, s = [], [], []
    while left.any():
        seed = int(np.argmax(left))
        reached = np.zeros(len(ids), dtype=bool)
        reached[seed] = True
        front = reached.copy()
        while front.any():
            step = near[front].any(0) & ~reached
            reached |= step
            front = step
        got = np.flatnonzero(reached)
        got = got[got != seed]
        seeds.append(np.full(len(got), ids[seed]))
        found.append(ids[got])
        left &= ~reached
    if not seeds:
        return _edges(*[np.zeros(0)] * 3, 1)
    return _edges(np.concatenate(seeds), np.concatenate(found), np.ones(sum(map(len, found))), 1)


def orders_for(rows: int, threshold: float) -> int:
    """How many orders bring a pair with a cosine of `threshold` into one block with a chance of PROMISED, if in each the
    block is a prefix of the signs: a plane parts the pair with a chance of its angle over pi."""
    bits = max(0.0, math.log2(max(1, rows) / BLOCK))
    together = (1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi) ** bits
    return 1 if together >= PROMISED else math.ceil(math.log(1 - PROMISED) / math.log1p(-together))


def _seeds(nodes: DataFrame, first: int, orders: int, threshold: float, floor: float) -> DataFrame:
    """Neighbours within blocks of BLOCK rows along several orders by the signs of random projections. A block is cut
    by position, so it never grows with a dense group."""

    def coded(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            if not batch.num_rows:
                continue
            dims = batch.column(1).to_numpy()
            node, out_o, out_c, out_i = batch.column(0), [], [], []
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                x = units(matrix(batch.column(2).take(pa.array(at))))
                for order in range(first, first + orders):
                    plane = np.random.default_rng(7919 * order + 1).standard_normal((60, dim))
                    bits = (x @ plane.T > 0).astype(np.int64)
                    out_o.append(np.full(len(at), order))
                    out_c.append(bits @ (np.int64(1) << np.arange(59, -1, -1)))
                    out_i.append(at)
            at = pa.array(np.concatenate(out_i))
            yield pa.RecordBatch.from_arrays(
                [node.take(at), batch.column(1).take(at), batch.column(2).take(at), pa.array(np.concatenate(out_o)).cast(pa.int32()), pa.array(np.concatenate(out_c))],
                names=["node", "dim", "vec", "turn", "code"],
            )

    kind = nodes.schema["vec"].dataType.simpleString()
    codes = nodes.select("node", "dim", "vec").mapInArrow(coded, f"node long, dim int, vec {kind}, turn int, code long")
    placed = running_totals(codes, [F.col(c).asc() for c in ("dim", "turn", "code")], {})
    blocks = placed.select("dim", "turn", F.expr(f"position div {BLOCK}").alias("block"), "node", "vec")

    def compare(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(it, 3):
            ids, x = group["node"].to_numpy(), units(matrix(group["vec"]))
            cosines = x @ x.T
            yield _nearest(ids, cosines, floor, np.full(len(ids), NEIGHBOURS))
            yield _joined(ids, cosines, threshold)

    by = ("dim", "turn", "block")
    return blocks.repartition(*by).sortWithinPartitions(*by).mapInArrow(compare, _EDGES)


def _lists(edges: DataFrame, width: Column) -> DataFrame:
    """Each node's best neighbours, as many as its list is wide."""
    best = Window.partitionBy("u").orderBy(F.col("s").desc(), "v")
    once = edges.groupBy("u", "v").agg(F.max("s").alias("s"), F.max("width").alias("width"))
    return once.select("*", F.row_number().over(best).alias("at")).where(F.col("at") <= width).drop("at")


def _refine(nodes: DataFrame, graph: DataFrame, threshold: float, floor: float, widest: int) -> tuple[DataFrame, DataFrame]:
    """One round: the neighbours and reverse neighbours of each node meet each other; a list that is full of links is
    twice as wide from then on. Gives the new lists and the links that the meetings join."""
    full = graph.groupBy("u").agg(F.count(F.lit(1)).alias("n"), F.min("s").alias("least"), F.max("width").alias("width"))
    wide = full.select(
        "u", F.when((F.col("n") >= F.col("width")) & (F.col("least") >= threshold), F.least(F.col("width") * 2, F.lit(WIDEST))).otherwise(F.col("width")).alias("wide")
    )
    both = graph.select("u", "v", "s").union(graph.select("v", "u", "s")).distinct()
    best = Window.partitionBy("u").orderBy(F.col("s").desc(), "v")
    members = both.select("*", F.row_number().over(best).alias("at")).where(F.col("at") <= 2 * widest).select("u", "v")
    members = members.union(members.select("u", F.col("u").alias("v")).distinct())
    known = nodes.select(F.col("node").alias("v"), "vec").join(wide.withColumnRenamed("u", "v"), "v", "left")
    met = members.join(known, "v").select("u", "v", F.coalesce("wide", F.lit(NEIGHBOURS)).alias("width"), "vec")

    def meet(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(it, 1):
            ids, x = group["v"].to_numpy(), units(matrix(group["vec"]))
            cosines = x @ x.T
            yield _nearest(ids, cosines, floor, group["width"].to_numpy())
            yield _joined(ids, cosines, threshold)

    found = materialise(met.repartition("u").sortWithinPartitions("u").mapInArrow(meet, _EDGES))
    near = found.where("kind = 0").select("u", "v", "s").union(graph.select("u", "v", "s"))
    near = near.join(wide, "u", "left").select("u", "v", "s", F.coalesce("wide", F.lit(NEIGHBOURS)).alias("width"))
    return materialise(_lists(near, F.col("width"))), found.where("kind = 1").select("u", "v")


def _counted(nodes: DataFrame, roots: DataFrame, graph: DataFrame, threshold: float) -> DataFrame:
    """(node, links): for each node of a component the copies of other vectors that it is linked to. These are its kept
    edges, unless some list of the component is or was full of links and so may not hold them all. Such components (and those of up
    to BLOCK rows, where it costs nothing) are compared with themselves, which is a list as wide as the component: it is dealt
    to pieces of about PIECE_BYTES, pairs of pieces meet, BLOCK rows at a time, and only counts leave them. Work grows with
    the square of the size of a dense component; what is shuffled with its size times the number of its pieces."""
    rooted = nodes.join(roots, "node")
    filled = (F.count(F.lit(1)) >= F.max("width")) & (F.min("s") >= threshold)
    full = graph.groupBy("u").agg((filled | (F.max("width") > NEIGHBOURS)).alias("full"))
    size = F.ceil(F.count(F.lit(1)) * F.first("dim") * 8 / PIECE_BYTES)  # a component's vectors are of one length
    shape = rooted.join(full, F.col("node") == F.col("u"), "left").groupBy("root").agg(
        size.alias("pieces"), (F.max(F.coalesce("full", F.lit(False))) | (F.count(F.lit(1)) <= BLOCK)).alias("dense")
    )
    links = graph.where(F.col("s") >= threshold)
    ends = links.select("u", "v").union(links.select("v", "u")).distinct()
    sparse = roots.join(shape.where("not dense").select("root"), "root", "left_semi").select(F.col("node").alias("u"))
    kept = ends.join(sparse, "u", "left_semi").join(nodes.select(F.col("node").alias("v"), "copies"), "v").groupBy(F.col("u").alias("node")).agg(F.sum("copies").alias("links"))
    dealt = rooted.join(shape.where("dense").select("root", "pieces"), "root").select(
        "root", "node", "vec", "copies", "pieces", F.pmod(F.xxhash64("node"), "pieces").alias("own")
    )
    met = dealt.select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)).alias("other")
    ).select("root", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "own", "node", "vec", "copies")

    def count(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(it, 3):
            a, b = group["a"][0].as_py(), group["b"][0].as_py()
            ids, x, n, own = group["node"].to_numpy(), units(matrix(group["vec"])), group["copies"].to_numpy(), group["own"].to_numpy()
            left, right = np.flatnonzero(own == a), np.flatnonzero(own == b)
            found = np.zeros(len(ids), np.int64)
            for i in range(0, len(left), BLOCK):
                one = left[i : i + BLOCK]
                for j in range(i if a == b else 0, len(right), BLOCK):
                    two = right[j : j + BLOCK]
                    near = x[one] @ x[two].T >= threshold
                    if a == b and i == j:
                        np.fill_diagonal(near, False)
                    else:
                        found[two] += near.T @ n[one]
                    found[one] += near @ n[two]
            sums = [(ids, found)]
            for node, links in sums:
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(links, pa.int64())], names=["node", "links"])

    by = ("root", "a", "b")
    return (
        met.repartition(*by).sortWithinPartitions(*by).mapInArrow(count, "node long, links long")
        .groupBy("node").agg(F.sum("links").alias("links"))
    ).union(kept)


def _recall(nodes: DataFrame, counts: DataFrame, threshold: float) -> float:
    """The mean, over vectors that have links, of the share of their links that were found, so that small groups count as
    much as large ones. Estimated from AUDITED vectors for which links were found and AUDITED for which none were, chosen by a
    hash and compared with all; each of the two kinds counts by its number."""
    known = nodes.join(counts, "node", "left").select("node", "dim", "vec", F.coalesce("links", F.lit(0)).alias("links")).withColumn("some", F.col("links") > 0)
    sizes = {r.some: r.n for r in known.groupBy("some").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    kinds = [known.where(F.col("some") == some).orderBy(F.xxhash64("node"), "node").limit(AUDITED) for some in (True, False)]
    sample = kinds[0].union(kinds[1]).toArrow()
    if not sample.num_rows:
        return 1.0
    asked = []
    for dim in sorted(set(sample["dim"].to_pylist())):
        part = sample.take([i for i, d in enumerate(sample["dim"].to_pylist()) if d == dim])
        asked.append((dim, part["node"].to_numpy(), units(matrix(part["vec"]))))
    shared = nodes.sparkSession.sparkContext.broadcast(asked)  # AUDITED vectors

    def compare(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, int] = {}
        for batch in it:
            dims = batch.column(1).to_numpy()
            for dim, ids, x in shared.value:
                at = np.flatnonzero(dims == dim)
                if not len(at):
                    continue
                part = batch.take(pa.array(at))
                near = x @ units(matrix(part.column(2))).T >= threshold
                near &= ids[:, None] != part.column(0).to_numpy()[None, :]
                for i, n in zip(ids.tolist(), (near @ part.column(3).to_numpy()).tolist()):
                    total[i] = total.get(i, 0) + n
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], names=["node", "n"])

    true = nodes.select("node", "dim", "vec", "copies").mapInArrow(compare, "node long, n long").groupBy("node").agg(F.sum("n").alias("n"))
    want = {r.node: r.n for r in true.collect()}  # a row for each audited vector
    shared.unpersist()
    shares = {True: [], False: []}
    for node, links, some in zip(*(sample[c].to_pylist() for c in ("node", "links", "some"))):
        if some or want[node]:
            shares[some].append(links / want[node] if want[node] else 1.0)
    lost = sizes.get(False, 0) * len(shares[False]) / max(1, min(AUDITED, sizes.get(False, 0)))
    have = sizes.get(True, 0)
    return have * sum(shares[True]) / len(shares[True]) / (have + lost) if shares[True] else float(not lost)


def near_duplicates(
    table: DataFrame, threshold: float = 0.95, vector: str = "embedding", key: str = "vec_id", recall: float = RECALL
) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row: links are pairs with a cosine of at least `threshold`.

    Equal vectors are one node with a number of copies. Random projections seed a neighbour graph; rounds of NN-descent
    let neighbours of neighbours meet until lists stop changing. A list holds neighbours of a cosine of at least
    2 threshold^2 - 1 only: two vectors that are both linked to a third are never further apart, so no others can lead
    to a link. Lists full of links are made twice as wide; besides, every meeting passes on links that join all
    it found connected, so a dense group stays together. Links are the kept edges; where lists are full of them the whole
    component is counted instead, in blocks. There are as many orders as a pair at the threshold needs at this number of vectors, so that
    pairs without other neighbours are met too. An audit compares some vectors with all; while it estimates that less
    than `recall` of the links of a vector are found, as many orders are tried again, and after MOST_ROUNDS turns it is an
    error: no result is returned that the audit doesn't bear out.

    A row whose vector is null, zero or holds null or non-finite components links with nothing: it has 0 links, is its
    own component and is kept; vectors of different lengths never link. A row with a null key links with nothing and
    has no component, kept is false. Repeated rows link with each other (kept is true for all rows of the
    smallest key); an empty table gives no rows; other columns are ignored.
    """
    rows = table.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("vec")).withColumn(
        "valid", takes_part("vec") & F.col("vec_id").isNotNull()
    )
    nodes = materialise(
        rows.where("valid").groupBy("vec").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
        .select(F.monotonically_increasing_id().alias("node"), F.size("vec").alias("dim"), "vec", "least", "copies")
    )
    floor = 2 * threshold * threshold - 1
    graph = joined = None
    orders = orders_for(nodes.count(), threshold)
    for turn in range(MOST_ROUNDS):
        seeds = materialise(_seeds(nodes, turn * orders, orders, threshold, floor))
        near = seeds.where("kind = 0").select("u", "v", "s", F.lit(NEIGHBOURS).alias("width"))
        graph = materialise(_lists(near if graph is None else near.union(graph), F.col("width")))
        more = seeds.where("kind = 1").select("u", "v")
        joined = more if joined is None else joined.union(more)
        before = graph.agg(F.count(F.lit(1)), F.sum("s"), F.max("width")).first()
        while before[0]:
            graph, more = _refine(nodes, graph, threshold, floor, before[2])
            joined = joined.union(more)
            now = graph.agg(F.count(F.lit(1)), F.sum("s"), F.max("width")).first()
            # Lists grow only where the rest of a dense group is near; once they are WIDEST, the count below does more.
            if now[0] <= before[0] * 1.001 and now[1] <= before[1] * 1.001 or now[2] >= WIDEST:
                break
            before = now
        # Whatever stands in a list met in a block or round whose links joined it, so the lists add nothing to these.
        roots = materialise(_both_ends(components(joined, "u", "v")))
        counts = materialise(_counted(nodes, roots, graph, threshold))
        found = _recall(nodes, counts, threshold)
        if found >= recall:
            break
    else:
        raise RuntimeError(f"only {found:.4f} of a vector's links were found after {MOST_ROUNDS} turns of {orders} orders")
    known = nodes.join(counts, "node", "left").join(roots, "node", "left").select(
        "vec", "least", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "node").alias("root")
    )
    named = known.groupBy("root").agg(F.min("least").alias("component_id"))
    known = known.join(named, "root").select("vec", (F.col("links") + F.col("copies") - 1).alias("links"), "component_id")
    linked = rows.where("valid").join(known, "vec").select("vec_id", F.col("links").alias("n_links"), "component_id")
    alone = rows.where("not valid").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _both_ends(tree: DataFrame) -> DataFrame:
    """(node, root) with the roots themselves."""
    return tree.union(tree.select("root", "root").distinct())
