"""Boosted ranker: LambdaMART gradients from pairs inside each query, histogram trees grown leaf by leaf."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestar.sources import files
from lodestar.sources.shared import materialise, scratch, spread

GAINS = (0.0, 1.0, 3.0)
#: Bins of a feature, one more for missing values; rows that are packed together, of whole queries; pairs in memory at a time; rows of a
#: query from which on its pairs are summed without being made; trees after which scores are stored anew;
#: chunks whose histograms come to the driver without a shuffle; chunks that one task learns from: jobs for them would take longer.
BINS, CHUNK, PAIRS, LONG, ROUND, FEW, ALONE = 255, 1 << 14, 1 << 20, 512, 10, 16, 4


@dataclass
class Tree:
    """Nodes in order of their making: a node with a feature sends values that are missing or at most `limit` to the left
    (`cut` is the limit's bin), a leaf has a value."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    limit: list[float] = field(default_factory=lambda: [0.0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int, limit: float) -> tuple[int, int]:
        a = len(self.feature)
        self.feature[node], self.cut[node], self.limit[node], self.left[node], self.right[node] = feature, cut, limit, a, a + 1
        for _ in range(2):
            for held, empty in ((self.feature, -1), (self.cut, 0), (self.limit, 0.0), (self.left, 0), (self.right, 0), (self.value, 0.0)):
                held.append(empty)
        return a, a + 1

    def leaves(self, x: np.ndarray, binned: bool = True) -> np.ndarray:
        """The leaf of each row of bins (or of values)."""
        feature, left, right, limit = map(np.array, (self.feature, self.left, self.right, self.cut if binned else self.limit))
        at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        while len(rows) and (inner := feature[at[rows]] >= 0).any():
            rows = rows[inner]
            node = at[rows]
            v = x[rows, feature[node]]
            at[rows] = np.where(np.isnan(v) | (v <= limit[node]) if not binned else v <= limit[node], left[node], right[node])
        return at


@dataclass
class Ranker:
    """Trees in order; a row's score is the sum of their leaves, each already scaled by the learning rate."""

    features: list[str]
    trees: list[Tree] = field(default_factory=list)
    gains: list[float] = field(default_factory=list)

    def score(self, df: DataFrame, out: str = "score") -> DataFrame:
        if not self.trees:
            return df.withColumn(out, F.lit(0.0))
        trees = df.sparkSession.sparkContext.broadcast(self.trees)  # of some leaves each

        @F.arrow_udf("double")
        def scored(row: pa.Array) -> pa.Array:
            x = np.asarray(row.flatten().cast(pa.float64()).fill_null(float("nan"))).reshape(len(row), -1)
            return pa.array(sum(np.array(t.value)[t.leaves(x, False)] for t in trees.value))

        return df.withColumn(out, scored(F.array(*(F.col(c).cast("double") for c in self.features))))

    def importance(self) -> dict[str, float]:
        """What each feature's splits gained."""
        return dict(sorted(zip(self.features, self.gains), key=lambda x: (-x[1], x[0])))

    def save(self, spark: SparkSession, path: str, overwrite: bool = False) -> None:
        files.write_json(spark, f"{path}/ranker.json", {"features": self.features, "gains": self.gains, "trees": [asdict(t) for t in self.trees]}, overwrite)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Ranker:
        known = json.loads(spark.read.text(f"{path}/ranker.json", wholetext=True).first().value)
        return cls(known["features"], [Tree(**t) for t in known["trees"]], known["gains"])


def lambdas(scored: DataFrame) -> DataFrame:
    """lambda and weight of each row of (query_id, job_id, relevance, score): over the pairs of a query with different
    grades, the change of NDCG that a swap makes times the logistic slope."""
    gain = F.element_at(F.array(*map(F.lit, GAINS)), F.col("relevance").cast("int") + 1)
    own = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "job_id")
    best = Window.partitionBy("query_id").orderBy(F.col("relevance").desc(), "job_id")
    rows = scored.select("query_id", "job_id", "relevance", "score", gain.alias("g"), (1 / F.log2(1.0 + F.row_number().over(own))).alias("d"), (1 / F.log2(1.0 + F.row_number().over(best))).alias("di"))
    ideal = rows.groupBy("query_id").agg(F.sum(F.col("g") * F.col("di")).alias("ideal")).where("ideal > 0")
    a, b = rows.alias("a"), rows.alias("b")
    pairs = a.join(b, (F.col("a.query_id") == F.col("b.query_id")) & (F.col("a.relevance") > F.col("b.relevance"))).join(ideal.alias("i"), F.col("a.query_id") == F.col("i.query_id"))
    delta = F.abs((F.col("a.g") - F.col("b.g")) * (F.col("a.d") - F.col("b.d"))) / F.col("i.ideal")
    rho = 1 / (1 + F.exp(F.col("a.score") - F.col("b.score")))
    moved = pairs.select(F.col("a.query_id").alias("query_id"), F.col("a.job_id").alias("up"), F.col("b.job_id").alias("down"), (rho * delta).alias("l"), (rho * (1 - rho) * delta).alias("w"))
    both = moved.select("query_id", F.col("up").alias("job_id"), "l", "w").union(moved.select("query_id", "down", -F.col("l"), "w"))
    return both.groupBy("query_id", "job_id").agg(F.sum("l").alias("lambda"), F.sum("w").alias("weight"))


def gradients(score: np.ndarray, grade: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """`lambdas` of queries that lie one after the other, each in the order of its jobs. Queries of one size are taken together, and of
    their pairs some rows at a time; pairs of queries of LONG rows or more are summed by `_sums`."""
    out = np.zeros((2, len(score)))
    gain, starts = np.array(GAINS)[grade], np.cumsum(sizes) - sizes
    for n in np.unique(sizes).tolist():
        of_size = starts[sizes == n]
        if n >= LONG:
            for q in of_size.tolist():
                nodes = _nodes(score[q : q + n])
                if len(nodes) * 4 < n:
                    out[:, q : q + n] = _sums(score[q : q + n], grade[q : q + n], nodes)
                    of_size = of_size[of_size != q]
        step = max(1, PAIRS // (n * n))
        for q in range(0, len(of_size), step):
            at = of_size[q : q + step, None] + np.arange(n)
            s, g = score[at], gain[at]
            rank = np.argsort(np.argsort(-s, axis=1, kind="stable"), axis=1, kind="stable")
            d = 1 / np.log2(np.arange(n) + 2)
            ideal = -np.sort(-g, axis=1) @ d
            scale = np.divide(1, ideal, out=np.zeros_like(ideal), where=ideal > 0)[:, None, None]
            d = d[rank]
            for low in range(0, n, max(1, PAIRS // n)):
                i = slice(low, low + max(1, PAIRS // n))
                more = g[:, i, None] > g[:, None, :]
                delta = np.abs((g[:, i, None] - g[:, None, :]) * (d[:, i, None] - d[:, None, :])) * scale * more
                rho = 1 / (1 + np.exp(np.clip(s[:, i, None] - s[:, None, :], -700, 700)))
                for k, part in enumerate((rho * delta, rho * (1 - rho) * delta)):
                    out[k][at[:, i]] += part.sum(2)
                    out[k][at] += (part.sum(1), -part.sum(1))[k == 0]
    return out[0], out[1]


def _nodes(score: np.ndarray) -> np.ndarray:
    """Scores between which a function of the difference of two, logistic or its slope, is interpolated to the last digits of a
    double: the scores themselves if they are few, else Chebyshev points; both have poles at a distance of pi from all scores, and the wider
    these spread, the more points it takes."""
    own = np.unique(score)
    half = (own[-1] - own[0]) / 2
    n = int(np.ceil(np.log(1e17) / np.arcsinh(np.pi / half))) + 12 if half > 0 else 1
    return own if len(own) <= n else (own[0] + own[-1]) / 2 + half * np.cos(np.pi * np.arange(n) / (n - 1))


def _basis(nodes: np.ndarray, score: np.ndarray) -> np.ndarray:
    """How much each node counts for each score (rows)."""
    apart = score[:, None] - nodes
    at = apart == 0
    if (exact := at.any(1)).all():
        return at.astype(float)
    sign = np.where(np.arange(len(nodes)) % 2, -1.0, 1.0)
    sign[[0, -1]] /= 2
    w = sign / np.where(at, 1.0, apart)
    w[exact] = at[exact]
    return w / w.sum(1, keepdims=True)


def _sums(score: np.ndarray, grade: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """`gradients` of one query, without its pairs: work grows with rows times nodes. In the order of ranks the places of all rows before
    one are better and of all after it worse, so the distance of places is a difference of running sums; and what a pair's scores add
    is a sum over nodes, so these sums are kept for each grade and node."""
    order = np.argsort(-score, kind="stable")
    s, g, n = score[order], grade[order], len(order)
    d, gains = 1 / np.log2(np.arange(n) + 2), np.array(GAINS)
    ideal = float(-np.sort(-gains[g]) @ d)
    out = np.zeros((2, n))
    if ideal <= 0:
        return out
    step = max(1, PAIRS // (4 * len(nodes)))
    blocks = [slice(low, min(low + step, n)) for low in range(0, n, step)]
    total, before = np.zeros((len(gains), 2, len(nodes))), np.zeros((len(gains), 2, len(nodes)))
    for b in blocks:
        basis = _basis(nodes, s[b])
        for h in range(len(gains)):
            some = g[b] == h
            total[h] += np.stack([np.ones(n)[b], d[b]])[:, some] @ basis[some]
    for b in blocks:
        basis, apart = _basis(nodes, s[b]), s[b, None] - nodes
        down = 1 / (1 + np.exp(np.clip(apart, -700, 700)))  # of a row that should be above one with a node's score
        slope = down * (1 - down)
        for h in range(len(gains)):
            mine = basis * (g[b] == h)[:, None]
            once, placed = np.cumsum(mine, axis=0), np.cumsum(mine * d[b, None], axis=0)
            ahead = (before[h, 1] + placed) - d[b, None] * (before[h, 0] + once)
            behind = d[b, None] * (total[h, 0] - before[h, 0] - once) - (total[h, 1] - before[h, 1] - placed)
            far = ahead + behind
            more = gains[g[b]] - gains[h]
            out[0, b] += np.where(more > 0, more * np.einsum("ij,ij->i", far, down), more * np.einsum("ij,ij->i", far, 1 - down))
            out[1, b] += np.abs(more) * np.einsum("ij,ij->i", far, slope)
            before[h] += np.stack([once[-1], placed[-1]])
    back = np.empty_like(out)
    back[:, order] = out / ideal
    return back


def _bounds(rows: DataFrame, features: list[str]) -> list[list[float]]:
    """Upper limits of the bins of each feature: all its values, if they are few, else quantiles."""
    value = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
    levels = F.array(*(F.lit(i / BINS) for i in range(1, BINS)))
    few = lambda c: F.slice(F.array_sort(F.collect_set(F.when(F.col(f"_n{c}") <= BINS, value(c)))), 1, BINS)
    counted = rows.agg(*(F.approx_count_distinct(value(c)).alias(f"_n{c}") for c in features))  # one row
    made = rows.crossJoin(F.broadcast(counted)).agg(*(F.struct(few(c).alias("all"), F.percentile_approx(value(c), levels, 10_000).alias("some")) for c in features)).first()
    return [sorted(set(m["all"] if len(m["all"] or ()) and len(m["all"]) < BINS else m["some"] or [])) for m in made]


def _packed(rows: DataFrame, features: list[str], bounds: list[list[float]], n: int) -> DataFrame:
    """(sizes, grades, bins, scores) of about n chunks of whole queries, packed. Bin 0 is for missing values; scores are 0."""

    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by([("query_id", "ascending"), ("job_id", "ascending")])
        ids = group["query_id"].combine_chunks()
        new = np.flatnonzero(np.append(True, np.asarray(ids[1:].cast(pa.string())) != np.asarray(ids[:-1].cast(pa.string()))))
        bins = np.zeros((len(ids), len(features)), np.uint8)
        for f in range(len(features)):
            x = group[f"x{f}"].combine_chunks().fill_null(float("nan")).to_numpy(zero_copy_only=False)
            bins[:, f] = np.where(np.isnan(x), 0, np.searchsorted(bounds[f], x) + 1)
        sizes, grades = np.diff(np.append(new, len(ids))).astype("<i4"), group["relevance"].to_numpy().astype(np.uint8)
        packed = {"sizes": sizes, "grades": grades, "bins": bins, "scores": np.zeros(len(ids))}
        return pa.table({c: pa.array([v.tobytes()], pa.binary()) for c, v in packed.items()})

    asked = rows.select("query_id", "job_id", F.col("relevance").cast("int").alias("relevance"), *(F.col(c).cast("double").alias(f"x{f}") for f, c in enumerate(features)))
    return asked.groupBy(F.pmod(F.xxhash64("query_id"), F.lit(n)).alias("_chunk")).applyInArrow(pack, "sizes binary, grades binary, bins binary, scores binary")


@dataclass
class _Leaf:
    """A leaf with its histogram (feature, bin, [lambda, weight, rows]), its best split, and the histogram of that split's left side."""

    held: np.ndarray
    gain: float
    feature: int
    cut: int
    inside: np.ndarray | None = None


def _leaf(held: np.ndarray, min_rows: int, min_weight: float) -> _Leaf:
    """Of the splits that leave enough on both sides the one that gains most in Newton steps, squares of lambda over weight; equal
    ones by feature and bin. Gains are rounded, so that ties don't hang on the order of sums."""
    left = np.cumsum(held, axis=1)[:, :-1]
    total = held[0].sum(0)
    right = total - left
    ok = (left[..., 2] >= min_rows) & (right[..., 2] >= min_rows) & (left[..., 1] >= min_weight) & (right[..., 1] >= min_weight)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left[..., 0] ** 2 / left[..., 1] + right[..., 0] ** 2 / right[..., 1] - total[0] ** 2 / total[1]
    gain = np.round(np.where(ok, gain, 0.0), 9)
    feature, cut = np.unravel_index(int(np.argmax(gain)), gain.shape)
    return _Leaf(held, float(gain[feature, cut]), int(feature), int(cut))


def _histogram(x: np.ndarray, lam: np.ndarray, weight: np.ndarray, tree: Tree, asked: dict[int, tuple[int, int]], total: np.ndarray) -> None:
    """Add rows to the histograms of asked leaves, of each the rows whose bin of a feature is at most a cut."""
    at = tree.leaves(x)
    for k, (leaf, (feature, cut)) in enumerate(asked.items()):
        mine = np.flatnonzero((at == leaf) & (x[:, feature] <= cut))
        for f in range(x.shape[1]):
            for j, v in enumerate((lam[mine], weight[mine], None)):
                total[k, f, :, j] += np.bincount(x[mine, f], v, BINS + 1)


@dataclass(frozen=True)
class _Grower:
    """How trees grow from histograms, wherever these are made."""

    bounds: list[list[float]]
    rate: float
    leaves: int
    min_rows: int
    min_weight: float

    def tree(self, histograms: Callable[[Tree, dict[int, tuple[int, int]]], dict[int, np.ndarray]], gains: list[float]) -> Tree:
        tree = Tree()
        open_ = {0: _leaf(histograms(tree, {0: (0, BINS)})[0], self.min_rows, self.min_weight)}
        while len(open_) < self.leaves:
            node, best = max(open_.items(), key=lambda x: (x[1].gain, -x[0]))
            if best.gain <= 0:
                break
            if best.inside is None:
                for k, inside in histograms(tree, {k: (v.feature, v.cut) for k, v in open_.items() if v.inside is None and v.gain > 0}).items():
                    open_[k].inside = inside
            del open_[node]
            # bin 0 holds missing values: a cut there has no limit that a value could meet
            limit = self.bounds[best.feature][best.cut - 1] if best.cut else float("-inf")
            a, b = tree.split(node, best.feature, best.cut, limit)
            gains[best.feature] += best.gain
            open_[a], open_[b] = (_leaf(h, self.min_rows, self.min_weight) for h in (best.inside, best.held - best.inside))
        for node, leaf in open_.items():
            lam, weight = leaf.held[0, :, 0].sum(), leaf.held[0, :, 1].sum()
            tree.value[node] = self.rate * float(lam / weight) if weight > 0 else 0.0
        return tree


def _alone(chunks: DataFrame, features: list[str], trees: int, grower: _Grower) -> Ranker:
    """All trees from one chunk, in one task."""
    n_features = len(features)

    def learn(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for sizes, grades, bins, scores in zip(*(c.to_pylist() for c in batch.columns)):
                x, score = np.frombuffer(bins, np.uint8).reshape(-1, n_features), np.frombuffer(scores, "<f8").copy()
                made, gains = [], [0.0] * n_features
                for _ in range(trees):
                    lam, weight = gradients(score, np.frombuffer(grades, np.uint8), np.frombuffer(sizes, "<i4"))

                    def histograms(tree: Tree, asked: dict[int, tuple[int, int]]) -> dict[int, np.ndarray]:
                        total = np.zeros((len(asked), n_features, BINS + 1, 3))
                        _histogram(x, lam, weight, tree, asked, total)
                        return dict(zip(asked, total))

                    made.append(tree := grower.tree(histograms, gains))
                    score += np.array(tree.value)[tree.leaves(x)]
                yield pa.RecordBatch.from_arrays([pa.array([json.dumps({"gains": gains, "trees": [asdict(t) for t in made]})])], names=["model"])

    model = chunks.mapInArrow(learn, "model string").first()
    if model is None:
        return Ranker(features, [Tree() for _ in range(trees)], [0.0] * n_features)
    known = json.loads(model.model)
    return Ranker(features, [Tree(**t) for t in known["trees"]], known["gains"])


def fit(train: DataFrame, features: list[str], trees: int = 80, rate: float = 0.05, leaves: int = 15, min_rows: int = 20, min_weight: float = 1e-3) -> Ranker:
    """Trees on the gradients of the ones before, each grown at the leaf whose split gains most until it has `leaves`; values are
    rate * sum(lambda) / sum(weight). `train`: query_id, job_id, relevance (0 to 2) and the features; missing values go left.

    Features are binned once, and rows packed in chunks of whole queries. For each tree scores and gradients are computed where the
    rows are and stored beside them, as long as the tree grows. A pass makes histograms of these and sums them: what comes to the driver is
    one row a bin (of each task, while there are FEW tasks: a shuffle takes longer than such a pass). A pass looks at all leaves that may be split next and makes the histograms of their left sides (right sides by
    subtraction), so it serves several splits. A query is taken by one task; its work doesn't grow with the square of its list.
    Rows of ALONE chunks at most are one chunk, and one task makes all trees.
    """
    spark = train.sparkSession
    rows = train.select("query_id", "job_id", "relevance", *features)
    bounds, n = _bounds(rows, features), max(1, -(-rows.count() // CHUNK))
    grower, alone = _Grower(bounds, rate, leaves, min_rows, min_weight), n <= min(ALONE, FEW)
    chunks = materialise(spread(_packed(rows, features, bounds, 1 if alone else n)))
    if alone:
        return _alone(chunks, features, trees, grower)
    few = chunks.count() <= FEW
    model, n_features = Ranker(features, gains=[0.0] * len(features)), len(features)

    def scored(it: Iterable[pa.RecordBatch], new: list[Tree]) -> Iterator[tuple[bytes, bytes, bytes, np.ndarray]]:
        for batch in it:
            for sizes, grades, bins, scores in zip(*(c.to_pylist() for c in batch.columns)):
                x, score = np.frombuffer(bins, np.uint8).reshape(-1, n_features), np.frombuffer(scores, "<f8").copy()
                for t in new:
                    score += np.array(t.value)[t.leaves(x)]
                yield sizes, grades, bins, score

    def stored(chunks: DataFrame, new: list[Tree]) -> DataFrame:
        """The chunks with the scores after more trees."""

        def read(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for sizes, grades, bins, score in scored(it, new):
                yield pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in (sizes, grades, bins, score.tobytes())], names=["sizes", "grades", "bins", "scores"])

        return materialise(chunks.mapInArrow(read, chunks.schema))

    def graded(chunks: DataFrame, new: list[Tree]) -> DataFrame:
        """(bins, l, w) of some rows each: what the histograms of a tree are made from."""

        def read(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for sizes, grades, bins, score in scored(it, new):
                both = gradients(score, np.frombuffer(grades, np.uint8), np.frombuffer(sizes, "<i4"))
                for low in range(0, len(score), CHUNK):
                    part = slice(low, low + CHUNK)
                    columns = (bins[low * n_features : (low + CHUNK) * n_features], *(v[part].astype("<f8").tobytes() for v in both))
                    yield pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in columns], names=["bins", "l", "w"])

        return materialise(chunks.mapInArrow(read, "bins binary, l binary, w binary"))

    def histograms(held: DataFrame, tree: Tree, asked: dict[int, tuple[int, int]]) -> dict[int, np.ndarray]:
        """For each asked leaf the histogram of its rows whose bin of a feature is at most a cut."""

        def read(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((len(asked), n_features, BINS + 1, 3))
            for batch in it:
                for bins, lam, weight in zip(*(c.to_pylist() for c in batch.columns)):
                    _histogram(np.frombuffer(bins, np.uint8).reshape(-1, n_features), np.frombuffer(lam, "<f8"), np.frombuffer(weight, "<f8"), tree, asked, total)
            k, f, b = np.nonzero(total[..., 2])
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in (*(v.astype(np.int32) for v in (k, f, b)), *total[k, f, b].T)], names=["k", "f", "b", "l", "w", "n"])

        sums = held.mapInArrow(read, "k int, f int, b int, l double, w double, n double")
        if not few:
            sums = sums.groupBy("k", "f", "b").agg(*(F.sum(c).alias(c) for c in "lwn"))
        sums = sums.toArrow()
        out = np.zeros((len(asked), n_features, BINS + 1, 3))
        np.add.at(out, tuple(sums[c].to_numpy() for c in "kfb"), np.stack([sums[c].to_numpy() for c in "lwn"], axis=1))
        return dict(zip(asked, out))

    new: list[Tree] = []  # trees that the stored scores lack
    for _ in range(trees):
        if len(new) == ROUND:
            chunks, new = stored(chunks, new), []
        with scratch(spark):
            held = graded(chunks, new)
            tree = grower.tree(lambda tree, asked: histograms(held, tree, asked), model.gains)
        new.append(tree)
        model.trees.append(tree)
    return model
