"""Mixing sources to target weights by pivotal dependent rounding. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.tables import materialise, row_hash, running_totals

WORD = r"[^\x20\x09-\x0D]+"
#: Shares nearer to a whole number than this are whole.
TINY = 1e-9
#: Rows that one task makes from a class of equal rows, at most.
SPREAD = 4096


def words_in(text: str) -> Column:
    """Number of words; null texts have none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """Targets of sources: `share` of all sizes, dealt by weight; what exceeds `cap` times a source's size is
    dealt again among the others until none is above. `sizes` has source and source_size. Weights repeat along
    the sources by code point, null last. Only totals come to the driver; each round fixes at least one source."""
    ranked = running_totals(sizes, [F.col("source").asc_nulls_last()], {"before": F.col("source_size")})
    turn = F.array(*(F.lit(float(w)) for w in weights))
    table = materialise(
        ranked.select(
            "source",
            "source_size",
            "units",
            F.element_at(turn, (F.col("position") % len(weights) + 1).cast("int")).alias("weight"),
            (F.col("source_size") * float(cap)).alias("most"),
        )
    )
    total, weight = table.agg(F.sum("source_size"), F.sum("weight")).first()
    goal = share * (total or 0)
    level, full = goal / weight if weight else 0.0, -1
    while True:
        over = F.col("weight") * F.lit(level) >= F.col("most")
        held, open_weight, n = table.agg(
            F.sum(F.when(over, F.col("most")).otherwise(0.0)),
            F.sum(F.when(over, 0.0).otherwise(F.col("weight"))),
            F.sum(over.cast("int")),
        ).first()
        if not n or n == full or not open_weight:
            break
        level, full = (goal - held) / open_weight, n
    return table.select(
        "source", "source_size", "units", F.least(F.col("weight") * F.lit(level), F.col("most")).alias("target")
    )


#: One document that is still undecided: `mass` of its `room` words is in the mix; the others of its class are settled.
_CLASS = ("doc_id", "size", "hash", "n", "base", "sure")
_TYPES = "doc_id:bigint,size:bigint,hash:bigint,n:bigint,base:int,sure:bigint"
_UNIT = f"struct<turn:bigint,{_TYPES},room:double,mass:double>"
_DECIDED = f"struct<{_TYPES},drawn:int>"


def _chance(*parts: str) -> str:
    """SQL for a number in [0, 1) that depends on these alone."""
    return f"(xxhash64({', '.join(parts)}) & 9007199254740991) / 9007199254740992D"


def _fold(units: str, seed: int) -> str:
    """SQL that walks along an array of units and lets the carried unit and the next one exchange mass until one of
    them is empty or full. The sum of masses stays, and so does each unit's expectation: mass moves up with the
    chance that makes the move fair. Gives the decided units, and the one that is left."""

    def decided(unit: str, full: int) -> str:
        return f"array_append(acc.done, named_struct({', '.join(f"'{f}', {unit}.{f}" for f in _CLASS)}, 'drawn', {full}))"

    def keep(unit: str, mass: str) -> str:
        return f"named_struct({', '.join(f"'{f}', {unit}.{f}" for f in ('turn', *_CLASS, 'room'))}, 'mass', {mass})"

    up, down = "least(acc.left.room - acc.left.mass, u.mass)", "least(acc.left.mass, u.room - u.mass)"
    draw = _chance("acc.left.turn", "u.turn", str(seed))
    state = lambda done, left: f"named_struct('done', {done}, 'left', {left})"
    return f"""aggregate({units},
        named_struct('done', cast(array() as array<{_DECIDED}>), 'left', cast(null as {_UNIT})),
        (acc, u) -> CASE
            WHEN acc.left IS NULL THEN {state("acc.done", "u")}
            WHEN {draw} * ({up} + {down}) < {down} THEN CASE
                WHEN acc.left.room - acc.left.mass <= u.mass
                THEN {state(decided("acc.left", 1), keep("u", "u.mass - (acc.left.room - acc.left.mass)"))}
                ELSE {state(decided("u", 0), keep("acc.left", "acc.left.mass + u.mass"))} END
            ELSE CASE
                WHEN acc.left.mass <= u.room - u.mass
                THEN {state(decided("acc.left", 0), keep("u", "u.mass + acc.left.mass"))}
                ELSE {state(decided("u", 1), keep("acc.left", "acc.left.mass - (u.room - u.mass)"))} END
            END)"""


def decide(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    cap: float = 2.0,
    seed: int = 42,
    fan_in: int = 64,
    text: str = "text",
    key: str = "doc_id",
    source: str = "source",
) -> DataFrame:
    """How often each document goes into the mix, so that each source's words come to its target.

    A source's target over its size is the expected number of copies of each of its documents. The whole part is
    taken for sure. The fractional parts are rounded by the pivotal method, in words: pairs of documents exchange
    mass until one of them is empty or full, which leaves the source's sum unchanged. Rows that agree in all columns
    are a class; the whole part of its common mass is taken for sure by as many of its rows, and what remains is the
    mass of one more row, which is the class's unit. Units are dealt to groups of about `fan_in` by a hash of their key;
    each group ends with at most one undecided unit, and those are dealt to groups again, a tree of depth
    log(documents) to the base `fan_in`, however large one source is. The last unit of a source is drawn. So a source
    misses its target by less than one document, however often its rows repeat.

    Returns doc_id, source, size, hash (of all columns), n (rows of the class), source_size, target, base (copies of
    each row) and extra (rows of the class that are taken once more). Choices depend on the rows and `seed` alone, so
    reruns agree. Null texts have size 0; documents without words are taken 0 words (their copies are the whole part);
    a null source is a source of its own, the last; null keys are allowed; very long texts are units like others (a
    target is met within the longest document); an empty table gives no rows; other columns only tell rows apart.
    """
    units = materialise(
        docs.select(
            F.col(key).cast("long").alias("doc_id"), F.col(source).alias("source"), words_in(text).alias("size"), row_hash(docs).alias("hash")
        )
        .groupBy("doc_id", "source", "size", "hash")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    sizes = units.groupBy("source").agg(
        F.sum(F.col("n") * F.col("size")).alias("source_size"), F.count(F.lit(1)).alias("units")
    )
    goals = targets(sizes, weights, share, cap)

    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    base = F.floor(F.col("rate") + TINY).cast("int")
    part = F.col("n") * F.greatest(F.col("rate") - F.col("base"), F.lit(0.0))
    settled = F.floor(F.col("part") + TINY).cast("long")
    rest = F.col("part") - F.col("sure")
    turn = F.xxhash64("doc_id", "size", "hash", F.lit(seed))
    spread = (
        units.alias("l")
        .join(goals.alias("r"), F.col("l.source").eqNullSafe(F.col("r.source")))
        .select("l.doc_id", "l.source", "l.size", "l.hash", "l.n", rate.alias("rate"), F.ceil(F.col("units") / fan_in).alias("groups"))
        .select("*", base.alias("base"))
        .select("*", part.alias("part"))
        .select("*", settled.alias("sure"))
        .select("*", F.when(rest > TINY, rest).otherwise(0.0).alias("rest"), turn.alias("turn"))
    )
    open_ = (F.col("rest") > 0) & (F.col("size") > 0)
    room = F.col("size").cast("double")
    unit = F.struct("turn", *_CLASS, room.alias("room"), (room * F.col("rest")).alias("mass"))
    level = spread.where(open_).select("source", F.pmod("turn", "groups").alias("group"), unit.alias("unit"))
    widest = goals.agg(F.max(F.ceil(F.col("units") / fan_in))).first()[0] or 1

    every = spread.where(~open_).select("source", *_CLASS, F.lit(0).alias("drawn"))
    while True:
        folded = materialise(
            level.groupBy("source", "group")
            .agg(F.array_sort(F.collect_list("unit")).alias("units"))
            .select("source", "group", F.expr(_fold("units", seed)).alias("state"))
        )
        every = every.unionByName(folded.select("source", F.explode("state.done").alias("d")).select("source", "d.*"))
        level = folded.select(
            "source", F.expr(f"`group` div {fan_in}").alias("group"), F.col("state.left").alias("unit")
        )
        if widest <= 1:
            break
        widest = -(-widest // fan_in)
    drawn = F.expr(f"{_chance('unit.turn', str(seed))} < unit.mass / unit.room").cast("int")
    every = every.unionByName(level.select("source", *(f"unit.{c}" for c in _CLASS), drawn.alias("drawn")))
    return (
        every.alias("l")
        .join(goals.alias("r"), F.col("l.source").eqNullSafe(F.col("r.source")))
        .select(
            "l.doc_id",
            "l.source",
            "l.size",
            "l.hash",
            "l.n",
            "r.source_size",
            "r.target",
            "l.base",
            (F.col("l.sure") + F.col("l.drawn")).alias("extra"),
        )
    )


def _times(df: DataFrame, n: str) -> DataFrame:
    """Each row as often as column `n` says, with `_at` (from 1). Large numbers are dealt to tasks, SPREAD at a time."""
    few = df.where(F.col(n).between(1, SPREAD)).select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col(n).cast("long"))).alias("_at"))
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"({n} - 1) div {SPREAD}"))).alias("_part")
    many = df.where(F.col(n) > SPREAD).select("*", part).repartition("_part", "hash")
    first = F.col("_part") * SPREAD
    many = many.select("*", F.explode(F.sequence(first + 1, F.least(first + SPREAD, F.col(n).cast("long")))).alias("_at")).drop("_part")
    return few.unionByName(many)


def mix(docs: DataFrame, **options) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken for each row of `docs`; options as for `decide`.
    taken is the number of words that the mix takes of the row, repeats counted."""
    copies = (F.col("base") + (F.col("_at") <= F.col("extra")).cast("int")).alias("copies")
    rows = _times(decide(docs, **options), "n").select("doc_id", "source", "size", "source_size", "target", copies)
    return rows.select("*", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", **options) -> DataFrame:
    """The mix itself: the rows of `docs` with all their columns, each as often as it was taken.

    Null, empty and very long texts, null keys and sources, repeated rows and empty tables are as in `decide`. Rows
    that are alone in their class are multiplied where they stand; of a class of repeated rows each gives its `base`
    copies and one of them all the extra ones."""
    taken = decide(docs, text=text, key=key, source=source, **options).where("base > 0 or extra > 0")
    here = F.when(F.col("n") == 1, F.col("base") + F.col("extra")).otherwise(F.col("base"))
    taken = taken.select(
        F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"), F.col("hash").alias("_hash"), "n", "extra", here.alias("here")
    )
    rows = docs.select(
        F.struct(*docs.columns).alias("_all"), F.col(key).cast("long").alias("id"), F.col(source).alias("source"), words_in(text).alias("size"),
        row_hash(docs).alias("hash"),
    )
    same = (
        F.col("id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_source")) & (F.col("size") == F.col("_size"))
        & (F.col("hash") == F.col("_hash"))
    )
    alone = rows.join(taken.where("here > 0"), same).select("_all", F.explode(F.sequence(F.lit(1), "here"))).select("_all.*")
    classes = rows.join(taken.where("n > 1 and extra > 0"), same).groupBy("id", "source", "size", "hash")
    more = _times(classes.agg(F.first("_all").alias("_all"), F.first("extra").alias("extra")), "extra").select("_all.*")
    return alone.unionByName(more)
