"""Ratings laid out once for a training loop, and the passes that run over them.

``RatingBlocks`` keeps two persisted copies of the ratings, dealt by user and
by item.  A loop then never moves a rating again: each pass sends every factor
vector once to each block that holds ratings of its id (``routes``, derived
once), and the block's arrays meet them in a cogroup on the block number, as
Arrow tables.

Block b is partition b on both sides (``repartitionById``): no partition is empty
and none holds two blocks.  There are as many blocks as cores, and more (whole multiples of
the cores) only where one would exceed ``per_block`` ratings; the larger a block, the fewer
messages a pass sends (a vector goes once to each block that needs it).  Inside
a task ratings are worked through in slices, so a block costs its Arrow
buffers and little more.

An id with more ratings than ``hot`` is dealt over several blocks; its partial
sums (k numbers, or one Gram matrix, per block) are merged afterwards.

The passes over both sides (gradient, line polynomial, loss) may have a layout ``grid`` instead: users and items fall into
groups, and a block is a pair of groups.  With p groups of users and q of items a user's vector goes to q blocks at most and an item's
to p, where a layout by user sends an item to nearly as many blocks as it has ratings.  p and q make the fewest messages; with
few items that is p = all blocks and q = 1, the layout by user.

Vectors of a side that lack an id are treated like an inner join: its ratings
do not count.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from math import ceil, isfinite

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .solve import batched_solve

OTHER = {"user": "item", "item": "user"}
SIDE = {"user": 0, "item": 1}
#: Ratings that a pass works through at a time.
SLICE = 1 << 18


@dataclass
class RatingBlocks:
    n_ratings: int
    n_blocks: int
    rows: dict[str, DataFrame]     # side → block, own, other, rating, shared (own lies in several blocks)
    routes: dict[str, DataFrame]   # layout → side, id, blocks
    split: dict[str, bool]         # side → whether any id is dealt over several blocks
    held: list[DataFrame] = field(default_factory=list)

    @classmethod
    def of(cls, ratings: DataFrame, per_block: int = 2_000_000, hot: int | None = None, sides=("user", "item")) -> "RatingBlocks":
        """``hot``: an eighth of ``per_block`` unless given.  The layouts are written to storage here; ``ratings`` is not
        read again."""
        spark = ratings.sparkSession
        hot = max(1, per_block // 8) if hot is None else hot
        r = ratings.select(F.col("user").cast("long").alias("user"), F.col("item").cast("long").alias("item"),
                           F.col("rating").cast("double").alias("rating"))
        # a written table (``cut``) is read again as it is
        held_here = None if ratings.is_cached or getattr(ratings, "written_at", None) else r.persist()
        n, users, items = r.agg(F.count(F.lit(1)), *[F.approx_count_distinct(c) for c in ("user", "item")]).first()
        cores = spark.sparkContext.defaultParallelism
        n_blocks = max(1, min(cores, ceil(n / 5_000)), ceil(n / per_block))
        if n_blocks > cores:  # whole waves: a last wave of few blocks takes as long as a full one
            n_blocks = -(-n_blocks // cores) * cores
        rows, routes, split, held = {}, {}, {}, []
        if "grid" in sides:
            shape = grid_shape(n_blocks, n, users, items, n_blocks > cores)
            n_blocks = shape[0] * shape[1]
        for side in sides:
            own = "user" if side == "grid" else side
            if side == "grid":
                frame, split[side] = _deal_grid(r, shape, hot)
            else:
                frame, split[side] = _deal(r, side, n_blocks, hot)
            rows[side] = frame.persist()
            ends = rows[side].select("block", "own", "other").mapInArrow(_ends(SIDE[own], SIDE[OTHER[own]]), "block int, side int, id long")
            routes[side] = ends.groupBy("side", "id").agg(F.collect_set("block").alias("blocks")).persist()
            routes[side].count()
            held += [rows[side], routes[side]]
        if held_here is not None:
            held_here.unpersist()
        return cls(n, n_blocks, rows, routes, split, held)

    def release(self) -> None:
        for df in self.held:
            df.unpersist()

    @property
    def both(self) -> str:
        """The layout for passes over both sides."""
        return "grid" if "grid" in self.rows else "user"

    def routed(self, layout: str, vectors: DataFrame) -> DataFrame:
        """``vectors(side, id, …)`` with the column ``blocks``, to be carried along by a loop: ``messages`` then joins nothing."""
        return vectors.withColumn("id", F.col("id").cast("long")).join(self.routes[layout], ["side", "id"], "left")

    def messages(self, layout: str, vectors: DataFrame, n: int) -> DataFrame:
        """``vectors(side, id, v)``, once per block that needs them: ``to, side, id, v0 …`` (``n`` numbers, as flat columns,
        which Arrow moves as plain buffers)."""
        carried = ["blocks"] if "blocks" in vectors.columns else []
        flat = vectors.selectExpr("side", "cast(id as long) id", *[f"v[{j}] v{j}" for j in range(n)], *carried)
        if not carried:
            flat = flat.join(self.routes[layout], ["side", "id"])
        return flat.selectExpr("explode(blocks) to", "side", "id", *[f"v{j}" for j in range(n)])

    def meet(self, layout: str, messages: DataFrame, fn, schema: str) -> DataFrame:
        """``fn(ratings, messages)`` per block, on Arrow tables; only the messages are shuffled."""
        dealt = messages.repartitionById(self.n_blocks, "to")
        return self.rows[layout].groupBy("block").cogroup(dealt.groupBy("to")).applyInArrow(fn, schema)


def _ends(own_side: int, other_side: int, held: int = 1 << 18):
    """Per task, each id once per block and side (``block`` runs in order), so that ids and not ratings are shuffled.

    The ids seen of a block are made distinct whenever ``held`` ratings more have come.
    """
    schema = pa.schema([("block", pa.int32()), ("side", pa.int32()), ("id", pa.int64())])

    def run(batches):
        block, seen, new, size = None, [np.zeros(0, np.int64)] * 2, ([], []), 0

        def distinct():
            return [np.unique(np.concatenate([s, *n])) for s, n in zip(seen, new)]

        def done():
            for side, ids in zip((own_side, other_side), distinct()):
                for lo in range(0, len(ids), 65536):
                    part = ids[lo:lo + 65536]
                    full = lambda x: np.full(len(part), x, dtype=np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(full(block)), pa.array(full(side)), pa.array(part)], schema=schema)

        for batch in batches:
            number, (own, other) = batch.column(0).to_numpy(), batch.columns[1:]
            starts = _starts(number) if len(number) else []
            for lo, hi in zip(starts, [*starts[1:], len(number)]):
                if number[lo] != block:
                    if block is not None:
                        yield from done()
                    block, seen, new, size = int(number[lo]), [np.zeros(0, np.int64)] * 2, ([], []), 0
                for ids, column in zip(new, (own, other)):  # a null id meets no vector
                    ids.append(column.slice(lo, hi - lo).drop_null().to_numpy())
                size += hi - lo
                if size >= held:
                    seen, new, size = distinct(), ([], []), 0
        if block is not None:
            yield from done()
    return run


def _deal(r: DataFrame, side: str, n_blocks: int, hot: int) -> tuple[DataFrame, bool]:
    own, other = F.col(side), F.col(OTHER[side])
    heavy = r.groupBy(side).agg(F.ceil(F.count(F.lit(1)) / F.lit(hot)).cast("int").alias("parts")).filter("parts > 1")
    any_heavy = bool(heavy.limit(1).count())
    # an id's parts never exceed its ratings / hot, and there are at most n / hot such ids: a join, not a literal list
    parts = F.coalesce(F.col("parts"), F.lit(1)) if any_heavy else F.lit(1)
    base = r.join(heavy, side, "left") if any_heavy else r
    block = F.pmod(F.xxhash64(own, F.pmod(F.xxhash64(other), parts)), F.lit(n_blocks)).cast("int")
    dealt = base.select(block.alias("block"), own.alias("own"), other.alias("other"), "rating", (parts > 1).alias("shared"))
    return dealt.repartitionById(n_blocks, "block").sortWithinPartitions("block", "own", "other"), any_heavy


def grid_shape(n_blocks: int, n: int, users: int, items: int, more: bool = False) -> tuple[int, int]:
    """(p, q) with p·q = ``n_blocks`` (up to an eighth above with ``more``) that make the fewest messages: groups of users
    and of items.

    An id with d ratings meets about g·(1 − (1 − 1/g)^d) of g groups.
    """
    def met(ids: int, g: int) -> float:
        return ids * g * (1 - (1 - 1 / g) ** (n / max(ids, 1))) if g > 1 else float(ids)
    shapes = [(p, -(-n_blocks // p)) for p in range(n_blocks, 0, -1)]
    return min((g for g in shapes if g[0] * g[1] <= n_blocks + more * (n_blocks // 8)), key=lambda g: met(users, g[1]) + met(items, g[0]))


def _deal_grid(r: DataFrame, shape: tuple[int, int], hot: int) -> tuple[DataFrame, bool]:
    """Blocks are pairs of a user group and an item group; ids with more than ``hot`` ratings are dealt over several groups."""
    group = {}
    split = False
    for side, groups in zip(("user", "item"), shape):
        if groups == 1:
            group[side] = F.lit(0)
            continue
        heavy = r.groupBy(side).agg(F.ceil(F.count(F.lit(1)) / F.lit(hot)).cast("int").alias(f"{side}_parts")).filter(f"{side}_parts > 1")
        part = F.lit(0)
        if heavy.limit(1).count():
            r, split = r.join(heavy, side, "left"), True
            part = F.pmod(F.xxhash64(OTHER[side], F.lit(1)), F.coalesce(F.col(f"{side}_parts"), F.lit(1)))
        group[side] = F.pmod(F.xxhash64(F.col(side), part), F.lit(groups))
    block = (group["user"] * F.lit(shape[1]) + group["item"]).cast("int")
    dealt = r.select(block.alias("block"), F.col("user").alias("own"), F.col("item").alias("other"), "rating", F.lit(False).alias("shared"))
    return dealt.repartitionById(shape[0] * shape[1], "block").sortWithinPartitions("block", "own", "other"), split


def _ratings(rows: pa.Table) -> tuple[np.ndarray, ...]:
    """Columns own, other, rating, shared of a block, sorted by own (as the layout is stored)."""
    cols = [rows.column(c).to_numpy() for c in ("own", "other", "rating", "shared")]
    if (cols[0][1:] < cols[0][:-1]).any():
        order = np.argsort(cols[0], kind="stable")
        cols = [c[order] for c in cols]
    return tuple(cols)


def _vectors(messages: pa.Table, side: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted ids of a side, and their vectors."""
    mine = np.flatnonzero(messages.column("side").to_numpy() == side)
    ids = messages.column("id").to_numpy()[mine]
    order = np.argsort(ids, kind="stable")
    names = [c for c in messages.column_names if c.startswith("v")]
    v = np.empty((len(ids), len(names)))
    for j, c in enumerate(names):
        v[:, j] = messages.column(c).to_numpy()[mine[order]]
    return ids[order], v


def _rows_at(ids: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Position of each wanted id in the sorted ``ids``, and whether it is there."""
    at = np.searchsorted(ids, wanted)
    at[at == len(ids)] = 0
    return at, (ids[at] == wanted) if len(ids) else np.zeros(len(wanted), dtype=bool)


def _starts(own: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.flatnonzero(own[1:] != own[:-1]) + 1])


def _lists(rows: np.ndarray, present: np.ndarray) -> pa.ListArray:
    """Lists of the rows of a matrix; null where not ``present`` (``rows`` has the present ones only)."""
    offsets = np.concatenate([[0], np.cumsum(np.where(present, rows.shape[1], 0))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel()), mask=pa.array(~present))


# ------------------------------------------------------------------ ALS half-step
#: Rows from which a product of matrices costs less than the products of all pairs of columns.
MANY = 16


def _grams(x: np.ndarray, starts: np.ndarray, ends: np.ndarray, upper) -> np.ndarray:
    """Upper triangles of XᵀX of each run of rows ``starts .. ends``; the runs follow one another and cover ``x``."""
    sizes = ends - starts
    many = np.flatnonzero(sizes >= MANY)
    if not len(many):
        return np.add.reduceat(x[:, upper[0]] * x[:, upper[1]], starts, axis=0)
    out = np.empty((len(starts), len(upper[0])))
    whole = np.empty((len(many), x.shape[1], x.shape[1]))
    for i, lo, hi in zip(range(len(many)), starts[many].tolist(), ends[many].tolist()):
        rows = x[lo:hi]
        np.matmul(rows.T, rows, out=whole[i])
    out[many] = whole[:, upper[0], upper[1]]
    few = np.flatnonzero(sizes < MANY)
    if len(few):
        rest = x[np.repeat(sizes < MANY, sizes)]
        out[few] = np.add.reduceat(rest[:, upper[0]] * rest[:, upper[1]], np.cumsum(sizes[few]) - sizes[few], axis=0)
    return out


HALF_STEP = "id long, features array<double>, sse double, gram array<double>"


def half_step(blocks: RatingBlocks, fixed: DataFrame, out_side: str, k: int, lam: float, scored: bool = False) -> DataFrame:
    """M2 over a layout: ``id, features`` of ``out_side`` from the fixed side's ``id, features``; one plan for every rank.

    ``scored`` adds ``sse``: the squared errors of the id's ratings at its new
    vector, which is the loss of a sweep without another pass over the ratings.
    """
    upper = np.triu_indices(k)

    def solve(rows: pa.Table, messages: pa.Table) -> pa.Table:
        names = ["id", "features", "sse", "gram"]
        lists = pa.list_(pa.float64())
        empty = pa.Table.from_arrays([pa.array([], t) for t in (pa.int64(), lists, pa.float64(), lists)], names=names)
        if not rows.num_rows or not messages.num_rows:
            return empty
        ids, v = _vectors(messages, SIDE[OTHER[out_side]])
        own, other, rating, shared = _ratings(rows)
        at, known = _rows_at(ids, other)
        if not known.all():
            at, own, rating, shared = at[known], own[known], rating[known], shared[known]
        if not len(own):
            return empty
        starts = _starts(own)
        ends = np.append(starts[1:], len(own))
        g = np.empty((len(starts), len(upper[0])))
        b = np.empty((len(starts), k))
        part = shared[starts]
        features, sse = np.zeros((len(starts), k)), np.empty(len(starts))
        # whole ids at a time, so that the products of one slice stay small
        slices = np.unique(np.searchsorted(starts, np.arange(0, len(own) + 1, 32_768)))
        for lo, hi in zip([0, *slices.tolist()], [*slices.tolist(), len(starts)]):
            if lo < hi:
                a, z = starts[lo], ends[hi - 1]
                x = v[at[a:z]]
                g[lo:hi] = _grams(x, starts[lo:hi] - a, ends[lo:hi] - a, upper)
                b[lo:hi] = np.add.reduceat(x * rating[a:z, None], starts[lo:hi] - a, axis=0)
                whole = lo + np.flatnonzero(~part[lo:hi])
                features[whole] = batched_solve(square(g[whole], k), b[whole], lam)
                own_v = np.repeat(features[lo:hi], ends[lo:hi] - starts[lo:hi], axis=0)
                error = rating[a:z] - np.einsum("ij,ij->i", x, own_v)
                # the parts of a split id keep the squares of their ratings; the rest follows from the merged sums
                sse[lo:hi] = np.add.reduceat(error * error, starts[lo:hi] - a)
        gram = np.concatenate([g[part], b[part]], axis=1)
        return pa.Table.from_arrays([pa.array(own[starts]), _lists(features[~part], ~part), pa.array(sse), _lists(gram, part)], names=names)

    fixed = fixed.select(F.lit(SIDE[OTHER[out_side]]).alias("side"), "id", F.col("features").alias("v"))
    solved = blocks.meet(out_side, blocks.messages(out_side, fixed, k), solve, HALF_STEP)
    out = ["id", "features"] + ["sse"] * scored
    if not blocks.split[out_side]:
        return solved.select(*out)

    def merge(batches):
        # rows sorted by id: whole ones pass, the parts of a split id add up (at most one row per block)
        held_id, held, squares = None, None, 0.0

        def done():
            gram, right = square(held[None, :len(upper[0])], k), held[None, len(upper[0]):]
            x = batched_solve(gram, right, lam)[0]
            error = squares - 2 * x @ right[0] + x @ gram[0] @ x
            return pa.RecordBatch.from_arrays([pa.array([held_id]), pa.array([x]), pa.array([max(float(error), 0.0)])],
                                              names=["id", "features", "sse"])
        for batch in batches:
            whole = batch.column("features").is_valid()
            yield batch.filter(whole).select(["id", "features", "sse"])
            for row in batch.filter(pa.compute.invert(whole)).to_pylist():
                if held_id is not None and row["id"] != held_id:
                    yield done()
                    held, squares = None, 0.0
                sums = np.array(row["gram"])
                held_id, held, squares = row["id"], sums if held is None else held + sums, squares + row["sse"]
        if held_id is not None:
            yield done()

    merged = solved.repartition("id").sortWithinPartitions("id").mapInArrow(merge, "id long, features array<double>, sse double")
    return merged.select(*out)


def square(upper: np.ndarray, k: int) -> np.ndarray:
    """Symmetric matrices from their upper triangles, one per row."""
    out = np.zeros((len(upper), k, k))
    i, j = np.triu_indices(k)
    out[:, i, j] = upper
    out[:, j, i] = upper
    return out


# ------------------------------------------------------------------ passes over both sides
def _pairs(rows: pa.Table, messages: pa.Table):
    """Ids and vectors of both sides, and per slice of ratings that have both: their two positions and their values."""
    uid, u = _vectors(messages, 0)
    iid, v = _vectors(messages, 1)

    def slices():
        own, other, rating, _ = _ratings(rows)
        for lo in range(0, len(own), SLICE):
            a, known_a = _rows_at(uid, own[lo:lo + SLICE])
            b, known_b = _rows_at(iid, other[lo:lo + SLICE])
            known = known_a & known_b
            if known.any():
                yield a[known], b[known], rating[lo:lo + SLICE][known]
    return uid, u, iid, v, slices()


# The expressions of a pass are SQL text: a loop builds its plans again at every step, and hundreds of Column calls would
# take the driver longer than the jobs take.

def dot_sql(p: str, q: str, k: int) -> str:
    """Inner product of two array columns of length ``k``."""
    return "(" + " + ".join(f"{p}[{j}] * {q}[{j}]" for j in range(k)) + ")"


def number(x: float) -> str:
    """A double literal."""
    x = float(x)
    return f"({x!r}D)" if isfinite(x) else f"double('{x}')"


LOSS = -1


def loss_pass(blocks: RatingBlocks, x: DataFrame, k: int, lam: float, normalizer: float) -> DataFrame:
    """A5 over ``x(side, id, features)``: one row ``loss``.  One number leaves each block."""
    def sums(rows: pa.Table, messages: pa.Table) -> pa.Table:
        _, u, _, v, slices = _pairs(rows, messages)
        total = 0.0
        for a, b, rating in slices:
            delta = np.einsum("ij,ij->i", u[a], v[b]) - rating
            total += float(delta @ delta)
        return pa.table({"e": [total]})

    table = x.select("side", "id", F.col("features").alias("v"))
    errors = blocks.meet(blocks.both, blocks.messages(blocks.both, table, k), sums, "e double")
    norms = x.selectExpr(f"{number(lam)} * {dot_sql('features', 'features', k)} e")
    return errors.unionByName(norms).agg(F.expr(f"0.5D * coalesce(sum(e), 0.0D) / {number(normalizer)}").alias("loss"))


def gradient_state(blocks: RatingBlocks, point: DataFrame, k: int, lam: float, normalizer: float) -> DataFrame:
    """A5 and A6 in one job: ``point(side, id, x, …)`` with its gradient ``g`` added, and a row of side -1 whose ``g`` holds
    the loss alone.  Further columns of ``point`` stay."""
    names = [f"g{j}" for j in range(k)]

    def sums(rows: pa.Table, messages: pa.Table) -> pa.Table:
        uid, u, iid, v, slices = _pairs(rows, messages)
        out = np.zeros((len(u) + len(v) + 1, k))
        du, dv = out[:len(u)], out[len(u):-1]
        for a, b, rating in slices:
            ua, vb = u[a], v[b]
            delta = np.einsum("ij,ij->i", ua, vb) - rating
            for j in range(k):
                du[:, j] += np.bincount(a, weights=delta * vb[:, j], minlength=len(u))
                dv[:, j] += np.bincount(b, weights=delta * ua[:, j], minlength=len(v))
            out[-1, 0] += delta @ delta
        side = np.concatenate([np.zeros(len(uid)), np.ones(len(iid)), [LOSS]]).astype(np.int32)
        return pa.Table.from_arrays([pa.array(side), pa.array(np.concatenate([uid, iid, [0]]))] +
                                    [pa.array(np.ascontiguousarray(out[:, j])) for j in range(k)], names=["side", "id", *names])

    routed = ["blocks"] if "blocks" in point.columns else []
    messages = blocks.messages(blocks.both, point.select("side", "id", F.col("x").alias("v"), *routed), k)
    parts = blocks.meet(blocks.both, messages, sums, "side int, id long, " + ", ".join(f"{g} double" for g in names))
    # the squared norms of x join the loss row
    norms = point.selectExpr(f"{LOSS} side", "cast(0 as long) id", f"{number(lam)} * {dot_sql('x', 'x', k)} g0",
                             *[f"0.0D {g}" for g in names[1:]])
    summed = parts.unionByName(norms).groupBy("side", "id").agg(*[F.expr(f"sum({g}) {g}") for g in names])
    n = number(normalizer)
    g = point.withColumn("id", F.col("id").cast("long")).join(summed, ["side", "id"], "full")
    comps = ", ".join(f"if(side = {LOSS}, 0.5D * g{j}, coalesce(g{j}, 0.0D) + {number(lam)} * x[{j}]) / {n}" for j in range(k))
    return g.selectExpr(*point.columns, f"array({comps}) g")


def gradient_pass(blocks: RatingBlocks, x: DataFrame, k: int, lam: float, normalizer: float) -> DataFrame:
    """``gradient_state`` of ``x(side, id, features)`` as ``side, id, features``: the gradient, and the loss at side -1."""
    state = gradient_state(blocks, x.select("side", "id", F.col("features").alias("x")), k, lam, normalizer)
    return state.select("side", "id", F.col("g").alias("features"))


def poly_pass(blocks: RatingBlocks, both: DataFrame, k: int, lam: float, normalizer: float) -> DataFrame:
    """A11 in one job over a table ``side, id, x, d``: one row ``c0 .. c4`` with loss(x - a d) = sum c_j a^j."""
    names = ["ee", "ep", "pp2eq", "pq", "qq"]

    def sums(rows: pa.Table, messages: pa.Table) -> pa.Table:
        _, u, _, v, slices = _pairs(rows, messages)
        total = np.zeros(5)
        dot = lambda p, q: np.einsum("ij,ij->i", p, q)
        for a, b, rating in slices:
            xu, du, xv, dv = u[a, :k], u[a, k:], v[b, :k], v[b, k:]
            e, p, q = dot(xu, xv) - rating, -(dot(xu, dv) + dot(du, xv)), dot(du, dv)
            total += [e @ e, e @ p, p @ p + 2 * (e @ q), p @ q, q @ q]
        return pa.table({c: [float(t)] for c, t in zip(names, total)})

    routed = ["blocks"] if "blocks" in both.columns else []
    messages = blocks.messages(blocks.both, both.select("side", "id", F.concat("x", "d").alias("v"), *routed), 2 * k)
    rows = blocks.meet(blocks.both, messages, sums, ", ".join(f"{c} double" for c in names))
    norms = both.selectExpr(*[f"{dot_sql(p, q, k)} {p}{q}" for p, q in ("xx", "xd", "dd")])
    s = rows.unionByName(norms, allowMissingColumns=True).agg(*[F.expr(f"coalesce(sum({c}), 0.0D) {c}") for c in (*names, "xx", "xd", "dd")])
    lam_, inv = number(lam), number(1.0 / float(normalizer))
    return s.selectExpr(f"0.5D * (ee + {lam_} * xx) * {inv} c0", f"(ep - {lam_} * xd) * {inv} c1",
                        f"0.5D * (pp2eq + {lam_} * dd) * {inv} c2", f"pq * {inv} c3", f"0.5D * qq * {inv} c4")
