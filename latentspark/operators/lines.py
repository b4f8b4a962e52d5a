"""A line through a point of the factorisation problem, in one job: the loss along it (A11) and the gradient along it.

Along ``x + a s`` a prediction is a square in a, so the loss is a quartic and the gradient a cubic with vector coefficients:
``g(a) = g0 + a g1 + a² g2 + a³ g3``.  One pass over the ratings sums both, at whatever step the driver then takes:
loss, gradient and inner products at the new point are known without reading a rating again, and the point after it
is an expression over the written table.  ``g0`` and the loss at the point itself are summed anew by every pass.

Ratings are held as packed slices (distinct ids of both sides, a rating's two places among them, its value), made once from
a layout ``grid`` of ``RatingBlocks``; the points as packed parts (ids, where they are needed, matrices of values by ids).  A pass
sends each part's vectors once to each block that needs them, and each block's sums back to the parts; a task works
on whole slices and parts, and Spark moves bytes, not numbers.

Vectors of a side that lack an id are treated like an inner join, null ids meet nothing, as in ``blocks``.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import cut, drop_cut
from .blocks import RatingBlocks, _rows_at, _starts

#: Ratings of a packed slice, and vectors that the blocks send back to a part.
PACK, PART = 1 << 13, 200_000
PACKED = "block int, own binary, own_at binary, other binary, other_at binary, rating binary"
STATE = "part int, side int, known boolean, whole boolean, ids binary, at binary, dest binary, x binary, s binary"
MESSAGE = "to int, part int, side int, ids binary, v binary"
SUMS = "part int, side int, ids binary, g binary"
ERRORS = ["ee", "ep", "pp2eq", "pq", "qq"]
NORMS = ["xx", "xs", "ss"]
#: Products of the line's direction (0) and the gradient's coefficients (1 to 4).
GRAM = [(i, j) for i in range(5) for j in range(i, 5)]
STATS = [*ERRORS, *NORMS, *[f"r{i}{j}" for i, j in GRAM]]
LINE = f"{STATE}, g binary, " + ", ".join(f"{c} double" for c in STATS)
TOTAL = -1


def _arrow(types: str) -> pa.Schema:
    known = {"int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary(), "double": pa.float64()}
    return pa.schema([(name, known[kind]) for name, kind in (c.split() for c in types.split(", "))])


def _table(rows: list[tuple], types: str) -> pa.Table:
    schema = _arrow(types)
    columns = zip(*rows) if rows else [[]] * len(schema)
    return pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def _numbers(value: pa.Scalar, dtype=np.float64) -> np.ndarray:
    """A packed array; no copy."""
    return np.frombuffer(value.as_buffer(), dtype=dtype) if value.is_valid else np.zeros(0, dtype)


def _matrix(value: pa.Scalar, n: int) -> np.ndarray:
    return _numbers(value).reshape(-1, n)


def _records(rows: pa.Table | pa.RecordBatch):
    return zip(*rows.columns)


# ------------------------------------------------------------------ ratings
def _pack(batches):
    """Slices of about ``PACK`` ratings of one block (they run in the order of ``own``)."""
    def packed(block, held):
        own, other, rating = (np.concatenate(c) for c in zip(*held))
        row = [block]
        for ids in (own, other):
            distinct, at = np.unique(ids, return_inverse=True)
            row += [distinct.tobytes(), at.astype(np.int32).tobytes()]
        return _table([(*row, rating.tobytes())], PACKED).to_batches()[0]

    block, held, size = None, [], 0
    for batch in batches:
        number = batch.column("block").to_numpy()
        starts = _starts(number).tolist() if len(number) else []
        for lo, hi in zip(starts, [*starts[1:], len(number)]):
            if held and (number[lo] != block or size >= PACK):
                yield packed(block, held)
                held, size = [], 0
            block = int(number[lo])
            part = batch.slice(lo, hi - lo)
            part = part.filter(pa.compute.and_(part.column("own").is_valid(), part.column("other").is_valid()))
            if part.num_rows:
                held.append([part.column(c).to_numpy(zero_copy_only=False) for c in ("own", "other", "rating")])
                size += part.num_rows
    if held:
        yield packed(block, held)


def packed_ratings(blocks: RatingBlocks) -> DataFrame:
    """The ratings of the layout ``grid`` as packed slices, block b in partition b; held until the layout is released."""
    if "packed" not in blocks.rows:
        slices = blocks.rows["grid"].select("block", "own", "other", "rating").mapInArrow(_pack, PACKED)
        rows = slices.repartitionById(blocks.n_blocks, "block").sortWithinPartitions("block").persist()
        rows.count()
        blocks.rows["packed"] = rows
        blocks.held.append(rows)
    return blocks.rows["packed"]


def _line_of_block(k: int, parts: int):
    """Sums over the ratings of a block: the gradient's four coefficients by id, and the errors' products."""

    def side_of(messages, side):
        mine = [(part, _numbers(ids, np.int64), _numbers(v).reshape(2 * k, -1))
                for _, part, s, ids, v in messages if s == side]
        if not mine:
            return mine, np.zeros(0, np.int64), np.zeros((2 * k, 0)), np.zeros(0, np.int64)
        ids = np.concatenate([m[1] for m in mine])
        order = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), dtype=np.int64)
        place[order] = np.arange(len(ids))
        return mine, ids[order], np.concatenate([m[2] for m in mine], axis=1)[:, order], place

    def coefficients(e, p, q, x, s, out):
        # g0 = Σ e x, g1 = Σ p x + e s, g2 = Σ q x + p s, g3 = Σ q s
        np.multiply(e, x, out=out[0])
        np.multiply(p, x, out=out[1])
        out[1] += e * s
        np.multiply(q, x, out=out[2])
        out[2] += p * s
        np.multiply(q, s, out=out[3])

    def run(rows: pa.Table, messages: pa.Table) -> pa.Table:
        block = (rows if rows.num_rows else messages).column(0)[0].as_py()
        found = [(None, part.as_py(), side.as_py(), ids, v) for _, part, side, ids, v in _records(messages)]
        users, uid, u, user_place = side_of(found, 0)
        items, iid, v, item_place = side_of(found, 1)
        du, dv = np.zeros((4 * k, len(uid))), np.zeros((4 * k, len(iid)))
        total = np.zeros(5)
        for _, own, own_at, other, other_at, rating in _records(rows):
            pu, ku = _rows_at(uid, _numbers(own, np.int64))
            pv, kv = _rows_at(iid, _numbers(other, np.int64))
            a, b, y = _numbers(own_at, np.int32), _numbers(other_at, np.int32), _numbers(rating)
            if not (ku.all() and kv.all()):
                known = ku[a] & kv[b]
                a, b, y = a[known], b[known], y[known]
            if not len(a):
                continue
            ua, vb = u[:, pu].take(a, axis=1), v[:, pv].take(b, axis=1)
            xu, su, xv, sv = ua[:k], ua[k:], vb[:k], vb[k:]
            e, p, q = np.zeros((3, len(y)))
            for j in range(k):
                e += xu[j] * xv[j]
                p += xu[j] * sv[j]
                p += su[j] * xv[j]
                q += su[j] * sv[j]
            e -= y  # after the whole product, so that ratings that are its predictions leave no error at all
            total += [e @ e, e @ p, p @ p + 2 * (e @ q), p @ q, q @ q]
            starts = _starts(a)
            at = pu[a[starts]]
            out = np.empty((4, len(y)))
            for j in range(k):
                coefficients(e, p, q, xv[j], sv[j], out)
                du[j::k, at] += np.add.reduceat(out, starts, axis=1)
                coefficients(e, p, q, xu[j], su[j], out)
                dv[j::k, pv] += [np.bincount(b, weights=w, minlength=len(pv)) for w in out]
        sent = [(block % parts, TOTAL, b"", total.tobytes())]
        for side, mine, place, sums in ((0, users, user_place, du), (1, items, item_place, dv)):
            lo = 0
            for part, ids, _ in mine:
                sent.append((part, side, ids.tobytes(), sums[:, place[lo:lo + len(ids)]].tobytes()))
                lo += len(ids)
        return _table(sent, SUMS)
    return run


# ------------------------------------------------------------------ points
def _pack_state(k: int):
    """One part of ``part, side, id, blocks, x`` as a row per side; ids that are null have a row of their own (not ``known``), and
    so have vectors that lack a number (not ``whole``): those count in no sum over vectors, like a null in SQL."""
    def vectors(lists: pa.ListArray) -> np.ndarray:
        if not lists.null_count and pa.compute.all(pa.compute.equal(pa.compute.list_value_length(lists), k)).as_py():
            return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), k)
        return np.array([[np.nan if v is None else v for v in ((x or []) + [None] * k)[:k]] for x in lists.to_pylist()])

    def complete(lists: pa.ListArray) -> np.ndarray:
        if not lists.null_count and not lists.flatten().null_count:
            return np.ones(len(lists), dtype=bool)
        return np.array([x is not None and None not in x for x in lists.to_pylist()])

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        side, known = rows.column("side").to_numpy(), rows.column("id").is_valid().to_numpy()
        whole = complete(pa.concat_arrays(rows.column("x").chunks))
        packed = []
        for s, valid, full in product((0, 1), (True, False), (True, False)):
            mine = rows.take(pa.array(np.flatnonzero((side == s) & (known == valid) & (whole == full)))).sort_by("id").combine_chunks()
            n = mine.num_rows
            if not n:
                continue
            x = vectors(pa.concat_arrays(mine.column("x").chunks))
            counts = pa.compute.fill_null(pa.compute.list_value_length(mine.column("blocks")), 0).to_numpy()
            dest = pa.compute.list_flatten(mine.column("blocks")).to_numpy().astype(np.int32)
            order = np.argsort(dest, kind="stable")
            packed.append((rows.column("part")[0].as_py(), s, valid, full,
                           pa.compute.fill_null(mine.column("id"), 0).to_numpy().astype(np.int64).tobytes(),
                           np.repeat(np.arange(n, dtype=np.int32), counts)[order].tobytes(), dest[order].tobytes(),
                           np.ascontiguousarray(x.T, dtype=np.float64).tobytes(), np.zeros(x.shape).tobytes()))
        return _table(packed, STATE)
    return run


def _moved(x: np.ndarray, s: np.ndarray, g: np.ndarray | None, z: float, beta: float) -> tuple[np.ndarray, np.ndarray]:
    """Vectors after the step ``z`` along ``s``, and the next direction ``beta s - g`` there."""
    if g is None:
        return x, s
    g0, g1, g2, g3 = np.split(g, 4)
    if z:
        x, g0 = x + z * s, g0 + z * (g1 + z * (g2 + z * g3))
    return x, beta * s - g0 if beta else -g0


def _move(z: float, beta: float):
    """Rows of a written line to those of the state ``STATE`` after its step."""
    def run(batches):
        for batch in batches:
            for part, side, known, whole, ids, at, dest, x, s, *g in _records(batch):
                if side.as_py() == TOTAL:
                    continue
                n = len(_numbers(ids, np.int64))
                new = _moved(_matrix(x, n), _matrix(s, n), _matrix(g[0], n) if g else None, z, beta)
                yield _table([(part.as_py(), side.as_py(), known.as_py(), whole.as_py(), ids.as_py(), at.as_py(), dest.as_py(),
                               *[m.tobytes() for m in new])], STATE).to_batches()[0]
    return run


def _send(z: float, beta: float):
    """Messages of the state after the step: vectors and directions once to each block that needs them."""
    def run(batches):
        for batch in batches:
            for part, side, _, _, ids, at, dest, x, s, *g in _records(batch):
                if side.as_py() == TOTAL:
                    continue
                ids, at, dest = _numbers(ids, np.int64), _numbers(at, np.int32), _numbers(dest, np.int32)
                if not len(dest):
                    continue
                both = np.concatenate(_moved(_matrix(x, len(ids)), _matrix(s, len(ids)), _matrix(g[0], len(ids)) if g else None, z, beta))
                starts = _starts(dest).tolist()
                for lo, hi in zip(starts, [*starts[1:], len(dest)]):
                    i = at[lo:hi]
                    yield _table([(int(dest[lo]), part.as_py(), side.as_py(), ids[i].tobytes(), both[:, i].tobytes())], MESSAGE).to_batches()[0]
    return run


def _line_of_part(k: int, lam: float, normalizer: float):
    """The state of a part with the blocks' sums for it: its line."""
    def run(state: pa.Table, sums: pa.Table) -> pa.Table:
        errors, found = np.zeros(5), {0: [], 1: []}
        for _, side, ids, g in _records(sums):
            if side.as_py() == TOTAL:
                errors += _numbers(g)
            else:
                ids = _numbers(ids, np.int64)
                found[side.as_py()].append((ids, _matrix(g, len(ids))))
        part = (state if state.num_rows else sums).column("part")[0].as_py()
        nothing = [0.0] * (len(NORMS) + len(GRAM))
        lines = [(part, TOTAL, True, True, *[b""] * 6, *(errors / normalizer).tolist(), *nothing)]
        for _, side, known, whole, ids, at, dest, x, s in _records(state):
            numbers = _numbers(ids, np.int64)
            x, s = _matrix(x, len(numbers)), _matrix(s, len(numbers))
            g = np.zeros((4 * k, len(numbers)))
            for mine, more in found[side.as_py()] if known.as_py() else ():
                here, there = _rows_at(numbers, mine)
                g[:, here[there]] += more[:, there]
            g[:k] += lam * x
            g[k:2 * k] += lam * s
            g /= normalizer
            of = np.concatenate([s.reshape(1, -1), g.reshape(4, -1)])
            gram = of @ of.T
            norms = [float((p * q).sum()) * lam / normalizer for p, q in ((x, x), (x, s), (s, s))]
            products = [*norms, *[float(gram[i, j]) for i, j in GRAM]] if whole.as_py() else nothing
            lines.append((part, side.as_py(), known.as_py(), whole.as_py(), ids.as_py(), at.as_py(), dest.as_py(), x.tobytes(), s.tobytes(),
                          g.tobytes(), *[0.0] * len(ERRORS), *products))
        return _table(lines, LINE)
    return run


def _unpack(z: float):
    """``side, id, features`` of the state after the step."""
    schema = pa.schema([("side", pa.int32()), ("id", pa.int64()), ("features", pa.list_(pa.float64()))])

    def run(batches):
        for batch in batches:
            for _, side, known, whole, ids, _, _, x, s, *_ in _records(batch):
                if side.as_py() == TOTAL:
                    continue
                ids = _numbers(ids, np.int64)
                x = _matrix(x, len(ids))
                x = np.ascontiguousarray((x + z * _matrix(s, len(ids)) if z else x).T)
                for lo in range(0, len(ids), 16384):
                    part = ids[lo:lo + 16384]
                    offsets = pa.array((np.arange(len(part) + 1) * x.shape[1]).astype(np.int32))
                    numbers = x[lo:lo + 16384].ravel()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(part), side.as_py(), dtype=np.int32)), pa.array(part, mask=np.full(len(part), not known.as_py())),
                         pa.ListArray.from_arrays(offsets, pa.array(numbers, mask=None if whole.as_py() else np.isnan(numbers)))], schema=schema)
    return run


@dataclass
class Line:
    """A written line: point, direction and the gradient's coefficients by id, and what was observed while it was written."""
    table: DataFrame
    parts: int
    c: tuple[float, ...]      # loss(x + a s) = Σ cⱼ aʲ
    gram: np.ndarray          # inner products of s, g0, g1, g2, g3

    @property
    def loss(self) -> float:
        return self.c[0]

    @property
    def gg(self) -> float:
        """Squared norm of the gradient at the point."""
        return float(self.gram[1, 1])

    def change(self, z: float) -> float:
        """(gradient after the step ``z``) · (its change from the point's)."""
        w = np.array([1.0, z, z * z, z ** 3])
        return float(w[1:] @ self.gram[2:, 1:] @ w)

    def params(self, z: float) -> DataFrame:
        """``side, id, features`` after the step ``z``, as a written table."""
        return cut(self.table.mapInArrow(_unpack(z), "side int, id long, features array<double>"))

    def drop(self) -> None:
        drop_cut(self.table)


def packed_state(blocks: RatingBlocks, x: DataFrame, k: int) -> tuple[DataFrame, int]:
    """``x(side, id, features)`` as a written table of packed parts (``STATE``), and their number."""
    spark = x.sparkSession
    routed = blocks.routed("grid", x.selectExpr("cast(side as int) side", "id", "features x"))
    n, entries = routed.agg(F.count(F.lit(1)), F.sum(F.greatest(F.size("blocks"), F.lit(0)))).first()
    parts = max(1, min(spark.sparkContext.defaultParallelism, ceil(n / 2_000)), ceil((entries or 0) / PART), ceil(n / PART))
    part = F.pmod(F.xxhash64("id", "side"), F.lit(parts)).cast("int")
    state = routed.select(part.alias("part"), "side", "id", "blocks", F.col("x").cast("array<double>").alias("x")).groupBy("part").applyInArrow(
        _pack_state(k), STATE)
    return cut(state), parts


def start(blocks: RatingBlocks, x: DataFrame, k: int, lam: float, normalizer: float) -> Line:
    """The line of no direction at ``x(side, id, features)``: loss and gradient there."""
    packed, parts = packed_state(blocks, x, k)
    line = _line(blocks, packed, parts, 0.0, 0.0, k, lam, normalizer)
    drop_cut(packed)
    return line


def along(blocks: RatingBlocks, line: Line, z: float, beta: float, k: int, lam: float, normalizer: float) -> Line:
    """The line at the point after the step ``z`` along ``line``, in the direction ``beta s - g``; ``line`` stays."""
    return _line(blocks, line.table.select("part", "side", "known", "whole", "ids", "at", "dest", "x", "s", "g"), line.parts, z, beta, k, lam, normalizer)


def _line(blocks: RatingBlocks, at: DataFrame, parts: int, z: float, beta: float, k: int, lam: float, normalizer: float) -> Line:
    sent = at.mapInArrow(_send(z, beta), MESSAGE).repartitionById(blocks.n_blocks, "to")
    sums = packed_ratings(blocks).groupBy("block").cogroup(sent.groupBy("to")).applyInArrow(_line_of_block(k, parts), SUMS)
    state = at.mapInArrow(_move(z, beta), STATE).repartitionById(parts, "part")
    line = state.groupBy("part").cogroup(sums.repartitionById(parts, "part").groupBy("part")).applyInArrow(_line_of_part(k, lam, normalizer), LINE)
    seen = Observation()
    table = cut(line.observe(seen, *[F.sum(c).alias(c) for c in STATS]))
    got = {c: float("nan") if v is None else float(v) for c, v in seen.get.items()}
    gram = np.empty((5, 5))
    for i, j in GRAM:
        gram[i, j] = gram[j, i] = got[f"r{i}{j}"]
    c = (0.5 * (got["ee"] + got["xx"]), got["ep"] + got["xs"], 0.5 * (got["pp2eq"] + got["ss"]), got["pq"], 0.5 * got["qq"])
    return Line(table, parts, c, gram)
