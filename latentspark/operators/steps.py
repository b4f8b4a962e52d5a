"""Descent by fixed steps, many of them to a job: a point needs nothing of the driver but the one before it.

The next point is ``x - a g(x)`` whatever the loss is, so the driver asks for some passes at once, gets the loss at every point
of them, and picks the point at which its stop test is met; those after it are thrown away.  A pass has two stages: the parts
of the point send each block the vectors it needs, and the blocks send their gradient sums back.  Ratings are the packed
slices of ``operators.lines``, here with the places of their ids among the vectors that their block is sent.  Those places never
change, so vectors and sums travel as bare numbers, without ids.

Spark's RDDs carry the records: block b and part p are partition b and p throughout, so that slices and ids are read where they
lie.  The points themselves go with the messages, by way of one block a part: a stage is one pass of records through Python.
After each job its last messages are a reliable checkpoint in the checkpoint folder, where lineage starts again.

Null ids meet nothing; vectors of a side that lack an id are treated like an inner join, as in ``blocks``.
"""

from __future__ import annotations

import gc
from collections import defaultdict

import numpy as np
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame

from ..session import cut, drop_cut, ensure_checkpoint_dir
from .blocks import RatingBlocks, _rows_at, _starts
from .lines import PACKED, STATE, _pack, _unpack, packed_state

#: Passes of the first job and of later ones at most, and passes after which the driver has old shuffles deleted.
FIRST, MOST, CLEAN = 4, 16, 16


def _place(key: int) -> int:
    return key


def _beside(left: RDD, right: RDD) -> RDD:
    """Partitions of both, one after the other in one task; both are dealt by ``_place`` and pickled in batches."""
    return RDD(left._jrdd.union(right._jrdd), left.ctx, right._jrdd_deserializer)


def _places(records):
    """Slices whose ids are places among the ids sent to their block, and per part and side the places of what it sends."""
    slices, sent = defaultdict(list), defaultdict(list)
    for block, (kind, *record) in records:
        (slices if kind == "ratings" else sent)[block].append(record)
    for block in sorted(slices.keys() | sent.keys()):
        ids, size = {}, [0, 0]
        for side in (0, 1):
            mine = [(part, name, np.frombuffer(numbers, np.int64)) for part, name, numbers in sent[block] if name[0] == side]
            every = np.concatenate([m[2] for m in mine]) if mine else np.zeros(0, np.int64)
            order = np.argsort(every, kind="stable")
            place = np.empty(len(every), np.int32)
            place[order] = np.arange(len(every))
            ids[side], size[side], lo = every[order], len(every), 0
            for part, name, numbers in mine:
                yield block, ("places", part, name, place[lo:lo + len(numbers)].tobytes())
                lo += len(numbers)
        yield block, ("sizes", *size)
        for own, own_at, other, other_at, rating in slices[block]:
            pu, ku = _rows_at(ids[0], np.frombuffer(own, np.int64))
            pv, kv = _rows_at(ids[1], np.frombuffer(other, np.int64))
            a, b, y = (np.frombuffer(x, t) for x, t in ((own_at, np.int32), (other_at, np.int32), (rating, np.float64)))
            known = ku[a] & kv[b]
            if known.any():
                yield block, ("slice", pu.astype(np.int32).tobytes(), a[known].tobytes(), pv.astype(np.int32).tobytes(),
                              b[known].tobytes(), y[known].tobytes())


def _of_block(k: int, parts: int):
    """A pass over a block: its squared errors, and the gradient's sums for each part and side in the order they were sent."""
    def run(records):
        places, sizes, slices, sent = defaultdict(list), {}, defaultdict(list), defaultdict(dict)
        for block, (kind, *record) in records:
            if kind == "x":
                sent[block][tuple(record[:2])] = record[2]
            elif kind in ("point", "loss"):  # on its way to its part
                yield record[0], (kind, *record[1:])
            elif kind == "places":
                places[block].append(record)
            elif kind == "sizes":
                sizes[block] = record
            else:
                slices[block].append(record)
        for block, size in sizes.items():
            x = [np.empty((k, n)) for n in size]
            where = [(part, name, np.frombuffer(at, np.int32)) for part, name, at in places[block]]
            for part, name, at in where:
                x[name[0]][:, at] = np.frombuffer(sent[block][part, name], np.float64).reshape(k, -1)
            g, total = [np.zeros(v.shape) for v in x], 0.0
            with np.errstate(all="ignore"):
                for pu, a, pv, b, y in slices[block]:
                    pu, a, pv, b = (np.frombuffer(p, np.int32) for p in (pu, a, pv, b))
                    u, v = x[0][:, pu].take(a, axis=1), x[1][:, pv].take(b, axis=1)
                    e = np.zeros(len(a))
                    for j in range(k):
                        e += u[j] * v[j]
                    e -= np.frombuffer(y, np.float64)  # after the whole product, as in ``lines``
                    total += float(e @ e)
                    starts = _starts(a)
                    g[0][:, pu[a[starts]]] += np.add.reduceat(e * v, starts, axis=1)
                    for j in range(k):
                        g[1][j, pv] += np.bincount(b, weights=e * u[j], minlength=len(pv))
            yield block % parts, ("e", total)
            for part, name, at in where:
                yield part, ("g", name, block, g[name[0]][:, at].tobytes())
    return run


def _ids_sent(records):
    """The ids of the vectors that each block will be sent, in the order of the vectors."""
    for part, (name, ids, at, dest) in records:
        ids, at, dest = (np.frombuffer(b, t) for b, t in ((ids, np.int64), (at, np.int32), (dest, np.int32)))
        for block, here in _runs(at, dest):
            yield block, ("ids", part, name, ids[here].tobytes())


def _sent(n_blocks: int, part: int, name: tuple, at: np.ndarray, dest: np.ndarray, x: np.ndarray):
    """Messages of some vectors of a part: to each block those that it needs, and all of them to the block they are back from."""
    yield part % n_blocks, ("point", part, name, x.tobytes())
    for block, here in _runs(at, dest):
        yield block, ("x", part, name, x[:, here].tobytes())


def _first(k: int, n_blocks: int):
    def run(records):
        for part, (name, at, dest, x) in records:
            at, dest = (np.frombuffer(b, np.int32) for b in (at, dest))
            yield from _sent(n_blocks, part, name, at, dest, np.frombuffer(x, np.float64).reshape(k, -1))
    return run


def _runs(at: np.ndarray, dest: np.ndarray):
    """The rows sent to each block."""
    starts = _starts(dest).tolist() if len(dest) else []
    for lo, hi in zip(starts, [*starts[1:], len(dest)]):
        yield int(dest[lo]), at[lo:hi]


def _of_part(k: int, n_blocks: int, lam: float, normalizer: float, a: float, step: int):
    """The messages of a part's next point, from the point before and the blocks' sums; the losses so far go with them."""
    def run(records):
        held, points, sums, errors, losses = {}, {}, defaultdict(dict), defaultdict(float), defaultdict(dict)
        for part, record in records:
            if isinstance(record[0], tuple):
                held[part, record[0]] = record[1:]
                continue
            kind, *record = record
            if kind == "point":
                points[part, record[0]] = record[1]
            elif kind == "g":
                sums[part, record[0]][record[1]] = record[2]
            elif kind == "e":
                errors[part] += record[0]
            else:
                losses[part] |= record[0]
        with np.errstate(all="ignore"):
            for (part, name), (ids, at, dest) in held.items():
                ids, at, dest = (np.frombuffer(b, t) for b, t in ((ids, np.int64), (at, np.int32), (dest, np.int32)))
                x = np.frombuffer(points[part, name], np.float64).reshape(k, -1)
                g = np.zeros(x.shape)
                for block, here in _runs(at, dest):
                    if block in sums[part, name]:
                        g[:, here] += np.frombuffer(sums[part, name][block], np.float64).reshape(k, -1)
                first = _starts(ids)
                if name[1] and len(first) < len(ids):  # every vector of an id has the id's gradient
                    g = np.repeat(np.add.reduceat(g, first, axis=1), np.diff(np.append(first, len(ids))), axis=1)
                if name[2]:
                    errors[part] += lam * float((x * x).sum())
                yield from _sent(n_blocks, part, name, at, dest, x - a * ((g + lam * x) / normalizer))
        for part in errors.keys() | losses.keys():
            yield part % n_blocks, ("loss", part, losses[part] | {step: 0.5 * errors[part] / normalizer})
    return run


def _whole(records):
    """Packed rows of a point, from the ids of its parts and the vectors."""
    held = {}
    for part, record in records:
        if isinstance(record[0], tuple):
            held[part, record[0]] = record[1]
        else:
            _, name, x = record
            yield (part, *name, bytearray(held[part, name]), bytearray(), bytearray(), bytearray(x), bytearray())


class Walk:
    """Points ``x_0, x_1, …`` of the descent by steps ``a`` from ``x(side, id, features)``; a layout ``grid`` holds the ratings."""

    def __init__(self, blocks: RatingBlocks, x: DataFrame, k: int, lam: float, normalizer: float, a: float):
        self.spark, self.k, self.lam, self.normalizer, self.a = x.sparkSession, k, float(lam), float(normalizer), float(a)
        ensure_checkpoint_dir(self.spark)
        table, self.parts = packed_state(blocks, x, k)
        self.n_blocks, self.cleaned = blocks.n_blocks, 0
        rows = table.select("part", "side", "known", "whole", "ids", "at", "dest", "x").rdd.map(
            lambda r: (r.part, ((r.side, r.known, r.whole), *[bytes(b) for b in r[4:]])))
        hold = StorageLevel.MEMORY_AND_DISK
        self.held = rows.map(lambda r: (r[0], r[1][:4])).partitionBy(self.parts, _place).persist(hold)
        ratings = blocks.rows["packed"] if "packed" in blocks.rows else blocks.rows["grid"].select(
            "block", "own", "other", "rating").mapInArrow(_pack, PACKED)
        slices = ratings.rdd.map(lambda r: (r.block, ("ratings", *[bytes(b) for b in r[1:]]))).partitionBy(self.n_blocks, _place)
        ids = self.held.mapPartitions(_ids_sent).partitionBy(self.n_blocks, _place)
        self.slices = _beside(slices, ids).mapPartitions(_places, preservesPartitioning=True).persist(hold)
        self.slices.count()
        first = rows.map(lambda r: (r[0], (r[1][0], *r[1][2:]))).mapPartitions(_first(k, self.n_blocks)).partitionBy(self.n_blocks, _place)
        #: messages of the first point of the last job, and of the point after its last
        self.ends = {0: first.persist(hold)}
        first.count()
        drop_cut(table)

    @property
    def done(self) -> int:
        return max(self.ends)

    def _after(self, t: int, n: int) -> RDD:
        """Messages of the point ``n`` steps after ``x_t``."""
        sent = self.ends[t]
        for step in range(t, t + n):
            sums = _beside(self.slices, sent).mapPartitions(_of_block(self.k, self.parts)).partitionBy(self.parts, _place)
            part = _of_part(self.k, self.n_blocks, self.lam, self.normalizer, self.a, step)
            sent = _beside(self.held, sums).mapPartitions(part).partitionBy(self.n_blocks, _place)
        return sent

    def go(self, n: int) -> list[float]:
        """``n`` steps more in one job: the losses at the latest point and at those after it but the last."""
        base = self.done
        self.forget([t for t in self.ends if t < base])
        last = self._after(base, n).persist(StorageLevel.MEMORY_AND_DISK)
        self.ends[base + n] = last
        last.checkpoint()
        found = last.flatMap(lambda r: [r[1][2]] if r[1][0] == "loss" else []).collect()
        return [float(sum(part.get(t, 0.0) for part in found)) for t in range(base, base + n)]

    def point(self, t: int) -> DataFrame:
        """``side, id, features`` of the point ``x_t``, one of the last job's, as a written table."""
        base = max(b for b in self.ends if b <= t)
        points = self._after(base, t - base).filter(lambda r: r[1][0] == "point").map(lambda r: (r[1][1], ("point", *r[1][2:])))
        rows = _beside(self.held, points.partitionBy(self.parts, _place)).mapPartitions(_whole)
        return cut(self.spark.createDataFrame(rows, STATE, verifySchema=False).mapInArrow(_unpack(0.0), "side int, id long, features array<double>"))

    def forget(self, points) -> None:
        """Frees messages: their memory, their checkpoint and, from time to time, the shuffles that led to them."""
        for t in points:
            gone = self.ends.pop(t)
            gone.unpersist()
            path = gone.getCheckpointFile()
            if path:
                hpath = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
                hpath.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)
        if self.ends and self.done - self.cleaned >= CLEAN:
            self.cleaned = self.done
            gc.collect()
            self.spark.sparkContext._jvm.System.gc()  # Spark deletes a shuffle's files when the driver's memory lets go of it

    def release(self) -> None:
        self.forget(list(self.ends))
        self.slices.unpersist()
        self.held.unpersist()
