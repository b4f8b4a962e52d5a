"""Hard negatives by a multiway hyperplane tree with distance ranges (after GNAT).

Whole-number vectors are searched for a window of inner products.  With R the
largest length of a row, a row x gets one more coordinate sqrt(R^2 - |x|^2) and
an anchor q gets 0; then |q - x|^2 = |q|^2 + R^2 - 2 q.x, so a window of inner
products is a ring around the anchor, and the triangle inequality holds.

1. ``fit_tree``: split points are drawn far from each other from a bounded sample
   of rows (``sample_rows``, by hash of the id); every row belongs to its
   nearest split point (cells are bounded by hyperplanes), level by level.
2. Every row is filed under its leaf, and for every split point i and sibling
   subtree j the least and largest distance of i to the rows of j is taken,
   over all rows: one aggregate of bounded size.
3. An anchor walks the tree: a subtree goes when, for some split point, its
   range and the anchor's ring cannot meet.  Anchors travel in blocks; what
   is left is compared exactly in the leaves, a matrix product per block.

Two searches run over the index: the nearest rows of the anchor's label, then
for every positive the nearest rows of other labels in its window.  Rings
start narrow: the sample's own rows bound the k-th score from below.  Results
are exact whatever the tree is.

Leaves with more than ``leaf_rows`` rows are dealt in parts by hash of the id,
so one vector or cell may hold any share of the rows.

Edge cases: rows with a null id, a null label, a null or empty vector, or any
null or non-finite component take no part, nor do those whose length differs from the most
frequent one (ties: the shorter); of rows repeating a vec_id that with the
smallest (label, vector) counts; ties go to the smaller vec_id; an anchor
without positives, or a positive without negatives, gives no rows; an empty
table gives none; further columns are ignored.  Inner products must stay below
2^47 (a ValueError names the table's bound otherwise).
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from latentspark.llm.common import hash_sample
from latentspark.session import cut, drop_cut

#: Inner products below this bound leave room for a row's place beside them in a 64-bit key.
LARGEST = 1 << 47
NOTHING = np.iinfo(np.int64).min


# ---------------------------------------------------------------- tree

@dataclass
class Node:
    """Split points (whole-number rows and the added coordinate) and, per cell, a node number or -1 - leaf."""
    points: np.ndarray
    extra: np.ndarray
    children: list[int]
    low: np.ndarray = field(default=None)   # low[i, j], high[i, j]: distances of point i to the rows of cell j
    high: np.ndarray = field(default=None)

    def distances(self, x: np.ndarray, extra: np.ndarray) -> np.ndarray:
        square = ((x * x).sum(axis=1) + extra ** 2)[:, None] + ((self.points ** 2).sum(axis=1) + self.extra ** 2)[None, :]
        return np.sqrt(np.maximum(square - 2 * (x @ self.points.T + extra[:, None] * self.extra[None, :]), 0.0))


def added(x: np.ndarray, radius2: float) -> np.ndarray:
    return np.sqrt(np.maximum(radius2 - (x * x).sum(axis=1), 0.0))


def fit_tree(sample: np.ndarray, radius2: float, branches: int, leaf_size: int) -> tuple[list[Node], int]:
    """Nodes (the first is the root, none if one leaf is enough) and the number of leaves."""
    nodes: list[Node] = []
    leaves = 0
    extra = added(sample, radius2)
    todo = [(np.arange(len(sample)), None)]
    while todo:
        rows, place = todo.pop(0)
        picked = []
        if len(rows) > leaf_size:
            # farthest-point choice: each split point is the row farthest from those before it; equal rows stop it
            near = np.full(len(rows), np.inf)
            at = 0
            while len(picked) < branches and (near[at] > 0 or not picked):
                picked.append(rows[at])
                one = Node(sample[rows[at]][None, :], extra[rows[at]][None], [])
                near = np.minimum(near, one.distances(sample[rows], extra[rows])[:, 0])
                near[near < 1e-6] = 0
                at = int(np.argmax(near))
        if len(picked) < 2:
            name = -1 - leaves
            leaves += 1
        else:
            name = len(nodes)
            node = Node(sample[picked], extra[picked], [0] * len(picked))
            nodes.append(node)
            cell = np.argmin(node.distances(sample[rows], extra[rows]), axis=1)
            todo += [(rows[cell == j], (name, j)) for j in range(len(picked))]
        if place is not None:
            nodes[place[0]].children[place[1]] = name
    return nodes, max(leaves, 1)


def file_rows(nodes: list[Node], x: np.ndarray, extra: np.ndarray, ranges: list | None = None) -> np.ndarray:
    """Leaf of each row; ``ranges``: per node (low, high), widened by what is filed."""
    leaf = np.zeros(len(x), dtype=np.int32)
    todo = [(0, np.arange(len(x)))] if nodes else []
    while todo:
        name, rows = todo.pop()
        d = nodes[name].distances(x[rows], extra[rows])
        cell = np.argmin(d, axis=1)
        for j, child in enumerate(nodes[name].children):
            own = np.flatnonzero(cell == j)
            if not len(own):
                continue
            if ranges is not None:
                ranges[name][0][:, j] = np.minimum(ranges[name][0][:, j], d[own].min(axis=0))
                ranges[name][1][:, j] = np.maximum(ranges[name][1][:, j], d[own].max(axis=0))
            if child < 0:
                leaf[rows[own]] = -1 - child
            else:
                todo.append((child, rows[own]))
    return leaf


def leaves_met(nodes: list[Node], n_leaves: int, x: np.ndarray, near: np.ndarray, far: np.ndarray) -> np.ndarray:
    """Flags (anchor, leaf): whether the leaf can hold rows at a distance in [near, far] of the anchor."""
    met = np.zeros((len(x), n_leaves), dtype=bool)
    slack = 1e-6 * (1 + far)
    near, far = near - slack, far + slack
    live = np.flatnonzero(near <= far)
    if not nodes:
        met[live, 0] = True
        return met
    todo = [(0, live)]
    while todo:
        name, rows = todo.pop()
        node = nodes[name]
        d = node.distances(x[rows], np.zeros(len(rows)))
        for j, child in enumerate(node.children):
            low, high = node.low[:, j], node.high[:, j]
            if not (low <= high).all():
                continue  # no row was filed here
            # distances of the anchor to rows of the cell lie in [least, most], by every split point
            least = np.maximum(d - high, low - d).max(axis=1)
            most = (d + high).min(axis=1)
            own = rows[(least <= far[rows]) & (most >= near[rows])]
            if len(own) and child < 0:
                met[own, -1 - child] = True
            elif len(own):
                todo.append((child, own))
    return met


# ---------------------------------------------------------------- exact choice

def first_of(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of the ``k`` largest allowed scores of every row; of equal ones the first columns."""
    n = scores.shape[1]
    keys = np.where(allowed, scores * n + (n - 1 - np.arange(n)), NOTHING)
    if n > k:
        columns = np.argpartition(keys, n - k, axis=1)[:, n - k:]
    else:
        columns = np.broadcast_to(np.arange(n), keys.shape)
    kept = np.take_along_axis(keys, columns, axis=1) != NOTHING
    r, c = np.nonzero(kept)
    return r, columns[r, c]


def whole(column: pa.Array) -> np.ndarray:
    """Lists of equal length as a matrix of doubles (all values are whole and small enough to be exact)."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


# ---------------------------------------------------------------- Spark

def whole_vectors(rows: DataFrame, label: Column, scale: int = 256) -> DataFrame:
    """``vec_id, label, v array<long>`` (floor of ``scale`` times each component) of the rows that take part, one per id."""
    e = F.col("e")
    good = rows.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"),
                       F.col("embedding").cast("array<double>").alias("e")).filter(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size(e) > 0)
        & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    top = good.groupBy(F.size(e).alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    v = F.transform(e, lambda x: F.floor(x * scale).cast("long"))
    one = good.filter(F.size(e) == (top["d"] if top else 0)).select("vec_id", F.struct("label", v.alias("v")).alias("row"))
    return one.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.label", "row.v")


class HyperplaneTree:
    """The index over ``rows`` (vec_id, label, v): rows filed by leaf in a written table, the tree with its ranges broadcast."""

    def __init__(self, rows: DataFrame, *, branches: int = 8, leaf_size: int = 64, sample_rows: int = 4096,
                 leaf_rows: int = 16384, seed: int = 19):
        self.spark, self.leaf_rows = rows.sparkSession, leaf_rows
        self.rows = cut(rows)
        length2 = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
        most = self.rows.agg(F.max(length2).alias("r")).first()["r"]
        if most is not None and most >= LARGEST:
            raise ValueError(f"inner products may reach {most:.3g}, more than {LARGEST}")
        self.radius2 = float(most or 0.0)
        picked = hash_sample(self.rows.select("vec_id"), "vec_id", sample_rows, seed)
        sample = (self.rows.join(F.broadcast(picked), "vec_id").orderBy("deal", "vec_id").limit(sample_rows).toPandas())
        x = np.stack(sample["v"].to_numpy()).astype(np.float64) if len(sample) else np.zeros((0, 1))
        nodes, self.n_leaves = fit_tree(x, self.radius2, branches, leaf_size)
        self.sample = (sample["vec_id"].to_numpy(dtype=np.int64), sample["label"].to_numpy(dtype=np.int64), x)
        shared, radius2 = self.spark.sparkContext.broadcast(nodes), self.radius2

        def file(batches):
            for b in batches:
                x = whole(b.column(2))
                yield pa.RecordBatch.from_arrays([pa.array(file_rows(shared.value, x, added(x, radius2))), *b.columns],
                                                 names=["leaf", "vec_id", "label", "v"])

        def measure(batches):
            shape = [(len(n.children), len(n.children)) for n in shared.value]
            ranges = [(np.full(s, np.inf), np.full(s, -np.inf)) for s in shape]
            for b in batches:
                x = whole(b.column(0))
                file_rows(shared.value, x, added(x, radius2), ranges)
            for name, (low, high) in enumerate(ranges):
                i, j = np.nonzero(low <= high)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), name)), pa.array(i), pa.array(j), pa.array(low[i, j]),
                                                  pa.array(high[i, j])], names=["node", "i", "j", "low", "high"])

        measured = (self.rows.select("v").mapInArrow(measure, "node long, i long, j long, low double, high double")
                    .groupBy("node", "i", "j").agg(F.min("low").alias("low"), F.max("high").alias("high")).toPandas())
        for n in nodes:
            m = len(n.children)
            n.low, n.high = np.full((m, m), np.inf), np.full((m, m), -np.inf)
        for r in measured.itertuples():
            nodes[r.node].low[r.i, r.j], nodes[r.node].high[r.i, r.j] = r.low, r.high
        self.tree = self.spark.sparkContext.broadcast(nodes)
        index = self.rows.select("vec_id", "label", "v").mapInArrow(file, "leaf int, vec_id long, label long, v array<long>")
        sizes = index.groupBy("leaf").agg(F.count("*").alias("n"))
        # one row per leaf of the sample's tree, whatever the input: small enough to broadcast
        self.parts = F.broadcast(cut(sizes.select("leaf", F.ceil(F.col("n") / leaf_rows).cast("int").alias("parts"))))
        self.filed = cut(index.join(self.parts, "leaf").select(
            "leaf", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int").alias("part"), "vec_id", "label", "v"))

    def drop(self) -> None:
        """Delete the written tables, once nothing reads the index any more."""
        drop_cut(self.rows)
        drop_cut(self.filed)

    def search(self, anchors: DataFrame, windows: int, k: int, same_label: bool, block: int = 512) -> DataFrame:
        """``anchor, place, vec_id, score``: per anchor and window the ``k`` first rows by score, then id, of the same or
        of other labels; never the anchor itself.

        ``anchors``: vec_id, label, v, and arrays ``low``, ``high`` of ``windows`` inner products (both ends belong to it).
        """
        sample = self.spark.sparkContext.broadcast(self.sample)
        tree, n_leaves, radius2 = self.tree, self.n_leaves, self.radius2

        def narrowed(ids, labels, x, low, high):
            """Windows with the k-th score of the sample as lower end; no better row can lie below it."""
            s_ids, s_labels, s = sample.value
            scores = (x @ s.T).astype(np.int64)
            fits = (labels[:, None] == s_labels[None, :]) == same_label
            fits &= ids[:, None] != s_ids[None, :]
            out = low.copy()
            for w in range(windows):
                inside = np.where(fits & (scores >= low[:, w, None]) & (scores <= high[:, w, None]), scores, NOTHING)
                if inside.shape[1] >= k:
                    out[:, w] = np.maximum(out[:, w], np.partition(inside, inside.shape[1] - k, axis=1)[:, inside.shape[1] - k])
            return out

        def ask(batches):
            for b in batches:
                for a in range(0, b.num_rows, block):
                    part = b.slice(a, block)
                    ids, labels, x = np.asarray(part.column(0)), np.asarray(part.column(1)), whole(part.column(2))
                    low = part.column(3).flatten().to_numpy().reshape(-1, windows)
                    high = part.column(4).flatten().to_numpy().reshape(-1, windows)
                    low = narrowed(ids, labels, x, low, high)
                    own2 = (x * x).sum(axis=1)
                    met = np.zeros((len(ids), n_leaves), dtype=bool)
                    for w in range(windows):
                        to_distance = lambda s: np.sqrt(np.maximum(own2 + radius2 - 2.0 * s, 0.0))
                        # a window beyond what any row can reach is cut to it, so that no distance overflows
                        top = np.sqrt(own2 * radius2) + 1
                        far = to_distance(np.maximum(low[:, w].astype(np.float64), -top))
                        near = to_distance(np.minimum(high[:, w].astype(np.float64), top))
                        far[low[:, w] > high[:, w]] = -1
                        met |= leaves_met(tree.value, n_leaves, x, np.where(far < 0, 1.0, near), np.where(far < 0, -1.0, far))
                    for leaf in range(n_leaves):
                        rows = np.flatnonzero(met[:, leaf])
                        if len(rows):
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([leaf], type=pa.int32()), pa.array([ids[rows]], type=pa.list_(pa.int64())),
                                 pa.array([labels[rows]], type=pa.list_(pa.int64())),
                                 pa.array([x[rows].astype(np.int64).ravel()], type=pa.list_(pa.int64())),
                                 pa.array([low[rows].ravel()], type=pa.list_(pa.int64())),
                                 pa.array([high[rows].ravel()], type=pa.list_(pa.int64()))],
                                names=["leaf", "ids", "labels", "x", "low", "high"])

        lists = "ids array<long>, labels array<long>, x array<long>, low array<long>, high array<long>"
        asked = anchors.select("vec_id", "label", "v", "low", "high").mapInArrow(ask, f"leaf int, {lists}")
        asks = asked.join(self.parts, "leaf").select(
            "leaf", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(2).alias("asks"),
            "ids", "labels", "x", "low", "high")
        none = F.lit(None).cast("array<long>")
        filed = self.filed.select("leaf", "part", F.lit(1).alias("asks"), F.array("vec_id").alias("ids"), F.array("label").alias("labels"),
                                  F.col("v").alias("x"), none.alias("low"), none.alias("high"))
        met = filed.unionByName(asks).repartition("leaf", "part").sortWithinPartitions("leaf", "part", "asks")

        def meet(batches):
            held, here, block_ = [], None, None
            best, size = [], 0

            def settle():
                a, w, i, s = (np.concatenate(c) for c in zip(*best))
                by = np.lexsort((i, -s, w, a))
                a, w, i, s = a[by], w[by], i[by], s[by]
                new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (w[1:] != w[:-1])]))
                place = np.arange(len(a)) - np.repeat(new, np.diff(np.append(new, len(a))))
                return tuple(c[place < k] for c in (a, w, i, s))

            for b in batches:
                place = np.stack([np.asarray(b.column(c), dtype=np.int64) for c in range(3)], axis=1)
                edges = np.flatnonzero((place[1:] != place[:-1]).any(axis=1)) + 1
                for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), len(place)]):
                    key = (place[lo, 0], place[lo, 1])
                    if key != here:
                        here, held, block_ = key, [], None
                    part = b.slice(lo, hi - lo)
                    if place[lo, 2] == 1:
                        held.append((part.column(3).flatten().to_numpy(), part.column(4).flatten().to_numpy(), whole(part.column(5))))
                        continue
                    if not held:
                        continue
                    if block_ is None:
                        ids, labels, x = (np.concatenate(c) for c in zip(*held))
                        by = np.argsort(ids, kind="stable")
                        block_ = ids[by], labels[by], np.ascontiguousarray(x[by].T)
                        held = [None]
                    ids, labels, columns = block_
                    for row in part.to_pylist():
                        own = np.array(row["ids"], dtype=np.int64)
                        q_labels = np.array(row["labels"], dtype=np.int64)
                        q = np.array(row["x"], dtype=np.float64).reshape(len(own), -1)
                        low = np.array(row["low"], dtype=np.int64).reshape(len(own), -1)
                        high = np.array(row["high"], dtype=np.int64).reshape(len(own), -1)
                        for a in range(0, len(own), 64):
                            z = slice(a, a + 64)
                            scores = (q[z] @ columns).astype(np.int64)
                            fits = (q_labels[z, None] == labels[None, :]) == same_label
                            fits &= own[z, None] != ids[None, :]
                            for w in range(windows):
                                inside = fits & (scores >= low[z, w, None]) & (scores <= high[z, w, None])
                                some = np.flatnonzero(inside.any(axis=1))
                                if not len(some):
                                    continue
                                r, c = first_of(scores[some], inside[some], k)
                                best.append((own[z][some][r], np.full(len(r), w, dtype=np.int32), ids[c], scores[some][r, c]))
                                size += len(r)
                        if size > 400_000:
                            best = [settle()]
                            size = len(best[0][0])
            if best:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in settle()], names=["anchor", "place", "vec_id", "score"])

        hits = met.mapInArrow(meet, "anchor long, place int, vec_id long, score long")
        rank = F.row_number().over(Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "vec_id"))
        return hits.withColumn("rank", rank).filter(F.col("rank") <= k)


def mine(rows: DataFrame, label: Column, every: int = 100, positives: int = 5, negatives: int = 5, least_percent: int = 80,
         **options) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``: for each anchor (id divisible by
    ``every``) and each of its first rows of the same label, the first rows of other labels that score between
    ``least_percent`` and 100 percent of the positive.
    """
    tree = HyperplaneTree(whole_vectors(rows, label), **options)
    anchors = tree.rows.filter(F.pmod("vec_id", F.lit(every)) == 0)
    widest = F.array(F.lit(LARGEST).cast("long"))
    asked = anchors.select("*", F.transform(widest, lambda x: -x).alias("low"), widest.alias("high"))
    found = cut(tree.search(asked, 1, positives, same_label=True).select(
        F.col("anchor").alias("vec_id"), (F.col("rank") - 1).alias("at"), F.col("vec_id").alias("positive"), F.col("score").alias("positive_score")))
    # windows by place; an anchor with fewer positives has empty ones
    scores = found.groupBy("vec_id").agg(F.map_from_entries(F.collect_list(F.struct("at", "positive_score"))).alias("s"))
    of = lambda i: F.col("s")[i.cast("int")]
    places = F.sequence(F.lit(0), F.lit(positives - 1))
    least = lambda s: F.ceil(s * F.lit(least_percent).cast("decimal(10,0)") / F.lit(100).cast("decimal(10,0)")).cast("long")
    windowed = anchors.join(scores, "vec_id").select(
        "vec_id", "label", "v", F.transform(places, lambda i: F.coalesce(least(of(i).cast("decimal(20,0)")), F.lit(1).cast("long"))).alias("low"),
        F.transform(places, lambda i: F.coalesce(of(i), F.lit(0).cast("long"))).alias("high"))
    hard = tree.search(windowed, positives, negatives, same_label=False)
    return (hard.select(F.col("anchor").alias("vec_id"), F.col("place").alias("at"), "rank", F.col("vec_id").alias("negative_id"),
                        F.col("score").alias("negative_score"))
            .join(found, ["vec_id", "at"])
            .select(F.col("vec_id").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", "negative_id", "positive_score",
                    "negative_score"))
