"""Nearest neighbours by a forest of random-projection trees, searched through one shared priority queue.

The trees are fitted on a bounded sample (``sample_rows`` vectors, by hash of
their id): each node splits its sample at the median of its projections on the
difference of two of its vectors.  Every row is then filed under one leaf of
each tree.  A query walks all trees at once: a heap holds the branches not
taken, nearest split first, and leaves are opened until they hold ``share`` of
the sample (summed over trees).  Leaf by leaf, queries meet the rows filed
there and are scored exactly, in double precision on the original vectors; what
leaves a task is the best few per query, merged in a last aggregate.

A leaf with more rows than ``leaf_rows`` is dealt out in parts, and its queries
go to each part.  Of equal vectors only as many as any query can return are
filed, those with the smallest ids, so a vector that a third of all rows share
is no hot leaf; equal query vectors are searched once.

Why ``share`` is a share: on vectors without structure (the given ones are
isotropic) the five nearest of a query are spread over many leaves; a constant
number of opened rows would lose recall as the table grows.

Edge cases: vectors that are null, empty, zero, or hold a null or non-finite
component take no part, as query or candidate, nor do those whose length differs
from the most frequent one (ties: the shorter); rows repeating a vec_id are
one candidate, at their nearest vector; rows with a null vec_id take no part;
ties go to the smaller vec_id; a table with one valid row gives no result rows.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from latentspark.llm.common import batched, hash_sample
from latentspark.session import cut


@dataclass
class Tree:
    """Nodes: unit ``directions``, ``thresholds``, ``children`` (node, or -1 - leaf); ``shares``: sample share per leaf."""
    directions: np.ndarray
    thresholds: np.ndarray
    children: np.ndarray
    shares: np.ndarray

    def leaves(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), dtype=np.int64) if len(self.thresholds) else np.full(len(x), -1)
        inner = np.flatnonzero(at >= 0)
        while len(inner):
            node = at[inner]
            side = np.einsum("ij,ij->i", x[inner], self.directions[node]) > self.thresholds[node]
            at[inner] = self.children[node, side.astype(np.int64)]
            inner = inner[at[inner] >= 0]
        return -1 - at


def fit_tree(sample: np.ndarray, leaf_size: int, rng: np.random.Generator) -> Tree:
    directions, thresholds, children, shares = [], [], [], []

    def leaf(rows):
        shares.append(len(rows) / max(len(sample), 1))
        return -len(shares)

    def split(rows):
        if len(rows) <= leaf_size:
            return None
        for _ in range(4):  # equal vectors can be drawn, and give no direction
            a, b = sample[rng.choice(rows, 2, replace=False)]
            d = a - b
            norm = np.linalg.norm(d)
            if norm > 1e-12:
                p = sample[rows] @ (d / norm)
                t = float(np.median(p))
                if (p > t).any():
                    return d / norm, t, rows[p <= t], rows[p > t]
        return None

    todo = [(np.arange(len(sample)), None, 0)]
    while todo:
        rows, parent, side = todo.pop()
        found = split(rows)
        if found is None:
            name = leaf(rows)
        else:
            name = len(thresholds)
            directions.append(found[0])
            thresholds.append(found[1])
            children.append([0, 0])
            todo += [(found[3], name, 1), (found[2], name, 0)]
        if parent is not None:
            children[parent][side] = name
    d = sample.shape[1]
    return Tree(np.array(directions).reshape(-1, d), np.array(thresholds), np.array(children, dtype=np.int64).reshape(-1, 2),
                np.array(shares))


def opened(trees: list[Tree], q: np.ndarray, share: float) -> list[tuple[int, int]]:
    """(tree, leaf) in the order in which the shared queue opens them for the unit vector ``q``."""
    margins = [t.directions @ q - t.thresholds for t in trees]
    heap = [(-np.inf, k, 0 if len(t.thresholds) else -1) for k, t in enumerate(trees)]
    heapq.heapify(heap)
    found, held = [], 0.0
    while heap and held < share:
        far, k, node = heapq.heappop(heap)
        tree = trees[k]
        while node >= 0:
            m = margins[k][node]
            near, other = tree.children[node, ::-1] if m > 0 else tree.children[node]
            heapq.heappush(heap, (max(far, abs(m)), k, int(other)))
            node = near
        found.append((k, int(-1 - node)))
        held += tree.shares[-1 - node]
    return found


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def valid(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id long, v array<double>`` of the rows that take part, of the most frequent length."""
    v = F.col("v")
    good = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v")).filter(
        F.col("vec_id").isNotNull() & (F.size(v) > 0)
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0))
    top = good.groupBy(F.size(v).alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    return good.filter(F.size(v) == (top["d"] if top else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _first_k(query, ids, scores, k):
    """Of arrays sorted by query, falling score and id: the first ``k`` ids per query, each at its first place."""
    by = np.lexsort((ids, query))  # stable: the best score of an id comes first
    first = np.ones(len(query), dtype=bool)
    first[by[1:]] = (query[by[1:]] != query[by[:-1]]) | (ids[by[1:]] != ids[by[:-1]])
    query, ids, scores = query[first], ids[first], scores[first]
    start = np.concatenate([[0], np.flatnonzero(query[1:] != query[:-1]) + 1]) if len(query) else np.zeros(0, np.int64)
    place = np.arange(len(query)) - np.repeat(start, np.diff(np.concatenate([start, [len(query)]])))
    keep = place < k
    return query[keep], ids[keep], scores[keep]


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` with the same row of ``b``, every pair summed in the same order."""
    dot = lambda x, y: np.einsum("ij,ij->i", x, y)
    return dot(a, b) / (np.sqrt(dot(a, a)) * np.sqrt(dot(b, b)))


HITS = pa.schema([("qkey", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def nearest(rows: DataFrame, every: int = 50, k: int = 5, *, n_trees: int = 12, leaf_size: int = 16,
            sample_rows: int = 8192, share: float = 1.5, leaf_rows: int = 4096, seed: int = 11) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found for each row whose id is divisible by ``every``."""
    spark = rows.sparkSession
    x = valid(rows).distinct()
    # equal vectors: the k + 1 smallest ids can be answers, the others never
    copy = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    filed = cut(x.withColumn("copy", copy).filter(F.col("copy") <= k + 1).select("vec_id", "v"))
    # equal query vectors are searched once, under the smallest of their ids
    asked = x.filter(F.pmod("vec_id", F.lit(every)) == 0)
    keys = cut(asked.groupBy("v").agg(F.min("vec_id").alias("qkey")))
    picked = hash_sample(filed.select("vec_id"), "vec_id", sample_rows, seed).distinct()
    sample = (filed.join(F.broadcast(picked), "vec_id").select("deal", "vec_id", "v").orderBy("deal", "vec_id", "v")
              .limit(sample_rows).toPandas()["v"])
    if not len(sample):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    points = _unit(np.stack(sample.to_numpy()))
    rng = np.random.default_rng(seed)
    forest = spark.sparkContext.broadcast([fit_tree(points, leaf_size, rng) for _ in range(n_trees)])

    def file(batches):
        for b in batches:
            unit = _unit(_matrix(b.column(1)))
            for t, tree in enumerate(forest.value):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(unit), t, dtype=np.int32)),
                                                  pa.array(tree.leaves(unit).astype(np.int32)), b.column(0), b.column(1)],
                                                 names=["tree", "leaf", "id", "v"])

    def ask(batches):
        schema = pa.schema([("tree", pa.int32()), ("leaf", pa.int32()), ("id", pa.int64()), ("v", pa.list_(pa.float64()))])

        def out():
            for b in batches:
                for key, q, v in zip(b.column(0).to_pylist(), _unit(_matrix(b.column(1))), b.column(1).to_pylist()):
                    for t, leaf in opened(forest.value, q, share):
                        yield t, leaf, key, v
        yield from batched(out(), schema, 2048)

    ddl = "tree int, leaf int, id long, v array<double>"
    index = filed.select("vec_id", "v").mapInArrow(file, ddl)
    parts = (index.groupBy("tree", "leaf").agg(F.count("*").alias("n"))
             .select("tree", "leaf", F.ceil(F.col("n") / leaf_rows).cast("int").alias("parts")))
    probes = keys.select("qkey", "v").mapInArrow(ask, ddl)
    # one row per leaf of the sample's trees, whatever the input: small enough to broadcast
    parts = F.broadcast(parts)
    dealt = index.join(parts, ["tree", "leaf"]).select(
        "tree", "leaf", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("asks"), "id", "v")
    asks = probes.join(parts, ["tree", "leaf"]).select(
        "tree", "leaf", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(2).alias("asks"), "id", "v")
    met = dealt.unionByName(asks).repartition("tree", "leaf", "part").sortWithinPartitions("tree", "leaf", "part", "asks")

    def meet(batches):
        held: list[np.ndarray] = []      # (ids, vectors) of the leaf part that is being read
        best: list[tuple] = []
        here, size = None, 0

        def flush():
            q, i, s = (np.concatenate(c) for c in zip(*best))
            order = np.lexsort((i, -s, q))
            return _first_k(q[order], i[order], s[order], k + 1)

        for b in batches:
            keys_ = np.stack([np.asarray(b.column(c), dtype=np.int64) for c in range(4)], axis=1)
            ids, v = np.asarray(b.column(4)), _matrix(b.column(5))
            edges = np.flatnonzero((keys_[1:] != keys_[:-1]).any(axis=1)) + 1
            for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), len(ids)]):
                place, asks_ = tuple(keys_[lo, :3].tolist()), keys_[lo, 3]
                if place != here:
                    here, held = place, []
                if asks_ == 1:
                    held.append((ids[lo:hi], v[lo:hi]))
                    continue
                if not held:
                    continue
                if len(held[0]) == 2:
                    c_ids, c = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
                    by = np.argsort(c_ids, kind="stable")
                    c_ids, c = c_ids[by], c[by]
                    held = [(c_ids, c, np.flatnonzero(np.concatenate([[True], c_ids[1:] != c_ids[:-1]])))]
                c_ids, c, starts = held[0]
                for a in range(lo, hi, 512):
                    q = v[a:min(a + 512, hi)]
                    s = _unit(q) @ _unit(c).T
                    # places are for ids: several rows of one count as its nearest
                    top = s if len(starts) == len(c_ids) else np.maximum.reduceat(s, starts, axis=1)
                    m = min(k + 1, top.shape[1])
                    # ties at the cut are settled by id, so all as near as the last one stay; those that
                    # stay are scored by one formula whatever block they lie in
                    floor = np.partition(top, top.shape[1] - m, axis=1)[:, top.shape[1] - m, None] - 1e-9
                    if top is not s:
                        floor = np.maximum(floor, np.repeat(top, np.diff([*starts, len(c_ids)]), axis=1) - 1e-9)
                    r, j = np.nonzero(s >= floor)
                    best.append((ids[a:a + len(q)][r], c_ids[j], cosine(q[r], c[j])))
                    size += len(r)
                if size > 400_000:
                    kept = flush()
                    best, size = [kept], len(kept[0])
        if best:
            q, i, s = flush()
            for a in range(0, len(q), 65536):
                yield pa.RecordBatch.from_arrays([pa.array(z[a:a + 65536]) for z in (q, i, s)], schema=HITS)

    # a candidate found by several trees, or several rows of one vec_id: its best score
    hits = met.mapInArrow(meet, "qkey long, vec_id long, score double").groupBy("qkey", "vec_id").agg(F.max("score").alias("score"))
    w = Window.partitionBy("qkey").orderBy(F.desc("score"), "vec_id")
    near = hits.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= k + 1)
    own = asked.join(keys.withColumnRenamed("v", "w"), F.col("v") == F.col("w")).select(F.col("vec_id").alias("query_id"), "qkey").distinct()
    # a query with several vectors has each neighbour once, at its best score
    out = (own.join(near, "qkey").filter("vec_id <> query_id").groupBy("query_id", "vec_id")
           .agg(F.max("score").alias("score")))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return out.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
