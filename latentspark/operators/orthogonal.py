"""M8/M9 without normal equations: ridge regression by a tall-skinny QR, merged up a tree.

``ridge`` and ``weighted_ridge`` of ``operators.regression`` sum Gram matrices, which squares the condition of the
columns.  Here every task reduces the rows [√c·X | √c·y] of a group to the (k+1)×(k+1) triangle of their QR
factorisation; triangles of a group are stacked and factorised again, ``fan`` at a time, until one is left.  The
answer comes from its singular values, so columns that differ by 1e-6 still have their coefficients.

A group of any size costs one triangle per task before the shuffle; no group is collected.  Rows with a null in any
column take no part, as in the sums; negative weights are an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows that are factorised at a time inside a task.
BLOCK = 4096


def triangle(rows: np.ndarray) -> np.ndarray:
    """R of the QR factorisation, square whatever the number of rows."""
    k = rows.shape[1]
    r = np.linalg.qr(rows, mode="r")
    return r if len(r) == k else np.vstack([r, np.zeros((k - len(r), k))])


def solve_triangle(r: np.ndarray, lam: float) -> np.ndarray:
    """Ridge coefficients from the triangle of [X | y]; with λ = 0 the least-squares answer of minimum norm."""
    k = r.shape[1] - 1
    u, s, vt = np.linalg.svd(r[:, :k], full_matrices=False)
    b = u.T @ r[:, k]
    if lam > 0:
        return vt.T @ (s * b / (s * s + lam))
    known = s > s.max(initial=0.0) * np.finfo(float).eps * max(r.shape)
    return vt.T @ np.where(known, b / np.where(known, s, 1.0), 0.0)


class _Triangles:
    """Running triangles of groups that arrive sorted; a change of group hands the finished one out."""

    def __init__(self, k: int):
        self.k, self.group, self.rows, self.n = k, None, [], 0

    def add(self, group, rows: np.ndarray):
        done = None
        if self.rows and group != self.group:
            done = self.finish()
        self.group = group
        self.rows.append(rows)
        self.n += len(rows)
        if self.n > BLOCK:
            self.rows = [triangle(np.vstack(self.rows))]
            self.n = self.k
        return done

    def finish(self):
        out = (self.group, triangle(np.vstack(self.rows)))
        self.rows, self.n = [], 0
        return out


def _edges(columns: list[list]) -> list[int]:
    """Bounds of the stretches of equal keys in parallel lists."""
    n = len(columns[0]) if columns else 0
    return [0, *[i for i in range(1, n) if any(c[i] != c[i - 1] for c in columns)], n]


def ridge_qr(df: DataFrame, features: list, label: str, lam: float, weight: str | None = None, by: list[str] | None = None,
             fan: int = 64) -> DataFrame:
    """``(by…, coef)``: (XᵀCX + λI)⁺XᵀCy per group by QR (M9; one row without ``by``, M8)."""
    by = list(by or [])
    xs = [F.col(c).cast("double") if isinstance(c, str) else c for c in features]
    k = len(xs) + 1
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    checked = F.when(w < 0, F.raise_error(F.lit("negative weight")).cast("double")).otherwise(F.sqrt(w))
    names = [f"_q{j}" for j in range(k)]
    columns: list[Column] = [*xs, F.col(label).cast("double")]
    rows = df.select(*[F.col(c) for c in by], *[(c * checked).alias(n) for c, n in zip(columns, names)]).dropna(subset=names)
    keys = [df.schema[c] for c in by]
    schema = T.StructType([*keys, T.StructField("_part", T.LongType()), T.StructField("_r", T.ArrayType(T.DoubleType()))])

    def emit(done, part, types):
        group, r = done
        arrays = [pa.array([g], type=t) for g, t in zip(group, types)]
        return pa.RecordBatch.from_arrays([*arrays, pa.array([part], type=pa.int64()), pa.array([r.ravel()], type=pa.list_(pa.float64()))],
                                          names=[*by, "_part", "_r"])

    def first(batches):
        from pyspark import TaskContext
        part, held, types = TaskContext.get().partitionId(), _Triangles(k), None
        for b in batches:
            types = [b.schema.field(c).type for c in by]
            x = np.stack([b.column(n).to_numpy(zero_copy_only=False) for n in names], axis=1)
            lists = [b.column(c).to_pylist() for c in by]
            bounds = _edges(lists) if by else [0, len(x)]
            for lo, hi in zip(bounds, bounds[1:]):
                if lo < hi:
                    done = held.add(tuple(c[lo] for c in lists), x[lo:hi])
                    if done:
                        yield emit(done, part, types)
        if held.rows:
            yield emit(held.finish(), part, types)

    def merge(batches):
        held, types = _Triangles(k), None
        for b in batches:
            types = [b.schema.field(c).type for c in by]
            for row in b.to_pylist():
                done = held.add((*[row[c] for c in by], row["_part"]), np.array(row["_r"]).reshape(k, k))
                if done:
                    yield emit((done[0][:-1], done[1]), done[0][-1], types)
        if held.rows:
            done = held.finish()
            yield emit((done[0][:-1], done[1]), done[0][-1], types)

    parts = (rows.sortWithinPartitions(*by) if by else rows).mapInArrow(first, schema)
    left = rows.rdd.getNumPartitions()
    while True:
        # triangles of one group whose task numbers share a stretch of ``fan`` meet in one task
        left = -(-left // fan)
        parts = parts.withColumn("_part", F.floor(F.col("_part") / fan))
        parts = parts.repartition(*by, "_part").sortWithinPartitions(*by, "_part").mapInArrow(merge, schema)
        if left <= 1:
            break

    out = T.StructType([*keys, T.StructField("coef", T.ArrayType(T.DoubleType()))])

    def solve(batches):
        for b in batches:
            coefs = [solve_triangle(np.array(r).reshape(k, k), lam) for r in b.column("_r").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in by], pa.array(coefs, type=pa.list_(pa.float64()))], names=[*by, "coef"])

    return parts.mapInArrow(solve, out)
