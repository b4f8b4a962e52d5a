"""Weighted ridge regression per group, and the ALS half-step built on it.

For each group g:  x_g = (Xᵀ C X + λI)⁺ Xᵀ C y    (C = diag(weights))

The normal equations of ``gram`` / ``ridge`` are ``sum`` columns of one hash
aggregate (whole-stage codegen, partial aggregation before the shuffle: a hot
group is pre-summed in every map task).  The half-step of ALS builds its Gram
matrices block by block over ratings that were laid out once
(``operators.blocks``), one plan for every rank.  The k×k solves run batched in
numpy; nothing is collected on the driver.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut
from .blocks import RatingBlocks, half_step
from .solve import batched_solve


def _feature_cols(features, k: int | None) -> list[Column]:
    if isinstance(features, str):
        if k is None:
            raise ValueError("k is required when features is an array column")
        return [F.col(features).getItem(i) for i in range(k)]
    return [F.col(c).cast("double") for c in features]


def gram(df: DataFrame, by: list[str], features, label: str, weight: str | None = None,
         k: int | None = None) -> DataFrame:
    """Per group the sums ``g_i_j = Σ c·xᵢ·xⱼ`` (i ≤ j), ``b_i = Σ c·xᵢ·y``, ``n``."""
    xs = _feature_cols(features, k)
    k = len(xs)
    w = F.col(weight).cast("double") if weight else None
    y = F.col(label).cast("double")
    aggs = []
    for i in range(k):
        for j in range(i, k):
            t = xs[i] * xs[j]
            aggs.append(F.sum(t * w if w is not None else t).alias(f"g_{i}_{j}"))
    for i in range(k):
        t = xs[i] * y
        aggs.append(F.sum(t * w if w is not None else t).alias(f"b_{i}"))
    aggs.append(F.count(F.lit(1)).alias("n"))
    grouped = df.groupBy(*by) if by else df.groupBy()
    return grouped.agg(*aggs)


def _solve_fn(k: int, lam: float, by: list[str], out: str):
    iu = [(i, j) for i in range(k) for j in range(i, k)]

    def solve(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            m = len(pdf)
            G = np.zeros((m, k, k))
            for i, j in iu:
                v = pdf[f"g_{i}_{j}"].to_numpy(dtype=float)
                G[:, i, j] = v
                G[:, j, i] = v
            b = np.stack([pdf[f"b_{i}"].to_numpy(dtype=float) for i in range(k)], axis=1)
            x = batched_solve(G, b, lam)
            res = pdf[by].copy() if by else pd.DataFrame(index=range(m))
            res[out] = list(x)
            yield res

    return solve


def solve_normal_equations(g: DataFrame, k: int, lam: float, by: list[str], out: str = "coef") -> DataFrame:
    """Batched (G + λI)⁺ b for every row of a Gram frame."""
    fields = [g.schema[c] for c in by]
    schema = T.StructType(fields + [T.StructField(out, T.ArrayType(T.DoubleType()))])
    return g.mapInPandas(_solve_fn(k, float(lam), by, out), schema)


def ridge(df: DataFrame, features, label: str, lam: float, k: int | None = None) -> DataFrame:
    """M8: ``(XᵀX + λI)⁺ Xᵀy`` over the whole table; one row ``coef``."""
    xs = _feature_cols(features, k)
    return weighted_ridge(df, features, label, None, lam, by=[], k=len(xs))


def weighted_ridge(df: DataFrame, features, label: str, weight: str | None, lam: float,
                   by: list[str] | None = None, k: int | None = None) -> DataFrame:
    """M9: ``(XᵀCX + λI)⁺ XᵀCy`` per group of ``by`` (filtered ridge when C ∈ {0,1})."""
    by = list(by or [])
    xs = _feature_cols(features, k)
    g = gram(df, by, features, label, weight, k=len(xs))
    return solve_normal_equations(g, len(xs), lam, by)


# ------------------------------------------------------------------ ALS half-step
def als_half_step(ratings: DataFrame, fixed: DataFrame, fixed_key: str, out_key: str,
                  k: int, lam: float) -> DataFrame:
    """M2: fix one side's factors and solve a ridge system per id of the other side.

    ``ratings`` has (user, item, rating); ``fixed`` is (id, features) for the
    ``fixed_key`` side.  Returns (id, features) for the ids of ``out_key``
    that have ratings; plain λ (Q13).  Ids without ratings are added by
    ``pad_factors`` (zero vector, Q14).  Loops build the ``RatingBlocks`` once
    and call ``half_step`` themselves.
    """
    r = ratings.select(F.col(fixed_key).alias("user"), F.col(out_key).alias("item"), "rating")
    # one pass only: small blocks cost a few more messages and keep a task's memory low
    blocks = RatingBlocks.of(r, per_block=500_000, sides=("item",))
    try:
        return cut(half_step(blocks, fixed, "item", k, lam))
    finally:
        blocks.release()
