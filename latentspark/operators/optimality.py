"""Optimality of non-negative factors: the Karush–Kuhn–Tucker conditions of one side, given the other.

The library ALS (M1) ends a sweep by solving, for every user u with n ratings, the non-negative least squares
min ½ Σ (u·v − y)² + ½ λ n |u|², u ≥ 0.  Its solution is the only point whose gradient w = Σ (u·v − y) v + λ n u is zero where
u is positive, and not negative where u is zero.  How far an id is from that is a sum over its ratings: one
aggregate, no solver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def nnls_violations(ratings: DataFrame, factors: DataFrame, others: DataFrame, own: str, other: str, k: int,
                    lam: float) -> DataFrame:
    """``id, n, violation, scale``: the largest violation over the components of each rated id of side ``own``.

    ``scale`` is λ n |u| + Σ |y||v| + Σ |u·v||v| for that component's sums at most,
    what rounding is relative to; λ counts once per rating (the library's convention).
    """
    u = factors.select(F.col("id").cast("long").alias(own), F.col("features").alias("u"))
    v = others.select(F.col("id").cast("long").alias(other), F.col("features").alias("v"))
    mu = "(" + " + ".join(f"u[{j}] * v[{j}]" for j in range(k)) + ")"
    rows = ratings.select(F.col(own).cast("long").alias(own), F.col(other).cast("long").alias(other), "rating").join(v, other).join(u, own)
    sums = rows.selectExpr(own, "u", "rating", "v", f"{mu} mu").groupBy(F.col(own).alias("id")).agg(
        F.expr("any_value(u) u"), F.expr("count(*) n"), *[F.expr(f"sum((mu - rating) * v[{j}]) w{j}") for j in range(k)],
        *[F.expr(f"sum((abs(mu) + abs(rating)) * abs(v[{j}])) s{j}") for j in range(k)])
    gradient = lambda j: f"(w{j} + {float(lam)!r}D * n * u[{j}])"
    far = ", ".join(f"if(u[{j}] > 0, abs({gradient(j)}), if(u[{j}] < 0, double('infinity'), greatest(0.0D, -{gradient(j)})))" for j in range(k))
    size = ", ".join(f"s{j} + {float(lam)!r}D * n * abs(u[{j}])" for j in range(k))
    return sums.selectExpr("id", "n", f"array_max(array({far})) violation", f"array_max(array({size})) scale")
