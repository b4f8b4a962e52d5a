"""Gradient checks and training-trace windows.

* D1/D2: central differences of a Column expression, per row of a table.
* D3: the numeric gradient of the factorisation loss for every coordinate in
  one job: moving coordinate (side, id, j) changes only the terms of that
  id's ratings and its own λ term, so each coordinate's difference is a sum
  over that id's ratings (O(ratings·k), not O(coordinates·ratings)).
* W1/W2/T3: windows over a trace (one row per iteration, bounded by the
  iteration cap, so an unpartitioned window is safe there and only there).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .objective import gradient
from .ratings import with_factors
from ..functions.vectors import dot


def numeric_gradient(df: DataFrame, f: Callable[[dict], Column], cols: list[str], eps: float = 1e-3,
                     prefix: str = "ng_") -> DataFrame:
    """Adds ``ng_<c>`` = (f(x + ε·e_c) − f(x − ε·e_c)) / 2ε for each column c."""
    base = {c: F.col(c).cast("double") for c in cols}
    out = []
    for c in cols:
        up = dict(base, **{c: base[c] + F.lit(eps)})
        dn = dict(base, **{c: base[c] - F.lit(eps)})
        out.append(((f(up) - f(dn)) / F.lit(eps + eps)).alias(prefix + c))
    return df.select("*", *out)


def verify_gradient(df: DataFrame, f: Callable[[dict], Column], grads: dict[str, Callable[[dict], Column]],
                    cols: list[str], eps: float = 1e-3) -> DataFrame:
    """Per row the squared distance between numeric and analytic gradient (``sq_dist``)."""
    base = {c: F.col(c).cast("double") for c in cols}
    ng = numeric_gradient(df, f, cols, eps)
    dist = None
    for c in cols:
        d = F.col("ng_" + c) - grads[c](base)
        dist = d * d if dist is None else dist + d * d
    return ng.withColumn("sq_dist", dist)


def check_mf_gradient(ratings: DataFrame, user_factors: DataFrame, item_factors: DataFrame, k: int,
                      lam: float, normalizer: float = 1.0, eps: float = 1e-3) -> DataFrame:
    """D3: ``(side, id, k, numeric, analytic)`` for every coordinate of both sides."""
    j = with_factors(ratings, user_factors, item_factors)
    mu = dot("uf", "vf", k)
    e = F.col("rating") - mu
    n = F.lit(float(normalizer))
    two_eps = F.lit(eps + eps)

    def side(key, own, other, factors, name):
        # moving own[j] by ±ε moves μ by ±ε·other[j]
        terms = []
        for jj in range(k):
            sh = F.lit(eps) * F.col(other).getItem(jj)
            terms.append(F.sum(F.lit(0.5) * ((e - sh) * (e - sh) - (e + sh) * (e + sh))).alias(f"s{jj}"))
        s = j.groupBy(F.col(key).alias("id")).agg(*terms)
        f = factors.select("id", "features").join(s, "id", "left")
        rows = []
        for jj in range(k):
            x = F.col("features").getItem(jj)
            reg = F.lit(0.5 * lam) * ((x + F.lit(eps)) * (x + F.lit(eps)) - (x - F.lit(eps)) * (x - F.lit(eps)))
            num = (F.coalesce(F.col(f"s{jj}"), F.lit(0.0)) + reg) / n / two_eps
            rows.append(F.struct(F.lit(jj).alias("k"), num.alias("numeric")))
        return f.select(F.lit(name).alias("side"), "id", F.explode(F.array(*rows)).alias("c")).select(
            "side", "id", "c.k", "c.numeric")

    num = side("user", "uf", "vf", user_factors, "user").unionByName(
        side("item", "vf", "uf", item_factors, "item"))
    du, di = gradient(ratings, user_factors, item_factors, k, lam, normalizer)
    ana = (du.select(F.lit("user").alias("side"), "id", F.posexplode("features").alias("k", "analytic"))
           .unionByName(di.select(F.lit("item").alias("side"), "id", F.posexplode("features").alias("k", "analytic"))))
    return num.join(ana, ["side", "id", "k"])


def gradient_distance(check: DataFrame) -> DataFrame:
    """D2 over D3's output: Σ (numeric − analytic)²."""
    d = F.col("numeric") - F.col("analytic")
    return check.agg(F.sum(d * d).alias("sq_dist"))


# ---------------------------------------------------------------- trace windows
def with_reduction(history: DataFrame, first: float = 0.5) -> DataFrame:
    """``red = loss / previous loss``; the first row gets ``first``."""
    w = Window.orderBy("iter")
    return history.withColumn("red", F.coalesce(F.col("loss") / F.lag("loss").over(w), F.lit(first)))


def shrink(history: DataFrame, n: int = 10) -> DataFrame:
    """``1 − avg(red)`` over the latest ``n`` rows up to each iteration."""
    w = Window.orderBy("iter").rowsBetween(-(n - 1), 0)
    return history.withColumn("shrink", F.lit(1.0) - F.avg("red").over(w))


def latest(history: DataFrame, n: int) -> DataFrame:
    """The newest ``n`` rows, newest first."""
    return history.orderBy(F.desc("iter")).limit(n)


def compare_trainers(ratings: DataFrame, fits: dict, k: int, lam: float, normalizer: float) -> DataFrame:
    """Loss of each fitted model on the same ratings, one row per trainer."""
    from .objective import loss_frame
    frames = [loss_frame(ratings, p.uf, p.vf, k, lam, normalizer).select(F.lit(name).alias("trainer"), "loss")
              for name, p in fits.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
