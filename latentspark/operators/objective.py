"""Regularised squared loss of a factor model, its gradient, and related sums.

Model: prediction μᵤᵢ = αᵤ·βᵢ over rated cells only.

    loss = ½ (Σ_rated (y − μ)² + λ Σ‖αᵤ‖² + λ Σ‖βᵢ‖²) / N
    dαᵤ  = (Σ_i δᵤᵢ βᵢ + λ αᵤ) / N,   dβᵢ = (Σ_u δᵤᵢ αᵤ + λ βᵢ) / N,   δ = μ − y

Work is O(ratings·k): one join of the rating rows with both factor tables,
then hash aggregates with map-side partial sums (a hot id is pre-summed in
every map task, so skew costs one partial row per task).  Only scalars
(loss, polynomial coefficients, inner products) reach the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import dot
from .ratings import with_factors


def _sum_sq(features: str, k: int) -> Column:
    return F.sum(dot(features, features, k))


def _scalar_sums(*parts: DataFrame) -> DataFrame:
    """Union one-row partial sums (columns: term, value) and pivot them into one row."""
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    terms = sorted({t for t in _TERMS})
    return u.groupBy().agg(*[F.sum(F.when(F.col("term") == t, F.col("value"))).alias(t) for t in terms])


_TERMS = ("sse", "su", "si")


def loss_frame(ratings: DataFrame, user_factors: DataFrame, item_factors: DataFrame,
               k: int, lam: float, normalizer: float = 1.0) -> DataFrame:
    """A5 as a one-row frame with columns ``sse, reg_user, reg_item, loss``."""
    j = with_factors(ratings, user_factors, item_factors)
    e = F.col("rating") - dot("uf", "vf", k)
    sse = j.agg(F.lit("sse").alias("term"), F.sum(e * e).alias("value"))
    su = user_factors.agg(F.lit("su").alias("term"), _sum_sq("features", k).alias("value"))
    si = item_factors.agg(F.lit("si").alias("term"), _sum_sq("features", k).alias("value"))
    s = _scalar_sums(sse, su, si)
    sse_c, su_c, si_c = (F.coalesce(F.col(c), F.lit(0.0)) for c in ("sse", "su", "si"))
    return s.select(sse_c.alias("sse"), su_c.alias("reg_user"), si_c.alias("reg_item"),
                    (F.lit(0.5) * (sse_c + F.lit(float(lam)) * su_c + F.lit(float(lam)) * si_c)
                     / F.lit(float(normalizer))).alias("loss"))


def loss(ratings: DataFrame, user_factors: DataFrame, item_factors: DataFrame,
         k: int, lam: float, normalizer: float = 1.0) -> float:
    """A5: the loss as a driver scalar (one job)."""
    return float(loss_frame(ratings, user_factors, item_factors, k, lam, normalizer).first()["loss"])


SIDE_USER, SIDE_ITEM = 0, 1


def gradient_frame(ratings: DataFrame, user_factors: DataFrame, item_factors: DataFrame,
                   k: int, lam: float, normalizer: float = 1.0) -> DataFrame:
    """A6 for both sides in one job: ``(side, id, features)`` with side 0 = user, 1 = item.

    Every rating row contributes δ·βᵢ to its user and δ·αᵤ to its item; the
    two contributions are emitted as two rows and summed in one hash
    aggregate keyed by (side, id), so the rating join runs once.  Ids without
    ratings get λα/N (δ is 0 on unrated cells).
    """
    j = with_factors(ratings, user_factors, item_factors)
    delta = dot("uf", "vf", k) - F.col("rating")
    contrib = F.explode(F.array(
        F.struct(F.lit(SIDE_USER).alias("side"), F.col("user").alias("id"), F.col("vf").alias("v")),
        F.struct(F.lit(SIDE_ITEM).alias("side"), F.col("item").alias("id"), F.col("uf").alias("v"))))
    e = j.select(delta.alias("delta"), contrib.alias("c")).select("delta", "c.side", "c.id", "c.v")
    sums = e.groupBy("side", "id").agg(
        *[F.sum(F.col("delta") * F.col("v").getItem(jj)).alias(f"g{jj}") for jj in range(k)])
    f = (user_factors.select(F.lit(SIDE_USER).alias("side"), "id", "features")
         .unionByName(item_factors.select(F.lit(SIDE_ITEM).alias("side"), "id", "features")))
    g = f.join(sums, ["side", "id"], "left")
    n = F.lit(float(normalizer))
    comps = [(F.coalesce(F.col(f"g{jj}"), F.lit(0.0)) + F.lit(float(lam)) * F.col("features").getItem(jj)) / n
             for jj in range(k)]
    return g.select("side", "id", F.array(*comps).alias("features"))


def split_sides(frame: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(side, id, features) → (user frame, item frame)."""
    return (frame.filter(F.col("side") == SIDE_USER).select("id", "features"),
            frame.filter(F.col("side") == SIDE_ITEM).select("id", "features"))


def gradient(ratings: DataFrame, user_factors: DataFrame, item_factors: DataFrame,
             k: int, lam: float, normalizer: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """(d_user, d_item) as factor-shaped frames ``(id, features)``."""
    return split_sides(gradient_frame(ratings, user_factors, item_factors, k, lam, normalizer))


def sq_diff(p: DataFrame, q: DataFrame, k: int) -> float:
    """Σ‖pᵢ − qᵢ‖² over ids present in both (factor-shaped frames)."""
    return float(sq_diff_frame(p, q, k).first()["sq_diff"] or 0.0)


def sq_diff_frame(p: DataFrame, q: DataFrame, k: int) -> DataFrame:
    j = p.select("id", F.col("features").alias("a")).join(q.select("id", F.col("features").alias("b")), "id")
    d = [F.col("a").getItem(i) - F.col("b").getItem(i) for i in range(k)]
    expr = d[0] * d[0]
    for x in d[1:]:
        expr = expr + x * x
    return j.agg(F.sum(expr).alias("sq_diff"))


def sq_norm_frame(factors: DataFrame, k: int) -> DataFrame:
    """Σ‖f‖² and ‖f‖ over a factor table."""
    return factors.agg(_sum_sq("features", k).alias("sq_norm")).select(
        "sq_norm", F.sqrt("sq_norm").alias("norm"))


def param_dots(a: tuple[DataFrame, DataFrame], b: tuple[DataFrame, DataFrame], k: int) -> float:
    """A10: inner product of two parameter sets (user part + item part), one job."""
    return float(param_dots_frame(a, b, k).first()["dot"] or 0.0)


def param_dots_frame(a, b, k: int) -> DataFrame:
    parts = []
    for side, (fa, fb) in enumerate(zip(a, b)):
        j = fa.select("id", F.col("features").alias("x")).join(fb.select("id", F.col("features").alias("y")), "id")
        parts.append(j.select(dot("x", "y", k).alias("v")))
    return parts[0].unionByName(parts[1]).agg(F.sum("v").alias("dot"))


# ---------------------------------------------------------------- line polynomial
def _state(factors: DataFrame, direction: DataFrame) -> DataFrame:
    return factors.select("id", F.col("features").alias("x")).join(
        direction.select("id", F.col("features").alias("d")), "id")


def line_poly_frame(ratings: DataFrame, user_factors: DataFrame, item_factors: DataFrame,
                    d_user: DataFrame, d_item: DataFrame, k: int, lam: float,
                    normalizer: float = 1.0) -> DataFrame:
    """Coefficients c0..c4 with loss(x − a·d) = Σ cⱼ aʲ, exactly.

    e = α·β − y,  p = −(α·dβ + dα·β),  q = dα·dβ over rated cells;
    c0 = ½Σe² + ½λΣx², c1 = Σep − λΣx·d, c2 = ½Σ(p²+2eq) + ½λΣd², c3 = Σpq, c4 = ½Σq²
    (all divided by N).  One pass over the ratings replaces every trial
    evaluation of a line search.
    """
    us = _state(user_factors, d_user).select(F.col("id").alias("user"), F.col("x").alias("ua"),
                                             F.col("d").alias("ud"))
    it = _state(item_factors, d_item).select(F.col("id").alias("item"), F.col("x").alias("ib"),
                                             F.col("d").alias("id_"))
    j = ratings.select("user", "item", "rating").join(us, "user").join(it, "item")
    e = dot("ua", "ib", k) - F.col("rating")
    p = -(dot("ua", "id_", k) + dot("ud", "ib", k))
    q = dot("ud", "id_", k)
    rows = j.select(e.alias("e"), p.alias("p"), q.alias("q")).agg(
        F.sum(F.col("e") * F.col("e")).alias("ee"), F.sum(F.col("e") * F.col("p")).alias("ep"),
        F.sum(F.col("p") * F.col("p") + F.lit(2.0) * F.col("e") * F.col("q")).alias("pp2eq"),
        F.sum(F.col("p") * F.col("q")).alias("pq"), F.sum(F.col("q") * F.col("q")).alias("qq"))
    reg = []
    for st in (_state(user_factors, d_user), _state(item_factors, d_item)):
        reg.append(st.select(dot("x", "x", k).alias("xx"), dot("x", "d", k).alias("xd"),
                             dot("d", "d", k).alias("dd")))
    r = reg[0].unionByName(reg[1]).agg(F.sum("xx").alias("xx"), F.sum("xd").alias("xd"), F.sum("dd").alias("dd"))
    lam_c, inv = F.lit(float(lam)), F.lit(1.0 / float(normalizer))
    z = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    out = rows.unionByName(r, allowMissingColumns=True).agg(*[F.sum(c).alias(c) for c in
                                                               ("ee", "ep", "pp2eq", "pq", "qq", "xx", "xd", "dd")])
    return out.select(
        ((F.lit(0.5) * z("ee") + F.lit(0.5) * lam_c * z("xx")) * inv).alias("c0"),
        ((z("ep") - lam_c * z("xd")) * inv).alias("c1"),
        ((F.lit(0.5) * z("pp2eq") + F.lit(0.5) * lam_c * z("dd")) * inv).alias("c2"),
        (z("pq") * inv).alias("c3"),
        ((F.lit(0.5) * z("qq")) * inv).alias("c4"))


def line_poly(ratings, user_factors, item_factors, d_user, d_item, k, lam, normalizer=1.0):
    """A11 as five driver scalars."""
    row = line_poly_frame(ratings, user_factors, item_factors, d_user, d_item, k, lam, normalizer).first()
    return tuple(float(row[c]) for c in ("c0", "c1", "c2", "c3", "c4"))


def poly_eval(c, a: float) -> float:
    return (((c[4] * a + c[3]) * a + c[2]) * a + c[1]) * a + c[0]


def poly_slope(c, a: float) -> float:
    return ((4 * c[4] * a + 3 * c[3]) * a + 2 * c[2]) * a + c[1]
