"""Synthetic low-rank ratings (for tests and demos).

Rating of cell (u, i) = Σⱼ g(u, j)·h(i, j) with hash-seeded Gaussians g, h,
computed inline per cell: cells come from one ``range`` (no join), factors
are functions of the ids, so any partition can be recomputed alone.  A cell
is kept with probability ``density`` (hash of the cell and the seed).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vectors import gaussian, unit_uniform


def low_rank_ratings(spark: SparkSession, n: int, m: int, rank: int, density: float = 1.0,
                     seed: int = 8, stddev: float = 1.0) -> DataFrame:
    cells = spark.range(n * m).select(F.floor(F.col("id") / F.lit(m)).alias("user"),
                                      (F.col("id") % F.lit(m)).alias("item"))
    r = None
    for j in range(rank):
        t = gaussian(F.col("user"), j, seed * 7919 + 1, stddev) * gaussian(F.col("item"), j, seed * 7919 + 2, stddev)
        r = t if r is None else r + t
    out = cells.select("user", "item", r.alias("rating"))
    if density < 1.0:
        out = out.filter(unit_uniform(F.col("user"), F.col("item"), F.lit(seed)) < F.lit(float(density)))
    return out
