"""The flagship query: library ALS on customer × part ratings, then the top-20
unseen parts for every customer, with part names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ratings import dims
from ..operators.recommend import recommend
from ..session import cut
from ..sources import tables as tb
from .als import fit_als_builtin


def flagship(spark: SparkSession, sf_dir: str, rank: int = 10, lam: float = 0.01, k: int = 20) -> DataFrame:
    ratings = cut(tb.ratings_from_orders(spark, sf_dir))
    d = dims(ratings)
    x = fit_als_builtin(ratings, rank=rank, lam=lam, n=d.n_users, m=d.n_items)
    requests = ratings.select(F.col("user").alias("req_pos"), "user").distinct()
    recs = recommend(x.uf, x.vf, ratings, requests, k=k, rank=rank, items=tb.items_from_parts(spark, sf_dir))
    return recs.select("req_pos", "user", "position", "item", F.round("score", 6).alias("score"), "name")
