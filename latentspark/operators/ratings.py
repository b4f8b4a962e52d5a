"""Rating-table operators: sizes, rated sets, de-duplication, factor padding, joins.

Ratings are long-form ``(user BIGINT, item BIGINT, rating DOUBLE)``; a rated cell is
a present row, an unrated cell an absent one (the dense masks of the
reference are never formed).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import dot, zeros


@dataclass(frozen=True)
class Dims:
    n_users: int
    n_items: int
    n_ratings: int


def dims(ratings: DataFrame, user: str = "user", item: str = "item") -> Dims:
    """A1/A2: max id + 1 per side and the rating count, in one job."""
    row = ratings.agg((F.max(user) + 1).alias("n"), (F.max(item) + 1).alias("m"),
                      F.count(F.lit(1)).alias("c")).first()
    return Dims(int(row["n"] or 0), int(row["m"] or 0), int(row["c"]))


def dims_frame(ratings: DataFrame, user: str = "user", item: str = "item") -> DataFrame:
    """A1/A2 as a one-row DataFrame (n_users, n_items, n_ratings)."""
    return ratings.agg((F.max(user) + 1).alias("n_users"), (F.max(item) + 1).alias("n_items"),
                       F.count(F.lit(1)).alias("n_ratings"))


def rated_items(ratings: DataFrame, user: str = "user", item: str = "item",
                chunk: int = 4096) -> DataFrame:
    """A3: sorted distinct items per user, as ``(user, chunk, items)``.

    Items are grouped in id ranges of ``chunk`` (chunk = item div ``chunk``),
    so no array holds more than ``chunk`` ids however many items one user
    rated; a user with few ratings has one row.  Distinct pairs are formed
    first (partial aggregation before the shuffle).
    """
    return (ratings.select(user, item).distinct()
            .groupBy(user, F.floor(F.col(item) / F.lit(chunk)).alias("chunk"))
            .agg(F.sort_array(F.collect_list(item)).alias("items")))


def seen_pairs(ratings: DataFrame, user: str = "user", item: str = "item") -> DataFrame:
    """Distinct (user, item) pairs; the form used by anti-joins."""
    return ratings.select(user, item).distinct()


def dedupe_ratings(lines: DataFrame, order: str = "ord", with_count: bool = False) -> DataFrame:
    """Q3: one rating per (user, item); the line with the largest ``order`` wins
    (equal orders: the larger rating, so the result is deterministic).  ``with_count`` adds ``n_lines``."""
    n = [F.count(F.lit(1)).alias("n_lines")] if with_count else []
    return (lines.groupBy("user", "item")
            .agg(F.max_by("rating", F.struct(order, "rating")).alias("rating"), *n))


def cells(ratings: DataFrame) -> DataFrame:
    """One row per (user, item), ids as BIGINT: the last line by the column ``ord`` if there is one (Q3), else the
    largest rating of the lines."""
    r = ratings if "ord" in ratings.columns else ratings.withColumn("ord", F.lit(0))
    return dedupe_ratings(r.select(F.col("user").cast("long").alias("user"), F.col("item").cast("long").alias("item"),
                                   F.col("rating").cast("double").alias("rating"), "ord"))


def restrict(ratings: DataFrame, max_user: int, max_item: int) -> DataFrame:
    """Keep ``item <= max_item AND user <= max_user`` (pushed to the scan)."""
    return ratings.filter((F.col("item") <= max_item) & (F.col("user") <= max_user))


def pad_factors(factors: DataFrame, n: int, k: int) -> DataFrame:
    """Factors for every id in ``0 .. n-1``; missing ids get zeros (Q2, Q14).

    A range left join: the id list is generated on the executors, never
    collected.
    """
    spark = factors.sparkSession
    ids = spark.range(n).select(F.col("id").cast("long").alias("id"))
    f = factors.select(F.col("id").cast("long").alias("id"),
                       F.col("features").cast("array<double>").alias("features"))
    return (ids.join(f, "id", "left")
            .select("id", F.coalesce(F.col("features"), zeros(k)).alias("features")))


def missing_ids(factors: DataFrame, n: int) -> DataFrame:
    """Ids of ``0 .. n-1`` that have no factor row."""
    spark = factors.sparkSession
    ids = spark.range(n).select(F.col("id").cast("long").alias("id"))
    return ids.join(factors.select(F.col("id").cast("long").alias("id")).distinct(), "id", "left_anti")


def with_factors(ratings: DataFrame, user_factors: DataFrame, item_factors: DataFrame) -> DataFrame:
    """Attach ``uf`` (user vector) and ``vf`` (item vector) to each rating.

    Plain equi-joins; AQE broadcasts a factor side only when its measured size
    is under the broadcast threshold, otherwise sort-merge.
    """
    uf = user_factors.select(F.col("id").alias("user"), F.col("features").alias("uf"))
    vf = item_factors.select(F.col("id").alias("item"), F.col("features").alias("vf"))
    return ratings.join(uf, "user").join(vf, "item")


def residuals(ratings: DataFrame, user_factors: DataFrame, item_factors: DataFrame, k: int) -> DataFrame:
    """Prediction αᵤ·βᵢ and residual y − μ over rated cells only."""
    j = with_factors(ratings, user_factors, item_factors)
    pred = dot("uf", "vf", k)
    return j.select("user", "item", "rating", pred.alias("pred"), (F.col("rating") - pred).alias("resid"))


def predict(pairs: DataFrame, user_factors: DataFrame, item_factors: DataFrame, k: int) -> DataFrame:
    """R2: predicted score for the given (user, item) pairs."""
    j = with_factors(pairs.select("user", "item"), user_factors, item_factors)
    return j.select("user", "item", dot("uf", "vf", k).alias("pred"))

