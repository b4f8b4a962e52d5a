"""Rating, title and pixel views derived from the driver's parquet tables.

These are the inputs of every registered query.  The derivations are fixed
(they define what the oracle SQL computes as well):

* ``r_ord``  – (user = o_custkey, item = l_partkey) over lineitem ⋈ orders,
  rating = 1 + (Σ l_quantity) mod 5.
* ``r_ev``   – (user = user_id, item = the number inside ``props``) over
  events, rating = least(5, greatest(1, avg(value) / 5)).
* ``items``  – (item = p_partkey, name = p_name).
* ``pixels`` – (image_id = l_orderkey, x = l_linenumber, y = l_partkey, px =
  (l_partkey·2654435761 + l_orderkey·40503) mod 2^32 as a signed number; line 7 grey).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ratings_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``r_ord``: one rating per (customer, part); pre-aggregated before the join's output grows."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .groupBy(F.col("o_custkey").cast("long").alias("user"),
                     F.col("l_partkey").cast("long").alias("item"))
            .agg(F.sum("l_quantity").alias("q"))
            .select("user", "item",
                    (F.lit(1) + F.col("q").cast("int") % F.lit(5)).cast("double").alias("rating")))


def rating_lines_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw (user, item, rating, ord) lines, one per lineitem, with duplicates.

    ``ord`` = l_orderkey·8 + l_linenumber orders the lines as they would
    arrive; several lines share a (user, item) pair (Q3).
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .select(F.col("o_custkey").cast("long").alias("user"),
                    F.col("l_partkey").cast("long").alias("item"),
                    (F.lit(1) + F.col("l_quantity").cast("int") % F.lit(5)).cast("double").alias("rating"),
                    (F.col("l_orderkey") * F.lit(8) + F.col("l_linenumber")).alias("ord")))


def ratings_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``r_ev``: (user_id, k in props) → clipped mean value / 5."""
    ev = table(spark, sf_dir, "events").select("user_id", "props", "value")
    return (ev.groupBy(F.col("user_id").cast("long").alias("user"),
                       F.regexp_extract("props", r"([0-9]+)", 1).cast("long").alias("item"))
            .agg(F.avg("value").alias("v"))
            .select("user", "item",
                    F.least(F.lit(5.0), F.greatest(F.lit(1.0), F.col("v") / F.lit(5.0))).alias("rating")))


def items_from_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").cast("long").alias("item"),
                                               F.col("p_name").alias("name"))


def pixels_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 32 bits occur; the seventh line of an order is a grey pixel with its own alpha."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    grey = (F.col("l_partkey") % 256) * F.lit(65793) + (F.col("l_suppkey") % 256) * F.lit(16777216)
    full = (F.col("l_partkey") * F.lit(2654435761) + F.col("l_orderkey") * F.lit(40503)) % F.lit(4294967296)
    w = F.when(F.col("l_linenumber") == 7, grey).otherwise(full)
    px = F.when(w >= 2147483648, w - F.lit(4294967296)).otherwise(w)
    return li.select(F.col("l_orderkey").alias("image_id"), F.col("l_linenumber").cast("int").alias("x"),
                     F.col("l_partkey").cast("int").alias("y"), px.cast("int").alias("px"))


# The deterministic rank-2 factors used by the oracle queries.
#   user: f0 = ((id*31+17) % 97)/97 + 0.1,  f1 = ((id*53+29) % 89)/89 + 0.1
#   item: f0 = ((id*37+19) % 83)/83 + 0.1,  f1 = ((id*41+23) % 79)/79 + 0.1
DET_USER = ((31, 17, 97), (53, 29, 89))
DET_ITEM = ((37, 19, 83), (41, 23, 79))


def det_component(id_col, a: int, b: int, m: int):
    return ((id_col * F.lit(a) + F.lit(b)) % F.lit(m)).cast("double") / F.lit(float(m)) + F.lit(0.1)


def det_factors(ids: DataFrame, id_col: str, side: str) -> DataFrame:
    """Rank-2 deterministic factors for the distinct ids of ``ids[id_col]``."""
    spec = DET_USER if side == "user" else DET_ITEM
    i = F.col("id")
    return (ids.select(F.col(id_col).cast("long").alias("id")).distinct()
            .select("id", F.array(*[det_component(i, a, b, m) for a, b, m in spec]).alias("features")))


def det_model(ratings: DataFrame):
    """(user_factors, item_factors) for every id that occurs in ``ratings``."""
    return det_factors(ratings, "user", "user"), det_factors(ratings, "item", "item")
