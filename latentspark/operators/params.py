"""Parameter sets: (user factors, item factors) pairs and their long form.

The flat parameter vector of the reference (all user columns, then all item
columns, column-major) is represented as rows ``(pos, side, id, k, value)``
with ``pos = id·rank + k`` for users and ``n·rank + id·rank + k`` for items;
positions are computed per row, no global sort is needed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vectors import gaussian_vector, vec_scale
from ..session import cut, drop_cut


@dataclass
class Params:
    """A point of the factorisation problem: two ``(id, features)`` frames, and the table they were cut to, if any."""
    uf: DataFrame
    vf: DataFrame
    whole: DataFrame | None = None

    @classmethod
    def of_table(cls, table: DataFrame) -> "Params":
        """From ``(side, id, features)``; side 0 are the users, side 1 the items, other sides are ignored."""
        side = lambda s: table.filter(F.col("side") == s).select("id", "features")
        return cls(side(0), side(1), table)

    def sides(self):
        return (self.uf, self.vf)

    def table(self) -> DataFrame:
        """Both sides as ``(side, id, features)``."""
        if self.whole is not None:
            return self.whole.filter(F.col("side") >= 0).select("side", "id", "features")
        one = lambda f, s: f.select(F.lit(s).alias("side"), F.col("id").cast("long").alias("id"), "features")
        return one(self.uf, 0).unionByName(one(self.vf, 1))

    def cut(self) -> "Params":
        """Both sides as one written table: one job, and lineage starts there."""
        return Params.of_table(cut(self.table()))

    def drop(self) -> None:
        """Delete the table behind this point; only for points that nothing reads any more."""
        drop_cut(self.whole)


def lin_comb(a: Params, ca: float, b: Params, cb: float) -> Params:
    """V2 / V4 over whole parameter sets: ``ca·a + cb·b``, one join by (side, id)."""
    j = a.table().join(b.table().select("side", "id", F.col("features").alias("b")), ["side", "id"])
    return Params.of_table(j.select("side", "id", F.zip_with(
        "features", "b", lambda p, q: F.lit(float(ca)) * p + F.lit(float(cb)) * q).alias("features")))


def move(p: Params, d: Params, z: float) -> Params:
    """V2 over a whole parameter set: ``p + z·d``."""
    return lin_comb(p, 1.0, d, z)


def scale(p: Params, c: float) -> Params:
    """V4 over a parameter set."""
    return Params.of_table(p.table().select("side", "id", vec_scale("features", c).alias("features")))


def gaussian_factors(spark: SparkSession, n: int, k: int, seed: int, stddev: float = 1.0,
                     salt: int = 0) -> DataFrame:
    """V7: N(0, stddev²) factors for ids 0..n-1 from a hash of (id, k, seed).

    Independent of partitioning and of executor loss (a recomputed partition
    gives the same numbers, unlike ``randn``).
    """
    ids = spark.range(n).select(F.col("id").cast("long").alias("id"))
    return ids.select("id", gaussian_vector(F.col("id"), k, seed * 1000003 + salt, stddev).alias("features"))


def init_params(spark: SparkSession, n: int, m: int, k: int, seed: int = 8, stddev: float = 1.0) -> Params:
    return Params(gaussian_factors(spark, n, k, seed, stddev, salt=1),
                  gaussian_factors(spark, m, k, seed, stddev, salt=2))


def flatten_params(uf: DataFrame, vf: DataFrame, n: int, k: int) -> DataFrame:
    """V5: ``(pos, side, id, k, value)``; users first, then items."""
    def side(f, name, offset):
        e = f.select("id", F.posexplode("features").alias("k", "value"))
        return e.select((F.lit(offset) + F.col("id").cast("long") * F.lit(k) + F.col("k")).alias("pos"),
                        F.lit(name).alias("side"), F.col("id").cast("long").alias("id"),
                        F.col("k").cast("int").alias("k"), "value")
    return side(uf, "user", 0).unionByName(side(vf, "item", n * k))


def unflatten_params(params: DataFrame, n: int, m: int) -> tuple[DataFrame, DataFrame, int]:
    """V6: rank = length/(n+m); positions below n·rank are users.

    Rebuilds ``(id, features)`` per side from ``(pos, value)`` only, one
    bounded group (rank values) per id.
    """
    total = params.count()
    rank = total // (n + m) if (n + m) else 0
    split = n * rank
    p = params.select("pos", "value")
    is_user = F.col("pos") < F.lit(split)
    rel = F.when(is_user, F.col("pos")).otherwise(F.col("pos") - F.lit(split))
    e = p.select(is_user.alias("is_user"), F.floor(rel / F.lit(rank)).cast("long").alias("id"),
                 (rel % F.lit(rank)).cast("int").alias("k"), "value")
    g = (e.groupBy("is_user", "id")
         .agg(F.array_sort(F.collect_list(F.struct("k", "value"))).alias("kv"))
         .select("is_user", "id", F.transform("kv", lambda s: s["value"]).alias("features")))
    return (g.filter("is_user").select("id", "features"), g.filter(~F.col("is_user")).select("id", "features"), rank)
