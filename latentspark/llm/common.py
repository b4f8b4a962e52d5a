"""Small helpers shared by the operators: tables, text bytes, hashing, row streams, cluster components."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from latentspark.session import cut

# Odd 64-bit multipliers of the mixing functions below.
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Arrow batches hold at most this many bytes unless the session sets another bound than Spark's 64 MB: whole texts
#: can be long, and a task holds a batch several times over (JVM buffers, Arrow, Python).
BATCH_BYTES = 4 << 20
BATCH_KEY, SPARK_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864"


def by_batch(df: DataFrame, fn, schema) -> DataFrame:
    """``mapInArrow`` with batches bounded by bytes (a session setting, left alone where the user has chosen one)."""
    conf = df.sparkSession.conf
    if str(conf.get(BATCH_KEY, SPARK_DEFAULT)).rstrip("b") == SPARK_DEFAULT:
        conf.set(BATCH_KEY, str(BATCH_BYTES))
    return df.mapInArrow(fn, schema)


def hash_sample(df: DataFrame, key: str, limit: int, seed: int = 0) -> DataFrame:
    """At most ``limit`` rows of ``df``, those with the smallest hash of ``key`` (column ``deal``); narrow rows only.

    A first cut by the expected share keeps what meets in the last task near ``limit`` whatever the input.
    """
    share = min(1.0, (1.2 * limit + 1000) / max(df.count(), 1))
    deal = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1 << 40))
    found = df.withColumn("deal", deal).filter(F.col("deal") < F.lit(int(share * (1 << 40))))
    return found.orderBy("deal", *[c for c in df.columns]).limit(limit)


def text_bytes(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def word_list(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; ``bytes.split`` cuts at exactly those six bytes."""
    return text_bytes(text).lower().split()


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


def hash_words(words: list[bytes]) -> np.ndarray:
    """64-bit keyed hash of each word, the same in every process."""
    from pandas.util import hash_array
    if not words:
        return np.zeros(0, dtype=np.uint64)
    return hash_array(np.array(words, dtype=object), categorize=False)


def window_hash(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width`` consecutive values of ``h``, order included."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = h[:n].copy()
    for j in range(1, width):
        out = mix64(out + GOLDEN) ^ h[j:j + n]
    return mix64(out)


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples, one batch in memory at a time."""
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        yield from zip(*columns)


def batched(rows: Iterable[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Arrow batches of ``size`` rows from tuples."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def runs(rows: Iterable[tuple], key: Callable[[tuple], object]) -> Iterator[tuple[object, list[tuple]]]:
    """Groups of consecutive rows with equal key (the input is sorted by it)."""
    held, last = [], None
    for row in rows:
        k = key(row)
        if held and k != last:
            yield last, held
            held = []
        last = k
        held.append(row)
    if held:
        yield last, held


def numbered(docs: DataFrame) -> tuple[DataFrame, str | None]:
    """``doc_id, text`` with a unique doc_id: as given, or row numbers by (doc_id, text) beside the given one in ``own_id``."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    several = d.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1 OR doc_id IS NULL").limit(1).count()
    if not several:
        return d, None
    ranged = cut(d.repartitionByRange("doc_id", F.xxhash64("text")).withColumn("part", F.spark_partition_id()))
    sizes = {r["part"]: r["n"] for r in ranged.groupBy("part").agg(F.count("*").alias("n")).collect()}
    before, total = [], 0
    for p in sorted(sizes):
        before.append((p, total))
        total += sizes[p]
    offsets = docs.sparkSession.createDataFrame(before, "part int, before long")
    place = F.row_number().over(Window.partitionBy("part").orderBy("doc_id", F.xxhash64("text"), "text"))
    out = ranged.withColumn("place", place).join(F.broadcast(offsets), "part").select(
        (F.col("before") + F.col("place")).alias("doc_id"), "text", F.col("doc_id").alias("own_id"))
    return cut(out), "own_id"


def components(edges: DataFrame, max_rounds: int | None = None) -> DataFrame:
    """Connected components of undirected ``edges(u, v)``: ``node, root`` with the smallest node as root.

    Alternating large-star and small-star rounds, each one aggregate of the
    smallest neighbour and one join back, so a node of any degree is
    pre-aggregated and its rows can be split by AQE.  Every round is a written
    table in the checkpoint folder; only counts reach the driver.  Nodes
    without an edge, null ends and loops are absent from the result.
    """
    e = (edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
         .filter("u IS NOT NULL AND v IS NOT NULL AND u <> v").distinct())
    e = cut(e)
    seen, done = None, 0
    while True:
        # every neighbour above u moves to u's smallest neighbour
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        # every neighbour below u, and u, move to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        e = cut(small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
                .filter("u <> v").distinct())
        row = e.agg(F.count("*").alias("n"), F.count_distinct("u").alias("k"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        done += 1
        if row["n"] == row["k"] and (row["n"], row["s"]) == seen or max_rounds and done >= max_rounds:
            break
        seen = (row["n"], row["s"])
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.union(stars.select(F.col("root").alias("node"), "root").distinct())
