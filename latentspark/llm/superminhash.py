"""Near-duplicate groups by SuperMinHash: signatures, banding, exact verification, union-find grouping.

A document's set holds its distinct 5-word shingles (A-Z lower-cased words; a
shorter text is one shingle, its whole word sequence).  SuperMinHash gives each
element one pseudo-random permutation of the signature slots: in step j an
element writes ``j + uniform`` into the slot its permutation puts at j.  Values
of step j lie in [j, j + 1), so a document is finished as soon as all its slots
are below j + 1: long documents stop after one or two steps.

Plan: equal sets collapse first (aggregate on a 128-bit set digest), so groups
of exact copies cost one row each from there on.  Every distinct set writes one
row per band; each band bucket links its members to its smallest one, and the
components of these candidate links are the places where links can exist.
Inside a component, links are tested on full shingle sets by a search that
takes a document, counts its intersections with all documents not yet reached
through an inverted index, and moves the linked ones to the reached side: no
pair is emitted, and every link that decides a group is exact.  A component of
more than ``block`` documents is dealt out as pairs of blocks, so no task holds
more than two blocks.

Edge cases: null or empty texts have an empty set, are linked with nothing and
form their own component; rows with a null doc_id take no part and come back
with a null component and kept false; rows that share a doc_id are one document,
their sets are linked; ties go to the smallest doc_id; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from latentspark.llm.common import (GOLDEN, batched, by_batch, components, fresh_name, hash_words, mix64, rows_of, runs,
                                    window_hash, word_list)
from latentspark.session import cut

#: Signature slots = BANDS * ROWS; at similarity 0.75 a pair shares no band with probability (1 - 0.75^5)^40 = 2e-5.
BANDS, ROWS, WIDTH = 40, 5, 5


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``width``-word shingles; one for the whole of a shorter text; none without words."""
    words = word_list(text)
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = hash_words(words)
    if len(h) < width:
        return mix64(window_hash(h, len(h)) ^ np.uint64(len(h)))
    return np.unique(window_hash(h, width))


def signatures(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """SuperMinHash signature (float64) of each non-empty set, all sets advanced step by step together."""
    n = len(sets)
    h = np.full(n * slots, np.inf)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    state = mix64(np.concatenate(sets) + GOLDEN) if n else np.zeros(0, np.uint64)
    order = np.tile(np.arange(slots, dtype=np.uint16), (len(state), 1))
    live = np.arange(len(state))
    for j in range(slots):
        state[live] += GOLDEN
        draw = mix64(state[live])
        # 32 bits choose the slot, the other 32 the fraction
        k = j + ((draw >> np.uint64(32)) * np.uint64(slots - j) >> np.uint64(32)).astype(np.int64)
        fraction = (draw & np.uint64(0xFFFFFFFF)).astype(np.float64) * 2.0 ** -32
        slot = order[live, k]
        order[live, k] = order[live, j]
        np.minimum.at(h, owner[live] * slots + slot, j + fraction)
        open_sets = h.reshape(n, slots).max(axis=1) >= j + 1
        live = live[open_sets[owner[live]]]
        if not len(live):
            break
    return h.reshape(n, slots)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band, the band's number included."""
    bits = np.ascontiguousarray(signature).view(np.uint64).reshape(-1, bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * GOLDEN, bits.shape[:2]).copy()
    for r in range(rows):
        key = mix64(key + GOLDEN) ^ bits[:, :, r]
    return mix64(key).view(np.int64)


SIGNED = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_hi", pa.int64()), ("set_lo", pa.int64()),
                    ("bands", pa.list_(pa.int64()))])


def sign(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, chunk: int = 50_000) -> DataFrame:
    """``docs(doc_id, text)`` → set size, 128-bit set digest and band keys; at most ``chunk`` shingles (or one text) at a time."""
    import hashlib

    def run(batches):
        def finish(held):
            full = [s for _, s in held if len(s)]
            keys = iter(band_keys(signatures(full, bands * rows), bands, rows)) if full else iter(())
            for doc_id, s in held:
                hi, lo = np.frombuffer(hashlib.md5(s.tobytes()).digest(), dtype=np.int64).tolist()
                yield doc_id, len(s), hi, lo, next(keys).tolist() if len(s) else None

        def out():
            held, size = [], 0
            for doc_id, text in rows_of(batches):
                s = shingles(text)
                held.append((doc_id, s))
                size += len(s)
                if size >= chunk or len(held) >= 4096:
                    yield from finish(held)
                    held, size = [], 0
            yield from finish(held)
        yield from batched(out(), SIGNED, 1024)

    return by_batch(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")), run, "doc_id long, n_shingles long, set_hi long, set_lo long, bands array<long>")


def linked_within(sets: list[np.ndarray]) -> list[int]:
    """For each set the smallest position that it reaches over links of 100 * |A ∩ B| >= 75 * |A ∪ B|, exactly."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    _, codes = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(n), sizes)
    spread = np.bincount(codes)
    common = spread[codes] > 1  # a shingle of one set alone counts in its size only
    ends = np.cumsum(np.bincount(owner[common], minlength=n))
    own_codes = codes[common]
    unseen = np.ones(n, dtype=bool)
    root = np.full(n, -1)

    def index():
        keep = common & unseen[owner]
        by = np.argsort(codes[keep], kind="stable")
        return owner[keep][by], np.concatenate([[0], np.cumsum(np.bincount(codes[keep], minlength=len(spread)))])

    posting, at = index()
    indexed = n
    for first in range(n):
        if not unseen[first]:
            continue
        unseen[first] = False
        root[first] = first
        todo = [first]
        while todo:
            x = todo.pop()
            left = int(unseen.sum())
            if not left:
                break
            if left < indexed // 2:  # the index only ever holds twice what is still unseen
                posting, at = index()
                indexed = left
            c = own_codes[(ends[x - 1] if x else 0):ends[x]]
            length = at[c + 1] - at[c]
            total = int(length.sum())
            if not total:
                continue
            where = np.repeat(at[c] - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(total)
            both = np.bincount(posting[where], minlength=n)
            hit = unseen & (both > 0) & (100 * both >= 75 * (sizes[x] + sizes - both))
            found = np.flatnonzero(hit)
            unseen[found] = False
            root[found] = first
            todo += found.tolist()
    return root.tolist()


def confirm(members: DataFrame, block: int) -> DataFrame:
    """Exact links ``u, v`` inside candidate components ``members(cluster, rep, text)``, a spanning star per reached group.

    A component within ``block`` members is one unit of work; a larger one
    becomes pairs of blocks (members dealt by hash), each holding two blocks.
    """
    sizes = members.groupBy("cluster").agg(F.count("*").alias("size"))
    n_blocks = F.ceil(F.col("size") / block).cast("int")
    units = (members.join(sizes, "cluster").withColumn("blocks", n_blocks)
             .withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(
                 F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: b != F.col("own")))))
             .select("cluster", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "rep", "text"))
    units = units.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "rep")

    def run(batches):
        def out():
            held = ((c, i, j, rep, shingles(text)) for c, i, j, rep, text in rows_of(batches))
            for _, group in runs(held, lambda r: r[:3]):
                if len(group) > 1:
                    for row, first in zip(group, linked_within([r[4] for r in group])):
                        if group[first][3] != row[3]:
                            yield row[3], group[first][3]
        yield from batched(out(), pa.schema([("u", pa.int64()), ("v", pa.int64())]))

    return by_batch(units, run, "u long, v long")


def near_duplicates(docs: DataFrame, *, bands: int = BANDS, rows: int = ROWS, block: int = 3000) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row of ``docs(doc_id, text)``."""
    docs = docs.select("doc_id", "text")
    signed = cut(sign(docs, bands, rows))
    known = signed.filter("doc_id IS NOT NULL AND n_shingles > 0")
    a_set = ["set_hi", "set_lo", "n_shingles"]
    # band keys are a function of the set, so any row's will do
    reps = cut(known.groupBy(*a_set).agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands")))
    buckets = reps.select("rep", F.explode("bands").alias("key"))
    least = buckets.groupBy("key").agg(F.min("rep").alias("low"), F.count("*").alias("n")).filter("n > 1").drop("n")
    candidates = buckets.join(least, "key").filter("rep <> low").select(F.col("rep").alias("u"), F.col("low").alias("v"))
    clusters = components(candidates)
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), "text").filter("node IS NOT NULL")
    # always a shuffle: what is linked has no proven bound, so it is never broadcast
    members = texts.join(clusters.hint("merge"), "node").select(F.col("root").alias("cluster"), F.col("node").alias("rep"), "text")
    # rows under one doc_id with different sets are one document: their sets belong together
    several = known.groupBy("doc_id").agg(F.min("set_hi").alias("a"), F.max("set_hi").alias("b")).filter("a <> b").select("doc_id")
    same_id = known.join(several, "doc_id").join(reps, a_set).select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))
    groups = components(confirm(members, block).union(same_id))
    out = (signed.select("doc_id", *a_set).join(reps.drop("bands"), a_set, "left")
           .join(groups.select(F.col("node").alias("rep"), "root"), "rep", "left"))
    component = F.when(F.col("n_shingles") > 0, F.coalesce("root", "rep")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """Rows of ``docs`` whose doc_id is the smallest of its group, columns unchanged; repeated rows of it stay.

    A row with a null doc_id is a document of its own here, behind all that have one.
    """
    key = fresh_name(docs, "kept_id")
    given = docs.withColumn(key, F.col("doc_id").cast("long"))
    if given.filter(F.col(key).isNull()).limit(1).count():
        last = given.agg(F.max(key)).first()[0] or 0
        given = cut(given.withColumn(key, F.coalesce(F.col(key), F.lit(last + 1) + F.monotonically_increasing_id())))
    verdict = near_duplicates(given.select(F.col(key).alias("doc_id"), "text"), **options).filter("kept")
    return given.join(verdict.select(F.col("doc_id").alias(key)).distinct(), key, "left_semi").drop(key)
