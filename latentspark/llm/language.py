"""Language identification: sparse softmax regression on TF-IDF character n-grams.

1. ``document_frequencies``: in how many training documents each hashed n-gram
   occurs; one pass over all of them, summed inside each task.
2. ``fit_languages``: a bounded sample of labelled documents (per language those
   with the smallest hash of the id) becomes sparse TF-IDF rows on the
   executors; follow-the-regularised-leader (FTRL-proximal, elastic net) learns
   the weights in small batches, and a temperature is fitted on a fifth of the
   sample that training never saw.
3. ``identify``: one pass, no shuffle, whole texts.

A text is lower-cased, every stretch of other than letters becomes one space,
and n-grams of 1 to 4 characters are taken over the result, a space at both
ends.  Weight of a gram: (1 + log count) * idf, rows scaled to length 1.

Edge cases: a null text, or one without a letter, is ``und`` with score 0;
documents with a null id, text or language, or without a letter, teach
nothing; with one language in the training rows every text with a letter gets
it (score 1), with none every text is ``und``; rows repeating a doc_id are
judged each on its own; only ``text`` is read for a prediction, and columns
named like the result struct keep their values (a free name is needed, see
``fresh_name``); an empty table gives no rows.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from latentspark.llm.common import by_batch

#: Buckets of n-grams: all values of 16 bits.
BUCKETS = 1 << 16
ORDERS = (1, 2, 3, 4)
UNKNOWN = "und"
SPACE = np.uint32(32)
SCRAMBLE = np.uint32(0x9E3779B1)
#: 1 + log of a count; counts beyond the table weigh as its last.
LOGS = 1 + np.log(np.maximum(np.arange(1 << 16), 1))


def learnable(doc_id: Column) -> Column:
    """True where the crc32 of the id as text leaves another remainder than 1 by 3 (false for null ids)."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) != 1, F.lit(False))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


@cache
def letters() -> np.ndarray:
    """One flag per code point: a letter (made once in each Python process)."""
    return np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), dtype=bool, count=sys.maxunicode + 1)


def grams(text: str | None) -> np.ndarray:
    """Buckets of all character n-grams of a text, repeats included; empty if it has no letter."""
    if not text:
        return np.zeros(0, dtype=np.uint16)
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    known = letters()[points]
    if not known.any():
        return np.zeros(0, dtype=np.uint16)
    # of a stretch of other characters the first stays, as a space
    stay = known.copy()
    stay[1:] |= known[:-1]
    stay[0] = True
    line = np.where(known, points, SPACE)[stay]
    line = np.pad(line, (int(line[0] != SPACE), int(line[-1] != SPACE)), constant_values=SPACE)
    h, found = np.zeros(len(line), dtype=np.uint32), []
    for n in range(1, ORDERS[-1] + 1):
        if len(line) < n:
            break
        h = (h[:len(line) - n + 1] ^ line[n - 1:]) * SCRAMBLE
        h ^= h >> np.uint32(15)
        if n in ORDERS:
            found.append(((h * SCRAMBLE) >> np.uint32(16)).astype(np.uint16))
    return np.concatenate(found)


def term_weights(buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets in order, and 1 + log of how often each occurs."""
    line = np.sort(buckets, kind="stable")  # radix sort of 16-bit values
    first = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]]))
    return line[first].astype(np.int64), LOGS[np.minimum(np.diff(np.append(first, len(line))), len(LOGS) - 1)]


def document_frequencies(docs: DataFrame, text: str = "text") -> tuple[int, np.ndarray]:
    """Documents with a letter, and how many of them hold each bucket; at most ``BUCKETS`` + 1 rows reach the driver."""
    def run(batches):
        seen, n = np.zeros(BUCKETS, dtype=np.int64), 0
        for batch in batches:
            for t in batch.column(0):
                g = grams(t.as_py())
                if len(g):
                    flags = np.zeros(BUCKETS, dtype=bool)
                    flags[g] = True
                    seen += flags
                    n += 1
        at = np.flatnonzero(seen)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(seen[at], n))], names=["bucket", "n"])

    rows = by_batch(docs.select(text), run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    total, out = 0, np.zeros(BUCKETS, dtype=np.int64)
    for b, n in zip(rows["bucket"], rows["n"]):
        if b < 0:
            total = int(n)
        else:
            out[b] = n
    return total, out


@dataclass
class Languages:
    """Names in order, ``idf`` per bucket, ``weights`` (buckets, languages), ``bias``, ``temperature``."""
    names: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, buckets: np.ndarray) -> np.ndarray:
        at, x = term_weights(buckets)
        x = x * self.idf[at]
        return (x / max(np.sqrt(x @ x), 1e-12)) @ self.weights[at] + self.bias

    def judge(self, text: str | None) -> tuple[str, float]:
        """Language and calibrated probability of a text; ties go to the first name."""
        g = grams(text)
        if not len(g) or not self.names:
            return UNKNOWN, 0.0
        p = softmax(self.logits(g)[None, :] / self.temperature)[0]
        k = int(np.argmax(p))
        return self.names[k], float(p[k])


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


class FollowTheLeader:
    """FTRL-proximal with elastic net for a softmax: per weight the sum of shifted gradients ``z`` and of squares ``n``.

    A weight is 0 until its ``|z|`` passes ``l1``, so what tells no language apart stays out of the model.
    """

    def __init__(self, rows: int, k: int, *, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.5):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros((rows, k)), np.zeros((rows, k))

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) > self.l1, w, 0.0)

    def learn(self, at: np.ndarray, x: np.ndarray, y: np.ndarray) -> float:
        """One step on the rows ``x`` (rows, len(at)) with one-hot ``y``; the last row of the model is the bias.  Mean loss."""
        at = np.append(at, len(self.z) - 1)
        x = np.hstack([x, np.ones((len(x), 1))])
        w = self.weights(at)
        p = softmax(x @ w)
        g = x.T @ (p - y)
        square = self.n[at] + g * g
        self.z[at] += g - (np.sqrt(square) - np.sqrt(self.n[at])) / self.alpha * w
        self.n[at] = square
        return float(-np.log(np.maximum((p * y).sum(axis=1), 1e-300)).mean())


def fit_temperature(z: np.ndarray, y: np.ndarray) -> float:
    """Temperature in [0.05, 20] with the least negative log likelihood of classes ``y`` (golden section over its logarithm)."""
    if not len(z):
        return 1.0
    rows = np.arange(len(z))

    def loss(log_t):
        s = z / np.exp(log_t)
        top = s.max(axis=1)
        return float((np.log(np.exp(s - top[:, None]).sum(axis=1)) + top - s[rows, y]).mean())

    lo, hi, r = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    a, b = hi - r * (hi - lo), lo + r * (hi - lo)
    fa, fb = loss(a), loss(b)
    for _ in range(40):
        if fa <= fb:
            hi, b, fb = b, a, fa
            a = hi - r * (hi - lo)
            fa = loss(a)
        else:
            lo, a, fa = a, b, fb
            b = lo + r * (hi - lo)
            fb = loss(b)
    return float(np.exp((lo + hi) / 2))


def labelled_sample(docs: DataFrame, per_language: int, seed: int = 3) -> DataFrame:
    """``deal, doc_id, lang, text``: per language at most ``per_language`` rows, those with the smallest hash of the id."""
    deal = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(seed)), F.lit(1 << 40))
    sizes = {r["lang"]: r["n"] for r in docs.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    chosen = F
    for lang in sorted(sizes):
        share = min(1.0, (1.2 * per_language + 100) / sizes[lang])
        chosen = chosen.when(F.col("lang") == lang, F.lit(int(share * (1 << 40))))
    if not sizes:
        return docs.withColumn("deal", deal).select("deal", "doc_id", "lang", "text")
    # narrow rows first: at most about 1.2 * per_language ids of a language meet in one task
    ids = docs.select("doc_id", "lang", deal.alias("deal")).filter(F.col("deal") < chosen.otherwise(F.lit(0)))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("deal", "doc_id"))
    last = (ids.withColumn("place", place).filter(F.col("place") <= per_language)
            .groupBy("lang").agg(F.max("deal").alias("last")))
    limits = F
    for r in last.collect():
        limits = limits.when(F.col("lang") == r["lang"], F.lit(r["last"]))
    return docs.withColumn("deal", deal).filter(F.col("deal") <= limits.otherwise(F.lit(-1))).select("deal", "doc_id", "lang", "text")


def fit_languages(docs: DataFrame, *, per_language: int = 2000, batch: int = 64, epochs: int = 3, seed: int = 7,
                  **options) -> Languages:
    """The classifier of ``docs`` (doc_id, text, lang): all its rows count for the document frequencies.

    The one sample: ``per_language`` rows of each language, whole texts, as sparse rows of distinct buckets.
    """
    docs = docs.select("doc_id", "text", "lang").filter("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL")
    total, df = document_frequencies(docs)
    idf = np.log((1 + total) / (1 + df)) + 1

    def run(batches):
        for b in batches:
            keep, ats, xs = [], [], []
            for i, t in enumerate(b.column(3)):
                g = grams(t.as_py())
                if len(g):
                    at, x = term_weights(g)
                    keep.append(i)
                    ats.append(at.astype(np.int32))
                    xs.append(x.astype(np.float32))
            small = pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2)], names=["deal", "doc_id", "lang"]).take(
                pa.array(keep, type=pa.int32()))
            yield pa.RecordBatch.from_arrays([*small.columns, pa.array(ats, type=pa.list_(pa.int32())), pa.array(xs, type=pa.list_(pa.float32()))],
                                             names=["deal", "doc_id", "lang", "at", "x"])

    # the sample stays in flat Arrow buffers: 8 bytes for each distinct bucket of a row
    sample = by_batch(labelled_sample(docs, per_language), run, "deal long, doc_id long, lang string, at array<int>, x array<float>").toArrow()
    langs = sample.column("lang").to_pylist()
    names = sorted(set(langs))
    if not names:
        return Languages([], idf, np.zeros((BUCKETS, 0)), np.zeros(0))
    buckets = sample.column("at").combine_chunks()
    begin, buckets = buckets.offsets.to_numpy(), buckets.values.to_numpy()
    counts = sample.column("x").combine_chunks().values.to_numpy()
    # rows that share a doc_id (and so a hash) are ordered by what they hold
    order = np.lexsort((np.add.reduceat(counts, begin[:-1]), np.searchsorted(names, langs), sample.column("doc_id").to_numpy(),
                        sample.column("deal").to_numpy()))
    y = np.searchsorted(names, langs)[order]

    def row(i: int) -> tuple[np.ndarray, np.ndarray]:
        """Buckets and weights of the i-th row, of length 1."""
        part = slice(begin[order[i]], begin[order[i] + 1])
        x = counts[part].astype(np.float64) * idf[buckets[part]]
        return buckets[part], x / np.sqrt(x @ x)

    # every fifth row of a language calibrates, if there are enough of them
    nth = np.zeros(len(y), dtype=np.int64)
    for k in range(len(names)):
        nth[y == k] = np.arange((y == k).sum())
    calibrates = (nth % 5 == 4) if len(y) >= 20 else np.zeros(len(y), dtype=bool)
    taught = np.flatnonzero(~calibrates)
    leader = FollowTheLeader(BUCKETS + 1, len(names), **options)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        shuffled = rng.permutation(taught)
        for lo in range(0, len(shuffled), batch):
            part = shuffled[lo:lo + batch]
            rows = [row(i) for i in part]
            at = np.unique(np.concatenate([r[0] for r in rows]))
            x = np.zeros((len(part), len(at)))
            for r, (where, weights) in enumerate(rows):
                x[r, np.searchsorted(at, where)] = weights
            one = np.zeros((len(part), len(names)))
            one[np.arange(len(part)), y[part]] = 1
            leader.learn(at, x, one)
    w = leader.weights()
    model = Languages(names, idf, w[:-1], w[-1])
    check = np.flatnonzero(calibrates)
    z = np.stack([weights @ model.weights[where] + model.bias for where, weights in map(row, check)]) if len(check) else np.zeros((0, len(names)))
    model.temperature = fit_temperature(z, y[check])
    return model


STRUCT = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])


def identify(docs: DataFrame, model: Languages, text: str = "text", into: str = "language") -> DataFrame:
    """``docs`` with one struct column ``into`` (lang, score); the model (buckets x languages numbers) is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64())])

    def run(batches):
        for batch in batches:
            found = [dict(zip(("lang", "score"), shared.value.judge(t.as_py()))) for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, type=kind)], names=[*batch.schema.names, into])

    return by_batch(docs, run, T.StructType([*docs.schema.fields, T.StructField(into, STRUCT)]))
