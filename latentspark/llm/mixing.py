"""Mixing to target weights over soft domain memberships.

1. ``fit_domains``: a softmax regression over the words that tell the labelled
   domains apart (chi-square of presence), from at most ``max_fit_rows``
   labelled documents.
2. ``memberships``: posteriors of every document, on a grid of 1/``GRID``, and
   its tokens; one pass.
3. ``fit_rates``: nonnegative rates r_d whose expected domain tokens
   sum_d r_d t_d p_dk come closest to the targets in least squares, by
   projected gradient with momentum from r = 1.  Documents with the same posteriors have the
   same rate at every step, so the unknowns are first summed by posterior (one
   aggregate; at most GRID^(K-1) rows whatever the input), and each step is one
   Spark job over that table that returns K sums.  A rate is a function of the
   posteriors and the list of past gradients: nothing is kept per document, and
   a lost executor recomputes only what it held.

The gradient is taken in the metric weighted by tokens, so rates depend on the
posteriors alone and a very long document is no outlier.

Edge cases: a null or empty text has 0 tokens and the posteriors of the
regression's bias; labels without document or with nulls are not used; a
domain without labels has posterior 0, and the weights of the others are
scaled up to 1; without any usable label every document is wholly of the first
domain; an empty table gives no rows; ties in the label sample go by id.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from latentspark.llm.common import by_batch, fresh_name, hash_sample, hash_words, word_list
from latentspark.session import cut

GRID = 1000
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Domains by the labels table, and the default shares of the mix.
DOMAINS = ("good", "poor", "toxic")
WEIGHTS = {"good": 0.90, "poor": 0.08, "toxic": 0.02}


def domain_of(quality: Column, toxic: Column) -> Column:
    return F.when(toxic == 1, 2).when(quality == 0, 1).when(quality == 1, 0)


@dataclass
class Domains:
    """Sorted word hashes and the softmax weights (words + bias, domains); ``present`` are the labelled domains."""
    words: np.ndarray
    weights: np.ndarray
    present: list[int]


def _distinct(text: str | None) -> tuple[int, np.ndarray]:
    """Number of words; sorted hashes of the distinct words, as they stand and without punctuation at their ends."""
    words = word_list(text)
    kinds = set(words)
    kinds |= {w.strip(PUNCTUATION) for w in kinds}
    return len(words), np.unique(hash_words(list(kinds)))


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def fit_domains(docs: DataFrame, labels: DataFrame, *, max_fit_rows: int = 10_000, max_words: int = 256,
                min_docs: int = 5, ridge: float = 1e-4, steps: int = 300) -> Domains:
    """The domain classifier.  Sample: the labelled ids with the smallest hash, at most ``max_fit_rows``, broadcast."""
    picked = hash_sample(labels.select(F.col("doc_id").cast("long").alias("label_id"),
                                       domain_of(F.col("quality"), F.col("toxic")).alias("domain"))
                         .filter("label_id IS NOT NULL AND domain IS NOT NULL"), "label_id", max_fit_rows).drop("deal")
    pairs = docs.select(F.col("doc_id").cast("long").alias("label_id"), "text").join(F.broadcast(picked), "label_id")

    def run(batches):
        for b in batches:
            sets = [_distinct(t.as_py())[1].view(np.int64) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(sets, type=pa.list_(pa.int64()))],
                                             names=["label_id", "domain", "words"])

    sample = cut(by_batch(pairs.select("label_id", "text", "domain"), run, "label_id long, domain int, words array<long>"))
    sizes = {r["domain"]: r["n"] for r in sample.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    present = sorted(sizes)
    if not present:
        return Domains(np.zeros(0, np.uint64), np.zeros((1, 1)), [0])
    total = float(sum(sizes.values()))
    seen = sample.select("domain", F.explode("words").alias("word")).groupBy("word").agg(
        F.count("*").alias("n"), *[F.sum((F.col("domain") == k).cast("int")).alias(f"n{k}") for k in present])

    def chi(k):  # presence of the word against membership in domain k
        a, n, m = F.col(f"n{k}"), F.col("n"), float(sizes[k])
        off = a * total - n * m
        return off * off * total / (n * (total - n + 1) * m * (total - m + 1))

    best = (seen.filter(F.col("n") >= min_docs).withColumn("chi", F.greatest(*[chi(k) for k in present], F.lit(0.0)))
            .filter("chi > 20").orderBy(F.desc("chi"), "word").limit(max_words).select("word").collect())
    words = np.sort(np.array([r["word"] for r in best], dtype=np.int64).view(np.uint64))
    rows = (sample.select("label_id", "domain", F.array_intersect(
                "words", F.array(*[F.lit(r["word"]) for r in best]).cast("array<bigint>")).alias("words"))
            .toPandas().sort_values(["label_id", "domain"], kind="stable"))
    x = np.zeros((len(rows), len(words) + 1), dtype=np.float32)
    x[:, -1] = 1
    for i, ws in enumerate(rows["words"]):
        x[i, np.searchsorted(words, np.asarray(ws, dtype=np.int64).view(np.uint64))] = 1
    y = np.zeros((len(rows), len(present)), dtype=np.float32)
    y[np.arange(len(rows)), np.searchsorted(present, rows["domain"].to_numpy())] = 1
    # accelerated gradient descent on standardised columns, so that rare telling words move as fast as frequent ones
    mean = x[:, :-1].mean(axis=0)
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-6))
    x[:, :-1] = (x[:, :-1] - mean) / spread
    w = v = np.zeros((x.shape[1], len(present)), dtype=np.float32)
    probe = np.ones(x.shape[1], dtype=np.float32)
    for _ in range(20):
        probe = x.T @ (x @ probe)
        probe /= np.linalg.norm(probe)
    step = 1 / (0.5 * float(probe @ (x.T @ (x @ probe))) / len(rows) + ridge)
    for i in range(steps):
        grad = x.T @ (_softmax(x @ v) - y) / len(rows) + ridge * v
        new = v - step * grad
        v = new + i / (i + 3) * (new - w)
        w = new
    w = w.astype(np.float64)
    w[:-1] /= spread[:, None]
    w[-1] -= mean @ w[:-1]
    return Domains(words, w, present)


def posteriors(model: Domains, k: int, sets: list[np.ndarray]) -> np.ndarray:
    """Domain posteriors (rows: documents, k columns) from the distinct word hashes of each document."""
    z = np.tile(model.weights[-1], (len(sets), 1))
    if len(model.words):
        for i, s in enumerate(sets):
            at = np.minimum(np.searchsorted(model.words, s), len(model.words) - 1)
            z[i] += model.weights[at[model.words[at] == s]].sum(axis=0)
    out = np.zeros((len(sets), k))
    out[:, model.present] = _softmax(z)
    return out


def memberships(docs: DataFrame, model: Domains, domains: tuple[str, ...] = DOMAINS, into: str = "mix") -> DataFrame:
    """``docs`` with a struct ``into``: ``n_tokens`` (words) and ``q``, the posteriors in units of 1/GRID that sum to GRID."""
    at, k = docs.columns.index("text"), len(domains)
    kind = pa.struct([("n_tokens", pa.int64()), ("q", pa.list_(pa.int32()))])
    out = T.StructType([*docs.schema.fields, T.StructField(into, T.StructType([
        T.StructField("n_tokens", T.LongType()), T.StructField("q", T.ArrayType(T.IntegerType()))]))])

    def run(batches):
        for b in batches:
            counted = [_distinct(t.as_py()) for t in b.column(at)]
            q = np.rint(posteriors(model, k, [s for _, s in counted]) * GRID).astype(np.int64)
            top = q.argmax(axis=1)
            q[np.arange(len(q)), top] += GRID - q.sum(axis=1)
            rows = [{"n_tokens": n, "q": r} for (n, _), r in zip(counted, q.tolist())]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rows, type=kind)], names=[*b.schema.names, into])

    return by_batch(docs, run, out)


def points_of(p: np.ndarray, history: list[list[float]]) -> tuple[np.ndarray, np.ndarray]:
    """Rates after the projected steps in ``history``, from r = 1, and the point that the next step starts from.

    A step is the scaled gradient per domain followed by the weight of the momentum after it.
    """
    r = y = np.ones(len(p))
    for *g, momentum in history:
        new = np.maximum(0.0, y - p @ np.asarray(g))
        y = new + momentum * (new - r)
        r = new
    return r, y


def rates_of(p: np.ndarray, history: list[list[float]]) -> np.ndarray:
    return points_of(p, history)[0]


@dataclass
class Rates:
    history: list[list[float]]
    reached: list[float]
    targets: list[float]
    converged: bool


def fit_rates(members: DataFrame, into: str, weights: dict[str, float], domains: tuple[str, ...] = DOMAINS, *,
              budget: float | None = None, tolerance: float = 1e-5, max_steps: int = 500) -> Rates:
    """Projected gradient until a step moves no expected total by more than ``tolerance`` of the budget.

    The momentum starts anew whenever it overshoots.  ``budget`` (tokens)
    defaults to all tokens of the input; ``converged`` says whether the stop
    test or ``max_steps`` ended the search.
    """
    k = len(domains)
    q, t = F.col(f"{into}.q"), F.col(f"{into}.n_tokens")
    mass = cut(members.groupBy(*[q[i].alias(f"q{i}") for i in range(k)]).agg(F.sum(t).alias("tokens")))
    p = [F.col(f"q{i}") / F.lit(float(GRID)) for i in range(k)]
    sums = mass.agg(*[F.sum(F.col("tokens") * p[i]).alias(f"m{i}") for i in range(k)],
                    *[F.sum(F.col("tokens") * p[i] * p[j]).alias(f"g{i}_{j}") for i in range(k) for j in range(k)]).first()
    have = np.array([sums[f"m{i}"] or 0.0 for i in range(k)])
    gram = np.array([[sums[f"g{i}_{j}"] or 0.0 for j in range(k)] for i in range(k)])
    live = have > 0
    w = np.array([weights.get(d, 0.0) for d in domains]) * live
    if not live.any() or not w.sum():
        return Rates([], have.tolist(), have.tolist(), True)
    total = float(have.sum()) if budget is None else float(budget)
    targets = total * w / w.sum()
    # equations scaled by their own Gram entry; the step is one over the largest eigenvalue
    scale = np.where(live, 1 / np.where(live, np.diag(gram), 1), 0)
    root = np.sqrt(scale)
    step = 1 / np.linalg.eigvalsh(root[:, None] * gram * root[None, :]).max()
    history: list[list[float]] = []
    reached = here = have
    off = lambda x: float(((x - targets) ** 2 * scale).sum())
    converged, age = False, 1
    for _ in range(max_steps):
        g = [float(f"{x:.12e}") for x in step * scale * (here - targets)]
        weight = (age - 1) / (age + 2)
        new, here = expected(mass, [*history, [*g, weight]], k)
        if age > 1 and off(new) > off(reached):  # momentum overshot: the same step again from the last rates
            history[-1][-1] = 0.0
            here, age = reached, 1
            continue
        history.append([*g, weight])
        moved, reached, age = np.abs(new - reached).max(), new, age + 1
        if moved <= tolerance * max(total, 1.0):
            converged = True
            break
    return Rates(history, reached.tolist(), targets.tolist(), converged)


def expected(mass: DataFrame, history: list[list[float]], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Expected domain tokens under the rates of ``history`` and at its next starting point: one job, 2 K sums."""
    schema = pa.schema([(f"s{i}", pa.float64()) for i in range(2 * k)])

    def run(batches):
        for b in batches:
            cols = [np.asarray(c, dtype=np.float64) for c in b.columns]
            p = np.stack(cols[:k], axis=1) / GRID
            s = np.concatenate([(x * cols[k]) @ p for x in points_of(p, history)])
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in s.tolist()], schema=schema)

    names = [f"s{i}" for i in range(2 * k)]
    parts = mass.select(*[f"q{i}" for i in range(k)], "tokens").mapInArrow(run, ", ".join(f"{n} double" for n in names))
    row = parts.agg(*[F.sum(n).alias(n) for n in names]).first()
    s = np.array([row[n] or 0.0 for n in names])
    return s[:k], s[k:]


def with_rates(members: DataFrame, into: str, rates: Rates, seed: int = 17, rounding: str = "random") -> DataFrame:
    """``members`` with ``rate`` and ``copies`` added to the struct ``into``.

    ``copies`` is the rate rounded up or down at random by a hash of doc_id
    (expectation: the rate), or, with ``rounding="nearest"``, to the nearest whole number.
    """
    history = rates.history

    @F.pandas_udf("double")
    def rate(q):
        p = np.stack(q.to_numpy()) / GRID if len(q) else np.zeros((0, 1))
        import pandas as pd
        return pd.Series(np.round(rates_of(p, history), 9))

    out = members.withColumn(into, F.col(into).withField("rate", rate(F.col(f"{into}.q"))))
    r = F.col(f"{into}.rate")
    u = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(seed)), F.lit(1 << 30)) / float(1 << 30) if rounding == "random" else F.lit(0.5)
    return out.withColumn(into, F.col(into).withField("copies", F.floor(r + u).cast("long")))


def mix(docs: DataFrame, labels: DataFrame, weights: dict[str, float] | None = None, into: str = "mix", *,
        rounding: str = "random", budget_of: tuple[str, ...] | None = None, keep: tuple[str, ...] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the struct ``into``: tokens, posteriors, rate, copies.

    ``budget_of``: domains whose expected tokens are the budget (default: all).
    The memberships alone are written once for the fit; if all of ``docs`` is
    asked for they are computed again beside it, so texts are never written.
    """
    model = fit_domains(docs, labels)
    members = memberships(docs, model, into=into)
    slim = cut(members.select(*(keep or ()), into))
    budget = None
    if budget_of:
        q = F.col(f"{into}.q")
        share = sum((q[DOMAINS.index(d)] for d in budget_of), F.lit(0)) / float(GRID)
        budget = slim.agg(F.sum(F.col(f"{into}.n_tokens") * share)).first()[0] or 0.0
    rates = fit_rates(slim, into, weights or WEIGHTS, budget=budget)
    return with_rates(members if keep is None else slim, into, rates, rounding=rounding)


def remix(docs: DataFrame, labels: DataFrame, weights: dict[str, float], **options) -> DataFrame:
    """Rows of ``docs`` as often as their copies say, columns unchanged."""
    s = fresh_name(docs, "mix")
    mixed = mix(docs, labels, weights, s, **options)
    return (mixed.filter(F.col(f"{s}.copies") > 0).withColumn(s, F.explode(F.sequence(F.lit(1), F.col(f"{s}.copies").cast("int"))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
