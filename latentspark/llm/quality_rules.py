"""Quality rules: a learned, ordered decision list over statistics of whole texts.

``text_statistics`` counts, per document and over its whole text, words, the
code points in them, symbol characters, repeated lines and repeated 3-word
windows, and a few more shape counts.  ``learn_rules`` fits a decision list to
labelled statistics by sequential covering: each rule is grown condition by
condition on one part of the rows (information gain of thresholds at
quantiles), pruned on the other part, and kept only while it is precise there.
``rule_verdict`` turns the list into one ordered Spark ``when`` chain.

Edge cases: a null or empty text has no words (all counts 0) and fails the
base rule; a label without document, or with null quality, is not used; a row
repeated in the labels counts each time; with no usable labels (or only one
class) the list is empty and the base rule alone decides; columns of the input
named like a statistic keep their own values (statistics travel in one struct
column with a free name).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from latentspark.llm.common import by_batch, fresh_name, hash_sample, hash_words, text_bytes, window_hash

# Fixed values of the base rule.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
              "n_distinct_words", "n_lines", "n_upper", "n_digits", "n_marks")
STRUCT = T.StructType([T.StructField(n, T.LongType()) for n in STATISTICS])

#: Ratios that rules may test, each over a denominator of at least 1.
RATIOS = {
    "chars_per_word": ("word_chars", "n_words"), "symbols_per_word": ("n_symbols", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"), "repeat_share": ("n_repeat_words", "n_words"),
    "distinct_share": ("n_distinct_words", "n_words"), "upper_share": ("n_upper", "word_chars"),
    "digit_share": ("n_digits", "word_chars"), "marks_per_word": ("n_marks", "n_words"),
}


def count_text(text: str | None) -> tuple[int, ...]:
    """The statistics of one text, in the order of ``STATISTICS``."""
    b = text_bytes(text)
    words = b.split()
    n = len(words)
    if not n:
        return (0, 0, len(b) - len(b.translate(None, SYMBOLS)), 0, 0, 0, 0, 0, 0, 0)
    solid = b.translate(None, SPACE)
    lines = [x for x in b.split(b"\n") if x.strip(SPACE)]
    h = hash_words(words)
    n_repeat = 0
    if n >= 4:
        windows = window_hash(h, 3)
        _, where, times = np.unique(windows, return_inverse=True, return_counts=True)
        starts = np.flatnonzero(times[where] > 1)
        if len(starts):
            inside = np.zeros(n + 1, dtype=np.int64)
            np.add.at(inside, starts, 1)
            np.add.at(inside, starts + 3, -1)
            n_repeat = int((np.cumsum(inside[:n]) > 0).sum())
    continuation = 0 if solid.isascii() else int(((np.frombuffer(solid, np.uint8) & 0xC0) == 0x80).sum())
    without = lambda drop: len(solid) - len(solid.translate(None, drop))
    return (n, len(solid) - continuation, without(SYMBOLS), len(lines) - len(set(lines)), n_repeat,
            len(np.unique(h)), len(lines), without(UPPER), without(b"0123456789"), without(b"!?"))


def text_statistics(docs: DataFrame, text: str = "text", into: str = "quality_stats") -> DataFrame:
    """``docs`` with one struct column ``into`` (a free name is needed) of whole-text counts; one pass, no shuffle."""
    fields = docs.schema.fields
    at = docs.columns.index(text)
    out = T.StructType([*fields, T.StructField(into, STRUCT)])
    kind = pa.struct([(n, pa.int64()) for n in STATISTICS])

    def run(batches):
        for batch in batches:
            rows = [dict(zip(STATISTICS, count_text(t.as_py()))) for t in batch.column(at)]
            names = [*batch.schema.names, into]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, type=kind)], names=names)

    return by_batch(docs, run, out)


def base_failed(s: str) -> Column:
    n = F.col(f"{s}.n_words")
    return (n < MIN_WORDS) | (100 * F.col(f"{s}.n_repeat_words") > MAX_REPEAT_PERCENT * n)


def ratio(s: str, name: str) -> Column:
    over, under = RATIOS[name]
    return F.col(f"{s}.{over}") / F.greatest(F.col(f"{s}.{under}"), F.lit(1)).cast("double")


# ---------------------------------------------------------------- learning

@dataclass(frozen=True)
class Rule:
    """A conjunction of (feature, is_above, threshold); ``precision`` and ``covered`` are those on the pruning rows."""
    conditions: tuple[tuple[str, bool, float], ...]
    precision: float
    covered: int

    def covers(self, x: np.ndarray, names: list[str]) -> np.ndarray:
        hit = np.ones(len(x), dtype=bool)
        for name, above, cut in self.conditions:
            v = x[:, names.index(name)]
            hit &= (v > cut) if above else (v <= cut)
        return hit

    def column(self, s: str) -> Column:
        out = F.lit(True)
        for name, above, cut in self.conditions:
            out = out & ((ratio(s, name) > cut) if above else (ratio(s, name) <= cut))
        return out


def _grow(x: np.ndarray, bad: np.ndarray, names: list[str], cuts: list[np.ndarray], most: int):
    """Conditions added one by one, each the one with the largest information gain, until no good row is covered."""
    live, conditions = np.ones(len(x), dtype=bool), []
    while len(conditions) < most:
        p, n = int((live & bad).sum()), int((live & ~bad).sum())
        if not p or not n:
            break
        start, best = np.log2(p / (p + n)), (1e-9, None)
        for f, name in enumerate(names):
            v = x[live, f]
            b = bad[live]
            for above in (True, False):
                hit = (v[:, None] > cuts[f]) if above else (v[:, None] <= cuts[f])
                tp, fp = (hit & b[:, None]).sum(0), (hit & ~b[:, None]).sum(0)
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(tp > 0, tp * (np.log2(tp / (tp + fp)) - start), -1.0)
                k = int(np.argmax(gain)) if len(gain) else -1
                if k >= 0 and gain[k] > best[0]:
                    best = (float(gain[k]), (name, above, float(cuts[f][k])))
        if best[1] is None:
            break
        conditions.append(best[1])
        live &= Rule((best[1],), 0, 0).covers(x, names)
    return tuple(conditions)


def cover(x: np.ndarray, bad: np.ndarray, names: list[str], *, max_rules: int = 16, max_conditions: int = 4,
          min_precision: float = 0.95, min_cover: int = 3, n_cuts: int = 64) -> list[Rule]:
    """Sequential covering of the bad rows: grow on two of three rows, prune on the third, drop what is covered.

    Rows of each class are dealt to the two parts by position, so callers fix their order.
    Covering ends when a pruned rule is less precise than ``min_precision`` on
    the pruning rows, or covers fewer than ``min_cover`` bad ones of all.
    """
    cuts = []
    for f in range(len(names)):
        edges = np.unique(np.quantile(x[:, f], np.linspace(0, 1, n_cuts + 1))) if len(x) else np.zeros(0)
        cuts.append((edges[1:] + edges[:-1]) / 2)
    grow_part = np.where(bad, np.cumsum(bad), np.cumsum(~bad)) % 3 != 0
    left, rules = np.ones(len(x), dtype=bool), []
    while len(rules) < max_rules and (left & bad).any():
        g, p = left & grow_part, left & ~grow_part
        conditions = _grow(x[g], bad[g], names, cuts, max_conditions)
        if not conditions:
            break

        def worth(cs):
            hit = Rule(cs, 0, 0).covers(x[p], names)
            tp, fp = int((hit & bad[p]).sum()), int((hit & ~bad[p]).sum())
            return (tp - fp) / (tp + fp) if tp + fp else -1.0
        conditions = max((conditions[:k] for k in range(len(conditions), 0, -1)), key=worth)
        hit = Rule(conditions, 0, 0).covers(x, names) & left
        test = hit & ~grow_part
        precision = float(bad[test].mean()) if test.any() else 0.0
        if precision < min_precision or int((hit & bad).sum()) < min_cover:
            break
        rules.append(Rule(conditions, precision, int(test.sum())))
        left &= ~hit
    return rules


def learn_rules(docs: DataFrame, labels: DataFrame, *, max_fit_rows: int = 20_000, **options) -> list[Rule]:
    """Rules for quality 0, from at most ``max_fit_rows`` labelled documents that pass the base rule.

    The bound is the only sample: the labelled ids with the smallest hash are
    taken (top-k, no full sort), broadcast (at most ``max_fit_rows`` of them)
    against the documents, and their counts, a few numbers a row, are fitted on the driver.
    """
    picked = hash_sample(labels.select(F.col("doc_id").cast("long").alias("label_id"), F.col("quality").cast("int").alias("quality"))
                         .filter("label_id IS NOT NULL AND quality IS NOT NULL"), "label_id", max_fit_rows)
    pairs = docs.select(F.col("doc_id").alias("label_id"), "text").join(F.broadcast(picked), "label_id")
    stats = text_statistics(pairs, into="s").filter(~base_failed("s"))
    names = sorted(RATIOS)
    rows = (stats.select("deal", "label_id", (F.col("quality") == 0).alias("bad"), *[ratio("s", n).alias(n) for n in names])
            .toPandas().sort_values(["deal", "label_id"], kind="stable"))
    bad = rows["bad"].to_numpy(dtype=bool)
    if not bad.any() or bad.all():
        return []
    return cover(rows[names].to_numpy(dtype=float), bad, names, **options)


def rule_verdict(rules: list[Rule], s: str) -> Column:
    """True where no rule rejects: an ordered ``when`` chain, first hit decides."""
    chain = F
    for r in rules:
        chain = chain.when(r.column(s), F.lit(False))
    return chain.otherwise(F.lit(True)) if rules else F.lit(True)


def judge(docs: DataFrame, rules: list[Rule], into: str = "quality_stats") -> DataFrame:
    """``docs`` with the statistics struct ``into`` and its fields ``base_failed`` and ``kept`` added."""
    failed = base_failed(into)
    return text_statistics(docs, into=into).withColumn(into, F.col(into).withField("base_failed", failed).withField(
        "kept", ~failed & rule_verdict(rules, into)))


def keep_good(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows of ``docs`` that the base rule and the list keep, columns unchanged."""
    s = fresh_name(docs, "quality_stats")
    return judge(docs, rules, s).filter(F.col(f"{s}.kept")).select(*[F.col(f"`{c}`") for c in docs.columns])
