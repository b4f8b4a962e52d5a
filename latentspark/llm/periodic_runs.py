"""Periodic runs of words, by online dyadic square catching.

``RunCatcher`` reads a text word by word (or stretch by stretch).  On level k
every completed aligned block of M = 2^k words has a catcher, which watches the
lags 2M <= q < 4M (level 0 also lag 1): a square of period q holds a whole
aligned block in its first half, so the block comes again q words later.  As
words are appended, each lag's suffix comparison moves on by the blocks that
are complete: ``since`` counts how many blocks in a row, up to the newest, the
text repeats at that lag.  Once there are as many as every run of
the wanted exponent must hold, a square is caught; squares of one lag that
touch are one stretch, and when it ends (or the text does) its ends are
settled word by word within a block on both sides, on exact word numbers.
Blocks are compared by hashes built by doubling, so a word costs a few array
operations on each of log n levels and memory is linear in the text.

A stretch whose period is not the smallest (a multiple of a smaller one) is
dropped: with an exponent of at least 2 the smaller period divides it.

Edge cases: a null or empty text has no words and no run; texts with fewer than
``min_length`` words have none; one word repeated is a run of period 1; rows
are judged one by one, so repeated rows, null ids and further columns do not
matter, and columns named like the result struct keep their values (a free name
is needed, see ``fresh_name``); an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from latentspark.llm.common import MIX_1, MIX_2, by_batch, mix64, text_bytes

#: Words handed to the catchers at a time.
STRETCH = 1 << 16


def paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of the block of two neighbours' hashes.  Equal hashes only point at stretches, whose words are compared then."""
    h = a * MIX_1
    h ^= h >> np.uint64(32)
    h += b
    h *= MIX_2
    return h


class Level:
    """Catchers of the blocks of 2^k words: hashes not yet used up, the next block, and the run of agreeing blocks per lag."""

    def __init__(self, k: int):
        self.size = 1 << k
        self.lags = np.arange(2 << k, 4 << k) if k else np.arange(1, 4)
        self.base, self.h = 0, np.zeros(0, dtype=np.uint64)   # hash of the block at base + i
        self.row = 0                                          # next block whose catcher is asked
        self.since = np.zeros(len(self.lags), dtype=np.int64)

    @property
    def hashed(self) -> int:
        return self.base + len(self.h)


class RunCatcher:
    """Runs of a sequence of whole numbers: maximal stretches with smallest period q and at least
    max(``min_length``, ``exponent`` * q) words."""

    def __init__(self, exponent: int = 4, min_length: int = 6):
        if exponent < 2:
            raise ValueError("a run repeats its period at least twice")
        self.exponent, self.min_length = exponent, min_length
        self.words, self.n = np.zeros(1024, dtype=np.int64), 0
        self.levels: list[Level] = []
        self.runs: dict[tuple[int, int], int] = {}            # (start, period) -> length

    def append(self, words: np.ndarray, below: int | None = None) -> None:
        """Further words; the catchers advance by all blocks that are complete now (at the end only levels under ``below`` matter)."""
        words = np.asarray(words, dtype=np.int64)
        if self.n + len(words) > len(self.words):
            self.words = np.concatenate([self.words[:self.n], np.empty(self.n + len(words) + 1024, dtype=np.int64)])
        self.words[self.n:self.n + len(words)] = words
        self.n += len(words)
        self._advance(below)

    def finish(self, words=()) -> list[tuple[int, int, int]]:
        """The last words; all runs as (start, length, period), by start, then period.  Nothing can be appended afterwards."""
        words = np.asarray(words, dtype=np.int64)
        # words that equal nothing let every block of the text meet all its lags
        top = 1
        while 4 * top * self.exponent <= self.n + len(words):
            top *= 2
        self.append(np.concatenate([words, np.iinfo(np.int64).min + np.arange(6 * top)]), 2 * top)
        return [(s, length, q) for (s, q), length in sorted(self.runs.items())]

    def _advance(self, below: int | None) -> None:
        while (1 << len(self.levels)) * 2 * self.exponent <= self.n and (not below or 1 << len(self.levels) < below):
            self.levels.append(Level(len(self.levels)))
        for k, level in enumerate(self.levels):
            m = level.size
            start, stop = level.hashed, self.n - m + 1
            if stop > start:
                if k:
                    low = self.levels[k - 1]
                    a = low.h[start - low.base:stop - low.base]
                    b = low.h[start + m // 2 - low.base:stop + m // 2 - low.base]
                    new = paired(a, b)
                else:
                    new = mix64(self.words[start:stop].view(np.uint64))
                level.h = np.concatenate([level.h, new]) if len(level.h) else new
            self._ask(level, last=below is not None)
        for k, level in enumerate(self.levels):
            # what neither a catcher nor the next level's hashes still need goes; the next level may be yet to come
            need = level.row * level.size
            need = min(need, self.levels[k + 1].hashed if k + 1 < len(self.levels) else 0)
            if need - level.base > max(len(level.h) // 2, 1024):
                level.h = level.h[need - level.base:].copy()
                level.base = need

    def _ask(self, level: Level, last: bool) -> None:
        """All blocks whose last lag lies within the text meet their lags."""
        m, first = level.size, int(level.lags[0])
        rows = (self.n - m - int(level.lags[-1])) // m + 1 - level.row
        if rows <= 0:
            return
        # view[i, j]: hash at the i-th block's start plus the j-th lag
        at = level.row * m - level.base
        view = np.ndarray((rows, len(level.lags)), np.uint64, level.h, 8 * (at + first), (8 * m, 8))
        own = level.h[at:at + (rows - 1) * m + 1:m]
        # a stretch of this lag that belongs to a run holds so many whole blocks
        agree = view == own[:, None]
        deep = int(max(((self.exponent - 1) * first - m + 1) // m, 1))
        if rows >= deep and not level.since.any():
            some = agree[:rows - deep + 1].copy()
            for d in range(1, deep):
                some &= agree[d:rows - deep + 1 + d]
            if not some.any():
                # nothing is caught here; only what the last blocks hold can grow on
                level.since = np.zeros_like(level.since) if last else self._tail(agree, deep)
                level.row += rows
                return
        need = np.maximum(((self.exponent - 1) * level.lags - m + 1) // m, 1)
        # ends of agreeing stretches, lag by lag; the carried count is a stretch that began before these blocks
        grid = np.zeros((len(level.lags), rows + 2), dtype=np.int8)
        grid[:, 1:-1] = agree.T
        change = np.diff(grid, axis=1)
        lag, begin = np.nonzero(change == 1)
        _, end = np.nonzero(change == -1)
        count = end - begin
        count += np.where(begin == 0, level.since[lag], 0)
        grown = np.zeros_like(level.since)
        open_ = end == rows
        grown[lag[open_]] = count[open_]
        # carried stretches that the first block here breaks
        over = np.flatnonzero((level.since > 0) & ~agree[0])
        caught = np.flatnonzero(~open_ & (count >= need[lag]))
        over = over[level.since[over] >= need[over]]
        head = np.concatenate([level.row + end[caught] - count[caught], level.row - level.since[over]])
        tail = np.concatenate([level.row + end[caught], np.full(len(over), level.row)])
        self._settle(m, level.lags[np.concatenate([lag[caught], over])], head * m, tail * m)
        level.since = grown
        level.row += rows

    @staticmethod
    def _tail(agree: np.ndarray, deep: int) -> np.ndarray:
        """Agreeing blocks up to the last one per lag, known to be fewer than ``deep``."""
        out, live = np.zeros(agree.shape[1], dtype=np.int64), np.ones(agree.shape[1], dtype=bool)
        for d in range(1, min(deep, len(agree)) + 1):
            live &= agree[-d]
            out += live
        return out

    def _settle(self, m: int, lags: np.ndarray, heads: np.ndarray, tails: np.ndarray) -> None:
        """Exact ends of the stretches whose blocks from ``heads`` to ``tails`` repeat ``lags`` words later."""
        if len(lags) > 4:
            # multiples of a known smaller period that spans the whole stretch are no smallest periods
            fresh = np.ones(len(lags), dtype=bool)
            for (s, q), length in self.runs.items():
                if length >= 4 * m:
                    fresh &= ~((heads >= s) & (tails + lags <= s + length) & (lags % q == 0) & (lags > q))
            lags, heads, tails = lags[fresh], heads[fresh], tails[fresh]
        for q, head, tail in zip(lags.tolist(), heads.tolist(), tails.tolist()):
            low, high = max(head - m, 0), min(tail + m, self.n - q)
            same = np.concatenate([[False], self.words[low:high] == self.words[low + q:high + q], [False]])
            edges = np.flatnonzero(same[1:] != same[:-1])
            for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
                length = b - a + q
                if length >= max(self.min_length, self.exponent * q) and self._smallest(low + a, q):
                    self.runs[low + a, q] = length

    def _smallest(self, start: int, q: int) -> bool:
        """No divisor of ``q`` is a period of the two periods from ``start``."""
        rest, p = q, 2
        primes = []
        while p * p <= rest:
            if rest % p == 0:
                primes.append(p)
                while rest % p == 0:
                    rest //= p
            p += 1
        primes += [rest] if rest > 1 else []
        w = self.words[start:start + 2 * q]
        return not any(np.array_equal(w[q // p:], w[:-(q // p)]) for p in primes)


def word_numbers(words: list[bytes]) -> np.ndarray:
    """Words as whole numbers, equal words alike (exact, by their last place)."""
    places = dict(zip(words, range(len(words))))
    return np.fromiter(map(places.__getitem__, words), dtype=np.int64, count=len(words))


def runs_of(words: list[bytes], exponent: int = 4, min_length: int = 6) -> list[tuple[int, int, int]]:
    """Runs of a list of words as (start, length, period)."""
    catcher = RunCatcher(exponent, min_length)
    if len(words) < max(min_length, exponent):
        return []
    numbers = word_numbers(words)
    while len(numbers) > STRETCH:
        catcher.append(numbers[:STRETCH])
        numbers = numbers[STRETCH:]
    return catcher.finish(numbers)


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by a space, without those that some run holds after its first period."""
    if not runs:
        return b" ".join(words)
    drop = np.zeros(len(words) + 1, dtype=np.int64)
    for s, length, q in runs:
        drop[s + q] += 1
        drop[s + length] -= 1
    keep = np.cumsum(drop[:-1]) == 0
    return b" ".join([w for w, k in zip(words, keep.tolist()) if k])


RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
STRUCT = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)),
                       T.StructField("collapsed", T.StringType())])


def find_runs(docs: DataFrame, text: str = "text", into: str = "periodic", *, exponent: int = 4, min_length: int = 6) -> DataFrame:
    """``docs`` with one struct column ``into``: number of words, runs by start and period, and the collapsed text.

    One pass, no shuffle; words are ``[^\\x20\\x09-\\x0D]+`` as they stand.
    """
    at = docs.columns.index(text)
    run_type = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])
    kind = pa.struct([("n_words", pa.int64()), ("runs", pa.list_(run_type)), ("collapsed", pa.string())])

    def run(batches):
        for batch in batches:
            found = []
            for t in batch.column(at):
                words = text_bytes(t.as_py()).split()
                runs = runs_of(words, exponent, min_length)
                found.append({"n_words": len(words), "runs": [dict(zip(("start", "length", "period"), r)) for r in runs],
                              "collapsed": collapse(words, runs)})
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, type=kind)], names=[*batch.schema.names, into])

    return by_batch(docs, run, T.StructType([*docs.schema.fields, T.StructField(into, STRUCT)]))


def planted_text(doc_id: Column, text: Column) -> Column:
    """Of ids whose crc32 (as text) ends in 0: the words from a on repeat with period p, as the query's contract deals them."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def again(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        tail = F.flatten(F.array_repeat(F.slice(w, (a + 1).cast("int"), p.cast("int")), F.ceil((n - a) / p).cast("int")))
        return F.array_join(F.concat(F.slice(w, 1, a.cast("int")), F.slice(tail, 1, (n - a).cast("int"))), " ")

    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: F.length(w) > 0)
    # the words are bound to a lambda's variable, so that they are split once
    made = F.element_at(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, again(w))), 1)
    return F.when(h % 10 == 0, F.coalesce(made, text)).otherwise(text)


def run_digests(found: DataFrame, into: str) -> DataFrame:
    """``doc_id`` and the digest columns of ``find_runs``; the longest run by length, start and period."""
    runs = F.col(f"{into}.runs")
    lines = F.array_join(F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    lines = F.when(F.size(runs) > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit(""))
    best = F.element_at(F.array_sort(F.transform(runs, lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("q")))), 1)
    best = F.when(F.size(runs) > 0, best)
    return found.select("doc_id", F.size(runs).cast("long").alias("n_runs"), best["s"].alias("start"), (-best["l"]).alias("length"),
                        best["q"].alias("period"), F.floor(-best["l"] * 1000 / best["q"]).cast("long").alias("exponent_milli"),
                        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
                        F.sha2(F.col(f"{into}.collapsed").cast("binary"), 256).alias("collapsed_sha256"))
