"""Removal of repeated byte strings, by suffix arrays over shards that equal strings share.

Every string of ``length`` bytes has a key: the smallest scrambled hash of its
``GRAM``-byte windows.  Equal strings have equal keys, and neighbouring strings
mostly share theirs, so a text falls into short segments, one per run of
strings with one key.  Only keys that occur in several different segments need
comparing; their segments meet in a shard, whose suffix array (induced sorting)
and permuted common prefixes show the strings that also start earlier.

Plan:

1. Segments of each text as (key, content hash, doc_id, start): of copies inside
   one batch the first is kept and the others are spans to remove, in one
   reading and one written table, so that the order of rows never matters.  The
   first ones are shuffled by key and sorted; equal content after the first is
   removed, and keys with several contents are listed.  Written table.
2. The listed segments' bytes are cut out of the texts beside their documents
   and dealt to shards by key; shards are read in chunks of whole keys.
3. A key with over ``max_segments`` different segments (a passage that very
   many documents hold in different surroundings) takes another exact way: its
   strings one by one as 128-bit hashes, reduced to the earliest by an aggregate.
4. All removed spans meet their document's text, which gives the kept bytes.

Edge cases: null and empty texts have no strings; texts shorter than
``length`` keep all bytes; rows that share a doc_id, or have none, are numbered
in the order of (doc_id, text), nulls first, and count as different documents;
an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from latentspark.llm.common import GOLDEN, batched, by_batch, mix64, numbered, rows_of, text_bytes
from latentspark.llm.suffix import common_prefixes, suffix_array
from latentspark.session import cut

LENGTH = 100
GRAM = 24
#: Bits of a key that hold a window's place while the smallest is sought; texts are cut up so that places fit.
PLACE_BITS = 20

_rng = np.random.default_rng(20240607)
BYTE_A, BYTE_B = _rng.integers(1, 1 << 63, size=(2, 256), dtype=np.uint64) | np.uint64(1)
STEP_A, STEP_B, STEP_C = _rng.integers(1, 1 << 63, size=3, dtype=np.uint64) | np.uint64(1)


def gram_hashes(b: np.ndarray, width: int, table: np.ndarray = BYTE_A, step: np.uint64 = STEP_A) -> np.ndarray:
    """Polynomial hash of every ``width`` consecutive bytes, built by doubling."""
    h, size, power = table[b], 1, step
    out, done = None, 0  # hash of the first ``done`` bytes of each window
    rest = width
    with np.errstate(over="ignore"):
        while True:
            if rest & size:
                if out is None:
                    out, done, out_power = h, size, power
                else:
                    m = min(len(out), len(h) - done)
                    out = out[:max(m, 0)] * power + h[done:done + max(m, 0)]
                    done += size
            if size * 2 > width:
                break
            h = h[:-size] * power + h[size:] if len(h) > size else h[:0]
            power = power * power
            size *= 2
    return out[:max(len(b) - width + 1, 0)]


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` consecutive values: the two running minima of blocks of that width."""
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    full = -(-len(x) // width) * width
    p = np.full(full, np.iinfo(np.uint64).max, dtype=np.uint64)
    p[:len(x)] = x
    p = p.reshape(-1, width)
    upto = np.minimum.accumulate(p, axis=1).ravel()
    since = np.minimum.accumulate(p[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(since[:n], upto[width - 1:width - 1 + n])


_powers: dict[str, np.ndarray] = {}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2^64 and of its inverse, for hashes of any stretch from one running sum."""
    if "up" not in _powers or len(_powers["up"]) < n:
        inverse = np.uint64(pow(int(STEP_B), -1, 1 << 64))
        size = max(n, 1 << 16)
        for k, base in (("up", STEP_B), ("down", inverse)):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers["up"], _powers["down"]


def segments(b: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Key, content hash, start and byte size of each segment of a text of at most 2^PLACE_BITS + length bytes."""
    width = length - gram + 1
    h = gram_hashes(b, gram) * STEP_C
    places = np.arange(len(h), dtype=np.uint64)
    mask = np.uint64((1 << PLACE_BITS) - 1)
    least = sliding_least((h & ~mask) | (places & mask), width)
    if not len(least):
        e = np.zeros(0, dtype=np.int64)
        return e, e, e, e
    start = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
    size = np.diff(np.concatenate([start, [len(least)]])) + length - 1
    up, down = _power_table(len(b) + 1)
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTE_B[b] * up[:len(b)])])
        content = mix64((total[start + size] - total[start]) * down[start] + GOLDEN * size.astype(np.uint64))
    key = least[start] >> np.uint64(PLACE_BITS)
    return key.astype(np.int64), content.view(np.int64), start.astype(np.int64), size.astype(np.int64)


def text_segments(b: bytes, length: int, gram: int):
    """``segments`` of a text of any size, taken in stretches that overlap by ``length - 1`` bytes."""
    data = np.frombuffer(b, dtype=np.uint8)
    most = (1 << PLACE_BITS) - length
    parts = []
    for lo in range(0, max(len(data) - length + 1, 0), most):
        k, c, s, n = segments(data[lo:lo + most + length - 1], length, gram)
        parts.append((k, c, s + lo, n))
    if not parts:
        e = np.zeros(0, dtype=np.int64)
        return e, e, e, e
    return tuple(np.concatenate(x) for x in zip(*parts))


def batch_segments(batch: pa.RecordBatch, length: int, gram: int):
    """Segments of a batch ``doc_id, text`` in the order of (content, document, start), and which repeat an earlier one."""
    ids = np.asarray(batch.column(0), dtype=np.int64)
    cols = []
    for i in np.argsort(ids, kind="stable").tolist():
        k, c, s, n = text_segments(text_bytes(batch.column(1)[i].as_py()), length, gram)
        cols.append((k, c, np.full(len(k), ids[i]), s, n))
    if not cols:
        return None, None
    cols = [np.concatenate(x) for x in zip(*cols)]
    by = np.argsort(cols[1], kind="stable")
    cols = [c[by] for c in cols]
    again = np.concatenate([[False], (cols[1][1:] == cols[1][:-1]) & (cols[0][1:] == cols[0][:-1]) & (cols[4][1:] == cols[4][:-1])]) \
        if len(by) else np.zeros(0, bool)
    return cols, again


FOUND = pa.schema([("again", pa.bool_()), ("key", pa.int64()), ("content", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()),
                   ("size", pa.int64())])
LISTED = pa.schema([("again", pa.bool_()), ("key", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("size", pa.int64())])
SPANS = pa.schema([("doc_id", pa.int64()), ("s", pa.int64()), ("e", pa.int64())])


def _slices(schema: pa.Schema, columns, size: int = 65536):
    for a in range(0, len(columns[0]), size):
        yield pa.RecordBatch.from_arrays([pa.array(c[a:a + size]) for c in columns], schema=schema)


def gathered(batches, rows: int, size: int = 16 << 20):
    """Consecutive Arrow batches joined to about ``rows`` rows or ``size`` bytes, and never more than ``rows`` rows."""
    held, n, used = [], 0, 0

    def whole():
        for part in pa.Table.from_batches(held).combine_chunks().to_batches():
            for a in range(0, part.num_rows, rows):
                yield part.slice(a, rows)
    for b in batches:
        held.append(b)
        n, used = n + b.num_rows, used + b.nbytes
        if n >= rows or used >= size:
            yield from whole()
            held, n, used = [], 0, 0
    if n:
        yield from whole()


def found_segments(docs: DataFrame, length: int, gram: int, batch_rows: int) -> DataFrame:
    """Segments of every text; of a batch's equal ones only the first, and the others' spans (``again``), joined where they touch.

    Both kinds come from one reading, and the caller writes them as one table:
    which copy is the first depends on the batch it is met in, so rows in
    another order, on a second reading or after a lost executor, must not
    change one kind without the other.
    """
    def run(batches):
        for batch in gathered(batches, batch_rows):
            cols, again = batch_segments(batch, length, gram)
            if cols is not None:
                key, content, doc, start, size = (c[~again] for c in cols)
                yield from _slices(FOUND, [np.zeros(len(key), dtype=bool), key, content, doc, start, size])
                doc, s, e = joined_spans(cols[2][again], cols[3][again], cols[3][again] + cols[4][again])
                none = np.zeros(len(doc), dtype=np.int64)
                yield from _slices(FOUND, [np.ones(len(doc), dtype=bool), none, none, doc, s, e - s])

    return by_batch(docs, run, "again boolean, key long, content long, doc_id long, start long, size long")


def joined_spans(doc: np.ndarray, s: np.ndarray, e: np.ndarray):
    """Spans sorted by document and start, overlapping and touching ones joined."""
    if not len(doc):
        return doc, s, e
    by = np.lexsort((s, doc))
    doc, s, e = doc[by], s[by], e[by]
    edge = np.concatenate([[0], np.flatnonzero(doc[1:] != doc[:-1]) + 1])
    number = np.zeros(len(doc), dtype=np.int64)
    number[edge] = 1
    # the furthest end so far within the document: documents are set apart by an offset
    apart = (np.cumsum(number) - 1) * (int(e.max()) + 2)
    reach = np.maximum.accumulate(e + apart)
    fresh = np.concatenate([[True], (s + apart)[1:] > reach[:-1]])
    first = np.flatnonzero(fresh)
    last = np.concatenate([first[1:], [len(doc)]]) - 1
    return doc[first], s[first], reach[last] - apart[last]


def list_repeats(firsts: DataFrame) -> DataFrame:
    """Of segments dealt by key: ``again`` rows repeat an earlier content; the others are the contents of keys with several.

    A stream over the sorted rows that carries one row: a key's first content
    is held back until a second one shows.
    """
    dealt = firsts.repartition("key").sortWithinPartitions("key", "size", "content", "doc_id", "start")

    def run(batches):
        last, held = None, None  # last (key, size, content); the only content of the key so far
        for b in batches:
            key, content, doc, start, size = (np.asarray(c, dtype=np.int64) for c in b.columns)
            if not len(key):
                continue
            prior = last or (None, None, None)
            new_key = np.concatenate([[prior[0] != int(key[0])], key[1:] != key[:-1]])
            fresh = new_key | np.concatenate([[prior[1:] != (int(size[0]), int(content[0]))],
                                              (size[1:] != size[:-1]) | (content[1:] != content[:-1])])
            run_of = np.cumsum(new_key)
            contents = np.bincount(run_of, weights=fresh, minlength=run_of[-1] + 1)
            open_runs = int(run_of[0]) == 0  # the batch goes on with the last key
            several = contents[run_of] > 1
            if open_runs and contents[0] >= 1:  # a further content of the key begun before
                several |= run_of == 0
                if held is not None:
                    yield from _slices(LISTED, [np.array([False]), *[np.array([x]) for x in held]])
                    held = None
            give = ~fresh | several
            # a key whose only content so far stands at the end of the batch is held back
            tail = run_of[-1]
            if tail > 0 or not open_runs:
                held = None
                if contents[tail] == 1:
                    at = int(np.flatnonzero((run_of == tail) & fresh)[0])
                    held = (int(key[at]), int(doc[at]), int(start[at]), int(size[at]))
            last = (int(key[-1]), int(size[-1]), int(content[-1]))
            yield from _slices(LISTED, [~fresh[give], key[give], doc[give], start[give], size[give]])

    return dealt.mapInArrow(run, "again boolean, key long, doc_id long, start long, size long")


def repeated_in_chunk(doc: np.ndarray, start: np.ndarray, texts: list[bytes], length: int):
    """Spans of ``texts`` (different segments, each of one document) whose strings also start earlier in the chunk."""
    by = np.lexsort((start, doc))
    doc, start = doc[by], start[by]
    raw = b"\x00".join(texts[i] for i in by.tolist())  # sizes tell the marks from zero bytes
    sizes = np.array([len(texts[i]) for i in by.tolist()], dtype=np.int64)
    t = np.frombuffer(raw + b"\x00\x00", dtype=np.uint8).astype(np.uint16) + 2
    begin = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    t[begin + sizes] = 1
    t[-1] = 0
    sa = suffix_array(t)
    lcp = common_prefixes(t, sa, t < 2)
    alike = lcp[sa] >= length
    alike[0] = False
    # runs of suffixes with a common prefix of the length: all but the one that starts first repeat it
    group = np.cumsum(~alike) - 1
    edge = np.flatnonzero(~alike)
    earliest = np.minimum.reduceat(sa, edge)
    again = np.sort(sa[sa != earliest[group]])
    place = np.searchsorted(begin, again, side="right") - 1
    s = again - begin[place] + start[place]
    return joined_spans(doc[place], s, s + length)


def repeated_in_shards(bytes_of: DataFrame, length: int, chunk_bytes: int) -> DataFrame:
    """Spans that repeat earlier strings among segments ``key, doc_id, start, bytes``; chunks hold whole keys."""
    def run(batches):
        def flush(held):
            doc, start = (np.array(x, dtype=np.int64) for x in zip(*[(r[1], r[2]) for r in held]))
            return _slices(SPANS, repeated_in_chunk(doc, start, [r[3] for r in held], length))

        held, size, whole = [], 0, 0  # whole: rows of finished keys
        for row in rows_of(batches):
            if held and row[0] != held[-1][0]:
                if size >= chunk_bytes:
                    yield from flush(held)
                    held, size = [], 0
            held.append(row)
            size += len(row[3]) + 1
        if held:
            yield from flush(held)

    dealt = bytes_of.repartition("key").sortWithinPartitions("key")
    return by_batch(dealt, run, "doc_id long, s long, e long")


def cut_out(docs: DataFrame, listed: DataFrame) -> DataFrame:
    """``key, doc_id, start, bytes`` of listed segments, cut out beside their documents (both shuffled by doc_id)."""
    wanted = listed.groupBy(F.col("doc_id").alias("d")).agg(F.collect_list(F.struct("key", "start", "size")).alias("cuts"))
    schema = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("bytes", pa.binary())])

    def run(batches):
        def out():
            for batch in batches:
                for i in range(batch.num_rows):
                    b = text_bytes(batch.column(1)[i].as_py())
                    d = batch.column(0)[i].as_py()
                    for c in batch.column(2)[i].as_py():
                        yield c["key"], d, c["start"], b[c["start"]:c["start"] + c["size"]]
        yield from batched(out(), schema, 4096)

    beside = docs.join(wanted.hint("merge"), F.col("doc_id") == F.col("d")).select("doc_id", "text", "cuts")
    return by_batch(beside, run, "key long, doc_id long, start long, bytes binary")


def repeated_strings(bytes_of: DataFrame, length: int) -> DataFrame:
    """The same spans string by string: 128-bit hashes, the earliest of each by an aggregate, the others by a join."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("doc_id", pa.int64()), ("s", pa.int64())])

    def run(batches):
        def out():
            for _, d, start, b in rows_of(batches):
                for i in range(len(b) - length + 1):
                    x, y = np.frombuffer(hashlib.blake2b(b[i:i + length], digest_size=16).digest(), dtype=np.int64).tolist()
                    yield x, y, d, start + i
        yield from batched(out(), schema, 8192)

    each = bytes_of.mapInArrow(run, "a long, b long, doc_id long, s long")
    least = each.groupBy("a", "b").agg(F.min(F.struct("doc_id", "s")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    return (each.join(least, ["a", "b"]).filter((F.col("doc_id") != F.col("first.doc_id")) | (F.col("s") != F.col("first.s")))
            .select("doc_id", "s", (F.col("s") + length).alias("e")))


def remove_repeats(docs: DataFrame, *, length: int = LENGTH, gram: int = GRAM, max_segments: int = 50_000,
                   chunk_bytes: int = 4 << 20, batch_rows: int = 8192) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed`` (the spans, end exclusive)."""
    docs, own = numbered(docs)
    texts = docs.select("doc_id", "text")
    found = cut(found_segments(texts, length, gram, batch_rows))
    listed = cut(list_repeats(found.filter("NOT again").drop("again")))
    contents = listed.filter("NOT again").drop("again")
    hot = contents.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > max_segments).select("key")
    spans = found.select("again", "doc_id", "start", "size").unionByName(listed.select("again", "doc_id", "start", "size")).filter(
        "again").select("doc_id", F.col("start").alias("s"), (F.col("start") + F.col("size")).alias("e"))
    if hot.limit(1).count():
        spans = spans.unionByName(repeated_strings(cut_out(texts, contents.join(hot, "key", "left_semi")), length))
        contents = contents.join(hot, "key", "left_anti")
    spans = spans.unionByName(repeated_in_shards(cut_out(texts, contents), length, chunk_bytes))
    of_doc = spans.groupBy(F.col("doc_id").alias("d")).agg(F.collect_list(F.struct("s", "e")).alias("spans"))
    beside = texts.join(of_doc.hint("merge"), F.col("doc_id") == F.col("d"), "left").select("doc_id", "text", "spans")
    span = pa.struct([("s", pa.int64()), ("e", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                        ("kept_sha256", pa.string()), ("removed", pa.list_(span))])

    def run(batches):
        def out():
            for d, text, found in rows_of(batches):
                b = text_bytes(text)
                digest, at, gone = hashlib.sha256(), 0, []
                if found:
                    s, e = (np.array([x[k] for x in found], dtype=np.int64) for k in ("s", "e"))
                    _, s, e = joined_spans(np.zeros(len(s), dtype=np.int64), s, e)
                    gone = list(zip(s.tolist(), e.tolist()))
                for s, e in gone:
                    digest.update(b[at:s])
                    at = e
                digest.update(b[at:])
                yield d, len(b), sum(e - s for s, e in gone), len(gone), digest.hexdigest(), [{"s": s, "e": e} for s, e in gone]
        yield from batched(out(), schema, 1024)

    result = by_batch(beside, run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
                                    "removed array<struct<s:long,e:long>>")
    if own:
        result = result.join(docs.select(F.col("doc_id").alias("d"), own), F.col("doc_id") == F.col("d")).select(
            F.col(own).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed")
    return result
