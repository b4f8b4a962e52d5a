"""Best-fit decreasing packing of tokenised documents into fixed-length sequences.

Every document becomes its token ids and one end id; longer ones than a
sequence are cut into full pieces, the first of them possibly shorter, so each
document has at most one piece that needs a partner.  Pieces (a few numbers
each, no ids) are dealt by hash to packing tasks of about ``per_task``
documents; a task takes them longest first and puts each into the open
sequence with the tightest sufficient space, found by a segment tree over the
remaining capacities.  Only the last sequences of each task stay part-filled.

Ids: the vocabulary is read twice, as ranks (fast encoder) for texts whose
characters are all below U+0250 and by the ``tokenizers`` file otherwise; both
give the same ids there, which the tests hold against each other.

Edge cases: a null or empty text is its end id alone (one piece of length 1); a
repeated row is packed again under the same doc_id; equal lengths go by doc_id
(nulls first), then piece; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from itertools import tee
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from latentspark.llm.common import batched, by_batch, rows_of

LENGTH = 1024
END_ID = 2
TOKENIZER = "byte_bpe_50k"
# Fixed value: the vocabulary's one special token, which its file also matches inside texts.
SPECIAL = {"<|endoftext|>": 50256}

_encoders: dict = {}


def encoder(name: str = TOKENIZER):
    """Function text → list of ids, loaded once per worker."""
    if name not in _encoders:
        import base64

        import public_tokenizers as files
        import tiktoken
        with open(files.path(f"{name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        fast = tiktoken.Encoding(name, pat_str=files.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)
        del ranks
        other = re.compile("[^\u0000-ɏ]")
        slow: list = []

        def encode(text: str) -> list[int]:
            if not other.search(text):
                return fast.encode(text, allowed_special="all")
            if not slow:  # most workers never need it
                from tokenizers import Tokenizer
                slow.append(Tokenizer.from_file(files.path(f"{name}.json")))
            return slow[0].encode(text, add_special_tokens=False).ids
        _encoders[name] = encode
    return _encoders[name]


PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids_crc32", pa.int64()), ("ids", pa.list_(pa.int32()))])


def pieces(docs: DataFrame, *, length: int = LENGTH, end_id: int = END_ID, tokenizer: str = TOKENIZER,
           with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``) for every piece of every whole text; no shuffle."""
    schema = PIECES if with_ids else pa.schema(list(PIECES)[:-1])

    def run(batches):
        encode = encoder(tokenizer)

        def out():
            for doc_id, text in rows_of(batches):
                ids = np.array([*(encode(text) if text else ()), end_id], dtype="<u4")
                ends = list(range(len(ids), 0, -length))[::-1]
                start = 0
                for k, end in enumerate(ends):
                    part = ids[start:end]
                    row = (doc_id, k, start, end - start, zlib.crc32(part.tobytes()))
                    yield (*row, part.astype(np.int32).tolist()) if with_ids else row
                    start = end
        yield from batched(out(), schema, 1024 if with_ids else 8192)

    ddl = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return by_batch(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, ddl)


class OpenSequences:
    """Open sequences by remaining capacity, in a segment tree of counts over the capacities 0 .. length - 1."""

    def __init__(self, length: int):
        self.leaves = 1 << (length - 1).bit_length()
        self.count = [0] * (2 * self.leaves)
        self.by_space: dict[int, list[int]] = {}

    def _add(self, space: int, step: int) -> None:
        i = space + self.leaves
        while i:
            self.count[i] += step
            i >>= 1

    def put(self, space: int, sequence: int) -> None:
        self.by_space.setdefault(space, []).append(sequence)
        self._add(space, 1)

    def tightest(self, need: int) -> tuple[int, int] | None:
        """Takes out the sequence with the least space of at least ``need``: (space, sequence), or None."""
        if need >= self.leaves:
            return None
        i = need + self.leaves
        if not self.count[i]:
            while i > 1 and (i & 1 or not self.count[i + 1]):  # up, until a right neighbour holds something
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:  # down, to its least space
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        space = i - self.leaves
        self._add(space, -1)
        return space, self.by_space[space].pop()


def best_fit(lengths, length: int):
    """(sequence, offset) for each of the descending ``lengths``; sequences are numbered from 0."""
    opened, n = OpenSequences(length), 0
    for size in lengths:
        found = opened.tightest(size) if size < length else None
        if found:
            space, sequence = found
        else:
            space, sequence = length, n
            n += 1
        if space > size:
            opened.put(space - size, sequence)
        yield sequence, length - space


def pack(parts: DataFrame, n_docs: int, *, length: int = LENGTH, per_task: int = 50_000) -> DataFrame:
    """``parts`` (columns as from ``pieces``, no ids) with ``sequence_id`` and ``offset``."""
    n = max(1, ceil(n_docs / per_task))
    dealt = (parts.select("doc_id", "piece", "start", "length", "ids_crc32")
             .repartition(n, F.xxhash64("doc_id", "piece", "ids_crc32"))
             .sortWithinPartitions(F.desc("length"), "doc_id", "piece", "ids_crc32"))
    placed = pa.schema([*list(PIECES)[:-1], ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def run(batches):
        from pyspark import TaskContext
        first = TaskContext.get().partitionId() << 40

        def out():
            rows, again = tee(rows_of(batches))
            for row, (sequence, offset) in zip(rows, best_fit((r[3] for r in again), length)):
                yield (*row, first + sequence, offset)
        yield from batched(out(), placed, 8192)

    return dealt.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, **options) -> DataFrame:
    """Placement of every piece of every document: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    return pack(pieces(docs), docs.count(), **options)


def sequences(docs: DataFrame, placement: DataFrame) -> DataFrame:
    """``sequence_id, ids``: the packed sequences themselves, joined from the pieces' ids; a group is one sequence."""
    key = ["doc_id", "piece", "ids_crc32"]
    ids = pieces(docs, with_ids=True).select(*key, "ids").dropDuplicates(key)
    joined = placement.join(ids.select(*[F.col(k).alias(f"b_{k}") for k in key], "ids"),
                            F.expr(" AND ".join(f"{k} <=> b_{k}" for k in key)))
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return joined.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
