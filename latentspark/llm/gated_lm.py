"""Language-model scores of whole documents: a gated recurrent network over word classes, words by class counts.

p(word | before) = p(class | state) * p(word | class).  The network reads the
class sequence and predicts the next class; within a class, words have their
share of the corpus counts, and each class of rare words keeps a discounted
share for one unknown word, so the probabilities of all words sum to one.

Classes: all training documents are grouped by their frequent words; a
frequent word (at most ``max_words``, broadcast) belongs to the group in which
it is most over-represented and to a band of equal mass there; rare words fall
into classes by their shape, which needs no table; the end is a class.

Plan:

1. Counts of all training tokens by word, and of the documents that have it: counted per task, then one aggregate.  This is
   what the model knows of words, over the whole corpus.  The groups come from vectors of the words in most documents; the
   frequent words' tokens by group are one more count.
2. A written table holds each document's class sequence (a byte a token), the
   sums of its frequent words, and its rare words as counted rows.
3. Training in ``deals`` rounds: every task starts from the same weights, runs
   truncated back-propagation over the documents of the round (one of ``deals``
   parts of the training documents, by hash of the id) and returns its weights,
   averaged by an aggregate over weight numbers.  Each part has its round, so
   every training document is read once.  A task begins its long documents first, so
   that none of them is read alone at the end.
4. Scoring of every document, window by window with the state carried on, many
   documents side by side.  Rare words meet their counts in a join, and return
   as sums.

Edge cases: a null or empty text is its end alone; a null doc_id is a training
document; rows sharing a doc_id are scored each on its own; without training
documents N and V are 0 and every word has the uniform share of its class; an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame, functions as F

from latentspark.llm.common import batched, by_batch, numbered, rows_of
from latentspark.session import cut, drop_cut

GROUPS, BANDS, SHAPES = 8, 8, 8
END = GROUPS * BANDS + SHAPES
CLASSES = END + 1
HIDDEN = 16
WINDOW = 32


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))


def shape(word: bytes) -> int:
    """Class of a rare word by how it looks: a mark at its end, a letter outside ASCII, a long one."""
    return 4 * (not word[-1:].isalnum() and word[-1] < 128) + 2 * (not word.isascii()) + (len(word) > 10)


# ---------------------------------------------------------------- network

def _sizes(h: int = HIDDEN):
    return [("x", (CLASSES, 3 * h)), ("u", (h, 2 * h)), ("c", (h, h)), ("b", (h,)), ("o", (h, CLASSES)), ("p", (CLASSES,))]


_ENDS = np.cumsum([int(np.prod(size)) for _, size in _sizes()]).tolist()


def unpack(flat: np.ndarray) -> dict[str, np.ndarray]:
    """Named weights as views into one vector."""
    return {name: flat[lo:hi].reshape(size) for (name, size), lo, hi in zip(_sizes(), [0, *_ENDS], _ENDS)}


def start_weights(class_mass: np.ndarray, seed: int = 5) -> np.ndarray:
    """Small random weights; the output bias is the classes' log share, so training starts at class frequencies."""
    rng = np.random.default_rng(seed)
    flat = np.concatenate([rng.normal(0, 0.3 if n in "xuc" else 0.05, int(np.prod(s))) for n, s in _sizes()]).astype(np.float32)
    unpack(flat)["b"][:] = 0
    unpack(flat)["p"][:] = np.log((class_mass + 0.5) / (class_mass.sum() + 0.5 * CLASSES))
    return flat


def forward(w: dict, inputs: np.ndarray, state: np.ndarray, keep: dict | None = None):
    """States after each of the (steps, rows) inputs, and the last one; ``keep`` gets what back-propagation needs.

    Inside, arrays are (values, rows), so that gates and candidates are whole blocks of memory.  The weights of the gates are
    negated once, so that a gate is 1 / (1 + exp of its sum); every step writes into memory that ``keep`` holds.
    """
    steps, h, rows = len(inputs), state.shape[1], inputs.shape[1]
    table = w["x"].copy()
    np.negative(table[:, :2 * h], out=table[:, :2 * h])
    x = np.ascontiguousarray(table[inputs].transpose(0, 2, 1))
    joint = np.concatenate([-w["u"], w["c"]], axis=1).T.copy()
    bias = w["b"][:, None]
    states = np.empty((steps + 1, h, rows), dtype=np.float32)
    states[0] = state.T
    held = steps if keep is not None else 1
    sums, new = np.empty((held, 3 * h, rows), dtype=np.float32), np.empty((held, h, rows), dtype=np.float32)
    for t in range(steps):
        m, n, s, after, given = sums[t % held], new[t % held], states[t], states[t + 1], x[t]
        np.matmul(joint, s, out=m)
        g, inner = m[:2 * h], m[2 * h:]
        g += given[:2 * h]
        np.exp(g, out=g)
        g += 1
        np.reciprocal(g, out=g)
        inner += bias
        np.multiply(g[h:], inner, out=n)
        n += given[2 * h:]
        np.tanh(n, out=n)
        np.subtract(s, n, out=after)
        after *= g[:h]
        after += n
    if keep is not None:
        keep.update(before=states[:-1], gates=sums[:, :2 * h], inner=sums[:, 2 * h:], new=new)
    return states[1:].transpose(0, 2, 1), states[-1].T


def log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=-1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=-1, keepdims=True))


def with_one(states: np.ndarray) -> np.ndarray:
    """Flat states with a column of ones, which carries the output's bias through the same product."""
    flat = np.ones((states.shape[0] * states.shape[1], states.shape[2] + 1), dtype=np.float32)
    flat[:, :-1].reshape(states.shape)[:] = states
    return flat


def shares(flat: np.ndarray, w: dict) -> tuple[np.ndarray, np.ndarray]:
    """Unnormalised class shares of ``with_one(states)`` and their sums: one exponential per class, in place."""
    x = flat @ np.concatenate([w["o"], w["p"][None]])
    # states lie within -1 and 1, so this bounds every entry; only large weights need the shift by the row's maximum
    if float(np.abs(w["o"]).sum(axis=0).max() + np.abs(w["p"]).max()) > 60:
        x -= x.max(axis=1, keepdims=True)
    np.exp(x, out=x)
    return x, x @ np.ones(x.shape[1], dtype=x.dtype)


def gradient(w: dict, inputs: np.ndarray, targets: np.ndarray, live: np.ndarray, state: np.ndarray):
    """Gradient (flat) of the mean log loss over the live steps of a window, and the state after it."""
    h, rows = state.shape[1], inputs.shape[1]
    keep: dict = {}
    states, last = forward(w, inputs, state, keep)
    flat_states = with_one(states)
    total = max(float(live.sum()), 1.0)
    d, sums = shares(flat_states, w)
    weight = (live.ravel() / total).astype(np.float32)
    d *= (weight / sums)[:, None]
    d[np.arange(len(d)), targets.ravel()] -= weight
    g = np.zeros(_ENDS[-1], dtype=np.float32)
    gw = unpack(g)
    outward = flat_states.T @ d
    gw["o"][:], gw["p"][:] = outward[:-1], outward[-1]
    ds = np.ascontiguousarray((d @ w["o"].T).reshape(-1, rows, h).transpose(0, 2, 1))
    before, z, r, n = keep["before"], keep["gates"][:, :h], keep["gates"][:, h:], keep["new"]
    # what a change of the state does to the candidate, the update gate and the reset gate, for the whole window
    to_n = (1 - z) * (1 - n * n)
    to_z = (before - n) * z * (1 - z)
    to_r = keep["inner"] * r * (1 - r)
    back = np.concatenate([w["u"], w["c"]], axis=1)
    carry = np.zeros((h, rows), dtype=np.float32)
    # by step: changes of the update gate, the reset gate, the inner sum and the candidate
    joint = np.empty((len(inputs), 4 * h, rows), dtype=np.float32)
    for t in range(len(inputs) - 1, -1, -1):
        dh, j = ds[t], joint[t]
        dh += carry
        dn = np.multiply(dh, to_n[t], out=j[3 * h:])
        np.multiply(dh, to_z[t], out=j[:h])
        np.multiply(dn, to_r[t], out=j[h:2 * h])
        np.multiply(dn, r[t], out=j[2 * h:3 * h])
        np.matmul(back, j[:3 * h], out=carry)
        dh *= z[t]
        carry += dh
    joint = joint.transpose(0, 2, 1).reshape(-1, 4 * h)
    inward = before.transpose(0, 2, 1).reshape(-1, h).T @ joint[:, :3 * h]
    gw["u"][:], gw["c"][:] = inward[:, :2 * h], inward[:, 2 * h:]
    gw["b"][:] = joint[:, 2 * h:3 * h].sum(axis=0)
    given = inputs.ravel().astype(np.uint8)
    by = np.argsort(given, kind="stable")
    given = given[by]
    starts = np.concatenate([[0], np.flatnonzero(given[1:] != given[:-1]) + 1])
    added = np.add.reduceat(joint[by], starts, axis=0)
    gw["x"][given[starts], :2 * h], gw["x"][given[starts], 2 * h:] = added[:, :2 * h], added[:, 3 * h:]
    return g, last


def side_by_side(sequences, rows: int, window: int = WINDOW):
    """Windows of class sequences read side by side: a row that ends its document takes the next one.

    Yields ``inputs, targets, live, fresh, owner``: (window, rows) arrays, which
    rows start a document, and each row's document.  The first input is the end class.
    """
    source = iter(sequences)
    held: list = [None] * rows
    while True:
        fresh = np.zeros(rows, dtype=bool)
        for i in range(rows):
            if held[i] is None:
                item = next(source, None)
                if item is not None:
                    held[i] = [item[0], item[1], 0]
                    fresh[i] = True
        if all(x is None for x in held):
            return
        inputs = np.full((window, rows), END, dtype=np.int64)
        targets = np.full((window, rows), END, dtype=np.int64)
        live = np.zeros((window, rows), dtype=np.float32)
        owner = [x[0] if x else None for x in held]
        for i, x in enumerate(held):
            if x is None:
                continue
            _, seq, at = x
            n = min(window, len(seq) - at)
            targets[:n, i] = seq[at:at + n]
            inputs[1:n, i] = seq[at:at + n - 1]
            if at:
                inputs[0, i] = seq[at - 1]
            live[:n, i] = 1
            x[2] = at + n
            if x[2] >= len(seq):
                held[i] = None
        yield inputs, targets, live, fresh, owner


def train_on(flat: np.ndarray, sequences, rows: int = 64, rate: float = 0.01) -> tuple[np.ndarray, float]:
    """Weights after one pass of Adam over the class sequences, and the tokens seen."""
    flat = flat.astype(np.float32).copy()
    w = unpack(flat)
    m, v, seen = np.zeros_like(flat), np.zeros_like(flat), 0.0
    state = np.zeros((rows, HIDDEN), dtype=np.float32)
    for i, (inputs, targets, live, fresh, _) in enumerate(side_by_side(sequences, rows), 1):
        state[fresh] = 0
        used = int(live.any(axis=1).sum())
        at = np.flatnonzero(live[0])  # rows that still hold a document; others have no gradient
        g, state[at] = gradient(w, inputs[:used, at], targets[:used, at], live[:used, at], state[at])
        norm = float(np.linalg.norm(g))
        if norm > 1:
            g /= norm
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        flat -= rate / (1 + i / 500) * (m / (1 - 0.9 ** i)) / (np.sqrt(v / (1 - 0.99 ** i)) + 1e-8)
        seen += float(live.sum())
    return flat, seen


def class_scores(flat: np.ndarray, sequences, rows: int = 256):
    """Natural log probability of the class sequence of each document, by document."""
    w = unpack(flat.astype(np.float32))
    state = np.zeros((rows, HIDDEN), dtype=np.float32)
    total: dict = {}
    for inputs, targets, live, fresh, owner in side_by_side(sequences, rows):
        state[fresh] = 0
        used = int(live.any(axis=1).sum())
        at = np.flatnonzero(live[0])  # rows that still hold a document
        states, state[at] = forward(w, inputs[:used, at], state[at])
        x, sums = shares(with_one(states), w)
        hit = x[np.arange(len(x)), targets[:used, at].ravel()]
        said = np.log(np.maximum(hit, 1e-37) / sums).reshape(used, -1).astype(np.float64) * live[:used, at]
        for i, s in zip(at.tolist(), said.sum(axis=0).tolist()):
            total[owner[i]] = total.get(owner[i], 0.0) + s
    return total


# ---------------------------------------------------------------- corpus counts and classes

@dataclass
class Words:
    """Frequent words with class and count, class masses, and the figures of the corpus."""
    table: dict[bytes, int]
    classes: np.ndarray
    counts: np.ndarray
    mass: np.ndarray          # training tokens per class
    kinds: np.ndarray         # distinct rare words per shape
    n: int
    v: int
    discount: float


def split_words(column) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(document of each word, number of each word, the distinct words) of a column of texts.

    The words are those of ``word_list``; a word is compared with a table once a batch, not once a token.
    """
    lists = pa.compute.ascii_split_whitespace(pa.compute.ascii_lower(pa.compute.fill_null(column, "")))
    words = lists.flatten()
    doc = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    full = pa.compute.greater(pa.compute.binary_length(words), 0)  # a blank at an end of a text leaves an empty string
    if not pa.compute.all(full).as_py():
        words, doc = words.filter(full), doc[full.to_numpy(zero_copy_only=False)]
    coded = words.dictionary_encode()
    return doc, coded.indices.to_numpy().astype(np.int64), coded.dictionary.cast(pa.binary())


def places(words: pa.Array, known: pa.Array) -> np.ndarray:
    """Position of each of ``words`` in ``known``, -1 where it is not there."""
    return pa.compute.fill_null(pa.compute.index_in(words, value_set=known), -1).to_numpy().astype(np.int64)


def document_groups(train: DataFrame, max_marks: int = 300, steps: int = 20, seed: int = 3, counts: DataFrame | None = None):
    """(marks, centres): the words in most documents, and the centres of document groups over them, from all of ``train``.

    ``counts``: ``word_counts(train)``, if at hand.  Counts, starts and steps are jobs over every document; the driver holds
    ``max_marks`` words and the centres.  The vectors of a batch of documents are one row of bytes, since every step reads them.
    """
    counts = word_counts(train) if counts is None else counts
    top = counts.select("w", "docs").orderBy(F.desc("docs"), "w").limit(max_marks).collect()
    marks = {bytes(r["w"]): i for i, r in enumerate(top)}
    if not marks:
        return marks, np.zeros((1, 0), dtype=np.float32)

    def vectors(batches):
        for b in batches:
            if b.num_rows:
                x = mark_vectors(*split_words(b.column(1)), b.num_rows, marks)
                yield pa.RecordBatch.from_arrays([pa.array([b.column(0).to_numpy().astype(np.int64).tobytes()], pa.binary()),
                                                  pa.array([x.tobytes()], pa.binary())], schema=pa.schema([("ids", pa.binary()), ("x", pa.binary())]))

    def packed(batches):
        for b in batches:
            for ids, x in zip(*b.columns):
                yield np.frombuffer(ids.as_buffer(), dtype=np.int64), np.frombuffer(x.as_buffer(), dtype=np.float32).reshape(-1, len(marks))

    def ids_of(batches):
        for b in batches:
            for ids in b.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(ids.as_buffer(), dtype=np.int64))], names=["doc_id"])

    rows = cut(by_batch(train.select("doc_id", "text"), vectors, "ids binary, x binary"))
    # the first centre is a random document by its place among the ids: one count a range, then the place in one range
    ranged = cut(rows.select("ids").mapInArrow(ids_of, "doc_id long").repartitionByRange("doc_id").select(
        "doc_id", F.spark_partition_id().alias("part")))
    sizes = sorted((r["part"], r["n"]) for r in ranged.groupBy("part").agg(F.count("*").alias("n")).collect())
    place = int(np.random.default_rng(seed).integers(sum(n for _, n in sizes), size=1)[0])
    for part, n in sizes:
        if place < n:
            break
        place -= n
    chosen = ranged.filter(F.col("part") == part).orderBy("doc_id").offset(place).first()["doc_id"]

    def found(batches):
        for ids, x in packed(batches):
            at = np.flatnonzero(ids == chosen)
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array([x[at[0]].tobytes()], pa.binary())], names=["x"])

    centres = np.frombuffer(bytes(by_batch(rows, found, "x binary").first()["x"]), dtype=np.float32)[None].copy()
    drop_cut(ranged)
    while len(centres) < GROUPS:  # spread-out starts
        def farthest(batches, centres=centres):
            best = None
            for ids, x in packed(batches):
                far = 1 - (x @ centres.T).max(axis=1)
                for i in np.flatnonzero(far == far.max()).tolist():
                    mine = (-float(far[i]), int(ids[i]), x[i].tobytes())
                    best = mine if best is None or mine < best else best
            if best is not None:
                yield from batched([best], pa.schema([("near", pa.float64()), ("doc_id", pa.int64()), ("x", pa.binary())]))

        last = by_batch(rows, farthest, "near double, doc_id long, x binary").orderBy("near", "doc_id").limit(1).first()
        if not last["near"] < 0:  # no document lies away from the centres so far
            break
        centres = np.concatenate([centres, np.frombuffer(bytes(last["x"]), dtype=np.float32)[None]])
    for _ in range(steps):
        def sums(batches, centres=centres):
            total = np.zeros(centres.shape)
            for _, x in packed(batches):
                own = (x @ centres.T).argmax(axis=1)
                for g in np.unique(own).tolist():
                    total[g] += x[own == g].sum(axis=0, dtype=np.float64)
            g, i = np.nonzero(total)
            yield from batched(zip(g.tolist(), i.tolist(), total[g, i].tolist()),
                               pa.schema([("g", pa.int32()), ("i", pa.int32()), ("s", pa.float64())]), 65536)

        # at most one number for each centre and mark reaches the driver
        got = by_batch(rows, sums, "g int, i int, s double").groupBy("g", "i").agg(F.sum("s").alias("s")).toPandas()
        total = np.zeros(centres.shape)
        total[got["g"], got["i"]] = got["s"]
        size = np.linalg.norm(total, axis=1, keepdims=True)
        before, centres = centres, np.where(size > 0, total / np.maximum(size, 1e-12), centres).astype(np.float32)
        if np.allclose(before, centres, atol=1e-6):
            break
    drop_cut(rows)
    return marks, centres


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.fromiter(map(np.linalg.norm, x), dtype=np.float32, count=len(x)), np.float32(1e-12))[:, None]


def mark_vectors(doc: np.ndarray, numbers: np.ndarray, words: pa.Array, n: int, marks: dict[bytes, int]) -> np.ndarray:
    """Roots of the counts of ``marks`` in each of ``n`` documents, in unit length, from ``split_words``."""
    mark = places(words, pa.array(list(marks), type=pa.binary()))[numbers]
    at = mark >= 0
    count = np.bincount(doc[at] * len(marks) + mark[at], minlength=n * len(marks)).reshape(n, len(marks))
    return _unit(np.sqrt(count).astype(np.float32))


def mark_vector(words: list[bytes], marks: dict[bytes, int]) -> np.ndarray:
    """``mark_vectors`` of one document."""
    return mark_vectors(np.zeros(len(words), dtype=np.int64), np.arange(len(words)), pa.array(words, type=pa.binary()), 1, marks)[0]


def word_counts(train: DataFrame, marks: dict[bytes, int] | None = None, centres: np.ndarray | None = None, flush: int = 400_000) -> DataFrame:
    """``w, n, docs``: training tokens by word, and the documents that have it.  Ends are not in it.

    ``marks`` and ``centres`` are taken for callers that counted by document group here; ``group_counts`` does that now.
    """
    schema = pa.schema([("w", pa.binary()), ("n", pa.int64()), ("docs", pa.int64())])

    def run(batches):
        def merged(held):
            t = pa.concat_tables(held).group_by("w", use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
            return pa.table([t.column(c) for c in ("w", "n_sum", "docs_sum")], schema=schema)

        held, size = [], 0
        for b in batches:
            doc, numbers, words = split_words(b.column(0))
            k = max(len(words), 1)
            pairs = np.sort(doc * k + numbers)
            first = pairs[np.concatenate([[True], pairs[1:] != pairs[:-1]])] if len(pairs) else pairs
            held.append(pa.table([words, pa.array(np.bincount(numbers, minlength=len(words))),
                                  pa.array(np.bincount(first % k, minlength=len(words)))], schema=schema))
            size += len(words)
            if size >= flush:
                held = [merged(held)]
                size = held[0].num_rows
                if 2 * size >= flush:
                    yield from held[0].to_batches(max_chunksize=65536)
                    held, size = [], 0
        if held:
            yield from merged(held).to_batches(max_chunksize=65536)

    rows = by_batch(train.select("text"), run, "w binary, n long, docs long")
    return rows.groupBy("w").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def group_counts(train: DataFrame, marks: dict[bytes, int], centres: np.ndarray, frequent: list[bytes]):
    """(tokens of each frequent word by document group, all tokens by group), from every training document."""
    shared = train.sparkSession.sparkContext.broadcast((marks, centres, frequent))

    def run(batches):
        marks, centres, frequent = shared.value
        known = pa.array(frequent, type=pa.binary())
        total = np.zeros((GROUPS, len(frequent) + 1), dtype=np.int64)
        for b in batches:
            doc, numbers, words = split_words(b.column(0))
            x = mark_vectors(doc, numbers, words, b.num_rows, marks)
            own = np.fromiter(((centres @ v).argmax() for v in x), dtype=np.int64, count=len(x))
            # the last column has the words that are not frequent
            at = own[doc] * total.shape[1] + places(words, known)[numbers] % total.shape[1]
            total += np.bincount(at, minlength=total.size).reshape(total.shape)
        any_ = np.flatnonzero(total.any(axis=0))
        for a in range(0, len(any_), 65536):
            i = any_[a:a + 65536]
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), *[pa.array(t[i]) for t in total]],
                                             names=["i", *[f"n{g}" for g in range(GROUPS)]])

    names = [f"n{g}" for g in range(GROUPS)]
    found = by_batch(train.select("text"), run, "i int, " + ", ".join(f"{c} long" for c in names)).groupBy("i").agg(
        *[F.sum(c).alias(c) for c in names]).toArrow()
    total = np.zeros((len(frequent) + 1, GROUPS))
    total[found["i"].to_numpy()] = np.stack([found[c].to_numpy() for c in names], axis=1) if found.num_rows else 0
    return total[:-1], total.sum(axis=0)


def learn_words(counts: DataFrame, n_docs: int, max_words: int, by_group=None) -> Words:
    """Classes of the frequent words (count above a threshold that at most ``max_words`` pass) and the corpus figures.

    ``by_group``: from the list of frequent words to what ``group_counts`` returns; without it there is one group.
    """
    level = F.floor(64 * F.log2("n")).cast("int")
    steps = counts.groupBy(level.alias("level")).agg(F.count("*").alias("k"), F.sum("n").alias("n")).collect()
    seen = counts.agg(F.sum((F.col("n") == 1).cast("long")).alias("a"), F.sum((F.col("n") == 2).cast("long")).alias("b")).first()
    n, v = sum(r["n"] for r in steps), sum(r["k"] for r in steps)
    least, room = None, max_words
    for r in sorted(steps, key=lambda r: -r["level"]):
        room -= r["k"]
        if room < 0:
            break
        least = r["level"]
    frequent = counts.filter(level >= (least if least is not None else 1 << 20))
    top = frequent.select("w", "n").toArrow()
    words, count = top["w"].to_pylist(), top["n"].to_numpy().astype(np.int64)
    order = sorted(range(len(words)), key=lambda i: (-count[i], words[i]))
    words, count = [words[i] for i in order], count[order]
    if by_group is None:
        own = np.zeros(len(words), dtype=np.int64)
    else:
        grouped, size = by_group(words)
        own = (grouped / np.maximum(size, 1)).argmax(axis=1)
    classes = np.zeros(len(words), dtype=np.int64)
    for g in range(GROUPS):
        at = np.flatnonzero(own == g)
        share = np.cumsum(count[at]) - count[at] / 2
        classes[at] = g * BANDS + np.minimum((BANDS * share / max(count[at].sum(), 1)).astype(np.int64), BANDS - 1)
    rare = counts.filter(level < (least if least is not None else 1 << 20))
    shapes = {r["s"]: (r["m"], r["k"]) for r in rare.groupBy(shape_column().alias("s")).agg(
        F.sum("n").alias("m"), F.count("*").alias("k")).collect()}
    mass = np.zeros(CLASSES)
    np.add.at(mass, classes, count)
    kinds = np.zeros(SHAPES)
    for s, (m, k) in shapes.items():
        mass[GROUPS * BANDS + s], kinds[s] = m, k
    mass[END] = n_docs
    ones, twos = seen["a"] or 0, seen["b"] or 0
    return Words({w: i for i, w in enumerate(words)}, classes, count, mass, kinds, n + n_docs, v + (n_docs > 0),
                 min(max(ones / max(ones + 2 * twos, 1), 0.1), 0.9))


def shape_column() -> Column:
    """``shape`` of the binary column ``w`` as a Spark expression."""
    text = F.col("w").cast("string")
    last = F.substring(F.hex("w"), -2, 2)
    mark = (last < "80") & ~text.rlike(r"[0-9A-Za-z]\z")
    plain = ~text.rlike(r"[^\x00-\x7F]")
    return (F.when(mark, 4).otherwise(0) + F.when(plain, 0).otherwise(2) + F.when(F.octet_length("w") > 10, 1).otherwise(0)).cast("int")


PREPARED = pa.schema([("doc_id", pa.int64()), ("given", pa.int64()), ("held_out", pa.bool_()), ("seq", pa.binary()), ("known", pa.int64()),
                      ("base", pa.float64()), ("within", pa.float64()), ("rare", pa.list_(pa.binary())), ("times", pa.list_(pa.int32()))])


def prepare(docs: DataFrame, words: Words) -> DataFrame:
    """Per document of ``docs(doc_id, given, held_out, text)``: class sequence, sums of its frequent words, its rare words with ``times``."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches):
        words = shared.value
        known = pa.array(list(words.table), type=pa.binary())
        # a rare word has the last place
        base_of = np.append(np.log10((words.counts + 1) / (words.n + words.v + 1.0)), 0.0)
        end_base = float(np.log10((words.mass[END] + 1) / (words.n + words.v + 1.0)))
        within = np.append(np.log10(words.counts / np.maximum(words.mass[words.classes], 1)) if len(words.counts) else np.zeros(0), 0.0)
        for b in batches:
            rows = b.num_rows
            doc, numbers, distinct = split_words(b.column(3))
            place = places(distinct, known)
            kind = words.classes[place] if len(words.classes) else np.zeros(len(place), dtype=np.int64)
            lost = np.flatnonzero(place < 0)
            kind[lost] = [GROUPS * BANDS + shape(w) for w in distinct.take(pa.array(lost)).to_pylist()]
            at = place[numbers]
            seq = np.full(len(doc) + rows, END, dtype=np.uint8)
            seq[np.arange(len(doc)) + doc] = kind[numbers]
            ends = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=rows) + 1)]).astype(np.int32)
            sums = lambda a: np.bincount(doc, weights=a, minlength=rows).astype(float)
            k = max(len(distinct), 1)
            pairs, times = np.unique((doc * k + numbers)[at < 0], return_counts=True)
            starts = pa.array(np.searchsorted(pairs, np.arange(rows + 1) * k).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.BinaryArray.from_buffers(pa.binary(), rows, [None, pa.py_buffer(ends), pa.py_buffer(seq)]),
                 pa.array(np.bincount(doc[at >= 0], minlength=rows) + int(words.mass[END] > 0)), pa.array(sums(base_of[at]) + end_base),
                 pa.array(sums(within[at])), pa.ListArray.from_arrays(starts, distinct.take(pa.array(pairs % k))),
                 pa.ListArray.from_arrays(starts, pa.array(times.astype(np.int32)))], names=PREPARED.names)

    return by_batch(docs.select("doc_id", "given", "held_out", "text"), run,
                    "doc_id long, given long, held_out boolean, seq binary, known long, base double, within double, "
                    "rare array<binary>, times array<int>")


def long_first(sequences, most: int = 4_000_000):
    """The sequences of at most about ``most`` tokens at a time, those of 1,024 tokens and more first, by whole thousands; the others stay in order.

    A document is read from start to end by one row.  A long one that starts last would go on alone, window after window.
    """
    held, size = [], 0
    for item in sequences:
        held.append(item)
        size += len(item[1])
        if size >= most:
            yield from sorted(held, key=lambda s: -(len(s[1]) >> 10))
            held, size = [], 0
    yield from sorted(held, key=lambda s: -(len(s[1]) >> 10))


def train(prepared: DataFrame, words: Words, *, deals: int = 8) -> np.ndarray:
    """Weights after ``deals`` rounds of parallel training and averaging; round r reads part r of the documents not held out."""
    context = prepared.sparkSession.sparkContext
    flat = start_weights(words.mass)
    for r in range(deals):
        weights = context.broadcast(flat)
        part = prepared.filter(~F.col("held_out") & (F.pmod(F.xxhash64("doc_id", F.lit(99)), F.lit(deals)) == r))

        def run(batches, weights=weights):
            new, seen = train_on(weights.value, long_first((d, np.frombuffer(seq, dtype=np.uint8)) for d, seq in rows_of(batches)))
            if seen:
                yield from batched(((i, float(x) * seen, seen) for i, x in enumerate(new.tolist())),
                                   pa.schema([("i", pa.int32()), ("x", pa.float64()), ("n", pa.float64())]), 65536)

        rows = by_batch(part.select("doc_id", "seq"), run, "i int, x double, n double").groupBy("i").agg(
            (F.sum("x") / F.sum("n")).alias("x")).toPandas()
        if len(rows):
            flat = rows.sort_values("i")["x"].to_numpy().astype(np.float32)
    return flat


SCORED = pa.schema([("doc_id", pa.int64()), ("given", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("known", pa.int64()),
                    ("base", pa.float64()), ("score", pa.float64())])


def score_frequent(prepared: DataFrame, flat: np.ndarray, chunk: int = 4096) -> DataFrame:
    """Per document: tokens, class sequence and frequent words scored."""
    shared = prepared.sparkSession.sparkContext.broadcast(flat)

    def run(batches):
        def finish(held):
            longest = sorted(enumerate(h[3] for h in held), key=lambda s: -len(s[1]))
            said = class_scores(shared.value, longest)
            for i, (d, given, out, seq, known, base, within) in enumerate(held):
                yield d, given, out, len(seq), known, base, said[i] / float(np.log(10)) + within

        def out():
            held, size = [], 0
            for d, given, held_out_, seq, *sums in rows_of(batches):
                held.append((d, given, held_out_, np.frombuffer(seq, dtype=np.uint8), *sums))
                size += len(seq)
                if len(held) >= chunk or size >= 4_000_000:
                    yield from finish(held)
                    held, size = [], 0
            if held:
                yield from finish(held)
        yield from batched(out(), SCORED, 1024)

    return by_batch(prepared.select("doc_id", "given", "held_out", "seq", "known", "base", "within"), run,
                    "doc_id long, given long, held_out boolean, n_tokens long, known long, base double, score double")


def score_documents(docs: DataFrame, *, max_words: int = 200_000, deals: int = 8) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per row of ``docs(doc_id, text)``."""
    docs, own = numbered(docs)
    marked = docs.withColumn("given", F.col(own or "doc_id")).withColumn("held_out", held_out(F.col("given")))
    training = marked.filter("NOT held_out")
    counts = cut(word_counts(training))
    marks, centres = document_groups(training, counts=counts)
    words = learn_words(counts, training.count(), max_words, lambda frequent: group_counts(training, marks, centres, frequent))
    prepared = cut(prepare(marked, words))
    scored = score_frequent(prepared, train(prepared, words, deals=deals))
    total = words.n + words.v + 1.0
    rare = prepared.select("doc_id", F.explode(F.arrays_zip("rare", "times")).alias("r")).select(
        "doc_id", F.col("r.rare").alias("w"), F.col("r.times").alias("tf"))
    met = rare.join(counts.select("w", "n").hint("merge"), "w", "left")
    s = shape_column()
    mass, kinds = (F.element_at(F.array(*[F.lit(float(x)) for x in a]), s + 1)
                   for a in (words.mass[GROUPS * BANDS:END], words.kinds))
    c = F.coalesce(F.col("n"), F.lit(0))
    # absolute discounting; the unknown word of a shape never seen has all of it
    share = F.when(mass == 0, 1.0).when(c > 0, (c - words.discount) / mass).otherwise(words.discount * kinds / mass)
    sums = met.groupBy(F.col("doc_id").alias("d")).agg(
        F.sum(F.when(c > 0, F.col("tf")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("tf") * F.log10((c + 1) / F.lit(total))).alias("rare_base"),
        F.sum(F.col("tf") * F.log10(share)).alias("rare_score"))
    out = scored.join(sums.hint("merge"), F.col("doc_id") == F.col("d"), "left")
    zero = lambda name: F.coalesce(F.col(name), F.lit(0))
    return out.select(F.col("given").alias("doc_id"), "held_out", "n_tokens", (F.col("known") + zero("rare_known")).alias("n_known"),
                      F.lit(int(words.n)).cast("long").alias("train_tokens"), (F.col("base") + zero("rare_base")).alias("base_score"),
                      (F.col("score") + zero("rare_score")).alias("score"))
