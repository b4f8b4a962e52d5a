"""Near duplicates, repeated strings and suffix arrays against brute force."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from latentspark.llm import repeats, superminhash as s
from latentspark.llm.common import components, table
from latentspark.llm.suffix import common_prefixes, suffix_array

from conftest import SF001


# ------------------------------------------------------------------ components

def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3), (3, None), (205, 203), (203, 205)]
    got = dict(components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert all(got[i] == 0 for i in range(41)) and all(got[100 + i] == 100 for i in range(30)) and got[205] == got[203] == 203
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


# ------------------------------------------------------------------ near duplicates

def brute_groups(rows):
    sets = {}
    for d, t in rows:
        w = (t or "").encode().lower().split()
        sets[d] = frozenset() if not w else frozenset([tuple(w)]) if len(w) < 5 else frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    holders, ids = defaultdict(list), sorted(sets)
    for d in ids:
        common = defaultdict(int)
        for x in sets[d]:
            for o in holders[x]:
                common[o] += 1
            holders[x].append(d)
        for o, k in common.items():
            if 100 * k >= 75 * (len(sets[d]) + len(sets[o]) - k):
                a, b = find(d), find(o)
                parent[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), find(d)) for d in ids}


def near_copies(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows, bases = [], [[rng.choice(words) for _ in range(rng.randint(1, 120))] for _ in range(12)]
    for i in range(n):
        w = list(rng.choice(bases))
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = rng.choice(words)
        rows.append((i, " ".join(w)))
    return rows


@pytest.mark.parametrize("block", [3000, 7])
def test_groups_match_brute_force(spark, block):
    rows = near_copies(5, 220) + [(500, None), (501, ""), (502, " \t"), (503, "One two"), (504, "one TWO"), (505, "one two three"),
                                  (506, "x " * 9000), (507, "X " * 9000)]
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, component_id int").repartition(5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in s.near_duplicates(docs, block=block).collect()}
    want = brute_groups(rows)
    assert got == {d: (n, c, c == d) for d, (n, c) in want.items()}
    assert len({c for _, c in want.values()}) < 0.6 * len(rows)


def test_groups_of_the_small_table(spark):
    docs = table(spark, SF001, "documents")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in s.near_duplicates(docs).collect()}
    assert got == brute_groups([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])


def test_repeated_and_null_ids(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(1, a), (2, b), (9, a), (9, b), (9, b), (4, c), (None, c), (None, a), (5, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = s.near_duplicates(docs).collect()
    assert len(out) == len(rows)
    assert {(r["doc_id"], r["component_id"]) for r in out} == {(1, 1), (2, 1), (9, 1), (4, 4), (None, None), (5, 5)}
    assert sorted(str(r["doc_id"]) for r in s.keep_one(docs).collect()) == ["1", "4", "5", "5"]
    assert s.near_duplicates(docs.limit(0)).count() == 0


def test_unique_documents_without_id_stay(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(None, b, "x"), (None, c, "x"), (None, c, "x"), (7, a, "x"), (None, a, "x"), (None, None, "x")]
    out = s.keep_one(spark.createDataFrame(rows, "doc_id long, text string, kept_id string"))
    assert out.columns == ["doc_id", "text", "kept_id"]
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in out.collect()))) == sorted(map(str, [(7, a), (None, b), (None, c), (None, None)]))


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    errors = []
    for shared in (0, 250, 500, 800, 1000):
        x, y = pool[:1000], np.concatenate([pool[:shared], pool[2000:3000 - shared]])
        true = shared / (2000 - shared)
        h = s.signatures([np.unique(x), np.unique(y)], 200)
        errors.append(abs(float((h[0] == h[1]).mean()) - true))
    assert max(errors) < 0.1 and errors[0] == 0 and errors[-1] == 0
    # alone or among others, a set has the same signature, and every slot of it is filled
    one = s.signatures([np.unique(pool[:3])], 200)
    assert np.array_equal(one[0], s.signatures([np.unique(pool[:900]), np.unique(pool[:3])], 200)[1]) and np.isfinite(one).all()


# ------------------------------------------------------------------ suffix arrays and repeats

def test_suffix_arrays_and_prefixes():
    rng = random.Random(0)
    for _ in range(400):
        letters, n = rng.choice([1, 2, 3, 9]), rng.randint(0, 60)
        body = [rng.randint(1, letters) for _ in range(n)]
        if rng.random() < 0.3:
            body = (body[:max(1, n // 4)] * 8)[:n]
        t = np.array([*body, 0])
        sa = suffix_array(t)
        assert sa.tolist() == sorted(range(len(t)), key=lambda i: t[i:].tolist())
        stop = t <= 1
        lcp = common_prefixes(t, sa, stop)
        for a, b in zip(sa[:-1], sa[1:]):
            k = 0
            while max(a, b) + k < len(t) and t[a + k] == t[b + k] and not stop[b + k]:
                k += 1
            assert lcp[b] == k


def brute_repeats(rows, length):
    seen, out = set(), {}
    for d, t in sorted(rows):
        b = (t or "").encode()
        inside = np.zeros(len(b) + 1, int)
        for i in range(len(b) - length + 1):
            w = b[i:i + length]
            if w in seen:
                inside[i] += 1
                inside[i + length] -= 1
            seen.add(w)
        c = np.cumsum(inside)[:len(b)] > 0
        kept = bytes(np.frombuffer(b, np.uint8)[~c])
        out[d] = (len(b), int(c.sum()), int((np.diff([0, *c.astype(int), 0]) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


def passages(seed, n, letters, size):
    rng = random.Random(seed)
    bases = ["".join(rng.choice(letters) for _ in range(size)) for _ in range(6)]
    def piece():
        return rng.choice(bases)[rng.randint(0, 20):rng.randint(size // 2, size)] if rng.random() < 0.5 else "".join(
            rng.choice(letters) for _ in range(rng.randint(0, 30)))
    return [(i, "".join(piece() for _ in range(rng.randint(0, 6)))) for i in range(n)]


HARD = [(900, None), (901, ""), (902, "a" * 3000), (903, "a" * 2500 + "b"), (904, "ab" * 700), (905, "é" * 90), (906, "xé" * 90),
        (907, "\x00" * 500), (908, "\x01\x00" * 300), (909, "short")]


@pytest.mark.parametrize("options", [{}, {"max_segments": 1}, {"chunk_bytes": 400}, {"length": 30, "gram": 8}])
def test_repeats_match_brute_force(spark, options):
    rows = passages(3, 40, "ab", 220) + [(100 + d, t) for d, t in passages(4, 40, "abcdefgh é", 400)] + HARD
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: tuple(r)[1:5] for r in repeats.remove_repeats(docs, **options).collect()}
    assert got == brute_repeats(rows, options.get("length", 100))


def test_repeats_do_not_depend_on_the_order_of_rows(spark):
    """The input's rows come in another order on every evaluation, as after a shuffle that is computed again."""
    rng = np.random.default_rng(6)
    passages = ["".join(rng.choice(list("abcdefghij "), 140)) for _ in range(6)]
    rows = [(d, "".join(passages[k] if rng.random() < 0.6 else "".join(rng.choice(list("klmnop "), 30))
                        for k in rng.integers(0, 6, 4))) for d in range(240)]

    def permuted(batches):
        import pyarrow as pa
        table = pa.Table.from_batches(list(batches))
        if table.num_rows:
            order = np.random.default_rng().permutation(table.num_rows)
            yield from table.take(pa.array(order)).combine_chunks().to_batches()

    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2, "doc_id").mapInArrow(permuted, "doc_id long, text string")
    want = brute_repeats(rows, 100)
    assert any(v[1] for v in want.values())
    for _ in range(2):
        got = {r["doc_id"]: tuple(r)[1:5] for r in repeats.remove_repeats(docs, batch_rows=7).collect()}
        assert got == want


def test_repeats_across_the_cuts_of_a_long_text(monkeypatch):
    rng = random.Random(1)
    t = "".join(rng.choice("abcdefg") for _ in range(6000)).encode()
    whole = repeats.text_segments(t, 100, 24)
    monkeypatch.setattr(repeats, "PLACE_BITS", 10)
    cut = repeats.text_segments(t, 100, 24)
    # other segments, but each string still lies in exactly one and has the same key there up to its bits
    for k, c, s_, n in (whole, cut):
        starts = np.concatenate([np.arange(a, a + b - 99) for a, b in zip(s_, n)])
        assert np.array_equal(np.sort(starts), np.arange(6000 - 99))


def test_repeats_with_repeated_and_null_ids(spark):
    docs = spark.createDataFrame([(1, "x" * 150), (1, "x" * 150), (None, "x" * 150), (2, "y")], "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["n_removed"]) for r in repeats.remove_repeats(docs).collect())
    assert got == [("1", 150), ("1", 150), ("2", 0), ("None", 149)]
    assert repeats.remove_repeats(docs.limit(0)).count() == 0


def test_repeats_of_the_small_table(spark):
    docs = table(spark, SF001, "documents").select("doc_id", "text")
    got = {r["doc_id"]: tuple(r)[1:5] for r in repeats.remove_repeats(docs).collect()}
    assert got == brute_repeats([tuple(r) for r in docs.collect()], 100)
