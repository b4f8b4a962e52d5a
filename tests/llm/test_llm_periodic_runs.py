"""Periodic runs against a brute-force version, as one piece and word by word; edge cases; the query's digests."""

import hashlib
import random
import re
import zlib

import numpy as np

from latentspark.llm import periodic_runs as p


def brute(words, exponent=4, min_length=6):
    out = []
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(min_length, exponent * q):
                part = words[i:j + q]
                if not any(part[d:] == part[:-d] for d in range(1, q)):
                    out.append((i, j - i + q, q))
            i = max(j, i) + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def made(rng):
    n, k = rng.choice([5, 8, 20, 60, 150, 300]), rng.choice([1, 2, 2, 3, 5, 50])
    w = [rng.randrange(k) for _ in range(n)]
    for _ in range(rng.randrange(4)):
        a = rng.randrange(n)
        q, e = 1 + rng.randrange(max(1, (n - a) // 2)), rng.randrange(a, n + 1)
        for i in range(a, e):
            w[i] = w[a + (i - a) % q]
    return w


def test_runs_equal_brute_force_however_the_words_arrive():
    rng = random.Random(5)
    for _ in range(250):
        w, exponent, least = made(rng), rng.choice([2, 3, 4, 4]), rng.choice([1, 6])
        want = brute(w, exponent, least)
        catcher, step, i = p.RunCatcher(exponent, least), rng.choice([1, 3, 17, 1000]), 0
        while i < len(w):
            catcher.append(np.array(w[i:i + step]))
            i += step
        assert catcher.finish() == want, (w, exponent, least, step)


def test_hash_collisions_change_nothing(monkeypatch):
    monkeypatch.setattr(p, "paired", lambda a, b: (a + b) & np.uint64(1))  # blocks hardly differ by hash
    rng = random.Random(9)
    for _ in range(60):
        w = made(rng)
        assert p.runs_of([b"%d" % x for x in w]) == brute(w) if len(w) >= 6 else True


def test_multiples_of_a_period_and_long_texts():
    assert p.runs_of([b"a"] * 50_000) == [(0, 50_000, 1)]
    assert p.runs_of([b"a", b"b", b"c"] * 40_000) == [(0, 120_000, 3)]
    words = [b"%d" % i for i in range(90_000)]
    words[70_000:70_400] = words[70_000:70_100] * 4   # across two stretches is the next one
    words[65_500:65_600] = [b"x", b"y"] * 50
    assert p.runs_of(words) == [(65_500, 100, 2), (70_000, 400, 100)]


def test_edge_rows(spark):
    texts = [None, "", " \t\n", "a", "x x x x x", "x x x x x x", "a b " * 4, "é ü é ü é ü é ü z", "A a A a A a A a", "q\x0bq\x0cq\rq q q"]
    rows = [(i, t, "own") for i, t in enumerate(texts)] + [(5, texts[5], "own"), (None, "n " * 9, "own")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, periodic string")
    got = p.find_runs(docs, into="p2").select("doc_id", "text", "periodic", "p2.*").collect()
    assert len(got) == len(rows)
    for r in got:
        words = re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")
        assert (r["n_words"], [tuple(x) for x in r["runs"]], r["periodic"]) == (len(words), brute(words), "own")
    assert {r["doc_id"]: r["collapsed"] for r in got}[6] == "a b"
    assert p.find_runs(docs.limit(0)).count() == 0


def test_query_equals_brute_force(spark):
    from latentspark.llm.registry import op12_periodic_runs
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in op12_periodic_runs(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    checked = 0
    for r in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")
        n, h = len(w), zlib.crc32(str(r["doc_id"]).encode())
        if n > 600:
            continue
        g = h // 10
        if h % 10 == 0 and n > 0:
            a = g % n
            q = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % q] for i in range(n)]
        runs = brute(w)
        drop = {k for s, length, q in runs for k in range(s + q, s + length)}
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want = (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in drop)))
        assert tuple(got[r["doc_id"]])[1:] == want
        checked += bool(runs)
    assert checked >= 5
