"""Personal data, chat, WARC, packing, nearest neighbours and the language model."""

import base64
import hashlib
import io
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from latentspark.llm import chat, forest, gated_lm as lm, packing, personal_data as pd_, registry, warc
from latentspark.llm.common import table

from conftest import SF001

# ------------------------------------------------------------------ personal data
PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def luhn(x):
    total = 0
    for i, c in enumerate(reversed(x)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(text):
    text, out, n = text or "", [], []
    for kind, pattern in PATTERNS:
        k = 0
        for m in re.finditer(pattern, text, re.A):
            d = re.sub("[^0-9]", "", m.group())
            if {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                    "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]:
                out.append(f"{kind}:{m.start()}:{m.end()}")
                k += 1
        n.append(k)
    return n, ",".join(out)


def check_spans(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = pd_.learn_spans(docs)
    texts = dict(rows)
    for r in pd_.span_report(docs, model).collect():
        n, want = base_spans(texts[r["doc_id"]])
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == n, texts[r["doc_id"]]
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest() and r["spans"].startswith(want)
    return docs, model


def test_base_spans_of_hard_and_random_texts(spark):
    rng = random.Random(4)
    parts = ["a@b.c", "+x@d.e", "..@-.-", "x@@y.z", "1.2.3.4", "999.1.1.1", "0255.00.1.256", "1.1.1.", "4111 1111 1111 1111", "-", "+1 (504) 555-2652",
             "+1+22", "5", " ", "é", "😀", "12345678901234567890", "\n", "@", ".", "x", "4111-1111-1111-1111"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))) for i in range(400)]
    rows += [(1000, None), (1001, ""), (1002, "1" * 20_000 + " " + "a" * 30_000 + "1.1.1." * 2000 + "a.b" * 5000 + "@x" + ".y" * 5000)]
    check_spans(spark, rows)


def test_added_spans_and_redaction(spark):
    key = "9b0b3c6a43eb78aa99cbd7049c572391524f37a8"
    rows = [(i, f'text token = "{key}" and 5392740730042733{i % 10} mail me.{i}@x.org') for i in range(40)]
    rows += [(100 + i, f"order 539274073004273{i % 10} of 2024-05-0{i % 9} in issue 12345678{i}") for i in range(80)] + [(300, None)]
    docs, model = check_spans(spark, rows)
    out = {r["doc_id"]: r for r in pd_.redact(docs.withColumn("pii_spans", F.lit("mine")), model).collect()}
    assert out[3]["text"].startswith('text token = "<SECRET>" and') and out[3]["text"].endswith("mail <EMAIL>")
    assert out[300]["text"] is None and out[3]["pii_spans"] == "mine"
    assert all("<SECRET>" not in out[100 + i]["text"] for i in range(80))
    with_one, against = model.reliabilities[3][1]
    assert with_one > against  # the cue-word labeler is found to speak for personal data


def test_no_candidates(spark):
    docs = spark.createDataFrame([(1, "plain words")], "doc_id long, text string")
    assert pd_.learn_spans(docs).weights == {}
    assert pd_.span_report(docs.limit(0), pd_.SpanModel()).count() == 0


def test_estimation_recovers_planted_reliabilities():
    rng = np.random.default_rng(0)
    accuracy, counts = [0.95, 0.8, 0.7, 0.55], Counter()
    for _ in range(20_000):
        y = 1 if rng.random() < 0.4 else -1
        counts[tuple((y if rng.random() < a else -y) if rng.random() < 0.9 else 0 for a in accuracy)] += 1
    post, rel, prior = pd_.estimate(dict(counts))
    found = [(r[1][0] / (r[1][0] + r[-1][0]) + r[-1][1] / (r[1][1] + r[-1][1])) / 2 for r in rel]
    assert abs(prior - 0.4) < 0.05 and np.allclose(found, accuracy, atol=0.05)


# ------------------------------------------------------------------ chat
CONTROLS = ["<|im_end|>\n", "<|im_start|>", "<|im_sep|>", "⁠", "<", "|", "[INST]", "[/INST]", "</s>", "<s>", "<<SYS>>", "a", "\n", "["]


def told(turns):
    return hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()


def test_conversations_round_trip(spark):
    rng = random.Random(9)
    rows = [(c, t, rng.choice(["assistant", "user", "system", "".join(rng.choices(CONTROLS, k=3))]), "".join(rng.choices(CONTROLS, k=rng.randint(0, 9))))
            for c in range(60) for t in range(rng.randint(1, 5))]
    rows += [(100, 0, None, None), (None, None, None, "q"), (None, None, None, "q"), (101, 1, "assistant", "a"), (101, 1, "assistant", "a")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, formatted int")
    back = chat.read_back(chat.render(chat.fold_events(chat.events_of(df))))
    by_conv = defaultdict(list)
    for c, t, r, x in rows:
        by_conv[c].append((t if t is not None else -1, r or "", x or ""))
    for r in chat.digests(back).collect():
        turns = [x[1:] for x in sorted(by_conv[r["conv_id"]])]
        learned = "".join(x for role, x in turns if role == "assistant")
        assert (r["n_turns"], r["turns_sha256"]) == (len(turns), told(turns))
        assert (r["loss_chars"], r["loss_sha256"]) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert back.count() == len(by_conv)


def test_event_log_is_folded(spark):
    log = [(1, 1, 10, "delta", "user", "he"), (1, 2, 10, "delta", None, "llo"), (1, 3, 11, "delta", "assistant", "bad"),
           (1, 4, 12, "delta", "user", "and?"), (1, 5, 11, "regenerate", None, None), (1, 6, 11, "delta", "assistant", "go"),
           (1, 7, 11, "delta", None, "od"), (2, 1, 1, "delta", "user", "x"), (2, 2, 2, "delta", "assistant", "y"),
           (2, 3, 1, "edit", None, "HELLO"), (2, 4, 3, "delta", "assistant", "fin"), (3, 1, 1, "delta", "user", None)]
    df = spark.createDataFrame(random.Random(0).sample(log, len(log)), "conv_id long, seq long, message long, op string, role string, text string")
    got = defaultdict(list)
    for r in chat.fold_events(df).orderBy("conv_id", "place").collect():
        got[r["conv_id"]].append((r["role"], r["text"]))
    assert got == {1: [("user", "hello"), ("assistant", "good")], 2: [("user", "HELLO"), ("assistant", "fin")], 3: [("user", "")]}
    assert chat.render(chat.fold_events(df.limit(0))).count() == 0


def test_planted_conversation_is_in_the_query(spark):
    text = "</s>[INST] ok [/INST]"
    r = registry.op6_chat_events(spark, SF001).filter("conv_id = -7").first()
    assert (r["n_turns"], r["loss_chars"], r["turns_sha256"]) == (2, len(text), told([("user", text), ("assistant", text)]))


# ------------------------------------------------------------------ WARC

def test_archives_round_trip(spark, tmp_path):
    rng = random.Random(2)
    pages = [(i, f"http://x/{i}\n", "".join(rng.choices(["<p>", "word ", "é", "\x00"], k=rng.randint(0, 40)))) for i in range(200)]
    pages += [(300 + i, None, "same body") for i in range(50)] + [(400, "", None), (401, "", ""), (None, "n", "same body"), (None, "n", "only null"),
                                                                  (500, "u", "zz"), (500, "u", "zz")]
    df = spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, html string, refers_to int").repartition(3)
    first = {}
    for i, _, h in pages:
        k = h or ""
        first[k] = min((x for x in (first.get(k), i) if x is not None), default=None)
    want = Counter()
    for i, _, h in pages:
        b = (h or "").encode()
        refers = None if i == first[h or ""] else first[h or ""]
        want[(i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if refers is None else "revisit", refers)] += 1
    manifest = warc.write_archives(df, str(tmp_path), archive_bytes=2000)
    assert manifest.count() > 3
    assert Counter(tuple(r) for r in warc.read_archives(manifest, str(tmp_path)).collect()) == want
    assert warc.round_trip(spark, df.limit(0)).count() == 0


def test_small_payloads_are_responses(spark):
    df = spark.createDataFrame([(1, "", "ab"), (2, "", "ab"), (3, "", "abcdef"), (4, "", "abcdef")], "page_id long, url string, html string")
    kinds = {r["page_id"]: r["record_type"] for r in warc.round_trip(spark, df, min_bytes=4).collect()}
    assert kinds == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_dictionary_leads_and_damage_is_seen():
    rng = random.Random(1)
    raw = [warc.record(i, "u", ("<html><body>" + " ".join(rng.choices(["alpha", "beta", "gamma"], k=60))).encode(), None) for i in range(300)]
    data = warc.archive(raw)
    magic, size = struct.unpack("<II", data[:8])
    assert magic == 0x184D2A5D and 0 < size < len(data)
    assert list(warc.records_of(io.BytesIO(data))) == raw
    import zstandard
    alone = sum(len(zstandard.ZstdCompressor(level=3).compress(x)) for x in raw)
    assert len(data) - size < alone  # the dictionary pays on records
    with pytest.raises(Exception):
        list(warc.records_of(io.BytesIO(data[:-7])))
    assert list(warc.records_of(io.BytesIO(warc.archive([b"x"])))) == [b"x"]  # too little for a dictionary


# ------------------------------------------------------------------ packing

def slow_ids():
    import public_tokenizers as files
    from tokenizers import Tokenizer
    slow = Tokenizer.from_file(files.path("byte_bpe_50k.json"))
    return lambda t: slow.encode(t, add_special_tokens=False).ids


PIECES = ["a", "b'", " ", "\n", "\t", "\x0b", "\x1c", "\x85", " ", "é", "ß", "À", "0", "12", ".", "<|endoftext|>", "'re", "'LL", "中", "😀", "Ω", "́"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=30))
def test_fast_ids_equal_the_tokenizer_file(parts):
    text = "".join(parts)
    assert packing.encoder()(text) == slow_ids_once()(text)


_slow = []


def slow_ids_once():
    if not _slow:
        _slow.append(slow_ids())
    return _slow[0]


def test_every_latin_character_gives_the_same_ids():
    for c in range(0x250):
        for t in (chr(c), f"a{chr(c)}b", chr(c) * 3 + " x", f" {chr(c)}1"):
            assert packing.encoder()(t) == slow_ids_once()(t), hex(c)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=120))
def test_best_fit_against_a_scan_of_all_bins(lengths):
    lengths = sorted(lengths, reverse=True)
    spaces, want = [], 0
    for x in lengths:
        fit = [s for s in spaces if s >= x]
        if fit:
            spaces.remove(min(fit))
            spaces.append(min(fit) - x)
        else:
            want += 1
            spaces.append(64 - x)
    placed = list(packing.best_fit(lengths, 64))
    used = defaultdict(int)
    for x, (sequence, offset) in zip(lengths, placed):
        assert offset == used[sequence]
        used[sequence] += x
    assert len(used) == want and all(v <= 64 for v in used.values())


def test_placement_and_sequences(spark):
    rng = random.Random(0)
    rows = [(i, " ".join(rng.choices(["alpha", "beta", "gamma"], k=rng.randint(0, 400)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "long " * 5000), (1, rows[1][1]), (None, "no id")]
    docs = spark.createDataFrame([(d, t, 7) for d, t in rows], "doc_id long, text string, offset int")
    placement = packing.pack_documents(docs, per_task=30)
    out = placement.collect()
    ids = {}
    for d, t in rows:
        ids[d] = [*slow_ids_once()(t or ""), 2]
    total = 0
    for d in ids:
        copies = sum(1 for x, _ in rows if x == d)
        pieces = sorted({(r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out if r["doc_id"] == d})
        assert sum(1 for r in out if r["doc_id"] == d) == copies * len(pieces)
        n, k = len(ids[d]), -(-len(ids[d]) // 1024)
        first = n - 1024 * (k - 1)
        assert [p[2] for p in pieces] == [first] + [1024] * (k - 1)
        for _, start, length, crc in pieces:
            assert crc == zlib.crc32(np.array(ids[d][start:start + length], dtype="<u4").tobytes())
        total += copies * n
    fill = defaultdict(list)
    for r in out:
        fill[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(fill) <= -(-total // 1024) + 4
    built = {r["sequence_id"]: r["ids"] for r in packing.sequences(docs, placement).collect()}
    assert sum(map(len, built.values())) == total and all(v.count(2) >= 1 or len(v) == 1024 for v in built.values())
    assert packing.pack_documents(docs.limit(0)).count() == 0


# ------------------------------------------------------------------ nearest neighbours

def brute_nearest(ids, x, every=50, k=5):
    out = {}
    for i in [j for j, v in enumerate(ids) if v % every == 0]:
        s = x @ x[i] / (np.linalg.norm(x, axis=1) * np.linalg.norm(x[i]))
        out[ids[i]] = [(ids[j], s[j]) for j in np.lexsort((ids, -s)) if ids[j] != ids[i]][:k]
    return out


def test_recall_on_the_small_table(spark):
    rows = table(spark, SF001, "embeddings").select("vec_id", "embedding").collect()
    ids, x = [r[0] for r in rows], np.array([r[1] for r in rows], dtype=float)
    got = defaultdict(dict)
    for r in registry.op5_projection_forest(spark, SF001).collect():
        got[r["query_id"]][r["rank"]] = (r["vec_id"], r["score"])
    want = brute_nearest(ids, x)
    assert set(got) == set(want) and all(sorted(v) == [1, 2, 3, 4, 5] for v in got.values())
    hits = sum(len({a for a, _ in got[q].values()} & {a for a, _ in w}) for q, w in want.items())
    assert hits >= 0.9 * 5 * len(want)
    for q, w in want.items():
        for a, s in w:
            assert all(abs(s - s2) < 1e-12 for a2, s2 in got[q].values() if a2 == a)


def test_ties_copies_and_unusable_vectors(spark):
    rows = [(i, [1.0, 0.0, float(i % 3)]) for i in range(400)]
    rows += [(1000, None), (1050, [0.0, 0.0, 0.0]), (1100, [float("nan"), 1.0, 2.0]), (1150, [1.0, 2.0]), (1200, []), (1250, [None, 1.0, 1.0]),
             (1300, [float("inf"), 1.0, 1.0]), (None, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<double>, rank int")
    got = defaultdict(list)
    for r in forest.nearest(df, leaf_rows=3, sample_rows=50).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["vec_id"])
    assert set(got) == set(range(0, 400, 50))
    for q, found in got.items():
        assert found == [i for i in range(400) if i % 3 == q % 3 and i != q][:5]
    assert forest.nearest(df.limit(0)).count() == 0 and forest.nearest(df.filter("vec_id = 0")).count() == 0


def test_repeated_rows_of_one_id_take_one_place(spark):
    rows = [(50, [1.0, 2.0, 3.0])] * 9 + [(i, [1.0, 2.0, 3.0]) for i in range(51, 57)]         # one row many times
    rows += [(7, [9.0, 0.001 * i, 0.0]) for i in range(20)] + [(100, [9.0, 0.0, 0.0])]         # one id, many near vectors
    rows += [(100, [0.0, 0.0, -5.0])]                                                          # a query with two vectors
    rows += [(i, [9.0, 0.1 * i, 0.0]) for i in range(1, 7)] + [(i, [0.0, 0.1 * i, -5.0]) for i in range(201, 204)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for leaf_rows in (4096, 3):
        got = defaultdict(list)
        for r in forest.nearest(df, leaf_size=1000, leaf_rows=leaf_rows).orderBy("query_id", "rank").collect():
            got[r["query_id"]].append((r["vec_id"], round(r["score"], 6)))
        assert got[50] == [(i, 1.0) for i in range(51, 56)]
        assert [i for i, _ in got[100]] == [7, 1, 2, 3, 4]


# ------------------------------------------------------------------ language model

def test_gradient_against_differences():
    rng = np.random.default_rng(0)
    flat = lm.start_weights(rng.random(lm.CLASSES) * 100)
    flat = flat + rng.normal(0, 0.2, len(flat)).astype(np.float32)
    inputs, targets = rng.integers(0, lm.CLASSES, (2, 6, 4))
    live = (rng.random((6, 4)) < 0.8).astype(np.float32)
    state = rng.normal(0, 0.3, (4, lm.HIDDEN)).astype(np.float32)

    def loss(f):
        w = lm.unpack(f)
        s, _ = lm.forward(w, inputs, state.astype(np.float64))
        said = lm.log_softmax(s.astype(np.float64) @ w["o"] + w["p"])
        return -(np.take_along_axis(said, targets[:, :, None], 2)[:, :, 0] * live).sum() / live.sum()
    g, _ = lm.gradient(lm.unpack(flat), inputs, targets, live, state)
    for i in rng.integers(0, len(flat), 150):
        up, down = flat.astype(np.float64), flat.astype(np.float64)
        up[i] += 1e-2
        down[i] -= 1e-2
        assert abs((loss(up) - loss(down)) / 2e-2 - g[i]) < 3e-4 + 0.03 * abs(g[i])


def test_windows_side_by_side_carry_whole_documents():
    rng = np.random.default_rng(1)
    seqs = [(i, rng.integers(0, lm.CLASSES, n)) for i, n in enumerate([1, 31, 32, 33, 100, 2, 65, 7])]
    flat = lm.start_weights(np.ones(lm.CLASSES), seed=2)
    alone = {i: lm.class_scores(flat, [(i, s)], rows=1)[i] for i, s in seqs}
    together = lm.class_scores(flat, seqs, rows=3)
    assert all(abs(alone[i] - together[i]) < 1e-3 for i, _ in seqs)
    w = lm.unpack(flat)  # and as one unbroken window
    for i, s in seqs:
        states, _ = lm.forward(w, np.concatenate([[lm.END], s[:-1]])[:, None], np.zeros((1, lm.HIDDEN), np.float32))
        said = lm.log_softmax(states[:, 0] @ w["o"] + w["p"])
        assert abs(said[np.arange(len(s)), s].sum() - alone[i]) < 1e-3


def test_training_learns_a_pattern():
    seqs = [(i, np.array([1, 2, 3, 4] * 20 + [lm.END])) for i in range(40)]
    flat = lm.start_weights(np.ones(lm.CLASSES))
    trained, seen = lm.train_on(flat, seqs * 8, rows=16, rate=0.03)
    assert seen == 8 * 40 * 81 and lm.class_scores(trained, seqs[:1])[0] > 0.3 * lm.class_scores(flat, seqs[:1])[0]


def test_scores_and_baseline(spark):
    docs = table(spark, SF001, "documents").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows}
    words = {d: [*(t or "").encode().lower().split(), None] for d, t in rows}
    c = Counter(w for d, ws in words.items() if not held[d] for w in ws)
    n, v = sum(c.values()), len(c)
    out = lm.score_documents(docs, max_words=500).collect()
    for r in out:
        w = words[r["doc_id"]]
        base = sum(np.log10((c[x] + 1) / (n + v + 1)) for x in w)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[r["doc_id"]], len(w), sum(c[x] > 0 for x in w), n)
        assert abs(r["base_score"] - base) < 1e-6 * abs(base) and r["score"] < 0
    unseen = [r for r in out if r["held_out"]]
    assert sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen)


def test_training_reads_every_document_not_held_out_once(spark, monkeypatch, tmp_path):
    one_pass = lm.train_on

    def noted(flat, sequences, **options):
        def read():
            for d, seq in sequences:
                (tmp_path / f"{d}-{random.getrandbits(64)}").touch()
                yield d, seq
        return one_pass(flat, read(), **options)
    monkeypatch.setattr(lm, "train_on", noted)
    docs = spark.createDataFrame([(d, "one two three") for d in range(300)], "doc_id long, text string")
    assert lm.score_documents(docs).count() == 300
    read = Counter(int(f.name.split("-")[0]) for f in tmp_path.iterdir())
    assert read == {d: 1 for d in range(300) if zlib.crc32(str(d).encode()) % 7 != 2}


def test_word_shares_sum_to_one(spark):
    train = spark.createDataFrame([(i, t) for i, t in enumerate(["a b c a", "a é%% longer_than_ten", "b b q"])], "doc_id long, text string")
    counts = lm.word_counts(train, {}, np.zeros((1, 0), np.float32))
    words = lm.learn_words(counts, 3, max_words=2)
    assert words.n == 13 and words.v == 7
    for k in set(words.classes.tolist()):
        assert abs(words.counts[words.classes == k].sum() / words.mass[k] - 1) < 1e-12
    rare = [(r["w"], r["n"]) for r in counts.collect() if bytes(r["w"]) not in words.table]
    by_shape = defaultdict(float)
    for w, k in rare:
        by_shape[lm.shape(bytes(w))] += (k - words.discount) / words.mass[lm.GROUPS * lm.BANDS + lm.shape(bytes(w))]
    for s, total in by_shape.items():
        assert abs(total + words.discount * words.kinds[s] / words.mass[lm.GROUPS * lm.BANDS + s] - 1) < 1e-12
    shapes = counts.select("w", lm.shape_column().alias("s")).collect()
    assert all(lm.shape(bytes(r["w"])) == r["s"] for r in shapes)


def test_language_model_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "a b c"), (3, "a b c"), (None, "x"), (10**6, "q\u0085 w")]
    out = lm.score_documents(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, score int"), max_words=2).collect()
    assert sorted(r["n_tokens"] for r in out) == [1, 1, 2, 3, 4, 4] and all(np.isfinite(r["score"]) for r in out)
    assert lm.score_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_document_groups_read_every_document(spark):
    # more documents than a bounded sample would hold; marks and centres are those of the whole
    texts = [f"{'red green' if d % 3 else 'cold warm'} w{d % 50}" for d in range(5000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    marks, centres = lm.document_groups(docs, max_marks=4, steps=30)
    count = Counter(w.encode() for t in texts for w in set(t.split()))
    assert list(marks) == [w for w, _ in sorted(count.items(), key=lambda c: (-c[1], c[0]))[:4]]
    given = {lm.mark_vector(t.encode().split(), marks).tobytes() for t in texts}
    own = {x: int((centres @ np.frombuffer(x, dtype=np.float32)).argmax()) for x in given}
    for g in set(own.values()):
        mean = sum((lm.mark_vector(t.encode().split(), marks).astype(float) for t in texts
                    if own[lm.mark_vector(t.encode().split(), marks).tobytes()] == g), np.zeros(4))
        assert np.allclose(centres[g], mean / np.linalg.norm(mean), atol=1e-5)
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b
    lm.document_groups(docs.mapInArrow(seen, docs.schema), max_marks=4, steps=1)
    assert reads.value == 2 * len(texts)   # counted, then made vectors: no document is left out


def test_groups_need_one_reading_beside_the_counts(spark):
    texts = ["red green", "Cold\tWARM \u0085x", " \n", None, "a\x0bb\x0cc\x1cd   e", "red red"] * 40
    doc, numbers, words = lm.split_words(pa.array(texts))
    words = words.to_pylist()
    got = [[] for _ in texts]
    for d, i in zip(doc.tolist(), numbers.tolist()):
        got[d].append(words[i])
    assert got == [(t or "").encode().lower().split() for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    counts = lm.word_counts(docs, flush=3)
    want, within = Counter(w for ws in got for w in ws), Counter(w for ws in got for w in set(ws))
    assert {bytes(r["w"]): (r["n"], r["docs"]) for r in counts.collect()} == {w: (want[w], within[w]) for w in want}
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b
    marks, centres = lm.document_groups(docs.mapInArrow(seen, docs.schema), max_marks=4, counts=counts)
    assert reads.value == len(texts)
    frequent = [b"red", b"cold"]
    by_group, size = lm.group_counts(docs, marks, centres, frequent)
    own = [int((centres @ lm.mark_vector(ws, marks)).argmax()) for ws in got]
    for g in range(lm.GROUPS):
        mine = Counter(w for ws, o in zip(got, own) if o == g for w in ws)
        assert by_group[:, g].tolist() == [mine[w] for w in frequent] and size[g] == sum(mine.values())
