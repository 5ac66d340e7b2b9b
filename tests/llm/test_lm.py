"""LM scoring: base statistics against plain Python, gradients against differences, held-out accuracy."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

P = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")

from brandpulse.llm import lm_scoring as L  # noqa: E402

MODEL = P.path("piece_bpe_32k.model")


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None]


def brute(rows):
    held = {d: zlib.crc32(str(d).encode()) % 5 == 1 for d, _ in rows}
    c = Counter(w for d, t in rows if not held[d] for w in words(t))
    n, v = sum(c.values()), len(c)
    return {d: (held[d], len(words(t)), sum(c[w] > 0 for w in words(t)), n,
                sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words(t))) for d, t in rows}


def test_base_statistics_and_empty(spark, monkeypatch):
    monkeypatch.setattr(L, "FREQUENT", 20)      # most words take the joined path
    rng = random.Random(4)
    vocab = [rng.choice("abAB") + "".join(rng.choice("cdeé") for _ in range(rng.randint(0, 3))) for _ in range(120)]
    rows = [(i, rng.choice([" ", "\n"]).join(rng.choice(vocab) for _ in range(rng.randint(0, 60)))) for i in range(80)]
    rows += [(100, None), (101, ""), (102, " \t"), (103, "only here"), (104, "long " * 3000)]
    docs = spark.createDataFrame([(d, t, 1.0) for d, t in rows], "doc_id long, text string, score double").repartition(3)
    got = {r.doc_id: r for r in L.lm_scores(docs, MODEL, rounds=1).collect()}
    assert len(got) == len(rows)
    for d, want in brute(rows).items():
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == want[:4], d
        assert abs(r.base_score - want[4]) < 1e-6 * max(1, abs(want[4]))
        assert math.isfinite(r.score) and r.score < 0
    assert L.lm_scores(docs.limit(0), MODEL).count() == 0


def test_gradients():
    rng = np.random.default_rng(1)
    p = L.Params([a.astype(np.float64) for a in L.Params.start(np.full(7, 1 / 7), 7).arrays])
    z, y = rng.integers(0, 7, (3, 9)), rng.integers(0, 7, (3, 9))
    real = np.ones((3, 9), bool)

    def loss():
        h = L.forward(p, z)[-1]
        return -L.log_probs(p, h.reshape(-1, h.shape[2]), y.ravel()).mean()

    for a, g in zip(p.arrays, L.gradients(p, z, y, real)):
        for _ in range(4):
            i = tuple(rng.integers(0, s) for s in a.shape)
            old = a[i]
            a[i] = old + 1e-3
            up = loss()
            a[i] = old - 1e-3
            down = loss()
            a[i] = old
            assert abs((up - down) / 2e-3 - g[i]) < 2e-3


def test_every_token_scored_once():
    lengths = np.array([0, 1, 5, L.WINDOW, L.WINDOW + 1, 100])
    text, start, skip = L.cover(lengths)
    seen = Counter()
    for t, s, k in zip(text, start, skip):
        for i in range(s + k, min(s + L.WINDOW, lengths[t])):
            seen[t, i] += 1
    assert seen == Counter({(t, i): 1 for t, n in enumerate(lengths) for i in range(n)})


def test_every_training_token_is_learnt_once(spark, monkeypatch):
    monkeypatch.setattr(L, "PART_WINDOWS", 40)
    docs = spark.createDataFrame([(i, f"w{i} " + "some words and more of them " * (700 * (i % 2) + i)) for i in range(12)],
                                 "doc_id long, text string").repartition(3)
    out = spark.sparkContext.accumulator(0)
    real_steps = L.local_steps

    def counted(p, z, y, real, rate, batch=L.BATCH):
        out.add(int(real.sum()))
        return real_steps(p, z, y, real, rate, batch)

    monkeypatch.setattr(L, "local_steps", counted)
    L.lm_scores(docs, MODEL, held_out=F.lit(False), rounds=3).count()
    enc = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert out.value == sum(len(enc.encode(r.text)) + 1 for r in docs.collect())


def plain_score(p, s, ids):
    """Token by token: the window that scores it, masked attention by loops, softmax over classes."""
    embed, place, qkv, out, up, bias = (a.astype(np.float64) for a in p.arrays)
    d, total = embed.shape[1], 0.0
    text, start, skip = L.cover(np.array([len(ids)]))
    for i, own in enumerate(ids):
        w = max(k for k in range(len(text)) if start[k] + skip[k] <= i)
        seen = [L.START, *ids][start[w]:i + 1]
        x = np.array([embed[s.context_of[t]] + place[j] for j, t in enumerate(seen)])
        q, k, v = x[-1] @ qkv[:, :d], x @ qkv[:, d:2 * d], x @ qkv[:, 2 * d:]
        a = np.exp(k @ q / math.sqrt(d) - (k @ q / math.sqrt(d)).max())
        logits = (x[-1] + (a / a.sum()) @ v @ out) @ up + bias
        top = logits.max()
        total += logits[s.class_of[own]] - top - math.log(np.exp(logits - top).sum()) + s.inside[own]
    return total / math.log(10)


def test_scores_against_a_plain_loop():
    rng = np.random.default_rng(5)
    counts = np.floor(1000 / (1 + np.arange(300))).astype(float)
    cls, inside, share = L.classes_of(counts, 16)
    s = L.Symbols(cls, inside, L.contexts_of(counts, cls, 40))
    assert s.context_of.max() < 40 and len(set(s.context_of[:20])) == 20      # frequent ids have embeddings of their own
    p = L.Params.start(share, 40)
    texts = [rng.integers(1, 300, n) for n in [1, 2, 23, 24, 25, 40, 41, 90, *rng.integers(1, 70, 12)]]
    got = L.score_texts(p, s, np.concatenate(texts), np.array([len(t) for t in texts]))
    assert np.allclose(got, [plain_score(p, s, t.tolist()) for t in texts], rtol=1e-5)


def test_blocks_hold_adjacent_windows_of_the_whole_text():
    ids = np.arange(10, 10 + 2 * L.BLOCK_WINDOWS * L.WINDOW + 30).astype("<u2")
    batch = L.pa.record_batch([L.pa.array([7], L.pa.int64()), L.pa.array([7], L.pa.int64()), L.pa.array([ids.tobytes()], L.pa.binary())],
                              ["_d", "_h", "ids"])
    got = [L.windows_of(x) for b in L._blocks([batch]) for x in b.column("block").to_pylist()]
    assert [len(w) for w in got] == [L.BLOCK_WINDOWS, L.BLOCK_WINDOWS, 2]
    w = np.concatenate(got)
    before, after = w[:, :-1].ravel(), w[:, 1:].ravel()
    assert after[after != 0xFFFF].tolist() == ids.tolist()
    assert before[:len(ids)].tolist() == [L.START, *ids[:-1]]


def test_copies_of_a_text_are_dealt_apart(spark, monkeypatch):
    monkeypatch.setattr(L, "PART_WINDOWS", 64)
    ids = bytearray(np.arange(100, 100 + 4 * L.WINDOW).astype("<u2").tobytes())
    rows = [(i if i < 300 else 1, 5, ids, 4) for i in range(600)]        # one text, half of its rows with one id
    seen = spark.createDataFrame(rows, "_d long, _h long, ids binary, windows long").repartition(4)
    sizes = [sum(len(L.windows_of(bytes(r.block))) for r in rs) for rs in by_part(L._dealt(seen, 2400, 1)).values()]
    assert sum(sizes) == 2400 and max(sizes) <= 3 * 64


def by_part(dealt):
    out = {}
    for r in dealt.collect():
        out.setdefault(r.part, []).append(r)
    return out


def test_held_out_texts_beat_the_same_model_without_context(spark):
    rng = random.Random(9)
    phrases = ["the cat sat on the mat", "a dog ran in the park", "we read old books at night"]
    rows = [(i, " . ".join(rng.choice(phrases) for _ in range(rng.randint(3, 9)))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    mean = lambda df: np.mean([r.score for r in df.collect() if r.held_out])
    assert mean(L.lm_scores(docs, MODEL)) > 0.7 * mean(L.lm_scores(docs, MODEL, rounds=0))


def small_model(seed=6, ids=60, classes=5):
    """A model over ids with a tree, its nodes moved off their start."""
    rng = np.random.default_rng(seed)
    counts = np.floor(400 / (1 + np.arange(ids)))
    cls, inside, share = L.classes_of(counts, classes)
    tree = L.tree_of(counts, cls)
    p = L.Params.start(share, 20, tree=tree)
    start = L.Params([a.astype(np.float64) for a in p.arrays], p.nodes.astype(np.float64), tree)
    moved = L.Params(start.arrays, start.nodes + rng.normal(0, 0.5, start.nodes.shape), tree)
    return start, moved, L.Symbols(cls, inside, L.contexts_of(counts, cls, 20))


def test_the_tree_starts_from_the_shares_and_then_depends_on_the_context():
    start, moved, s = small_model()
    n = len(s.class_of)
    h = np.random.default_rng(7).normal(0, 1, (4, 16))
    at = lambda p: np.stack([L.log_probs(p, h, np.full(4, i)) for i in range(n)])
    for p in (start, moved):
        assert np.allclose(np.exp(at(p)).sum(0), 1)                  # over the whole vocabulary
    plain = L.Params(start.arrays)
    assert np.allclose(at(start), np.stack([L.log_probs(plain, h, np.full(4, s.class_of[i])) + s.inside[i] for i in range(n)]), atol=1e-6)
    a, b = np.flatnonzero(s.class_of == s.class_of.max())[:2]
    odds = at(moved)[a] - at(moved)[b]
    assert np.ptp(odds) > 0.1                                        # ids of one class, told apart by the context


def test_gradients_of_ids_and_nodes():
    _, p, s = small_model()
    rng = np.random.default_rng(2)
    z, y = rng.integers(0, 20, (3, 9)), rng.integers(0, 60, (3, 9))
    real = np.ones((3, 9), bool)
    real[2, 6:] = False

    def loss():
        h = L.forward(p, z)[-1]
        return -L.log_probs(p, h.reshape(-1, 16), y.ravel())[real.ravel()].mean()

    *grads, (nodes, rows) = L.gradients(p, z, y, real)
    of_nodes = np.zeros_like(p.nodes)
    of_nodes[nodes] = rows
    for a, g in zip([*p.arrays, p.nodes], [*grads, of_nodes]):
        for k in range(12):
            i = tuple(rng.integers(0, n) for n in a.shape) if k else np.unravel_index(np.abs(g).argmax(), g.shape)
            old = a[i]
            a[i] = old + 1e-4
            up = loss()
            a[i] = old - 1e-4
            down = loss()
            a[i] = old
            assert abs((up - down) / 2e-4 - g[i]) < 1e-5


def test_scores_of_ids_against_the_nodes_one_by_one():
    _, p, s = small_model()
    rng = np.random.default_rng(8)
    texts = [rng.integers(1, 60, n) for n in (1, 2, 24, 25, 70)]
    want = []
    for ids in texts:
        text, start, skip = L.cover(np.array([len(ids)]))
        total = 0.0
        for i, own in enumerate(ids):
            w = max(k for k in range(len(text)) if start[k] + skip[k] <= i)
            z = np.array([s.context_of[t] for t in [L.START, *ids][start[w]:i + 1]])
            h = L.forward(p, z[None])[-1][0, -1]
            logits = h @ p.arrays[4] + p.arrays[5]
            total += logits[s.class_of[own]] - np.log(np.exp(logits).sum())
            for j in range(p.tree.first[own], p.tree.first[own + 1]):
                odds = p.tree.side[j] * (p.nodes[p.tree.node[j], :-1] @ h + p.nodes[p.tree.node[j], -1])
                total -= math.log1p(math.exp(-odds))
        want.append(total / math.log(10))
    assert np.allclose(L.score_texts(p, s, np.concatenate(texts), np.array([len(t) for t in texts])), want, rtol=1e-5)


def test_words_of_one_class_are_told_apart_by_what_precedes_them(spark, monkeypatch):
    two = L.classes_of
    monkeypatch.setattr(L, "classes_of", lambda counts: two(counts, 2))
    pairs = [("red", "apple"), ("blue", "river"), ("green", "forest"), ("black", "stone")]
    rng = random.Random(3)
    rows = [(i, " ".join(" ".join(rng.choice(pairs)) for _ in range(20))) for i in range(300)]
    right = " ".join(f"{a} {b}" for a, b in pairs * 4)
    wrong = " ".join(f"{a} {pairs[k - 1][1]}" for k, (a, _) in enumerate(pairs)) + " "
    docs = spark.createDataFrame([*rows, (1000, right), (1001, (wrong * 4).strip())], "doc_id long, text string")
    got = {r.doc_id: r.score for r in L.lm_scores(docs, MODEL, held_out=F.col("doc_id") >= 1000).collect()}
    assert got[1000] > got[1001] + 10


def test_distinct_runs():
    text = " one two  one\tfé one two ".encode()
    data = np.frombuffer(text * 3, np.uint8)
    off = np.arange(4) * len(text)
    start, end, _ = L.word_bounds(data, off)
    some, a, b, number = L.distinct(data, start, end)
    words = [some[x:y].tobytes() for x, y in zip(a, b)]
    assert len(set(words)) == len(words) == 3
    assert [words[i] for i in number] == [data[x:y].tobytes() for x, y in zip(start, end)]
    assert [len(x) for x in L.distinct(data[:0], start[:0], end[:0])] == [0, 0, 0, 0]


def test_masked_attention_whatever_its_scale():
    rng = np.random.default_rng(12)
    z = rng.integers(0, 7, (4, 9))
    for scale in (0.1, 1, 8, 40):               # exponents below, shifted, and beyond what one shift for all rows can hold
        p = L.Params.start(np.full(7, 1 / 7), 7)
        p.arrays[0] *= np.float32(scale)
        embed, place, qkv, out, *_ = (a.astype(np.float64) for a in p.arrays)
        x = embed[z] + place[:9]
        q, k, v = np.split(x @ qkv, 3, axis=2)
        a = np.where(np.tril(np.ones((9, 9))) > 0, q @ k.transpose(0, 2, 1) / 4, -np.inf)
        a = np.exp(a - a.max(2, keepdims=True))
        want = x + (a / a.sum(2, keepdims=True)) @ v @ out
        assert np.allclose(L.forward(p, z)[-1], want, rtol=1e-3, atol=1e-3 * scale)
        for g in L.gradients(p, z, z, np.ones(z.shape, bool)):
            assert np.isfinite(g).all()


def test_library_and_merges_give_the_same_pieces():
    v = L.Vocabulary.load(MODEL)
    rng = random.Random(21)
    marks = ["<s>", "</s>", "<unk>", "<0x41>", "▁", "\0", "\u200d", "é", "日本", "😀", "e\u0301", "\n", "\t", "  ", "0", "a", "the", "ing", "."]
    texts = ["".join(rng.choice(marks) for _ in range(rng.randint(1, 12))) for _ in range(400)] + ["x" * 500, "ab" * 90_000, "日" * 300, ""]
    data, off = L.text_bytes(L.pa.array([t.encode() for t in texts], L.pa.binary()))
    plain, fast = L.Encoder(v), L.LibraryEncoder(v, L.unit_model(MODEL))
    got = L._ids(fast, v, data, off)
    want = [L._ids(plain, v, data[a:b], np.array([0, b - a])) for a, b in zip(off[:-1], off[1:])]
    assert np.concatenate([w[0] for w in want]).tolist() == got[0].tolist() and [w[1][0] for w in want] == got[1].tolist()
    calls = []
    fast.encode = lambda *a: calls.append(1)
    assert L._ids(fast, v, data, off)[0].tolist() == got[0].tolist() and not calls      # a unit is encoded once
    broken = np.frombuffer(b"ab \xff\xfe cd", np.uint8)
    one = np.array([0, len(broken)])
    fast = L.LibraryEncoder(v, L.unit_model(MODEL))
    assert L._ids(fast, v, broken, one)[0].tolist() == L._ids(plain, v, broken, one)[0].tolist()
