"""Near-duplicate groups against all pairs of full shingle sets, in plain Python."""

import random
import re

from brandpulse.llm import common
from brandpulse.llm.components import connected_components
from brandpulse.llm.minhash_dedup import minhash_dedup


def shingles(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}


def brute(rows, percent=75):
    sets = [shingles(t) for _, t in rows]
    comp = list(range(len(rows)))

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                comp[max(a, b)] = min(a, b)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), d), d)
    return sorted((d, len(sets[i]), low[find(i)], d == low[find(i)]) for i, (d, _) in enumerate(rows))


def edited(rng, words, k):
    words = list(words)
    for _ in range(k):
        words[rng.randrange(len(words))] = f"e{rng.random():.4f}"
    return words


def test_groups_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(common.slices, "__defaults__", ("_t", 3000))
    rng = random.Random(5)
    texts = [None, "", " \n", "one two", "One two", "one two three", "x " * 5000]
    for _ in range(25):
        base = [f"w{rng.randint(0, 4000)}" for _ in range(rng.randint(6, 160))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 6)):
            base = edited(rng, base, rng.randint(0, 4))     # chains drift away from the first text
            texts.append(rng.choice([" ", "\n", "\t "]).join(base))
    rng.shuffle(texts)
    rows = [(i * 3 % 1009, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, n long").repartition(4)
    got = sorted(map(tuple, minhash_dedup(docs).drop("_h", "_group").collect()))
    want = brute(rows)
    assert got == want
    assert any(not r[3] for r in want)


def test_one_large_group_and_repeated_rows(spark):
    rng = random.Random(6)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(edited(rng, base, 1))) for i in range(150)] + [(200 + i, " ".join(base)) for i in range(80)]
    rows += [(500, "a b c d e f g"), (500, "a b c d e f g"), (None, "a b c d e f g"), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in minhash_dedup(docs).collect()}
    want = brute(rows[:230])
    assert all(got[(d, n)] == (c, k) for d, n, c, k in want)
    assert got[(500, 3)] == (None, False) and got[(None, 3)] == (None, True) and got[(None, 0)] == (None, True)
    assert minhash_dedup(docs.limit(0)).count() == 0


def test_template_documents_do_not_meet(spark, monkeypatch):
    from brandpulse.llm import minhash_dedup as M

    rng = random.Random(11)
    template = " ".join(f"t{i}" for i in range(60))
    rows = [(i, template + " " + " ".join(f"w{rng.random():.6f}" for _ in range(60))) for i in range(300)]
    near = [(1000 + i, " ".join(edited(rng, rows[i][1].split(), 2))) for i in range(0, 40, 2)]
    counts, real = {}, M.scratch

    def counted(df, name):
        out = real(df, name)
        counts[name] = out.count()
        return out

    monkeypatch.setattr(M, "scratch", counted)
    docs = spark.createDataFrame(rows + near, "doc_id long, text string").repartition(3)
    got = sorted(map(tuple, minhash_dedup(docs, rounds=0).drop("_h", "_group").collect()))
    assert got == brute(rows + near)
    # Template shingles are common and come last: members stay only for the near copies' sake.
    assert counts["minhash-mixed"] > 200 and counts["minhash-near"] <= 2 * 32 * len(near)


def test_words_that_collide_in_sums_modulo_a_power_of_two(spark):
    pattern = [0]
    while len(pattern) < 4096:
        pattern += [1 - x for x in pattern]
    rows = []
    for n in (1024, 4096):
        a, b = ("".join("ab"[x ^ k] for x in pattern[:n]) for k in (0, 1))
        rows += [(len(rows), " ".join([a] * 5)), (len(rows) + 1, " ".join([b] * 5))]
        rows += [(100 + len(rows), " ".join(["x y"[::2], *(["p q"[::2]] if k else []), a if k else b, "r", "s", "t"])) for k in (0, 1)]
    # Runs of two words in the same orders.
    rows += [(50 + k, " ".join("uv"[x ^ k] for x in pattern)) for k in (0, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, minhash_dedup(docs).drop("_h", "_group").collect())) == brute(rows)


def test_components_of_a_long_path_and_small_graphs(spark):
    rng = random.Random(3)
    path = [rng.getrandbits(62) - 2 ** 61 for _ in range(1000)]       # node labels in no order along the path
    star = [(9, i) for i in range(1, 9)]
    links = [*zip(path, path[1:]), *star, (20, 21), (21, 20), (30, 30)]
    edges = spark.createDataFrame(links, "a long, b long").repartition(3)
    got = {r.node: r.comp for r in connected_components(edges, "test-path").collect()}
    want = {n: min(path) for n in path} | {n: 1 for n in range(1, 10)} | {20: 20, 21: 20}
    assert got == want
    assert connected_components(edges.limit(0), "test-none").count() == 0
