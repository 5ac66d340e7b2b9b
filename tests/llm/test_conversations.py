"""Conversation repair against a plain search over all edits, with odd rows, cut conversations and repeated rows."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

from brandpulse.llm import conversations as C
from brandpulse.llm import queries

NEXT = {0: 2, 1: 2, 2: 3, 3: 2}
KEEP = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}


def plain_edits(rows):
    """Every state's cheapest, then ASCII-least edits; rows are (initial, must go, truncated)."""
    def inserted(best):
        for _ in range(3):
            for s in list(best):
                cost, audit = best[s][0] + 3, best[s][1] + "I"
                if NEXT[s] not in best or best[NEXT[s]] > (cost, audit):
                    best[NEXT[s]] = (cost, audit)
        return best

    # A state may be worth holding with several strings only if one begins another, which only trailing I do:
    # states right after a row and after insertions are kept apart by rebuilding the insertions at every row.
    best = {0: (0, "")}
    for initial, must, cut in rows:
        after = {}

        def put(t, cost, audit):
            if t not in after or after[t] > (cost, audit):
                after[t] = (cost, audit)

        options = [(s, c, a) for s, (c, a) in best.items()]
        for s, c, a in list(options):
            for k in range(1, 4):
                s, c, a = NEXT[s], c + 3, a + "I"
                options.append((s, c, a))
        for s, c, a in options:
            put(s, c + 4, a + "D")
            if not must:
                put(NEXT[s], c + 3 + 3 * cut, a + "R")
                if (initial, s) in KEEP:
                    put(KEEP[initial, s], c + 3 * cut, a + "K")
        best = after
    best = inserted(dict(best))
    return min(best[s] for s in (0, 3) if s in best)


def expected(turns):
    convs = defaultdict(list)
    for conv, turn, role, text in turns:
        role, text = " " if role is None else role, " " if text is None else text
        rows = convs[conv]
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        rows += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, judged, counts = set(), [], defaultdict(int)
        for _, role, text in rows:
            solid = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = ("blank" if not solid else "duplicate" if (role, text) in seen else
                     "truncated" if solid[-1] not in ".!?" else None)
            seen.add((role, text))
            counts[fault] += 1
            judged.append((role[:1], fault in ("blank", "duplicate"), int(fault == "truncated")))
        cost, audit = plain_edits(judged)
        turns_of = [r[0] for r in rows if r[0] is not None]
        gaps = max(turns_of) - min(turns_of) + 1 - len(set(turns_of)) if turns_of else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        state, at, lines = 0, 0, []
        for e in audit:
            role, text = ("assistant" if state == 2 else "user"), ""
            if e != "I":
                text = rows[at][2]
                if e == "K":
                    role = rows[at][1]
                at += 1
            if e == "D":
                continue
            state = KEEP[role[0], state] if e == "K" else NEXT[state]
            lines.append(f"{role}:{text}")
        assert at == len(rows) and state in (0, 3)
        out[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def run(spark, turns, **kw):
    df = spark.createDataFrame([(c, t, r, x, 1, "y") for c, t, r, x in turns],
                               "conv_id long, turn long, role string, text string, cost int, _conv string").repartition(3)
    return {r[0]: tuple(r[1:]) for r in C.repair_conversations(df, **kw).collect()}


def odd_turns(seed, convs, most):
    rng = random.Random(seed)
    texts = ["Well then.", "Right!", "Is it?", "broken off", "", "  \t\n", "é. ", "x" * 300 + ".", "a:b\nc.", None, "no end …"]
    rows = []
    for conv in range(convs):
        for turn in range(rng.randint(0, most)):
            role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", "", None, "u", "ASSISTANT"])
            rows.append((conv, rng.choice([turn, turn, turn, turn + 3, None]), role, rng.choice(texts) if rng.random() < 0.5 else f"turn {rng.random()}."))
    return rows


def test_codes_against_search():
    rng = random.Random(3)
    for _ in range(600):
        rows = [(rng.choice("ssuuuaaax"), rng.random() < 0.15, int(rng.random() < 0.3)) for _ in range(rng.randint(0, 40))]
        codes = bytes(C.row_code(i, m, bool(c)) for i, m, c in rows)
        got = C.solved(codes, [i for i, _, _ in rows], [""] * len(rows), 0, None)
        assert (got["cost"], got["audit"]) == plain_edits(rows)


def test_repair_odd_rows(spark):
    rows = odd_turns(1, 60, 9) + [(None, None, None, None), (None, 2, "user", "Hello."), (None, 2, "user", "Hello."),
                                  (500, 7, "user", "Hi."), (501, 3, "assistant", "z" * 200_000)]
    rows += [(600, 1, "user", "the same row.")] * 50
    assert run(spark, rows) == expected(rows)
    assert run(spark, rows, partitions=1) == expected(rows)


def test_long_conversation_is_cut(spark, monkeypatch):
    monkeypatch.setattr(C, "PIECE_ROWS", 7)
    rows = odd_turns(2, 12, 6)
    rng = random.Random(8)
    for conv in (100, 101):
        rows += [(conv, t, rng.choice(["user", "assistant", "assistant", "user", "system"]),
                  rng.choice([f"turn {t}.", f"turn {t}", "again."])) for t in range(300)]
    want = expected(rows)
    assert run(spark, rows, partitions=5) == want
    assert run(spark, rows, partitions=1) == want


def test_all_dropped_and_empty(spark):
    gone = [(c, 0, "user", "Hi.") for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    assert gone and set(run(spark, gone).values()) == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert run(spark, []) == {}


def test_query_on_table(spark):
    sf = "/root/testdata/sf0.001"
    got = queries.QUERIES["op13_conversation_repair"](spark, sf)
    turns = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    cols = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert got.columns == cols and all(t == "bigint" for c, t in got.dtypes[:7])
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == expected(turns)
