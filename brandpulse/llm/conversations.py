"""Conversation structure repair by Hirschberg's divide and conquer.

A conversation is legal if its role initials read ``(s?(ua)+)?``. Four states follow it: 0 nothing yet, 1 a
system turn, 2 a user turn, 3 an assistant turn; 0 and 3 may end. A row is kept, reroled or deleted, and empty
turns may be inserted before any row and at the end; the state and the edit fix the role. One row with the
insertions before it is a step: a 4 x 4 table of costs and edit strings that end in the row's own letter.

For the cheapest edits, the forward cost vector of the first half and the backward cost vector of the second
meet in the middle, the cheapest crossing state is chosen, and both halves are solved alone: memory stays
linear in the rows. Equal costs go to the ASCII-least edit string. Edit strings up to the middle all end there
in a row's letter, so none is the beginning of another, and their order follows from the order at the row
before: the forward pass carries a rank of the four states along with the costs.

Rows are sorted by conversation over all partitions (a range shuffle that cuts a long conversation too). A task
solves what lies wholly inside its range; of the rest it leaves bounded pieces with their 4 x 4 costs and
ranks. Pieces of one conversation are crossed by the same rule, on those numbers only, and then solved side by side.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brandpulse.llm.common import scratch

SPACES = " \t\n\x0b\x0c\r"
ENDS = ".!?"
PIECE_ROWS = 2048
PIECE_BYTES = 4 << 20
_INF = 1 << 60

# Costs of the edits; an undeleted truncated row adds its own.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
_NEXT = (2, 2, 3, 2)                                        # state after an inserted or reroled turn
_KEPT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}   # state after a kept turn, by role initial
_INITIALS = "sua"
_LAST = ((0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, ""))  # what ends each state legally


def _step(code: int) -> list[list[tuple[int, str]]]:
    """``[from][to] = (cost, edits)`` of one row: 0 must go, else 1 + 2 * initial (s, u, a, other) + truncated."""
    table = [[(_INF, "")] * 4 for _ in range(4)]
    initial, truncated = divmod(code - 1, 2)
    stay = TRUNCATED * truncated
    for start in range(4):
        state = start
        for k in range(4):
            moves = [(state, DELETE, "D")]
            if code:
                moves.append((_NEXT[state], REROLE + stay, "R"))
                kept = _KEPT.get(_INITIALS[initial], {}).get(state) if initial < 3 else None
                if kept is not None:
                    moves.append((kept, stay, "K"))
            for to, cost, letter in moves:
                table[start][to] = min(table[start][to], (cost + k * INSERT, "I" * k + letter))
            state = _NEXT[state]
    return table


STEPS = [_step(c) for c in range(9)]


def row_code(initial: str, must_go: bool, truncated: bool) -> int:
    at = _INITIALS.find(initial) if initial else -1
    return 0 if must_go else 1 + 2 * (at if at >= 0 else 3) + int(truncated)


def forward(codes: bytes, start: int) -> tuple[list[int], list[int]]:
    """Costs of every state after the rows, and the states' rank by their least edit string."""
    cost, rank = [_INF] * 4, [0] * 4
    cost[start] = 0
    for c in codes:
        step = STEPS[c]
        best = [min((cost[s] + step[s][t][0], rank[s], step[s][t][1]) for s in range(4)) for t in range(4)]
        order = sorted(range(4), key=lambda t: best[t][1:])
        cost, rank = [min(b[0], _INF) for b in best], [order.index(t) for t in range(4)]
    return cost, rank


def backward(codes: bytes, end: tuple[int, ...]) -> list[int]:
    """Costs from every state before the rows to their end, ``end`` being what each end state costs."""
    cost = list(end)
    for c in reversed(codes):
        step = STEPS[c]
        cost = [min(min(step[s][t][0] + cost[t] for t in range(4)), _INF) for s in range(4)]
    return cost


FREE_END = tuple(c for c, _ in _LAST)


def only(state: int) -> tuple[int, ...]:
    return tuple(0 if t == state else _INF for t in range(4))


@lru_cache(maxsize=1 << 14)
def _short(codes: bytes, start: int, end: tuple[int, ...]) -> str:
    return _solve(codes, start, end)


def _solve(codes: bytes, start: int, end: tuple[int, ...]) -> str:
    if len(codes) <= 1:
        if not codes:
            return ""
        return min((STEPS[codes[0]][start][t][0] + end[t], STEPS[codes[0]][start][t][1]) for t in range(4))[1]
    mid = len(codes) // 2
    cost, rank = forward(codes[:mid], start)
    back = backward(codes[mid:], end)
    cross = min(range(4), key=lambda s: (cost[s] + back[s], rank[s]))
    return cheapest(codes[:mid], start, only(cross)) + cheapest(codes[mid:], cross, end)


def cheapest(codes: bytes, start: int, end: tuple[int, ...]) -> str:
    """The cheapest edits of the rows, of equal ones the ASCII-least, without what follows the last row."""
    return _short(codes, start, end) if len(codes) <= 16 else _solve(codes, start, end)


def apply_edits(edits: str, roles: Sequence[str], texts: Sequence[str], codes: bytes,
                state: int) -> tuple[list[str], list[str], int, int]:
    """Repaired roles and texts, the cost, and the state after the edits."""
    at, cost, out_roles, out_texts = 0, 0, [], []
    for e in edits:
        if e == "D":
            cost += DELETE
            at += 1
            continue
        if e == "I":
            cost += INSERT
            role, text = ("assistant" if state == 2 else "user"), ""
            state = _NEXT[state]
        else:
            text = texts[at]
            cost += TRUNCATED * ((codes[at] - 1) % 2)
            if e == "K":
                role, state = roles[at], _KEPT[roles[at][0]][state]
            else:
                role, state, cost = ("assistant" if state == 2 else "user"), _NEXT[state], cost + REROLE
            at += 1
        out_roles.append(role)
        out_texts.append(text)
    return out_roles, out_texts, cost, state


def illegal_pairs(roles: Sequence[str]) -> int:
    return sum((a[:1] + b[:1]) not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))


# ---------------------------------------------------------------------------
# rows

def damage(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """``(_conv, _turn, _role, _text, _n)``: rows after the planned damage, ``_n`` times each.

    crc32 of ``conv:turn`` modulo 20: 0 drops the row, 1 empties the text, 2 takes ``.!?`` out of it, 3 repeats
    the row, 4 makes the role ``user``. A null counts as one space, in the key too.
    """
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text_of(conv_col), F.lit(":"), text_of(turn_col)).cast("binary")) % 20
    rows = turns.select(F.col(conv_col).alias("_conv"), F.col(turn_col).alias("_turn"), text_of(role_col).alias("_role"),
                        text_of(text_col).alias("_text"), kind.alias("_kind")).where("_kind <> 0")
    return rows.select(
        "_conv", "_turn", F.when(F.col("_kind") == 4, "user").otherwise(F.col("_role")).alias("_role"),
        F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("_text", ENDS, "")).otherwise(F.col("_text")).alias("_text"),
        F.when(F.col("_kind") == 3, 2).otherwise(1).cast("long").alias("_n"))


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def faults(rows: DataFrame, max_broadcast_rows: int = 100_000) -> DataFrame:
    """Equal rows as one, ``_n`` times, with ``_blank``, ``_late`` (role and text stand at an earlier turn) and ``_cut``.

    Role and text are compared by their sha-256; only groups that stand at several turns are joined back.
    """
    counted = scratch(rows.groupBy("_conv", "_turn", "_role", "_text").agg(F.sum("_n").alias("_n")), "conv-rows")
    last = F.right(F.rtrim(F.col("_text"), F.lit(SPACES)), F.lit(1))
    key = F.sha2(F.concat_ws("\n", F.octet_length("_role").cast("string"), "_role", "_text"), 256)
    # A turn's place, nulls first.
    place = F.struct(F.col("_turn").isNotNull().alias("known"), F.col("_turn").alias("turn"))
    counted = counted.withColumns({"_key": key, "_place": place})
    again = scratch(counted.groupBy(F.col("_conv").alias("_c"), F.col("_key").alias("_k"))
                    .agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_m")).where("_m > 1").drop("_m"), "conv-again")
    few = again.limit(max_broadcast_rows + 1).count() <= max_broadcast_rows   # about 120 bytes a row
    joined = counted.join(F.broadcast(again) if few else again, _same("_conv", "_c") & _same("_key", "_k"), "left")
    return joined.select(
        "_conv", "_turn", "_role", "_text", "_n",
        (last == "").alias("_blank"),
        (F.col("_first").isNotNull() & (F.col("_place") > F.col("_first"))).alias("_late"),
        (~F.coalesce(F.instr(F.lit(ENDS), last) > 0, F.lit(False))).alias("_cut"))


PIECE = ("_conv {conv}, _piece long, whole boolean, n_rows long, blank long, duplicate long, truncated long, "
         "illegal long, cost long, audit string, roles array<string>, texts array<string>, codes binary, "
         "seen_roles array<string>, ends array<long>, ranks array<long>")
_FIELDS = [f.split()[0] for f in PIECE.split(", ")]


class _Open:
    """Rows of one piece as they come."""

    def __init__(self, conv):
        self.conv, self.roles, self.texts, self.codes, self.size = conv, [], [], bytearray(), 0
        self.blank = self.duplicate = self.truncated = 0

    def add(self, role, text, n, blank, late, cut):
        first = min(n, PIECE_ROWS)
        for i in range(first):
            again = late or i > 0
            code = row_code(role[:1], blank or again, cut)
            self.blank += blank
            self.duplicate += again and not blank
            self.truncated += cut and not blank and not again
            self.roles.append(role)
            self.texts.append(text if code else "")       # a deleted row's text is not needed again
            self.codes.append(code)
            self.size += len(text) * (code > 0) + 32
            blank, late = blank, True
        return n - first

    def row(self, number: int, whole: bool) -> dict:
        codes = bytes(self.codes)
        out = {"_conv": self.conv, "_piece": number, "whole": whole, "n_rows": len(codes), "blank": self.blank,
               "duplicate": self.duplicate, "truncated": self.truncated, "illegal": illegal_pairs(self.roles)}
        if whole:
            return out | solved(codes, self.roles, self.texts, 0, None)
        both = [forward(codes, s) for s in range(4)]
        return out | {"codes": codes, "seen_roles": self.roles, "texts": self.texts,
                      "ends": [c for cost, _ in both for c in cost], "ranks": [r for _, rank in both for r in rank]}


def solved(codes: bytes, roles, texts, start: int, end: int | None) -> dict:
    """Cost, edits and repaired turns of a piece from ``start`` to ``end`` (None: to a legal end)."""
    edits = cheapest(codes, start, FREE_END if end is None else only(end))
    r, t, cost, state = apply_edits(edits, roles, texts, codes, start)
    if end is None:
        more, tail = _LAST[state]
        for _ in tail:
            r.append("assistant" if state == 2 else "user")
            t.append("")
            state = _NEXT[state]
        edits, cost = edits + tail, cost + more
    return {"cost": cost, "audit": edits, "roles": r, "texts": t}


def _pieces(batches) -> Iterator:
    """Sorted rows of a task to pieces; only the first and last conversation, and cut ones, may go on elsewhere."""
    from pyspark import TaskContext

    base = TaskContext.get().partitionId() << 32
    held, number, current, cut, first = [], 0, None, False, True
    schema = None

    def close(more: bool, edge: bool):
        nonlocal number, cut, first, current
        if current is not None and len(current.codes):
            held.append(current.row(base + number, not (more or cut or edge or first)))
            number += 1
        cut = more
        if not more:
            first, current = False, None

    def flush():
        out = {k: [row.get(k) for row in held] for k in _FIELDS}
        held.clear()
        return pa.record_batch([pa.array(out[f.name], f.type) for f in schema], schema=schema)

    started = False
    for batch in batches:
        if schema is None:
            conv = batch.schema.field("_conv").type
            strings = pa.list_(pa.string())
            schema = pa.schema(list(zip(_FIELDS, [conv, pa.int64(), pa.bool_(), *[pa.int64()] * 6, pa.string(), strings, strings,
                                                  pa.binary(), strings, pa.list_(pa.int64()), pa.list_(pa.int64())])))
        size = 0
        for conv, _, role, text, n, blank, late, was_cut in zip(*[batch.column(i).to_pylist() for i in range(8)]):
            if not started or conv != current.conv:
                if started:
                    close(False, False)
                current, started = _Open(conv), True
            while n:
                if len(current.codes) >= PIECE_ROWS or current.size >= PIECE_BYTES:
                    close(True, False)
                    current = _Open(conv)
                before = n
                n = current.add(role, text, n, blank, late, was_cut)
                late = late or n < before
            size += len(text)
            if len(held) >= 4096 or size > PIECE_BYTES:
                size = 0
                yield flush()
    if started:
        close(False, True)
        yield flush()


def _crossed(pieces: pd.DataFrame) -> pd.DataFrame:
    """Start and end state of every piece of one conversation, from the pieces' costs and ranks alone."""
    pieces = pieces.sort_values("_piece", kind="stable")
    tables = [(np.array(e, object).reshape(4, 4), np.array(r).reshape(4, 4)) for e, r in zip(pieces["ends"], pieces["ranks"])]
    back = [list(FREE_END)]
    for ends, _ in reversed(tables):
        back.append([min(min(ends[s][t] + back[-1][t] for t in range(4)), _INF) for s in range(4)])
    back.reverse()
    # Forward from state 0: after each piece, the least end state that still reaches the whole's cost.
    state, starts, stops = 0, [], []
    for (ends, ranks), after in zip(tables, back[1:]):
        starts.append(state)
        state = min(range(4), key=lambda t: (ends[state][t] + after[t], ranks[state][t]))
        stops.append(state)
    return pd.DataFrame({"_piece": pieces["_piece"].to_numpy(), "_start": starts, "_stop": stops,
                         "_final": [False] * (len(starts) - 1) + [True]})


def _solve_pieces(batches) -> Iterator:
    for batch in batches:
        rows = batch.to_pylist()
        for row in rows:
            start, end = row.pop("_start"), row.pop("_stop")
            row |= solved(row["codes"], row["seen_roles"], row["texts"], start, None if row.pop("_final") else end)
            row |= {"seen_roles": [row["seen_roles"][0], row["seen_roles"][-1]], "codes": None, "ends": None, "ranks": None}
        schema = pa.schema([batch.schema.field(f) for f in _FIELDS])
        yield pa.record_batch([pa.array([r[f] for r in rows], schema.field(f).type) for f in _FIELDS], schema=schema)


def repair_rows(rows: DataFrame, partitions: int | None = None) -> DataFrame:
    """Repair of ``(_conv, _turn, _role, _text, _n)``: one row for each piece, in ``_piece`` order.

    ``roles`` and ``texts`` are the repaired turns, ``audit`` the edits (Keep, Rerole, Delete, Insert). A
    conversation that lies inside one task's range is one piece with ``whole`` true; others are pieces of
    at most ``PIECE_ROWS`` rows or about ``PIECE_BYTES``, whose counts add up (``illegal`` without the pairs between
    two pieces; ``seen_roles`` holds a piece's first and last role before the repair).
    """
    spark = rows.sparkSession
    judged = faults(rows)
    conv = judged.schema["_conv"].dataType.simpleString()
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["_conv", "_turn", "_role"]
    # Rows of one turn and role are told apart by the head of their text, so that they can be cut too.
    dealt = judged.withColumn("_head", F.left("_text", F.lit(64))).repartitionByRange(partitions, *order, "_head")
    sorted_rows = dealt.sortWithinPartitions(*order, "_head", "_text").drop("_head")
    made = scratch(sorted_rows.mapInArrow(_pieces, PIECE.format(conv=conv)), "conv-pieces")
    cut = made.where("NOT whole")
    states = (cut.select("_conv", "_piece", "ends", "ranks").groupBy("_conv")
              .applyInPandas(_crossed, "_piece long, _start int, _stop int, _final boolean"))
    rest = cut.join(states, "_piece").mapInArrow(_solve_pieces, PIECE.format(conv=conv))
    return made.where("whole").unionByName(rest)


def _assembler(conv_type: str):
    def run(batches):
        import hashlib

        state, out = None, []

        def done():
            if state is not None:
                out.append({k: state[k] for k in ("_conv", *_COUNTS)} | {"audit": "".join(state["audit"]),
                                                                         "repaired_sha256": state["sha"].hexdigest()})

        schema = None
        for batch in batches:
            schema = schema or pa.schema([batch.schema.field("_conv"), *[pa.field(c, pa.int64()) for c in _COUNTS],
                                          pa.field("audit", pa.string()), pa.field("repaired_sha256", pa.string())])
            for row in batch.to_pylist():
                if state is None or state["_conv"] != row["_conv"]:
                    done()
                    state = {"_conv": row["_conv"], **dict.fromkeys(_COUNTS, 0), "audit": [], "sha": hashlib.sha256(), "last": None, "some": False}
                for c in _COUNTS:
                    state[c] += row[c]
                if state["last"] is not None:
                    state["illegal"] += illegal_pairs([state["last"], row["seen_roles"][0]])
                state["last"] = row["seen_roles"][-1]
                state["audit"].append(row["audit"])
                for role, text in zip(row["roles"], row["texts"]):
                    state["sha"].update(("\n" * state["some"] + f"{role}:{text}").encode())
                    state["some"] = True
            if len(out) > 1000:
                yield pa.Table.from_pylist(out, schema).combine_chunks().to_batches()[0]
                out.clear()
        done()
        if out:
            yield pa.Table.from_pylist(out, schema).combine_chunks().to_batches()[0]
    return run


_COUNTS = ("blank", "duplicate", "truncated", "illegal", "cost")


def digests(pieces: DataFrame) -> DataFrame:
    """``(_conv, counts, cost, audit, repaired_sha256)`` of each conversation of ``repair_rows``.

    Whole conversations are hashed where they are; the pieces of a cut one pass one task in order, piece by
    piece, since a digest is one chain. Its memory is one piece and the edit string that the row returns.
    """
    text = F.concat_ws("\n", F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit(":"), t)))
    whole = pieces.where("whole").select("_conv", *_COUNTS, "audit", F.sha2(text, 256).alias("repaired_sha256"))
    conv = pieces.schema["_conv"].dataType.simpleString()
    schema = f"_conv {conv}, " + ", ".join(f"{c} long" for c in _COUNTS) + ", audit string, repaired_sha256 string"
    cut = (pieces.where("NOT whole").select("_conv", "_piece", "seen_roles", *_COUNTS, "audit", "roles", "texts")
           .repartition("_conv").sortWithinPartitions("_conv", "_piece").mapInArrow(_assembler(conv), schema))
    return whole.unionByName(cut)


def repair_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", partitions: int | None = None) -> DataFrame:
    """Damage, judge and repair every conversation: ``(conv_col, gaps, blank, duplicate, truncated, illegal, cost,
    audit, repaired_sha256)``, one row for every conversation id of the input.

    Rows go by turn, nulls first, then by role and text. A row's first fault counts: blank (no character other
    than white space), duplicate (role and text stand earlier), truncated (last such character not ``.!?``).
    ``gaps``: turns missing between the least and the largest.

    Defined cases: a null role, text, turn or id counts as one space in the damage and as such a role or text
    afterwards; a null id is a conversation of its own; equal rows are counted first and travel once; a
    conversation without rows after damage has zeros, an empty audit and the hash of the empty string; very
    long texts are one row of a piece; an empty table gives no rows; other columns are not read.
    """
    rows = scratch(damage(turns, conv_col, turn_col, role_col, text_col), "conv-damaged")
    out = digests(repair_rows(rows, partitions))
    gaps = rows.groupBy(F.col("_conv").alias("_c")).agg(
        F.coalesce(F.max("_turn").cast("long") - F.min("_turn").cast("long") + 1 - F.count_distinct("_turn"), F.lit(0)).alias("gaps"))
    every = turns.select(F.col(conv_col).alias("_id")).distinct()
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return (every.join(out, _same("_id", "_conv"), "left").join(gaps, _same("_id", "_c"), "left")
            .select(F.col("_id").alias(conv_col), zero("gaps"), *[zero(c) for c in _COUNTS],
                    F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")))
