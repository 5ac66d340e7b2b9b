"""Piece vocabularies of SentencePiece BPE models, and their encoding of units in numpy.

A space stands for the vocabulary's space mark throughout. Texts fall into units at places no piece spans
(before a space that follows another character, around characters that only stand alone), so units are
encoded independently, and every distinct unit of a task once.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np

from brandpulse.llm.common import Rolling

MARK = "▁"
MARK_BYTES = MARK.encode()
LONG_UNIT = 200          # characters; longer units are merged one by one with a heap
INDEX_BYTES = 1 << 17    # unit bytes indexed at once
_NONE = -np.inf


@dataclass
class Vocabulary:
    """Pieces as byte strings with their ids and scores, the ids of single bytes, and the places of cuts."""

    pieces: list[bytes]
    ids: np.ndarray
    scores: np.ndarray       # by id
    byte_ids: np.ndarray     # by byte value
    table: list[bytes]       # decoded bytes by id
    cut_space: bool          # no piece holds a space after another character
    alone: np.ndarray        # by byte value: an ASCII character that no longer piece holds

    @staticmethod
    def load(path: str) -> "Vocabulary":
        """Read a .model file on the driver; tasks get the vocabulary, not the path."""
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        with open(path, "rb") as f:
            proto = sentencepiece_model_pb2.ModelProto.FromString(f.read())
        norm, trainer = proto.normalizer_spec, proto.trainer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix \
                or trainer.model_type != 2 or not trainer.byte_fallback:
            raise NotImplementedError("a BPE model with byte fallback, dummy prefix and no normalisation is needed")
        lib = SentencePieceProcessor(model_proto=proto.SerializeToString())
        n = lib.get_piece_size()
        scores = np.array([lib.get_score(i) for i in range(n)], np.float64)
        pieces, ids, byte_ids, table = [], [], np.zeros(256, np.int32), [b""] * n
        for i in range(n):
            piece = lib.id_to_piece(i)
            if lib.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
                table[i] = bytes([int(piece[3:5], 16)])
            elif not (lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i)):
                table[i] = piece.replace(MARK, " ").encode()
                pieces.append(table[i])
                ids.append(i)
        longer = [p for p in pieces if len(p.decode()) > 1]
        cut = not any(p[j] != 32 and p[j + 1] == 32 for p in longer for j in range(len(p) - 1))
        alone = np.zeros(256, bool)
        alone[:128] = True
        for p in longer:
            alone[list(p)] = False
        return Vocabulary(pieces, np.array(ids, np.int32), scores, byte_ids, table, cut, alone)

    def is_cut(self, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Whether a unit ends between two neighbouring bytes."""
        cut = self.alone[before] | self.alone[after]
        return cut | ((after == 32) & (before != 32)) if self.cut_space else cut


class Encoder:
    """Encodes units; what a task has seen is kept by hash, up to a bound, then started anew."""

    def __init__(self, vocabulary: Vocabulary, most_units: int = 500_000):
        self.v = vocabulary
        self.most = most_units
        self.width = max(len(p) for p in vocabulary.pieces)
        self._reset()
        lengths = np.array([len(p) for p in vocabulary.pieces])
        order = np.argsort(lengths, kind="stable")
        self._pieces = [vocabulary.pieces[i] for i in order]
        self._piece_ids = vocabulary.ids[order]
        self._lengths = lengths[order]
        padded = [p[:8].ljust(8, b"\0") for p in self._pieces]
        self._low = np.frombuffer(b"".join(padded), ">u8").astype(np.uint64)
        short = (8 - np.minimum(self._lengths, 8)).astype(np.uint64) * np.uint64(8)
        self._high = self._low | ((np.uint64(1) << short) - np.uint64(1))

    def _reset(self):
        self._keys = np.zeros(0, np.uint64)
        self._at = np.zeros(0, np.int64)       # place of a key's ids
        self._len = np.zeros(0, np.int64)
        self._ids = np.zeros(0, np.int32)

    def units(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(ids, place, length)``: the pieces of unit i are ``ids[place[i]:place[i] + length[i]]``."""
        if len(self._keys) > self.most:
            self._reset()
        hashes = Rolling(data).of(start, end)
        keys, one, back = np.unique(hashes, return_index=True, return_inverse=True)
        found = np.searchsorted(self._keys, keys)
        known = np.zeros(len(keys), bool)
        inside = found < len(self._keys)
        known[inside] = self._keys[found[inside]] == keys[inside]
        new = one[~known]
        if len(new):
            ids, lengths = self.encode(data, start[new], end[new])
            at = len(self._ids) + np.cumsum(lengths) - lengths
            self._ids = np.concatenate([self._ids, ids])
            merged = np.concatenate([self._keys, keys[~known]])
            order = np.argsort(merged, kind="stable")
            self._keys = merged[order]
            self._at = np.concatenate([self._at, at])[order]
            self._len = np.concatenate([self._len, lengths])[order]
            found = np.searchsorted(self._keys, keys)
        return self._ids, self._at[found][back], self._len[found][back]

    def encode(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of every unit, one after the other, and how many each has.

        Units over ``INDEX_BYTES`` are cut first where no occurrence of a piece spans two neighbouring characters:
        no merge can cross such a place, so the parts are units of their own.
        """
        far = np.flatnonzero(end - start > INDEX_BYTES)
        if not len(far):
            return self._encode_units(data, start, end)
        cuts = [start]
        for u in far.tolist():
            cuts.append(self.free_places(data[start[u]:end[u]]) + start[u])
        begin = np.unique(np.concatenate(cuts))
        unit = np.searchsorted(start, begin, side="right") - 1
        ids, lengths = self._encode_units(data, begin, np.minimum(np.append(begin[1:], end[-1]), end[unit]))
        return ids, np.bincount(unit, weights=lengths, minlength=len(start)).astype(np.int64)

    def free_places(self, text: np.ndarray) -> np.ndarray:
        """Places inside a text where a character begins and that no piece spans, found block by block."""
        out = []
        for a in range(0, len(text), INDEX_BYTES):
            low, high = max(0, a - self.width), min(len(text), a + INDEX_BYTES + self.width)
            part = text[low:high]
            place, length, _ = self.edges(part, np.full(len(part), len(part)))
            mark = np.zeros(len(part) + 1, np.int64)
            np.add.at(mark, place + 1, 1)
            np.add.at(mark, place + length, -1)
            free = (np.cumsum(mark[:-1]) == 0) & ((part & 0xC0) != 0x80)
            places = np.flatnonzero(free) + low
            out.append(places[(places >= max(a, 1)) & (places < a + INDEX_BYTES)])
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    def _encode_units(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = end - start
        ids, lengths = [], np.zeros(len(start), np.int64)
        bounds = np.searchsorted(np.cumsum(size), np.arange(INDEX_BYTES, int(size.sum()) + INDEX_BYTES, INDEX_BYTES))
        a = 0
        for b in [*np.unique(np.minimum(bounds + 1, len(start))).tolist(), len(start)]:
            if b > a:
                part, lengths[a:b] = self._encode(data, start[a:b], size[a:b])
                ids.append(part)
                a = b
        return (np.concatenate(ids) if ids else np.zeros(0, np.int32)), lengths

    def edges(self, text: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All occurrences of longer pieces in the concatenated units: ``(place, bytes, id)``.

        Suffixes, cut at their unit's end, are sorted by their first eight bytes; a binary search gives each
        piece its range of suffixes, and pieces over eight bytes are compared onwards inside their range.
        """
        n = len(text)
        padded = np.concatenate([text, np.zeros(8, np.uint8)])
        words = np.ndarray((n,), ">u8", buffer=padded.tobytes(), strides=(1,)).astype(np.uint64)
        left = np.minimum(stop - np.arange(n), 8)
        words &= ~((np.uint64(1) << ((8 - left) * 8).astype(np.uint64)) - np.uint64(1))
        order = np.argsort(words, kind="stable")
        ranked = words[order]
        lo = np.searchsorted(ranked, self._low, side="left")
        hi = np.searchsorted(ranked, self._high, side="right")
        count = hi - lo
        piece = np.repeat(np.arange(len(count)), count)
        place = order[np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(len(piece))]
        far = np.flatnonzero(self._lengths[piece] > 8)
        if len(far):
            ok = np.ones(len(piece), bool)
            for j in range(8, self.width, 8):
                far = far[ok[far] & (self._lengths[piece[far]] > j)]
                if not len(far):
                    break
                which, inverse = np.unique(piece[far], return_inverse=True)
                chunk = [self._pieces[w][j:j + 8] for w in which.tolist()]
                want = np.frombuffer(b"".join(c.ljust(8, b"\0") for c in chunk), ">u8").astype(np.uint64)
                mask = np.array([(2 ** 64 - 1) ^ ((1 << (8 * (8 - len(c)))) - 1) for c in chunk], np.uint64)
                at = place[far] + j
                here = np.where(at < n, words[np.minimum(at, n - 1)], np.uint64(0))
                # Bytes past the unit's end are another unit's: the suffix at `at` belongs to it.
                ok[far] = ((here & mask[inverse]) == want[inverse]) & (at < stop[place[far]])
            piece, place = piece[ok], place[ok]
        return place, self._lengths[piece], self._piece_ids[piece]

    def _encode(self, data, start, size):
        total = int(size.sum())
        first = np.cumsum(size) - size
        text = data[np.repeat(start - first, size) + np.arange(total)]
        stop = np.repeat(first + size, size)
        unit_of = np.repeat(np.arange(len(size)), size)
        place, length, piece = self.edges(text, stop)
        small = np.uint16 if len(self.v.table) < 1 << 16 else np.int32
        edge = np.zeros((total, self.width + 1), small)        # edges by place (a counting sort) and length; 0: none
        edge[place, length] = piece
        lead = np.flatnonzero((text & 0xC0) != 0x80)
        if not len(lead) or lead[0] != 0:
            lead = np.arange(total)
        begin = lead
        after = np.append(begin[1:], total)
        unit = unit_of[begin]
        done: list[tuple[np.ndarray, np.ndarray]] = []
        long = np.bincount(unit, minlength=len(size)) > LONG_UNIT
        if long.any():
            far = long[unit]
            for u in np.flatnonzero(long):
                done.append(self._merge_long(begin[unit == u], after[unit == u], edge))
            begin, after, unit = begin[~far], after[~far], unit[~far]
        # Relax: every round merges the best pair (highest score, then leftmost) of every unit still open.
        while len(begin):
            span = after[1:] - begin[:-1]
            fits = (unit[1:] == unit[:-1]) & (span <= self.width)
            pair = np.zeros(len(begin), np.int32)
            pair[:-1][fits] = edge[begin[:-1][fits], span[fits]]
            score = np.where(pair > 0, self.v.scores[pair], _NONE)
            heads = np.flatnonzero(np.append(True, unit[1:] != unit[:-1]))
            best = np.maximum.reduceat(score, heads)
            width = np.diff(np.append(heads, len(begin)))
            top = np.repeat(best, width)
            open_ = top > _NONE
            if not open_.all():
                done.append((begin[~open_], after[~open_]))
            at = np.flatnonzero(open_ & (score == top))
            at = at[np.append(True, unit[at[1:]] != unit[at[:-1]])] if len(at) else at
            after = after.copy()
            after[at] = after[at + 1]
            keep = open_
            keep[at + 1] = False
            begin, after, unit = begin[keep], after[keep], unit[keep]
        begin = np.concatenate([d[0] for d in done])
        after = np.concatenate([d[1] for d in done])
        order = np.argsort(begin)
        begin, after = begin[order], after[order]
        ids = edge[begin, np.minimum(after - begin, self.width)]
        unknown = ids == 0
        count = np.where(unknown, after - begin, 1)
        at = np.cumsum(count) - count
        out = np.zeros(int(count.sum()), np.int32)
        out[at[~unknown]] = ids[~unknown].astype(np.int32)
        raw = np.flatnonzero(unknown)
        if len(raw):        # characters without a piece: their bytes
            n = count[raw]
            inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            out[np.repeat(at[raw], n) + inner] = self.v.byte_ids[text[np.repeat(begin[raw], n) + inner]]
        return out, np.bincount(unit_of[begin], weights=count, minlength=len(size)).astype(np.int64)

    def _merge_long(self, begin, after, edge):
        """The same merges for one long unit: a heap of pairs and a linked list of symbols."""
        n = len(begin)
        b, e = begin.tolist(), after.tolist()
        nxt, prev, alive = list(range(1, n)) + [-1], list(range(-1, n - 1)), [True] * n
        scores, heap = self.v.scores, []

        def offer(i, j):
            if j >= 0 and i >= 0 and e[j] - b[i] <= self.width:
                piece = int(edge[b[i], e[j] - b[i]])
                if piece:
                    heapq.heappush(heap, (-scores[piece], i, j, e[i], e[j]))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, ei, ej = heapq.heappop(heap)
            if not (alive[i] and alive[j]) or nxt[i] != j or e[i] != ei or e[j] != ej:
                continue
            e[i], alive[j], nxt[i] = e[j], False, nxt[j]
            if nxt[j] >= 0:
                prev[nxt[j]] = i
            offer(prev[i], i)
            offer(i, nxt[i])
        stay = [i for i in range(n) if alive[i]]
        return np.array([b[i] for i in stay], np.int64), np.array([e[i] for i in stay], np.int64)


def marked(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Texts as the model sees them, one after the other: a space in front of each, marks as spaces; empty stay empty."""
    out = [b" " + t.replace(MARK_BYTES, b" ") if t else b"" for t in texts]
    off = np.zeros(len(out) + 1, np.int64)
    np.cumsum([len(t) for t in out], out=off[1:])
    return np.frombuffer(b"".join(out), np.uint8), off


def unit_bounds(v: Vocabulary, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, end, first)``: units of text i are ``first[i]:first[i+1]``."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    cut = np.ones(len(data), bool)
    cut[1:] = v.is_cut(data[:-1], data[1:])
    cut[off[(off > 0) & (off < len(data))]] = True
    start = np.flatnonzero(cut)
    return start, np.append(start[1:], len(data)), np.searchsorted(start, off)
