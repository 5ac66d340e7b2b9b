"""Language-model scores of whole texts: a causal self-attention model in numpy over subword ids.

Texts (A-Z lower-cased) become ids of a public SentencePiece vocabulary. A token's probability is
p(class | context) * p(id | class, context), a hierarchical softmax over the whole vocabulary: classes are cut
from the ids by their counts in all training texts, frequent ids alone and rarer ones together, and the ids of a
class are the leaves of a Huffman tree whose nodes each choose a side from the context. Before any step the tree
gives the smoothed shares of the counts. The context is what one layer of masked self-attention makes of the ids before
the token: each of the ``CONTEXTS - CLASSES`` most frequent ids has an embedding of its own, rarer ones share that
of their class.
Adjacent windows cover every token of every training text. They are learnt once, in ``ROUNDS`` rounds: a round
takes its share of the parts, every part makes local steps from the last round's parameters, and the results
are averaged. Scoring covers a text by overlapping windows; each token is scored once, where it has the most context.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brandpulse.llm.common import Rolling, lower_ascii, null_id, one_thread, row_keys, scratch, slices, text_bytes, word_bounds
from brandpulse.llm.pieces import LONG_UNIT, Encoder, Vocabulary, marked, unit_bounds
from brandpulse.llm.repeats import _lists

WINDOW = 24
STRIDE = 20
WIDTH = 16
CLASSES = 32
CONTEXTS = 2048                  # embeddings of ids in the context
FILLER = 0xFFFF                  # no id: ids travel as 16-bit numbers
START, END = 1, 2                # ids of the vocabulary's text bounds
BLOCK_WINDOWS = 64               # adjacent training windows that are dealt together, at most
PART_WINDOWS = 65_536            # training windows of a partition
ROUNDS = 4
BATCH = 256                      # windows of a step, reached by doubling from the first steps' size
FIRST_BATCH, BATCH_STEPS = 8, 32
LARGEST = 40.0                   # exponents of the attention above it are shifted down
NODE_RATE, NODE_START = 10.0, 1.0   # of Adagrad for the tree's nodes: its rate over the other parameters', its first sum of squares
PIECE_NUMBERS = 1 << 13          # parameters that are averaged in one group
FREQUENT = 200_000               # words whose counts travel with the task: the documented bound of that table
END_WORD = np.uint64(0x1)        # stands for the end token among word hashes
SCORED_TOKENS = 1 << 13


# ---------------------------------------------------------------------------
# the model

@dataclass
class Tree:
    """The ids inside the classes: id i passes the nodes ``node[first[i]:first[i + 1]]``, to the side in ``side`` (1 or -1)."""

    class_of: np.ndarray
    first: np.ndarray
    node: np.ndarray
    side: np.ndarray
    bias: np.ndarray         # by node: the log-odds of side 1 in the counts

    def paths(self, ids: np.ndarray):
        """All choices on the way to the ids, level by level: ``(order, sizes, owner, node, side)``.

        Longest ways first: ``order`` sorts the ids so, level j holds the first ``sizes[j]`` of them, ``owner`` is their place in ``ids``.
        """
        first = self.first.take(ids)
        depth = self.first.take(ids + 1) - first
        order = np.argsort(-depth.astype(np.int16), kind="stable")
        first = first.take(order)
        sizes = np.cumsum(np.bincount(depth, minlength=1)[::-1])[::-1][1:].tolist()
        owner = np.concatenate([order[:0], *[order[:n] for n in sizes]])
        at = np.concatenate([first[:0], *[first[:n] + j for j, n in enumerate(sizes)]])
        return order, sizes, owner, self.node.take(at), self.side.take(at)


@dataclass
class Params:
    """embed (K, d), place (W, d), qkv (d, 3d), out (d, d), up (d, C), bias (C): K contexts, C classes.

    With a tree the model is over ids: ``nodes`` (N, d + 1) holds each node's weights, its bias last. Without one it is over classes.
    """

    arrays: list[np.ndarray]
    nodes: np.ndarray | None = None
    tree: Tree | None = None

    @staticmethod
    def shapes(classes: int, contexts: int, width: int = WIDTH, window: int = WINDOW) -> list[tuple[int, ...]]:
        return [(contexts, width), (window, width), (width, 3 * width), (width, width), (width, classes), (classes,)]

    @staticmethod
    def start(share: np.ndarray, contexts: int = CONTEXTS, seed: int = 13, tree: Tree | None = None) -> "Params":
        """Small random numbers; the biases alone give the classes' shares and the ids' inside them."""
        rng = np.random.default_rng(seed)
        arrays = [rng.normal(0, s, shape).astype(np.float32)
                  for s, shape in zip((0.3, 0.1, 0.25, 0.25, 0.05, 0), Params.shapes(len(share), contexts))]
        arrays[5] = np.log(share).astype(np.float32)
        if tree is None:
            return Params(arrays)
        nodes = np.zeros((len(tree.bias), arrays[0].shape[1] + 1), np.float32)
        nodes[:, -1] = tree.bias
        return Params(arrays, nodes, tree)

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in self.arrays + ([] if self.tree is None else [self.nodes])]).astype(np.float64)

    @staticmethod
    def unflat(flat: np.ndarray, classes: int, contexts: int, tree: Tree | None = None) -> "Params":
        out, at = [], 0
        for shape in Params.shapes(classes, contexts):
            n = int(np.prod(shape))
            out.append(flat[at:at + n].reshape(shape).astype(np.float32))
            at += n
        if tree is None:
            return Params(out)
        return Params(out, flat[at:].reshape(len(tree.bias), -1).astype(np.float32), tree)


@cache
def _seen(w: int) -> np.ndarray:
    """1 where a place (row) may see a place (column): itself and back."""
    return np.tril(np.ones((w, w), np.float32))


def _scaled(qkv: np.ndarray) -> np.ndarray:
    """The weights with the attention's scale in those of the queries."""
    out = qkv.copy()
    out[:, :len(qkv)] *= np.float32(len(qkv) ** -0.5)
    return out


def forward(p: Params, z: np.ndarray):
    """Context numbers before each place (B, W) to log-probabilities' ingredients; the mask lets a place see itself and back.

    ``att`` holds exponentials and ``rec`` (B * W, 1) the reciprocals of their rows' sums: the attention is their product.
    """
    embed, place, qkv, out, up, bias = p.arrays
    b, w = z.shape
    d = embed.shape[1]
    x = embed.take(z, axis=0)
    x += place[:w]
    every = (x.reshape(-1, d) @ _scaled(qkv)).reshape(b, w, 3 * d)
    q, k, v = every[..., :d], every[..., d:2 * d], every[..., 2 * d:]
    att = q @ k.transpose(0, 2, 1)
    # (The entry of a place for itself is always there, so the least of them bounds every row's sum from below.)
    top = att.max()
    if max(top, LARGEST) - att.diagonal(axis1=1, axis2=2).min() > LARGEST + 80.0:
        att += np.where(_seen(w) > 0, np.float32(0), np.float32(-1e9))
        att -= att.max(2, keepdims=True)
    elif top > LARGEST:
        att -= top - LARGEST
    np.exp(att, out=att)
    att *= _seen(w)
    rec = 1 / (att.reshape(-1, w) @ np.ones((w, 1), att.dtype))
    mixed = (att @ v).reshape(-1, d)
    mixed *= rec
    h = x + (mixed @ out).reshape(b, w, d)
    return x, q, k, v, att, rec, mixed, h


def _class_logits(p: Params, h: np.ndarray) -> np.ndarray:
    """Logits with a row for each class and a column for each place: sums over classes run along memory."""
    logits = p.arrays[4].T @ h.T
    logits += p.arrays[5][:, None]
    return logits


def _choices(p: Params, h: np.ndarray, paths) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """At every choice of the paths: the node's weights, ``h`` with a 1 for its bias, and the log-odds of the side taken."""
    _, _, owner, node, side = paths
    w = p.nodes.take(node, axis=0)
    seen = np.concatenate([h, np.ones((len(h), 1), h.dtype)], axis=1).take(owner, axis=0)
    odds = ((w * seen) @ np.ones((w.shape[1], 1), w.dtype))[:, 0]
    odds *= side
    return w, seen, odds


def log_probs(p: Params, h: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Natural log-probability of ``y`` at rows of ``h``: ids if the model has a tree, else classes."""
    logits = _class_logits(p, h)
    top = logits.max(0)
    own = logits[y if p.tree is None else p.tree.class_of[y], np.arange(len(y))] - top
    logits -= top
    np.exp(logits, out=logits)
    out = own - np.log(logits.sum(0))
    if p.tree is None:
        return out
    paths = p.tree.paths(y)
    odds = _choices(p, h, paths)[2]
    return out + np.bincount(paths[2], weights=np.minimum(odds, 0) - np.log(1 + np.exp(-np.abs(odds))), minlength=len(y))


def tree_gradients(p: Params, h: np.ndarray, ids: np.ndarray, weight: np.ndarray):
    """Of the weighted cross-entropy of the ids inside their classes, by ``h`` and by the nodes met: ``(gradient, (nodes, gradient))``."""
    paths = p.tree.paths(ids)
    (order, sizes, owner, node, side), (w, by, odds) = paths, _choices(p, h, paths)
    g = -side * weight.take(owner) / (1 + np.exp(np.minimum(odds, 80)))
    by *= g[:, None]
    w *= g[:, None]
    ranked = np.argsort(node, kind="stable")
    node = node.take(ranked)
    heads = np.flatnonzero(np.append(True, node[1:] != node[:-1])[:len(node)])
    by = by.take(ranked, axis=0)
    total, a = np.zeros((len(h), w.shape[1]), h.dtype), 0
    for n in sizes:
        total[:n] += w[a:a + n]
        a += n
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    return total.take(place, axis=0)[:, :-1], (node[heads], np.add.reduceat(by, heads, axis=0) if len(heads) else by)


def gradients(p: Params, z: np.ndarray, y: np.ndarray, real: np.ndarray) -> list:
    """Gradients of the mean cross-entropy over ``real`` places; with a tree, at last ``(nodes, gradient)`` of the nodes met."""
    embed, place, qkv, out, up, bias = p.arrays
    x, q, k, v, att, rec, mixed, h = forward(p, z)
    b, w, d = x.shape
    x, h = x.reshape(-1, d), h.reshape(-1, d)
    logits = _class_logits(p, h)
    logits -= logits.max(0)
    np.exp(logits, out=logits)
    weight = (real.ravel() / max(1, real.sum())).astype(logits.dtype)
    logits *= weight / logits.sum(0)
    logits[y.ravel() if p.tree is None else p.tree.class_of[y.ravel()], np.arange(b * w)] -= weight
    g_up = (logits @ h).T
    g_h = logits.T @ up.T
    of_nodes = []
    if p.tree is not None:
        more, nodes = tree_gradients(p, h, y.ravel(), weight)
        g_h += more
        of_nodes = [nodes]
    g_out = mixed.T @ g_h
    # The attention's gradient from its exponentials: a row's part of ``rec`` goes with the gradient of what it mixed.
    g_mixed = g_h @ out.T
    g_mixed *= rec
    own = (g_mixed * mixed) @ np.ones((d, 1), mixed.dtype)
    g_mixed = g_mixed.reshape(b, w, d)
    g_s = g_mixed @ v.transpose(0, 2, 1)
    g_s -= own.reshape(b, w, 1)
    g_s *= att
    g_all = np.empty((b, w, 3 * d), g_s.dtype)
    np.matmul(g_s, k, out=g_all[..., :d])
    np.matmul(g_s.transpose(0, 2, 1), q, out=g_all[..., d:2 * d])
    np.matmul(att.transpose(0, 2, 1), g_mixed, out=g_all[..., 2 * d:])
    g_all = g_all.reshape(-1, 3 * d)
    g_qkv = _scaled(x.T @ g_all)
    g_x = g_all @ _scaled(qkv).T
    g_x += g_h
    g_embed = np.zeros_like(embed)
    order = np.argsort(z.ravel(), kind="stable")
    ranked = z.ravel()[order]
    heads = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
    g_embed[ranked[heads]] = np.add.reduceat(g_x.take(order, axis=0), heads, axis=0)
    g_place = np.zeros_like(place)
    g_place[:w] = g_x.reshape(b, w, d).sum(0)
    return [g_embed, g_place, g_qkv, g_out, g_up, logits.sum(1), *of_nodes]


def local_steps(p: Params, z: np.ndarray, y: np.ndarray, real: np.ndarray, rate: float, batch: int = BATCH) -> Params:
    """One pass of Adam over the windows, in order; steps start small and double in size every ``BATCH_STEPS``.

    The tree's nodes, of which a step meets few, take Adagrad's steps on summed gradients: an unmet node stays as it is.
    """
    flat = np.concatenate([a.ravel() for a in p.arrays])
    ends = np.cumsum([a.size for a in p.arrays])
    now = Params([x.reshape(a.shape) for x, a in zip(np.split(flat, ends[:-1]), p.arrays)],       # views of ``flat``
                 None if p.tree is None else p.nodes.copy(), p.tree)
    squares = None if p.tree is None else np.full_like(now.nodes, NODE_START)
    first, second, step = np.zeros_like(flat), np.zeros_like(flat), np.empty_like(flat)
    t, a = 0, 0
    while a < len(z):
        some = slice(a, a + min(batch, FIRST_BATCH << min(t // BATCH_STEPS, 20)))
        t, a = t + 1, some.stop
        grads = gradients(now, z[some], y[some], real[some])
        up, down = np.float32(rate / (1 - 0.9 ** t)), np.float32((1 - 0.98 ** t) ** -0.5)
        g = np.concatenate([x.ravel() for x in grads[:len(p.arrays)]])
        first *= np.float32(0.9)
        first += np.multiply(g, np.float32(0.1), out=step)
        second *= np.float32(0.98)
        g *= g
        g *= np.float32(0.02)
        second += g
        np.sqrt(second, out=step)
        step *= down
        step += np.float32(1e-6)
        np.divide(first, step, out=step)
        step *= up
        flat -= step
        if p.tree is not None:
            node, g = grads[-1]
            g *= np.float32(real[some].sum())
            total = squares[node] + g * g
            squares[node] = total
            now.nodes[node] -= np.float32(NODE_RATE * rate) * g / np.sqrt(total)
    return now


def cover(lengths: np.ndarray, window: int = WINDOW, stride: int = STRIDE):
    """Windows over texts of so many tokens: ``(text, start, first scored place)``; every token is scored once."""
    count = 1 + np.maximum(0, -(-(lengths - window) // stride))
    count = np.where(lengths > 0, count, 0)
    text = np.repeat(np.arange(len(lengths)), count)
    no = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    return text, no * stride, np.where(no > 0, window - stride, 0)


@dataclass
class Symbols:
    """What the model knows of ids: their class, log p(id | class), and the number of their embedding."""

    class_of: np.ndarray
    inside: np.ndarray
    context_of: np.ndarray


def score_texts(p: Params, s: Symbols, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Log10 probability of every text; ``ids`` are the texts' tokens (their end included), one after the other."""
    out = np.zeros(len(lengths))
    ends = np.cumsum(lengths)
    text, start, skip = cover(lengths)
    base = (ends - lengths)[text] + start
    left = np.minimum(lengths[text] - start, WINDOW)
    classes, contexts = s.class_of[ids], s.context_of[ids]
    before = np.empty(len(ids), contexts.dtype)
    before[1:] = contexts[:-1]
    before[(ends - lengths)[lengths > 0]] = s.context_of[START]
    step = np.arange(WINDOW)
    for a in range(0, len(text), SCORED_TOKENS // WINDOW):
        rows = slice(a, a + SCORED_TOKENS // WINDOW)
        at = np.minimum(base[rows, None] + step, len(ids) - 1)
        h = forward(p, before.take(at))[-1]
        take = (step >= skip[rows, None]) & (step < left[rows, None])
        places = np.flatnonzero(take)
        flat = at.ravel().take(places)
        h = h.reshape(-1, h.shape[2]).take(places, axis=0)
        if p.tree is None:
            lp = log_probs(p, h, classes[flat]).astype(np.float64) + s.inside[ids[flat]]
        else:
            lp = log_probs(p, h, ids[flat])
        out += np.bincount(np.repeat(text[rows], take.sum(1)), weights=lp, minlength=len(lengths))
    return out / np.log(10.0)


def classes_of(counts: np.ndarray, classes: int = CLASSES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(class of each id, log p(id | class), share of each class)`` from counts: equal shares, ids by count."""
    weight = counts + 0.5
    order = np.argsort(-weight, kind="stable")
    rank = np.arange(len(order))
    upto = np.cumsum(weight[order])
    # The i-th most frequent id gets class i while it fills a class, then classes are cut at equal mass.
    share, cls = upto[-1] / classes, np.zeros(len(order), np.int64)
    alone = int(np.searchsorted(-weight[order], -share, side="right"))
    alone = min(alone, classes - 1)
    rest = weight[order][alone:]
    cut = (np.cumsum(rest) - rest) / rest.sum() * (classes - alone)
    cls[order] = np.where(rank < alone, rank, alone + np.minimum(
        np.concatenate([np.zeros(alone), cut]).astype(np.int64), classes - alone - 1))
    mass = np.bincount(cls, weights=weight, minlength=classes)
    return cls, np.log(weight / mass[cls]), np.maximum(mass, 0.5) / np.maximum(mass, 0.5).sum()


def tree_of(counts: np.ndarray, class_of: np.ndarray) -> Tree:
    """A Huffman tree of the ids of each class: frequent ids have few choices on their way."""
    n = len(counts)
    weight = (counts + 0.5).tolist()
    parent, side, bias = np.full(2 * n, -1), np.zeros(2 * n, np.int8), []
    for c in range(int(class_of.max()) + 1):
        heap = [(weight[i], i) for i in np.flatnonzero(class_of == c).tolist()]
        heapq.heapify(heap)
        while len(heap) > 1:
            (less, a), (more, b) = heapq.heappop(heap), heapq.heappop(heap)
            parent[[a, b]], side[[a, b]] = n + len(bias), (-1, 1)
            heapq.heappush(heap, (less + more, n + len(bias)))
            bias.append(np.log(more / less))
    at, ids, nodes, sides = np.arange(n), [], [], []
    own = at
    while len(own := own[parent[at] >= 0]):
        at = at[parent[at] >= 0]
        ids.append(own)
        nodes.append(parent[at] - n)
        sides.append(side[at])
        at = parent[at]
    whole = [np.concatenate([*x, np.zeros(0, np.int64)]) for x in (ids, nodes, sides)]
    order = np.argsort(whole[0], kind="stable")
    first = np.append(0, np.cumsum(np.bincount(whole[0].astype(np.int64), minlength=n)))
    return Tree(class_of, first, whole[1][order].astype(np.uint16), whole[2][order].astype(np.float32), np.array(bias, np.float32))


def contexts_of(counts: np.ndarray, class_of: np.ndarray, contexts: int = CONTEXTS) -> np.ndarray:
    """The embedding of each id: the start and the most frequent ids have one each, the others their class's."""
    shared = int(class_of.max()) + 1
    weight = counts + 0.5
    weight[START] = np.inf
    own = np.argsort(-weight, kind="stable")[:max(contexts - shared, 0)]
    out = contexts - shared + class_of
    out[own] = np.arange(len(own))
    return out.astype(np.uint16)


# ---------------------------------------------------------------------------
# tasks

def distinct(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(bytes, start, end, number)``: the distinct ones of ascending, disjoint byte runs, and which of them each run is.

    Runs are compared by their bytes, so a word is hashed or encoded once for each slice that holds it.
    """
    edge = np.zeros(len(data) + 1, np.int8)
    edge[start] += 1
    edge[end] -= 1
    held = data[np.cumsum(edge[:-1], dtype=np.int8).view(bool)]
    off = np.zeros(len(start) + 1, np.int64)
    np.cumsum(end - start, out=off[1:])
    runs = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(off), pa.py_buffer(held)]).dictionary_encode()
    data, off = text_bytes(runs.dictionary)
    return data, off[:-1], off[1:], runs.indices.to_numpy()


def unit_model(model_path: str) -> bytes:
    """The vocabulary's model for units, as the library reads it: no space is put in front."""
    from sentencepiece import sentencepiece_model_pb2

    with open(model_path, "rb") as f:
        proto = sentencepiece_model_pb2.ModelProto.FromString(f.read())
    proto.normalizer_spec.add_dummy_prefix = False
    return proto.SerializeToString()


class LibraryEncoder(Encoder):
    """New units go to the library, many in one call; long units and bytes that are no UTF-8 are merged as in ``Encoder``."""

    def __init__(self, v: Vocabulary, model: bytes):
        from sentencepiece import SentencePieceProcessor

        super().__init__(v)
        self._library = SentencePieceProcessor(model_proto=model)

    def encode(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw, short, units = data.tobytes(), end - start <= LONG_UNIT, []
        for u, (a, b) in enumerate(zip(start.tolist(), end.tolist())):
            if b - a <= LONG_UNIT:
                try:
                    units.append(str(raw[a:b], "utf-8"))
                except UnicodeDecodeError:
                    short[u] = False
        ids = self._library.encode(units, num_threads=1) if units else []
        lengths = np.zeros(len(start), np.int64)
        lengths[short] = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.int32, int(lengths.sum()))
        if short.all():
            return flat, lengths
        far = np.flatnonzero(~short)
        far = far[np.argsort(start[far])]
        more, lengths[far] = super().encode(data, start[far], end[far])
        out, first = np.empty(int(lengths.sum()), np.int32), np.cumsum(lengths) - lengths
        out[np.repeat(short, lengths)] = flat
        out[np.repeat(first[far] - (np.cumsum(lengths[far]) - lengths[far]), lengths[far]) + np.arange(len(more))] = more
        return out, lengths


def _gather(v: Vocabulary, model: bytes):
    """One pass: ids and training windows of every text; counts of words and ids of each batch's training texts."""
    def run(batches):
        enc = LibraryEncoder(v, model)
        for batch in batches:
            words, times, pieces = [], [], np.zeros(len(v.table), np.int64)
            n_end = 0
            for part in slices(batch):
                data, off = text_bytes(part.column("_t"))
                data = lower_ascii(data)
                held = part.column("held").to_numpy(zero_copy_only=False)
                start, end, first = word_bounds(data, off)
                train = ~held
                n_end += int(train.sum())
                some, a, b, number = distinct(data, start, end)
                count = np.bincount(number[np.repeat(train, np.diff(first))], minlength=len(a))
                words.append(Rolling(some).of(a, b)[count > 0])
                times.append(count[count > 0])
                ids, lengths = _ids(enc, v, data, off)
                pieces += np.bincount(ids[np.repeat(train, lengths)], minlength=len(pieces))
                ends = np.cumsum(lengths)
                yield pa.record_batch(
                    [part.column("_d"), part.column("_h"),
                     pa.array([ids[e - n:e].astype("<u2").tobytes() for e, n in zip(ends.tolist(), lengths.tolist())], pa.binary()),
                     pa.array(np.where(train, -(-lengths // WINDOW), 0), pa.int64()),
                     *[pa.nulls(part.num_rows, pa.list_(pa.int64())) for _ in range(4)]], _GATHERED)
            if n_end:
                words.append(np.array([END_WORD]))
                times.append(np.array([n_end]))
            keys, at = np.unique(np.concatenate([*words, np.zeros(0, np.uint64)]), return_inverse=True)
            counts = np.zeros(len(keys), np.int64)
            np.add.at(counts, at, np.concatenate([*times, np.zeros(0, np.int64)]))
            seen = np.flatnonzero(pieces)
            for a in range(0, len(keys), 1 << 16):
                some = slice(a, a + (1 << 16))
                one = [keys[some].view(np.int64), counts[some], *((seen, pieces[seen]) if a == 0 else (seen[:0], seen[:0]))]
                yield pa.record_batch([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()),
                                       pa.nulls(1, pa.int64()),
                                       *[_lists(np.asarray(x, np.int64), np.array([len(x)]), "i8") for x in one]], _GATHERED)
    return run


_GATHERED = ["_d", "_h", "ids", "windows", "word", "count", "piece", "pieces"]
_GATHERED_KINDS = ("_d long, _h long, ids binary, windows long, word array<long>, count array<long>, "
                   "piece array<long>, pieces array<long>")


def _ids(enc: Encoder, v: Vocabulary, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of every text, its end included."""
    raw = data.tobytes()
    seen, edge = marked([raw[a:b] for a, b in zip(off[:-1].tolist(), off[1:].tolist())])
    start, end, first = unit_bounds(v, seen, edge)
    if len(start):
        some, a, b, number = distinct(seen, start, end)
        ids, at, length = enc.units(some, a, b)
        at, length = at[number], length[number]
    else:
        ids, at, length = (np.zeros(0, np.int32),) * 3
    total = np.zeros(len(length) + 1, np.int64)
    np.cumsum(length, out=total[1:])
    flat = ids[np.repeat(at - total[:-1], length) + np.arange(total[-1])] if len(start) else np.zeros(0, np.int32)
    bound = total[first]
    return np.insert(flat, bound[1:], END), np.diff(bound) + 1


def _blocks(batches):
    """Training texts cut into runs of ``BLOCK_WINDOWS`` windows, each with the id before it.

    ``turn`` numbers the rows of a batch that agree in id and text, so that repeated rows are dealt apart too.
    """
    size = BLOCK_WINDOWS * WINDOW
    for batch in batches:
        ids, hashes, turn, no, blocks, met = [], [], [], [], [], Counter()
        for d, h, raw in zip(*[batch.column(c).to_pylist() for c in ("_d", "_h", "ids")]):
            met[d, h] += 1
            padded = np.concatenate([np.array([START], "<u2"), np.frombuffer(raw, "<u2")])
            for i, a in enumerate(range(0, len(padded) - 1, size)):
                ids.append(d)
                hashes.append(h)
                turn.append(met[d, h])
                no.append(i)
                blocks.append(padded[a:a + size + 1].tobytes())
        for a in range(0, len(blocks), 1024):
            some = slice(a, a + 1024)
            yield pa.record_batch([*[pa.array(x[some], pa.int64()) for x in (ids, hashes, turn, no)],
                                   pa.array(blocks[some], pa.binary())], ["_d", "_h", "turn", "no", "block"])


def _dealt(seen: DataFrame, windows: int, rounds: int) -> DataFrame:
    """``(part, block)``, written once, in ``rounds`` parts at least: a part is one file with one row group, which a task reads as a whole.

    Blocks are dealt one by one, copies of a text too, so parts hold about ``PART_WINDOWS`` windows whatever repeats.
    """
    key = ["_d", "_h", "turn", "no"]
    return scratch(seen.where("windows > 0").select("_d", "_h", "ids")
                   .mapInArrow(_blocks, "_d long, _h long, turn long, no long, block binary")
                   .repartition(max(rounds, -(-windows // PART_WINDOWS)), *key)
                   .select(F.spark_partition_id().alias("part"), "block"), "lm-windows")


def windows_of(block: bytes) -> np.ndarray:
    """Adjacent windows (n, WINDOW + 1) of a block, each with the id before it; ``FILLER`` fills the last."""
    ids = np.frombuffer(block, "<u2")
    n = -(-(len(ids) - 1) // WINDOW)
    padded = np.full(n * WINDOW + 1, FILLER, "<u2")
    padded[:len(ids)] = ids
    return padded[np.arange(n)[:, None] * WINDOW + np.arange(WINDOW + 1)]


def _trainer(p: Params, s: Symbols, rate: float):
    def steps(blocks):
        w = np.concatenate([windows_of(x) for x in blocks])
        w = w[np.lexsort(w.T[::-1])]
        w = w[np.random.default_rng(17).permutation(len(w))]
        real = (w[:, 1:] != FILLER)
        w = np.where(w == FILLER, END, w)
        z, y = s.context_of[w[:, :-1]], w[:, 1:].astype(np.int64)
        return local_steps(p, z, y, real, rate).flat() * len(w), len(w)

    def run(batches):
        # A task may read several of the dealt partitions, one after the other; each is learnt on its own.
        total, n, part, blocks = 0.0, 0, None, []
        for batch in batches:
            for at, block in zip(batch.column("part").to_pylist(), batch.column("block").to_pylist()):
                if at != part and blocks:
                    more, m = steps(blocks)
                    total, n, blocks = total + more, n + m, []
                part = at
                blocks.append(block)
        if blocks:
            more, m = steps(blocks)
            total, n = total + more, n + m
            total = (total / n).astype(np.float32)
            pieces = [total[a:a + PIECE_NUMBERS].tobytes() for a in range(0, len(total), PIECE_NUMBERS)]
            yield pa.record_batch([pa.array(np.arange(len(pieces))), pa.array(pieces, pa.binary()), pa.array(np.full(len(pieces), float(n)))],
                                  ["no", "p", "n"])
    return run


def _averaged(pieces: pd.DataFrame) -> pd.DataFrame:
    """The mean of one piece of the parameters over all tasks, weighted by their windows."""
    rows = pieces.sort_values(["n", "p"], kind="stable")
    total = sum(np.frombuffer(x, np.float32) * n for x, n in zip(rows["p"], rows["n"]))
    return pd.DataFrame({"no": [pieces["no"].iloc[0]], "p": [(total / rows["n"].sum()).astype(np.float32).tobytes()]})


def _scorer(p: Params, s: Symbols):
    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                texts = [np.frombuffer(x, "<u2") for x in part.column("ids").to_pylist()]
                lengths = np.array([len(t) for t in texts], np.int64)
                score = score_texts(p, s, np.concatenate(texts).astype(np.int64), lengths)
                yield pa.record_batch([part.column("_d"), part.column("_h"), pa.array(score)], ["_d", "_h", "score"])
    return run


def _based(keys: np.ndarray, logs: np.ndarray):
    """Per text: tokens, known tokens and their logs among the frequent words; the other words with their counts."""
    def run(batches):
        for batch in batches:
            for part in slices(batch):
                data, off = text_bytes(part.column("_t"))
                data = lower_ascii(data)
                start, end, first = word_bounds(data, off)
                n = part.num_rows
                some, a, b, number = distinct(data, start, end)
                words = Rolling(some).of(a, b)
                text = np.repeat(np.arange(n), np.diff(first))
                at = np.minimum(np.searchsorted(keys, words), max(len(keys) - 1, 0))
                known = (keys[at] == words if len(keys) else np.zeros(len(words), bool))[number]
                total = np.bincount(text[known], weights=logs[at[number[known]]], minlength=n) if len(keys) else np.zeros(n)
                rare, owner = words[number[~known]], text[~known]
                order = np.lexsort((rare, owner))
                rare, owner = rare[order], owner[order]
                new = np.flatnonzero(np.append(True, (rare[1:] != rare[:-1]) | (owner[1:] != owner[:-1]))) if len(rare) else \
                    np.zeros(0, np.int64)
                times = np.diff(np.append(new, len(rare)))
                per = np.bincount(owner[new], minlength=n)
                yield pa.record_batch(
                    [part.column("_r"), part.column("_d"), part.column("_h"), part.column("held"),
                     pa.array(np.diff(first) + 1, pa.int64()), pa.array(np.bincount(text[known], minlength=n), pa.int64()),
                     pa.array(total), _lists(rare[new], per, "u8"), _lists(times.astype(np.int32), per, "i4")],
                    ["_r", "_d", "_h", "held", "n_tokens", "known", "logs", "word", "times"])
    return run


def is_held_out(id_col: str) -> Column:
    """Whether crc32 of the id's text leaves 1 modulo 5 (a null id: training)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 1, F.lit(False))


def _least_frequent(counts: DataFrame) -> int:
    """The count from which on at most ``FREQUENT`` words remain, from a histogram of some two thousand bins."""
    bins = counts.groupBy(F.floor(F.log2("c") * 32).alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("least"))
    total, least = 0, 2 ** 62
    for row in sorted(bins.collect(), key=lambda r: -r["bin"]):     # 32 bins for each doubling of the count
        total += row["n"]
        if total > FREQUENT:
            break
        least = row["least"]
    return least


def lm_scores(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
              held_out: Column | None = None, rounds: int = ROUNDS, contexts: int = CONTEXTS) -> DataFrame:
    """Base statistics and model score of every whole text.

    Returns ``(id_col, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double,
    score double)``. Tokens of the base: words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, then one end;
    base_score = sum of log10((c + 0.5) / (N + 0.5 * (V + 1))) with counts from the training rows; score =
    log10 probability of the text's subword ids and its end under the attention model.

    Defined cases: a null or empty text is its end alone; a null id counts as training; repeated rows are
    counted each and score alike; without training rows N = V = 0 and the model is uniform over classes; a
    very long text is one slice of a map task; an empty table gives no rows; other columns are not read.

    Word counts are pre-aggregated by batch, then shuffled. The ``FREQUENT`` most frequent words (a fixed
    bound) travel with the tasks; all others are joined to the counts, so a hot word is never shuffled by key.
    """
    v = Vocabulary.load(model_path)
    if len(v.table) >= FILLER:
        raise ValueError(f"{len(v.table)} ids; they travel as 16-bit numbers, so fewer than {FILLER} are needed")
    held = is_held_out(id_col) if held_out is None else held_out
    rows = row_keys(docs.withColumn("_held_out", held), id_col, text_col, ["_held_out"]).withColumnRenamed("_c0", "held")
    one_thread(docs.sparkSession)
    seen = scratch(rows.mapInArrow(_gather(v, unit_model(model_path)), _GATHERED_KINDS), "lm-gathered")

    counts = scratch(seen.where("word IS NOT NULL").select(F.inline(F.arrays_zip("word", "count")))
                     .groupBy("word").agg(F.sum("count").alias("c")), "lm-words")
    n, vocab = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    top = counts.where(F.col("c") >= _least_frequent(counts)).select("word", "c").toPandas()
    keys = top["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    keys, logs = keys[order], np.log10(top["c"].to_numpy(np.float64)[order] + 0.5)
    known_end = float(counts.where(F.col("word") == int(END_WORD)).agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0])

    per_piece = (seen.where("piece IS NOT NULL").select(F.inline(F.arrays_zip("piece", "pieces")))
                 .groupBy("piece").agg(F.sum("pieces").alias("c")).toPandas())     # one row for each id at most
    piece_counts = np.zeros(len(v.table))
    piece_counts[per_piece["piece"].to_numpy(np.int64)] = per_piece["c"].to_numpy(np.float64)
    class_of, inside, share = classes_of(piece_counts)
    symbols = Symbols(class_of, inside, contexts_of(piece_counts, class_of, contexts))
    tree = tree_of(piece_counts, class_of)

    windows = int(seen.agg(F.coalesce(F.sum("windows"), F.lit(0))).first()[0])
    params = Params.start(share, contexts, tree=tree)
    dealt = _dealt(seen, windows, rounds) if windows else None
    for r in range(rounds if windows else 0):
        mine = dealt.where(F.col("part") % rounds == r)
        parts = mine.mapInArrow(_trainer(params, symbols, 0.02 / (r + 1)), "no long, p binary, n double")
        mean = parts.groupBy("no").applyInPandas(_averaged, "no long, p binary").collect()    # one row for each piece
        if mean:
            flat = np.concatenate([np.frombuffer(x["p"], np.float32) for x in sorted(mean, key=lambda x: x["no"])])
            params = Params.unflat(flat, len(share), contexts, tree)

    scored = (seen.where("ids IS NOT NULL").select("_d", "_h", "ids")
              .mapInArrow(_scorer(params, symbols), "_d long, _h long, score double")
              .groupBy("_d", "_h").agg(F.min("score").alias("score")))

    numbered = rows.select(F.monotonically_increasing_id().alias("_r"), "_d", "_h", "held", "_t")
    based = scratch(numbered.mapInArrow(_based(keys, logs), (
        "_r long, _d long, _h long, held boolean, n_tokens long, known long, logs double, word array<long>, times array<int>")),
        "lm-base")
    rare = (based.select("_r", F.inline(F.arrays_zip("word", "times"))).join(counts, "word", "left")
            .groupBy("_r").agg(F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("more"),
                               F.sum(F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("rare")))
    one_end = float(np.log10(known_end + 0.5))
    floor = float(np.log10(n + 0.5 * (vocab + 1)))
    base = (F.col("logs") + F.coalesce("rare", F.lit(0.0)) + F.lit(one_end) - F.col("n_tokens") * F.lit(floor))
    out = based.drop("word", "times").join(rare, "_r", "left").join(scored, ["_d", "_h"], "left")
    return out.select(
        null_id().alias(id_col), F.col("held").alias("held_out"), "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0)) + F.lit(int(known_end > 0))).alias("n_known"),
        F.lit(int(n)).cast("long").alias("train_tokens"), base.alias("base_score"), "score")
