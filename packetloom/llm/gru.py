"""A gated recurrent network over token numbers with a class-factored softmax, in numpy: scores and truncated backpropagation.

Tokens 0 .. words-1 are frequent words, in classes of `CLASS_SIZE` by rank; the numbers after them stand for classes of rarer words. The
probability of a frequent word is that of its class, given the state, times its own within the class, given the state; for a
rarer word the network gives the class. Documents run in lanes, one after the other; the state goes on from window to window
until a document ends, so a document of any length is scored whole while memory holds one window.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np

HIDDEN = 16
CLASS_SIZE = 32
WINDOW = 32
_LN10 = float(np.log(10))


class Shape:
    def __init__(self, words: int, rare: int):
        self.frequent = -(-words // CLASS_SIZE)  # classes of frequent words
        self.words, self.rare = words, rare
        self.classes = self.frequent + rare
        h = HIDDEN
        self.parts = {
            "wx": (words + rare + 1, 3 * h), "u": (h, 3 * h), "wc": (h, self.classes), "bc": (self.classes,),
            "ww": (h, self.frequent * CLASS_SIZE), "bw": (self.frequent * CLASS_SIZE,),
        }
        self.size = sum(int(np.prod(s)) for s in self.parts.values())

    def views(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for name, s in self.parts.items():
            n = int(np.prod(s))
            out[name] = flat[at : at + n].reshape(s)
            at += n
        return out


def start_values(shape: Shape, word_counts: np.ndarray, rare_counts: np.ndarray) -> np.ndarray:
    """Small random weights; the biases say what the counts say, so an untrained network is a unigram model."""
    flat = np.random.default_rng(7).normal(0, 0.1, shape.size).astype(np.float32)
    p = shape.views(flat)
    total = float(word_counts.sum() + rare_counts.sum() + 1)
    padded = np.full(shape.frequent * CLASS_SIZE, -60.0)
    padded[: shape.words] = np.log((word_counts + 0.5) / total)
    by_class = np.add.reduceat(np.concatenate([word_counts, np.zeros(len(padded) - shape.words)]), np.arange(0, len(padded), CLASS_SIZE)) \
        if shape.words else np.zeros(0)
    p["bw"][:] = padded
    p["bc"][:] = np.log((np.concatenate([by_class, rare_counts]) + 0.5) / total)
    p["wc"][:] *= 0.1
    p["ww"][:] *= 0.1
    return flat


class Lanes:
    """Documents dealt to lanes of about equal length, the longest first, as one array with the longest lane first. Within a lane they keep
    the order they come in."""

    def __init__(self, docs: list[np.ndarray], width: int, start: int):
        heap = [(0, k) for k in range(min(width, max(1, len(docs))))]
        dealt: list[list[int]] = [[] for _ in heap]
        total = [0] * len(heap)
        for i in sorted(range(len(docs)), key=lambda i: -len(docs[i])):
            n, k = heap[0]
            dealt[k].append(i)
            total[k] = n + len(docs[i])
            heapq.heapreplace(heap, (total[k], k))
        order = sorted(range(len(dealt)), key=lambda k: -total[k])
        numbers = [i for k in order for i in sorted(dealt[k])]
        sizes = np.array([len(docs[i]) for i in numbers], dtype=np.int64)
        self.targets = np.concatenate([docs[i] for i in numbers]).astype(np.int32) if numbers else np.zeros(0, np.int32)
        self.documents = np.repeat(np.array(numbers, dtype=np.int32), sizes)
        self.first = np.zeros(len(self.targets), dtype=bool)
        self.first[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
        self.inputs = np.concatenate(([start], self.targets[:-1])).astype(np.int32) if numbers else self.targets
        self.inputs[self.first] = start
        self.sizes = np.array([total[k] for k in order], dtype=np.int64)
        self.at = np.cumsum(self.sizes) - self.sizes

    def windows(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Inputs, targets (-1: none), document numbers and starts of documents, place by lane, window after window."""
        for at in range(0, int(self.sizes.max(initial=0)), WINDOW):
            active = int(np.count_nonzero(self.sizes > at))
            span = np.arange(at, min(at + WINDOW, int(self.sizes[0])))[:, None]
            there = span < self.sizes[:active]
            place = np.where(there, span + self.at[:active], 0)
            yield self.inputs[place], np.where(there, self.targets[place], -1), self.documents[place], self.first[place] & there


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place; exponentials are faster than tanh here."""
    np.negative(x, out=x)
    np.exp(np.minimum(x, 80, out=x), out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _turned(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x.T)


def forward(p: dict, x: np.ndarray, first: np.ndarray, h: np.ndarray, trace: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """States after each place (places, HIDDEN, lanes) and the last one (lanes, HIDDEN).

    A place's values lie feature by feature, so that each gate of all lanes is one block of memory.
    """
    hid, lanes = HIDDEN, x.shape[1]
    out = np.empty((len(x), hid, lanes), dtype=np.float32)
    ut, wt, h = _turned(p["u"]), _turned(p["wx"]), _turned(h)
    starts = first.any(axis=1)
    kept = len(x) if trace is not None else 1
    gates, through = np.empty((kept, 3 * hid, lanes), dtype=np.float32), np.empty((kept, 3 * hid, lanes), dtype=np.float32)
    before = np.empty_like(out) if trace is not None else None
    for t in range(len(x)):
        if starts[t]:
            h = h * ~first[t]
        g, hu = (gates[t], through[t]) if trace is not None else (gates[0], through[0])
        np.take(wt, x[t], axis=1, out=g, mode="clip")
        np.matmul(ut, h, out=hu)
        zr, n = g[: 2 * hid], g[2 * hid :]
        zr += hu[: 2 * hid]
        _sigmoid(zr)
        if trace is not None:
            before[t] = h
        own = np.multiply(zr[hid:], hu[2 * hid :], out=out[t])
        n += own
        n *= 2
        _sigmoid(n)  # tanh(a) = 2 sigmoid(2 a) - 1
        n *= 2
        n -= 1
        h = np.subtract(h, n, out=own)
        h *= zr[:hid]
        h += n
    if trace is not None:
        trace.extend((gates, through[:, 2 * hid :], before))
    return out, h.T


def class_of(shape: Shape, y: np.ndarray) -> np.ndarray:
    return np.where(y < shape.words, y // CLASS_SIZE, shape.frequent + y - shape.words)


def output_rows(states: np.ndarray, there: np.ndarray) -> np.ndarray:
    """The states of places with a target, a row each, and a 1 by which the bias is multiplied."""
    rows = np.ones((states.shape[0] * states.shape[2], HIDDEN + 1), dtype=np.float32)
    rows[:, :HIDDEN].reshape(len(states), -1, HIDDEN)[:] = states.transpose(0, 2, 1)
    return rows if there.all() else rows[there.reshape(-1)]


def with_bias(weights: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, bool]:
    """Weights with the bias as their last row, and whether any state (none exceeds 1) can give values beyond those `exps` takes as they are."""
    reach = np.abs(weights).sum(axis=0)
    return np.vstack([weights, bias]), bool(((bias + reach > 60) | (bias - reach < -80)).any())


def exps(x: np.ndarray, wide: bool) -> np.ndarray:
    """In place. Biases are logarithms of shares, so only a bound on large values is needed, no maximum per row."""
    return np.exp(np.clip(x, -80, 60, out=x) if wide else x, out=x)


def row_sums(x: np.ndarray) -> np.ndarray:
    return x @ np.ones(x.shape[1], dtype=x.dtype)


class Words:
    """The frequent words among targets, sorted by class, so that each class is one slice."""

    def __init__(self, shape: Shape, y: np.ndarray):
        places = np.flatnonzero(y < shape.words)
        of = (y[places] // CLASS_SIZE).astype(np.int16)
        order = np.argsort(of, kind="stable")
        self.places, self.rank = places[order], y[places[order]] % CLASS_SIZE
        edges = np.searchsorted(of[order], np.arange(shape.frequent + 1)).tolist()
        self.slices = [(k, slice(i, j), slice(k * CLASS_SIZE, (k + 1) * CLASS_SIZE)) for k, (i, j) in enumerate(zip(edges, edges[1:])) if j > i]

    def exps(self, weights: np.ndarray, wide: bool, rows: np.ndarray) -> np.ndarray:
        """Of all words of each one's class; `rows` are those of the places."""
        out = np.empty((len(rows), CLASS_SIZE), dtype=np.float32)
        for _, part, cols in self.slices:
            np.matmul(rows[part], weights[:, cols], out=out[part])
        return exps(out, wide)


#: Rows of the class layer worked on at a time, so that they stay in the processor's cache.
CHUNK = 512


def log_probs(p: dict, shape: Shape, rows: np.ndarray, y: np.ndarray) -> np.ndarray:
    """log10 of the probability of each target (of its class, for rarer words)."""
    found = np.empty(len(y), dtype=np.float32)
    of = class_of(shape, y)
    weights, wide = with_bias(p["wc"], p["bc"])
    for i in range(0, len(y), CHUNK):
        part = exps(rows[i : i + CHUNK] @ weights, wide)
        found[i : i + CHUNK] = part[np.arange(len(part)), of[i : i + CHUNK]] / row_sums(part)
    words = Words(shape, y)
    shares = words.exps(*with_bias(p["ww"], p["bw"]), rows.take(words.places, axis=0))
    own = shares[np.arange(len(shares)), words.rank] / row_sums(shares)
    out = np.log(np.maximum(found, 1e-37)).astype(np.float64)
    out[words.places] += np.log(np.maximum(own, 1e-37))
    return out / _LN10


def score(flat: np.ndarray, shape: Shape, docs: list[np.ndarray], width: int = 256) -> np.ndarray:
    """Summed log10 probabilities per document (token numbers, the end token last)."""
    p = shape.views(flat)
    total = np.zeros(len(docs))
    h = np.zeros((min(width, max(1, len(docs))), HIDDEN), dtype=np.float32)
    for x, y, number, first in Lanes(docs, width, shape.words + shape.rare).windows():
        states, h = forward(p, x, first, h[: x.shape[1]])
        there = y >= 0
        found = log_probs(p, shape, output_rows(states, there), y[there])
        total += np.bincount(number[there], weights=found, minlength=len(docs))
    return total


#: In training, longer documents are cut into pieces of this many tokens, which begin with an empty state: else lanes of unequal length would be
#: worked on one by one. Scoring never does that.
PIECE = 2048
#: First value of Adagrad's sums of squares. Gradients are means over a window of all lanes, so their squares are small.
SEEN = 1e-6


def gradient(p: dict, g: dict, shape: Shape, x: np.ndarray, y: np.ndarray, first: np.ndarray, h: np.ndarray, scale: np.float32) -> tuple:
    """Fills `g` but for the input rows. Returns the input rows used, their gradients, and the last state."""
    hid, lanes = HIDDEN, x.shape[1]
    trace: list = []
    states, last = forward(p, x, first, h, trace)
    there = y >= 0
    s, target = output_rows(states, there), y[there]
    of = class_of(shape, target)
    ds = np.empty((len(s), hid), dtype=np.float32)
    weights, wide = with_bias(p["wc"], p["bc"])
    back = _turned(p["wc"])
    total = np.zeros_like(weights)
    for i in range(0, len(target), CHUNK):
        rows = slice(i, i + CHUNK)
        d = exps(s[rows] @ weights, wide)
        d *= (scale / row_sums(d))[:, None]
        d[np.arange(len(d)), of[rows]] -= scale
        total += s[rows].T @ d
        np.matmul(d, back, out=ds[rows])
    g["wc"][:], g["bc"][:] = total[:hid], total[hid]
    words = Words(shape, target)
    ws = s.take(words.places, axis=0)
    weights, wide = with_bias(p["ww"], p["bw"])
    d = words.exps(weights, wide, ws)
    d *= (scale / row_sums(d))[:, None]
    d[np.arange(len(d)), words.rank] -= scale
    back = np.empty((len(ws), hid), dtype=np.float32)
    total = np.zeros_like(weights)
    for _, rows, cols in words.slices:
        total[:, cols] = ws[rows].T @ d[rows]
        np.matmul(d[rows], p["ww"][:, cols].T, out=back[rows])
    g["ww"][:], g["bw"][:] = total[:hid], total[hid]
    ds[words.places] += back
    d_states = np.zeros((len(x), lanes, hid), dtype=np.float32)
    d_states[there] = ds
    d_states = np.ascontiguousarray(d_states.transpose(0, 2, 1))
    # Back through the window; gradients end there, the state does not. What reaches a state is multiplied by `factor` for each gate.
    gates, hu, before = trace
    z, r, n = gates[:, :hid], gates[:, hid : 2 * hid], gates[:, 2 * hid :]
    factor = np.empty_like(gates)
    to_new = (1 - z) * (1 - n * n)
    np.multiply(before - n, z * (1 - z), out=factor[:, :hid])
    np.multiply(to_new, r, out=factor[:, 2 * hid :])
    np.multiply(factor[:, 2 * hid :], hu * (1 - r), out=factor[:, hid : 2 * hid])
    through = factor  # in place, place by place
    back = np.zeros((hid, lanes), dtype=np.float32)
    u, starts = np.ascontiguousarray(p["u"]), first.any(axis=1)
    for t in range(len(x) - 1, -1, -1):
        back += d_states[t]
        d_states[t] = back
        parts = through[t].reshape(3, hid, lanes)
        parts *= back
        back *= z[t]
        back += u @ through[t]
        if starts[t]:
            back *= ~first[t]
    g["u"][:] = np.matmul(before, through.transpose(0, 2, 1)).sum(axis=0)
    through[:, 2 * hid :] = to_new * d_states  # from here on those of the gates' sums
    flat_x = x.reshape(-1)
    used = np.flatnonzero(np.bincount(flat_x))
    sums = np.empty((3 * hid, len(p["wx"])))
    for k in range(3 * hid):
        sums[k] = np.bincount(flat_x, weights=through[:, k].reshape(-1), minlength=sums.shape[1])
    return used, sums.T[used].astype(np.float32), last


def train(
    flat: np.ndarray, shape: Shape, docs: list[np.ndarray], seen: np.ndarray | None = None, width: int = 256, rate: float = 0.2
) -> tuple[np.ndarray, np.ndarray]:
    """One pass of truncated backpropagation with Adagrad over the documents, in their order. Returns the values and the sums of squared
    gradients, `seen`, from which another pass goes on."""
    docs = [doc[i : i + PIECE] for doc in docs for i in range(0, len(doc), PIECE)]
    flat = flat.copy()
    seen = np.full_like(flat, SEEN) if seen is None else seen.copy()
    grad = np.zeros_like(flat)
    p, g, sums = shape.views(flat), shape.views(grad), shape.views(seen)
    dense = slice(int(np.prod(shape.parts["wx"])), None)  # all but the input rows, of which a window uses some only
    width = min(width, max(1, len(docs)))
    scale = np.float32(1.0 / (width * WINDOW))
    h = np.zeros((width, HIDDEN), dtype=np.float32)
    for x, y, _, first in Lanes(docs, width, shape.words + shape.rare).windows():
        used, rows, h = gradient(p, g, shape, x, y, first, h[: x.shape[1]], scale)
        sums["wx"][used] += rows * rows
        p["wx"][used] -= rate * rows / np.sqrt(sums["wx"][used])
        step = grad[dense]
        seen[dense] += step * step
        flat[dense] -= rate * step / np.sqrt(seen[dense])
    return flat, seen
