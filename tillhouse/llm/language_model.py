"""A gated recurrent language model in numpy that gives whole documents a probability.

The next token's probability is factored into its class's and its own within the class. Frequent words are put into
classes of about equal square-root frequency, each with a softmax of its own. All other words, seen or not,
belong to classes by their shape (last byte and first non-ASCII character); within such a class a word
has its smoothed share of the corpus counts, so the probabilities of all possible tokens add up to one.

Documents run in many lanes side by side. A lane is a row of documents; the state is carried from window to
window of a document, and set to zero where the next one begins.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.text import fold, map_texts, texts_of
from tillhouse.session import written

#: Stands for the end of a document; no word holds white space.
END = b"\n"
#: Most frequent words whose counts every worker has (at most; it is cut at a frequency).
HEAD = 1 << 17
#: Words with a softmax of their own, classes they are put in, classes by shape.
WORDS, WORD_CLASSES, SHAPES = 4096, 48, 63
HIDDEN = 32
#: Lanes (at least, and tokens that make one more) and steps of a window in training, rounds, step size of the optimiser.
#: One document in so many belongs to the first round.
TRAIN_LANES, LANE, WINDOW, ROUNDS, RATE, FIRST = 48, 2048, 24, 2, 0.006, 8
#: A corpus is gone over again as a whole, whatever its size; a smaller one until so many tokens have been learned from.
ENOUGH = 1 << 20
#: Tokens a training task lays out over its lanes at once (and has at least, on average), and parameters that are summed up as one row.
#: Of a chunk so many sums of tasks' parameters are added up first.
TRAINED, CHUNK, MEANS = 1 << 19, 4096, 64
#: Lanes in scoring, tokens that are laid out over them at once, and positions whose probabilities are worked out at once.
LANES, LAID_OUT, POSITIONS = 512, 4_000_000, 12_288
#: Positions whose class probabilities are worked out at once, so that they stay near the processor and the library multiplies
#: them by the weights without packing them first (up to about a million multiplications a call).
NEAR = 256
#: Parameters that the optimiser changes at once, for the same reason.
CHANGED = 1 << 14
#: Occurrences in a window up to which an id's gradients are added up together with those of other ids.
FEW = 12
#: Distinct words a counting task holds before it passes them on.
COUNTED = 300_000
SEED = 11

#: Input ids as they are stored: all are under WORDS + SHAPES.
IDS = np.dtype("<u2")

_ASCII = bytes(range(128))


def tokens(text: bytes) -> list[bytes]:
    """Lower-cased (A to Z) words between ASCII white space."""
    return text.lower().split()


def shape(word: bytes) -> int:
    """What a word looks like: its last byte if ASCII, and the first two bytes of its first other character."""
    other = word.translate(None, _ASCII)[:2]
    return min(word[-1], 128) << 16 | int.from_bytes(other.ljust(2, b"\0"), "big")


# ---- Counts of the corpus ----


def count_words(docs: DataFrame) -> DataFrame:
    """``word`` (bytes) and ``c``, over all whole texts, the ends of documents included. Counted in the tasks before the shuffle."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[pa.RecordBatch]:
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

        counts: Counter[bytes] = Counter()
        for batch in batches:
            for text in texts_of(batch):
                counts.update(tokens(text))
            counts[END] += batch.num_rows
            if len(counts) >= COUNTED:
                yield from out()
                counts = Counter()
        yield from out()

    return map_texts(docs, ["text"], "word binary, n long", each).filter("n > 0").groupBy("word").agg(F.sum("n").alias("c"))


@dataclass
class Vocabulary:
    """What every worker knows of the corpus: a bounded head of the counts, and totals."""

    head: dict[bytes, int]  # to the position in the arrays below
    counts: np.ndarray
    least: int  # all words that occur at least so often are in the head
    total: int
    distinct: int
    words: int  # the first so many of the head, the end among them, have a softmax of their own
    bounds: np.ndarray  # word classes' limits within those
    shapes: dict[int, int]  # to the class; other shapes belong to the last
    shape_log: np.ndarray  # log10 of the class's denominator
    ids: np.ndarray = field(init=False)  # of the head: the network's input id
    leaf: np.ndarray = field(init=False)  # of the head: log10 within a shape class, 0 for the words' own
    ascii: list[int] = field(init=False)  # input ids of ASCII words without a softmax of their own, by the last byte

    def __post_init__(self):
        order = list(self.head)
        own = np.array([self.shapes.get(shape(w), SHAPES - 1) for w in order], np.int64)
        small = np.arange(len(order)) >= self.words
        self.ids = np.where(small, self.words + own, np.arange(len(order))).astype(np.int32)
        self.ascii = [self.words + self.shapes.get(shape(bytes([b])), SHAPES - 1) for b in range(128)]
        self.leaf = np.where(small, np.log10(self.counts + 0.5) - self.shape_log[own], 0.0)

    @property
    def inputs(self) -> int:
        return self.words + SHAPES

    @property
    def base_log(self) -> float:
        return math.log10(self.total + 0.5 * (self.distinct + 1))

    @property
    def classes(self) -> int:
        return len(self.bounds) - 1 + SHAPES

    @property
    def base_log(self) -> float:
        return math.log10(self.total + 0.5 * (self.distinct + 1))

    def class_of(self) -> np.ndarray:
        """The class of every input id."""
        return np.concatenate([np.searchsorted(self.bounds, np.arange(self.words), "right") - 1, np.arange(SHAPES) + len(self.bounds) - 1]).astype(np.int32)


def class_bounds(counts: np.ndarray, classes: int) -> np.ndarray:
    """Limits of classes of about equal square-root frequency; counts fall."""
    mass = np.cumsum(np.sqrt(counts))
    cuts = np.searchsorted(mass, mass[-1] * np.arange(1, classes) / classes) + 1
    return np.unique(np.concatenate([[0], cuts, [len(counts)]]))


def vocabulary(counts: DataFrame) -> Vocabulary:
    """From the counts of all words. The head is cut at a frequency found from a histogram of a few hundred rows."""
    step = F.floor(F.log2("c") * 8).alias("step")
    steps = counts.groupBy(step).agg(F.count(F.lit(1)).alias("v"), F.sum("c").alias("n"), F.min("c").alias("least")).collect()
    steps.sort(key=lambda r: -r["step"])
    room, least = HEAD - 1, 1 << 62
    for r in steps:
        if (room := room - r["v"]) < 0:
            break
        least = r["least"]
    top = counts.filter((F.col("c") >= least) | (F.col("word") == F.lit(bytearray(END)))).collect()
    top.sort(key=lambda r: (bytes(r["word"]) != END, -r["c"], bytes(r["word"])))
    head = {bytes(r["word"]): i for i, r in enumerate(top)} or {END: 0}
    own = np.array([r["c"] for r in top] or [0], np.int64)
    words = min(WORDS, len(head))
    frequent = frozenset(list(head)[:words])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, v = Counter(), Counter()
        for batch in batches:
            for word, c in zip(batch.column("word").to_pylist(), batch.column("c").to_pylist(), strict=True):
                if word not in frequent:
                    n[s := shape(word)] += c
                    v[s] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.int64()) for x in (n, n.values(), v.values())], ["shape", "n", "v"])

    found = counts.mapInArrow(each, "shape long, n long, v long").groupBy("shape").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
    found = written(found)
    total, distinct = sum(r["n"] for r in steps), sum(r["v"] for r in steps)
    kept = found.orderBy(F.col("n").desc(), "shape").limit(SHAPES - 1).collect()
    all_n, all_v = found.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    sizes = [(r["n"], r["v"]) for r in kept] + [(0, 0)] * (SHAPES - 1 - len(kept))
    sizes.append((all_n - sum(n for n, _ in sizes), all_v - sum(v for _, v in sizes)))
    return Vocabulary(
        head, own, least, total, distinct, words, class_bounds(own[:words] + 1, min(WORD_CLASSES, words)),
        {r["shape"]: i for i, r in enumerate(kept)}, np.log10([n + 0.5 * (v + 1) for n, v in sizes]),
    )


# ---- The network ----


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _log_softmax(logits: np.ndarray) -> np.ndarray:
    logits = logits - logits.max(axis=1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


class Network:
    """A gated recurrent unit with a class-factored softmax. ``p`` holds the parameters by name."""

    def __init__(self, p: dict[str, np.ndarray], bounds: np.ndarray, class_of: np.ndarray):
        self.p, self.bounds, self.class_of = p, bounds, class_of

    @classmethod
    def new(cls, vocabulary: Vocabulary) -> Network:
        """Small random weights; the output biases give the corpus's frequencies."""
        random = np.random.default_rng(SEED)
        normal = lambda *shape: (random.normal(0, 0.1, shape)).astype(np.float32)
        counts = vocabulary.counts[: vocabulary.words] + 0.5
        shapes = 10**vocabulary.shape_log
        class_of = vocabulary.class_of()
        by_class = np.bincount(class_of, np.concatenate([counts, shapes]), vocabulary.classes)
        p = {
            "wx": normal(vocabulary.inputs, 3 * HIDDEN),
            "u": normal(HIDDEN, 3 * HIDDEN),
            "bn": np.zeros(HIDDEN, np.float32),
            "wc": normal(HIDDEN, vocabulary.classes) * 0.1,
            "bc": np.log(by_class / by_class.sum()).astype(np.float32),
            "wo": normal(HIDDEN, vocabulary.words) * 0.1,
            "bo": np.log(counts / by_class[class_of[: vocabulary.words]]).astype(np.float32),
        }
        return cls(p, vocabulary.bounds, class_of)

    def step(self, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
        """The next state, and what the way back needs."""
        gx, gh = self.p["wx"][x], h @ self.p["u"]
        zr = _sigmoid(gx[:, : 2 * HIDDEN] + gh[:, : 2 * HIDDEN])
        z, r, inner = zr[:, :HIDDEN], zr[:, HIDDEN:], gh[:, 2 * HIDDEN :] + self.p["bn"]
        n = np.tanh(gx[:, 2 * HIDDEN :] + r * inner)
        return n + z * (h - n), z, r, n, inner

    def _gates(self) -> tuple[np.ndarray, np.ndarray]:
        """Inputs' and states' weights gate by gate, those of the sigmoids negated: one over 1 plus the exponential is the gate."""
        wx, u = (self.p[k].reshape(-1, 3, HIDDEN).transpose(1, 0, 2).copy() for k in ("wx", "u"))
        for weights in (wx, u):
            np.negative(weights[:2], out=weights[:2])
        return wx, u

    def stepper(self) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
        """``step`` without what the way back needs: gates apart, so that every pass is over whole arrays."""
        wx, u = self._gates()
        bn = np.tile(self.p["bn"], (LANES, 1))

        def next_state(x: np.ndarray, h: np.ndarray) -> np.ndarray:
            gates, (z, r, n) = wx.take(x, axis=1), (through := np.matmul(h, u))
            through[:2] += gates[:2]
            np.exp(through[:2], out=through[:2])
            through[:2] += 1  # one over the gates
            n += bn[: len(n)]
            n /= r
            n += gates[2]
            np.tanh(n, out=n)
            out = h - n
            out /= z
            out += n
            return out

        return next_state

    def by_class(self, target: np.ndarray) -> tuple[np.ndarray, list[tuple[slice, int, int]]]:
        """Positions in the order of their targets' classes; and of each class of several words the parts of them and its limits."""
        kinds = self.class_of[target].astype(np.uint16)  # short numbers are sorted faster
        order = np.argsort(kinds, kind="stable")
        edges, bounds = np.searchsorted(kinds[order], np.arange(len(self.bounds))).tolist(), self.bounds.tolist()
        several = (c for c in range(len(bounds) - 1) if bounds[c + 1] - bounds[c] > 1)
        return order, [(slice(at, min(at + NEAR, edges[c + 1])), bounds[c], bounds[c + 1]) for c in several for at in range(edges[c], edges[c + 1], NEAR)]

    def _layers(self) -> tuple[tuple[np.ndarray, bool], tuple[np.ndarray, bool]]:
        """Of the classes' and of the words' layer the weights, the last row the biases, and whether no exponential can overflow or
        vanish: states are within -1 and 1, so the weights tell."""
        out = []
        for w, b in (("wc", "bc"), ("wo", "bo")):
            (height, width), kind = self.p[w].shape, self.p[w].dtype
            layer = np.empty((height + 1, width + 16), kind)[:, :width]  # rows a power of two apart would meet in the processor's cache
            layer[:-1], layer[-1] = self.p[w], self.p[b]
            out.append((layer, bool((np.ones(height + 1, kind) @ np.abs(layer)).max() <= 40)))
        return tuple(out)

    def log_probability(self, h: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural logarithm of each target's class, times that of the word in it where it has a softmax."""
        order, classes = self.by_class(target)
        own, chosen = with_one(h, order), target[order]
        (wc, tame), (wo, tame_words) = self._layers()
        shares = self._log_shares(own, wc, near(len(h), wc.shape[1]), self.class_of[chosen], tame)
        shares += self._log_shares(own, wo, classes, chosen, tame_words)
        out = np.empty(len(h), h.dtype)
        out[order] = shares
        return out

    @staticmethod
    def _log_shares(h: np.ndarray, w: np.ndarray, parts: list[tuple[slice, int, int]], chosen: np.ndarray, tame: bool) -> np.ndarray:
        """The chosen column of the log softmax of ``h w``, each part over its own columns; zero outside the parts."""
        own, sums, ones, at_cells = np.zeros(len(h), h.dtype), np.ones(len(h), h.dtype), np.ones(w.shape[1], h.dtype), cells(parts, chosen)
        for at, low, high in parts:
            logits = h[at] @ w[:, low:high]
            if not tame:
                logits -= logits.max(axis=1, keepdims=True)
            logits.reshape(-1).take(at_cells[at], out=own[at], mode="clip")
            np.exp(logits, out=logits)
            np.matmul(logits, ones[low:high], out=sums[at])
        return own - np.log(sums)

    def window(self, x: np.ndarray, target: np.ndarray, begins: np.ndarray, h: np.ndarray) -> tuple[float, dict[str, np.ndarray], np.ndarray]:
        """Loss and gradients of one window (steps x lanes), the gradient ending at its first step; and the last state."""
        loss, g, (rows, by_row), h = self.sparse_window(x, target, begins, h)
        g["wx"] = np.zeros_like(self.p["wx"])
        g["wx"][rows] = by_row
        return loss, g, h

    def sparse_window(self, x: np.ndarray, target: np.ndarray, begins: np.ndarray, h: np.ndarray) -> tuple[float, dict[str, np.ndarray], tuple[np.ndarray, np.ndarray], np.ndarray]:
        """``window``, with the gradient of the inputs as the rows touched and what they get."""
        p, kind = self.p, self.p["u"].dtype
        (steps, lanes), size = x.shape, x.size
        new = [np.flatnonzero(row) for row in begins]  # lanes where a document begins
        gates, u = np.empty((3, steps, lanes, HIDDEN), kind), p["u"].reshape(HIDDEN, 3, HIDDEN).transpose(1, 0, 2).copy()
        for k, gate in enumerate(gates):  # gates apart, so that every pass is over whole arrays
            p["wx"].reshape(-1, HIDDEN).take(3 * x + k, axis=0, out=gate, mode="clip")
        np.negative(u[:2], out=u[:2])
        z, r, n = gates
        bn = np.tile(p["bn"], (lanes, 1))
        befores, inners, states = (np.empty((steps, lanes, HIDDEN), kind) for _ in range(3))
        through_u, some = np.empty((3, lanes, HIDDEN), kind), np.empty((lanes, HIDDEN), kind)
        with np.errstate(over="ignore"):  # a gate that is shut
            for t in range(steps):
                before = befores[t]
                before[:] = h
                if len(new[t]):
                    before[new[t]] = 0
                np.matmul(before, u, out=through_u)
                sigmoids = gates[:2, t]
                np.subtract(through_u[:2], sigmoids, out=sigmoids)
                np.exp(sigmoids, out=sigmoids)
                sigmoids += 1
                np.reciprocal(sigmoids, out=sigmoids)
                inner = np.add(through_u[2], bn, out=inners[t])
                n[t] += np.multiply(r[t], inner, out=some)
                np.tanh(n[t], out=n[t])
                h = np.subtract(before, n[t], out=states[t])
                h *= z[t]
                h += n[t]
        flat = target.ravel()
        order, classes = self.by_class(flat)
        own, chosen, d_states = with_one(states.reshape(size, HIDDEN), order), flat[order], np.empty((size, HIDDEN), kind)
        (wc, tame), (wo, tame_words) = self._layers()
        loss, by_class, d_own = self._shares_back(own, wc, near(size, wc.shape[1]), self.class_of[chosen], tame)
        more, by_word, d = self._shares_back(own, wo, classes, chosen, tame_words)
        loss += more
        d_own += d
        d_states[order] = d_own
        g = {"wc": by_class[:-1], "bc": by_class[-1], "wo": by_word[:-1], "bo": by_word[-1]}
        d_states = d_states.reshape(steps, lanes, HIDDEN)
        for_n, d_gates = np.multiply(n, n), np.empty_like(gates)
        np.subtract(1, for_n, out=for_n)
        for_z, for_r, _ = d_gates  # and, step by step, what goes back to the states
        np.subtract(befores, n, out=for_z)
        for_z *= 1 - z
        np.multiply(r, r, out=for_r)
        np.subtract(r, for_r, out=for_r)
        for_r *= inners
        carry, by_u, u = np.zeros((lanes, HIDDEN), kind), np.zeros((3, HIDDEN, HIDDEN), kind), p["u"].reshape(HIDDEN, 3, HIDDEN).transpose(1, 2, 0).copy()
        for t in range(steps - 1, -1, -1):
            dh = d_states[t]
            dh += carry
            through = np.multiply(dh, z[t], out=some)
            dh -= through
            dn = np.multiply(dh, for_n[t], out=n[t])
            for_r[t] *= dn
            for_z[t] *= through
            np.multiply(dn, r[t], out=d_gates[2, t])
            by_u += befores[t].T @ d_gates[:, t]
            np.matmul(d_gates[:, t], u, out=through_u)
            np.add(through_u[0], through_u[1], out=carry)
            carry += through_u[2]
            carry += through
            if len(new[t]):
                carry[new[t]] = 0
        g["u"] = np.concatenate(list(by_u), axis=1)
        g["bn"] = np.ones(size, kind) @ d_gates[2].reshape(size, HIDDEN)
        rows, by_row = summed_by(x.ravel(), np.concatenate([a.reshape(size, HIDDEN) for a in (for_z, for_r, n)], axis=1))
        return loss / size, g, (rows, by_row), h.copy()

    @staticmethod
    def _shares_back(h: np.ndarray, w: np.ndarray, parts: list[tuple[slice, int, int]], chosen: np.ndarray, tame: bool) -> tuple[float, np.ndarray, np.ndarray]:
        """Minus the sum of ``_log_shares``, its mean by weights and by states. Rows are divided by their sums in the narrow factors."""
        size, back, ones, at_cells = len(h), w[:-1].T.copy(), np.ones(w.shape[1], h.dtype), cells(parts, chosen)
        own, sums, share, by_w, by_h = np.zeros(size, h.dtype), np.ones(size, h.dtype), np.zeros((size, 1), h.dtype), np.zeros(w.shape, h.dtype), np.zeros((size, HIDDEN), h.dtype)
        mean = h.dtype.type(1 / size)
        for at, low, high in parts:
            some, cell = h[at], at_cells[at]
            d = some @ w[:, low:high]
            if not tame:
                d -= d.max(axis=1, keepdims=True)
            flat = d.reshape(-1)
            flat.take(cell, out=own[at], mode="clip")
            np.exp(d, out=d)
            whole = np.matmul(d, ones[low:high], out=sums[at])
            flat[cell] -= whole
            np.matmul(d, back[low:high], out=by_h[at])
            by_w[:, low:high] += (some * np.divide(mean, whole[:, None], out=share[at])).T @ d
        by_h *= share
        return float((np.log(sums) - own).sum()), by_w, by_h


def near(size: int, width: int) -> list[tuple[slice, int, int]]:
    """Parts of so many positions, each with all columns."""
    return [(slice(at, min(at + NEAR, size)), 0, width) for at in range(0, size, NEAR)]


def cells(parts: list[tuple[slice, int, int]], chosen: np.ndarray) -> np.ndarray:
    """Where the chosen column of each position lies in the array of its part (rows one after another)."""
    starts, stops, lows, highs = (np.array(x, np.int64) for x in zip(*((at.start, at.stop, low, high) for at, low, high in parts), strict=True)) if parts else [np.zeros(0, np.int64)] * 4
    times, out = stops - starts, np.zeros(len(chosen), np.int64)
    row = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    at = row + np.repeat(starts, times)
    out[at] = row * np.repeat(highs - lows, times) + chosen[at] - np.repeat(lows, times)
    return out


def with_one(h: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The rows in that order, with a last column of ones, which meets the biases."""
    out = np.ones((len(h), h.shape[1] + 1), h.dtype)
    out[:, :-1] = h.take(order, axis=0)
    return out


def summed_by(ids: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids, and the sum of the rows of each: frequent ids one by one, others all at once, a row of each in a step."""
    order = np.argsort(ids.astype(np.uint16) if WORDS + SHAPES < 1 << 16 else ids, kind="stable")  # short numbers are sorted faster
    ids, values = ids[order], values.take(order, axis=0)
    firsts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
    times = np.diff(np.append(firsts, len(ids)))
    out = values[firsts]
    rare = np.flatnonzero((times > 1) & (times <= FEW))
    for k in range(1, FEW):
        out[rare] += values[firsts[rare] + k]
        rare = rare[times[rare] > k + 1]
    for i in np.flatnonzero(times > FEW):
        np.add.reduce(values[firsts[i] : firsts[i] + times[i]], axis=0, out=out[i])
    return ids[firsts], out


def lay_out(lengths: np.ndarray, lanes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents in lanes of about equal length, longest first: their order in the lanes, and the lanes' starts and lengths (falling)."""
    heap = [(0, k) for k in range(min(lanes, len(lengths)))]
    rows: list[list[int]] = [[] for _ in heap]
    for i in np.argsort(-lengths, kind="stable").tolist():
        load, k = heapq.heappop(heap)
        rows[k].append(i)
        heapq.heappush(heap, (load + int(lengths[i]), k))
    loads = np.zeros(len(rows), np.int64)
    for load, k in heap:
        loads[k] = load
    order = np.argsort(-loads, kind="stable")
    starts = np.concatenate([[0], np.cumsum(loads[order])[:-1]]) if len(rows) else np.zeros(0, np.int64)
    return np.array([i for k in order.tolist() for i in rows[k]], np.int64), starts.astype(np.int64), loads[order]


def flatten(docs: list[np.ndarray], order: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Targets, inputs (the token before, the end at a beginning) and beginnings of documents one after another."""
    target = np.concatenate([docs[i] for i in order])
    begins = np.zeros(len(target), bool)
    begins[np.cumsum([0, *[len(docs[i]) for i in order[:-1]]])] = True
    x = np.roll(target, 1)
    x[begins] = 0  # the end has id 0
    return target, x, begins


class Trainer:
    """Adam over windows of lanes, for the documents of one task in one round. ``p`` are the parameters at its start."""

    def __init__(self, vocabulary: Vocabulary, p: dict[str, np.ndarray], round_: int, expected: float, rounds: int = ROUNDS):
        self.network = Network({k: v.copy() for k, v in p.items()}, vocabulary.bounds, vocabulary.class_of())
        self.first, self.second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
        self.random, self.round, self.rounds, self.expected = np.random.default_rng(SEED + round_), round_, rounds, max(1.0, expected)
        self.count = self.tokens = 0

    def learn(self, docs: list[np.ndarray]) -> None:
        """One pass over documents (input ids, each with its end). A lane's share may begin and end within a document."""
        if not docs:
            return
        target, x, begins = flatten(docs, self.random.permutation(len(docs)))
        lanes = max(1, min(max(TRAIN_LANES, len(target) // LANE), len(target) // WINDOW))
        length = -(-len(target) // lanes)
        filled = np.arange(lanes * length) % len(target)  # the last lane goes on with the first tokens, so that none is left out
        target, x, begins = (a[filled].reshape(lanes, length).T for a in (target, x, begins))
        h = np.zeros((lanes, HIDDEN), np.float32)
        for t in range(0, length, WINDOW):
            _, g, (rows, by_row), h = self.network.sparse_window(x[t : t + WINDOW], target[t : t + WINDOW], begins[t : t + WINDOW], h)
            done = (self.round + min(1.0, (self.tokens + t * lanes) / self.expected)) / self.rounds
            self._step(g, rows, by_row, RATE * max(0.05, 1 - done))
        self.tokens += sum(map(len, docs))

    def _step(self, g: dict[str, np.ndarray], rows: np.ndarray, by_row: np.ndarray, rate: float) -> None:
        """The inputs' moments, and the inputs, change in the rows that the window touched."""
        self.count += 1
        norm = math.sqrt(sum(float(np.vdot(v, v)) for v in (*g.values(), by_row)))
        first_by, second_by = 1 - 0.9**self.count, 1 - 0.995**self.count
        scale, eps, by = np.float32(min(1.0, 1.0 / (norm + 1e-9))), np.float32(1e-6 * math.sqrt(second_by)), np.float32(rate * math.sqrt(second_by) / first_by)

        def change(v: np.ndarray, first: np.ndarray, second: np.ndarray, p: np.ndarray) -> None:
            v *= scale
            step = v - first
            step *= np.float32(0.1)
            first += step
            v *= v
            v -= second
            v *= np.float32(0.005)
            second += v
            np.sqrt(second, out=step)
            step += eps
            np.divide(first, step, out=step)
            step *= by
            p -= step

        for k, v in g.items():
            arrays = [a.reshape(-1) for a in (v, self.first[k], self.second[k], self.network.p[k])]
            for at in range(0, v.size, CHANGED):
                change(*(a[at : at + CHANGED] for a in arrays))
        at_once, kept = CHANGED // by_row.shape[1], [a["wx"] for a in (self.first, self.second, self.network.p)]
        for at in range(0, len(rows), at_once):
            some = rows[at : at + at_once]
            held = [a.take(some, axis=0) for a in kept]
            change(by_row[at : at + at_once], *held)
            for a, values in zip(kept, held, strict=True):
                a[some] = values


def score_documents(network: Network, docs: list[np.ndarray]) -> np.ndarray:
    """Natural log probability of each document (input ids with its end), the words' shares in shape classes left out."""
    lengths = np.array([len(d) for d in docs], np.int64)
    if not lengths.sum():
        return np.zeros(len(docs))
    order, starts, loads = lay_out(lengths, LANES)
    target, x, begins = flatten(docs, order)
    out = np.zeros(len(target))
    h = np.zeros((len(starts), HIDDEN), np.float32)
    next_state, states, places, held = network.stepper(), [], [], 0
    active = np.searchsorted(-loads, -np.arange(int(loads[0])), "left")  # lanes longer than each step
    with np.errstate(over="ignore"):  # a gate that is shut
        for t, lanes in enumerate(active.tolist()):
            at = starts[:lanes] + t
            h = h[:lanes]
            if (new := begins[at]).any():
                h = np.where(new[:, None], np.float32(0), h)
            h = next_state(x[at], h)
            states.append(h)
            places.append(at)
            held += lanes
            if held >= POSITIONS or t + 1 == len(active):
                place = np.concatenate(places)
                out[place] = network.log_probability(np.concatenate(states), target[place])
                states, places, held = [], [], 0
    sums = np.zeros(len(docs))
    sums[order] = np.add.reduceat(out, np.flatnonzero(begins))
    return sums


# ---- Documents ----


def to_ids(text: bytes, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, Counter]:
    """A text's positions in the head (-1 outside), its input ids with the end, and its words outside the head."""
    words = tokens(text)
    words.append(END)
    get = vocabulary.head.get
    at = np.fromiter(map(get, words, repeat(-1)), np.int64, len(words))
    ids = vocabulary.ids[at]
    outside = np.flatnonzero(at < 0)
    rest = [words[i] for i in outside.tolist()]
    if rest:
        ascii_, first, get = vocabulary.ascii, vocabulary.words, vocabulary.shapes.get
        ids[outside] = [ascii_[w[-1]] if w.isascii() else first + get(shape(w), SHAPES - 1) for w in rest]
    return at, ids, Counter(rest)


MARKED = "doc_id long, early boolean, n_tokens long, known long, base double, leaf double, ids binary, tail array<struct<word:binary,n:int>>"


def mark(docs: DataFrame, known: Vocabulary) -> DataFrame:
    """Per document its input ids, what the head of the counts says, the words outside it with their numbers, and whether it belongs to the first round."""
    row = lambda values: np.append(values, 0)  # noqa: E731  the last is that of position -1, outside the head
    head_log, seen, leaf = row(np.log10(known.counts + 0.5)), row(known.counts > 0), row(known.leaf)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [to_ids(text, known) for text in texts_of(batch)]
            if not found:
                continue
            at, ids = (np.concatenate([x[k] for x in found]) for k in (0, 1))
            sizes, tails = np.array([len(x[0]) for x in found]), [x[2] for x in found]
            total = lambda values, starts=np.cumsum(sizes) - sizes: np.add.reduceat(values, starts)
            words = pa.StructArray.from_arrays([pa.array([w for tail in tails for w in tail], pa.binary()), pa.array([n for tail in tails for n in tail.values()], pa.int32())], ["word", "n"])
            outside = np.where(at < 0, known.shape_log[np.maximum(ids - known.words, 0)], 0.0)
            columns = [
                batch.column("doc_id"),
                batch.column("early"),
                pa.array(sizes, pa.int64()),
                pa.array(total(seen[at]), pa.int64()),
                pa.array(total(head_log[at]) - sizes * known.base_log),
                pa.array(total(leaf[at]) - total(outside)),
                pa.array([x[1].astype(IDS).tobytes() for x in found], pa.binary()),
                pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, tails)]), pa.int32()), words),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "early", "n_tokens", "known", "base", "leaf", "ids", "tail"])

    early = F.pmod(F.xxhash64("text", F.lit(SEED)), F.lit(FIRST)) == 0
    return map_texts(docs.select("doc_id", "text", early.alias("early")), ["doc_id", "text", "early"], MARKED, each)


def ids_of(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(x, IDS).astype(np.int32) for x in batch.column("ids").to_pylist()]


def train_round(docs: DataFrame, known: Vocabulary, p: dict[str, np.ndarray], round_: int, expected: float, rounds: int = ROUNDS) -> tuple[dict[str, np.ndarray], int]:
    """``train_marked`` of texts."""
    return train_marked(mark(docs, known), known, p, round_, expected, rounds)


def train_marked(marked: DataFrame, known: Vocabulary, p: dict[str, np.ndarray], round_: int, expected: float, rounds: int = ROUNDS) -> tuple[dict[str, np.ndarray], int]:
    """The parameters after every task has learned from all its documents, averaged by their tokens; and the tokens learned from."""
    names = list(p)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, held, laid, task = Trainer(known, p, round_, expected, rounds), [], 0, 0
        for batch in batches:
            task = batch.column("task")[0].as_py() if batch.num_rows else task
            for ids in ids_of(batch):
                held.append(ids)
                laid += len(ids)
                if laid >= TRAINED:
                    trainer.learn(held)
                    held, laid = [], 0
        trainer.learn(held)
        if trainer.tokens:
            flat = np.concatenate([trainer.network.p[k].ravel() for k in names]).astype("<f8") * trainer.tokens
            parts = [flat[at : at + CHUNK].tobytes() for at in range(0, len(flat), CHUNK)]
            n = len(parts)
            columns = [pa.array(range(n), pa.int32()), pa.array([task] * n, pa.int32()), pa.array([trainer.tokens] * n, pa.int64()), pa.array(parts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["chunk", "task", "tokens", "part"])

    def add(rows: pa.Table) -> pa.Table:
        tokens, out = sum(rows["tokens"].to_pylist()), 0.0
        for row in rows.sort_by("task").to_pylist():
            out = out + np.frombuffer(row["part"], "<f8")
        return pa.table({"chunk": rows["chunk"][:1], "task": pa.array([rows["task"][0].as_py() % MEANS], pa.int32()), "tokens": pa.array([tokens], pa.int64()), "part": pa.array([out.tobytes()], pa.binary())})

    schema = "chunk int, task int, tokens long, part binary"
    learned = map_texts(marked.select("ids", F.spark_partition_id().alias("task")), ["ids", "task"], schema, each)
    some = learned.groupBy("chunk", F.col("task") % MEANS).applyInArrow(add, schema)
    got = sorted(some.groupBy("chunk").applyInArrow(add, schema).collect(), key=lambda r: r["chunk"])
    if not got:
        return p, 0
    flat = (np.frombuffer(b"".join(r["part"] for r in got), "<f8") / got[0]["tokens"]).astype(np.float32)
    ends = np.cumsum([p[k].size for k in names])
    return {k: part.reshape(p[k].shape).copy() for k, part in zip(names, np.split(flat, ends[:-1]), strict=True)}, got[0]["tokens"]


def learn(docs: DataFrame, counts: DataFrame) -> tuple[Vocabulary, Network]:
    """Vocabulary from the counts of all learning documents, network from all of them."""
    known = vocabulary(counts)
    return known, fit(written(mark(docs, known)), known)


def fit(marked: DataFrame, known: Vocabulary) -> Network:
    """The network of all marked documents.

    Of the first two rounds each document is in one: one in ``FIRST`` (by a hash of its text) in the first, whose mean is where the
    tasks of the second begin. A third round goes over all documents, however many they are, and of few tokens further ones do until
    ``ENOUGH`` have been seen, three at most. A task learns from the documents of one partition, or of several if they are
    small, so the network, and with it the scores, follow the layout of the table's files.
    """
    network = Network.new(known)
    if known.total:
        tasks = marked.select(F.spark_partition_id().alias("task")).distinct().count()
        early = F.col("early")
        more = max(1, min(3, ENOUGH // known.total))
        rounds = [(early, 1 / FIRST), (~early, 1 - 1 / FIRST), *[(F.lit(True), 1.0)] * more]
        for round_, (part, share) in enumerate(rounds):
            at_once = max(1, min(tasks, int(known.total * share) // TRAINED))  # the mean of many that have hardly begun would learn little
            network.p, _ = train_marked(marked.filter(part).coalesce(at_once), known, network.p, round_, known.total * share / at_once, len(rounds))
    return network


SCORED = "row long, doc_id long, n_tokens long, known long, base double, leaf double"


def model(marked: DataFrame, network: Network) -> DataFrame:
    """The columns named in ``SCORED``, and the network's log10 probability of each document."""
    names = [c.split()[0] for c in SCORED.split(", ")]

    def emit(rows: list[pa.RecordBatch], held: list[np.ndarray]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows).combine_chunks()
        columns = [table[c].chunk(0) for c in names]
        return pa.RecordBatch.from_arrays([*columns, pa.array(score_documents(network, held) / math.log(10))], [*names, "model"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held, laid = [], [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            rows.append(batch.select(names))
            held += ids_of(batch)
            laid += sum(map(len, held[-batch.num_rows :]))
            if laid >= LAID_OUT:
                yield emit(rows, held)
                rows, held, laid = [], [], 0
        if held:
            yield emit(rows, held)

    return map_texts(marked, [*names, "ids"], f"{SCORED}, model double", each)


def score(docs: DataFrame) -> DataFrame:
    """Learn from the documents outside fold 1 and score all of them, whole.

    Needs ``doc_id`` and ``text``. A null text is empty (its end is its only token). A row without an id is scored but
    not learned from, and its ``held_out`` is null. Repeated rows count, and are scored, each. An empty table
    gives no rows. Without learning documents all words are unknown.

    Counts and training cover all learning texts: tasks train on their own and parameters are averaged. Texts become ids once; training
    and scoring read these. Workers get the counts of at most ``HEAD`` words; the words outside that go
    to their counts by a shuffle, summed up per document beforehand, and only numbers come back.
    """
    counts = written(count_words(docs.filter(fold() != 1)))
    known = vocabulary(counts)
    marked = written(mark(docs, known).withColumn("row", F.monotonically_increasing_id()))
    scored = written(model(marked, fit(marked.filter(fold() != 1), known)))
    tails = marked.select("row", F.explode("tail").alias("t")).select("row", F.col("t.word").alias("word"), F.col("t.n").alias("n"))
    rest = counts.filter(F.col("c") < known.least)
    c = F.coalesce("c", F.lit(0))
    sums = tails.join(rest, "word", "left").groupBy("row").agg(F.sum(F.col("n") * F.log10(c + 0.5)).alias("outside"), F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("seen"))
    outside = F.coalesce("outside", F.lit(0.0))
    return scored.join(sums, "row", "left").select(
        "doc_id",
        (fold() == 1).alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("seen", F.lit(0))).alias("n_known"),
        F.lit(known.total).cast("long").alias("train_tokens"),
        (F.col("base") + outside).alias("base_score"),
        (F.col("leaf") + F.col("model") + outside).alias("score"),
    )
