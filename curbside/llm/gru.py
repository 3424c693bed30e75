"""A gated recurrent language model in numpy: layers, truncated backpropagation, and scoring of whole documents.

The next token is predicted in two factors, its class and itself within the class. Frequent words have small classes
with a softmax each. All other words fall into a few open classes by their first bytes; within these a word has its
smoothed share of the class, one share being left for words never seen. So the model is a distribution over the words
of the training text and unseen words, as the base is, and starts out equal to it: biases are log shares, and training
adds what the context tells.

Documents run in lanes, several one after the other in a lane, with the state reset between them. Lanes are cut into
windows of steps; the state is carried from window to window, so a document's score is that of its whole text, while
gradients stop at a window's start.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np

HIDDEN = 32
OPEN_CLASSES = 32  # classes of other words

TRAIN_LANES, TRAIN_STEPS = 192, 16
TRAIN_PIECE = 1024  # longer documents are learned from in pieces of so many tokens, so that lanes end together
SCORE_LANES, SCORE_STEPS = 512, 64
SCORE_PLACES = 16_384  # hidden states whose probabilities are computed together, at least
BLOCK_PLACES = 2_048  # of them, those whose class probabilities are in memory at once
RATE = 0.15
CLIP = 5.0

Params = dict[str, np.ndarray]


@dataclass(frozen=True)
class Sizes:
    """Numbers of frequent classes, of words in each, and of open classes."""

    frequent: int
    width: int = 64
    open: int = OPEN_CLASSES

    @property
    def words(self) -> int:
        """Places of words in frequent classes."""
        return self.frequent * self.width

    @property
    def inputs(self) -> int:
        return self.words + self.open


def initial(sizes: Sizes, word_counts: np.ndarray, open_shares: np.ndarray, total: float, seed: int = 7) -> Params:
    """Parameters of a model that gives every token its unigram share.

    `word_counts` has the smoothed counts of the frequent words (0 where a class is not full), `open_shares` those of
    the open classes; `total` is their sum.
    """
    rng = np.random.default_rng(seed)
    counts = word_counts.reshape(sizes.frequent, sizes.width)
    classes = np.concatenate([counts.sum(axis=1), open_shares])
    f = np.float32
    return {
        "input": rng.normal(0, 0.1, (sizes.inputs, 3 * HIDDEN)).astype(f),
        "recurrent": rng.normal(0, 0.5 / np.sqrt(HIDDEN), (HIDDEN, 3 * HIDDEN)).astype(f),
        "gate": np.zeros(3 * HIDDEN, f),
        "class": rng.normal(0, 0.01, (HIDDEN, len(classes))).astype(f),
        "class_bias": np.log(np.maximum(classes, 1e-12) / total).astype(f),
        "word": rng.normal(0, 0.01, (sizes.frequent, HIDDEN, sizes.width)).astype(f),
        "word_bias": np.log(np.maximum(counts, 1e-12) / np.maximum(counts.sum(axis=1, keepdims=True), 1e-12)).astype(f),
    }


def _log_sum(x: np.ndarray) -> np.ndarray:
    """Log of the sum of exponentials of each row; sums of short rows are fastest as a product with ones."""
    with np.errstate(over="ignore"):
        total = np.exp(x) @ np.ones(x.shape[1], dtype=x.dtype)
    if np.isfinite(total).all() and total.min(initial=1) > 0:
        return np.log(total)
    top = x.max(axis=1)
    return top + np.log(np.exp(x - top[:, None]).sum(axis=1))


# -- lanes --------------------------------------------------------------------------------------


def lanes_of(lengths: Sequence[int], lanes: int) -> list[list[int]]:
    """Documents dealt to lanes so that these are about equally long; the longest lane first."""
    heap = [(0, k) for k in range(min(lanes, len(lengths)))]
    out: list[list[int]] = [[] for _ in heap]
    total = [0] * len(heap)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        size, k = heapq.heappop(heap)
        out[k].append(i)
        total[k] = size + lengths[i]
        heapq.heappush(heap, (total[k], k))
    return [out[k] for k in sorted(range(len(out)), key=lambda k: -total[k])]


@dataclass
class Window:
    """`inputs`, `targets`, `starts` and `documents`, each steps x lanes; `valid` marks places in use."""

    inputs: np.ndarray
    targets: np.ndarray
    starts: np.ndarray
    documents: np.ndarray
    valid: np.ndarray


def windows(docs: Sequence[np.ndarray], end: int, lanes: int, steps: int) -> Iterator[Window]:
    """The documents' tokens, each document's last being `end`, in windows of lanes. Later windows have fewer lanes."""
    lanes_ = lanes_of([len(d) for d in docs], lanes)
    if not lanes_:
        return
    order = [i for lane in lanes_ for i in lane]
    sizes = np.array([len(docs[i]) for i in order])
    begins = np.cumsum(sizes) - sizes
    targets = np.concatenate([docs[i] for i in order]).astype(np.int64, copy=False)
    starts = np.zeros(len(targets), dtype=bool)
    starts[begins] = True
    inputs = np.concatenate([[end], targets[:-1]])
    inputs[starts] = end
    documents = np.repeat(order, sizes)
    lengths = np.array([sum(len(docs[i]) for i in lane) for lane in lanes_])
    firsts = np.cumsum(lengths) - lengths
    for at in range(0, int(lengths[0]), steps):
        active = int((lengths > at).sum())  # the longest lane is the first
        step = np.arange(at, min(at + steps, int(lengths[0])))[:, None]
        valid = step < lengths[:active]
        place = np.where(valid, firsts[:active] + step, 0)
        out = [whole[place] for whole in (inputs, targets, starts, documents)]
        if not valid.all():
            for part in out:
                part[~valid] = 0
        yield Window(*out, valid)


# -- forward and backward -----------------------------------------------------------------------


def _halves(dtype: type) -> np.ndarray:
    """sigmoid(x) = (1 + tanh(x / 2)) / 2; the inner halving is done on the tables."""
    return np.concatenate([np.full(2 * HIDDEN, 0.5), np.ones(HIDDEN)]).astype(dtype)


def _gate_major(rows: np.ndarray) -> np.ndarray:
    """The three gates' parts of `rows` one after the other: elementwise steps then run over whole blocks."""
    return np.ascontiguousarray(rows.reshape(len(rows), 3, HIDDEN).transpose(1, 0, 2))


def input_table(p: Params, rows: np.ndarray | slice = slice(None)) -> np.ndarray:
    """What the given rows of `input` add to the gates (gates x rows x hidden)."""
    return _gate_major((p["input"][rows] + p["gate"]) * _halves(np.float32))


def forward(p: Params, w: Window, h: np.ndarray, keep: bool = False, table: np.ndarray | None = None, rows: np.ndarray | None = None):
    """Hidden states of a window (steps x lanes x hidden), the last one, and what backpropagation needs: the states before,
    the gates and the inner product (3 x steps x lanes x hidden), and the candidates.

    `table` is an `input_table`, and `rows` the inputs' rows in it.
    """
    table, rows = input_table(p) if table is None else table, w.inputs if rows is None else rows
    recurrent = _gate_major(p["recurrent"] * _halves(np.float32))
    steps, lanes = rows.shape
    places = (rows[:, None, :] + (np.arange(3) * table.shape[1])[:, None]).reshape(steps, 3 * lanes)
    flat = table.reshape(-1, HIDDEN)
    f = np.float32
    states = np.empty((steps, lanes, HIDDEN), dtype=f)
    depth = steps if keep else 1  # of what is kept
    before, n = np.empty((depth, lanes, HIDDEN), dtype=f), np.empty((depth, lanes, HIDDEN), dtype=f)
    gates = np.empty((3, depth, lanes, HIDDEN), dtype=f)
    x = np.empty((3, lanes, HIDDEN), dtype=flat.dtype)
    any_start = w.starts.any(axis=1)
    for t in range(steps):
        at = t if keep else 0
        if keep or any_start[t]:
            before[at] = h
            h = before[at]
            if any_start[t]:
                h[w.starts[t]] = 0
        np.take(flat, places[t], axis=0, out=x.reshape(-1, HIDDEN), mode="clip")
        u, candidate, new = gates[:, at], n[at], states[t]
        np.matmul(h, recurrent, out=u)
        zr = u[:2]
        zr += x[:2]
        np.tanh(zr, out=zr)
        zr *= 0.5
        zr += 0.5
        np.multiply(zr[1], u[2], out=candidate)
        candidate += x[2]
        np.tanh(candidate, out=candidate)
        np.subtract(h, candidate, out=new)
        new *= zr[0]
        new += candidate
        h = new
    return states, h.copy(), (before, gates, n) if keep else ()


def _split(targets: np.ndarray, sizes: Sizes) -> tuple[np.ndarray, np.ndarray]:
    """Class of each target, and which are words of frequent classes."""
    frequent = targets < sizes.words
    return np.where(frequent, targets // sizes.width, targets - sizes.words + sizes.frequent), frequent


def _errors(logits: np.ndarray, targets: np.ndarray, scale: np.float32) -> np.ndarray:
    """Gradients of the logits: `scale` times the probabilities of each row, less `scale` at its target."""
    with np.errstate(over="ignore"):
        out = np.exp(logits)
        total = out @ np.ones(out.shape[1], dtype=out.dtype)
    if not (np.isfinite(total).all() and total.min(initial=1) > 0):
        out = np.exp(logits - _log_sum(logits)[:, None])
        total = np.ones(len(out), dtype=out.dtype)
    out *= (scale / total)[:, None]
    out[np.arange(len(targets)), targets] -= scale
    return out


def _sorted_by_class(classes: np.ndarray, sizes: Sizes) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The order of targets by class, and (class, from, to) in it for the frequent classes that occur; these come first."""
    order = np.argsort(classes.astype(np.uint16), kind="stable")  # sorted by radix; there are at most some hundred classes
    bounds = np.cumsum(np.bincount(classes, minlength=sizes.frequent)[: sizes.frequent]).tolist()
    return order, [(k, a, b) for k, (a, b) in enumerate(zip([0, *bounds], bounds)) if b > a]


def log_probabilities(p: Params, sizes: Sizes, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Natural logs of class and word probabilities of targets (places x hidden states); open classes: of the class."""
    classes, _ = _split(targets, sizes)
    order, spans = _sorted_by_class(classes, sizes)
    states, classes, within = np.take(states, order, axis=0), classes[order], targets[order] % sizes.width
    found = np.empty(len(targets), dtype=np.result_type(states, p["class"]))
    for a in range(0, len(targets), BLOCK_PLACES):
        logits = states[a : a + BLOCK_PLACES] @ p["class"]
        logits += p["class_bias"]
        found[a : a + BLOCK_PLACES] = logits[np.arange(len(logits)), classes[a : a + BLOCK_PLACES]] - _log_sum(logits)
    for k, a, b in spans:
        inside = states[a:b] @ p["word"][k]
        inside += p["word_bias"][k]
        found[a:b] += inside[np.arange(b - a), within[a:b]] - _log_sum(inside)
    out = np.empty_like(found)
    out[order] = found
    return out


def score(p: Params, sizes: Sizes, docs: Sequence[np.ndarray], end: int) -> np.ndarray:
    """Natural log probability of each document's token classes and frequent words."""
    out = np.zeros(len(docs))
    h = np.zeros((0, HIDDEN), dtype=np.float32)
    waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    places = 0
    table = input_table(p)
    for w in windows(docs, end, SCORE_LANES, SCORE_STEPS):
        if not len(h):
            h = np.zeros((w.inputs.shape[1], HIDDEN), dtype=np.float32)
        states, h, _ = forward(p, w, h[: w.inputs.shape[1]], table=table)
        if w.valid.all():  # nothing to leave out
            waiting.append((states.reshape(-1, HIDDEN), w.targets.ravel(), w.documents.ravel()))
        else:
            waiting.append((states[w.valid], w.targets[w.valid], w.documents[w.valid]))
        places += len(waiting[-1][1])
        if places >= SCORE_PLACES:
            _add(out, p, sizes, waiting)
            waiting, places = [], 0
    if waiting:
        _add(out, p, sizes, waiting)
    return out


def _add(out: np.ndarray, p: Params, sizes: Sizes, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
    states, targets, documents = (np.concatenate(c) for c in zip(*parts)) if len(parts) > 1 else parts[0]
    out += np.bincount(documents, weights=log_probabilities(p, sizes, states, targets), minlength=len(out))


def _sums_by_row(parts: np.ndarray, rows: np.ndarray, places: np.ndarray, n: int) -> np.ndarray:
    """Sums of `parts` (3 x places x hidden) at `places` by their rows, all `n` of which occur (n x 3 * hidden).

    The rows' first, second ... occurrences are added as blocks; those after the eighth, of few rows, row by row.
    """
    counts = np.bincount(rows, minlength=n)
    ranks = np.argsort(-counts, kind="stable")  # the commonest row first: those with a k-th occurrence are a slice
    counts = counts[ranks]
    where = np.empty(n, dtype=np.int64)
    where[ranks] = np.arange(n)
    ordered = places[np.argsort(where[rows].astype(np.uint32), kind="stable")]
    first = np.cumsum(counts) - counts
    sums = np.take(parts, ordered[first], axis=1)
    for k in range(1, 8):
        m = int(np.searchsorted(-counts, -k))  # rows with more than k
        if not m:
            break
        sums[:, :m] += np.take(parts, ordered[first[:m] + k], axis=1)
    m = int(np.searchsorted(-counts, -8))
    if m:
        rest = counts[:m] - 8
        begins = np.cumsum(rest) - rest
        at = np.arange(rest.sum()) + np.repeat(first[:m] + 8 - begins, rest)
        sums[:, :m] += np.add.reduceat(np.take(parts, ordered[at], axis=1), begins, axis=1)
    out = np.empty((n, parts.shape[0] * parts.shape[2]), dtype=parts.dtype)
    out[ranks] = sums.transpose(1, 0, 2).reshape(n, -1)
    return out


def gradients(p: Params, sizes: Sizes, w: Window, h: np.ndarray):
    """Gradients of the mean negative log probability of a window, by name, and the state at its end.

    Gradients of `input` and `word` come as (rows, values): most rows of a window's vocabulary are untouched.
    """
    # only the rows of `input` that occur are prepared; places out of use take any of them
    occurs = np.zeros(len(p["input"]), dtype=bool)
    occurs[w.inputs[w.valid]] = True
    rows = np.flatnonzero(occurs)
    number = np.zeros(len(occurs), dtype=np.int64)
    number[rows] = np.arange(len(rows))
    given = number[w.inputs]
    states, last, (before, gates, n) = forward(p, w, h, keep=True, table=input_table(p, rows), rows=given)

    # states in the order of their classes, so that a class is a slice
    valid = np.flatnonzero(w.valid)
    targets = w.targets.ravel()[valid]
    scale = np.float32(1.0 / max(1, len(targets)))
    classes, _ = _split(targets, sizes)
    order, spans = _sorted_by_class(classes, sizes)
    places = valid[order]
    ordered = states.reshape(-1, HIDDEN)[places]
    logits = ordered @ p["class"]
    logits += p["class_bias"]
    soft = _errors(logits, classes[order], scale)
    g: dict = {"class": ordered.T @ soft, "class_bias": soft.sum(axis=0)}
    back = soft @ p["class"].T
    if spans:
        occurring, stop = np.array([k for k, _, _ in spans]), spans[-1][2]
        inside = np.empty((stop, sizes.width), dtype=np.float32)
        for k, a, b in spans:
            np.matmul(ordered[a:b], p["word"][k], out=inside[a:b])
        inside += np.repeat(p["word_bias"][occurring], [b - a for _, a, b in spans], axis=0)
        inside = _errors(inside, targets[order[:stop]] % sizes.width, scale)
        weights, share = np.empty((len(spans), HIDDEN, sizes.width), dtype=np.float32), np.empty_like(ordered[:stop])
        for i, (k, a, b) in enumerate(spans):
            np.matmul(ordered[a:b].T, inside[a:b], out=weights[i])
            np.matmul(inside[a:b], p["word"][k].T, out=share[a:b])
        back[:stop] += share
        biases = np.add.reduceat(inside, [a for _, a, _ in spans], axis=0)
        g["word"], g["word_bias"] = (occurring, weights), (occurring, biases)
    into = np.zeros_like(states)
    into.reshape(-1, HIDDEN)[places] = back

    # what the gates pass on of a state's gradient does not depend on it: found for all steps at once
    z, r, inner = gates
    pass_n = (1 - z) * (1 - n * n)
    passed = np.empty((4, *states.shape), dtype=np.float32)
    du, of_input = passed[:3], passed[1:]  # of the products with the recurrent weights: n, z, r; of the inputs: z, r, n
    np.multiply(pass_n, r, out=passed[0])
    np.subtract(before, n, out=passed[1])
    passed[1] *= z * (1 - z)
    np.multiply(inner, r * (1 - r), out=passed[2])
    passed[2] *= pass_n
    passed[3] = pass_n
    turned = np.ascontiguousarray(np.roll(p["recurrent"].reshape(HIDDEN, 3, HIDDEN), 1, axis=1).transpose(1, 2, 0))
    moved = np.empty((3, *last.shape), dtype=np.result_type(passed, turned))
    d = np.zeros_like(last)
    for t in range(len(states) - 1, -1, -1):
        d += into[t]
        u = passed[:, t]
        u *= d
        np.matmul(u[:3], turned, out=moved)
        d *= z[t]
        for part in moved:
            d += part
        d[w.starts[t]] = 0
    recurrent = np.matmul(before.reshape(-1, HIDDEN).T, du.reshape(3, -1, HIDDEN))
    g["recurrent"] = np.roll(recurrent, -1, axis=0).transpose(1, 0, 2).reshape(HIDDEN, 3 * HIDDEN)
    values = _sums_by_row(of_input.reshape(3, -1, HIDDEN), given.ravel()[valid], valid, len(rows))
    g["gate"] = values.sum(axis=0)
    g["input"] = (rows, values)
    return g, last


def train(p: Params, sizes: Sizes, docs: Iterable[Sequence[np.ndarray]], end: int) -> tuple[Params, int]:
    """Parameters after one pass of Adagrad over groups of documents, and the number of tokens seen."""
    p = {k: v.copy() for k, v in p.items()}
    seen = {k: np.full_like(v, 1e-4) for k, v in p.items()}
    tokens = 0
    for group in docs:
        h = np.zeros((0, HIDDEN), dtype=np.float32)
        pieces = [d[i : i + TRAIN_PIECE] for d in group for i in range(0, len(d), TRAIN_PIECE)]
        for w in windows(pieces, end, TRAIN_LANES, TRAIN_STEPS):
            if not len(h):
                h = np.zeros((w.inputs.shape[1], HIDDEN), dtype=np.float32)
            g, h = gradients(p, sizes, w, h[: w.inputs.shape[1]])
            tokens += int(w.valid.sum())
            flat = [(v[1] if isinstance(v, tuple) else v).ravel() for v in g.values()]
            norm = np.sqrt(sum(float(v @ v) for v in flat))
            factor = np.float32(min(1.0, CLIP / (norm + 1e-9)))
            for name, value in g.items():
                rows, value = value if isinstance(value, tuple) else (slice(None), value)
                if len(value) == len(p[name]):  # all of them, in order
                    rows = slice(None)
                if factor < 1:
                    value *= factor
                squares = seen[name][rows]
                squares += value * value
                if not isinstance(rows, slice):
                    seen[name][rows] = squares
                value /= np.sqrt(squares)
                value *= np.float32(RATE)
                p[name][rows] -= value
    return p, tokens
