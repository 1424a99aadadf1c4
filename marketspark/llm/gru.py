"""A gated recurrent language model over word ids, in numpy.

The softmax is factored by class: a class from the state, then a word from the state within the
class. In the wide classes of a long list a group of words comes between: a group within the class, then a
word within the group, each from the state. The last class stands for all words outside the list; which of
them it is does not depend on the state.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

HIDDEN = 16
#: Classes of a short list; a longer one has about the square root of its words.
CLASSES = 48
#: A list beyond LONG words has so many classes, and groups of GROUP words in those wider than WHOLE.
LONG = 1 << 14
GROUPED_CLASSES = 64
WHOLE = 256
GROUP = 16
#: Streams that run side by side and steps that a gradient goes back.
STREAMS, STEPS = 256, 32
#: Windows that are cut at a time.
AHEAD = 8
#: A trainer has a stream for so many words of its list, up to WIDE: a step changes most classes of a long one.
SPARE, WIDE = 512, 1024
#: Numbers that are worked out at a time for the classes.
BLOCK = 1 << 18
RATE = 0.03
CLIP = 5.0
#: Numbers of a slice of the weights.
SLICE = 1 << 16
#: Rows of one group from which their products are summed by a product of matrices.
MANY = 6
#: Rows of logits this near to one another can be shifted by one number before their exponentials are taken.
SPREAD = 60.0
#: The bias of what fills the last group.
NEVER = -1e4
#: Rows of first weights that are drawn at a time.
DRAWN = 1 << 13


class Words:
    """Ids of listed words by count: 0 the most frequent; ``size`` is any other word.

    Classes widen with the rank, so a frequent word costs little however long the list is.
    """

    def __init__(self, counts: np.ndarray, rest: float, classes: int | None = None, long: int = LONG, whole: int = WHOLE, group: int = GROUP):
        self.size, self.group = len(counts), group
        grouped = self.size > long
        classes = classes or (GROUPED_CLASSES if grouped else max(CLASSES, int(0.7 * self.size ** 0.5)))
        power = 3 if grouped else 2
        bounds = np.unique(np.ceil(np.linspace(0, 1, min(classes, self.size) + 1) ** power * self.size).astype(np.int64))
        wide = np.flatnonzero(np.diff(bounds) > whole) if grouped else []
        #: Classes whose words are told apart at once, the first; and their words.
        self.whole = int(wide[0]) if len(wide) else len(bounds) - 1
        self.first = int(bounds[self.whole])
        inner = bounds[self.whole + 1:-1] - self.first
        bounds[self.whole + 1:-1] = self.first + inner // group * group
        self.bounds = bounds = np.unique(bounds)
        self.classes = len(self.bounds) - 1
        #: Where each wide class has its groups; all but the last group are full.
        self.groups = -(-(bounds[self.whole:] - self.first) // group)
        self.counts, self.rest = counts.astype(np.float64), rest
        self.class_of = np.append(np.searchsorted(self.bounds, np.arange(self.size), side="right") - 1, self.classes).astype(np.int64)

    @property
    def columns(self) -> int:
        """Words with those that fill the last group, which have no probability."""
        return self.first + int(self.groups[-1]) * self.group

    def by_group(self, values: np.ndarray) -> np.ndarray:
        """A view of the grouped words' part of ``values`` (a column a word): groups, then words."""
        return values[..., self.first:].reshape(*values.shape[:-1], -1, self.group)


def initial(words: Words, hidden: int = HIDDEN, seed: int = 3) -> dict[str, np.ndarray]:
    """Weights that make the model the unigram of the counts, whatever the state."""
    rng = np.random.default_rng(seed)

    def small(rows, columns):
        out = np.empty((rows, columns), np.float32)
        for at in range(0, rows, DRAWN):
            out[at:at + DRAWN] = rng.standard_normal((min(DRAWN, rows - at), columns)) * 0.1
        return out

    sums = np.add.reduceat(words.counts, words.bounds[:-1]) if words.size else np.empty(0)
    mass = np.maximum(np.append(sums, words.rest), 1e-3)
    counts = np.append(np.maximum(words.counts, 1e-3), np.zeros(words.columns - words.size))
    with np.errstate(divide="ignore"):
        bw = np.maximum(np.log(counts), NEVER).astype(np.float32)
    out = {
        "embed": small(words.size + 1, hidden), "wx": small(hidden, 3 * hidden), "wh": small(hidden, 3 * hidden),
        "b": np.zeros(3 * hidden, np.float32),
        "wc": np.zeros((hidden, words.classes + 1), np.float32), "bc": np.log(mass / mass.sum()).astype(np.float32),
        "ww": np.zeros((hidden, words.columns), np.float32), "bw": bw,
    }
    if words.whole < words.classes:
        out["wg"] = np.zeros((hidden, int(words.groups[-1])), np.float32)
        out["bg"] = np.log(words.by_group(counts).sum(axis=1)).astype(np.float32)
    return out


def _sigmoid(x):
    return 0.5 * (np.tanh(0.5 * x) + 1.0)


def forward(p, inputs, fresh, state, keep: bool):
    """States after each of the steps (rows of ``inputs``); ``fresh`` marks where a text begins."""
    steps, streams = inputs.shape
    hidden = p["wh"].shape[0]
    gates = (p["embed"][inputs.ravel()] @ p["wx"] + p["b"]).reshape(steps, streams, 3 * hidden)
    states = np.empty((steps, streams, hidden), np.float32)
    saved = []
    for t in range(steps):
        before = state * ~fresh[t][:, None] if fresh[t].any() else state
        u = before @ p["wh"]
        zr = _sigmoid(gates[t, :, :2 * hidden] + u[:, :2 * hidden])
        z, r = zr[:, :hidden], zr[:, hidden:]
        inner = u[:, 2 * hidden:]
        n = np.tanh(gates[t, :, 2 * hidden:] + r * inner)
        state = n + z * (before - n)
        states[t] = state
        if keep:
            saved.append((before, z, r, inner, n))
    return states, state, saved


def _softmax(x, short: bool = True):
    """In place. A short list's rows are each shifted by their most; others by that of all rows, if it is near."""
    if short or x.size and x.max() - x.min() > SPREAD:
        x -= x.max(axis=1, keepdims=True)
    elif x.size:
        x -= x.max()
    np.exp(x, out=x)
    x /= x.sum(axis=1, keepdims=True) if short else (x @ np.ones(x.shape[1], x.dtype))[:, None]
    return x


def output(p, words: Words, states, targets, grads=None, touched=None):
    """Natural log probability of each target; with ``grads`` also the gradient of the states.

    The word's part is 0 for words outside the list. ``touched``, if given, gets the gradients of ``ww``,
    ``bw``, ``wg`` and ``bg`` part by part, in place of whole arrays: a name, a view of such an array, the
    place of the part in the view, and its gradient.
    """
    n, short = len(targets), words.whole == words.classes
    chosen = words.class_of[targets]
    logp, d_states = np.empty(n, states.dtype), None
    if grads is not None:
        d_states = np.empty_like(states)
        grads["wc"], grads["bc"] = np.zeros_like(p["wc"]), np.zeros_like(p["bc"])
    size = max(1, BLOCK // (words.classes + 1))
    for first in range(0, n, size):
        block = slice(first, first + size)
        probability = _softmax(states[block] @ p["wc"] + p["bc"], short)
        rows, own = np.arange(len(probability)), chosen[block]
        logp[block] = np.log(np.maximum(probability[rows, own], 1e-30))
        if grads is not None:
            probability[rows, own] -= 1.0
            grads["wc"] += states[block].T @ probability
            grads["bc"] += probability.sum(axis=0)
            d_states[block] = probability @ p["wc"].T
    if grads is not None:
        if touched is None:
            grads.update((name, np.zeros_like(p[name])) for name in ("ww", "bw", "wg", "bg") if name in p)

            def touched(name, view, at, grad):
                view(grads[name])[at] = grad

    order = np.argsort(chosen.astype(np.int16), kind="stable")
    ends = np.searchsorted(chosen[order], np.arange(words.classes + 1))
    sorted_states, sorted_targets, inner = states[order], targets[order], np.zeros(n, states.dtype)
    d_sorted = np.zeros_like(states) if grads is not None else None
    for c in range(words.classes):
        at = slice(ends[c], ends[c + 1])
        if ends[c] == ends[c + 1]:
            continue
        if c < words.whole:
            a, b, weight, bias = words.bounds[c], words.bounds[c + 1], "ww", "bw"
            target = sorted_targets[at] - a
        else:
            a, b, weight, bias = words.groups[c - words.whole], words.groups[c - words.whole + 1], "wg", "bg"
            target = (sorted_targets[at] - words.first) // words.group - a
        h = sorted_states[at]
        inside = _softmax(h @ p[weight][:, a:b] + p[bias][a:b], short)
        own = np.arange(len(h))
        inner[at] = np.log(np.maximum(inside[own, target], 1e-30))
        if grads is not None:
            inside[own, target] -= 1.0
            d_sorted[at] = inside @ p[weight][:, a:b].T
            touched(weight, np.asarray, np.s_[..., a:b], h.T @ inside)
            touched(bias, np.asarray, np.s_[..., a:b], inside.sum(axis=0))
    if not short:
        at = slice(ends[words.whole], ends[words.classes])
        _within_groups(p, words, sorted_states[at], sorted_targets[at] - words.first, inner[at], d_sorted[at] if grads is not None else None, touched)
    logp[order] += inner
    if grads is not None:
        d_states[order] += d_sorted
    return logp, d_states


def _within_groups(p, words: Words, states, targets, logp, d_states, touched):
    """Adds what the words within their groups bring to ``logp`` and ``d_states``; a group is never divided."""
    group, word = np.divmod(targets, words.group)
    at = np.argsort(group, kind="stable")
    group, word = group[at], word[at]
    ww, bw = words.by_group(p["ww"]), words.by_group(p["bw"])
    starts = np.flatnonzero(np.diff(group, prepend=-1))
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + max(1, BLOCK // (len(ww) * words.group)))))
        block = slice(starts[first], starts[last] if last < len(starts) else len(at))
        rows, h, weights = at[block], states[at[block]], ww[:, group[block]]
        inside = _softmax(np.einsum("nh,hnw->nw", h, weights) + bw[group[block]], False)
        own = np.arange(len(rows))
        logp[rows] += np.log(np.maximum(inside[own, word[block]], 1e-30))
        if d_states is not None:
            inside[own, word[block]] -= 1.0
            d_states[rows] += np.einsum("hnw,nw->nh", weights, inside)
            some, begins = group[starts[first:last]], starts[first:last] - starts[first]
            touched("ww", words.by_group, np.s_[..., some, :], _outer_sums(h, inside, begins))
            touched("bw", words.by_group, np.s_[..., some, :], np.add.reduceat(inside, begins, axis=0))
        first = last


def _outer_sums(h, inside, begins):
    """Sums, over each run of rows, of the outer products of ``h`` and ``inside``: hidden, runs, words."""
    n = np.diff(begins, append=len(h))
    sums = h[begins].T[:, :, None] * inside[begins]
    for k in range(1, min(int(n.max()), MANY)):
        more = np.flatnonzero((n > k) & (n <= MANY))
        rows = begins[more] + k
        sums[:, more] += h[rows].T[:, :, None] * inside[rows]
    for run in np.flatnonzero(n > MANY).tolist():
        rows = slice(begins[run], begins[run] + n[run])
        sums[:, run] = h[rows].T @ inside[rows]
    return sums


def backward(p, inputs, fresh, saved, d_states, grads):
    """Gradients of the recurrent weights over one window; nothing goes back beyond it."""
    steps, streams = inputs.shape
    hidden = p["wh"].shape[0]
    d_gates = np.empty((steps, streams, 3 * hidden), np.float32)
    grads["wh"] = np.zeros_like(p["wh"])
    later = np.zeros((streams, hidden), np.float32)
    du = np.empty((streams, 3 * hidden), np.float32)
    for t in range(steps - 1, -1, -1):
        before, z, r, inner, n = saved[t]
        d = d_states[t] + later
        gates = d_gates[t]
        dz, dr, dn = gates[:, :hidden], gates[:, hidden:2 * hidden], gates[:, 2 * hidden:]
        keep = 1.0 - z
        np.multiply(d * keep, 1.0 - n * n, out=dn)
        np.multiply(d * (before - n) * z, keep, out=dz)
        np.multiply(dn * inner * r, 1.0 - r, out=dr)
        du[:, :2 * hidden] = gates[:, :2 * hidden]
        np.multiply(dn, r, out=du[:, 2 * hidden:])
        grads["wh"] += before.T @ du
        later = d * z + du @ p["wh"].T
        if fresh[t].any():
            later *= ~fresh[t][:, None]
    flat = d_gates.reshape(-1, 3 * hidden)
    x = p["embed"][inputs.ravel()]
    grads["wx"], grads["b"] = x.T @ flat, flat.sum(axis=0)
    dx = flat @ p["wx"].T
    order = np.argsort(inputs.ravel(), kind="stable")
    ids = inputs.ravel()[order]
    starts = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
    grads["embed"] = (ids[starts], np.add.reduceat(dx[order], starts, axis=0))


class Streams:
    """Texts dealt to streams; every window is the next steps of all streams that have any.

    A text goes to the stream with the least waiting, so streams run dry together; the state is
    carried from window to window until the text ends.
    """

    def __init__(self, start: int, streams: int = STREAMS, steps: int = STEPS):
        self.start, self.steps = start, steps
        self.waiting = np.zeros(streams, np.int64)
        self.parts: list[list[tuple[int, np.ndarray, int]]] = [[] for _ in range(streams)]

    def add(self, text: int, ids: np.ndarray) -> None:
        stream = int(self.waiting.argmin())
        self.parts[stream].append((text, ids, 0))
        self.waiting[stream] += len(ids)

    def windows(self, end: bool) -> Iterator[tuple[np.ndarray, ...]]:
        """Streams in the window, inputs, targets, text numbers (-1: nothing) and marks of first words.

        While more texts come (``end`` false) only whole windows are given.
        """
        while True:
            active = np.flatnonzero(self.waiting > 0)
            if not len(active) or not end and self.waiting.min() < self.steps:
                return
            times = 1 if end else int(min(self.waiting.min() // self.steps, AHEAD))
            span = self.steps * times
            shape = (len(active), span)
            targets, texts = np.zeros(shape, np.int64), np.full(shape, -1, np.int64)
            inputs, fresh = np.full(shape, self.start, np.int64), np.zeros(shape, bool)
            for row, stream in enumerate(active):
                at, parts = 0, self.parts[stream]
                while at < span and parts:
                    text, ids, done = parts[0]
                    n = min(span - at, len(ids) - done)
                    targets[row, at:at + n] = ids[done:done + n]
                    texts[row, at:at + n] = text
                    if done:
                        inputs[row, at:at + n] = ids[done - 1:done + n - 1]
                    else:
                        fresh[row, at] = True
                        inputs[row, at + 1:at + n] = ids[:n - 1]
                    at += n
                    if done + n == len(ids):
                        parts.pop(0)
                    else:
                        parts[0] = (text, ids, done + n)
                self.waiting[stream] -= at
            for first in range(0, span, self.steps):
                yield active, *(x[:, first:first + self.steps].T.copy() for x in (inputs, targets, texts, fresh))


class Trainer:
    """Truncated backpropagation with adaptive steps from given weights."""

    def __init__(self, p: dict[str, np.ndarray], words: Words, start: int, rate: float = RATE, streams: int | None = None):
        streams = streams or max(STREAMS, min(WIDE, words.size // SPARE))
        self.p = {k: v.copy() for k, v in p.items()}
        self.words, self.rate, self.tokens = words, rate, 0
        self.squares = {k: np.full_like(v, 1e-2) for k, v in p.items()}
        self.streams = Streams(start, streams)
        self.state = np.zeros((streams, p["wh"].shape[0]), np.float32)

    def _step(self, name, grad):
        if name == "embed":
            at, grad = grad
            self.squares[name][at] += grad * grad
            self.p[name][at] -= self.rate * grad / np.sqrt(self.squares[name][at])
        else:
            self.squares[name] += grad * grad
            self.p[name] -= self.rate * grad / np.sqrt(self.squares[name])

    def run(self, end: bool) -> None:
        for active, inputs, targets, texts, fresh in self.streams.windows(end):
            states, last, saved = forward(self.p, inputs, fresh, self.state[active], True)
            self.state[active] = last
            real = np.flatnonzero(texts.ravel() >= 0)
            flat = states.reshape(-1, states.shape[2])
            grads: dict = {}
            scale = np.float32(1.0 / np.sqrt(len(real)))

            def touched(name, view, at, grad, scale=scale):
                grad *= scale
                np.clip(grad, -CLIP, CLIP, out=grad)
                squares, weights = view(self.squares[name]), view(self.p[name])
                root = grad * grad
                root += squares[at]
                squares[at] = root
                grad /= np.sqrt(root, out=root)
                grad *= np.float32(self.rate)
                weights[at] -= grad

            _, d = output(self.p, self.words, flat[real], targets.ravel()[real], grads, touched)
            d_states = np.zeros_like(flat)
            d_states[real] = d
            backward(self.p, inputs, fresh, saved, d_states.reshape(states.shape), grads)
            for name, grad in grads.items():
                if name == "embed":
                    self._step(name, (grad[0], np.clip(grad[1] * scale, -CLIP, CLIP)))
                else:
                    self._step(name, np.clip(grad * scale, -CLIP, CLIP))
            self.tokens += len(real)

    def add(self, ids: np.ndarray) -> None:
        self.streams.add(0, ids)


class Scorer:
    """Sums of log probabilities of whole texts, by their number."""

    def __init__(self, p, words: Words, start: int, streams: int = STREAMS, steps: int = 64):
        self.p, self.words = p, words
        self.streams = Streams(start, streams, steps)
        self.state = np.zeros((streams, p["wh"].shape[0]), np.float32)
        self.sums = np.zeros(0)

    def add(self, text: int, ids: np.ndarray) -> None:
        if text >= len(self.sums):
            self.sums = np.concatenate((self.sums, np.zeros(max(1024, text + 1 - len(self.sums), len(self.sums)))))
        self.streams.add(text, ids)

    def run(self, end: bool) -> None:
        for active, inputs, targets, texts, fresh in self.streams.windows(end):
            states, last, _ = forward(self.p, inputs, fresh, self.state[active], False)
            self.state[active] = last
            real = np.flatnonzero(texts.ravel() >= 0)
            logp, _ = output(self.p, self.words, states.reshape(-1, states.shape[2])[real], targets.ravel()[real])
            np.add.at(self.sums, texts.ravel()[real], logp)


def slices(p: dict[str, np.ndarray]) -> Iterator[np.ndarray]:
    """Views of all weights, SLICE numbers at most in each, always in the same order."""
    for name in sorted(p):
        flat = p[name].reshape(-1)
        for at in range(0, flat.size, SLICE):
            yield flat[at:at + SLICE]
