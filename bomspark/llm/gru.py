"""A gated recurrent language model in numpy, with a class-factored softmax.

Symbols 0 .. heads-1 are frequent words in classes of ``width`` by rank; each
further symbol is a class of its own (a group of rarer words, whose
probability within the group is the caller's).  The probability of a symbol is
that of its class given the state, times that of the word within the class.

Texts run through lanes, one after the other; a lane's state is reset where a
text begins and carried from window to window within it, so every text is
scored in full.  Training is truncated backpropagation over such windows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np

#: Scoring: lanes side by side and steps per window.
LANES, WINDOW = 256, 64
#: Training: lanes, steps backpropagated through, learning rate.
TRAIN_LANES, TRAIN_STEPS, RATE = 512, 16, 0.03
#: Times as many steps at most where few lanes are left.
_LONGER = 16
#: States whose class scores are held at once: they stay in a core's cache.
_ROWS = 1024
#: Weights that are updated at once.
_WEIGHTS = 16384
_OFTEN = 16
#: Scores within this need no shift before their exponentials are summed.
_CALM = 60.0


class _Room:
    """Arrays for the values of a window, kept from window to window: memory that is taken
    anew for each costs a page fault per page."""

    def __init__(self):
        self.held: dict[str, np.ndarray] = {}

    def get(self, name: str, shape: tuple[int, ...], kind) -> np.ndarray:
        size = math.prod(shape)
        if name not in self.held or self.held[name].size < size:
            self.held[name] = np.empty(size, kind)
        return self.held[name][:size].reshape(shape)


def _product(h: np.ndarray, w: np.ndarray, out: np.ndarray) -> np.ndarray:
    """``h @ w``, rounded to the type of ``out``."""
    if w.dtype == out.dtype:
        return np.matmul(h, w, out=out)
    np.copyto(out, h.astype(w.dtype) @ w, casting="same_kind")
    return out


def _gates(rows: np.ndarray, hidden: int) -> np.ndarray:
    """Rows of three gates side by side as one array per gate, so that each is gapless; the
    first two, whose sigmoid is taken, with their sign changed."""
    out = np.ascontiguousarray(rows.reshape(len(rows), 3, hidden).transpose(1, 0, 2))
    np.negative(out[:2], out=out[:2])
    return out


def _advance(h, x, u, bias, room, zr, q, n, out) -> np.ndarray:
    """Next state from state ``h`` and inputs ``x``, in gates as ``u``; all that the gradient
    needs is left in ``zr``, ``q`` and ``n``, the state in ``out``; ``room`` is used up."""
    _product(h, u, room)
    np.add(x[:2], room[:2], out=zr)
    np.exp(zr, out=zr)
    zr += 1
    np.reciprocal(zr, out=zr)
    np.add(room[2], bias, out=q)
    np.multiply(zr[1], q, out=n)
    n += x[2]
    np.tanh(n, out=n)
    np.subtract(h, n, out=out)
    out *= zr[0]
    out += n
    return out


def _blocks(*same: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Views of gapless arrays of one shape, ``_WEIGHTS`` of each at a time."""
    for a in range(0, same[0].size, _WEIGHTS):
        yield tuple(x.reshape(-1)[a:a + _WEIGHTS] for x in same)


def _is_calm(h: np.ndarray, w: np.ndarray, b: np.ndarray) -> bool:
    """Whether no score ``h @ w + b`` is so large that its exponential needs care.  States
    begun at zero stay within one, so for them this is a matter of the weights alone."""
    most = max(1.0, np.abs(h).max(initial=0))
    return bool(most * np.abs(w).sum(axis=-2).max(initial=0) + np.abs(b).max(initial=0) < _CALM)


def _log_at(x: np.ndarray, at: np.ndarray, calm: bool) -> np.ndarray:
    """Log softmax of each row of ``x`` at its place ``at``; ``x`` is used up."""
    if not calm:
        x -= x.max(axis=1, keepdims=True)
    own = x[np.arange(len(at)), at]
    return own - np.log(np.exp(x, out=x).sum(axis=1))


def _loss_slope(x: np.ndarray, at: np.ndarray, weight: np.ndarray, calm: bool) -> np.ndarray:
    """Gradient by ``x`` of each row's weighted log loss; ``x`` is used up."""
    if not calm:
        x -= x.max(axis=1, keepdims=True)
    np.exp(x, out=x)
    x *= (weight / (x @ np.ones(x.shape[1], x.dtype)))[:, None]
    x[np.arange(len(at)), at] -= weight
    return x


@dataclass
class Gru:
    heads: int                   # a multiple of width
    width: int
    groups: int
    hidden: int
    p: dict[str, np.ndarray] = field(default_factory=dict)

    @property
    def start(self) -> int:      # input before a text's first symbol
        return self.heads + self.groups

    @classmethod
    def fresh(cls, frequency: np.ndarray, heads: int, width: int, hidden: int, seed: int = 1) -> Gru:
        """Small random weights; the biases give the symbols' frequencies."""
        m = cls(heads, width, len(frequency) - heads, hidden)
        rng = np.random.default_rng(seed)
        f = frequency.astype(np.float64) + 0.5
        inner = f[:heads].reshape(-1, width)
        classes = np.concatenate((inner.sum(axis=1), f[heads:]))
        m.p = {
            "x": rng.normal(0, 0.1, (len(frequency) + 1, 3 * hidden)),
            "u": rng.normal(0, hidden ** -0.5, (hidden, 3 * hidden)),
            "n": np.zeros(hidden),
            "c": np.zeros((hidden, len(classes))), "cb": np.log(classes / classes.sum()),
            "w": np.zeros((len(inner), hidden, width)),
            "wb": np.log(inner / inner.sum(axis=1, keepdims=True)),
        }
        m.p = {k: v.astype(np.float32) for k, v in m.p.items()}
        return m

    def step(self, x: np.ndarray, h: np.ndarray):
        """Next state from input rows ``x`` (of table x) and state ``h``."""
        zr, (q, n, out) = np.empty((2, *h.shape), h.dtype), np.empty((3, *h.shape), h.dtype)
        _advance(h, _gates(x, self.hidden), _gates(self.p["u"], self.hidden), self.p["n"],
                 np.empty((3, *h.shape), h.dtype), zr, q, n, out)
        return out, *zr, q, n

    def classes_of(self, target: np.ndarray) -> np.ndarray:
        return np.where(target < self.heads, target // self.width,
                        target - self.heads + self.heads // self.width)

    def log_prob(self, h: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural log probability of each target given its state."""
        order, own, parts = _by_class(self.classes_of(target))
        seen, lp = h.take(order, axis=0), np.empty(len(target))
        calm = _is_calm(seen, self.p["c"], self.p["cb"])
        room = np.empty((min(_ROWS, len(own)), self.p["c"].shape[1]), h.dtype)
        for a in range(0, len(own), _ROWS):
            part = slice(a, a + _ROWS)
            x = _product(seen[part], self.p["c"], room[:len(own) - a])
            x += self.p["cb"]
            lp[part] = _log_at(x, own[part], calm)
        x, parts = self._inner(seen, parts, _Room())
        lp[:len(x)] += _log_at(x, target.take(order[:len(x)]) % self.width,
                               _is_calm(seen, self.p["w"], self.p["wb"]))
        out = np.empty_like(lp)
        out[order] = lp
        return out

    def _inner(self, h: np.ndarray, parts: list, held: _Room) -> tuple[np.ndarray, list]:
        """Scores of the words in each state's class, and the parts with words; states are
        in order of class, so those of groups come last."""
        parts = [(c, part) for c, part in parts if c < self.heads // self.width]
        x = held.get("inner", (parts[-1][1].stop if parts else 0, self.width), h.dtype)
        for c, part in parts:
            _product(h[part], self.p["w"][c], x[part])
            x[part] += self.p["wb"][c]
        return x, parts

    def score(self, texts: list[np.ndarray], lanes: int = LANES, window: int = WINDOW) -> np.ndarray:
        """Natural log probability of each text (an array of symbols)."""
        total = np.zeros(len(texts) + 1)
        if not texts:
            return total[:-1]
        laid = Lanes(texts, min(lanes, len(texts)), self.start)
        # products in double: a text's score does not depend on the texts beside it
        m = Gru(self.heads, self.width, self.groups, self.hidden, {
            k: v.astype(np.float64) if k in ("u", "c", "w") else v for k, v in self.p.items()})
        k, inputs, u = self.hidden, _gates(m.p["x"], self.hidden), _gates(m.p["u"], self.hidden)
        h = np.zeros((len(laid.sizes), k), np.float32)
        for at in range(0, laid.steps, window):
            end = min(at + window, laid.steps)
            target, source, text = laid.window(at, end)
            n = target.shape[1]
            states = np.empty((end - at, n, k), np.float32)
            keep = (source != m.start)[:, :, None].astype(np.float32)
            x, room = np.empty((3, n, k), np.float32), np.empty((8, n, k), np.float32)
            h = h[:n]
            for t in range(end - at):
                for gate, table in zip(x, inputs):
                    table.take(source[t], axis=0, out=gate, mode="clip")
                np.multiply(h, keep[t], out=room[7])
                h = _advance(room[7], x, u, m.p["n"], room[:3], room[3:5], room[5], room[6], states[t])
            lp = m.log_prob(states.reshape(-1, k), target.ravel())
            total += np.bincount(text.ravel(), lp, len(texts) + 1)
        return total[:-1]

    def train(self, texts: list[np.ndarray], tokens: int, lanes: int = TRAIN_LANES,
              steps: int = TRAIN_STEPS, rate: float = RATE, epochs: int = 6) -> Gru:
        """Truncated backpropagation over every symbol of ``texts``; as often as
        ``tokens`` symbols allow, once at least and ``epochs`` times at most.
        The order of the texts is kept, so it should be a random one."""
        size = sum(map(len, texts))
        if not size:
            return self
        laid = Lanes(texts, min(lanes, len(texts)), self.start, False)
        grad = {k: np.empty_like(v) for k, v in self.p.items()}
        # weights, gradients and their moments in blocks that stay in a core's cache
        blocks = [(p, g, np.zeros_like(p), np.zeros_like(p)) for k, v in self.p.items()
                  for p, g in _blocks(v, grad[k])]
        room, held = np.empty(_WEIGHTS, np.float32), _Room()
        turns = min(epochs, max(1, tokens // size))
        done = update = 0
        for _ in range(turns):
            h = np.zeros((len(laid.sizes), self.hidden), np.float32)
            for at, end in laid.windows(steps, _LONGER):
                target, source, text = laid.window(at, end)
                use = text < len(texts)
                h, _ = self._backprop(source, target, use, h[:target.shape[1]], grad, held)
                done += int(use.sum())
                update += 1
                fall = rate * max(0.1, 1 - done / (turns * size))
                fall *= float(np.sqrt(1 - 0.99 ** update)) / (1 - 0.9 ** update)
                for p, g, m, v in blocks:
                    r = room[:len(p)]
                    m *= 0.9
                    m += np.multiply(g, 0.1, out=r)
                    np.multiply(g, g, out=r)
                    r *= 0.01
                    v *= 0.99
                    v += r
                    np.sqrt(v, out=r)
                    r += 1e-6
                    np.divide(m, r, out=r)
                    r *= fall
                    p -= r
        return self

    def _backprop(self, source, target, use, h, grad=None, held=None):
        """State after the window and mean gradients of its log loss (in the
        arrays ``grad`` if they are given).  The state may be in ``held``."""
        held = held or _Room()
        k, p, steps, lanes = self.hidden, self.p, len(source), len(h)
        if grad is None:
            grad = {name: np.empty_like(v) for name, v in p.items()}
        keep = (source != self.start)[:, :, None].astype(np.float32)
        rows, u, kind = source.ravel(), _gates(p["u"], k), p["x"].dtype
        inputs = held.get("inputs", (3, steps, lanes, k), kind)
        for gate, table in zip(inputs, _gates(p["x"], k)):
            table.take(rows, axis=0, out=gate.reshape(-1, k), mode="clip")
        before, q, n, states, by_n, rest = (held.get(name, (steps, lanes, k), kind) for name in (
            "before", "q", "n", "states", "by_n", "rest"))
        zr, room = held.get("zr", (2, steps, lanes, k), kind), held.get("room", (3, lanes, k), kind)
        for t in range(steps):
            np.multiply(h, keep[t], out=before[t])
            h = _advance(before[t], inputs[:, t], u, p["n"], room, zr[:, t], q[t], n[t], states[t])
        h = h.copy()                  # the states' room is used again
        dh = self._by_state(states.reshape(-1, k), target.ravel(), use.ravel(), grad, held)
        dh = dh.reshape(steps, lanes, k)
        # what the loss by a state is multiplied by: for the inputs of its gates, through u
        # and, in the candidate's own case, without its gate
        z, r = zr
        through = inputs
        np.multiply(n, n, out=by_n)
        np.subtract(1, by_n, out=by_n)
        by_n *= np.subtract(1, z, out=rest)
        np.subtract(before, n, out=through[0])
        through[0] *= z
        through[0] *= rest
        np.multiply(by_n, r, out=through[2])
        np.multiply(through[2], q, out=through[1])
        through[1] *= np.subtract(1, r, out=rest)
        back, up = np.zeros_like(h), np.ascontiguousarray(_gates(p["u"], k).transpose(0, 2, 1))
        np.negative(up[:2], out=up[:2])
        for t in reversed(range(steps)):
            d, own = dh[t], through[:, t]
            d += back
            own *= d
            np.matmul(own, up, out=room)
            np.multiply(d, z[t], out=back)
            for part in room:
                back += part
            back *= keep[t]
        through = through.reshape(3, -1, k)
        flat = before.reshape(-1, k).T
        for i, part in enumerate(through):
            np.matmul(flat, part, out=grad["u"][:, i * k:(i + 1) * k])
        grad["n"][:] = through[2].sum(axis=0)
        np.multiply(by_n.reshape(-1, k), dh.reshape(-1, k), out=through[2])
        order = _order(rows)
        own, rest = held.get("own", (len(rows), 3, k), kind), rest.reshape(-1, k)
        for i, part in enumerate(through):
            own[:, i] = part.take(order, axis=0, out=rest, mode="clip")
        _add_rows(own.reshape(-1, 3 * k), rows.take(order), grad["x"])
        norm = np.sqrt(sum(float(np.vdot(g, g)) for g in grad.values()))
        if norm > 1:
            for g in grad.values():
                g /= norm
        return h, grad

    def _by_state(self, h, target, use, grad, held) -> np.ndarray:
        """Gradients of the mean log loss by the states, and in ``grad`` by the softmax."""
        p = self.p
        order, own, parts = _by_class(self.classes_of(target))
        goal, dh = target.take(order), held.get("dh", h.shape, h.dtype)
        seen = h.take(order, axis=0, out=held.get("seen", h.shape, h.dtype), mode="clip")
        on = use.take(order).astype(h.dtype) / max(1, int(use.sum()))
        up = np.ascontiguousarray(p["c"].T)
        grad["c"][:], grad["cb"][:] = 0, 0
        calm = _is_calm(seen, p["c"], p["cb"])
        room, ones = held.get("classes", (min(_ROWS, len(own)), len(up)), h.dtype), np.ones(_ROWS, h.dtype)
        for a in range(0, len(own), _ROWS):
            part = slice(a, a + _ROWS)
            d = np.matmul(seen[part], p["c"], out=room[:len(own) - a])
            d += p["cb"]
            _loss_slope(d, own[part], on[part], calm)
            grad["c"] += (d.T @ seen[part]).T
            grad["cb"] += ones[:len(d)] @ d
            np.matmul(d, up, out=dh[part])
        grad["w"][:], grad["wb"][:] = 0, 0
        d, parts = self._inner(seen, parts, held)
        _loss_slope(d, goal[:len(d)] % self.width, on[:len(d)], _is_calm(seen, p["w"], p["wb"]))
        down = held.get("down", (len(d), self.hidden), h.dtype)
        for c, part in parts:
            np.matmul(seen[part].T, d[part], out=grad["w"][c])
            np.add.reduce(d[part], axis=0, out=grad["wb"][c])
            np.matmul(d[part], p["w"][c].T, out=down[part])
        dh[:len(d)] += down
        out = seen                    # its rows are not needed any more
        out[order] = dh
        return out


def _add_rows(values: np.ndarray, rows: np.ndarray, out: np.ndarray) -> None:
    """``out`` becomes the sum of the values of each row; ``rows`` ascend.  Rows met often
    are summed one by one, the others' first, second, ... values each at once."""
    out[:] = 0
    cuts = np.append(0, np.flatnonzero(np.diff(rows)) + 1)
    sizes = np.diff(np.append(cuts, len(rows)))
    for a, n in zip(cuts[sizes > _OFTEN].tolist(), sizes[sizes > _OFTEN].tolist()):
        np.add.reduce(values[a:a + n], axis=0, out=out[rows[a]])
    cuts, sizes = cuts[sizes <= _OFTEN], sizes[sizes <= _OFTEN]
    for i in range(int(sizes.max(initial=0))):
        at = cuts[sizes > i] + i
        out[rows[at]] += values[at]


def _order(keys: np.ndarray) -> np.ndarray:
    """Places of small whole numbers in stable order; those of 16 bits are sorted by radix."""
    return np.argsort(keys.astype(np.uint16) if keys.max(initial=0) < 1 << 16 else keys, kind="stable")


def _by_class(own: np.ndarray):
    """Places in order of class; the classes in that order; (class, slice) of each there."""
    at = _order(own)
    mine = own.take(at)
    cuts = [0, *(np.flatnonzero(np.diff(mine)) + 1).tolist(), len(at)]
    return at, mine, [(int(mine[a]), slice(a, z)) for a, z in zip(cuts, cuts[1:]) if a < z]


class Lanes:
    """Texts dealt to lanes, each to the lane that is shortest then; ``window`` gives
    targets, inputs and text numbers as (steps, lanes) arrays, longest lane first.
    The text number of unused places is the number of texts.  Only a window is ever laid
    out, so one very long text takes no room in the other lanes."""

    def __init__(self, texts: list[np.ndarray], lanes: int, start: int, longest_first: bool = True):
        heap = [(0, lane) for lane in range(lanes)]
        held: list[list[int]] = [[] for _ in range(lanes)]
        for i in sorted(range(len(texts)), key=lambda i: -len(texts[i]) if longest_first else i):
            size, lane = heapq.heappop(heap)
            held[lane].append(i)
            heapq.heappush(heap, (size + len(texts[i]), lane))
        order = sorted(heap, key=lambda x: -x[0])
        dealt = [i for _, lane in order for i in held[lane]]
        lengths = np.array([len(texts[i]) for i in dealt], np.int64)
        self.sizes = np.array([size for size, _ in order])
        self.begin = np.cumsum(self.sizes) - self.sizes
        # lane after lane; the last place stands for those after a lane's end
        self.target = np.concatenate([*(texts[i] for i in dealt), [0]]).astype(np.int32)
        self.text = np.repeat(np.array([*dealt, len(texts)], np.int32), np.append(lengths, 1))
        self.source = np.append(np.int32(start), self.target[:-1])
        self.source[np.cumsum(lengths) - lengths] = start
        self.source[-1] = start
        self.steps = int(self.sizes[0])

    def windows(self, steps: int, longer: int) -> Iterator[tuple[int, int]]:
        """Bounds of windows of ``steps``, or of up to ``longer`` times as many where
        fewer lanes go on, so that windows hold about as many symbols."""
        at = 0
        while at < self.steps:
            live = int((self.sizes > at).sum())
            end = min(at + steps * min(longer, len(self.sizes) // live), self.steps)
            yield at, end
            at = end

    def window(self, at: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Steps at .. end of the lanes that are not over at its first."""
        n = int((self.sizes > at).sum())
        step = np.arange(at, end)[:, None]
        place = np.where(step < self.sizes[:n], self.begin[:n] + step, len(self.target) - 1)
        return self.target[place], self.source[place], self.text[place]
