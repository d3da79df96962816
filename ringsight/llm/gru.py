"""A gated recurrent language model in numpy: class-factored softmax, truncated backpropagation, state kept across windows.

Symbols are the frequent words, each a member of a class, and bands of rare words, each a class of its own. P(symbol | state) is
P(class | state) P(symbol | class, state), so a step costs about the square root of the vocabulary. Output biases start at the
log frequencies, so an untrained model is the unigram model of the symbols.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np

HIDDEN, WINDOW, LANES = 16, 32, 128
BLOCK = 4096  # steps laid out at once
CHUNK = 2048  # outputs worked on at once, few enough to stay in a core's cache
RATE, WARM, CLIP = 0.006, 150, 5.0


class Gru:
    """Parameters in one flat vector, so that models can be averaged."""

    def __init__(self, counts: np.ndarray, class_of: np.ndarray, hidden: int = HIDDEN, flat: np.ndarray | None = None) -> None:
        """counts: of each symbol; class_of: ascending class numbers of the symbols."""
        self.hidden, self.symbols, self.classes = hidden, len(counts), int(class_of[-1]) + 1
        self.class_of = class_of
        self.first = np.searchsorted(class_of, np.arange(self.classes + 1))
        shapes = {
            "E": (self.symbols + 1, 3 * hidden),  # the last row starts a document
            "U": (hidden, 3 * hidden),
            "Wc": (self.classes, hidden),
            "bc": (self.classes,),
            "Ww": (self.symbols, hidden),
            "bw": (self.symbols,),
        }
        sizes = [int(np.prod(s)) for s in shapes.values()]
        ends = np.cumsum([0, *sizes])
        if flat is None:
            random = np.random.Generator(np.random.PCG64(1))
            flat = random.normal(0, 0.1, ends[-1]).astype(np.float32)
        self.flat = flat
        self.parts = {k: slice(a, b) for k, a, b in zip(shapes, ends[:-1], ends[1:], strict=True)}
        self.shapes = shapes
        self.view(flat, self)
        self.counts = counts
        self.rooms: dict[str, np.ndarray] = {}

    def start_at_frequencies(self) -> None:
        share = (self.counts + 0.5) / (self.counts.sum() + 0.5 * len(self.counts))
        mass = np.add.reduceat(share, self.first[:-1])
        self.bc[:] = np.log(mass)
        self.bw[:] = np.log(share / mass[self.class_of])
        self.Wc[:] = 0
        self.Ww[:] = 0

    def view(self, flat: np.ndarray, onto: object) -> None:
        for k, place in self.parts.items():
            setattr(onto, k, flat[place].reshape(self.shapes[k]))

    def _room(self, name: str, *shape: int) -> np.ndarray:
        """An array to fill, the same memory at every call: fresh pages for every window cost more than the sums in them."""
        size = int(np.prod(shape))
        if name not in self.rooms or self.rooms[name].size < size:
            self.rooms[name] = np.empty(size, np.float32)
        return self.rooms[name][:size].reshape(shape)

    @staticmethod
    def _order(values: np.ndarray, size: int) -> np.ndarray:
        """The stable order of numbers below `size`; short integers are sorted by digits, which is much faster."""
        return np.argsort(values.astype(np.int16) if size < 1 << 15 else values, kind="stable")

    def _forward(self, x: np.ndarray, h: np.ndarray, fresh: np.ndarray, tape: dict[str, np.ndarray] | None) -> np.ndarray:
        """States before each output (T, H, n) from the state before (n, H). Lanes come last: what a step works on is then contiguous."""
        n, (length, lanes) = self.hidden, x.shape
        gates, rows = self._room("gates", length, 3 * n, lanes), self._room("rows", length, lanes, 3 * n)
        self.E.astype(np.float32, copy=False).take(x, axis=0, out=rows, mode="clip")  # without buffering; x is in range
        gates[:] = rows.transpose(0, 2, 1)
        turn = np.ascontiguousarray(self.U.T, np.float32)
        states, starts = self._room("states", length, n, lanes), fresh.any(axis=1)
        h = np.ascontiguousarray(h.T, np.float32)
        inner, work = np.empty((3 * n, lanes), np.float32), np.empty((n, lanes), np.float32)
        for t in range(length):
            if starts[t]:
                h = np.where(fresh[t], np.float32(0), h)
            np.matmul(turn, h, out=inner)
            gate = gates[t]
            zr, c = gate[: 2 * n], gate[2 * n :]
            zr += inner[: 2 * n]
            np.negative(zr, out=zr)
            np.exp(zr, out=zr)
            zr += 1
            np.reciprocal(zr, out=zr)
            np.multiply(zr[n:], inner[2 * n :], out=work)
            c += work
            np.tanh(c, out=c)
            if tape is not None:
                tape["before"][t], tape["inner"][t] = h, inner[2 * n :]
            new = states[t]
            np.subtract(h, c, out=new)
            new *= zr[:n]
            new += c
            h = new
        if tape is not None:
            tape["gates"] = gates  # now z, r and the candidates
        return states

    def steps(self, x: np.ndarray, h: np.ndarray, fresh: np.ndarray, keep: bool) -> tuple[np.ndarray, dict, np.ndarray]:
        """States before each output (T, n, H) from inputs (T, n); fresh marks inputs that start a document. The next call overwrites them."""
        size = (len(x), self.hidden, x.shape[1])
        tape = {k: self._room(k, *size) for k in ("before", "inner")} if keep else None
        states = self._forward(x, h, fresh, tape)
        return states.transpose(0, 2, 1), tape or {}, states[-1].T.copy()

    def output(self, states: np.ndarray, targets: np.ndarray, gradient: object | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural log probabilities of the targets, and the slope of minus their sum by the states."""
        cls = self.class_of[targets]
        order = self._order(cls, self.classes)
        cls, targets = cls[order], targets[order]
        columns, at = np.ascontiguousarray(states.take(order, axis=0).T), np.arange(len(order))
        sums = np.empty(len(order), columns.dtype)
        slope = None if gradient is None else np.empty_like(columns)
        for low in range(0, len(order), CHUNK):
            part = slice(low, low + CHUNK)
            inside, mine = columns[:, part], (cls[part], at[: len(cls[part])])
            p = self.Wc @ inside
            p += self.bc[:, None]
            p -= p.max(axis=0)
            found = p[mine]
            np.exp(p, out=p)
            total = p.sum(axis=0)
            sums[part] = found - np.log(total)
            if gradient is not None:
                p /= total
                p[mine] -= 1
                gradient.Wc += p @ inside.T
                gradient.bc += p.sum(axis=1)
                slope[:, part] = self.Wc.T @ p
        cuts = np.searchsorted(cls, np.arange(self.classes + 1))
        for k in np.flatnonzero((np.diff(cuts) > 0) & (np.diff(self.first) > 1)):
            own, a, b = slice(cuts[k], cuts[k + 1]), self.first[k], self.first[k + 1]
            inside, mine = columns[:, own], (targets[own] - a, at[: cuts[k + 1] - cuts[k]])
            q = self.Ww[a:b] @ inside
            q += self.bw[a:b, None]
            q -= q.max(axis=0)
            sums[own] += q[mine]
            np.exp(q, out=q)
            total = q.sum(axis=0)
            sums[own] -= np.log(total)
            if gradient is not None:
                q /= total
                q[mine] -= 1
                gradient.Ww[a:b] += q @ inside.T
                gradient.bw[a:b] += q.sum(axis=1)
                slope[:, own] += self.Ww[a:b].T @ q
        found = np.empty_like(sums)
        found[order] = sums
        if slope is not None:
            back = np.empty((len(order), self.hidden), slope.dtype)
            back[order] = slope.T
            slope = back
        return found, slope

    def learn(self, x: np.ndarray, y: np.ndarray, h: np.ndarray, fresh: np.ndarray, used: np.ndarray, adam: Adam) -> np.ndarray:
        """One window of truncated backpropagation; returns the state to carry on with."""
        states, tape, after = self.steps(x, h, fresh, keep=True)
        total = np.zeros_like(self.flat)
        grad = type("Gradient", (), {})()
        self.view(total, grad)
        n, slopes = self.hidden, np.zeros((x.size, self.hidden), np.float32)
        given = np.flatnonzero(used)
        _, slope = self.output(states.reshape(-1, n).take(given, axis=0), y.ravel()[given], grad)
        slopes[given] = slope
        slopes = np.ascontiguousarray(slopes.reshape(*x.shape, n).transpose(0, 2, 1))
        z, r, c = (tape["gates"][:, k * n : (k + 1) * n] for k in range(3))
        # what a step's slope is multiplied with, for all steps at once
        by_z, by_c, by_r, work = (self._room(f"by {k}", *z.shape) for k in ("z", "c", "r", "work"))
        np.subtract(1, z, out=work)
        np.subtract(tape["before"], c, out=by_z)
        by_z *= z
        by_z *= work
        np.multiply(c, c, out=by_c)
        np.subtract(1, by_c, out=by_c)
        by_c *= work
        np.subtract(1, r, out=work)
        np.multiply(tape["inner"], r, out=by_r)
        by_r *= work
        dgates, dinner = (self._room(k, len(x), 3 * n, x.shape[1]) for k in ("dgates", "dinner"))
        turn, dh, starts = self.U.astype(np.float32, copy=False), np.zeros((n, x.shape[1]), np.float32), fresh.any(axis=1)
        for t in range(len(x) - 1, -1, -1):
            d, out, into = slopes[t], dgates[t], dinner[t]
            d += dh
            np.multiply(d, by_z[t], out=out[:n])
            np.multiply(d, by_c[t], out=out[2 * n :])
            np.multiply(out[2 * n :], by_r[t], out=out[n : 2 * n])
            into[: 2 * n] = out[: 2 * n]
            np.multiply(out[2 * n :], r[t], out=into[2 * n :])
            np.matmul(turn, into, out=dh)
            d *= z[t]
            dh += d
            if starts[t]:
                dh[:, fresh[t]] = 0
        grad.U += np.matmul(tape["before"], dinner.transpose(0, 2, 1)).sum(axis=0)
        order = self._order(x.ravel(), self.symbols + 1)
        inputs, at = np.unique(x.ravel()[order], return_index=True)
        rows, by_input = self._room("rows", *x.shape, 3 * n), self._room("by input", x.size, 3 * n)
        rows[:] = dgates.transpose(0, 2, 1)
        rows.reshape(-1, 3 * n).take(order, axis=0, out=by_input, mode="clip")
        grad.E[inputs] = np.add.reduceat(by_input, at, axis=0)
        adam.step(self.flat, total / max(1, int(used.sum())), min(1, 2 * int(used.sum()) / (LANES * WINDOW)))
        return after


class Adam:
    def __init__(self, size: int) -> None:
        self.m, self.v, self.t = np.zeros(size, np.float32), np.zeros(size, np.float32), 0

    def step(self, flat: np.ndarray, slope: np.ndarray, share: float = 1.0) -> None:
        """share: below 1 for windows with few tokens, which tell less."""
        norm = float(np.sqrt(slope @ slope))
        if norm > CLIP:
            slope = slope * np.float32(CLIP / norm)
        self.t += 1
        self.m += 0.1 * (slope - self.m)
        self.v += 0.01 * (slope * slope - self.v)
        size = share * RATE * min(1, self.t / WARM) * np.sqrt(1 - 0.99**self.t) / (1 - 0.9**self.t)
        flat -= (size * self.m / (np.sqrt(self.v) + 1e-5)).astype(np.float32)


def train(model: Gru, texts: Iterable[np.ndarray], pool: int = 1 << 19) -> int:
    """One pass over symbol arrays; documents follow each other in lanes, and the state is carried from window to window to their ends."""
    adam, seen = Adam(len(model.flat)), 0
    lanes: list[deque[np.ndarray]] = [deque() for _ in range(LANES)]
    at = [0] * LANES  # the next place in the first document of each lane
    sizes = np.zeros(LANES, np.int64)
    h = np.zeros((LANES, model.hidden), np.float32)
    for group in chain(_pools(texts, pool), [None]):
        for text in sorted(group or [], key=len, reverse=True):
            k = int(sizes.argmin())
            lanes[k].append(text)
            sizes[k] += len(text)
        # what is left in the lanes goes on with the next pool; after the last one the lanes run to their ends
        ready = int(sizes.max()) if group is None else int(sizes.min()) // WINDOW * WINDOW
        while ready > 0:
            steps = -(-min(ready, BLOCK) // WINDOW) * WINDOW
            ready -= steps
            y = np.zeros((steps, LANES), np.int64)
            x = np.full((steps, LANES), model.symbols, np.int64)
            used = np.zeros((steps, LANES), bool)
            for k, lane in enumerate(lanes):
                to = 0
                while lane and to < steps:
                    text, low = lane[0], at[k]
                    n = min(len(text) - low, steps - to)
                    y[to : to + n, k], used[to : to + n, k] = text[low : low + n], True
                    if low:  # under way: it goes on after its last symbol
                        x[to, k] = text[low - 1]
                    x[to + 1 : to + n, k] = text[low : low + n - 1]
                    at[k], to = low + n, to + n
                    if at[k] == len(text):
                        lane.popleft()
                        at[k] = 0
                sizes[k] -= to
            for t in range(0, steps, WINDOW):
                w = slice(t, t + WINDOW)
                live = used[t]  # a lane that has ended stays ended
                if live.any():
                    fresh = x[w][:, live] == model.symbols
                    h[live] = model.learn(x[w][:, live], y[w][:, live], h[live], fresh, used[w][:, live], adam)
                    seen += int(used[w].sum())
    return seen


def _pools(texts: Iterable[np.ndarray], pool: int) -> Iterator[list[np.ndarray]]:
    """Groups of whole documents of about `pool` symbols."""
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text)
        if size >= pool:
            yield group
            group, size = [], 0
    if group:
        yield group


def score(model: Gru, texts: list[np.ndarray], lanes: int = 512, window: int = 64) -> np.ndarray:
    """Natural log-likelihood of each complete text; the state is carried from window to window to its end."""
    out = np.zeros(len(texts))
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    for low in range(0, len(order), lanes):
        own = order[low : low + lanes]
        sizes = np.array([len(texts[i]) for i in own])
        h = np.zeros((len(own), model.hidden), np.float32)
        for t in range(0, int(sizes[0]) if len(sizes) else 0, window):
            live = int((sizes > t).sum())
            steps = min(window, int(sizes[0]) - t)
            y = np.zeros((steps, live), np.int64)
            x = np.full((steps, live), model.symbols, np.int64)
            used = np.zeros((steps, live), bool)
            for k in range(live):
                part = texts[own[k]][t : t + steps]
                y[: len(part), k], used[: len(part), k] = part, True
                if t:
                    x[0, k] = texts[own[k]][t - 1]
                x[1 : len(part), k] = part[:-1]
            fresh = np.zeros(x.shape, bool)
            states, _, h = model.steps(x, h[:live], fresh, keep=False)
            found, _ = model.output(states[used], y[used])
            lane = np.broadcast_to(np.arange(live), used.shape)[used]
            out[own[:live]] += np.bincount(lane, found, live)
    return out
