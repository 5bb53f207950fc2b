"""A small gated recurrent language model in numpy.

Input rows go straight into the gates, the output softmax is factored into
classes (class first, then the word within it), training is truncated
backpropagation over windows of ``STEPS`` tokens.  Texts lie one after the other
in lanes that advance together; the state is carried from window to window
and reset where a text begins, so a text of any length is read whole.
"""

from __future__ import annotations

import numpy as np

HIDDEN, STEPS = 16, 16
#: an update waits for gradients of this share of a full window, so the last, longest lanes cost few updates
ENOUGH = 0.5

Params = dict[str, np.ndarray]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Layout:
    """Which class and which place in it each symbol has; symbol 0 is a class of its own."""

    def __init__(self, counts: np.ndarray):
        n = len(counts)
        self.width = max(1, int(np.ceil(np.sqrt(max(1, n - 1)))))
        by_count = np.argsort(-counts[1:], kind="stable") + 1
        self.cls, self.place = np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.cls[by_count] = 1 + np.arange(n - 1) // self.width
        self.place[by_count] = np.arange(n - 1) % self.width
        self.classes = 1 + int(self.cls.max()) if n > 1 else 1

    def start(self, counts: np.ndarray, hidden: int = HIDDEN, seed: int = 1) -> Params:
        """Parameters to begin with: outputs biased to the counts, so it starts as a unigram model."""
        rng = np.random.default_rng(seed)
        share = (counts + 1.0) / (counts + 1.0).sum()
        total = np.bincount(self.cls, share, self.classes)
        word = np.full((self.classes, self.width), -30.0)
        word[self.cls, self.place] = np.log(share / total[self.cls])
        word[0, 0] = 0.0
        normal = lambda scale, *shape: rng.normal(0, scale, shape).astype(np.float32)
        return {"x": normal(0.1, len(counts), 3 * hidden), "u": normal(0.2, hidden, 3 * hidden),
                "wc": normal(0.05, hidden, self.classes), "bc": np.log(total).astype(np.float32),
                "ww": normal(0.05, self.classes, hidden, self.width), "bw": word.astype(np.float32)}


def lanes(lengths: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of about ``n`` lanes of whole texts laid end to end, longest first."""
    ends = np.cumsum(lengths)
    target = max(1, -(-int(ends[-1]) // n))
    lane = (ends - lengths) // target
    first = np.flatnonzero(np.concatenate(([True], lane[1:] != lane[:-1])))
    start = (ends - lengths)[first]
    size = np.diff(np.concatenate((start, ends[-1:])))
    order = np.argsort(-size, kind="stable")
    return start[order], size[order]


def flat_inputs(symbols: np.ndarray, lengths: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """What the model sees before each token (the end sign before a text's first), and where texts begin."""
    begin = np.zeros(len(symbols), bool)
    begin[np.cumsum(lengths) - lengths] = True
    seen = np.empty_like(symbols)
    seen[1:] = symbols[:-1]
    seen[begin] = end
    return seen, begin


def _forward(p: Params, h: np.ndarray, seen: np.ndarray, begin: np.ndarray, keep: bool) -> tuple[np.ndarray, np.ndarray, list]:
    """States after each of the window's steps (steps x lanes x hidden), the last one, and what backprop needs."""
    k = p["u"].shape[0]
    steps = seen.shape[1]
    out, saved = np.empty((steps, len(h), k), np.float32), []
    for t in range(steps):
        h = np.where(begin[:, t, None], np.float32(0), h)
        g = p["x"][seen[:, t]]
        hu = h @ p["u"]
        zr = _sigmoid(g[:, :2 * k] + hu[:, :2 * k])
        z, r, a = zr[:, :k], zr[:, k:], hu[:, 2 * k:]
        n = np.tanh(g[:, 2 * k:] + r * a)
        new = n + z * (h - n)
        if keep:
            saved.append((h, z, r, a, n))
        h = out[t] = new
    return out, h, saved


def _outputs(p: Params, layout: Layout, o: np.ndarray, target: np.ndarray, grads: Params | None,
             weight: np.ndarray | None) -> tuple[np.ndarray, np.ndarray | None]:
    """Natural-log probability of each target; with ``grads``, also the gradient by the states."""
    cls = layout.cls[target]
    z = o @ p["wc"] + p["bc"]
    z -= z.max(axis=1, keepdims=True)
    e = np.exp(z)
    s = e.sum(axis=1)
    rows = np.arange(len(o))
    logp = z[rows, cls] - np.log(s)
    back = None
    if grads is not None:
        d = e / s[:, None]
        d[rows, cls] -= 1
        d *= weight[:, None]
        grads["wc"] += o.T @ d
        grads["bc"] += d.sum(axis=0)
        back = d @ p["wc"].T
    order = np.argsort(cls, kind="stable")
    edges = np.searchsorted(cls[order], np.arange(layout.classes + 1))
    for c in range(1, layout.classes):
        i = order[edges[c]:edges[c + 1]]
        if not len(i):
            continue
        oc, at = o[i], layout.place[target[i]]
        z = oc @ p["ww"][c] + p["bw"][c]
        z -= z.max(axis=1, keepdims=True)
        e = np.exp(z)
        s = e.sum(axis=1)
        rows = np.arange(len(i))
        logp[i] += z[rows, at] - np.log(s)
        if grads is not None:
            d = e / s[:, None]
            d[rows, at] -= 1
            d *= weight[i, None]
            grads["ww"][c] += oc.T @ d
            grads["bw"][c] += d.sum(axis=0)
            back[i] += d @ p["ww"][c].T
    return logp, back


def _windows(start: np.ndarray, size: np.ndarray, steps: int):
    """Windows of all lanes still running: places of the tokens (lanes x steps), and which of them exist."""
    for t in range(0, int(size[0]), steps):
        live = int(np.searchsorted(-size, -t, "left"))  # lanes are sorted, longest first
        place = np.arange(t, t + steps)
        there = place[None, :] < size[:live, None]
        yield live, start[:live, None] + np.minimum(place[None, :], size[:live, None] - 1), there


def score(p: Params, layout: Layout, symbols: np.ndarray, lengths: np.ndarray, end: int, n_lanes: int = 1024) -> np.ndarray:
    """Log10 probability of each text under the model (a symbol each, whole texts)."""
    seen, begin = flat_inputs(symbols, lengths, end)
    start, size = lanes(lengths, n_lanes)
    logp = np.empty(len(symbols))
    h = np.zeros((len(start), p["u"].shape[0]), np.float32)
    for live, at, there in _windows(start, size, 2 * STEPS):
        out, h, _ = _forward(p, h[:live], seen[at], begin[at], keep=False)
        there = there.T
        at = at.T[there]
        logp[at] = _outputs(p, layout, out[there], symbols[at], None, None)[0]
    text = np.repeat(np.arange(len(lengths)), lengths)
    return np.bincount(text, logp, len(lengths)) / np.log(10)


class Trainer:
    """Adam over truncated-backpropagation windows."""

    def __init__(self, params: Params, layout: Layout, rate: float):
        self.p = {k: v.copy() for k, v in params.items()}
        self.layout, self.rate, self.t = layout, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}
        self.grads, self.gathered = {k: np.zeros_like(v) for k, v in params.items()}, 0.0

    def texts(self, symbols: np.ndarray, lengths: np.ndarray, end: int, n_lanes: int = 128) -> None:
        seen, begin = flat_inputs(symbols, lengths, end)
        start, size = lanes(lengths, n_lanes)
        h = np.zeros((len(start), self.p["u"].shape[0]), np.float32)
        for live, at, there in _windows(start, size, STEPS):
            h = self._window(h[:live], seen[at], begin[at], symbols[at], there / (len(start) * STEPS))
            if self.gathered >= ENOUGH:
                self._step()
        if self.gathered:
            self._step()

    def _window(self, h: np.ndarray, seen: np.ndarray, begin: np.ndarray, target: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Adds to the gradients; ``weight`` is the same for all tokens of a call, so the last, longest lanes do not outweigh the rest."""
        p, k = self.p, self.p["u"].shape[0]
        out, last, saved = _forward(p, h, seen, begin, keep=True)
        grads = self.grads
        self.gathered += float(weight.sum())
        weight = weight.T.reshape(-1).astype(np.float32)
        _, back = _outputs(p, self.layout, out.reshape(-1, k), target.T.reshape(-1), grads, weight)
        back = back.reshape(out.shape)
        dh = np.zeros_like(last)
        by_step = []
        for t in range(len(saved) - 1, -1, -1):
            prev, z, r, a, n = saved[t]
            dh = dh + back[t]
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (prev - n) * z * (1 - z)
            dr = dn * a * r * (1 - r)
            g = np.concatenate((dz, dr, dn * r), axis=1)
            grads["u"] += prev.T @ g
            dh = (dh * z + g @ p["u"].T) * ~begin[:, t, None]
            by_step.append(np.concatenate((dz, dr, dn), axis=1))
        rows = np.concatenate(by_step[::-1])
        ids = seen.T.reshape(-1)
        order = np.argsort(ids, kind="stable")
        first = np.flatnonzero(np.concatenate(([True], np.diff(ids[order]) != 0)))
        grads["x"][ids[order][first]] += np.add.reduceat(rows[order], first, axis=0)
        return last

    def _step(self) -> None:
        grads = self.grads
        self.t += 1
        norm = float(np.sqrt(sum(float((g * g).sum()) for g in grads.values())))
        scale = min(1.0, 1.0 / (norm + 1e-9))
        a = np.float32(self.rate * np.sqrt(1 - 0.999 ** self.t) / (1 - 0.9 ** self.t))
        for name, g in grads.items():
            g *= np.float32(scale)
            m, v = self.m[name], self.v[name]
            m += np.float32(0.1) * (g - m)
            v += np.float32(0.001) * (g * g - v)
            self.p[name] -= a * m / (np.sqrt(v) + np.float32(1e-8))
            g[...] = 0
        self.gathered = 0.0
