"""A small text convolution network in numpy: several filter widths, max pooling over time, softmax.

Sequences lie behind one another in one array of embedding rows, each followed by ``gap`` zero rows, so that no filter reads
from one sequence into the next. Pooling takes the maximum of each filter over all places of a sequence, so only those places get
a gradient.
"""

from __future__ import annotations

import numpy as np


class ConvNet:
    def __init__(self, dim: int, widths: tuple[int, ...], filters: int, classes: int, seed: int):
        rng = np.random.default_rng(seed)
        self.dim, self.widths, self.filters = dim, widths, filters
        self.gap = max(widths) - 1
        normal = lambda *shape, scale: (rng.normal(size=shape) * scale).astype(np.float32)
        self.params = {f"w{w}": normal(w, dim, filters, scale=(1 / (w * dim)) ** 0.5) for w in widths}
        self.params |= {f"b{w}": np.zeros(filters, np.float32) for w in widths}
        self.params |= {"out": normal(filters * len(widths), classes, scale=(1 / (filters * len(widths))) ** 0.5),
                        "bias": np.zeros(classes, np.float32)}
        self._m = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.params.items()}
        self._t = 0

    def rested(self) -> None:
        """Forget how the parameters moved."""
        self._m, self._t = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.params.items()}, 0

    def responses(self, x: np.ndarray, width: int) -> np.ndarray:
        """Response of the filters of one width at every row."""
        w, n = self.params[f"w{width}"], len(x)
        y = x @ w[0]
        for k in range(1, width):
            y[:n - k] += (x[k:] @ w[k])
        return y

    def pooled(self, x: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Maximum of every filter within each sequence (before bias and ReLU); sequences are non-empty."""
        cuts = np.stack([begin, end], 1).ravel()
        if cuts[-1] >= len(x):
            cuts = cuts[:-1]
        even = len(begin) > 1 and len(set(np.diff(begin).tolist()) | {int(end[0] - begin[0]) + self.gap}) == 1 and bool((end - begin == end[0] - begin[0]).all())
        parts = []
        for w in self.widths:
            y = self.responses(x, w)
            if even and len(y) == len(begin) * (end[0] - begin[0] + self.gap):
                parts.append(y.reshape(len(begin), -1, y.shape[1])[:, :end[0] - begin[0]].max(axis=1))
            else:
                parts.append(np.maximum.reduceat(y, cuts, axis=0)[::2])
        return np.concatenate(parts, 1)

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        bias = np.concatenate([self.params[f"b{w}"] for w in self.widths])
        return np.maximum(pooled + bias, 0) @ self.params["out"] + self.params["bias"]

    def step(self, x: np.ndarray, begin: np.ndarray, end: np.ndarray, target: np.ndarray, weight: np.ndarray, rate: float) -> tuple[np.ndarray, np.ndarray, float]:
        """One training step; returns rows of ``x`` with a gradient, that gradient, and the loss."""
        where, tops = self.located(x, begin, end)
        places = [[np.minimum(at + begin[:, None] + k, len(x) - 1) for k in range(w)] for w, at in zip(self.widths, where)]
        grads, loss = self.update(tops, [[x[p] for p in each] for each in places], target, weight, rate)
        return (np.concatenate([p.ravel() for each in places for p in each]),
                np.concatenate([g.reshape(-1, self.dim) for each in grads for g in each]), loss)

    def located(self, x: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Per width: the first place, counted from the sequence's begin, of every filter's maximum, and that maximum."""
        where, tops = [], []
        for w in self.widths:
            y = self.responses(x, w)
            at = np.stack([y[a:b].argmax(axis=0) for a, b in zip(begin.tolist(), end.tolist())])
            where.append(at), tops.append(np.take_along_axis(y, at + begin[:, None], axis=0))
        return where, tops

    def update(self, tops: list[np.ndarray], inside: list[list[np.ndarray]], target: np.ndarray, weight: np.ndarray,
               rate: float) -> tuple[list[list[np.ndarray]], float]:
        """Moves the parameters; ``tops`` and ``inside`` have, per width, the maxima and the rows below the filter there (one array for
        each of its places). Returns gradients of these rows, and the loss."""
        pooled = np.concatenate(tops, 1)
        bias = np.concatenate([self.params[f"b{w}"] for w in self.widths])
        hidden = np.maximum(pooled + bias, 0)
        p = softmax(hidden @ self.params["out"] + self.params["bias"])
        loss = float(-(np.log(p[np.arange(len(p)), target] + 1e-9) * weight).mean())
        d = p.copy()
        d[np.arange(len(d)), target] -= 1
        d *= (weight / len(d))[:, None]
        d = d.astype(np.float32)
        grads = {"out": hidden.T @ d, "bias": d.sum(0)}
        dh = (d @ self.params["out"].T) * (hidden > 0)
        back = []
        for j, w in enumerate(self.widths):
            dp = dh[:, j * self.filters:(j + 1) * self.filters]
            grads[f"b{w}"] = dp.sum(0)
            grads[f"w{w}"] = np.stack([np.einsum("bfd,bf->df", inside[j][k], dp) for k in range(w)]).astype(self.params[f"w{w}"].dtype)
            back.append([dp[:, :, None] * self.params[f"w{w}"][k].T[None] for k in range(w)])
        self._t += 1
        for k, g in grads.items():
            adam(self.params[k], g, *self._m[k], self._t, rate)
        return back, loss


def adam(p: np.ndarray, g: np.ndarray, m: np.ndarray, v: np.ndarray, t: int, rate: float) -> None:
    """One step of Adam in place."""
    m += 0.1 * (g - m)
    v += 0.01 * (g * g - v)
    p -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)


class Embedding:
    """Rows of a table learned by Adam on those that occur; row 0 stays zero."""

    def __init__(self, rows: int, dim: int, seed: int, scale: float = 0.1):
        self.begin((np.random.default_rng(seed).normal(size=(rows, dim)) * scale).astype(np.float32))
        self.table[0] = 0

    def begin(self, table: np.ndarray) -> None:
        """Go on from a copy of ``table``, as if nothing had been learned."""
        self.table = table.copy()
        self._m, self._v, self._t = np.zeros_like(table), np.zeros_like(table), 0

    def learn(self, rows: np.ndarray, grads: np.ndarray, rate: float) -> None:
        used, back = np.unique(rows, return_inverse=True)
        total = np.zeros((len(used), self.table.shape[1]), np.float32)
        np.add.at(total, back, grads)
        self._t += 1
        m, v, p = self._m[used], self._v[used], self.table[used]
        adam(p, total, m, v, self._t, rate)
        self._m[used], self._v[used], self.table[used] = m, v, p
        self.table[0] = 0


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def laid_out(lengths: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Begin and end of every sequence in the common array, and its length."""
    end = np.cumsum(lengths + gap) - gap
    return end - lengths, end, int(end[-1] + gap) if len(end) else 0
