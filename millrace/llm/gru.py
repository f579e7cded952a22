"""A bidirectional gated recurrent network with attention pooling, in numpy."""

from __future__ import annotations

import numpy as np

NAMES = ("wf", "uf", "bf", "wb", "ub", "bb", "a", "o", "b")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class BiGru:
    """Logits of windows of input vectors; a window's padding is masked out."""

    def __init__(self, inputs: int, hidden: int = 8, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.hidden = hidden
        self.p = {
            "wf": draw(inputs, 3 * hidden), "uf": draw(hidden, 3 * hidden), "bf": np.zeros(3 * hidden, np.float32),
            "wb": draw(inputs, 3 * hidden), "ub": draw(hidden, 3 * hidden), "bb": np.zeros(3 * hidden, np.float32),
            "a": draw(2 * hidden), "o": draw(2 * hidden), "b": np.zeros(1, np.float32),
        }

    def _cell(self, x: np.ndarray, h: np.ndarray, u: np.ndarray, keep: np.ndarray | None):
        n = self.hidden
        hu = h @ u
        gates = _sigmoid(x[:, : 2 * n] + hu[:, : 2 * n])
        z, r = gates[:, :n], gates[:, n:]
        new = np.tanh(x[:, 2 * n :] + r * hu[:, 2 * n :])
        after = new + z * (h - new)
        if keep is not None:
            after = np.where(keep, after, h)
        return after, (h, z, r, new, hu[:, 2 * n :])

    def logits(self, xf: np.ndarray, xb: np.ndarray, places: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Logit of each window. ``xf`` and ``xb``: projected inputs of all words; ``places``: (windows, steps)."""
        windows, steps = places.shape
        h = np.zeros((steps, windows, 2 * self.hidden), np.float32)
        state = np.zeros((windows, self.hidden), np.float32)
        whole = bool((lengths == steps).all())
        for t in range(steps):
            state, _ = self._cell(xf[places[:, t]], state, self.p["uf"], None if whole else (t < lengths)[:, None])
            h[t, :, : self.hidden] = state
        state = np.zeros((windows, self.hidden), np.float32)
        for t in reversed(range(steps)):
            state, _ = self._cell(xb[places[:, t]], state, self.p["ub"], None if whole else (t < lengths)[:, None])
            h[t, :, self.hidden :] = state
        return self._pool(h, lengths)[0]

    def _pool(self, h: np.ndarray, lengths: np.ndarray):
        inside = np.arange(len(h))[:, None] < lengths
        e = np.where(inside, h @ self.p["a"], np.float32(-1e9))
        weight = np.where(inside, np.exp(e - e.max(0)), np.float32(0))
        weight /= np.maximum(weight.sum(0), 1e-9)
        pooled = np.einsum("tw,twd->wd", weight, h)
        return pooled @ self.p["o"] + self.p["b"][0], weight, pooled

    def gradients(self, x: np.ndarray, lengths: np.ndarray, y: np.ndarray, importance: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Weighted log loss of windows ``x`` (windows, steps, inputs) with labels ``y``, and its gradients."""
        windows, steps, _ = x.shape
        n, p = self.hidden, self.p
        h = np.zeros((steps, windows, 2 * n), x.dtype)
        kept: dict[str, list] = {"f": [None] * steps, "b": [None] * steps}
        for side, order, lo in (("f", range(steps), 0), ("b", reversed(range(steps)), n)):
            projected = x @ p["w" + side] + p["b" + side]
            state = np.zeros((windows, n), x.dtype)
            for t in order:
                state, kept[side][t] = self._cell(projected[:, t], state, p["u" + side], (t < lengths)[:, None])
                h[t, :, lo : lo + n] = state
        logit, weight, pooled = self._pool(h, lengths)
        prob = _sigmoid(logit)
        total = importance.sum()
        loss = float(-(importance * np.where(y == 1, np.log(prob + 1e-9), np.log(1 - prob + 1e-9))).sum() / total)
        g = {k: np.zeros_like(v) for k, v in p.items()}
        d = importance * (prob - y) / total
        g["o"], g["b"] = pooled.T @ d, np.array([d.sum()], x.dtype)
        d_pooled = d[:, None] * p["o"]
        d_weight = np.einsum("wd,twd->tw", d_pooled, h)
        d_e = weight * (d_weight - (weight * d_weight).sum(0))
        g["a"] = np.einsum("tw,twd->d", d_e, h)
        d_h = weight[:, :, None] * d_pooled + d_e[:, :, None] * p["a"]
        for side, order, lo in (("f", reversed(range(steps)), 0), ("b", range(steps), n)):
            u, carried = p["u" + side], np.zeros((windows, n), x.dtype)
            for t in order:
                before, z, r, new, hu = kept[side][t]
                inside = (t < lengths)[:, None]
                d_after = d_h[t, :, lo : lo + n] + carried
                live = np.where(inside, d_after, 0)
                d_new = live * (1 - z) * (1 - new * new)
                d_z = live * (before - new) * z * (1 - z)
                d_r = d_new * hu * r * (1 - r)
                d_x = np.concatenate([d_z, d_r, d_new], 1)
                d_hu = np.concatenate([d_z, d_r, d_new * r], 1)
                g["w" + side] += x[:, t].T @ d_x
                g["b" + side] += d_x.sum(0)
                g["u" + side] += before.T @ d_hu
                carried = np.where(inside, live * z, d_after) + d_hu @ u.T
        return loss, g

    def train(self, x, lengths, y, importance, *, epochs: int, batch: int = 256, rate: float = 0.01, seed: int = 6) -> float:
        """Adam over shuffled batches; the last epoch's mean loss."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, mean = 0, 0.0
        for _ in range(epochs):
            order, losses = rng.permutation(len(x)), []
            for lo in range(0, len(x), batch):
                part = order[lo : lo + batch]
                loss, g = self.gradients(x[part], lengths[part], y[part], importance[part])
                losses.append(loss)
                step += 1
                for k in self.p:
                    first[k] = 0.9 * first[k] + 0.1 * g[k]
                    second[k] = 0.999 * second[k] + 0.001 * g[k] ** 2
                    self.p[k] = (self.p[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
            mean = float(np.mean(losses)) if losses else 0.0
        return mean
