"""A character-level bidirectional LSTM with CRF transitions, in NumPy.

Works on windows of equal length: ``classes`` (windows x length) of character
classes in, one tag for each character out. Trained by back-propagation
through time on the CRF likelihood; decoded by Viterbi. All loops run over
the positions of a window; each step is array work over all windows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _lstm(classes: np.ndarray, w: np.ndarray, u: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """Hidden states (length, windows, units), and the steps if ``keep``."""
    n, length = classes.shape
    units = u.shape[0]
    h, c = np.zeros((n, units), np.float32), np.zeros((n, units), np.float32)
    out, steps = np.empty((length, n, units), np.float32), []
    for t in range(length):
        z = w[classes[:, t]] + h @ u
        gates = _sigmoid(z[:, : 3 * units])
        i, f, o = gates[:, :units], gates[:, units : 2 * units], gates[:, 2 * units :]
        g = np.tanh(z[:, 3 * units :])
        before, h_before = c, h
        c = f * before + i * g
        tc = np.tanh(c)
        h = o * tc
        out[t] = h
        if keep:
            steps.append((i, f, o, g, before, tc, h_before))
    return out, steps


def _lstm_back(classes: np.ndarray, u: np.ndarray, steps: list, dh: np.ndarray, vocabulary: int) -> tuple[np.ndarray, np.ndarray]:
    n, length = classes.shape
    dw, du = np.zeros((vocabulary, u.shape[1]), np.float32), np.zeros_like(u)
    later, dc = np.zeros((n, u.shape[0]), np.float32), np.zeros((n, u.shape[0]), np.float32)
    for t in range(length - 1, -1, -1):
        i, f, o, g, before, tc, h_before = steps[t]
        d = dh[t] + later
        dc = dc + d * o * (1 - tc**2)
        z = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), d * tc * o * (1 - o), dc * i * (1 - g**2)], axis=1)
        du += h_before.T @ z
        dw += (classes[:, t] == np.arange(vocabulary)[:, None]).astype(np.float32) @ z
        later, dc = z @ u.T, dc * f
    return dw, du


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis=axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis=axis, keepdims=True))).squeeze(axis)


@dataclass
class Tagger:
    """``w``/``u``: input and recurrent weights (forward, backward), ``e``: tag
    scores of the joined states, ``b``: tag biases, ``a``: transitions."""

    params: dict[str, np.ndarray]

    @classmethod
    def new(cls, vocabulary: int, tags: int, units: int, seed: int = 0) -> Tagger:
        rng = np.random.default_rng(seed)
        p = {}
        for d in "fb":
            p["w" + d] = rng.normal(0, 0.3, (vocabulary, 4 * units)).astype(np.float32)
            p["w" + d][:, units : 2 * units] += 1  # remember by default
            p["u" + d] = rng.normal(0, 1 / np.sqrt(units), (units, 4 * units)).astype(np.float32)
        p["e"] = rng.normal(0, 0.2, (2 * units, tags)).astype(np.float32)
        p["b"] = np.zeros(tags, np.float32)
        p["a"] = np.zeros((tags, tags), np.float32)
        return cls(p)

    def scores(self, classes: np.ndarray, keep: bool = False) -> tuple[np.ndarray, tuple]:
        """Tag scores (length, windows, tags)."""
        p = self.params
        f, fs = _lstm(classes, p["wf"], p["uf"], keep)
        b, bs = _lstm(classes[:, ::-1], p["wb"], p["ub"], keep)
        h = np.concatenate([f, b[::-1]], axis=2)
        return h @ p["e"] + p["b"], (h, fs, bs)

    def decode(self, classes: np.ndarray) -> np.ndarray:
        """The likeliest tags (windows x length)."""
        e, _ = self.scores(classes)
        a, best, back = self.params["a"], e[0], []
        for t in range(1, len(e)):
            total = best[:, :, None] + a
            back.append(total.argmax(axis=1).astype(np.int8))
            best = total.max(axis=1) + e[t]
        tags = np.empty((len(e), classes.shape[0]), np.int8)
        tags[-1] = best.argmax(axis=1)
        rows = np.arange(classes.shape[0])
        for t in range(len(e) - 2, -1, -1):
            tags[t] = back[t][rows, tags[t + 1]]
        return tags.T

    def viterbi(self, e: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The likeliest tags of stretches of any lengths, whose tag scores stand one
        after another in ``e`` (positions, tags) from ``offsets`` on."""
        a, size = self.params["a"], np.diff(offsets)
        order = np.argsort(-size, kind="stable")
        start, size = offsets[:-1][order], size[order]
        # stretches that have a position t are the first ones in order of length
        live = np.searchsorted(-size, -np.arange(int(size.max(initial=0)) + 1), side="left")
        best, back = e[start].copy(), []
        for t in range(1, len(live) - 1):
            n = live[t]
            total = best[:n, :, None] + a
            back.append(total.argmax(axis=1).astype(np.int8))
            best[:n] = total.max(axis=1) + e[start[:n] + t]
        state = best.argmax(axis=1)
        tags = np.empty(len(e), np.int8)
        for t in range(len(live) - 2, -1, -1):
            n = live[t]
            tags[start[:n] + t] = state[:n]
            if t:
                state[:n] = back[t - 1][np.arange(n), state[:n]]
        return tags

    def gradients(self, classes: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood a window, and its gradient."""
        p = self.params
        e, (h, fs, bs) = self.scores(classes, keep=True)
        length, n, k = e.shape
        a = p["a"]
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[0] = e[0]
        for t in range(1, length):
            alpha[t] = _log_sum(alpha[t - 1][:, :, None] + a, 1) + e[t]
        for t in range(length - 2, -1, -1):
            beta[t] = _log_sum(a + (e[t + 1] + beta[t + 1])[:, None, :], 2)
        z = _log_sum(alpha[-1], 1)
        de = np.exp(alpha + beta - z[:, None])
        rows = np.arange(n)
        da = np.zeros_like(a)
        gold = np.zeros(n)
        for t in range(length):
            gold += e[t][rows, tags[:, t]]
            de[t][rows, tags[:, t]] -= 1
            if t:
                pair = alpha[t - 1][:, :, None] + a + (e[t] + beta[t])[:, None, :] - z[:, None, None]
                da += np.exp(pair).sum(axis=0)
                np.add.at(da, (tags[:, t - 1], tags[:, t]), -1)
                gold += a[tags[:, t - 1], tags[:, t]]
        de /= n
        dh = de @ p["e"].T
        units = p["uf"].shape[0]
        v = p["wf"].shape[0]
        g = {"a": da / n, "b": de.sum(axis=(0, 1)), "e": np.einsum("tnh,tnk->hk", h, de)}
        g["wf"], g["uf"] = _lstm_back(classes, p["uf"], fs, dh[:, :, :units], v)
        g["wb"], g["ub"] = _lstm_back(classes[:, ::-1], p["ub"], bs, dh[::-1, :, units:], v)
        return float((z - gold).mean()), g

    def train(self, classes: np.ndarray, tags: np.ndarray, epochs: int, batch: int = 32, rate: float = 0.02, seed: int = 0) -> list[float]:
        """Adam with a falling rate over shuffled batches; the mean loss of each epoch."""
        rng = np.random.default_rng(seed)
        mean, square, step, losses = {}, {}, 0, []
        for epoch in range(epochs):
            order, loss = rng.permutation(len(classes)), []
            for i in range(0, len(order), batch):
                pick = order[i : i + batch]
                value, g = self.gradients(classes[pick], tags[pick])
                loss.append(value)
                step += 1
                norm = np.sqrt(sum(float((x**2).sum()) for x in g.values()))
                for k, x in g.items():
                    x = x * min(1, 5 / max(norm, 1e-9))
                    mean[k] = 0.9 * mean.get(k, 0) + 0.1 * x
                    square[k] = 0.999 * square.get(k, 0) + 0.001 * x * x
                    move = mean[k] / (1 - 0.9**step) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
                    self.params[k] = (self.params[k] - rate * 0.8**epoch * move).astype(np.float32)
            losses.append(float(np.mean(loss)) if loss else 0.0)
        return losses
