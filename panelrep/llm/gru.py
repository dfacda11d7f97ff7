"""A bidirectional gated recurrent network over bytes, in numpy, trained by backpropagation through time.

Arrays are (direction, unit, lane): lanes are byte windows that step together.
Direction 0 reads forwards, direction 1 backwards.  A step is

    r, z = sigmoid(x_r + U_r h), sigmoid(x_z + U_z h)
    n = tanh(x_n + r * (U_n h + b))
    h = n + z * (h - n)

with x looked up by byte.  Padding (byte 256) leaves h as it is.
"""

from __future__ import annotations

import numpy as np

PAD = 256


class BiGru:
    def __init__(self, units: int, classes: int, seed: int = 0) -> None:
        g = np.random.default_rng(seed)
        self.units, self.classes = units, classes
        self.p = {
            "x": g.normal(0, 0.3, (2, 3 * units, 257)),
            "u": g.normal(0, units ** -0.5, (2, 3 * units, units)),
            "b": np.zeros((2, units, 1)),
            "w": g.normal(0, units ** -0.5, (2, classes, units)),
            "c": np.zeros((classes, 1)),
        }
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _step(self, h: np.ndarray, now: np.ndarray, then: np.ndarray, pads: bool) -> tuple:
        """One step of both directions: forwards on bytes ``now``, backwards on ``then``."""
        p, k = self.p, self.units
        x = np.stack([p["x"][0].take(now, axis=1), p["x"][1].take(then, axis=1)])
        a = np.matmul(p["u"], h)
        gates = x[:, :2 * k] + a[:, :2 * k]
        gates *= 0.5
        np.tanh(gates, out=gates)
        gates *= 0.5
        gates += 0.5
        r, z = gates[:, :k], gates[:, k:]
        v = a[:, 2 * k:] + p["b"]
        n = np.tanh(x[:, 2 * k:] + r * v)
        out = h - n
        out *= z
        out += n
        real = None
        if pads:
            real = (np.stack([now, then]) != PAD)[:, None, :]
            out = np.where(real, out, h)
        return out, r, z, n, v, real

    def logits(self, windows: np.ndarray) -> np.ndarray:
        """(position, class, lane) for windows (position, lane) of byte numbers, padded at the end."""
        size, lanes = windows.shape
        padded = (windows == PAD).any(axis=1)
        h = np.zeros((2, self.units, lanes), np.float32)
        out = np.empty((size, self.classes, lanes), np.float32)
        out[:] = self.p["c"]
        w = self.p["w"]
        for t in range(size):
            b = size - 1 - t
            h = self._step(h, windows[t], windows[b], bool(padded[t] or padded[b]))[0]
            out[t] += w[0] @ h[0]
            out[b] += w[1] @ h[1]
        return out

    def loss(self, windows: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over all real positions, and its gradient by backpropagation through time."""
        p, k = self.p, self.units
        size, lanes = windows.shape
        kind = p["x"].dtype
        hs, saved = [np.zeros((2, k, lanes), kind)], []
        logits = np.empty((size, self.classes, lanes), kind)
        logits[:] = p["c"]
        for t in range(size):
            b = size - 1 - t
            h, *rest = self._step(hs[-1], windows[t], windows[b], True)
            hs.append(h)
            saved.append(rest)
            logits[t] += p["w"][0] @ h[0]
            logits[b] += p["w"][1] @ h[1]
        real = windows != PAD
        total = max(1, int(real.sum()))
        e = np.exp(logits - logits.max(axis=1, keepdims=True))
        prob = e / e.sum(axis=1, keepdims=True)
        right = prob[:, labels, np.arange(lanes)]
        value = float(-(np.log(right + 1e-12) * real).sum() / total)
        d = prob
        d[:, labels, np.arange(lanes)] -= 1
        d *= real[:, None, :] / total
        g = {name: np.zeros_like(v) for name, v in p.items()}
        g["c"] += d.sum(axis=(0, 2))[:, None]
        back = np.zeros((2, k, lanes), kind)
        for t in reversed(range(size)):
            b = size - 1 - t
            h, old, (r, z, n, v, live) = hs[t + 1], hs[t], saved[t]
            g["w"][0] += d[t] @ h[0].T
            g["w"][1] += d[b] @ h[1].T
            back = back + np.stack([p["w"][0].T @ d[t], p["w"][1].T @ d[b]])
            through = np.where(live, back, 0)
            keep = back - through
            dn = through * (1 - z) * (1 - n * n)
            dv = dn * r
            dgate = np.concatenate([dn * v * r * (1 - r), through * (old - n) * z * (1 - z)], axis=1)
            da = np.concatenate([dgate, dv], axis=1)
            dx = np.concatenate([dgate, dn], axis=1)
            g["b"] += dv.sum(axis=2, keepdims=True)
            g["u"] += np.matmul(da, old.transpose(0, 2, 1))
            for way, bytes_ in ((0, windows[t]), (1, windows[b])):
                one = np.zeros((lanes, 257), kind)
                one[np.arange(lanes), bytes_] = 1
                g["x"][way] += dx[way] @ one
            back = keep + through * z + np.matmul(p["u"].transpose(0, 2, 1), da)
        return value, g

    def train(self, windows: np.ndarray, labels: np.ndarray, steps: int, batch: int, rate: float = 0.02,
              seed: int = 1) -> BiGru:
        """Adam on random batches of the windows (position, lane), every class drawn equally often."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        of = [np.flatnonzero(labels == c) for c in np.unique(labels)]
        for i in range(1, steps + 1):
            pick = np.concatenate([rng.choice(x, -(-batch // len(of))) for x in of])
            _, g = self.loss(windows[:, pick], labels[pick])
            size = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
            pull = min(1.0, 1.0 / (size + 1e-9))
            lr = rate * min(1.0, 2 * (1 - i / (steps + 1)))
            for k, v in g.items():
                v = v * pull
                m[k] = 0.9 * m[k] + 0.1 * v
                s[k] = 0.99 * s[k] + 0.01 * v * v
                self.p[k] -= (lr * (m[k] / (1 - 0.9 ** i)) / (np.sqrt(s[k] / (1 - 0.99 ** i)) + 1e-8)) \
                    .astype(self.p[k].dtype)
        return self
