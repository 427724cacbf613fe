"""A small gated recurrent language model in numpy, with a class-factored output.

Token 0 is the end of a text (and the input before its first token), token 1 any word outside the vocabulary, the others words.
Token t is member t % width of class t // width: its probability is the class's times its share inside the class."""

from __future__ import annotations

import numpy as np

HIDDEN = 16
WIDTH = 48
CLASSES = 48
VOCABULARY = WIDTH * CLASSES
WINDOW = 32
STREAMS = 128
LN10 = np.log(10.0)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Gru:
    def __init__(self, theta: np.ndarray | None = None, hidden: int = HIDDEN, classes: int = CLASSES, width: int = WIDTH):
        self.h, self.c, self.w = hidden, classes, width
        self.shapes = [(classes * width, 3 * hidden), (hidden, 3 * hidden), (hidden, classes), (classes,), (classes, hidden, width), (classes, width)]
        size = sum(int(np.prod(s)) for s in self.shapes)
        if theta is None:
            theta = np.random.default_rng(3).standard_normal(size) * 0.1
        self.theta = np.array(theta, np.float32)
        self.x, self.u, self.wc, self.bc, self.ww, self.bw = self._views(self.theta)

    def _views(self, flat: np.ndarray) -> list[np.ndarray]:
        out, a = [], 0
        for s in self.shapes:
            n = int(np.prod(s))
            out.append(flat[a:a + n].reshape(s))
            a += n
        return out

    # -------------------------------------------------------------- recurrence and output
    def step(self, ids: np.ndarray, h: np.ndarray):
        k = self.h
        gx, gh = self.x[ids], h @ self.u
        zr = _sigmoid(gx[:, :2 * k] + gh[:, :2 * k])
        z, r = zr[:, :k], zr[:, k:]
        n = np.tanh(gx[:, 2 * k:] + r * gh[:, 2 * k:])
        return n + z * (h - n), z, r, n, gh[:, 2 * k:]

    def output(self, hs: np.ndarray, target: np.ndarray, grad: bool = False):
        """ln probability of each target, and the gradients of their sum if wanted.  Targets are sorted by class and lie side by side in
        the arrays' last dimension, so that sums over classes and members run along memory."""
        cls, at = target // self.w, np.arange(len(target))
        order = np.argsort(cls, kind="stable")
        cls, member = cls[order], (target % self.w)[order]
        cuts = np.searchsorted(cls, np.arange(self.c + 1))
        some = [(c, slice(cuts[c], cuts[c + 1])) for c in np.flatnonzero(np.diff(cuts)).tolist()]
        ht = np.ascontiguousarray(hs[order].T)
        lc = self.wc.T @ ht
        lc += self.bc[:, None]
        lw = np.empty((self.w, len(at)), lc.dtype)
        for c, i in some:
            lw[:, i] = self.ww[c].T @ ht[:, i]
            lw[:, i] += self.bw[c][:, None]
        sorted_logp = np.zeros(len(at))
        for x, y in ((lc, cls), (lw, member)):
            x -= x.max(0)
            own = x[y, at]
            np.exp(x, out=x)
            s = x.sum(0)
            sorted_logp += own - np.log(s)
            if grad:
                x *= -1 / s
                x[y, at] += 1
        logp = np.empty(len(at))
        logp[order] = sorted_logp
        if not grad:
            return logp
        dht = self.wc @ lc
        dww, dbw = np.zeros_like(self.ww), np.zeros_like(self.bw)
        for c, i in some:
            dww[c], dbw[c] = ht[:, i] @ lw[:, i].T, lw[:, i].sum(1)
            dht[:, i] += self.ww[c] @ lw[:, i]
        dh = np.empty_like(hs)
        dh[order] = dht.T
        return logp, dh, ht @ lc.T, lc.sum(1), dww, dbw

    # -------------------------------------------------------------- scoring
    def score(self, texts: list[np.ndarray]) -> np.ndarray:
        """ln probability of each whole text (arrays of token ids that end with 0): texts are walked side by side, longest first, in windows, and the
        state goes on from window to window."""
        total = np.zeros(len(texts))
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        for a in range(0, len(order), 2048):
            part = order[a:a + 2048]
            sizes = np.asarray([len(texts[i]) for i in part])
            flat = np.concatenate([texts[i] for i in part]).astype(np.int64)
            start = np.cumsum(sizes) - sizes
            h, prev = np.zeros((len(part), self.h), np.float32), np.zeros(len(part), np.int64)
            for t0 in range(0, int(sizes[0]), WINDOW):
                hs, ys, who = [], [], []
                for t in range(t0, min(t0 + WINDOW, int(sizes[0]))):
                    n = int(np.searchsorted(-sizes, -t, side="left"))  # texts longer than t come first
                    h = self.step(prev[:n], h[:n])[0]
                    prev = flat[start[:n] + t]
                    hs.append(h)
                    ys.append(prev)
                    who.append(np.arange(n))
                logp = self.output(np.concatenate(hs), np.concatenate(ys))
                total[part] += np.bincount(np.concatenate(who), logp, minlength=len(part))
        return total

    # -------------------------------------------------------------- training
    def gradient(self, x: np.ndarray, y: np.ndarray, h: np.ndarray):
        """One window (time, streams): sum of ln p, its gradient and the state at the end.  Backpropagation stops at the window's start;
        the state is reset where a text begins; targets below 0 are padding."""
        steps, b = x.shape
        k, ut = self.h, np.ascontiguousarray(self.u.T)
        goes_on = (x != 0).astype(np.float32)[:, :, None]
        hs, before, g = (np.zeros((steps, b, k), np.float32) for _ in range(3))
        zr, n = np.zeros((steps, b, 2 * k), np.float32), np.zeros((steps, b, k), np.float32)
        for t in range(steps):
            before[t] = h * goes_on[t]
            h, z, r, n[t], g[t] = self.step(x[t], before[t])
            hs[t], zr[t, :, :k], zr[t, :, k:] = h, z, r
        real = np.flatnonzero(y.ravel() >= 0)
        logp, dreal, dwc, dbc, dww, dbw = self.output(hs.reshape(-1, k)[real], y.ravel()[real], True)
        dhs = np.zeros((steps * b, k), np.float32)
        dhs[real] = dreal
        dhs = dhs.reshape(hs.shape)
        # what a state's gradient is multiplied with on its way to each gate, for all steps at once
        z, r = zr[:, :, :k], zr[:, :, k:]
        dan = (1 - z) * (1 - n * n)
        factor = np.stack([(before - n) * z * (1 - z), dan * g * r * (1 - r), dan * r], 2)
        dgh, carry = np.zeros((steps, b, 3 * k), np.float32), np.zeros((b, k), np.float32)
        for t in range(steps - 1, -1, -1):
            dhs[t] += carry
            np.multiply(dhs[t][:, None, :], factor[t], out=dgh[t].reshape(b, 3, k))
            carry = (dhs[t] * z[t] + dgh[t] @ ut) * goes_on[t]
        dx = dgh.copy()
        dx[:, :, 2 * k:] = dhs * dan
        grad = np.zeros_like(self.theta)
        gx, gu, gwc, gbc, gww, gbw = self._views(grad)
        ids = x.ravel()
        order = np.argsort(ids, kind="stable")
        first = np.flatnonzero(np.diff(ids[order], prepend=-1))
        gx[ids[order[first]]] = np.add.reduceat(dx.reshape(-1, 3 * self.h)[order], first, axis=0)
        gu[:] = before.reshape(-1, self.h).T @ dgh.reshape(-1, 3 * self.h)
        gwc[:], gbc[:], gww[:], gbw[:] = dwc, dbc, dww, dbw
        return float(logp.sum()), len(real), grad, h


class Adam:
    def __init__(self, net: Gru, rate: float):
        self.net, self.rate, self.n = net, rate, 0
        self.m, self.v = np.zeros_like(net.theta), np.zeros_like(net.theta)

    def learn(self, texts: list[np.ndarray]) -> int:
        """One pass of truncated backpropagation over texts (token ids that end with 0); returns the tokens."""
        if not texts:
            return 0
        flat = np.concatenate(texts)
        b = max(1, min(STREAMS, len(flat) // WINDOW))
        length = -(-len(flat) // b)
        y = np.full(b * length, -1, np.int64)
        y[:len(flat)] = flat
        x = np.concatenate([[0], np.maximum(y[:-1], 0)])
        x, y = x.reshape(b, length).T, y.reshape(b, length).T
        h = np.zeros((b, self.net.h), np.float32)
        for t in range(0, length, WINDOW):
            _, n, grad, h = self.net.gradient(x[t:t + WINDOW], y[t:t + WINDOW], h)
            if not n:
                continue
            grad /= n
            grad *= min(1.0, 1.0 / max(float(np.linalg.norm(grad)), 1e-12))
            self.n += 1
            self.m += 0.1 * (grad - self.m)
            self.v += 0.01 * (grad * grad - self.v)
            rate = self.rate * np.sqrt(1 - 0.99 ** self.n) / (1 - 0.9 ** self.n)
            self.net.theta += np.float32(rate) * self.m / (np.sqrt(self.v) + np.float32(1e-6))
        return len(flat)
