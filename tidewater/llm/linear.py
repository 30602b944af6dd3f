"""Small logistic models over hashed features, fitted on bounded samples."""

from __future__ import annotations

import numpy as np


BLOCK = 1 << 19


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def platt(score: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> tuple[float, float]:
    """(a, b) so that sigmoid(a * score + b) is the probability of y = 1; targets are smoothed by the class sizes."""
    pos, neg = float((y == 1).sum()), float((y == 0).sum())
    target = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    weight = np.ones(len(y)) if weight is None else weight
    scale = max(float(np.std(score)), 1e-12)
    x = np.c_[score / scale, np.ones(len(score))]

    def loss(ab):
        z = x @ ab
        return float((weight * (np.logaddexp(0, z) - target * z)).sum())

    ab = np.zeros(2)
    for _ in range(100):
        p = sigmoid(x @ ab)
        grad = x.T @ (weight * (p - target))
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-9 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        now = loss(ab)
        while loss(ab - step) > now and abs(step).max() > 1e-9:
            step = step / 2
        ab = ab - step
        if abs(step).max() < 1e-8:
            break
    return float(ab[0] / scale), float(ab[1])


class Sparse:
    """Rows of (feature, value), flat: row i holds at[i]:at[i + 1]."""

    def __init__(self, at: np.ndarray, feature: np.ndarray, value: np.ndarray):
        self.at, self.feature, self.value = np.asarray(at, np.int64), feature, value

    @staticmethod
    def from_rows(rows: list[tuple[np.ndarray, np.ndarray]]) -> Sparse:
        return Sparse(np.r_[0, np.cumsum([len(f) for f, _ in rows], dtype=np.int64)],
                      np.concatenate([np.asarray(f, np.int32) for f, _ in rows] or [np.zeros(0, np.int32)]),
                      np.concatenate([np.asarray(v, np.float32) for _, v in rows] or [np.zeros(0, np.float32)]))

    @staticmethod
    def from_bytes(features: list[bytes], values: list[bytes]) -> Sparse:
        """From int32 features and float32 values per row; the lists are emptied on the way, as they hold as much again."""
        at = np.r_[0, np.cumsum([len(f) // 4 for f in features], dtype=np.int64)]
        out = Sparse(at, np.empty(int(at[-1]), np.int32), np.empty(int(at[-1]), np.float32))
        for i in range(len(at) - 1):
            out.feature[at[i] : at[i + 1]] = np.frombuffer(features[i], np.int32)
            out.value[at[i] : at[i + 1]] = np.frombuffer(values[i], np.float32)
            features[i] = values[i] = None
        return out

    def __len__(self):
        return len(self.at) - 1

    def rows(self, keep: np.ndarray) -> Sparse:
        """Those rows that keep marks."""
        size = np.diff(self.at)
        each = np.repeat(keep, size)
        return Sparse(np.r_[0, np.cumsum(size[keep])], self.feature[each], self.value[each])

    def _blocks(self):
        """(rows from, to) that hold about BLOCK features together, so that products need little room."""
        i = 0
        while i < len(self):
            j = max(i + 1, int(np.searchsorted(self.at, self.at[i] + BLOCK, side="right")) - 1)
            yield i, min(j, len(self))
            i = j

    def dot(self, w: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self))
        for i, j in self._blocks():
            a, b = self.at[i], self.at[j]
            total = np.cumsum(w[self.feature[a:b]] * self.value[a:b], dtype=np.float64)
            ends = self.at[i + 1 : j + 1] - a
            upto = np.where(ends > 0, total[ends - 1] if b > a else 0.0, 0.0)
            out[i:j] = np.diff(upto, prepend=0.0)
        return out

    def back(self, g: np.ndarray, dims: int) -> np.ndarray:
        out = np.zeros(dims)
        for i, j in self._blocks():
            a, b = self.at[i], self.at[j]
            each = np.repeat(g[i:j].astype(np.float32), np.diff(self.at[i : j + 1])) * self.value[a:b]
            out += np.bincount(self.feature[a:b], each, minlength=dims)
        return out


def fit_logistic(x: Sparse, y: np.ndarray, weight: np.ndarray, dims: int, l2: float = 1e-5, rounds: int = 120,
                 rate: float = 0.5, start: tuple[np.ndarray, float] | None = None, far: list | None = None) -> tuple[np.ndarray, float]:
    """(weights, intercept) by full-batch Adam: no order of rows, no random numbers. Rows of weight 0 don't count.

    start: a fit of similar rows to go on from.  far: of rows that are elsewhere, at start: gradient and curvature of the
    weights, of the intercept, and the rows' weight.
    """
    w, b = (start[0].copy(), start[1]) if start else (np.zeros(dims, np.float32), 0.0)
    m, v, mb, vb = np.zeros(dims), np.zeros(dims), 0.0, 0.0
    total = max(weight.sum() + (far[4] if far else 0.0), 1e-12)
    weight = weight / total
    y = np.where(weight > 0, y, 0)
    for i in range(1, rounds + 1):
        g = weight * (sigmoid(x.dot(w) + b) - y)
        gw, gb = x.back(g, dims) + l2 * w, g.sum()
        if far:
            gw += (far[0] + far[1] * (w - start[0])) / total
            gb += (far[2] + far[3] * (b - start[1])) / total
        m, v = 0.9 * m + 0.1 * gw, 0.99 * v + 0.01 * gw * gw
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        step = rate / (1 + i / 40)
        w -= (step * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-8)).astype(np.float32)
        b -= step * (mb / (1 - 0.9**i)) / (np.sqrt(vb / (1 - 0.99**i)) + 1e-8)
    return w, float(b)
