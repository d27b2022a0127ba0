"""Small numpy classifiers for bounded samples of labelled rows."""

from __future__ import annotations

import numpy as np


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


#: Sparse values worked on at a time.
CHUNK = 1 << 20


def chunks(n: int):
    return [slice(i, min(i + CHUNK, n)) for i in range(0, n, CHUNK)]


def logits(row, col, value, n_rows: int, w):
    """The weighted sum of each sparse row."""
    z = np.zeros(n_rows)
    for s in chunks(len(row)):
        z += np.bincount(row[s], value[s] * w[col[s]], n_rows)
    return z


def logistic(row, col, value, n_rows: int, n_cols: int, target, weight, l2: float = 1e-3, rounds: int = 150, rate: float = 0.1):
    """(weights, bias) of a logistic regression on sparse rows, soft targets allowed.

    Full-batch Adam from zero, so the same rows give the same weights.
    """
    w, b = np.zeros(n_cols), 0.0
    m, v, mb, vb = np.zeros(n_cols), np.zeros(n_cols), 0.0, 0.0
    total = weight.sum()
    for t in range(1, rounds + 1):
        z = logits(row, col, value, n_rows, w) + b
        g = weight * (sigmoid(z) - target) / total
        gw = l2 * w
        for s in chunks(len(row)):
            gw += np.bincount(col[s], value[s] * g[row[s]], n_cols)
        gb = g.sum()
        m, v = 0.9 * m + 0.1 * gw, 0.999 * v + 0.001 * gw * gw
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        c1, c2 = 1 - 0.9 ** t, 1 - 0.999 ** t
        w -= rate * (m / c1) / (np.sqrt(v / c2) + 1e-9)
        b -= rate * (mb / c1) / (np.sqrt(vb / c2) + 1e-9)
    return w, float(b)


def calibrate(z, target, rounds: int = 50) -> tuple[float, float]:
    """(scale, shift) such that sigmoid(scale * z + shift) is a probability (Platt, by Newton steps)."""
    a, b = 1.0, 0.0
    pos, neg = target.sum(), (1 - target).sum()
    goal = np.where(target > 0.5, (pos + 1) / (pos + 2), 1 / (neg + 2))  # smoothed, as usual for this fit
    for _ in range(rounds):
        p = sigmoid(a * z + b)
        d = p - goal
        h = np.maximum(p * (1 - p), 1e-9)
        grad = np.array([(d * z).sum() + 1e-3 * (a - 1), d.sum()])
        hess = np.array([[(h * z * z).sum() + 1e-3, (h * z).sum()], [(h * z).sum(), h.sum() + 1e-6]])
        step = np.linalg.solve(hess, grad)
        size = np.abs(step).max()
        if size > 2:
            step *= 2 / size
        a, b = a - step[0], b - step[1]
        if size < 1e-8:
            break
    return float(max(a, 1e-3)), float(b)
