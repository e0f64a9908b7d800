"""Logistic regression over sparse rows, and its calibration, for models fitted on a bounded sample."""

from __future__ import annotations

import numpy as np

#: Entries of sparse rows that are worked on at once: what is computed of each takes memory for so many only.
ENTRIES = 1 << 19


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def row_sums(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    """Sum of value times weight over the entries of each row."""
    out = np.zeros(n)
    for a in range(0, len(rows), ENTRIES):
        part = slice(a, a + ENTRIES)
        np.add.at(out, rows[part], values[part] * weights[columns[part]])
    return out


def fit_logistic(
    rows: np.ndarray, columns: np.ndarray, values: np.ndarray, y: np.ndarray, size: int, l1=0.0, l2=1e-4, steps=150, rate=0.1
) -> tuple[np.ndarray, float]:
    """Weights and intercept by Adam on the whole sample, classes weighted alike; l1 shrinks weights to exactly zero."""
    n, weights, bias = len(y), np.zeros(size), 0.0
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y <= 0).sum(), 1))
    m, v, mb, vb = np.zeros(size), np.zeros(size), 0.0, 0.0
    for t in range(1, steps + 1):
        z = row_sums(rows, columns, values, weights, n) + bias
        g = share * (sigmoid(z) - y)
        grad = row_sums(columns, rows, values, g, size) + l2 * weights
        gb = g.sum()
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb**2
        step = rate / (1 + t / steps)
        weights -= step * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        if l1:
            weights = np.sign(weights) * np.maximum(np.abs(weights) - step * l1, 0)
        bias -= step * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.99**t)) + 1e-8)
    return weights, bias


def fit_platt(scores: np.ndarray, y: np.ndarray, steps: int = 60) -> tuple[float, float]:
    """Slope and intercept of a probability from a score, by damped Newton steps, with smoothed targets; slope >= 0."""
    pos, neg = (y > 0).sum(), (y <= 0).sum()
    if not pos or not neg:
        return 1.0, 0.0
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    centre, scale = scores.mean(), scores.std() + 1e-12
    x = (scores - centre) / scale
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = sigmoid(a * x + b)
        w = np.maximum(p * (1 - p), 1e-9)
        ga, gb = ((p - target) * x).sum() + 1e-3 * a, (p - target).sum()
        haa, hab, hbb = (w * x * x).sum() + 1e-3, (w * x).sum(), w.sum() + 1e-9
        det = haa * hbb - hab * hab + 1e-12
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        size = max(1.0, abs(da), abs(db))
        a, b = a - da / size, b - db / size
    a = max(a, 0.0)
    return a / scale, b - a * centre / scale
