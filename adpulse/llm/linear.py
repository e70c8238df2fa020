"""Hashed character n-grams and a logistic scorer on them."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np

BITS = 18
WIDTH = 1 << BITS
_ODD = np.uint64(0x9E3779B97F4A7C15)
BYTES_AT_ONCE = 1 << 20


class Grams:
    """Which hashed n-grams a text has, each once. Letters count lower-case
    (A-Z only); a text is framed by blanks."""

    def __init__(self, sizes: Sequence[int], lower: bool = True):
        self.sizes, self.lower = tuple(sizes), lower
        self.seen = np.zeros(WIDTH, dtype=bool)

    def __call__(self, text: str | None) -> np.ndarray:
        raw = b" " + (text or "").encode() + b" "
        data = np.frombuffer(raw.lower() if self.lower else raw, dtype=np.uint8)
        for at in range(0, len(data), BYTES_AT_ONCE):
            part = data[at:at + BYTES_AT_ONCE + max(self.sizes) - 1].astype(np.uint64)
            for n in self.sizes:
                if len(part) >= n:
                    value = np.full(len(part) - n + 1, n, dtype=np.uint64)
                    for k in range(n):
                        value = (value << np.uint64(8)) | part[k:len(part) - n + 1 + k]
                    self.seen[((value * _ODD) >> np.uint64(64 - BITS)).astype(np.intp)] = True
        found = np.flatnonzero(self.seen)
        self.seen[found] = False
        return found


def log_count_ratios(features: Iterable[np.ndarray], labels: Sequence[float], smooth: float = 1.0) -> np.ndarray:
    """Naive Bayes log-count ratio of each feature: presence in label 1
    against presence in label 0, smoothed."""
    counts = np.full((2, WIDTH), smooth)
    for found, label in zip(features, labels):
        counts[1, found] += label
        counts[0, found] += 1 - label
    totals = np.array([sum(1 - y for y in labels), sum(labels)]) + 2 * smooth
    return np.log(counts[1] / totals[1]) - np.log(counts[0] / totals[0])


def train(features: list[np.ndarray], labels: Sequence[float], scale: np.ndarray,
          epochs: int = 6, rate: float = 0.5, decay: float = 1e-4, seed: int = 3) -> tuple[np.ndarray, float]:
    """Weights of the features and intercept of a logistic model on features of
    unit length (scaled by ``scale`` first), by adaptive gradient steps; the
    two sides of the labels weigh the same. Labels may be probabilities."""
    width = len(scale)
    y = np.asarray(labels, dtype=np.float64)
    weights, bias = np.zeros(width), 0.0
    if not len(y):
        return weights, bias
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    importance = np.where(y >= 0.5, 0.5 / share, 0.5 / (1 - share))
    squares, bias_squares = np.full(width, 1e-6), 1e-6
    rng = np.random.default_rng(seed)
    total, bias_total, steps = np.zeros(width), 0.0, 0
    for epoch in range(epochs):
        for i in rng.permutation(len(y)):
            found = features[i]
            x = scale[found]
            x = x / max(np.sqrt(x @ x), 1e-12)
            error = importance[i] * (1 / (1 + np.exp(-np.clip(weights[found] @ x + bias, -30, 30))) - y[i])
            slope = error * x + decay * weights[found]
            squares[found] += slope * slope
            weights[found] -= rate * slope / np.sqrt(squares[found])
            bias_squares += error * error
            bias -= rate * error / np.sqrt(bias_squares)
        if epoch >= epochs // 2:  # average of the later epochs
            total += weights
            bias_total += bias
            steps += 1
    return total / steps, bias_total / steps


def score(found: np.ndarray, weights: np.ndarray, bias: float, squares: np.ndarray) -> float:
    """``weights`` times scale and ``squares`` of the scale are given, so a
    text costs two sums."""
    length = np.sqrt(max(squares[found].sum(), 1e-24)) if len(found) else 1.0
    margin = weights[found].sum() / length + bias
    return float(1 / (1 + np.exp(-np.clip(margin, -30, 30))))
