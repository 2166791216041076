"""Two-label linear-chain conditional random field in numpy.

Label 1 at a position scores the sum of its features' weights, label 0 scores nothing, and
each step adds the weight of its label pair. With two labels the forward and backward
messages are one log ratio a position. Sequences lie one after the other in flat arrays,
``first`` holding their bounds; steps run over all sequences at once, longest first.
Used inside tasks for decoding; fitting runs on a bounded sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np


@dataclass
class Chain:
    weights: np.ndarray
    pairs: np.ndarray  # [label before, label]

    def emissions(self, slots: np.ndarray) -> np.ndarray:
        """Score of label 1 for positions whose features are the rows of ``slots``."""
        out = np.zeros(len(slots))
        for k in range(slots.shape[1]):
            out += self.weights[slots[:, k]]
        return out


def _steps(first: np.ndarray) -> Iterator[np.ndarray]:
    """Positions of step 0, 1, ... of every sequence that is long enough."""
    lens = np.diff(first)
    order = np.argsort(-lens, kind="stable")
    start, lens = first[:-1][order], lens[order]
    top = int(lens[0]) if len(lens) else 0
    alive = np.searchsorted(-lens, -np.arange(top), "left")
    for t in range(top):
        yield start[:alive[t]] + t


def _log_ratio(r: np.ndarray, t: np.ndarray) -> np.ndarray:
    """log of (e^t01 + e^(r+t11)) / (e^t00 + e^(r+t10))."""
    return np.logaddexp(t[0, 1], r + t[1, 1]) - np.logaddexp(t[0, 0], r + t[1, 0])


def messages(u: np.ndarray, first: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward log ratios of label 1 to label 0 (forward includes ``u``)."""
    fwd, back = np.zeros(len(u)), np.zeros(len(u))
    steps = list(_steps(first))
    for t, at in enumerate(steps):
        fwd[at] = u[at] if t == 0 else u[at] + _log_ratio(fwd[at - 1], pairs)
    flip = pairs.T
    for at in reversed(steps[1:]):
        back[at - 1] = _log_ratio(u[at] + back[at], flip)
    return fwd, back


def marginals(u: np.ndarray, first: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Probability of label 1 at every position."""
    fwd, back = messages(u, first, pairs)
    return 1 / (1 + np.exp(-np.clip(fwd + back, -500, 500)))


def viterbi(u: np.ndarray, first: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Labels of the best path; a tie goes to label 0."""
    diff = np.zeros(len(u))  # best score ending in 1, less that ending in 0
    via = np.zeros((2, len(u)), bool)
    steps = list(_steps(first))
    for t, at in enumerate(steps):
        if t == 0:
            diff[at] = u[at]
            continue
        d = diff[at - 1]
        to0, to1 = d + pairs[1, 0] > pairs[0, 0], d + pairs[1, 1] > pairs[0, 1]
        via[0, at], via[1, at] = to0, to1
        diff[at] = (u[at] + np.where(to1, d + pairs[1, 1], pairs[0, 1])
                    - np.where(to0, d + pairs[1, 0], pairs[0, 0]))
    label = np.zeros(len(u), bool)
    ends = first[1:][np.diff(first) > 0] - 1
    label[ends] = diff[ends] > 0
    for at in reversed(steps[1:]):
        label[at - 1] = np.where(label[at], via[1, at], via[0, at])
    return label


def fit(slots: np.ndarray, labels: np.ndarray, first: np.ndarray, n_weights: int,
        steps: int = 120, rate: float = 0.3, l2: float = 1e-4) -> Chain:
    """Maximises the mean log likelihood per position with Adam on the whole sample."""
    chain = Chain(np.zeros(n_weights), np.zeros((2, 2)))
    n = max(1, len(labels))
    y = labels.astype(float)
    inner = np.ones(len(labels), bool)
    inner[first[:-1][np.diff(first) > 0]] = False
    cur = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (labels[cur - 1].astype(int), labels[cur].astype(int)), 1)
    m = v = np.zeros(n_weights + 4)
    for step in range(1, steps + 1):
        u = chain.emissions(slots)
        fwd, back = messages(u, first, chain.pairs)
        p = 1 / (1 + np.exp(-np.clip(fwd + back, -500, 500)))
        g = np.zeros(n_weights)
        for k in range(slots.shape[1]):
            g += np.bincount(slots[:, k], y - p, n_weights)
        a, b = fwd[cur - 1], u[cur] + back[cur]
        w = np.stack([np.full(len(cur), chain.pairs[0, 0]), chain.pairs[0, 1] + b,
                      chain.pairs[1, 0] + a, chain.pairs[1, 1] + a + b])
        w = np.exp(w - w.max(axis=0)) if len(cur) else w
        expected = (w / w.sum(axis=0)).sum(axis=1).reshape(2, 2) if len(cur) else np.zeros((2, 2))
        x = np.concatenate([chain.weights, chain.pairs.ravel()])
        g = np.concatenate([g, (seen - expected).ravel()]) / n - l2 * x
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        x = x + rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        chain = Chain(x[:n_weights], x[n_weights:].reshape(2, 2))
    return chain


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-3, steps: int = 30) -> np.ndarray:
    """Newton's method; the last column of ``x`` is the constant."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (y - p) / len(y) - l2 * w
        h = (x * (p * (1 - p))[:, None]).T @ x / len(y) + l2 * np.eye(len(w))
        w = w + np.linalg.solve(h, g)
    return w
