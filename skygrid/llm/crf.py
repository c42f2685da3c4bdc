"""A linear chain of two labels: batched forward-backward, likelihood gradient, and fitting by Adam."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BAD, GOOD = 0, 1


def padded(lengths: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of all sequences laid out as (sequence, step, ...), and the mask of real steps."""
    mask = np.arange(int(lengths.max(initial=0)))[None, :] < lengths[:, None]
    out = np.zeros(mask.shape + values.shape[1:])
    out[mask] = values
    return out, mask


def chunks(lengths: np.ndarray, cells: int = 200_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sequences of like length together, at most ``cells`` padded steps at once: their numbers, and their rows."""
    order = np.argsort(lengths, kind="stable")
    begin = np.cumsum(lengths) - lengths
    k = 0
    while k < len(order):
        n = 1
        while k + n < len(order) and (n + 1) * lengths[order[k + n]] <= cells:
            n += 1
        part = order[k:k + n]
        yield part, np.concatenate([np.arange(begin[j], begin[j] + lengths[j]) for j in part])
        k += n


def marginals(score: np.ndarray, mask: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label marginals, and pair marginals summed over all steps.

    ``score`` is (sequence, step, label), ``move`` the transition scores. Every step works on all sequences at once.
    """
    n, steps, _ = score.shape
    pairs = np.zeros((2, 2))
    if not steps:
        return score, pairs
    fwd, back = np.zeros_like(score), np.zeros_like(score)
    fwd[:, 0] = score[:, 0]
    for t in range(1, steps):
        a = fwd[:, t - 1, :, None] + move
        fwd[:, t] = np.where(mask[:, t, None], np.logaddexp(a[:, 0], a[:, 1]) + score[:, t], fwd[:, t - 1])
    log_z = np.logaddexp(fwd[:, -1, 0], fwd[:, -1, 1])
    for t in range(steps - 2, -1, -1):
        a = move + (score[:, t + 1] + back[:, t + 1])[:, None, :]
        back[:, t] = np.where(mask[:, t + 1, None], np.logaddexp(a[:, :, 0], a[:, :, 1]), 0.0)
        pairs += np.einsum("nab,n->ab", np.exp(fwd[:, t, :, None] + a - log_z[:, None, None]), mask[:, t + 1])
    return np.exp(fwd + back - log_z[:, None, None]) * mask[:, :, None], pairs


def fit(features: np.ndarray, lengths: np.ndarray, labels: np.ndarray, *, steps: int = 120, rate: float = 0.1,
        ridge: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Emission weights (feature, label) and transition scores of the penalised conditional likelihood.

    ``features`` and ``labels`` hold the lines of all sequences one after another.
    """
    emit, move = np.zeros((features.shape[1], 2)), np.zeros((2, 2))
    if not len(labels):
        return emit, move
    owner = np.repeat(np.arange(len(lengths)), lengths)
    gold_emit = np.stack([(labels == k) @ features for k in (BAD, GOOD)], 1)
    gold_move = np.zeros_like(move)
    inner = np.flatnonzero(owner[1:] == owner[:-1])
    np.add.at(gold_move, (labels[inner], labels[inner + 1]), 1.0)
    parts = [(lengths[p], features[rows]) for p, rows in chunks(lengths)]
    seen = [[np.zeros_like(x), np.zeros_like(x)] for x in (emit, move)]
    for step in range(1, steps + 1):
        grad = [gold_emit - ridge * len(labels) * emit, gold_move - ridge * len(labels) * move]
        for n, x in parts:
            score, mask = padded(n, x @ emit)
            p, pairs = marginals(score, mask, move)
            grad[0] -= x.T @ p[mask]
            grad[1] -= pairs
        for param, g, (m, v) in zip((emit, move), grad, seen):
            g = g / len(labels)
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            param += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return emit, move
