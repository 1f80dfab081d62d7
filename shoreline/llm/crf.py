"""Linear-chain conditional random fields with two labels, fitted on a bounded set of sequences.

An item is a row of feature values, a sequence is a run of items. The score of a labelling is the
sum of each item's feature weights for its label and of the weights of neighbouring label pairs.
"""

from __future__ import annotations

import numpy as np

LABELS = 2


class Chain:
    def __init__(self, weights: np.ndarray, steps: np.ndarray):
        self.weights, self.steps = weights, steps

    def decode(self, features: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The best label of every item (Viterbi), for sequences laid end to end.

        All sequences advance together, longest first, so the Python loop runs as often as the
        longest one has items. Equal scores choose label 0.
        """
        scores = features @ self.weights
        starts = np.cumsum(lengths) - lengths
        order = np.argsort(-lengths, kind="stable")
        longest = int(lengths.max(initial=0))
        alive = np.searchsorted(-lengths[order], -np.arange(1, longest + 1), side="right")
        best = np.zeros((len(lengths), LABELS))
        back = np.zeros((len(features), LABELS), np.int8)
        for t in range(longest):
            now = order[: alive[t]]
            at = starts[now] + t
            if t:
                paths = best[now][:, :, None] + self.steps
                back[at] = paths.argmax(1)
                best[now] = paths.max(1) + scores[at]
            else:
                best[now] = scores[at]
        out = np.zeros(len(features), np.int8)
        label = best.argmax(1).astype(np.int8)
        for t in range(longest - 1, -1, -1):
            now = order[: alive[t]]
            at = starts[now] + t
            out[at] = label[now]
            label[now] = back[at, label[now]]
        return out


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def fit(
    features: np.ndarray, labels: np.ndarray, lengths: np.ndarray, rounds: int = 150, decay: float = 1e-3,
    rate: float = 0.1, segment: int = 32,
) -> Chain:
    """Maximum likelihood with a quadratic penalty, by Adam on exact gradients.

    Sequences are cut into segments of at most ``segment`` items for training only.
    """
    cuts = [min(segment, n - s) for n in lengths.tolist() for s in range(0, n, segment)]
    lengths = np.array(cuts, np.int64)
    starts = np.cumsum(lengths) - lengths
    n, longest = len(lengths), int(lengths.max())
    inside = np.arange(longest) < lengths[:, None]
    at = np.where(inside, starts[:, None] + np.arange(longest), 0)
    truth = np.eye(LABELS)[labels]
    pairs_seen = np.zeros((LABELS, LABELS))
    both = inside[:, 1:]
    np.add.at(pairs_seen, (labels[at[:, :-1][both]], labels[at[:, 1:][both]]), 1)
    size = features.shape[1]
    theta = np.zeros(size * LABELS + LABELS * LABELS)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        weights, steps = theta[: size * LABELS].reshape(size, LABELS), theta[size * LABELS :].reshape(LABELS, LABELS)
        scores = (features @ weights)[at]
        ahead, behind = np.zeros((n, longest, LABELS)), np.zeros((n, longest, LABELS))
        ahead[:, 0] = scores[:, 0]
        for t in range(1, longest):
            on = _logsum(ahead[:, t - 1][:, :, None] + steps, 1) + scores[:, t]
            ahead[:, t] = np.where(inside[:, t, None], on, ahead[:, t - 1])
        total = _logsum(ahead[:, -1], 1)
        for t in range(longest - 2, -1, -1):
            on = _logsum(steps + (scores[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
            behind[:, t] = np.where(inside[:, t + 1, None], on, 0)
        chance = np.exp(ahead + behind - total[:, None, None])
        joint = np.exp(
            ahead[:, :-1, :, None] + steps + (scores + behind)[:, 1:, None, :] - total[:, None, None, None]
        )
        expected = np.zeros((len(features), LABELS))
        expected[at[inside]] = chance[inside]
        slope = np.concatenate(
            [
                (features.T @ (expected - truth)).ravel(),
                (joint[both].sum(0) - pairs_seen).ravel(),
            ]
        ) / len(features) + decay * theta
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        theta = theta - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Chain(theta[: size * LABELS].reshape(size, LABELS), theta[size * LABELS :].reshape(LABELS, LABELS))
